"""The operators as queries over the sample tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    binpack,
    bursttrie,
    chat,
    kneser,
    langmix,
    linedup,
    metricjoin,
    raking,
    resample,
    spacedseed,
    tensorhash,
    tokenfile,
    weakrules,
)
from tidemark.llm.jaccard import Measure
from tidemark.scratch import scratch_folder, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from those whose crc32(doc_id) mod 4 is not 2."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    model = langmix.fit(docs.where(~F.col("held_out")))
    return langmix.predict(docs, model, ("doc_id", "held_out"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, dealt over all layouts, formatted and read back."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], rows.schema
    )
    records = chat.records_of_rows(rows.union(probe), "conv_id", "turn", "role", "text")
    turns = chat.turns_of_records(records, "conv_id", "turn")
    read = chat.read_back(chat.render(turns))
    turns = F.array_join(
        F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "n_unknown",
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule votes of all documents, weighed by their estimated accuracies."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    features = stored(weakrules.text_features(docs).drop("text"), "text-features")
    failed = weakrules.base_failed()
    return weakrules.judged(features).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("kept")).alias("kept"),
        "quality",
    )


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written as block files and read back."""
    path = scratch_folder(spark, "token-blocks")
    docs = _table(spark, sf_dir, "documents")
    tokenfile.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    read = tokenfile.read_tokens(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes, tokens and rows."""
    weighed = stored(binpack.measured(_table(spark, sf_dir, "documents")), "weighed")
    placed = binpack.slotted(weighed, binpack.pack(weighed, shards=8))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap with benchmark items, and where."""
    found = spacedseed.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


#: Shares of tokens to these powers are the targets.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.9}


def op7_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the probability that brings sources, languages and topics to their targets."""
    text = F.col("text")
    docs = _table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "source", "lang", raking.topic_of(text).alias("topic"),
                       raking.tokens_of(text).alias("tokens"), F.lit(None).cast("string").alias("text"))
    docs = stored(docs, "cell-rows")
    return raking.mixed(docs, POWERS, keep=0.8).select(
        "doc_id", "source", "lang", "topic", "tokens", F.round("probability", 6).alias("probability"), "kept"
    )


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten of them or more hold."""
    docs = _table(spark, sf_dir, "documents")
    frequent = linedup.frequent_lines(docs, least=10)
    return linedup.drop_lines(docs, frequent, keep_text=False)


def op9_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links of 85 in 100 four-word shingles."""
    found = metricjoin.joined(_table(spark, sf_dir, "documents"), Measure(words=4, num=85, den=100))
    return _components(found)


def _components(found: DataFrame) -> DataFrame:
    return found.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents labelled good and not toxic."""
    labels = _table(spark, sf_dir, "labels")
    return labels.where("quality = 1 and toxic = 0").select("doc_id")


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of all documents under a model of the trusted ones, and which documents it keeps."""
    docs = _table(spark, sf_dir, "documents")
    found = kneser.classified(docs, trusted(spark, sf_dir))
    return found.select("doc_id", "lang", "perplexity", "threshold", "kept")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards ``benchmark``, the five in a hundred with the highest scores ranked."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = resample.fit(docs, _table(spark, sf_dir, "benchmark"))
    scores = stored(resample.scored(docs, model), "scores")
    return resample.drawn(scores, percent=5).select("doc_id", "n_features", "weight", "score", "rank")


def op12_tensor_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links of 80 in 100 two-word shingles, and which document of each stays."""
    found = tensorhash.near_duplicates(_table(spark, sf_dir, "documents"), Measure(words=2, num=80, den=100))
    return _components(found).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op13_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each opened by turns of its group's first one."""
    rows = bursttrie.turns(_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return bursttrie.trie(bursttrie.regrafted(stored(rows, "turns")))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_mixture,
        op2_chat_format,
        op3_quality_rules,
        op4_token_blocks,
        op5_vector_shards,
        op6_spaced_seeds,
        op7_raked_mixture,
        op8_line_runs,
        op9_metric_join,
        op10_kneser_ney,
        op11_importance_resampling,
        op12_tensor_minhash,
        op13_burst_trie,
    )
}

#: Checksum of the bytes that a list ``octets`` holds, bit by bit.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], octets), lambda c, o: list_reduce(
    [xor(c, o), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT],
    lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""

#: The bytes of a text in UTF-8.
_OCTETS = "list_transform(range(octet_length(encode({0}))), lambda i: CAST('0x' || hex(encode({0}))[2*i+1:2*i+2] AS BIGINT))"

_LINKED_SQL = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - {words} + 2),
                lambda i: array_to_string(w[i:i + {words} - 1], ' '))) END AS s FROM words
    ), items AS (
        SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
    ), links AS (
        SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b USING (g)
        WHERE a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= {least} * greatest(a.n, b.n)
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {least} * (a.n + b.n - count(*))
    ), reached AS (
        SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
    ), named AS (
        SELECT x, min(y) AS y FROM reached GROUP BY x
    )
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id{more}
    FROM sets LEFT JOIN named ON doc_id = x
"""

LLM_SQL: dict[str, str] = {
    "op2_chat_format": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), measured AS (
            SELECT *, role = 'assistant' AS learnt,
                length(text) + 2 * (length(text) - length(replace(replace(replace(text, '%', ''), '<', ''), '[', '')))
                AS text_chars,
                length(role) + 2 * (length(role) - length(translate(role, '%<[|' || chr(10), ''))) AS role_chars
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(sum(CASE WHEN learnt THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (learnt), '')) AS loss_sha256,
            CAST(sum(role_chars + text_chars + 13) AS BIGINT) AS formatted_chars,
            CAST(0 AS BIGINT) AS n_unknown
        FROM measured GROUP BY conv_id
    """,
    "op8_line_runs": r"""
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), lines AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM lines
        ), frequent AS (
            SELECT line_key FROM keyed WHERE line_key <> '' GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10
        ), marked AS (
            SELECT keyed.*, frequent.line_key IS NOT NULL AS gone FROM keyed LEFT JOIN frequent USING (line_key)
        )
        SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op9_metric_join": _LINKED_SQL.format(words=4, least=85, more=""),
    "op11_importance_resampling": rf"""
        WITH words AS (
            SELECT 0 AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents
            UNION ALL
            SELECT 1, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+') FROM benchmark
        ), runs AS (
            SELECT side, id, unnest(list_concat(w,
                list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM words
        ), features AS (
            SELECT f, {_OCTETS.format("f")} AS octets FROM (SELECT DISTINCT f FROM runs)
        ), buckets AS (
            SELECT f, {_CRC32} % 10000 AS bucket FROM features
        ), counted AS (
            SELECT side, id, bucket, count(*) AS n FROM runs JOIN buckets USING (f) GROUP BY ALL
        ), sums AS (
            SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t
            FROM counted GROUP BY bucket
        ), totals AS (
            SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(s_all AS DOUBLE) + 10000)
                / ((CAST(s AS DOUBLE) + 1) * (CAST(t_all AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM sums, totals
        ), weights AS (
            SELECT id, sum(n) AS n, sum(n * gain) AS weight FROM counted JOIN gains USING (bucket) WHERE side = 0 GROUP BY id
        ), scored AS (
            SELECT id AS doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
                CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln(
                (CAST(('0x' || sha256('42:' || id)[1:8]) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
            FROM words LEFT JOIN weights USING (id) WHERE side = 0
        ), placed AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS total
            FROM scored WHERE n_words >= 20
        )
        SELECT scored.doc_id, n_features, weight, score, CASE WHEN place <= 5 * total // 100 THEN place END AS rank
        FROM scored LEFT JOIN placed USING (doc_id)
    """,
    "op12_tensor_minhash": _LINKED_SQL.format(
        words=2, least=80, more=", doc_id = least(doc_id, coalesce(y, doc_id)) AS kept"
    ),
    "op13_burst_trie": rf"""
        WITH own AS (
            SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), octets AS (
            SELECT conv_id, turns, {_OCTETS.format("CAST(conv_id AS VARCHAR)")} AS octets FROM own
        ), cut AS (
            SELECT conv_id, turns, {_CRC32} % 4 AS h FROM octets
        ), built AS (
            SELECT c.conv_id, list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) AS turns
            FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
        ), paths AS (
            SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM built
        ), members AS (
            SELECT conv_id, depth, n, turns[1:depth] AS path FROM paths
        ), nodes AS (
            SELECT depth, path, min(conv_id) AS conv, count(*) AS n_convs,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends
            FROM members GROUP BY depth, path
        ), own_tokens AS (
            SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1)
                * len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS tokens FROM nodes
        ), families AS (
            SELECT n.*, p.conv AS parent, count(c.conv) AS children
            FROM own_tokens n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
            LEFT JOIN nodes c ON c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path GROUP BY ALL
        ), above AS (
            SELECT unnest(range(depth + 1)) AS top, path, tokens, children FROM families
        ), sums AS (
            SELECT top, path[1:top] AS path, count(*) FILTER (children = 0) AS leaves, sum(tokens) AS saved
            FROM above GROUP BY ALL
        )
        SELECT conv AS conv_id, CAST(f.depth AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, children AS n_children,
            leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
        FROM families f JOIN sums s ON s.top = f.depth AND s.path = f.path
    """,
}
