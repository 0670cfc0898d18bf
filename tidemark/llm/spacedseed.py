"""Benchmark decontamination with spaced seeds.

A seed is the hash of the words that a fixed mask selects from a window; where
the mask has a 0 a word may differ. Seeds of the benchmark items are joined
with seeds at every place of every text. Around a hit, item and text are laid
over each other and compared word by word; the best run, one point for each
equal word and one off for each other, counts as an overlap from
``needed`` points on: ``least``, for items of fewer than twice as many words half
of them, but no fewer than ``least`` - 2. Shorter items than ``least`` words
count where they occur whole, found by a seed of all their words. Words are
lower-cased runs of letters and digits; in scripts without blanks (Han, kana,
Thai, Lao, Khmer, Burmese) each letter is a word.

Texts are never shuffled to be searched: the seeds of the items, four numbers
each and once for equal items, are sent to all tasks in slices of about ``SLICE``
rows, so that their size is bounded whatever the benchmark, and each slice is
joined with the whole corpus. What it finds is one row per document, item and
offset; only then do the words of both come to it, by joins.

Defined cases: null and empty texts have no words; items without words are left
out, as are null items; an item of one word is found wherever that word is;
items that repeat are found each; equal ids with other texts are separate; an
empty benchmark finds nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import stored

MASKS = ("1101011", "11100101", "1001101001")
SHORT = "1011101"  # with the others it finds eight words with any inner one changed
SLICE = 2_000_000
LEAST = 8


#: Blocks of scripts that put no blanks between words.
UNSPACED = (
    r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\u9FFF\uA9E0-\uA9FF\uAA60-\uAA7F\uF900-\uFAFF\uFF66-\uFF9F"
    r"\x{1B000}-\x{1B16F}\x{20000}-\x{3FFFF}]"
)


def word_hashes(text: Column) -> Column:
    """A hash per word; texts that begin or end with other characters have an empty word there."""
    text = F.lower(F.coalesce(text, F.lit("")))
    apart = F.regexp_replace(text, UNSPACED, " $0 ")
    beyond = text.rlike(r"[\u0E00-\x{10FFFF}]")  # one comparison a character spares most texts the long list
    words = F.split(F.when(beyond, apart).otherwise(text), r"[^\p{L}\p{N}]+")
    return F.transform(words, lambda w: F.xxhash64(w))


def needed(n_words: Column, least: int) -> Column:
    """Points that count as an overlap with an item of so many words."""
    half = F.greatest(F.lit(least - 2), F.least(F.lit(least), F.floor(n_words / 2)))
    return F.when(n_words < least, n_words).otherwise(half).cast("int")


def _seeds(df: DataFrame, words: str, keep: Sequence[str], masks: Sequence[str]) -> DataFrame:
    """``keep`` columns with (place, seed) for every mask and every place where it fits; places count from 0."""
    placed = df.select(*keep, words, F.explode(F.sequence(F.lit(0), F.size(words) - 1)).alias("place"))
    hashed = []
    for mask in masks:
        chosen = [F.get(words, F.col("place") + at) for at, used in enumerate(mask) if used == "1"]
        fits = F.col("place") + len(mask) <= F.size(words)
        hashed.append(F.when(fits, F.xxhash64(F.lit(mask), *chosen)))
    many = placed.select(*keep, "place", F.explode(F.array(*hashed)).alias("seed"))
    return many.where(F.col("seed").isNotNull())


def _trimmed(words: Column) -> Column:
    """Without the empty words at the ends, where items are compared as a whole."""
    empty = F.xxhash64(F.lit(""))
    return F.filter(words, lambda w: w != empty)


def _best_run(equal: Column) -> Column:
    """(score, start, end) of the best run in an array of booleans; ``end`` is exclusive."""
    kind = "struct<at:int,run:int,since:int,score:int,start:int,end:int>"
    first = F.expr(f"cast(named_struct('at',0,'run',0,'since',0,'score',0,'start',0,'end',0) as {kind})")

    def step(s: Column, same: Column) -> Column:
        at = s["at"] + 1
        since = F.when(s["run"] <= 0, s["at"]).otherwise(s["since"])
        run = F.greatest(s["run"], F.lit(0)) + F.when(same, 1).otherwise(-1)
        better = run > s["score"]
        return F.struct(
            at.alias("at"),
            run.alias("run"),
            since.alias("since"),
            F.when(better, run).otherwise(s["score"]).alias("score"),
            F.when(better, since).otherwise(s["start"]).alias("start"),
            F.when(better, at).otherwise(s["end"]).alias("end"),
        ).cast(kind)

    return F.aggregate(equal, first, step)


def overlaps(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    masks: Sequence[str] = MASKS,
    least: int = LEAST,
) -> DataFrame:
    """(id, text_hash, item, score, first_word, n_words): the best overlap of each document and item that overlap."""
    theirs = items.select(F.col(item_col).alias("_item"), _trimmed(word_hashes(F.col(item_text_col))).alias("_theirs"))
    theirs = theirs.where(F.size("_theirs") > 0).withColumn("_key", F.xxhash64("_theirs")).distinct()
    theirs = stored(theirs, "items")
    known = theirs.select("_key", "_theirs").dropDuplicates(["_key"])
    long, short = F.size("_theirs") >= least, F.size("_theirs") < 2 * least - 1
    lengths = known.where(short).select(F.size("_theirs").alias("n")).distinct().collect()  # fewer than 2 * least
    whole = ["1" * n for n in sorted(r["n"] for r in lengths) if n < least]
    extra = [SHORT] if any(r["n"] >= least for r in lengths) else []
    seeds = _seeds(known.where(long), "_theirs", ["_key"], masks)
    if extra:
        seeds = seeds.union(_seeds(known.where(long & short), "_theirs", ["_key"], extra))
    for mask in whole:
        seeds = seeds.union(_seeds(known.where(F.size("_theirs") == len(mask)), "_theirs", ["_key"], [mask]))
    seeds = seeds.withColumnRenamed("place", "_at")
    masks = list(dict.fromkeys([*masks, *extra, *whole]))
    slices = max(1, -(-seeds.count() // SLICE))
    docs = df.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_words"))
    docs = docs.withColumn("_text", F.xxhash64("_words"))
    words = word_hashes(F.col("_words")).alias("_own")
    own = _seeds(docs.select("_doc", "_text", words), "_own", ["_doc", "_text"], masks)
    parts = []
    for k in range(slices):
        # by the whole row, so that a seed of very many items is in all slices
        part = seeds.where(F.pmod(F.xxhash64("seed", "_key", "_at"), F.lit(slices)) == k) if slices > 1 else seeds
        parts.append(own.join(F.broadcast(part), "seed"))  # about SLICE rows
    hits = reduce(DataFrame.union, parts)
    hits = hits.select("_doc", "_text", "_key", (F.col("place") - F.col("_at")).alias("_off")).distinct()
    hits = stored(hits, "hits").withColumnsRenamed({"_doc": "_id", "_text": "_hash"})
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    # texts are hashed once, whatever their hits: exploding a list of one keeps the hashing below the join
    hit = docs.join(hits.select("_id", "_hash").distinct(), same, "left_semi")
    hit = hit.select("_doc", "_text", F.explode(F.array(words)).alias("_own"))
    hits = hit.join(hits.join(known, "_key"), same)  # items come to the hits first, so no text is shuffled per hit
    # where both reach: from the start of the item or of the text on
    low, skip = F.greatest(F.lit(0), F.col("_off")), F.greatest(F.lit(0), -F.col("_off"))
    both = F.least(F.size("_own") - low, F.size("_theirs") - skip)
    # exploding a list of one keeps the comparison out of the join: only what lies over the item leaves it, not the text
    over = F.struct(F.slice("_own", low + 1, both).alias("own"), F.slice("_theirs", skip + 1, both).alias("theirs"))
    hits = hits.select("_doc", "_text", "_key", low.alias("_low"), F.size("_theirs").alias("_size"),
                       F.explode(F.array(over)).alias("_over"))
    equal = F.zip_with("_over.own", "_over.theirs", lambda a, b: a == b)
    runs = hits.select("_doc", "_text", "_key", "_low", "_size", _best_run(equal).alias("_run"))
    found = runs.where(F.col("_run.score") >= needed(F.col("_size"), least)).select(
        "_doc", "_text", "_key",
        F.struct(
            F.col("_run.score").alias("score"),
            (-(F.col("_low") + F.col("_run.start"))).alias("first"),
            (F.col("_run.end") - F.col("_run.start")).alias("n_words"),
        ).alias("_best"),
    )
    best = found.groupBy("_doc", "_text", "_key").agg(F.max("_best").alias("_best"))
    named = best.join(theirs.select("_key", "_item"), "_key")
    best = named.groupBy("_doc", "_text", "_item").agg(F.max("_best").alias("_best"))
    return best.select(
        F.col("_doc").alias(id_col),
        F.col("_text").alias("text_hash"),
        F.col("_item").alias(item_col),
        F.col("_best.score").alias("score"),
        (-F.col("_best.first")).alias("first_word"),
        F.col("_best.n_words").alias("n_words"),
    )


def without_overlaps(
    df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """Rows of ``df`` that overlap with no item, all columns."""
    found = overlaps(df, items, id_col, text_col, **how)
    found = found.select(F.col(id_col).alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("_doc")) & (F.xxhash64(F.col(text_col)) == F.col("_hash"))
    return df.join(found, same, "left_anti")
