"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, ``ORDER`` at a time: letters keep their case,
digits are one character, white space is one blank. Texts are dealt into blocks
by document id, once to count and once to score:

1. ``block_grams``: every block reports its distinct n-grams and how often they
   occur in the trusted documents of the training part;
2. ``gram_costs``: counts are summed, sharded by n-gram; continuation counts,
   discounts and back-off weights follow by grouping, and joins on the n-gram,
   its suffixes and its contexts give each n-gram of the corpus its -log p;
3. ``scored``: the costs go back to the blocks that asked for them, and a block
   adds them up over its texts.

What travels are distinct n-grams per block, never one row per character, and
no table is sent to all tasks. A document's cost per character is drawn towards
the rate of its language by ``PRIOR`` characters, so that very short texts are
not judged on a few letters. Insults are a few words in hundreds and vanish in
a mean, so the costliest run of ``RUN`` characters anywhere in the text, its
peak, is a second score, which no length thins out. A document is rejected if
either score is above its language's threshold: the
``quantile`` of the trusted documents that were held out of training (one in
five), raised by ``margin``. A quantile of few documents is drawn, by ``WEIGHT``
documents, towards the median of all documents of the language times the ratio
of quantile to median that held-out documents of all languages have; so a
language that training hardly saw is measured by its own costs. In a language
without trusted text, and without any trusted document, nothing is rejected; no
language counts as one.

Defined cases: null and empty texts have no characters, cost their language's
rate (null where it has no text at all) and are kept; equal ids and repeated rows are scored row by row; ties at
the threshold are kept; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import Shelf, stored

ORDER = 5
START = "\x02"  # stands before the first characters of a text
PRIOR = 100
RUN = 6  # characters that the peak is the cost of
WEIGHT = 20
HOLD_OUT = 5
CHUNK = 1 << 18  # code points looked up at once


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Code point to code point: digits to 0, white space to blank, others to themselves."""
    out = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isspace():
            out[i] = 32
        elif c.isdecimal():
            out[i] = 48
    return out


_BEFORE = np.full(ORDER - 1, ord(START), np.uint32)


def _codes(text: str, before: np.ndarray = _BEFORE) -> np.ndarray:
    """Classes of the text's characters behind those ``before``; runs of blanks are one."""
    codes = _classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = np.concatenate([before[-1:], codes]) == 32
    return np.concatenate([before, codes[~(blank[1:] & blank[:-1])]])


def _keys(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each n-gram, never 0."""
    n = len(codes) - ORDER + 1
    out = np.zeros(n, np.uint64)
    multiplier = 0x9E3779B97F4A7C15
    for k in range(ORDER):
        out += codes[k : k + n].astype(np.uint64) * np.uint64(multiplier)
        multiplier = multiplier * 0xD1342543DE82EF95 % (1 << 64) | 1
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out | np.uint64(1)


class GramTable:
    """Numbers for n-gram hashes: open addressing in arrays, looked up many at a time."""

    def __init__(self, expected: int = 1 << 14):
        self._bits = max(10, int(expected * 4 - 1).bit_length())
        self._slots = np.zeros(1 << self._bits, np.uint64)
        self._numbers = np.zeros(1 << self._bits, np.int32)
        self.keys = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for unknown ones."""
        at = (keys >> np.uint64(64 - self._bits)).astype(np.int64)
        held = self._slots[at]
        out = np.where(held == keys, self._numbers[at], -1)
        rest = np.flatnonzero((held != keys) & (held != 0))
        mask = (1 << self._bits) - 1
        at = at[rest]
        while len(rest):
            at = (at + 1) & mask
            held = self._slots[at]
            hit = held == keys[rest]
            out[rest[hit]] = self._numbers[at[hit]]
            go = ~hit & (held != 0)
            rest, at = rest[go], at[go]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Number new, distinct keys."""
        first = len(self.keys)
        self.keys = np.concatenate([self.keys, keys])
        if 2 * len(self.keys) > 1 << self._bits:
            self._bits = int(len(self.keys) * 4 - 1).bit_length()
            self._slots = np.zeros(1 << self._bits, np.uint64)
            self._numbers = np.zeros(1 << self._bits, np.int32)
            first = 0
        rest = np.arange(first, len(self.keys))
        at = (self.keys[rest] >> np.uint64(64 - self._bits)).astype(np.int64)
        mask = (1 << self._bits) - 1
        while len(rest):
            free = self._slots[at] == 0
            self._numbers[at[free]] = rest[free]  # of several that want a slot the last one has it
            won = free.copy()
            won[free] = self._numbers[at[free]] == rest[free]
            self._slots[at[won]] = self.keys[rest[won]]
            rest, at = rest[~won], (at[~won] + 1) & mask


def _chunks(texts: Iterator[tuple[str, object]]) -> Iterator[tuple[np.ndarray, list]]:
    """Codes of several texts at once (a long one alone, in pieces), with (length, tag) of each."""
    held: list[np.ndarray] = []
    tags: list[tuple[int, object]] = []
    size = 0
    for text, tag in texts:
        before = _BEFORE
        for at in range(0, len(text), CHUNK):
            codes = _codes(text[at : at + CHUNK], before)
            before = codes[1 - ORDER :]
            held.append(codes)
            tags.append((len(codes), tag))
            size += len(codes)
            if size >= CHUNK:
                yield np.concatenate(held), tags
                held, tags, size = [], [], 0
    if held:
        yield np.concatenate(held), tags


def _starts(tags: list) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([n for n, _ in tags])])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, as they travel to their blocks twice."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = (t.as_py() for t in batch.column("text"))
        columns = {name: batch.column(name) for name in batch.schema.names if name != "text"}
        columns["packed"] = pa.array([t if t is None else pack(t.encode("utf-8")) for t in texts], pa.binary())
        yield pa.record_batch(columns)


def _texts(documents: pa.Table) -> Iterator[str]:
    unpack = zstandard.ZstdDecompressor().decompress
    for packed in documents.column("packed"):
        octets = packed.as_py()
        yield "" if octets is None else unpack(octets).decode("utf-8")


def _counted(documents: pa.Table, trusted: pa.Table) -> pa.Table:
    """(block, gram, n) of a block; n counts trusted documents only."""
    learn = set(trusted.column("doc").to_pylist())
    table = GramTable()
    counts, grams = np.zeros(0, np.int64), []
    texts = ((t, d in learn) for d, t in zip(documents.column("doc").to_pylist(), _texts(documents)))
    for codes, tags in _chunks((t, tag) for t, tag in texts if t):
        keys = _keys(codes)
        starts = _starts(tags)
        real = np.ones(len(keys), bool)  # n-grams that begin in one text and end in the next are none
        weight = np.zeros(len(codes), bool)
        for k, (n, learnt) in enumerate(tags):
            real[starts[k] + n - ORDER + 1 : starts[k + 1]] = False
            if learnt:
                weight[starts[k] : starts[k + 1]] = True
        numbers = table.find(keys)
        new = np.flatnonzero((numbers < 0) & real)
        if len(new):
            fresh, where = np.unique(keys[new], return_index=True)
            table.add(fresh)
            cut = codes[new[where][:, None] + np.arange(ORDER)]
            text = cut.astype("<u4").tobytes().decode("utf-32-le", "replace")
            grams.append(pa.array([text[ORDER * i : ORDER * i + ORDER] for i in range(len(fresh))], pa.string()))
            numbers = table.find(keys)
        counts = np.concatenate([counts, np.zeros(len(table) - len(counts), np.int64)])
        counts += np.bincount(numbers[real & weight[: len(keys)]], minlength=len(table))
    block = documents.column("block")[0].as_py() if documents.num_rows else 0
    return pa.table(
        {
            "block": pa.array([block] * len(table), pa.int32()),
            "gram": pa.chunked_array(grams, pa.string()),
            "n": pa.array(counts, pa.int64()),
        }
    )


def _block(doc: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(blocks)).cast("int")


def _held_out(doc: Column) -> Column:
    return F.crc32(doc.cast("string").cast("binary")) % HOLD_OUT == 0


def _dealt(documents: DataFrame, blocks: int) -> DataFrame:
    """(block, doc, text_hash, packed) from (doc, text)."""
    kind = documents.schema["doc"].dataType.simpleString()
    rows = documents.select(
        _block(F.col("doc"), blocks).alias("block"), "doc", F.xxhash64("text").alias("text_hash"), "text"
    )
    return rows.mapInArrow(_packed, f"block int, doc {kind}, text_hash long, packed binary")


def block_grams(documents: DataFrame, trusted: DataFrame, blocks: int) -> DataFrame:
    """(block, gram, n) from (doc, text) and the ids (doc) to learn from; texts are shuffled once."""
    right = trusted.select(_block(F.col("doc"), blocks).alias("block"), "doc")
    both = _dealt(documents, blocks).groupBy("block").cogroup(right.groupBy("block"))
    return both.applyInArrow(_counted, "block int, gram string, n long")


def _shorter(above: DataFrame, k: int) -> DataFrame:
    """(gram, n) of length k: the number of distinct characters that stand before it in the n-grams ``above``."""
    return above.groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n"))


def discounts(level: DataFrame) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more, from the counts of counts of one length."""
    ones = [F.sum((F.col("n") == c).cast("long")).alias(f"c{c}") for c in (1, 2, 3, 4)]
    c = [x or 0 for x in level.agg(*ones).first()]
    if min(c) == 0:
        return 0.5, 0.5, 0.5
    y = c[0] / (c[0] + 2 * c[1])
    given = (1 - 2 * y * c[1] / c[0], 2 - 3 * y * c[2] / c[1], 3 - 4 * y * c[3] / c[2])
    return tuple(min(max(d, 0.1), i - 0.1) for i, d in enumerate(given, 1))


def gram_costs(grams: DataFrame) -> DataFrame:
    """(gram, cost) for each distinct n-gram of ``block_grams``: -log of its interpolated probability.

    Lengths are done from 1 up, each for the distinct endings of that length
    only, and joined by n-gram, by context and by the ending one shorter.
    """
    shelf = Shelf(grams.sparkSession)
    counts = shelf.put(grams.groupBy("gram").agg(F.sum("n").alias("n")), "counts")
    levels = {ORDER: counts.where(F.col("n") > 0)}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = shelf.put(_shorter(levels[k + 1], k), f"level-{k}")
    n, lower = F.col("n"), None
    for k in range(1, ORDER + 1):
        level = levels[k]
        one, two, more = discounts(level)
        discount = F.when(n == 1, one).when(n == 2, two).otherwise(more)
        if k == ORDER:
            asked = counts.withColumn("_n", F.when(n > 0, n - discount)).drop("n")
        else:
            asked = counts.select(F.substring("gram", ORDER - k + 1, k).alias("gram")).distinct()
            asked = asked.join(level.select("gram", (n - discount).alias("_n")), "gram", "left")
        if k == 1:
            all_ = level.agg(F.count(F.lit(1)), F.sum("n"), F.sum(discount)).first()
            total = F.lit(float(all_[1] or 1))
            weight, shorter = F.lit((all_[2] or 1.0) / (all_[1] or 1)), F.lit(1.0 / (all_[0] + 1))
        else:
            contexts = level.groupBy(F.substring("gram", 1, k - 1).alias("_context"))
            contexts = contexts.agg(F.sum("n").alias("_total"), F.sum(discount).alias("_weight"))
            asked = asked.withColumn("_context", F.substring("gram", 1, k - 1)).join(contexts, "_context", "left")
            ending = lower.select(F.col("gram").alias("_ending"), F.col("p").alias("_shorter"))
            asked = asked.drop("_context").withColumn("_ending", F.substring("gram", 2, k - 1)).join(ending, "_ending")
            total, shorter = F.col("_total"), F.col("_shorter")
            weight = F.coalesce(F.col("_weight") / total, F.lit(1.0))
        p = F.coalesce(F.col("_n") / total, F.lit(0.0)) + weight * shorter
        lower = shelf.put(asked.select("gram", p.alias("p")), f"p-{k}")
        shelf.drop(f"p-{k - 1}")
    shelf.drop("counts", *(f"level-{k}" for k in range(1, ORDER)))
    return lower.select("gram", (-F.log("p")).cast("float").alias("cost"))


def _added_up(documents: pa.Table, costs: pa.Table) -> pa.Table:
    """(doc, text hash, chars, cost, peak) of each row of a block."""
    table, price = GramTable(max(costs.num_rows, 1)), costs.column("cost").to_numpy().astype(np.float64)
    keys = [_row_keys(_matrix(grams)) for grams in costs.column("gram").chunks if len(grams)]
    if keys:
        table.add(np.concatenate(keys))
    chars = np.zeros(documents.num_rows, np.int64)
    total, peak = np.zeros(documents.num_rows), np.zeros(documents.num_rows)
    last, tail = -1, np.zeros(0)  # the end of the piece before, for runs that cross into the next
    texts = ((t, i) for i, t in enumerate(_texts(documents)))
    for codes, tags in _chunks((t, i) for t, i in texts if t):
        starts = _starts(tags)
        numbers = table.find(_keys(codes))
        own = np.append(price[numbers], np.zeros(ORDER - 1))
        sums = np.add.reduceat(own, starts[:-1])
        for k, (n, i) in enumerate(tags):
            ghosts = own[starts[k] + n - ORDER + 1 : starts[k + 1]].sum()
            chars[i] += n - ORDER + 1
            total[i] += sums[k] - ghosts
            each = own[starts[k] : starts[k] + n - ORDER + 1]
            each = np.concatenate([tail, each]) if i == last else each
            peak[i] = max(peak[i], _peak(each))
            last, tail = i, each[max(len(each) - RUN + 1, 0) :]
    return pa.table(
        {
            "doc": documents.column("doc"),
            "text_hash": documents.column("text_hash"),
            "chars": pa.array(chars, pa.int64()),
            "cost": pa.array(total, pa.float64()),
            "peak": pa.array(peak, pa.float64()),
        }
    )


def _peak(costs: np.ndarray) -> float:
    """The highest sum of ``RUN`` neighbours; of fewer costs, of all."""
    sums = np.concatenate([[0.0], np.cumsum(costs)])
    return float((sums[RUN:] - sums[:-RUN]).max()) if len(costs) > RUN else float(sums[-1])


def _matrix(grams: pa.Array) -> np.ndarray:
    """Code points of n-grams, a row each."""
    return np.frombuffer("".join(grams.to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)


def _row_keys(codes: np.ndarray) -> np.ndarray:
    """Hashes of n-grams that are rows of a matrix."""
    return _keys(np.ascontiguousarray(codes).reshape(-1))[::ORDER]


def scored(documents: DataFrame, answers: DataFrame, blocks: int) -> DataFrame:
    """(doc, text_hash, chars, cost, peak) from (doc, text) and (block, gram, cost) for the n-grams each block reported."""
    both = _dealt(documents, blocks).groupBy("block").cogroup(answers.groupBy("block"))
    kind = documents.schema["doc"].dataType.simpleString()
    return both.applyInArrow(_added_up, f"doc {kind}, text_hash long, chars long, cost double, peak double")


def perplexities(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, text_hash, chars, cost, peak) per row, the model being learnt from the ids in ``trusted``."""
    blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    documents = df.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    learn = trusted.select(F.col(id_col).alias("doc")).where(~_held_out(F.col("doc"))).distinct()
    shelf = Shelf(df.sparkSession)
    grams = shelf.put(block_grams(documents, learn, blocks), "grams")
    costs = gram_costs(grams)
    answers = shelf.put(grams.select("block", "gram").join(costs, "gram").select("block", "gram", "cost"), "answers")
    shelf.drop("grams")
    found = stored(scored(documents, answers, blocks), "perplexities")
    shelf.drop("answers")
    return found


def classified(
    df: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quantile: float = 0.995,
    margin: float = 0.03,
) -> DataFrame:
    """(id, text_hash, lang, perplexity, threshold, peak, peak_limit, kept) for every row of ``df``."""
    costs = perplexities(df, trusted, id_col, text_col)
    keys = df.select(
        F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(lang_col).alias("lang")
    )
    # equal rows have equal costs, so one of them is enough to join
    once = costs.groupBy("doc", "text_hash").agg(*(F.first(c).alias(c) for c in ("chars", "cost", "peak")))
    same = F.col("k.doc").eqNullSafe(F.col("c.doc")) & (F.col("k.text_hash") == F.col("c.text_hash"))
    rows = keys.alias("k").join(once.alias("c"), same, "left").select("k.*", "c.chars", "c.cost", "c.peak")
    known = trusted.select(F.col(id_col).alias("doc")).distinct().withColumn("_known", F.lit(True))
    any_ = F.col("chars") > 0
    known_, held = F.coalesce("_known", F.lit(False)) & any_, F.coalesce(_held_out(F.col("doc")), F.lit(False))
    rows = rows.join(known, "doc", "left").withColumns({"_known": known_, "_held": known_ & held})
    rows = stored(rows, "document-costs")
    held, count = F.col("_held"), F.count_if("_held").alias("_n")

    def at(c: Column, share: float, name: str) -> Column:
        return F.percentile_approx(c, share, 10_000).alias(name)

    def weighed(own: Column, other: Column) -> Column:
        """``own`` as far as ``_n`` held-out documents say, else ``other``."""
        return F.when(F.col("_n") > 0, (F.col("_n") * own + WEIGHT * other) / (F.col("_n") + WEIGHT)).otherwise(other)

    # one row per language from here on; what all languages have together comes from the held-out documents
    own_rate = F.sum(F.when(held, F.col("cost"))) / F.sum(F.when(held, F.col("chars")))
    usual = at(F.when(any_, F.col("cost") / F.col("chars")), 0.5, "_usual")
    rates = rows.groupBy("lang").agg(own_rate.alias("_own"), usual, count)
    rates = rates.select(F.col("lang").alias("_lang"), weighed(F.col("_own"), F.col("_usual")).alias("rate"))
    rates = stored(rates, "language-rates")
    drawn = rows.join(rates, F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumn(
        "_drawn", (F.col("cost") + PRIOR * F.col("rate")) / (F.col("chars") + PRIOR)
    )
    drawn = stored(drawn.drop("_lang", "rate"), "drawn-costs")
    scores = ("_drawn", "peak")
    limits = drawn.groupBy(F.col("lang").alias("_lang")).agg(
        F.max("_known").alias("_known"), count,
        *(at(F.when(any_, F.col(c)), 0.5, f"_mid{c}") for c in scores),
        *(at(F.when(held, F.col(c)), quantile, f"_top{c}") for c in scores),
    )
    limits = stored(limits.where("_known").drop("_known"), "language-limits")
    ratios = drawn.where(held).join(limits, F.col("lang").eqNullSafe(F.col("_lang")))
    ratios = ratios.agg(*(at(F.col(c) / F.col(f"_mid{c}"), quantile, c) for c in scores)).first()
    if ratios["_drawn"] is None:  # nothing was held out
        limits = limits.where("false")
    drawn = drawn.join(
        limits.select(
            "_lang",
            *(
                (weighed(F.col(f"_top{c}"), F.col(f"_mid{c}") * F.lit(ratios[c])) * (1 + margin)).alias(f"_limit{c}")
                for c in scores
            ),
        ),
        F.col("lang").eqNullSafe(F.col("_lang")),
        "left",
    )
    within = (F.col("_drawn") <= F.col("_limit_drawn")) & (F.col("peak") <= F.col("_limitpeak"))
    return drawn.select(
        F.col("doc").alias(id_col),
        "text_hash",
        "lang",
        F.exp("_drawn").alias("perplexity"),
        F.exp("_limit_drawn").alias("threshold"),
        "peak",
        F.col("_limitpeak").alias("peak_limit"),
        F.coalesce(within, F.lit(True)).alias("kept"),
    )


def keep_good(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Rows of ``df`` that the classifier keeps, all columns."""
    bad = classified(df, trusted, id_col, text_col, **how).where(~F.col("kept"))
    bad = bad.select(F.col(id_col).alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("_doc")) & (F.xxhash64(F.col(text_col)) == F.col("_hash"))
    return df.join(bad, same, "left_anti")
