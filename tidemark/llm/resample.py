"""Importance resampling towards a target distribution of hashed n-grams.

Texts are bags of hashed runs of one to ``longest`` words. Every bucket has a
gain, the logarithm of its frequency in the target texts over that in the
documents; a document's weight is the sum of the gains of its features, read
from one array. Adding Gumbel noise to the weights and taking the highest
scores draws without replacement with probabilities that follow the weights.

The cutoff is found without sorting the scores. A quantile sketch names a
bracket of scores that should hold it. Exact counts above and inside validate
the bracket, or widen it where the sketch missed; only the rows inside are
sorted, and the row at the missing place is the cutoff.

Both passes over the texts run in Arrow batches that keep the counts of a task
in one array. What reaches the driver is bounded by ``buckets``.

Defined cases: a null text or one without words has no features and weight 0;
documents with fewer than ``least_words`` words are scored and never drawn; a
row without an id draws its noise by the hash of its text, so rows without an id
and with equal texts tie; ties go to smaller ids, null last, then to smaller text
hashes, and equal rows in any order; an empty table gives an empty result; no
target text gives every bucket the same small target frequency. Texts of any
length are read in pieces. Ids are integers. Extra columns, whatever their names,
are ignored by ``scored`` and kept by ``resampled``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ordering import placed
from tidemark.scratch import stored

#: Bytes that are not part of a word, after A-Z have become lower case: ASCII other than a-z and 0-9.
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PIECE = 1 << 20


@dataclass(frozen=True)
class Features:
    """Runs of one to ``longest`` words in ``buckets`` buckets."""

    longest: int = 3
    buckets: int = 10_000


@dataclass(frozen=True)
class Model:
    """Gains in thousandths per bucket."""

    features: Features
    gains: tuple[int, ...]


def _pieces(text: bytes | None) -> Iterator[bytes]:
    """A text in lower case, cut between words after about a megabyte."""
    octets = (text or b"").translate(_LOWER)
    at = 0
    while at < len(octets):
        cut = _BETWEEN.search(octets, at + _PIECE)
        end = cut.end() if cut else len(octets)
        yield octets[at:end]
        at = end


def feature_buckets(text: bytes | None, features: Features) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of all runs that end in it) per piece of a text in UTF-8.

    The checksum of a run continues that of the run without its last word, so
    a piece starts from the checksums of the runs that the last one ended with.
    """
    open_: list[list[int]] = [[] for _ in range(features.longest - 1)]
    for piece in _pieces(text):
        words = [w for w in _BETWEEN.split(piece) if w]
        if not words:
            continue
        spaced = [b" " + w for w in words]
        sums = list(map(crc32, words))
        found = [sums]
        for k in range(features.longest - 1):
            begun = open_[k] + sums
            open_[k] = begun[-1:]
            sums = list(map(crc32, spaced[len(spaced) - len(begun) + 1 :], begun))
            found.append(sums)
        every = np.concatenate([np.fromiter(run, np.uint32, len(run)) for run in found])
        yield len(words), (every % np.uint32(features.buckets)).astype(np.int64)


def _counted(features: Features, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of a task by bucket, as one row per bucket that occurs."""
    sums = np.zeros(features.buckets, np.int64)
    for batch in batches:
        for text in batch.column(0):
            for _, buckets in feature_buckets(text.as_py(), features):
                sums += np.bincount(buckets, minlength=features.buckets)
    some = np.flatnonzero(sums)
    yield pa.record_batch({"bucket": pa.array(some, pa.int32()), "n": pa.array(sums[some], pa.int64())})


def bucket_counts(texts: DataFrame, text_col: str, features: Features) -> list[int]:
    """How often each bucket occurs in all texts; as long as there are buckets, whatever the input."""
    rows = texts.select(F.col(text_col).cast("binary")).mapInArrow(partial(_counted, features), "bucket int, n long")
    sums = [0] * features.buckets
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        sums[row.bucket] = row.n
    return sums


def fit(docs: DataFrame, target: DataFrame, text_col: str = "text", features: Features = Features()) -> Model:
    """Gains of ``target`` over ``docs``, both counted whole, with one added to each bucket."""
    own, wanted = (bucket_counts(df, text_col, features) for df in (docs, target))
    of_own, of_wanted = float(sum(own) + features.buckets), float(sum(wanted) + features.buckets)
    gains = (
        math.floor(1000 * math.log((t + 1.0) * of_own / ((s + 1.0) * of_wanted))) for s, t in zip(own, wanted)
    )
    return Model(features, tuple(gains))


def _weighed(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gains = np.array(model.gains, np.int64)
    for batch in batches:
        found = []
        for text in batch.column("text"):
            n_words = n_features = weight = 0
            for words, buckets in feature_buckets(text.as_py(), model.features):
                n_words += words
                n_features += len(buckets)
                weight += int(gains[buckets].sum())
            found.append((n_words, n_features, weight))
        columns = np.array(found, np.int64).reshape(-1, 3)
        numbers = {c: pa.array(columns[:, k], pa.int64()) for k, c in enumerate(("n_words", "n_features", "weight"))}
        ids = {c: batch.column(c) for c in ("doc_id", "text_hash", "noise")}
        yield pa.record_batch(ids | numbers)


def scored(docs: DataFrame, model: Model, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight, score) of every row of ``docs``.

    ``score`` is the weight with Gumbel noise in thousandths, drawn from the
    seed and the id.
    """
    own = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit(":"), F.sha2(F.coalesce(text_col, F.lit("")), 256)))
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), own), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        noise.alias("noise"),
        F.col(text_col).cast("binary").alias("text"),
    )
    schema = "doc_id long, text_hash long, noise long, n_words long, n_features long, weight long"
    weighed = rows.mapInArrow(partial(_weighed, model), schema)
    return weighed.withColumn("score", F.col("weight") + F.col("noise")).drop("noise")


#: Scores from high to low, ties by id.
ORDER = (F.desc, "score"), (F.asc_nulls_last, "doc_id"), (F.asc, "text_hash")


def _order() -> list:
    return [how(column) for how, column in ORDER]


def bracket(scores: DataFrame, wanted: int, total: int, error: float = 1e-3) -> tuple[int, int, int]:
    """(low, high, above): the row at place ``wanted`` has a score in [low, high], and ``above`` rows have a higher one.

    The sketch errs by ``error`` of the rows on each side. Counts that show
    that it erred by more make the bracket wider; in the end it holds all scores.
    """
    while True:
        at = 1 - wanted / total
        edges = [max(at - 2 * error, 0.0), min(at + 2 * error, 1.0)]
        low, high = scores.agg(F.percentile_approx("score", edges, F.lit(int(1 / error))).alias("e")).first()["e"]
        if error >= 0.5:
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        counts = scores.agg(
            F.count_if(F.col("score") > high).alias("above"),
            F.count_if(F.col("score").between(low, high)).alias("inside"),
        ).first()
        if counts.above < wanted <= counts.above + counts.inside:
            return low, high, counts.above
        error *= 8


def drawn(scores: DataFrame, percent: int, least_words: int = 20, error: float = 1e-3) -> DataFrame:
    """``scores`` with ``rank``: 1, 2, 3... for the highest ``percent`` of the rows with enough words, else null.

    ``scores`` is read several times; store it first. Only drawn rows are
    ranked, in ranges of their scores.
    """
    eligible = scores.where(F.col("n_words") >= least_words)
    total = eligible.count()
    wanted = percent * total // 100
    undrawn = F.lit(None).cast("long")
    if not wanted:
        return scores.withColumn("rank", undrawn)
    low, high, above = bracket(eligible.select("score"), wanted, total, error)
    inside = eligible.where(F.col("score").between(low, high)).select("score", "doc_id", "text_hash")
    inside = placed(inside, _order(), _order(), "place", "bracket")
    last = inside.where(F.col("place") == wanted - above).first()
    # ranges go by the whole order, so rows equal to the last one in all of it are told apart by their place only
    after_id = F.coalesce(F.col("doc_id") > last.doc_id, F.lit(last.doc_id is not None))
    same_id = F.col("doc_id").eqNullSafe(F.lit(last.doc_id))
    tied = F.col("score") == last.score
    beyond = (F.col("score") < last.score) | (
        tied & ((~same_id & after_id) | (same_id & (F.col("text_hash") > last.text_hash)))
    )
    chosen = F.coalesce((F.col("n_words") >= least_words) & ~beyond, F.lit(False))
    ranked = placed(scores.where(chosen), _order(), _order(), "rank", "drawn")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return scores.where(~chosen).withColumn("rank", undrawn).unionByName(ranked)


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns."""
    model = fit(docs, target, text_col)
    scores = stored(scored(docs, model, seed, id_col, text_col), "scores")
    ranks = stored(drawn(scores, percent).select("doc_id", "text_hash", "rank"), "ranks")
    key = [F.col("doc_id"), F.col("text_hash")]
    own = [F.col(id_col).cast("long"), F.xxhash64(text_col)]
    taken = ranks.where("rank is not null")
    last = taken.orderBy(F.desc("rank")).first()
    if last is None:
        return docs.limit(0)
    # equal rows are drawn apart only where the cutoff falls between them
    cut = lambda columns: columns[0].eqNullSafe(F.lit(last.doc_id)) & (columns[1] == last.text_hash)
    whole = taken.where(~cut(key)).select(key[0].alias("_id"), key[1].alias("_hash")).distinct().alias("t")
    d = docs.alias("d")
    same = F.col(f"d.{id_col}").cast("long").eqNullSafe(F.col("t._id")) & (
        F.xxhash64(F.col(f"d.{text_col}")) == F.col("t._hash")
    )
    return d.join(whole, same, "left_semi").union(docs.where(cut(own)).limit(taken.where(cut(key)).count()))
