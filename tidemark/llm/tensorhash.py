"""MinHash near-duplicates with tensored bands.

A band table wants keys of many minhashes so that unlike documents do not meet,
and many tables so that like ones do. Instead of computing minhashes for every
table, two collections of ``size`` partial keys of ``rows`` minhashes each are
made, and every pair of a key of one and a key of the other is the key of a table:
``size`` ** 2 tables of 2 ``rows`` minhashes from 2 ``size`` ``rows`` minhashes.
Documents of similarity s meet in a table unless one collection has no key in
common, so a link is missed with a probability of about 2 (1 - s ** rows) ** size: 7 in a
million at s = 0.8 with the sizes given, and less the more alike they are.

Pairs of partial keys are only formed where both occur in another document, which
is necessary for a table key to occur there. Tables' buckets are candidates only:
links are confirmed on whole sets, each bucket starting from one member, without
forming all pairs of a bucket (``metricjoin.linked``). There is no cap on buckets.
The shingles that no other candidate has are counted, as they tell how far
documents are apart at least: pairs that cannot link by that are not compared.

Defined cases, as for the Jaccard join: documents without words link with nothing and
are their own component; fewer words than a shingle has make one shingle; rows
without an id take part and never name a component that has other rows; ids are
integers; rows with equal ids are rows of their own; equal sets are one class; an
empty table gives an empty result; extra columns, whatever their names, are ignored
by ``near_duplicates`` and kept by ``keep_one``. Sets are known by 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.jaccard import (
    Measure,
    class_of,
    distinct_regions,
    each_set,
    named,
    own_counts,
    set_hashes,
    sets_of,
    texts,
)
from tidemark.llm.metricjoin import linked, one_of_each
from tidemark.llm.shingles import mixed
from tidemark.scratch import stored

_BLOCK = 2048  # shingles hashed at a time


@dataclass(frozen=True)
class Tensor:
    """Two collections of ``size`` partial keys, each of ``rows`` minhashes."""

    rows: int = 4
    size: int = 24
    seed: int = 42

    def functions(self) -> tuple[np.ndarray, np.ndarray]:
        """Factors and summands of the hash functions."""
        random = np.random.default_rng(self.seed)
        count = 2 * self.size * self.rows
        return random.integers(0, 1 << 31, count, np.uint32) * 2 + 1, random.integers(0, 1 << 32, count, np.uint32)


def partial_keys(shingles: np.ndarray, tensor: Tensor, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The keys of both collections, one after the other, from the distinct shingles of a document."""
    factors, summands = functions
    numbers = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(numbers), _BLOCK):
        np.minimum(least, (numbers[k : k + _BLOCK, None] * factors + summands).min(axis=0), out=least)
    bands = least.reshape(2 * tensor.size, tensor.rows).astype(np.uint64)
    keys = np.arange(1, 2 * tensor.size + 1, dtype=np.uint64)
    for k in range(tensor.rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, k])
    return keys


def _sketched(words: int, tensor: Tensor, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    functions = tensor.functions()
    none = np.zeros(0, np.int64)
    for batch in batches:
        about, keys = [], []
        for (doc, text_hash), shingles in each_set(words, batch, "doc", "text_hash"):
            about.append((doc, text_hash, len(shingles), *set_hashes(shingles)))
            keys.append(partial_keys(shingles, tensor, functions).view(np.int64) if len(shingles) else none)
        names = ("doc", "text_hash", "n", "h1", "h2")
        columns = {c: pa.array([row[k] for row in about], pa.int64()) for k, c in enumerate(names)}
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
        values = pa.array(np.concatenate([*keys, none]), pa.int64())
        yield pa.record_batch(columns | {"keys": pa.ListArray.from_arrays(offsets, values)})


def buckets(classes: DataFrame, tensor: Tensor) -> DataFrame:
    """(region, doc, n): classes by the keys of the tables, in which another class has that key."""
    each = classes.select(F.col("class").alias("doc"), "n", F.posexplode("keys").alias("place", "key"))
    common = each.groupBy("key").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("key")
    first = F.col("place") < tensor.size
    halves = each.join(common, "key").groupBy("doc", "n").agg(
        F.collect_list(F.when(first, F.col("key"))).alias("_a"), F.collect_list(F.when(~first, F.col("key"))).alias("_b")
    )
    tables = halves.select("doc", "n", F.explode("_a").alias("_a"), "_b").select("doc", "n", "_a", F.explode("_b").alias("_b"))
    keyed = stored(tables.select(F.xxhash64("_a", "_b").alias("region"), "doc", "n"), "buckets")
    return stored(distinct_regions(keyed), "buckets")


def near_duplicates(
    df: DataFrame, measure: Measure, tensor: Tensor = Tensor(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc, text_hash, class, n, component, group) for every row of ``df``, see ``jaccard.named``."""
    docs = texts(df, id_col, text_col)
    schema = "doc long, text_hash long, n long, h1 long, h2 long, keys array<long>"
    rows = stored(docs.mapInArrow(partial(_sketched, measure.words, tensor), schema), "minhashes")
    some = rows.where("n > 0").groupBy(class_of().alias("class"), "n", "h1", "h2")
    classes = some.agg(F.min(F.struct("doc", "text_hash")).alias("first"), F.first("keys").alias("keys"))
    classes = stored(classes.select("class", "n", "h1", "h2", "first.*", "keys"), "classes")
    members = buckets(classes, tensor)
    wanted = classes.drop("keys").join(members.select(F.col("doc").alias("class")).distinct(), "class")
    sets = sets_of(docs, stored(wanted, "candidates"), measure.words)
    members = members.join(own_counts(sets), "doc", "left").withColumn("own", F.coalesce("own", F.lit(0).cast("long")))
    members = stored(members.select("region", "doc", "n", "own"), "members")
    return named(rows.drop("keys"), linked(members, sets, measure))


def keep_one(
    df: DataFrame, measure: Measure, tensor: Tensor = Tensor(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of ``df`` with one document of each component, that with the smallest id; rows without words all stay."""
    return one_of_each(df, near_duplicates(df, measure, tensor, id_col, text_col), id_col, text_col)
