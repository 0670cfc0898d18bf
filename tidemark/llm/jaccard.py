"""Documents as sets of word shingles: measures, classes of equal sets, exact similarities."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shingles import batched, mixed, shingle_sets
from tidemark.scratch import Shelf, stored

BITMAP = 32768  # bits of a part of the filter, as ``bitmap_construct_agg`` has them
BITS_EACH = 16
MOST_BITS = 1 << 27
PROBES = 4
WORD = r"[^\x20\x09-\x0D]"  # a character of a word, as ``shingle_sets`` has it


@dataclass(frozen=True)
class Measure:
    """Shingles of ``words`` words; a link from a similarity of ``num`` / ``den`` on."""

    words: int = 5
    num: int = 4
    den: int = 5

    def links(self, inter: Column, union: Column) -> Column:
        return self.den * inter >= self.num * union


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, text_hash, text): ``doc`` is the id, null where there is none; a row is known by both first columns."""
    text = F.col(text_col)
    return df.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def set_hashes(shingles: np.ndarray) -> tuple[int, int]:
    """Two sums that stand for a set."""
    again = mixed(shingles + np.uint64(0x632BE59BD9B4E019))
    return tuple(int(x.sum().view(np.int64)) for x in (shingles, again))


def each_set(words: int, batch: pa.RecordBatch, *names: str) -> Iterator[tuple[tuple, np.ndarray]]:
    """(values of ``names``, shingles) of the rows of a batch with a column ``text``."""
    tags = zip(*(batch.column(c).to_pylist() for c in names))
    for some, held in batched(zip(tags, (t.as_py() for t in batch.column("text")))):
        yield from zip(some, shingle_sets(held, words))


def class_of() -> Column:
    """The number of a class of equal sets, from their size and sums."""
    return F.xxhash64("n", "h1", "h2")


def representatives(rows: DataFrame) -> DataFrame:
    """(class, n, h1, h2, doc, text_hash): one row of each class that has words."""
    first = F.min(F.struct("doc", "text_hash")).alias("first")
    classes = rows.where("n > 0").groupBy(class_of().alias("class"), "n", "h1", "h2").agg(first)
    return classes.select("class", "n", "h1", "h2", "first.*")


def _sets(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sets = [], []
        for (doc, h1, h2), shingles in each_set(words, batch, "class", "h1", "h2"):
            if set_hashes(shingles) == (h1, h2):
                ids.append(doc)
                sets.append(shingles.view(np.int64))
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        values = np.concatenate([*sets, np.zeros(0, np.int64)])
        yield pa.record_batch(
            {
                "doc": pa.array(ids, pa.int64()),
                "n": pa.array(np.diff(offsets), pa.int64()),
                "shingles": pa.ListArray.from_arrays(offsets, pa.array(values, pa.int64())),
            }
        )


def _places(key: Column, bits: int) -> Column:
    """The bits of a filter that stand for a key, as ``_passing`` finds them."""
    low, high = key.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(key, 32).bitwiseOR(1)
    return F.array(*((low + i * high) % bits for i in range(PROBES)))


def row_filter(rows: DataFrame) -> np.ndarray:
    """A Bloom filter of the rows (doc, text_hash), whose size follows their number up to ``MOST_BITS``."""
    bits = BITMAP
    while bits < min(MOST_BITS, BITS_EACH * rows.count()):
        bits *= 2
    places = rows.select(F.explode(_places(F.xxhash64("doc", "text_hash"), bits)).alias("_place"))
    places = places.select(F.expr(f"_place DIV {BITMAP}").alias("_part"), (F.col("_place") % BITMAP).alias("_bit"))
    # places are dealt by their part first: tasks would else send a bitmap of each part
    maps = places.repartition("_part").groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    out = np.zeros(bits // 8, np.uint8)
    for row in maps.collect():
        out[row["_part"] * (BITMAP // 8) :][: BITMAP // 8] = np.frombuffer(row["_map"], np.uint8)
    return out


def _passing(bitmap: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose key the filter may hold, without the key."""
    for batch in batches:
        keys = batch.column("key").to_numpy().view(np.uint64)
        low, high = keys & np.uint64(0xFFFFFFFF), keys >> np.uint64(32) | np.uint64(1)
        there = np.ones(len(keys), bool)
        for i in range(PROBES):
            place = (low + np.uint64(i) * high) % np.uint64(8 * len(bitmap))
            there &= (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
        yield batch.filter(pa.array(there)).select(["doc", "text_hash", "text"])


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(doc, n, shingles), ``doc`` being the class, for classes of (class, h1, h2, doc, text_hash).

    Of the texts only those that pass a Bloom filter of the wanted rows are shuffled to meet them.
    """
    keyed = docs.withColumn("key", F.xxhash64("doc", "text_hash"))
    schema = "doc long, text_hash long, text string"
    shelf = Shelf(docs.sparkSession)
    # put down, as a task that filters and makes sets as well would hold two Python processes
    passing = shelf.put(keyed.mapInArrow(partial(_passing, row_filter(wanted)), schema), "passing")
    d, w = passing.alias("d"), wanted.select("class", "h1", "h2", "doc", "text_hash").alias("w")
    same = F.col("d.doc").eqNullSafe(F.col("w.doc")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    asked = d.join(w, same).select("class", "h1", "h2", "text")
    schema = "doc long, n long, shingles array<long>"
    sets = stored(asked.mapInArrow(partial(_sets, words), schema), "shingle-sets")
    shelf.drop("passing")
    total = sets.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc").alias("d")).first()
    # rows that repeat give their set more than once
    return stored(sets.dropDuplicates(["doc"]), "shingle-sets") if total["n"] > total["d"] else sets


def own_counts(sets: DataFrame) -> DataFrame:
    """(doc, own): how many shingles of a set are in no other of the sets; sets without such shingles have no row."""
    each = sets.select("doc", F.explode("shingles").alias("_shingle"))
    met = each.groupBy("_shingle").agg(F.count(F.lit(1)).alias("_c"), F.min("doc").alias("doc"))
    return met.where("_c = 1").groupBy("doc").agg(F.count(F.lit(1)).alias("own"))


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, inter, union) of pairs of classes."""
    left = sets.select(F.col("doc").alias("a"), F.col("n").alias("_na"), F.col("shingles").alias("_sa"))
    right = sets.select(F.col("doc").alias("b"), F.col("n").alias("_nb"), F.col("shingles").alias("_sb"))
    joined = pairs.join(left, "a").join(right, "b")
    inter = F.size(F.array_intersect("_sa", "_sb")).cast("long")
    return joined.select("a", "b", inter.alias("inter"), (F.col("_na") + F.col("_nb") - inter).alias("union"))


def distinct_regions(members: DataFrame) -> DataFrame:
    """(region, doc) of regions with two members at least, one region for all with the same members."""
    key = F.xxhash64("doc").cast("decimal(38,0)")
    alike = members.groupBy("region").agg(
        F.count(F.lit(1)).alias("_c"), F.sum(key).alias("_s"), F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("_x")
    )
    alike = alike.where("_c > 1").groupBy("_c", "_s", "_x").agg(F.min("region").alias("region")).select("region")
    return members.join(alike, "region")


def named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc, text_hash, class, n, component, group) from rows with n, h1, h2 and (node, component) of linked classes.

    ``component`` is the smallest id of the documents that links lead to, and
    the own id without words. Components may share such a name where ids
    repeat; ``group``, a class of the component, tells them apart (null for
    rows without words).
    """
    about = rows.select("doc", "text_hash", "n", F.when(F.col("n") > 0, class_of()).alias("class"))
    classes = about.where("n > 0").groupBy("class").agg(F.min("doc").alias("_rep"))
    grouped = classes.join(labels, F.col("class") == F.col("node"), "left")
    grouped = grouped.select("class", "_rep", F.coalesce("component", "class").alias("group"))
    least = grouped.groupBy("group").agg(F.min("_rep").alias("_least"))
    told = grouped.join(least, "group").select("class", "_least", "group")
    out = about.join(told, "class", "left")
    component = F.when(F.col("n") > 0, F.col("_least")).otherwise(F.col("doc"))
    return out.select("doc", "text_hash", "class", "n", component.alias("component"), "group")
