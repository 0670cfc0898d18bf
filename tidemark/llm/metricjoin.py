"""Exact n-gram Jaccard join in the metric space of shingle sets.

Two documents link when the Jaccard distance of their sets of word shingles is
at most ``r`` = 1 - similarity. The join never forms all pairs of a group:

1. ``sketched``: documents are measured in tasks that exchange only shingle
   hashes. A document of whose shingles more than the share ``r`` occur in no
   other document has no partner and is done. Equal sets become one class.
2. ``regions``: the remaining classes are laid out by single shingles, those first
   that are rare in a frequency sketch of fixed size; to share a region is necessary
   for a link, whatever the order, and a document enters as many regions as the
   triangle inequality of the symmetric difference asks for (its first
   n - ceil(t n) + 1 shingles; no others are exploded). Regions with equal members are one.
3. ``linked``: every region elects a pivot and the distances of its members to
   it are computed. Members linked to the pivot are its cell; they are connected
   and need no comparison with each other. Only what the triangle inequality
   cannot settle goes on to the next level: members outside the cell, and
   boundary members of the cell within whose window a document outside may lie.
   Levels repeat with new pivots, sixteen times as many each, until no region has
   anything open. Pivots meet all open members of their region, so nothing is
   lost.

Distances are exact (integers compared with the threshold); bounds only ever
skip pairs that cannot link. ``components`` then joins the links.

Defined cases: documents without words have an empty set, link with nothing and
are their own component; fewer words than a shingle has make one shingle; rows
without an id take part and never name a component that has other rows; ids are
integers of 64 bits, all of them; rows with equal ids are rows of their own; equal
texts are one class however many they are; an empty table gives an empty result;
extra columns, whatever their names, are ignored by ``joined`` and kept by ``keep_one``.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm.components import components
from tidemark.llm.jaccard import (
    WORD,
    Measure,
    class_of,
    distinct_regions,
    each_set,
    named,
    representatives,
    set_hashes,
    sets_of,
    similarities,
    texts,
)
from tidemark.scratch import Shelf, stored

CHUNK_SHINGLES = 1 << 21
COUNTER_BITS = 24  # of the frequency sketch
SLICE = 1 << 20
PART_BYTES = 1 << 26  # of text whose shingles meet in a part of the hash space
_PART = pa.schema(
    [("part", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary()), ("sizes", pa.binary()),
     ("shared", pa.binary()), ("about", pa.binary())]
)
_ABOUT = np.dtype([(name, "<i8") for name in ("doc", "has_id", "text_hash", "n", "h1", "h2", "known")])
_SENT = "part int, chunk long, hashes binary, docs binary, sizes binary, shared binary, about binary"
_ANSWERED = "chunk long, docs binary, counts binary, about binary"
_TOLD = "doc long, text_hash long, n long, h1 long, h2 long, shared long"


def _exchanged(words: int, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk of documents and part of the hash space: 32 bits of each shingle, by document.

    Shingles that two documents of the chunk have are known to be shared; they
    are announced once, without documents.
    """
    about: list[tuple] = []
    sets: list[np.ndarray] = []
    seen: dict[tuple, int] = {}

    def flush() -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate([*sets, np.zeros(0, np.uint64)])
        docs = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])[: len(ranked)]
        run = np.cumsum(fresh) - 1
        double = np.bincount(run, minlength=1)[run] > 1 if len(ranked) else np.zeros(0, bool)
        known = np.zeros(len(every), bool)
        known[order] = double
        rows = np.array(about, dtype=_ABOUT)
        own = np.bincount(docs[known], minlength=len(sets))
        rows["known"] = [own[seen_at] if seen_at >= 0 else 0 for seen_at in rows["known"]]
        told = ranked[double & fresh]
        single, owners = every[~known], docs[~known]
        place = ((single >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(place, kind="stable")  # documents stay in order within a part
        single, owners = single[order].astype("<u4"), owners[order]
        cuts = np.searchsorted(place[order], np.arange(parts + 1))
        told_place = ((told >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(told_place, kind="stable")
        told = told[order].astype("<u4")
        told_cuts = np.searchsorted(told_place[order], np.arange(parts + 1))
        ids = np.array(places, "<i8")
        columns: dict[str, list] = {name: [] for name in _PART.names}
        for p in range(parts):
            inside = owners[cuts[p] : cuts[p + 1]]
            present, counts = np.unique(inside, return_counts=True)
            columns["part"].append(p)
            columns["chunk"].append(chunk)
            columns["hashes"].append(single[cuts[p] : cuts[p + 1]].tobytes())
            columns["docs"].append(ids[present].tobytes())
            columns["sizes"].append(counts.astype("<u4").tobytes())
            columns["shared"].append(told[told_cuts[p] : told_cuts[p + 1]].tobytes())
            columns["about"].append(rows.tobytes() if p == chunk % parts else b"")
        return pa.record_batch(columns, schema=_PART)

    places: list[int] = []  # of the documents that tell the sets, in the chunk
    size, chunk = 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        for (doc, text_hash), shingles in each_set(words, batch, "doc", "text_hash"):
            h1, h2 = set_hashes(shingles)
            key = (len(shingles), h1, h2)
            if len(shingles) and key not in seen:
                seen[key] = len(sets)
                sets.append(shingles)
                places.append(len(about))
                size += len(shingles)
                at = seen[key]
            else:
                at = -1  # its set is told by another document of the chunk
            about.append((doc or 0, doc is not None, text_hash, len(shingles), h1, h2, at))
            if size >= CHUNK_SHINGLES:
                yield flush()
                about, sets, seen, places, size = [], [], {}, [], 0
                chunk += 1
    if about:
        yield flush()


def _met(table: pa.Table) -> pa.Table:
    """One part of the hash space: of each chunk, which documents' shingles others have too, and how many."""
    read = lambda name, kind: [np.frombuffer(x.as_py(), kind) for x in table.column(name)]
    hashes, ids, sizes = read("hashes", "<u4"), read("docs", "<i8"), read("sizes", "<u4")
    told = np.concatenate(read("shared", "<u4"))
    both = np.concatenate([*hashes, told, told])  # a shared shingle counts as two
    order = np.argsort(both, kind="stable")
    ranked = both[order]
    again = np.zeros(len(both), bool)
    if len(both) > 1:
        same = ranked[1:] == ranked[:-1]
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
    docs, counts, at = [], [], 0
    for h, i, n in zip(hashes, ids, sizes):
        begins = np.cumsum(n, dtype=np.int64) - n
        own = np.add.reduceat(again[at : at + len(h)].astype(np.int64), begins) if len(n) else n
        docs.append(i[own > 0].tobytes())
        counts.append(own[own > 0].astype("<u4").tobytes())
        at += len(h)
    return pa.table(
        {
            "chunk": table.column("chunk"),
            "docs": pa.array(docs, pa.binary()),
            "counts": pa.array(counts, pa.binary()),
            "about": table.column("about"),
        }
    )


def _told(table: pa.Table) -> pa.Table:
    """The documents of one chunk with the answers of all parts added up."""
    read = lambda name, kind: np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])
    about = read("about", _ABOUT)
    sums = np.bincount(read("docs", "<i8"), read("counts", "<u4"), len(about)).astype(np.int64)
    columns = {name: pa.array(about[name], pa.int64()) for name in ("text_hash", "n", "h1", "h2")}
    ids = pa.array(about["doc"], pa.int64(), mask=about["has_id"] == 0)
    return pa.table({"doc": ids} | columns | {"shared": pa.array(about["known"] + sums, pa.int64())})


def sketched(docs: DataFrame, measure: Measure) -> DataFrame:
    """(doc, text_hash, n, h1, h2, shared) of each row of (doc, text_hash, text).

    Questions and answers travel as packed arrays, one per chunk of documents
    and part of the hash space.
    """
    bytes_in = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), bytes_in // PART_BYTES)
    sent = docs.mapInArrow(partial(_exchanged, measure.words, parts), _SENT)
    answers = sent.groupBy("part").applyInArrow(_met, _ANSWERED)
    return answers.groupBy("chunk").applyInArrow(_told, _TOLD)


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The frequency sketch of a task's sets, in slices."""
    counters = np.zeros(1 << COUNTER_BITS, np.uint8)
    for batch in batches:
        column = batch.column("shingles")
        for k in range(batch.num_rows):
            own = _counter(column[k].values.to_numpy(zero_copy_only=False).view(np.uint64))
            counters[own] = np.minimum(counters[own], 254) + 1
    for k in range(0, len(counters), SLICE):
        part = counters[k : k + SLICE]
        if part.any():
            yield pa.record_batch({"slice": pa.array([k // SLICE], pa.int32()), "counts": pa.array([zlib.compress(part, 1)], pa.binary())})


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the slices of a task; counts stop at the largest byte."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, counts in zip(batch.column("slice").to_pylist(), batch.column("counts")):
            own = np.frombuffer(zlib.decompress(counts.as_py()), np.uint8)
            sums[k] = np.minimum(sums[k].astype(np.uint16) + own, 255).astype(np.uint8) if k in sums else own
    for k, total in sums.items():
        yield pa.record_batch({"slice": pa.array([k], pa.int32()), "counts": pa.array([zlib.compress(total, 1)], pa.binary())})


def frequencies(sets: DataFrame) -> np.ndarray:
    """How many of the sets have a shingle of each range of hashes, a byte each: 16 megabytes, whatever the input.

    The slices of the tasks are added up in two steps.
    """
    schema = "slice int, counts binary"
    slices = sets.select("shingles").mapInArrow(_counted, schema).withColumn("bin", F.xxhash64("counts") % 64)
    bins = slices.repartition("slice", "bin").select("slice", "counts").mapInArrow(_added, schema)
    sketch = np.zeros(1 << COUNTER_BITS, np.uint8)
    for row in bins.repartition("slice").mapInArrow(_added, schema).collect():
        sketch[row["slice"] * SLICE :][:SLICE] = np.frombuffer(zlib.decompress(row["counts"]), np.uint8)
    return sketch


def _first(measure: Measure, sketch: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first shingles of each set, those that are rare by the sketch before others."""
    for batch in batches:
        column, firsts = batch.column("shingles"), []
        for k in range(batch.num_rows):
            shingles = column[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
            room = len(shingles) - -(-len(shingles) * measure.num // measure.den) + 1
            firsts.append(shingles[np.lexsort((shingles, sketch[_counter(shingles)]))[:room]].view(np.int64))
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32)
        values = pa.array(np.concatenate([*firsts, np.zeros(0, np.int64)]), pa.int64())
        yield pa.record_batch(
            {"doc": batch.column("doc"), "n": batch.column("n"), "first": pa.ListArray.from_arrays(offsets, values)}
        )


def regions(sets: DataFrame, own: DataFrame, measure: Measure) -> DataFrame:
    """(region, doc, n, own): classes by the first of their shingles, those rare in a sketch of all sets first.

    ``own`` (doc, own) counts shingles that no other document has. Regions of one member are left out.
    """
    rows = sets.select("doc", "n", "shingles").mapInArrow(
        partial(_first, measure, frequencies(sets)), "doc long, n long, first array<long>"
    )
    each = stored(rows, "firsts").select("doc", "n", F.posexplode("first").alias("_place", "region"))
    # the smaller of two sets that link has a common shingle even earlier
    early = F.col("_place") <= F.col("n") - F.ceil(F.col("n") * 2 * measure.num / (measure.num + measure.den))
    met = each.groupBy("region").agg(F.count(F.lit(1)).alias("_c"), F.max(early).alias("_early"))
    placed = stored(each.join(met.where("_c > 1 and _early").select("region"), "region").select("region", "doc", "n"), "regions")
    return stored(distinct_regions(placed).join(own, "doc").select("region", "doc", "n", "own"), "regions")


def _may_link(measure: Measure, sizes: Column, apart: Column) -> Column:
    """Whether sets of together ``sizes`` shingles link if at least ``apart`` shingles are in one of them only."""
    return measure.den * (sizes - apart) >= measure.num * (sizes + apart)


def linked(members: DataFrame, sets: DataFrame, measure: Measure, pivots: int = 1) -> DataFrame:
    """(node, component) of the links, from (region, doc, n, own).

    The first pivot of a region is the member with the fewest shingles of its
    own, the middle of a family of near copies. ``apart`` is the size of the
    symmetric difference to it. For members x and y the triangle inequality
    gives |x - y| >= |apart(x) - apart(y)|; and as shingles of one's own are in
    no other set, at most min(apart - own) of the differences are common, so
    |x - y| >= apart(x) + apart(y) - 2 min(apart - own).
    """
    shelf = Shelf(members.sparkSession)
    known: list[DataFrame] = []
    level = 0
    open_ = members.withColumns(
        {"apart": F.lit(None).cast("long"), "inside": F.lit(False), "component": F.col("doc")}
    )
    kept = ("doc", "n", "own", "apart", "component")
    while True:
        order = Window.partitionBy("region").orderBy("inside", "own", F.xxhash64("doc"), "doc")
        chosen = open_.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= pivots)
        chosen = chosen.select("region", *(F.col(c).alias(f"p_{c}") for c in kept))
        met = open_.join(chosen, "region").where("doc <> p_doc").withColumns(
            {"a": F.least("doc", "p_doc"), "b": F.greatest("doc", "p_doc")}
        )
        if level:
            common = F.least(F.col("apart") - F.col("own"), F.col("p_apart") - F.col("p_own"))
            least = F.greatest(
                F.col("own") + F.col("p_own"),
                F.abs(F.col("apart") - F.col("p_apart")),
                F.col("apart") + F.col("p_apart") - 2 * common,
            )
            met = met.where("component <> p_component").where(_may_link(measure, F.col("n") + F.col("p_n"), least))
        else:
            met = shelf.put(met.select("region", "doc", "n", "p_doc", "p_n", "a", "b"), "met")
        asked = met.select("a", "b").distinct()
        for before in known:
            asked = asked.join(before.select("a", "b"), ["a", "b"], "left_anti")
        known.append(shelf.put(similarities(asked, sets), f"distances-{level}"))
        every = reduce(DataFrame.union, known)
        links = every.where(measure.links(F.col("inter"), F.col("union")))
        new = known[-1].where(measure.links(F.col("inter"), F.col("union")))
        if not level or not new.isEmpty():
            labels = shelf.put(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), f"labels-{level}")
        rest = open_.drop("component", "inside").join(labels, F.col("doc") == F.col("node"), "left").drop("node")
        rest = rest.withColumn("component", F.coalesce("component", "doc"))
        if not level:
            to_pivot = met.join(known[0], ["a", "b"]).select(
                "region", "doc", (F.col("n") + F.col("p_n") - 2 * F.col("inter")).alias("apart")
            )
            rest = rest.drop("apart").join(to_pivot, ["region", "doc"], "left")
            rest = rest.withColumn("apart", F.coalesce("apart", F.lit(0).cast("long")))  # the pivot itself
            # from here on regions with the same pivot are one, named by it: the distances to it are the same
            by_pivot = chosen.select("region", F.col("p_doc").alias("_first"))
            rest = rest.join(by_pivot, "region").withColumn("region", F.col("_first")).drop("_first")
            rest = rest.dropDuplicates(["region", "doc"])
            chosen = chosen.select(F.col("p_doc").alias("region"), "p_doc").distinct()
            firsts = shelf.put(chosen.select("region", F.col("p_doc").alias("doc")), "firsts")
        cells = firsts.join(labels, F.col("doc") == F.col("node"), "left")
        cells = cells.select("region", F.coalesce("component", "doc").alias("_cell"))
        rest = rest.join(cells, "region").withColumn("inside", F.col("component") == F.col("_cell")).drop("_cell")
        # pivots have met all open members of their region
        was_pivot = chosen.select("region", F.col("p_doc").alias("doc"))
        rest = shelf.put(rest.join(was_pivot, ["region", "doc"], "left_anti").select(*open_.columns), "rest")
        # windows: what of a region may still link beyond its component
        spare = F.col("apart") - 2 * F.col("own")
        outer = ~F.col("inside")
        windows = rest.groupBy("region").agg(
            F.max(spare).alias("_spare"),
            F.min("apart").alias("_near"),
            F.max(F.when(outer, spare)).alias("_outer_spare"),
            F.min(F.when(outer, F.col("apart"))).alias("_outer_near"),
            F.min("component").alias("_lo"),
            F.max("component").alias("_hi"),
        )
        windows = windows.where("_lo <> _hi and _outer_near is not null")
        partner = F.when(F.col("inside"), F.col("_outer_spare")).otherwise(F.col("_spare"))
        nearest = F.when(F.col("inside"), F.col("_outer_near")).otherwise(F.col("_near"))
        # a partner has at most n * den / num shingles
        most = F.floor(F.col("n") * (measure.num + measure.den) / measure.num)
        undecided = _may_link(measure, most, F.col("apart") - partner) & _may_link(measure, most, nearest - spare)
        left = rest.join(windows, "region").where(undecided).select(*open_.columns)
        size = left.groupBy("region").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("region")
        open_ = shelf.put(left.join(size, "region", "left_semi"), f"open-{level}")
        shelf.drop(f"open-{level - 1}", "rest", "met")
        if open_.isEmpty():
            return labels
        level += 1
        pivots *= 16


def joined(df: DataFrame, measure: Measure, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, text_hash, class, n, component, group) for every row of ``df``, see ``jaccard.named``."""
    docs = texts(df, id_col, text_col)
    rows = stored(sketched(docs, measure), "sketches")
    # equal sets of a chunk are told by one row: a class may have partners if any of its rows may
    near = rows.where("n > 0").groupBy(class_of().alias("class"), "n").agg(F.max("shared").alias("shared"))
    near = near.where(measure.den * F.col("shared") >= measure.num * F.col("n"))
    wanted = representatives(rows).join(near.select("class", "shared"), "class")
    wanted = stored(wanted, "candidates")
    own = wanted.select(F.col("class").alias("doc"), (F.col("n") - F.col("shared")).alias("own"))
    sets = sets_of(docs, wanted, measure.words)
    return named(rows.drop("shared"), linked(regions(sets, own, measure), sets, measure))


def keep_one(df: DataFrame, measure: Measure, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` with one document of each component, that with the smallest id; rows without words all stay."""
    return one_of_each(df, joined(df, measure, id_col, text_col), id_col, text_col)


def one_of_each(df: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``df`` that come first in their group of ``found``, by id and then by the hash of the text."""
    each = found.where("n > 0").groupBy("group", "doc", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "text_hash", "copies")
    first = each.groupBy("group").agg(F.min(order).alias("_first"))
    first = stored(first.select("_first.*"), "kept")
    words = F.coalesce(F.col(text_col), F.lit("")).rlike(WORD)
    rows, kept = uuid.uuid4().hex, uuid.uuid4().hex
    d, k = df.where(words).alias(rows), first.alias(kept)
    number, text_hash = F.col(f"`{rows}`.`{id_col}`").cast("long"), F.xxhash64(F.col(f"`{rows}`.`{text_col}`"))
    same = number.eqNullSafe(F.col(f"`{kept}`.doc")) & (text_hash == F.col(f"`{kept}`.text_hash"))
    stays = d.join(k, same, "left_semi")
    if not first.where("copies > 1").isEmpty():  # rows that repeat
        marks = [f"{rows}_id", f"{rows}_text"]
        numbered = stays.withColumns({marks[0]: F.col(id_col).cast("long"), marks[1]: F.xxhash64(F.col(text_col))})
        stays = numbered.dropDuplicates(marks).drop(*marks)
    return stays.union(df.where(~words))
