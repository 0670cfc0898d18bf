"""Sharding by vector bin packing.

Documents with equal texts are a group. A group weighs a vector of bytes,
tokens and rows, every shard has an equal share of each as capacity, and each
item goes, largest first, to the shard where the dot product of its vector with
the residual capacity is highest among those with room for its bytes; where
none has, to the one with most bytes left.

The law kept is ``bytes``: sizes near equal. Items are what the driver can hold
at any input size: groups of at least 1/``pieces`` of a dimension (at most
3 * ``pieces``) by themselves, all others hashed into ``pieces`` bundles. A
group stays whole unless it exceeds a shard's share in bytes; then it is dealt
in cells of about 1/``pieces`` of all rows, by document id.

Defined cases: null texts are one group of size 1 each and no tokens; equal ids
and repeated rows are rows of their own; an empty table gives an empty result;
extra columns pass through ``assign``, result columns replace columns of the
same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

PIECES = 4096


@dataclass(frozen=True)
class Packing:
    """Cells with their shard and first slot, and the groups that are items by themselves."""

    cells: DataFrame
    groups: DataFrame
    pieces: int


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def tokens_of(text: Column) -> Column:
    """Words as a measure of tokens."""
    return F.coalesce(F.size(F.split(text, r"\s+")), F.lit(0)).cast("long")


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, tokens, group hashes): what packing needs, without the texts."""
    text = F.col(text_col)
    return df.select(
        F.col(id_col),
        size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        tokens_of(text).alias("tokens"),
        *_group(text),
    )


def _group(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for the text."""
    return F.xxhash64(text).alias("_g1"), F.xxhash64(text, F.lit("group")).alias("_g2")


def _celled(df: DataFrame, groups: DataFrame, pieces: int, id_col: str) -> DataFrame:
    """Adds the cell (kind, key, sub) of each row; ``groups`` is bounded by 3 * pieces rows."""
    out = df.join(F.broadcast(groups), ["_g1", "_g2"], "left")
    own = F.col("_subs").isNotNull()
    return out.withColumns(
        {
            "_cell": F.when(own, F.col("_item")).otherwise(F.pmod(F.col("_g1"), F.lit(pieces)).cast("int")),
            "_sub": F.when(
                own, F.pmod(F.xxhash64(F.col(id_col), F.lit("sub")), F.col("_subs")).cast("int")
            ).otherwise(F.lit(0)),
        }
    ).drop("_item", "_subs")


def pack(weighed: DataFrame, shards: int = 8, pieces: int = PIECES, id_col: str = "doc_id") -> Packing:
    """Plan from ``measured`` rows, which are read three times; store them first."""
    spark = weighed.sparkSession
    dims = ("size", "tokens", "rows")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = {k: v or 0 for k, v in weighed.agg(*sums).first().asDict().items()}
    share = {d: max(total[d], 1) / shards for d in dims}
    grouped = weighed.groupBy("_g1", "_g2").agg(*sums)
    heavy = " or ".join(f"{d} * {pieces} >= {max(total[d], 1)}" for d in dims)
    big = grouped.where(heavy).orderBy("_g1", "_g2").collect()  # at most 3 * pieces rows
    per_cell = max(total["rows"] // pieces, 1)
    groups = spark.createDataFrame(
        [(g._g1, g._g2, pieces + k, -(-g.rows // per_cell)) for k, g in enumerate(big)],
        "_g1 long, _g2 long, _item int, _subs int",
    )
    split = {pieces + k for k, g in enumerate(big) if g["size"] > share["size"]}
    cells = _celled(weighed, groups, pieces, id_col).groupBy("_cell", "_sub").agg(*sums).collect()
    items: dict[tuple, list] = {}
    for c in sorted(cells, key=lambda c: (c._cell, c._sub)):
        items.setdefault((c._cell, c._sub) if c._cell in split else (c._cell,), []).append(c)
    vectors = {
        key: [sum(c[d] for c in held) / max(total[d], 1) * shards for d in dims] for key, held in items.items()
    }
    left = [[1.0] * len(dims) for _ in range(shards)]
    where: dict[tuple, int] = {}
    for key in sorted(items, key=lambda k: (-vectors[k][0], k)):
        v = vectors[key]
        fits = [s for s in range(shards) if left[s][0] + 1e-9 >= v[0]]
        if fits:
            best = max(fits, key=lambda s: (sum(a * b for a, b in zip(v, left[s])), -s))
        else:
            best = max(range(shards), key=lambda s: (left[s][0], -s))
        left[best] = [a - b for a, b in zip(left[best], v)]
        where[key] = best
    first, placed = [0] * shards, []
    for key, held in items.items():
        for c in held:
            placed.append((c._cell, c._sub, where[key], first[where[key]]))
            first[where[key]] += c.rows
    table = spark.createDataFrame(placed, "_cell int, _sub int, shard int, _first long")
    return Packing(table, groups, pieces)


def assign(df: DataFrame, plan: Packing, id_col: str = "doc_id", text_col: str | None = "text") -> DataFrame:
    """Adds ``shard`` to every row; without a shuffle, as both plan tables are bounded by the number of pieces."""
    out = df.drop("shard")
    if text_col is not None:
        g1, g2 = _group(F.col(text_col))
        out = out.withColumns({"_g1": g1, "_g2": g2})
    out = _celled(out, plan.groups, plan.pieces, id_col)
    out = out.join(F.broadcast(plan.cells), ["_cell", "_sub"], "left")
    return out if text_col is None else out.drop("_g1", "_g2", "_cell", "_sub", "_first")


def slotted(weighed: DataFrame, plan: Packing, id_col: str = "doc_id") -> DataFrame:
    """``measured`` rows with ``shard`` and ``slot``: gapless from 0 in a shard, numbered cell by cell."""
    out = assign(weighed, plan, id_col, None)
    order = Window.partitionBy("_cell", "_sub").orderBy(id_col, "text_crc32")
    slot = F.col("_first") + F.row_number().over(order) - 1
    return out.withColumn("slot", slot.cast("long")).drop("_g1", "_g2", "_cell", "_sub", "_first")
