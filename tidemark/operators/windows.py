"""Previous-row differences and forward fill (W1-W5), plain and bucketed.

The plain forms sort one entity (or, without entity, the whole frame) in one
task. That is right for frames already aggregated to one row per date, whose
size the calendar bounds. Row-level frames take the bucketed forms: a bucket is
a coarser value of the order column (month of a date, hour of a time stamp), so
each task sorts one (entity, bucket) and only one row per bucket travels on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window, WindowSpec

_PREV = "_prev_"


def add_previous_diff(
    df: DataFrame,
    measures: Sequence[str],
    order_by: str,
    partition_by: Sequence[str] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """``<m>_inc`` and ``<m>_inc_pct`` against the row before.

    The first row of an entity is compared with 0; a percentage without a
    base (previous value 0 or no value) is 0.
    """
    if bucket is None:
        window = Window.partitionBy(*partition_by).orderBy(order_by)
        df = df.withColumns({_PREV + m: F.lag(m).over(window) for m in measures})
    else:
        df = previous_values(df, {m: _PREV + m for m in measures}, order_by, bucket, partition_by)
    return with_differences(df, {m: _PREV + m for m in measures}).drop(*(_PREV + m for m in measures))


def with_differences(df: DataFrame, previous: Mapping[str, str]) -> DataFrame:
    """Increment and percentage from columns that hold the previous value."""
    added = {}
    for measure, column in previous.items():
        before = F.coalesce(F.col(column), F.lit(0))
        inc = F.col(measure) - before
        added[f"{measure}_inc"] = inc
        added[f"{measure}_inc_pct"] = F.coalesce(F.try_divide(inc * F.lit(100.0), before), F.lit(0.0))
    return df.withColumns(added)


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    order_by: str,
    partition_by: Sequence[str] = (),
    initial: float | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Last non-null value up to the row; W5 when ``initial`` fills leading nulls."""
    if bucket is not None:
        filled = _fill_bucketed(df, columns, order_by, bucket, partition_by)
    else:
        window = Window.partitionBy(*partition_by).orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
        filled = df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})
    if initial is None:
        return filled
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(initial)) for c in columns})


def previous_values(
    df: DataFrame,
    targets: Mapping[str, str],
    order_by: str,
    bucket: Column,
    partition_by: Sequence[str] = (),
    fill: Sequence[str] = (),
) -> DataFrame:
    """Bucketed lag and forward fill in one pass.

    ``targets`` maps a column to the name of its previous value, columns in
    ``fill`` repeat their last known value. ``order_by`` must be unique within
    an entity and ``bucket`` must not fall when it grows.
    """
    rows = df.withColumn("_bucket", bucket)
    last = {f"_at_{c}": F.max_by(c, order_by) for c in targets}
    last |= {f"_of_{c}": F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order_by))) for c in fill}
    tails = _tails(rows, last, partition_by)
    across = Window.partitionBy(*partition_by).orderBy("_bucket")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.withColumns(
        {f"_at_{c}": F.lag(f"_at_{c}").over(across) for c in targets}
        | {f"_of_{c}": F.last(f"_of_{c}", ignorenulls=True).over(before) for c in fill}
    )
    inside, both = _with_carry(rows, carry, order_by, partition_by)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    values = {c: F.when(F.col("_carried"), F.col(f"_at_{c}")).otherwise(F.col(c)) for c in targets}
    known = {c: F.when(F.col("_carried"), F.col(f"_of_{c}")).otherwise(F.col(c)) for c in fill}
    found = both.withColumns(
        {name: F.lag(values[c]).over(inside) for c, name in targets.items()}
        | {f"_full_{c}": F.last(known[c], ignorenulls=True).over(so_far) for c in fill}
    )
    kept = [F.col(f"_full_{c}").alias(c) if c in fill else F.col(c) for c in df.columns]
    return found.filter("NOT _carried").select(*kept, *targets.values())


def _fill_bucketed(
    df: DataFrame, columns: Sequence[str], order_by: str, bucket: Column, partition_by: Sequence[str]
) -> DataFrame:
    return previous_values(df, {}, order_by, bucket, partition_by, columns)


def _tails(rows: DataFrame, last: Mapping[str, Column], partition_by: Sequence[str]) -> DataFrame:
    """One row per bucket with its closing values, built before the shuffle."""
    return rows.groupBy(*partition_by, "_bucket").agg(*(value.alias(c) for c, value in last.items()))


def _with_carry(
    rows: DataFrame, carry: DataFrame, order_by: str, partition_by: Sequence[str]
) -> tuple[WindowSpec, DataFrame]:
    """The rows and, ahead of them in every bucket, one row with the values carried in.

    The carried row takes the place of a join: the rows are shuffled once, by
    bucket, and a null entity needs no care.
    """
    both = rows.withColumn("_carried", F.lit(False)).unionByName(
        carry.withColumn("_carried", F.lit(True)), allowMissingColumns=True
    )
    inside = Window.partitionBy(*partition_by, "_bucket").orderBy(F.col("_carried").desc(), order_by)
    return inside, both
