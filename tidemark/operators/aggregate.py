"""Roll-ups, totals and de-duplication (A1-A10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates

AGGREGATES = {"sum": F.sum, "max": F.max, "avg": F.avg, "min": F.min}


def sum_by(df: DataFrame, keys: Sequence[str | Column], measures: Sequence[str]) -> DataFrame:
    """A1, A2: sums per key; partial sums are built before the shuffle."""
    return df.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures))


def month_rollup(
    df: DataFrame, how: Mapping[str, str], by: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """One row per (entity, month) with the date keys of that month.

    ``how`` names the aggregate per column: max for cumulative counts, avg for
    levels, sum for volumes.
    """
    day = F.col(date)
    grouped = df.groupBy(*by, F.year(day).alias("year"), F.month(day).alias("month")).agg(
        *(AGGREGATES[fn](column).alias(column) for column, fn in how.items())
    )
    year, month = F.col("year"), F.col("month")
    first = dates.first_of_month(year, month)
    return grouped.select(
        dates.first_dateid(year, month).alias("dateid"),
        *by,
        first.alias("date"),
        "year",
        "month",
        dates.month_name(first).alias("month_name"),
        *how,
    )


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by its remaining columns, nulls last.

    Every task keeps one row per key before the shuffle, so a key with very
    many rows is as cheap as any other.
    """
    rest = [c for c in df.columns if c not in keys]
    if len(rest) == 1:
        chosen = df.groupBy(*keys).agg(F.min(rest[0]).alias(rest[0]))
        return chosen.select(*df.columns)
    ranked = F.struct(*(c for name in rest for c in (F.col(name).isNull().alias(f"_no_{name}"), F.col(name))))
    chosen = df.groupBy(*keys).agg(F.min(ranked).alias("_row"))
    return chosen.select(*(F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns))


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """The latest row of every key; without keys the latest row of all."""
    rest = [c for c in df.columns if c not in keys and c != order_by]
    latest = df.groupBy(*keys).agg(
        F.max(order_by).alias(order_by), *(F.max_by(c, order_by).alias(c) for c in rest)
    )
    return latest.filter(F.col(order_by).isNotNull()).select(*df.columns)
