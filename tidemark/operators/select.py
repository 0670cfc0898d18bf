"""Filters, clamps, top-k and latest date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def without(df: DataFrame, column: str) -> DataFrame:
    """rows where the column is null."""
    return df.filter(F.col(column).isNull())


def having(df: DataFrame, column: str) -> DataFrame:
    """rows where the column has a value."""
    return df.filter(F.col(column).isNotNull())


def having_counted(df: DataFrame, column: str, counts: Observation) -> DataFrame:
    """F2, A10: as ``having``; ``counts`` tells after the action how many rows came and how many lacked a value."""
    came = F.count(F.lit(1)).alias("n_rows")
    lacking = F.count_if(F.col(column).isNull()).alias("n_without")
    return having(df.observe(counts, came, lacking), column)


def in_range(df: DataFrame, start: dt.date | Column | None, end: dt.date | Column, date: str = "date") -> DataFrame:
    """closed date range, open below without a start."""
    df = df if start is None else df.filter(F.col(date) >= start)
    return df.filter(F.col(date) <= end)


def on_date(df: DataFrame, day: dt.date | Column, date: str = "date") -> DataFrame:
    """rows of one date."""
    return df.filter(F.col(date) == day)


def nonzero(df: DataFrame, value: str = "value") -> DataFrame:
    """zero stands for a missing value and is left out."""
    return df.filter(F.col(value) != 0)


def latest_date(df: DataFrame, date: str = "date") -> DataFrame:
    """O3: the largest date, as a one-row frame."""
    return df.agg(F.max(date).alias(date))


def clamp(start: dt.date, end: dt.date, first: dt.date | None, last: dt.date | None) -> tuple[dt.date, dt.date]:
    """a requested range cut to what is available."""
    return (max(start, first) if first else start), (min(end, last) if last else end)


def clamp_end(end: dt.date, df: DataFrame, date: str = "date") -> Column:
    """F9 as a scalar subquery: the requested end or, if earlier, the last date of ``df``."""
    return F.least(F.lit(end), latest_date(df, date).scalar())


def top_k(df: DataFrame, k: int, measure: str, entity: str, date: str = "date") -> DataFrame:
    """O2: latest date first, then largest measure, ties by entity name."""
    return df.orderBy(F.col(date).desc(), F.col(measure).desc(), F.col(entity)).limit(k)


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """O1: sort at the edge of a result."""
    return df.orderBy(*keys)


def replace_where(df: DataFrame, column: str, condition: Column, value: object) -> DataFrame:
    """A new value where the condition holds, the old one elsewhere."""
    new = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(condition, new).otherwise(F.col(column)))


def select_series(df: DataFrame, series: Sequence[str], series_id: str = "series_id") -> DataFrame:
    """F3 for many keys: one scan with IN instead of one per key."""
    return df.filter(F.col(series_id).isin(list(series)))
