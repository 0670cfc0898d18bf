"""Checks on keys, references, NOT NULL and text lengths (DQ2, DQ3, A10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import Table


def violation_counts(required: Sequence[str], lengths: Mapping[str, int]) -> list[Column]:
    """Aggregates that count rows, nulls in required columns and texts that are too long."""
    return [
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required),
        *(F.count_if(F.length(c) > n).alias(f"long_{c}") for c, n in lengths.items()),
    ]


def column_report(df: DataFrame, required: Sequence[str], lengths: Mapping[str, int]) -> DataFrame:
    """DQ2: every column check in one aggregate pass, as one row."""
    return df.agg(*violation_counts(required, lengths))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """DQ2: keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """DQ3: values without a parent row, with their row count.

    Rows are counted per value before the anti join, so a value that fills
    much of the table is one row by then.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return values.join(parent, values[column] == parent[parent_key], "left_anti")


def missing_entities(entities: DataFrame, facts: DataFrame, entity: str) -> DataFrame:
    """Listed entities for which no row arrived."""
    return entities.join(facts.select(entity).distinct(), entity, "left_anti")


def check_observed(table: Table, observed: Mapping[str, int]) -> None:
    """Raise when the counts observed during a write show a violation."""
    wrong = {k: v for k, v in observed.items() if k.startswith(("null_", "long_")) and v}
    if wrong:
        raise ValueError(f"{table.name}: rows that break the schema: {wrong}")
