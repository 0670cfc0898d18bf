"""Equi joins between facts, dimensions and series.

Only frames that hold one row per month by their key are broadcast by hint
(J5): the calendar bounds them, whatever the data. Elsewhere Catalyst and AQE
broadcast a side after checking its size against
``spark.sql.autoBroadcastJoinThreshold`` and sort or hash both sides beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_measures(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``left`` with the measures of ``right`` for equal keys."""
    return left.join(right.select(*keys, *measures), list(keys))


def join_totals(us: DataFrame, world: DataFrame) -> DataFrame:
    """Per-date totals of one country beside those of the world."""
    return us.join(world.drop("date"), "dateid")


def cases_with_market(cases: DataFrame, market: DataFrame, scores: Sequence[str]) -> DataFrame:
    """Every case day, with the market scores of that day if it had any.

    Distinct market rows first: both sides then hold one row per day and the
    result needs no DISTINCT of its own.
    """
    return cases.join(market.select("dateid", *scores).distinct(), "dateid", "left")


def series_with_facts(series: DataFrame, monthly: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Every series value, with the month's facts if there are any.

    ``series`` is unique by series and month, ``monthly`` by month. Catalyst
    and AQE send the months to the series where they are small enough.
    """
    return series.join(monthly.select("dateid", *measures), "dateid", "left")


def enrich_countries(facts: DataFrame, countries: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Facts with columns of the country table, matched by country name."""
    lookup = countries.select(F.col("Name").alias(name), *columns).distinct()
    return facts.join(lookup, name)


def describe_series(facts: DataFrame, dim: DataFrame, series_id: str = "series_id") -> DataFrame:
    """Series values with category and sub-categories."""
    texts = dim.select(F.col("series_id").alias(series_id), "category", "subcat1", "subcat2")
    return facts.join(texts, series_id)
