"""Questions asked of the facts (Q1-Q10). Each one is a single plan and a single action.

A requested end date is cut to the last date of ``source``, by default the fact
itself. Name the source when the fact is a costly view: its last date is then
read without computing the fact twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.operators.joins import describe_series
from tidemark.operators.reshape import as_json, ordered_arrays
from tidemark.operators.select import clamp_end, in_range, nonzero, on_date, ordered, select_series, top_k

# The columns and the series that the dashboard draws.
DAILY_COLUMNS = (
    "date",
    "us_confirmed",
    "us_deaths",
    "us_confirmed_inc",
    "us_deaths_inc",
    "global_confirmed",
    "global_deaths",
    "global_confirmed_inc",
    "global_deaths_inc",
    "sp500_score",
    "nasdaq100_score",
    "dowjones_score",
)
DASHBOARD_SERIES = (
    "payems",
    "jtsjol",
    "unrate",
    "LNS13023653",
    "LNU04032215",
    "LNU04032218",
    "LNU04032219",
    "LNU04032222",
    "LNU04032226",
    "CES4348100001",
    "CES6562000101",
    "CES6561000001",
    "CES7071000001",
    "MRTSSM7225USN",
    "MRTSSM4541USS",
    "MRTSSM4451USS",
    "MRTSSM446USS",
)
CASE_COLUMNS = ("date", "us_confirmed", "us_deaths", "us_confirmed_inc", "us_deaths_inc")


def cases_and_indexes(fact: DataFrame, start: dt.date, end: dt.date, source: DataFrame | None = None) -> DataFrame:
    """Q1: the twelve daily columns of a date range, in date order."""
    days = in_range(fact, start, clamp_end(end, source or fact))
    return ordered(days.select(*DAILY_COLUMNS), "date")


def cases_and_indexes_arrays(
    fact: DataFrame, start: dt.date, end: dt.date, source: DataFrame | None = None
) -> DataFrame:
    """Q1 for charts: one row, one array per column; the date range bounds the arrays."""
    days = in_range(fact, start, clamp_end(end, source or fact))
    return ordered_arrays(days.select(*DAILY_COLUMNS), DAILY_COLUMNS)


def top_places(fact: DataFrame, entity: str, end: dt.date, k: int, source: DataFrame | None = None) -> DataFrame:
    """Q2, Q3: the ``k`` places with most cases on the (clamped) end date."""
    day = on_date(fact, clamp_end(end, source or fact))
    return top_k(day, k, "confirmed", entity).select(entity, "confirmed", "deaths")


def top_places_of_days(daily: DataFrame, entity: str, end: dt.date, k: int) -> DataFrame:
    """Q2, Q3 from counts per place and day: the totals of the ``k`` first places on the (clamped) end date.

    Days after the end are left out before anything is summed, and the last
    day of the data is found in the same pass: one scan, one shuffle of days.
    """
    day, last = F.col("date"), F.lit(end)
    upto = F.when(day <= last, day)
    sums = [F.sum(F.when(day <= last, F.col(c))).alias(c) for c in ("confirmed", "deaths")]
    places = daily.groupBy(entity).agg(*sums, F.max(upto).alias("_own"), F.max(day).alias("_last"))
    whole = F.max("_last").over(Window.partitionBy(F.lit(1)))
    shown = places.withColumn("_day", F.least(last, whole)).filter(F.col("_own") == F.col("_day"))
    return top_k(shown, k, "confirmed", entity, "_day").select(entity, "confirmed", "deaths")


def top_places_json(fact: DataFrame, entity: str, end: dt.date, k: int, source: DataFrame | None = None) -> DataFrame:
    """Q2, Q3 as JSON objects."""
    return as_json(top_places(fact, entity, end, k, source))


def monthly_cases(fact: DataFrame, start: dt.date, end: dt.date, source: DataFrame | None = None) -> DataFrame:
    """Q4: the case columns of every month in range, once each, in date order."""
    months = in_range(fact, start, clamp_end(end, source or fact))
    return ordered(months.select(*CASE_COLUMNS).distinct(), "date")


def series_values(
    fact: DataFrame,
    start: dt.date,
    end: dt.date,
    series: Sequence[str] = DASHBOARD_SERIES,
    source: DataFrame | None = None,
) -> DataFrame:
    """Q5: dates and values of every asked-for series, zeros left out, in one scan."""
    rows = select_series(in_range(fact, start, clamp_end(end, source or fact)), series, "bol_series_id")
    values = nonzero(rows, "bol_series_value").select("bol_series_id", "date", "bol_series_value")
    return ordered_arrays(values, ["date", "bol_series_value"], ["bol_series_id"])


def day_details(fact: DataFrame, day: dt.date) -> DataFrame:
    """Q6: every row of one date."""
    return on_date(fact, day)


def peak_date(df: DataFrame, measure: str, date: str = "date") -> Column:
    """Date of the largest value, the earliest one among equals."""
    return F.max_by(date, F.struct(F.col(measure), F.datediff(F.lit(dt.date(9999, 12, 31)), F.col(date))))


def peak_months(series: DataFrame, monthly: DataFrame, inc: str = "us_confirmed_inc") -> DataFrame:
    """Q7: peak month of every series beside the peak month of new cases."""
    cases_peak = monthly.agg(peak_date(monthly, inc).alias("peak")).scalar()
    peaks = series.filter("value IS NOT NULL").groupBy("series_id").agg(peak_date(series, "value").alias("series_peak"))
    with_cases = peaks.withColumn("cases_peak", cases_peak)
    return with_cases.withColumn("same_month", F.col("series_peak") == F.col("cases_peak"))


def extreme_groups(
    series: DataFrame, dim: DataFrame, start: dt.date, end: dt.date, subcat1: str, k: int = 1
) -> DataFrame:
    """Q8: the groups of a sub-category with the highest and the lowest mean in a period."""
    members = dim.filter(F.col("subcat1") == subcat1)
    means = describe_series(
        in_range(series, start, end).groupBy("series_id").agg(F.avg("value").alias("mean_value")), members
    ).select("series_id", "subcat2", "mean_value")
    high = means.orderBy(F.col("mean_value").desc(), "series_id").limit(k).withColumn("side", F.lit("highest"))
    low = means.orderBy(F.col("mean_value").asc(), "series_id").limit(k).withColumn("side", F.lit("lowest"))
    return high.unionByName(low)


def change_from_base(
    df: DataFrame, start: dt.date, end: dt.date, by: Sequence[str], value: str = "value", date: str = "date"
) -> DataFrame:
    """Q9: mean within ``[start, end]`` against the mean before ``start``, in percent."""
    day = F.col(date)
    means = df.groupBy(*by).agg(
        F.avg(F.when(day < start, F.col(value))).alias("base_mean"),
        F.avg(F.when(day.between(start, end), F.col(value))).alias("period_mean"),
    )
    change = F.try_divide((F.col("period_mean") - F.col("base_mean")) * 100.0, F.col("base_mean"))
    return means.withColumn("change_pct", change)


def correlations(series: DataFrame, monthly: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Q10: correlation of every series with each measure over the months both have."""
    months = monthly.select("dateid", *measures)
    joined = series.select("dateid", "series_id", "value").join(months, "dateid")
    found = (F.corr("value", F.col(m).cast("double")).alias(f"corr_{m}") for m in measures)
    return joined.groupBy("series_id").agg(F.count("value").alias("n_months"), *found)
