"""Cases beside markets and labour series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_name
from tidemark.functions.values import zero_all_numbers
from tidemark.operators.aggregate import last_per_key, month_rollup
from tidemark.operators.incremental import FIRST_MARK, is_resume
from tidemark.operators.joins import cases_with_market, series_with_facts
from tidemark.operators.windows import add_previous_diff, forward_fill
from tidemark.plans.cases import TOTALS
from tidemark.plans.markets import SCORES
from tidemark.plans.steps import UP_TO_DATE, Report, bounds, finished, pending, refresh_months, seed_rows
from tidemark.sinks.warehouse import Warehouse

ROLLUP = {**dict.fromkeys(TOTALS, "max"), **dict.fromkeys(SCORES, "avg")}
DIFFERENCES = tuple(f"{t}_{suffix}" for t in TOTALS for suffix in ("inc", "inc_pct"))
MEASURES = (*TOTALS, *DIFFERENCES, *SCORES)


# -- frames ---------------------------------------------------------------


def cases_and_market(cases: DataFrame, market: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Every case day with the latest known market level.

    Market days without a case day vanish. The fill sees all days; a filter
    on the date belongs after it.
    """
    return forward_fill(cases_with_market(cases, market, SCORES), SCORES, "dateid", bucket=bucket)


def cases_and_market_monthly(daily: DataFrame) -> DataFrame:
    """Month-end cases, mean levels, differences of the cases."""
    return add_previous_diff(month_rollup(daily, ROLLUP), TOTALS, "date")


def series_and_cases(series: DataFrame, monthly: DataFrame) -> DataFrame:
    """Every series value with the facts of its month.

    Months without facts and missing series values read 0; the value as it
    was stays in ``bol_series_value_raw``.
    """
    measures = [c for c in MEASURES if c in monthly.columns]
    joined = series_with_facts(series.select("dateid", "date", "series_id", "value"), monthly, measures)
    shaped = joined.select(
        "dateid",
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        month_name(F.col("date")).alias("month_name"),
        F.col("series_id").alias("bol_series_id"),
        F.col("value").alias("bol_series_value"),
        *measures,
    )
    raw = F.when(F.col("_known"), F.col("bol_series_value")).alias("bol_series_value_raw")
    known = shaped.withColumn("_known", F.col("bol_series_value").isNotNull())
    filled = zero_all_numbers(known)
    return filled.select(*shaped.columns[:7], raw, *measures)


# -- jobs -----------------------------------------------------------------


def consolidate_covid_stock(wh: Warehouse, lookback_days: int = 0) -> Report:
    """New case days, and days whose market levels came later, with levels filled from the last stored ones.

    Levels that arrive for days already stored take the mark back to before
    them (``finished``), so these days are among the ones loaded here.
    """
    target, source = "covid_stock_fact", "covid19_sum_fact"
    todo = pending(wh, target, source, lookback_days)
    if todo is None:
        return UP_TO_DATE
    cases = wh.read(source, after=todo.low, until=todo.end)
    market = wh.read("stock_index_fact", after=todo.low, until=todo.end)
    joined = cases_with_market(cases, market, SCORES)
    earlier = seed_rows(wh, target, todo.low, None, cases)
    if earlier is not None:
        last = last_per_key(earlier, [], "date").select(*joined.columns)
        joined = joined.unionByName(last)
    filled = forward_fill(joined, SCORES, "dateid")
    observed = wh.load(target, filled if todo.low is None else filled.filter(F.col("date") > todo.low))
    finished(wh, target, todo)
    return Report(True, observed["n_rows"])


def aggregate_covid_stock_monthly_fact(wh: Warehouse, lookback_days: int = 0) -> Report:
    """Months touched by new days."""
    return refresh_months(
        wh, "covid_stock_monthly_fact", "covid_stock_fact", ROLLUP, TOTALS, lookback_days=lookback_days
    )


def consolidate_covid_stock_bol(wh: Warehouse, lookback_days: int = 0) -> Report:
    """The labour table; months that either input has touched are written anew, others stay."""
    target, months, series = "covid_stock_bol_monthly_fact", "covid_stock_monthly_fact", "bol_series_fact"
    marks = wh.marks()
    end = max(marks.get(months, FIRST_MARK), marks.get(series, FIRST_MARK))
    todo = bounds(marks.get(target, FIRST_MARK), end, lookback_days) if is_resume(end) else None
    if todo is None:
        return UP_TO_DATE
    after = None if todo.low is None else (todo.low + dt.timedelta(days=1)).replace(day=1) - dt.timedelta(days=1)
    observed = wh.load(target, series_and_cases(wh.read(series, after=after), wh.read(months, after=after)))
    finished(wh, target, todo)
    return Report(True, observed["n_rows"])
