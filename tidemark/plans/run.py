"""The whole load in dependency order."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.plans import cases, consolidate, labour, markets
from tidemark.plans.steps import Report
from tidemark.sinks.warehouse import Warehouse


@dataclass(frozen=True)
class Landed:
    """Where the input files are; a part without files is left out of the run."""

    us_confirmed: str | None = None
    us_deaths: str | None = None
    global_confirmed: str | None = None
    global_deaths: str | None = None
    countries: str | None = None
    indexes: str | None = None
    series: str | None = None
    series_json: str | None = None
    ticker_pages: DataFrame | None = None
    prices: str | None = None
    price_errors: str | None = None


def load_all(
    wh: Warehouse,
    landed: Landed,
    end: dt.date | None = None,
    lookback_days: int = 0,
    start: dt.date | None = None,
) -> dict[str, Report]:
    """Run every job whose inputs have landed; reports are true for jobs that had something to load.

    ``start`` is the oldest day of market and labour files that a first load
    takes; without it all days are loaded.
    """
    done: dict[str, Report] = {}
    wh.recover()

    def note(job, *args, **options) -> None:
        done[job.__name__] = job(wh, *args, **options)

    late = {"lookback_days": lookback_days}
    first = {"start": start, **late}
    if landed.us_confirmed and landed.us_deaths:
        note(cases.extract_us, landed.us_confirmed, landed.us_deaths, end, **late)
        note(cases.transform_raw_to_fact_us, **late)
        note(cases.aggregate_fact_to_monthly_fact_us, **late)
    if landed.countries:
        note(cases.transform_raw_to_dim_country, landed.countries)
    if landed.global_confirmed and landed.global_deaths:
        note(cases.extract_global, landed.global_confirmed, landed.global_deaths, end, **late)
        note(cases.transform_raw_to_fact_global, **late)
        note(cases.aggregate_fact_to_monthly_fact_global, **late)
    note(cases.aggregate_fact_to_sum_fact, **late)
    note(cases.aggregate_fact_to_sum_monthly_fact, **late)
    if landed.indexes:
        note(markets.extract_major_stock_indexes, landed.indexes, end, **first)
        note(markets.aggregate_fact_to_monthly_fact_stock_index, **late)
    if landed.ticker_pages is not None:
        note(markets.extract_sp500_tickers, landed.ticker_pages)
    if landed.prices and landed.price_errors:
        note(markets.extract_batch_stock, landed.prices, landed.price_errors, end, **first)
        note(markets.transform_raw_to_fact_stock, **late)
        note(markets.aggregate_fact_to_monthly_fact_stock, **late)
    if landed.series:
        note(labour.extract_BOL, landed.series, end, **first)
    if landed.series_json:
        note(labour.extract_series_json, landed.series_json)
        note(labour.transform_raw_to_fact_bol, end, **late)
    note(consolidate.consolidate_covid_stock, **late)
    note(consolidate.aggregate_covid_stock_monthly_fact, **late)
    note(consolidate.consolidate_covid_stock_bol, **late)
    return done
