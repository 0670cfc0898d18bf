"""Labour, travel and retail series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import dateid, period_date
from tidemark.operators.aggregate import first_per_key
from tidemark.operators.reshape import series_to_long
from tidemark.operators.select import having
from tidemark.plans.steps import UP_TO_DATE, Bounds, Report, bounds, finished
from tidemark.schemas import conform
from tidemark.scratch import stored
from tidemark.sinks.warehouse import Warehouse
from tidemark.sources.files import csv_header, read_series_csv
from tidemark.sources.nested import flatten_series, read_documents

def series_fact(raw: DataFrame) -> DataFrame:
    """Raw (series, year, period) rows to one value per series and month.

    Annual rows (M13) have no month and drop out. The date stands for year and
    period, so one grouping makes the rows single.
    """
    dated = having(raw.withColumn("date", period_date(F.col("year"), F.col("period"))), "date")
    single = first_per_key(dated.select("series_id", "date", "value"), ["series_id", "date"])
    return single.select(dateid(F.col("date")).alias("dateid"), "series_id", "date", "value")


def extract_BOL(
    wh: Warehouse,
    series_csv: str,
    end: dt.date | None = None,
    lookback_days: int = 0,
    start: dt.date | None = None,
) -> Report:
    """The wide monthly file to series facts, for the series of the stored dimension.

    A first load takes all months from ``start`` on, without it all there are.
    Columns that the dimension does not name are counted in the report.
    """
    mark = "bol_series_fact:wide"
    todo = bounds(wh.mark(mark), end or dt.date.today(), lookback_days)
    if todo is None:
        return UP_TO_DATE
    first = start if todo.low is None else todo.low + dt.timedelta(days=1)
    known = {row["series_id"] for row in wh.read("bol_series_dim").select("series_id").collect()}
    columns = [c for c in csv_header(wh.spark, series_csv) if c != "date"]
    series = [c for c in columns if c in known]
    wide = read_series_csv(wh.spark, series_csv, series, first, todo.end)
    return _store(wh, mark, series_to_long(wide), todo, {"columns without a series": len(columns) - len(series)})


def _store(wh: Warehouse, mark: str, facts: DataFrame, todo: Bounds, dropped: dict[str, int]) -> Report:
    """Facts of one way in beside those of the other: months that both have keep the series of both."""
    name = "bol_series_fact"
    new = stored(conform(facts, name), "series")
    span = new.agg(F.min("date"), F.max("date")).first()
    if span[0] is None:
        return UP_TO_DATE
    there = wh.read(name, after=span[0] - dt.timedelta(days=1), until=span[1])
    there = there.join(new.select("date").distinct(), "date", "left_semi")
    kept = there.join(new.select("date", "series_id"), ["date", "series_id"], "left_anti").select(*new.columns)
    wh.load(name, new.unionByName(kept))
    wh.set_mark(mark, max(span[1], todo.low or span[1]))
    finished(wh, name, Bounds(todo.low and min(todo.low, span[0] - dt.timedelta(days=1)), span[1]))
    return Report(True, new.count(), dropped)


def extract_series_json(wh: Warehouse, path: str) -> Report:
    """Landed JSON answers to raw series rows; rows that are there already stay single."""
    observed = wh.add_years("bol_series_raw", flatten_series(read_documents(wh.spark, path)))
    return Report(bool(observed["n_rows"]), observed["n_rows"])


def transform_raw_to_fact_bol(wh: Warehouse, end: dt.date | None = None, lookback_days: int = 0) -> Report:
    """Raw series rows to series facts, with a mark of its own; only the years in question are read."""
    mark = "bol_series_fact:raw"
    todo = bounds(wh.mark(mark), end or dt.date.today(), lookback_days)
    if todo is None:
        return UP_TO_DATE
    raw = wh.read("bol_series_raw").filter(F.col("year") <= todo.end.year)
    if todo.low is not None:
        raw = raw.filter(F.col("year") >= todo.low.year)
    facts = series_fact(raw).filter(F.col("date") <= todo.end)
    if todo.low is not None:
        facts = facts.filter(F.col("date") > todo.low)
    annual = raw.filter(period_date(F.col("year"), F.col("period")).isNull()).count()
    return _store(wh, mark, facts, todo, {"rows that are no month": annual})
