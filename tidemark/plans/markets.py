"""Tickers, prices and indexes."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import dateid
from tidemark.operators.aggregate import last_per_key, month_rollup
from tidemark.operators.incremental import increment_by_entity, is_resume
from tidemark.operators.quality import missing_entities
from tidemark.operators.select import in_range
from tidemark.operators.windows import forward_fill
from tidemark.plans.steps import UP_TO_DATE, Bounds, Report, bounds, finished, pending, refresh_months, seed_rows
from tidemark.schemas import conform
from tidemark.scratch import stored
from tidemark.sinks.texts import write_text_list
from tidemark.sinks.warehouse import Warehouse
from tidemark.sources.files import read_series_csv, read_text_list
from tidemark.sources.markup import ticker_rows
from tidemark.sources.prices import file_versions, good_prices, list_price_files, quarantined, read_price_files
from tidemark.storage import Folders

# Index series and the score columns they fill.
INDEX_COLUMNS = {"djia": "dowjones_score", "nasdaq100": "nasdaq100_score", "sp500": "sp500_score"}

SCORES = tuple(INDEX_COLUMNS.values())
PRICE_ROLLUP = {"High": "avg", "Low": "avg", "Open": "avg", "Close": "avg", "Volume": "sum", "adj_close": "avg"}


# -- frames ---------------------------------------------------------------


def index_fact(
    wide: DataFrame, earlier: DataFrame | None = None, columns: Mapping[str, str] = INDEX_COLUMNS
) -> DataFrame:
    """Index levels per day; a missing level repeats the last known one.

    Days before the first known level get 0. ``earlier`` hands over the last
    levels of loads before.
    """
    scores = list(columns.values())
    days = wide.select("date", *(F.col(c).alias(name) for c, name in columns.items())).withColumn("_new", F.lit(True))
    if earlier is not None:
        seed = last_per_key(earlier.select("date", *scores), [], "date")
        days = days.unionByName(seed.withColumn("_new", F.lit(False)))
    filled = forward_fill(days, scores, "date", initial=0.0).filter("_new")
    return filled.select(dateid(F.col("date")).alias("dateid"), "date", *scores)


def index_monthly(fact: DataFrame) -> DataFrame:
    """Mean level per month."""
    return month_rollup(fact, dict.fromkeys(SCORES, "avg"))


def price_fact(raw: DataFrame) -> DataFrame:
    """Price rows with their date key."""
    return conform(raw.withColumn("dateid", dateid(F.col("date"))), "stock_price_fact")


def price_monthly(fact: DataFrame) -> DataFrame:
    """Mean prices and summed volume per ticker and month."""
    return month_rollup(fact, PRICE_ROLLUP, ["stock_ticker"])


# -- jobs -----------------------------------------------------------------


def extract_sp500_tickers(
    wh: Warehouse, pages: DataFrame, ticker_list: str | None = None, markup: str = "html"
) -> Report:
    """The ticker table of a landed page to ticker rows and, if wanted, a ticker list."""
    name = "stock_ticker_raw"
    if is_resume(wh.mark(name)):
        return UP_TO_DATE
    rows = ticker_rows(pages, markup)
    observed = wh.replace(name, rows)
    if ticker_list is not None:
        write_text_list(wh.read(name), "ticker", ticker_list)
    wh.set_mark(name, dt.date.today())
    return Report(True, observed["n_rows"])


#: What a price row is known by.
PRICE = ("stock_ticker", "date")


def extract_batch_stock(
    wh: Warehouse,
    price_dir: str,
    error_dir: str,
    end: dt.date | None = None,
    lookback_days: int = 0,
    start: dt.date | None = None,
) -> Report:
    """Price files to raw rows; broken lines and tickers without rows are set aside.

    Only files are parsed that are new, that have changed, or that hold rows
    after the end of the last load: a ledger knows the versions that were read.
    A file that was only added to gives the rows after its ticker's own mark, so
    it does not matter when it comes. Any other change replaces the rows and the
    broken lines that the file gave before. A first load of a file takes all days
    from ``start`` on, without it all there are; ``lookback_days`` reads all files
    again. Rows of other tickers stay, whatever day they are of. A file that
    cannot be used does not stop the others. Names of files to read are the one
    thing that is collected.
    """
    name = "stock_price_raw"
    end = end or dt.date.today()
    files = list_price_files(wh.spark, price_dir)
    ledger = wh.ledger(name)
    settled = (F.coalesce("last_date", "until") <= F.col("until")) | (F.col("until") >= F.lit(end))
    seen = ledger.filter(settled).select("file", "length", "modified", F.lit(True).alias("_seen"))
    todo = files.join(seen, ["file", "length", "modified"], "left")
    if not lookback_days:
        todo = todo.filter(F.col("_seen").isNull())
    todo = stored(todo.drop("_seen"), "files")
    paths = [row.path for row in todo.select("path").collect()]
    if not paths:
        return UP_TO_DATE
    mark = wh.mark(name)
    lines = stored(read_price_files(wh.spark, paths), "price-lines")
    versions = stored(file_versions(todo, lines, ledger, end), "file-versions")
    good = good_prices(lines).filter(F.col("date") <= F.lit(end)).join(versions.select("file", "grew"), "file")
    whole = in_range(good.filter(~F.col("grew")), start, end)
    added = increment_by_entity(good.filter("grew"), wh.entity_marks(name), "stock_ticker", lookback_days=lookback_days)
    rows = whole.unionByName(added)
    changed = versions.filter("known and not grew").select("stock_ticker")
    observed = wh.merge(name, rows, PRICE, None if changed.isEmpty() else changed)
    broken = _set_aside(wh, lines, versions, error_dir)
    recent = wh.read(name, after=mark if is_resume(mark) and mark < end else None, until=end)
    tickers = wh.read("stock_ticker_raw").select(F.col("ticker").alias("stock_ticker"))
    write_text_list(missing_entities(tickers, recent, "stock_ticker"), "stock_ticker", f"{error_dir}/no_rows")
    latest = good.groupBy(F.col("stock_ticker").alias("entity")).agg(F.max("date").alias("latest"))
    wh.raise_entity_marks(name, latest)
    wh.note_files(name, versions)
    if observed["max_date"] is None:
        return Report(False, 0, {"broken lines": broken})
    finished(wh, name, Bounds(observed["min_date"] - dt.timedelta(days=1), end), observed["max_date"])
    return Report(True, observed["n_rows"], {"broken lines": broken})


def extract_single_date_stock(
    wh: Warehouse, price_dir: str, error_dir: str, date: dt.date, ticker_list: str | None = None
) -> Report:
    """Prices of one day, for the tickers of a text list or of the ticker table.

    The rows of these tickers are stored again if they were there before, those
    of others stay. Only files of these tickers are parsed. Marks stay.
    """
    name = "stock_price_raw"
    if ticker_list is None:
        tickers = wh.read("stock_ticker_raw").select(F.col("ticker").alias("stock_ticker"))
    else:
        tickers = read_text_list(wh.spark, ticker_list, "stock_ticker")
    files = list_price_files(wh.spark, price_dir).join(tickers.distinct(), "stock_ticker", "left_semi")
    files = stored(files, "files")
    paths = [row.path for row in files.select("path").collect()]
    if not paths:
        return UP_TO_DATE
    lines = stored(read_price_files(wh.spark, paths), "price-lines")
    observed = wh.merge(name, in_range(good_prices(lines), date, date), PRICE)
    broken = _set_aside(wh, lines, files, error_dir)
    loaded = wh.read(name, after=date - dt.timedelta(days=1), until=date)
    write_text_list(missing_entities(tickers, loaded, "stock_ticker"), "stock_ticker", f"{error_dir}/no_rows")
    if wh.mark(name) >= date:
        finished(wh, name, Bounds(date - dt.timedelta(days=1), date))
    return Report(True, observed["n_rows"], {"broken lines": broken})


_BROKEN = "file string, stock_ticker string, broken string"


def _set_aside(wh: Warehouse, lines: DataFrame, files: DataFrame, error_dir: str) -> int:
    """The broken lines of these files in place of those that earlier versions of them gave; how many there are."""
    folders, kept = Folders(wh.spark), f"{error_dir}/broken_lines"
    broken = stored(quarantined(lines), "broken-lines")
    before = wh.spark.read.schema(_BROKEN).json(kept) if folders.exists(kept) else wh.spark.createDataFrame([], _BROKEN)
    fresh = f"{error_dir}/_broken_lines_{uuid.uuid4().hex}"
    before.join(files.select("file"), "file", "left_anti").unionByName(broken).write.json(fresh)
    folders.move(fresh, kept)
    return broken.count()


def extract_major_stock_indexes(
    wh: Warehouse,
    index_csv: str,
    end: dt.date | None = None,
    lookback_days: int = 0,
    start: dt.date | None = None,
) -> Report:
    """Index levels to index facts; a first load takes all days from ``start`` on, without it all there are."""
    name = "stock_index_fact"
    todo = bounds(wh.mark(name), end or dt.date.today(), lookback_days)
    if todo is None:
        return UP_TO_DATE
    first = start if todo.low is None else todo.low + dt.timedelta(days=1)
    wide = read_series_csv(wh.spark, index_csv, list(INDEX_COLUMNS), first, todo.end)
    observed = wh.load(name, index_fact(wide, seed_rows(wh, name, todo.low, None, wide)))
    if observed["max_date"] is None:
        return UP_TO_DATE
    finished(wh, name, todo, observed["max_date"])
    return Report(True, observed["n_rows"])


def aggregate_fact_to_monthly_fact_stock_index(wh: Warehouse, lookback_days: int = 0) -> Report:
    """Index months touched by new days."""
    return refresh_months(
        wh,
        "stock_index_monthly_fact",
        "stock_index_fact",
        dict.fromkeys(SCORES, "avg"),
        lookback_days=lookback_days,
    )


def transform_raw_to_fact_stock(wh: Warehouse, lookback_days: int = 0) -> Report:
    """New price rows to price facts."""
    target, source = "stock_price_fact", "stock_price_raw"
    todo = pending(wh, target, source, lookback_days)
    if todo is None:
        return UP_TO_DATE
    observed = wh.load(target, price_fact(wh.read(source, after=todo.low, until=todo.end)))
    finished(wh, target, todo)
    return Report(True, observed["n_rows"])


def aggregate_fact_to_monthly_fact_stock(wh: Warehouse, lookback_days: int = 0) -> Report:
    """Price months touched by new days; earlier months stay."""
    return refresh_months(
        wh,
        "stock_price_monthly_fact",
        "stock_price_fact",
        PRICE_ROLLUP,
        by=["stock_ticker"],
        lookback_days=lookback_days,
    )
