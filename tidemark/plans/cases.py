"""Case and death counts: raw rows, daily and monthly facts, totals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import dateid
from tidemark.operators.aggregate import month_rollup, sum_by
from tidemark.operators.incremental import FIRST_MARK, diff_with_seed, is_resume
from tidemark.operators.joins import join_totals
from tidemark.operators.reshape import dates_in_range, pack_columns, quoted, unpack_dates
from tidemark.operators.select import having, without
from tidemark.operators.windows import add_previous_diff
from tidemark.plans.steps import UP_TO_DATE, Report, bounds, finished, pending, refresh_months, seed_rows
from tidemark.schemas import TABLES, conform
from tidemark.sinks.warehouse import Warehouse
from tidemark.sources.files import read_delimited, read_wide_csv

COUNTS = ("confirmed", "deaths")
TOTALS = ("us_confirmed", "us_deaths", "global_confirmed", "global_deaths")
COUNT = T.LongType()
STATE = "Province_State"
COUNTRY = "Country_Region"

US_IDS = TABLES["covid19_us_dim"].schema
GLOBAL_IDS = T.StructType(
    [
        T.StructField("Province/State", T.StringType()),
        T.StructField("Country/Region", T.StringType()),
        T.StructField("Lat", T.DoubleType()),
        T.StructField("Long", T.DoubleType()),
    ]
)


# -- frames ---------------------------------------------------------------


def counts_by_day(
    deaths: DataFrame,
    confirmed: DataFrame,
    key: str,
    ids: Sequence[str],
    dates: dict[str, dt.date],
) -> DataFrame:
    """Wide deaths and wide confirmed to one row per (place, date).

    The two frames are joined while still wide, on the place alone. The result
    is that of unpivoting both and joining on (place, date), but the join moves
    one row per place instead of one per place and day, and equal header names
    pair the dates without a comparison per row.
    """
    names = list(dates)
    left = pack_columns(deaths, ids, names, "deaths")
    right = pack_columns(confirmed, [key], names, "confirmed")
    return unpack_dates(left.join(right, key), ids, list(dates.values()), COUNTS)


def country_rows(wide: DataFrame) -> DataFrame:
    """F1, P5: rows of whole countries; countries reported only by province drop out."""
    return without(wide, "Province/State").drop("Province/State")


def state_fact(raw: DataFrame, stored: DataFrame | None = None, entity: str = STATE) -> DataFrame:
    """Counties to states per day, with differences."""
    daily = sum_by(raw, [entity, "date"], COUNTS)
    return daily_differences(daily, stored, entity)


def country_fact(raw: DataFrame, stored: DataFrame | None = None, entity: str = COUNTRY) -> DataFrame:
    """Distinct country rows per day, with differences."""
    daily = raw.select(entity, "date", *COUNTS).distinct()
    return daily_differences(daily, stored, entity)


def daily_differences(daily: DataFrame, stored: DataFrame | None, entity: str) -> DataFrame:
    keyed = daily.withColumn("dateid", dateid(F.col("date")))
    return diff_with_seed(keyed, stored, COUNTS, [entity])


def monthly_fact(fact: DataFrame, entity: str) -> DataFrame:
    """Month-end of the cumulative counts, with differences."""
    monthly = month_rollup(fact, dict.fromkeys(COUNTS, "max"), [entity])
    return add_previous_diff(monthly, COUNTS, "date", [entity])


def day_totals(fact: DataFrame, prefix: str) -> DataFrame:
    """A2: counts of all places per day."""
    summed = sum_by(fact, ["dateid", "date"], COUNTS)
    return summed.withColumnsRenamed({c: prefix + c for c in COUNTS})


def totals_fact(us: DataFrame, world: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Totals of two facts side by side, with differences."""
    joined = join_totals(day_totals(us, "us_"), day_totals(world, "global_"))
    return diff_with_seed(joined, stored, TOTALS)


def totals_in_one_pass(facts: DataFrame, is_us: Column, bucket: Column | None = None) -> DataFrame:
    """The totals when one frame holds both sides: conditional sums instead of a join.

    Days without any row of the country drop out, as they do in the join.
    """
    sums = {}
    for c in COUNTS:
        sums["us_" + c] = F.sum(F.when(is_us, F.col(c)))
    for c in COUNTS:
        sums["global_" + c] = F.sum(c)
    per_day = facts.groupBy("date").agg(
        F.count_if(is_us).alias("_us_rows"), *(s.alias(name) for name, s in sums.items())
    )
    days = per_day.filter("_us_rows > 0").drop("_us_rows").withColumn("dateid", dateid(F.col("date")))
    return add_previous_diff(days, TOTALS, "date", bucket=bucket)


def totals_monthly(totals: DataFrame) -> DataFrame:
    """Month-end totals with differences."""
    monthly = month_rollup(totals, dict.fromkeys(TOTALS, "max"))
    return add_previous_diff(monthly, TOTALS, "date")


# -- jobs -----------------------------------------------------------------


def _extract(
    wh: Warehouse,
    raw: str,
    dim: str,
    frames: tuple[DataFrame, DataFrame],
    key: str,
    ids: Sequence[str],
    end: dt.date | None,
    skip_first: int,
    lookback_days: int,
) -> Report:
    deaths, confirmed = frames
    mark = wh.mark(raw)
    available = dates_in_range(deaths.columns, until=end or dt.date.today(), skip_first=skip_first)
    shared = {n: d for n, d in available.items() if n in set(confirmed.columns)}
    todo = bounds(mark, max(shared.values()), lookback_days) if shared else None
    if todo is None:
        return UP_TO_DATE
    dates = {n: d for n, d in shared.items() if todo.low is None or d > todo.low}
    rename = {"Country/Region": COUNTRY, "Long": "Long_"}
    rows = counts_by_day(deaths, confirmed, key, ids, dates).withColumnsRenamed(rename)
    observed = wh.load(raw, having(rows, "Lat"))
    lost = deaths.filter(F.col("Lat").isNull()).count() * len(dates)
    places = having(deaths.selectExpr(*map(quoted, ids)).withColumnsRenamed(rename), "Lat")
    _add_places(wh, dim, places, rename.get(key, key), todo.end)
    finished(wh, raw, todo)
    return Report(True, observed["n_rows"], {"without a position": lost})


def _add_places(wh: Warehouse, dim: str, places: DataFrame, key: str, end: dt.date) -> None:
    """Places of the first file, later those that a file has for the first time."""
    if not is_resume(wh.mark(dim)):
        wh.replace(dim, places)
    else:
        stored = wh.read(dim)
        new = conform(places, dim).join(stored, key, "left_anti")
        if new.isEmpty():
            return
        wh.replace(dim, stored.unionByName(new))
    wh.set_mark(dim, end)


def extract_us(
    wh: Warehouse,
    confirmed_csv: str,
    deaths_csv: str,
    end: dt.date | None = None,
    skip_first: int = 0,
    lookback_days: int = 0,
) -> Report:
    """B1: the county files to raw rows and, on the first load, the county dimension."""
    frames = (
        read_wide_csv(wh.spark, deaths_csv, US_IDS, COUNT),
        read_wide_csv(wh.spark, confirmed_csv, US_IDS, COUNT),
    )
    return _extract(
        wh, "covid19_us_raw", "covid19_us_dim", frames, "UID", US_IDS.names, end, skip_first, lookback_days
    )


def extract_global(
    wh: Warehouse,
    confirmed_csv: str,
    deaths_csv: str,
    end: dt.date | None = None,
    skip_first: int = 0,
    lookback_days: int = 0,
) -> Report:
    """B2: the country files to raw rows and, on the first load, the country list."""
    frames = (
        country_rows(read_wide_csv(wh.spark, deaths_csv, GLOBAL_IDS, COUNT)),
        country_rows(read_wide_csv(wh.spark, confirmed_csv, GLOBAL_IDS, COUNT)),
    )
    ids = ["Country/Region", "Lat", "Long"]
    return _extract(
        wh,
        "covid19_global_raw",
        "covid19_global_dim",
        frames,
        "Country/Region",
        ids,
        end,
        skip_first,
        lookback_days,
    )


def transform_raw_to_fact_us(wh: Warehouse, lookback_days: int = 0) -> Report:
    """New county days to state facts."""
    return _transform(wh, "covid19_us_fact", "covid19_us_raw", state_fact, STATE, lookback_days)


def transform_raw_to_fact_global(wh: Warehouse, lookback_days: int = 0) -> Report:
    """New country days to country facts."""
    return _transform(wh, "covid19_global_fact", "covid19_global_raw", country_fact, COUNTRY, lookback_days)


def _transform(wh: Warehouse, target: str, source: str, build, entity: str, lookback_days: int) -> Report:
    todo = pending(wh, target, source, lookback_days)
    if todo is None:
        return UP_TO_DATE
    new = wh.read(source, after=todo.low, until=todo.end)
    observed = wh.load(target, build(new, seed_rows(wh, target, todo.low, entity, new)))
    finished(wh, target, todo)
    return Report(True, observed["n_rows"])


def aggregate_fact_to_monthly_fact_us(wh: Warehouse, lookback_days: int = 0) -> Report:
    """State months touched by new days."""
    return refresh_months(
        wh,
        "covid19_us_monthly_fact",
        "covid19_us_fact",
        dict.fromkeys(COUNTS, "max"),
        COUNTS,
        [STATE],
        lookback_days,
    )


def aggregate_fact_to_monthly_fact_global(wh: Warehouse, lookback_days: int = 0) -> Report:
    """Country months touched by new days."""
    return refresh_months(
        wh,
        "covid19_global_monthly_fact",
        "covid19_global_fact",
        dict.fromkeys(COUNTS, "max"),
        COUNTS,
        [COUNTRY],
        lookback_days,
    )


def transform_raw_to_dim_country(wh: Warehouse, country_csv: str) -> Report:
    """The ``;`` separated country file to the country dimension."""
    if is_resume(wh.mark("country_dim")):
        return UP_TO_DATE
    schema = TABLES["country_dim"].schema
    observed = wh.replace("country_dim", read_delimited(wh.spark, country_csv, schema))
    wh.set_mark("country_dim", dt.date.today())
    return Report(True, observed["n_rows"])


def aggregate_fact_to_sum_fact(wh: Warehouse, lookback_days: int = 0) -> Report:
    """New days that both facts have reached to totals.

    A day waits until the slower of the two has it; it would be lost if the
    mark passed it before.
    """
    target, source, other = "covid19_sum_fact", "covid19_us_fact", "covid19_global_fact"
    marks = wh.marks()
    end = min(marks.get(source, FIRST_MARK), marks.get(other, FIRST_MARK))
    todo = bounds(marks.get(target, FIRST_MARK), end, lookback_days) if is_resume(end) else None
    if todo is None:
        return UP_TO_DATE
    us = wh.read(source, after=todo.low, until=todo.end)
    world = wh.read(other, after=todo.low, until=todo.end)
    observed = wh.load(target, totals_fact(us, world, seed_rows(wh, target, todo.low, None, us)))
    finished(wh, target, todo)
    return Report(True, observed["n_rows"])


def aggregate_fact_to_sum_monthly_fact(wh: Warehouse, lookback_days: int = 0) -> Report:
    """Total months touched by new days."""
    return refresh_months(
        wh,
        "covid19_sum_monthly_fact",
        "covid19_sum_fact",
        dict.fromkeys(TOTALS, "max"),
        TOTALS,
        lookback_days=lookback_days,
    )
