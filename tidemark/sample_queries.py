"""Every operator and question as a query over the sample tables.

Each entry takes (session, folder) and reads whole tables. Dates leave as ISO
text (D8) and inexact numbers rounded, as a dashboard would show them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates, values
from tidemark.operators import aggregate, incremental, joins, quality, reshape, select, windows
from tidemark.plans import cases, consolidate, dashboard, labour, markets, steps
from tidemark.plans.run import Landed, load_all
from tidemark.schemas import TABLES
from tidemark.scratch import scratch_folder, stored
from tidemark.sinks.texts import write_text_list
from tidemark.sinks.warehouse import Warehouse
from tidemark.storage import Folders
from tidemark.sources import files, markup, nested
from tidemark.sources.prices import PRICE_COLUMNS
from tidemark.streaming import daily
from tidemark import views

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

START = dt.date(1996, 1, 1)
END = dt.date(2000, 12, 31)
SPLIT = dt.date(1998, 6, 15)
BEYOND = dt.date(2030, 1, 1)
SHIFT_MONTHS = 240
SLICE = (dt.date(2016, 2, 10), dt.date(2020, 10, 31))
US = "AMERICA"


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def present(df: DataFrame, digits: int = 5) -> DataFrame:
    """Dates as ISO text, percentages with 5 and other inexact numbers with ``digits`` places."""
    shown = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = dates.iso_text(c)
        elif isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), 5 if f.name.endswith("_pct") else digits)
        shown.append(c.alias(f.name))
    return df.select(*shown)


# -- shared frames ---------------------------------------------------------


def _state_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    return views.cumulative(views.state_daily(spark, sf), ["state", "country"])


def _country_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    per_day = aggregate.sum_by(views.county_daily(spark, sf), ["country", "date"], cases.COUNTS)
    return views.cumulative(per_day, ["country"])


def _totals(spark: SparkSession, sf: str, bucketed: bool = False) -> DataFrame:
    bucket = dates.month_number(F.col("date")) if bucketed else None
    return cases.totals_in_one_pass(views.county_daily(spark, sf), F.col("country") == US, bucket)


def _cases_index(spark: SparkSession, sf: str) -> DataFrame:
    market = views.index_daily(spark, sf).withColumn("dateid", dates.dateid(F.col("date")))
    return consolidate.cases_and_market(_totals(spark, sf), market.drop("date"))


def _cases_index_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return consolidate.cases_and_market_monthly(_cases_index(spark, sf))


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return views.series_monthly(spark, sf).withColumn("dateid", dates.dateid(F.col("date")))


def _cases_index_series(spark: SparkSession, sf: str) -> DataFrame:
    return consolidate.series_and_cases(_series(spark, sf), _cases_index_monthly(spark, sf))


def _nation_daily(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders taken and parts shipped per nation and day: two sources with one key."""
    orders = (
        views.table(spark, sf, "orders")
        .join(views.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("uid"), F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("confirmed"))
    )
    shipped = (
        views.table(spark, sf, "lineitem")
        .join(views.table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("uid"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.sum("l_quantity").cast("long").alias("deaths"))
    )
    return orders, shipped


def _header_labels(spark: SparkSession, sf: str) -> list[str]:
    """A header for every month from the first to the last order: the names of a wide frame are part of its plan."""
    first, last = views.order_days(spark, sf).agg(F.min("date"), F.max("date")).first()
    if first is None:
        return []
    months = range(dates.month_of(first) + SHIFT_MONTHS, dates.month_of(last) + SHIFT_MONTHS + 1)
    return [f"{m % 12 + 1}/1/{m // 12 % 100:02d}" for m in months]


def _wide(spark: SparkSession, sf: str, cumulated: DataFrame, place: str, measure: str) -> DataFrame:
    """Month-end counts, one column per month, named like the columns of the landed files.

    The names are those of 20 years later, as a header means the years 20xx.
    """
    monthly = aggregate.month_rollup(cumulated, {measure: "max"}, [place])
    label = F.date_format(F.add_months("date", SHIFT_MONTHS), "M/d/yy")
    labels = _header_labels(spark, sf)
    return monthly.withColumn("_label", label).groupBy(place).pivot("_label", labels).agg(F.first(measure))


# -- facts of cases ---------------------------------------------------------


@query
def q2_topk_state(spark, sf):
    """Q2: F6, F9, O2 over A1."""
    return dashboard.top_places_of_days(views.state_daily(spark, sf), "state", dt.date(2000, 6, 30), 10)


@query
def q3_topk_country(spark, sf):
    """Q3: the end date lies beyond the data and is clamped."""
    per_day = aggregate.sum_by(views.county_daily(spark, sf), ["country", "date"], cases.COUNTS)
    return dashboard.top_places_of_days(per_day, "country", BEYOND, 3)


@query
def state_daily_fact(spark, sf):
    """A1, D2, W1, W3."""
    return present(cases.state_fact(views.county_daily(spark, sf), entity="state"))


@query
def state_totals_sql(spark, sf):
    """SQL text over a named frame."""
    counties = views.county_daily(spark, sf)
    text = """
        SELECT state, year(date) AS year, sum(confirmed) AS confirmed, sum(deaths) AS deaths
        FROM {counties} GROUP BY state, year(date) ORDER BY state, year(date)
    """
    return spark.sql(text, counties=counties)


@query
def country_daily_fact(spark, sf):
    """A8, D2, W1, W3."""
    return present(cases.country_fact(_country_cumulative(spark, sf), entity="country"))


@query
def state_monthly_fact(spark, sf):
    """A3, D3-D5, W1, W3."""
    return present(cases.monthly_fact(_state_cumulative(spark, sf), "state"))


@query
def country_monthly_fact(spark, sf):
    """A3, D3-D5, W1, W3."""
    return present(cases.monthly_fact(_country_cumulative(spark, sf), "country"))


@query
def totals_daily(spark, sf):
    """A2 twice in one pass, W2, W3."""
    return present(_totals(spark, sf))


@query
def totals_daily_bucketed(spark, sf):
    """W2 by month buckets: equal to ``totals_daily`` without a single-task sort of all days."""
    return present(_totals(spark, sf, bucketed=True))


@query
def totals_monthly(spark, sf):
    """A4, D3-D5, W2, W3."""
    return present(cases.totals_monthly(_totals(spark, sf)))


@query
def totals_join(spark, sf):
    """B8 with two sources: A2 twice, J3, W2, W3."""
    orders = views.table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.floor("o_totalprice").alias("confirmed"),
        (F.col("o_orderstatus") == "F").cast("long").alias("deaths"),
    )
    lines = views.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").cast("long").alias("confirmed"),
        (F.col("l_returnflag") == "R").cast("long").alias("deaths"),
    )
    keyed = [df.withColumn("dateid", dates.dateid(F.col("date"))) for df in (orders, lines)]
    return present(cases.totals_fact(*keyed))


@query
def counts_join(spark, sf):
    """Inner join of two measures on (place, date)."""
    confirmed, deaths = _nation_daily(spark, sf)
    joined = joins.join_measures(deaths, confirmed, ["uid", "date"], ["confirmed"])
    return present(joined.select("uid", "date", "confirmed", "deaths"))


# -- markets ----------------------------------------------------------------


@query
def index_daily_ffill(spark, sf):
    """Leading nulls stay."""
    return present(windows.forward_fill(views.index_daily(spark, sf), markets.SCORES, "date"))


@query
def index_daily_ffill_bucketed(spark, sf):
    """W4 by month buckets: equal to ``index_daily_ffill``."""
    bucket = dates.month_number(F.col("date"))
    return present(windows.forward_fill(views.index_daily(spark, sf), markets.SCORES, "date", bucket=bucket))


@query
def index_daily_ffill0(spark, sf):
    """W5 (B12): leading nulls become 0."""
    own = {score: score for score in markets.SCORES}
    return present(markets.index_fact(views.index_daily(spark, sf), columns=own))


@query
def index_monthly_avg(spark, sf):
    """A5, D3-D5."""
    return present(markets.index_monthly(views.index_daily(spark, sf)), 7)


@query
def price_fact(spark, sf):
    """D2, P1."""
    return present(markets.price_fact(views.price_daily(spark, sf)))


@query
def price_monthly(spark, sf):
    """A6, D3-D5."""
    return present(markets.price_monthly(views.price_daily(spark, sf)), 7)


# -- consolidated facts -----------------------------------------------------


@query
def cases_index_daily(spark, sf):
    """J4, W4, then F4."""
    daily_rows = _cases_index(spark, sf)
    return present(incremental.increment(daily_rows, START))


@query
def cases_index_monthly(spark, sf):
    """A7, W2, W3."""
    return present(_cases_index_monthly(spark, sf), 7)


@query
def cases_index_series_monthly(spark, sf):
    """J5, N2, D5."""
    return present(_cases_index_series(spark, sf), 7)


# -- reshaping --------------------------------------------------------------


@query
def unpivot_index(spark, sf):
    """R1."""
    return present(reshape.unpivot(views.index_daily(spark, sf), ["date"], "series", "score"))


@query
def explode_struct_index(spark, sf):
    """The rows of R1 from an exploded array of structs."""
    return present(reshape.unpivot_structs(views.index_daily(spark, sf), ["date"], "series", "score"))


@query
def unpivot_series(spark, sf):
    """R2: wide series to (date, dateid, series_id, value)."""
    return present(reshape.series_to_long(views.series_wide(spark, sf)))


@query
def wide_date_slice(spark, sf):
    """The date columns of ``(latest, end]`` of a wide frame, then long."""
    wide = _wide(spark, sf, _state_cumulative(spark, sf), "state", "confirmed")
    sliced = reshape.slice_dates(wide, ["state"], *SLICE)
    long = reshape.unpivot(sliced, ["state"], "label", "confirmed")
    dated = select.having(long, "confirmed").withColumn("date", dates.header_date(F.col("label")))
    return present(dated.select("state", "date", "confirmed"))


@query
def wide_counts_join(spark, sf):
    """Two wide frames joined on the place, both measures unpivoted together."""
    cumulated = _country_cumulative(spark, sf)
    deaths, confirmed = (_wide(spark, sf, cumulated, "country", m) for m in ("deaths", "confirmed"))
    header = reshape.dates_in_range(deaths.columns)
    long = cases.counts_by_day(deaths, confirmed, "country", ["country"], header)
    return present(select.having(long, "confirmed"))


# -- series -----------------------------------------------------------------


@query
def series_dedup(spark, sf):
    """A8, D7, A9."""
    return present(labour.series_fact(views.series_raw(spark, sf)))


@query
def series_arrays(spark, sf):
    """Q5: F3, F5, F7, K6; the arrays as JSON text (K5)."""
    named = _series(spark, sf).withColumnsRenamed({"series_id": "bol_series_id", "value": "bol_series_value"})
    arrays = dashboard.series_values(named, START, END, ["A-F", "N-O", "R-F"], views.order_days(spark, sf))
    texts = F.transform("date", lambda d: dates.iso_text(d))
    whole = F.transform("bol_series_value", lambda v: v.cast("long"))
    return arrays.select("bol_series_id", F.to_json(texts).alias("dates"), F.to_json(whole).alias("numbers"))


@query
def distinct_cases_range(spark, sf):
    """Q4: F5, A8, O1."""
    return present(dashboard.monthly_cases(_cases_index_series(spark, sf), START, END, views.order_days(spark, sf)))


@query
def daily_range(spark, sf):
    """Q1: F9, F5, O1."""
    return present(dashboard.cases_and_indexes(_cases_index(spark, sf), START, END, views.order_days(spark, sf)))


@query
def daily_range_arrays(spark, sf):
    """Q1 for charts: K6 in one pass."""
    row = dashboard.cases_and_indexes_arrays(_cases_index(spark, sf), START, END, views.order_days(spark, sf))
    numbers = ("us_confirmed", "us_deaths_inc", "global_confirmed_inc")
    texts = F.transform("date", lambda d: dates.iso_text(d))
    return row.select(F.to_json(texts).alias("dates"), *(F.to_json(c).alias(c) for c in numbers))


@query
def drilldown_day(spark, sf):
    """Q6: F6."""
    return present(dashboard.day_details(_state_cumulative(spark, sf), dt.date(1999, 3, 9)))


@query
def rows_json(spark, sf):
    """K5: every monthly row as JSON."""
    monthly = cases.monthly_fact(_country_cumulative(spark, sf), "country")
    shown = monthly.select("country", dates.iso_text(F.col("date")).alias("date"), "confirmed", "deaths_inc")
    return reshape.as_json(shown)


@query
def formatted_counts(spark, sf):
    """T3."""
    cumulated = _state_cumulative(spark, sf)
    return present(cumulated.select("state", "date", values.thousands(F.col("confirmed")).alias("confirmed")))


@query
def peak_month(spark, sf):
    """Q7: peak of new cases against the peak of every series."""
    return present(dashboard.peak_months(_series(spark, sf), _cases_index_monthly(spark, sf)))


@query
def series_dim_rank(spark, sf):
    """Q8: J7, averages, both ends of the ranking."""
    dim = _series_dim(spark, sf)
    return present(dashboard.extreme_groups(_series(spark, sf), dim, START, END, "returned"), 7)


def _series_dim(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension of the series that occur, described from their ids."""
    ids = views.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    return ids.select(
        F.concat("l_returnflag", F.lit("-"), "l_linestatus").alias("series_id"),
        F.lit("lineitem").alias("category"),
        F.when(F.col("l_returnflag") == "N", "kept").otherwise("returned").alias("subcat1"),
        F.concat(F.lit("flag "), "l_returnflag", F.lit(", status "), "l_linestatus").alias("subcat2"),
    )


@query
def pct_vs_base(spark, sf):
    """Q9: mean of a period against the mean before it."""
    return present(dashboard.change_from_base(_series(spark, sf), START, END, ["series_id"]), 7)


@query
def corr_by_series(spark, sf):
    """Q10: correlation with new cases and with the indexes."""
    measures = ["us_confirmed_inc", "global_confirmed_inc", *markets.SCORES]
    return present(dashboard.correlations(_series(spark, sf), _cases_index_monthly(spark, sf), measures), 6)


@query
def country_enrich(spark, sf):
    """Totals per nation with a column of the country table."""
    counts = views.county_daily(spark, sf).groupBy(F.col("state").alias("Country_Region"))
    totals = counts.agg(F.sum("confirmed").alias("confirmed"))
    nations = views.table(spark, sf, "nation").join(
        views.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    countries = nations.select(F.col("n_name").alias("Name"), F.col("r_name").alias("Continent"))
    return joins.enrich_countries(totals, countries, "Country_Region", ["Continent"])


# -- filters, dates, values -------------------------------------------------


@query
def null_filter(spark, sf):
    """F1, F2, A10: rows without and with each level."""
    index = views.index_daily(spark, sf)
    rows = reshape.unpivot(index, ["date"], "series", "score")
    return rows.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("score").isNull()).alias("n_without"),
        F.count("score").alias("n_with"),
    )


@query
def days_without_level(spark, sf):
    """days on which one index has no level."""
    return present(select.without(views.index_daily(spark, sf), "dowjones_score").select("date", "sp500_score"))


@query
def conditional_column(spark, sf):
    """A level replaced where a condition holds."""
    index = views.index_daily(spark, sf)
    marked = select.replace_where(index, "sp500_score", F.col("dowjones_score").isNull(), -1.0)
    return present(marked.select("date", "sp500_score"))


@query
def zero_fill(spark, sf):
    """Nulls of named columns become 0, others stay."""
    return present(values.zero_nulls(views.index_daily(spark, sf), ["dowjones_score", "sp500_score"]))


@query
def latest_date(spark, sf):
    """O3."""
    return present(select.latest_date(views.index_daily(spark, sf)))


@query
def calendar_days(spark, sf):
    """Days of the calendar on which no market was open."""
    index = views.index_daily(spark, sf).select("date")
    span = index.agg(F.min("date").alias("first"), F.date_add(F.max("date"), 1).alias("end"))
    days = span.select("first", F.explode(dates.days_between(F.col("first"), F.col("end"))).alias("date"))
    closed = days.join(index, "date", "left_anti")
    return present(
        closed.select(
            "date",
            F.datediff("date", "first").alias("day_no"),
            dates.same_month(F.col("date"), F.date_add("date", 7)).alias("week_in_month"),
        )
    )


@query
def date_keys(spark, sf):
    """Every date function over every order date."""
    day = F.col("o_orderdate").cast("date")
    days = views.table(spark, sf, "orders").select(day.alias("date")).distinct()
    label = F.date_format(F.add_months("date", SHIFT_MONTHS), "M/d/yy")
    year, month = F.year("date"), F.month("date")
    keys = days.select(
        "date",
        label.alias("label"),
        dates.header_date(label).alias("from_label"),
        dates.dateid(F.col("date")).alias("dateid"),
        dates.first_of_month(year, month).alias("month_start"),
        dates.first_dateid(year, month).alias("month_dateid"),
        dates.month_name(F.col("date")).alias("month_name"),
        dates.period_date(year, views.period(month)).alias("from_period"),
        dates.iso_date(dates.iso_text(F.col("date"))).alias("from_iso"),
        F.datediff("date", F.lit(dt.date(1995, 1, 1))).alias("day_no"),
        F.date_add("date", 30).alias("in_30_days"),
        dates.same_day(F.col("date"), F.date_add("date", 0)).alias("same_day"),
    )
    return present(keys)


@query
def parsed_values(spark, sf):
    """Parts of texts as numbers, null when they are none."""
    part = views.table(spark, sf, "part")
    number = F.substring_index("p_brand", "#", -1)
    return part.select(
        "p_partkey",
        values.words(F.col("p_name"))[0].alias("first_word"),
        values.parse_int(number).alias("brand_no"),
        values.parse_double(F.concat(number, F.lit(".5"))).alias("brand_half"),
        values.parse_int(F.col("p_type")).alias("no_number"),
        values.strip_newline(F.concat("p_name", F.lit("\n"))).alias("name"),
    )


# -- nested text and markup -------------------------------------------------


@query
def json_props(spark, sf):
    """A field of a JSON column, counted."""
    props = F.from_json("props", "struct<k: int>")
    counts = views.table(spark, sf, "events").groupBy("event_type", props["k"].alias("k"))
    return counts.agg(F.count(F.lit(1)).alias("n"))


@query
def json_nested_flatten(spark, sf):
    """Documents as nested series, one observation per line, and flat again."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            (2000 + i % 20).cast("string").alias("year"),
            views.period(i % 13 + 1).alias("period"),
            F.length(line).cast("string").alias("value"),
            F.array(
                F.struct(F.col("source").alias("text")),
                F.struct(F.lit(None).cast("string").alias("text")),
                F.struct(F.col("lang").alias("text")),
            ).alias("footnotes"),
        ),
    )
    one = F.struct(F.col("doc_id").cast("string").alias("seriesID"), lines.alias("data"))
    doc = F.struct(F.struct(F.array(one).alias("series")).alias("Results"))
    texts = views.table(spark, sf, "documents").select(F.to_json(doc).alias("json"))
    return nested.flatten_series(texts)


@query
def html_rows(spark, sf):
    """The linked list items of every page."""
    return markup.link_rows(views.table(spark, sf, "pages"), "html", ["page_id"])


@query
def html_tickers(spark, sf):
    """S6 (B10): ticker tables, written from the parts and read back."""
    cells = ["p_brand", "p_name", F.lit("reports"), "p_type", F.lit("a &amp; b"), "p_name", F.lit("2001")]

    def row(ticker, founded):
        tds = [ticker, *cells[1:], F.col("p_partkey").cast("string"), founded]
        return F.concat(F.lit("<tr>"), *(F.concat(F.lit("<td>"), c, F.lit("\n</td>")) for c in tds), F.lit("</tr>"))

    ticker = F.concat("p_brand", F.lit("-"), F.col("p_partkey").cast("string"))
    page = F.concat(
        F.lit("<html><table><tr><td>other</td></tr></table>"),
        F.lit('<table class="wikitable sortable"><tr><th>Symbol</th><th>Security</th></tr>'),
        row(ticker, (F.col("p_size") + 1900).cast("string")),
        row(F.concat(F.lit("<b>X</b>"), ticker), F.lit("unknown")),
        F.lit("</table></html>"),
    )
    return markup.ticker_rows(views.table(spark, sf, "part").select(page.alias("html")))


# -- increments -------------------------------------------------------------


@query
def incremental_equals_full(spark, sf):
    """I4: a first load, then an increment with seeded differences, equals one full load."""
    raw = views.county_daily(spark, sf)
    first = cases.state_fact(incremental.increment(raw, None, SPLIT), entity="state")
    later = cases.state_fact(incremental.increment(raw, SPLIT, BEYOND), stored=first, entity="state")
    return present(first.unionByName(later))


@query
def month_upsert(spark, sf):
    """Touched months recomputed beside stored ones equal a full recompute."""
    days = _state_cumulative(spark, sf)
    how = dict.fromkeys(cases.COUNTS, "max")
    before = incremental.increment(days, None, SPLIT)
    earlier = incremental.upsert_months(before, None, None, how, cases.COUNTS, ["state"])
    touched = incremental.upsert_months(days, earlier, SPLIT, how, cases.COUNTS, ["state"])
    kept = earlier.filter(F.col("date") < F.trunc(F.date_add(F.lit(SPLIT), 1), "MM"))
    return present(kept.unionByName(touched))


@query
def high_water_marks(spark, sf):
    """Marks from the data, one moved, one added."""
    sources = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    marks = None
    for name, column in sources.items():
        latest = views.table(spark, sf, name).agg(F.to_date(F.max(column)).cast("timestamp").alias("latest_date"))
        row = latest.select(F.lit(name).alias("table_name"), "latest_date")
        marks = row if marks is None else marks.unionByName(row)
    marks = incremental.set_mark(marks, "orders", dt.date(2002, 2, 2))
    marks = incremental.set_mark(marks, "country_dim", dt.date(2002, 3, 3))
    return marks.select("table_name", dates.iso_text(F.col("latest_date")).alias("latest"))


@query
def stream_equals_batch(spark, sf):
    """I8: the events as a file stream equal the batch result."""
    # the table may be one file or a folder of files
    return _streamed(spark, views.table(spark, sf, "events").schema, f"{sf}/events.parquet*", None)


@query
def stream_many_files(spark, sf):
    """I8: events in several files, one file per micro-batch, every file with parts of every day."""
    events = views.table(spark, sf, "events")
    folder = scratch_folder(spark, "landed")
    events.repartition(5, "event_id").write.parquet(folder)
    return _streamed(spark, events.schema, folder, 1)


def _streamed(spark, schema, folder, files_per_batch):
    target, state = scratch_folder(spark, "stream"), scratch_folder(spark, "stream-state")
    daily.process_new_files(
        spark,
        folder,
        schema,
        lambda batch, number: daily.store_batch(daily.daily_counts(batch), target, number),
        state,
        files_per_batch=files_per_batch,
        numbered=True,
    )
    return present(daily.summed_batches(spark, target, ["event_type", "date"], ["n", "cents"]))


@query
def user_event_diff(spark, sf):
    """W1, W3, W4 on rows: the event before of each user, in buckets of bounded size.

    Event ids grow with time, so a bucket of 1,000 ids holds no more rows than
    that, however many events one user has. Both values travel in one pass.
    """
    bucket = F.expr("event_id DIV 1000")
    errors = F.when(F.col("event_type") == "error", F.col("value"))
    events = views.table(spark, sf, "events").select("event_id", "user_id", "value", errors.alias("last_error"))
    both = windows.previous_values(events, {"value": "_before"}, "event_id", bucket, ["user_id"], ["last_error"])
    return present(windows.with_differences(both, {"value": "_before"}).drop("_before"))


# -- files, loads and marks ----------------------------------------------------


def _warehouse(spark, names) -> Warehouse:
    wh = Warehouse(spark, scratch_folder(spark, "warehouse"))
    wh.reset(names)
    return wh


def _csv(df: DataFrame, sep: str = ",") -> str:
    """One landed CSV file with a header."""
    folder = scratch_folder(df.sparkSession, "landed")
    df.coalesce(1).write.option("header", True).option("sep", sep).csv(folder)
    return folder


def _county_files(spark, sf) -> tuple[str, str]:
    """Month-end counts of the nations as the wide files of counties: confirmed, deaths."""
    cumulated = _state_cumulative(spark, sf)
    nations = views.table(spark, sf, "nation").join(
        views.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    place = nations.select(
        F.col("n_name").alias("state"),
        (F.col("n_nationkey") + 84000000).alias("UID"),
        F.lit("US").alias("iso2"),
        F.lit("USA").alias("iso3"),
        F.lit(840).alias("code3"),
        F.col("n_nationkey").cast("double").alias("FIPS"),
        F.concat(F.lit("county, "), "n_name").alias("Admin2"),
        F.col("n_name").alias("Province_State"),
        F.col("r_name").alias("Country_Region"),
        F.lit(32.5).alias("Lat"),
        F.lit(-86.6).alias("Long_"),
        F.concat("n_name", F.lit(", US")).alias("Combined_Key"),
        F.lit(1000).alias("Population"),
    )
    files = []
    for measure in cases.COUNTS:
        wide = _wide(spark, sf, cumulated, "state", measure).na.fill(0)
        ids = place if measure == "deaths" else place.drop("Population")
        files.append(_csv(ids.join(wide, "state").drop("state")))
    return files[0], files[1]


US_TABLES = ("covid19_us_raw", "covid19_us_dim", "covid19_us_fact", "covid19_us_monthly_fact")


@query
def county_files_loaded(spark, sf):
    """Wide files loaded in two steps by their marks, the second one repeated."""
    confirmed, deaths = _county_files(spark, sf)
    wh = _warehouse(spark, US_TABLES)
    for end in (SLICE[0], SLICE[1], SLICE[1]):
        cases.extract_us(wh, confirmed, deaths, end)
        cases.transform_raw_to_fact_us(wh)
    return present(wh.read("covid19_us_fact"))


def _global_files(spark, sf) -> tuple[str, str]:
    """Month-end counts as the wide files of countries: confirmed, deaths.

    A country has a row of its own and one per province, which the loads leave out; one has no position.
    """
    nations = views.table(spark, sf, "nation").join(
        views.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    provinces = nations.select(F.col("n_name").alias("state"), F.col("r_name").alias("Country/Region"))
    files = []
    for measure in cases.COUNTS:
        whole = _wide(spark, sf, _country_cumulative(spark, sf), "country", measure).na.fill(0)
        parts = _wide(spark, sf, _state_cumulative(spark, sf), "state", measure).na.fill(0)
        whole = whole.withColumnRenamed("country", "Country/Region").withColumn("Province/State", F.lit(None).cast("string"))
        parts = parts.join(provinces, "state").withColumnRenamed("state", "Province/State")
        nowhere = whole.limit(1).withColumn("Country/Region", F.lit("nowhere, at sea")).withColumn("Lat", F.lit(None).cast("double"))
        rows = whole.unionByName(parts).withColumn("Lat", F.lit(41.15)).unionByName(nowhere)
        files.append(_csv(rows.withColumn("Long", F.lit(-20.5))))
    return files[0], files[1]


GLOBAL_TABLES = ("covid19_global_raw", "covid19_global_dim", "covid19_global_fact", "covid19_global_monthly_fact")


@query
def global_files_loaded(spark, sf):
    """Wide files of countries loaded in two steps by their marks, then months."""
    confirmed, deaths = _global_files(spark, sf)
    wh = _warehouse(spark, GLOBAL_TABLES)
    for end in SLICE:
        cases.extract_global(wh, confirmed, deaths, end)
        cases.transform_raw_to_fact_global(wh)
        cases.aggregate_fact_to_monthly_fact_global(wh)
    return present(wh.read("covid19_global_monthly_fact"))


class _LostBefore(Warehouse):
    """A warehouse whose driver is lost when the index levels are to be stored."""

    def load(self, name: str, new: DataFrame) -> dict[str, object]:
        if name == "stock_index_fact":
            raise InterruptedError(name)
        return super().load(name, new)


@query
def whole_run_resumed(spark, sf):
    """Every job in order from landed files of counties, countries and indexes; lost midway, run again, then a later day."""
    us, world = _county_files(spark, sf), _global_files(spark, sf)
    levels = views.index_daily(spark, sf).withColumn("date", F.add_months("date", SHIFT_MONTHS))
    series = {score: name for name, score in markets.INDEX_COLUMNS.items()}
    landed = Landed(*us, *world, indexes=_csv(levels.withColumnsRenamed(series)))
    wh = _warehouse(spark, tuple(TABLES))
    try:
        load_all(_LostBefore(spark, wh.root), landed, SLICE[0])
    except InterruptedError:
        pass  # the jobs before have stored their tables and marks
    else:
        raise AssertionError("the first run was not lost")
    for end in SLICE:
        load_all(wh, landed, end)
    return present(wh.read("covid_stock_fact"))


@query
def country_file_loaded(spark, sf):
    """A file with ``;`` to the country dimension."""
    nation = views.table(spark, sf, "nation").join(
        views.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    number = F.col("n_nationkey")
    given = {
        "code": F.format_string("%03d", number), "Name": F.col("n_name"), "Continent": F.col("r_name"),
        "SurfaceArea": number * 1.5, "IndepYear": number + 1900, "Population": number * 1000, "Capital": number,
    }
    columns = [given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in TABLES["country_dim"].schema]
    wh = _warehouse(spark, ["country_dim"])
    cases.transform_raw_to_dim_country(wh, _csv(nation.select(*reversed(columns)), ";"))
    return wh.read("country_dim").select("code", "Name", "Continent", "SurfaceArea", "IndepYear", "Population", "Capital")


@query
def series_file_loaded(spark, sf):
    """A wide file of series, for the series of the stored dimension, in two steps."""
    wide = views.series_wide(spark, sf)
    wh = _warehouse(spark, ["bol_series_dim", "bol_series_fact"])
    ids = [c for c in wide.columns if c not in ("date", "A-F")]
    wh.replace("bol_series_dim", spark.createDataFrame([(c, "flag", None, None) for c in ids], TABLES["bol_series_dim"].schema))
    path = _csv(wide)
    for end in (SPLIT, BEYOND):
        labour.extract_BOL(wh, path, end)
    return present(wh.read("bol_series_fact"))


@query
def series_answers_loaded(spark, sf):
    """Raw rows as JSON answers, stored once each, to one value per series and month."""
    raw = views.series_raw(spark, sf)
    points = F.collect_set(F.struct(F.col("year").cast("string").alias("year"), "period",
                                    F.col("value").cast("string").alias("value"),
                                    F.array().cast("array<struct<text:string>>").alias("footnotes")))
    series = raw.groupBy(F.col("series_id").alias("seriesID")).agg(points.alias("data"))
    answer = series.agg(F.struct(F.collect_list(F.struct("seriesID", "data")).alias("series")).alias("Results"))
    folder = scratch_folder(spark, "answers")
    answer.select(F.to_json(F.struct("Results"))).coalesce(1).write.text(folder)
    wh = _warehouse(spark, ["bol_series_raw", "bol_series_fact"])
    for _ in range(2):
        labour.extract_series_json(wh, folder)
    labour.transform_raw_to_fact_bol(wh, BEYOND)
    return present(wh.read("bol_series_fact"))


@query
def text_list_round_trip(spark, sf):
    """A text list written and read back."""
    folder = scratch_folder(spark, "list")
    write_text_list(views.table(spark, sf, "part").select("p_brand").distinct(), "p_brand", folder)
    return files.read_text_list(spark, folder, "ticker")


def _market_rows(spark, sf) -> DataFrame:
    market = views.index_daily(spark, sf).withColumn("dateid", dates.dateid(F.col("date")))
    return windows.forward_fill(market, markets.SCORES, "date", initial=0.0)


MARKET_TABLES = ("covid19_sum_fact", "stock_index_fact", "covid_stock_fact", "covid_stock_monthly_fact")


def _loaded_part(wh: Warehouse, name: str, rows: DataFrame, low: dt.date | None, end: dt.date) -> None:
    """Rows in (low, end] of a table that other jobs fill, with their mark."""
    wh.load(name, incremental.increment(rows, low, end))
    steps.finished(wh, name, steps.Bounds(low, end))


@query
def late_index_equals_full(spark, sf):
    """Cases consolidated while the index lags, and again when it has come, equal one full load."""
    wh = _warehouse(spark, MARKET_TABLES)
    market = stored(_market_rows(spark, sf), "market")
    _loaded_part(wh, "covid19_sum_fact", _totals(spark, sf), None, END)
    _loaded_part(wh, "stock_index_fact", market, None, SPLIT)
    consolidate.consolidate_covid_stock(wh)
    _loaded_part(wh, "stock_index_fact", market, SPLIT, END)
    consolidate.consolidate_covid_stock(wh)
    return present(wh.read("covid_stock_fact"))


@query
def late_series_equals_full(spark, sf):
    """Series that come after the cases are beside them, whatever came first."""
    wh = _warehouse(spark, (*MARKET_TABLES, "bol_series_fact", "covid_stock_bol_monthly_fact"))
    series = stored(_series(spark, sf), "series")
    _loaded_part(wh, "stock_index_fact", _market_rows(spark, sf), None, END)
    _loaded_part(wh, "covid19_sum_fact", _totals(spark, sf), None, END)
    _loaded_part(wh, "bol_series_fact", series, None, SPLIT)
    for low, end in ((None, None), (SPLIT, END)):
        if end is not None:
            _loaded_part(wh, "bol_series_fact", series, low, end)
        consolidate.consolidate_covid_stock(wh)
        consolidate.aggregate_covid_stock_monthly_fact(wh)
        consolidate.consolidate_covid_stock_bol(wh)
    kept = ("date", "bol_series_id", "bol_series_value", "us_confirmed", "global_deaths_inc", "sp500_score")
    return present(wh.read("covid_stock_bol_monthly_fact").select(*kept), 7)


@query
def warehouse_marks(spark, sf):
    """Marks set from the data, one table reset, read back."""
    wh = _warehouse(spark, US_TABLES)
    last = {
        name: views.table(spark, sf, source).agg(F.max(F.col(column).cast("date"))).first()[0]
        for name, source, column in (("covid19_us_raw", "orders", "o_orderdate"), ("covid19_us_fact", "lineitem", "l_shipdate"),
                                     ("covid19_us_dim", "events", "ts"))
    }
    wh.set_marks(last)
    wh.reset(["covid19_us_dim"])
    marks = wh.read("latest_data").filter(F.col("table_name").isin(*US_TABLES))
    return marks.select("table_name", dates.iso_text(F.col("latest_date")).alias("latest"))


PRICE_START, PRICE_SPLIT, PRICE_END = dt.date(1998, 1, 15), dt.date(1998, 2, 10), dt.date(1998, 3, 10)
PRICE_LOADS = ("stock_ticker_raw", "stock_price_raw", "stock_price_fact", "stock_price_monthly_fact")


def _prices(spark, sf) -> DataFrame:
    ticker = F.translate("stock_ticker", "#", "")
    return stored(views.price_daily(spark, sf).withColumn("stock_ticker", ticker), "prices")


def _price_lines(prices: DataFrame, high=None) -> DataFrame:
    """(stock_ticker, line) of price files; their headers are lines as well."""
    high = F.col("High").cast("string") if high is None else high
    values = [F.col(c).cast("string") for c in ("Low", "Open", "Close", "Volume", "adj_close")]
    lines = prices.select("stock_ticker", F.concat_ws(",", dates.iso_text(F.col("date")), high, *values).alias("line"))
    header = F.lit(",".join(PRICE_COLUMNS)).alias("line")
    return lines.unionByName(prices.select("stock_ticker").distinct().select("stock_ticker", header))


def _land_prices(lines: DataFrame, folder: str) -> None:
    """One ``<ticker>.csv`` per ticker in a folder, over earlier ones of the same tickers."""
    folders, fresh = Folders(lines.sparkSession), scratch_folder(lines.sparkSession, "landing")
    lines.repartition("stock_ticker").write.partitionBy("stock_ticker").text(fresh)
    for part in folders.names(fresh):
        (file,) = (f for f in folders.files(f"{fresh}/{part}") if f.startswith("part-"))
        folders.move(f"{fresh}/{part}/{file}", f"{folder}/{part.partition('=')[2]}.csv")


def _some(share: int):
    return F.substring("stock_ticker", 6, 9).cast("int") % share == 0  # of Brand<number>


@query
def price_merge(spark, sf):
    """Files of some tickers come late, one day is loaded again for a few; no row is lost."""
    prices, folder, errors = _prices(spark, sf), scratch_folder(spark, "landed"), scratch_folder(spark, "errors")
    wh = _warehouse(spark, PRICE_LOADS)
    for part in (~_some(3), _some(3)):
        _land_prices(_price_lines(prices.filter(part)), folder)
        markets.extract_batch_stock(wh, folder, errors, PRICE_SPLIT, start=PRICE_START)
    few = scratch_folder(spark, "few")
    write_text_list(prices.filter(_some(5)).select("stock_ticker").distinct(), "stock_ticker", few)
    markets.extract_single_date_stock(wh, folder, errors, dt.date(1998, 2, 2), few)
    markets.extract_batch_stock(wh, folder, errors, PRICE_END)
    return present(wh.read("stock_price_raw"))


@query
def late_ticker_equals_full(spark, sf):
    """A file that comes when all others have been loaded, without looking back."""
    prices, folder, errors = _prices(spark, sf), scratch_folder(spark, "landed"), scratch_folder(spark, "errors")
    wh = _warehouse(spark, PRICE_LOADS)
    for part in (~_some(4), _some(4)):
        _land_prices(_price_lines(prices.filter(part)), folder)
        markets.extract_batch_stock(wh, folder, errors, PRICE_END, start=PRICE_START)
        markets.transform_raw_to_fact_stock(wh)
        markets.aggregate_fact_to_monthly_fact_stock(wh)
    return present(wh.read("stock_price_monthly_fact").drop("dateid", "year", "month", "month_name"), 7)


@query
def price_quarantine(spark, sf):
    """Broken lines of files loaded twice, then of some files that have been mended."""
    prices, folder, errors = _prices(spark, sf), scratch_folder(spark, "landed"), scratch_folder(spark, "errors")
    day = F.dayofmonth("date")
    high = F.when(day == 7, "oops").when(day == 9, "1,2").otherwise(F.col("High").cast("string"))
    wh = _warehouse(spark, PRICE_LOADS)
    for lines in (_price_lines(prices, high), None, _price_lines(prices.filter(_some(3)))):
        if lines is not None:
            _land_prices(lines, folder)
        markets.extract_batch_stock(wh, folder, errors, PRICE_SPLIT, start=PRICE_START)
    broken = spark.read.schema("stock_ticker string, broken string").json(f"{errors}/broken_lines")
    first = F.substring("broken", 1, 10)
    stored_rows = wh.read("stock_price_raw").groupBy("stock_ticker").agg(F.count(F.lit(1)).alias("n_stored"))
    told = broken.groupBy("stock_ticker").agg(
        F.count(F.lit(1)).alias("n_broken"), F.min(first).alias("first"), F.max(first).alias("last")
    )
    return stored_rows.join(told, "stock_ticker", "left").na.fill(0, ["n_broken"])


# -- quality ----------------------------------------------------------------


@query
def pk_violations(spark, sf):
    """DQ2: keys that occur more than once."""
    return quality.duplicate_keys(views.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def fk_orphans(spark, sf):
    """DQ3: users of events that are no supplier, with their rows."""
    events, supplier = views.table(spark, sf, "events"), views.table(spark, sf, "supplier")
    return quality.orphans(events, "user_id", supplier, "s_suppkey")


@query
def missing_entities(spark, sf):
    """Documents for which no label arrived."""
    documents = views.table(spark, sf, "documents").select("doc_id")
    return quality.missing_entities(documents, views.table(spark, sf, "labels"), "doc_id")


@query
def column_report(spark, sf):
    """DQ2: NOT NULL and length checks of a fact in one pass."""
    index = views.index_daily(spark, sf).withColumn("month_name", dates.month_name(F.col("date")))
    return quality.column_report(index, ["date", *markets.SCORES], {"month_name": 6})
