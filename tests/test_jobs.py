"""The load jobs end to end on landed files: one run, several runs, repeated runs."""

from __future__ import annotations

import datetime as dt

import landed
import pytest
from pyspark.sql import functions as F
from tidemark import __main__ as command
from tidemark.operators.quality import duplicate_keys, orphans
from tidemark.plans import cases, dashboard, labour, markets
from tidemark.plans.run import Landed, load_all
from tidemark.schemas import TABLES
from tidemark.sinks.warehouse import Warehouse

LAST = landed.days()[-1]
MID_MONTH = dt.date(2020, 3, 5)
MONTH_END = dt.date(2020, 2, 29)

LOADED = [
    name for name in TABLES if name not in ("latest_data", "bol_series_raw", "country_dim", "bol_series_dim")
]


US_TABLES = ("latest_data", "covid19_us_raw", "covid19_us_dim", "covid19_us_fact", "covid19_us_monthly_fact")
PRICE_TABLES = ("latest_data", "stock_ticker_raw", "stock_price_raw")


def warehouse(spark, path, names=US_TABLES) -> Warehouse:
    wh = Warehouse(spark, str(path))
    wh.reset(names)
    return wh


def land(spark, folder) -> Landed:
    us_c, us_d = landed.us_files(folder)
    gl_c, gl_d = landed.global_files(folder)
    return Landed(
        us_confirmed=us_c,
        us_deaths=us_d,
        global_confirmed=gl_c,
        global_deaths=gl_d,
        countries=landed.country_file(folder),
        indexes=landed.index_file(folder),
        series=landed.series_file(folder),
        ticker_pages=spark.createDataFrame([(landed.ticker_page(),)], "html string"),
        prices=landed.price_files(folder),
        price_errors=str(folder / "errors"),
    )


@pytest.fixture(scope="module")
def loads(spark, tmp_path_factory):
    """The same files loaded at once, and in steps that end with and within a month."""
    folder = tmp_path_factory.mktemp("landed")
    files = land(spark, folder)
    once = Warehouse(spark, str(folder / "once"))
    once.reset()
    first_run = load_all(once, files, LAST)
    steps = Warehouse(spark, str(folder / "steps"))
    steps.reset()
    for end in (MID_MONTH, LAST):
        load_all(steps, files, end)
    return once, steps, files, first_run


def tuples(wh, name):
    def plain(value):
        # means of the same rows may differ in the last bit
        return round(value, 9) if isinstance(value, float) else value

    return sorted((tuple(map(plain, r)) for r in wh.read(name).collect()), key=repr)


def test_every_job_had_something_to_load(loads):
    assert all(loads[3].values())


@pytest.mark.parametrize("name", LOADED)
def test_stepwise_load_equals_full_load(loads, name):
    once, steps, *_ = loads
    full = tuples(once, name)
    assert full
    assert tuples(steps, name) == full


@pytest.mark.parametrize("name", list(TABLES))
def test_stored_tables_have_the_declared_schema(loads, name):
    df = loads[0].read(name)
    declared = TABLES[name].schema
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared]


@pytest.mark.parametrize("name", [n for n, t in TABLES.items() if t.key and n != "latest_data"])
def test_keys_are_unique_and_references_hold(loads, name):
    once = loads[0]
    table = TABLES[name]
    df = once.read(name)
    assert duplicate_keys(df, table.key).count() == 0
    for column, (parent, key) in table.references.items():
        assert orphans(df, column, once.read(parent), key).count() == 0


def test_second_run_loads_nothing(loads, spark):
    once, _, files, _ = loads
    before = {name: tuples(once, name) for name in LOADED}
    done = load_all(once, files, LAST)
    again = {"extract_major_stock_indexes", "extract_BOL", "extract_batch_stock"}
    assert not any(v for k, v in done.items() if k not in again)
    assert {name: tuples(once, name) for name in LOADED} == before


def test_marks_are_the_largest_loaded_dates(loads):
    marks = loads[0].marks()
    assert marks["covid19_us_raw"] == LAST
    assert marks["covid19_us_monthly_fact"] == LAST
    assert marks["bol_series_fact"] == dt.date(2020, 3, 1)
    assert marks["bol_series_raw"] == dt.date(1990, 1, 1)


def test_state_fact_values(loads):
    fact = loads[0].read("covid19_us_fact").filter("Province_State = 'Alabama'").orderBy("date").collect()
    assert len(fact) == landed.DAYS
    a, b = landed.COUNTIES[:2]
    for i, row in enumerate(fact):
        value = landed.confirmed(a, i) + landed.confirmed(b, i)
        before = landed.confirmed(a, i - 1) + landed.confirmed(b, i - 1) if i else 0
        assert row.confirmed == value
        assert row.confirmed_inc == value - before
        assert float(row.confirmed_inc_pct) == pytest.approx((value - before) * 100 / before if before else 0, abs=6e-6)
        assert row.dateid == int(f"{row.date:%Y%m%d}")


def test_increments_add_up_to_the_last_value(loads):
    fact = loads[0].read("covid19_global_fact")
    sums = fact.groupBy("Country_Region").agg(F.sum("confirmed_inc").alias("s"), F.max_by("confirmed", "date").alias("m"))
    assert sums.filter("s <> m").count() == 0


def test_countries_only_known_by_province_or_without_position_drop_out(loads):
    names = {r[0] for r in loads[0].read("covid19_global_raw").select("Country_Region").distinct().collect()}
    assert names == set(landed.COUNTRIES)
    assert {r[0] for r in loads[0].read("covid19_global_dim").select("Country_Region").collect()} == names


def test_totals_hold_every_state_and_country(loads):
    row = loads[0].read("covid19_sum_fact").filter(F.col("date") == LAST).collect()[0]
    i = landed.DAYS - 1
    assert row.us_confirmed == sum(landed.confirmed(c, i) for c in landed.COUNTIES)
    assert row.global_confirmed == sum(s + up * i for s, up, _ in landed.COUNTRIES.values())


def test_market_levels_are_filled_on_weekends_and_holidays(loads):
    rows = {r.date: r for r in loads[0].read("covid_stock_fact").collect()}
    assert len(rows) == landed.DAYS
    friday, sunday = dt.date(2020, 1, 31), dt.date(2020, 2, 2)
    assert rows[sunday].sp500_score == rows[friday].sp500_score == 3300.5 - 9
    assert rows[landed.FIRST].sp500_score == 0.0
    holiday = landed.days()[20]
    assert rows[holiday].dowjones_score == rows[holiday - dt.timedelta(days=1)].dowjones_score


def test_labour_months_without_cases_read_zero_and_keep_the_raw_value(loads):
    rows = loads[0].read("covid_stock_bol_monthly_fact").filter("bol_series_id = 'payems'").orderBy("date").collect()
    assert [r.date.isoformat()[:7] for r in rows] == ["2019-11", "2019-12", "2020-01", "2020-02", "2020-03"]
    assert rows[0].us_confirmed == 0 and rows[2].us_confirmed > 0
    assert (rows[2].bol_series_value, rows[2].bol_series_value_raw) == (0.0, None)
    assert rows[2].month_name == "January"


def test_prices_broken_lines_and_missing_tickers(loads, spark):
    once, _, files, _ = loads
    raw = once.read("stock_price_raw")
    assert {r[0] for r in raw.select("stock_ticker").distinct().collect()} == {"AAA", "BBB"}
    assert raw.filter("stock_ticker = 'BBB'").count() == 1
    monthly = once.read("stock_price_monthly_fact").filter("stock_ticker = 'AAA'").orderBy("date").collect()
    january = list(range(10))
    assert monthly[0].Volume == sum(1000 + i for i in january)
    assert monthly[0].High == pytest.approx(sum(10 + i for i in january) / 10)


def test_quarantine_files(spark, tmp_path):
    prices, errors = landed.price_files(tmp_path), str(tmp_path / "errors")
    wh = warehouse(spark, tmp_path / "wh", PRICE_TABLES)
    markets.extract_sp500_tickers(wh, spark.createDataFrame([(landed.ticker_page(),)], "html string"), str(tmp_path / "list"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "list")).collect()) == ["AAA", "BBB", "CCC"]
    assert markets.extract_batch_stock(wh, prices, errors, LAST)
    broken = spark.read.json(f"{errors}/broken_lines").collect()
    assert sorted(r.broken for r in broken)[-1] == "garbage"
    assert len(broken) == 3 and {r.stock_ticker for r in broken} == {"BBB"}
    assert [r[0] for r in spark.read.text(f"{errors}/no_rows").collect()] == ["CCC"]
    markets.extract_single_date_stock(wh, prices, errors, dt.date(2020, 1, 23), str(tmp_path / "list"))
    assert wh.read("stock_price_raw").filter("date = DATE'2020-01-23'").count() == 2
    assert wh.read("stock_price_raw").count() == landed.DAYS + 1


def test_ticker_table(loads):
    rows = {r.ticker: r for r in loads[0].read("stock_ticker_raw").collect()}
    assert set(rows) == {"AAA", "BBB", "CCC"}
    assert rows["AAA"].name == "A & A"
    assert (rows["AAA"].cik, rows["AAA"].founded_year) == ("0000000001", 1976)
    assert rows["BBB"].founded_year is None


def test_crash_between_data_and_mark_is_repaired_by_the_next_run(spark, tmp_path):
    us_c, us_d = landed.us_files(tmp_path)
    wh = warehouse(spark, tmp_path / "wh")
    cases.extract_us(wh, us_c, us_d, MID_MONTH)
    cases.transform_raw_to_fact_us(wh)
    cases.extract_us(wh, us_c, us_d, LAST)
    # the data of the next step is stored, but the run dies before the mark is set
    mark = wh.mark("covid19_us_fact")
    fact = cases.state_fact(wh.read("covid19_us_raw", after=mark), wh.read("covid19_us_fact", until=mark))
    wh.load("covid19_us_fact", fact)
    stored = tuples(wh, "covid19_us_fact")
    assert cases.transform_raw_to_fact_us(wh)
    assert tuples(wh, "covid19_us_fact") == stored
    assert wh.mark("covid19_us_fact") == LAST


def test_increments_that_end_with_a_month_equal_a_full_load(spark, tmp_path):
    us_c, us_d = landed.us_files(tmp_path)
    full, steps = (warehouse(spark, tmp_path / name) for name in ("full", "steps"))
    for wh, ends in ((full, [LAST]), (steps, [landed.FIRST, MONTH_END, LAST])):
        for end in ends:
            assert cases.extract_us(wh, us_c, us_d, end)
            assert cases.transform_raw_to_fact_us(wh)
            assert cases.aggregate_fact_to_monthly_fact_us(wh)
    for name in US_TABLES[1:]:
        assert tuples(steps, name) == tuples(full, name)


def test_lookback_loads_late_values(spark, tmp_path):
    us_c, us_d = landed.us_files(tmp_path)
    wh = warehouse(spark, tmp_path / "wh")
    cases.extract_us(wh, us_c, us_d, MID_MONTH)
    cases.transform_raw_to_fact_us(wh)
    cases.aggregate_fact_to_monthly_fact_us(wh)
    # a county is corrected some days back
    text = open(us_c).read().replace(",65,", ",999,")
    assert ",999," in text
    open(us_c, "w").write(text)
    cases.extract_us(wh, us_c, us_d, LAST, lookback_days=60)
    cases.transform_raw_to_fact_us(wh, lookback_days=60)
    cases.aggregate_fact_to_monthly_fact_us(wh, lookback_days=60)
    fresh = warehouse(spark, tmp_path / "fresh")
    cases.extract_us(fresh, us_c, us_d, LAST)
    cases.transform_raw_to_fact_us(fresh)
    cases.aggregate_fact_to_monthly_fact_us(fresh)
    for name in ("covid19_us_raw", "covid19_us_fact", "covid19_us_monthly_fact"):
        assert tuples(wh, name) == tuples(fresh, name)


def test_skip_first_leaves_out_leading_dates(spark, tmp_path):
    us_c, us_d = landed.us_files(tmp_path, 5)
    wh = warehouse(spark, tmp_path / "wh")
    cases.extract_us(wh, us_c, us_d, skip_first=1)
    assert wh.read("covid19_us_raw").agg(F.min("date")).collect()[0][0] == landed.days()[1]


def test_null_in_a_required_column_stops_the_load(spark, tmp_path):
    us_c, us_d = landed.us_files(tmp_path, 3)
    lines = open(us_c).read().splitlines()
    lines[1] = lines[1][: lines[1].rindex(",")] + ","
    open(us_c, "w").write("\n".join(lines) + "\n")
    wh = warehouse(spark, tmp_path / "wh")
    with pytest.raises(ValueError, match="null_confirmed"):
        cases.extract_us(wh, us_c, us_d)
    assert wh.mark("covid19_us_raw") == dt.date(1990, 1, 1)


def test_counts_beyond_32_bits_are_loaded(spark, tmp_path):
    add = 3_000_000_000

    def grown(path, places):
        head, *lines = open(path).read().splitlines()
        more = lambda line: [str(int(v) + add) for v in line.rsplit(",", 3)[1:]]
        lines = [",".join([line.rsplit(",", 3)[0], *more(line)]) if any(p in line for p in places) else line for line in lines]
        open(path, "w").write("\n".join([head, *lines]) + "\n")

    us, world = landed.us_files(tmp_path, 3), landed.global_files(tmp_path, 3)
    for path in us:
        grown(path, ["Alabama"])
    for path in world:
        grown(path, ["Italy"])
    wh = warehouse(spark, tmp_path / "wh", [n for n in TABLES if n.startswith(("latest", "covid19_us", "covid19_global"))])
    cases.extract_us(wh, *us)
    cases.transform_raw_to_fact_us(wh)
    cases.extract_global(wh, *world)
    cases.transform_raw_to_fact_global(wh)
    last = F.col("date") == landed.days(3)[-1]
    counts = {r[0]: tuple(r)[1:] for r in wh.read("covid19_us_fact").filter(last).select("Province_State", *cases.COUNTS).collect()}
    counties = [c for c in landed.COUNTIES if c[2] == "Alabama"]
    per_day = sum(landed.confirmed(c, 2) for c in counties), sum(landed.deaths(c, 2) for c in counties)
    assert counts["Alabama"] == tuple(2 * add + n for n in per_day)
    rows = wh.read("covid19_global_fact").filter(last).select("Country_Region", *cases.COUNTS).collect()
    assert {r[0]: tuple(r)[1:] for r in rows}["Italy"] == (add + 83, add + 0)


def test_country_dimension(loads):
    rows = {r.code: r for r in loads[0].read("country_dim").collect()}
    assert rows["ITA"].LocalName == "Italia" and rows["ITA"].IndepYear == 1861
    assert rows["ATA"].IndepYear is None


def test_tables_answer_sql(loads, spark):
    loads[0].register_views(["covid19_us_fact", "covid19_sum_fact"])
    row = spark.sql("""
        SELECT max(abs(s.total - t.us_confirmed)) AS gap
        FROM (SELECT dateid, sum(confirmed) AS total FROM covid19_us_fact GROUP BY dateid) s
        JOIN covid19_sum_fact t ON s.dateid = t.dateid
    """).collect()[0]
    assert row.gap == 0


def test_dashboard_questions_on_the_loaded_tables(loads):
    once = loads[0]
    top = dashboard.top_places(once.read("covid19_us_fact"), "Province_State", dt.date(2030, 1, 1), 2).collect()
    assert [r.Province_State for r in top] == ["California", "Alabama"]
    arrays = dashboard.cases_and_indexes_arrays(once.read("covid_stock_fact"), landed.FIRST, LAST).collect()
    assert len(arrays) == 1 and {len(a) for a in arrays[0]} == {landed.DAYS}
    labour = once.read("covid_stock_bol_monthly_fact")
    series = {r.bol_series_id: r for r in dashboard.series_values(labour, dt.date(2019, 11, 1), LAST).collect()}
    assert set(series) == {"unrate", "payems", "LNU04032215", "LNU04032218"}
    assert len(series["payems"].date) == len(series["payems"].bol_series_value) == 4
    months = dashboard.monthly_cases(labour, dt.date(2020, 1, 1), LAST).collect()
    assert [r.date.month for r in months] == [1, 2, 3]
    extremes = dashboard.extreme_groups(
        once.read("bol_series_fact"), once.read("bol_series_dim"), dt.date(2020, 1, 1), LAST, "Unemployment Rate"
    ).collect()
    assert {r.side: r.subcat2 for r in extremes} == {"highest": "Service", "lowest": "Overall"}


def test_series_answers_to_facts(spark, tmp_path):
    wh = warehouse(spark, tmp_path / "wh", ("latest_data", "bol_series_raw", "bol_series_fact"))
    labour.extract_series_json(wh, landed.series_json(tmp_path, 2019))
    assert labour.transform_raw_to_fact_bol(wh, LAST)
    labour.extract_series_json(wh, landed.series_json(tmp_path, 2020))
    labour.extract_series_json(wh, landed.series_json(tmp_path, 2020))
    assert labour.transform_raw_to_fact_bol(wh, LAST)
    raw = wh.read("bol_series_raw")
    assert raw.count() == 6
    assert raw.filter("year = 2020 AND period = 'M02' AND series_id = 'unrate'").collect()[0].footnotes == "preliminary,revised"
    facts = sorted((r.dateid, r.series_id, r.value) for r in wh.read("bol_series_fact").collect())
    assert facts == [
        (20190101, "unrate", 3.5), (20190201, "payems", None), (20190201, "unrate", 3.6),
        (20200101, "unrate", 3.5), (20200201, "payems", None), (20200201, "unrate", 3.6),
    ]


def test_totals_wait_for_the_slower_source(spark, tmp_path):
    us_c, us_d = landed.us_files(tmp_path, 8)
    gl_c, gl_d = landed.global_files(tmp_path, 8)
    names = (*US_TABLES, "covid19_global_raw", "covid19_global_dim", "covid19_global_fact", "covid19_sum_fact")
    wh = warehouse(spark, tmp_path / "wh", names)
    cases.extract_us(wh, us_c, us_d)
    cases.transform_raw_to_fact_us(wh)
    assert not cases.aggregate_fact_to_sum_fact(wh)
    for end in (landed.days()[4], landed.days()[7]):
        cases.extract_global(wh, gl_c, gl_d, end)
        cases.transform_raw_to_fact_global(wh)
        assert cases.aggregate_fact_to_sum_fact(wh)
        assert wh.mark("covid19_sum_fact") == end
    assert wh.read("covid19_sum_fact").count() == 8


def test_command_line(spark, tmp_path):
    us_c, us_d = landed.us_files(tmp_path, 4)
    (tmp_path / "tickers.html").write_text(landed.ticker_page())
    arguments = [str(tmp_path / "wh"), "--reset", "--end", "2020-01-23", "--us-confirmed", us_c, "--us-deaths", us_d]
    done = command.run(spark, command.parse([*arguments, "--ticker-pages", str(tmp_path / "tickers.html")]))
    assert done["extract_us"] and done["extract_sp500_tickers"] and not done["aggregate_fact_to_sum_fact"]
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.mark("covid19_us_monthly_fact") == dt.date(2020, 1, 23)
    assert wh.read("stock_ticker_raw").count() == 3


def test_files_without_places(spark, tmp_path):
    us_c, us_d = landed.us_files(tmp_path, 3)
    for path in (us_c, us_d):
        header = open(path).read().splitlines()[0]
        open(path, "w").write(header + "\n")
    wh = warehouse(spark, tmp_path / "wh")
    assert cases.extract_us(wh, us_c, us_d)
    assert cases.transform_raw_to_fact_us(wh)
    assert wh.read("covid19_us_fact").count() == 0
    assert wh.mark("covid19_us_fact") == landed.days()[2]
