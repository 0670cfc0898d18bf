from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from tidemark.operators import aggregate, incremental, joins, quality, reshape, select
from tidemark.schemas import TABLES, conform

D = dt.date


def days(spark, values, schema="e string, date date, confirmed long, deaths long"):
    return spark.createDataFrame(values, schema)


def test_date_columns_in_range():
    columns = ["Province/State", "Lat", "1/22/20", "1/23/20", "1/24/20", "2/1/20"]
    assert list(reshape.dates_in_range(columns)) == columns[2:]
    assert list(reshape.dates_in_range(columns, D(2020, 1, 22), D(2020, 1, 24))) == ["1/23/20", "1/24/20"]
    assert list(reshape.dates_in_range(columns, skip_first=2)) == ["1/24/20", "2/1/20"]
    assert reshape.dates_in_range(columns, D(2020, 2, 1)) == {}


@pytest.mark.parametrize("width", [3, 100])
def test_unpivot_and_back(spark, rows, width):
    names = [f"{i % 12 + 1}/1/{i // 12}" for i in range(width)]
    df = spark.createDataFrame([("a", *range(width)), ("b", *range(5, width + 5))], ["place", *names])
    long = reshape.unpivot(df, ["place"], "label", "v")
    assert long.count() == 2 * width
    assert rows(long) == rows(reshape.unpivot_structs(df, ["place"], "label", "v"))
    back = long.groupBy("place").pivot("label", names).agg(F.first("v"))
    assert rows(back) == rows(df)


def test_unpivot_wants_one_type(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "place string, x int, y double")
    with pytest.raises(TypeError, match="one type"):
        reshape.unpivot(df, ["place"], "k", "v")


def test_thousands_of_date_columns(spark):
    n = 1200
    labels = [f"{d.month}/{d.day}/{d:%y}" for d in (D(2020, 1, 22) + dt.timedelta(days=i) for i in range(n))]
    df = spark.range(3).selectExpr("id AS UID", *(f"id * {i} AS `{name}`" for i, name in enumerate(labels)))
    header = reshape.date_columns(df.columns)
    packed = reshape.pack_columns(df, ["UID"], list(header), "confirmed")
    long = reshape.unpack_dates(packed, ["UID"], list(header.values()), ["confirmed"])
    assert long.count() == 3 * n
    assert long.filter("UID = 2 AND date = DATE'2020-01-24'").collect()[0].confirmed == 4


def test_ordered_arrays(spark):
    df = days(spark, [("a", D(2020, 1, 3), 3, 0), ("a", D(2020, 1, 1), 1, 9), ("b", D(2020, 1, 2), 7, 7)])
    got = {r.e: r for r in reshape.ordered_arrays(df, ["date", "confirmed", "deaths"], ["e"]).collect()}
    assert got["a"].date == [D(2020, 1, 1), D(2020, 1, 3)]
    assert (got["a"].confirmed, got["a"].deaths) == ([1, 3], [9, 0])


def test_first_per_key_is_deterministic(spark, rows):
    df = spark.createDataFrame([("s", 1, 2.0), ("s", 1, 1.0), ("s", 1, 1.0), ("t", 1, None), ("t", 1, 5.0)], "s string, k int, v double")
    assert rows(aggregate.first_per_key(df, ["s", "k"])) == [("s", 1, 1.0), ("t", 1, 5.0)]


def test_first_per_key_keeps_rows_whole(spark, rows):
    df = spark.createDataFrame([("s", 2.0, "a"), ("s", 1.0, "z"), ("s", 1.0, None), ("t", None, "n")], "s string, v double, n string")
    assert rows(aggregate.first_per_key(df, ["s"])) == [("s", 1.0, "z"), ("t", None, "n")]


def test_month_rollup(spark):
    df = days(spark, [("a", D(2020, 1, 1), 1, 9), ("a", D(2020, 1, 31), 5, 7), ("a", D(2021, 1, 1), 2, 2)])
    out = aggregate.month_rollup(df, {"confirmed": "max", "deaths": "avg"}, ["e"]).orderBy("date").collect()
    assert out[0].asDict() == {
        "dateid": 20200101, "e": "a", "date": D(2020, 1, 1), "year": 2020, "month": 1, "month_name": "January",
        "confirmed": 5, "deaths": 8.0,
    }
    assert out[1].dateid == 20210101


def test_last_per_key(spark, rows):
    df = days(spark, [("a", D(2020, 1, 1), 1, 9), ("a", D(2020, 1, 2), 5, 7), ("b", D(2020, 1, 1), 2, 2)])
    assert [r[:3] for r in rows(aggregate.last_per_key(df, ["e"], "date"))] == [("a", D(2020, 1, 2), 5), ("b", D(2020, 1, 1), 2)]
    assert aggregate.last_per_key(df.filter("false"), [], "date").count() == 0


def test_diff_with_seed_equals_full(spark, rows):
    values = [(e, D(2020, 1, d), 10 * d + k, d % 3) for k, e in enumerate("abc") for d in range(1, 9) if (d + k) % 4]
    df = days(spark, values)
    full = incremental.diff_with_seed(df, None, ["confirmed", "deaths"], ["e"])
    mark = D(2020, 1, 4)
    first = incremental.diff_with_seed(incremental.increment(df, None, mark), None, ["confirmed", "deaths"], ["e"])
    later = incremental.diff_with_seed(incremental.increment(df, mark), first, ["confirmed", "deaths"], ["e"])
    assert rows(first.unionByName(later)) == rows(full)


def test_increment_bounds_and_lookback(spark):
    df = days(spark, [("a", D(2020, 1, d), d, 0) for d in range(1, 11)])
    got = [r.date.day for r in incremental.increment(df, D(2020, 1, 3), D(2020, 1, 5)).orderBy("date").collect()]
    assert got == [4, 5]
    assert incremental.increment(df, D(2020, 1, 3), lookback_days=2).count() == 9


def test_set_mark(spark, rows):
    marks = spark.sql("SELECT 'a' AS table_name, TIMESTAMP'2020-01-01' AS latest_date")
    out = incremental.set_mark(incremental.set_mark(marks, "a", D(2020, 2, 2)), "b", D(2020, 3, 3))
    assert rows(out.selectExpr("table_name", "CAST(latest_date AS DATE)")) == [("a", D(2020, 2, 2)), ("b", D(2020, 3, 3))]
    assert not incremental.is_resume(D(1990, 1, 2)) and incremental.is_resume(D(1990, 1, 3))


def test_top_k_breaks_ties_by_name(spark):
    df = days(spark, [(e, D(2020, 1, 1), 5, 0) for e in "dcba"] + [("z", D(2020, 1, 2), 1, 0)])
    assert [r.e for r in select.top_k(df, 3, "confirmed", "e").collect()] == ["z", "a", "b"]


def test_clamp(spark):
    df = days(spark, [("a", D(2020, 1, 1), 5, 0), ("a", D(2020, 1, 5), 5, 0)])
    assert select.on_date(df, select.clamp_end(D(2030, 1, 1), df)).count() == 1
    assert select.on_date(df, select.clamp_end(D(2020, 1, 2), df)).count() == 0
    assert select.clamp(D(2019, 1, 1), D(2021, 1, 1), D(2020, 1, 1), D(2020, 5, 5)) == (D(2020, 1, 1), D(2020, 5, 5))
    assert select.clamp(D(2019, 1, 1), D(2021, 1, 1), None, None) == (D(2019, 1, 1), D(2021, 1, 1))


def test_filter_with_counts_in_one_pass(spark):
    counts = Observation()
    kept = select.having_counted(spark.createDataFrame([(1,), (None,), (3,)], "k int"), "k", counts)
    assert kept.count() == 2
    assert counts.get == {"n_rows": 3, "n_without": 1}


def test_market_join_keeps_case_days_only(spark):
    cases = spark.createDataFrame([(20200101, 1), (20200102, 2)], "dateid long, n int")
    market = spark.createDataFrame([(20200102, 7.0), (20200102, 7.0), (20200103, 8.0)], "dateid long, s double")
    out = joins.cases_with_market(cases, market, ["s"]).orderBy("dateid").collect()
    assert [(r.dateid, r.s) for r in out] == [(20200101, None), (20200102, 7.0)]


def test_country_enrichment_and_series_texts(spark, rows):
    facts = spark.createDataFrame([("Italy", 1), ("Nowhere", 2)], "Country_Region string, n int")
    countries = spark.createDataFrame([("Italy", "Europe"), ("Italy", "Europe")], "Name string, Continent string")
    assert rows(joins.enrich_countries(facts, countries, "Country_Region", ["Continent"])) == [("Italy", 1, "Europe")]
    dim = spark.createDataFrame([("unrate", "c", "s1", "s2")], TABLES["bol_series_dim"].schema)
    series = spark.createDataFrame([("unrate", 3.5), ("other", 1.0)], "series_id string, value double")
    assert rows(joins.describe_series(series, dim)) == [("unrate", 3.5, "c", "s1", "s2")]


def test_quality(spark, rows):
    df = spark.createDataFrame([(1, "ab"), (1, None), (2, "abcdef"), (None, "a")], "k int, t string")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    report = quality.column_report(df, ["k", "t"], {"t": 3}).collect()[0]
    assert report.asDict() == {"n_rows": 4, "null_k": 1, "null_t": 1, "long_t": 1}
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.orphans(df, "k", parent, "id")) == [(2, 1)]
    with pytest.raises(ValueError, match="null_k"):
        quality.check_observed(TABLES["latest_data"], report.asDict())


def test_conform_rounds_percentages_and_orders_columns(spark):
    df = spark.sql("SELECT 0.000005D AS x").selectExpr(
        "x AS deaths_inc_pct", "1234567.123455D AS confirmed_inc_pct", "1 AS deaths_inc", "1 AS confirmed_inc",
        "1 AS deaths", "1 AS confirmed", "DATE'2020-01-01' AS date", "'a' AS Province_State", "20200101 AS dateid", "1 AS extra",
    )
    out = conform(df, "covid19_us_fact")
    assert out.columns == TABLES["covid19_us_fact"].schema.names
    row = out.collect()[0]
    assert (str(row.deaths_inc_pct), str(row.confirmed_inc_pct)) == ("0.00001", "1234567.12346")


def test_conform_refuses_values_that_do_not_fit(spark):
    df = spark.sql("SELECT 'x' AS table_name, 'no date' AS latest_date")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, "latest_data").collect()
