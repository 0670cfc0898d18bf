from __future__ import annotations

import datetime as dt
import json

import landed
import pytest
from pyspark.sql import types as T
from tidemark.plans.cases import US_IDS
from tidemark.sources import files, jdbc, markup, nested, prices, seeds
from tidemark.sinks.texts import write_json, write_text_list


def test_wide_csv_schema_comes_from_the_header(spark, tmp_path):
    path, _ = landed.us_files(tmp_path, 3)
    df = files.read_wide_csv(spark, path, US_IDS)
    types = dict(df.dtypes)
    assert types["UID"] == "bigint" and types["FIPS"] == "double" and types["1/24/20"] == "int"
    assert df.filter("UID = 84006001").collect()[0]["Combined_Key"] == "Alameda, California, US"


def test_series_csv_bounds_and_missing_values(spark, tmp_path):
    path = landed.index_file(tmp_path)
    df = files.read_series_csv(spark, path, ["djia", "nasdaq100"], dt.date(2020, 1, 23), dt.date(2020, 1, 24))
    assert [tuple(r) for r in df.orderBy("date").collect()] == [
        (dt.date(2020, 1, 23), None, None),
        (dt.date(2020, 1, 24), 28998.0, 9002.0),
    ]


def test_wide_files_of_a_folder_are_read_by_their_own_headers(spark, tmp_path):
    ids = T.StructType([T.StructField("Place", T.StringType()), T.StructField("Lat", T.DoubleType())])
    (tmp_path / "a b.csv").write_text("Place,Lat,1/22/20,1/23/20\nX,1.5,1,2\nY,,3,4\n")
    (tmp_path / "c.csv").write_text("Lat,Place,1/24/20,1/23/20\n1.5,X,5,2\n,Z,7,6\n")
    df = files.read_wide_csv(spark, str(tmp_path), ids)
    assert dict(df.dtypes)["1/24/20"] == "int"
    got = df.select("Place", "Lat", "1/22/20", "1/23/20", "1/24/20").collect()
    assert {tuple(r) for r in got} == {("X", 1.5, 1, 2, 5), ("Y", None, 3, 4, None), ("Z", None, None, 6, 7)}


def test_other_orders_of_columns_keep_rows_that_repeat(spark, tmp_path):
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("people", T.LongType())])
    (tmp_path / "a.csv").write_text("code;people;note\nAT;9;n\nAT;9;n\n")
    (tmp_path / "b.csv").write_text("people;note;code\n8;n;CH\n")
    got = files.read_delimited(spark, str(tmp_path), schema).collect()
    assert sorted(tuple(r) for r in got) == [("AT", 9), ("AT", 9), ("CH", 8)]


def test_series_of_several_files_meet_by_date(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,djia\n2020-01-22,1\n2020-01-23,.\n")
    (tmp_path / "b.csv").write_text("nasdaq100,date\n7,2020-01-23\n")
    assert files.csv_header(spark, str(tmp_path)) == ["date", "djia", "nasdaq100"]
    got = files.read_series_csv(spark, str(tmp_path), ["djia", "nasdaq100"]).collect()
    assert {tuple(r) for r in got} == {(dt.date(2020, 1, 22), 1.0, None), (dt.date(2020, 1, 23), None, 7.0)}


def test_price_lines(spark, tmp_path):
    lines = prices.read_price_files(spark, landed.price_files(tmp_path))
    assert prices.good_prices(lines).count() == 61
    # the split into good and broken does not depend on the columns a query needs
    assert prices.good_prices(lines).select("stock_ticker").count() == 61
    assert prices.quarantined(lines).count() == 3


def test_text_list_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("AAA",), ("BBB",)], "t string")
    write_text_list(df, "t", str(tmp_path / "list"))
    assert sorted(r.t for r in files.read_text_list(spark, str(tmp_path / "list"), "t").collect()) == ["AAA", "BBB"]


def test_json_lines(spark, tmp_path):
    write_json(spark.sql("SELECT 'a' AS s, true AS b, CAST(NULL AS INT) AS n"), str(tmp_path / "json"))
    assert json.loads(spark.read.text(str(tmp_path / "json")).collect()[0][0]) == {"s": "a", "b": True}


def test_ticker_page(spark):
    pages = spark.createDataFrame([(landed.ticker_page(),), ("<p>no table</p>",), (None,)], "html string")
    rows = markup.ticker_rows(pages).orderBy("ticker").collect()
    assert [tuple(r) for r in rows] == [
        ("AAA", "A & A", "Tech", "Chips", "Here", "0000000001", 1976),
        ("BBB", "Bee", "Energy", "Oil", "There", "0000000002", None),
        ("CCC", "Sea", "Energy", "Oil", "There", "0000000003", 2001),
    ]


def test_links(spark):
    pages = spark.createDataFrame([(1, '<ul><li class="x"><a href="/a">A &lt;\n</a></li><li>B</li><li><a class="c" href="/c">C</a></li></ul>')], "id int, html string")
    rows = markup.link_rows(pages, "html", ["id"]).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "/a", "A <"), (1, 2, "/c", "C")]


def test_nested_series(spark):
    def point(year, period, value, *notes):
        return {"year": year, "period": period, "value": value, "footnotes": [{"text": n} if n else {} for n in notes]}

    doc = {
        "status": "ok",
        "Results": {
            "series": [
                {"seriesID": "A", "data": [point("2020", "M01", "1.5", "p", None, "q"), point("2020", "M13", "9")]},
                {"seriesID": "B", "data": [point("2019", "M12", "-")]},
                {"seriesID": "C", "data": []},
            ]
        },
    }
    df = spark.createDataFrame([(json.dumps(doc),), ("broken",)], "json string")
    rows = sorted(tuple(r) for r in nested.flatten_series(df).collect())
    assert rows == [("A", 2020, "M01", 1.5, "p,q"), ("B", 2019, "M12", None, "")]


def test_jdbc_scan_options():
    plain = jdbc.scan_options("jdbc:x", "t", properties={"user": "u"})
    assert plain == {"url": "jdbc:x", "dbtable": "t", "user": "u"}
    ranged = jdbc.scan_options("jdbc:x", "t", "dateid", 20200101, 20201231, 8)
    assert ranged["partitionColumn"] == "dateid" and ranged["numPartitions"] == "8"
    with pytest.raises(ValueError, match="partitioned scan"):
        jdbc.scan_options("jdbc:x", "t", "dateid")


def test_seeds(spark):
    assert seeds.labour_series(spark).count() == 23
    marks = seeds.initial_marks(spark).collect()
    assert len(marks) == 23 and {r.latest_date for r in marks} == {dt.datetime(1990, 1, 1)}
