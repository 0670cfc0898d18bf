"""Price loads that lose nothing: merges by key, marks by ticker, the file ledger, the quarantine."""

from __future__ import annotations

import datetime as dt

import pytest
from tidemark.operators.incremental import increment_by_entity
from tidemark.plans import markets
from tidemark.sinks.warehouse import Warehouse
from tidemark.sources import prices

HEADER = "Date,High,Low,Open,Close,Volume,Adj Close"
FIRST = dt.date(2020, 1, 30)
TABLES = ("stock_ticker_raw", "stock_price_raw", "stock_price_fact", "stock_price_monthly_fact")


def day(n):
    return FIRST + dt.timedelta(days=n)


def land(folder, ticker, levels, *broken):
    """A price file with one row per day from the first on."""
    folder.mkdir(exist_ok=True)
    rows = [f"{day(k)},{v},1,2,3,4,5" for k, v in enumerate(levels) if v is not None]
    (folder / f"{ticker}.csv").write_text("\n".join([HEADER, *rows, *broken]) + "\n")


@pytest.fixture
def wh(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.reset(TABLES)
    return wh


def stored(wh, name="stock_price_raw"):
    found = {}
    for r in wh.read(name).collect():
        assert found.setdefault((r.stock_ticker, r.date), r.High) == r.High
    return found


def expected(**tickers):
    return {(t, day(k)): float(v) for t, levels in tickers.items() for k, v in enumerate(levels) if v is not None}


def load(wh, tmp_path, end=9, **options):
    return markets.extract_batch_stock(wh, str(tmp_path / "in"), str(tmp_path / "errors"), day(end), **options)


def test_one_day_of_one_ticker_leaves_the_others(wh, spark, tmp_path):
    for t in "AB":
        land(tmp_path / "in", t, [10, 11, 12])
    assert load(wh, tmp_path)
    land(tmp_path / "in", "A", [10, 99, 12])
    (tmp_path / "list").write_text("A\n")
    assert markets.extract_single_date_stock(wh, str(tmp_path / "in"), str(tmp_path / "errors"), day(1), str(tmp_path / "list"))
    assert stored(wh) == expected(A=[10, 99, 12], B=[10, 11, 12])


@pytest.mark.parametrize("options", [{}, {"lookback_days": 3}])
def test_a_late_ticker_loads_and_deletes_nothing(wh, tmp_path, options):
    for t in "AB":
        land(tmp_path / "in", t, [10, 11, 12, 13])
    load(wh, tmp_path)
    markets.transform_raw_to_fact_stock(wh)
    for t in "AB":
        (tmp_path / "in" / f"{t}.csv").unlink()
    land(tmp_path / "in", "C", [20, 21, 22])
    report = load(wh, tmp_path, **options)
    assert report and report.stored == 3
    assert markets.transform_raw_to_fact_stock(wh)
    whole = expected(A=[10, 11, 12, 13], B=[10, 11, 12, 13], C=[20, 21, 22])
    assert stored(wh) == whole and stored(wh, "stock_price_fact") == whole
    assert {r.entity: r.latest for r in wh.entity_marks("stock_price_raw").collect()} == {"A": day(3), "B": day(3), "C": day(2)}


def test_an_unchanged_folder_parses_no_line(wh, tmp_path, monkeypatch):
    land(tmp_path / "in", "A", [10, 11, 12], "garbage")
    assert load(wh, tmp_path).dropped == {"broken lines": 1}
    asked = []
    read = markets.read_price_files
    monkeypatch.setattr(markets, "read_price_files", lambda spark, paths: asked.append(paths) or read(spark, paths))
    assert not load(wh, tmp_path) and asked == []
    land(tmp_path / "in", "B", [5])
    assert load(wh, tmp_path) and len(asked) == 1 and len(asked[0]) == 1
    assert stored(wh) == expected(A=[10, 11, 12], B=[5])


def test_rows_after_the_end_come_with_a_later_end(wh, tmp_path):
    land(tmp_path / "in", "A", [10, 11, 12, 13])
    assert load(wh, tmp_path, 1) and stored(wh) == expected(A=[10, 11])
    assert not load(wh, tmp_path, 1)
    report = load(wh, tmp_path, 3)
    assert report.stored == 2 and stored(wh) == expected(A=[10, 11, 12, 13])


def test_a_file_that_grew_gives_its_new_rows_only(wh, tmp_path):
    land(tmp_path / "in", "A", [10, 11], "garbage")
    load(wh, tmp_path)
    land(tmp_path / "in", "A", [10, 11, 12], "garbage")
    report = load(wh, tmp_path)
    assert report.stored == 1 and stored(wh) == expected(A=[10, 11, 12])


def test_a_changed_file_replaces_its_rows_and_its_broken_lines(wh, spark, tmp_path):
    land(tmp_path / "in", "A", [10, 11, 12, 13], "garbage", "2020-02-09,x,1,2,3,4,5")
    land(tmp_path / "in", "B", [5, None, None, 6], "rubbish")
    load(wh, tmp_path)
    markets.transform_raw_to_fact_stock(wh)
    # a day is gone, another one has a new value, one line has been mended
    land(tmp_path / "in", "A", [10, None, 99, 13], "garbage")
    assert load(wh, tmp_path)
    whole = expected(A=[10, None, 99, 13], B=[5, None, None, 6])
    assert stored(wh) == whole
    broken = spark.read.json(str(tmp_path / "errors" / "broken_lines")).collect()
    assert sorted((r.stock_ticker, r.broken) for r in broken) == [("A", "garbage"), ("B", "rubbish")]


def test_merging_months_and_repeating_a_merge(wh, spark):
    schema = "dateid long, stock_ticker string, date date, High double, Low double, Open double, Close double, Volume double, adj_close double"
    rows = lambda *keys: spark.createDataFrame(
        [(int(f"{day(k):%Y%m%d}"), t, day(k), float(v), 1.0, 1.0, 1.0, 1.0, 1.0) for t, k, v in keys], schema
    )
    name, identity = "stock_price_fact", ("stock_ticker", "date")
    wh.merge(name, rows(("A", 0, 1), ("A", 1, 1), ("B", 1, 1), ("B", 2, 1)), identity)
    for _ in range(2):
        wh.merge(name, rows(("A", 1, 2), ("C", 2, 2)), identity)
        assert stored(wh, name) == {
            ("A", day(0)): 1.0, ("A", day(1)): 2.0, ("B", day(1)): 1.0, ("B", day(2)): 1.0, ("C", day(2)): 2.0,
        }
    gone = spark.createDataFrame([("B",), ("A",)], "stock_ticker string")
    found = wh.merge(name, rows(("B", 2, 3)), identity, gone)
    assert stored(wh, name) == {("B", day(2)): 3.0, ("C", day(2)): 2.0} and found["min_date"] == day(0)
    wh.merge(name, rows(), identity, spark.createDataFrame([("B",), ("C",)], "stock_ticker string"))
    assert stored(wh, name) == {}


def test_increments_by_entity(spark, rows):
    df = spark.createDataFrame([("A", day(0)), ("A", day(1)), ("B", day(0))], "t string, date date")
    marks = spark.createDataFrame([("A", day(0)), ("X", day(5))], "entity string, latest date")
    assert rows(increment_by_entity(df, marks, "t")) == [("A", day(1)), ("B", day(0))]
    assert len(rows(increment_by_entity(df, marks, "t", lookback_days=1))) == 3


def test_listing_does_not_read(spark, tmp_path):
    land(tmp_path / "in", "A", [1])
    listed = prices.list_price_files(spark, str(tmp_path / "in"))
    assert [(r.stock_ticker, r.length) for r in listed.collect()] == [("A", (tmp_path / "in" / "A.csv").stat().st_size)]
    assert "content" not in listed._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
