"""Staged, checked and recoverable writes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tidemark.plans import steps
from tidemark.sinks.warehouse import Warehouse
from tidemark.sources import prices

DAY = dt.date(2020, 1, 30)


def rows(spark, days, level=1.0):
    return spark.createDataFrame(
        [(int(f"{d:%Y%m%d}"), d, level, level, level) for d in days],
        "dateid long, date date, dowjones_score double, nasdaq100_score double, sp500_score double",
    )


def days(first, n):
    return [first + dt.timedelta(days=k) for k in range(n)]


@pytest.fixture
def wh(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.reset(["stock_index_fact", "covid19_global_dim", "stock_index_monthly_fact"])
    return wh


def stored_days(wh):
    return {r.date: r.sp500_score for r in wh.read("stock_index_fact").collect()}


def test_begun_months_keep_their_days(spark, wh):
    wh.load("stock_index_fact", rows(spark, days(DAY, 4)))
    wh.load("stock_index_fact", rows(spark, days(DAY + dt.timedelta(days=3), 3), 2.0))
    found = stored_days(wh)
    assert list(sorted(found)) == days(DAY, 6)
    assert [found[d] for d in days(DAY, 6)] == [1.0] * 3 + [2.0] * 3


def test_a_violating_write_leaves_the_table_as_it_was(spark, wh):
    wh.replace("covid19_global_dim", spark.createDataFrame([("Italy", 1.0, 2.0)], "Country_Region string, Lat double, Long_ double"))
    for bad in (("x" * 65, 1.0, 2.0), ("France", None, 2.0)):
        with pytest.raises(ValueError, match="break the schema"):
            wh.replace("covid19_global_dim", spark.createDataFrame([bad], "Country_Region string, Lat double, Long_ double"))
    twice = rows(spark, [DAY]).union(rows(spark, [DAY], 2.0))
    with pytest.raises(ValueError, match="more than once"):
        wh.load("stock_index_fact", twice)
    assert [r.Country_Region for r in wh.read("covid19_global_dim").collect()] == ["Italy"]
    assert stored_days(wh) == {}


def test_a_run_that_dies_while_publishing_is_finished_by_the_next(spark, wh, monkeypatch):
    wh.load("stock_index_fact", rows(spark, days(DAY, 4)))
    move, calls = Warehouse._publish, []

    def dies(self, folders, name, folder):
        # the month of the first day is gone, and nothing has been moved yet
        folders.remove(f"{self.path(name)}/year=2020/month=1")
        calls.append(name)
        raise RuntimeError("lost")

    monkeypatch.setattr(Warehouse, "_publish", dies)
    with pytest.raises(RuntimeError):
        wh.load("stock_index_fact", rows(spark, [DAY], 5.0))
    monkeypatch.setattr(Warehouse, "_publish", move)
    assert calls == ["stock_index_fact"]
    wh.recover()
    found = stored_days(wh)
    assert list(sorted(found)) == days(DAY, 4) and found[DAY] == 5.0


def test_staged_rows_that_were_not_ready_are_dropped(spark, wh):
    rows(spark, [DAY]).write.parquet(f"{wh.path('_staged')}/stock_index_fact-0")
    wh.load("stock_index_fact", rows(spark, [DAY + dt.timedelta(days=1)]))
    assert list(stored_days(wh)) == [DAY + dt.timedelta(days=1)]


def test_reset_leaves_other_tables_and_marks(spark, wh):
    wh.load("stock_index_fact", rows(spark, [DAY]))
    wh.set_marks({"stock_index_fact": DAY, "covid19_us_fact": DAY})
    wh.reset(["covid19_global_dim"])
    assert wh.mark("stock_index_fact") == wh.mark("covid19_us_fact") == DAY
    assert wh.mark("covid19_global_dim") == dt.date(1990, 1, 1) and stored_days(wh)


def test_late_rows_take_back_what_was_made_without_them(wh):
    wh.set_marks({"covid_stock_fact": DAY, "covid_stock_monthly_fact": DAY, "covid_stock_bol_monthly_fact": DAY})
    low = DAY - dt.timedelta(days=10)
    steps.finished(wh, "stock_index_fact", steps.Bounds(low, DAY))
    marks = wh.marks()
    assert marks["stock_index_fact"] == DAY
    assert {marks[f"covid_stock{x}"] for x in ("_fact", "_monthly_fact", "_bol_monthly_fact")} == {low}


def test_seed_scan_has_a_lower_bound(spark, wh):
    wh.load("stock_index_fact", rows(spark, days(DAY, 3)))
    seed = steps.seed_rows(wh, "stock_index_fact", DAY + dt.timedelta(days=2), None, rows(spark, [DAY]))
    plan = seed._jdf.queryExecution().executedPlan().toString()
    partition = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert ">= 202001" in partition


def test_price_columns_are_found_by_the_header_of_their_file(spark, tmp_path):
    folder = tmp_path / "prices"
    folder.mkdir()
    (folder / "AAA.csv").write_text("Date,High,Low,Open,Close,Volume,Adj Close\n2019-05-06,1,2,3,4,5,6\n")
    (folder / "BBB.csv").write_text("Volume,Date,Adj Close,Close,Open,Low,High\n5,2019-05-06,6,4,3,2,1\n")
    (folder / "CCC.csv").write_text("Date,High,Low\n2019-05-06,1,2\n")
    lines = prices.read_price_files(spark, str(folder))
    good = {r.stock_ticker: (r.High, r.Low, r.Open, r.Close, r.Volume, r.adj_close) for r in prices.good_prices(lines).collect()}
    assert good == {t: (1.0, 2.0, 3.0, 4.0, 5.0, 6.0) for t in ("AAA", "BBB")}
    assert [(r.stock_ticker, r.broken) for r in prices.quarantined(lines).collect()] == [("CCC", "2019-05-06,1,2")]
    assert prices.good_prices(lines).agg(F.min("date")).first()[0] == dt.date(2019, 5, 6)
