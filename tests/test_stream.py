from __future__ import annotations

import datetime as dt

import landed
import pytest
from pyspark.sql import functions as F
from tidemark.plans import cases
from tidemark.schemas import TABLES
from tidemark.sinks.warehouse import Warehouse
from tidemark.streaming.daily import load_county_days, process_new_files

US_TABLES = ("latest_data", "covid19_us_raw", "covid19_us_dim", "covid19_us_fact", "covid19_us_monthly_fact")
N = 16


def rows(wh, name):
    return sorted((tuple(r) for r in wh.read(name).collect()), key=repr)


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("batch")
    wh = Warehouse(spark, str(folder / "wh"))
    wh.reset(US_TABLES)
    cases.extract_us(wh, *landed.us_files(folder, N))
    cases.transform_raw_to_fact_us(wh)
    cases.aggregate_fact_to_monthly_fact_us(wh)
    return wh


def test_files_arriving_in_turn_equal_one_batch(spark, batch, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.reset(US_TABLES)
    schema = TABLES["covid19_us_raw"].schema
    raw = batch.read("covid19_us_raw")
    inbox, state = str(tmp_path / "inbox"), str(tmp_path / "state")
    cuts = [dt.date(2020, 1, 1), dt.date(2020, 1, 31), dt.date(2020, 2, 3), dt.date(2020, 12, 31)]
    for low, high in zip(cuts, cuts[1:]):
        part = raw.filter((F.col("date") > low) & (F.col("date") <= high))
        part.coalesce(1).write.mode("append").parquet(inbox)
        process_new_files(spark, inbox, schema, lambda df: load_county_days(wh, df), state, files_per_batch=1)
    # nothing new: the stream hands nothing over
    process_new_files(spark, inbox, schema, lambda df: pytest.fail("file seen twice"), state)
    for name in ("covid19_us_raw", "covid19_us_fact", "covid19_us_monthly_fact"):
        assert rows(wh, name) == rows(batch, name)


def test_a_repeated_micro_batch_changes_nothing(spark, batch, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.reset(US_TABLES)
    raw = batch.read("covid19_us_raw")
    load_county_days(wh, raw)
    load_county_days(wh, raw)
    assert rows(wh, "covid19_us_fact") == rows(batch, "covid19_us_fact")
