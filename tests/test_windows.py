from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tidemark.functions.dates import month_number
from tidemark.operators.windows import add_previous_diff, forward_fill

DAY = dt.date(2020, 1, 30)
SCHEMA = "e string, date date, v long"


def frame(spark, values):
    return spark.createDataFrame([(e, DAY + dt.timedelta(days=i), v) for e, i, v in values], SCHEMA)


BUCKETS = ["plain", "bucketed"]


def bucket_of(kind):
    return month_number(F.col("date")) if kind == "bucketed" else None


@pytest.mark.parametrize("kind", BUCKETS)
def test_differences(spark, kind):
    df = frame(spark, [("a", 0, 10), ("a", 1, 15), ("a", 3, 0), ("a", 4, 8), ("a", 5, None), ("a", 6, 4), ("b", 2, 7)])
    out = add_previous_diff(df, ["v"], "date", ["e"], bucket_of(kind)).orderBy("e", "date").collect()
    assert [(r.v_inc, r.v_inc_pct) for r in out] == [
        (10, 0.0),  # first row of an entity: compared with 0
        (5, 50.0),
        (-15, -100.0),
        (8, 0.0),  # previous value 0: no percentage
        (None, 0.0),  # no value: no increment
        (4, 0.0),  # previous value missing: counts as 0
        (7, 0.0),
    ]


@pytest.mark.parametrize("kind", BUCKETS)
def test_differences_without_entity(spark, kind):
    df = frame(spark, [("a", 0, 10), ("b", 1, 15), ("c", 2, 30)]).drop("e")
    out = add_previous_diff(df, ["v"], "date", bucket=bucket_of(kind)).orderBy("date").collect()
    assert [r.v_inc for r in out] == [10, 5, 15]


@pytest.mark.parametrize("kind", BUCKETS)
def test_null_entity_is_an_entity(spark, kind):
    df = frame(spark, [(None, 0, 10), (None, 2, 15), ("a", 1, 1)])
    out = add_previous_diff(df, ["v"], "date", ["e"], bucket_of(kind)).orderBy("e", "date").collect()
    assert [(r.e, r.v_inc) for r in out] == [(None, 10), (None, 5), ("a", 1)]


@pytest.mark.parametrize("kind", BUCKETS)
def test_forward_fill(spark, kind):
    df = frame(spark, [("a", 0, None), ("a", 1, 5), ("a", 2, None), ("a", 40, None), ("a", 41, 0), ("a", 90, None)])
    plain = forward_fill(df, ["v"], "date", bucket=bucket_of(kind)).orderBy("date").collect()
    assert [r.v for r in plain] == [None, 5, 5, 5, 0, 0]
    zero = forward_fill(df, ["v"], "date", initial=0, bucket=bucket_of(kind)).orderBy("date").collect()
    assert [r.v for r in zero] == [0, 5, 5, 5, 0, 0]


def test_empty_input(spark):
    df = frame(spark, [])
    for kind in BUCKETS:
        assert add_previous_diff(df, ["v"], "date", ["e"], bucket_of(kind)).count() == 0
        assert forward_fill(df, ["v"], "date", bucket=bucket_of(kind)).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(
        st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 150)),
        st.one_of(st.none(), st.integers(0, 9)),
        max_size=25,
    )
)
def test_bucketed_equals_plain(spark, cells):
    df = frame(spark, [(e, i, v) for (e, i), v in cells.items()])
    bucket = month_number(F.col("date"))
    plain = add_previous_diff(df, ["v"], "date", ["e"])
    bucketed = add_previous_diff(df, ["v"], "date", ["e"], bucket).select(*plain.columns)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, bucketed.collect()))
    plain = forward_fill(df, ["v"], "date", ["e"])
    bucketed = forward_fill(df, ["v"], "date", ["e"], bucket=bucket)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, bucketed.collect()))
