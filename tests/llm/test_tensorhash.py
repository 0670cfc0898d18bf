"""Tensored MinHash against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_metricjoin import _edited, _expected, _families

from tidemark.llm import tensorhash
from tidemark.llm.jaccard import Measure, own_counts
from tidemark.llm.tensorhash import Tensor, partial_keys


def _got(df, measure):
    found = tensorhash.near_duplicates(df, measure).collect()
    return sorted((r["doc"], r["n"], r["component"]) for r in found)


@pytest.mark.parametrize(("seed", "measure"), [(11, Measure()), (12, Measure(2, 80, 100))])
def test_equals_brute_force(spark, documents, seed, measure):
    rows = _families(seed)
    assert _got(documents(rows), measure) == _expected(rows, measure)


def test_one_large_group_of_near_copies(spark, documents):
    r = random.Random(8)
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(k, _edited(base, r, k % 3)) for k in range(150)] + [(200 + k, f"own{k} words here") for k in range(5)]
    measure = Measure(2, 4, 5)
    assert _got(documents(rows), measure) == _expected(rows, measure)


def test_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO\n"), (6, "one two"), (7, "two one"), (6, "one two"),
            (1 << 62, "far id here"), (-5, "FAR id here")]
    df = documents(rows).withColumnRenamed("source", "class").withColumnRenamed("lang", "keys")
    expected = [(-5, 2, -5), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 4), (6, 1, 4), (7, 1, 7), (1 << 62, 2, -5)]
    assert _got(df, Measure(2, 4, 5)) == expected
    kept = tensorhash.keep_one(df, Measure(2, 4, 5))
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [-5, 1, 2, 3, 4, 7]
    assert tensorhash.keep_one(documents([]), Measure(2, 4, 5)).count() == 0


def test_tables_miss_few_links_and_few_strangers_meet():
    tensor, random_ = Tensor(), np.random.default_rng(5)
    functions, met = tensor.functions(), {0.8: 0, 0.5: 0, 0.1: 0}
    for s in met:
        for _ in range(300):
            common = round(360 * s)
            every = random_.integers(0, 1 << 63, 360, np.uint64)
            mine, yours = every[: common + (360 - common) // 2], np.concatenate([every[:common], every[common + (360 - common) // 2 :]])
            a, b = (partial_keys(x, tensor, functions) == partial_keys(y, tensor, functions) for x, y in [(mine, yours)] * 2)
            met[s] += bool(a[: tensor.size].any() and b[tensor.size :].any())
    assert met[0.8] == 300
    # by the formula (1 - (1 - s ** 4) ** 24) ** 2: 0.62 and 0.00001
    assert 150 < met[0.5] < 220 and met[0.1] <= 1


def test_keys_do_not_depend_on_the_order_or_the_blocks(monkeypatch):
    tensor, shingles = Tensor(), np.random.default_rng(1).integers(0, 1 << 63, 500, np.uint64)
    keys = partial_keys(shingles, tensor, tensor.functions())
    monkeypatch.setattr(tensorhash, "_BLOCK", 7)
    assert (partial_keys(shingles[::-1], tensor, tensor.functions()) == keys).all()
    assert len(set(keys.tolist())) == 2 * tensor.size


def test_shingles_of_ones_own_are_counted(spark):
    sets = spark.createDataFrame([(1, [1, 2, 3]), (2, [2, 3]), (3, [3, 7, 8, 9])], "doc long, shingles array<long>")
    assert {tuple(r) for r in own_counts(sets).collect()} == {(1, 1), (3, 3)}
