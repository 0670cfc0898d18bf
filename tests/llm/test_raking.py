from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import raking


def _rows(n=3000, seed=1):
    r = random.Random(seed)
    return [
        (k, r.choice(["a", "a", "a", "b", None]), r.choice(["en", "en", "fr"]), r.choice(["x", "y"]), r.randint(1, 50))
        for k in range(n)
    ]


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, tokens long")
    return df.withColumn("text", F.lit(None).cast("string"))


def _brute(rows, targets, sweeps=200):
    cells = defaultdict(float)
    for _, *key, tokens in rows:
        cells[tuple(key)] += tokens
    total, weight = sum(cells.values()), dict(cells)
    for _ in range(sweeps):
        for d, shares in enumerate(targets):
            sums = defaultdict(float)
            for key, w in weight.items():
                sums[key[d]] += w
            weight = {key: w * shares[key[d]] * total / sums[key[d]] for key, w in weight.items()}
    return cells, weight


def test_raked_weights_equal_brute_force_and_targets(spark):
    rows = _rows()
    targets = [{"a": 0.5, "b": 0.3, None: 0.2}, {"en": 0.5, "fr": 0.5}, {"x": 0.7, "y": 0.3}]
    frames = {
        d: spark.createDataFrame(list(t.items()), "value string, share double")
        for d, t in zip(raking.DIMENSIONS, targets)
    }
    tokens, weight = _brute(rows, targets)
    cells = raking.raked(raking.cells_of(_frame(spark, rows)), frames)
    out = {(r["source"], r["lang"], r["topic"]): r for r in cells.collect()}
    assert out.keys() == weight.keys()
    for key, w in weight.items():
        assert out[key]["weight"] == pytest.approx(w, rel=1e-4) and out[key]["tokens"] == tokens[key]
    chances = raking.calibrated(cells, 0.6).collect()
    expected = sum(r["tokens"] * r["probability"] for r in chances)
    assert expected == pytest.approx(0.6 * sum(tokens.values()), rel=1e-6)
    scales = {round(r["probability"] * r["tokens"] / r["weight"], 6) for r in chances if r["probability"] < 1}
    assert len(scales) == 1 and all(r["probability"] <= 1 for r in chances)


def test_unnamed_values_keep_their_share(spark):
    rows = _rows()
    cells = raking.cells_of(_frame(spark, rows))
    given = {d: raking.tempered(cells, d, 1.0) for d in raking.DIMENSIONS}
    given["source"] = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "value string, share double")
    sums = defaultdict(lambda: [0, 0.0])
    for r in raking.raked(cells, given).collect():
        sums[r["source"]][0] += r["tokens"]
        sums[r["source"]][1] += r["weight"]
    assert sums[None][1] == pytest.approx(sums[None][0], rel=1e-4)
    assert sums["b"][1] == pytest.approx(3 * sums["a"][1], rel=1e-4)


def test_sample_follows_the_probabilities(spark):
    rows = _rows(6000)
    out = raking.mixed(_frame(spark, rows), {"source": 0.2, "lang": 0.5}, keep=0.5).collect()
    assert len(out) == 6000
    total = sum(r["tokens"] for r in out)
    assert sum(r["tokens"] for r in out if r["kept"]) == pytest.approx(0.5 * total, rel=0.05)
    by_cell = defaultdict(list)
    for r in out:
        by_cell[r["source"], r["lang"], r["topic"]].append(r)
    for held in by_cell.values():
        p = held[0]["probability"]
        assert abs(sum(r["kept"] for r in held) / len(held) - p) < 5 * (p * (1 - p) / len(held)) ** 0.5 + 1e-9
    again = raking.mixed(_frame(spark, rows[::-1]), {"source": 0.2, "lang": 0.5}, keep=0.5)
    assert {r["doc_id"] for r in again.collect() if r["kept"]} == {r["doc_id"] for r in out if r["kept"]}


def test_joined_by_shuffle_beyond_the_bound(spark, monkeypatch):
    rows = _rows(500)
    want = sorted(map(tuple, raking.mixed(_frame(spark, rows), {"source": 0.5}).collect()), key=repr)
    monkeypatch.setattr(raking, "MOST_CELLS", 0)
    assert sorted(map(tuple, raking.mixed(_frame(spark, rows), {"source": 0.5}).collect()), key=repr) == want


def test_defined_cases(spark, documents):
    text = F.col("text")
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "a b c", "en", None), (3, "a b c", "en", None), (None, "x", "fr", "s")]
    df = documents(rows).withColumns({"topic": raking.topic_of(text), "tokens": raking.tokens_of(text), "kept": F.lit("?")})
    out = raking.mixed(df, {"lang": 0.5}, keep=1.0).collect()
    assert len(out) == 5 and all(r["kept"] is True and r["probability"] == pytest.approx(1.0) for r in out)
    assert raking.mixed(df.where("false"), {}).count() == 0
