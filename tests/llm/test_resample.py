"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ordering, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    runs = [" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def _expected(rows, target, percent, least=20):
    own = Counter(b for _, t in rows for b in _features(t)[1])
    wanted = Counter(b for t in target for b in _features(t)[1])
    s_all, t_all = sum(own.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10000) / ((own[b] + 1) * (t_all + 10000))))
    out = []
    for i, text in rows:
        n, found = _features(text)
        weight = sum(gain(b) for b in found)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, len(found), weight, score, None])
    ranked = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0]))
    for k, row in enumerate(ranked[: percent * len(ranked) // 100]):
        row[5] = k + 1
    return sorted(tuple(r) for r in out)


def _got(docs, target, percent):
    model = resample.fit(docs, target)
    scores = resample.scored(docs, model).cache()
    return sorted(
        (r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in resample.drawn(scores, percent).collect()
    )


def _texts(n, seed):
    r = random.Random(seed)
    vocabulary = ["the", "The", "of", "ÄRGER", "été", "x1", "42", "don't", "a-b", "中文", "end."] + [f"w{k}" for k in range(60)]
    return [" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("percent", [5, 37, 100])
def test_equals_plain_python(spark, documents, percent):
    rows = list(enumerate(_texts(150, percent)))
    target = spark.createDataFrame([(k, t) for k, t in enumerate(_texts(20, 9))], "item_id long, text string")
    expected = _expected(rows, [r.text for r in target.collect()], percent)
    assert _got(documents(rows), target, percent) == expected


def test_pieces_continue_each_other(monkeypatch):
    text = " ".join(_texts(40, 3)).encode()
    whole = [np.concatenate([b for _, b in resample.feature_buckets(text, resample.Features(n))]) for n in (1, 2, 3, 5)]
    assert sorted(whole[2].tolist()) == sorted(_features(text.decode())[1])
    for size in (1, 2, 7, 300):
        monkeypatch.setattr(resample, "_PIECE", size)
        for n, expected in zip((1, 2, 3, 5), whole):
            found = np.concatenate([b for _, b in resample.feature_buckets(text, resample.Features(n))])
            assert sorted(found.tolist()) == sorted(expected.tolist())


def test_a_wrong_bracket_is_widened(spark, monkeypatch):
    scores = spark.createDataFrame([(k,) for k in range(1000)], "score long")
    for wanted in (1, 500, 1000):
        low, high, above = resample.bracket(scores, wanted, 1000, 0.01)
        assert high - low < 100 and above < wanted <= above + high - low + 1
    asked = []
    sketch = F.percentile_approx

    def errs(column, edges, accuracy):
        asked.append(edges)
        return F.transform(sketch(column, edges, accuracy), lambda e: e + 200) if len(asked) == 1 else sketch(column, edges, accuracy)

    monkeypatch.setattr(resample.F, "percentile_approx", errs)
    low, high, above = resample.bracket(scores, 500, 1000, 0.01)
    assert len(asked) == 2 and above < 500 <= above + high - low + 1


def test_defined_cases(spark, documents):
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(None, long), (None, long), (None, long + " x"), (3, None), (4, ""), (5, "..."), (6, long), (6, long), (7, "short")]
    docs = documents(rows).withColumnRenamed("source", "weight").withColumnRenamed("lang", "rank")
    target = spark.createDataFrame([], "item_id long, text string")
    out = resample.drawn(resample.scored(docs, resample.fit(docs, target)).cache(), 100).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == [1, 2, 3, 4, 5]
    assert {(r.doc_id, r.weight, r.n_features) for r in out if r.doc_id in (3, 4, 5)} == {(k, 0, 0) for k in (3, 4, 5)}
    kept = resample.resampled(docs, target, 100)
    assert kept.columns == docs.columns and kept.count() == 5
    assert resample.resampled(docs, target, 40).count() == 2
    empty = documents([])
    assert resample.drawn(resample.scored(empty, resample.fit(empty, target)), 5).count() == 0
    assert resample.resampled(empty, target).count() == 0


def test_rows_without_ids_do_not_share_their_noise(spark, documents):
    rows = [(None, f"{' '.join(f'w{k}' for k in range(30))} {j}") for j in range(200)]
    docs = documents(rows)
    scores = resample.scored(docs, resample.fit(docs, docs.limit(0))).collect()
    assert len({r.score - r.weight for r in scores}) > 150


def test_ties_go_to_smaller_ids_and_places_are_gapless(spark):
    scores = spark.createDataFrame(
        [(k, k % 5, 30, 1, 7, 7) for k in range(100)], "doc_id long, text_hash long, n_words long, n_features long, weight long, score long"
    )
    out = {r.doc_id: r["rank"] for r in resample.drawn(scores, 30).collect()}
    assert out == {k: k + 1 if k < 30 else None for k in range(100)}
    placed = ordering.placed(scores, [F.col("doc_id")], [F.col("doc_id")], "place", "test")
    assert sorted((r.doc_id, r.place) for r in placed.collect()) == [(k, k + 1) for k in range(100)]
