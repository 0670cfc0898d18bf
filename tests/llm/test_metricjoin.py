from __future__ import annotations

import random
import re
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard, metricjoin
from tidemark.llm.components import components
from tidemark.llm.jaccard import Measure
from tidemark.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _set(text, words):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = WORD.findall(low)
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[k : k + words]) for k in range(len(found) - words + 1))


def _expected(rows, measure):
    sets = [(i, _set(t, measure.words)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and measure.den * len(x & y) >= measure.num * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, len(s), least[root(k)]) for k, (i, s) in enumerate(sets))


def _got(df, measure):
    return sorted((r["doc"], r["n"], r["component"]) for r in metricjoin.joined(df, measure).collect())


def _edited(text, r, edits):
    words = text.split()
    for _ in range(edits):
        k = r.randrange(len(words))
        words[k] = r.choice(["new", "other", words[k].upper()]) + str(r.randrange(3))
    return " ".join(words)


def _families(seed, families=12, n=80):
    """Documents in families of edited copies, with passages shared between families."""
    r = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(25))
    rows = []
    for f in range(families):
        base = " ".join(f"w{r.randrange(300)}" for _ in range(r.randint(3, 60)))
        if f % 3 == 0:
            base += " " + passage
        text = base
        for _ in range(r.randint(1, n // families)):
            rows.append(text)
            text = _edited(r.choice([base, text]), r, r.randint(0, 4))
    ids = r.sample(range(1000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize(("seed", "measure"), [(1, Measure()), (2, Measure(4, 85, 100)), (3, Measure(1, 1, 2)), (4, Measure(2, 3, 5))])
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
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO\n"), (6, "one two"), (7, "two one"), (6, "one two")]
    df = documents(rows).withColumnRenamed("source", "component")
    measure = Measure()
    assert _got(df, measure) == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 4), (6, 1, 4), (7, 1, 7)]
    kept = metricjoin.keep_one(df, measure)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 7]
    assert metricjoin.keep_one(documents([]), measure).count() == 0


def test_rows_without_or_with_equal_ids(spark, documents):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(None, long), (9, long + " end"), (5, "a b c d e f g"), (5, long + " x"), (5, "quite other words than those")]
    out = metricjoin.joined(documents(rows), Measure()).collect()
    assert sorted(r["component"] for r in out) == [5, 5, 5, 5, 5]
    assert len({r["class"] for r in out}) == 5
    kept = metricjoin.keep_one(documents([(None, long), (9, long + " end")]), Measure()).collect()
    assert [r["doc_id"] for r in kept] == [9]


def test_shingle_sets_tell_texts_apart():
    r = random.Random(2)
    texts = [" ".join(r.choice(["a", "B", "b", "é", "ab"]) for _ in range(r.randint(0, 9))) for _ in range(400)]
    hashed = list(shingle_sets(texts, 3))
    by_set = {}
    for text, own in zip(texts, hashed):
        expected = _set(text, 3)
        assert len(own) == len(expected) and (np.diff(own.astype(object)) > 0).all()
        assert by_set.setdefault(expected, own.tolist()) == own.tolist()


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 102), (102, 101), (300, 200), (7, 7)]
    out = components(spark.createDataFrame(edges, "u long, v long")).collect()
    found = {r["node"]: r["component"] for r in out}
    assert len(out) == len(found)
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, 300: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_equal_ids_and_rows_without_words_lose_no_document(spark, documents):
    long = " ".join(f"w{k}" for k in range(40))
    stay = [(5, long + " x"), (5, "quite other words than those"), (1, "a b c d e f g"), (1, "h i j k l m n"),
            (None, None), (None, None), (None, " "), (3, ""), (3, ""), (7, "same text twice here now")]
    go = [(9, long), (7, "same text twice here now"), (8, "SAME text twice here  now")]
    kept = metricjoin.keep_one(documents(stay + go), Measure()).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted(stay, key=repr)


def test_ids_of_all_64_bits(spark, documents):
    low, high = -(1 << 63), (1 << 63) - 1
    rows = [((1 << 62) + 5, "a b c d e f g"), ((1 << 62) + 6, "A b c d e f g"), (low, "h i j"), (high, "H i j")]
    expected = [(low, 1, low), ((1 << 62) + 5, 3, (1 << 62) + 5), ((1 << 62) + 6, 3, (1 << 62) + 5), (high, 1, low)]
    assert _got(documents(rows), Measure()) == expected


def test_columns_with_the_names_used_inside_survive(spark, documents):
    df = documents([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y")])
    df = df.withColumnsRenamed({"lang": "doc", "source": "text_hash"})
    kept = metricjoin.keep_one(df, Measure())
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_only_texts_that_may_be_wanted_meet_the_wanted(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 1000 > 0, F.col("id")).alias("doc"), F.xxhash64("id").alias("text_hash"), F.lit("a b c d").alias("text")
    )
    wanted = rows.where("text_hash % 50 = 0").select("doc", "text_hash")
    keyed = rows.withColumn("key", F.xxhash64("doc", "text_hash"))
    bitmap = jaccard.row_filter(wanted)
    passing = keyed.mapInArrow(partial(jaccard._passing, bitmap), rows.schema).select("doc", "text_hash").collect()
    asked = {tuple(r) for r in wanted.collect()}
    assert asked <= {tuple(r) for r in passing} and len(passing) < 1.5 * len(asked)
    assert not jaccard.row_filter(wanted.where("false")).any()
