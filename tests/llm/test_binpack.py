from __future__ import annotations

import random
import zlib
from collections import defaultdict

from tidemark.llm import binpack


def _placed(df, shards=8, pieces=binpack.PIECES):
    weighed = binpack.measured(df)
    return binpack.slotted(weighed, binpack.pack(weighed, shards, pieces)).collect()


def _rows(n, hot=0, seed=1):
    r = random.Random(seed)
    rows = [(k, " ".join(["wé"] * r.randint(1, 60)) + str(k)) for k in range(n)]
    return rows + [(n + k, "copied text " * 8) for k in range(hot)]


def test_sizes_near_equal_and_slots_gapless(spark, documents):
    rows = _rows(1500, hot=120)
    out = _placed(documents(rows))
    by_shard, by_text, texts = defaultdict(list), defaultdict(set), dict(rows)
    for r in out:
        by_shard[r["shard"]].append(r)
        by_text[texts[r["doc_id"]]].add(r["shard"])
        encoded = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(encoded) + 1, zlib.crc32(encoded))
    assert len(out) == len(rows) and sorted(by_shard) == list(range(8))
    assert all(sorted(r["slot"] for r in held) == list(range(len(held))) for held in by_shard.values())
    assert all(len(s) == 1 for s in by_text.values())
    sums = [sum(r["size"] for r in held) for held in by_shard.values()]
    tokens = [sum(r["tokens"] for r in held) for held in by_shard.values()]
    assert max(sums) - min(sums) < 0.03 * sum(sums) / 8
    assert max(tokens) - min(tokens) < 0.2 * sum(tokens) / 8


def test_group_above_a_shard_is_split(spark, documents):
    out = _placed(documents([(k, "the same text") for k in range(600)] + _rows(300)[:300]))
    sums = defaultdict(int)
    for r in out:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) - min(sums.values()) < 0.1 * sum(sums.values()) / 8


def test_assign_agrees_with_slots(spark, documents):
    df = documents(_rows(200, hot=30)).withColumnRenamed("source", "shard")
    weighed = binpack.measured(df)
    plan = binpack.pack(weighed, 4, 16)
    slots = {r["doc_id"]: r["shard"] for r in binpack.slotted(weighed, plan).collect()}
    out = binpack.assign(df, plan)
    assert sorted(out.columns) == sorted(df.columns)
    assert {r["doc_id"]: r["shard"] for r in out.collect()} == slots


def test_defined_cases(spark, documents):
    rows = [(1, None), (2, None), (3, ""), (4, "x"), (4, "x"), (None, "y"), (5, "long " * 50_000)]
    out = _placed(documents(rows))
    assert len(out) == 7
    assert sorted(r["size"] for r in out) == [1, 1, 1, 2, 2, 2, 250_001]
    assert _placed(documents([])) == []
