from __future__ import annotations

import hashlib
import random
from collections import Counter

from tidemark.llm import linedup


def _key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def _expected(rows, least):
    split = [(i, (t or "").split("\n")) for i, t in rows]
    docs = Counter(k for _, lines in split for k in {_key(x) for x in lines} if k)
    out = []
    for i, lines in split:
        kept = [x for x in lines if docs[_key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def _got(df, **how):
    out = linedup.drop_lines(df, linedup.frequent_lines(df, **how), keep_text=False)
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_equals_brute_force(spark, documents):
    r = random.Random(3)
    lines = ["Common", " common\t", "COMMON", "É", "é", "", "  ", "x y", "\x0bx y\r", *map(str, range(20))]
    rows = [(k, "\n".join(r.choice(lines) for _ in range(r.randint(0, 8)))) for k in range(120)]
    rows += [(500, None), (501, ""), (None, "Common\nown"), (502, "common\n" * 5000 + "end")]
    for batches in (1, 2, 5):
        assert _got(documents(rows), least=10, batches=batches) == _expected(rows, 10)


def test_runs_are_merged_by_level(spark, documents):
    runs = linedup.LineRuns(spark, fanout=2, least=3)
    total = Counter()
    for b in range(5):
        rows = [(k, f"hot\nb{b}\nk{k % 4}") for k in range(4)]
        runs.add(linedup.document_lines(documents(rows)))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    total = {r["hash"]: r["n"] for r in runs.counts().collect()}
    assert total[linedup.line_hash(b"hot")] == 4  # known from three documents on: not counted again
    assert total[linedup.line_hash(b"k1")] == 3 or total[linedup.line_hash(b"k1")] == 5
    assert total[linedup.line_hash(b"b4")] == 4


def test_defined_cases(spark, documents):
    assert _got(documents([])) == []
    rows = [(7, "same\nx")] * 12
    assert _got(documents(rows)) == _expected(rows, 10)
    df = documents([(k, "Line\nown" + str(k)) for k in range(10)]).withColumnRenamed("source", "gone")
    out = linedup.drop_lines(df, linedup.frequent_lines(df)).collect()
    assert sorted(r["kept_text"] for r in out) == [f"own{k}" for k in range(10)]
