"""The burst trie against a trie of dictionaries."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import bursttrie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn int, role string, text string, rep string, depth int, row long"


def _turns(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}


def _regrafted(own):
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rest = abs(c) % 20 if c >= 0 else -(abs(c) % 20)
        out[c] = own.get(c - rest, [])[:h] + mine[h:]
    return out


def _nodes(convs):
    members, children = defaultdict(list), defaultdict(set)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
            if d:
                children[tuple(path[: d - 1])].add(tuple(path[:d]))
    out = []

    def subtree(path):
        leaves = saved = 0
        for child in children[path]:
            more, tokens = subtree(child)
            leaves, saved = leaves + more, saved + tokens
        if path:
            saved += (len(members[path]) - 1) * len(WORD.findall(path[-1][1]))
        leaves = leaves or 1
        ends = sorted(c for c in members[path] if len(convs[c]) == len(path))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        out.append((min(members[path]), len(path), parent, len(members[path]), len(children[path]), leaves, saved, digest))
        return leaves, saved

    if convs:
        subtree(())
    return sorted(out, key=repr)


def _got(df, regraft, most_turns):
    rows = bursttrie.turns(df, "conv_id", "turn", "role", "text")
    rows = bursttrie.regrafted(rows) if regraft else bursttrie.conversations(rows)
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in names) for r in bursttrie.trie(rows, most_turns).collect()), key=repr)


def _rows(seed, n=60):
    r = random.Random(seed)
    vocabulary = [("system", "be kind now"), ("user", "hi"), ("user", "hi there"), ("assistant", "yes"), ("assistant", None), (None, "x y")]
    rows = []
    for c in range(n):
        opening = [vocabulary[0]] * (c % 2) + [vocabulary[1]] * r.randint(0, 3)
        path = opening + [r.choice(vocabulary) for _ in range(r.randint(0 if opening else 1, 5))]
        turns = r.sample(range(-3, 20), len(path)) if c % 7 else [None] + list(range(len(path) - 1))
        rows += [(c * 3 - 20, t, *p, "a", 1, 2) for t, p in zip(sorted(turns, key=lambda t: (t is not None, t or 0)), path)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("most_turns", [1, 20, 4096])
@pytest.mark.parametrize("regraft", [True, False])
def test_equals_a_plain_trie(spark, most_turns, regraft):
    rows = _rows(most_turns)
    own = _turns(rows)
    expected = _nodes(_regrafted(own) if regraft else own)
    assert _got(spark.createDataFrame(rows, SCHEMA), regraft, most_turns) == expected


def test_many_copies_and_a_long_conversation(spark, monkeypatch):
    rows = [(c, t, "user", f"turn {t}", "", 0, 0) for c in range(40) for t in range(3)]
    rows += [(c, t, "user", f"turn {t}", "", 0, 0) for c in (100, 101) for t in range(6000 + c % 2)]
    monkeypatch.setattr(bursttrie, "_IDS_PER_CHUNK", 7)
    expected = _nodes_of_runs(rows)
    got = _got(spark.createDataFrame(rows, SCHEMA), False, 50)
    assert len(got) == 6002
    for row in expected:
        assert row in got


def _nodes_of_runs(rows):
    """The nodes where something happens in ``test_many_copies_and_a_long_conversation``."""
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return [
        (0, 0, None, 42, 1, 1, 3 * 2 * 41 + 5997 * 2, sha([])),
        (0, 3, 0, 42, 1, 1, 2 * 41 + 5997 * 2, sha(range(40))),
        (100, 4, 0, 2, 1, 1, 5997 * 2, sha([])),
        (100, 6000, 100, 2, 1, 1, 2, sha([100])),
        (101, 6001, 100, 1, 0, 1, 0, sha([101])),
    ]


def test_defined_cases(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert _got(df, True, 10) == []
    rows = [(None, 1, "user", "x", "", 0, 0), (5, 1, None, None, "", 0, 0), (5, 1, "", "", "", 0, 0), (5, None, "b", "b b", "", 0, 0),
            (-3, 2, "user", "t " * 30000, "", 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for regraft in (True, False):
        own = _turns(rows)
        assert _got(df, regraft, 1) == _nodes(_regrafted(own) if regraft else own)
