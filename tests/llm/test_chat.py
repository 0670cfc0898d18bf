from __future__ import annotations

import json
import os
import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat

LAYOUTS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, "messages",
     [("user", "a"), ("assistant", "")]),
    ({"messages": []}, "messages", []),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, "conversations",
     [("user", "a"), ("assistant", "b")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i"), ("user", "x"), ("assistant", "o")]),
    ({"output": "o", "instruction": "i"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"prompt": "p", "completion": None}, "prompt", [("user", "p")]),
    ({"system": "s", "prompt": "p", "completion": "c"}, "prompt", [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "r"}, "response", [("user", "p"), ("assistant", "r")]),
    ({"question": "q", "answer": "a"}, "question", [("user", "q"), ("assistant", "a")]),
    ({"other": {"x": [1, 2.5]}}, None, None),
]


def test_layouts(spark):
    rows = [(k, json.dumps(record), "keeps") for k, (record, _, _) in enumerate(LAYOUTS)]
    rows += [(98, "no json", "keeps"), (99, None, "keeps")]
    out = chat.canonical_turns(spark.createDataFrame(rows, "k int, record string, _pieces string")).collect()
    found = {r["k"]: r for r in out}
    for k, (_, layout, turns) in enumerate(LAYOUTS):
        assert found[k]["layout"] == layout
        assert (found[k]["turns"] and [tuple(t) for t in found[k]["turns"]]) == (turns or found[k]["turns"])
    assert found[98]["turns"] is None and found[99]["layout"] is None and found[98]["_pieces"] == "keeps"


SPECIAL = st.text(st.sampled_from("a%<|>[]/sINT\n25C3B é\\"), max_size=12)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(SPECIAL, SPECIAL), max_size=4), min_size=1, max_size=30))
def test_round_trip(spark, conversations):
    rows = [(k, [{"role": r, "text": t} for r, t in turns]) for k, turns in enumerate(conversations)]
    df = spark.createDataFrame(rows, f"k int, turns {chat.TURNS}")
    for row in chat.read_back(chat.render(df, loss_role="a")).collect():
        turns = conversations[row["k"]]
        assert [tuple(t) for t in row["read_turns"]] == turns
        assert row["loss_texts"] == [t if r == "a" else "" for r, t in turns]
        assert "[" not in row["formatted"] and "</s>" not in row["formatted"]


def _turns(df, mappings=chat.MAPPINGS):
    records = chat.records_of_rows(df, "c", "t", "role", "text")
    return chat.turns_of_records(records, "c", "t", mappings=mappings)


def test_rows_become_records(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (None, 1, None, "x"), (1, 2, "assistant", "a")]
    df = spark.createDataFrame(rows, "c long, t long, role string, text string")
    found = {r["c"]: [tuple(t) for t in r["turns"]] for r in _turns(df).collect()}
    assert found == {1: [("user", ""), ("assistant", "a"), ("assistant", "b")], None: [("", "x")]}
    assert _turns(df.where("false")).count() == 0


ROLES = ("user", "assistant", "system", "human", "gpt", "tool", "", None)


def test_every_layout_gives_the_rows_back(spark):
    rows = [(c, t, ROLES[(c + t) % len(ROLES)], f"{c} <\\ \"{t}") for c in range(200) for t in range(4)]
    df = spark.createDataFrame(rows, "c long, t long, role string, text string")
    records = chat.records_of_rows(df, "c", "t", "role", "text")
    told = chat.canonical_turns(records)
    assert {r["layout"] for r in told.select("layout").distinct().collect()} == {m.name for m in chat.MAPPINGS}
    found = {r["c"]: ([tuple(t) for t in r["turns"]], r["n_unknown"]) for r in _turns(df).collect()}
    assert found == {
        c: ([(ROLES[(c + t) % len(ROLES)] or "", f"{c} <\\ \"{t}") for t in range(4)], 0) for c in range(200)
    }


def test_turns_come_through_the_fingerprints(spark):
    """Without a mapping, or with the wrong one, other turns come out and unknown records are told."""
    rows = [(c, t, ("user", "assistant")[t], f"{c}:{t}") for c in range(60) for t in range(2)]
    df = spark.createDataFrame(rows, "c long, t long, role string, text string")
    right = {r["c"]: (r["turns"], r["n_unknown"]) for r in _turns(df).collect()}
    few = [m for m in chat.MAPPINGS if m.name != "prompt"]
    less = {r["c"]: (r["turns"], r["n_unknown"]) for r in _turns(df, few).collect()}
    lost = {c for c, (turns, unknown) in less.items() if unknown == 2 and turns == []}
    assert lost and all(less[c] == right[c] for c in less.keys() - lost)
    answer_first = [
        replace(m, fields=(("$.answer", "user"), ("$.question", "assistant"))) if m.name == "question" else m
        for m in chat.MAPPINGS
    ]
    swapped = {r["c"]: r["turns"] for r in _turns(df, answer_first).collect()}
    changed = {c for c in swapped if swapped[c] != right[c][0]}
    assert changed and changed != set(swapped)
    assert all([t["role"] for t in swapped[c]] == ["assistant", "user"] for c in changed)


def test_records_with_many_turns(spark):
    rows = [(1, 1, json.dumps(LAYOUTS[0][0])), (1, 0, json.dumps({"prompt": "p", "response": "r"})), (1, 2, "{")]
    df = spark.createDataFrame(rows, "c long, t long, record string")
    row = chat.turns_of_records(df, "c", "t").first()
    assert [tuple(t) for t in row["turns"]] == [("user", "p"), ("assistant", "r"), *LAYOUTS[0][2]]
    assert row["n_unknown"] == 1


@pytest.mark.parametrize("n", [400])
def test_many_turns(spark, n):
    df = spark.range(n).select(
        F.lit(1).alias("c"), F.col("id").alias("t"), F.lit("user").alias("role"), F.repeat(F.lit("<x"), 500).alias("text")
    )
    out = chat.read_back(chat.render(_turns(df)))
    row = out.select(F.size("read_turns").alias("n"), F.col("read_turns")[n - 1]["text"].alias("t")).first()
    assert row["n"] == n and row["t"] == "<x" * 500


BEYOND = """
from pyspark.sql import SparkSession, functions as F
from tidemark.llm import chat

conf = {"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "2"}
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
text = F.when(F.col("id") % 2 == 0, F.repeat(F.lit("<"), 1_000_000)).otherwise(F.lit("b"))
df = spark.range(300).select(F.lit(1).alias("c"), "id", F.lit("user").alias("role"), text.alias("text"))
few = [(2, 2, "assistant", "b"), (2, 1, None, None), (None, 1, "user", "x")]
rows = df.union(spark.createDataFrame(few, "c int, id long, role string, text string"))
out = chat.turns_of_records(chat.records_of_rows(rows, "c", "id", "role", "text"), "c", "id")
size = F.aggregate("turns", F.lit(0), lambda total, t: total + F.length(t["text"]))
found = out.select("c", F.size("turns").alias("n"), size.alias("size"), F.element_at("turns", -1)["role"].alias("role"))
found = {r["c"]: (r["n"], r["size"], r["role"]) for r in found.collect()}
assert found == {1: (300, 150_000_150, "user"), 2: (2, 1, "assistant"), None: (1, 1, "user")}, found
one = spark.range(len(chat.MAPPINGS)).select(F.col("id").alias("c"), F.lit(0).alias("t"))
size = (F.col("c") + 140_000_000).cast("int")  # no constant, which plans would print
records = [m.written(F.lit("user"), F.repeat(F.lit("x"), size)) for m in chat.MAPPINGS]
record = F.coalesce(*(F.when(F.col("c") == k, r) for k, r in enumerate(records)))
large = chat.turns_of_records(one.repartition(1).withColumn("record", record), "c", "t")
large = large.select("n_unknown", F.size("turns").alias("n"), F.length(F.col("turns")[0]["text"]).alias("size"))
large = sorted(tuple(r) for r in large.collect())
assert large == [(0, 1, 140_000_000 + k) for k in range(len(chat.MAPPINGS))], large
"""


def test_conversations_beyond_the_size_of_a_variant():
    """In a process of its own, as the session of the tests has too little memory for a text of 150 MB."""
    own = {"PYTHONPATH": str(Path(chat.__file__).parents[2]), "PYSPARK_SUBMIT_ARGS": "--driver-memory 8g pyspark-shell"}
    done = subprocess.run([sys.executable, "-c", BEYOND], env=os.environ | own, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
