from __future__ import annotations

import os

import corpus_pipeline
import oracle
import pytest

from tidemark.llm.registry import LLM_QUERIES, LLM_SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NATIVE = ("op2_chat_format", "op3_quality_rules", "op6_spaced_seeds", "op7_raked_mixture")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no sample tables")


@pytest.mark.parametrize("name", list(LLM_SQL))
def test_query_equals_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(SF_DIR), LLM_QUERIES[name], LLM_SQL[name], SF_DIR) is None


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, name):
    plan = LLM_QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_stages(spark):
    """Each stage keeps whole rows of its input; what goes and stays is as each operator says."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        rows = [tuple(r) for r in out.select(*columns).collect()]
        assert len(rows) == len(set(rows)) and set(rows) <= before and rows
        docs, before = spark.createDataFrame(rows, docs.schema), set(rows)
    shards = {r["shard"] for r in out.collect()}
    assert shards <= set(range(8))
    texts = [r[columns.index("text")] or "" for r in rows]
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert not any(item in text for item in items for text in texts)
    assert len(texts) == len(set(texts))
