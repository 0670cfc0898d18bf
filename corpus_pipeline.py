"""A training corpus from the table ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next one's ``docs``. All but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import binpack, kneser, metricjoin, raking, spacedseed
from tidemark.llm.jaccard import Measure
from tidemark.scratch import stored

SHARDS = 8
#: Token shares to these powers are the targets of the mixture.
POWERS = {"source": 0.8, "lang": 0.8, "topic": 1.0}
KEEP = 0.9


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the perplexity that trusted text of their language has."""
    trusted = _table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return kneser.keep_good(docs, trusted)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 8 in 10 five-word shingles."""
    return metricjoin.keep_one(docs, Measure(words=5, num=4, den=5))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of ``benchmark``."""
    return spacedseed.without_overlaps(docs, _table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of nine tenths of the tokens in which sources and languages come nearer to each other."""
    text = F.col("text")
    with_cells = docs.withColumns({"topic": raking.topic_of(text), "tokens": raking.tokens_of(text)})
    chosen = raking.mixed(with_cells, POWERS, keep=KEEP)
    return chosen.where("kept").select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard."""
    weighed = stored(binpack.measured(docs), "weighed")
    return binpack.assign(docs, binpack.pack(weighed, SHARDS))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixture),
    ("sharding", shards),
]

#: The fitted stages (perplexities, components, raked weights) are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
