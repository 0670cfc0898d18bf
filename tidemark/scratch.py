"""Where intermediate files go."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a folder below the warehouse, which the executors share
    as well.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable."""
    checkpoint_root(spark)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when each job ends, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a fresh scratch folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    with tidy_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Shelf:
    """Intermediate tables by name; a name that is stored anew drops what it held before."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_folder(self._spark, name)
        with tidy_shuffles(self._spark):
            df.write.parquet(path)
        self.drop(name)
        self._paths[name] = path
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self._paths:
                remove_folder(self._spark, self._paths.pop(name))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more, on whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
