"""Landed files as a stream: each micro-batch runs the batch load (I8)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.cases import aggregate_fact_to_monthly_fact_us, transform_raw_to_fact_us
from tidemark.plans.steps import Bounds, finished
from tidemark.schemas import conform
from tidemark.scratch import stored
from tidemark.sinks.warehouse import Warehouse


def process_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    load: Callable[..., None],
    checkpoint: str,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    options: dict[str, str] | None = None,
    numbered: bool = False,
) -> None:
    """Hand every file that arrived since the last call to ``load``, then stop.

    The stream's checkpoint remembers the files. A batch may be handed over
    again after a failure, so ``load`` must be repeatable; with ``numbered`` it
    gets the number of the batch as well, which stays the same then.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**(options or {}))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.load(folder)
        .writeStream.foreachBatch(lambda batch, number: load(batch, number) if numbered else load(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_county_days(wh: Warehouse, batch: DataFrame) -> None:
    """One batch of raw county rows: store its days, then refresh the facts.

    A day may come in several files and late: what is stored of it stays,
    counties that come again are replaced, and the facts are taken back to
    before the oldest day of the batch.
    """
    raw = "covid19_us_raw"
    new = stored(conform(batch, raw).dropDuplicates(["UID", "date"]), "county-days")
    span = new.agg(F.min("date"), F.max("date")).first()
    if span[0] is None:
        return
    low = span[0] - dt.timedelta(days=1)
    there = wh.read(raw, after=low, until=span[1]).join(new.select("date").distinct(), "date", "left_semi")
    kept = there.join(new.select("UID", "date"), ["UID", "date"], "left_anti").select(*new.columns)
    wh.load(raw, new.unionByName(kept))
    finished(wh, raw, Bounds(low, span[1]))
    transform_raw_to_fact_us(wh)
    aggregate_fact_to_monthly_fact_us(wh)


def store_batch(rows: DataFrame, path: str, number: int) -> None:
    """Keep what one micro-batch contributes in a folder of its own; a repeated batch replaces itself only."""
    part = rows.withColumn("batch", F.lit(number).cast("long"))
    part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def summed_batches(spark: SparkSession, path: str, keys: list[str], sums: list[str]) -> DataFrame:
    """Sums over all micro-batches: days that several of them hold add up."""
    return spark.read.parquet(path).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


def daily_counts(events: DataFrame) -> DataFrame:
    """Events and their values per type and day."""
    day = F.to_date("ts").alias("date")
    cents = F.round(F.col("value") * 100).cast("long")
    return events.groupBy("event_type", day).agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("cents"))
