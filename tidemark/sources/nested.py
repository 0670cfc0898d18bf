"""Nested JSON series to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import is_month_period
from tidemark.functions.values import join_texts

SERIES_JSON = (
    "struct<Results: struct<series: array<struct<seriesID: string, data: array<struct<"
    "year: string, period: string, value: string, footnotes: array<struct<text: string>>>>>>>>"
)


def read_documents(spark: SparkSession, path: str, column: str = "json") -> DataFrame:
    """Landed documents (JSON answers, HTML pages), one per file."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias(column))


def flatten_series(df: DataFrame, json: str = "json") -> DataFrame:
    """One row per monthly observation, footnote texts joined by commas."""
    parsed = df.select(F.from_json(json, SERIES_JSON).alias("doc"))
    series = parsed.select(F.inline("doc.Results.series"))
    points = series.select(F.col("seriesID").alias("series_id"), F.inline("data"))
    notes = F.filter(F.transform("footnotes", lambda n: n["text"]), lambda t: t.isNotNull())
    return points.filter(is_month_period(F.col("period"))).select(
        "series_id",
        F.col("year").cast("int").alias("year"),
        "period",
        F.col("value").try_cast("double").alias("value"),
        join_texts(notes).alias("footnotes"),
    )
