"""Text outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.reshape import as_json


def write_text_list(df: DataFrame, column: str, path: str) -> None:
    """One value per line."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """K5: one JSON object per line."""
    as_json(df).write.mode("overwrite").text(path)
