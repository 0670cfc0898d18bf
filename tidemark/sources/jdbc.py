"""Tables of an external database over JDBC (S3, K1-K3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def scan_options(
    url: str,
    table: str,
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a table scan; with ``column`` it is read in ranges, not by one task."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    bounds = (column, lower, upper, partitions)
    if any(b is not None for b in bounds):
        if any(b is None for b in bounds):
            raise ValueError("a partitioned scan needs column, lower, upper and partitions")
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **scan: object) -> DataFrame:
    """S3: table scan; Spark pushes filters and column choice to the database."""
    return spark.read.format("jdbc").options(**scan_options(**scan)).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    keep_definition: bool = False,
    properties: Mapping[str, str] | None = None,
) -> None:
    """K1-K3: append, overwrite, or (``keep_definition``) truncate and refill."""
    writer = df.write.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    writer.option("truncate", keep_definition).mode(mode).save()
