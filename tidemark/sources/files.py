"""Delimited files and text lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import parse_header


def _layouts(spark: SparkSession, path: str, sep: str) -> dict[tuple[str, ...], list[str]]:
    """Column names of the first lines, with the files that have them in this order; no data is read."""
    reader = spark.read.option("header", True).option("sep", sep)
    found: dict[tuple[str, ...], list[str]] = {}
    if len(spark.read.text(path).inputFiles()) <= 1:
        return {tuple(reader.csv(path).columns): [path]}
    listed = spark.read.format("binaryFile").load(path).where("length > 0").select("path").orderBy("path")
    for (file,) in listed.collect():
        found.setdefault(tuple(reader.csv(file).columns), []).append(file)
    return found or {tuple(reader.csv(path).columns): [path]}


def csv_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names from the first lines of all files, each once; no data is read."""
    return list(dict.fromkeys(name for names in _layouts(spark, path, sep) for name in names))


def _read_by_header(
    spark: SparkSession,
    path: str,
    type_of: Callable[[str], T.DataType],
    keys: Callable[[str], bool],
    sep: str = ",",
    **options: str,
) -> DataFrame:
    """Files of a folder, each by its own header.

    Files with one header are one scan. Other orders of the columns are matched
    by name. Where files differ in the columns themselves, the row of a key is
    put together from all of them; of several values for one cell the largest is
    kept, values before nulls.
    """
    layouts = _layouts(spark, path, sep)
    reader = spark.read.option("header", True).option("sep", sep).options(**options)
    parts = [
        reader.schema(T.StructType([T.StructField(n, type_of(n)) for n in names])).csv(files)
        for names, files in layouts.items()
    ]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if len({frozenset(names) for names in layouts}) == 1:
        return df
    common = [n for n in df.columns if keys(n) and all(n in names for names in layouts)]
    return df.groupBy(*(F.col(f"`{n}`") for n in common)).agg(*(F.max(F.col(f"`{n}`")).alias(n) for n in df.columns if n not in common))


def read_wide_csv(
    spark: SparkSession, path: str, ids: T.StructType, measure: T.DataType = T.IntegerType()
) -> DataFrame:
    """Header CSV with id columns and one column per date, a file or a folder whose files may have other dates.

    The schema comes from the headers, so no file is scanned to infer it
    and a column keeps its type whatever today's values look like.
    """
    known = {f.name: f.dataType for f in ids}

    def type_of(name: str) -> T.DataType:
        return known.get(name) or (measure if parse_header(name) else T.StringType())

    return _read_by_header(spark, path, type_of, lambda name: not parse_header(name))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";") -> DataFrame:
    """CSV with another separator, columns matched by the header name of their own file."""
    types = {f.name: f.dataType for f in schema}
    df = _read_by_header(spark, path, lambda n: types.get(n, T.StringType()), lambda n: n in types, sep)
    return df.select(*schema.names)


def read_series_csv(
    spark: SparkSession,
    path: str,
    series: Sequence[str],
    start: dt.date | None = None,
    end: dt.date | None = None,
    date: str = "date",
) -> DataFrame:
    """Wide frame (date x series), limited to ``[start, end]``; files of a folder may have other series.

    A cell that is empty or ``.`` is a missing value.
    """
    type_of = lambda n: T.DateType() if n == date else T.DoubleType()
    df = _read_by_header(spark, path, type_of, lambda n: n == date, nullValue=".").select(date, *series)
    if start is not None:
        df = df.filter(F.col(date) >= start)
    return df if end is None else df.filter(F.col(date) <= end)


def read_text_list(spark: SparkSession, path: str, column: str = "value") -> DataFrame:
    """One value per line; empty lines are no values."""
    return spark.read.text(path).select(F.col("value").alias(column)).filter(F.col(column) != "")
