"""Price files per ticker with a quarantine for broken lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of a price file.
PRICE_COLUMNS = ("Date", "High", "Low", "Open", "Close", "Volume", "Adj Close")

_MEASURES = ("High", "Low", "Open", "Close", "Volume", "adj_close")


_TICKER = r"^(.*?)\.csv"


def list_price_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, stock_ticker, length, modified) of the files in a folder; their content is not read."""
    about = F.col("_metadata")
    return spark.read.format("binaryFile").load(path).select(
        about["file_path"].alias("file"),
        "path",
        F.regexp_extract(about["file_name"], _TICKER, 1).alias("stock_ticker"),
        about["file_size"].alias("length"),
        about["file_modification_time"].alias("modified"),
    )


def read_price_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line of ``<ticker>.csv`` files; ``broken`` holds the text of unusable ones, ``file`` the file.

    Values are found by the header of their own file, whatever the order of
    its columns. A line is unusable when it has another number of cells than
    the header, when a cell does not parse, or when its file's header lacks the
    date or a measure. Headers are one line per file; they meet the lines by
    file name.
    """
    file = F.col("_metadata.file_path").alias("_file")
    ticker = F.regexp_extract(F.col("_metadata.file_name"), _TICKER, 1).alias("stock_ticker")
    lines = spark.read.text(path).select(file, ticker, F.rtrim(F.col("value")).alias("_line"))
    is_header = F.col("_line").rlike(r"(^|,)\s*Date\s*(,|$)")
    cells = F.transform(F.split("_line", ","), lambda c: F.trim(c))
    headers = lines.filter(is_header).groupBy("_file").agg(F.first(cells).alias("_names"))
    data = lines.filter(~is_header & (F.col("_line") != "")).join(headers, "_file", "left")
    values = data.withColumn("_cells", cells)
    whole = F.size("_cells") == F.size("_names")

    def cell(name: str):
        at = F.array_position("_names", name)
        return F.when(whole & (at > 0), F.get("_cells", (at - 1).cast("int")))

    dated = values.select(
        F.col("_file").alias("file"),
        "stock_ticker",
        "_line",
        F.try_to_date(cell("Date"), "yyyy-MM-dd").alias("date"),
        *(cell(c).try_cast("double").alias(c.lower().replace(" ", "_") if " " in c else c) for c in PRICE_COLUMNS[1:]),
    )
    missing = F.greatest(*(F.col(c).isNull() for c in ("date", *_MEASURES)))
    return dated.select("file", "stock_ticker", "date", *_MEASURES, F.when(missing, F.col("_line")).alias("broken"))


def good_prices(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("broken").isNull()).drop("broken")


def quarantined(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("broken").isNotNull()).select("file", "stock_ticker", "broken")


def file_versions(files: DataFrame, lines: DataFrame, ledger: DataFrame, end) -> DataFrame:
    """Each of the listed files as it is now, and whether it only grew since the version in the ledger.

    A version is known by the number and a digest of its good rows up to the
    last date that was loaded of it. The same rows up to that date mean that the
    file was only added to.
    """
    row = F.xxhash64("stock_ticker", "date", *_MEASURES)
    until = F.least("until", "last_date").alias("old_until")
    before = ledger.select("file", until, F.col("n_rows").alias("old_n_rows"), F.col("digest").alias("old_digest"))
    good = good_prices(lines).join(before.select("file", "old_until"), "file", "left")
    then, now = F.col("date") <= F.col("old_until"), F.col("date") <= F.lit(end)
    sums = good.groupBy("file").agg(
        F.max("date").alias("last_date"),
        F.count_if(now).alias("n_rows"),
        F.bit_xor(F.when(now, row)).alias("digest"),
        F.count_if(then).alias("_n_then"),
        F.bit_xor(F.when(then, row)).alias("_digest_then"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    known = files.join(sums, "file", "left").join(before, "file", "left")
    grew = (zero("_n_then") == F.col("old_n_rows")) & (zero("_digest_then") == F.col("old_digest"))
    return known.select(
        "file",
        "stock_ticker",
        "length",
        "modified",
        F.lit(end).alias("until"),
        "last_date",
        zero("n_rows").alias("n_rows"),
        zero("digest").alias("digest"),
        F.col("old_until").isNotNull().alias("known"),
        F.coalesce(grew, F.lit(False)).alias("grew"),
    )
