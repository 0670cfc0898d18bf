"""The sample tables seen as inputs of the star schema.

Orders stand for cases (customer = county, nation = state, region = country),
order priorities for indexes, lineitems for prices and labour series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

PRIORITY_SCORES = {
    "1-URGENT": "dowjones_score",
    "2-HIGH": "nasdaq100_score",
    "3-MEDIUM": "sp500_score",
}


# the sample tables; a given schema spares the job that would infer it from a file
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def county_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: counts per customer and day with state and country, one row per order.

    Only sums are taken of it, so orders are not grouped per customer first:
    that would shuffle them once more without making them fewer. Customers are
    broadcast when they are small enough; otherwise both sides are sorted, and
    AQE splits the partition of a customer with very many orders.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("date"),
        F.floor("o_totalprice").alias("confirmed"),
        (F.col("o_orderstatus") == "F").cast("long").alias("deaths"),
    )
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("n_name").alias("state"), F.col("r_name").alias("country"))
    )
    return orders.join(places, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("uid"), "state", "country", "date", "confirmed", "deaths"
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of the source, to bound a requested range by."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))


def state_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 per state and day."""
    counts = county_daily(spark, sf_dir).groupBy("state", "country", "date")
    return counts.agg(F.sum("confirmed").alias("confirmed"), F.sum("deaths").alias("deaths"))


def cumulative(daily: DataFrame, by: list[str]) -> DataFrame:
    """Running totals per place; a place has one row per day, so its window is short."""
    window = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumns({c: F.sum(c).over(window) for c in ("confirmed", "deaths")})


def index_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: index levels on weekdays, with gaps."""
    date = F.col("o_orderdate").cast("date")
    return (
        table(spark, sf_dir, "orders")
        .filter(F.weekday(date) < 5)
        .groupBy(date.alias("date"))
        .agg(
            *(
                F.max(F.when(F.col("o_orderpriority") == priority, F.col("o_totalprice"))).alias(score)
                for priority, score in PRIORITY_SCORES.items()
            )
        )
    )


def price_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: prices per brand and day; the aggregate is built before its shuffle."""
    brands = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("stock_ticker"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(brands, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("stock_ticker", F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.max("l_extendedprice").alias("High"),
            F.min("l_extendedprice").alias("Low"),
            F.max("l_quantity").alias("Open"),
            F.min("l_quantity").alias("Close"),
            F.sum("l_quantity").alias("Volume"),
            F.max("l_tax").alias("adj_close"),
        )
    )


def period(month: Column) -> Column:
    """Month number to ``M01`` - ``M12`` text."""
    return F.concat(F.lit("M"), F.lpad(month.cast("string"), 2, "0"))


def _series_id() -> Column:
    return F.concat("l_returnflag", F.lit("-"), "l_linestatus")


def series_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: monthly series."""
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(_series_id().alias("series_id"), month.alias("date"))
        .agg(F.sum("l_quantity").alias("value"))
    )


def series_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: raw series rows with many copies of a key."""
    return table(spark, sf_dir, "lineitem").select(
        _series_id().alias("series_id"),
        F.year("l_shipdate").alias("year"),
        period(F.month("l_shipdate")).alias("period"),
        F.col("l_quantity").alias("value"),
    )


def series_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: one column per series that the data hold."""
    return series_monthly(spark, sf_dir).groupBy("date").pivot("series_id").agg(F.max("value"))
