"""Rows the tables start with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.incremental import SEED_MARK
from tidemark.schemas import TABLES

# The labour and retail series (series_id, category, subcat1, subcat2).
LABOUR_SERIES = [
    ("payems", "Labor market", "All Employees, Total Nonfarm", ""),
    ("LNS14000006", "Labor market", "Unemployment Rate", "Black or African American"),
    ("LNS14000009", "Labor market", "Unemployment Rate", "Hispanic or Latino"),
    ("LNS14000003", "Labor market", "Unemployment Rate", "White"),
    ("LNS14032183", "Labor market", "Unemployment Rate", "Asian"),
    ("LNU04032215", "Labor market", "Unemployment Rate", "Management, Professional, and Related Occupations"),
    ("LNU04032218", "Labor market", "Unemployment Rate", "Service"),
    ("LNU04032219", "Labor market", "Unemployment Rate", "Sales and Office Occupations"),
    (
        "LNU04032222",
        "Labor market",
        "Unemployment Rate",
        "Natural Resources, Construction, and Maintenance Occupations",
    ),
    ("LNU04032226", "Labor market", "Unemployment Rate", "Production, Transportation and Material Moving Occupations"),
    ("CES4348100001", "Labor market", "All Employees", "Air Transportation"),
    ("CES6562000101", "Labor market", "All Employees", "Health Care"),
    ("CES6561000001", "Labor market", "All Employees", "Educational Services"),
    ("CES7071000001", "Labor market", "All Employees", "Arts, Entertainment, and Recreation"),
    ("unrate", "Labor market", "Unemployment Rate", "Overall"),
    ("jtsjol", "Labor market", "Job Openings", "Total Nonfarm"),
    ("LNS13023653", "Labor market", "Unemployment Level", "Job Losers on Layoff"),
    ("VMTD11", "Production & Business Activity", "Vehicle Miles Traveled", "Vehicle Miles Traveled"),
    ("AIRRPMTSID11", "Production & Business Activity", "Air Revenue Passenger Miles", "Air Revenue Passenger Miles"),
    ("MRTSSM7225USN", "Production & Business Activity", "Retail Sales", "Restaurants and Other Eating Places"),
    ("MRTSSM4541USS", "Production & Business Activity", "Retail Sales", "Electronic Shopping and Mail-order Houses"),
    ("MRTSSM4451USS", "Production & Business Activity", "Retail Sales", "Grocery Stores"),
    ("MRTSSM446USS", "Production & Business Activity", "Retail Sales", "Health and Personal Care Stores"),
]


def labour_series(spark: SparkSession) -> DataFrame:
    """The series dimension."""
    return spark.createDataFrame(LABOUR_SERIES, TABLES["bol_series_dim"].schema)


def initial_marks(spark: SparkSession) -> DataFrame:
    """One mark per table, before any load."""
    names = [(name,) for name in TABLES if name != "latest_data"]
    tables = spark.createDataFrame(names, "table_name string")
    return tables.withColumn("latest_date", F.lit(SEED_MARK).cast("timestamp"))
