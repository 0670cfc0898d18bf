"""The star schema: columns, keys and layout of every table, and conforming to them.

Case counts are ``long``: those of the files are running totals, which need
not fit 32 bits. Percentages are ``decimal(18,5)``, dates are ``date``, the
high-water mark is a ``timestamp``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PCT = T.DecimalType(18, 5)

BY_DATE = ("date",)
BY_MONTH = ("year", "month")
BY_YEAR = ("year",)


@dataclass(frozen=True)
class Table:
    """One table: schema, primary key, references, text lengths, directory layout."""

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    lengths: Mapping[str, int] = field(default_factory=dict)
    layout: tuple[str, ...] = ()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def stored_schema(self) -> T.StructType:
        """The schema plus the layout columns that are derived from the date."""
        derived = [T.StructField(c, T.IntegerType()) for c in self.layout if c not in self.schema.names]
        return T.StructType([*self.schema.fields, *derived])


def _fields(*columns: str) -> list[T.StructField]:
    """Fields from ``name type`` texts; a trailing ``!`` marks NOT NULL."""
    parsed = []
    for column in columns:
        name, kind = column.rstrip("!").split(" ", 1)
        parsed.append(T.StructField(name, _TYPES[kind], not column.endswith("!")))
    return parsed


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "pct": PCT,
}


def _counts(prefix: str = "") -> list[T.StructField]:
    return _fields(
        f"{prefix}confirmed long!",
        f"{prefix}deaths long!",
        f"{prefix}confirmed_inc long",
        f"{prefix}deaths_inc long",
        f"{prefix}confirmed_inc_pct pct",
        f"{prefix}deaths_inc_pct pct",
    )


def _optional(fields: list[T.StructField]) -> list[T.StructField]:
    return [T.StructField(f.name, f.dataType, True) for f in fields]


_MONTH = _fields("year int!", "month int!", "month_name string")
_DAY = _fields("dateid long!", "date date!")
_SCORES = _fields("sp500_score double", "nasdaq100_score double", "dowjones_score double")
_PRICES = _fields("High double!", "Low double!", "Open double!", "Close double!", "Volume double!", "adj_close double!")
_US_PLACE = _fields(
    "UID long!",
    "iso2 string!",
    "iso3 string!",
    "code3 int!",
    "FIPS double",
    "Admin2 string",
    "Province_State string",
    "Country_Region string",
    "Lat double!",
    "Long_ double!",
    "Combined_Key string",
    "Population int",
)
_PLACE_LENGTHS = {
    "iso2": 16,
    "iso3": 16,
    "Admin2": 128,
    "Province_State": 32,
    "Country_Region": 32,
    "Combined_Key": 128,
}


def _entity_fact(entity: str, monthly: bool) -> T.StructType:
    months = _MONTH if monthly else []
    return T.StructType(
        [*_fields("dateid long!", f"{entity} string", "date date!"), *months, *_counts()]
    )


def _table(name: str, fields, **options) -> Table:
    schema = fields if isinstance(fields, T.StructType) else T.StructType(list(fields))
    return Table(name, schema, **options)


# Names, columns, types, keys and text lengths of the tables.
_COUNTRY = {"Country_Region": ("covid19_global_dim", "Country_Region")}
_TICKER = {"stock_ticker": ("stock_ticker_raw", "ticker")}

_ALL = [
    _table(
        "latest_data",
        _fields("table_name string!", "latest_date timestamp!"),
        key=("table_name",),
        lengths={"table_name": 128},
    ),
    _table(
        "covid19_us_raw",
        [*_US_PLACE, *_fields("date date!", "confirmed long!", "deaths long!")],
        lengths=_PLACE_LENGTHS,
        layout=BY_DATE,
    ),
    _table("covid19_us_dim", _US_PLACE, key=("UID",), lengths=_PLACE_LENGTHS),
    _table(
        "covid19_us_fact",
        _entity_fact("Province_State", monthly=False),
        key=("dateid", "Province_State"),
        lengths={"Province_State": 32},
        layout=BY_MONTH,
    ),
    _table(
        "covid19_us_monthly_fact",
        _entity_fact("Province_State", monthly=True),
        key=("dateid", "Province_State"),
        lengths={"Province_State": 32, "month_name": 32},
        layout=BY_MONTH,
    ),
    _table(
        "covid19_global_raw",
        _fields(
            "Country_Region string", "Lat double!", "Long_ double!", "date date!", "confirmed long!", "deaths long!"
        ),
        lengths={"Country_Region": 64},
        layout=BY_DATE,
    ),
    _table(
        "covid19_global_dim",
        _fields("Country_Region string", "Lat double!", "Long_ double!"),
        key=("Country_Region",),
        lengths={"Country_Region": 64},
    ),
    _table(
        "covid19_global_fact",
        _entity_fact("Country_Region", monthly=False),
        key=("dateid", "Country_Region"),
        references=_COUNTRY,
        lengths={"Country_Region": 64},
        layout=BY_MONTH,
    ),
    _table(
        "covid19_global_monthly_fact",
        _entity_fact("Country_Region", monthly=True),
        key=("dateid", "Country_Region"),
        references=_COUNTRY,
        lengths={"Country_Region": 64, "month_name": 32},
        layout=BY_MONTH,
    ),
    _table(
        "country_dim",
        _fields(
            "code string",
            "Name string",
            "Continent string",
            "Region string",
            "SurfaceArea double",
            "IndepYear int",
            "Population int",
            "LifeExpectancy double",
            "GNP int",
            "LocalName string",
            "GovernmentForm string",
            "HeadOfState string",
            "Capital int",
            "Code2 string",
        ),
        key=("code",),
        lengths={
            "code": 3,
            "Name": 64,
            "Continent": 32,
            "Region": 32,
            "LocalName": 64,
            "GovernmentForm": 64,
            "HeadOfState": 64,
            "Code2": 3,
        },
    ),
    _table("covid19_sum_fact", [*_DAY, *_counts("us_"), *_counts("global_")], key=("dateid",), layout=BY_MONTH),
    _table(
        "covid19_sum_monthly_fact",
        [*_DAY, *_MONTH, *_counts("us_"), *_counts("global_")],
        key=("dateid",),
        lengths={"month_name": 32},
        layout=BY_MONTH,
    ),
    _table(
        "stock_price_raw",
        [*_fields("stock_ticker string!", "date date!"), *_PRICES],
        lengths={"stock_ticker": 16},
        layout=BY_DATE,
    ),
    _table(
        "stock_ticker_raw",
        _fields(
            "ticker string!",
            "name string",
            "industry string",
            "subindustry string",
            "hq_location string",
            "cik string",
            "founded_year int",
        ),
        key=("ticker",),
        lengths={"ticker": 16, "name": 128, "industry": 64, "subindustry": 64, "hq_location": 64, "cik": 10},
    ),
    _table(
        "stock_index_fact",
        [*_DAY, *_fields("dowjones_score double!", "nasdaq100_score double!", "sp500_score double!")],
        key=("dateid",),
        layout=BY_MONTH,
    ),
    _table(
        "stock_index_monthly_fact",
        [*_DAY, *_MONTH, *_fields("dowjones_score double!", "nasdaq100_score double!", "sp500_score double!")],
        key=("dateid",),
        lengths={"month_name": 32},
        layout=BY_MONTH,
    ),
    _table(
        "stock_price_fact",
        [*_fields("dateid long!", "stock_ticker string!", "date date!"), *_PRICES],
        key=("dateid", "stock_ticker"),
        references=_TICKER,
        lengths={"stock_ticker": 16},
        layout=BY_DATE,
    ),
    _table(
        "stock_price_monthly_fact",
        [*_fields("dateid long!", "stock_ticker string!", "date date!"), *_MONTH, *_PRICES],
        key=("dateid", "stock_ticker"),
        references=_TICKER,
        lengths={"stock_ticker": 16, "month_name": 32},
        layout=BY_MONTH,
    ),
    _table(
        "bol_series_raw",
        _fields("series_id string!", "year int!", "period string", "value double", "footnotes string"),
        lengths={"series_id": 64, "period": 8, "footnotes": 128},
        layout=BY_YEAR,
    ),
    _table(
        "bol_series_dim",
        _fields("series_id string!", "category string!", "subcat1 string", "subcat2 string"),
        key=("series_id",),
        lengths={"series_id": 64, "category": 256, "subcat1": 256, "subcat2": 256},
    ),
    _table(
        "bol_series_fact",
        _fields("dateid long!", "series_id string!", "date date!", "value double"),
        key=("dateid", "series_id"),
        references={"series_id": ("bol_series_dim", "series_id")},
        lengths={"series_id": 64},
        layout=BY_DATE,
    ),
    _table(
        "covid_stock_fact", [*_DAY, *_counts("us_"), *_counts("global_"), *_SCORES], key=("dateid",), layout=BY_MONTH
    ),
    _table(
        "covid_stock_monthly_fact",
        [*_DAY, *_MONTH, *_counts("us_"), *_counts("global_"), *_SCORES],
        key=("dateid",),
        lengths={"month_name": 32},
        layout=BY_MONTH,
    ),
    _table(
        "covid_stock_bol_monthly_fact",
        [
            *_DAY,
            *_MONTH,
            *_fields("bol_series_id string!", "bol_series_value double!", "bol_series_value_raw double"),
            *_optional([*_counts("us_"), *_counts("global_")]),
            *_SCORES,
        ],
        key=("dateid", "bol_series_id"),
        references={"bol_series_id": ("bol_series_dim", "series_id")},
        lengths={"month_name": 32, "bol_series_id": 64},
        layout=BY_MONTH,
    ),
]

TABLES: dict[str, Table] = {table.name: table for table in _ALL}


#: What loads know of their inputs, beside the tables: marks by entity, and the versions of files that were read.
ENTITY_MARKS = _table(
    "entity_marks",
    _fields("table_name string!", "entity string!", "latest date!"),
    key=("table_name", "entity"),
    layout=("table_name",),
)
FILE_LEDGER = _table(
    "file_ledger",
    _fields(
        "table_name string!", "file string!", "length long!", "modified timestamp!", "until date!", "last_date date",
        "n_rows long!", "digest long!",
    ),
    key=("table_name", "file"),
    layout=("table_name",),
)


def conform(df: DataFrame, table: Table | str) -> DataFrame:
    """DQ1: the declared columns in the declared order and types.

    Casts run in ANSI mode, so a value that does not fit raises an error
    instead of being stored wrong.
    """
    schema = (TABLES[table] if isinstance(table, str) else table).schema
    return df.selectExpr(*(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema))
