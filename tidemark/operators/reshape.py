"""Wide frames to long ones (P2, R1-R3) and columns to arrays and JSON (K5, K6).

Frames with one column per date have thousands of columns. Their expressions
are handed over as one SQL text, since building a Column object per name takes
milliseconds each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import dateid, parse_header


def date_columns(columns: Sequence[str]) -> dict[str, dt.date]:
    """Columns whose name is a date, with that date, in file order."""
    dated = ((name, parse_header(name)) for name in columns)
    return {name: date for name, date in dated if date is not None}


def dates_in_range(
    columns: Sequence[str],
    after: dt.date | None = None,
    until: dt.date | None = None,
    skip_first: int = 0,
) -> dict[str, dt.date]:
    """Date columns in ``(after, until]``; ``skip_first`` drops leading ones."""
    dated = list(date_columns(columns).items())[skip_first:]
    return {
        name: date
        for name, date in dated
        if (after is None or date > after) and (until is None or date <= until)
    }


def slice_dates(
    df: DataFrame,
    ids: Sequence[str],
    after: dt.date | None = None,
    until: dt.date | None = None,
    skip_first: int = 0,
) -> DataFrame:
    """The id columns and only the date columns in ``(after, until]``."""
    wanted = dates_in_range(df.columns, after, until, skip_first)
    return df.selectExpr(*map(quoted, ids), *map(quoted, wanted))


def same_dtype(df: DataFrame, columns: Sequence[str]) -> str:
    """DQ4: the one type of these columns; an error when they differ."""
    types = dict(df.dtypes)
    found = {types[name] for name in columns}
    if len(found) != 1:
        raise TypeError(f"columns to unpivot must share one type, found {sorted(found)}")
    return found.pop()


def unpivot(df: DataFrame, ids: Sequence[str], key: str, value: str) -> DataFrame:
    """Every column outside ``ids`` becomes a (key, value) row.

    Rows are zipped from two arrays, in one projection however many columns there are.
    """
    values = [c for c in df.columns if c not in ids]
    same_dtype(df, values)
    names = ", ".join(map(_text, values))
    return df.selectExpr(*map(quoted, ids), f"inline(arrays_zip(array({names}), {_array(values)})) AS ({key}, {value})")


def unpivot_structs(df: DataFrame, ids: Sequence[str], key: str, value: str) -> DataFrame:
    """The same rows from an exploded array of structs."""
    values = [c for c in df.columns if c not in ids]
    same_dtype(df, values)
    pairs = ", ".join(f"named_struct('{key}', {_text(c)}, '{value}', {quoted(c)})" for c in values)
    exploded = df.selectExpr(*map(quoted, ids), f"explode(array({pairs})) AS pair")
    return exploded.select(*map(quoted, ids), f"pair.{key}", f"pair.{value}")


def pack_columns(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """Same-typed columns as one array column, so that a plan carries one column instead of thousands."""
    same_dtype(df, columns)
    return df.selectExpr(*map(quoted, ids), f"{_array(columns)} AS {quoted(name)}")


def unpack_dates(
    df: DataFrame, ids: Sequence[str], dates: Sequence[dt.date], measures: Sequence[str], date: str = "date"
) -> DataFrame:
    """R1 for several packed measures at once: one row per (ids, date) holding every measure.

    ``dates`` are the dates of the array positions. Rows are built in place, so
    nothing is shuffled, and the header is parsed once instead of once per row.
    """
    days = ", ".join(f"DATE'{d.isoformat()}'" for d in dates)
    arrays = ", ".join([f"array({days})", *map(quoted, measures)])
    names = ", ".join([date, *measures])
    return df.selectExpr(*map(quoted, ids), f"inline(arrays_zip({arrays})) AS ({names})")


def series_to_long(df: DataFrame, date: str = "date") -> DataFrame:
    """R2: (date x series columns) to (date, dateid, series_id, value)."""
    long = unpivot(df, [date], "series_id", "value")
    return long.select(date, dateid(F.col(date)).alias("dateid"), "series_id", "value")


def ordered_arrays(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), order: str = "date"
) -> DataFrame:
    """K6: columns as arrays sorted by ``order``, all in one pass.

    The input must hold one row per (``by``, ``order``) and be limited to a date
    range, which bounds each array by the days of that range.
    """
    fields = [c for c in columns if c != order]
    rows = F.array_sort(F.collect_list(F.struct(order, *fields)))
    grouped = df.groupBy(*by).agg(rows.alias("_rows"))
    return grouped.select(*by, *(F.col("_rows")[c].alias(c) for c in columns))


def as_json(df: DataFrame, alias: str = "json") -> DataFrame:
    """K5: each row as one JSON object text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(alias))


def quoted(column: str) -> str:
    """A column name as SQL text."""
    return "`" + column.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _array(columns: Sequence[str]) -> str:
    return f"array({', '.join(map(quoted, columns))})"
