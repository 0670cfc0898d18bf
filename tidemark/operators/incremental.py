"""High-water marks and increments as plain DataFrame steps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregate import last_per_key, month_rollup
from tidemark.operators.select import replace_where
from tidemark.operators.windows import add_previous_diff

# The seed of every mark, and the date after which a load resumes.
SEED_MARK = dt.date(1990, 1, 1)
FIRST_MARK = dt.date(1990, 1, 2)


def is_resume(mark: dt.date | None) -> bool:
    """A table has been loaded before."""
    return mark is not None and mark > FIRST_MARK


def set_mark(marks: DataFrame, table: str, latest: dt.date) -> DataFrame:
    """The mark of one table replaced, or added when the table has none."""
    moment = F.lit(latest).cast("timestamp")
    changed = replace_where(marks, "latest_date", F.col("table_name") == table, moment)
    own = marks.sparkSession.createDataFrame([(table,)], "table_name string")
    missing = own.join(marks, "table_name", "left_anti").withColumn("latest_date", moment)
    return changed.unionByName(missing)


def increment(
    df: DataFrame,
    mark: dt.date | Column | None,
    end: dt.date | Column | None = None,
    date: str = "date",
    lookback_days: int = 0,
) -> DataFrame:
    """I4: rows in ``(mark, end]``; ``lookback_days`` reads that much again for late rows."""
    if mark is not None:
        low = mark if isinstance(mark, Column) else F.lit(mark)
        df = df.filter(F.col(date) > (F.date_sub(low, lookback_days) if lookback_days else low))
    return df if end is None else df.filter(F.col(date) <= end)


def increment_by_entity(
    df: DataFrame, marks: DataFrame, entity: str, date: str = "date", lookback_days: int = 0
) -> DataFrame:
    """Rows after the mark of their own entity in (entity, latest); all rows of an entity without one."""
    known = marks.select(F.col("entity").alias("_entity"), F.col("latest").alias("_latest"))
    marked = df.join(known, F.col(entity) == F.col("_entity"), "left")
    late = F.col("_latest").isNull() | (F.col(date) > F.date_sub("_latest", lookback_days))
    return marked.filter(late).drop("_entity", "_latest")


def diff_with_seed(
    new: DataFrame,
    stored: DataFrame | None,
    measures: Sequence[str],
    by: Sequence[str] = (),
    date: str = "date",
) -> DataFrame:
    """I4 with W1-W3: differences of new rows against the last stored row of each entity.

    ``stored`` holds only rows before the new ones. One row per entity is
    taken from it, so the first new day is compared with the day before
    instead of with nothing.
    """
    fresh = new.withColumn("_new", F.lit(True))
    if stored is not None:
        seed = last_per_key(stored.select(*by, date, *measures), by, date).withColumn("_new", F.lit(False))
        fresh = fresh.unionByName(seed, allowMissingColumns=True)
    return add_previous_diff(fresh, measures, date, by).filter("_new").drop("_new")


def months_from(df: DataFrame, mark: dt.date | Column, date: str = "date") -> DataFrame:
    """Whole months from the month of the first day after ``mark``."""
    low = mark if isinstance(mark, Column) else F.lit(mark)
    return df.filter(F.col(date) >= F.trunc(F.date_add(low, 1), "MM"))


def upsert_months(
    daily: DataFrame,
    stored: DataFrame | None,
    mark: dt.date | Column | None,
    how: Mapping[str, str],
    diffs: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """The months touched since ``mark``, ready to replace their stored rows.

    The touched months are recomputed from all their days. Their differences
    start from the last stored month before them.
    """
    touched = daily if mark is None else months_from(daily, mark)
    monthly = month_rollup(touched, how, by)
    if not diffs:
        return monthly
    earlier = None
    if mark is not None and stored is not None:
        low = mark if isinstance(mark, Column) else F.lit(mark)
        earlier = stored.filter(F.col("date") < F.trunc(F.date_add(low, 1), "MM"))
    return diff_with_seed(monthly, earlier, diffs, by)
