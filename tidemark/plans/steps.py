"""What every load job shares: bounds, no-op test, marks, reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidemark.operators.incremental import FIRST_MARK, SEED_MARK, is_resume, upsert_months
from tidemark.sinks.warehouse import Warehouse

#: What each table is made of.
INPUTS = {
    "covid19_us_fact": ("covid19_us_raw",),
    "covid19_us_monthly_fact": ("covid19_us_fact",),
    "covid19_global_fact": ("covid19_global_raw",),
    "covid19_global_monthly_fact": ("covid19_global_fact",),
    "covid19_sum_fact": ("covid19_us_fact", "covid19_global_fact"),
    "covid19_sum_monthly_fact": ("covid19_sum_fact",),
    "stock_index_monthly_fact": ("stock_index_fact",),
    "stock_price_fact": ("stock_price_raw",),
    "stock_price_monthly_fact": ("stock_price_fact",),
    "covid_stock_fact": ("covid19_sum_fact", "stock_index_fact"),
    "covid_stock_monthly_fact": ("covid_stock_fact",),
    "covid_stock_bol_monthly_fact": ("covid_stock_monthly_fact", "bol_series_fact"),
}


@dataclass(frozen=True)
class Bounds:
    """The dates ``(low, end]`` a job has to load; ``low`` is None on a first load."""

    low: dt.date | None
    end: dt.date


@dataclass(frozen=True)
class Report:
    """A10: what a job did. It is true when the job stored something."""

    loaded: bool = False
    stored: int = 0
    dropped: Mapping[str, int] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return self.loaded

    def __str__(self) -> str:
        if not self.loaded:
            return "up to date"
        left_out = "".join(f", {n} {what}" for what, n in self.dropped.items())
        return f"loaded {self.stored} rows{left_out}"


UP_TO_DATE = Report()


def pending(wh: Warehouse, target: str, source: str, lookback_days: int = 0) -> Bounds | None:
    """Bounds from the marks of target and source; None when there is nothing to do."""
    marks = wh.marks()
    end = marks.get(source, FIRST_MARK)
    return bounds(marks.get(target, FIRST_MARK), end, lookback_days) if is_resume(end) else None


def bounds(mark: dt.date, end: dt.date, lookback_days: int = 0) -> Bounds | None:
    """Nothing to do when the mark has reached the end, unless late rows are read again."""
    if mark >= end and not lookback_days:
        return None
    return Bounds(mark - dt.timedelta(days=lookback_days) if is_resume(mark) else None, end)


def finished(wh: Warehouse, target: str, todo: Bounds, latest: dt.date | None = None) -> None:
    """``target`` holds everything up to ``latest``, and may have changed after ``todo.low``.

    Tables made of it are taken back to ``todo.low`` where they had gone on
    without these rows, so that their next run reads them, whichever of their
    inputs is late.
    """
    marks = wh.marks()
    reached = latest or todo.end
    new = {target: max(reached, marks.get(target, SEED_MARK))}
    low = todo.low or SEED_MARK
    taken_back = [target]
    for name in taken_back:
        for made, inputs in INPUTS.items():
            if name in inputs and marks.get(made, SEED_MARK) > low:
                new[made] = low
                taken_back.append(made)
    wh.set_marks(new)


def seed_rows(
    wh: Warehouse, name: str, low: dt.date | None, entity: str | None, new: DataFrame, days: int = 31
) -> DataFrame | None:
    """I4: stored rows that hold the last one of each entity in ``new``; None on a first load.

    Only the last ``days`` days are read, and what lies before them only for
    entities that have no row there.
    """
    if low is None:
        return None
    edge = low - dt.timedelta(days=days)
    recent = wh.read(name, after=edge, until=low)
    if entity is None:
        return wh.read(name, until=low) if recent.isEmpty() else recent
    missing = new.select(entity).distinct().join(recent.select(entity).distinct(), entity, "left_anti")
    if missing.isEmpty():
        return recent
    older = wh.read(name, until=edge).join(missing, entity, "left_semi")
    return recent.unionByName(older)


def refresh_months(
    wh: Warehouse,
    target: str,
    source: str,
    how: Mapping[str, str],
    diffs: Sequence[str] = (),
    by: Sequence[str] = (),
    lookback_days: int = 0,
) -> Report:
    """Recompute the months of ``target`` that days of ``source`` have touched."""
    todo = pending(wh, target, source, lookback_days)
    if todo is None:
        return UP_TO_DATE
    after = None if todo.low is None else (todo.low + dt.timedelta(days=1)).replace(day=1) - dt.timedelta(days=1)
    daily = wh.read(source, after=after, until=todo.end)
    stored = seed_rows(wh, target, after, by[0] if by else None, daily, 62) if diffs else None
    observed = wh.load(target, upsert_months(daily, stored, todo.low, how, diffs, by))
    finished(wh, target, todo)
    return Report(True, observed["n_rows"])
