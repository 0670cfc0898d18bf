"""Places of rows in a total order, without a task that sees them all."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.scratch import stored

_ROW_BITS = 33  # of ``monotonically_increasing_id``: the lower bits count the rows of a task


def placed(
    df: DataFrame,
    ranges: Sequence[Column],
    order: Sequence[Column],
    place: str,
    name: str,
    slim: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """``df``, stored, with the place of each row in ``order`` as ``place``, from 1 on.

    Tasks take ranges of ``ranges``, which must not contradict ``order``, and
    sort them; rows that are equal in ``ranges`` meet in one task. A row's
    place is its place in its task after all rows of the tasks before: one
    number per task, which is what is broadcast. ``slim`` may narrow the sorted
    rows before they are stored; it keeps the column ``_<place>_in_task``.
    """
    in_task = f"_{place}_in_task"
    spread = df.repartitionByRange(*ranges).sortWithinPartitions(*order)
    kept = stored(slim(spread.withColumn(in_task, F.monotonically_increasing_id())), name)
    task = F.shiftright(in_task, _ROW_BITS)
    sizes = kept.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    row = F.col(in_task).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    out = kept.join(F.broadcast(first), task == F.col("_task"))
    return out.withColumn(place, F.col("_first") + row + 1).drop(in_task, "_task", "_first")
