"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic. Token weights of the
cells are raked: scaled to the target shares of one dimension after the other,
until all hold. A document is then kept with the probability of its cell,
``scale`` times raked weight over tokens, at most 1, the scale being such that
the expected tokens are the share ``keep`` of all. Whether a document is kept
depends on its id, its cell's probability and the seed alone.

Cells are summed before anything else is done; everything iterative is on the
cells. Targets are tables (value, share); ``tempered`` makes them from the
data: shares to the power ``power``, which lifts small values.

Defined cases: null values of a dimension are a value of their own; documents
without text have one token; values that a target table does not name keep
their present share of tokens, the named ones share what is left; equal ids
share their fate if their cell does, rows without an id go by their text; an
empty table gives an empty result; other columns pass through, result columns
replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.scratch import stored

DIMENSIONS = ("source", "lang", "topic")
MOST_CELLS = 200_000  # so many cells are sent to all tasks; more are joined by shuffle
SWEEPS_AT_ONCE = 5


def tokens_of(text: Column) -> Column:
    """Blanks and one: tokens up to a factor."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("long")


def topic_of(text: Column) -> Column:
    """The form of a text as its topic, for tables that have none."""
    text = F.coalesce(text, F.lit(""))
    words = tokens_of(text)
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    return (
        F.when(words < 50, "note").when(10 * bars > words, "table").when(words < 400, "article").otherwise("treatise")
    )


def cells_of(df: DataFrame, tokens: str = "tokens", dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Tokens by cell."""
    return df.groupBy(*dimensions).agg(F.sum(F.greatest(F.col(tokens), F.lit(1))).alias("tokens"))


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(value, share) with shares of tokens to a power."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").cast("double").alias("_t"))
    raised = sums.withColumn("_p", F.pow("_t", F.lit(power)))
    total = raised.agg(F.sum("_p").alias("_all"))
    return raised.join(total).select("value", (F.col("_p") / F.col("_all")).alias("share"))


def _with_targets(cells: DataFrame, targets: Mapping[str, DataFrame], dimensions: Sequence[str]) -> DataFrame:
    """Adds ``_to_<dimension>``, the tokens that the cell's value should have."""
    out = cells
    for d in dimensions:
        sums = cells.groupBy(d).agg(F.sum("tokens").cast("double").alias("_t"))
        named = targets[d].select(F.col("value").alias("_value"), "share")
        sums = sums.join(named, F.col(d).eqNullSafe(F.col("_value")), "left")
        whole = sums.agg(
            F.sum("_t").alias("_all"),
            F.coalesce(F.sum(F.when(F.col("share").isNotNull(), F.col("_t"))), F.lit(0.0)).alias("_free"),
            F.coalesce(F.sum("share"), F.lit(1.0)).alias("_shares"),
        )
        to = F.coalesce(F.col("share") / F.col("_shares") * F.col("_free"), F.col("_t"))
        sums = sums.join(whole).select(F.col(d).alias("_value"), to.alias(f"_to_{d}"))
        out = out.join(sums, F.col(d).eqNullSafe(F.col("_value"))).drop("_value")
    return out


def raked(
    cells: DataFrame,
    targets: Mapping[str, DataFrame],
    dimensions: Sequence[str] = DIMENSIONS,
    sweeps: int = 50,
    tolerance: float = 1e-6,
) -> DataFrame:
    """Cells with ``weight``: tokens scaled until every dimension has its targets within ``tolerance``, or ``sweeps``."""
    start = _with_targets(cells, targets, dimensions).withColumn("weight", F.col("tokens").cast("double"))
    out = stored(start, "cells")
    for _ in range(0, sweeps, SWEEPS_AT_ONCE):
        for _ in range(SWEEPS_AT_ONCE):
            for d in dimensions:
                now = F.sum("weight").over(Window.partitionBy(d))
                out = out.withColumn("weight", F.col("weight") * F.col(f"_to_{d}") / now)
        out = stored(out, "cells")
        off = F.lit(0.0)
        for d in dimensions:
            now = F.sum("weight").over(Window.partitionBy(d))
            off = F.greatest(off, F.abs(now / F.col(f"_to_{d}") - 1))
        worst = out.select(off.alias("off")).agg(F.max("off")).first()[0]
        if worst is None or worst <= tolerance:
            break
    return out.drop(*(f"_to_{d}" for d in dimensions))


def calibrated(cells: DataFrame, keep: float) -> DataFrame:
    """Adds ``probability``: min(1, scale * weight / tokens), expecting the share ``keep`` of all tokens."""
    ratio = F.col("weight") / F.col("tokens")
    scale = keep
    for _ in range(60):  # cells at 1 give their surplus to the others; the scale only grows
        full = scale * ratio >= 1
        sums = cells.agg(
            F.sum("tokens").alias("all"),
            F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("open"),
        ).first()
        if sums["all"] is None or not sums["open"]:
            break
        better = (keep * sums["all"] - sums["full"]) / sums["open"]
        if better <= scale * (1 + 1e-12):
            break
        scale = better
    return cells.withColumn("probability", F.least(F.lit(1.0), scale * ratio))


def uniform(id_col: str, text_col: str, seed: int) -> Column:
    """A number in [0, 1) made of the id (of the text where there is none) and the seed."""
    name = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def mixed(
    df: DataFrame,
    power: Mapping[str, float],
    keep: float = 0.9,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: Sequence[str] = DIMENSIONS,
    targets: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Adds ``probability`` and ``kept`` to every row; ``df`` has the dimensions and ``tokens``."""
    cells = stored(cells_of(df, dimensions=dimensions), "cells")
    given = {d: tempered(cells, d, power.get(d, 1.0)) for d in dimensions} | dict(targets or {})
    chances = stored(calibrated(raked(cells, given, dimensions), keep), "chances")
    names = {d: f"_cell_{d}" for d in dimensions}
    chances = chances.select(*(F.col(d).alias(n) for d, n in names.items()), "probability")
    if chances.count() <= MOST_CELLS:
        chances = F.broadcast(chances)
    same = [F.col(d).eqNullSafe(F.col(n)) for d, n in names.items()]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    out = df.drop("probability", "kept").join(chances, condition, "left").drop(*names.values())
    return out.withColumn("kept", uniform(id_col, text_col, seed) < F.col("probability"))
