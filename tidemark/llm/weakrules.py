"""Quality rules by weak supervision.

``text_features`` measures whole texts, each ``Rule`` votes good, bad or
abstains on them, ``fit`` estimates by expectation-maximisation how often each
rule votes what on good and on bad documents, and ``posterior`` is the
probability of a good document given all votes. No rule alone rejects a
document. All per-document work is built-in functions; the estimation sees one
row per distinct vote pattern (at most 3 ** rules).

Defined cases: a null text has no words, no lines and is all abstentions; texts
that repeat count as often as they occur; an empty table gives the starting
accuracies; extra columns pass through, measured columns replace columns of the
same name.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
_TRIMMED = " \t\n\x0b\x0c\r"
WINDOW = 8
GOOD, BAD, ABSTAIN = 1, 0, -1


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else (or on nulls) abstains."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.expr(f"CASE WHEN {self.bad} THEN {BAD} WHEN {self.good} THEN {GOOD} ELSE {ABSTAIN} END")


#: Most rules know one kind of bad text and abstain on all others; few know good text.
RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "false"),
    Rule("separators", "10 * n_separators > n_words", "false"),
    Rule("shouting", "2 * n_upper > n_letters", "false"),
    Rule("exclaiming", "5 * n_exclaims > n_words", "false"),
    Rule("same_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines", "false"),
    Rule("same_words", "10 * n_repeat_words > 3 * n_words", "n_words >= 20 and 20 * n_repeat_words <= n_words"),
    Rule("echoes", "5 * n_echo_words > n_words", "n_words >= 20 and 50 * n_echo_words <= n_words"),
    Rule("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 16 * n_words)", "false"),
    Rule("letters", "2 * n_letters < word_chars", "n_words > 0 and 5 * n_letters >= 4 * word_chars"),
)


def _chars(text: Column, kept: str) -> Column:
    """Code points of the text that are in a character class."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def text_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_letters, n_upper, n_symbols, n_separators, n_exclaims, n_lines,
    n_dup_lines, n_echo_words (equal to the word before) and n_repeat_words.

    Each step is a projection of its own, so that no array is computed twice:
    word hashes become hashes of 2, 4 and 8 words by pairing the array with
    itself, shifted. Only texts with a repeated window sort their windows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.expr(f"trim(BOTH '{_TRIMMED}' FROM coalesce(`{text}`, ''))")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    out = df.withColumns(
        {
            "_words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
                F.split(trimmed, f"[{SPACE}]+")
            ),
            "_lines": lines,
            "word_chars": F.length(F.regexp_replace(body, f"[{SPACE}]+", "")).cast("long"),
            "n_letters": _chars(body, r"\p{L}"),
            "n_upper": _chars(body, r"\p{Lu}"),
            "n_symbols": _chars(body, r"#*$%&|<>"),
            "n_separators": _chars(body, r"|"),
            "n_exclaims": _chars(body, r"!"),
        }
    )
    out = out.withColumns(
        {
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
            "n_words": F.size("_words").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    ).drop("_words", "_lines")
    ahead = F.greatest(F.size("_hashes") - 1, F.lit(0))
    same = F.zip_with(F.slice("_hashes", F.lit(1), ahead), F.slice("_hashes", F.lit(2), ahead), lambda a, b: a == b)
    out = out.withColumn("n_echo_words", F.size(F.filter(same, lambda x: x)).cast("long"))
    width = 1
    while width < WINDOW:
        left = F.slice("_hashes", F.lit(1), F.greatest(F.size("_hashes") - width, F.lit(0)))
        right = F.slice("_hashes", F.lit(1 + width), F.greatest(F.size("_hashes") - width, F.lit(0)))
        out = out.withColumn("_hashes", F.zip_with(left, right, lambda a, b: F.xxhash64(a, b)))
        width *= 2
    # sorted (window, place) of texts in which a window occurs twice, else null
    placed = F.zip_with(
        "_hashes", F.sequence(F.lit(1), F.size("_hashes")), lambda h, i: F.struct(h.alias("h"), i.alias("i"))
    )
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    out = out.withColumn("_sorted", F.when(repeats, F.sort_array(placed))).drop("_hashes")
    inner = F.size("_sorted") - 1
    both = F.zip_with(
        F.slice("_sorted", F.lit(1), inner),
        F.slice("_sorted", F.lit(2), inner),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))
    out = out.withColumn("_places", F.when(F.col("_sorted").isNotNull(), places)).drop("_sorted")
    covered = F.aggregate(
        F.zip_with(
            F.slice("_places", F.lit(1), F.size("_places") - 1),
            F.slice("_places", F.lit(2), F.size("_places") - 1),
            lambda a, b: F.least(b - a, F.lit(WINDOW)),
        ),
        F.lit(WINDOW),
        lambda total, x: total + x,
    )
    covered = F.when(F.col("_places").isNotNull(), covered).otherwise(F.lit(0))
    return out.withColumn("n_repeat_words", covered.cast("long")).drop("_places")


def votes(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds ``vote_<rule>`` (1 good, 0 bad, -1 abstains)."""
    return df.withColumns({f"vote_{r.name}": r.vote() for r in rules})


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents; per rule and class the probabilities of (bad, good, abstain)."""

    good: float
    by_rule: tuple[tuple[str, tuple[float, float, float], tuple[float, float, float]], ...]


def fit(voted: DataFrame, rules: Sequence[Rule] = RULES, rounds: int = 200, tolerance: float = 1e-9) -> LabelModel:
    """Expectation-maximisation over the counts of vote patterns.

    It starts from a majority of good documents, on which rules hardly ever vote
    bad, and from bad documents of several kinds, each known to some rules only;
    this fixes which class is which. Counts are smoothed by half a document,
    abstentions carry what evidence they have.
    """
    columns = [f"vote_{r.name}" for r in rules]
    patterns = [(tuple(row[:-1]), row[-1]) for row in voted.groupBy(*columns).count().collect()]
    places = {BAD: 0, GOOD: 1, ABSTAIN: 2}
    coded = [([places[v] for v in votes_of], n) for votes_of, n in patterns]
    good, on_good, on_bad = 0.8, [[0.002, 0.499, 0.499]] * len(rules), [[0.3, 0.35, 0.35]] * len(rules)
    total = sum(n for _, n in coded)
    before = -math.inf
    for _ in range(rounds if total else 0):
        sums = [[[0.5] * 3 for _ in rules] for _ in range(2)]
        mass, likelihood = 0.0, 0.0
        for code, n in coded:
            a, b = math.log(good), math.log(1 - good)
            for r, v in enumerate(code):
                a += math.log(on_good[r][v])
                b += math.log(on_bad[r][v])
            top = max(a, b)
            both = top + math.log(math.exp(a - top) + math.exp(b - top))
            p = math.exp(a - both)
            likelihood += n * both
            mass += n * p
            for r, v in enumerate(code):
                sums[0][r][v] += n * p
                sums[1][r][v] += n * (1 - p)
        good = (mass + 0.5) / (total + 1)
        on_good, on_bad = ([[x / sum(s) for x in s] for s in side] for side in sums)
        if likelihood - before < tolerance * total:
            break
        before = likelihood
    return LabelModel(
        good, tuple((r.name, tuple(on_good[k]), tuple(on_bad[k])) for k, r in enumerate(rules))
    )


def posterior(model: LabelModel) -> Column:
    """Probability of a good document from the columns ``vote_<rule>``."""
    odds = F.lit(math.log(model.good) - math.log(1 - model.good))
    for name, on_good, on_bad in model.by_rule:
        bad, good, abstain = (math.log(g) - math.log(b) for g, b in zip(on_good, on_bad))
        vote = F.col(f"vote_{name}")
        odds = odds + F.when(vote == BAD, F.lit(bad)).when(vote == GOOD, F.lit(good)).otherwise(F.lit(abstain))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def base_failed() -> Column:
    """Too short, or mostly windows of eight words that the text repeats."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judged(features: DataFrame, rules: Sequence[Rule] = RULES, least: float = 0.5) -> DataFrame:
    """Adds votes, ``quality`` (posterior) and ``kept``; features are read twice, so store them first."""
    voted = votes(features, rules)
    model = fit(voted, rules)
    return voted.withColumn("quality", posterior(model)).withColumn("kept", F.col("quality") >= least)
