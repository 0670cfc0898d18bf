"""Language identification as a mixture of languages.

Training counts letter trigrams per language, hashed into 2 ** 16 buckets, so a
model has (languages x 65,536) numbers whatever the corpus holds. A document's
language proportions maximise the likelihood of its trigrams under the mixture
and are found by expectation-maximisation; which languages take part is decided
by penalised likelihood: a further language must gain more than ``penalty``
times the logarithm of the number of trigrams.

The search starts from the best single language. As the log-likelihood is
concave in the proportions, its gradient there bounds the gain of any other
mixture; documents in which that bound is below the penalty, nearly all, are
decided by one pass, the rest go through forward selection.

Defined cases: a text that is null or has no letter is ``und`` with score 0; with
no training text every document is ``und``; languages tie by name; very long
texts are read in pieces; rows repeat as given; other columns pass through,
result columns replace columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
PIECE = 1 << 20  # code points read at once
SMOOTHING = 0.05
UNKNOWN = "und"


@dataclass(frozen=True)
class MixtureModel:
    """Log-probabilities of trigram buckets, a row per language, languages sorted by name."""

    languages: tuple[str, ...]
    logs: np.ndarray


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """1 for code points that are letters."""
    return np.frombuffer(bytes(chr(i).isalpha() for i in range(0x110000)), np.uint8)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of the letter trigrams of the lower-cased text, piece by piece.

    Runs of other characters count as one blank, and blanks surround the text.
    """
    letters = _letter_table()
    rest = np.array([32], np.uint32)
    for at in range(0, len(text), PIECE):
        codes = _codes(text[at : at + PIECE].lower())
        if at + PIECE >= len(text):
            codes = np.append(codes, np.uint32(32))
        codes = np.concatenate([rest, np.where(letters[codes] == 1, codes, np.uint32(32))])
        blank = codes == 32
        codes = codes[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
        if len(codes) >= 3:
            wide = codes.astype(np.uint64)
            mixed = wide[:-2] * np.uint64(0x9E3779B97F4A7C15)
            mixed += wide[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
            mixed += wide[2:] * np.uint64(0x165667B19E3779F9)
            yield (mixed >> np.uint64(48)).astype(np.int64)
        rest = codes[-2:]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a whole task."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            for grams in trigrams(text.as_py()):
                own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(grams, minlength=BUCKETS)
    for lang, own in counts.items():
        found = np.flatnonzero(own)
        yield pa.record_batch(
            {
                "lang": pa.array([lang] * len(found), pa.string()),
                "bucket": pa.array(found, pa.int32()),
                "n": pa.array(own[found], pa.int64()),
            }
        )


def fit(df: DataFrame, lang_col: str = "lang", text_col: str = "text") -> MixtureModel:
    """Model from all rows with a text and a language.

    Counts are summed per task and then by Spark; at most languages x 65,536
    sums reach the driver.
    """
    given = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    given = given.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    parts = given.mapInArrow(_counted, "lang string, bucket int, n long")
    rows = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(rows.column("lang").to_pylist(), dtype=object)
    languages = tuple(sorted(set(names)))
    counts = np.zeros((len(languages), BUCKETS))
    for k, name in enumerate(languages):
        own = names == name
        counts[k, rows.column("bucket").to_numpy()[own]] = rows.column("n").to_numpy()[own]
    seen = max(int((counts.sum(axis=0) > 0).sum()), 1)
    weights = counts + SMOOTHING
    logs = np.log(weights / (counts.sum(axis=1, keepdims=True) + SMOOTHING * seen))
    return MixtureModel(languages, logs.astype(np.float32))


def proportions(
    counts: np.ndarray, likelihoods: np.ndarray, rounds: int = 100, tolerance: float = 1e-6
) -> tuple[np.ndarray, float]:
    """Expectation-maximisation: proportions of the columns of ``likelihoods`` (grams x languages), log-likelihood."""
    total = counts.sum()
    share = np.full(likelihoods.shape[1], 1 / likelihoods.shape[1])
    before = -math.inf
    for _ in range(rounds):
        joint = likelihoods * share
        mixed = joint.sum(axis=1)
        now = float(counts @ np.log(mixed))
        share = (counts / mixed) @ joint / total
        if now - before < tolerance * abs(now):
            break
        before = now
    return share, now


def _mixture(grams: np.ndarray, best: int, model: MixtureModel, penalty: float) -> np.ndarray:
    """Proportions of all languages after forward selection from ``best``."""
    counts = np.bincount(grams, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    counts = counts[found].astype(float)
    logs = model.logs[:, found].T.astype(float)
    likelihoods = np.exp(logs - logs.max(axis=1, keepdims=True))
    price = penalty * math.log(counts.sum() + 1)
    chosen, share = [best], np.ones(1)
    value = float(counts @ np.log(likelihoods[:, best]))
    while len(chosen) < len(model.languages):
        mixed = likelihoods[:, chosen] @ share
        gain = (counts / mixed) @ likelihoods - counts.sum()  # bounds what each language can add
        open_ = [k for k in np.argsort(-gain, kind="stable") if k not in chosen and gain[k] > price]
        tried = [(proportions(counts, likelihoods[:, [*chosen, k]]), k) for k in open_]
        if not tried:
            break
        (new, reached), k = max(tried, key=lambda t: (t[0][1], -t[1]))
        if reached - value <= price:
            break
        chosen, share, value = [*chosen, int(k)], new, reached
    out = np.zeros(len(model.languages))
    out[chosen] = share / share.sum()
    return out


def infer(text: str | None, model: MixtureModel, penalty: float = 4.0) -> np.ndarray | None:
    """Language proportions of a whole text; None without a letter or a model."""
    pieces = [g for g in trigrams(text)] if text and model.languages else []
    if not pieces or not any(c.isalpha() for c in text):
        return None
    grams = pieces[0] if len(pieces) == 1 else np.concatenate(pieces)
    logs = model.logs[:, grams]
    sums = logs.sum(axis=1, dtype=np.float64)
    best = int(np.argmax(sums))
    others = [k for k in range(len(model.languages)) if k != best]
    price = penalty * math.log(len(grams) + 1)
    # gradient of the log-likelihood towards each other language
    if all(float(np.exp(logs[k] - logs[best]).sum()) - len(grams) <= price for k in others):
        share = np.zeros(len(model.languages))
        share[best] = 1.0
        return share
    return _mixture(grams, best, model, penalty)


def _inferred(model, penalty: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: MixtureModel = model.value
    for batch in batches:
        names, scores, mixes = [], [], []
        for text in batch.column("_text"):
            share = infer(text.as_py(), known, penalty)
            if share is None:
                names.append(UNKNOWN)
                scores.append(0.0)
                mixes.append([])
                continue
            best = int(np.argmax(share))
            names.append(known.languages[best])
            scores.append(min(1.0, float(share[best])))
            mixes.append([{"lang": known.languages[k], "share": float(share[k])} for k in np.flatnonzero(share)])
        out = {c: batch.column(c) for c in batch.schema.names if c != "_text"}
        out["lang_pred"] = pa.array(names, pa.string())
        out["score"] = pa.array(scores, pa.float64())
        out["mixture"] = pa.array(mixes, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))
        yield pa.record_batch(out)


def predict(
    df: DataFrame, model: MixtureModel, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", penalty: float = 4.0
) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score`` (its proportion) and ``mixture``; the text alone decides."""
    keep = tuple(c for c in keep if c not in ("lang_pred", "score", "mixture"))
    given = df.select(*keep, F.col(text_col).alias("_text"))
    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kinds, "lang_pred string, score double, mixture array<struct<lang:string,share:double>>"])
    shared = df.sparkSession.sparkContext.broadcast(model)  # languages x 65,536 numbers of 4 bytes
    return given.mapInArrow(partial(_inferred, shared, penalty), schema)
