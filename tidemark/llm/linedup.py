"""Line removal with levelled sorted runs of line hashes.

A run is a table of (line hash, number of documents), sorted by hash. A batch
of documents becomes one run at level 0; as soon as a level holds ``fanout``
runs they are merged into one run of the next level. Before a batch adds its
run, its lines are merge-anti-joined with the hashes that the stored runs know
from ``least`` documents already: those can go without further counting, so a
line that occurs everywhere costs one row per batch at most. Each text line
equals a 64-bit hash of its key: the line without white space at its ends and
with A-Z lower-cased.

Defined cases: a null text is one empty line; empty keys are never removed; a
line that repeats in a document counts once, equal documents count each; an
empty batch adds no run; extra columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scratch import remove_folder, scratch_folder, stored, tidy_shuffles

SPACE = b" \t\n\x0b\x0c\r"


def line_hash(line: bytes) -> int | None:
    """Signed 64-bit hash of the line's key, None for an empty key."""
    key = line.strip(SPACE).lower()  # of bytes: A-Z only
    if not key:
        return None
    value = xxhash.xxh3_64_intdigest(key)
    return value - (1 << 64) if value >> 63 else value


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").split(b"\n")


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    """One text after another; a long text is not copied with its neighbours."""
    return (x.as_py() for x in batch.column("text"))


def _hashes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, hash): each line hash once per document."""
    for batch in batches:
        rows, hashes = [], []
        for row, text in zip(batch.column("row").to_pylist(), _texts(batch)):
            own = {h for line in set(_lines(text)) if (h := line_hash(line)) is not None}
            hashes.extend(own)
            rows.extend([row] * len(own))
        yield pa.record_batch({"row": pa.array(rows, pa.int64()), "hash": pa.array(hashes, pa.int64())})


def document_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, hash). ``row`` is the id, or a hash of the text where the id is null."""
    keyed = df.select(_row(id_col, text_col), F.col(text_col).alias("text"))
    return keyed.mapInArrow(_hashes_of, "row long, hash long")


def _row(id_col: str, text_col: str):
    return F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))).alias("row")


class LineRuns:
    """The runs below one folder, by level."""

    def __init__(self, spark: SparkSession, root: str | None = None, fanout: int = 2, least: int = 10):
        self.spark, self.fanout, self.least = spark, fanout, least
        self.root = root or scratch_folder(spark, "line-runs")
        self.levels: list[list[str]] = []
        self._made = 0

    def _read(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.schema("hash long, n long").parquet(*paths)

    def counts(self) -> DataFrame:
        """(hash, n) over all runs."""
        paths = [p for level in self.levels for p in level]
        if not paths:
            return self.spark.createDataFrame([], "hash long, n long")
        return self._read(paths).groupBy("hash").agg(F.sum("n").alias("n"))

    def frequent(self) -> DataFrame:
        """Hashes known from ``least`` documents or more."""
        return self.counts().where(F.col("n") >= self.least).select("hash")

    def _write(self, counts: DataFrame, level: int) -> None:
        path = f"{self.root}/level-{level}/run-{self._made:06d}"
        self._made += 1
        with tidy_shuffles(self.spark):
            counts.sortWithinPartitions("hash").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def add(self, lines: DataFrame) -> None:
        """Add a batch of ``document_lines`` as a run, then compact full levels.

        Lines are counted within tasks before they travel, so that a line that
        is everywhere is a row per task when it meets the runs.
        """
        counts = lines.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
        if self.levels:
            counts = counts.join(self.frequent(), "hash", "left_anti")
        self._write(counts, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._write(self._read(merged).groupBy("hash").agg(F.sum("n").alias("n")), level + 1)
            for path in merged:
                remove_folder(self.spark, path)
            level += 1


def _kept(keep_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counted, dropped, digests, texts = [], [], [], []
        for text, gone in zip(_texts(batch), batch.column("gone")):
            lines = _lines(text)
            hashes = set(gone.as_py() or ())
            kept = [x for x in lines if line_hash(x) not in hashes] if hashes else lines
            whole = b"\n".join(kept)
            counted.append(len(lines))
            dropped.append(len(lines) - len(kept))
            digests.append(hashlib.sha256(whole).hexdigest())
            if keep_text:
                texts.append(None if text is None else whole.decode("utf-8"))
        out = {name: batch.column(name) for name in batch.schema.names if name not in ("text", "gone")}
        out |= {
            "n_lines": pa.array(counted, pa.int64()),
            "n_dropped": pa.array(dropped, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        if keep_text:
            out["kept_text"] = pa.array(texts, pa.string())
        yield pa.record_batch(out)


def drop_lines(
    df: DataFrame, frequent: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """(id, n_lines, n_dropped, kept_sha256[, kept_text]) without the lines whose hash is in ``frequent``.

    Only hashes travel to find the lines; texts are shuffled once, by document.
    """
    gone = document_lines(df, id_col, text_col).join(frequent, "hash", "left_semi")
    gone = gone.groupBy("row").agg(F.collect_set("hash").alias("gone"))
    keyed = df.select(F.col(id_col), F.col(text_col).alias("text"), _row(id_col, text_col))
    joined = keyed.join(gone, "row", "left").drop("row")
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, n_lines long, n_dropped long, kept_sha256 string"
    return joined.mapInArrow(partial(_kept, keep_text), schema + (", kept_text string" if keep_text else ""))


def frequent_lines(
    df: DataFrame, least: int = 10, batches: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Hashes of the lines in at least ``least`` documents, fed to the runs in ``batches`` parts of the documents."""
    runs = LineRuns(df.sparkSession, least=least)
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit("batch")), F.lit(batches))
    for k in range(batches):
        runs.add(document_lines(df.where(part == k), id_col, text_col))
    found = stored(runs.frequent(), "frequent-lines")
    remove_folder(df.sparkSession, runs.root)
    return found
