"""Token ids in binary segments of patched frame-of-reference blocks.

``write_tokens`` orders documents by id, encodes whole texts, appends the end
id and writes segments of about ``segment_ids`` ids. A segment holds three
streams of ``pfor``: document ids (as steps), document lengths and token ids.
Segments are rows of Parquet files, which Spark commits and repeats after a
loss; an index gives the ids before each segment. ``read_tokens`` reads the
files back, a document per row.

    segment := "PFR1", null ids u64, first id i64, bytes of streams 1 and 2 u64 * 2, stream * 3

Defined cases: null texts are empty (the end id alone), documents without an id
come first, equal ids go by text, a document is never cut, an empty table gives
no segment, extra columns are ignored.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm import pfor
from tidemark.scratch import tidy_shuffles

MAGIC = b"PFR1"
_HEAD = 36
SEGMENT_IDS = 1 << 20
CACHED_WORDS = 400_000
_CONTROL = "\x01"


def _byte_letters(octets: bytes) -> str:
    """Byte-level vocabularies write a byte as the character of that number where it is printable, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return "".join(chr(b) if b in printable else chr(256 + rest.index(b)) for b in octets)


class WordEncoder:
    """Ids of whole texts, with the ids of words it has met.

    Texts are cut at spaces and line feeds, which the tokenizer drops and
    across which it never joins anything, so ids of the pieces in order are the
    ids of the text. Of a piece of Latin letters, one mark behind it or none,
    the lower-cased letters go straight to the tokenizer's model. Other pieces
    are encoded together with a control character between them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._letters = {ord(c): _byte_letters(c.encode()) for c in map(chr, range(0x80, 0x100))}
        self._marks = {m: self._bytes(m) for m in ".,;:!?"}
        self._between = self._ids(_CONTROL)[0]
        self._known: dict[str, bytes] = {"": b""}
        self._before: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _bytes(self, text: str) -> bytes:
        return np.array(self._ids(text), "<u4").tobytes()

    def _keep(self, words: list[str], ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        octets = ids.tobytes()
        for w, a, b in zip(words, (4 * begins).tolist(), (4 * ends).tolist(), strict=True):
            self._known[w] = octets[a:b]

    def _learn(self, words: list[str]) -> None:
        known, before = self._known, self._before
        simple, other, cores = [], [], set()
        for w in words:
            core = w[:-1] if w[-1] in self._marks else w
            if core.isalpha() and (core.isascii() or max(core) <= "\xff"):
                simple.append((w, core := core.lower()))
                if core not in known:
                    if core in before:
                        known[core] = before[core]
                    else:
                        cores.add(core)
            elif _CONTROL in w:
                known[w] = self._bytes(w)
            else:
                other.append(w)
        tokenize, letters = self._tokenizer.model.tokenize, self._letters
        for core in cores:
            spelt = core if core.isascii() else core.translate(letters)
            known[core] = array("I", [t.id for t in tokenize(spelt)]).tobytes()
        for w, core in simple:
            if w != core:
                known[w] = known[core] + (self._marks[w[-1]] if len(w) > len(core) else b"")
        for at in range(0, len(other), 1000):
            some = other[at : at + 1000]
            ids = np.array(self._ids(f" {_CONTROL} ".join(some)), "<u4")
            cuts = np.flatnonzero(ids == self._between)
            self._keep(some, ids, np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(ids)]]))

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        words = text.replace("\n", " ").split(" ")
        if len(self._known) > CACHED_WORDS:  # words in use come over from the generation before
            self._before, self._known = self._known, {"": b""}
        known, before = self._known, self._before
        found = list(map(known.get, words))
        if None in found:
            new = {w for w, ids in zip(words, found) if ids is None}
            for w in new:
                if w in before:
                    known[w] = before[w]
            self._learn([w for w in new if w not in known])
            found = list(map(known.get, words))
        return b"".join(found)


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pack_segment(ids: list[int | None], lengths: list[int], tokens: bytes) -> bytes:
    """The bytes of a segment; ids ascend, nulls first."""
    nulls = sum(i is None for i in ids)
    real = np.array(ids[nulls:], np.int64)
    steps = np.diff(real.view(np.uint64)) if len(real) else np.zeros(0, np.uint64)
    streams = [
        pfor.encode(steps),
        pfor.encode(np.array(lengths, np.uint64)),
        pfor.encode(np.frombuffer(tokens, "<u4")),
    ]
    head = MAGIC + np.uint64(nulls).tobytes() + np.int64(real[0] if len(real) else 0).tobytes()
    return head + np.array([len(s) for s in streams[:2]], "<u8").tobytes() + b"".join(streams)


def unpack_segment(image: bytes) -> tuple[list[int | None], np.ndarray, bytes]:
    """Ids, lengths and little-endian tokens of a segment."""
    if image[:4] != MAGIC:
        raise ValueError("not a segment")
    nulls = int(np.frombuffer(image, "<u8", 1, 4)[0])
    first = np.frombuffer(image, "<i8", 1, 12)[0]
    a, b = (int(x) for x in np.frombuffer(image, "<u8", 2, 20))
    steps = pfor.decode(image[_HEAD : _HEAD + a])
    lengths = pfor.decode(image[_HEAD + a : _HEAD + a + b]).astype(np.int64)
    real = np.concatenate([np.array([first], np.int64).view(np.uint64), steps]).cumsum(dtype=np.uint64).view(np.int64)
    ids = [None] * nulls + real.tolist()[: len(lengths) - nulls]
    return ids, lengths, pfor.decode(image[_HEAD + a + b :]).astype("<u4").tobytes()


def _segments(
    path: str, end_id: int, most: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    encoder, end = _encoder(path), np.array([end_id], "<u4").tobytes()
    part, seq = TaskContext.get().partitionId(), 0
    ids: list[int | None] = []
    lengths: list[int] = []
    tokens = bytearray()

    def image() -> pa.RecordBatch:
        return pa.record_batch(
            {
                "part": pa.array([part], pa.int32()),
                "seq": pa.array([seq], pa.int32()),
                "n_ids": pa.array([len(tokens) // 4], pa.int64()),
                "segment": pa.array([pack_segment(ids, lengths, bytes(tokens))], pa.binary()),
            }
        )

    for batch in batches:
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text")):
            own = encoder.encode(text.as_py() or "") + end
            ids.append(key)
            lengths.append(len(own) // 4)
            tokens += own
            if len(tokens) >= 4 * most:
                yield image()
                seq, ids, lengths, tokens = seq + 1, [], [], bytearray()
    if ids:
        yield image()


def write_tokens(
    df: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode and write all documents in ascending order of their ids; texts are shuffled once, by range."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = chosen.repartitionByRange(parts, "id").sortWithinPartitions("id", "text")
    schema = "part int, seq int, n_ids long, segment binary"
    with tidy_shuffles(spark):
        ordered.mapInArrow(partial(_segments, tokenizer, end_id, segment_ids), schema).write.parquet(path)


def segment_index(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, start): ids in all segments before each one. Only the sums by part meet in one task."""
    sizes = spark.read.parquet(path).select("part", "seq", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("_own"))
    parts = parts.select("part", F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.withColumn("_inner", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)))
    return own.join(parts, "part").select("part", "seq", (F.col("_before") + F.col("_inner")).alias("start"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            ids, lengths, tokens = unpack_segment(batch.column("segment")[row].as_py())
            part, seq = batch.column("part")[row].as_py(), batch.column("seq")[row].as_py()
            ends = lengths.cumsum()
            starts = ends - lengths
            pieces = [tokens[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.record_batch(
                {
                    "id": pa.array(ids, pa.int64()),
                    "part": pa.array([part] * len(ids), pa.int32()),
                    "seq": pa.array([seq] * len(ids), pa.int32()),
                    "offset": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids": pa.array(pieces, pa.binary()),
                }
            )


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) from the files; ids are little-endian unsigned 32-bit integers."""
    images = spark.read.parquet(path).select("part", "seq", "segment")
    schema = "id long, part int, seq int, offset long, n_tokens long, ids binary"
    found = images.mapInArrow(_documents, schema)
    placed = found.join(segment_index(spark, path), ["part", "seq"])
    return placed.select(
        F.col("id").alias(id_col), (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids"
    )
