"""Hashes of word shingles, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD = 1 << 64
_STEPS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)


def mixed(values: np.ndarray) -> np.ndarray:
    """Finaliser: every bit of the input reaches every bit of the output."""
    out = values ^ (values >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


@lru_cache(maxsize=1)
def _bytes() -> tuple[np.ndarray, np.ndarray]:
    """A number per byte, equal for A-Z and a-z, and which bytes are white space."""
    lowered = np.arange(256, dtype=np.uint64)
    lowered[65:91] += np.uint64(32)
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return mixed((lowered + np.uint64(1)) * np.uint64(_BASE)), space


_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if len(_powers["up"]) < n + 1:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, _WORD))):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def _word_hashes(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word."""
    octets = np.frombuffer(joined, np.uint8)
    numbers, space = _bytes()
    inside = np.concatenate([[False], ~space[octets], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    up, down = _power_tables(len(octets))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers[octets] * up[: len(octets)])])
    hashes = (sums[ends] - sums[begins]) * down[begins]
    return mixed(hashes + (ends - begins).astype(np.uint64)), begins


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text.

    A text with fewer words is one shingle of all of them; without words or
    text it has none.
    """
    whole = [(t or "").encode("utf-8") for t in texts]
    sizes = np.array([len(w) + 1 for w in whole], np.int64)
    ends = sizes.cumsum()
    hashes, begins = _word_hashes(b"\n".join(whole) + b"\n")
    first = np.searchsorted(begins, ends - sizes)
    last = np.searchsorted(begins, ends)
    steps = [np.uint64(_STEPS[j % len(_STEPS)] + 2 * (j // len(_STEPS))) for j in range(words)]
    n = max(len(hashes) - words + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for j in range(words):
        rolled += hashes[j : j + n] * steps[j]
    rolled = mixed(rolled)
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= words:
            yield np.unique(rolled[a : b - words + 1])
        elif b > a:
            short = sum((int(h) * int(s) for h, s in zip(hashes[a:b], steps)), b - a) % _WORD
            yield mixed(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def batched(texts: Iterator[tuple[object, str | None]], most: int = 1 << 21) -> Iterator[tuple[list, list]]:
    """(tags, texts) in parts of about ``most`` characters; a longer text is a part of its own."""
    tags, held, size = [], [], 0
    for tag, text in texts:
        own = len(text or "")
        if held and size + own > most:
            yield tags, held
            tags, held, size = [], [], 0
        tags.append(tag)
        held.append(text)
        size += own
    if held:
        yield tags, held
