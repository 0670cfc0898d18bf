"""Patched frame-of-reference blocks.

A stream of unsigned integers is cut into blocks of 512. Of each block the
minimum is subtracted, and the rest is packed at the width that ``percentile``
of its values need; values that need more are exceptions, stored whole in a
list behind the block. The stream begins with its length, its number of blocks,
the bytes of an exception's value and the byte at which each block starts, so a
block is read without the ones before it.

    stream := n u64, blocks u64, item u64, start u64 * blocks, block *
    block  := minimum u64, width u8, exceptions u16, packed 64 * width bytes,
              place u16 * exceptions, value u(8 * item) * exceptions
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BLOCK = 512
_HEAD = 11
_STARTS = 24
_CHUNK = 2048  # blocks packed at once, which bounds the memory for single bits


@lru_cache(maxsize=1)
def _small_bits() -> np.ndarray:
    """Bits that each number below 2 ** 16 needs."""
    return np.array([n.bit_length() for n in range(1 << 16)], np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    if values.size and values.max() < 1 << 16:
        return _small_bits()[values.astype(np.uint16)]
    out = np.zeros(values.shape, np.uint8)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        more = rest >= np.uint64(1) << np.uint64(step)
        out[more] += step
        rest[more] >>= np.uint64(step)
    return out + (rest > 0)


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Low ``width`` bits of (k, 512) values as (k, 64 * width) bytes."""
    if not width:
        return np.zeros((len(rows), 0), np.uint8)
    low = rows if width == 64 else rows & ((np.uint64(1) << np.uint64(width)) - np.uint64(1))
    if width == 16:
        return low.astype("<u2").view(np.uint8).reshape(len(rows), -1)
    if width < 16:  # eight values are ``width`` bytes: two words of four values each, shifted together
        shifts = np.arange(4, dtype=np.uint64) * np.uint64(width)
        four = np.bitwise_or.reduce(low.reshape(len(rows), -1, 4) << shifts, axis=-1)
        a, b = four[:, ::2], four[:, 1::2]
        both = np.stack([a | (b << np.uint64(4 * width)), b >> np.uint64(64 - 4 * width)], axis=-1)
        return both.astype("<u8").view(np.uint8).reshape(len(rows), -1, 16)[..., :width].reshape(len(rows), -1)
    octets = low.astype("<u8")[..., None].view(np.uint8)[..., : (width + 7) // 8]
    bits = np.unpackbits(octets, axis=-1, bitorder="little")[..., :width]
    return np.packbits(bits.reshape(len(rows), -1), axis=-1, bitorder="little")


def _unpack(rows: np.ndarray, width: int) -> np.ndarray:
    """Inverse of ``_pack``."""
    if not width:
        return np.zeros((len(rows), BLOCK), np.uint64)
    if width == 16:
        return rows.reshape(len(rows), BLOCK, 2).copy().view("<u2")[..., 0].astype(np.uint64)
    bits = np.unpackbits(rows, axis=-1, bitorder="little").reshape(len(rows), BLOCK, width)
    octets = np.packbits(bits, axis=-1, bitorder="little")
    whole = np.zeros((len(rows), BLOCK, 8), np.uint8)
    whole[..., : octets.shape[-1]] = octets
    return whole.view("<u8")[..., 0].astype(np.uint64)


def encode(values: np.ndarray, percentile: float = 99.0) -> bytes:
    """One stream from unsigned integers."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, values[-1] if n else 0, np.uint64)
    padded[:n] = values
    padded = padded.reshape(blocks, BLOCK)
    lowest = padded.min(axis=1) if blocks else np.zeros(0, np.uint64)
    padded -= lowest[:, None]
    needed = _bits(padded)
    rank = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)
    widths = np.partition(needed, rank, axis=1)[:, rank] if blocks else np.zeros(0, np.uint8)
    packed: list[bytes] = [b""] * blocks
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        for at in range(0, len(own), _CHUNK):
            part = own[at : at + _CHUNK]
            for k, row in zip(part, _pack(padded[part], int(width))):
                packed[k] = row.tobytes()
    odd_block, odd_place = np.nonzero(needed > widths[:, None])
    ends = np.searchsorted(odd_block, np.arange(blocks + 1))
    item = next(b for b in (1, 2, 4, 8) if not blocks or int(needed.max()) <= 8 * b)
    odd_value = padded[odd_block, odd_place].astype(f"<u{item}")
    odd_place = odd_place.astype("<u2")
    body, starts, at = [], [], _STARTS + 8 * blocks
    for k in range(blocks):
        a, b = ends[k], ends[k + 1]
        piece = (
            int(lowest[k]).to_bytes(8, "little") + bytes((widths[k],)) + int(b - a).to_bytes(2, "little") + packed[k]
        )
        if b > a:
            piece += odd_place[a:b].tobytes() + odd_value[a:b].tobytes()
        starts.append(at)
        at += len(piece)
        body.append(piece)
    head = np.array([n, blocks, item], "<u8").tobytes() + np.array(starts, "<u8").tobytes()
    return head + b"".join(body)


def decode(stream: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Values [first, last) of a stream; only their blocks are read."""
    n, blocks, item = (int(x) for x in np.frombuffer(stream, "<u8", 3))
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint64)
    starts = np.frombuffer(stream, "<u8", blocks, _STARTS).astype(np.int64)
    begin, end = first // BLOCK, -(-last // BLOCK)
    octets = np.frombuffer(stream, np.uint8)
    starts = starts[begin:end]
    heads = octets[starts[:, None] + np.arange(_HEAD)]
    lowest = heads[:, :8].copy().view("<u8")[:, 0].astype(np.uint64)
    widths, odd = heads[:, 8], heads[:, 9:11].copy().view("<u2")[:, 0].astype(np.int64)
    out = np.empty((end - begin, BLOCK), np.uint64)
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        for at in range(0, len(own), _CHUNK):
            part = own[at : at + _CHUNK]
            span = starts[part][:, None] + _HEAD + np.arange(BLOCK // 8 * int(width))
            out[part] = _unpack(octets[span], int(width))
    for k in np.flatnonzero(odd):
        m = int(odd[k])
        at = int(starts[k]) + _HEAD + BLOCK // 8 * int(widths[k])
        out[k, np.frombuffer(stream, "<u2", m, at)] = np.frombuffer(stream, f"<u{item}", m, at + 2 * m)
    out += lowest[:, None]
    return out.reshape(-1)[first - begin * BLOCK : last - begin * BLOCK]
