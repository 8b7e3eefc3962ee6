"""Words of whole batches of texts as 64-bit hashes, without a loop over words.

A word's hash is a polynomial over its bytes, taken from one running sum over the batch, and then
mixed. Letters A-Z count as a-z; words end at the six ASCII blanks and at the end of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

#: Bytes of text handled at a time; a longer text is handled alone.
SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
BLANK = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_VALUE = mix(LOWER.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int, way: str) -> np.ndarray:
    """Powers 0 to n-1 of the base, or of its inverse modulo 2 ** 64."""
    if len(_powers[way]) < n:
        base = _BASE if way == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(max(n, SLICE + 1), base, np.uint64)
        steps[0] = 1
        _powers[way] = np.multiply.accumulate(steps)
    return _powers[way][:n]


def text_bytes(name: str) -> Column:
    """A text column as bytes; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and where each value begins and the last ends."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind, len(column) + 1, column.offset * (8 if wide else 4))
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held, offsets.astype(np.int64)


def parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: first and last row, their bytes, and offsets into these."""
    data, offsets = buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1]
        yield first, last, data[own[0] : own[-1]], own - own[0]
        first = last


@dataclass
class Words:
    hashes: np.ndarray
    #: Words of text k are bounds[k] to bounds[k + 1].
    bounds: np.ndarray
    #: First byte of each word, and one after its last.
    begins: np.ndarray
    ends: np.ndarray


def hash_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none)
    # Bytes are always inside the tables; in this mode numpy does not check them one by one.
    blank = BLANK.take(data, mode="clip")
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin, end = ~blank, ~blank
    begin[1:] &= blank[:-1] | edge[1:n]
    end[:-1] &= blank[1:] | edge[1:n]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE.take(data, mode="clip") * _power(n, "up"), out=run[1:])
    hashes = (run[ends] - run[begins]) * _power(n, "down")[begins]
    hashes = mix(hashes + (ends - begins).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return Words(hashes, np.searchsorted(begins, offsets), begins, ends)
