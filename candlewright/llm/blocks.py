"""Sums of large fixed-size arrays over all tasks, block by block.

A task that has counted something into an array emits the array in blocks. Blocks with the same
number are added in a tree: first in groups of some `FAN`, then the groups' sums, and so on. A task
adds to one block at a time per block number it meets, however many tasks have counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from candlewright.session import materialize

BLOCK = 1 << 16


def split(values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Blocks of a flat array that are not all zero."""
    for k in range(0, len(values), BLOCK):
        block = values[k : k + BLOCK]
        if block.any():
            yield k // BLOCK, block.tobytes()


def pack(values: np.ndarray, kept: int = 4) -> bytes:
    """Numbers as the first `kept` bytes of their float32, byte by byte and compressed.

    Four bytes keep them as they are, three round them to 16 bits of mantissa.
    """
    whole = np.ascontiguousarray(values, "<f4").view("<u4")
    if kept < 4:
        whole = whole + np.uint32(1 << (8 * (4 - kept) - 1))
    planes = whole.view(np.uint8).reshape(-1, 4).T[4 - kept :]
    head = np.array([len(whole), kept], "<u4").tobytes()
    return head + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n, kept = (int(x) for x in np.frombuffer(data, "<u4", 2))
    planes = pa.decompress(memoryview(data)[8:], n * kept, codec="zstd", asbytes=True)
    whole = np.zeros((n, 4), np.uint8)
    whole[:, 4 - kept :] = np.frombuffer(planes, np.uint8).reshape(kept, n).T
    return whole.view("<f4").ravel()


#: Rows of one block that are added in one step of the tree, on average.
FAN = 16


def summed(blocks: DataFrame, kind: str | Callable[[bytes], np.ndarray]) -> DataFrame:
    """Rows `name, block, data` with the data of equal names and blocks added up.

    `kind` is the numpy type inside `data`, or a function that reads it; sums are kept in 64 bits and returned as float64. The
    blocks are read several times, so they should be a written table.
    """

    def adder(kind):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[str, int], np.ndarray] = {}
            for batch in batches:
                for name, block, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    values = kind(data) if callable(kind) else np.frombuffer(data, kind)
                    if (name, block) in held:
                        held[name, block] += values
                    else:
                        held[name, block] = values.astype(np.float64)
            for (name, block), values in held.items():
                yield pa.RecordBatch.from_pylist(
                    [{"name": name, "block": block, "data": values.tobytes()}],
                    schema=pa.schema([("name", pa.string()), ("block", pa.int32()), ("data", pa.binary())]),
                )

        return add

    rows = blocks.select("name", "block", "data")
    met = rows.groupBy("name", "block").agg(F.count(F.lit(1)).alias("n"))
    most = met.agg(F.max("n")).first()[0] or 0
    shape = "name string, block int, data binary"
    while most > 2 * FAN:
        groups = -(-most // FAN)
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
        dealt = rows.withColumn("part", part).repartition("name", "block", "part").drop("part")
        rows = materialize(dealt.mapInArrow(adder(kind), shape), "sums")
        # A group may meet another in its task, which only makes it one less.
        most, kind = groups, "float64"
    return rows.repartition(16, "name", "block").mapInArrow(adder(kind), shape)


def gathered(sums: DataFrame, size: int) -> dict[str, np.ndarray]:
    """The summed arrays by name; `size` numbers each, whatever the size of the corpus."""
    out: dict[str, np.ndarray] = {}
    for row in sums.toLocalIterator():
        values = np.frombuffer(row["data"], np.float64)
        at = row["block"] * BLOCK
        out.setdefault(row["name"], np.zeros(size))[at : at + len(values)] = values
    return out
