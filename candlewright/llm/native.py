"""Column expressions over texts that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row, however often `body` refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text in order; none for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def hashes(items: Column) -> Column:
    return F.transform(items, lambda x: F.xxhash64(x))


def grams(hashed: Column, size: int) -> Column:
    """Hashes of all runs of `size` items; none when there are fewer items."""

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - size)
        run = lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)])
        none = F.array().cast("array<bigint>")
        return F.when(F.size(h) >= size, F.transform(starts, run)).otherwise(none)

    return let(hashed, windows)


def packed(docs: DataFrame, *added: Column) -> DataFrame:
    """The rows as one struct `doc`, so that added columns never clash with theirs."""
    return docs.select(F.struct("*").alias("doc"), *added)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("doc.*")
