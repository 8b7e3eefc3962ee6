"""Bar positions, and chunks of consecutive bars with a margin of neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewright.operators.scan import div, running


def bar_index(candles: DataFrame) -> DataFrame:
    """Add ``idx``, the 0-based position of a bar in its symbol's time order.

    Candles must be unique on (symbol, bar_ts); those without a time come first, those without
    a symbol form a history of their own. One calendar day of one symbol is the unit of
    work; a table that already has ``idx`` is returned as it is, so that an indexed table can
    be written once and reused.
    """
    if "idx" in candles.columns:
        return candles
    dated = candles.withColumn("_day", F.unix_date(F.to_date("bar_ts")))
    numbered = running(
        dated, ["symbol"], "_day", ["bar_ts"], {"_n": ("sum", F.lit(1).cast("bigint"))}
    )
    return numbered.withColumn("idx", F.col("_n") - 1).drop("_n", "_day")


def with_chunk(df: DataFrame, size: int, idx: str = "idx", name: str = "chunk") -> DataFrame:
    return df.withColumn(name, div(F.col(idx), size))


def halo_chunks(indexed: DataFrame, size: int, back: int, ahead: int = 2) -> DataFrame:
    """Cut symbols into chunks of ``size`` bars and lend each its neighbours' rim.

    A bar among the last ``back`` of its chunk is also copied into the next one, a bar among
    the first ``ahead`` into the previous one. Windows over (symbol, chunk) then see every bar
    they need for the rows marked ``own``.
    """
    if back > size:
        raise ValueError("a chunk must be at least as long as the lookback")
    home = div(F.col("idx"), size)
    offset = F.col("idx") % size
    homes = F.array_compact(
        F.array(
            home,
            F.when(offset >= size - back, home + 1),
            F.when((offset < ahead) & (home > 0), home - 1),
        )
    )
    copied = indexed.withColumn("chunk", F.explode(homes))
    return copied.withColumn("own", F.col("chunk") == home)
