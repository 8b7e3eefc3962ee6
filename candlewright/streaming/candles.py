"""Candles from a stream of ticks, and a stream of candles without repeats.

Watermarks exist for instants only, so times without zone are read in the session's zone on
the way in and put back on the way out; run streams with the session zone UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewright.schema import CANDLE_COLUMNS, resolution_seconds
from candlewright.sources.ticks import tick_key


def stream_candles(
    ticks: DataFrame,
    resolution: str,
    late_by: str = "10 minutes",
    *,
    symbol: str = "symbol",
    ts: str = "ts",
    seq: str | None = "seq",
    price: str = "price",
    volume: str = "volume",
) -> DataFrame:
    """Bars that are closed for good: ``late_by`` after their end, by event time.

    Ticks later than that are dropped. Same bars as the batch operator for all closed ones.
    """
    timed = ticks.withColumn(ts, F.col(ts).cast("timestamp"))
    order = tick_key(timed, ts, seq)
    bar = F.window(ts, f"{resolution_seconds(resolution)} seconds")
    return (
        timed.withWatermark(ts, late_by)
        .groupBy(F.col(symbol).alias("symbol"), bar.alias("_bar"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.sum(volume).cast("double").alias("volume"),
        )
        .withColumn("bar_ts", F.col("_bar.start").cast("timestamp_ntz"))
        .select(*CANDLE_COLUMNS)
    )


def stream_dedupe(candles: DataFrame, late_by: str = "1 hour") -> DataFrame:
    """Candles seen again by a later poll are dropped; state is kept ``late_by`` long."""
    timed = candles.withColumn("bar_ts", F.col("bar_ts").cast("timestamp"))
    once = timed.withWatermark("bar_ts", late_by).dropDuplicatesWithinWatermark(
        ["symbol", "bar_ts"]
    )
    return once.withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz"))
