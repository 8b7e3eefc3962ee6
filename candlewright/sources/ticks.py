"""Candles from ticks, and coarser candles from finer ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType, TimestampNTZType

from candlewright.operators.scan import running
from candlewright.schema import CANDLE_COLUMNS, resolution_seconds


def bar_start(ts: Column | str, resolution: str) -> Column:
    return F.window(ts, f"{resolution_seconds(resolution)} seconds")["start"].cast("timestamp_ntz")


# Farther apart than any two sequence numbers of 64 bits.
_STRIDE = "20000000000000000000"


def _micros(ticks: DataFrame, ts: str) -> Column:
    if not isinstance(ticks.schema[ts].dataType, TimestampNTZType):
        return F.unix_micros(F.col(ts).cast("timestamp"))
    # Not by way of the session's zone, where two times may fall on one.
    minutes = F.unix_date(F.to_date(ts)).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), F.col(ts)) * 1_000_000).cast("bigint")


def tick_key(ticks: DataFrame, ts: str, seq: str | None) -> Column:
    """Time and sequence number in one value of fixed width that sorts like the pair.

    A pair is no fixed-width value, so taking its extremes makes Spark sort all ticks first; a decimal
    keeps the aggregation hash-based. A tick without a number comes before those with one. A ``seq`` that
    is no whole number (such as a text) is compared as it is, at the price of the sort.
    """
    if seq is None:
        return F.col(ts)
    if not isinstance(ticks.schema[seq].dataType, IntegralType):
        return F.struct(ts, seq)
    wide = "decimal(20,0)"
    number = F.coalesce(F.col(seq).cast(wide), F.lit("-9223372036854775809").cast(wide))
    return _micros(ticks, ts).cast("decimal(18,0)") * F.lit(_STRIDE).cast(wide) + number


def candles_from_ticks(
    ticks: DataFrame,
    resolution: str,
    *,
    symbol: str = "symbol",
    ts: str = "ts",
    seq: str | None = "seq",
    price: str = "price",
    volume: str = "volume",
) -> DataFrame:
    """OHLCV bars of the ticks; ``seq`` orders ticks of one instant."""
    at = tick_key(ticks, ts, seq)
    return (
        ticks.select(
            F.col(symbol).alias("symbol"),
            bar_start(ts, resolution).alias("bar_ts"),
            at.alias("_at"),
            F.col(price).alias("_price"),
            F.col(volume).alias("_volume"),
        )
        .groupBy("symbol", "bar_ts")
        .agg(
            F.min_by("_price", "_at").alias("open"),
            F.max("_price").alias("high"),
            F.min("_price").alias("low"),
            F.max_by("_price", "_at").alias("close"),
            F.sum("_volume").cast("double").alias("volume"),
        )
        .select(*CANDLE_COLUMNS)
    )


def resample_candles(candles: DataFrame, resolution: str) -> DataFrame:
    """Roll candles up to a coarser resolution."""
    return (
        candles.withColumn("_bar", bar_start("bar_ts", resolution))
        .groupBy("symbol", "_bar")
        .agg(
            F.min_by("open", "bar_ts").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "bar_ts").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .withColumnRenamed("_bar", "bar_ts")
        .select(*CANDLE_COLUMNS)
    )


def price_walk(events: DataFrame) -> DataFrame:
    """Ticks whose price walks: 500 plus a hundredth of the running sum of (value - 50).

    The sum is carried minute by minute, so a symbol's ticks are never gathered in one task.
    """
    exact = F.col("value").cast("decimal(18,2)")
    ticks = events.select(
        F.col("event_type").alias("symbol"),
        "ts",
        F.col("event_id").alias("seq"),
        exact.alias("volume"),
        (F.unix_date(F.to_date("ts")) * 1440 + F.hour("ts") * 60 + F.minute("ts"))
        .cast("bigint")
        .alias("_minute"),
    )
    walked = running(
        ticks, ["symbol"], "_minute", ["ts", "seq"], {"_sum": ("sum", F.col("volume") - 50)}
    )
    price = (F.lit(500) + F.lit("0.01").cast("decimal(3,2)") * F.col("_sum")).cast("double")
    return walked.select("symbol", "ts", "seq", "volume", price.alias("price"))


def walk_candles(events: DataFrame, resolution: str = "1h") -> DataFrame:
    return candles_from_ticks(price_walk(events), resolution)
