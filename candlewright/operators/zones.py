"""Order-block zones: where momentum crossed, what passed the gates, which bar it came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewright.operators.chain import follow_chain
from candlewright.operators.index import with_chunk
from candlewright.operators.indicators import (
    ORIGIN_FARTHEST,
    ORIGIN_NEAREST,
    add_indicators,
    chunk_window,
    in_chunks,
)
from candlewright.operators.scan import running
from candlewright.params import ChunkParams, ZoneParams
from candlewright.schema import ZONE_COLUMNS
from candlewright.session import materialize

# Averages summed in another order differ in the last bits; that is not a trend.
SAME_WITHIN = 1e-12


def above(a: Column, b: Column) -> Column:
    """a > b by more than rounding noise."""
    return a - b > F.lit(SAME_WITHIN) * F.greatest(F.abs(a), F.abs(b))


def crossing_side(params: ZoneParams, pc: Column, prev: Column) -> Column:
    """'bull' where the change rises through +s, 'bear' where it falls through -s."""
    s = F.lit(params.sensitivity)
    return F.when((prev > -s) & (pc <= -s), "bear").when((prev < s) & (pc >= s), "bull")


def volume_gate(params: ZoneParams) -> Column:
    return F.coalesce(F.col("volume_percentile") >= params.min_volume_percentile, F.lit(False))


def trend_unknown() -> Column:
    return F.col("sma_trend").isNull() | F.col("sma50").isNull() | F.col("roc").isNull()


def trend_gate(side: Column) -> Column:
    a, b = F.col("sma_trend"), F.col("sma50")
    return F.when(trend_unknown(), True).when(side == "bull", above(a, b)).otherwise(above(b, a))


def volatility_gate() -> Column:
    return F.coalesce(~above(F.col("atr"), F.col("avg_atr") * 2), F.lit(True))


def trade_condition(params: ZoneParams, side: Column) -> Column:
    """All gates; an unknown trend accepts at once, without asking for volatility."""
    return volume_gate(params) & (trend_unknown() | (trend_gate(side) & volatility_gate()))


def candle_color() -> Column:
    return F.when(F.col("close") > F.col("open"), "up").when(F.col("close") < F.col("open"), "down")


def origin_bar(color: str) -> Column:
    """The latest bar 15..4 bars back with that colour and all four prices.

    The latest one of all earlier bars costs one step per row; whether it is near enough is
    asked afterwards.
    """
    whole = F.col("high").isNotNull() & F.col("low").isNotNull() & (candle_color() == color)
    bar = F.struct(F.col("idx"), F.col("high"), F.col("low"))
    frame = chunk_window().rowsBetween(Window.unboundedPreceding, -ORIGIN_NEAREST)
    return F.last(F.when(whole, bar), ignorenulls=True).over(frame)


def crossings(
    candles: DataFrame, params: ZoneParams = ZoneParams(), chunks: ChunkParams = ChunkParams()
) -> DataFrame:
    """Every momentum crossing with its gates and origin bar (null if there is none)."""
    w = chunk_window()
    wide = add_indicators(in_chunks(candles, params, chunks), params, extras=False)
    marked = wide.select(
        "*",
        F.lag("pc").over(w).alias("prev_pc"),
        origin_bar("up").alias("up_bar"),
        origin_bar("down").alias("down_bar"),
    )
    side = crossing_side(params, F.col("pc"), F.col("prev_pc"))
    found = marked.withColumn("side", side).where("own and side is not null")
    latest = F.when(F.col("side") == "bear", F.col("up_bar")).otherwise(F.col("down_bar"))
    origin = F.when(latest["idx"] >= F.col("idx") - ORIGIN_FARTHEST, latest)
    return found.select(
        "symbol",
        "side",
        "idx",
        "bar_ts",
        "pc",
        "prev_pc",
        volume_gate(params).alias("volume_ok"),
        trend_gate(F.col("side")).alias("trend_ok"),
        volatility_gate().alias("volatility_ok"),
        trade_condition(params, F.col("side")).alias("accepted"),
        origin.alias("origin"),
    )


def zone_candidates(
    candles: DataFrame, params: ZoneParams = ZoneParams(), chunks: ChunkParams = ChunkParams()
) -> DataFrame:
    """Accepted crossings that have an origin bar, before the distance rule."""
    return crossings(candles, params, chunks).where("accepted and origin is not null").select(
        "symbol",
        "side",
        F.col("idx").alias("trigger_idx"),
        F.col("origin.idx").alias("start_idx"),
        F.col("origin.high").alias("top"),
        F.col("origin.low").alias("bot"),
    )


def min_distance_thin(
    candidates: DataFrame, min_distance: int, chunks: ChunkParams = ChunkParams()
) -> DataFrame:
    """Keep a candidate if it lies ``min_distance`` bars or more after the last kept one.

    Both sides share the clock.
    """
    nodes = candidates.withColumn("_next", F.col("trigger_idx") + min_distance)
    return follow_chain(nodes, "symbol", "trigger_idx", "_next", chunks).drop("_next")


def order_blocks(
    candles: DataFrame, params: ZoneParams = ZoneParams(), chunks: ChunkParams = ChunkParams()
) -> DataFrame:
    """Zones (symbol, side, trigger_idx, start_idx, top, bot) of a full scan."""
    candidates = materialize(zone_candidates(candles, params, chunks), "candidates")
    return min_distance_thin(candidates, params.min_distance, chunks).select(*ZONE_COLUMNS)


def last_zone_index(zones: DataFrame) -> DataFrame:
    """Last zone start per symbol and side, and the bar an incremental scan resumes at."""
    return zones.groupBy("symbol").agg(
        F.max(F.when(F.col("side") == "bull", F.col("start_idx"))).alias("last_bull_idx"),
        F.max(F.when(F.col("side") == "bear", F.col("start_idx"))).alias("last_bear_idx"),
        F.greatest(F.lit(4), F.max("start_idx")).alias("resume_idx"),
    )


def signal_bars(zones: DataFrame, entry_at: str = "origin") -> DataFrame:
    """Bars that carry a signal: (symbol, idx, side, n_copies)."""
    idx = {"origin": "start_idx", "trigger": "trigger_idx"}[entry_at]
    return (
        zones.groupBy("symbol", F.col(idx).alias("idx"), "side")
        .agg(F.count(F.lit(1)).alias("n_copies"))
    )


def bars_at_zone_start(indexed: DataFrame, zones: DataFrame) -> DataFrame:
    """Candles on which at least one zone starts."""
    return indexed.join(signal_bars(zones), ["symbol", "idx"])


def signals_on_last_bar(indexed: DataFrame, zones: DataFrame, entry_at: str = "origin") -> DataFrame:
    """Signals that sit on the newest bar of their symbol."""
    newest = indexed.groupBy("symbol").agg(F.max("idx").alias("idx"))
    return signal_bars(zones, entry_at).join(newest, ["symbol", "idx"])


def signals_at_polls(
    indexed: DataFrame, zones: DataFrame, entry_at: str = "trigger", every_seconds: int = 86400
) -> DataFrame:
    """What a run that looks every ``every_seconds`` acts on: signals on each look's newest bar.

    Looks are at whole multiples of the interval from 1970 on; ``polled_at`` is the end of the one
    that first sees the bar. Zones of a bar do not depend on later bars, so one scan serves all looks.
    """
    # The window is half open, as a look takes in the bars before its instant.
    look = F.window("bar_ts", f"{every_seconds} seconds")["end"].cast("timestamp_ntz")
    newest = (
        indexed.where("bar_ts is not null")
        .groupBy("symbol", look.alias("polled_at"))
        .agg(F.max("idx").alias("idx"))
    )
    return signal_bars(zones, entry_at).join(newest, ["symbol", "idx"])


def zone_active_bars(
    indexed: DataFrame, zones: DataFrame, chunks: ChunkParams = ChunkParams()
) -> DataFrame:
    """Zones of each side that cover a bar; a zone lasts from its start to the end of data."""
    starts = zones.groupBy("symbol", F.col("start_idx").alias("idx")).agg(
        F.lit(None).cast("timestamp_ntz").alias("bar_ts"),
        F.count_if(F.col("side") == "bull").alias("_bull"),
        F.count_if(F.col("side") == "bear").alias("_bear"),
    )
    none = F.lit(0).cast("bigint")
    bars = indexed.select("symbol", "idx", "bar_ts", none.alias("_bull"), none.alias("_bear"))
    # Starts are rows beside the bars rather than joined to them: one shuffle of the bars.
    counted = running(
        with_chunk(bars.unionByName(starts), chunks.size),
        ["symbol"],
        "chunk",
        ["idx"],
        {"active_bull": ("sum", F.col("_bull")), "active_bear": ("sum", F.col("_bear"))},
        fan=chunks.fan,
        peers=True,
    ).where("bar_ts is not null")
    return counted.select("symbol", "idx", "bar_ts", "active_bull", "active_bear")


def zone_overlay(indexed: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone edges as fractions of the symbol's price range, and the bars they span."""
    ranges = indexed.groupBy("symbol").agg(
        F.min("low").alias("lo"), F.max("high").alias("hi"), F.max("idx").alias("last_idx")
    )
    span = F.col("hi") - F.col("lo")
    return zones.join(ranges, "symbol").select(
        "symbol",
        "side",
        "trigger_idx",
        "start_idx",
        "last_idx",
        F.try_divide(F.col("bot") - F.col("lo"), span).alias("bot_frac"),
        F.try_divide(F.col("top") - F.col("lo"), span).alias("top_frac"),
    )
