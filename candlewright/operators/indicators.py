"""Rolling indicators of a candle table.

Every function returns Columns over a given window, so that the planner puts all of them
behind one shuffle and one sort. A rolling mean is missing until its whole window is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from candlewright.operators.index import bar_index, halo_chunks
from candlewright.params import ChunkParams, ZoneParams

CHANGE_BARS = 4
VOLUME_MEAN_BARS = 20
VOLUME_RANK_BARS = 50
LONG_MEAN_BARS = 50
RANGE_MEAN_BARS = 14
MEAN_RANGE_MEAN_BARS = 20
MOMENTUM_BARS = 10
ORIGIN_NEAREST, ORIGIN_FARTHEST = 4, 15

# Bars of history any column here or in the zone detector looks back on.
LOOKBACK = 64
LOOKAHEAD = 2

BASIC = [
    "pc", "volume_ma", "volume_percentile", "sma_trend", "sma50", "tr", "atr", "roc",
    "swing_high", "swing_low", "avg_atr",
]


def percent_change(column: str, bars: int, w: WindowSpec) -> Column:
    old = F.lag(column, bars).over(w)
    return F.try_divide(F.col(column) - old, old) * 100


def rolling_mean(column: str, bars: int, w: WindowSpec) -> Column:
    frame = w.rowsBetween(1 - bars, 0)
    return F.when(F.count(column).over(frame) == bars, F.avg(column).over(frame))


def sorted_frame(column: str, bars: int, w: WindowSpec) -> Column:
    return F.sort_array(F.collect_list(column).over(w.rowsBetween(1 - bars, 0)))


def percentile_of_newest(frame: str, column: str, bars: int) -> Column:
    """Percent rank of the newest value in its ``sorted_frame``, ties sharing their mean rank.

    Uses native array functions; lambdas over the values would be interpreted one by one. The
    frame has to be a column of its own, or it would be sorted again for every mention.
    """
    newest = F.col(column)
    below = F.array_position(frame, newest) - 1
    above = F.array_position(F.reverse(frame), newest) - 1
    rank = (below + (bars - above) + 1) / 2
    return F.when((F.size(frame) == bars) & newest.isNotNull(), rank / bars * 100)


def true_range(w: WindowSpec) -> Column:
    before = F.lag("close").over(w)
    known = before.isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull()
    return F.when(
        known,
        F.greatest(
            F.col("high") - F.col("low"),
            F.abs(F.col("high") - before),
            F.abs(F.col("low") - before),
        ),
    )


def swing(column: str, w: WindowSpec, *, above: bool) -> Column:
    beats = F.lit(True)
    for shift in (1, 2, -1, -2):
        other = F.lag(column, shift).over(w)
        beats = beats & (F.col(column) > other if above else F.col(column) < other)
    return F.coalesce(beats, F.lit(False)).cast("int")


def chunk_window() -> WindowSpec:
    return Window.partitionBy("symbol", "chunk").orderBy("idx")


def chunk_size(params: ZoneParams, chunks: ChunkParams) -> int:
    return max(chunks.size, LOOKBACK, params.trend_period)


def in_chunks(candles: DataFrame, params: ZoneParams, chunks: ChunkParams) -> DataFrame:
    """Indexed candles, cut and overlapped far enough for every lookback.

    A table that already is (with ``chunk`` and ``own``) is used as it lies.
    """
    if {"chunk", "own"} <= set(candles.columns):
        return candles
    back = max(LOOKBACK, params.trend_period)
    return halo_chunks(bar_index(candles), chunk_size(params, chunks), back, LOOKAHEAD)


def add_indicators(chunked: DataFrame, params: ZoneParams, *, extras: bool = True) -> DataFrame:
    """Indicator columns on an overlapped, chunked table (rim rows included).

    ``extras`` adds those the zone detector does not ask for: volume mean and swing points.
    """
    w = chunk_window()
    more = []
    if extras:
        more = [
            rolling_mean("volume", VOLUME_MEAN_BARS, w).alias("volume_ma"),
            swing("high", w, above=True).alias("swing_high"),
            swing("low", w, above=False).alias("swing_low"),
        ]
    first = chunked.select(
        "*",
        percent_change("open", CHANGE_BARS, w).alias("pc"),
        sorted_frame("volume", VOLUME_RANK_BARS, w).alias("_volumes"),
        rolling_mean("close", params.trend_period, w).alias("sma_trend"),
        rolling_mean("close", LONG_MEAN_BARS, w).alias("sma50"),
        true_range(w).alias("tr"),
        percent_change("close", MOMENTUM_BARS, w).alias("roc"),
        *more,
    )
    ranked = first.withColumn(
        "volume_percentile", percentile_of_newest("_volumes", "volume", VOLUME_RANK_BARS)
    ).drop("_volumes")
    return ranked.withColumn("atr", rolling_mean("tr", RANGE_MEAN_BARS, w)).withColumn(
        "avg_atr", rolling_mean("atr", MEAN_RANGE_MEAN_BARS, w)
    )


def indicators(
    candles: DataFrame, params: ZoneParams = ZoneParams(), chunks: ChunkParams = ChunkParams()
) -> DataFrame:
    """Candles with ``idx`` and every indicator column, one row per candle."""
    wide = add_indicators(in_chunks(candles, params, chunks), params)
    return wide.where("own").drop("own", "chunk")
