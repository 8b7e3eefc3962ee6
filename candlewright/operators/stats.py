"""Trade and candle statistics: one aggregation per symbol, combined on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.operators.trades import running_drawdown
from candlewright.params import ChunkParams, TradeParams

HISTOGRAM_BINS = 20


def completed_trades(trades: DataFrame) -> DataFrame:
    return trades.where("pnl is not null")


def winners(trades: DataFrame) -> DataFrame:
    return trades.where("pnl > 0")


def losers(trades: DataFrame) -> DataFrame:
    return trades.where("pnl < 0")


def trade_markers(trades: DataFrame) -> DataFrame:
    """Where trades were entered."""
    return trades.select("symbol", "type", "entry_time", "entry_price")


def _mean_or_zero(wanted: Column) -> Column:
    return F.coalesce(F.avg(F.when(wanted, F.col("pnl"))), F.lit(0.0))


def trade_stats(
    trades: DataFrame, params: TradeParams = TradeParams(), by: tuple[str, ...] = ("symbol",)
) -> DataFrame:
    """Statistics of completed trades per ``by``.

    ``profit_factor`` is mean win over mean loss, infinite without losses. The final capital is
    that of a symbol's last trade, so it and the total return come only with ``symbol`` in ``by``.
    """
    pnl = F.col("pnl")
    grouped = completed_trades(trades).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_trades"),
        (F.avg(F.when(pnl > 0, 1.0).otherwise(0.0)) * 100).alias("win_rate"),
        _mean_or_zero(pnl > 0).alias("avg_win"),
        _mean_or_zero(pnl < 0).alias("avg_loss"),
        F.avg("return_pct").alias("avg_return_pct"),
        F.max("pnl").alias("max_pnl"),
        F.min("pnl").alias("min_pnl"),
        F.avg("entry_capital").alias("avg_entry_capital"),
        *([F.max_by("exit_capital", "trade_no").alias("final_capital")] if "symbol" in by else []),
    )
    factor = F.when(F.col("avg_loss") == 0, F.lit(float("inf"))).otherwise(
        F.abs(F.try_divide("avg_win", "avg_loss"))
    )
    result = grouped.withColumn("profit_factor", factor)
    if "symbol" not in by:
        return result
    initial = float(params.initial_capital)
    return result.withColumn("initial_capital", F.lit(initial)).withColumn(
        "total_return_pct", (F.col("final_capital") - initial) / initial * 100
    )


def trade_drawdown(trades: DataFrame, chunks: ChunkParams = ChunkParams()) -> DataFrame:
    """Completed trades with the highest exit capital so far and the fall below it."""
    return running_drawdown(
        completed_trades(trades),
        ["symbol"],
        "entry_idx",
        "exit_capital",
        chunks.trade_block,
        chunks.fan,
    )


def equity_drawdown(equity: DataFrame, chunks: ChunkParams = ChunkParams()) -> DataFrame:
    return running_drawdown(equity, ["symbol"], "idx", "equity", chunks.size, chunks.fan)


def max_drawdown(with_drawdown: DataFrame) -> DataFrame:
    return with_drawdown.groupBy("symbol").agg(F.min("drawdown_pct").alias("max_drawdown_pct"))


def trade_report(
    trades: DataFrame, params: TradeParams = TradeParams(), chunks: ChunkParams = ChunkParams()
) -> DataFrame:
    """Statistics and drawdown of each symbol."""
    drawdown = max_drawdown(trade_drawdown(trades, chunks))
    return trade_stats(trades, params).join(drawdown, "symbol", "left")


def pnl_histogram(trades: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins of pnl per symbol, empty bins included, the last one closed.

    A symbol with a single value gets a range half a unit to each side.
    """
    done = completed_trades(trades).select("symbol", "pnl")
    spread = done.groupBy("symbol").agg(F.min("pnl").alias("lo"), F.max("pnl").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ranges = spread.select(
        "symbol",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    bucket = F.least(F.width_bucket("pnl", "lo", "hi", F.lit(bins)), F.lit(bins))
    counts = (
        done.join(ranges, "symbol")
        .groupBy("symbol", bucket.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    every = ranges.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    return every.join(counts, ["symbol", "bin"], "left").select(
        "symbol",
        "bin",
        (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_lo"),
        (F.col("lo") + width * F.col("bin")).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def trade_list(trades: DataFrame) -> DataFrame:
    """Completed trades in order, as printed: minutes, cents."""
    minute = "yyyy-MM-dd HH:mm"
    return (
        completed_trades(trades)
        .orderBy("symbol", "trade_no")
        .select(
            "symbol",
            "trade_no",
            "type",
            F.date_format("entry_time", minute).alias("entry_time"),
            F.date_format("exit_time", minute).alias("exit_time"),
            F.round("entry_price", 2).alias("entry_price"),
            F.round("exit_price", 2).alias("exit_price"),
            F.round("pnl", 2).alias("pnl"),
            F.round("return_pct", 2).alias("return_pct"),
        )
    )


def price_range(candles: DataFrame) -> DataFrame:
    return candles.groupBy("symbol").agg(
        F.min("low").alias("min_low"), F.max("high").alias("max_high")
    )


def last_bar(candles: DataFrame) -> DataFrame:
    return candles.groupBy("symbol").agg(
        F.max("bar_ts").alias("last_ts"), F.max_by("close", "bar_ts").alias("last_close")
    )


def candle_summary(candles: DataFrame) -> DataFrame:
    return candles.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.min("bar_ts").alias("first_ts"),
        F.max("bar_ts").alias("last_ts"),
    )


def position_from_events(
    events: DataFrame, key: str = "symbol", ts: str = "event_ts", seq: str = "event_id"
) -> DataFrame:
    """Current position: the newest event of each key; an exit clears the prices."""
    newest = events.groupBy(key).agg(
        F.max_by(
            F.struct("type", "direction", "price", "stop_loss", "trailing_stop"),
            F.struct(ts, seq),
        ).alias("e")
    )
    entered = F.col("e.type") == "entry"
    sign = F.when(F.col("e.direction") == "long", 1).otherwise(-1)
    return newest.select(
        key,
        F.when(entered, sign).otherwise(0).alias("position"),
        F.when(entered, F.col("e.price")).alias("entry_price"),
        F.when(entered, F.col("e.stop_loss")).alias("stop_loss"),
        F.when(entered, F.col("e.trailing_stop")).alias("trailing_stop"),
    )
