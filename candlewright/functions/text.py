"""Message texts. The wording is fixed; sending them is not part of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.params import TradeParams, ZoneParams

# Fixed marks in front of messages.
BUY_MARK, SELL_MARK, ERROR_MARK, START_MARK = "🟢", "🔴", "⚠️", "🚀"


def trade_alert(side: Column, symbol: Column, price: Column, size: Column) -> Column:
    mark = F.when(F.lower(side) == "buy", BUY_MARK).otherwise(SELL_MARK)
    return F.concat(
        mark, F.lit(" <b>"), F.upper(side), F.lit(" Alert</b>\n\nSymbol: "), symbol,
        F.lit("\nPrice: "), price, F.lit("\nSize: "), size.cast("string"),
    )


def exit_alert(price: Column, pnl: Column, reason: Column) -> Column:
    return F.concat(
        F.lit("<b>EXIT Alert</b>\n\nPrice: "), F.round(price, 2).cast("string"),
        F.lit("\nPnL: "), F.round(pnl, 2).cast("string"), F.lit("\nReason: "), reason,
    )


def error_alert(message: Column) -> Column:
    return F.concat(F.lit(f"{ERROR_MARK} <b>Error Alert</b>\n\n"), message)


def startup_text(
    product_id: int, timeframe: str, zones: ZoneParams, trades: TradeParams
) -> str:
    lines = [
        f"{START_MARK} Trading Bot Started!",
        f"Product ID: {product_id}",
        f"Initial Capital: ${trades.initial_capital:g}",
        f"Leverage: {trades.leverage:g}x",
        "Order Block Strategy Params:",
        f"- Candle TF: {timeframe}",
        f"- Price Move Threshold: {zones.sensitivity * 100:.2f}%",
        f"- Min Volume Percentile: {zones.min_volume_percentile:g}",
        "- SMA Trend: 20/50",
        f"- Min Candles Between Trades: {zones.min_distance}",
        f"- Stop Loss: {trades.stop_pct * 100:.2f}%",
        f"- Trailing Stop: {trades.trail_pct * 100:.2f}%",
    ]
    return "\n".join(lines)


def _general(value: Column) -> Column:
    """A number without the zeros it does not need."""
    shown = F.regexp_replace(F.format_string("%.6f", value.cast("double")), r"\.?0+$", "")
    return F.when(value.isNotNull(), shown)


def _percent(share: Column) -> Column:
    shown = F.concat(F.format_string("%.2f", share.cast("double") * 100), F.lit("%"))
    return F.when(share.isNotNull(), shown)


def startup_message(settings: DataFrame) -> DataFrame:
    """One message per run about to start.

    ``settings``: product_id, timeframe, initial_capital, leverage, sensitivity,
    min_volume_percentile, min_distance, stop_pct, trail_pct; other columns are kept. A missing
    setting reads ``?``.
    """
    values = {
        "Product ID: ": F.col("product_id").cast("string"),
        "Initial Capital: $": _general(F.col("initial_capital")),
        "Leverage: ": F.concat(_general(F.col("leverage")), F.lit("x")),
        "- Candle TF: ": F.col("timeframe"),
        "- Price Move Threshold: ": _percent(F.col("sensitivity")),
        "- Min Volume Percentile: ": _general(F.col("min_volume_percentile")),
        "- Min Candles Between Trades: ": F.col("min_distance").cast("string"),
        "- Stop Loss: ": _percent(F.col("stop_pct")),
        "- Trailing Stop: ": _percent(F.col("trail_pct")),
    }
    lines = [F.concat(F.lit(k), F.coalesce(v, F.lit("?"))) for k, v in values.items()]
    lines.insert(0, F.lit(f"{START_MARK} Trading Bot Started!"))
    lines.insert(4, F.lit("Order Block Strategy Params:"))
    lines.insert(8, F.lit("- SMA Trend: 20/50"))
    return settings.withColumn("message", F.array_join(F.array(*lines), "\n"))


def alert_text(trades: DataFrame) -> DataFrame:
    """An entry and an exit message for every trade."""
    side = F.when(F.col("type") == "long", "BUY").otherwise("SELL")
    entry = trade_alert(side, F.col("symbol"), F.lit("MARKET"), F.round("position_size", 8))
    leave = exit_alert(F.col("exit_price"), F.col("pnl"), F.col("exit_reason"))
    return trades.select(
        "symbol",
        "trade_no",
        F.explode(
            F.array(
                F.struct(F.lit("entry").alias("kind"), entry.alias("message")),
                F.struct(F.lit("exit").alias("kind"), leave.alias("message")),
            )
        ).alias("m"),
    ).select("symbol", "trade_no", "m.kind", "m.message")
