"""Declared table shapes."""

from __future__ import annotations

CANDLE = (
    "symbol string, bar_ts timestamp_ntz, open double, high double, "
    "low double, close double, volume double"
)
OHLCV = ["open", "high", "low", "close", "volume"]
CANDLE_COLUMNS = ["symbol", "bar_ts", *OHLCV]

ZONE_COLUMNS = ["symbol", "side", "trigger_idx", "start_idx", "top", "bot"]

TRADE_COLUMNS = [
    "symbol", "trade_no", "type", "entry_idx", "exit_idx", "entry_price", "entry_time",
    "entry_capital", "position_size", "stop_loss", "exit_price", "exit_time", "pnl",
    "exit_capital", "exit_reason", "return_pct",
]

EQUITY_COLUMNS = ["symbol", "idx", "bar_ts", "position", "equity"]

# Resolution names and their length in seconds; anything else is read as one minute.
RESOLUTIONS = {"1m": 60, "5m": 300, "15m": 900, "1h": 3600, "4h": 14400, "1d": 86400}

ORDER_TYPES = ["market_order", "limit_order"]
TIME_IN_FORCE = ["fok", "ioc", "gtc"]


def resolution_seconds(name: str) -> int:
    return RESOLUTIONS.get(name, RESOLUTIONS["1m"])
