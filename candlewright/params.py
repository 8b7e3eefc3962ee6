"""Strategy and trade settings. Field defaults and TRADING hold fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ZoneParams:
    """Thresholds of the zone detector.

    ``sensitivity`` is compared with a change *in percent*: 0.015 means 0.015 %.
    """

    sensitivity: float = 0.015
    min_volume_percentile: float = 50.0
    trend_period: int = 20
    min_distance: int = 10


# The setting used for live and compounding runs.
TRADING = ZoneParams(
    sensitivity=0.005, min_volume_percentile=30.0, trend_period=10, min_distance=5
)


@dataclass(frozen=True)
class TradeParams:
    """How zones become trades.

    entry_at       'origin' enters on the bar the zone starts at (looks 4..15 bars ahead),
                   'trigger' enters on the bar that revealed the zone.
    size_decimals  None keeps the exact size, a number rounds it half-even.
    stop_column    'final' reports the stop as last ratcheted, 'initial' as first set.
    """

    stop_pct: float = 0.02
    trail_pct: float = 0.015
    leverage: float = 1.0
    initial_capital: float = 100.0
    entry_at: str = "origin"
    size_decimals: int | None = None
    stop_reason: str = "stop_loss"
    stop_column: str = "final"


# Study with literal settings, and study with rounded sizes and the configured reason.
STUDY = TradeParams()
ROUNDED_STUDY = TradeParams(size_decimals=8, stop_reason="trailing_stop", stop_column="initial")


@dataclass(frozen=True)
class ChunkParams:
    """How a long history is cut: bars per chunk, and chunks per second-level group.

    A chunk with its rim of neighbours stays below the 4096 rows that Spark keeps in memory
    per window group before it turns to a sorter that spills.
    """

    size: int = 3968
    fan: int = 1024
    trade_block: int = 1 << 18
