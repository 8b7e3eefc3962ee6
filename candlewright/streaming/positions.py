"""One open position per symbol, carried through a stream of signal bars.

Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from candlewright.params import TradeParams

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_STATE = (
    "position int, entry_idx bigint, entry_ts timestamp, entry_price double, stop double, "
    "size double, capital double, entry_capital double, last_idx bigint, trade_no bigint, "
    "n_early bigint, lost bigint"
)

POSITION = (
    "symbol string, idx bigint, bar_ts timestamp, position int, equity double, "
    "trade_no bigint, type string, entry_idx bigint, entry_time timestamp, entry_price double, "
    "entry_capital double, position_size double, stop_loss double, exit_price double, "
    "pnl double, exit_capital double, exit_reason string, n_missing bigint"
)
_TRADE_FIELDS = 12
_EARLY = "bar_ts timestamp, close double, side string, n_copies bigint"


class PositionProcessor(StatefulProcessor):
    """Per bar: trail the stop and leave if it is hit, then act on the bar's signal.

    Bars count from 0 without gaps. One that comes before its turn waits in the state until the bars
    before it have come, in whatever files or batches they lie; one that comes again is passed over. Bars
    are taken frame by frame, and waiting ones are looked up by number, so memory holds one frame.

    ``gap_delay`` (milliseconds of event time): when the watermark has passed a waiting bar by so much,
    the bars it waits for are given up. The next row says in ``n_missing`` how many.
    """

    def __init__(self, params: TradeParams, gap_delay: int | None = None):
        self.params = params
        self.gap_delay = gap_delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _STATE)
        self.early = handle.getMapState("early", "idx bigint", _EARLY)

    def _load(self) -> None:
        if self.held.exists():
            held = self.held.get()
        else:
            cash = float(self.params.initial_capital)
            held = (0, -1, None, 0.0, 0.0, 0.0, cash, cash, -1, 0, 0, 0)
        *self.state, self.last, self.number, self.n_early, self.lost = held

    def _save(self) -> None:
        self.held.update((*self.state, self.last, self.number, self.n_early, self.lost))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._load()
        for frame in rows:
            out = []
            bars = frame.sort_values("idx")
            for idx, ts, close, side, copies in zip(
                bars["idx"], bars["bar_ts"], bars["close"], bars["side"], bars["n_copies"]
            ):
                bar = (
                    ts,
                    None if close is None or close != close else float(close),
                    side if isinstance(side, str) else None,
                    int(copies),
                )
                if idx == self.last + 1:
                    self._forget(int(idx))
                    self._step(key, int(idx), bar, out)
                    self._follow(key, out)
                elif idx > self.last:
                    self._keep(int(idx), bar)
            yield _frame(out)
        self._save()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._load()
        out = []
        watermark = timerValues.getCurrentWatermarkInMs()
        while self.n_early:
            idx, first = min((k[0], v[0]) for k, v in self.early.iterator())
            if _millis(first) + self.gap_delay > watermark:
                break
            self.lost += idx - self.last - 1
            self.last = idx - 1
            self._follow(key, out)
        self._save()
        yield _frame(out)

    def _keep(self, idx: int, bar: tuple) -> None:
        if self.n_early and self.early.containsKey((idx,)):
            return
        self.early.updateValue((idx,), bar)
        self.n_early += 1
        if self.gap_delay is not None:
            self.handle.registerTimer(_millis(bar[0]) + self.gap_delay)

    def _forget(self, idx: int) -> None:
        if self.n_early and self.early.containsKey((idx,)):
            self.early.removeKey((idx,))
            self.n_early -= 1

    def _follow(self, key, out: list) -> None:
        """Take the waiting bars whose turn has come."""
        while self.n_early and self.early.containsKey((self.last + 1,)):
            idx = self.last + 1
            bar = self.early.getValue((idx,))
            self._forget(idx)
            self._step(key, idx, bar, out)

    def _step(self, key, idx: int, bar: tuple, out: list) -> None:
        p = self.params
        self.last = idx
        ts, close, side, copies = bar
        if close is None:
            return
        pos, entry, entry_ts, price, stop, size, cash, staked = self.state
        closed = (None,) * _TRADE_FIELDS
        stopped = False
        if pos == 1:
            stop = max(stop, close * (1 - p.trail_pct))
            stopped = close <= stop
        elif pos == -1:
            stop = min(stop, close * (1 + p.trail_pct))
            stopped = close >= stop
        signal = (1 if side == "bull" else -1) if copies > 0 and idx >= 1 else 0
        met = pos != 0 and not stopped and signal == -pos
        was_flat = pos == 0
        if stopped or met:
            pnl = pos * (size * close - size * price)
            before, cash = staked, cash + pnl
            closed = (
                self.number, "long" if pos == 1 else "short", entry, entry_ts, price, before, size,
                stop, close, pnl, cash, p.stop_reason if stopped else "opposite_signal",
            )
            pos = 0
        if signal and (was_flat or stopped or (met and copies >= 2)):
            pos, entry, entry_ts, price, staked = signal, idx, ts, close, cash
            size = cash * p.leverage / close
            if p.size_decimals is not None:
                size = round(size, p.size_decimals)
            stop = close * (1 - p.stop_pct if pos == 1 else 1 + p.stop_pct)
            self.number += 1
        equity = cash + (pos * (size * close - size * price) if pos else 0.0)
        out.append((key[0], idx, ts, pos, equity, *closed, self.lost))
        self.lost = 0
        self.state = [pos, entry, entry_ts, price, stop, size, cash, staked]

    def close(self) -> None:
        pass


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[f.split()[0] for f in POSITION.split(", ")])


def _millis(ts) -> int:
    """Milliseconds from 1970 of a time as pandas or the state gives it, which both are UTC."""
    stamp = pd.Timestamp(ts)
    stamp = stamp.tz_localize("UTC") if stamp.tzinfo is None else stamp
    return int(stamp.timestamp() * 1000)


def stream_positions(
    bars: DataFrame, params: TradeParams = TradeParams(), gap_delay: str | None = None
) -> DataFrame:
    """Position and equity after every bar, and the trade a bar closed if it closed one.

    ``bars`` streams (symbol, idx, bar_ts, close, side, n_copies) as ``SignalStream`` writes them.
    Bars without a price change nothing and give no row.

    Without ``gap_delay`` a bar waits for the one before it for as long as it takes. With it (such as
    '2 hours') event time decides: bars older than the newest of all symbols by more than the delay are
    dropped as any late row is, and a bar no longer waits for them. ``n_missing`` counts, on the next
    bar with a price, those given up since the last one. Needs the session zone UTC.
    """
    rows = bars.withColumn("bar_ts", F.col("bar_ts").cast("timestamp"))
    delay = None
    if gap_delay is not None:
        rows = rows.withWatermark("bar_ts", gap_delay)
        # The watermark already lags by the delay.
        delay = 0
    return rows.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=PositionProcessor(params, delay),
        outputStructType=POSITION,
        outputMode="Append",
        timeMode="None" if gap_delay is None else "EventTime",
    )


def stream_equity(positions: DataFrame) -> DataFrame:
    return positions.select("symbol", "idx", "bar_ts", "position", "equity")
