"""The whole study of a candle table: indicators, zones, trades, equity, report.

Tables that later steps use more than once are written to the shared folder once.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame

from candlewright.operators import exits as exit_ops
from candlewright.operators import indicators as indicator_ops
from candlewright.operators import stats
from candlewright.operators import trades as trade_ops
from candlewright.operators import zones as zone_ops
from candlewright.params import ChunkParams, TradeParams, ZoneParams
from candlewright.session import materialize, materialize_by


class Study:
    """One candle table under one setting. Nothing runs before a result is asked for.

    Steps refer to their input several times, so the input is written first. A chunk is as long as
    the longest lookback at least. Candles without a symbol or a time have no place in a history; ``candle_rejects`` lists them.
    """

    def __init__(
        self,
        candles: DataFrame,
        zone_params: ZoneParams = ZoneParams(),
        trade_params: TradeParams = TradeParams(),
        chunks: ChunkParams = ChunkParams(),
    ):
        self.candles = candles
        self.zone_params = zone_params
        self.trade_params = trade_params
        self.chunks = replace(chunks, size=indicator_ops.chunk_size(zone_params, chunks))

    @cached_property
    def placed(self) -> DataFrame:
        """Candles with their position, cut into chunks with the rim of their neighbours.

        Written once, in buckets by symbol and chunk: windows, the exit scan and the equity read the
        bars where they lie. A table that already has ``idx`` is not indexed again.
        """
        whole = self.candles.where("symbol is not null and bar_ts is not null")
        cut = indicator_ops.in_chunks(whole, self.zone_params, self.chunks)
        return materialize_by(cut, "bars", ["symbol", "chunk"], ["idx"])

    @cached_property
    def in_place(self) -> DataFrame:
        """The bars by chunk, each once."""
        return self.placed.where("own").drop("own")

    @cached_property
    def bars(self) -> DataFrame:
        """Candles with their position."""
        return self.in_place.drop("chunk")

    @cached_property
    def indicators(self) -> DataFrame:
        return indicator_ops.indicators(self.placed, self.zone_params, self.chunks)

    @cached_property
    def candidates(self) -> DataFrame:
        found = zone_ops.zone_candidates(self.placed, self.zone_params, self.chunks)
        return materialize(found, "candidates")

    @cached_property
    def zones(self) -> DataFrame:
        """Order-block zones."""
        thinned = zone_ops.min_distance_thin(
            self.candidates, self.zone_params.min_distance, self.chunks
        )
        return materialize(thinned.select(*zone_ops.ZONE_COLUMNS), "zones")

    @cached_property
    def exits(self) -> DataFrame:
        """Every possible entry with its exit."""
        signals = zone_ops.signal_bars(self.zones, self.trade_params.entry_at)
        found = exit_ops.first_exit(self.in_place, signals, self.trade_params, self.chunks)
        return materialize(found, "exits")

    @cached_property
    def taken(self) -> DataFrame:
        return materialize(trade_ops.nonoverlapping_trades(self.exits, self.chunks), "taken")

    @cached_property
    def trades(self) -> DataFrame:
        return trade_ops.compounding_trades(self.taken, self.trade_params, self.chunks)

    @cached_property
    def written_trades(self) -> DataFrame:
        """The trades as a table, for the results that use them more than once."""
        return materialize(self.trades, "trades")

    @cached_property
    def equity(self) -> DataFrame:
        table = self.written_trades
        return trade_ops.equity_curve(self.in_place, table, self.trade_params, self.chunks)

    @cached_property
    def stops(self) -> DataFrame:
        table = self.written_trades
        return trade_ops.trailing_stop(self.bars, table, self.trade_params, self.chunks)

    @cached_property
    def report(self) -> DataFrame:
        return stats.trade_report(self.written_trades, self.trade_params, self.chunks)
