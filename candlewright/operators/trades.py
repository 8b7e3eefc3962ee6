"""Non-overlapping trades with compounding capital, and the equity they make."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from candlewright.operators.chain import follow_chain
from candlewright.operators.exits import initial_stop
from candlewright.operators.index import with_chunk
from candlewright.operators.scan import running
from candlewright.params import ChunkParams, TradeParams
from candlewright.schema import EQUITY_COLUMNS, TRADE_COLUMNS
from candlewright.session import materialize


def side_sign(column: str = "type") -> Column:
    return F.when(F.col(column) == "long", 1).otherwise(-1)


def position_size(
    capital: Column, price: Column, leverage: float = 1.0, decimals: int | None = None
) -> Column:
    size = F.try_divide(capital * leverage, price)
    return size if decimals is None else F.coalesce(F.bround(size, decimals), F.lit(0.0))


def unrealized_pnl(size: Column, entry: Column, price: Column, sign: Column) -> Column:
    return sign * (size * price - size * entry)


def return_pct(pnl: Column, capital: Column) -> Column:
    return F.try_divide(pnl, capital) * 100


def nonoverlapping_trades(exits: DataFrame, chunks: ChunkParams = ChunkParams()) -> DataFrame:
    """Of all entries with their exits, those reached while no position is open."""
    return follow_chain(exits, "symbol", "entry_idx", "next_idx", chunks)


def _compound(taken: DataFrame, params: TradeParams, chunks: ChunkParams) -> DataFrame:
    """Trade number and entry capital: each trade stakes all that earlier ones left."""
    gain = F.try_divide(F.col("exit_price"), F.col("entry_price")) - 1
    counted = running(
        with_chunk(taken, chunks.trade_block, "entry_idx", "_block"),
        ["symbol"],
        "_block",
        ["entry_idx"],
        {
            "_earlier": ("sum", F.lit(1).cast("bigint")),
            "_growth": ("product", 1 + params.leverage * side_sign() * gain),
        },
        inclusive=False,
        fan=chunks.fan,
    )
    return counted.select(
        *taken.columns,
        (F.coalesce("_earlier", F.lit(0)) + 1).alias("trade_no"),
        (params.initial_capital * F.coalesce("_growth", F.lit(1.0))).alias("entry_capital"),
    )


def _rounded_capital(numbered: DataFrame, params: TradeParams) -> DataFrame:
    """Entry capital and position size (``_size``) when sizes are rounded.

    Rounding makes every trade depend on the exact capital left by the one before, so trades
    of a symbol pass in order through one task. Only the running capital is held; rows stream.
    """
    columns = numbered.columns
    schema = StructType(numbered.schema.fields).add("_size", "double")

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        symbol, capital = None, params.initial_capital
        for batch in batches:
            before, sizes = [], []
            for name, kind, entry, leave in zip(
                batch["symbol"], batch["type"], batch["entry_price"], batch["exit_price"]
            ):
                if name != symbol:
                    symbol, capital = name, params.initial_capital
                before.append(capital)
                usable = entry and entry == entry
                size = round(capital * params.leverage / entry, params.size_decimals) if usable else 0.0
                sizes.append(size)
                # Without a usable price the trade changes nothing, as in the exact form.
                if usable and leave == leave:
                    change = size * leave - size * entry
                    capital += change if kind == "long" else -change
            yield batch.assign(entry_capital=before, _size=sizes)[[*columns, "_size"]]

    ordered = numbered.repartition("symbol").sortWithinPartitions("symbol", "trade_no")
    return ordered.mapInPandas(carry, schema)


def compounding_trades(
    taken: DataFrame, params: TradeParams = TradeParams(), chunks: ChunkParams = ChunkParams()
) -> DataFrame:
    """The trade table of non-overlapping entries."""
    numbered = _compound(taken, params, chunks)
    if params.size_decimals is None:
        size = position_size(F.col("entry_capital"), F.col("entry_price"), params.leverage)
    else:
        # The size that the capital was carried with, not rounded a second time by another rule.
        numbered, size = _rounded_capital(numbered, params), F.col("_size")
    first = initial_stop(F.col("entry_price"), side_sign(), params.stop_pct)
    reason = (
        F.when(F.col("exit_kind") == "stop", params.stop_reason)
        .when(F.col("exit_kind") == "opposite", "opposite_signal")
        .otherwise("end_of_data")
    )
    return (
        numbered.withColumn("position_size", size)
        .withColumn(
            "pnl",
            unrealized_pnl(
                F.col("position_size"), F.col("entry_price"), F.col("exit_price"), side_sign()
            ),
        )
        .withColumn("exit_capital", F.col("entry_capital") + F.col("pnl"))
        .withColumn("return_pct", return_pct(F.col("pnl"), F.col("entry_capital")))
        .withColumn("stop_loss", F.col("last_stop") if params.stop_column == "final" else first)
        .withColumn("exit_reason", reason)
        .select(*TRADE_COLUMNS)
    )


def trade_prices(indexed: DataFrame, spans: DataFrame) -> DataFrame:
    """Attach entry and exit price and time to (symbol, entry_idx, exit_idx) rows."""
    entry = indexed.select(
        "symbol",
        F.col("idx").alias("entry_idx"),
        F.col("close").alias("entry_price"),
        F.col("bar_ts").alias("entry_time"),
    )
    leave = indexed.select(
        "symbol",
        F.col("idx").alias("exit_idx"),
        F.col("close").alias("exit_price"),
        F.col("bar_ts").alias("exit_time"),
    )
    return spans.join(entry, ["symbol", "entry_idx"]).join(leave, ["symbol", "exit_idx"])


_EVENT = (
    "struct<seq:bigint,position:int,capital:double,size:double,entry_price:double,entry_idx:bigint>"
)


def _position_per_bar(indexed: DataFrame, trade_table: DataFrame, chunks: ChunkParams) -> DataFrame:
    """Each bar with the newest trade event up to it, as struct ``now`` (null before any).

    A bar that closes one trade and opens the next ends with the open one. A trade cut off by
    the end of data stays open on its last bar.
    """
    opened = trade_table.select(
        "symbol",
        F.col("entry_idx").alias("idx"),
        F.struct(
            (F.col("trade_no") * 2).alias("seq"),
            side_sign().alias("position"),
            F.col("entry_capital").alias("capital"),
            F.col("position_size").alias("size"),
            F.col("entry_price").alias("entry_price"),
            F.col("entry_idx").alias("entry_idx"),
        ).alias("event"),
    )
    closed = trade_table.where("exit_reason <> 'end_of_data'").select(
        "symbol",
        F.col("exit_idx").alias("idx"),
        F.struct(
            (F.col("trade_no") * 2 + 1).alias("seq"),
            F.lit(0).alias("position"),
            F.col("exit_capital").alias("capital"),
            F.lit(0.0).alias("size"),
            F.col("entry_price").alias("entry_price"),
            F.col("entry_idx").alias("entry_idx"),
        ).alias("event"),
    )
    events = opened.union(closed).groupBy("symbol", "idx").agg(F.max("event").alias("event"))
    placed = indexed if "chunk" in indexed.columns else with_chunk(indexed, chunks.size)
    bars = placed.select("symbol", "idx", "bar_ts", "close", "chunk")
    events = with_chunk(events, chunks.size)
    # A chunk starts with the newest event of the chunks before it; these are one row per chunk.
    newest = events.groupBy("symbol", "chunk").agg(F.max_by("event", "idx").alias("event"))
    every = bars.select("symbol", "chunk").distinct().join(newest, ["symbol", "chunk"], "left")
    carried = running(
        materialize(with_chunk(every, chunks.fan, "chunk", "_group"), "chunk-events"),
        ["symbol"],
        "_group",
        ["chunk"],
        {"carry": ("last", F.col("event"))},
        inclusive=False,
        fan=chunks.fan,
    )
    carries = carried.where("carry is not null").select(
        "symbol", (F.col("chunk") * chunks.size - 1).alias("idx"), F.col("carry").alias("event"), "chunk"
    )
    # Grouped by chunk on both sides, so bars that lie in buckets of chunks are not moved.
    marks = events.unionByName(carries).select("symbol", "idx", F.col("event").cast(_EVENT), "chunk")
    marks = marks.toDF("symbol", "at", "event", "chunk")
    keys = ["symbol", "chunk"]
    return bars.groupBy(*keys).cogroup(marks.groupBy(*keys)).applyInArrow(
        _newest_event, f"symbol string, idx bigint, bar_ts timestamp_ntz, close double, now {_EVENT}"
    )


def _newest_event(bars: pa.Table, marks: pa.Table) -> pa.Table:
    """Bars of a chunk, each with the last event up to it."""
    marks = marks.sort_by("at")
    found = np.searchsorted(marks["at"].to_numpy(), bars["idx"].to_numpy(), "right") - 1
    now = marks["event"].combine_chunks().take(pa.array(np.maximum(found, 0), mask=found < 0))
    return bars.select(["symbol", "idx", "bar_ts", "close"]).append_column("now", now)


def equity_curve(
    indexed: DataFrame,
    trade_table: DataFrame,
    params: TradeParams = TradeParams(),
    chunks: ChunkParams = ChunkParams(),
) -> DataFrame:
    """Position and equity after every bar."""
    held = _position_per_bar(indexed, trade_table, chunks)
    position = F.coalesce(F.col("now.position"), F.lit(0))
    floating = unrealized_pnl(
        F.col("now.size"), F.col("now.entry_price"), F.col("close"), F.col("now.position")
    )
    equity = (
        F.when(F.col("now").isNull(), F.lit(float(params.initial_capital)))
        .when(position == 0, F.col("now.capital"))
        .otherwise(F.col("now.capital") + floating)
    )
    return held.select(
        "symbol", "idx", "bar_ts", position.alias("position"), equity.alias("equity")
    ).select(*EQUITY_COLUMNS)


def trailing_stop(
    indexed: DataFrame,
    trade_table: DataFrame,
    params: TradeParams = TradeParams(),
    chunks: ChunkParams = ChunkParams(),
) -> DataFrame:
    """The ratcheting stop of the open trade, for each bar after its entry up to its exit."""
    held = _position_per_bar(indexed, trade_table, chunks)
    # The exit bar carries the close event; it still belongs to the trade it closes. A bar that
    # also opens the next trade is found by its event order and handled through the trade table.
    spans = trade_table.select("symbol", "type", "trade_no", "entry_idx", "exit_idx", "entry_price")
    inside = (
        held.where("now.position <> 0 and idx > now.entry_idx")
        .select("symbol", "idx", "close", F.col("now.entry_idx").alias("entry_idx"))
        .join(spans, ["symbol", "entry_idx"])
        .where("idx < exit_idx")
    )
    last = spans.where("exit_idx > entry_idx").join(
        indexed.select("symbol", F.col("idx").alias("exit_idx"), "close"), ["symbol", "exit_idx"]
    )
    columns = ["symbol", "trade_no", "type", "entry_price", "entry_idx", "idx", "close"]
    every = inside.select(*columns).union(
        last.withColumn("idx", F.col("exit_idx")).select(*columns)
    )
    long = F.col("type") == "long"
    ratcheted = running(
        with_chunk(every, chunks.size),
        ["symbol", "trade_no"],
        "chunk",
        ["idx"],
        {"_top": ("max", F.col("close")), "_low": ("min", F.col("close"))},
        fan=chunks.fan,
    )
    first = initial_stop(F.col("entry_price"), side_sign(), params.stop_pct)
    stop = F.when(
        long, F.greatest(first, F.col("_top") * (1 - params.trail_pct))
    ).otherwise(F.least(first, F.col("_low") * (1 + params.trail_pct)))
    return ratcheted.select(
        "symbol", "trade_no", "type", "idx", "close", stop.alias("trailing_stop")
    )


def running_drawdown(
    df: DataFrame,
    key: list[str],
    order: str,
    value: str,
    block: int,
    fan: int = 1024,
) -> DataFrame:
    """Add ``peak`` (highest value so far) and ``drawdown_pct`` (how far below it)."""
    with_peak = running(
        with_chunk(df, block, order, "_block"),
        key,
        "_block",
        [order],
        {"peak": ("max", F.col(value))},
        fan=fan,
    ).drop("_block")
    fall = F.try_divide(F.col(value) - F.col("peak"), F.col("peak")) * 100
    return with_peak.withColumn("drawdown_pct", fall)
