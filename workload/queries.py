"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from candlewright.functions import text
from candlewright.functions.ticks import round_to_tick
from candlewright.operators import accounts, orders as order_ops, stats
from candlewright.operators import trades as trade_ops
from candlewright.operators import zones as zone_ops
from candlewright.operators.index import bar_index
from candlewright.params import ROUNDED_STUDY, STUDY, TRADING, ChunkParams, TradeParams
from candlewright.plans.study import Study
from candlewright.schema import CANDLE_COLUMNS, RESOLUTIONS
from candlewright.session import materialize, scratch_path
from candlewright.sources import backfill, candles as candle_sources
from candlewright.sources import sinks
from candlewright.sources.ticks import resample_candles, walk_candles
from candlewright.streaming import candles as streams
from candlewright.streaming import positions, signals

TRIGGER_STUDY = TradeParams(entry_at="trigger")
# Chunks so small that short histories span many of them, and many groups of them.
SMALL = ChunkParams(size=64, fan=3, trade_block=16)

_kept: dict[tuple, object] = {}


def _once(spark: SparkSession, key: tuple, build: Callable[[], object]) -> object:
    """Tables many queries start from are written once per session."""
    full = (spark.sparkContext.applicationId, *key)
    if full not in _kept:
        _kept[full] = build()
    return _kept[full]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def candles(spark: SparkSession, sf_dir: str, resolution: str = "1h") -> DataFrame:
    def build() -> DataFrame:
        return materialize(walk_candles(table(spark, sf_dir, "events"), resolution), "candles")

    return _once(spark, ("candles", sf_dir, resolution), build)


def study(
    spark: SparkSession,
    sf_dir: str,
    trade_params: TradeParams = STUDY,
    resolution: str = "1h",
    chunks: ChunkParams = ChunkParams(),
) -> Study:
    def build() -> Study:
        table = candles(spark, sf_dir, resolution)
        made = Study(table, TRADING, trade_params, chunks)
        if trade_params != STUDY:
            # The same bars and zones serve every way of trading them.
            base = study(spark, sf_dir, STUDY, resolution, chunks)
            made.placed, made.zones = base.placed, base.zones
        return made

    return _once(spark, ("study", sf_dir, resolution, trade_params, chunks), build)


def rounded(df: DataFrame, **decimals: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in decimals.items()})


def _columns(df: DataFrame, *names: str, decimals: int = 8) -> DataFrame:
    """Key columns and the named values, doubles rounded."""
    double = dict(df.dtypes)
    return df.select(
        "symbol",
        "idx",
        *[F.round(n, decimals).alias(n) if double[n] == "double" else F.col(n) for n in names],
    )


# --- sources ---------------------------------------------------------------------------


def candles_from_ticks(spark, sf_dir):
    return walk_candles(table(spark, sf_dir, "events"), "1h")


def candles_from_ticks_15m(spark, sf_dir):
    return walk_candles(table(spark, sf_dir, "events"), "15m")


def candle_scan(spark, sf_dir):
    return candle_sources.candle_scan(
        candles(spark, sf_dir), "view", "2024-01-10 00:00:00", "2024-01-20 00:00:00", 3600
    )


def _envelopes(spark, sf_dir) -> DataFrame:
    """Candles as daily responses; those of one symbol report a failure instead."""
    bar = F.struct(
        F.unix_seconds(F.col("bar_ts").cast("timestamp")).alias("time"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close")],
        F.when(F.hour("bar_ts") == 5, "n/a").otherwise(F.col("volume").cast("string")).alias("volume"),
    )
    daily = candles(spark, sf_dir).groupBy("symbol", F.to_date("bar_ts").alias("day"))
    good = F.col("symbol") != "error"
    return daily.agg(F.collect_list(bar).alias("bars")).select(
        "symbol",
        F.to_json(
            F.struct(
                good.alias("success"),
                F.when(~good, "unavailable").alias("error"),
                F.when(good, F.col("bars")).alias("result"),
            )
        ).alias("body"),
    )


def candle_envelope(spark, sf_dir):
    return candle_sources.candle_envelope(_envelopes(spark, sf_dir))


def candle_envelope_errors(spark, sf_dir):
    failed = candle_sources.envelope_errors(_envelopes(spark, sf_dir))
    return failed.groupBy("symbol", "error").agg(F.count(F.lit(1)).alias("n"))


def candle_normalize(spark, sf_dir):
    raw = candles(spark, sf_dir).select(
        "symbol",
        F.unix_seconds(F.col("bar_ts").cast("timestamp")).alias("time"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low")],
        F.when(F.col("close") < F.col("open"), "bad").otherwise(F.col("close").cast("string")).alias("close"),
        F.when(F.hour("bar_ts") == 7, "NaN").otherwise(F.col("volume").cast("string")).alias("volume"),
    )
    return candle_sources.candle_normalize(raw)


def _time_envelopes(spark, sf_dir) -> DataFrame:
    """Daily responses whose times come in every form a source has been seen to send."""
    secs = F.unix_seconds(F.col("bar_ts").cast("timestamp")).cast("string")
    hour = F.hour("bar_ts")
    time = (
        F.when(hour == 3, F.concat(secs, F.lit(".5")))
        .when(hour == 6, F.concat(secs, F.lit(".0")))
        .when(hour == 9, F.concat(F.lit('"'), F.date_format("bar_ts", "yyyy-MM-dd HH:mm"), F.lit('"')))
        .when(hour == 12, F.concat(F.lit('"'), secs, F.lit('"')))
        .when(hour == 15, "null")
        .when(hour == 21, F.concat(secs, F.lit("000")))
        .otherwise(secs)
    )
    fields = [F.concat(F.lit(f',"{c}":'), F.col(c).cast("string")) for c in CANDLE_COLUMNS[2:]]
    bar = F.concat(F.lit('{"time":'), time, *fields, F.lit("}"))
    daily = candles(spark, sf_dir).groupBy("symbol", F.to_date("bar_ts").alias("day"))
    return daily.agg(F.array_join(F.collect_list(bar), ",").alias("bars")).select(
        "symbol", F.concat(F.lit('{"success":true,"result":['), "bars", F.lit("]}")).alias("body")
    )


def candle_times(spark, sf_dir):
    """Candles of the same responses: every whole number is a time, however it is written."""
    return candle_sources.candle_envelope(_time_envelopes(spark, sf_dir)).where("bar_ts is not null")


def candle_time_rejects(spark, sf_dir):
    raw = candle_sources.envelope_rows(_time_envelopes(spark, sf_dir))
    return candle_sources.time_rejects(raw)


BACKFILL_BARS = 100


def _ranges(spark, sf_dir) -> DataFrame:
    """Whole days from each symbol's first candle to its last."""
    first, last = F.date_trunc("day", F.min("bar_ts")), F.date_trunc("day", F.max("bar_ts"))
    return candles(spark, sf_dir).groupBy("symbol").agg(
        first.cast("timestamp_ntz").alias("start_ts"),
        (last + F.expr("interval 1 day")).cast("timestamp_ntz").alias("end_ts"),
    )


def backfill_union(spark, sf_dir):
    """Slices as files, read in one scan. A slice has half the volume of the bar it ends in."""
    ranges = _ranges(spark, sf_dir)
    cut = backfill.cut_slices(candles(spark, sf_dir), ranges, 3600, BACKFILL_BARS)
    plan = backfill.slice_plan(ranges, 3600, BACKFILL_BARS)
    ends = plan.select("symbol", "slice", F.col("end_ts").alias("bar_ts"), F.lit(0.5).alias("_part"))
    part = F.coalesce("_part", F.lit(1.0))
    seen = cut.join(ends, ["symbol", "slice", "bar_ts"], "left").withColumn("volume", F.col("volume") * part)
    path = scratch_path(spark, "slices")
    seen.drop("_part").write.partitionBy("slice").parquet(path)
    return backfill.merge_slices(backfill.read_slices(spark, path))


def backfill_plan(spark, sf_dir):
    return backfill.slice_plan(_ranges(spark, sf_dir), 3600, BACKFILL_BARS)


def backfill_coverage(spark, sf_dir):
    return backfill.coverage(candles(spark, sf_dir), 3600)


def backfill_gaps(spark, sf_dir):
    return backfill.gaps(candles(spark, sf_dir), _ranges(spark, sf_dir), 3600)


def latest_window(spark, sf_dir):
    return candle_sources.latest_window(candles(spark, sf_dir), 50, 3600)


def latest_window_in_folders(spark, sf_dir):
    """The same window out of a table in folders, of which only the newest are read."""
    path = scratch_path(spark, "candle_table")
    sinks.write_candles(candles(spark, sf_dir), path, "1h")
    folders = candle_sources.candle_folders(spark, path, resolution="1h")
    return candle_sources.latest_window_in_folders(folders, 50, 3600)


def intake_counts(spark, sf_dir):
    """Counts that come with the pass over the rows of the daily responses."""
    raw = candle_sources.envelope_rows(_time_envelopes(spark, sf_dir))
    raw = raw.withColumn("symbol", F.when(F.col("symbol") != "error", F.col("symbol")))
    raw = raw.withColumn("volume", F.when(F.col("volume").cast("double") > 50, F.lit("n/a")).otherwise(F.col("volume")))
    counts = Observation("intake")
    materialize(candle_sources.observed_intake(raw, counts), "intake")
    return spark.createDataFrame([counts.get], INTAKE)


INTAKE = "rows_in bigint, kept bigint, no_symbol bigint, bad_time bigint, bad_numbers bigint"


def latest_bars(spark, sf_dir):
    return candle_sources.latest_bars(candles(spark, sf_dir), 50)


def lookback_days(spark, sf_dir):
    return candle_sources.lookback_days(candles(spark, sf_dir), 7, "2024-01-20 12:00:00")


def candle_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    # Midnight rows lose their time, to be rejected on the way back.
    at = F.when(F.hour("bar_ts") != 0, F.date_format("bar_ts", "yyyy-MM-dd HH:mm:ss"))
    out = candles(spark, sf_dir).select("symbol", at.alias("timestamp"), *CANDLE_COLUMNS[2:])
    out.write.partitionBy("symbol").csv(path, header=True)
    read = candle_sources.read_candle_csv(spark, path)
    return read.where("bar_ts is not null")


def candle_csv_rejects(spark, sf_dir):
    path = scratch_path(spark, "csv")
    at = F.when(F.hour("bar_ts") != 0, F.date_format("bar_ts", "yyyy-MM-dd HH:mm:ss"))
    out = candles(spark, sf_dir).select("symbol", at.alias("timestamp"), *CANDLE_COLUMNS[2:])
    out.write.partitionBy("symbol").csv(path, header=True)
    read = candle_sources.read_candle_csv(spark, path)
    return candle_sources.candle_rejects(read).drop("bar_ts")


def resample(resolution: str):
    def query(spark, sf_dir):
        return rounded(resample_candles(candles(spark, sf_dir, "15m"), resolution), volume=4)

    return query


def history_page(spark, sf_dir):
    page = candle_sources.history_page(
        table(spark, sf_dir, "orders"), "o_orderkey", 100, 100, o_orderstatus="F"
    )
    return page.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def fills_page(spark, sf_dir):
    page = candle_sources.history_page(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        250,
        100,
        o_orderpriority=["1-URGENT", "2-HIGH"],
    )
    return page.select("o_orderkey", "o_orderpriority", "o_totalprice")


def trade_sink(spark, sf_dir):
    path = scratch_path(spark, "trade_sink")
    sinks.write_by_symbol(study(spark, sf_dir).trades, path, "entry_time")
    return _trade_columns(spark.read.parquet(path))


def equity_sink(spark, sf_dir):
    path = scratch_path(spark, "equity_sink")
    sinks.write_by_symbol(study(spark, sf_dir).equity, path, "bar_ts")
    return _equity_columns(spark.read.parquet(path))


def candle_table(spark, sf_dir):
    """Two resolutions in one table, and a range of one of them read back."""
    path = scratch_path(spark, "candle_table")
    sinks.write_candles(candles(spark, sf_dir), path, "1h")
    sinks.write_candles(resample_candles(candles(spark, sf_dir, "15m"), "4h"), path, "4h")
    return candle_sources.read_candles(
        spark, path, resolution="1h", start="2024-01-10 03:00:00", end="2024-01-12 06:00:00"
    )


def history_cursor(spark, sf_dir):
    return candle_sources.page_cursor(history_page(spark, sf_dir), "o_orderkey", 100)


def head_tail(spark, sf_dir):
    return candle_sources.head_tail(candles(spark, sf_dir))


# --- indicators ------------------------------------------------------------------------


def bar_index_query(spark, sf_dir):
    return bar_index(candles(spark, sf_dir)).select("symbol", "bar_ts", "idx")


def indicator(*names: str):
    def query(spark, sf_dir):
        return _columns(study(spark, sf_dir).indicators, *names)

    return query


def indicators(spark, sf_dir):
    names = [
        "pc", "volume_ma", "volume_percentile", "sma_trend", "sma50", "tr", "atr", "roc",
        "swing_high", "swing_low", "avg_atr",
    ]
    return _columns(study(spark, sf_dir).indicators, *names)


def candle_color(spark, sf_dir):
    return study(spark, sf_dir).bars.select(
        "symbol", "idx", zone_ops.candle_color().alias("color")
    )


# --- zones -----------------------------------------------------------------------------


def _crossings(spark, sf_dir) -> DataFrame:
    def build() -> DataFrame:
        s = study(spark, sf_dir)
        return materialize(zone_ops.crossings(s.bars, TRADING, s.chunks), "crossings")

    return _once(spark, ("crossings", sf_dir), build)


def momentum_cross(spark, sf_dir):
    return _columns(_crossings(spark, sf_dir), "side", "pc", "prev_pc")


def gate(column: str):
    def query(spark, sf_dir):
        return _crossings(spark, sf_dir).select("symbol", "idx", "side", column)

    return query


def zone_origin(spark, sf_dir):
    return _crossings(spark, sf_dir).select(
        "symbol",
        "idx",
        "side",
        F.col("origin.idx").alias("start_idx"),
        F.col("origin.high").alias("top"),
        F.col("origin.low").alias("bot"),
    )


def zone_candidates(spark, sf_dir):
    return study(spark, sf_dir).candidates


def min_distance_thin(spark, sf_dir):
    s = study(spark, sf_dir)
    return zone_ops.min_distance_thin(s.candidates, TRADING.min_distance, s.chunks).select(
        "symbol", "side", "trigger_idx"
    )


def order_blocks(spark, sf_dir, chunks=ChunkParams()):
    s = study(spark, sf_dir, chunks=chunks)
    return zone_ops.order_blocks(s.bars, TRADING, s.chunks)


def all_zones(spark, sf_dir):
    return study(spark, sf_dir).zones.groupBy("symbol", "side").agg(
        F.count(F.lit(1)).alias("n"), F.min("bot").alias("min_bot"), F.max("top").alias("max_top")
    )


def last_zone_index(spark, sf_dir):
    return zone_ops.last_zone_index(study(spark, sf_dir).zones)


def bars_at_zone_start(spark, sf_dir):
    s = study(spark, sf_dir)
    return zone_ops.bars_at_zone_start(s.bars, s.zones).select(
        "symbol", "idx", "bar_ts", "close", "side", "n_copies"
    )


def zone_active_bars(spark, sf_dir):
    s = study(spark, sf_dir)
    return zone_ops.zone_active_bars(s.bars, s.zones, s.chunks)


def signals_on_last_bar(spark, sf_dir):
    """The newest bar here is each symbol's last trigger, where a live run would act."""
    s = study(spark, sf_dir)
    last = s.zones.groupBy("symbol").agg(F.max("trigger_idx").alias("last"))
    upto = s.bars.join(last, "symbol").where("idx <= last").drop("last")
    return zone_ops.signals_on_last_bar(upto, s.zones, "trigger")


def signals_at_polls(spark, sf_dir):
    """What a run that looks every six hours acts on, over all bars."""
    s = study(spark, sf_dir)
    return zone_ops.signals_at_polls(s.bars, s.zones, "trigger", 6 * 3600)


def zone_overlay(spark, sf_dir):
    s = study(spark, sf_dir)
    return rounded(zone_ops.zone_overlay(s.bars, s.zones), bot_frac=8, top_frac=8)


# --- trades ----------------------------------------------------------------------------


def _trade_columns(trades: DataFrame) -> DataFrame:
    shown = rounded(
        trades,
        entry_price=6, exit_price=6, entry_capital=6, position_size=6, stop_loss=8, pnl=6,
        exit_capital=6, return_pct=6,
    )
    return shown.select(
        "symbol", "trade_no", "type", "entry_idx", "exit_idx", "entry_price", "entry_time",
        "entry_capital", "position_size", "stop_loss", "exit_price", "exit_time", "pnl",
        "exit_capital", "exit_reason", "return_pct",
    )


def _equity_columns(equity: DataFrame) -> DataFrame:
    return rounded(equity, equity=6).select("symbol", "idx", "bar_ts", "position", "equity")


def trades(params: TradeParams = STUDY, chunks: ChunkParams = ChunkParams()):
    def query(spark, sf_dir):
        return _trade_columns(study(spark, sf_dir, params, chunks=chunks).trades)

    return query


def equity(params: TradeParams = STUDY, chunks: ChunkParams = ChunkParams()):
    def query(spark, sf_dir):
        return _equity_columns(study(spark, sf_dir, params, chunks=chunks).equity)

    return query


def first_exit(spark, sf_dir, chunks=ChunkParams()):
    return rounded(study(spark, sf_dir, chunks=chunks).exits, last_stop=8).select(
        "symbol", "entry_idx", "type", "n_copies", "exit_idx", "exit_kind", "last_stop"
    )


def nonoverlapping_trades(spark, sf_dir):
    s = study(spark, sf_dir)
    return trade_ops.nonoverlapping_trades(s.exits, s.chunks).select(
        "symbol", "entry_idx", "type", "exit_idx", "exit_kind"
    )


def trade_prices(spark, sf_dir):
    s = study(spark, sf_dir)
    return trade_ops.trade_prices(s.bars, s.taken.select("symbol", "entry_idx", "exit_idx"))


def initial_stop(spark, sf_dir):
    from candlewright.operators.exits import initial_stop as stop

    t = study(spark, sf_dir).trades
    value = stop(F.col("entry_price"), trade_ops.side_sign(), STUDY.stop_pct)
    return t.select("symbol", "trade_no", F.round(value, 8).alias("initial_stop"))


def trailing_stop(spark, sf_dir, chunks=ChunkParams()):
    return rounded(study(spark, sf_dir, chunks=chunks).stops, trailing_stop=8).select(
        "symbol", "trade_no", "idx", "close", "trailing_stop"
    )


def trade_part(*names: str):
    def query(spark, sf_dir):
        return _trade_columns(study(spark, sf_dir).trades).select("symbol", "trade_no", *names)

    return query


def position_size(spark, sf_dir):
    t = study(spark, sf_dir).trades
    exact = trade_ops.position_size(F.col("entry_capital"), F.col("entry_price"), 3.0)
    short = trade_ops.position_size(F.col("entry_capital"), F.col("entry_price"), 3.0, 4)
    return t.select(
        "symbol", "trade_no", F.round(exact, 6).alias("size"), F.round(short, 4).alias("size_4")
    )


def unrealized_pnl(spark, sf_dir):
    """Gain of every trade, open or not, at its symbol's highest close."""
    s = study(spark, sf_dir)
    peak = s.bars.groupBy("symbol").agg(F.max("close").alias("close"))
    value = trade_ops.unrealized_pnl(
        F.col("position_size"), F.col("entry_price"), F.col("close"), trade_ops.side_sign()
    )
    return s.trades.join(peak, "symbol").select(
        "symbol", "trade_no", F.round(value, 6).alias("unrealized_pnl")
    )


def completed_trades(spark, sf_dir):
    return stats.completed_trades(study(spark, sf_dir).trades).select("symbol", "trade_no", "exit_reason")


def winners(spark, sf_dir):
    return stats.winners(_trade_columns(study(spark, sf_dir).trades)).select("symbol", "trade_no", "pnl")


def losers(spark, sf_dir):
    return stats.losers(_trade_columns(study(spark, sf_dir).trades)).select("symbol", "trade_no", "pnl")


def trade_markers(spark, sf_dir):
    return stats.trade_markers(study(spark, sf_dir).trades)


# --- statistics ------------------------------------------------------------------------

_STATS = [
    "win_rate", "avg_win", "avg_loss", "avg_return_pct", "max_pnl", "min_pnl",
    "avg_entry_capital", "final_capital", "profit_factor", "total_return_pct",
]


def trade_stats(spark, sf_dir):
    s = stats.trade_stats(study(spark, sf_dir).trades, STUDY)
    return rounded(s, **{c: 5 for c in _STATS}).drop("initial_capital")


def trade_stats_overall(spark, sf_dir):
    s = stats.trade_stats(study(spark, sf_dir).trades, STUDY, by=())
    names = [c for c in _STATS if c not in ("final_capital", "total_return_pct")]
    return rounded(s, **{c: 5 for c in names})


def trade_report(spark, sf_dir):
    s = study(spark, sf_dir).report
    return rounded(s, max_drawdown_pct=5, **{c: 5 for c in _STATS}).drop("initial_capital")


def running_drawdown(spark, sf_dir):
    d = rounded(stats.trade_drawdown(study(spark, sf_dir).trades), peak=5, drawdown_pct=5)
    return d.select("symbol", "trade_no", "peak", "drawdown_pct")


def max_drawdown(spark, sf_dir, chunks=ChunkParams()):
    s = study(spark, sf_dir, chunks=chunks)
    d = stats.max_drawdown(stats.equity_drawdown(s.equity, s.chunks))
    return rounded(d, max_drawdown_pct=5)


def pnl_histogram(spark, sf_dir):
    h = stats.pnl_histogram(_trade_columns(study(spark, sf_dir).trades))
    return rounded(h, bin_lo=10, bin_hi=10)


def trade_list(spark, sf_dir):
    return stats.trade_list(_trade_columns(study(spark, sf_dir).trades))


def price_range(spark, sf_dir):
    return stats.price_range(candles(spark, sf_dir))


def last_bar(spark, sf_dir):
    return stats.last_bar(candles(spark, sf_dir))


def candle_summary(spark, sf_dir):
    return stats.candle_summary(candles(spark, sf_dir))


def position_from_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    entry = F.col("event_type").isin("purchase", "signup", "view")
    direction = F.when(F.col("event_id") % 2 == 0, "long").otherwise("short")
    sign = F.when(direction == "long", 1).otherwise(-1)
    events = e.select(
        "user_id",
        F.col("ts").alias("event_ts"),
        "event_id",
        F.when(entry, "entry").otherwise("exit").alias("type"),
        direction.alias("direction"),
        F.col("value").alias("price"),
        (F.col("value") * (1 - sign * 0.02)).alias("stop_loss"),
        (F.col("value") * (1 - sign * 0.015)).alias("trailing_stop"),
    )
    position = stats.position_from_events(events, key="user_id")
    return rounded(position, stop_loss=6, trailing_stop=6)


# --- orders and accounts ---------------------------------------------------------------


def _line_orders(spark, sf_dir) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("size"),
        F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy").alias("side"),
        F.when(F.col("l_linestatus") == "O", "limit_order").otherwise("market_order").alias("order_type"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )


def order_intents(spark, sf_dir):
    orders = _line_orders(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "product_id",
        "size",
        "side",
        "order_type",
        F.col("price").alias("limit_price"),
        F.when(F.col("discount") < 0.02, "ioc").when(F.col("discount") > 0.08, "day").alias("time_in_force"),
        F.lit(None).cast("string").alias("post_only"),
        F.when(F.col("side") == "sell", "true").alias("reduce_only"),
    )
    return order_ops.order_intents(orders)


def order_intents_fractional(spark, sf_dir):
    """Sizes with a fraction of either sign: the fraction goes, and so do orders of less than one."""
    size = F.col("size") * F.col("discount") * F.when(F.col("side") == "sell", -1).otherwise(1)
    orders = _line_orders(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "product_id", size.alias("size"), "side", "order_type",
        F.col("price").alias("limit_price"),
        F.lit(None).cast("string").alias("time_in_force"),
        F.lit(None).cast("string").alias("post_only"),
        F.lit(None).cast("string").alias("reduce_only"),
    )
    return order_ops.order_intents(orders).select("l_orderkey", "l_linenumber", "product_id", "size", "side")


def stop_order_intents(spark, sf_dir):
    orders = _line_orders(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "product_id",
        "size",
        "side",
        "order_type",
        F.when(F.col("discount") > 0.01, F.col("price")).alias("limit_price"),
        F.when(F.col("tax") < 0.07, F.col("price")).alias("stop_price"),
        F.when(F.col("discount") < 0.09, F.col("discount") * 100).alias("trail_amount"),
        (F.col("tax") > 0.04).alias("trailing"),
    )
    return rounded(order_ops.stop_order_intents(orders), trail_amount=4)


def order_batches(spark, sf_dir):
    orders = _line_orders(spark, sf_dir)
    order = [
        "l_orderkey", "l_linenumber", "l_suppkey", "size", "side", "order_type", "price",
        "discount", "tax",
    ]
    batches = order_ops.order_batches(orders, order, ["l_orderkey", "l_linenumber", "size", "side"])
    listed = F.transform(
        "orders",
        lambda o: F.concat_ws(":", o["l_orderkey"], o["l_linenumber"], o["size"].cast("bigint"), o["side"]),
    )
    return batches.select("product_id", "batch_no", "n_orders", F.array_join(listed, ",").alias("orders"))


def order_json(spark, sf_dir):
    intents = order_intents(spark, sf_dir)
    fields = [
        "product_id", "size", "side", "order_type", "limit_price", "time_in_force", "post_only",
        "reduce_only",
    ]
    return order_ops.order_json(intents, fields).select("l_orderkey", "l_linenumber", "body")


def cancel_intents(spark, sf_dir):
    orders = _line_orders(spark, sf_dir).withColumnRenamed("l_orderkey", "id")
    return order_ops.cancel_intents(orders)


def trade_orders(spark, sf_dir):
    made = order_ops.trade_orders(study(spark, sf_dir).trades, 1)
    return rounded(made, size=6)


def balance_for_asset(spark, sf_dir):
    wallets = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("asset_id"),
        F.col("c_custkey").alias("wallet_id"),
        F.col("c_acctbal").alias("balance"),
    )
    return accounts.balance_for_asset(wallets)


def first_position(spark, sf_dir):
    positions = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("product_id"),
        F.col("o_orderkey").alias("position_id"),
        F.lit(1.0).alias("size"),
        F.col("o_totalprice").alias("entry_price"),
    )
    return accounts.first_position(positions)


def alert_text(spark, sf_dir):
    t = _trade_columns(study(spark, sf_dir, ROUNDED_STUDY).trades)
    return text.alert_text(t)


def error_alert(spark, sf_dir):
    failed = candle_sources.envelope_errors(_envelopes(spark, sf_dir))
    shown = F.concat_ws(": ", "symbol", "error")
    return failed.groupBy(text.error_alert(shown).alias("message")).agg(F.count(F.lit(1)).alias("n"))


def startup_message(spark, sf_dir):
    """A run for every part, with settings made from its columns."""
    settings = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.element_at(F.array(*map(F.lit, RESOLUTIONS)), (F.col("p_size") % len(RESOLUTIONS) + 1).cast("int")).alias("timeframe"),
        F.col("p_retailprice").alias("initial_capital"),
        ((F.col("p_size") % 5 + 1) / 2).alias("leverage"),
        ((F.col("p_size") + 1) / 1000).alias("sensitivity"),
        F.lit(TRADING.min_volume_percentile).alias("min_volume_percentile"),
        F.when(F.col("p_size") != 7, F.lit(TRADING.min_distance)).alias("min_distance"),
        F.lit(STUDY.stop_pct).alias("stop_pct"),
        F.lit(STUDY.trail_pct).alias("trail_pct"),
    )
    return text.startup_message(settings).select("product_id", "message")


def round_to_tick_query(spark, sf_dir):
    price = F.col("p_retailprice")
    made = {}
    for name, tick in (("t005", "0.05"), ("t05", "0.5"), ("t1", "1")):
        made[f"{name}_nearest"] = round_to_tick(price, tick).cast("double")
        made[f"{name}_floor"] = round_to_tick(price, tick, "floor").cast("double")
        made[f"{name}_ceil"] = round_to_tick(price, tick, "ceil").cast("double")
        made[f"{name}_ceil_up"] = round_to_tick(price, tick, "ceil", compat=True).cast("double")
        made[f"{name}_below_zero"] = round_to_tick(-price, tick).cast("double")
    return table(spark, sf_dir, "part").select(
        "p_partkey", *[c.alias(n) for n, c in made.items()]
    )


# --- streams ---------------------------------------------------------------------------


@contextmanager
def _settings(spark: SparkSession, **values: str):
    """Session settings for one stream, put back afterwards."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _state_partitions(spark: SparkSession) -> str:
    """A stream keeps its number of state stores for life: a few per core, not more."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return str(min(wanted, 2 * spark.sparkContext.defaultParallelism))


def _finish(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _to_folder(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    writer = stream.writeStream.format("parquet").option("path", path)
    with _settings(
        spark,
        spark__sql__shuffle__partitions=_state_partitions(spark),
        spark__sql__streaming__stateStore__providerClass=positions.STATE_STORE,
    ):
        _finish(writer.option("checkpointLocation", scratch_path(spark, "offsets")))
    return spark.read.schema(stream.schema).parquet(path)


def stream_candles(spark, sf_dir):
    """Hourly bars of event values, as far as they are closed ten minutes before the last event."""
    schema = table(spark, sf_dir, "events").schema
    ticks = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    bars = streams.stream_candles(
        ticks, "1h", symbol="event_type", seq="event_id", price="value", volume="value"
    )
    return rounded(_to_folder(spark, bars, "stream_candles"), volume=4)


def _candle_stream(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    """All candles in four files, one week after the other, one file per micro-batch.

    ``again``: every file also repeats the week before its own.
    """
    base = candles(spark, sf_dir)
    path = scratch_path(spark, "candle_stream")
    weeks = ["2000-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2100-01-01"]
    starts = [weeks[0], *weeks] if again else weeks
    for start, end in zip(starts, weeks[1:]):
        week = base.where(
            (F.col("bar_ts") >= F.lit(start).cast("timestamp_ntz"))
            & (F.col("bar_ts") < F.lit(end).cast("timestamp_ntz"))
        )
        week.coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(path)


def stream_dedupe(spark, sf_dir):
    """Every candle arrives twice in its batch, and again in the next one."""
    twice = _candle_stream(spark, sf_dir, again=True).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    once = streams.stream_dedupe(twice.drop("n"), "30 days")
    return _to_folder(spark, once, "stream_dedupe").select(*CANDLE_COLUMNS)


def _signal_folders(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        path = scratch_path(spark, "stream_signals")
        source = _candle_stream(spark, sf_dir)
        _finish(signals.stream_signals(source, path, scratch_path(spark, "offsets"), TRADING))
        return path

    return _once(spark, ("signals", sf_dir), build)


def stream_signals(spark, sf_dir):
    return signals.current_zones(spark, _signal_folders(spark, sf_dir))


def stream_signals_corrected(spark, sf_dir):
    """The same candles; every 40th comes a week late, and every 50th wrong at first and then revised."""
    base = candles(spark, sf_dir)
    hour = F.floor(F.unix_timestamp(F.col("bar_ts").cast("timestamp")) / 3600)
    late, wrong = hour % 40 == 7, hour % 50 == 11
    week = F.greatest(F.lit(0), F.least(F.lit(4), F.floor(F.datediff("bar_ts", F.lit("2024-01-01")) / 7)))
    first = base.select(
        *[c for c in CANDLE_COLUMNS if c != "open"],
        F.when(wrong, F.col("open") * 1.01).otherwise(F.col("open")).alias("open"),
        F.when(late, week + 1).otherwise(week).alias("_file"),
    )
    sent = first.unionByName(base.where(wrong).withColumn("_file", week + 1))
    path = scratch_path(spark, "corrected_stream")
    for number in range(6):
        part = sent.where(F.col("_file") == number).select(*CANDLE_COLUMNS)
        part.coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = scratch_path(spark, "corrected_signals")
    _finish(signals.stream_signals(source, out, scratch_path(spark, "offsets"), TRADING))
    return signals.current_zones(spark, out)


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        path = f"{_signal_folders(spark, sf_dir)}/bars"
        schema = spark.read.parquet(path).drop("batch_id").schema
        bars = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        moved = positions.stream_positions(bars.parquet(f"{path}/batch_id=*"), TRIGGER_STUDY)
        return _to_folder(spark, moved, "stream_positions")

    return _once(spark, ("positions", sf_dir), build)


def stream_positions(spark, sf_dir):
    """Trades the stream has closed; one still open has no row yet."""
    closed = _positions(spark, sf_dir).where("exit_reason is not null")
    shown = rounded(
        closed,
        entry_price=6, exit_price=6, entry_capital=6, position_size=6, stop_loss=8, pnl=6,
        exit_capital=6,
    )
    return shown.select(
        "symbol", "trade_no", "type", "entry_idx", F.col("idx").alias("exit_idx"), "entry_price",
        F.col("entry_time").cast("timestamp_ntz").alias("entry_time"), "entry_capital",
        "position_size", "stop_loss", "exit_price", "pnl", "exit_capital", "exit_reason",
    )


def stream_gaps(spark, sf_dir):
    """Bars that never come: every 97th is left out, and those after it wait a day at most."""
    s = study(spark, sf_dir)
    signal = zone_ops.signal_bars(s.zones, "trigger")
    bars = s.bars.select("symbol", "idx", "bar_ts", "close").join(signal, ["symbol", "idx"], "left")
    sent = bars.where(F.col("idx") % 97 != 50).withColumn("n_copies", F.coalesce("n_copies", F.lit(0)))
    path = scratch_path(spark, "gap_stream")
    sent = materialize(sent.withColumn("bar_ts", F.col("bar_ts").cast("timestamp")), "gap_bars")
    edges = ["2000-01-01", "2024-01-10", "2024-01-20", "2100-01-01"]
    for start, end in zip(edges, edges[1:]):
        part = sent.where((F.col("bar_ts") >= start) & (F.col("bar_ts") < end))
        part.coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1).parquet(path)
    moved = positions.stream_positions(reader, TRIGGER_STUDY, "1 day")
    return _to_folder(spark, moved, "stream_gaps").select("symbol", "idx", "n_missing")


def stream_equity(spark, sf_dir):
    equity = positions.stream_equity(_positions(spark, sf_dir))
    return _equity_columns(equity.withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "candle_scan": candle_scan,
    "candle_envelope": candle_envelope,
    "candle_envelope_errors": candle_envelope_errors,
    "candle_normalize": candle_normalize,
    "candle_times": candle_times,
    "candle_time_rejects": candle_time_rejects,
    "backfill_union": backfill_union,
    "backfill_plan": backfill_plan,
    "backfill_coverage": backfill_coverage,
    "backfill_gaps": backfill_gaps,
    "latest_window": latest_window,
    "latest_window_in_folders": latest_window_in_folders,
    "intake_counts": intake_counts,
    "latest_bars": latest_bars,
    "lookback_days": lookback_days,
    "candle_csv": candle_csv,
    "candle_csv_rejects": candle_csv_rejects,
    "resample_1h": resample("1h"),
    "resample_4h": resample("4h"),
    "resample_1d": resample("1d"),
    "candles_from_ticks": candles_from_ticks,
    "candles_from_ticks_15m": candles_from_ticks_15m,
    "history_page": history_page,
    "fills_page": fills_page,
    "history_cursor": history_cursor,
    "candle_table": candle_table,
    "trade_sink": trade_sink,
    "equity_sink": equity_sink,
    "head_tail": head_tail,
    "bar_index": bar_index_query,
    "pct_change_4": indicator("pc"),
    "volume_ma": indicator("volume_ma"),
    "volume_percentile": indicator("volume_percentile"),
    "sma_trend": indicator("sma_trend"),
    "sma50": indicator("sma50"),
    "true_range": indicator("tr"),
    "atr": indicator("atr"),
    "avg_atr": indicator("avg_atr"),
    "roc": indicator("roc"),
    "swing_high": indicator("swing_high"),
    "swing_low": indicator("swing_low"),
    "indicators": indicators,
    "candle_color": candle_color,
    "momentum_cross": momentum_cross,
    "volume_gate": gate("volume_ok"),
    "trend_gate": gate("trend_ok"),
    "volatility_gate": gate("volatility_ok"),
    "trade_condition": gate("accepted"),
    "zone_origin": zone_origin,
    "zone_candidates": zone_candidates,
    "min_distance_thin": min_distance_thin,
    "order_blocks": order_blocks,
    "all_zones": all_zones,
    "last_zone_index": last_zone_index,
    "bars_at_zone_start": bars_at_zone_start,
    "zone_active_bars": zone_active_bars,
    "signals_on_last_bar": signals_on_last_bar,
    "signals_at_polls": signals_at_polls,
    "zone_overlay": zone_overlay,
    "first_exit": first_exit,
    "nonoverlapping_trades": nonoverlapping_trades,
    "trade_prices": trade_prices,
    "trades": trades(),
    "trades_rounded": trades(ROUNDED_STUDY),
    "trades_at_trigger": trades(TRIGGER_STUDY),
    "equity": equity(),
    "equity_rounded": equity(ROUNDED_STUDY),
    "equity_at_trigger": equity(TRIGGER_STUDY),
    "order_blocks_chunked": partial(order_blocks, chunks=SMALL),
    "first_exit_chunked": partial(first_exit, chunks=SMALL),
    "trades_chunked": trades(STUDY, SMALL),
    "equity_chunked": equity(STUDY, SMALL),
    "trailing_stop_chunked": partial(trailing_stop, chunks=SMALL),
    "max_drawdown_chunked": partial(max_drawdown, chunks=SMALL),
    "initial_stop": initial_stop,
    "trailing_stop": trailing_stop,
    "compounding_capital": trade_part("entry_capital", "exit_capital"),
    "position_size": position_size,
    "unrealized_pnl": unrealized_pnl,
    "return_pct": trade_part("return_pct"),
    "completed_trades": completed_trades,
    "winners": winners,
    "losers": losers,
    "trade_markers": trade_markers,
    "trade_number": trade_part("entry_idx"),
    "trade_stats": trade_stats,
    "trade_stats_overall": trade_stats_overall,
    "trade_report": trade_report,
    "running_drawdown": running_drawdown,
    "max_drawdown": max_drawdown,
    "pnl_histogram": pnl_histogram,
    "trade_list": trade_list,
    "price_range": price_range,
    "last_bar": last_bar,
    "candle_summary": candle_summary,
    "position_from_events": position_from_events,
    "order_intents": order_intents,
    "order_intents_fractional": order_intents_fractional,
    "stop_order_intents": stop_order_intents,
    "order_batches": order_batches,
    "order_json": order_json,
    "cancel_intents": cancel_intents,
    "trade_orders": trade_orders,
    "balance_for_asset": balance_for_asset,
    "first_position": first_position,
    "alert_text": alert_text,
    "error_alert": error_alert,
    "startup_message": startup_message,
    "round_to_tick": round_to_tick_query,
    "stream_candles": stream_candles,
    "stream_dedupe": stream_dedupe,
    "stream_signals": stream_signals,
    "stream_signals_corrected": stream_signals_corrected,
    "stream_positions": stream_positions,
    "stream_equity": stream_equity,
    "stream_gaps": stream_gaps,
}
