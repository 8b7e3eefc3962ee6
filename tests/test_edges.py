"""Hand-made tables for the corners."""

import datetime as dt
import math

import pytest
from pyspark.sql import Row, functions as F

from candlewright.functions.text import error_alert, startup_text, trade_alert
from candlewright.functions.ticks import round_to_tick
from candlewright.operators import stats
from candlewright.operators.exits import first_exit
from candlewright.operators.indicators import indicators
from candlewright.operators.orders import order_batches, stop_order_intents
from candlewright.operators.trades import compounding_trades, equity_curve, nonoverlapping_trades
from candlewright.operators.zones import order_blocks
from candlewright.params import TRADING, ChunkParams, TradeParams
from candlewright.plans.study import Study
from candlewright.schema import CANDLE, EQUITY_COLUMNS, TRADE_COLUMNS, ZONE_COLUMNS
from candlewright.session import materialize
from candlewright.sources import backfill, candles as sources

SHORT = ChunkParams(size=64, fan=2)
START = dt.datetime(2024, 1, 1)


def bars(spark, closes):
    rows = [("x", i, None if c is None else float(c), START + dt.timedelta(hours=i)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, idx bigint, close double, bar_ts timestamp_ntz")


def marks(spark, *rows):
    return spark.createDataFrame(
        [("x", *r) for r in rows], "symbol string, idx bigint, side string, n_copies bigint"
    )


def walk(spark, closes, *signals, params=TradeParams()):
    table = bars(spark, closes)
    exits = materialize(first_exit(table, marks(spark, *signals), params, SHORT), "exits")
    taken = materialize(nonoverlapping_trades(exits, SHORT), "taken")
    trades = compounding_trades(taken, params, SHORT)
    return [
        (t.type, t.entry_idx, t.exit_idx, t.exit_reason) for t in trades.orderBy("trade_no").collect()
    ]


def test_stop_and_new_entry_on_one_bar(spark):
    got = walk(spark, [100, 100, 97, 97, 97], (1, "bull", 1), (2, "bull", 1))
    assert got == [("long", 1, 2, "stop_loss"), ("long", 2, 4, "end_of_data")]


def test_stop_wins_over_opposite_signal(spark):
    got = walk(spark, [100, 100, 97, 97], (1, "bull", 1), (2, "bear", 1))
    assert got == [("long", 1, 2, "stop_loss"), ("short", 2, 3, "end_of_data")]


def test_one_opposite_copy_closes_two_reverse(spark):
    closes = [100, 100, 100.5, 100.5, 100.5]
    assert walk(spark, closes, (1, "bull", 1), (3, "bear", 1)) == [("long", 1, 3, "opposite_signal")]
    assert walk(spark, closes, (1, "bull", 1), (3, "bear", 2)) == [
        ("long", 1, 3, "opposite_signal"),
        ("short", 3, 4, "end_of_data"),
    ]


def test_entry_on_last_bar_and_signal_on_first(spark):
    assert walk(spark, [100, 101, 102], (0, "bull", 1), (2, "bear", 1)) == [
        ("short", 2, 2, "end_of_data")
    ]


def test_ratchet_follows_the_peak(spark):
    # 110 lifts the stop to 108.35; 108 is under it although it is far over the entry.
    assert walk(spark, [100, 100, 110, 108, 120], (1, "bull", 1)) == [("long", 1, 3, "stop_loss")]


def test_missing_price_neither_stops_nor_moves_the_stop(spark):
    got = walk(spark, [100.0, 100.0, None, 99.0, 97.0], (1, "bull", 1))
    assert got == [("long", 1, 4, "stop_loss")]


def test_empty_inputs_keep_their_schema(spark):
    study = Study(spark.createDataFrame([], CANDLE), TRADING)
    assert study.zones.columns == ZONE_COLUMNS and study.zones.count() == 0
    assert study.trades.columns == TRADE_COLUMNS and study.trades.count() == 0
    assert study.equity.columns == EQUITY_COLUMNS and study.equity.count() == 0
    assert study.report.count() == 0


def candles(spark, rows):
    full = [("x", START + dt.timedelta(hours=i), *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, CANDLE)


def test_missing_value_blanks_every_window_it_is_in(spark):
    rows = [(10.0, 11.0, 9.0, 10.0, 5.0)] * 60
    rows[30] = (10.0, 11.0, 9.0, None, None)
    out = {r.idx: r for r in indicators(candles(spark, rows), TRADING).collect()}
    assert out[29].volume_ma == 5.0 and out[30].volume_ma is None and out[49].volume_ma is None
    assert out[50].volume_ma == 5.0
    assert out[31].tr is None and out[32].tr == 2.0
    assert out[59].volume_percentile is None
    assert out[0].tr is None and out[1].tr == 2.0


def test_all_volumes_tied(spark):
    out = indicators(candles(spark, [(10.0, 11.0, 9.0, 10.0, 5.0)] * 55), TRADING)
    assert out.where("idx = 52").first().volume_percentile == pytest.approx(51.0)


def test_zero_price_gives_missing_ratio(spark):
    rows = [(0.0, 1.0, 0.0, 0.0, 1.0)] * 15
    out = indicators(candles(spark, rows), TRADING).where("idx = 12").first()
    assert out.pc is None and out.roc is None


def test_no_origin_no_zone(spark):
    # Opens climb but no candle has a body, so nothing can be an origin.
    rows = [(100.0 + (i > 60) * (i - 60), 200.0, 50.0, 100.0 + (i > 60) * (i - 60), float(i)) for i in range(90)]
    assert order_blocks(candles(spark, rows), TRADING).count() == 0


def trade_rows(spark, pnls):
    rows = [
        Row(symbol="x", trade_no=i + 1, entry_idx=i, pnl=p, return_pct=p, entry_capital=100.0, exit_capital=100.0 + (p or 0))
        for i, p in enumerate(pnls)
    ]
    return spark.createDataFrame(
        rows,
        "symbol string, trade_no bigint, entry_idx bigint, pnl double, return_pct double, "
        "entry_capital double, exit_capital double",
    )


def test_no_losers_is_infinite_factor(spark):
    got = stats.trade_stats(trade_rows(spark, [1.0, 0.0, None])).first()
    assert got.n_trades == 2 and got.win_rate == 50.0 and got.avg_loss == 0.0
    assert math.isinf(got.profit_factor)


def test_histogram_of_one_value(spark):
    got = {r.bin: r.n for r in stats.pnl_histogram(trade_rows(spark, [2.0, 2.0])).collect()}
    assert len(got) == 20 and got[11] == 2 and sum(got.values()) == 2


def test_histogram_last_bin_is_closed(spark):
    got = {r.bin: r.n for r in stats.pnl_histogram(trade_rows(spark, [0.0, 1.0, 20.0])).collect()}
    assert got[1] == 1 and got[2] == 1 and got[20] == 1


def test_drawdown(spark):
    table = trade_rows(spark, [0.0, 10.0, -12.0, 5.0])
    assert stats.max_drawdown(stats.trade_drawdown(table)).first()[1] == pytest.approx(-20.0)


def test_tick_of_negative_price_and_on_grid(spark):
    df = spark.createDataFrame([(-1.02,), (1.0,), (1.025,)], "p double")
    got = df.select(
        round_to_tick(F.col("p"), "0.05").cast("double"),
        round_to_tick(F.col("p"), "0.05", "ceil").cast("double"),
        round_to_tick(F.col("p"), "0.05", "ceil", compat=True).cast("double"),
    ).collect()
    assert [tuple(r) for r in got] == [(-1.0, -1.0, -1.0), (1.0, 1.0, 1.05), (1.05, 1.05, 1.05)]


def test_envelopes(spark):
    rows = [
        ("a", '{"success":true,"result":[{"time":1704067200,"open":"1","high":2,"low":0.5,"close":"oops","volume":"NaN"}]}'),
        ("b", '{"success":false,"error":"no_auth"}'),
        ("c", '{"success":true,"result":[]}'),
        ("d", "<html>"),
    ]
    df = spark.createDataFrame(rows, "symbol string, body string")
    good = sources.candle_envelope(df).collect()
    assert [tuple(r) for r in good] == [("a", START, 1.0, 2.0, 0.5, None, None)]
    errors = {r.symbol: r.error for r in sources.envelope_errors(df).collect()}
    assert errors == {"b": "no_auth", "d": "unreadable response"}


def test_csv_row_without_time_is_rejected(spark, tmp_path):
    (tmp_path / "data.csv").write_text(
        "timestamp,open,high,low,close,volume\n,1,2,0.5,1.5,10\n2024-01-01 00:00:00,1,2,0.5,x,10\n"
    )
    read = sources.read_candle_csv(spark, str(tmp_path), "a")
    assert sources.candle_rejects(read).count() == 1
    assert tuple(read.where("bar_ts is not null").first()) == ("a", START, 1.0, 2.0, 0.5, None, 10.0)


def test_backfill_takes_shared_candle_from_the_later_slice(spark):
    one = candles(spark, [(1.0, 1.0, 1.0, 1.0, 1.0)] * 2)
    two = candles(spark, [(2.0, 2.0, 2.0, 2.0, 2.0)] * 3).where("bar_ts > timestamp_ntz'2024-01-01'")
    got = [r.open for r in backfill.backfill_union([one, two]).orderBy("bar_ts").collect()]
    assert got == [1.0, 2.0, 2.0]


def test_stop_order_rules(spark):
    rows = [
        (1, 2.9, "sell", "limit_order", None, 5.0, None, False),
        (2, 2.9, "sell", "market_order", None, None, 20.0, True),
        (3, 2.9, "buy", "market_order", None, None, None, True),
        (4, 2.9, "buy", "market_order", None, None, None, False),
    ]
    df = spark.createDataFrame(
        rows,
        "product_id int, size double, side string, order_type string, limit_price double, "
        "stop_price double, trail_amount double, trailing boolean",
    )
    got = {r.product_id: (r.size, r.trail_amount, r.error) for r in stop_order_intents(df).collect()}
    assert got == {
        1: (2, None, "limit_price is nil"),
        2: (2, -20.0, None),
        3: (2, None, "trail_amount is nil"),
        4: (2, None, "stop_price is nil"),
    }


def test_batches_hold_at_most_five(spark):
    df = spark.range(23).select(F.lit(1).alias("product_id"), F.col("id").alias("k"))
    got = order_batches(df, ["k"], ["k"], block_width=4).orderBy("batch_no").collect()
    assert [r.n_orders for r in got] == [5, 5, 5, 5, 3]
    assert [o.k for r in got for o in r.orders] == list(range(23))


def test_texts(spark):
    text = trade_alert(F.lit("buy"), F.lit("ABC"), F.lit("MARKET"), F.lit(0.05))
    got = spark.range(1).select(text.alias("a"), error_alert(F.lit("bad")).alias("b")).first()
    assert got.a == "🟢 <b>BUY Alert</b>\n\nSymbol: ABC\nPrice: MARKET\nSize: 0.05"
    assert got.b == "⚠️ <b>Error Alert</b>\n\nbad"
    lines = startup_text(1, "1m", TRADING, TradeParams()).split("\n")
    assert lines[3] == "Leverage: 1x" and lines[6] == "- Price Move Threshold: 0.50%"


def test_leverage_and_equity_at_exit(spark):
    params = TradeParams(leverage=3.0)
    table = bars(spark, [100.0, 100.0, 104.0, 101.0, 101.0])
    exits = materialize(first_exit(table, marks(spark, (1, "bull", 1)), params, SHORT), "exits")
    taken = materialize(nonoverlapping_trades(exits, SHORT), "taken")
    trades = materialize(compounding_trades(taken, params, SHORT), "trades")
    trade = trades.first()
    assert trade.exit_capital == pytest.approx(103.0) and trade.return_pct == pytest.approx(3.0)
    line = equity_curve(table, trades, params, SHORT).orderBy("idx").collect()
    assert [r.equity for r in line] == pytest.approx([100, 100, 112, 103, 103])
    assert [r.position for r in line] == [0, 1, 1, 0, 0]
