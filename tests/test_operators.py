import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

import model
from candlewright.operators.chain import follow_chain
from candlewright.operators.exits import first_exit
from candlewright.operators.index import bar_index
from candlewright.operators.indicators import indicators
from candlewright.operators.scan import running
from candlewright.operators.trades import (
    compounding_trades,
    equity_curve,
    nonoverlapping_trades,
    trailing_stop,
)
from candlewright.operators.zones import order_blocks
from candlewright.params import TRADING, ChunkParams, TradeParams
from candlewright.schema import CANDLE
from candlewright.session import materialize
from candlewright.sources.candles import read_candles
from candlewright.sources.sinks import write_candles

CUTS = [
    ChunkParams(size=16, fan=3, trade_block=20),
    ChunkParams(size=64, fan=2, trade_block=64),
    ChunkParams(),
]
SERIES, BARS = 60, 200


def test_running_equals_plain_window(spark):
    r = random.Random(1)
    rows = [(f"k{r.choice('aab')}", i, r.choice([None, r.uniform(0.5, 2.0)])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i bigint, x double").withColumn("b", F.expr("i div 7"))
    kinds = ("sum", "max", "min", "product", "last")
    x = F.col("x")
    for inclusive in (True, False):
        values = {kind: (kind, x) for kind in kinds}
        got = running(
            df, ["k"], "b", ["i"], values, inclusive=inclusive, fan=5
        )
        alone = running(
            df, ["k"], "b", ["i"], {"last": ("last", x)}, inclusive=inclusive, fan=5
        )
        assert alone.exceptAll(got.select(alone.columns)).count() == 0
        w = Window.partitionBy("k").orderBy("i").rowsBetween(
            Window.unboundedPreceding, 0 if inclusive else -1
        )
        plain = df.select(
            "k", "i", F.sum(x).over(w), F.max(x).over(w), F.min(x).over(w),
            F.product(x).over(w), F.last(x, True).over(w),
        )
        a = {(t[0], t[1]): t[2:] for t in got.select("k", "i", *kinds).collect()}
        b = {(t[0], t[1]): t[2:] for t in plain.collect()}
        assert a.keys() == b.keys()
        for key in a:
            assert [v is None for v in a[key]] == [v is None for v in b[key]], key
            assert [v or 0 for v in a[key]] == pytest.approx([v or 0 for v in b[key]], rel=1e-9)


def test_bar_index_is_position(spark):
    c = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("symbol"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id * 37)").alias("bar_ts"),
    )
    w = Window.partitionBy("symbol").orderBy("bar_ts")
    wrong = bar_index(c).withColumn("want", F.row_number().over(w) - 1).where("idx <> want")
    assert wrong.count() == 0


@pytest.mark.parametrize("cut", CUTS)
def test_chain_equals_greedy_walk(spark, cut):
    r = random.Random(7)
    rows, want = [], set()
    for s in range(80):
        dense, gap = r.choice([0.1, 0.5, 0.9]), r.choice([1, 3, 10, 40])
        far = r.random() < 0.5
        nodes = {
            p: p + (r.randint(1, gap) if far else gap) for p in range(BARS) if r.random() < dense
        }
        rows += [(f"s{s}", p, n, p * 1.5) for p, n in nodes.items()]
        t = -1
        for p in sorted(nodes):
            if p >= t:
                want.add((f"s{s}", p))
                t = nodes[p]
    df = spark.createDataFrame(rows, "symbol string, p bigint, n bigint, extra double")
    got = follow_chain(df, "symbol", "p", "n", cut).collect()
    assert {(x.symbol, x.p) for x in got} == want
    assert len(got) == len(want)
    assert all(x.extra == x.p * 1.5 for x in got)


@pytest.fixture(scope="module")
def random_trades(spark):
    bars, signals, want = [], [], {}
    for s in range(SERIES):
        closes, marks = model.random_series(s, BARS)
        want[f"s{s}"] = (closes, marks)
        bars += [(f"s{s}", i, c) for i, c in enumerate(closes)]
        signals += [
            (f"s{s}", i, "bull" if side > 0 else "bear", n) for i, (side, n) in marks.items()
        ]
    at = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, idx)")
    indexed = spark.createDataFrame(bars, "symbol string, idx bigint, close double").withColumn("bar_ts", at)
    marks = spark.createDataFrame(signals, "symbol string, idx bigint, side string, n_copies bigint")
    return indexed.cache(), marks.cache(), want


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("decimals", [None, 8])
def test_trades_and_equity_equal_the_walk(spark, random_trades, cut, decimals):
    indexed, signals, want = random_trades
    params = TradeParams(size_decimals=decimals)
    exits = materialize(first_exit(indexed, signals, params, cut), "exits")
    taken = materialize(nonoverlapping_trades(exits, cut), "taken")
    table = materialize(compounding_trades(taken, params, cut), "trades")
    got = {}
    for t in table.orderBy("symbol", "trade_no").collect():
        sign = 1 if t.type == "long" else -1
        reason = {"stop_loss": "stop", "opposite_signal": "opposite", "end_of_data": "end"}
        got.setdefault(t.symbol, []).append(
            (sign, t.entry_idx, t.exit_idx, t.entry_capital, t.position_size, t.stop_loss, t.pnl,
             reason[t.exit_reason])
        )
    curve = {}
    for e in equity_curve(indexed, table, params, cut).orderBy("symbol", "idx").collect():
        curve.setdefault(e.symbol, []).append((e.position, e.equity))
    for symbol, (closes, marks) in want.items():
        trades, line = model.run_trades(closes, marks, decimals=decimals)
        mine = got.get(symbol, [])
        assert [t[:3] + t[7:] for t in mine] == [t[:3] + t[7:] for t in trades], symbol
        for a, b in zip(mine, trades):
            assert a[3:7] == pytest.approx(b[3:7], rel=1e-9, abs=1e-9)
        assert [p for p, _ in curve[symbol]] == [p for p, _ in line]
        assert [q for _, q in curve[symbol]] == pytest.approx([q for _, q in line], rel=1e-9)
        spans = [(t[1], t[2]) for t in mine]
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("cut", CUTS[:2])
def test_trailing_stop_ends_at_the_reported_stop(random_trades, cut):
    indexed, signals, _ = random_trades
    params = TradeParams()
    exits = materialize(first_exit(indexed, signals, params, cut), "exits")
    taken = materialize(nonoverlapping_trades(exits, cut), "taken")
    table = materialize(compounding_trades(taken, params, cut), "trades")
    stops = trailing_stop(indexed, table, params, cut)
    last = stops.groupBy("symbol", "trade_no").agg(F.max_by("trailing_stop", "idx").alias("s"), F.count("*").alias("n"))
    joined = table.where("exit_idx > entry_idx").join(last, ["symbol", "trade_no"], "left")
    bad = joined.where("s is null or abs(s - stop_loss) > 1e-9 or n <> exit_idx - entry_idx")
    assert bad.count() == 0


@pytest.fixture(scope="module")
def random_candles(spark):
    rows, want = [], {}
    for s in range(12):
        r = random.Random(100 + s)
        price, bars = 500.0, []
        for _ in range(300):
            o = price
            if r.random() < 0.85:
                price = round(price * (1 + r.gauss(0, 0.002)), 2)
            high = round(max(o, price) + r.choice([0, 0.5, 3]), 2)
            low = round(min(o, price) - r.choice([0, 0.5]), 2)
            bars.append((o, high, low, price, float(r.randint(1, 40))))
        want[f"s{s}"] = bars
        rows += [(f"s{s}", i, *b) for i, b in enumerate(bars)]
    df = spark.createDataFrame(
        rows, "symbol string, i int, open double, high double, low double, close double, volume double"
    )
    at = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, i)")
    return df.withColumn("bar_ts", at).drop("i").cache(), want


@pytest.mark.parametrize("size", [64, 100, 3968])
def test_chunked_indicators_equal_whole_windows(random_candles, size):
    candles, want = random_candles
    rows = indicators(candles, TRADING, ChunkParams(size=size)).orderBy("symbol", "idx").collect()
    assert len(rows) == sum(map(len, want.values()))
    for row in rows:
        bars, i = want[row.symbol], row.idx
        close = [b[3] for b in bars]
        if i >= 49:
            assert row.sma50 == pytest.approx(sum(close[i - 49 : i + 1]) / 50)
            assert row.volume_percentile == pytest.approx(
                model.percentile([b[4] for b in bars[i - 49 : i + 1]])
            )
        else:
            assert row.sma50 is None and row.volume_percentile is None
        assert (row.tr is None) == (i == 0)
        assert (row.atr is None) == (i < 14)
        assert (row.avg_atr is None) == (i < 33)
        peak = 2 <= i < len(bars) - 2 and all(
            bars[i][1] > bars[i + k][1] for k in (-2, -1, 1, 2)
        )
        assert row.swing_high == int(peak)


@pytest.mark.parametrize("cut", [ChunkParams(size=64, fan=2), ChunkParams()])
def test_order_blocks_equal_the_walk(random_candles, cut):
    candles, want = random_candles
    got = {}
    for z in order_blocks(candles, TRADING, cut).collect():
        got.setdefault(z.symbol, set()).add((z.side, z.trigger_idx, z.start_idx, z.top, z.bot))
    total = 0
    for symbol, bars in want.items():
        found = model.zones(bars, TRADING)
        total += len(found)
        assert got.get(symbol, set()) == set(found), symbol
    assert total > 50


def test_nulls_are_keys_of_their_own(spark):
    rows = [(k, i, 1) for k in ("a", None) for i in [None, *range(12)]]
    df = spark.createDataFrame(rows, "k string, i bigint, x bigint").withColumn("b", F.expr("i div 3"))
    got = running(df, ["k"], "b", ["i"], {"n": ("sum", F.col("x"))}, fan=2).collect()
    assert sorted((str(r.k), -1 if r.i is None else r.i, r.n) for r in got) == [
        (k, i, i + 2) for k in ("None", "a") for i in range(-1, 12)
    ]


@pytest.mark.parametrize("share", [0.2, 1.0])
def test_chain_equals_the_walk(spark, share):
    rng = random.Random(3)
    rows = [
        (key, pos, pos + (10 if share == 1.0 else rng.choice([1, 7, 300])))
        for key in ("a", "b", None)
        for pos in range(1200)
        if rng.random() < share
    ]
    want = []
    for key in ("a", "b", None):
        free = 0
        for k, pos, nxt in rows:
            if k == key and pos >= free:
                want.append((str(k), pos, nxt))
                free = nxt
    df = spark.createDataFrame(rows, "k string, at bigint, then bigint")
    for cut in (ChunkParams(size=16, fan=3), ChunkParams()):
        got = follow_chain(df, "k", "at", "then", cut).collect()
        assert sorted((str(r.k), r.at, r.then) for r in got) == sorted(want)


def test_candle_table_reads_only_its_days(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [("A/B", start + dt.timedelta(hours=h), *[float(h)] * 5) for h in range(72)]
    table = spark.createDataFrame(rows, CANDLE)
    path = str(tmp_path / "candles")
    write_candles(table, path, "1h")
    write_candles(table.where("hour(bar_ts) = 0"), path, "1d")
    write_candles(table.where("day(bar_ts) = 2"), path, "1h")
    got = read_candles(spark, path, resolution="1h", start="2024-01-02 05:00:00", end="2024-01-02 23:00:00")
    assert {r.open for r in got.collect()} == {float(h) for h in range(29, 48)}
    assert {r.symbol for r in got.collect()} == {"A/B"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(resolution" in plan and "date#" in plan.split("PartitionFilters")[1][:200]
    assert read_candles(spark, path, resolution="1h").count() == 72
    assert read_candles(spark, path, resolution="1d").count() == 3
