"""Sources against plain Python on small tables."""

import datetime as dt
import random

from pyspark.sql import Observation, functions as F

from candlewright.functions.text import startup_message, startup_text
from candlewright.params import TRADING, TradeParams
from candlewright.schema import CANDLE
from candlewright.sources import backfill, candles as sources, sinks
from candlewright.sources.ticks import candles_from_ticks, tick_key

START = dt.datetime(2024, 1, 1)
RANGE = "symbol string, start_ts timestamp_ntz, end_ts timestamp_ntz"


def minute(n):
    return START + dt.timedelta(minutes=n)


def candles(spark, present):
    rows = [(s, None if n is None else minute(n), 1.0, 1.0, 1.0, 1.0, float(n or 0)) for s, n in present]
    return spark.createDataFrame(rows, CANDLE)


def runs(numbers):
    """(first, last) of every run of neighbouring numbers."""
    out = []
    for n in sorted(numbers):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [tuple(r) for r in out]


def test_coverage_and_gaps_against_sets(spark):
    rng = random.Random(5)
    have = {
        "a": {n for n in range(0, 9000) if rng.random() < 0.97 and not 2000 <= n < 5200},
        "b": {n for n in range(100, 300) if n % 3},
        "c": set(range(1435, 1450)),
    }
    rows = [(s, n) for s, ns in have.items() for n in ns] + [("b", 101), ("b", 101), ("b", None), (None, 5)]
    table = candles(spark, rows)
    asked = {"a": [(10, 8990)], "b": [(0, 120), (200, 260)], "c": [(1440, 1445)], "d": [(7, 9)]}
    ranges = spark.createDataFrame(
        [(s, minute(a), minute(b)) for s, parts in asked.items() for a, b in parts]
        + [(None, minute(0), minute(9)), ("e", None, minute(9)), ("f", minute(9), minute(9))],
        RANGE,
    )
    got = sorted(map(tuple, backfill.coverage(table).collect()))
    want = sorted(
        (s, minute(a), minute(b), b - a + 1) for s, ns in have.items() for a, b in runs(ns)
    )
    assert got == want
    got = sorted(map(tuple, backfill.gaps(table, ranges).collect()))
    want = sorted(
        (s, minute(a), minute(b + 1), b - a + 1)
        for s, parts in asked.items()
        for first, end in parts
        for a, b in runs(set(range(first, end)) - have.get(s, set()))
    )
    assert got == want and ("d", minute(7), minute(9), 2) in got
    nothing = table.limit(0)
    assert backfill.coverage(nothing).count() == 0
    assert sorted(r.n_missing for r in backfill.gaps(nothing, ranges).collect()) == [2, 5, 60, 120, 8980]


def test_slices_cover_the_range_and_merge_to_it(spark, tmp_path):
    table = candles(spark, [("a", n) for n in range(0, 2601)] + [("b", n) for n in range(5)])
    ranges = spark.createDataFrame(
        [("a", minute(0), minute(2600)), ("b", minute(0), minute(3)), ("x", minute(0), minute(1))], RANGE
    )
    plan = sorted(map(tuple, backfill.slice_plan(ranges, 60, 10).collect()))
    assert len(plan) == 262 and plan[0] == ("a", 0, minute(0), minute(10))
    assert plan[-2:] == [("b", 0, minute(0), minute(3)), ("x", 0, minute(0), minute(1))]
    cut = backfill.cut_slices(table, ranges, 60, 10)
    assert cut.count() == 2600 + 259 + 3
    # What an earlier slice knows of the shared bar is not taken.
    cut = cut.withColumn("close", F.col("slice").cast("double"))
    cut.write.partitionBy("slice").parquet(str(tmp_path / "s"))
    merged = backfill.merge_slices(backfill.read_slices(spark, str(tmp_path / "s")))
    plan_text = merged._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("FileScan") == 1 and "Union" not in plan_text
    got = {(r.symbol, r.bar_ts): r.close for r in merged.collect()}
    assert len(got) == 2603 and got["a", minute(10)] == 1.0 and got["a", minute(2599)] == 259.0


def test_times_that_cannot_be_read_keep_their_value(spark):
    times = ["1704067200", '"1704067200"', "1704067200.0", "1704067200.25", '"2024-01-01"', "null",
             "1704067200000", "1e30", "true", "[1]", '""', "-60"]
    body = ",".join(f'{{"time":{t},"open":1,"high":"2","low":0.5,"close":"x","volume":{i}}}' for i, t in enumerate(times))
    rows = [("a", f'{{"success":true,"result":[{body},{{"volume":99}},7]}}'), ("b", '{"success":true,"result":5}'),
            ("c", None), ("d", '{"success":true,"result":[{"timestamp":60,"open":1}]}')]
    responses = spark.createDataFrame(rows, "symbol string, body string")
    got = sources.candle_envelope(responses).where("bar_ts is not null").collect()
    assert sorted((r.symbol, r.bar_ts, r.open, r.volume) for r in got if r.volume is not None) == [
        ("a", dt.datetime(1969, 12, 31, 23, 59), 1.0, 11.0),
        ("a", START, 1.0, 0.0), ("a", START, 1.0, 1.0), ("a", START, 1.0, 2.0),
    ]
    assert [r.bar_ts for r in got if r.symbol == "d"] == [dt.datetime(1970, 1, 1, 0, 1)]
    bad = sources.time_rejects(sources.envelope_rows(responses)).collect()
    by_volume = {r.volume: (r.raw_time, r.reason) for r in bad if r.volume is not None}
    assert by_volume[3.0] == ("1704067200.25", "fractional")
    assert by_volume[4.0] == ("2024-01-01", "not a number")
    assert by_volume[5.0] == (None, "missing") and by_volume[99.0] == (None, "missing")
    assert by_volume[6.0] == ("1704067200000", "out of range") and by_volume[7.0][1] == "out of range"
    assert {by_volume[n][1] for n in (8.0, 9.0, 10.0)} == {"not a number"}
    # Every row is either a candle or a reject.
    assert len(got) + len(bad) == sources.candle_envelope(responses).count() == len(times) + 3
    assert [r.symbol for r in sources.envelope_errors(responses).collect()] == ["c"]
    plain = spark.createDataFrame([("a", "x", 1.0), ("a", "60", 2.0)], "symbol string, time string, open double")
    full = plain.select("*", *[F.lit("1").alias(c) for c in ("high", "low", "close", "volume")])
    assert sources.time_rejects(full).count() == 1 and sources.candle_normalize(full).count() == 2


def test_tick_order_is_that_of_the_pair_and_needs_no_sort(spark):
    rng = random.Random(3)
    numbers = [None, -(2**63), -1, 0, 1, 2**63 - 1]
    rows = [("s", START + dt.timedelta(microseconds=rng.randrange(6)), rng.choice(numbers), float(i), 1.0) for i in range(300)]
    for kind in ("timestamp", "timestamp_ntz"):
        ticks = spark.createDataFrame(rows, f"symbol string, ts {kind}, seq bigint, price double, volume double")
        keyed = ticks.select("price", F.struct("ts", "seq").alias("pair"), tick_key(ticks, "ts", "seq").alias("key"))
        by_pair = [r[0] for r in keyed.groupBy("pair").agg(F.min("key").alias("k"), F.max("key").alias("m")).orderBy("pair").selectExpr("struct(k, m)").collect()]
        assert all(r.k == r.m for r in by_pair)
        assert [r.k for r in by_pair] == sorted({r.k for r in by_pair}) and len(by_pair) == 36
    plan = candles_from_ticks(ticks, "1m")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    texts = ticks.withColumn("seq", F.col("seq").cast("string"))
    assert candles_from_ticks(texts, "1m").count() == 1


def test_startup_messages(spark):
    trades = TradeParams()
    names = "product_id int, timeframe string, initial_capital double, leverage double, sensitivity double, "
    names += "min_volume_percentile double, min_distance int, stop_pct double, trail_pct double, message string"
    row = (1, "1m", 100.0, 1.0, TRADING.sensitivity, 30.0, 5, trades.stop_pct, trades.trail_pct, "old")
    got = startup_message(spark.createDataFrame([row, (2,) + (None,) * 9], names)).collect()
    assert got[0].message == startup_text(1, "1m", TRADING, trades)
    assert got[1].message.count("?") == 8 and got[1].product_id == 2


def test_csv_symbol_from_folders(spark, tmp_path):
    rows = [("a/b%c d", minute(0), 1.0, 1.0, 1.0, 1.0, 1.0), ("007", minute(1), 2.0, 2.0, 2.0, 2.0, 2.0)]
    table = spark.createDataFrame(rows, CANDLE)
    table.select("symbol", F.col("bar_ts").cast("string").alias("timestamp"), *CANDLE_FIELDS).write.partitionBy(
        "symbol"
    ).csv(str(tmp_path / "c"), header=True)
    got = sources.read_candle_csv(spark, str(tmp_path / "c"))
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    plan = got.where("symbol = '007'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan


def test_latest_window_opens_the_newest_folders_only(spark, tmp_path):
    # Days without candles; one symbol ended long before the other.
    rows = [("a", n) for n in range(0, 9 * 1440, 7) if n // 1440 not in (6,)] + [("b", n) for n in range(0, 2000, 9)]
    table = candles(spark, rows)
    path = str(tmp_path / "t")
    sinks.write_candles(table, path)
    got = sources.latest_window_in_folders(sources.candle_folders(spark, path), 3000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    want = sources.latest_window(table, 3000)
    assert {r.symbol for r in want.select("symbol").distinct().collect()} == {"a", "b"}
    # From here on no folder of a day that is in no window can be read.
    broken = list((tmp_path / "t").glob("resolution=1m/symbol=a/date=2024-01-0[3-5]/*.parquet"))
    for file in broken:
        file.write_bytes(b"not a table")
    assert len(broken) >= 3
    assert want.count() > 500 and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    empty = sources.candle_folders(spark, path).limit(0)
    assert sources.latest_window_in_folders(empty, 3000).count() == 0


def test_intake_counts_in_batch_and_on_a_stream(spark, tmp_path):
    rows = [("a", "60", "1"), ("a", "x", "1"), (None, "60", "1"), (None, None, "y"), ("b", "120", "y"), ("b", "0", None)]
    raw = spark.createDataFrame(rows, "symbol string, time string, open string")
    raw = raw.select("*", *[F.lit("1").alias(c) for c in CANDLE_FIELDS[1:]])
    want = {"rows_in": 6, "kept": 3, "no_symbol": 1, "bad_time": 2, "bad_numbers": 1}
    counts = Observation("intake")
    assert sources.observed_intake(raw, counts).count() == 3
    assert counts.get == want
    raw.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    query = (
        sources.observed_intake(stream, "intake").writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "offsets"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    seen = [p.observedMetrics["intake"].asDict() for p in query.recentProgress if "intake" in p.observedMetrics]
    assert {k: sum(p[k] for p in seen) for k in want} == want


CANDLE_FIELDS = ["open", "high", "low", "close", "volume"]
