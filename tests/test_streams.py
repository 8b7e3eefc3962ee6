"""Streams give what the batch operators give."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from candlewright.params import TRADING, TradeParams
from candlewright.plans.study import Study
from candlewright.sources.ticks import candles_from_ticks, walk_candles
from candlewright.streaming.candles import stream_candles, stream_dedupe
from candlewright.streaming.positions import stream_positions
from candlewright.streaming.signals import SignalStream, current_zones, stream_signals

NAMES = dict(symbol="event_type", seq="event_id", price="value", volume="value")


def finish(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None


def to_parquet(stream, folder, label):
    out = str(folder / label)
    finish(
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", out + "_offsets")
    )
    return stream.sparkSession.read.parquet(out)


def write_days(df, ts, path, edges):
    for start, end in zip(edges, edges[1:]):
        part = df.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))
        part.coalesce(1).write.mode("append").parquet(path)


def days(*numbers):
    return [dt.datetime(2024, 1, 1) + dt.timedelta(days=n) for n in numbers]


def test_stream_candles_equal_batch_with_late_ticks(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    # Every seventh tick arrives with the next day's file, hours late but inside the watermark.
    late = F.when(F.col("event_id") % 7 == 0, F.col("ts") + F.expr("interval 12 hours"))
    shifted = events.withColumn("arrives", F.coalesce(late, F.col("ts")))
    write_days(shifted, "arrives", str(tmp_path / "in"), days(0, 6, 12, 18, 40))
    ticks = (
        spark.readStream.schema(shifted.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "in"))
    )
    got = to_parquet(stream_candles(ticks, "1h", "1 day", **NAMES), tmp_path, "bars")
    batch = candles_from_ticks(events, "1h", **NAMES)
    last = events.agg(F.max("ts")).first()[0]
    closed = batch.where(F.col("bar_ts") < F.lit(last - dt.timedelta(days=1, hours=1)))
    assert got.count() >= closed.count() > 100
    both = closed.join(got.withColumnRenamed("close", "c"), ["symbol", "bar_ts", "open", "high", "low"])
    assert both.where("close = c").count() == closed.count()


def test_signals_and_positions_equal_batch_across_a_restart(spark, tmp_path):
    candles = walk_candles(spark.read.parquet(f"{DATA}/events.parquet")).cache()
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    offsets = str(tmp_path / "offsets")

    def feed():
        reader = spark.readStream.schema(candles.schema).option("maxFilesPerTrigger", 1)
        finish(stream_signals(reader.parquet(source), out, offsets, TRADING))

    write_days(candles, "bar_ts", source, days(0, 10))
    feed()
    # The second run is polled the last two days again, then the rest.
    write_days(candles, "bar_ts", source, days(8, 20, 40))
    feed()

    zones = current_zones(spark, out)
    trade_params = TradeParams(entry_at="trigger")
    study = Study(candles, TRADING, trade_params)
    want = study.zones
    assert zones.count() == want.count() > 0
    assert zones.select(*want.columns).exceptAll(want).count() == 0

    folder = f"{out}/bars"
    schema = spark.read.parquet(folder).drop("batch_id").schema
    bars = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    moved = to_parquet(
        stream_positions(bars.parquet(f"{folder}/batch_id=*"), trade_params), tmp_path, "moved"
    )
    equity = study.equity.select("symbol", "idx", "position", F.round("equity", 6).alias("equity"))
    got = moved.select("symbol", "idx", "position", F.round("equity", 6).alias("equity"))
    assert got.count() == equity.count()
    assert got.exceptAll(equity).count() == 0
    closed = moved.where("exit_reason is not null").select("symbol", "entry_idx", F.col("idx").alias("exit_idx"), "exit_reason")
    done = study.trades.where("exit_reason <> 'end_of_data'").select(*closed.columns)
    assert closed.count() == done.count() and closed.exceptAll(done).count() == 0


def test_repeated_candles_are_dropped(spark, tmp_path):
    candles = walk_candles(spark.read.parquet(f"{DATA}/events.parquet")).cache()
    for _ in range(2):
        candles.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    reader = spark.readStream.schema(candles.schema).option("maxFilesPerTrigger", 1)
    polled = reader.parquet(str(tmp_path / "in"))
    got = to_parquet(stream_dedupe(polled, "60 days"), tmp_path, "once")
    assert got.count() == candles.count()


@pytest.mark.parametrize("files", [1, 100])
def test_positions_take_bars_in_any_order(spark, tmp_path, files):
    rng, price, rows = random.Random(7), 100.0, []
    for symbol in ("A", "B"):
        for idx in range(40):
            price *= 1 + rng.uniform(-0.03, 0.03)
            side = rng.choice(["bull", "bear", None, None])
            ts = dt.datetime(2024, 1, 1) + dt.timedelta(hours=idx)
            close = None if idx == 17 else price
            rows.append((symbol, idx, ts, close, side, int(side is not None)))
    schema = "symbol string, idx bigint, bar_ts timestamp, close double, side string, n_copies bigint"

    def run(parts, name, per_batch):
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        bars = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(f"{tmp_path}/{name}")
        query = (
            stream_positions(bars)
            .writeStream.format("memory")
            .queryName(f"positions_{name}_{per_batch}")
            .option("checkpointLocation", f"{tmp_path}/state-{name}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(240)
        return sorted(map(str, spark.table(f"positions_{name}_{per_batch}").collect()))

    mixed = list(rows)
    rng.shuffle(mixed)
    whole = run([rows], "ordered", 100)
    assert len(whole) == 78
    assert run([mixed[:25], mixed[25:50], mixed[45:]], "mixed", files) == whole


def test_positions_give_up_bars_that_never_come(spark, tmp_path):
    """A lost bar counts as one without a price, once event time is past the delay."""
    rng, price, rows = random.Random(11), 100.0, []
    for idx in range(60):
        price *= 1 + rng.uniform(-0.03, 0.03)
        side = rng.choice(["bull", "bear", None])
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(hours=idx)
        rows.append(("A", idx, ts, price, side, int(side is not None)))
    lost, waits = {7, 20, 21, 22}, {57}
    schema = "symbol string, idx bigint, bar_ts timestamp, close double, side string, n_copies bigint"

    def run(parts, name, delay):
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        bars = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
        return to_parquet(stream_positions(bars, gap_delay=delay), tmp_path, f"out_{name}").orderBy("idx").collect()

    # Bar 30 comes late but within the delay.
    first = [r for r in rows[:35] if r[1] not in lost | {30}]
    sent = [first, [rows[30]] + rows[35:50], [r for r in rows[50:] if r[1] not in waits]]
    got = run(sent, "gaps", "6 hours")
    priced = [r if r[1] not in lost else (*r[:3], None, *r[4:]) for r in rows]
    want = run([priced], "whole", None)
    assert [r.idx for r in got] == [r.idx for r in want if r.idx < 57]
    assert [tuple(r)[:-1] for r in got] == [tuple(r)[:-1] for r in want if r.idx < 57]
    assert {r.idx: r.n_missing for r in got if r.n_missing} == {8: 1, 23: 3}
    assert not any(r.n_missing for r in want)


def test_corrections_within_the_horizon_and_bounded_folders(spark, tmp_path):
    """Late and revised candles change the zones; those before the horizon are put aside."""
    candles = walk_candles(spark.read.parquet(f"{DATA}/events.parquet")).where("symbol in ('view', 'click')")
    rows = sorted(candles.collect(), key=lambda r: (r.bar_ts, r.symbol))
    target = SignalStream(spark, str(tmp_path / "out"), TRADING, horizon=60)
    rng, waiting, sent, seen = random.Random(4), [], [], []

    def feed(part):
        target(spark.createDataFrame(part, candles.schema).coalesce(1), len(sent))
        sent.append(part)

    for k in range(0, len(rows), 40):
        # What was held back goes with the next batch.
        part, waiting = waiting, []
        for row in rows[k : k + 40]:
            chance = rng.random()
            if chance < 0.05:
                waiting.append(row)
                continue
            if chance < 0.1:
                waiting.append(row)
                part.append(row.__class__(*row[:2], row.open * 1.01, *row[3:]))
            else:
                part.append(row)
        feed(part)
        seen.append({str(f.relative_to(tmp_path)) for f in (tmp_path / "out").glob("*/*/slot=*")})
    feed(waiting or rows[-1:])
    assert len(sent) > 6 and seen[1] == seen[-1]
    want = Study(candles, TRADING).zones
    got = current_zones(spark, str(tmp_path / "out"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and want.count() > 0
    log = spark.read.parquet(str(tmp_path / "out" / "zones"))
    assert log.where("op = 'retract'").count() > 0
    assert spark.read.parquet(str(tmp_path / "out" / "late")).count() == 0

    # The same batch again changes nothing; candles of long ago are put aside, repeats among them.
    target(spark.createDataFrame(sent[-1], candles.schema), len(sent) - 1)
    assert current_zones(spark, str(tmp_path / "out")).exceptAll(got).count() == 0
    feed([rows[0].__class__(*rows[0][:2], 1.0, *rows[0][3:]), rows[1]])
    late = spark.read.parquet(str(tmp_path / "out" / "late"))
    assert sorted(r.open for r in late.collect()) == sorted([1.0, rows[1].open])
    bars = spark.read.parquet(str(tmp_path / "out" / "bars"))
    numbers = {s: sorted(r.idx for r in bars.collect() if r.symbol == s) for s in ("view", "click")}
    assert all(n == list(range(len(n))) for n in numbers.values())
