"""Bars lie in buckets by symbol and chunk; entries of a crowded chunk go to several tasks."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewright.operators import exits as exit_ops
from candlewright.operators.exits import Lifted, first_exit
from candlewright.params import STUDY, TRADING, ChunkParams, TradeParams
from candlewright.plans.study import Study
from candlewright.session import materialize

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def study(spark):
    from candlewright.sources.ticks import walk_candles

    ticks = spark.read.parquet(f"{DATA}/events.parquet")
    return Study(materialize(walk_candles(ticks, "1h"), "candles"), TRADING, STUDY, ChunkParams(size=64, fan=3))


def moved_bars(df):
    """Exchanges with a scan of the bars below them, but for counts and lists of chunks."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: re.search(r"[A-Za-z(*]", line).start()
    moved, open_exchanges = [], []
    for line in filter(str.strip, lines):
        here = depth(line)
        open_exchanges = [x for x in open_exchanges if x < here]
        if "Exchange" in line:
            open_exchanges.append(here)
        if "FileScan" in line and ".bars_" in line and re.search(r"\bidx#", line):
            moved.append(len(open_exchanges))
    return moved


def test_windows_exits_and_equity_do_not_move_the_bars(study):
    study.zones, study.written_trades  # noqa: B018
    candidates = exit_ops.materialize  # kept to be put back
    plans = [study.indicators, study.equity]
    seen = []

    def spy(df, label):
        seen.append((label, moved_bars(df)))
        return candidates(df, label)

    exit_ops.materialize = spy
    try:
        from candlewright.operators import zones as zone_ops

        found = zone_ops.zone_candidates(study.placed, study.zone_params, study.chunks)
        signals = zone_ops.signal_bars(study.zones)
        first_exit(study.in_place, signals, STUDY, study.chunks)
    finally:
        exit_ops.materialize = candidates
    for df in (found, *plans):
        scans = moved_bars(df)
        assert scans and not any(scans)
    chunks = [moved for label, moved in seen if label == "chunks"]
    assert chunks and all(chunks) and not any(any(m) for m in chunks)
    assert all(not moved for label, moved in seen if label != "chunks")


def test_buckets_hold_every_bar_once(study):
    placed = study.placed
    assert study.in_place.count() == study.candles.count()
    assert placed.where("not own").count() > 0
    assert study.in_place.where("chunk <> idx div 64").count() == 0


def test_crowded_chunk_is_dealt_over_several_tasks(spark, monkeypatch):
    """A thousand entries, all ended by one bar of the last chunk."""
    n = 1000
    closes = [100 + 0.001 * k for k in range(n)] + [1.0] * 24
    rows = [("s", k, c) for k, c in enumerate(closes)]
    at = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, idx)")
    bars = spark.createDataFrame(rows, "symbol string, idx bigint, close double").withColumn("bar_ts", at)
    marks = spark.createDataFrame([("s", k, "bull", 1) for k in range(1, n)], "symbol string, idx bigint, side string, n_copies bigint")
    groups = []
    met = exit_ops._met

    def spy(mine, entries, scan, result):
        df = met(mine, entries, scan, result)
        plan = df._jdf.queryExecution().analyzed().toString()
        groups.append("part" in plan)
        return df

    want = first_exit(bars, marks, TradeParams(), ChunkParams(size=32, fan=8)).orderBy("entry_idx").collect()
    monkeypatch.setattr(exit_ops, "DEALT", 50)
    monkeypatch.setattr(exit_ops, "_met", spy)
    dealt = first_exit(bars, marks, TradeParams(), ChunkParams(size=32, fan=8))
    got = dealt.withColumn("task", F.spark_partition_id()).orderBy("entry_idx").collect()
    assert [tuple(r)[:-1] for r in got] == [tuple(r) for r in want]
    assert {r["exit_idx"] for r in got} == {n} and len(got) == n - 1
    assert all(groups) and len({r["task"] for r in got}) > 1


def test_long_histories_need_several_levels(spark):
    rng = np.random.default_rng(9)
    closes = 100 * np.exp(np.cumsum(rng.normal(0, 0.0004, 3000)))
    at = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, idx)")
    rows = [("s", k, float(c)) for k, c in enumerate(closes)]
    bars = spark.createDataFrame(rows, "symbol string, idx bigint, close double").withColumn("bar_ts", at)
    signs = [("s", int(k), "bull" if rng.random() < 0.5 else "bear", int(rng.integers(1, 3))) for k in rng.choice(np.arange(1, 3000), 12, replace=False)]
    marks = spark.createDataFrame(signs, "symbol string, idx bigint, side string, n_copies bigint")
    whole, small = (
        first_exit(bars, marks, TradeParams(), cut).orderBy("entry_idx").collect()
        for cut in (ChunkParams(), ChunkParams(size=16, fan=2))
    )
    assert whole == small and len(whole) == 12


def test_lifting_finds_the_first_value():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 8, 33, 100):
        values = np.where(rng.random(n) < 0.1, np.nan, rng.integers(0, 20, n).astype(float))
        lifted = Lifted(values)
        starts, bounds = rng.integers(0, n + 1, 200), rng.integers(-1, 21, 200).astype(float)
        bounds[:5] = np.nan
        got = lifted.first_at_most(starts, bounds)
        for s, b, g in zip(starts, bounds, got):
            hits = [k for k in range(s, n) if values[k] <= b]
            assert g == (hits[0] if hits else max(s, n))
        ends = np.minimum(starts + rng.integers(0, 9, 200), n)
        for s, e, g in zip(starts, ends, lifted.least(starts, ends)):
            inside = [v for v in values[s:e] if v == v]
            assert g == (min(inside) if inside else np.inf)
