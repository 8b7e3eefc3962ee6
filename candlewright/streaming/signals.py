"""Zones from a stream of closed candles, corrected where a candle comes late or is revised.

Row windows do not exist on streams, so every micro-batch joins the bars kept from before and
goes through the batch operators. What has to survive between batches is small: per symbol the
bars of the horizon, with the position from which another zone may be triggered after each, and the
zones triggered on them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candlewright.operators.index import bar_index
from candlewright.operators.indicators import LOOKBACK
from candlewright.operators.zones import min_distance_thin, signal_bars, zone_candidates
from candlewright.params import ChunkParams, ZoneParams
from candlewright.schema import CANDLE, CANDLE_COLUMNS, OHLCV, ZONE_COLUMNS
from candlewright.sources.sinks import write_batch

_STATE = f"{CANDLE}, idx bigint, next_trigger bigint, shift bigint, fixed boolean"
_ZONE = "symbol string, side string, trigger_idx bigint, start_idx bigint, top double, bot double"
_CHANGE = f"{_ZONE}, op string, version bigint"


class SignalStream:
    """``foreachBatch`` target. Folders below ``path``: ``zones``, ``bars``, ``late``, and the two
    slots each of ``state`` and ``work``, which batches use in turn.

    ``zones`` is a log of changes: a zone is inserted, or retracted when a candle of the last
    ``horizon`` bars that came late or was revised undoes it; ``version`` is the batch.
    ``current_zones`` gives those that hold. From the earliest changed bar on, zones are found
    again, so that they are the zones of the batch operators over all candles so far.

    ``bars`` holds every new bar once, with the signal it had when it came, numbered in order of
    arrival: a candle that comes late does not open or close a position in the past. ``late`` holds
    candles from before the horizon (repeats of what is no longer kept among them), and candles
    without a symbol or a time. Of two versions of a candle in one batch the greatest by its values counts.
    A batch reads the slot of the batch before and writes its own, so one that is run again gives
    the same rows, and the number of folders does not grow but for the three results.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        params: ZoneParams = ZoneParams(),
        chunks: ChunkParams = ChunkParams(),
        horizon: int = 500,
    ):
        self.spark = spark
        self.path = path
        self.params = params
        self.chunks = chunks
        self.horizon = horizon
        self.back = max(LOOKBACK, params.trend_period) + 2

    def folder(self, name: str) -> str:
        return os.path.join(self.path, name)

    def _slot(self, name: str, batch_id: int) -> str:
        return f"{self.folder(name)}/slot={batch_id % 2}"

    def _write(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        path = self._slot(name, batch_id)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _before(self, name: str, batch_id: int, schema: str) -> DataFrame:
        if batch_id == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._slot(name, batch_id - 1))

    def _judged(self, incoming: DataFrame, state: DataFrame, known: DataFrame) -> DataFrame:
        """Candles once each, with what is known of their symbol and time."""
        single = incoming.groupBy("symbol", "bar_ts").agg(F.max(F.struct(*OHLCV)).alias("new"))
        held = state.select("symbol", "bar_ts", F.struct(*OHLCV).alias("old"))
        beyond = F.coalesce(F.col("bar_ts") <= F.col("edge_ts"), F.lit(False))
        return (
            single.join(known, "symbol", "left")
            .join(held, ["symbol", "bar_ts"], "left")
            .where("old is null or not (old <=> new)")
            .select(
                "symbol",
                "bar_ts",
                "new.*",
                (F.col("symbol").isNull() | F.col("bar_ts").isNull() | beyond).alias("late"),
                F.expr("seen_ts is null or bar_ts > seen_ts").alias("fresh"),
                F.col("old").isNull().alias("added"),
            )
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # The session of a running stream plans without adaptive execution. The many small joins
        # here want it, so the batch is handed over to the session the stream was started from.
        handed = self._write(batch.select(*CANDLE_COLUMNS), "work/incoming", batch_id)
        state = self._before("state/bars", batch_id, _STATE)
        zones = self._before("state/zones", batch_id, _ZONE)
        known = state.groupBy("symbol").agg(
            F.min("idx").alias("first_idx"),
            F.max("bar_ts").alias("seen_ts"),
            F.max("shift").alias("old_shift"),
            F.max(F.when(F.col("fixed"), F.col("bar_ts"))).alias("edge_ts"),
        )
        judged = self._write(self._judged(handed, state, known), "work/judged", batch_id)
        write_batch(judged.where("late").select(*CANDLE_COLUMNS), self.folder("late"), batch_id)

        changed = judged.where("not late")
        touched = changed.select("symbol").distinct()
        same = state.join(touched, "symbol", "left_semi").join(
            changed, ["symbol", "bar_ts"], "left_anti"
        )
        no = F.lit(False)
        merged = same.select(
            *CANDLE_COLUMNS, "next_trigger", no.alias("fresh"), no.alias("added"), no.alias("changed")
        ).unionByName(
            changed.select(*CANDLE_COLUMNS, "fresh", "added", F.lit(True).alias("changed")),
            allowMissingColumns=True,
        )
        first = known.select("symbol", "first_idx", "old_shift")
        numbered = bar_index(merged).join(first, "symbol", "left")
        numbered = numbered.withColumn("idx", F.col("idx") + F.coalesce("first_idx", F.lit(0)))
        bars = self._write(numbered, "work/bars", batch_id)

        moved = F.coalesce("old_shift", F.lit(0)) + F.col("n_late")
        start = bars.groupBy("symbol").agg(
            F.min(F.when(F.col("changed"), F.col("idx"))).alias("since"),
            F.max("idx").alias("last"),
            F.max("old_shift").alias("old_shift"),
            F.count_if(F.col("added") & ~F.col("fresh")).alias("n_late"),
        ).select("symbol", "since", "last", moved.alias("shift"))
        placed = bars.drop("first_idx", "old_shift").join(start, "symbol")
        base = placed.where("idx < since").groupBy("symbol").agg(F.max("next_trigger").alias("base"))
        start = self._write(start.join(base, "symbol", "left"), "work/start", batch_id)

        found = zone_candidates(bars.select(*CANDLE_COLUMNS, "idx"), self.params, self.chunks)
        found = found.join(start.select("symbol", "since", "base"), "symbol")
        found = found.where("trigger_idx >= since and trigger_idx >= coalesce(base, 0)")
        # Positions count from the first changed bar while the distance rule is applied.
        rebased = found.select(*ZONE_COLUMNS, "since").withColumn("trigger_idx", F.col("trigger_idx") - F.col("since"))
        rebased = self._write(rebased, "work/candidates", batch_id)
        thinned = min_distance_thin(rebased, self.params.min_distance, self.chunks)
        thinned = thinned.withColumn("trigger_idx", F.col("trigger_idx") + F.col("since"))
        new = self._write(thinned.select(*ZONE_COLUMNS), "work/zones", batch_id)

        held = zones.join(start.select("symbol", "since"), "symbol")
        old = held.where("trigger_idx >= since").select(*ZONE_COLUMNS)
        gone = old.join(new, ZONE_COLUMNS, "left_anti").withColumn("op", F.lit("retract"))
        come = new.join(old, ZONE_COLUMNS, "left_anti").withColumn("op", F.lit("insert"))
        log = gone.select(*ZONE_COLUMNS, "op").unionByName(come.select(*ZONE_COLUMNS, "op"))
        log = log.withColumn("version", F.lit(batch_id).cast("bigint"))
        write_batch(log, self.folder("zones"), batch_id)

        fresh = bars.where("fresh").select("symbol", "idx", "bar_ts", "close").join(
            start.select("symbol", "shift"), "symbol"
        )
        marked = fresh.join(signal_bars(new, "trigger"), ["symbol", "idx"], "left").select(
            "symbol",
            (F.col("idx") - F.col("shift")).alias("idx"),
            "bar_ts",
            "close",
            "side",
            F.coalesce("n_copies", F.lit(0)).alias("n_copies"),
        )
        write_batch(marked, self.folder("bars"), batch_id)
        self._keep(state, zones, bars, start, new, batch_id)

    def _keep(self, state, zones, bars, start, new, batch_id: int) -> None:
        """State for the next batch; symbols without a change keep theirs."""
        distance, tail_bars = self.params.min_distance, self.horizon + self.back
        tail = bars.drop("old_shift").join(start, "symbol").where(F.col("idx") > F.col("last") - tail_bars)
        earlier = new.join(start.select("symbol", "last"), "symbol")
        earlier = earlier.where(F.col("trigger_idx") <= F.col("last") - tail_bars)
        earlier = earlier.groupBy("symbol").agg(F.max("trigger_idx").alias("earlier"))
        kept = new.select("symbol", F.col("trigger_idx").alias("idx"), F.col("trigger_idx").alias("kept"))
        upto = Window.partitionBy("symbol").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
        newest = F.greatest(F.max("kept").over(upto), F.col("earlier"))
        again = F.coalesce(F.greatest(F.col("base"), newest + distance), F.lit(0))
        truncated = F.col("last") >= tail_bars
        tail = tail.join(earlier, "symbol", "left").join(kept, ["symbol", "idx"], "left").select(
            *CANDLE_COLUMNS,
            "idx",
            F.when(F.col("idx") < F.col("since"), F.col("next_trigger")).otherwise(again).alias("next_trigger"),
            "shift",
            (truncated & (F.col("idx") <= F.col("last") - self.horizon)).alias("fixed"),
        )
        untouched = state.join(start, "symbol", "left_anti")
        self._write(tail.unionByName(untouched), "state/bars", batch_id)
        stay = zones.join(start.select("symbol", "since"), "symbol").where("trigger_idx < since")
        valid = stay.select(*ZONE_COLUMNS).unionByName(new).join(start.select("symbol", "last"), "symbol")
        valid = valid.where(F.col("trigger_idx") > F.col("last") - tail_bars).select(*ZONE_COLUMNS)
        self._write(valid.unionByName(zones.join(start, "symbol", "left_anti")), "state/zones", batch_id)


def current_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zones that hold after all changes in the log below ``path``."""
    log = spark.read.schema(_CHANGE).parquet(f"{path}/zones")
    net = F.sum(F.when(F.col("op") == "insert", 1).otherwise(-1))
    return log.groupBy(*ZONE_COLUMNS).agg(net.alias("_net")).where("_net > 0").select(*ZONE_COLUMNS)


def stream_signals(
    candles: DataFrame,
    path: str,
    checkpoint: str,
    params: ZoneParams = ZoneParams(),
    chunks: ChunkParams = ChunkParams(),
    horizon: int = 500,
):
    """A stream writer that keeps ``path`` up to date; start it with a trigger of choice."""
    target = SignalStream(candles.sparkSession, path, params, chunks, horizon)
    return candles.writeStream.foreachBatch(target.__call__).option("checkpointLocation", checkpoint)
