"""Long histories fetched in slices: the slices to ask for, all of them as one table, what is missing.

Ranges are tables (symbol, start_ts, end_ts); a range holds the instants start_ts <= t < end_ts.
Neighbouring slices share the instant between them, and the later one's candle counts there: the
earlier slice may have met it unfinished. Rows without a symbol, a time or a bound take no part.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewright.operators.scan import running
from candlewright.schema import CANDLE, CANDLE_COLUMNS, OHLCV

_DAY = 86400


def seconds(ts: str) -> Column:
    """Seconds from 1970 of a time without zone, whatever zone the session has."""
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    return day * _DAY + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def instant(value: Column) -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        days=F.floor(value / _DAY).cast("int"), secs=F.pmod(value, F.lit(_DAY))
    )


def slice_plan(ranges: DataFrame, bar_seconds: int = 60, slice_bars: int = 1000) -> DataFrame:
    """Slices of ``slice_bars`` bars, numbered from 0, that cover every range."""
    length = slice_bars * bar_seconds
    known = ranges.select(
        "symbol", seconds("start_ts").alias("_first"), seconds("end_ts").alias("_end")
    ).where("symbol is not null and _first < _end")
    last = F.ceil((F.col("_end") - F.col("_first")) / length) - 1
    numbered = known.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("slice"))
    start = F.col("_first") + F.col("slice") * length
    return numbered.select(
        "symbol",
        "slice",
        instant(start).alias("start_ts"),
        instant(F.least(start + length, "_end")).alias("end_ts"),
    )


def cut_slices(
    candles: DataFrame, ranges: DataFrame, bar_seconds: int = 60, slice_bars: int = 1000
) -> DataFrame:
    """The candles each slice of the plan holds, found by arithmetic, with ``slice``.

    A candle on the instant two slices share is in both. One row per symbol joins in, so a range
    look-up needs no join on times.
    """
    length = slice_bars * bar_seconds
    known = ranges.select(
        "symbol", seconds("start_ts").alias("_first"), seconds("end_ts").alias("_end")
    )
    at = seconds("bar_ts")
    inside = candles.join(known, "symbol").where((at >= F.col("_first")) & (at < F.col("_end")))
    passed = at - F.col("_first")
    own = F.floor(passed / length)
    shared = (passed % length == 0) & (own > 0)
    return inside.select(
        *CANDLE_COLUMNS, F.explode(F.when(shared, F.array(own - 1, own)).otherwise(F.array(own))).alias("slice")
    )


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """All slices below ``path`` (folders ``slice=...``) in one scan."""
    return spark.read.schema(f"{CANDLE}, slice bigint").parquet(path)


def merge_slices(sliced: DataFrame) -> DataFrame:
    """One candle per symbol and time, from the latest slice that has it."""
    newest = sliced.groupBy("symbol", "bar_ts").agg(*[F.max_by(c, "slice").alias(c) for c in OHLCV])
    return newest.select(*CANDLE_COLUMNS)


def backfill_union(slices: Iterable[DataFrame]) -> DataFrame:
    """Slices that are tables of their own, in order of time, as one.

    Every table is a branch of the plan; slices that lie in one folder are better read by ``read_slices``.
    """
    united = None
    for number, part in enumerate(slices):
        tagged = part.select(*CANDLE_COLUMNS, F.lit(number).cast("bigint").alias("slice"))
        united = tagged if united is None else united.unionByName(tagged)
    if united is None:
        raise ValueError("no slices")
    return merge_slices(united)


def _islands(candles: DataFrame, ranges: DataFrame | None, bar_seconds: int) -> DataFrame:
    """Runs of bars without a gap, day by day, with the end of the run before (null for the first).

    Days keep windows short; the end of the run before is carried over days in two levels. A range
    adds a run without bars just before its start and one at its end.
    """
    bars = candles.select("symbol", seconds("bar_ts").alias("_at")).where(
        "symbol is not null and _at is not null"
    )
    if ranges is not None:
        known = ranges.select(
            "symbol", seconds("start_ts").alias("_first"), seconds("end_ts").alias("_end")
        ).where("symbol is not null and _first < _end")
        bars = bars.join(known, "symbol").where("_at >= _first and _at < _end").select("symbol", "_at")
    day = F.floor(F.col("_at") / _DAY)
    in_day = Window.partitionBy("symbol", "_day").orderBy("_at")
    placed = bars.withColumn("_day", day).withColumn("_before", F.lag("_at").over(in_day))
    apart = F.col("_before").isNull() | (F.col("_at") - F.col("_before") > bar_seconds)
    fresh = F.col("_before").isNull() | (F.col("_at") > F.col("_before"))
    runs = (
        placed.withColumn("_fresh", fresh.cast("bigint"))
        .withColumn("_run", F.sum(apart.cast("bigint")).over(in_day))
        .groupBy("symbol", "_day", "_run")
        .agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"), F.sum("_fresh").alias("_bars"))
        .select("symbol", "_from", "_to", "_bars", F.lit(False).alias("_opens"))
    )
    if ranges is not None:
        for edge, opens in ((F.col("_first") - bar_seconds, True), (F.col("_end"), False)):
            mark = known.select(
                "symbol", edge.alias("_from"), edge.alias("_to"),
                F.lit(0).cast("bigint").alias("_bars"), F.lit(opens).alias("_opens"),
            )
            runs = runs.unionByName(mark)
    blocks = runs.withColumn("_block", F.floor(F.col("_from") / (64 * _DAY)))
    return running(
        blocks, ["symbol"], "_block", ["_from", "_to"], {"_left": ("last", F.col("_to"))}, inclusive=False
    )


def coverage(candles: DataFrame, bar_seconds: int = 60) -> DataFrame:
    """Merged ranges that have every bar: symbol, start_ts, end_ts (of the last bar), n_bars."""
    runs = _islands(candles, None, bar_seconds)
    apart = F.col("_left").isNull() | (F.col("_from") - F.col("_left") > bar_seconds)
    numbered = running(
        runs, ["symbol"], "_block", ["_from", "_to"], {"_no": ("sum", apart.cast("bigint"))}
    )
    merged = numbered.groupBy("symbol", "_no").agg(
        F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.sum("_bars").alias("n_bars")
    )
    return merged.select(
        "symbol", instant(F.col("_from")).alias("start_ts"), instant(F.col("_to")).alias("end_ts"), "n_bars"
    )


def gaps(candles: DataFrame, ranges: DataFrame, bar_seconds: int = 60) -> DataFrame:
    """What a backfill of the ranges still lacks: symbol, start_ts, end_ts (exclusive), n_missing.

    A symbol's ranges must not overlap or touch. One without any candle is a single gap.
    """
    runs = _islands(candles, ranges, bar_seconds)
    missing = F.ceil((F.col("_from") - F.col("_left")) / bar_seconds) - 1
    # Nothing is asked for between the end of one range and the start of the next.
    return runs.where("_left is not null and not _opens").select(
        "symbol",
        instant(F.col("_left") + bar_seconds).alias("start_ts"),
        instant(F.col("_from")).alias("end_ts"),
        missing.alias("n_missing"),
    ).where("n_missing > 0")
