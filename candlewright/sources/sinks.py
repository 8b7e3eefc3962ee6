"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_by_symbol(df: DataFrame, path: str, time: str, mode: str = "overwrite") -> None:
    """Parquet in one folder per symbol; used for trades and equity.

    Rows are laid out by symbol and ``time`` first: few files, and a full symbol in several tasks.
    """
    laid_out = df.repartitionByRange("symbol", time)
    laid_out.write.mode(mode).partitionBy("symbol").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch in a folder of its own: a replayed batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_candles(df: DataFrame, path: str, resolution: str = "1m") -> None:
    """Candle history for time-ranged reads: a folder per resolution, symbol and day.

    Days that are written again are replaced; everything else in the table stays.
    """
    dated = df.withColumn("resolution", F.lit(resolution)).withColumn("date", F.to_date("bar_ts"))
    (
        dated.repartitionByRange("symbol", "date")
        .sortWithinPartitions("symbol", "bar_ts")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("resolution", "symbol", "date")
        .parquet(path)
    )
