"""Time the headline queries and print one JSON line.

Candles are built once from the ticks and written, as a user would keep them; every query then
starts from that table and repeats all of its own work. Each query runs once untimed first.
BENCH_SF_DIR, BENCH_CPUS and BENCH_RESOLUTION choose data, cores and bar length.
BENCH_CANDLES names a folder with a candle table to use instead.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from candlewright.operators import stats  # noqa: E402
from candlewright.params import STUDY, TRADING  # noqa: E402
from candlewright.plans.study import Study  # noqa: E402
from candlewright.session import materialize  # noqa: E402
from candlewright.sources.ticks import resample_candles, walk_candles  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    resolution = os.environ.get("BENCH_RESOLUTION", "15m")
    given = os.environ.get("BENCH_CANDLES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(4 * int(cpus)) if given else cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if given:
        candles = spark.read.parquet(given)
    else:
        candles = materialize(walk_candles(events, resolution), "candles")
    n_bars = candles.count()

    def run(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    def fresh() -> Study:
        return Study(candles, TRADING, STUDY)

    steps = {
        "candles_from_ticks": lambda: run(walk_candles(events, resolution)),
        "resample": lambda: run(resample_candles(candles, "4h")),
        "indicators": lambda: run(fresh().indicators),
        "order_blocks": lambda: run(fresh().zones),
        "trades": lambda: run(fresh().trades),
        "equity": lambda: run(fresh().equity),
        "trade_report": lambda: run(fresh().report),
        "candle_summary": lambda: run(stats.candle_summary(candles)),
    }
    seconds = {}
    for name, step in steps.items():
        if not given:
            step()
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": given or os.path.basename(sf_dir.rstrip("/")),
                "bars": n_bars,
                "bars_per_second": {
                    name: round(n_bars / seconds[name])
                    for name in ("indicators", "order_blocks", "trades")
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
