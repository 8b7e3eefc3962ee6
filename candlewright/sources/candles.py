"""Reading candle tables: files, JSON envelopes, slices, windows of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from candlewright.schema import CANDLE, CANDLE_COLUMNS, OHLCV
from candlewright.session import materialize

_TEXT_FIELDS = "open string, high string, low string, close string, volume string"


def candle_folders(
    spark: SparkSession, path: str, fmt: str = "parquet", resolution: str = "1m"
) -> DataFrame:
    """The same table with the folder's ``date``."""
    table = spark.read.schema(f"{CANDLE}, resolution string, date date").format(fmt).load(path)
    return table.where(F.col("resolution") == resolution)


def read_candles(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    resolution: str = "1m",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Candles of one resolution out of a table that ``write_candles`` wrote.

    A range of time reads only the folders of its days.
    """
    picked = candle_folders(spark, path, fmt, resolution)
    if start is not None:
        picked = picked.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        picked = picked.where(F.col("date") <= F.lit(end).cast("date"))
    return candle_scan(picked, None, start, end)


def candle_scan(
    candles: DataFrame,
    symbol: str | None = None,
    start: str | None = None,
    end: str | None = None,
    warmup_seconds: int = 0,
) -> DataFrame:
    """Candles of one symbol with start <= bar_ts <= end.

    A filter on time does not pass below a window, so indicators over a range need it here:
    ``warmup_seconds`` widens the start by the lookback.
    """
    picked = candles if symbol is None else candles.where(F.col("symbol") == symbol)
    if start is not None:
        first = F.lit(start).cast("timestamp_ntz") - F.make_interval(secs=F.lit(warmup_seconds))
        picked = picked.where(F.col("bar_ts") >= first)
    if end is not None:
        picked = picked.where(F.col("bar_ts") <= F.lit(end).cast("timestamp_ntz"))
    return picked.select(*CANDLE_COLUMNS)


def to_number(value: Column) -> Column:
    """Text to double; bad text and NaN are missing."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


# Epoch seconds beyond the year 9999 are no times; milliseconds taken for seconds end up there.
_LAST_SECOND = 253402300799


def read_time(raw: Column) -> Column:
    """Epoch seconds as text or number to (seconds, reason): one of the two is null.

    A whole number is a time, also written as text or with a zero fraction. Everything else keeps
    no time and says why.
    """
    written = raw.cast("string")
    number = written.try_cast("decimal(38,6)")
    reason = (
        F.when(written.isNull(), "missing")
        .when(number.isNull(), "not a number")
        .when(F.abs(number) > _LAST_SECOND, "out of range")
        .when(number != F.floor(number), "fractional")
    )
    whole = F.when(reason.isNull(), number).try_cast("bigint")
    return F.struct(whole.alias("seconds"), reason.alias("reason"))


def _raw_time(raw: DataFrame) -> Column:
    names = [c for c in ("time", "timestamp") if c in raw.columns]
    return F.coalesce(*[F.col(c).cast("string") for c in names])


def candle_normalize(raw: DataFrame) -> DataFrame:
    """Raw rows (symbol, ``time`` or ``timestamp`` in epoch seconds, five fields) to candles.

    A time that cannot be read is missing here and kept as it came by ``time_rejects``.
    """
    # Epoch seconds are UTC whatever zone the session shows times in.
    at = F.timestamp_seconds(read_time(_raw_time(raw))["seconds"])
    return raw.select(
        "symbol",
        F.to_utc_timestamp(at, F.current_timezone()).cast("timestamp_ntz").alias("bar_ts"),
        *[to_number(F.col(c).cast("string")).alias(c) for c in OHLCV],
    )


def time_rejects(raw: DataFrame) -> DataFrame:
    """Raw rows whose time cannot be read: the time as it came, the reason, and the five fields."""
    return raw.select(
        "symbol",
        _raw_time(raw).alias("raw_time"),
        read_time(_raw_time(raw))["reason"].alias("reason"),
        *[to_number(F.col(c).cast("string")).alias(c) for c in OHLCV],
    ).where("reason is not null")


def observed_intake(raw: DataFrame, name: str | Observation) -> DataFrame:
    """Raw rows as candles, those without a symbol or a readable time left out, and counted on the way.

    The counts come with the pass that reads the rows: by ``Observation.get`` in batch, by the progress
    of a stream under its name. ``rows_in`` is the sum of ``kept``, ``no_symbol`` and ``bad_time``, where a
    row without either counts under its time; ``bad_numbers`` counts kept rows with a value lost.
    """
    fields = [F.col(c).cast("string") for c in OHLCV]
    lost = sum((to_number(f).isNull() & f.isNotNull()).cast("int") for f in fields) > 0
    bad = read_time(_raw_time(raw))["reason"].isNotNull()
    marked = raw.withColumns(
        {"_bad": bad, "_none": ~bad & F.col("symbol").isNull(), "_lost": lost}
    )
    kept = ~F.col("_bad") & ~F.col("_none")
    counted = marked.observe(
        name,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(kept).alias("kept"),
        F.count_if("_none").alias("no_symbol"),
        F.count_if("_bad").alias("bad_time"),
        F.count_if(kept & F.col("_lost")).alias("bad_numbers"),
    )
    return candle_normalize(counted.where(kept).drop("_bad", "_none", "_lost"))


def parse_envelopes(responses: DataFrame, body: str = "body") -> DataFrame:
    """Responses with ``_e``: success, error and the list of bars, each as it came (a variant).

    A bar of an odd shape spoils neither its response nor its neighbours.
    """
    opened = F.try_parse_json(body)
    return responses.withColumn(
        "_e",
        F.struct(
            F.try_variant_get(opened, "$.success", "boolean").alias("success"),
            F.try_variant_get(opened, "$.error", "string").alias("error"),
            F.try_variant_get(opened, "$.result", "array<variant>").alias("bars"),
        ),
    )


def envelope_rows(responses: DataFrame, body: str = "body") -> DataFrame:
    """Raw rows out of JSON envelopes (symbol, body), every field as text; failed ones give none."""
    bars = (
        parse_envelopes(responses, body)
        .where("_e.success")
        .select("symbol", F.explode("_e.bars").alias("_bar"))
    )
    fields = ["time", "timestamp", *OHLCV]
    return bars.select(
        "symbol", *[F.try_variant_get("_bar", f"$.{c}", "string").alias(c) for c in fields]
    )


def candle_envelope(responses: DataFrame, body: str = "body") -> DataFrame:
    """Candles out of JSON envelopes (symbol, body); failed and empty ones give no rows."""
    return candle_normalize(envelope_rows(responses, body))


def envelope_errors(responses: DataFrame, body: str = "body") -> DataFrame:
    """Envelopes that failed, or that could not be read at all, with their error."""
    failed = ~F.coalesce(F.col("_e.success"), F.lit(False))
    return (
        parse_envelopes(responses, body)
        .where(failed)
        .select("symbol", F.coalesce("_e.error", F.lit("unreadable response")).alias("error"))
    )


def _newest(candles: DataFrame, value: str) -> DataFrame:
    """The newest value of each symbol, written first.

    A written table has a known size: Spark then broadcasts it if it is small and so leaves the
    candles where they are, and joins by shuffle if there are very many symbols.
    """
    return materialize(candles.groupBy("symbol").agg(F.max(value).alias("_newest")), "newest")


def latest_window(candles: DataFrame, limit: int = 500, bar_seconds: int = 60) -> DataFrame:
    """Candles of the last ``limit`` bar lengths before each symbol's newest candle."""
    newest = _newest(candles, "bar_ts")
    first = F.col("_newest") - F.make_interval(secs=F.lit(limit * bar_seconds))
    return candles.join(newest, "symbol").where(F.col("bar_ts") >= first).select(*CANDLE_COLUMNS)


def latest_window_in_folders(table: DataFrame, limit: int = 500, bar_seconds: int = 60) -> DataFrame:
    """``latest_window`` of a table from ``candle_folders``, out of each symbol's newest folders only.

    The newest day of a symbol is found without reading a column, its newest candle in that folder. The
    (symbol, date) pairs that the window needs are a small table; joined on the folders' own columns,
    they tell the scan which folders to open (dynamic partition pruning): those of a wanted symbol on a day
    that some symbol's window needs, for Spark prunes each column by itself. A symbol whose newest folder has no
    candle with a time gives no rows.
    """
    keys = ["symbol", "date"]
    days = table.groupBy("symbol").agg(F.max("date").alias("date"))
    days = materialize(days, "newest_days").where("date is not null")
    # Spark prunes by a side that has a filter of its own.
    known = days.where(F.col("date") >= F.lit("0001-01-01").cast("date"))
    newest = table.join(known, keys).groupBy("symbol").agg(F.max("bar_ts").alias("_newest"))
    first = F.col("_newest") - F.make_interval(secs=F.lit(limit * bar_seconds))
    wanted = newest.where("_newest is not null").select(
        "symbol",
        first.alias("_first"),
        F.explode(F.sequence(F.to_date(first), F.to_date("_newest"))).alias("date"),
    )
    wanted = materialize(wanted, "wanted_days").where(F.col("date") >= F.lit("0001-01-01").cast("date"))
    return table.join(wanted, keys).where("bar_ts >= _first").select(*CANDLE_COLUMNS)


def latest_bars(candles: DataFrame, limit: int = 500) -> DataFrame:
    """The last ``limit`` candles of each symbol, however far back they reach.

    Every task drops all but its own last ``limit`` rows of a symbol before the shuffle.
    """
    backwards = Window.partitionBy("symbol").orderBy(F.desc("bar_ts"))
    ranked = candles.withColumn("_back", F.row_number().over(backwards))
    return ranked.where(F.col("_back") <= limit).select(*CANDLE_COLUMNS)


def lookback_days(candles: DataFrame, days: int, as_of: str) -> DataFrame:
    """Candles of the ``days`` days up to ``as_of`` (no wall clock)."""
    end = F.lit(as_of).cast("timestamp_ntz")
    start = end - F.make_interval(days=F.lit(days))
    return candles.where((F.col("bar_ts") >= start) & (F.col("bar_ts") <= end))


def head_tail(candles: DataFrame, n: int = 5) -> DataFrame:
    """The first and last ``n`` candles in time."""
    head = candles.orderBy("bar_ts", "symbol").limit(n).withColumn("part", F.lit("head"))
    tail = candles.orderBy(F.desc("bar_ts"), F.desc("symbol")).limit(n)
    return head.unionByName(tail.withColumn("part", F.lit("tail")))


CSV = "timestamp string, " + _TEXT_FIELDS


def read_candle_csv(spark: SparkSession, path: str, symbol: str | Column | None = None) -> DataFrame:
    """Headered CSV files; ``symbol`` names the table, or is a Column such as a path part.

    Without it the symbol is that of the folders (``symbol=...``) below ``path``: a filter on it
    reads only those folders. Rows whose time or numbers cannot be read keep a null there.
    """
    in_folders = symbol is None
    name = F.col("symbol") if in_folders else F.lit(symbol) if isinstance(symbol, str) else symbol
    schema = f"{CSV}, symbol string" if in_folders else CSV
    raw = spark.read.schema(schema).option("mode", "PERMISSIVE").csv(path, header=True)
    return raw.select(
        name.alias("symbol"),
        F.col("timestamp").try_cast("timestamp_ntz").alias("bar_ts"),
        *[to_number(F.col(c)).alias(c) for c in OHLCV],
    )


def candle_rejects(candles: DataFrame) -> DataFrame:
    """Rows that name no time or no symbol."""
    return candles.where("bar_ts is null or symbol is null")


def history_page(
    table: DataFrame, key: str, after: int | None = None, page_size: int = 100, **equals
) -> DataFrame:
    """One page of a table in key order, from the first key beyond ``after``."""
    page = table
    for column, value in equals.items():
        wanted = F.col(column)
        page = page.where(wanted.isin(*value) if isinstance(value, (list, tuple)) else wanted == value)
    if after is not None:
        page = page.where(F.col(key) > after)
    return page.orderBy(key).limit(page_size)


def page_cursor(page: DataFrame, key: str, page_size: int = 100) -> DataFrame:
    """Rows of a page and the key the next one goes on from, null after a page that is not full."""
    full = F.count(F.lit(1)) == page_size
    return page.agg(
        F.count(F.lit(1)).alias("n_rows"), F.when(full, F.max(key)).alias("next_after")
    )
