"""First exit of every possible entry: trailing stop, opposite signal or end of data.

The exit of an entry depends on its bar and side only, so all of them are resolved at once.

1. Chunk by chunk, next to the bars. The trailing stop that hits first after a bar does so whatever
   was entered before, so one backward pass gives it for every bar; the bar that reaches an entry's
   first stop is found by binary lifting over minima, for all entries together. Each chunk also leaves
   a summary: low, high, the first trailing hit inside, the first signal of each side, and the bars
   that set a new low or high.
2. Entries that outlive their chunk look for the chunk that ends them among the summaries, in groups of
   chunks, then groups of groups, as many levels as the longest history needs.
3. The chunk that ends an entry is not read again: the bar is found in its summary, where the lows so
   far fall step by step.

Where many entries meet one group or chunk they are dealt over several tasks, each with the same
summaries. No entry is paired with a bar, and no entry has a loop turn of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewright.operators.scan import div
from candlewright.params import ChunkParams, TradeParams
from candlewright.session import materialize

STOP, OPPOSITE = 1, 2
#: Entries that look for their end in one task.
DEALT = 1 << 16

_POINT = "struct<pos:bigint,price:double,ts:timestamp_ntz,copies:bigint>"
_ENTRY = (
    "symbol string, block bigint, entry bigint, side int, n_copies bigint, entry_price double, "
    "entry_ts timestamp_ntz, level double, hit bigint"
)
_EXIT = f"{_ENTRY}, hit_kind int, hit_copies bigint, hit_price double, hit_ts timestamp_ntz"
_SUMMARY = (
    f"lo double, hi double, falls {_POINT}, climbs {_POINT}, bull {_POINT}, bear {_POINT}, "
    f"newest {_POINT}, lows array<{_POINT}>, highs array<{_POINT}>"
)
#: What an entry that lands in a chunk needs to know of it.
_PARTS = ["lows", "highs", "falls", "climbs", "bull", "bear"]
_TIME = pa.timestamp("us")
_POINT_TYPE = pa.struct(
    [("pos", pa.int64()), ("price", pa.float64()), ("ts", _TIME), ("copies", pa.int64())]
)
_ENTRY_FIELDS = [
    ("symbol", pa.string()),
    ("block", pa.int64()),
    ("entry", pa.int64()),
    ("side", pa.int32()),
    ("n_copies", pa.int64()),
    ("entry_price", pa.float64()),
    ("entry_ts", _TIME),
    ("level", pa.float64()),
    ("hit", pa.int64()),
]
_EXIT_FIELDS = [
    *_ENTRY_FIELDS,
    ("hit_kind", pa.int32()),
    ("hit_copies", pa.int64()),
    ("hit_price", pa.float64()),
    ("hit_ts", _TIME),
]
_CHUNK_FIELDS = [
    *_EXIT_FIELDS,
    ("lo", pa.float64()),
    ("hi", pa.float64()),
    *[(name, _POINT_TYPE) for name in ("falls", "climbs", "bull", "bear", "newest")],
    ("lows", pa.list_(_POINT_TYPE)),
    ("highs", pa.list_(_POINT_TYPE)),
]


def initial_stop(price: Column, side: Column, stop_pct: float) -> Column:
    """Long: price less ``stop_pct``; short: price plus it. ``side`` is 1 or -1."""
    return F.when(side > 0, price * (1 - stop_pct)).otherwise(price * (1 + stop_pct))


class Lifted:
    """Minima over runs of 1, 2, 4, ... values; missing ones count as infinite."""

    def __init__(self, values: np.ndarray):
        self.runs = [np.where(np.isnan(values), np.inf, values)]
        while 2 << (len(self.runs) - 1) <= len(values):
            finer, width = self.runs[-1], 1 << (len(self.runs) - 1)
            self.runs.append(np.minimum(finer[:-width], finer[width:]))

    def first_at_most(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """First position from ``start`` with a value up to ``bound``, else the length."""
        at = start.copy()
        bound = np.where(np.isnan(bound), -np.inf, bound)
        n = len(self.runs[0])
        for power in range(len(self.runs) - 1, -1, -1):
            least, width = self.runs[power], 1 << power
            inside = at + width <= n
            clear = inside & (least[np.where(inside, at, 0)] > bound)
            at = np.where(clear, at + width, at)
        return at

    def least(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minimum from ``start`` up to, not with, ``end``; infinite where that is empty."""
        width = np.maximum(end - start, 1)
        power = np.minimum(np.log2(width).astype(np.int64), len(self.runs) - 1)
        out = np.full(len(start), np.inf)
        for p in np.unique(power):
            mine = (power == p) & (end > start)
            runs = self.runs[p]
            out[mine] = np.minimum(runs[start[mine]], runs[end[mine] - (1 << p)])
        return out


class Path:
    """Prices of a run of bars, or lows and highs of a run of chunks, seen by one side.

    Written for longs; shorts pass mirrored prices.
    """

    def __init__(self, lows: np.ndarray, highs: np.ndarray, factor: float, inside: np.ndarray):
        n = len(lows)
        self.n, self.factor = n, factor
        self.lows, self.tops = Lifted(lows), Lifted(-highs)
        after = np.arange(1, n + 1)
        falls = np.append(self.lows.first_at_most(after, factor * highs), n)
        falls[:n] = np.where(inside, np.minimum(falls[:n], after - 1), falls[:n])
        #: First trailing hit of anything open at the start of a row.
        self.trail = np.minimum.accumulate(falls[::-1])[::-1]

    def stop(self, start: np.ndarray, level: np.ndarray) -> np.ndarray:
        """First row from ``start`` where a stop at ``level`` that trails the highs is hit, or n."""
        return np.minimum(self.lows.first_at_most(start, level), self.trail[start])

    def raised(self, start: np.ndarray, end: np.ndarray, level: np.ndarray) -> np.ndarray:
        """The level after the highs of the rows from ``start`` up to, not with, ``end``."""
        top = -self.tops.least(start, end)
        return np.fmax(level, np.where(np.isinf(top), np.nan, self.factor * top))


def _factors(params: TradeParams) -> dict[int, float]:
    return {1: 1 - params.trail_pct, -1: 1 + params.trail_pct}


def _next_of(rows: np.ndarray, n: int) -> np.ndarray:
    """For every start 0..n: the first of ``rows`` at or after it, or n."""
    out = np.full(n + 1, n, np.int64)
    out[rows] = rows
    return np.minimum.accumulate(out[::-1])[::-1]


def _points(pos, price, ts: pa.Array, copies=None) -> pa.StructArray:
    none = pa.nulls(len(pos), pa.int64())
    return pa.StructArray.from_arrays(
        [
            pa.array(pos, pa.int64()),
            pa.array(price, pa.float64()),
            ts,
            none if copies is None else pa.array(copies, pa.int64()),
        ],
        fields=list(_POINT_TYPE),
    )


def _chunk_scan(params: TradeParams):
    """Per chunk: the exits of its signals as entries, and one row with its summary."""
    factors = _factors(params)
    first_stop = {1: 1 - params.stop_pct, -1: 1 + params.stop_pct}
    schema = pa.schema(_CHUNK_FIELDS)

    def scan(key, bars: pa.Table, marks: pa.Table) -> pa.Table:
        if not bars.num_rows:
            return schema.empty_table()
        bars = bars.take(pa.array(np.argsort(bars["pos"].to_numpy(), kind="stable")))
        pos, price = bars["pos"].to_numpy(), bars["price"].to_numpy().astype(np.float64)
        ts = bars["ts"].combine_chunks()
        n = len(pos)
        at = np.searchsorted(pos, marks["pos"].to_numpy())
        known = pos[np.minimum(at, n - 1)] == marks["pos"].to_numpy()
        marks, at = marks.filter(pa.array(known)), at[known]
        side, copies = marks["side"].to_numpy(), marks["n_copies"].to_numpy()
        symbol, block = key[0].as_py(), key[1].as_py()

        with np.errstate(invalid="ignore"):
            inside = {s: s * price <= s * price * factors[s] for s in (1, -1)}
            paths = {s: Path(s * price, s * price, factors[s], inside[s]) for s in (1, -1)}
            copies_at = np.zeros(n + 1, np.int64)
            copies_at[at] = copies
            signals = {s: _next_of(at[side == s], n) for s in (1, -1)}
            hit, kind = np.full(len(at), n, np.int64), np.zeros(len(at), np.int32)
            level = np.zeros(len(at))
            for s in (1, -1):
                own = np.flatnonzero(side == s)
                start = at[own] + 1
                stop_at = s * price[at[own]] * first_stop[s]
                stop, against = paths[s].stop(start, stop_at), signals[-s][start]
                hit[own] = np.minimum(stop, against)
                kind[own] = np.where(stop <= against, STOP, OPPOSITE)
                level[own] = s * paths[s].raised(start, np.minimum(hit[own] + 1, n), stop_at)
            lo, hi = np.fmin.reduce(price), np.fmax.reduce(price)
            lows = price < np.append(np.inf, np.fmin.accumulate(price)[:-1])
            highs = price > np.append(-np.inf, np.fmax.accumulate(price)[:-1])
            for new in (lows, highs):  # the first bar with a price sets both
                new[np.flatnonzero(~np.isnan(price))[:1]] = True

        missing = hit == n
        taken = pa.array(np.where(missing, 0, hit), mask=missing)
        entries = {
            "symbol": pa.array([symbol] * len(at), pa.string()),
            "block": pa.array(np.full(len(at), block), pa.int64()),
            "entry": marks["pos"].combine_chunks(),
            "side": marks["side"].combine_chunks(),
            "n_copies": marks["n_copies"].combine_chunks(),
            "entry_price": pa.array(price[at], from_pandas=True),
            "entry_ts": ts.take(pa.array(at)),
            "level": pa.array(level, from_pandas=True),
            "hit": pa.array(np.where(missing, -1, pos[np.minimum(hit, n - 1)])),
            "hit_kind": pa.array(np.where(missing, 0, kind), pa.int32()),
            "hit_copies": pa.array(np.where(missing | (kind == STOP), 0, copies_at[hit])),
            "hit_price": pa.array(price, from_pandas=True).take(taken),
            "hit_ts": ts.take(taken),
        }

        def point(row: int) -> pa.Array:
            if row >= n:
                return pa.nulls(1, _POINT_TYPE)
            return _points([pos[row]], pa.array([price[row]], from_pandas=True), ts[row : row + 1], [copies_at[row]])

        def steps(new: np.ndarray) -> pa.Array:
            rows = np.flatnonzero(new)
            held = _points(pos[rows], price[rows], ts.take(pa.array(rows)))
            return pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), held)

        summary = {
            "symbol": pa.array([symbol], pa.string()),
            "block": pa.array([block], pa.int64()),
            "lo": pa.array([lo], from_pandas=True),
            "hi": pa.array([hi], from_pandas=True),
            "falls": point(paths[1].trail[0]),
            "climbs": point(paths[-1].trail[0]),
            "bull": point(signals[1][0]),
            "bear": point(signals[-1][0]),
            "newest": point(n - 1),
            "lows": steps(lows),
            "highs": steps(highs),
        }
        tables = []
        for columns, size in ((entries, len(at)), (summary, 1)):
            held = [columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in schema]
            tables.append(pa.table(held, schema=schema))
        return pa.concat_tables(tables)

    return scan


def _unit_scan(params: TradeParams):
    """Per group of chunks (or of groups): which of them ends an entry that is open after ``after``."""
    factors = _factors(params)
    schema = pa.schema(_ENTRY_FIELDS)

    def scan(key, units: pa.Table, waiting: pa.Table) -> pa.Table:
        if not units.num_rows or not waiting.num_rows:
            return schema.empty_table()
        units = units.take(pa.array(np.argsort(units["unit"].to_numpy(), kind="stable")))
        unit = units["unit"].to_numpy()
        n = len(unit)
        lo, hi = (units[c].to_numpy().astype(np.float64) for c in ("lo", "hi"))
        flag = {c: units[c].to_numpy() for c in ("falls", "climbs", "bull", "bear")}
        side = waiting["side"].to_numpy()
        given = waiting["level"].to_numpy().astype(np.float64)
        start = np.searchsorted(unit, waiting["after"].to_numpy(), "right")
        hit, level = np.full(len(side), n, np.int64), np.zeros(len(side))
        with np.errstate(invalid="ignore"):
            for s, low, high, falls, against in (
                (1, lo, hi, flag["falls"], flag["bear"]),
                (-1, -hi, -lo, flag["climbs"], flag["bull"]),
            ):
                own = np.flatnonzero(side == s)
                path = Path(low, high, factors[s], falls)
                ends = _next_of(np.flatnonzero(against), n)[start[own]]
                hit[own] = np.minimum(path.stop(start[own], s * given[own]), ends)
                # The level on arrival at that unit, not after it.
                level[own] = s * path.raised(start[own], hit[own], s * given[own])
        found = np.where(hit < n, unit[np.minimum(hit, n - 1)], -1)
        done = {"level": pa.array(level, from_pandas=True), "hit": pa.array(found)}
        return pa.table([done[f.name] if f.name in done else waiting[f.name] for f in schema], schema=schema)

    return scan


def _landing(params: TradeParams):
    """Per chunk: the bar that ends each entry that arrives with a level, out of the summary."""
    factors = _factors(params)
    schema = pa.schema(_EXIT_FIELDS)

    def scan(key, chunk: pa.Table, arrived: pa.Table) -> pa.Table:
        if not chunk.num_rows or not arrived.num_rows:
            return schema.empty_table()
        one = chunk.slice(0, 1)
        steps = {c: one[c].combine_chunks().flatten() for c in ("lows", "highs")}
        first = {c: one[c].combine_chunks() for c in ("falls", "climbs", "bull", "bear")}
        # Every bar that may end an entry, once: new lows and highs, and the four first events.
        points = pa.concat_arrays([*steps.values(), *first.values()])
        at = points.flatten()[0].to_numpy(zero_copy_only=False).astype(np.float64)
        n_lows, n_highs = len(steps["lows"]), len(steps["highs"])
        last = n_lows + n_highs
        never = len(points)
        at = np.append(np.where(np.isnan(at), np.inf, at), np.inf)
        prices = {c: steps[c].flatten()[1].to_numpy() for c in steps}
        side = arrived["side"].to_numpy()
        given = arrived["level"].to_numpy().astype(np.float64)
        which, kind = np.full(len(side), never), np.zeros(len(side), np.int32)
        level = np.zeros(len(side))
        for s, falling, offset, falls, against, rising, from_ in (
            (1, "lows", 0, last, last + 3, "highs", n_lows),
            (-1, "highs", n_lows, last + 1, last + 2, "lows", 0),
        ):
            own = np.flatnonzero(side == s)
            bound = np.where(np.isnan(given[own]), -np.inf, s * given[own])
            step = np.searchsorted(-s * prices[falling], -bound)
            reached = np.where(step < len(prices[falling]), offset + step, never)
            stop = np.where(at[reached] <= at[falls], reached, falls)
            which[own] = np.where(at[stop] <= at[against], stop, against)
            kind[own] = np.where(at[stop] <= at[against], STOP, OPPOSITE)
            # The best price up to the exit is the last step the other way.
            seen = np.searchsorted(at[from_ : from_ + len(prices[rising])], at[which[own]], "right") - 1
            best = np.where(seen >= 0, prices[rising][np.maximum(seen, 0)], np.nan) if len(prices[rising]) else np.nan
            level[own] = s * np.fmax(s * given[own], factors[s] * s * best)
        hit, price, ts, copies = points.take(pa.array(which, mask=which == never)).flatten()
        columns = {
            "level": pa.array(level, from_pandas=True),
            "hit": hit,
            "hit_kind": pa.array(kind),
            "hit_copies": pa.array(
                np.where(kind == OPPOSITE, copies.fill_null(0).to_numpy(zero_copy_only=False), 0),
                pa.int64(),
            ),
            "hit_price": price,
            "hit_ts": ts,
        }
        return pa.table([columns[f.name] if f.name in columns else arrived[f.name] for f in schema], schema=schema)

    return scan


def _met(rows: DataFrame, entries: DataFrame, scan, result: str) -> DataFrame:
    """Run ``scan`` on the rows and entries of each (symbol, block).

    Entries of a crowded block are dealt over several groups, each with all rows of the block.
    """
    keys = ["symbol", "block"]
    parts = entries.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / DEALT).alias("parts"))
    mine = rows.join(parts, keys).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    )
    theirs = entries.join(parts, keys).withColumn(
        "part", F.pmod(F.xxhash64("entry", "side"), F.col("parts"))
    )
    # Both sides may stem from one table; new names keep their columns apart.
    theirs = theirs.toDF(*theirs.columns)
    dealt = [*keys, "part"]
    return mine.groupBy(*dealt).cogroup(theirs.groupBy(*dealt)).applyInArrow(scan, result)


def _coarser(units: DataFrame, fan: int, params: TradeParams) -> DataFrame:
    """One row per group of ``fan`` units: low, high, signals, and whether it stops out a trade."""
    group = div(F.col("unit"), fan)
    before = Window.partitionBy("symbol", group).orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    falls = F.col("lo") <= F.max("hi").over(before) * (1 - params.trail_pct)
    climbs = F.col("hi") >= F.min("lo").over(before) * (1 + params.trail_pct)
    marked = units.select(
        "symbol",
        group.alias("unit"),
        "lo",
        "hi",
        "bull",
        "bear",
        (F.col("falls") | F.coalesce(falls, F.lit(False))).alias("falls"),
        (F.col("climbs") | F.coalesce(climbs, F.lit(False))).alias("climbs"),
    )
    return marked.groupBy("symbol", "unit").agg(
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        *[F.bool_or(c).alias(c) for c in ("falls", "climbs", "bull", "bear")],
    )


def _open_after(entries: DataFrame, after: Column, block: Column) -> DataFrame:
    """Entries that look for their end among the units of ``block`` after ``after``."""
    names = [name for name, _ in _ENTRY_FIELDS if name not in ("block", "hit")]
    return entries.select(*names, block.cast("bigint").alias("block"), after.cast("bigint").alias("after"))


def first_exit(
    indexed: DataFrame,
    signals: DataFrame,
    params: TradeParams = TradeParams(),
    chunks: ChunkParams = ChunkParams(),
) -> DataFrame:
    """The exit of every signal if it were entered at its bar's close.

    ``signals`` holds (symbol, idx, side, n_copies), at most one side per bar. The result has
    entry and exit price and time, the stop as last ratcheted, the kind of exit, and
    ``next_idx``: the first bar on which another entry may follow. Bars that have a ``chunk`` are
    taken chunk by chunk as they lie. Runs jobs: the scan of the chunks, and one per level that
    entries still open go through, are written to the shared folder.
    """
    idx = F.col("idx")
    chunk = F.col("chunk") if "chunk" in indexed.columns else div(idx, chunks.size)
    bars = indexed.select(
        "symbol", chunk.alias("block"), idx.alias("pos"), F.col("close").alias("price"), F.col("bar_ts").alias("ts")
    )
    marks = signals.where("idx >= 1").select(
        "symbol",
        div(idx, chunks.size).alias("block"),
        idx.alias("pos"),
        F.when(F.col("side") == "bull", 1).otherwise(-1).alias("side"),
        "n_copies",
    )
    keys = ["symbol", "block"]
    scanned = bars.groupBy(*keys).cogroup(marks.groupBy(*keys)).applyInArrow(
        _chunk_scan(params), f"{_EXIT}, {_SUMMARY}"
    )
    scanned = materialize(scanned, "chunks")
    summaries = scanned.where("entry is null")
    entries = scanned.where("entry is not null").select(*[name for name, _ in _EXIT_FIELDS])
    units = summaries.select(
        "symbol",
        F.col("block").alias("unit"),
        "lo",
        "hi",
        *[F.col(c).isNotNull().alias(c) for c in ("falls", "climbs", "bull", "bear")],
    )
    n_units = (summaries.agg(F.max("block")).first()[0] or 0) + 1

    result = entries.where("hit >= 0")
    waiting = entries.where("hit < 0")
    after = F.col("block")
    levels, found = [], []
    while n_units > 1:
        last = n_units <= chunks.fan
        group = F.lit(0) if last else div(F.col("unit"), chunks.fan)
        block = F.lit(0) if last else div(after, chunks.fan)
        levels.append(units.withColumn("block", group.cast("bigint")))
        ended = _met(levels[-1], _open_after(waiting, after, block), _unit_scan(params), _ENTRY)
        ended = materialize(ended, "ended")
        found.append(ended.where("hit >= 0"))
        waiting, after = ended.where("hit < 0"), F.col("block")
        if last:
            break
        units = materialize(_coarser(units, chunks.fan, params), "units")
        n_units = -(-n_units // chunks.fan)
    coming = None
    for level in range(len(levels) - 1, -1, -1):
        coming = found[level] if coming is None else coming.unionByName(found[level])
        arrived = _open_after(coming, F.lit(-1), F.col("hit"))
        if level:
            ended = _met(levels[level - 1], arrived, _unit_scan(params), _ENTRY)
            coming = materialize(ended, "ended")
        else:
            result = result.unionByName(_met(summaries.select(*keys, *_PARTS), arrived, _landing(params), _EXIT))
    result = result.unionByName(waiting, allowMissingColumns=True)

    newest = summaries.groupBy("symbol").agg(F.max("newest").alias("newest"), F.max("newest.ts").alias("last_ts"))
    missed = F.col("hit") < 0
    kind = F.when(missed, "end").when(F.col("hit_kind") == STOP, "stop").otherwise("opposite")
    again = (F.col("hit_kind") == STOP) | (F.col("hit_copies") >= 2)
    return result.join(newest, "symbol").select(
        "symbol",
        F.col("entry").alias("entry_idx"),
        F.when(F.col("side") == 1, "long").otherwise("short").alias("type"),
        "n_copies",
        "entry_price",
        F.col("entry_ts").alias("entry_time"),
        F.col("level").alias("last_stop"),
        F.when(missed, F.col("newest.pos")).otherwise(F.col("hit")).alias("exit_idx"),
        F.when(missed, F.col("newest.price")).otherwise(F.col("hit_price")).alias("exit_price"),
        F.when(missed, F.col("last_ts")).otherwise(F.col("hit_ts")).alias("exit_time"),
        kind.alias("exit_kind"),
        F.when(missed, F.col("newest.pos") + 1)
        .when(again, F.col("hit"))
        .otherwise(F.col("hit") + 1)
        .alias("next_idx"),
    )
