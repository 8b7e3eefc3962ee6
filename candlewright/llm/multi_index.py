"""Hard-negative mining over an inverted multi-index, exact.

Vectors are cut in halves, each half has a codebook, and a vector lies in the cell of its two nearest
codes. For an anchor q, no vector under code c of a half scores more there than
q . code(c) + |q| radius(c), the radius being the largest distance from the code to one of its
vectors. Cells are visited in falling order of the sum of both bounds, by a heap over the two sorted
lists (multi-sequence). What is looked for is a set of windows per anchor: the best `keep` rows with a
score from `low` to `high`, of the anchor's label or of others. A window is certified, and its search
ends, when no cell left can reach its `keep`-th score or its lower end. So nothing is missed.

1. `build` fits the codebooks on at most 8,192 vectors (the least hashes of ids), then codes every
   row, counts cells and takes radii, and packs the rows of a cell in blocks of some 4,096. A cell with
   many rows is cut by hash of the id into as many parts as it needs.
2. Anchors are packed in groups of 256. A round walks the cells of every open anchor until so many
   rows are covered, eight times as many in each round, and writes requests: a group's anchors that
   want a cell. Requests are joined with the blocks by cell and part, each joined row is one matrix
   product, and tasks hand on only the best rows of each window. Rounds end when all is certified.
3. Positives are the best rows of the same label; the windows of the negatives follow from their
   scores.

What the driver holds are the codebooks (2 x 256 codes at most) and a count and two radii per cell
(65,536 at most), whatever the number of rows.

Edge cases: rows with a null id, label or vector, or a null or non-finite component, take no part;
exact repeats of a row count once; rows that share an id are never each other's positives. A shorter
vector counts as ending in zeros. Equal scores go by smaller id. Components must be small enough for
inner products in 64 bits. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewright.session import materialize

GROUP, BLOCK = 256, 4096
#: Rows of results a task holds before it thins them out.
HELD = 1 << 17


@dataclass(frozen=True)
class MineParams:
    positives: int = 5
    negatives: int = 3
    #: A negative's score lies between these whole percentages of the positive's.
    low: int = 50
    high: int = 95
    #: Vectors the codebooks are fitted on, at most.
    sample: int = 8192
    rows_per_cell: int = 512
    codes: int = 256
    #: Rows covered by an anchor's first round, and how many times more by each later one.
    first: int = 8192
    growth: int = 8


@dataclass
class Index:
    """Codebooks and directory of the cells; `blocks` holds the rows."""

    blocks: DataFrame
    codes: tuple[np.ndarray, np.ndarray]
    #: Rows, parts, and radii in both halves, by cell; cells without rows have no parts.
    rows: np.ndarray
    parts: np.ndarray
    radii: np.ndarray
    kind: str
    exact: str

    def directory(self) -> "Directory":
        return Directory(self.codes, self.rows, self.parts, self.radii, self.kind, self.exact)


@dataclass
class Directory:
    codes: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray
    parts: np.ndarray
    radii: np.ndarray
    kind: str
    exact: str

    def __post_init__(self) -> None:
        n, m = (len(c) for c in self.codes)
        each = self.radii.reshape(n, m, 2)
        #: Largest radius of each code over its cells.
        self.widest = (each[:, :, 0].max(axis=1), each[:, :, 1].max(axis=0))

    def bounds(self, q: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...], tuple[float, float]]:
        """Per half: scores of the codes, bounds of the codes; and the lengths of the anchor's halves."""
        cut = self.codes[0].shape[1]
        halves = (q[:cut], q[cut:])
        lengths = tuple(float(np.linalg.norm(h)) for h in halves)
        scores = tuple(c @ h for c, h in zip(self.codes, halves, strict=True))
        tops = tuple(s + w * n for s, w, n in zip(scores, self.widest, lengths, strict=True))
        return scores, tops, lengths


def cells_by_bound(tops: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, int, int]]:
    """Pairs of codes in falling order of the sum of their bounds (multi-sequence)."""
    orders = [np.argsort(-t, kind="stable") for t in tops]
    first, second = (t[o].tolist() for t, o in zip(tops, orders, strict=True))
    left, right = (o.tolist() for o in orders)
    #: In every row of the grid of sorted codes, how many have been visited.
    done = [0] * len(first)
    heap = [(-(first[0] + second[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, left[i], right[j]
        done[i] = j + 1
        # A neighbour follows once the other cell before it has been visited.
        if i + 1 < len(first) and done[i + 1] == j:
            heapq.heappush(heap, (-(first[i + 1] + second[j]), i + 1, j))
        if j + 1 < len(second) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))


def _fit(sample: np.ndarray, n: int) -> np.ndarray:
    """Codes of one half: Lloyd's algorithm from evenly spaced starts."""
    sample = np.unique(sample, axis=0)
    codes = sample[np.linspace(0, len(sample) - 1, min(n, len(sample))).astype(int)]
    for _ in range(10):
        nearest = _nearest(sample, codes)
        sums = np.zeros_like(codes)
        np.add.at(sums, nearest, sample)
        count = np.bincount(nearest, minlength=len(codes))[:, None]
        codes = np.where(count > 0, sums / np.maximum(count, 1), codes)
    return codes


def _nearest(vectors: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.argmax(vectors @ codes.T - 0.5 * (codes**2).sum(axis=1), axis=1)


def whole_numbers(vector: Column, scale: int) -> Column:
    """Components as whole numbers: the floor of `scale` times each."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    whole = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, whole), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dim)


def _packs(
    batches: Iterator[pa.RecordBatch], size: int, kind: str, dim: int, keys: int
) -> Iterator[tuple[tuple, list[bytes]]]:
    """Runs of rows with equal first columns, at most `size`: ids, labels and vectors as bytes."""
    for batch in batches:
        held = [batch.column(k).to_numpy() for k in range(keys + 2)]
        vectors = _matrix(batch.column(keys + 2), dim).astype(kind)
        change = np.zeros(batch.num_rows, bool)
        for column in held[:keys]:
            change[1:] |= column[1:] != column[:-1]
        begins = [0, *np.flatnonzero(change), batch.num_rows]
        for begin, end in zip(begins, begins[1:]):
            for k in range(begin, end, size):
                to = min(k + size, end)
                key = tuple(int(column[k]) for column in held[:keys])
                yield key, [
                    held[keys][k:to].astype(np.int64).tobytes(),
                    held[keys + 1][k:to].astype(np.int64).tobytes(),
                    vectors[k:to].tobytes(),
                ]


def build(vectors: DataFrame, params: MineParams) -> Index | None:
    """Index of the rows `id, label, z`; none if there are no rows."""
    spark = vectors.sparkSession
    n, dim, most = vectors.agg(
        F.count("*"), F.max(F.size("z")), F.max(F.array_max(F.transform("z", lambda x: F.abs(x))))
    ).first()
    if not n:
        return None
    dim, most = max(dim, 1), most or 0
    # The smallest type that holds a component, and the type in which products are exact.
    kind = "i2" if most < 1 << 15 else "i4" if most < 1 << 31 else "i8"
    exact = "f8" if dim * most * most < 1 << 53 else "i8"
    padded = F.concat("z", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dim) - F.size("z")))
    rows = vectors.select("id", "label", padded.alias("z"))
    picked = rows.select("z").orderBy(F.xxhash64("id"), "id").limit(params.sample).collect()
    sample = np.array([r["z"] for r in picked], np.float64)
    cut = (dim + 1) // 2
    wanted = min(params.codes, max(1, round(math.sqrt(n / params.rows_per_cell))))
    codes = (_fit(sample[:, :cut], wanted), _fit(sample[:, cut:], wanted))
    shared = spark.sparkContext.broadcast(codes)
    wide = len(codes[1])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            z = _matrix(batch.column(2), dim).astype(np.float64)
            halves = (z[:, :cut], z[:, cut:])
            near = [_nearest(h, c) for h, c in zip(halves, own, strict=True)]
            far = [np.linalg.norm(h - c[k], axis=1) for h, c, k in zip(halves, own, near, strict=True)]
            cell = (near[0] * wide + near[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), *batch.columns, pa.array(far[0]), pa.array(far[1])],
                ["cell", "id", "label", "z", "e1", "e2"],
            )

    table = materialize(
        rows.mapInArrow(coded, "cell int, id bigint, label bigint, z array<bigint>, e1 double, e2 double"),
        "coded",
    )
    cells = table.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("e1").alias("e1"), F.max("e2").alias("e2")
    )
    size = len(codes[0]) * wide
    count, radii = np.zeros(size, np.int64), np.zeros((size, 2))
    for r in cells.collect():  # one row per cell, bounded by the codes
        count[r["cell"]], radii[r["cell"]] = r["n"], (r["e1"], r["e2"])
    parts = -(-count // BLOCK)
    of_cell = spark.createDataFrame(
        [(int(c), int(p)) for c, p in enumerate(parts) if p], "cell int, parts bigint"
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, data in _packs(batches, BLOCK, kind, dim, 2):
            yield pa.RecordBatch.from_pylist(
                [dict(zip(names, (*key, *data), strict=True))], schema=of_blocks
            )

    names = ["cell", "part", "ids", "labels", "vectors"]
    of_blocks = pa.schema(list(zip(names, [pa.int32(), pa.int64(), *[pa.binary()] * 3], strict=True)))
    blocks = (
        table.join(of_cell, "cell")
        .select("cell", F.pmod(F.xxhash64("id"), "parts").alias("part"), "id", "label", "z")
        .repartition("cell", "part")
        .sortWithinPartitions("cell", "part", "id")
        .mapInArrow(packed, "cell int, part bigint, ids binary, labels binary, vectors binary")
    )
    return Index(materialize(blocks, "blocks"), codes, count, parts, radii, kind, exact)


def anchor_groups(anchors: DataFrame, index: Index) -> DataFrame:
    """`g, ids, labels, vectors`: anchors `id, label, z`, 256 to a group."""
    dim = sum(c.shape[1] for c in index.codes)
    kind = index.kind

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = TaskContext.get().partitionId() << 32
        for _, data in _packs(batches, GROUP, kind, dim, 0):
            yield pa.RecordBatch.from_pylist([dict(zip(names, (g, *data), strict=True))], schema=of_groups)
            g += 1

    names = ["g", "ids", "labels", "vectors"]
    of_groups = pa.schema(list(zip(names, [pa.int64(), *[pa.binary()] * 3], strict=True)))
    padded = F.concat("z", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dim) - F.size("z")))
    n = max(1, -(-anchors.count() // GROUP))
    rows = anchors.select("id", "label", padded.alias("z")).repartition(n, "id").sortWithinPartitions("id")
    return materialize(
        rows.mapInArrow(packed, "g bigint, ids binary, labels binary, vectors binary"), "anchors"
    )


def _requests(
    directory: Directory, covered: int, limit: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cells of the next round for every group; a row without a cell says a group is not done."""
    schema = pa.schema(
        [("g", pa.int64()), ("cell", pa.int32()), ("part", pa.int64())]
        + [(x, pa.binary()) for x in ("a", "ids", "labels", "vectors", "wa", "w", "low", "high", "need")]
    )

    def walk(q: np.ndarray, need: float, high: float) -> tuple[list[int], bool]:
        """Cells of this round, and whether the anchor needs another one."""
        scores, tops, lengths = directory.bounds(q)
        slack = 1e-6 * (1 + max(abs(float(t.max())) for t in tops))
        wide, found, rows = len(directory.codes[1]), [], 0
        for bound, i, j in cells_by_bound(tops):
            if bound + slack < need:
                return found, False
            if rows >= limit:
                return found, True
            cell = i * wide + j
            inside = int(directory.rows[cell])
            if inside and rows >= covered:
                middle = scores[0][i] + scores[1][j]
                around = lengths[0] * directory.radii[cell, 0] + lengths[1] * directory.radii[cell, 1]
                if middle + around + slack >= need and middle - around - slack <= high:
                    found.append(cell)
            rows += inside
        return found, False

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim = sum(c.shape[1] for c in directory.codes)
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = (np.frombuffer(row[x], np.int64) for x in ("ids", "labels"))
                vectors = np.frombuffer(row["vectors"], directory.kind).reshape(len(ids), dim)
                windows = row["windows"] or []
                wa = np.array([x["a"] for x in windows], np.int16)
                w = np.array([x["w"] for x in windows], np.int8)
                low = np.array([x["low"] for x in windows], np.int64)
                high = np.array([x["high"] for x in windows], np.int64)
                need = low.copy()
                full = {(x["a"], x["w"]): x["score"] for x in row["last"] or []}
                for k, x in enumerate(windows):
                    need[k] = max(need[k], full.get((x["a"], x["w"]), need[k]))
                wanted: dict[int, list[int]] = {}
                more = False
                for a in np.unique(wa):
                    own = wa == a
                    q = vectors[a].astype(np.float64)
                    cells, again = walk(q, float(need[own].min()), float(high[own].max()))
                    more |= again
                    for cell in cells:
                        wanted.setdefault(cell, []).append(int(a))
                if more:
                    yield pa.RecordBatch.from_pylist([{"g": row["g"]}], schema=schema)
                for cell, who in wanted.items():
                    mine = np.array(who, np.int16)
                    of = np.isin(wa, mine)
                    request = {
                        "g": row["g"],
                        "cell": cell,
                        "a": mine.tobytes(),
                        "ids": ids[mine].tobytes(),
                        "labels": labels[mine].tobytes(),
                        "vectors": vectors[mine].tobytes(),
                        "wa": np.searchsorted(mine, wa[of]).astype(np.int16).tobytes(),
                        "w": w[of].tobytes(),
                        "low": low[of].tobytes(),
                        "high": high[of].tobytes(),
                        "need": need[of].tobytes(),
                    }
                    for part in range(int(directory.parts[cell])):
                        yield pa.RecordBatch.from_pylist([{**request, "part": part}], schema=schema)

    return plan


class Found:
    """Best rows of windows met by one task, in arrays of `g, a, w, anchor, score, id`."""

    def __init__(self, keep: int) -> None:
        self.keep, self.held, self.n = keep, [], 0

    def add(self, part: list[np.ndarray]) -> None:
        self.held.append(part)
        self.n += len(part[0])

    def thinned(self) -> list[np.ndarray]:
        if not self.held:
            return [np.zeros(0, np.int64)] * 6
        g, a, w, anchor, score, id_ = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((id_, -score, w, a, g))
        g, a, w, anchor, score, id_ = (x[order] for x in (g, a, w, anchor, score, id_))
        begin = np.ones(len(g), bool)
        begin[1:] = (g[1:] != g[:-1]) | (a[1:] != a[:-1]) | (w[1:] != w[:-1])
        at = np.arange(len(g))
        first = np.maximum.accumulate(np.where(begin, at, 0))
        own = at - first < self.keep
        out = [x[own] for x in (g, a, w, anchor, score, id_)]
        self.held, self.n = [out], int(own.sum())
        return out


def best_in_windows(
    scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, wa: np.ndarray, high: np.ndarray, need: np.ndarray, keep: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window, score and id of the first `keep` allowed rows of each window, from its upper end down.

    `scores` is anchor by row; window k belongs to anchor `wa[k]` and reaches from `need` to `high`.
    """
    none = np.zeros(0, np.int64)
    least = np.full(len(scores), np.iinfo(np.int64).max)
    most = np.full(len(scores), np.iinfo(np.int64).min)
    np.minimum.at(least, wa, need)
    np.maximum.at(most, wa, high)
    who, row = np.nonzero(allowed & (scores >= least[:, None]) & (scores <= most[:, None]))
    if not len(who):
        return none, none, none
    value = scores[who, row].astype(np.int64)
    order = np.lexsort((ids[row], -value, who))
    who, row, value = who[order], row[order], value[order]
    levels = np.unique(value)
    # Position of a score within an anchor, falling: the number of levels above it.
    key = who * (len(levels) + 1) + len(levels) - np.searchsorted(levels, value, "right")
    top = wa * (len(levels) + 1) + len(levels) - np.searchsorted(levels, high, "right")
    begin = np.searchsorted(key, top)
    end = np.searchsorted(who, wa, "right")
    at = begin[:, None] + np.arange(keep)
    inside = at < end[:, None]
    at = np.minimum(at, len(who) - 1)
    inside &= value[at] >= need[:, None]
    window = np.broadcast_to(np.arange(len(wa))[:, None], at.shape)[inside]
    return window, value[at][inside], ids[row[at]][inside]


def _score(
    directory: Directory, keep: int, same: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["g", "a", "w", "anchor", "score", "id"]

    def emitted(arrays: list[np.ndarray]) -> pa.RecordBatch:
        kinds = [np.int64, np.int32, np.int32, np.int64, np.int64, np.int64]
        return pa.RecordBatch.from_arrays(
            [pa.array(x.astype(k)) for x, k in zip(arrays, kinds, strict=True)], names
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim = sum(c.shape[1] for c in directory.codes)
        found = Found(keep)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                take = lambda name, kind: np.frombuffer(row[name], kind)
                ids, labels = take("ids", np.int64), take("labels", np.int64)
                block_ids, block_labels = take("block_ids", np.int64), take("block_labels", np.int64)
                q = take("vectors", directory.kind).reshape(len(ids), dim).astype(directory.exact)
                z = take("block_vectors", directory.kind).reshape(len(block_ids), dim).astype(directory.exact)
                scores = q @ z.T
                allowed = labels[:, None] == block_labels
                if same:
                    allowed &= ids[:, None] != block_ids
                else:
                    allowed = ~allowed
                wa = take("wa", np.int16).astype(np.int64)
                high, need = take("high", np.int64), take("need", np.int64)
                window, score, id_ = best_in_windows(scores, allowed, block_ids, wa, high, need, keep)
                who = wa[window]
                found.add(
                    [
                        np.full(len(window), row["g"]),
                        take("a", np.int16)[who].astype(np.int64),
                        take("w", np.int8)[window].astype(np.int64),
                        ids[who],
                        score,
                        id_,
                    ]
                )
                if found.n > HELD:
                    found.thinned()
                    if found.n > HELD // 2:
                        yield emitted(found.thinned())
                        found = Found(keep)
        yield emitted(found.thinned())

    return scan


def _search(index: Index, groups: DataFrame, windows: DataFrame, keep: int, same: bool, params: MineParams) -> DataFrame:
    """`g, a, w, anchor, score, id, rank` for windows `g, a, w, low, high`: the first `keep` rows of each."""
    directory = index.directory()
    spark = groups.sparkSession
    asked = materialize(
        groups.join(
            windows.groupBy("g").agg(F.collect_list(F.struct("a", "w", "low", "high")).alias("windows")), "g"
        ),
        "windows",
    )
    schema = "g bigint, a int, w int, anchor bigint, score bigint, id bigint"
    best = spark.createDataFrame([], schema + ", rank int")
    covered, limit = 0, params.first
    blocks = index.blocks.select(
        "cell", "part", *[F.col(x).alias(f"block_{x}") for x in ("ids", "labels", "vectors")]
    )
    ranked = Window.partitionBy("g", "a", "w").orderBy(F.desc("score"), "id")
    while True:
        last = best.where(F.col("rank") == keep).groupBy("g")
        last = last.agg(F.collect_list(F.struct("a", "w", "score")).alias("last"))
        fields = ("a", "ids", "labels", "vectors", "wa", "w", "low", "high", "need")
        requests = materialize(
            asked.join(last, "g", "left").mapInArrow(
                _requests(directory, covered, limit),
                "g bigint, cell int, part bigint, " + ", ".join(f"{x} binary" for x in fields),
            ),
            "requests",
        )
        met = requests.where("cell is not null").join(blocks, ["cell", "part"])
        found = met.mapInArrow(_score(directory, keep, same), schema)
        best = best.drop("rank").unionAll(found).withColumn("rank", F.row_number().over(ranked))
        best = materialize(best.where(F.col("rank") <= keep), "best")
        if requests.where("cell is null").isEmpty():
            return best
        covered, limit = limit, limit * params.growth


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    params: MineParams = MineParams(),
) -> DataFrame:
    """`anchor, positive, rank, negative, positive_score, negative_score` for rows `id, label, z`.

    `z` are whole numbers; `is_anchor` is a condition on these columns.
    """
    names = "anchor bigint, positive bigint, rank int, negative bigint, positive_score bigint, negative_score bigint"
    rows = materialize(
        vectors.select(F.col("id").cast("bigint"), F.col("label").cast("bigint"), "z")
        .where("id is not null and label is not null and z is not null")
        .distinct(),
        "vectors",
    )
    index = build(rows, params)
    if index is None:
        return vectors.sparkSession.createDataFrame([], names)
    groups = anchor_groups(rows.where(is_anchor), index)
    ends = np.iinfo(np.int64)
    numbers = F.sequence(F.lit(0), (F.octet_length("ids") / 8 - 1).cast("int"))
    whole = groups.select(
        "g",
        F.explode(numbers).alias("a"),
        F.lit(0).alias("w"),
        F.lit(int(ends.min)).cast("bigint").alias("low"),
        F.lit(int(ends.max)).cast("bigint").alias("high"),
    )
    positives = _search(index, groups, whole, params.positives, True, params).select(
        "g",
        "a",
        (F.col("rank") - 1).alias("w"),
        F.col("id").alias("positive"),
        F.col("score").alias("positive_score"),
    )
    share = lambda percent: f"cast(positive_score as decimal(20, 0)) * {percent / 100:.2f}"
    windows = positives.select(
        "g",
        "a",
        "w",
        F.expr(f"cast(ceil({share(params.low)}) as bigint)").alias("low"),
        F.expr(f"cast(floor({share(params.high)}) as bigint)").alias("high"),
    )
    windows = windows.where("low <= high")
    negatives = _search(index, groups, windows, params.negatives, False, params)
    return negatives.join(positives, ["g", "a", "w"]).select(
        "anchor",
        "positive",
        "rank",
        F.col("id").alias("negative"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
