"""A language model: hashed maximum entropy over word classes, then words within their class.

P(word | before) = P(class | before) * P(group | class, before) * P(word | group). The commonest words
are classes of their own; all others share classes by their last two bytes, and a class is split into
groups by the first byte and the third last, which needs no table of words. The first two factors are
softmaxes, over the classes and over the groups of a class, with one weight row per active feature:
the word before, the classes of the two words before, and the words two and three places back (skips).
Features are hashed into two tables, one for classes and one with a part per class for its groups.
Their rows follow from the distinct tokens counted in training (`table_rows`), so the tables grow with
the corpus. The last factor is the word's share of its group; the number of words seen once estimates
the share of unknown words, which count together as one more word of the group.

Training covers all training texts. Counts of (feature, class or group) give the gradient of the empty
model and a first step from it; every further step is one pass in which each task adds up the expected
counts under the current weights over its texts, and the blocks of all tasks are summed.

Words are known by 64-bit hashes. The counts of the most frequent words are held by every task, up to
`held` words; all rarer ones are joined with the table of counts, so every word gets its exact count.

Edge cases: a null or blank text is one end token. Repeated rows are scored alike and count as often
as they occur in training. A row without an id is never held out. Without training texts every token
is unknown. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from candlewright.llm import blocks
from candlewright.llm.tokens import LOWER, hash_words, mix, parts, text_bytes
from candlewright.session import materialize


@dataclass(frozen=True)
class ModelParams:
    #: Words that are classes of their own, and classes for all others.
    own: int = 24
    shared: int = 24
    #: Groups of each shared class.
    groups: int = 16
    #: Rows of the class table for each square root of a distinct token.
    rows_per_root: int = 16
    #: Scan partitions that one task counts over, as long as every core has a task.
    splits: int = 8
    #: Gradient steps over all training texts after the first one.
    steps: int = 1
    #: Scale of the first step, and of the others.
    first: float = 0.6
    rate: float = 0.5
    #: Counts a weight needs before it moves far.
    damping: float = 4.0
    #: Words whose counts every task holds; the others are joined.
    held: int = 1 << 17
    #: Smoothing of the base score.
    base: float = 0.1


END = np.uint64(0x1F83D9ABFB41BD6B)
START = np.uint64(0x5BE0CD19137E2179)
_SEED = mix(np.arange(101, 109, dtype=np.uint64))


@dataclass
class Tokens:
    """Tokens of a run of texts, each text followed by an end."""

    hashes: np.ndarray
    #: Class a token has unless it is a class of its own.
    shared: np.ndarray
    #: Its group in that class.
    group: np.ndarray
    #: Place in its text.
    place: np.ndarray
    #: Tokens of text k are bounds[k] to bounds[k + 1].
    bounds: np.ndarray


def table_rows(distinct: int, params: ModelParams) -> int:
    """Rows of the class table: the power of two from `rows_per_root` times the root of the distinct tokens on."""
    return 1 << max(8, int(np.ceil(np.log2(params.rows_per_root * max(distinct, 1) ** 0.5))))


@lru_cache
def _buckets(n: int) -> np.ndarray:
    """A bucket for every two bytes, in lower case; the first byte counts 256."""
    a, b = np.meshgrid(LOWER.astype(np.uint64), LOWER.astype(np.uint64), indexing="ij")
    return (mix(a * np.uint64(257) + b + np.uint64(1)) % np.uint64(n)).astype(np.int64).ravel()


def read_tokens(data: np.ndarray, offsets: np.ndarray, shared: int, groups: int = 1) -> Tokens:
    words = hash_words(data, offsets)
    sizes = np.diff(words.bounds)
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(words.hashes)) + owner
    hashes = np.full(bounds[-1], END, np.uint64)
    hashes[at] = words.hashes
    kind, group = np.zeros(bounds[-1], np.int64), np.zeros(bounds[-1], np.int64)
    if len(at):
        length = words.ends - words.begins

        def byte(place: np.ndarray) -> np.ndarray:
            return data.take(place, mode="clip").astype(np.int64)

        pair = byte(words.ends - 1) << 8 | byte(words.ends - 2) * (length > 1)
        kind[at] = _buckets(shared).take(pair)
        pair = byte(words.begins) << 8 | byte(words.ends - 3) * (length > 2)
        group[at] = _buckets(groups).take(pair)
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes + 1)
    return Tokens(hashes, kind, group, place, bounds)


class Places:
    """Finds hashes among sorted ones by their first bits; hashes spread evenly, so few places are tried."""

    def __init__(self, hashes: np.ndarray):
        bits = len(hashes).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.hashes = np.append(hashes, np.uint64(2**64 - 1))
        self.first = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each hash the place it has, and whether it is there; the place means nothing if not."""
        at = self.first.take((wanted >> self.shift).view(np.int64)).astype(np.int64)
        left = np.flatnonzero(self.hashes.take(at) < wanted)
        while len(left):
            at[left] += 1
            left = left[self.hashes.take(at[left]) < wanted[left]]
        known = (self.hashes.take(at) == wanted) & (at < len(self.hashes) - 1)
        return np.where(known, at, 0), known


@dataclass
class Classes:
    #: Sorted hashes of the words that are classes of their own.
    own: np.ndarray
    shared: int

    @property
    def n(self) -> int:
        return len(self.own) + self.shared

    def of(self, tokens: Tokens) -> np.ndarray:
        if not len(self.own):
            return tokens.shared
        at = np.minimum(np.searchsorted(self.own, tokens.hashes), len(self.own) - 1)
        return np.where(self.own[at] == tokens.hashes, at, len(self.own) + tokens.shared)


def contexts(tokens: Tokens, kinds: np.ndarray) -> list[np.ndarray]:
    """What stands before each token, as one hash per kind of feature."""

    def back(values: np.ndarray, n: int, edge) -> np.ndarray:
        out = np.full(len(values), edge, values.dtype)
        out[n:] = values[:-n] if n < len(values) else values[:0]
        return np.where(tokens.place >= n, out, edge)

    word = [back(tokens.hashes, n, START) for n in (1, 2, 3)]
    first, second = (back(kinds, n, 255).astype(np.uint64) for n in (1, 2))
    codes = [word[0], first * np.uint64(256) + second, word[1], word[2]]
    return [mix(c ^ _SEED[k]) for k, c in enumerate(codes)]


FEATURES = 4


def features(tokens: Tokens, kinds: np.ndarray, rows: int) -> list[np.ndarray]:
    """Rows of the class table that are active for each token."""
    mask = np.uint64(rows - 1)
    return [(c & mask).astype(np.int64) for c in contexts(tokens, kinds)]


@dataclass
class Layer:
    """The tokens one softmax decides on: their active rows and what they turned out to be."""

    active: list[np.ndarray]
    kinds: np.ndarray


def layers(tokens: Tokens, classes: Classes, rows: int) -> tuple[Layer, Layer, np.ndarray]:
    """Classes of all tokens, groups of those in shared classes, and where the latter stand.

    The group table has `rows // 8` rows for each shared class, those of the first class first.
    """
    kinds = classes.of(tokens)
    codes = contexts(tokens, kinds)
    mask, part = np.uint64(rows - 1), rows // 8
    at = np.flatnonzero(kinds >= len(classes.own))
    region = (kinds[at] - len(classes.own)) * part
    high = np.uint64(32)
    grouped = [region + ((c[at] >> high) & np.uint64(part - 1)).astype(np.int64) for c in codes]
    whole = Layer([(c & mask).astype(np.int64) for c in codes], kinds)
    return whole, Layer(grouped, tokens.group[at]), at


def chances(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """What each row multiplies the chances with; every feature's row brings an even part of the bias."""
    return np.exp(weights + bias / np.float32(FEATURES))


#: Tokens handled at a time; their rows of chances stay in the processor's cache.
RUN = 1 << 10
#: Tokens whose counts are added up before they go to the tables.
WIDE = 32 * RUN
#: Tokens of one row from which on they are added up by themselves.
HEAVY = 128


def class_powers(active: list[np.ndarray], rows: np.ndarray, out: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Unnormalised chances of each class in `out`: products of `rows`, which stay far from overflow."""
    # Rows lie inside the table; in this mode numpy writes to `out` without a copy.
    rows.take(active[0], 0, out, "clip")
    for f in active[1:]:
        out *= rows.take(f, 0, room[: len(f)], "clip")
    return out


def run_logs(layer: Layer, rows: np.ndarray) -> np.ndarray:
    """log10 P(what each token turned out to be)."""
    logs = np.empty(len(layer.kinds))
    held, room = np.empty((2, RUN, rows.shape[1]), np.float32)
    for low in range(0, len(logs), RUN):
        own = layer.kinds[low : low + RUN]
        x = class_powers([f[low : low + RUN] for f in layer.active], rows, held[: len(own)], room)
        logs[low : low + RUN] = np.log10(x[np.arange(len(own)), own] / x.sum(1))
    return logs


def class_logs(active: list[np.ndarray], kinds: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """log10 P(class of each token)."""
    return run_logs(Layer(active, kinds), chances(weights, bias))


def _block_rows(values: np.ndarray, name: str, kept: int) -> Iterator[pa.RecordBatch]:
    for block, data in blocks.split(values.ravel()):
        data = blocks.pack(np.frombuffer(data, values.dtype).astype(np.float32), kept)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([block], pa.int32()), pa.array([data], pa.binary())],
            ["name", "block", "data"],
        )


BLOCK_ROWS = "name string, block int, data binary"


def count_tokens(train: DataFrame, params: ModelParams) -> DataFrame:
    """`token, shared, c` over the training texts, given as `text` in bytes; `shared` numbers class and group."""
    shared, groups = params.shared, params.groups

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            token, shared_, c = (np.concatenate(x) for x in zip(*held, strict=True))
            unique, first, inverse = np.unique(token, return_index=True, return_inverse=True)
            return unique, shared_[first], np.bincount(inverse, c).astype(np.int64)

        def rows(token, kind, c) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(kind, pa.int32()), pa.array(c)], ["token", "shared", "c"]
            )

        for batch in batches:
            for _, _, data, offsets in parts(batch.column(0)):
                t = read_tokens(data, offsets, shared, groups)
                unique, first, c = np.unique(t.hashes, return_index=True, return_counts=True)
                held.append((unique, (t.shared * groups + t.group)[first].astype(np.int32), c))
                if sum(len(x[0]) for x in held) > 2_000_000:
                    held = [merged()]
                    if len(held[0][0]) > 1_000_000:
                        yield rows(*held.pop())
        if held:
            yield rows(*merged())

    found = train.mapInArrow(scan, "token bigint, shared int, c bigint")
    return found.groupBy("token").agg(F.min("shared").alias("shared"), F.sum("c").alias("c"))


@dataclass
class LanguageModel:
    classes: Classes
    #: Weights of classes, and of groups with a quarter of the group's log share in each row.
    weights: np.ndarray
    bias: np.ndarray
    group_weights: np.ndarray
    #: Per group, those of the first shared class first: tokens, and words seen once.
    group_tokens: np.ndarray
    group_once: np.ndarray
    #: Tokens of each word that is a class of its own.
    own_tokens: np.ndarray
    tokens: int
    words: int
    #: Sorted hashes of frequent words and their counts.
    held: np.ndarray
    held_counts: np.ndarray
    #: Words below this count are not held.
    held_from: int


def _held_from(counts: DataFrame, most: int) -> int:
    """The smallest of some steps of counts that at most `most` words reach."""
    step = F.floor(4 * F.log2("c"))
    bins = counts.groupBy(step.alias("bin")).agg(F.count("*").alias("n")).collect()
    total, start = 0, 2**62
    for row in sorted(bins, key=lambda r: -r["bin"]):
        total += row["n"]
        if total > most:
            break
        start = int(np.ceil(2 ** (row["bin"] / 4) - 1e-9))
    return start


def _tasks(train: DataFrame, params: ModelParams) -> DataFrame:
    """Fewer, larger tasks for counts into arrays: a task sends its arrays once, whatever it has read."""
    cores, splits = train.sparkSession.sparkContext.defaultParallelism, train.rdd.getNumPartitions()
    return train.coalesce(max(1, -(-splits // (params.splits * cores))) * cores)


def _counted(
    train: DataFrame, shapes: dict[str, tuple[int, int]], fill, params: ModelParams, label: str, kind=np.float32, kept: int = 4
) -> list[np.ndarray]:
    """The arrays that `fill(tokens, arrays)` adds to over all texts, summed over tasks."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = {name: np.zeros(shape, kind) for name, shape in shapes.items()}
        for batch in batches:
            for _, _, data, offsets in parts(batch.column(0)):
                fill(read_tokens(data, offsets, params.shared, params.groups), arrays)
        for name, values in arrays.items():
            yield from _block_rows(values, name, kept)

    found = materialize(_tasks(train, params).mapInArrow(scan, BLOCK_ROWS), label)
    sums = {name: np.zeros(shape, np.float32) for name, shape in shapes.items()}
    for row in blocks.summed(found, blocks.unpack).toLocalIterator():
        values, at = np.frombuffer(row["data"], np.float64), row["block"] * blocks.BLOCK
        sums[row["name"]].reshape(-1)[at : at + len(values)] = values
    return list(sums.values())


def _seen(layer: Layer, into: np.ndarray) -> None:
    n, cells = into.shape[1], into.reshape(-1)
    for f in layer.active:
        np.add.at(cells, f * n + layer.kinds, into.dtype.type(1))


def _observed(train: DataFrame, classes: Classes, rows: int, params: ModelParams) -> list[np.ndarray]:
    """How often each feature stands before each class and before each group."""

    def fill(t: Tokens, arrays: dict[str, np.ndarray]) -> None:
        whole, grouped, _ = layers(t, classes, rows)
        _seen(whole, arrays["classes"])
        _seen(grouped, arrays["groups"])

    shapes = {"classes": (rows, classes.n), "groups": (params.shared * (rows // 8), params.groups)}
    return _counted(train, shapes, fill, params, "observed", np.int32)


def _by_row(f: np.ndarray, rows: int) -> np.ndarray:
    """The tokens in order of their rows; numpy sorts 16 bits by counting."""
    order = np.argsort((f & 0xFFFF).astype(np.uint16), kind="stable")
    for low in range(16, (rows - 1).bit_length(), 16):
        order = order[np.argsort(((f >> low) & 0xFFFF).astype(np.uint16)[order], kind="stable")]
    return order


def _add_rows(values: np.ndarray, f: np.ndarray, into: np.ndarray, held: np.ndarray, room: np.ndarray) -> None:
    """Add the values of each token to its row; `held` and `room` are space for as many values.

    Once in order of rows, the first tokens of all rows are taken together, then the second ones, and so on; the
    rows with most tokens come first, so those that have another one are always the first few.
    """
    if not len(f):
        return
    order = _by_row(f, len(into))
    ordered = f[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(starts, append=len(f))
    by_size = np.argsort(np.maximum(HEAVY + 1 - sizes, 0).astype(np.uint16), kind="stable")
    starts, sizes = starts[by_size], sizes[by_size]
    met, heavy = ordered[starts], int(np.count_nonzero(sizes > HEAVY))
    for row, start, size in zip(met[:heavy].tolist(), starts[:heavy].tolist(), sizes[:heavy].tolist(), strict=True):
        for low in range(start, start + size, RUN):
            own = order[low : min(low + RUN, start + size)]
            into[row] += values.take(own, 0, room[: len(own)], "clip").sum(0)
    met, starts, sizes = met[heavy:], starts[heavy:], sizes[heavy:]
    sums = values.take(order[starts], 0, held[: len(met)], "clip")
    more = np.cumsum(np.bincount(sizes, minlength=2)[::-1])[::-1].tolist()
    for k, n in enumerate(more[2:], 1):
        sums[:n] += values.take(order[starts[:n] + k], 0, room[:n], "clip")
    into[met] = into.take(met, 0) + sums


def _add_expected(active: list[np.ndarray], rows: np.ndarray, into: np.ndarray) -> None:
    """Add the chances of every class to the rows that are active; `into` has the shape of `rows`."""
    tokens, n = len(active[0]), rows.shape[1]
    odds, held, room = (np.empty((min(WIDE, tokens), n), np.float32) for _ in range(3))
    for start in range(0, tokens, WIDE):
        end = min(start + WIDE, tokens)
        for low in range(start, end, RUN):
            high = min(low + RUN, end)
            x = class_powers([f[low:high] for f in active], rows, odds[low - start : high - start], room)
            x /= x.sum(1, keepdims=True)
        for f in active:
            _add_rows(odds[: end - start], f[start:end], into, held, room)


def expected(t: Tokens, kinds: np.ndarray, weights: np.ndarray, bias: np.ndarray, into: np.ndarray) -> None:
    """Add the model's expected counts of classes over some tokens; `into` has a row per class."""
    _add_expected(features(t, kinds, len(weights)), chances(weights, bias), into.T)


def _expected(train: DataFrame, classes: Classes, weights, bias, group_weights, params: ModelParams) -> list[np.ndarray]:
    rows = (chances(weights, bias), np.exp(group_weights))
    held = train.sparkSession.sparkContext.broadcast((classes, *rows))

    def fill(t: Tokens, arrays: dict[str, np.ndarray]) -> None:
        own, by_class, by_group = held.value
        whole, grouped, _ = layers(t, own, len(by_class))
        _add_expected(whole.active, by_class, arrays["classes"])
        _add_expected(grouped.active, by_group, arrays["groups"])

    shapes = {"classes": weights.shape, "groups": group_weights.shape}
    found = _counted(train, shapes, fill, params, "expected", kept=3)
    held.unpersist()
    return found


def fit(train: DataFrame, counts: DataFrame, params: ModelParams = ModelParams()) -> LanguageModel:
    """Train on texts given as `text` in bytes; `counts` is their written table of tokens."""
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    start = _held_from(counts, params.held)
    frequent = counts.where(F.col("c") >= start).select("token", "c").toArrow()
    hashes = frequent.column("token").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    held, held_counts = hashes[order], frequent.column("c").to_numpy()[order]
    top = np.argsort(-held_counts, kind="stable")[: params.own]
    classes = Classes(np.sort(held[top]), params.shared)
    n, shared, groups = classes.n, params.shared, params.groups

    own = F.col("token").isin(*classes.own.view(np.int64).tolist()) if len(classes.own) else F.lit(False)
    group_tokens, group_once = np.zeros(shared * groups), np.zeros(shared * groups)
    by_group = counts.where(~own).groupBy("shared").agg(
        F.sum("c").alias("n"), F.sum((F.col("c") == 1).cast("bigint")).alias("once")
    )
    for row in by_group.collect():
        group_tokens[row["shared"]], group_once[row["shared"]] = row["n"], row["once"]
    own_tokens = held_counts[np.searchsorted(held, classes.own)] if len(classes.own) else np.zeros(0, np.int64)
    inside = group_tokens.reshape(shared, groups)
    tokens = np.concatenate([own_tokens, inside.sum(1)])

    share = (tokens + 0.5) / (tokens + 0.5).sum()
    bias = np.log(share).astype(np.float32)
    inside = (inside + 0.5) / (inside + 0.5).sum(1, keepdims=True)
    rows = table_rows(totals["v"], params)
    # One row of shares for each row of the group table, which belongs to one class.
    inside = np.repeat(inside, rows // 8, 0)
    weights, groups_only = np.zeros((rows, n), np.float32), (np.log(inside) / FEATURES).astype(np.float32)
    group_weights = groups_only
    if totals["n"]:

        def first(seen: np.ndarray, chance: np.ndarray) -> np.ndarray:
            flat, prior = seen.sum(1, keepdims=True) * chance, params.damping * chance
            return (params.first / 2 * np.log((seen + prior) / (flat + prior))).astype(np.float32)

        def step(seen: np.ndarray, model: np.ndarray) -> np.ndarray:
            moved = (seen - model) / (np.maximum(seen, model) + params.damping)
            return (params.rate * moved).astype(np.float32)

        seen, group_seen = _observed(train, classes, rows, params)
        weights, group_weights = first(seen, share), groups_only + first(group_seen, inside)
        for _ in range(params.steps):
            model, group_model = _expected(train, classes, weights, bias, group_weights, params)
            weights += step(seen, model)
            group_weights += step(group_seen, group_model)
    return LanguageModel(
        classes, weights, bias, group_weights, group_tokens, group_once, own_tokens,
        int(totals["n"] or 0), int(totals["v"]), held, held_counts, start,
    )


def _word_logs(model: LanguageModel) -> np.ndarray:
    """Log10 of what a group's tokens and its unknown words share."""
    return np.log10(model.group_tokens + model.group_once + 0.5)


def score(
    docs: DataFrame, model: LanguageModel, counts: DataFrame, params: ModelParams = ModelParams()
) -> DataFrame:
    """`id, held_out, n_tokens, n_known, base_score, score` for rows `id, held_out, text` in bytes."""
    context = docs.sparkSession.sparkContext
    rows = (chances(model.weights, model.bias), np.exp(model.group_weights))
    shared = context.broadcast((model.classes, rows, model.held, model.held_counts, _word_logs(model)))
    base, log_all = params.base, float(np.log10(model.tokens + params.base * (model.words + 1)))
    names = ["row", "id", "held_out", "n_tokens", "n_known", "base", "score", "token", "kind", "c"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, (class_rows, group_rows), held, held_counts, whole = shared.value
        row, places = TaskContext.get().partitionId() << 40, Places(held)
        log_base = np.log10(held_counts + base) - log_all
        for batch in batches:
            for first, last, data, offsets in parts(batch.column(2)):
                t = read_tokens(data, offsets, params.shared, params.groups)
                by_class, by_group, grouped = layers(t, classes, len(class_rows))
                logs = run_logs(by_class, class_rows)
                logs[grouped] += run_logs(by_group, group_rows)
                group = t.shared * params.groups + t.group
                at, known = places.of(t.hashes)
                plain = np.zeros(len(logs))
                plain[known] = log_base[at[known]]
                inside = grouped[known[grouped]]
                logs[inside] += np.log10(held_counts[at[inside]]) - whole[group[inside]]
                starts, n = t.bounds[:-1], last - first
                number = row + np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number),
                        batch.column(0).slice(first, n),
                        batch.column(1).slice(first, n),
                        pa.array(np.diff(t.bounds)),
                        pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                        pa.array(np.add.reduceat(plain, starts)),
                        pa.array(np.add.reduceat(logs, starts)),
                        *[pa.nulls(n).cast(x) for x in (pa.int64(), pa.int32(), pa.int64())],
                    ],
                    names,
                )
                rare = np.flatnonzero(~known)
                if len(rare):
                    owner = np.repeat(number, np.diff(t.bounds))[rare]
                    none = pa.nulls(len(rare))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(owner),
                            none.cast(batch.column(0).type),
                            none.cast(pa.bool_()),
                            none.cast(pa.int64()),
                            none.cast(pa.int64()),
                            none.cast(pa.float64()),
                            none.cast(pa.float64()),
                            pa.array(t.hashes[rare].view(np.int64)),
                            pa.array(group[rare].astype(np.int32)),
                            none.cast(pa.int64()),
                        ],
                        names,
                    )
                row += n

    kind = docs.schema["id"].dataType.simpleString()
    found = docs.select("id", "held_out", "text").mapInArrow(
        scan,
        f"row bigint, id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double,"
        " token bigint, kind int, c bigint",
    )
    found = materialize(found, "scores")
    texts = found.where(F.col("token").isNull()).drop("token", "kind", "c")
    kinds = docs.sparkSession.createDataFrame(
        [(k, float(a), float(b)) for k, (a, b) in enumerate(zip(_word_logs(model), model.group_once))],
        "kind int, whole double, once double",
    )
    c = F.coalesce("c", F.lit(0))
    seen = F.when(c > 0, c).otherwise(F.col("once") + 0.5)
    tail = (
        found.where(F.col("token").isNotNull())
        .select("row", "token", "kind")
        .join(counts.where(F.col("c") < model.held_from).select("token", "c"), "token", "left")
        .join(F.broadcast(kinds), "kind")
        .groupBy("row")
        .agg(
            F.sum((c > 0).cast("bigint")).alias("tail_known"),
            F.sum(F.log10(c + base) - log_all).alias("tail_base"),
            F.sum(F.log10(seen) - F.col("whole")).alias("tail_score"),
        )
    )
    add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return texts.join(tail, "row", "left").select(
        "id",
        "held_out",
        "n_tokens",
        add("n_known", "tail_known").alias("n_known"),
        add("base", "tail_base").alias("base_score"),
        add("score", "tail_score").alias("score"),
    )


def train_and_score(
    docs: DataFrame,
    held_out,
    params: ModelParams = ModelParams(),
    id_col: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, LanguageModel]:
    """Learn from the rows where `held_out` is not true and score all rows."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_bytes(text).alias("text")
    )
    train = rows.where(~F.col("held_out")).select("text")
    counts = materialize(count_tokens(train, params), "token-counts")
    model = fit(train, counts, params)
    return score(rows, model, counts, params), model
