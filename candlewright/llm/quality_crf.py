"""Text quality by a linear-chain conditional random field over lines.

Every line with a word is good or bad. A line's features are simple rates (symbols, capitals,
repeated words, ...) of the line itself, of the line before and of the line after; neighbouring
labels are tied by transition weights. Forward and backward passes give each line's probability of
being good; the document's share is their mean weighted by line length, mapped to the label's
probability by a logistic curve.

Documents are labelled, lines are not: in training, a document's label stands for all of its lines.
The model is fitted on a bounded sample of labelled documents, up to `most_per_label` of each label
taken by a hash of the id and weighted back to the labels' shares. Scoring covers all texts.

Edge cases: a null text or one without words has no line and scores the labels' mean. Rows of a
repeated id are scored one by one; a repeated label row counts again. Null labels are not learned
from. If all labels are equal, or there are none, every text scores their mean, or 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from candlewright.llm.tokens import BLANK, hash_words, parts, text_bytes


@dataclass(frozen=True)
class CrfParams:
    most_per_label: int = 2000
    steps: int = 120
    rate: float = 0.1
    decay: float = 1e-3


_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_CAPITAL = np.zeros(256, np.int32)
_CAPITAL[65:91] = 1
_DIGIT = np.zeros(256, np.int32)
_DIGIT[48:58] = 1
_BANG = np.zeros(256, np.int32)
_BANG[ord("!")] = 1
_LAST = np.zeros(256, bool)
_LAST[[ord(c) for c in ".!?"]] = True
#: Features of a line; each also counts for the line before and the line after.
OWN = 9


@dataclass
class Lines:
    features: np.ndarray
    #: Bytes of a line without blanks.
    size: np.ndarray
    #: Lines of text k are bounds[k] to bounds[k + 1].
    bounds: np.ndarray


def read_lines(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Lines with a word of a run of texts."""
    words = hash_words(data, offsets)
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[1:][data == 10] = True
    cuts = np.flatnonzero(edge)
    first = np.searchsorted(words.begins, cuts)
    full = np.flatnonzero(np.diff(first) > 0) if len(cuts) > 1 else np.zeros(0, np.int64)
    low, high, w0, w1 = cuts[full], cuts[full + 1], first[full], first[full + 1]

    def total(kind: np.ndarray) -> np.ndarray:
        run = np.zeros(n + 1, np.int64)
        np.cumsum(kind[data], out=run[1:])
        return (run[high] - run[low]).astype(float)

    n_words = (w1 - w0).astype(float)
    size = total((~BLANK).astype(np.int32))
    same = np.zeros(len(words.hashes) + 1, np.int64)
    if len(words.hashes) > 1:
        same[2:] = np.cumsum(words.hashes[1:] == words.hashes[:-1])
    stutter = np.maximum(same[w1] - same[np.minimum(w0 + 1, w1)], 0).astype(float)
    ended = _LAST[data[words.ends[w1 - 1] - 1]] if len(w1) else np.zeros(0, bool)
    own = np.stack(
        [
            np.log1p(n_words),
            np.log1p(n_words) * (n_words < 6),
            np.minimum(total(_SYMBOL) / n_words, 4),
            np.minimum(total(_BANG) / n_words, 4),
            total(_CAPITAL) / size,
            total(_DIGIT) / size,
            np.minimum(size / n_words, 30),
            stutter / n_words,
            ended.astype(float),
        ],
        1,
    ) if len(full) else np.zeros((0, OWN))
    bounds = np.searchsorted(low, offsets)
    bounds[-1] = len(low)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    inner = bounds[:-1][np.diff(bounds) > 0]
    before[inner] = 0
    after[bounds[1:][np.diff(bounds) > 0] - 1] = 0
    return Lines(np.concatenate([own, before, after], 1), size, bounds)


def joined(runs: list[Lines]) -> Lines:
    """The lines of several runs of texts as one."""
    bounds, base = [np.zeros(1, np.int64)], 0
    for r in runs:
        bounds.append(r.bounds[1:] + base)
        base += len(r.size)
    return Lines(
        np.concatenate([r.features for r in runs]),
        np.concatenate([r.size for r in runs]),
        np.concatenate(bounds),
    )


@dataclass(frozen=True)
class CrfModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    #: Weight of label j after label i; 0 bad, 1 good.
    moves: np.ndarray
    slope: float
    shift: float
    share: float
    constant: bool = False


def chains(gain: np.ndarray, moves: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward logs per line and log total per text; `gain` favours label 1.

    All texts of the run advance together, one line per step; a step costs only its texts.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    forth, back = np.zeros((len(gain), 2)), np.zeros((len(gain), 2))
    longest = int(sizes[0]) if len(sizes) else 0
    # How many texts have a line t.
    alive = np.searchsorted(-sizes, -np.arange(longest), "left")
    for t in range(longest):
        at = starts[: alive[t]] + t
        if t:
            last = forth[at - 1]
            forth[at] = np.logaddexp(last[:, :1] + moves[0], last[:, 1:] + moves[1])
        forth[at, 1] += gain[at]
    for t in range(longest - 2, -1, -1):
        at = starts[: alive[t + 1]] + t
        ahead = back[at + 1].copy()
        ahead[:, 1] += gain[at + 1]
        back[at] = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
    total = np.zeros(len(bounds) - 1)
    full = np.diff(bounds) > 0
    ends = forth[bounds[1:][full] - 1]
    total[full] = np.logaddexp(ends[:, 0], ends[:, 1])
    return forth, back, total


def good_odds(lines: Lines, model: CrfModel) -> np.ndarray:
    """P(good) of each line."""
    gain = ((lines.features - model.mean) / model.spread) @ model.weights + model.bias
    forth, back, total = chains(gain, model.moves, lines.bounds)
    return np.exp(forth[:, 1] + back[:, 1] - np.repeat(total, np.diff(lines.bounds)))


def weighted(odds: np.ndarray, lines: Lines) -> np.ndarray:
    """Mean odds by text, weighted by line length; NaN without lines."""
    sums = np.concatenate([[0.0], np.cumsum(odds * lines.size)])
    sizes = np.concatenate([[0.0], np.cumsum(lines.size)])
    low, high = lines.bounds[:-1], lines.bounds[1:]
    with np.errstate(invalid="ignore", divide="ignore"):
        return (sums[high] - sums[low]) / (sizes[high] - sizes[low])


def _logit(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


class _Adam:
    def __init__(self, n: int, rate: float) -> None:
        self.m, self.v, self.rate, self.k = np.zeros(n), np.zeros(n), rate, 0

    def move(self, grad: np.ndarray) -> np.ndarray:
        self.k += 1
        self.m, self.v = 0.9 * self.m + 0.1 * grad, 0.999 * self.v + 0.001 * grad**2
        return self.rate * (self.m / (1 - 0.9**self.k)) / (np.sqrt(self.v / (1 - 0.999**self.k)) + 1e-8)


def fit(rows: list[tuple[int, bytes]], counts: dict[int, int], params: CrfParams = CrfParams()) -> CrfModel:
    """Likelihood ascent on labelled texts; `counts` are the labels' numbers before sampling."""
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    labels = np.array([y for y, _ in rows], float)
    n = 3 * OWN
    if not total or labels.min(initial=1) == labels.max(initial=0):
        return CrfModel(np.zeros(n), np.ones(n), np.zeros(n), 0.0, np.zeros((2, 2)), 1.0, 0.0, share, True)
    texts = [t for _, t in rows]
    lines = joined([read_lines(data, offsets) for _, _, data, offsets in parts(pa.array(texts, pa.binary()))])
    sizes = np.diff(lines.bounds)
    owner = np.repeat(np.arange(len(rows)), sizes)
    y = labels[owner]
    weight = np.array([counts[int(k)] / max(1, (labels == k).sum()) for k in labels])
    weight /= weight.sum()
    # A text counts once, however many lines it has.
    each = (weight / np.maximum(sizes, 1))[owner]
    mean, spread = lines.features.mean(0), lines.features.std(0) + 1e-6
    x = (lines.features - mean) / spread
    w, bias, moves = np.zeros(n), 0.0, np.zeros((2, 2))
    adam = _Adam(n + 5, params.rate)
    # Lines that have a line before them in the same text.
    inner = np.ones(len(y), bool)
    inner[lines.bounds[:-1][sizes > 0]] = False
    inner = np.flatnonzero(inner)
    for _ in range(params.steps):
        gain = x @ w + bias
        forth, back, logs = chains(gain, moves, lines.bounds)
        p = np.exp(forth[:, 1] + back[:, 1] - logs[owner])
        miss = each * (y - p)
        ahead = back[inner].copy()
        ahead[:, 1] += gain[inner]
        push = np.zeros((2, 2))
        for i in (0, 1):
            for j in (0, 1):
                both = np.exp(forth[inner - 1, i] + moves[i, j] + ahead[:, j] - logs[owner[inner]])
                push[i, j] = (each[inner] * ((y[inner] == j) * (y[inner - 1] == i) - both)).sum()
        grad = np.concatenate([x.T @ miss - params.decay * w, [miss.sum()], (push - params.decay * moves).ravel()])
        step = adam.move(grad)
        w, bias, moves = w + step[:n], bias + step[n], moves + step[n + 1 :].reshape(2, 2)
    model = CrfModel(mean, spread, w, float(bias), moves, 1.0, 0.0, share)
    q = weighted(good_odds(lines, model), lines)
    known = ~np.isnan(q)
    z, target, mass = _logit(q[known]), labels[known], weight[known]
    curve, adam = np.array([1.0, 0.0]), _Adam(2, 0.05)
    for _ in range(300):
        miss = mass * (target - 1 / (1 + np.exp(-(curve[0] * z + curve[1]))))
        curve = curve + adam.move(np.array([(miss * z).sum() - 1e-3 * (curve[0] - 1), miss.sum()]))
    return CrfModel(mean, spread, w, float(bias), moves, max(0.05, float(curve[0])), float(curve[1]), share)


def sample(docs: DataFrame, labels: DataFrame, params: CrfParams, id_col: str, text: str, label: str) -> tuple[list, dict]:
    """Texts in bytes with their label, at most `most_per_label` of each, and the labels' counts."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    # At most 2 * most_per_label ids and labels, hence the broadcast.
    taken = [
        known.where(F.col("y") == y).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(params.most_per_label)
        for y in (0, 1)
    ]
    rows = (
        docs.select(F.col(id_col).alias("id"), text_bytes(text).alias("text"))
        .join(F.broadcast(taken[0].unionAll(taken[1])), "id")
        .select("y", "text")
        .toArrow()
    )
    return list(zip(rows.column("y").to_pylist(), rows.column("text").to_pylist(), strict=True)), counts


def score(docs: DataFrame, model: CrfModel, keys: list[Column], text: str = "text") -> DataFrame:
    """The `keys` with `score`, `n_lines` with words and `n_bad` lines more likely bad than good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for first, last, data, offsets in parts(batch.columns[-1]):
                lines = read_lines(data, offsets)
                odds = good_odds(lines, own)
                bad = np.concatenate([[0], np.cumsum(odds < 0.5)])
                q = weighted(odds, lines)
                found = 1 / (1 + np.exp(-(own.slope * _logit(q) + own.shift)))
                found[np.isnan(q) | own.constant] = own.share
                keys_ = [c.slice(first, last - first) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        *keys_,
                        pa.array(found, pa.float64()),
                        pa.array(np.diff(lines.bounds), pa.int64()),
                        pa.array(bad[lines.bounds[1:]] - bad[lines.bounds[:-1]], pa.int64()),
                    ],
                    [*batch.schema.names[:-1], "score", "n_lines", "n_bad"],
                )

    rows = docs.select(*keys, text_bytes(text).alias("body"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(scan, f"{kept}, score double, n_lines bigint, n_bad bigint")
