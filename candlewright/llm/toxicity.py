"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A sentence has probability s = sigmoid(b + sum of the weights of its distinct words, where a word's
weight is its own plus those of its beginnings of 4 to 7 letters); a document is
toxic if any sentence is: 1 - prod(1 - s), the noisy-or. The weights follow the gradient of the
document labels' likelihood through the noisy-or, so blame falls on the sentences that explain a
label, and these can be shown.

The model is fitted on a bounded sample of labelled documents, up to `most_per_label` of each label
taken by a hash of the id and weighted back to the labels' shares. Scoring covers all texts.

Edge cases: a null text or one without words has no sentence and scores 0. Rows of a repeated id are
scored one by one; a repeated label row counts again. Null labels are not learned from. Without
toxic or without harmless labels every text scores the labels' mean, or 0.5 if there are none.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class ToxicParams:
    most_per_label: int = 2000
    #: Documents of the sample a word or beginning must occur in.
    min_docs: int = 5
    steps: int = 150
    rate: float = 0.1
    decay: float = 3e-5
    start: float = -5.0
    #: Weights below this are dropped after fitting.
    least_weight: float = 0.02


SENTENCE = re.compile(r"[.!?\n]+")
WORD = re.compile(r"\w+")


#: Lengths of the beginnings of a word that are features beside the word.
BEGINNINGS = (4, 5, 6, 7)
#: Words whose weight a Python worker remembers.
KEPT_WORDS = 1 << 18


def word_features(word: str) -> list[str]:
    return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) > n]]


def sentences(text: str) -> list[str]:
    return [s for s in SENTENCE.split(text) if WORD.search(s)]


def softplus(z: float) -> float:
    return z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))


@dataclass(frozen=True)
class ToxicModel:
    bias: float
    weights: dict[str, float]
    #: Score of every text when the labels do not allow a fit.
    constant: float | None = None
    kept: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        found = self.kept.get(word)
        if found is None:
            if len(self.kept) >= KEPT_WORDS:
                self.kept.clear()
            found = self.kept[word] = sum(self.weights.get(f, 0.0) for f in word_features(word))
        return found

    def sentence_logs(self, text: str) -> tuple[float, float, int]:
        """log(1 - score), the worst sentence's probability and its number (-1: none)."""
        weight, bias = self.weight, self.bias
        clean, worst, at, k = 0.0, 0.0, -1, 0
        # Sentences without a known word share one value.
        plain = softplus(bias)
        for s in SENTENCE.split(text.lower()):
            words = WORD.findall(s)
            if not words:
                continue
            z = bias + math.fsum(map(weight, set(words)))
            clean -= plain if z == bias else softplus(z)
            if at < 0 or z > worst:
                worst, at = z, k
            k += 1
        return float(clean), float(1 / (1 + np.exp(-worst))) if at >= 0 else 0.0, at


def sample(docs: DataFrame, labels: DataFrame, params: ToxicParams, id_col: str, text: str, label: str) -> tuple[list, dict]:
    """Texts with label and weight, at most `most_per_label` of each label, and the labels' counts."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    # At most 2 * most_per_label ids and labels, hence the broadcast.
    taken = [
        known.where(F.col("y") == y).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(params.most_per_label)
        for y in (0, 1)
    ]
    rows = (
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(F.broadcast(taken[0].unionAll(taken[1])), "id")
        .select("y", "text")
        .toArrow()
    )
    return list(zip(rows.column("y").to_pylist(), rows.column("text").to_pylist(), strict=True)), counts


def fit(rows: list[tuple[int, str]], counts: dict[int, int], params: ToxicParams = ToxicParams()) -> ToxicModel:
    """Noisy-or gradient ascent on labelled texts; `counts` are the labels' numbers before sampling."""
    total = sum(counts.values())
    labels = np.array([y for y, _ in rows], float)
    if not total or labels.min(initial=1) == labels.max(initial=0):
        return ToxicModel(0.0, {}, counts.get(1, 0) / total if total else 0.5)
    names: dict[str, int] = {}
    words, lengths, owners = array("i"), array("i"), array("i")
    for d, (_, text) in enumerate(rows):
        for s in SENTENCE.split(text.lower()):
            own = [f for w in sorted(set(WORD.findall(s))) for f in word_features(w)]
            if own:
                words.extend([names.setdefault(w, len(names)) for w in own])
                lengths.append(len(own))
                owners.append(d)
    word, owner = np.frombuffer(words, np.int32), np.frombuffer(owners, np.int32)
    of = np.repeat(np.arange(len(lengths), dtype=np.int32), np.frombuffer(lengths, np.int32))
    pairs = word.astype(np.int64) * len(rows) + owner[of]
    pairs.sort()
    first = np.concatenate([[True], pairs[1:] != pairs[:-1]]) if len(pairs) else np.zeros(0, bool)
    usual = np.bincount(pairs[first] // len(rows), minlength=len(names)) >= params.min_docs
    del pairs, first
    number = np.cumsum(usual) - 1
    keep = usual[word]
    word, of = number[word[keep]].astype(np.int32), of[keep]
    n_words, n_sentences = int(usual.sum()), len(lengths)
    weight = np.array([counts[int(y)] / max(1, (labels == y).sum()) for y in labels])
    weight /= weight.sum()

    w, bias = np.zeros(n_words), params.start
    m, v = np.zeros(n_words + 1), np.zeros(n_words + 1)
    for step in range(1, params.steps + 1):
        z = bias + np.bincount(of, w[word], n_sentences)
        clean = np.bincount(owner, -np.logaddexp(0, z), len(rows))
        p = -np.expm1(clean)
        # d log P(label) / dz of a sentence: its s for a harmless text, shared blame for a toxic one.
        blame = labels * (1 - p) / np.maximum(p, 1e-12) - (1 - labels)
        g = (weight * blame)[owner] / (1 + np.exp(-z))
        grad = np.append(np.bincount(word, g[of], n_words) - params.decay * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = params.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w + move[:-1], bias + move[-1]
    kept = [x for x, k in names.items() if usual[k]]
    found = {x: float(a) for x, a in zip(kept, w, strict=True) if abs(a) >= params.least_weight}
    return ToxicModel(float(bias), found)


def score(docs: DataFrame, model: ToxicModel, keys: list[Column], text: str = "text") -> DataFrame:
    """The `keys` with `score`, and the worst sentence: `worst` (its number), `worst_score`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.sentence_logs(t) for t in _texts(batch)]
            whole = [-np.expm1(x[0]) if own.constant is None else own.constant for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(whole, pa.float64()),
                    pa.array([x[2] for x in found], pa.int32()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                [*batch.schema.names[:-1], "score", "worst", "worst_score"],
            )

    rows = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("body"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(scan, f"{kept}, score double, worst int, worst_score double")


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    """The last column's texts, a few rows in Python at a time."""
    for k in range(0, batch.num_rows, 256):
        yield from batch.slice(k, 256).columns[-1].to_pylist()


def offending(docs: DataFrame, model: ToxicModel, at: float = 0.5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`id, sentence, probability, words`: every sentence that alone reaches `at`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids, numbers, odds, said = [], [], [], []
            for k, t in enumerate(_texts(batch)):
                for j, s in enumerate(sentences(t)):
                    z = own.bias + math.fsum(map(own.weight, set(WORD.findall(s.lower()))))
                    p = 1 / (1 + np.exp(-z))
                    if p >= at:
                        ids.append(k)
                        numbers.append(j)
                        odds.append(float(p))
                        said.append(s.strip())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(ids, pa.int64())),
                    pa.array(numbers, pa.int32()),
                    pa.array(odds, pa.float64()),
                    pa.array(said, pa.string()),
                ],
                ["id", "sentence", "probability", "words"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(scan, f"id {kind}, sentence int, probability double, words string")
