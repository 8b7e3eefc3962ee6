"""Ranked lexical search of many items at once: what items share is computed once per document.

A document's score for an item is a sum over the item's terms, so items that share terms share parts
of their sums. The query set is taken in blocks of at most 1,024 items or 65,536 terms. In a block:

1. Terms that occur in exactly the same items, equally often, form one node. Of the nodes of all
   items, the pairs found in most items are joined to new nodes, round by round, until no pair is in
   two items. Items and nodes now are a graph of sums without cycles, in which a sum that several
   items need has one node (`share`).
2. One pass over the texts writes, per document, its number of terms and the terms of the block
   with their frequencies. Counts of documents and terms over the whole corpus come from that table.
3. A second pass, over that table alone, takes a run of documents at a time: one accumulator per node
   and document, filled from the terms first and then along the graph, each once; items add up theirs.
   A task keeps the best documents per item; these meet per item in two steps, so that no
   task gets what all tasks have kept.

The score of term t in document d is w(t) * (10^9 tf div (1000 tf + 8 m(d))), with the weight
w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 100 - b + (b n N div L), in 64-bit integers.

Edge cases: texts and items that are null or have no term are no documents and have no results. Equal
scores go by ascending id, rows without an id last. Rows that share an id are documents, or items, of
their own. Very long texts are read in slices that end between terms, whole. Empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from candlewright.session import materialize

#: Bytes of UTF-8 that belong to terms: digits, letters, and all beyond ASCII.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
BETWEEN = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
BLOCK_ITEMS, BLOCK_TERMS = 1 << 10, 1 << 16
#: Bytes of a text read at a time.
SLICE = 1 << 20
#: Accumulators held at a time: nodes times documents.
CELLS = 1 << 22
#: Nodes of an item, the most common first, whose pairs are counted in a round. Bounds the time taken
#: to find shared sums; scores do not depend on it.
PAIRED = 64


@dataclass(frozen=True)
class SearchParams:
    top: int = 10
    #: Part of the length correction that grows with a document's length, in percent.
    b: int = 75


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased terms of a text, in slices."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > SLICE:
            found = BETWEEN.search(text, at + SLICE)
            end = found.start() if found else end
        yield TERM.findall(text[at:end].lower())
        at = end


@dataclass
class Shared:
    """Sums over terms: the first nodes are sums of terms, later ones of two nodes each."""

    #: Terms, and for each the node it belongs to.
    terms: list[bytes]
    node_of: list[int]
    #: Per round: new nodes and the two nodes each adds.
    rounds: list[list[tuple[int, int, int]]]
    #: Per item: nodes and how often each counts.
    items: list[list[tuple[int, int]]]
    nodes: int = field(default=0)

    @property
    def additions(self) -> int:
        """Additions of accumulators per document."""
        return sum(map(len, self.rounds)) + sum(len(x) for x in self.items)


def share(items: list[Counter[bytes]]) -> Shared:
    """The graph of sums for items given as terms with frequencies."""
    holders: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for i, item in enumerate(items):
        for term, times in item.items():
            holders[term].append((i, times))
    names = sorted(holders)
    first: dict[tuple[tuple[int, int], ...], int] = {}
    node_of = [first.setdefault(tuple(holders[t]), len(first)) for t in names]
    entries: list[set[tuple[int, int]]] = [set() for _ in items]
    for held, node in first.items():
        for i, times in held:
            entries[i].add((node, times))
    rounds, nodes = [], len(first)
    while True:
        spread = Counter(e for own in entries for e in own)
        together: Counter[tuple[tuple[int, int], tuple[int, int]]] = Counter()
        for own in entries:
            common = sorted((e for e in own if spread[e] > 1), key=lambda e: (-spread[e], e))[:PAIRED]
            together.update((a, b) for a, b in combinations(sorted(common), 2) if a[1] == b[1])
        taken: set[tuple[int, int]] = set()
        added = []
        for (a, b), n in sorted(together.items(), key=lambda x: (-x[1], x[0])):
            if n < 2:
                break
            if a in taken or b in taken:
                continue
            taken |= {a, b}
            added.append((nodes, a, b))
            nodes += 1
        if not added:
            break
        partner = {}
        for node, a, b in added:
            partner[a] = (b, (node, a[1]))
        for own in entries:
            for a in [e for e in own if e in partner]:
                b, joint = partner[a]
                if b in own:
                    own -= {a, b}
                    own.add(joint)
        rounds.append([(node, a[0], b[0]) for node, a, b in added])
    return Shared(names, node_of, rounds, [sorted(x) for x in entries], nodes)


class Evaluator:
    """Scores of all items of a block for a run of documents."""

    def __init__(self, shared: Shared, weights: np.ndarray, params: SearchParams, n: int, length: int):
        self.shared, self.weights, self.params, self.n, self.length = shared, weights, params, n, length
        self.node_of = np.array(shared.node_of, np.int64)
        self.rounds = [np.array(r, np.int64).T for r in shared.rounds]
        self.used = [(i, x) for i, x in enumerate(shared.items) if x]
        self.at_once = max(1, CELLS // max(1, shared.nodes))

    def scores(self, sizes: np.ndarray, ends: np.ndarray, ids: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Item by document; `ids` and `times` are the documents' terms, cut at `ends`."""
        b = self.params.b
        m = 100 - b + (b * sizes * self.n) // self.length
        doc = np.repeat(np.arange(len(sizes)), np.diff(ends))
        value = self.weights[ids] * ((1_000_000_000 * times) // (1000 * times + 8 * m[doc]))
        sums = np.zeros((self.shared.nodes, len(sizes)), np.int64)
        np.add.at(sums, (self.node_of[ids], doc), value)
        for node, left, right in self.rounds:
            sums[node] = sums[left] + sums[right]
        out = np.zeros((len(self.used), len(sizes)), np.int64)
        for k, (_, parts) in enumerate(self.used):
            for node, count in parts:
                out[k] += sums[node] if count == 1 else count * sums[node]
        return out


def _blocks(items: DataFrame, id_col: str, text: str) -> Iterator[tuple[list, list[Counter[bytes]]]]:
    """Ids and terms of the items, some at a time."""
    ids, found, held = [], [], set()
    for row in items.select(F.col(id_col).alias("id"), F.col(text).alias("text")).toLocalIterator():
        own: Counter[bytes] = Counter()
        for part in terms((row["text"] or "").encode()):
            own.update(part)
        if not own:
            continue
        if ids and (len(ids) == BLOCK_ITEMS or len(held.union(own)) > BLOCK_TERMS):
            yield ids, found
            ids, found, held = [], [], set()
        ids.append(row["id"])
        found.append(own)
        held.update(own)
    if ids:
        yield ids, found


def postings(docs: DataFrame, names: list[bytes], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`row, id, n, ids, times`: number of terms, and those of `names` with their frequencies."""
    known = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(names)})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            sizes, ends, ids, times = [], [0], [], []
            for k in range(batch.num_rows):
                found: Counter[int | None] = Counter()
                for part in terms(batch.column(2)[k].as_py()):
                    found.update(map(number, part))
                sizes.append(found.total())
                found.pop(None, 0)
                ids += found.keys()
                times += found.values()
                ends.append(len(ids))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(times, pa.int64())),
                ],
                ["row", "id", "n", "ids", "times"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(read, f"row bigint, id {kind}, n bigint, ids array<int>, times array<bigint>")


def _best(found: DataFrame, evaluator: Evaluator) -> DataFrame:
    """`item, row, id, score`: the best documents of each task for each item."""
    spark, top = found.sparkSession, evaluator.params.top
    shared = spark.sparkContext.broadcast(evaluator)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        kept: list[list[tuple]] = [[] for _ in own.used]
        least = np.ones(len(own.used), np.int64)
        kinds = None
        for batch in batches:
            kinds = batch.schema
            for k in range(0, batch.num_rows, own.at_once):
                part = batch.slice(k, own.at_once)
                lists, times = part.column(3), part.column(4)
                scores = own.scores(
                    part.column(2).to_numpy(),
                    lists.offsets.to_numpy().astype(np.int64),
                    lists.flatten().to_numpy(),
                    times.flatten().to_numpy(),
                )
                ids = part.column(1).to_pylist()
                rows = part.column(0).to_pylist()
                for item in np.flatnonzero((scores >= least[:, None]).any(axis=1)):
                    line = scores[item]
                    new = np.flatnonzero(line >= least[item])
                    if len(new) > 4 * top:  # only what is not below the run's own last place
                        limit = np.partition(line[new], -top)[-top]
                        new = new[line[new] >= limit]
                    mine = kept[item]
                    mine += [(-int(line[d]), ids[d] is None, ids[d], rows[d]) for d in new]
                    mine.sort(key=lambda x: (x[:2], x[3]) if x[1] else (x[:2], x[2], x[3]))
                    del mine[top:]
                    if len(mine) == top:
                        least[item] = -mine[-1][0]
        if kinds is None:
            return
        out = [(own.used[i][0], x[3], x[2], -x[0]) for i, mine in enumerate(kept) for x in mine]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in out], pa.int32()),
                pa.array([x[1] for x in out], pa.int64()),
                pa.array([x[2] for x in out], kinds.field(1).type),
                pa.array([x[3] for x in out], pa.int64()),
            ],
            ["item", "row", "id", "score"],
        )

    kind = dict(found.dtypes)["id"]
    return found.mapInArrow(scan, f"item int, row bigint, id {kind}, score bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    params: SearchParams = SearchParams(),
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """`item, rank, id, score`: the best documents of every item, the highest score first."""
    spark = docs.sparkSession
    out, total = None, None
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    kinds = f"item int, item_id {dict(items.dtypes)[item_col]}"
    for item_ids, counted in _blocks(items, item_col, item_text):
        shared = share(counted)
        found = materialize(postings(docs, shared.terms, id_col, text), "postings")
        if total is None:
            total = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        n, length = total
        if not n:
            break
        held = dict(
            found.select(F.explode("ids").alias("term")).groupBy("term").count().toLocalIterator()
        )
        weights = np.array(
            [math.floor(1000 * math.log((2 * n + 2) / (2 * held.get(k, 0) + 1))) for k in range(len(shared.terms))],
            np.int64,
        )
        best = _best(found.where("size(ids) > 0"), Evaluator(shared, weights, params, n, length))
        dealt = Window.partitionBy("item", "part").orderBy(*order)
        best = best.withColumn("part", F.spark_partition_id() % 64)
        best = best.withColumn("rank", F.row_number().over(dealt)).where(F.col("rank") <= params.top)
        whole = Window.partitionBy("item").orderBy(*order)
        best = best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= params.top)
        names = spark.createDataFrame(list(enumerate(item_ids)), kinds)
        best = best.join(names, "item").select(F.col("item_id").alias("item"), "rank", "id", "score")
        best = materialize(best, "ranked")
        out = best if out is None else out.unionAll(best)
    if out is None:
        kinds = f"item {dict(items.dtypes)[item_col]}, rank int, id {dict(docs.dtypes)[id_col]}, score bigint"
        out = spark.createDataFrame([], kinds)
    return out
