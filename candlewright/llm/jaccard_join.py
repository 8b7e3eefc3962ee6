"""Texts whose sets of word n-grams reach a Jaccard similarity, and their groups.

The setting is 3-grams and 0.9 unless `JoinParams` says otherwise; the numbers below are for it.

Prefix filtering under several global orders. If two sets of n and m tokens reach the similarity,
they share a token among the first n - ceil(0.9 n) + 1 of one and the same number of the other, in
whatever order all tokens stand. Every order here puts rare tokens first, by a count of all tokens in
a table of fixed width, and breaks ties by its own hash. Texts meet on the prefix tokens of the first
order. Under each other order the prefix is longer by some tokens, and then at least so many more must
be shared; a pair goes on only if it meets this under every order, and is then verified on the whole
sets. Counts only rank tokens: a wrong count costs time, never a link.

Equal sets are one node. The nodes of a token are cut into runs by size, where sizes leave a gap that
no link can cross. A prefix token that no other prefix of like size has is in no set whose own prefix
reaches further in the order. So of two nodes, the one whose prefix ends first has at most its other
tokens in common with the other, which rules most pairs out. In a run, nodes are first compared with its head, the
node whose prefix most others share, and with one other. What that links is one component, and only pairs of
different components are compared after that, so a large group of near copies costs a few comparisons
per text instead of all pairs. Where a run has few such pairs for its nodes, they go through the
filters as they are. Elsewhere they are found by what the two differ in from their head: at
least one is not linked with it, so the differences must share tokens, and meet on prefixes again.
Copies changed in different places have nothing there to share. Either way finds any link between
different components; the choice is one of cost only.

Edge cases: a null, empty or blank text has an empty set, is linked with nothing, and forms its own
component. Texts with fewer words than a 3-gram have the whole sequence as their only token. Rows
that share an id but not a text are separate texts; repeated rows are one node. A row without an id
takes part, and its component is named after the smallest id there is, or null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from candlewright.llm import blocks
from candlewright.llm.graph import components
from candlewright.llm.tokens import hash_words, mix, parts, text_bytes
from candlewright.session import materialize


@dataclass(frozen=True)
class JoinParams:
    size: int = 3
    #: Similarity in percent.
    percent: int = 90
    #: Cells of the table that counts tokens for their rank; a power of two.
    cells: int = 1 << 20
    orders: int = 3
    #: Least and most bits of the table that marks texts to read again; powers of two. Between them it
    #: has eight for every text. Beyond, more texts are read in vain.
    marks: int = 1 << 22
    most_marks: int = 1 << 30
    #: Pairs of different components that a run may have per node to be paired as it is.
    few: int = 8
    #: Nodes of such a run that one task pairs with the others.
    piece: int = 1 << 16


#: Bits in one of Spark's bitmaps.
_BUCKET = 1 << 15
_STEPS = mix(np.arange(1, 64, dtype=np.uint64)) | np.uint64(1)


def token_sets(column: pa.Array, size: int) -> Iterator[list[np.ndarray]]:
    """Sorted distinct token hashes of each text, for runs of texts in order."""
    for _, _, data, offsets in parts(column):
        words = hash_words(data, offsets)
        h = words.hashes
        runs = np.zeros(max(len(h) - size + 1, 0), np.uint64)
        for j in range(size):
            runs += h[j : len(h) - size + 1 + j] * _STEPS[j] if len(runs) else runs
        runs = mix(runs)
        out = []
        for low, high in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            if high - low >= size:
                out.append(np.unique(runs[low : high - size + 1]))
            elif high > low:
                few = h[low:high] * _STEPS[: high - low]
                out.append(mix(few.sum(keepdims=True) + _STEPS[size + high - low : size + high - low + 1]))
            else:
                out.append(np.zeros(0, np.uint64))
        yield out


def _node(tokens: np.ndarray) -> int:
    """One number for a set."""
    total = mix(tokens ^ _STEPS[0]).sum(keepdims=True) + np.uint64(len(tokens))
    return int(mix(total).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _order_key(tokens: np.ndarray, ranks: np.ndarray, order: int) -> np.ndarray:
    """Sorts tokens by an order: rare ones first."""
    rank = ranks[(tokens & np.uint64(len(ranks) - 1)).astype(np.int64)].astype(np.uint64)
    return (rank << np.uint64(56)) | (mix(tokens ^ _STEPS[8 + order]) >> np.uint64(8))


def _ranked(tokens: np.ndarray, ranks: np.ndarray, order: int, n: int) -> np.ndarray:
    """The first n tokens of an order."""
    if n >= len(tokens):
        return tokens
    return tokens[np.argpartition(_order_key(tokens, ranks, order), n - 1)[:n]]


def least_shared(n: int, percent: int) -> int:
    """How many tokens more than the least possible a prefix is long, and must share, one included."""
    return (prefix_length(n, percent) + 1) // 2


def long_prefix(tokens: np.ndarray, ranks: np.ndarray, order: int, percent: int) -> bytes:
    """Sorted short forms of a longer prefix; equal tokens have equal short forms."""
    n = len(tokens)
    own = _ranked(tokens, ranks, order, prefix_length(n, percent) + least_shared(n, percent) - 1)
    return np.sort((own >> np.uint64(32)).astype(np.uint32)).tobytes()


def _keys_schema(df: DataFrame) -> str:
    kind = dict(df.dtypes)["id"]
    return f"id {kind}, n bigint, node bigint, name string, block int, data binary"


def keyed(docs: DataFrame, params: JoinParams, id_col: str, text: str) -> DataFrame:
    """A row `id, n, node` per text, and among them rows `name, block, data` with token counts."""
    size, cells = params.size, params.cells

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(cells, np.int64), False
        for batch in batches:
            done = 0
            for sets in token_sets(batch.column(1), size):
                every = np.concatenate(sets)
                if len(every):
                    seen = True
                    at = (every & np.uint64(cells - 1)).astype(np.int64)
                    counts += np.bincount(at, minlength=cells)
                ids = batch.column(0).slice(done, len(sets))
                done += len(sets)
                none = pa.nulls(len(sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                        none.cast(pa.string()),
                        none.cast(pa.int32()),
                        none.cast(pa.binary()),
                    ],
                    ["id", "n", "node", "name", "block", "data"],
                )
        if seen:
            for block, data in blocks.split(counts.astype(np.uint32)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(1).cast(kind),
                        pa.nulls(1).cast(pa.int64()),
                        pa.nulls(1).cast(pa.int64()),
                        pa.array(["tokens"]),
                        pa.array([block], pa.int32()),
                        pa.array([data], pa.binary()),
                    ],
                    ["id", "n", "node", "name", "block", "data"],
                )

    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text).alias("text"))
    kind = _arrow_type(rows)
    return rows.mapInArrow(scan, _keys_schema(rows))


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["id"].dataType)


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank class of each cell: how many doublings it stands above the usual load of a cell."""
    usual = np.median(counts)
    return np.floor(np.log2(1 + np.maximum(0, counts - usual))).astype(np.uint8)


def _spread(keys: DataFrame, params: JoinParams) -> np.ndarray:
    sums = blocks.summed(keys.where(F.col("block").isNotNull()), "uint32")
    return rarity(blocks.gathered(sums, params.cells).get("tokens", np.zeros(params.cells)))


def signatures(docs: DataFrame, ranks, params: JoinParams, text: str) -> DataFrame:
    """`node, n, last, prefix, others`: the prefix tokens of the first order, and longer ones of the others.

    `last` is where the prefix ends in the first order. A node has a row per task that met it.
    """
    size, percent, orders = params.size, params.percent, params.orders

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = ranks.value, set()
        for batch in batches:
            for sets in token_sets(batch.column(0), size):
                nodes, sizes, lasts, prefixes, others = [], [], [], [], []
                for s in sets:
                    if not len(s):
                        continue
                    node = _node(s)
                    if node in known:
                        continue
                    known.add(node)
                    nodes.append(node)
                    sizes.append(len(s))
                    prefixes.append(_ranked(s, table, 0, prefix_length(len(s), percent)))
                    lasts.append(int(_order_key(prefixes[-1], table, 0).max()))
                    others.append([long_prefix(s, table, k, percent) for k in range(1, orders)])
                if len(known) > 1_000_000:  # this only saves repeats
                    known.clear()
                if nodes:
                    ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])])
                    flat = np.concatenate(prefixes).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(nodes, pa.int64()),
                            pa.array(sizes, pa.int64()),
                            pa.array(lasts, pa.int64()),
                            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                            pa.array(others, pa.list_(pa.binary())),
                        ],
                        ["node", "n", "last", "prefix", "others"],
                    )

    return docs.select(text_bytes(text).alias("text")).mapInArrow(
        scan, "node bigint, n bigint, last bigint, prefix array<bigint>, others array<binary>"
    )


def _meetings(signed: DataFrame, percent: int) -> DataFrame:
    """`token, run, node, n, last, most, kin`: nodes under their prefix tokens where another of like size is.

    Runs of a token are cut where a size is too small for the next. A prefix token of a node that is
    not met in any run is in no other prefix of like size, so of its n tokens at most `most`, n less
    these, can be common with a node whose prefix ends no sooner. One whose prefix ends before may have
    the token behind its prefix. `kin` grows with the nodes met on them.
    """
    rows = signed.select(F.explode("prefix").alias("token"), "node", "n", "last")
    by_size = W.partitionBy("token").orderBy("n", "node")
    fits = lambda small, large: F.coalesce(100 * small >= percent * large, F.lit(False))
    rows = (
        rows.withColumn("back", fits(F.lag("n").over(by_size), F.col("n")))
        .withColumn("ahead", fits(F.col("n"), F.lead("n").over(by_size)))
        .withColumn("run", F.sum((~F.col("back")).cast("int")).over(by_size))
        .where("back or ahead")
    )
    by_run = W.partitionBy("token", "run")
    rows = (
        rows.select("token", "run", "node", "n", "last")
        .withColumn("lo", F.min("node").over(by_run))
        .withColumn("hi", F.max("node").over(by_run))
        .withColumn("met", F.count("*").over(by_run))
        .where("lo <> hi")
        .select("token", "run", "node", "n", "last", "met")
        .distinct()
    )
    rows = materialize(rows, "meetings")
    met = rows.groupBy("node", "n").agg(F.count("*").alias("met"), F.sum(F.log("met")).alias("logs"))
    longest = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    most = met.select(
        "node",
        (F.col("n") - longest + F.col("met")).cast("bigint").alias("most"),
        (F.col("logs") / longest).cast("double").alias("kin"),
    )
    return rows.drop("met").join(most, "node")


def _fits(a: list[str], b: list[str], percent: int) -> Column:
    """Whether two sets can be similar, from their columns `n, last, most`: by their sizes and what
    the one whose prefix ends first can have in common with the other."""
    (na, last_a, most_a), (nb, last_b, most_b) = [[F.col(c) for c in x] for x in (a, b)]
    most = F.when(last_a <= last_b, most_a).otherwise(most_b)
    common = (100 + percent) * most >= percent * (na + nb)
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & common


def _pair(a: str, b: str, na: str, nb: str) -> list[Column]:
    """Columns `a, b` in order with their sizes."""
    first = F.col(a) < F.col(b)
    return [
        F.least(a, b).alias("a"),
        F.greatest(a, b).alias("b"),
        F.when(first, F.col(na)).otherwise(F.col(nb)).alias("na"),
        F.when(first, F.col(nb)).otherwise(F.col(na)).alias("nb"),
    ]


def _star_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """Every node with the head of its run, and with the node of the largest number."""
    by_run = W.partitionBy("token", "run")
    rows = shared.withColumn("head", F.max(_head()).over(by_run)).withColumn("end", F.max(F.struct("node", "n", "last", "most")).over(by_run))
    pairs = [
        rows.where(F.col("node") != F.col(f"{other}.node"))
        .where(_fits(["n", "last", "most"], [f"{other}.{c}" for c in ("n", "last", "most")], percent))
        .select(*_pair("node", f"{other}.node", "n", f"{other}.n"))
        for other in ("head", "end")
    ]
    return pairs[0].unionAll(pairs[1]).distinct()


def _head() -> Column:
    """Orders the nodes of a run: its head, the largest, is the one whose prefix most others share."""
    return F.struct("kin", "node", "n", "last", "most")


def _crossing(shared: DataFrame, labels: DataFrame, params: JoinParams) -> DataFrame:
    """`token, run, node, n, last, most, comp, head, few, main, pieces`: nodes of runs with several components.

    `head` is the run's, `main` its component with most nodes, `few` tells whether the run has few pairs
    of different components, `pieces` how many tasks share the run.
    """
    percent, at = params.percent, ["token", "run"]
    rows = shared.join(labels, "node", "left").withColumn("comp", F.coalesce("label", "node"))
    rows = materialize(rows.select(*at, "node", "n", "last", "most", "kin", "comp"), "members")
    by_comp = rows.groupBy(*at, "comp").agg(
        F.max(_head()).alias("head"),
        F.min("n").alias("low"),
        F.max("most").alias("top"),
        F.count("*").alias("nodes"),
    )
    runs = by_comp.groupBy(*at).agg(
        F.max("head")["node"].alias("head"),
        F.min("low").alias("low"),
        F.max("top").alias("top"),
        F.count("*").alias("comps"),
        F.max(F.struct("nodes", "comp"))["comp"].alias("main"),
        F.ceil(F.sum("nodes") / params.piece).alias("pieces"),
        F.sum("nodes").alias("nodes"),
        F.sum(F.col("nodes").cast("double") * F.col("nodes")).alias("within"),
    )
    pairs = (F.col("nodes").cast("double") * F.col("nodes") - F.col("within")) / 2
    runs = runs.where("comps > 1").withColumn("few", pairs <= params.few * F.col("nodes"))
    # Whichever prefix ends first, what a node can have in common with another of the run is `top` at most.
    common = f"{100 + percent} * top >= {percent} * (n + greatest(low, {percent} * n / 100))"
    return (
        rows.join(runs.select(*at, "head", "low", "top", "few", "main", "pieces"), at)
        .where(common)
        .select(*at, "node", "n", "last", "most", "comp", "head", "few", "main", "pieces")
    )


def _plain_pairs(crossing: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in runs that have few of them.

    The nodes outside a run's main component, of which there are few, meet all nodes of the run, which
    are dealt in pieces. So nodes of the main component, however many, are not tried with each other.
    """
    rows = crossing.where("few")
    at = ["token", "run", "piece"]
    values = ["node", "n", "last", "most", "comp"]
    side = lambda df, x: df.select(*at, "main", *[F.col(c).alias(f"{c}_{x}") for c in values])
    outside = rows.where("comp <> main").withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1))
    )
    dealt = rows.withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")))
    return (
        side(outside, "a")
        .drop("main")
        .join(side(dealt, "b"), at)
        .where("comp_a <> comp_b and (comp_b = main or node_a < node_b)")
        .where(_fits(["n_a", "last_a", "most_a"], ["n_b", "last_b", "most_b"], percent))
        .select(*_pair("node_a", "node_b", "n_a", "n_b"))
        .distinct()
    )


def _spokes(crossing: DataFrame) -> DataFrame:
    """`a, b, n, comp`: nodes `a` of the other runs, with the run's head `b`."""
    return (
        crossing.where("not few and node <> head")
        .select(F.col("node").alias("a"), F.col("head").alias("b"), "n", "comp")
        .distinct()
    )


def slack(n: int, m: int, percent: int) -> int:
    """Sets of n and m tokens that reach the similarity differ in at most so many."""
    return (n + m) * (100 - percent) // (100 + percent)


def _differences(spokes: DataFrame, sets: DataFrame, ranks, params: JoinParams) -> DataFrame:
    """`head, token, node, n, comp, size, at`: the prefix of what each node differs in from its head.

    Two nodes differ in what is in one of these differences only. `at` is the place of the token,
    `size` the number of all of them.
    """
    percent = params.percent
    columns = ["head", "token", "node", "n", "comp", "size", "at"]

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, head, n, comp, members, x, y in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                tokens = np.setxor1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True)
                most = slack(n, 100 * n // percent, percent)
                size = len(tokens)
                # From the place p on, size - p tokens are left to be shared with a difference of one
                # token or more, and of size - most or more.
                length = min(most, (size + most - 1) // 2) + 1
                # In how many differences from this head a token is, by what its rank class tells.
                key = _order_key(tokens, ranks.value, 0)
                count = np.exp2((key >> np.uint64(56)).astype(np.float64))
                lacking = np.isin(tokens, np.frombuffer(y, np.uint64))
                count[lacking] = np.maximum(members - count[lacking], members / 16)
                own = tokens[np.lexsort((key, count))[:length]]
                k = len(own)
                same = [np.full(k, v, np.int64) for v in (node, n, comp, size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (np.full(k, head, np.int64), own.view(np.int64), *same, np.arange(k))],
                    columns,
                )

    spokes = spokes.join(spokes.groupBy("b").agg(F.count("*").alias("members")), "b")
    both = _beside(spokes, sets, "tokens").select("a", "b", "n", "comp", "members", "x", "y")
    return both.mapInArrow(differ, ", ".join(f"{c} bigint" for c in columns))


def _cross_pairs(spokes: DataFrame, sets: DataFrame, ranks, params: JoinParams) -> DataFrame:
    """Pairs with a head in common that lie in different components.

    One of the two is then not linked with the head. With D the difference from the head, i and j
    differ in |D(i)| + |D(j)| tokens less twice the common ones of D(i) and D(j). If these had none in
    common, i and j could only be similar if both were similar to the head; so they share some, and
    at the first shared one enough are left in both.
    """
    percent = params.percent
    rows = _differences(spokes, sets, ranks, params).withColumn(
        "limit", F.col("size") - 2 * F.col("at") + F.expr(f"(n + 100 * n div {percent}) * {100 - percent} div {100 + percent}")
    )
    rows = materialize(rows, "differences")
    at = ["head", "token"]
    small = rows.groupBy(*at).agg(F.min("size").alias("least"), F.max("limit").alias("most"))
    rows = rows.join(small, at).where("size <= most and least <= limit").drop("least", "most")
    comps = rows.groupBy(*at).agg(F.min("comp").alias("one"), F.max("comp").alias("other"))
    rows = materialize(rows.join(comps.where("one <> other").select(*at), at, "left_semi"), "differences")
    side = lambda x: rows.select(*at, *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "comp", "size", "at")])
    room = f"(n_a + n_b) * {100 - percent} div {100 + percent}"
    return (
        side("a")
        .join(side("b"), at)
        .where("node_a < node_b and comp_a <> comp_b")
        .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        .where(f"size_b <= size_a - 2 * at_a + {room} and size_a <= size_b - 2 * at_b + {room}")
        .select(*_pair("node_a", "node_b", "n_a", "n_b"))
        .distinct()
    )


def _marked(values: DataFrame, most: int, params: JoinParams):
    """A table of bits in which the numbers of a column `x` are marked; there are `most` at most."""
    marks = min(params.most_marks, max(params.marks, 1 << (8 * most).bit_length()))
    place = F.col("x").bitwiseAND(F.lit(marks - 1)) + 1
    parts = (
        values.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()
    )
    table = np.zeros((max(marks // _BUCKET, 1), _BUCKET // 8), np.uint8)
    for row in parts:
        table[row["part"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return values.sparkSession.sparkContext.broadcast((table.reshape(-1), marks))


def _hit(marked: tuple[np.ndarray, int], x: np.ndarray) -> np.ndarray:
    bits, marks = marked
    at = x & np.int64(marks - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def _beside(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """The pairs with the value of either end as `x` and `y`."""
    for end, column in (("a", "x"), ("b", "y")):
        pairs = pairs.join(values.select(F.col("node").alias(end), F.col(name).alias(column)), end)
    return pairs


def _common(x: bytes, y: bytes) -> int:
    """Common short forms, and as many more as one form may stand for."""
    p, q = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
    one = np.unique(p)
    return len(np.intersect1d(one, np.unique(q), True)) + len(p) - len(one)


def _candidates(pairs: DataFrame, signed: DataFrame, params: JoinParams) -> DataFrame:
    """Pairs whose longer prefixes share enough under every further order."""
    percent = params.percent
    bits = _marked(_ends(pairs).select(F.col("node").alias("x")), 2 * pairs.count(), params)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_hit(bits.value, batch.column(0).to_numpy())))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, x, y in zip(*[c.to_pylist() for c in batch.columns[2:]], strict=True):
                # Either prefix holds so many common tokens at least; both do for the smaller number.
                least = min(least_shared(na, percent), least_shared(nb, percent))
                keep.append(all(_common(p, q) >= least for p, q in zip(x, y, strict=True)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    some = signed.select("node", "others").mapInArrow(marked, "node bigint, others array<binary>")
    both = _beside(pairs, some, "others").select("a", "b", "na", "nb", "x", "y")
    return materialize(both.mapInArrow(meet, "a bigint, b bigint").distinct(), "candidates")


def _sets_of(
    docs: DataFrame, keys: DataFrame, pairs: DataFrame, params: JoinParams, id_col: str, text: str
) -> DataFrame:
    """`node, tokens` of the nodes in the pairs, each from one text that has the set.

    The texts are marked and read again, so that no text is shuffled. A text that falls on another's
    mark is only emitted in vain.
    """
    size = params.size
    carriers = (
        keys.where(F.col("node").isNotNull())
        .join(_ends(pairs), "node", "left_semi")
        .groupBy("node")
        .agg(F.min("id").alias("id"))
        .select(F.xxhash64("id").bitwiseXOR(F.col("node")).alias("x"))
    )
    bits = _marked(carriers, 2 * pairs.count(), params)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, done = batch.column(1).to_numpy(), 0
            for sets in token_sets(batch.column(0), size):
                own = h[done : done + len(sets)]
                done += len(sets)
                nodes = np.array([_node(s) if len(s) else 0 for s in sets], np.int64)
                wanted = [k for k in np.flatnonzero(_hit(bits.value, own ^ nodes)) if len(sets[k])]
                if wanted:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[wanted]), pa.array([sets[k].tobytes() for k in wanted], pa.binary())],
                        ["node", "tokens"],
                    )

    rows = docs.select(text_bytes(text).alias("text"), F.xxhash64(F.col(id_col)).alias("h"))
    return rows.mapInArrow(scan, "node bigint, tokens binary")


def _similar(percent: int):
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return test


def groups(
    docs: DataFrame,
    params: JoinParams = JoinParams(),
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`id, n, node, component` per row: the set's size and number, and its component's smallest id."""
    context = docs.sparkSession.sparkContext
    everything = materialize(keyed(docs, params, id_col, text), "token-sets")
    ranks = context.broadcast(_spread(everything, params))
    keys = everything.where(F.col("block").isNull()).select("id", "n", "node")

    signed = materialize(signatures(docs, ranks, params, text), "signatures")
    shared = materialize(_meetings(signed, params.percent), "meetings")

    def sets_of(pairs: DataFrame) -> DataFrame:
        return materialize(_sets_of(docs, keys, pairs, params, id_col, text), "sets")

    def links(near: DataFrame, sets: DataFrame) -> DataFrame:
        both = _beside(near, sets, "tokens").select("a", "b", "x", "y")
        return materialize(both.mapInArrow(_similar(params.percent), "a bigint, b bigint"), "links")

    stars = materialize(_star_pairs(shared, params.percent), "pairs")
    near = _candidates(stars, signed, params)
    found = links(near, sets_of(near))
    labels = components(found)
    crossing = materialize(_crossing(shared, labels, params), "crossing")
    plain = _plain_pairs(crossing, params.percent).join(stars, ["a", "b"], "left_anti")
    near = _candidates(materialize(plain, "pairs"), signed, params)
    spokes = materialize(_spokes(crossing), "spokes")
    wanted = spokes.select("a", "b").unionAll(near)
    if not wanted.isEmpty():
        sets = sets_of(wanted)
        if not spokes.isEmpty():
            more = _cross_pairs(spokes, sets, ranks, params).join(stars, ["a", "b"], "left_anti")
            more = _candidates(materialize(more, "pairs"), signed, params)
            near = near.unionAll(more).distinct()
        known = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = components(known.unionAll(links(near, sets)))

    named = (
        keys.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("least"))
        .join(labels, "node", "left")
        .select("node", "least", F.coalesce("label", "node").alias("comp"))
    )
    named = materialize(named, "nodes")
    least = named.groupBy("comp").agg(F.min("least").alias("component"))
    named = named.join(least, "comp").select("node", "component")
    return keys.join(named, "node", "left").select(
        "id",
        "n",
        "node",
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"),
    )
