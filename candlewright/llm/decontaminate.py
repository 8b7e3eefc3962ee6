"""Benchmark items inside documents: SimHash windows of the item's size, then exact similarity.

A window is a run of as many words as the item has. Windows that share no shingle with any item can
not be similar to one, so windows start where a shingle of an item occurs, on the item's diagonal, and
anywhere between two such starts that are less than half an item apart, where words were put in or
left out. Each gets a 64-bit SimHash of its weighted shingles. Fingerprints are cut into 8 blocks of 8
bits; if two differ in at most 23 bits, some block differs in at most two, so the items are listed
under all 37 values near each of their blocks, and a window looks its 8 blocks up: every pair within
the radius is found. These pairs are verified by the weighted Jaccard similarity of their shingles,
with counts. Windows of the least similarity that counts differ in some 10 bits; the README says how
many lie beyond the radius.

A shingle has five words (the whole item when it is shorter); its weight falls with the number of
items that have it, in whole thousandths, so that sums do not depend on their order.

Edge cases: words are lower-cased; null, empty and blank texts and items have none and match nothing.
A document shorter than the item is compared as a whole. Rows that share an id are compared one by
one and reported under that id once per item; rows without an id are reported under null. Of windows
equally similar the first is reported. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.llm.native import grams, hashes, let, words
from candlewright.session import materialize

#: Blocks of 8 bits, each looked up with up to two bits changed: 8 * 3 - 1 bits of distance.
BLOCKS, RADIUS = 8, 23
NEAR = sorted({(1 << a) | (1 << b) for a in range(8) for b in range(8)} | {0})


@dataclass(frozen=True)
class LeakParams:
    shingle: int = 5
    percent: int = 80


def _hashed(text: Column) -> Column:
    return hashes(words(F.lower(text)))


def item_shingles(items: DataFrame, params: LeakParams, item_col: str, text: str) -> DataFrame:
    """`item, size, k, pos, h`: the shingles of every item in order; `size` is the item's words."""
    rows = items.select(F.col(item_col).alias("item"), _hashed(F.col(text)).alias("w"))
    rows = rows.select("item", "w", F.size("w").alias("size")).where("size > 0")
    k = F.least("size", F.lit(params.shingle))
    runs = reduce(
        lambda other, n: F.when(k == n, grams(F.col("w"), n)).otherwise(other),
        range(1, params.shingle),
        grams(F.col("w"), params.shingle),
    )
    # Items that share an id are told apart by their words.
    return rows.select(
        F.xxhash64("item", "w").alias("entry"), "item", "size", k.alias("k"), F.posexplode(runs).alias("pos", "h")
    )


def _fingerprints(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash and total weight per key, from rows with `h`, a count `c` and a weight `w`."""
    weight = F.col("c") * F.col("w")
    bit = lambda b: F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1))
    sums = [F.sum(weight * (2 * bit(b) - 1)).alias(f"s{b}") for b in range(64)]
    summed = shingles.groupBy(*keys).agg(F.sum(weight).alias("total"), *sums)
    ones = [F.shiftleft((F.col(f"s{b}") > 0).cast("bigint"), b) for b in range(64)]
    return summed.select(*keys, "total", reduce(lambda x, y: x.bitwiseOR(y), ones).alias("print"))


def _block(k: int) -> Column:
    return F.shiftrightunsigned("print", 8 * k).bitwiseAND(F.lit(255)).cast("int")


def windows(docs: DataFrame, shingles: DataFrame, id_col: str, text: str) -> DataFrame:
    """`id, row, size, k, start`: windows on the diagonals of shared shingles, and between near ones."""
    found = None
    for k in sorted(r["k"] for r in shingles.select("k").distinct().collect()):
        runs = docs.select(
            F.col(id_col).alias("id"), F.xxhash64(text).alias("row"), _hashed(F.col(text)).alias("w")
        ).select("id", "row", F.size("w").alias("n"), F.posexplode(grams(F.col("w"), k)).alias("at", "h"))
        at_items = shingles.where(F.col("k") == k).select("h", "size", "k", "pos").distinct()
        start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("pos"), F.col("n") - F.col("size")))
        own = (
            runs.join(at_items, "h")
            .select("id", "row", "size", "k", start.alias("start"))
            .distinct()
        )
        found = own if found is None else found.unionAll(own)
    starts = found.groupBy("id", "row", "size", "k").agg(F.sort_array(F.collect_set("start")).alias("starts"))

    def upto_next(start: Column, i: Column) -> Column:
        then = F.get("starts", i + 1)
        near = (then - start) * 2 < F.col("size")
        return F.when(near, F.sequence(start, then - 1)).otherwise(F.array(start))

    return starts.select("id", "row", "size", "k", F.explode(F.flatten(F.transform("starts", upto_next))).alias("start"))


def _window_shingles(docs: DataFrame, found: DataFrame, id_col: str, text: str) -> DataFrame:
    """`id, row, size, k, start, h, c`: the shingles of every window with their counts."""
    spots = found.groupBy("id", "row").agg(F.collect_set(F.struct("size", "k", "start")).alias("spots"))
    spots = spots.select(F.col("id").alias("at_id"), F.col("row").alias("at_row"), "spots")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    ks = sorted(r["k"] for r in found.select("k").distinct().collect())

    def runs(w: Column) -> Column:
        """The grams of each length that some window needs."""
        return F.array(*[grams(w, k) for k in ks])

    index = lambda k: reduce(
        lambda other, x: F.when(k == x[1], x[0]).otherwise(other), enumerate(ks), F.lit(0)
    )
    joined = (
        rows.join(spots, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("row") == F.col("at_row")))
        .select("id", "row", "spots", let(_hashed(F.col("text")), runs).alias("runs"))
        .select("id", "row", "runs", F.explode("spots").alias("spot"))
    )
    own = F.slice(
        F.get("runs", index(F.col("spot.k"))),
        F.col("spot.start") + 1,
        F.col("spot.size") - F.col("spot.k") + 1,
    )
    keys = ["id", "row", "size", "k", "start", "h"]
    # Repeated rows give the same windows; each is counted once.
    return (
        joined.select("id", "row", "spot.size", "spot.k", "spot.start", own.alias("own"))
        .groupBy("id", "row", "size", "k", "start")
        .agg(F.first("own").alias("own"))
        .select("id", "row", "size", "k", "start", F.explode("own").alias("h"))
        .groupBy(*keys)
        .agg(F.count("*").alias("c"))
    )


def leaks(
    docs: DataFrame,
    items: DataFrame,
    params: LeakParams = LeakParams(),
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """`id, item, start, size, similarity`: the best window of a document for each item found in it."""
    shingles = materialize(item_shingles(items, params, item_col, item_text).coalesce(1), "shingles")
    n_items = shingles.agg(F.count_distinct("entry")).first()[0]
    weigh = lambda df: F.round(1000 * F.log1p(F.lit(float(n_items)) / df)).cast("bigint")
    if not n_items:
        kinds = {**dict(docs.select(F.col(id_col).alias("id")).dtypes), **dict(shingles.dtypes)}
        return docs.sparkSession.createDataFrame(
            [], f"id {kinds['id']}, item {kinds['item']}, start int, size int, similarity double"
        )
    weights = shingles.groupBy("h").agg(weigh(F.count_distinct("entry")).alias("w"))
    weights = materialize(weights.coalesce(1), "weights")
    held = shingles.groupBy("entry", "item", "size", "k", "h").agg(F.count("*").alias("c"))
    held = materialize(held.join(weights, "h").coalesce(1), "items")
    item_prints = _fingerprints(held, ["entry", "item", "size", "k"])

    found = materialize(windows(docs, shingles, id_col, text), "windows")
    spot = ["id", "row", "size", "k", "start"]
    seen = _window_shingles(docs, found, id_col, text).join(weights, "h", "left")
    seen = seen.select(*spot, "h", "c", F.coalesce("w", weigh(F.lit(1.0))).alias("w"))
    seen = materialize(seen, "window-shingles")
    prints = _fingerprints(seen, spot)

    cut = F.posexplode(F.array(*[_block(k) for k in range(BLOCKS)])).alias("block", "value")
    listed = (
        item_prints.select(
            "entry", "item", "size", "k", F.col("total").alias("item_total"), F.col("print").alias("item_print"), "print"
        )
        .select("entry", "item", "size", "k", "item_total", "item_print", cut)
        .withColumn("flip", F.explode(F.array(*[F.lit(x) for x in NEAR])))
        .withColumn("value", F.col("value").bitwiseXOR(F.col("flip")))
        .drop("flip")
    )
    listed = materialize(listed.coalesce(1), "blocks")
    looked = prints.select(*spot, "total", "print", cut)
    pairs = (
        looked.join(listed, ["size", "k", "block", "value"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select(*spot, "entry", "item", "total", "item_total")
        .distinct()
    )
    pairs = materialize(pairs, "pairs").withColumnRenamed("id", "p_id")
    same = [F.col(f"s.{c}") == F.col(f"p.{c}") for c in spot[1:]]
    on = reduce(lambda x, y: x & y, same, F.col("s.id").eqNullSafe(F.col("p.p_id")))
    both = (
        seen.alias("s")
        .join(pairs.alias("p"), on)
        .select("s.*", "entry", "item", "total", "item_total")
        .join(held.select("entry", "h", F.col("c").alias("ci")), ["entry", "h"])
        .groupBy(*spot, "entry", "item", "total", "item_total")
        .agg(F.sum(F.col("w") * F.least("c", "ci")).alias("shared"))
        .withColumn("every", F.col("total") + F.col("item_total") - F.col("shared"))
        .where(100 * F.col("shared") >= params.percent * F.col("every"))
    )
    best = F.max(F.struct((F.col("shared") / F.col("every")).alias("similarity"), (-F.col("start")).alias("back"), "size"))
    return (
        both.groupBy("id", "item")
        .agg(best.alias("best"))
        .select("id", "item", (-F.col("best.back")).alias("start"), "best.size", "best.similarity")
    )
