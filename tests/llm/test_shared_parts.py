"""Sums over tasks, marks and pairs, against plain Python."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewright.llm import blocks, jaccard_join
from candlewright.session import materialize


@pytest.mark.parametrize("tasks", [0, 1, 3, 40, 600])
def test_blocks_are_added_in_a_tree(spark, tasks):
    rng = np.random.default_rng(tasks)
    rows, want = [], {}
    for _ in range(tasks):
        for name in ("a", "b"):
            values = rng.integers(0, 9, 5).astype(np.uint32)
            rows.append((name, 0, values.tobytes()))
            want[name] = want.get(name, 0) + values.astype(float)
    table = spark.createDataFrame(rows, "name string, block int, data binary").repartition(8)
    got = blocks.gathered(blocks.summed(materialize(table, "blocks"), "uint32"), 5)
    assert got.keys() == want.keys()
    assert all(np.array_equal(got[k], want[k]) for k in want)


CROSSING = (
    "token bigint, run int, node bigint, n bigint, last bigint, most bigint, comp bigint, head bigint,"
    " few boolean, main bigint, pieces bigint"
)


def crossing(spark, comps, pieces):
    """One run per list of components; the node number tells the node."""
    rows, number = [], 0
    for run, members in enumerate(comps):
        main = max((members.count(c), c) for c in set(members))[1]
        for comp in members:
            number += 1
            rows.append((7, run, number, 100, 1, 100, comp, 1, True, main, pieces))
    return spark.createDataFrame(rows, CROSSING), rows


@pytest.mark.parametrize("pieces", [1, 5])
def test_pairs_of_different_components(spark, pieces):
    rng = random.Random(2)
    comps = [[1] * 30 + [2], [1, 2, 3, 4], [5, 5, 6, 6], [rng.randrange(4) for _ in range(25)]]
    table, rows = crossing(spark, comps, pieces)
    got = sorted((r.a, r.b) for r in jaccard_join._plain_pairs(table, 90).collect())
    want = sorted(
        (x[2], y[2]) for x, y in itertools.combinations(rows, 2) if x[1] == y[1] and x[6] != y[6]
    )
    assert got == want


def test_one_outsider_beside_many_copies_is_no_square(spark):
    """200,000 nodes of one component would be 2 * 10^10 pairs."""
    nodes = spark.range(200_000).selectExpr(
        "7L token", "0 run", "id node", "100L n", "1L last", "100L most", "if(id = 5, 1L, 0L) comp",
        "1L head", "true few", "0L main", "4L pieces",
    )
    pairs = jaccard_join._plain_pairs(nodes, 90)
    assert pairs.count() == 199_999
    assert pairs.where((F.col("a") != 5) & (F.col("b") != 5)).count() == 0


def test_marks_grow_with_what_is_marked(spark):
    values = spark.range(1000).select(F.xxhash64("id").alias("x"))
    params = jaccard_join.JoinParams(marks=1 << 15, most_marks=1 << 20)
    numbers = np.array([r.x for r in values.collect()], np.int64)
    for most, marks in ((1000, 1 << 15), (100_000, 1 << 20), (10**9, 1 << 20)):
        marked = jaccard_join._marked(values, most, params).value
        assert marked[1] == marks and jaccard_join._hit(marked, numbers).all()
        assert jaccard_join._hit(marked, numbers + 12345).mean() < 0.1


def test_packed_numbers_come_back():
    values = np.concatenate([np.random.default_rng(1).lognormal(0, 5, 1000), [0, 1, 7, 2**24]]).astype(np.float32)
    assert np.array_equal(blocks.unpack(blocks.pack(values)), values)
    assert np.allclose(blocks.unpack(blocks.pack(values, 3)), values, rtol=2**-16, atol=0)
    assert len(blocks.unpack(blocks.pack(values[:0]))) == 0
