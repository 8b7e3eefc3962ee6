"""Connected components by alternating stars.

Large star: every node sends its larger neighbours to the smallest node it knows. Small star: it
sends its smaller neighbours and itself there. Both are a minimum per node and a join with it; no
task sees all neighbours of a node at once. Edges end as stars around each component's smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewright.session import materialize


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")
    ).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """`node, label` for every node in the links `a, b`; the label is the smallest node reachable."""
    edges = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = materialize(edges, "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        large = materialize(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), "m")
            .unionAll(least)
            .select("u", F.col("m").alias("v"))
            .distinct()
        )
        edges = materialize(small, "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(roots)
