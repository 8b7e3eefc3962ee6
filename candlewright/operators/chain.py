"""Follow a chain of "take one, then skip ahead" through an ordered group.

Each node has a position and the position from which the next node may be taken. The first
node of a key is taken; after taking a node, the next one is the first node at or beyond its
``next``. This is inherently a walk, but a block of nodes acts on the walk as a step function:
"arrive with threshold t, leave with threshold f(t)". Only thresholds that nodes of other blocks
have, or that skip to the block's first node, ever arrive, so few steps per block are needed even
where every bar is a node. The steps are themselves such nodes: the walk is done once over
steps of steps and then repeated inside the blocks it really enters, all of them in parallel.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from candlewright.operators.scan import div
from candlewright.params import ChunkParams
from candlewright.session import materialize


def _grouped(nodes: DataFrame, key: str, width: int | None) -> DataFrame:
    block = F.lit(0).cast("bigint") if width is None else div(F.col("pos"), width)
    payload = [c for c in nodes.columns if c != key]
    ordered = ["pos", "next", *[c for c in payload if c not in ("pos", "next")]]
    return nodes.groupBy(key, block.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(*ordered))).alias("nodes")
    )


def _steps(nodes: DataFrame, key: str, width: int) -> DataFrame:
    """The step function of every block, at the thresholds that can arrive in it.

    Arriving at or before ``pos``, and after the step before, the walk leaves at ``next``.
    """
    block, landing = div(F.col("pos"), width), div(F.col("next"), width)
    own = nodes.select(key, block.alias("block"), "pos", "next", F.lit(False).alias("arrives"))
    arriving = (
        nodes.where(landing > block)
        .select(key, landing.alias("block"), F.col("next").alias("pos"), "next")
        .distinct()
        .withColumn("arrives", F.lit(True))
    )

    def step_table(rows: pd.DataFrame) -> pd.DataFrame:
        inside = rows[~rows["arrives"]].sort_values("pos")
        if inside.empty:
            return inside[[key, "pos", "next"]]
        pos = inside["pos"].to_numpy()
        after = np.searchsorted(pos, inside["next"].to_numpy()).tolist()
        leaves = inside["next"].tolist()
        for n in range(len(pos) - 1, -1, -1):
            if after[n] < len(pos):
                leaves[n] = leaves[after[n]]
        reached = np.searchsorted(pos, rows.loc[rows["arrives"], "pos"].to_numpy())
        steps = np.unique(np.append(reached[reached < len(pos)], 0))
        left = np.array(leaves, dtype="int64")[steps]
        # Neighbours that leave at the same place are one step.
        ends = np.append(left[1:] != left[:-1], True)
        return pd.DataFrame(
            {key: rows[key].iloc[0], "pos": pos[steps][ends], "next": left[ends]}
        )

    kind = nodes.schema[key].dataType.simpleString()
    return (
        own.unionByName(arriving)
        .groupBy(key, "block")
        .applyInPandas(step_table, f"`{key}` {kind}, pos bigint, next bigint")
    )


def _walk(grouped: DataFrame, key: str, arrivals: DataFrame | None) -> DataFrame:
    """Taken nodes of each block entered, each with the threshold it was reached with."""
    if arrivals is None:
        entered = grouped.withColumn("arrive", F.lit(-1).cast("bigint"))
    else:
        here = (F.col("block") == F.col("_block")) & F.col(key).eqNullSafe(F.col("_key"))
        entered = grouped.join(arrivals, here)
    node_type = grouped.schema["nodes"].dataType.elementType.simpleString()
    none = F.expr(f"cast(array() as array<struct<arrive:bigint,node:{node_type}>>)")
    start = F.struct(F.col("arrive").alias("t"), none.alias("taken"))

    def step(state: Column, node: Column) -> Column:
        found = F.struct(state["t"].alias("arrive"), node.alias("node"))
        taken = F.struct(
            node["next"].alias("t"), F.concat(state["taken"], F.array(found)).alias("taken")
        )
        return F.when(node["pos"] >= state["t"], taken).otherwise(state)

    folded = F.aggregate("nodes", start, step, lambda s: s["taken"])
    return entered.select(key, F.explode(folded).alias("_x")).select(key, "_x.arrive", "_x.node.*")


def follow_chain(
    df: DataFrame, key: str, pos: str, nxt: str, chunks: ChunkParams = ChunkParams()
) -> DataFrame:
    """Rows of ``df`` on the chain. Positions are unique per key and ``nxt`` exceeds ``pos``.

    Blocks form groups, and these larger ones, until a key has one at most; a job per level writes
    their steps. ``df`` is read several times; write it first where it is costly.
    """
    nodes = df.select(
        key,
        F.col(pos).cast("bigint").alias("pos"),
        F.col(nxt).cast("bigint").alias("next"),
        *[c for c in df.columns if c not in (key, pos, nxt)],
    )
    levels = []
    level, width = nodes, chunks.size
    farthest = nodes.agg(F.max("pos")).first()[0] or 0
    while farthest >= width:
        levels.append((_grouped(level, key, width), width))
        level = materialize(_steps(level, key, width), "steps")
        width *= chunks.fan

    taken = _walk(_grouped(level, key, None), key, None)
    for grouped, width in reversed(levels):
        arrivals = taken.select(
            F.col(key).alias("_key"), div(F.col("pos"), width).alias("_block"), "arrive"
        )
        taken = _walk(grouped, key, arrivals)
    return taken.select(
        *[
            F.col({pos: "pos", nxt: "next"}.get(c, c)).alias(c)
            for c in df.columns
        ]
    )
