"""Running values over long ordered groups, computed block by block.

A plain ``Window.partitionBy(key)`` sends a whole key to one task. Here every key is cut
into blocks of consecutive rows: a window per block, one total per block, and the totals
of earlier blocks carried in by a join on (key, block). The join and the window ask for
the same partitioning, so the rows themselves are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_START = Window.unboundedPreceding
# Stands for a missing block: before every other one.
_FIRST_BLOCK = -(1 << 62)


def div(value: Column, by: int) -> Column:
    """Whole-number division of a non-negative bigint."""
    return F.call_function("div", value, F.lit(by))


def _over_rows(kind: str, value: Column) -> Column:
    return {
        "sum": lambda: F.sum(value),
        "product": lambda: F.product(value),
        "max": lambda: F.max(value),
        "min": lambda: F.min(value),
        "last": lambda: F.last(value, ignorenulls=True),
    }[kind]()


def _block_total(kind: str, value: Column, order: list[str]) -> Column:
    if kind == "last":
        at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
        return F.max_by(value, F.when(value.isNotNull(), at))
    return _over_rows(kind, value)


def _join_values(kind: str, earlier: Column, here: Column) -> Column:
    if kind == "last":
        return F.coalesce(here, earlier)
    if kind == "max":
        return F.greatest(earlier, here)
    if kind == "min":
        return F.least(earlier, here)
    both = earlier + here if kind == "sum" else earlier * here
    return F.coalesce(both, here, earlier)


def running(
    df: DataFrame,
    key: list[str],
    block: str,
    order: list[str],
    values: dict[str, tuple[str, Column]],
    *,
    inclusive: bool = True,
    fan: int = 1024,
    peers: bool = False,
) -> DataFrame:
    """Add one running column per entry of ``values``: name -> (kind, value).

    ``block`` is an integer column that never decreases along ``order`` inside a key; rows
    without one come first. ``fan`` blocks form a group whose totals are carried in a second
    step, so no task sees more than ``fan`` totals or one total per group. A null in the key
    is a value like any other: blocks are matched on keys without nulls made from it.
    ``peers``: rows that share an ``order`` value see each other's values too.
    """
    names = [f"_key_{n}" for n in range(len(key))]
    nulls = sum((F.when(F.isnull(k), 1 << n).otherwise(0) for n, k in enumerate(key)), F.lit(0))
    keys = [*names, "_nulls"]
    place = [*keys, "_place"]
    rows = df.select(
        "*",
        *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(n) for n, k in zip(names, key)],
        nulls.alias("_nulls"),
        F.coalesce(F.col(block).cast("bigint"), F.lit(_FIRST_BLOCK)).alias("_place"),
    )
    upto = 0 if inclusive else -1
    ordered = Window.partitionBy(*place).orderBy(*order)
    in_block = ordered.rangeBetween(_START, 0) if peers else ordered.rowsBetween(_START, upto)
    named = list(values.items())
    with_inner = rows.select(
        "*",
        *[
            _over_rows(kind, value).over(in_block).alias(f"_in_{name}")
            for name, (kind, value) in named
        ],
    )

    source = rows
    if all(kind == "last" for kind, _ in values.values()):
        seen = F.lit(False)
        for _, (_, value) in named:
            seen = seen | value.isNotNull()
        source = rows.where(seen)
    totals = source.groupBy(*place).agg(
        *[_block_total(kind, value, order).alias(f"_t_{name}") for name, (kind, value) in named]
    )
    if all(kind == "last" for kind, _ in values.values()):
        # Blocks without any value need a carried one too.
        totals = rows.select(*place).distinct().join(totals, place, "left")

    totals = totals.withColumn("_group", div(F.col("_place"), fan))
    in_group = Window.partitionBy(*keys, "_group").orderBy("_place").rowsBetween(_START, -1)
    groups = Window.partitionBy(*keys).orderBy("_group").rowsBetween(_START, -1)
    group_totals = totals.groupBy(*keys, "_group").agg(
        *[
            _block_total(kind, F.col(f"_t_{name}"), ["_place"]).alias(f"_g_{name}")
            for name, (kind, _) in named
        ]
    )
    group_carry = group_totals.select(
        *keys,
        "_group",
        *[
            _over_rows(kind, F.col(f"_g_{name}")).over(groups).alias(f"_gc_{name}")
            for name, (kind, _) in named
        ],
    )
    near = totals.select(
        *place,
        "_group",
        *[
            _over_rows(kind, F.col(f"_t_{name}")).over(in_group).alias(f"_n_{name}")
            for name, (kind, _) in named
        ],
    )
    carried = near.join(group_carry, [*keys, "_group"]).select(
        *place,
        *[
            _join_values(kind, F.col(f"_gc_{name}"), F.col(f"_n_{name}")).alias(f"_c_{name}")
            for name, (kind, _) in named
        ],
    )

    joined = with_inner.join(carried, place)
    return joined.select(
        *[joined[c] for c in df.columns],
        *[
            _join_values(kind, F.col(f"_c_{name}"), F.col(f"_in_{name}")).alias(name)
            for name, (kind, _) in named
        ],
    )
