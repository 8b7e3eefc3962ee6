"""Order rows: what would be sent, checked and batched. Nothing is sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewright.operators.scan import div, running
from candlewright.schema import ORDER_TYPES, TIME_IN_FORCE

SMALLEST_SIZE = 1e-8
BATCH_SIZE = 5


def trade_orders(trades: DataFrame, product_id: int) -> DataFrame:
    """The two market orders of every trade; the exit reverses the side and only reduces."""
    long = F.col("type") == "long"

    def order(step: str, idx: str, side: Column, reduces: bool) -> Column:
        return F.struct(
            F.lit(step).alias("step"),
            F.col(idx).alias("idx"),
            side.alias("side"),
            F.lit("true" if reduces else None).cast("string").alias("reduce_only"),
        )

    both = F.array(
        order("entry", "entry_idx", F.when(long, "buy").otherwise("sell"), False),
        order("exit", "exit_idx", F.when(long, "sell").otherwise("buy"), True),
    )
    rows = trades.where(F.abs("position_size") >= SMALLEST_SIZE).select(
        "symbol", "trade_no", F.abs("position_size").alias("size"), F.explode(both).alias("o")
    )
    return rows.select(
        "symbol",
        "trade_no",
        "o.step",
        "o.idx",
        F.lit(product_id).alias("product_id"),
        "size",
        "o.side",
        F.lit("market_order").alias("order_type"),
        "o.reduce_only",
    )


def order_intents(orders: DataFrame) -> DataFrame:
    """Plain orders: whole sizes, a limit price on limit orders only, flags as text.

    Input: product_id, size, side, order_type, limit_price, time_in_force, post_only,
    reduce_only. Sizes that truncate to nothing are dropped.
    """
    known = F.col("order_type").isin(*ORDER_TYPES) & (
        F.col("time_in_force").isNull() | F.col("time_in_force").isin(*TIME_IN_FORCE)
    )
    extra = [c for c in orders.columns if c not in _ORDER_FIELDS]
    whole = F.col("size").cast("bigint")
    return orders.where(F.abs(whole) >= SMALLEST_SIZE).select(
        *extra,
        "product_id",
        F.col("size").cast("bigint").alias("size"),
        "side",
        "order_type",
        F.when(F.col("order_type") == "limit_order", F.col("limit_price")).alias("limit_price"),
        "time_in_force",
        F.coalesce("post_only", F.lit("false")).alias("post_only"),
        F.coalesce("reduce_only", F.lit("false")).alias("reduce_only"),
        F.when(known, "ok").otherwise("rejected").alias("status"),
    )


_ORDER_FIELDS = [
    "product_id", "size", "side", "order_type", "limit_price", "time_in_force", "post_only",
    "reduce_only",
]


def stop_order_intents(orders: DataFrame) -> DataFrame:
    """Stop orders and why a row is not one.

    A limit order needs ``limit_price``; a trailing one needs ``trail_amount`` (negative when
    selling), any other needs ``stop_price``.
    """
    limit = F.col("order_type") == "limit_order"
    trailing = F.coalesce("trailing", F.lit(False))
    error = (
        F.when(limit & F.col("limit_price").isNull(), "limit_price is nil")
        .when(trailing & F.col("trail_amount").isNull(), "trail_amount is nil")
        .when(~trailing & F.col("stop_price").isNull(), "stop_price is nil")
    )
    signed = F.when(F.col("side") == "buy", F.col("trail_amount")).otherwise(-F.col("trail_amount"))
    fields = [
        "product_id", "size", "side", "order_type", "limit_price", "stop_price", "trail_amount",
        "trailing",
    ]
    return orders.select(
        *[c for c in orders.columns if c not in fields],
        "product_id",
        F.col("size").cast("bigint").alias("size"),
        "side",
        "order_type",
        F.lit("stop_loss_order").alias("stop_order_type"),
        F.when(limit, F.col("limit_price")).alias("limit_price"),
        F.when(trailing, signed).alias("trail_amount"),
        F.when(~trailing, F.col("stop_price")).alias("stop_price"),
        F.when(error.isNull(), "ok").otherwise("error").alias("status"),
        error.alias("error"),
    )


def cancel_intents(orders: DataFrame) -> DataFrame:
    return orders.select("id", "product_id")


_PRICES = ("limit_price", "stop_price", "trail_amount")


def price_text(price: Column) -> Column:
    """A price in plain digits, at most eight after the point."""
    return F.regexp_replace(price.cast("decimal(38,8)").cast("string"), r"\.?0+$", "")


def order_json(orders: DataFrame, fields: list[str]) -> DataFrame:
    """Add ``body``: the order as compact JSON, prices as text, fields that are null left out."""
    shown = [price_text(F.col(c)).alias(c) if c in _PRICES else F.col(c) for c in fields]
    return orders.withColumn("body", F.to_json(F.struct(*shown)))


def order_batches(
    orders: DataFrame,
    order: list[str],
    payload: list[str],
    block_width: int = 1 << 12,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Orders of each product in groups of at most five, in ``order``.

    ``order`` starts with an integer id; ranges of ``block_width`` ids are numbered on their
    own and offset by the ids before, so one busy product is spread over many tasks.
    """
    numbered = running(
        orders.withColumn("_block", div(F.col(order[0]), block_width)),
        ["product_id"],
        "_block",
        order,
        {"_n": ("sum", F.lit(1).cast("bigint"))},
    )
    place = F.col("_n") - 1
    return (
        numbered.groupBy("product_id", div(place, batch_size).alias("batch_no"))
        .agg(F.sort_array(F.collect_list(F.struct(place.alias("place"), *payload))).alias("orders"))
        .withColumn("n_orders", F.size("orders"))
    )
