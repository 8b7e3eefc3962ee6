"""First row per key of account tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def first_per_key(table: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """The row of each key that comes first in ``order`` (a unique number)."""
    return table.groupBy(key).agg(
        F.min(order).alias(order), *[F.min_by(c, order).alias(c) for c in columns]
    )


def balance_for_asset(wallets: DataFrame, asset_id: int | None = None) -> DataFrame:
    """First wallet (asset_id, wallet_id, balance) of an asset, or of every asset."""
    chosen = wallets if asset_id is None else wallets.where(F.col("asset_id") == asset_id)
    return first_per_key(chosen, "asset_id", "wallet_id", ["balance"])


def first_position(positions: DataFrame, product_id: int | None = None) -> DataFrame:
    """First margined position (product_id, position_id, size, entry_price) of a product."""
    chosen = positions if product_id is None else positions.where(F.col("product_id") == product_id)
    return first_per_key(chosen, "product_id", "position_id", ["size", "entry_price"])
