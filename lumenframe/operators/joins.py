"""Joins against derived side tables whose size is measured before they are broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.session import checkpoint

MAX_BROADCAST_ROWS = 200_000


def small_or_shuffled(side: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Computes ``side`` once and marks it for broadcast only if it has at most ``max_rows`` rows.

    A larger side is returned without a hint: the join then shuffles, and AQE
    splits the partitions of hot keys.
    """
    side = checkpoint(side)
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side


def lookup(df: DataFrame, dimension: DataFrame, keys: str | Sequence[str], defaults: dict | None = None) -> DataFrame:
    """Left join to a dimension; a missing row gives the default instead of NULL.

    No broadcast hint: dimensions grow, and Spark broadcasts by measured size.
    """
    out = df.join(dimension, keys, "left")
    return out.withColumns({c: F.coalesce(F.col(c), v) for c, v in (defaults or {}).items()})


def without(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``seen``."""
    return df.join(seen.select(*keys), list(keys), "left_anti")


def overlap_count(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many distinct keys occur on both sides (0 for a disjoint split)."""
    return (
        left.select(*keys)
        .join(right.select(*keys), list(keys), "left_semi")
        .distinct()
        .agg(F.count(F.lit(1)).alias("overlap"))
    )
