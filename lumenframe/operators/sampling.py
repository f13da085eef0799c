"""Splits and samples that repeat exactly: every choice follows a hash of the row id.

Row order and partitioning never matter, so a lost executor cannot move a row
from one side of a split to the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.operators.ordered import with_position


def multiplier(seed: int) -> int:
    """Odd 32-bit factor of the hash. Another seed gives another factor, not a shifted key."""
    return (2654435761 + 81006 * seed) % 4294967296 | 1


def split_key(id_column: str, seed: int = 42) -> Column:
    """Multiplicative hash of an integer id to [0, 2**32); the reduced id cannot overflow a long."""
    reduced = F.pmod(F.col(id_column).cast("long"), F.lit(2147483648))
    return F.pmod(reduced * F.lit(multiplier(seed)), F.lit(4294967296))


def random_split(
    df: DataFrame, id_column: str, test_share: float = 0.2, seed: int = 42, by: Sequence[str] = ()
) -> DataFrame:
    """Adds ``split``; ``test`` has exactly ``int(n * test_share)`` rows (of each ``by`` stratum, rounded)."""
    keyed = df.withColumn("_key", split_key(id_column, seed))
    placed = with_position(keyed, ["_key", id_column], by, name="_pos", total="_size")
    size = F.col("_size") * F.lit(test_share)
    wanted = F.round(size) if by else F.floor(size)
    return placed.withColumn("split", F.when(F.col("_pos") < wanted, F.lit("test")).otherwise(F.lit("train"))).drop(
        "_key", "_pos", "_size"
    )


def hash_split(df: DataFrame, id_column: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split`` without any shuffle; the test share holds in expectation."""
    cut = int(test_share * 4294967296)
    is_test = split_key(id_column, seed) < F.lit(cut)
    return df.withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def fold_of(id_column: str, folds: int, seed: int = 42) -> Column:
    """Fold number from the high bits of the split key."""
    return (F.shiftright(split_key(id_column, seed), 16) % folds).cast("int")


def cap_per_class(df: DataFrame, by: str, id_column: str, limit: int = 200, seed: int = 42) -> DataFrame:
    """At most ``limit`` rows of each class, without replacement.

    Spark cuts each class to ``limit`` rows per task before the shuffle (window
    group limit, which applies below 1,000 rows); larger limits take exact positions.
    """
    keyed = df.withColumn("_key", split_key(id_column, seed))
    if limit < 1000:
        first = Window.partitionBy(by).orderBy("_key", id_column)
        picked = keyed.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= limit)
    else:
        picked = with_position(keyed, ["_key", id_column], [by], name="_place").filter(F.col("_place") < limit)
    return picked.drop("_key", "_place")


def fixed_sample(df: DataFrame, id_column: str, size: int, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows (all, if fewer), uniform by hash."""
    keyed = df.withColumn("_key", split_key(id_column, seed))
    return keyed.orderBy("_key", id_column).limit(size).drop("_key")
