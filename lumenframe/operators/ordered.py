"""Row positions and running totals over a total order, without a single-task window.

A window with few partitions (one long series, one global ranking) puts a whole
group in one task. Here the rows are range-partitioned on the full order key, so
a group of any size is spread over many tasks; each task numbers or sums its own
rows and adds the totals of the ranges before it. The side table of totals has
one row per (group, range), never one per data row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.session import checkpoint

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _key(name_or_col: str | Column) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


def range_sorted(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows sorted into ranges; adds ``_range`` (range number) and ``_row`` (place in it).

    The result is checkpointed: range bounds come from sampling, so every later
    use has to see the same ranges, also after an executor is lost.
    """
    keys = [_key(c) for c in order]
    numbered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    numbered = checkpoint(numbered)
    return numbered.withColumns(
        {
            "_range": F.shiftright("_mid", _ROW_BITS).cast("int"),
            "_row": F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("_mid")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL keys match each other."""
    renamed = right.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"__{k}"])
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def with_position(
    df: DataFrame,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """Adds the 0-based place of each row in its ``by`` group (and the group size as ``total``).

    ``order`` must be a total order within the group for a repeatable result.
    """
    by = list(by)
    rows = range_sorted(df, by + list(order))
    ranges = rows.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    if total:
        ranges = ranges.withColumn(total, F.sum("_rows").over(Window.partitionBy(*by)))
    ranges = ranges.drop("_rows")
    return (
        join_null_safe(rows, ranges, by + ["_range"])
        .withColumn(name, F.col("_before") + F.col("_row") - F.col("_first"))
        .drop("_range", "_row", "_first", "_before")
    )


def with_running(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    totals: bool = False,
) -> DataFrame:
    """Adds, for ``{new: column}`` in ``sums``, the running total up to and including the row.

    With ``totals`` also adds ``new_total``, the sum over the whole group.
    """
    by = list(by)
    rows = range_sorted(df, by + list(order))
    ranges = rows.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()])
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    added = {f"_b_{n}": F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)) for n in sums}
    if totals:
        added |= {f"{n}_total": F.sum(f"_s_{n}").over(group) for n in sums}
    ranges = ranges.withColumns(added).drop(*[f"_s_{n}" for n in sums])
    local = (
        Window.partitionBy(*by, "_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumns({f"_l_{n}": F.sum(c).over(local) for n, c in sums.items()})
    rows = join_null_safe(rows, ranges, by + ["_range"])
    return rows.withColumns({n: F.col(f"_l_{n}") + F.col(f"_b_{n}") for n in sums}).drop(
        "_range", "_row", *[f"_l_{n}" for n in sums], *[f"_b_{n}" for n in sums]
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Exact linear-interpolated quantiles in long form: ``by..., column, probability, value``.

    Equal values are counted first, so a value that fills a third of the rows is
    one row from then on, and no task holds the values of a whole group.
    """
    by = list(by)
    values = df.select(
        *by,
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
            )
        ).alias("_cell"),
    ).select(*by, "_cell.column", "_cell.value")
    counted = (
        values.filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = with_running(counted, ["value"], {"_upto": "_n"}, by=[*by, "column"], totals=True)
    picks = []
    for i, p in enumerate(probabilities):
        place = (F.col("_upto_total") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            covers = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
            picks.append(F.max(F.when(covers, F.col("value"))).alias(f"_{side}{i}"))
    wide = ranked.groupBy(*by, "column").agg(F.max("_upto_total").alias("_total"), *picks)
    cells = []
    for i, p in enumerate(probabilities):
        place = (F.col("_total") - 1) * F.lit(float(p))
        value = F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (place - F.floor(place))
        cells.append(F.struct(F.lit(float(p)).alias("probability"), value.alias("value")))
    return wide.select(*by, "column", F.explode(F.array(*cells)).alias("_cell")).select(
        *by, "column", "_cell.probability", "_cell.value"
    )


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """One-pass sketch version of :func:`exact_quantiles`, same shape, for when an estimate will do."""
    by = list(by)
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    wide = df.groupBy(*by).agg(
        *[F.percentile_approx(F.col(c).cast("double"), wanted, accuracy).alias(f"_q_{c}") for c in columns]
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(float(p)).alias("probability"),
            F.col(f"_q_{c}")[i].alias("value"),
        )
        for c in columns
        for i, p in enumerate(probabilities)
    ]
    return wide.select(*by, F.explode(F.array(*cells)).alias("_cell")).select(*by, "_cell.*")
