"""Lag, rolling and interpolation features for ordered series of any length.

A series is cut into chunks of consecutive rows by exact row position; the last
rows of a chunk are copied into the next one as lead-in. A window then never
spans more than one chunk, so one endless series does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.operators.joins import small_or_shuffled
from lumenframe.operators.ordered import exact_quantiles, join_null_safe, with_position
from lumenframe.session import checkpoint

CHUNK_ROWS = 500_000


def history_features(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    lags: Sequence[int] = (1, 3, 6, 12, 24, 48, 72),
    windows: Sequence[int] = (6, 12, 24, 48),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Adds ``lag_n``, ``roll_mean_w`` and ``roll_std_w`` of the rows before the current one.

    Rolling values are NULL until the window is full, and when it holds a NULL.
    """
    by = list(by)
    halo = max([*lags, *windows], default=1)
    if chunk_rows < halo:
        raise ValueError(f"chunk_rows must be at least {halo}")
    placed = with_position(df, order, by, name="_pos")
    chunk = F.floor(F.col("_pos") / chunk_rows)
    in_halo = F.col("_pos") % chunk_rows >= chunk_rows - halo
    copies = F.when(in_halo, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    rows = placed.withColumn("_chunk", F.explode(copies))
    ordered = Window.partitionBy(*by, "_chunk").orderBy("_pos")
    added = {f"lag_{n}": F.lag(value, n).over(ordered) for n in lags}
    for w in windows:
        before = ordered.rowsBetween(-w, -1)
        full = F.count(value).over(before) == w
        added[f"roll_mean_{w}"] = F.when(full, F.avg(value).over(before))
        added[f"roll_std_{w}"] = F.when(full, F.stddev_samp(value).over(before))
    return rows.withColumns(added).filter(F.col("_chunk") == chunk).drop("_chunk", "_pos")


def interpolate(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "filled",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Linear interpolation by row position; trailing gaps repeat the last value, leading gaps stay NULL.

    Every chunk takes the nearest known value before and after it from a table
    with one row per chunk.
    """
    by = list(by)
    placed = with_position(df, order, by, name="_pos")
    placed = placed.withColumn("_chunk", F.floor(F.col("_pos") / chunk_rows))
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_pos").alias("at"), F.col(value).alias("v")))
    edges = placed.groupBy(*by, "_chunk").agg(F.min(known).alias("_first"), F.max(known).alias("_last"))
    chunks = Window.partitionBy(*by).orderBy("_chunk")
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    # Looking ahead is looking back in descending order: frames that only grow cost one step per row.
    later = Window.partitionBy(*by).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        *by,
        "_chunk",
        F.last("_last", ignorenulls=True).over(earlier).alias("_from"),
        F.last("_first", ignorenulls=True).over(later).alias("_to"),
    )
    rows = join_null_safe(placed, carried, [*by, "_chunk"])  # a series may have a NULL key
    ordered = Window.partitionBy(*by, "_chunk").orderBy("_pos")
    before = F.last(known, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    backwards = Window.partitionBy(*by, "_chunk").orderBy(F.desc("_pos"))
    after = F.last(known, ignorenulls=True).over(backwards.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns(
        {"_before": F.coalesce(before, F.col("_from")), "_after": F.coalesce(after, F.col("_to"))}
    )
    step = (F.col("_pos") - F.col("_before.at")) / (F.col("_after.at") - F.col("_before.at"))
    between = F.col("_before.v") + (F.col("_after.v") - F.col("_before.v")) * step
    filled = (
        F.when(F.col(value).isNotNull(), F.col(value))
        .when(F.col("_before").isNull(), F.lit(None).cast("double"))
        .when(F.col("_after").isNull(), F.col("_before.v"))
        .otherwise(between)
    )
    return rows.withColumn(name, filled).drop("_pos", "_chunk", "_from", "_to", "_before", "_after")


def fill_leading(
    df: DataFrame, value: str, by: Sequence[str] = (), train: DataFrame | None = None, name: str | None = None
) -> DataFrame:
    """Remaining NULLs take the exact median of the series (of ``train`` rows only, if given)."""
    by = list(by)
    if train is None:
        train = df = checkpoint(df)  # read twice: for the medians and for the rows
    medians = exact_quantiles(train, [value], [0.5], by)
    if not by:
        filled = F.coalesce(F.col(value), medians.agg(F.max("value")).scalar())
        return df.withColumn(name or value, filled)
    medians = small_or_shuffled(medians.select(*by, F.col("value").alias("_median")))
    return (
        df.join(medians, by, "left")
        .withColumn(name or value, F.coalesce(F.col(value), F.col("_median")))
        .drop("_median")
    )


def temporal_split(df: DataFrame, ts: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Rows strictly before the cutoff, and the rest. Both filters reach the scan."""
    at = F.lit(cutoff).cast(dict(df.dtypes)[ts])
    return df.filter(F.col(ts) < at), df.filter(F.col(ts) >= at)


def seasonality(df: DataFrame, part, columns: Sequence[str], name: str) -> DataFrame:
    """Mean of each column by a calendar part."""
    return df.groupBy(part.alias(name)).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])
