"""Feature transforms: standardization, encodings, quantile bins, centred PCA, cosine similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.operators.joins import small_or_shuffled
from lumenframe.operators.ordered import exact_quantiles, with_position, with_running


def scaling_moments(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population deviation of each column; a constant column scales by 1."""
    return train.agg(
        *[
            F.struct(
                F.avg(c).alias("mean"),
                F.when(F.stddev_pop(c) == 0, F.lit(1.0)).otherwise(F.stddev_pop(c)).alias("std"),
            ).alias(c)
            for c in columns
        ]
    )


def standardize(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation, both taken from ``train`` (default: ``df``).

    The moments come in as one scalar subquery, so no join and no extra shuffle.
    """
    moments = scaling_moments(train if train is not None else df, columns)
    moments = moments.select(F.struct(*columns).alias("m")).scalar()
    with_moments = df.withColumn("_m", moments)
    scaled = {c: (F.col(c) - F.col(f"_m.{c}.mean")) / F.col(f"_m.{c}.std") for c in columns}
    return with_moments.withColumns(scaled).drop("_m")


def standardize_array(df: DataFrame, column: str, train: DataFrame | None = None, name: str | None = None) -> DataFrame:
    """:func:`standardize` for every position of an array column; one array of moments, however wide."""
    cells = (train if train is not None else df).select(F.posexplode(column).alias("position", "value"))
    value = F.col("value").cast("double")
    moments = cells.groupBy("position").agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    scale = F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std"))
    packed = moments.agg(F.array_sort(F.collect_list(F.struct("position", "mean", scale.alias("std"))))).scalar()
    scaled = F.zip_with(F.col(column), F.col("_m"), lambda x, m: (x.cast("double") - m["mean"]) / m["std"])
    return df.withColumn("_m", packed).withColumn(name or column, scaled).drop("_m")


def quantile_bins(df: DataFrame, columns: str | Sequence[str], bins: int = 10) -> DataFrame:
    """Adds ``<column>_bin``: equal-count bins with right-closed edges at the exact quantiles.

    Equal edges merge. The lowest value belongs to the first bin; NULL stays
    NULL. The edges of all columns come from one pass.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    long = exact_quantiles(df, names, [i / bins for i in range(bins + 1)])

    def edges_of(c: str):
        mine = F.collect_list(F.when(F.col("column") == c, F.col("value")))
        return F.array_distinct(F.array_sort(mine)).alias(c)

    edges = long.agg(F.struct(*[edges_of(c) for c in names])).scalar()
    with_edges = df.withColumn("_edges", edges)

    def place(c: str):
        v = F.col(c).cast("double")
        below = F.size(F.filter(F.col(f"_edges.{c}"), lambda e: e < v))
        return F.when(F.col(c).isNotNull(), F.greatest(below - 1, F.lit(0)))

    return with_edges.withColumns({f"{c}_bin": place(c) for c in names}).drop("_edges")


def label_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Rank of each distinct value in sorted order, from 0."""
    distinct = df.select(column).filter(F.col(column).isNotNull()).distinct()
    codes = with_position(distinct, [column], name=name)
    return df.join(small_or_shuffled(codes), column, "left")


def unit_length(df: DataFrame, column: str, name: str = "unit", floor: float = 1e-10) -> DataFrame:
    """Array column divided by its Euclidean norm plus ``floor``."""
    as_double = F.transform(F.col(column), lambda x: x.cast("double"))
    squares = F.aggregate(as_double, F.lit(0.0), lambda total, x: total + x * x)
    return df.withColumn(name, F.transform(as_double, lambda x: x / (F.sqrt(squares) + floor)))


def fit_pca(df: DataFrame, column: str, k: int, output: str = "components") -> PipelineModel:
    """Centre, then project: Spark's PCA fits on centred rows but projects rows as they are."""
    center = StandardScaler(inputCol=column, outputCol="_centered", withMean=True, withStd=False)
    return Pipeline(stages=[center, PCA(k=k, inputCol="_centered", outputCol=output)]).fit(df)


def explained_variance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Variance share of each component and the running share; one row per component."""
    shares = [float(x) for x in model.stages[-1].explainedVariance]
    rows = [(i + 1, share, sum(shares[: i + 1])) for i, share in enumerate(shares)]
    return spark.createDataFrame(rows, "component int, ratio double, cumulative double")


def first_reaching(df: DataFrame, value: str, order: Sequence, threshold: float) -> DataFrame:
    """Number of rows, in order, whose values sum up to ``threshold`` of the total; all rows, if never."""
    running = with_running(df, order, {"_sum": value}, totals=True)
    below = F.count_if(F.col("_sum") < F.lit(threshold) * F.col("_sum_total"))
    return running.agg(F.least(below + 1, F.count(F.lit(1))).alias("needed"))
