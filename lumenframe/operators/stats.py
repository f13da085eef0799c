"""Descriptive statistics: summaries, profiles, histograms, correlation, ANOVA, box plots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.operators.joins import small_or_shuffled
from lumenframe.operators.ordered import approximate_quantiles, exact_quantiles, with_position


def _cells(columns: Sequence[str], **parts) -> Column:
    """Array of structs, one per column name, to turn one wide row into long rows."""
    return F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), *[f(c).alias(n) for n, f in parts.items()]) for c in columns])
    )


def quantile_columns(long: DataFrame, names: dict[float, str], by: Sequence[str] = ()) -> DataFrame:
    """Long quantiles to one row per (group, column)."""
    return long.groupBy(*by, "column").agg(
        *[F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n) for p, n in names.items()]
    )


QUARTILES = {0.25: "q1", 0.5: "median", 0.75: "q3"}


def describe(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, one row per column."""
    value = F.col("value")
    moments = (
        df.select(_cells(columns, value=lambda c: F.col(c).cast("double")).alias("cell"))
        .select("cell.column", "cell.value")
        .groupBy("column")
        .agg(
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
    )
    find = exact_quantiles if exact else approximate_quantiles
    quartiles = quantile_columns(find(df, columns, list(QUARTILES)), QUARTILES)
    return moments.join(quartiles, "column", "left")


def group_profile(df: DataFrame, by: Sequence[str], columns: Sequence[str], places: int = 1) -> DataFrame:
    """Group size and rounded group means."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("count"), *[F.bround(F.avg(c), places).alias(f"mean_{c}") for c in columns]
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)


def range_summary(df: DataFrame, column: str) -> DataFrame:
    """Minimum, maximum, mean and exact median of a column, one row."""
    medians = exact_quantiles(df, [column], [0.5])
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"), F.avg(column).alias("mean")).withColumn(
        "median", medians.agg(F.max("value")).scalar()
    )


def flag_totals(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Sum of each 0/1 column, one row per flag."""
    totals = df.agg(*[F.sum(f).alias(f) for f in flags])
    return totals.unpivot([], list(flags), "flag", "total").orderBy("total", "flag")


def sparsity(df: DataFrame, row: str, column: str) -> DataFrame:
    """Share of empty cells of the row x column matrix."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(row).alias("rows"), F.countDistinct(column).alias("columns")
    )
    return counts.withColumn("sparsity", 1 - F.col("n") / (F.col("rows").cast("double") * F.col("columns")))


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    count = F.countDistinct if exact else F.approx_count_distinct
    return df.agg(*[count(c).alias(f"distinct_{c}") for c in columns])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values (NULL or NaN) per column and in total."""

    def missing(c: str) -> Column:
        empty = F.col(c).isNull()
        if dict(df.dtypes)[c] in ("double", "float"):
            empty = empty | F.isnan(c)
        return F.count_if(empty)

    wide = df.agg(*[missing(c).alias(c) for c in columns])
    return wide.withColumn("total", sum((F.col(c) for c in columns), F.lit(0)))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all column pairs, upper triangle with diagonal.

    One pass over the complete rows adds up one small matrix per task.
    """
    rows = VectorAssembler(inputCols=list(columns), outputCol="_v", handleInvalid="skip").transform(df)
    matrix = Correlation.corr(rows.select("_v"), "_v").first()[0].toArray()
    cells = [
        (a, b, float(matrix[i, j])) for (i, a), (j, b) in combinations_with_replacement(enumerate(columns), 2)
    ]
    return df.sparkSession.createDataFrame(cells, "left string, right string, r double")


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line y = slope x + intercept and the x range it covers."""
    return df.agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
    )


def anova_f(long: DataFrame, feature: str, value: str, label: str) -> DataFrame:
    """One-way ANOVA F score of each feature against a class, from a long (feature, value, class) table."""
    groups = long.groupBy(feature, label).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("var")
    )
    whole = groups.groupBy(feature).agg(
        F.sum("n").alias("n_all"),
        F.count(F.lit(1)).alias("k"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
        F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("raw"),
    )
    between = F.col("raw") - F.col("n_all") * F.col("grand") * F.col("grand")
    score = F.try_divide(between / (F.col("k") - 1), F.col("within") / (F.col("n_all") - F.col("k")))
    return whole.select(feature, score.alias("f_score"))


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max] of the column (of each group), last edge closed, empty bins kept."""
    keys = [by] if by else []
    span = df.filter(F.col(column).isNotNull()).groupBy(*keys).agg(
        F.min(column).cast("double").alias("_low"), F.max(column).cast("double").alias("_high")
    )
    flat = F.col("_low") == F.col("_high")
    span = span.select(
        *keys,
        F.when(flat, F.col("_low") - 0.5).otherwise(F.col("_low")).alias("low"),
        F.when(flat, F.col("_high") + 0.5).otherwise(F.col("_high")).alias("high"),
    )
    if by:
        rows = df.select(by, F.col(column).alias("_v")).join(small_or_shuffled(span), by)
    else:
        edges = span.agg(F.first(F.struct("low", "high"))).scalar()
        rows = df.select(F.col(column).alias("_v"), edges.alias("_e")).select("_v", "_e.low", "_e.high")
    place = F.floor((F.col("_v") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    counts = (
        rows.filter(F.col("_v").isNotNull())
        .groupBy(*keys, "low", "high", F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    per_group = counts.groupBy(*keys, "low", "high").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "_c"))).alias("_m"), F.sum("_c").alias("_n")
    )
    width = (F.col("high") - F.col("low")) / bins
    grid = per_group.select(
        *keys, "low", "high", "_m", "_n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    count = F.coalesce(F.try_element_at("_m", F.col("bin")), F.lit(0).cast("long"))
    return grid.select(
        *keys,
        "bin",
        (F.col("low") + width * F.col("bin")).alias("left_edge"),
        (F.col("low") + width * (F.col("bin") + 1)).alias("right_edge"),
        count.alias("count"),
        (count / (F.col("_n") * width)).alias("density"),
    )


def box_stats(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier count of each group."""
    by = list(by)
    quartiles = quantile_columns(exact_quantiles(df, [column], list(QUARTILES), by), QUARTILES, by).drop("column")
    rows = df.select(*by, F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        rows.join(small_or_shuffled(quartiles), by)
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def mean_vector(df: DataFrame, column: str) -> DataFrame:
    """Element-wise mean of an array column, one row per position."""
    vector = array_to_vector(F.col(column).cast("array<double>"))
    mean = df.filter(F.col(column).isNotNull()).select(Summarizer.mean(vector).alias("_mean"))
    return mean.select(F.posexplode(vector_to_array("_mean")).alias("position", "mean"))


def crosstab_share(df: DataFrame, row: str, column: str, levels: Sequence) -> DataFrame:
    """Row-normalized counts, one column per level; a row without counts gives zeros."""
    counts = df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(f"_c{i}") for i, v in enumerate(levels)])
    total = sum((F.col(f"_c{i}") for i in range(len(levels))), F.lit(0))
    safe = F.when(total == 0, F.lit(1)).otherwise(total)
    return counts.select(row, *[(F.col(f"_c{i}") / safe).alias(f"{column}_{v}") for i, v in enumerate(levels)])


def dominant_category(df: DataFrame, group: str, category: str) -> DataFrame:
    """Most frequent category of each group; equal counts give the lowest category."""
    counts = df.groupBy(group, category).agg(F.count(F.lit(1)).alias("count"))
    first = Window.partitionBy(group).orderBy(F.desc("count"), category)
    return counts.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")


# The coefficients of Wichura's algorithm AS 241 (Applied Statistics 37, 1988), lowest power
# first: numerator and denominator for the centre, the shoulders and the far tails.
AS241 = (
    (
        (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
         4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
        (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
         2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
    ),
    (
        (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
         1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
        (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
         1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
    ),
    (
        (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
         2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
         7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
    ),
)


def normal_quantile(probability: Column) -> Column:
    """Inverse of the standard normal distribution function for 0 < p < 1, by rational approximation."""

    def ratio(part: int, x: Column) -> Column:
        above, below = (reduce(lambda total, c: total * x + c, k[-2::-1], F.lit(k[-1])) for k in AS241[part])
        return above / below

    q = probability - 0.5
    tail = F.sqrt(-F.log(F.least(probability, 1 - probability)))
    outer = F.when(tail <= 5, ratio(1, tail - 1.6)).otherwise(ratio(2, tail - 5.0))
    return F.when(F.abs(q) <= 0.425, q * ratio(0, 0.180625 - q * q)).otherwise(F.signum(q) * outer)


def normal_qq(df: DataFrame, column: str, id_column: str) -> DataFrame:
    """Sorted values against normal order-statistic medians (Filliben's estimate)."""
    ranked = with_position(df.filter(F.col(column).isNotNull()), [column, id_column], name="_i", total="_n")
    i, n = F.col("_i") + 1, F.col("_n")
    top = F.pow(F.lit(0.5), 1 / n)
    median = F.when(i == n, top).when(i == 1, 1 - top).otherwise((i - 0.3175) / (n + 0.365))
    return ranked.select(id_column, normal_quantile(median).alias("theoretical"), F.col(column).alias("observed"))


def spread(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation."""
    return df.groupBy(*by).agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))
