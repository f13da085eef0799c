"""Price regression inputs: derived features, summaries, bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import columns as fx
from lumenframe.operators import features, stats
from lumenframe.plans.registry import query
from lumenframe.plans.sales import rounded
from lumenframe.plans.views import LISTINGS, listings

NUMERIC = ["quantity", "discount", "tax", "size", "list_price", "price"]


@query(
    "c2_ratio_features",
    f"""WITH {LISTINGS} SELECT id, round(price / quantity, 8) AS price_per_unit,
      round(tax / nullif(discount, 0), 8) AS tax_per_discount,
      round(price / list_price, 8) AS price_ratio FROM listings""",
)
def c2_ratio_features(spark, sf):
    df = listings(spark, sf).select(
        "id",
        fx.ratio("price", "quantity").alias("price_per_unit"),
        fx.ratio("tax", "discount").alias("tax_per_discount"),
        fx.ratio("price", "list_price").alias("price_ratio"),
    )
    return rounded(df, 8, "price_per_unit", "tax_per_discount", "price_ratio")


@query(
    "c3_scalar_feature",
    f"""WITH {LISTINGS} SELECT id,
      round(price / (SELECT count(DISTINCT size) * count(DISTINCT quantity) FROM listings), 6) AS density
    FROM listings""",
)
def c3_scalar_feature(spark, sf):
    df = listings(spark, sf)
    cells = df.agg((F.countDistinct("size") * F.countDistinct("quantity")).cast("double")).scalar()
    return df.select("id", F.round(F.col("price") / cells, 6).alias("density"))


@query(
    "c4_log_transform",
    f"""WITH {LISTINGS} SELECT id, round(log_price, 6) AS log_price,
      round(exp(log_price) - 1, 3) AS restored FROM listings""",
)
def c4_log_transform(spark, sf):
    return listings(spark, sf).select(
        "id", F.round("log_price", 6).alias("log_price"), F.round(F.expm1("log_price"), 3).alias("restored")
    )


@query(
    "c5_threshold_label",
    f"WITH {LISTINGS} SELECT id, CAST(price >= 50000 AS INTEGER) AS expensive FROM listings",
)
def c5_threshold_label(spark, sf):
    return listings(spark, sf).select("id", fx.threshold_label("price", 50000).alias("expensive"))


@query(
    "d6_label_range",
    f"WITH {LISTINGS} SELECT id, size FROM listings WHERE size BETWEEN 3 AND 8",
)
def d6_label_range(spark, sf):
    return listings(spark, sf).filter(F.col("size").between(3, 8)).select("id", "size")


@query(
    "d9_fill_null",
    f"""WITH {LISTINGS} SELECT id, round(coalesce(tax / nullif(discount, 0), 0), 6) AS tax_per_discount
    FROM listings""",
)
def d9_fill_null(spark, sf):
    df = listings(spark, sf).select("id", fx.ratio("tax", "discount").alias("tax_per_discount"))
    return rounded(df.fillna(0.0, subset=["tax_per_discount"]), 6, "tax_per_discount")


@query(
    "e2_describe_listings",
    f"""WITH {LISTINGS}, long AS (UNPIVOT (SELECT {", ".join(NUMERIC)} FROM listings)
      ON {", ".join(NUMERIC)} INTO NAME "column" VALUE v)
    SELECT "column", count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std,
           min(v) AS min, max(v) AS max, round(quantile_cont(v, 0.25), 4) AS q1,
           round(quantile_cont(v, 0.5), 4) AS median, round(quantile_cont(v, 0.75), 4) AS q3
    FROM long GROUP BY 1""",
)
def e2_describe_listings(spark, sf):
    return rounded(stats.describe(listings(spark, sf), NUMERIC), 4, "mean", "std", "q1", "median", "q3")


@query(
    "e11_distinct_counts",
    f"""WITH {LISTINGS} SELECT count(DISTINCT size) AS distinct_size,
      count(DISTINCT quantity) AS distinct_quantity FROM listings""",
)
def e11_distinct_counts(spark, sf):
    return stats.distinct_counts(listings(spark, sf), ["size", "quantity"])


@query(
    "e12_null_audit",
    f"""WITH {LISTINGS}, f AS (SELECT quantity, tax / nullif(discount, 0) AS tax_per_discount FROM listings)
    SELECT count(*) FILTER (quantity IS NULL) AS quantity,
      count(*) FILTER (tax_per_discount IS NULL) AS tax_per_discount,
      count(*) FILTER (quantity IS NULL) + count(*) FILTER (tax_per_discount IS NULL) AS total FROM f""",
)
def e12_null_audit(spark, sf):
    df = listings(spark, sf).select("quantity", fx.ratio("tax", "discount").alias("tax_per_discount"))
    return stats.null_counts(df, ["quantity", "tax_per_discount"])


PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]]


@query(
    "e14_correlation_matrix",
    f"WITH {LISTINGS} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 6) + 0 AS r FROM listings" for a, b in PAIRS
    ),
)
def e14_correlation_matrix(spark, sf):
    return rounded(stats.correlations(listings(spark, sf), NUMERIC), 6, "r")


@query(
    "e15_linear_trend",
    f"""WITH {LISTINGS} SELECT round(regr_slope(price, quantity), 4) AS slope,
      round(regr_intercept(price, quantity), 4) AS intercept,
      min(quantity) AS x_min, max(quantity) AS x_max FROM listings""",
)
def e15_linear_trend(spark, sf):
    return rounded(stats.linear_trend(listings(spark, sf), "quantity", "price"), 4, "slope", "intercept")


def histogram_sql(source: str, column: str, bins: int, by: str | None = None) -> str:
    key = f"{by}, " if by else ""
    using = f"USING ({by})" if by else "ON true"
    group = f"GROUP BY {by}" if by else ""
    return f"""span AS (SELECT {key}min({column}) AS low, max({column}) AS high, count({column}) AS n
      FROM {source} {group}),
    placed AS (SELECT {key}CAST(least(floor(({column} - low) / (high - low) * {bins}), {bins - 1}) AS INTEGER) AS bin,
      count(*) AS c FROM {source} JOIN span {using} GROUP BY ALL),
    grid AS (SELECT span.*, CAST(unnest(range({bins})) AS INTEGER) AS bin FROM span)
    SELECT {key}bin, round(low + (high - low) / {bins} * bin, 6) AS left_edge,
      round(low + (high - low) / {bins} * (bin + 1), 6) AS right_edge, coalesce(c, 0) AS count,
      round(coalesce(c, 0) / (n * ((high - low) / {bins})), 8) AS density
    FROM grid LEFT JOIN placed USING ({key}bin)"""


def shown(df):
    return rounded(rounded(df, 6, "left_edge", "right_edge"), 8, "density")


@query("e17_histogram", f"WITH {LISTINGS}, {histogram_sql('listings', 'log_price', 50)}")
def e17_histogram(spark, sf):
    return shown(stats.histogram(listings(spark, sf), "log_price", 50))


@query(
    "w6_quantile_bins",
    f"""WITH {LISTINGS}, e AS (SELECT list_distinct(quantile_cont(price,
        [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS price_edges,
      list_distinct(quantile_cont(size, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS size_edges
      FROM listings)
    SELECT id, CAST(greatest(len(list_filter(price_edges, lambda x: x < price)) - 1, 0) AS INTEGER) AS price_bin,
      CAST(greatest(len(list_filter(size_edges, lambda x: x < size)) - 1, 0) AS INTEGER) AS size_bin
    FROM listings, e""",
)
def w6_quantile_bins(spark, sf):
    df = features.quantile_bins(listings(spark, sf), ["price", "size"], 10)
    return df.select("id", "price_bin", "size_bin")


@query(
    "f1_standardize_listings",
    f"""WITH {LISTINGS}, t AS (SELECT * FROM listings WHERE id % 5 <> 0),
    m AS (SELECT avg(price) AS pm, stddev_pop(price) AS ps, avg(size) AS sm, stddev_pop(size) AS ss FROM t)
    SELECT id, round((price - pm) / ps, 6) AS price, round((size - sm) / ss, 6) AS size FROM listings, m""",
)
def f1_standardize_listings(spark, sf):
    df = listings(spark, sf)
    scaled = features.standardize(df, ["price", "size"], train=df.filter(F.col("id") % 5 != 0))
    return rounded(scaled.select("id", "price", "size"), 6, "price", "size")
