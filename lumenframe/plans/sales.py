"""Customer segmentation queries over the invoice lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.functions import columns as fx
from lumenframe.operators import rfm as seg
from lumenframe.operators import stats
from lumenframe.plans.registry import query
from lumenframe.plans.views import RFM, SALES, sales

SEGMENTS = {0: "Champions", 1: "Lost", 2: "New/Promising"}


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return seg.billable(sales(spark, sf), "R")


def rfm_table(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(seg.rfm(lines(spark, sf)), 2, "monetary")


def clustered(spark: SparkSession, sf: str) -> DataFrame:
    """RFM rows with a rule-based cluster number 0..3, so that SQL can follow."""
    return rfm_table(spark, sf).withColumn("cluster", F.least(F.floor(F.col("frequency") / 5), F.lit(3)).cast("int"))


CLUSTERED = (
    RFM + ", clustered AS (SELECT *, CAST(least(floor(frequency / 5), 3) AS INTEGER) AS cluster FROM rfm)"
)


@query(
    "c1_line_total",
    f"WITH {SALES} SELECT invoice_no, quantity, round(quantity * unit_price, 2) AS total FROM sales",
)
def c1_line_total(spark, sf):
    df = sales(spark, sf).select("invoice_no", "quantity", (F.col("quantity") * F.col("unit_price")).alias("total"))
    return rounded(df, 2, "total")


@query(
    "d1_drop_null_customer",
    f"WITH {SALES} SELECT customer_id, invoice_no, line_price FROM sales WHERE customer_id IS NOT NULL",
)
def d1_drop_null_customer(spark, sf):
    return sales(spark, sf).dropna(subset=["customer_id"]).select("customer_id", "invoice_no", "line_price")


@query(
    "d2_not_cancelled",
    f"WITH {SALES} SELECT customer_id, invoice_no, line_price FROM sales WHERE invoice_no NOT LIKE 'R%'",
)
def d2_not_cancelled(spark, sf):
    return sales(spark, sf).filter(fx.not_prefixed("invoice_no", "R")).select("customer_id", "invoice_no", "line_price")


@query(
    "c10_days_since_purchase",
    f"""WITH {SALES}, snap AS (SELECT max(invoice_ts) + INTERVAL 1 DAY AS snapshot_at FROM sales)
    SELECT invoice_no, CAST(floor((epoch_us(snapshot_at) - epoch_us(invoice_ts)) / 86400000000) AS BIGINT) AS days
    FROM sales, snap""",
)
def c10_days_since_purchase(spark, sf):
    df = sales(spark, sf)
    snapshot = df.agg(F.max("invoice_ts") + F.expr("INTERVAL 1 DAY")).scalar()
    return df.select("invoice_no", fx.whole_days_between(snapshot, F.col("invoice_ts")).alias("days"))


@query("e1_rfm", f"WITH {RFM} SELECT * FROM rfm")
def e1_rfm(spark, sf):
    return rfm_table(spark, sf)


@query(
    "w7_capped_rfm",
    f"""WITH {RFM}, b AS (
      SELECT quantile_cont(recency, 0.01) AS rl, quantile_cont(recency, 0.99) AS rh,
             quantile_cont(frequency, 0.01) AS fl, quantile_cont(frequency, 0.99) AS fh,
             quantile_cont(monetary, 0.01) AS ml, quantile_cont(monetary, 0.99) AS mh FROM rfm)
    SELECT customer_id, round(least(greatest(recency, rl), rh), 4) AS recency,
           round(least(greatest(frequency, fl), fh), 4) AS frequency,
           round(least(greatest(monetary, ml), mh), 4) AS monetary FROM rfm, b""",
)
def w7_capped_rfm(spark, sf):
    return rounded(seg.cap_outliers(rfm_table(spark, sf), seg.METRICS), 4, *seg.METRICS)


@query(
    "e2_describe_rfm",
    f"""WITH {RFM}, long AS (
      SELECT 'recency' AS "column", CAST(recency AS DOUBLE) AS v FROM rfm
      UNION ALL SELECT 'frequency', frequency FROM rfm UNION ALL SELECT 'monetary', monetary FROM rfm)
    SELECT "column", count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std,
           min(v) AS min, max(v) AS max, round(quantile_cont(v, 0.25), 4) AS q1,
           round(quantile_cont(v, 0.5), 4) AS median, round(quantile_cont(v, 0.75), 4) AS q3
    FROM long GROUP BY 1""",
)
def e2_describe_rfm(spark, sf):
    return rounded(stats.describe(rfm_table(spark, sf), seg.METRICS), 4, "mean", "std", "q1", "median", "q3")


@query(
    "e3_cluster_profile",
    f"""WITH {CLUSTERED} SELECT cluster, count(*) AS count, round_even(avg(recency), 1) AS mean_recency,
      round_even(avg(frequency), 1) AS mean_frequency, round_even(avg(monetary), 1) AS mean_monetary
    FROM clustered GROUP BY cluster""",
)
def e3_cluster_profile(spark, sf):
    return stats.group_profile(clustered(spark, sf), ["cluster"], seg.METRICS)


@query("e4_value_counts", f"WITH {CLUSTERED} SELECT cluster, count(*) AS count FROM clustered GROUP BY cluster")
def e4_value_counts(spark, sf):
    return stats.value_counts(clustered(spark, sf), "cluster")


FILTERED = """, named AS (
  SELECT *, CASE cluster WHEN 0 THEN 'Champions' WHEN 1 THEN 'Lost' WHEN 2 THEN 'New/Promising' END AS segment
  FROM clustered), filtered AS (
  SELECT * FROM named WHERE segment IN ('Champions', 'Lost')
    AND recency BETWEEN 1 AND 900 AND monetary BETWEEN 50000 AND 900000)"""


def named(spark: SparkSession, sf: str) -> DataFrame:
    return clustered(spark, sf).withColumn("segment", fx.mapped("cluster", SEGMENTS))


def filtered(spark: SparkSession, sf: str) -> DataFrame:
    return seg.filter_segments(named(spark, sf), ["Champions", "Lost"], (1, 900), (50000, 900000))


@query("c12_map_segment", f"WITH {CLUSTERED}{FILTERED} SELECT customer_id, cluster, segment FROM named")
def c12_map_segment(spark, sf):
    return named(spark, sf).select("customer_id", "cluster", "segment")


@query(
    "d3_segment_filter",
    f"WITH {CLUSTERED}{FILTERED} SELECT customer_id, segment, recency, monetary FROM filtered",
)
def d3_segment_filter(spark, sf):
    return filtered(spark, sf).select("customer_id", "segment", "recency", "monetary")


@query(
    "e5_kpis",
    f"""WITH {CLUSTERED}{FILTERED} SELECT count(*) AS customers, round_even(avg(recency), 1) AS avg_recency,
      round_even(avg(frequency), 1) AS avg_frequency, round_even(avg(monetary), 2) AS avg_monetary FROM filtered""",
)
def e5_kpis(spark, sf):
    return seg.kpis(filtered(spark, sf))


@query(
    "e6_monetary_range",
    f"""WITH {RFM} SELECT min(monetary) AS min, max(monetary) AS max, round(avg(monetary), 4) AS mean,
      round(median(monetary), 4) AS median FROM rfm""",
)
def e6_monetary_range(spark, sf):
    return rounded(stats.range_summary(rfm_table(spark, sf), "monetary"), 4, "mean", "median")


@query(
    "r1_melt_profile",
    f"""WITH {CLUSTERED}, p AS (SELECT cluster, round_even(avg(recency), 1) AS mean_recency,
      round_even(avg(frequency), 1) AS mean_frequency, round_even(avg(monetary), 1) AS mean_monetary
      FROM clustered GROUP BY cluster)
    SELECT cluster, 'mean_recency' AS variable, mean_recency AS value FROM p
    UNION ALL SELECT cluster, 'mean_frequency', mean_frequency FROM p
    UNION ALL SELECT cluster, 'mean_monetary', mean_monetary FROM p""",
)
def r1_melt_profile(spark, sf):
    profile = stats.group_profile(clustered(spark, sf), ["cluster"], seg.METRICS).drop("count")
    return profile.unpivot(["cluster"], [c for c in profile.columns if c != "cluster"], "variable", "value")


@query(
    "c16_rounding",
    f"""WITH {SALES} SELECT invoice_no, round_even(line_price / 8, 1) AS one, round_even(line_price / 7, 4) AS four
    FROM sales""",
)
def c16_rounding(spark, sf):
    return sales(spark, sf).select(
        "invoice_no",
        fx.half_even(F.col("line_price") / 8, 1).alias("one"),
        fx.half_even(F.col("line_price") / 7, 4).alias("four"),
    )


@query(
    "c15_select_rename",
    f"""WITH {SALES} SELECT invoice_no AS invoice, quantity AS units, line_price FROM sales""",
)
def c15_select_rename(spark, sf):
    df = sales(spark, sf).drop("customer_id", "invoice_ts", "unit_price")
    return df.withColumnsRenamed({"invoice_no": "invoice", "quantity": "units"})


@query(
    "k3_name_clusters",
    f"""WITH {CLUSTERED}, s AS (SELECT cluster,
        (recency - avg(recency) OVER ()) / stddev_pop(recency) OVER () AS zr,
        (frequency - avg(frequency) OVER ()) / stddev_pop(frequency) OVER () AS zf,
        (monetary - avg(monetary) OVER ()) / stddev_pop(monetary) OVER () AS zm FROM clustered),
    c AS (SELECT cluster, avg(zm) + avg(zf) - avg(zr) AS v FROM s GROUP BY cluster),
    r AS (SELECT cluster, row_number() OVER (ORDER BY v DESC, cluster) AS place FROM c)
    SELECT cluster, CASE place WHEN 1 THEN 'Champions' WHEN 2 THEN 'Loyal' WHEN 3 THEN 'At Risk'
      WHEN 4 THEN 'Lost' END AS segment FROM r""",
)
def k3_name_clusters(spark, sf):
    from lumenframe.operators.features import standardize

    scaled = standardize(clustered(spark, sf), seg.METRICS)
    centers = scaled.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in seg.METRICS])
    named = seg.name_segments(centers, ["Champions", "Loyal", "At Risk", "Lost"])
    return named.select("cluster", "segment")
