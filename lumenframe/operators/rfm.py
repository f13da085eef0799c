"""Customer segmentation by recency, frequency and spend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.columns import not_prefixed, whole_days_between
from lumenframe.operators.ordered import approximate_quantiles, exact_quantiles
from lumenframe.session import checkpoint

METRICS = ("recency", "frequency", "monetary")


def billable(sales: DataFrame, cancel_prefix: str = "C") -> DataFrame:
    """Lines with a customer whose invoice was not cancelled, with their total."""
    return (
        sales.dropna(subset=["customer_id"])
        .filter(not_prefixed("invoice_no", cancel_prefix))
        .withColumn("total", F.col("quantity") * F.col("unit_price"))
    )


def rfm(lines: DataFrame) -> DataFrame:
    """Per customer: days since the last purchase, number of invoices, spend.

    The snapshot is one day after the last purchase of all. It is read from the
    customer table, which is written once, so the lines are scanned only once.
    Spark counts the distinct invoices in two steps, (customer, invoice) first,
    so a very large customer does not end up in one task.
    """
    per_customer = checkpoint(
        lines.groupBy("customer_id").agg(
            F.max("invoice_ts").alias("_last"),
            F.countDistinct("invoice_no").alias("frequency"),
            F.sum("total").alias("monetary"),
        )
    )
    snapshot = per_customer.agg(F.max("_last") + F.expr("INTERVAL 1 DAY")).scalar()
    return per_customer.select(
        "customer_id", whole_days_between(snapshot, F.col("_last")).alias("recency"), "frequency", "monetary"
    )


def cap_outliers(
    df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99, exact: bool = True
) -> DataFrame:
    """Clamp each column to its ``low`` and ``high`` quantile."""
    find = exact_quantiles if exact else approximate_quantiles
    bounds = find(df, columns, [low, high])

    def bound(column: str, p: float):
        hit = (F.col("column") == column) & (F.col("probability") == p)
        return F.max(F.when(hit, F.col("value")))

    edges = bounds.agg(
        F.struct(*[F.struct(bound(c, low).alias("low"), bound(c, high).alias("high")).alias(c) for c in columns])
    ).scalar()
    with_edges = df.withColumn("_edges", edges)

    def clamped(c: str):
        low_edge, high_edge = F.col(f"_edges.{c}.low"), F.col(f"_edges.{c}.high")
        v = F.col(c).cast("double")
        return F.when(v < low_edge, low_edge).when(v > high_edge, high_edge).otherwise(v)

    return with_edges.withColumns({c: clamped(c) for c in columns}).drop("_edges")


def name_segments(centers: DataFrame, names: Sequence[str]) -> DataFrame:
    """Names clusters by their centers: best (recent, frequent, high spend) first.

    Cluster numbers are arbitrary, so names follow the order of
    ``monetary + frequency - recency`` of the standardized centers.
    """
    value = F.col("monetary") + F.col("frequency") - F.col("recency")
    place = F.row_number().over(Window.orderBy(F.desc(value), "cluster"))
    labels = F.array(*[F.lit(n) for n in names])
    return centers.withColumn("segment", F.try_element_at(labels, place))


def filter_segments(
    df: DataFrame, segments: Sequence[str], recency: tuple[float, float], monetary: tuple[float, float]
) -> DataFrame:
    return df.filter(
        F.col("segment").isin(*segments) & F.col("recency").between(*recency) & F.col("monetary").between(*monetary)
    )


def kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("customers"),
        F.bround(F.avg("recency"), 1).alias("avg_recency"),
        F.bround(F.avg("frequency"), 1).alias("avg_frequency"),
        F.bround(F.avg("monetary"), 2).alias("avg_monetary"),
    )
