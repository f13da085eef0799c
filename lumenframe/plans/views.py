"""The analytic inputs derived from the base tables, in Spark and (for the oracle) in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.operators.sampling import multiplier
from lumenframe.sources.readers import read_table, spread


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Invoice lines; a cancelled line's invoice number starts with R, one order in 50 has no customer."""
    orders = read_table(spark, sf, "orders")
    lines = read_table(spark, sf, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey")).alias("customer_id"),
        F.concat("l_returnflag", F.col("o_orderkey").cast("string")).alias("invoice_no"),
        F.col("o_orderdate").alias("invoice_ts"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("line_price"),
    )


SALES = """
sales AS (
  SELECT CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS customer_id,
         l_returnflag || CAST(o_orderkey AS VARCHAR) AS invoice_no,
         o_orderdate AS invoice_ts, l_quantity AS quantity,
         l_extendedprice / l_quantity AS unit_price, l_extendedprice AS line_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

RFM = (
    SALES
    + """, kept AS (
  SELECT *, quantity * unit_price AS total FROM sales
  WHERE customer_id IS NOT NULL AND invoice_no NOT LIKE 'R%'
), snap AS (SELECT max(invoice_ts) + INTERVAL 1 DAY AS snapshot_at FROM kept),
rfm AS (
  SELECT customer_id,
         CAST(floor((epoch_us(max(s.snapshot_at)) - epoch_us(max(invoice_ts))) / 86400000000) AS BIGINT) AS recency,
         count(DISTINCT invoice_no) AS frequency, round(sum(total), 2) AS monetary
  FROM kept, snap s GROUP BY customer_id
)"""
)


def series(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered measurements, one series per event type, every 50th value missing."""
    return read_table(spark, sf, "events").select(
        F.col("event_type").alias("series"),
        "ts",
        "event_id",
        F.when(F.col("event_id") % 50 != 0, F.col("value")).alias("value"),
    )


SERIES = """
series AS (
  SELECT event_type AS series, ts, event_id,
         CASE WHEN event_id % 50 <> 0 THEN value END AS value
  FROM events
)"""


def listings(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric regression input: price of a line from its quantity, discount, tax, size and list price."""
    lines = spread(read_table(spark, sf, "lineitem"))
    parts = read_table(spark, sf, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") * 1000003 + F.col("l_linenumber") * 100003 + F.col("l_partkey")).alias("id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").alias("list_price"),
        F.col("l_extendedprice").alias("price"),
        F.log1p("l_extendedprice").alias("log_price"),
    )


LISTINGS = """
listings AS (
  SELECT l_orderkey * 1000003 + l_linenumber * 100003 + l_partkey AS id,
         l_quantity AS quantity, l_discount AS discount, l_tax AS tax,
         CAST(p_size AS DOUBLE) AS size, p_retailprice AS list_price,
         l_extendedprice AS price, ln(1 + l_extendedprice) AS log_price
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """One rating in [1, 5] per (user, item): repeated pairs are averaged."""
    orders = read_table(spark, sf, "orders")
    lines = read_table(spark, sf, "lineitem")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.avg(1 + F.floor((F.col("l_quantity") - 1) / 10)).alias("rating"))
    )


RATINGS = """
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         avg(1 + floor((l_quantity - 1) / 10)) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY ALL
)"""

# Split key: multiplicative hash of the id, the same arithmetic in both engines.
def split_key_sql(id_column: str, seed: int = 42) -> str:
    return f"((({id_column}) % 2147483648) * {multiplier(seed)}) % 4294967296"



def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows with a rare 0/1 label, one scoring method per event type."""
    return read_table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("method"),
        (F.col("event_id") % 581 == 0).cast("int").alias("y"),
        F.col("value").alias("score"),
    )


SCORED = """
scored AS (
  SELECT event_id AS id, event_type AS method,
         CAST(event_id % 581 = 0 AS INTEGER) AS y, value AS score
  FROM events
)"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Float vectors with a class label and a 0/1 target."""
    return read_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        "embedding",
        "label",
        (F.col("label") >= 7).cast("int").alias("y"),
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted against actual classes: the vector label against ``vec_id % 10``."""
    return read_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("actual"), (F.col("vec_id") % 10).cast("int").alias("predicted")
    )


LABELLED = """
labelled AS (
  SELECT vec_id AS id, label AS actual, CAST(vec_id % 10 AS INTEGER) AS predicted FROM embeddings
)"""


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled texts: document text with its 0/1 quality label."""
    docs = spread(read_table(spark, sf, "documents"))
    labels = read_table(spark, sf, "labels")
    return docs.join(labels, "doc_id").select("doc_id", "text", "lang", "source", F.col("quality").alias("label"))


REVIEWS = """
reviews AS (
  SELECT d.doc_id, d.text, d.lang, d.source, l.quality AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""
