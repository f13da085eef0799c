"""Reader and writer queries: table rows are written as files in the shared folder and read back."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lumenframe.functions import columns as fx
from lumenframe.operators import sampling, stats
from lumenframe.plans.listings import NUMERIC
from lumenframe.plans.registry import query
from lumenframe.plans.sales import rounded
from lumenframe.plans.scoring import METRICS, metric_table
from lumenframe.plans.views import LISTINGS, REVIEWS, SALES, SERIES, listings, reviews, sales, series, split_key_sql, vectors
from lumenframe.session import scratch_path
from lumenframe.sources import readers, writers
from lumenframe.sources.readers import read_table


@query(
    "a1_read_csv",
    f"""WITH {SERIES} SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
      CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, value, series AS wind FROM series""",
)
def a1_read_csv(spark, sf):
    df = series(spark, sf).select(
        "event_id",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.hour("ts").alias("hour"),
        "value",
        F.col("series").alias("wind"),
    )
    path = scratch_path(spark, "csv")
    df.write.option("header", True).option("nullValue", "NA").csv(path)
    schema = "event_id long, year int, month int, day int, hour int, value double, wind string"
    return readers.read_measurements(spark, path, schema)


@query(
    "a2_read_semicolons",
    """SELECT p_partkey AS id, p_retailprice AS price, CAST(p_size % 10 AS INTEGER) AS quality,
      CAST(p_size % 10 >= 7 AS INTEGER) AS quality_binary FROM part""",
)
def a2_read_semicolons(spark, sf):
    df = read_table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"), (F.col("p_size") % 10).alias("quality")
    )
    path = scratch_path(spark, "semicolons")
    df.write.option("header", True).option("sep", ";").csv(path)
    return readers.read_quality(spark, path, "id long, price double, quality int")


@query(
    "a3_read_ratings",
    """SELECT o_custkey AS user_id, l_partkey AS item_id, 1 + floor((l_quantity - 1) / 10) AS rating,
      CAST(epoch(o_orderdate) AS BIGINT) AS timestamp FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def a3_read_ratings(spark, sf):
    lines = read_table(spark, sf, "lineitem").join(
        read_table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    df = lines.select(
        "o_custkey",
        "l_partkey",
        (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("double"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")),
    )
    path = scratch_path(spark, "ratings")
    df.write.option("sep", "\t").csv(path)
    return readers.read_ratings(spark, path)


ITEM_FLAGS = [f"size_{i}" for i in range(19)]


@query(
    "a4_read_items",
    "SELECT p_partkey AS item_id, 'é ' || p_name AS title, "
    + ", ".join(f"CAST(p_size % 19 = {i} AS INTEGER) AS size_{i}" for i in range(19))
    + " FROM part",
)
def a4_read_items(spark, sf):
    df = read_table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("é "), "p_name"),
        F.lit("01-Jan-1995"),
        F.lit(None).cast("string"),
        F.lit("link"),
        *[(F.col("p_size") % 19 == i).cast("int").alias(n) for i, n in enumerate(ITEM_FLAGS)],
    )
    path = scratch_path(spark, "items")
    df.write.option("sep", "|").option("encoding", "ISO-8859-1").csv(path)
    return readers.read_items(spark, path, ITEM_FLAGS)


@query(
    "a5_read_transactions",
    f"WITH {SALES} SELECT customer_id, invoice_no, invoice_ts, quantity FROM sales",
)
def a5_read_transactions(spark, sf):
    path = scratch_path(spark, "sales") + ".parquet"
    df = sales(spark, sf).select("customer_id", "invoice_no", "invoice_ts", "quantity")
    df.write.parquet(path)
    return readers.read_transactions(spark, path, df.schema)


@query(
    "a6_read_labelled_texts",
    f"""WITH {REVIEWS} SELECT doc_id, length(text) AS size, label,
      CASE WHEN {split_key_sql('doc_id')} < 858993459 THEN 'test' ELSE 'train' END AS split FROM reviews""",
)
def a6_read_labelled_texts(spark, sf):
    df = sampling.hash_split(reviews(spark, sf), "doc_id")
    paths = {}
    for part in ("train", "test"):
        paths[part] = scratch_path(spark, f"texts-{part}")
        df.filter(F.col("split") == part).select("doc_id", "text", "label").write.parquet(paths[part])
    texts = readers.read_labelled_texts(spark, paths)
    return texts.select("doc_id", F.length("text").cast("long").alias("size"), "label", "split")


@query(
    "a7_read_corpus",
    """WITH t AS (SELECT doc_id, lang, regexp_replace(text, '[\\x09-\\x0D\\x20]+', ' ', 'g') AS body FROM documents)
    SELECT doc_id, lang AS category, length(body) AS size, md5(body) AS digest FROM t WHERE lang IN ('en', 'de')""",
)
def a7_read_corpus(spark, sf):
    """One file per message in a folder per category, read back without header, attribution, quote and signature."""
    message = F.concat(
        F.lit("From: a@example.com\nSubject: a long\n  folded line\n\nB. writes:\n> earlier\n[[["),
        F.concat(F.col("doc_id").cast("string"), F.lit("]]]\n--\n((("), F.regexp_replace("text", r"[\x09-\x0D\x20]+", " ")),
        F.lit(")))\n--\nB.\n"),
    )
    folder = scratch_path(spark, "corpus")
    documents = readers.spread(read_table(spark, sf, "documents"))
    writers.write_messages(documents.select(message.alias("value"), F.col("lang").alias("category")), folder)
    read = readers.read_corpus(spark, folder, ["category=en", "category=de"])
    body = F.regexp_extract("text", r"(?s)\A\[\[\[(\d+)\]\]\]\n--\n\(\(\((.*)\)\)\)\z", 2)
    return read.select(
        F.regexp_extract("text", r"\A\[\[\[(\d+)\]\]\]", 1).cast("long").alias("doc_id"),
        F.regexp_replace("category", "^category=", "").alias("category"),
        F.length(body).cast("long").alias("size"),
        F.md5(body.cast("binary")).alias("digest"),
    )


@query(
    "a8_read_wide",
    """WITH l AS (SELECT vec_id, label, CAST(unnest(range(64)) AS INTEGER) AS position,
      CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)
    SELECT vec_id, label, position, value FROM l""",
)
def a8_read_wide(spark, sf):
    df = vectors(spark, sf)
    path = scratch_path(spark, "wide")
    wide = df.select(F.col("id").alias("vec_id"), "label", *[F.col("embedding")[i].alias(f"x{i}") for i in range(64)])
    wide.write.parquet(path)
    read = readers.read_wide(spark, path, "label", ignore=["vec_id"])
    return read.select("vec_id", "label", F.posexplode(vector_to_array("features")).alias("position", "value"))


PREDICTIONS = f"""{REVIEWS}, p AS (SELECT doc_id, text, label, CAST(length(text) >= 1000 AS INTEGER) AS prediction FROM reviews)"""


def predictions(spark, sf):
    return reviews(spark, sf).select(
        "doc_id", "text", "label", (F.length("text") >= 1000).cast("int").alias("prediction")
    )


@query(
    "a9_read_predictions",
    f"WITH {PREDICTIONS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, CAST(label AS VARCHAR) AS label, CAST(prediction AS VARCHAR) AS prediction FROM p",
)
def a9_read_predictions(spark, sf):
    path = scratch_path(spark, "predictions")
    df = predictions(spark, sf)
    writers.write_table(df.toDF(*[f" {c} " for c in df.columns]), path)
    return readers.read_predictions(spark, path)


@query(
    "b1_write_table",
    f"WITH {PREDICTIONS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(label AS VARCHAR) AS label FROM p",
)
def b1_write_table(spark, sf):
    path = writers.write_table(predictions(spark, sf).select("doc_id", "label"), scratch_path(spark, "table"))
    return spark.read.option("header", True).csv(path)


@query("b2_write_metrics", f"WITH {METRICS} SELECT model, metric, round(value, 4) AS value FROM long")
def b2_write_metrics(spark, sf):
    path = writers.write_metrics(metric_table(spark, sf), scratch_path(spark, "metrics"))
    df = spark.read.schema("position int, model string, metric string, value double").json(path)
    return rounded(df.select("model", "metric", "value"), 4, "value")


@query(
    "b4_write_summary",
    f"""WITH {LISTINGS}, long AS (UNPIVOT (SELECT {", ".join(NUMERIC)} FROM listings)
      ON {", ".join(NUMERIC)} INTO NAME "column" VALUE v)
    SELECT "column", count(v) AS count, round(avg(v), 4) AS mean, min(v) AS min, max(v) AS max FROM long GROUP BY 1""",
)
def b4_write_summary(spark, sf):
    summary = stats.describe(listings(spark, sf), NUMERIC)
    path = writers.write_table(summary, scratch_path(spark, "summary"))
    df = spark.read.schema(summary.schema).option("header", True).csv(path)
    return rounded(df.select("column", "count", "mean", "min", "max"), 4, "mean")


@query(
    "c18_feature_columns",
    """SELECT p_partkey, list_sort(['p_partkey', 'p_size', 'p_retailprice']) AS names,
      round(p_partkey + p_size + p_retailprice, 4) AS total FROM part""",
)
def c18_feature_columns(spark, sf):
    """The columns that are left as features once the targets are out, and their sum in every row."""
    df = read_table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice").withColumns(
        {"quality": F.col("p_size") % 10, "quality_binary": fx.threshold_label("p_size", 7)}
    )
    names = readers.feature_columns(df, ["quality", "quality_binary"])
    total = sum((F.col(n).cast("double") for n in names), F.lit(0.0))
    listed = F.sort_array(F.array(*[F.lit(n) for n in names]))
    return rounded(df.select("p_partkey", listed.alias("names"), total.alias("total")), 4, "total")
