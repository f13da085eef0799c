"""Readers: delimited files, text corpora, vector tables, scored predictions.

All take explicit schemas: no read infers types by scanning the data first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deals the rows of a small scan out to all cores, ahead of heavy work per row (text, models).

    For plain scans only: asking for the number of splits then runs nothing. A
    scan with at least as many splits as cores stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_measurements(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma-separated file with a header; ``NA`` and empty cells are NULL."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "NA").csv(path)


def read_quality(
    spark: SparkSession, path: str, schema: T.StructType | str, score: str = "quality", threshold: int = 7
) -> DataFrame:
    """Semicolon-separated file with a header, plus the 0/1 target ``<score>_binary``."""
    df = spark.read.schema(schema).option("header", True).option("sep", ";").csv(path)
    return df.withColumn(f"{score}_binary", (F.col(score) >= threshold).cast("int"))


RATINGS_SCHEMA = "user_id long, item_id long, rating double, timestamp long"


def read_ratings(spark: SparkSession, path: str, schema: str = RATINGS_SCHEMA) -> DataFrame:
    """Headerless tab-separated ratings: user, item, rating, timestamp."""
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def read_items(spark: SparkSession, path: str, flags: Sequence[str], skipped: int = 3) -> DataFrame:
    """Headerless ``|``-separated Latin-1 items: id, title, ``skipped`` ignored columns, 0/1 flags."""
    schema = "item_id long, title string"
    schema += "".join(f", _skip{i} string" for i in range(skipped))
    schema += "".join(f", `{f}` int" for f in flags)
    df = spark.read.schema(schema).option("sep", "|").option("encoding", "ISO-8859-1").csv(path)
    return df.select("item_id", "title", *flags)


def read_transactions(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Invoice lines from Parquet, or from CSV with a header."""
    if path.endswith(".parquet"):
        return spark.read.schema(schema).parquet(path)
    return spark.read.schema(schema).option("header", True).csv(path)


def read_labelled_texts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Labelled texts of several splits (``{"train": path, "test": path}``) as one table with ``split``."""
    parts = [spark.read.parquet(p).withColumn("split", F.lit(split)) for split, p in paths.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: Names of files that Spark's text reader unpacks.
COMPRESSED = r"\.(?:bz2|deflate|gz|lz4|snappy|zst)$"
#: Bytes of small files that a task reads.
TASK_BYTES = 128 << 20


def strip_message(text: str) -> F.Column:
    """Message body without header block, quoted lines and signature.

    A header (a text whose first line is a field) ends at the first blank line, folded lines included;
    quoted lines start with ``>`` or ``|`` or hold an attribution; the footer is the last block after a line of
    dashes. Nothing before that line is cut.
    """
    whole = F.col(text)
    blank = F.instr(whole, "\n\n")
    headed = whole.rlike(r"\A[A-Za-z-]+:[^\n]*\n") & (blank > 0)
    body = F.when(headed, F.substr(whole, blank + 2)).otherwise(whole)
    body = F.regexp_replace(body, r"(?m)^(?:>|\||In article|Quoted from)[^\n]*\n?", "")
    body = F.regexp_replace(body, r"(?m)^[^\n]*(?:(?:writes|wrote|says|said):|writes in)[^\n]*\n?", "")
    lines = F.split(F.regexp_replace(body, r"\s+\z", ""), "\n", -1)

    def above_dashes(lines: F.Column) -> F.Column:
        dashes = F.transform(lines, lambda line: line.rlike(r"^\s*--+\s*$"))
        behind = F.array_position(F.reverse(dashes), F.lit(True))  # lines from the last one of dashes on; 0 if none
        kept = F.transform(F.array(behind), lambda n: F.when(n > 0, F.slice(lines, F.lit(1), F.size(lines) - n.cast("int"))))
        return F.trim(F.array_join(F.coalesce(kept[0], lines), "\n"))

    return F.transform(F.array(lines), above_dashes)[0]  # as a variable of a lambda the lines are taken once


def read_corpus(
    spark: SparkSession, folder: str, categories: Sequence[str] | None = None, strip: bool = True
) -> DataFrame:
    """One file per message below ``folder/<category>/``, whole texts, with category filter.

    A task reads many files, as Spark counts each for 4 MB. Files are read as bytes, which costs less for each file
    than the text reader does; that one comes in where some are compressed.
    """
    category = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    wanted = F.lit(True) if categories is None else category.isin(*categories)
    packed = df.where(wanted & F.col("_metadata.file_name").rlike(COMPRESSED)).select("length").limit(1).count()
    if packed:
        df = spark.read.text(folder, wholetext=True, recursiveFileLookup=True).withColumnRenamed("value", "content")
    size = int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    df = df.where(wanted).select(
        category.alias("category"),
        F.col("_metadata.file_name").alias("name"),
        F.col("content").cast("string").alias("text"),
    )
    df = df.coalesce(tasks)
    return df.withColumn("text", strip_message("text")) if strip else df


def feature_columns(df: DataFrame, targets: Sequence[str]) -> list[str]:
    """All columns but the targets, so that no label leaks into the features."""
    return [c for c in df.columns if c not in set(targets)]


def read_wide(
    spark: SparkSession, path: str, label: str, ignore: Sequence[str] = (), vector: str = "features"
) -> DataFrame:
    """Wide numeric table as ``(ignored..., label, features)`` with one vector per row."""
    df = spark.read.parquet(path)
    names = feature_columns(df, [label, *ignore])
    return df.select(
        *ignore, label, array_to_vector(F.array(*[F.col(n).cast("double") for n in names])).alias(vector)
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Scored rows from a CSV with a header; blanks around column names are dropped."""
    df = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return df.toDF(*[c.strip() for c in df.columns])
