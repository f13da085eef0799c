"""From raw documents to packed training sequences: five stages, each one of the text operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import decontaminate, near, packing, secrets, toxicity
from lumenframe.llm.common import documents, fresh, whole
from lumenframe.session import scratch_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the labels teach the models."""
    return toxicity.remove_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash and MinHash candidates, five-word shingles, similarity 0.8 or more."""
    return near.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in benchmark passages."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars`` follows the text. Other texts stay as they are."""
    columns, text = docs.columns, fresh("_text", docs.columns)
    found = secrets.find_secrets(docs, base_name="_base_spans", name="_secret_spans")
    base, spans = found.columns[-2:]
    masked = found.withColumn(text, secrets.redact(whole("text"), F.col(spans)))
    hit = F.size(spans) > 0
    new = {"text": F.when(hit, F.col(text)).otherwise(F.col("text"))}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(hit, F.length(text)).otherwise(F.col("n_chars")).cast(kind)
    return masked.withColumns(new).select(*columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all that is left, in windows of 1024."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash", without_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Learned models, 64-bit text hashes and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
