"""Live scoring: a stream of texts goes through the same stages as the batch."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumenframe.operators.texts import prepared

SCHEMA = "doc_id long, text string"


def score_texts(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Cleaned text, class, both probabilities and the confidence; works on batches and streams."""
    scored = model.transform(prepared(df))
    both = vector_to_array("probability")
    return scored.select(
        "doc_id",
        "cleaned",
        F.col("prediction").cast("int").alias("prediction"),
        both[0].alias("negative"),
        both[1].alias("positive"),
        F.greatest(both[0], both[1]).alias("confidence"),
    )


def incoming_texts(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Stream of (doc_id, text) from JSON files that arrive in a folder."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def start_scoring(model: PipelineModel, texts: DataFrame, output: str, progress: str) -> StreamingQuery:
    """Scores everything available, then stops; a restart goes on after the last finished batch.

    ``progress`` keeps the offsets and has to lie in the shared folder. The
    Parquet sink commits each batch once.
    """
    return (
        score_texts(model, texts)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", progress)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def similar_examples(predictions: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` known texts (by id) of each predicted class, shortened."""
    first = Window.partitionBy("prediction").orderBy("doc_id")
    ranked = predictions.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= n)
    return ranked.select(
        "prediction",
        "rank",
        "doc_id",
        F.concat(F.substring("text", 1, 250), F.lit("…")).alias("text"),
        "label",
        (F.col("label") == F.col("prediction")).alias("correct"),
    )
