"""Sinks: result tables, metrics and models."""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, header: bool = True) -> str:
    """Result table as CSV part files; embedded quotes are doubled."""
    df.write.mode("errorifexists").option("header", header).option("quote", '"').option("escape", '"').csv(path)
    return path


def write_metrics(metrics: DataFrame, path: str) -> str:
    """Long metrics table (``model, metric, value``) as JSON lines."""
    metrics.write.mode("errorifexists").json(path)
    return path


def save_model(model: PipelineModel, path: str) -> str:
    """Fitted pipeline, vocabulary and all stages included."""
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_messages(df: DataFrame, folder: str) -> str:
    """One file per row of (value, category) in ``folder/category=<category>/``, each with a line end; a new folder.

    Into a folder of the local (or mounted) file system tasks write the files themselves: without its native library
    Hadoop starts a process for each file there. A repeated task writes the same names anew. Other stores are left to Spark.
    """
    session = df.sparkSession
    path = session._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(session._jsc.hadoopConfiguration())
    if system.exists(path):
        raise FileExistsError(folder)
    at = urlsplit(system.makeQualified(path).toUri().toString())
    if at.scheme != "file":
        # Tasks move their files into the new folder themselves; by default the driver moves them one by one.
        committed = df.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
        committed.option("maxRecordsPerFile", 1).partitionBy("category").text(folder)
        return folder
    local = unquote(at.path)
    system.mkdirs(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get(), 0
        for batch in batches:
            for value, category in zip(batch.column("value").to_pylist(), batch.column("category").to_pylist(), strict=True):
                home = f"{local}/category={quote(category, safe='') if category else '__HIVE_DEFAULT_PARTITION__'}"
                name = f"part-{task.partitionId():05d}-{n:08d}.txt"
                draft = f"{home}/.{name}.{task.taskAttemptId()}"
                try:
                    out = open(draft, "xb")
                except FileNotFoundError:
                    os.makedirs(home, exist_ok=True)
                    out = open(draft, "xb")
                with out:
                    out.write((value or b"") + b"\n")
                os.replace(draft, f"{home}/{name}")
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    rows = df.select(F.col("value").cast("binary").alias("value"), F.col("category").cast("string").alias("category"))
    rows.mapInArrow(run, "n long").agg(F.sum("n")).collect()
    return folder
