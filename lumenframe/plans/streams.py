"""Live scoring queries."""

from __future__ import annotations

from pyspark.ml import Pipeline

from lumenframe.operators import models as ml
from lumenframe.operators import texts
from lumenframe.plans.files import PREDICTIONS, predictions
from lumenframe.plans.registry import query
from lumenframe.plans.training import review_rows
from lumenframe.session import scratch_path
from lumenframe.sources.readers import read_table
from lumenframe.streaming import live_scoring as live


@query("z1_live_scoring")
def z1_live_scoring(spark, sf):
    """All documents arrive as files; the stream scores them with the model fitted on the labelled ones."""
    train, _ = review_rows(spark, sf)
    vectorizer = texts.fit_vectorizer(train)
    model = Pipeline(stages=[*vectorizer.stages, ml.logistic(train)]).fit(train)
    folder, output = scratch_path(spark, "incoming"), scratch_path(spark, "scored")
    read_table(spark, sf, "documents").select("doc_id", "text").write.json(folder)
    stream = live.start_scoring(model, live.incoming_texts(spark, folder), output, scratch_path(spark, "progress"))
    stream.awaitTermination()
    return spark.read.parquet(output)


@query(
    "z1_similar_examples",
    f"""WITH {PREDICTIONS}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY prediction ORDER BY doc_id) AS INTEGER) AS rank
      FROM p QUALIFY rank <= 3)
    SELECT prediction, rank, doc_id, text[:250] || '…' AS text, label, label = prediction AS correct FROM r""",
)
def z1_similar_examples(spark, sf):
    return live.similar_examples(predictions(spark, sf))
