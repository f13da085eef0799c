"""Exact evaluation of classifiers, rankers, regressors and fixed alert budgets.

Ranking measures first count the rows per (method, score): a score shared by a
third of all rows is one row from then on. The running counts come from
range-partitioned totals, so no task sees a whole ranking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.operators.joins import small_or_shuffled
from lumenframe.operators.ordered import with_running

BUDGETS = (0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1)


def safe_ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts of (actual, predicted); pairs that never occur are absent."""
    return df.groupBy(*by, actual, predicted).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, classes: Sequence) -> DataFrame:
    """One row per actual class, one column per predicted class, zeros included."""
    counted = df.groupBy(actual).agg(
        *[F.count_if(F.col(predicted) == c).alias(f"predicted_{c}") for c in classes]
    )
    kind = df.schema[actual].dataType
    listed = df.sparkSession.createDataFrame([(c,) for c in classes], f"_class {kind.simpleString()}")
    both = listed.join(counted, F.col("_class").eqNullSafe(F.col(actual)), "full")
    counts = [F.coalesce(f"predicted_{c}", F.lit(0).cast("long")).alias(f"predicted_{c}") for c in classes]
    return both.select(F.coalesce(actual, "_class").alias(actual), *counts)


def binary_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; a zero denominator gives 0."""
    hit = (F.col(actual) == 1) & (F.col(predicted) == 1)
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(actual) == F.col(predicted)).alias("correct"),
        F.count_if(hit).alias("tp"),
        F.count_if(F.col(predicted) == 1).alias("flagged"),
        F.count_if(F.col(actual) == 1).alias("positives"),
    )
    return counts.select(
        *by,
        safe_ratio(F.col("correct"), F.col("n")).alias("accuracy"),
        safe_ratio(F.col("tp"), F.col("flagged")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("positives")).alias("recall"),
        safe_ratio(2 * F.col("tp"), F.col("flagged") + F.col("positives")).alias("f1"),
    )


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts only."""
    cells = confusion(df, actual, predicted)
    side = F.explode(
        F.array(
            F.struct(F.col(actual).alias("class"), F.col("count").alias("a"), F.lit(0).cast("long").alias("p")),
            F.struct(F.col(predicted).alias("class"), F.lit(0).cast("long").alias("a"), F.col("count").alias("p")),
        )
    )
    both = cells.withColumn("tp", F.when(F.col(actual) == F.col(predicted), F.col("count")).otherwise(0))
    margins = both.select("tp", side.alias("s")).groupBy("s.class").agg(
        F.sum("s.a").alias("support"),
        F.sum("s.p").alias("flagged"),
        (F.sum("tp") / 2).alias("tp"),
    )
    return margins.select(
        "class",
        safe_ratio(F.col("tp"), F.col("flagged")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("support")).alias("recall"),
        safe_ratio(2 * F.col("tp"), F.col("flagged") + F.col("support")).alias("f1"),
        "support",
    )


def averaged_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Macro and support-weighted averages of the class report, with accuracy; one row."""
    report = class_report(df, actual, predicted)

    def weighted(c: str) -> Column:
        return safe_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))

    return report.agg(
        weighted("recall").alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
    )


def score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Running counts from the highest score down, one row per distinct score.

    Adds ``tp``/``fp`` (positives and negatives with at least this score) and
    the totals ``tp_total``/``fp_total``.
    """
    counted = (
        df.filter(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
        .withColumn("_down", -F.col("score"))
    )
    return with_running(counted, ["_down"], {"tp": "pos", "fp": "neg"}, by=by, totals=True).drop("_down")


def roc_auc(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; a tie between a positive and a negative counts one half."""
    above = F.col("tp") - F.col("pos")
    area = F.sum(F.col("neg") * (above + F.col("pos") / 2))
    return counts.groupBy(*by).agg(
        F.try_divide(area, (F.max("tp_total") * F.max("fp_total")).cast("double")).alias("roc_auc")
    )


def roc_points(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return counts.select(
        *by,
        F.col("score").alias("threshold"),
        safe_ratio(F.col("fp"), F.col("fp_total")).alias("fpr"),
        safe_ratio(F.col("tp"), F.col("tp_total")).alias("tpr"),
    )


def precision_recall_points(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return counts.select(
        *by,
        F.col("score").alias("threshold"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("tp_total")).alias("recall"),
    )


def average_precision(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum over distinct scores of (recall step) x precision."""
    step = safe_ratio(F.col("pos"), F.col("tp_total"))
    precision = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    return counts.groupBy(*by).agg(F.sum(step * precision).alias("average_precision"))


def precision_at_k(
    df: DataFrame, label: str, score: str, id_column: str, by: Sequence[str] = (), counts: DataFrame | None = None
) -> DataFrame:
    """Precision and recall among the k best scores, k = max(1, positives); ties go to the lower id.

    Only rows tied at the k-th score need an order by id; all higher scores count whole. ``counts`` takes
    the :func:`score_counts` of the same rows, if they are there already.
    """
    by = list(by)
    counts = score_counts(df, label, score, by) if counts is None else counts
    k = F.greatest(F.col("tp_total"), F.lit(1))
    upto = F.col("tp") + F.col("fp")
    reach = counts.withColumns({"k": k, "upto": upto, "size": F.col("pos") + F.col("neg")})
    edge = reach.filter((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("size") < F.col("k"))).select(
        *by,
        F.col("score").alias("edge"),
        "k",
        F.col("tp_total").alias("positives"),
        (F.col("tp") - F.col("pos")).alias("sure"),
        (F.col("k") - (F.col("upto") - F.col("size"))).alias("room"),
    )
    if by:
        tied = df.join(small_or_shuffled(edge), by).filter(F.col(score) == F.col("edge"))
    else:
        at = edge.agg(F.first(F.struct(*edge.columns))).scalar()
        tied = df.withColumn("_e", at).filter(F.col(score) == F.col("_e.edge")).select("*", "_e.*").drop("_e")
    from lumenframe.operators.ordered import with_position

    placed = with_position(tied, [id_column], by, name="_at")
    hits = placed.groupBy(*by, "k", "positives", "sure").agg(
        F.count_if((F.col("_at") < F.col("room")) & (F.col(label) == 1)).alias("tied")
    )
    tp = F.col("sure") + F.col("tied")
    return hits.select(
        *by,
        F.col("positives"),
        "k",
        safe_ratio(tp, F.col("k")).alias("precision_at_k"),
        safe_ratio(tp, F.col("positives")).alias("recall_at_k"),
    )


def alert_budget(
    df: DataFrame, label: str, score: str, budgets: Sequence[float] = BUDGETS, by: Sequence[str] = ()
) -> DataFrame:
    """Operating point of each review budget, all budgets in one pass over the score counts.

    ``round(budget * n)`` alerts (half to even, at least 1, at most n) fix the
    threshold; every row with at least that score is flagged, ties included.
    """
    by = list(by)
    counts = score_counts(df, label, score, by)
    n = (F.col("tp_total") + F.col("fp_total")).cast("double")
    upto, size = F.col("tp") + F.col("fp"), F.col("pos") + F.col("neg")

    def reached(budget: Column) -> Column:
        wanted = F.greatest(F.lit(1.0), F.least(F.bround(budget * n), n))
        return (upto >= wanted) & (upto - size < wanted)

    # Budgets are chosen before the rows multiply: most scores are no threshold at all.
    mine = F.filter(F.array(*[F.lit(float(b)) for b in budgets]), reached)
    at_edge = counts.withColumn("budget", F.explode(mine))
    return at_edge.select(
        *by,
        "budget",
        F.col("score").alias("threshold"),
        upto.alias("n_alerts"),
        (upto / n).alias("review_rate"),
        F.col("tp").alias("n_caught"),
        F.col("tp_total").alias("n_positive"),
        safe_ratio(F.col("tp"), upto).alias("precision"),
        safe_ratio(F.col("tp"), F.col("tp_total")).alias("recall"),
    )


def alert_threshold(df: DataFrame, label: str, score: str, budget: float) -> DataFrame:
    """Operating point of one budget; an empty input is an error."""
    if df.select(score).limit(1).count() == 0:
        raise ValueError("no scored rows")
    return alert_budget(df, label, score, [budget])


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (), places: dict[str, int] | None = None
) -> DataFrame:
    """MAE, RMSE, R2 and MAPE (the denominator is shifted by 1e-6)."""
    a, p = F.col(actual), F.col(predicted)
    out = df.groupBy(*by).agg(
        F.avg(F.abs(a - p)).alias("mae"),
        F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
        (1 - F.try_divide(F.avg((a - p) * (a - p)), F.var_pop(a))).alias("r2"),
        (F.avg(F.abs((a - p) / (a + 1e-6))) * 100).alias("mape"),
    )
    return out.withColumns({c: F.bround(c, n) for c, n in (places or {}).items()})


def compare_models(metrics: DataFrame, order: str, ascending: bool = False) -> DataFrame:
    """Long ``(model, metric, value)`` to one row per model, best first."""
    wide = metrics.groupBy("model").pivot("metric").agg(F.first("value"))
    return wide.orderBy(F.asc(order) if ascending else F.desc(order), "model")


def best_model(metrics: DataFrame, metric: str, smallest: bool = False, position: str = "position") -> DataFrame:
    """The model with the best value of a metric; the first one wins a tie."""
    rows = metrics.filter(F.col("metric") == metric)
    return rows.orderBy(F.asc("value") if smallest else F.desc("value"), position).limit(1)


def ranking_report(df: DataFrame, label: str, score: str, id_column: str, by: Sequence[str]) -> DataFrame:
    """AUC, average precision and precision/recall at k of every method, from one long scores table."""
    by = list(by)
    counts = score_counts(df, label, score, by)
    area = roc_auc(counts, by)
    ap = average_precision(counts, by)
    at_k = precision_at_k(df, label, score, id_column, by, counts)
    return area.join(ap, by).join(at_k, by)


def top_and_bottom(df: DataFrame, column: str, n: int, tie: str) -> DataFrame:
    """The ``n`` largest and the ``n`` smallest rows; two top-k scans, no full sort."""
    top = df.orderBy(F.desc(column), tie).limit(n).withColumn("side", F.lit("top"))
    bottom = df.orderBy(F.asc(column), tie).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group; Spark limits every group per task before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
