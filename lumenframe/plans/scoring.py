"""Evaluation, splitting and ranking queries over scored rows and predicted classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import columns as fx
from lumenframe.operators import evaluate as ev
from lumenframe.operators import sampling, stats
from lumenframe.plans.listings import histogram_sql, shown
from lumenframe.plans.registry import query
from lumenframe.plans.sales import rounded
from lumenframe.plans.series import PREDICTED, predicted
from lumenframe.plans.views import LABELLED, SCORED, labelled, scored, split_key_sql

KEY = split_key_sql("id")
FLAGGED = SCORED + ", flagged AS (SELECT *, CAST(score >= 150 AS INTEGER) AS pred FROM scored)"


def flagged(spark, sf):
    return scored(spark, sf).withColumn("pred", fx.threshold_label("score", 150))


@query("v1_confusion", f"WITH {LABELLED} SELECT actual, predicted, count(*) AS count FROM labelled GROUP BY ALL")
def v1_confusion(spark, sf):
    return ev.confusion(labelled(spark, sf), "actual", "predicted")


@query(
    "v1_confusion_matrix",
    f"WITH {LABELLED} SELECT actual, "
    + ", ".join(f"count(*) FILTER (predicted = {c}) AS predicted_{c}" for c in range(10))
    + " FROM labelled GROUP BY actual",
)
def v1_confusion_matrix(spark, sf):
    return ev.confusion_matrix(labelled(spark, sf), "actual", "predicted", range(10))


BINARY_SQL = """count(*) AS n, count(*) FILTER (y = pred) AS correct, count(*) FILTER (y = 1 AND pred = 1) AS tp,
  count(*) FILTER (pred = 1) AS fl, count(*) FILTER (y = 1) AS pos"""
BINARY_OUT = """round(correct / n, 6) AS accuracy, round(coalesce(tp / nullif(fl, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(pos, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(fl + pos, 0), 0), 6) AS f1"""


@query("v2_binary_metrics", f"WITH {FLAGGED}, c AS (SELECT {BINARY_SQL} FROM flagged) SELECT {BINARY_OUT} FROM c")
def v2_binary_metrics(spark, sf):
    return rounded(ev.binary_metrics(flagged(spark, sf), "y", "pred"), 6, "accuracy", "precision", "recall", "f1")


REPORT = f"""{LABELLED}, k AS (SELECT DISTINCT actual AS class FROM labelled UNION SELECT predicted FROM labelled),
  c AS (SELECT class, count(*) FILTER (actual = class) AS support, count(*) FILTER (predicted = class) AS fl,
    count(*) FILTER (actual = class AND predicted = class) AS tp FROM k JOIN labelled
    ON actual = class OR predicted = class GROUP BY class),
  r AS (SELECT class, coalesce(tp / nullif(fl, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
    coalesce(2 * tp / nullif(fl + support, 0), 0) AS f1, support FROM c)"""


@query(
    "v3_class_report",
    f"""WITH {REPORT} SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(f1, 6) AS f1, support FROM r""",
)
def v3_class_report(spark, sf):
    return rounded(ev.class_report(labelled(spark, sf), "actual", "predicted"), 6, "precision", "recall", "f1")


@query(
    "v3_averaged_report",
    f"""WITH {REPORT} SELECT round(sum(recall * support) / sum(support), 6) AS accuracy, """
    + ", ".join(
        f"round(avg({m}), 6) AS macro_{m}, round(sum({m} * support) / sum(support), 6) AS weighted_{m}"
        for m in ("precision", "recall", "f1")
    )
    + " FROM r",
)
def v3_averaged_report(spark, sf):
    df = ev.averaged_report(labelled(spark, sf), "actual", "predicted")
    return rounded(df, 6, *df.columns)


AUC = """auc AS (SELECT method, (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2)
    / nullif(count(*) FILTER (y = 1) * count(*) FILTER (y = 0), 0) AS roc_auc FROM (
    SELECT method, y, rank() OVER w + (count(*) OVER (PARTITION BY method, score) - 1) / 2 AS r
    FROM scored WINDOW w AS (PARTITION BY method ORDER BY score)) GROUP BY method)"""
COUNTS = """per AS (SELECT method, score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg
    FROM scored GROUP BY ALL),
  counts AS (SELECT method, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
    sum(pos) OVER (PARTITION BY method) AS p, sum(neg) OVER (PARTITION BY method) AS n
    FROM per WINDOW w AS (PARTITION BY method ORDER BY score DESC))"""


def counts(spark, sf):
    return ev.score_counts(scored(spark, sf), "y", "score", ["method"])


@query("v4_roc_auc", f"WITH {SCORED}, {AUC} SELECT method, round(roc_auc, 8) AS roc_auc FROM auc")
def v4_roc_auc(spark, sf):
    return rounded(ev.roc_auc(counts(spark, sf), ["method"]), 8, "roc_auc")


@query(
    "v5_roc_points",
    f"""WITH {SCORED}, {COUNTS} SELECT method, score AS threshold, round(coalesce(fp / nullif(n, 0), 0), 8) AS fpr,
      round(coalesce(tp / nullif(p, 0), 0), 8) AS tpr FROM counts""",
)
def v5_roc_points(spark, sf):
    return rounded(ev.roc_points(counts(spark, sf), ["method"]), 8, "fpr", "tpr")


@query(
    "v6_average_precision",
    f"""WITH {SCORED}, {COUNTS} SELECT method, round(sum(coalesce(pos / nullif(p, 0), 0) * (tp / (tp + fp))), 8) AS average_precision
    FROM counts GROUP BY method""",
)
def v6_average_precision(spark, sf):
    return rounded(ev.average_precision(counts(spark, sf), ["method"]), 8, "average_precision")


@query(
    "v6_precision_recall_points",
    f"""WITH {SCORED}, {COUNTS} SELECT method, score AS threshold, round(tp / (tp + fp), 8) AS precision,
      round(coalesce(tp / nullif(p, 0), 0), 8) AS recall FROM counts""",
)
def v6_precision_recall_points(spark, sf):
    return rounded(ev.precision_recall_points(counts(spark, sf), ["method"]), 8, "precision", "recall")


AT_K = """ranked AS (SELECT method, y, row_number() OVER (PARTITION BY method ORDER BY score DESC, id) AS r,
    sum(y) OVER (PARTITION BY method) AS p FROM scored),
  at_k AS (SELECT method, CAST(max(p) AS BIGINT) AS positives, CAST(greatest(max(p), 1) AS BIGINT) AS k,
    sum(y) FILTER (r <= greatest(p, 1)) AS tp FROM ranked GROUP BY method)"""


@query(
    "v7_precision_at_k",
    f"""WITH {SCORED}, {AT_K} SELECT method, positives, k, round(tp / k, 8) AS precision_at_k,
      round(coalesce(tp / nullif(positives, 0), 0), 8) AS recall_at_k FROM at_k""",
)
def v7_precision_at_k(spark, sf):
    df = ev.precision_at_k(scored(spark, sf), "y", "score", "id", ["method"])
    return rounded(df, 8, "precision_at_k", "recall_at_k")


def budget_sql(budgets, by: bool) -> str:
    key = "method, " if by else ""
    part = "PARTITION BY method" if by else ""
    on = "s.method = t.method AND " if by else ""
    group = "s.method, " if by else ""
    return f"""b AS (SELECT CAST(unnest([{', '.join(str(float(x)) for x in budgets)}]) AS DOUBLE) AS budget),
    r AS (SELECT *, row_number() OVER ({part} ORDER BY score DESC, id) AS rn, count(*) OVER ({part}) AS n FROM scored),
    t AS (SELECT {key}budget, score AS thr FROM r, b
      WHERE rn = greatest(1, least(round_even(budget * n, 0), n)))
    SELECT {group}budget, thr AS threshold, count(*) FILTER (score >= thr) AS n_alerts,
      round(count(*) FILTER (score >= thr) / count(*), 8) AS review_rate,
      count(*) FILTER (score >= thr AND y = 1) AS n_caught, count(*) FILTER (y = 1) AS n_positive,
      round(count(*) FILTER (score >= thr AND y = 1) / count(*) FILTER (score >= thr), 8) AS precision,
      round(coalesce(count(*) FILTER (score >= thr AND y = 1) / nullif(count(*) FILTER (y = 1), 0), 0), 8) AS recall
    FROM scored s JOIN t ON {on} true GROUP BY {group}budget, thr"""


@query("v8_alert_threshold", f"WITH {SCORED}, {budget_sql([0.01], False)}")
def v8_alert_threshold(spark, sf):
    df = ev.alert_threshold(scored(spark, sf), "y", "score", 0.01)
    return rounded(df, 8, "review_rate", "precision", "recall")


@query("v9_budget_sweep", f"WITH {SCORED}, {budget_sql(ev.BUDGETS, False)}")
def v9_budget_sweep(spark, sf):
    return rounded(ev.alert_budget(scored(spark, sf), "y", "score"), 8, "review_rate", "precision", "recall")


@query("v13_budget_by_method", f"WITH {SCORED}, {budget_sql(ev.BUDGETS, True)}")
def v13_budget_by_method(spark, sf):
    df = ev.alert_budget(scored(spark, sf), "y", "score", by=["method"])
    return rounded(df, 8, "review_rate", "precision", "recall")


@query(
    "v13_ranking_report",
    f"""WITH {SCORED}, {AUC}, {COUNTS}, {AT_K},
    ap AS (SELECT method, sum(coalesce(pos / nullif(p, 0), 0) * (tp / (tp + fp))) AS ap FROM counts GROUP BY method)
    SELECT method, round(roc_auc, 8) AS roc_auc, round(ap, 8) AS average_precision, positives, k,
      round(tp / k, 8) AS precision_at_k, round(coalesce(tp / nullif(positives, 0), 0), 8) AS recall_at_k
    FROM auc JOIN ap USING (method) JOIN at_k USING (method)""",
)
def v13_ranking_report(spark, sf):
    df = ev.ranking_report(scored(spark, sf), "y", "score", "id", ["method"])
    return rounded(df, 8, "roc_auc", "average_precision", "precision_at_k", "recall_at_k")


@query("k7_score_orientation", f"WITH {SCORED} SELECT id, -score AS anomaly_score FROM scored")
def k7_score_orientation(spark, sf):
    return scored(spark, sf).select("id", (-F.col("score")).alias("anomaly_score"))


@query("e13_class_rate", f"WITH {SCORED} SELECT method, round(avg(y), 8) AS rate FROM scored GROUP BY method")
def e13_class_rate(spark, sf):
    return scored(spark, sf).groupBy("method").agg(F.round(F.avg("y"), 8).alias("rate"))


# --- regression measures over the persistence forecast ---------------------------------

REG = """round(avg(abs(value - predicted)), 6) AS mae, round(sqrt(avg((value - predicted) ** 2)), 6) AS rmse,
  round(1 - avg((value - predicted) ** 2) / var_pop(value), 6) AS r2,
  round(avg(abs((value - predicted) / (value + 1e-6))) * 100, 4) AS mape"""


@query("v10_regression_metrics", f"WITH {PREDICTED} SELECT {REG} FROM e")
def v10_regression_metrics(spark, sf):
    df = ev.regression_metrics(predicted(spark, sf), "value", "predicted")
    return rounded(rounded(df, 6, "mae", "rmse", "r2"), 4, "mape")


@query(
    "v11_back_transform",
    f"""WITH {PREDICTED} SELECT round((exp(avg(abs(ln(1 + value) - ln(1 + predicted)))) - 1) * 100000, 3) AS mae_units,
      round(avg(abs(value - predicted)), 6) AS mae_true FROM e""",
)
def v11_back_transform(spark, sf):
    df = predicted(spark, sf)
    mae_log = F.avg(F.abs(F.log1p("value") - F.log1p("predicted")))
    return df.agg(
        F.round(fx.back_transformed(mae_log), 3).alias("mae_units"),
        F.round(F.avg(F.abs(F.col("value") - F.col("predicted"))), 6).alias("mae_true"),
    )


def metric_table(spark, sf):
    """Long metrics of two forecasts: the last value and the constant 50."""
    df = predicted(spark, sf)
    parts = [
        ev.regression_metrics(d, "value", "predicted").withColumns({"model": F.lit(n), "position": F.lit(i)})
        for i, (n, d) in enumerate((("last", df), ("constant", df.withColumn("predicted", F.lit(50.0)))))
    ]
    wide = parts[0].unionByName(parts[1])
    return wide.unpivot(["position", "model"], ["mae", "rmse", "r2", "mape"], "metric", "value")


METRICS = f"""{PREDICTED}, two AS (SELECT 0 AS position, 'last' AS model, value, predicted FROM e
    UNION ALL SELECT 1, 'constant', value, 50.0 FROM e),
  wide AS (SELECT position, model, {REG} FROM two GROUP BY ALL),
  long AS (UNPIVOT wide ON mae, rmse, r2, mape INTO NAME metric VALUE value)"""


@query("r5_union_metrics", f"WITH {METRICS} SELECT position, model, metric, round(value, 4) AS value FROM long")
def r5_union_metrics(spark, sf):
    return rounded(metric_table(spark, sf), 4, "value")


@query(
    "v12_model_comparison",
    f"""WITH {METRICS} SELECT model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 4) AS r2,
      round(mape, 4) AS mape FROM wide""",
)
def v12_model_comparison(spark, sf):
    return rounded(ev.compare_models(metric_table(spark, sf), "r2"), 4, "mae", "rmse", "r2", "mape")


@query(
    "r3_transpose_metrics",
    f"""WITH {METRICS} SELECT metric, round(max(value) FILTER (model = 'last'), 4) AS last,
      round(max(value) FILTER (model = 'constant'), 4) AS constant FROM long GROUP BY metric""",
)
def r3_transpose_metrics(spark, sf):
    wide = metric_table(spark, sf).groupBy("metric").pivot("model", ["last", "constant"]).agg(F.first("value"))
    return rounded(wide, 4, "last", "constant")


@query(
    "s4_best_model",
    f"""WITH {METRICS} SELECT model, metric, round(value, 4) AS value FROM long WHERE metric = 'rmse'
    ORDER BY long.value, position LIMIT 1""",
)
def s4_best_model(spark, sf):
    best = ev.best_model(metric_table(spark, sf), "rmse", smallest=True)
    return rounded(best.select("model", "metric", "value"), 4, "value")


# --- splits and samples ----------------------------------------------------------------


@query(
    "p1_random_split",
    f"""WITH {SCORED} SELECT id, CASE WHEN row_number() OVER (ORDER BY {KEY}, id) <= floor(count(*) OVER () * 0.2)
      THEN 'test' ELSE 'train' END AS split FROM scored""",
)
def p1_random_split(spark, sf):
    return sampling.random_split(scored(spark, sf), "id").select("id", "split")


@query(
    "p1_hash_split",
    f"WITH {SCORED} SELECT id, CASE WHEN {KEY} < 858993459 THEN 'test' ELSE 'train' END AS split FROM scored",
)
def p1_hash_split(spark, sf):
    return sampling.hash_split(scored(spark, sf), "id").select("id", "split")


@query(
    "p2_stratified_split",
    f"""WITH {SCORED} SELECT id, y, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY {KEY}, id)
      <= round(count(*) OVER (PARTITION BY y) * 0.2) THEN 'test' ELSE 'train' END AS split FROM scored""",
)
def p2_stratified_split(spark, sf):
    return sampling.random_split(scored(spark, sf), "id", by=["y"]).select("id", "y", "split")


@query(
    "p3_cap_per_class",
    f"""WITH {SCORED} SELECT id, method FROM scored
    QUALIFY row_number() OVER (PARTITION BY method ORDER BY {KEY}, id) <= 200""",
)
def p3_cap_per_class(spark, sf):
    return sampling.cap_per_class(scored(spark, sf), "method", "id", 200).select("id", "method")


@query("p4_fixed_sample", f"WITH {SCORED} SELECT id, score FROM scored ORDER BY {KEY}, id LIMIT 2000")
def p4_fixed_sample(spark, sf):
    return sampling.fixed_sample(scored(spark, sf), "id", 2000).select("id", "score")


@query(
    "p6_folds",
    f"WITH {SCORED} SELECT id, CAST(({KEY}) // 65536 % 3 AS INTEGER) AS fold FROM scored",
)
def p6_folds(spark, sf):
    return scored(spark, sf).select("id", sampling.fold_of("id", 3).alias("fold"))


@query(
    "j4_split_overlap",
    f"""WITH {SCORED}, s AS (SELECT id, {KEY} < 858993459 AS test FROM scored)
    SELECT count(*) AS overlap FROM (SELECT id FROM s WHERE test INTERSECT SELECT id FROM s WHERE NOT test)""",
)
def j4_split_overlap(spark, sf):
    from lumenframe.operators.joins import overlap_count

    split = sampling.hash_split(scored(spark, sf), "id")
    return overlap_count(split.filter("split = 'train'"), split.filter("split = 'test'"), ["id"])


@query(
    "r6_class_samples",
    f"""WITH {SCORED}, a AS (SELECT id, method FROM scored
    QUALIFY row_number() OVER (PARTITION BY method ORDER BY {KEY}, id) <= 50) SELECT id, method FROM a""",
)
def r6_class_samples(spark, sf):
    df = scored(spark, sf).select("id", "method")
    return sampling.cap_per_class(df, "method", "id", 50).orderBy("id")


# --- sorted heads ----------------------------------------------------------------------


@query("s1_sorted_head", f"WITH {SCORED} SELECT id, score FROM scored ORDER BY score DESC, id LIMIT 30")
def s1_sorted_head(spark, sf):
    return scored(spark, sf).select("id", "score").orderBy(F.desc("score"), "id").limit(30)


@query(
    "s2_top_per_group",
    f"""WITH {SCORED}, r AS (SELECT method, id, score,
      CAST(row_number() OVER (PARTITION BY method ORDER BY score DESC, id) AS INTEGER) AS rank FROM scored)
    SELECT * FROM r WHERE rank <= 15""",
)
def s2_top_per_group(spark, sf):
    df = scored(spark, sf).select("method", "id", "score")
    return ev.top_n_per_group(df, ["method"], [F.desc("score"), F.asc("id")], 15)


@query(
    "s3_top_and_bottom",
    f"""WITH {SCORED} (SELECT id, score, 'top' AS side FROM scored ORDER BY score DESC, id LIMIT 20)
    UNION ALL (SELECT id, score, 'bottom' FROM scored ORDER BY score, id LIMIT 20)""",
)
def s3_top_and_bottom(spark, sf):
    return ev.top_and_bottom(scored(spark, sf).select("id", "score"), "score", 20, "id")


@query("s6_first_per_class", f"WITH {SCORED} SELECT method, min(id) AS id, arg_min(score, id) AS score FROM scored GROUP BY method")
def s6_first_per_class(spark, sf):
    return scored(spark, sf).groupBy("method").agg(F.min("id").alias("id"), F.min_by("score", "id").alias("score"))


@query(
    "e17_density_by_label",
    f"WITH {SCORED}, {histogram_sql('scored', 'score', 60, 'y')}",
)
def e17_density_by_label(spark, sf):
    return shown(stats.histogram(scored(spark, sf), "score", 60, by="y"))


@query(
    "c14_confidence",
    f"""WITH {FLAGGED}, p AS (SELECT id, pred, round(score / 511, 2) AS probability FROM flagged)
    SELECT id, round(CASE WHEN pred = 1 THEN probability ELSE 1 - probability END, 6) AS confidence,
      printf('%.1f%%', 100 * CASE WHEN pred = 1 THEN probability ELSE 1 - probability END) AS shown FROM p""",
)
def c14_confidence(spark, sf):
    df = flagged(spark, sf).withColumn("probability", F.round(F.col("score") / 511, 2))
    sure = fx.confidence("probability", "pred")
    return df.select("id", F.round(sure, 6).alias("confidence"), fx.percent(sure).alias("shown"))


@query(
    "c11_clip",
    f"WITH {SCORED} SELECT id, least(greatest(score / 50, 1), 5) AS clipped FROM scored",
)
def c11_clip(spark, sf):
    return scored(spark, sf).select("id", fx.clip(F.col("score") / 50, 1, 5).alias("clipped"))
