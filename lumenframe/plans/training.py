"""Model queries: fit on a hash split, report measures on the rest."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lumenframe.functions import columns as fx
from lumenframe.functions import text as tx
from lumenframe.functions.stopwords import ENGLISH
from lumenframe.operators import boosting, gram
from lumenframe.operators import evaluate as ev
from lumenframe.operators import factorization as fac
from lumenframe.operators import features, sampling, texts, topics
from lumenframe.operators import models as ml
from lumenframe.operators import recommend as rec
from lumenframe.operators import timeseries as ts
from lumenframe.plans.ratings import split as rating_split
from lumenframe.plans.registry import query
from lumenframe.plans.sales import rounded
from lumenframe.plans.series import CUTOFF, ORDER
from lumenframe.plans.texts import counts as text_counts
from lumenframe.plans.texts import documents
from lumenframe.plans.vectors import as_features
from lumenframe.plans.views import LISTINGS, listings, reviews, series, vectors
from lumenframe.session import checkpoint, scratch_path
from lumenframe.sources.readers import read_table
from lumenframe.sources.writers import load_model, save_model

INPUTS = ["quantity", "discount", "tax", "size", "list_price"]


def price_rows(spark, sf):
    """Standardized listing features, label log price, split by a hash of the id."""
    df = sampling.hash_split(listings(spark, sf), "id").withColumnRenamed("log_price", "label")
    df = features.standardize(df, INPUTS, train=df.filter("split = 'train'"))
    return ml.assembled(df.select("id", "label", "split", *INPUTS), INPUTS)


def parts(df):
    df = checkpoint(df)
    return df.filter("split = 'train'"), df.filter("split = 'test'")


SUMS = f"""{LISTINGS}, s AS (SELECT count(*) AS n, avg(quantity) AS mx, avg(price) AS my,
  var_pop(quantity) * count(*) AS sxx, covar_pop(quantity, price) * count(*) AS sxy FROM listings)"""


def simple_fit(spark, sf, build):
    df = ml.assembled(listings(spark, sf).select("quantity", F.col("price").alias("label")), ["quantity"]).persist()
    model = build(df).fit(df)
    df.unpersist()
    row = [(float(model.coefficients[0]), float(model.intercept))]
    return rounded(spark.createDataFrame(row, "slope double, intercept double"), 2, "slope", "intercept")


@query(
    "m1_linear_coefficients",
    f"WITH {SUMS} SELECT round(sxy / sxx, 2) AS slope, round(my - sxy / sxx * mx, 2) AS intercept FROM s",
)
def m1_linear_coefficients(spark, sf):
    return simple_fit(spark, sf, lambda df: ml.linear())


@query(
    "m2_ridge_coefficients",
    f"""WITH {SUMS} SELECT round(sxy / (sxx + 1000000), 2) AS slope,
      round(my - sxy / (sxx + 1000000) * mx, 2) AS intercept FROM s""",
)
def m2_ridge_coefficients(spark, sf):
    return simple_fit(spark, sf, lambda df: ml.ridge(df, 1_000_000.0))


@query(
    "m3_lasso_coefficients",
    f"""WITH {SUMS}, b AS (SELECT *, sign(sxy) * greatest(abs(sxy / n) - 200, 0) / (sxx / n) AS slope FROM s)
    SELECT round(slope, 2) + 0 AS slope, round(my - slope * mx, 2) AS intercept FROM b""",
)
def m3_lasso_coefficients(spark, sf):
    return simple_fit(spark, sf, lambda df: ml.lasso(200.0))


REGRESSORS = {
    "m1_linear": lambda train: ml.linear(),
    "m2_ridge": lambda train: ml.ridge(train, 1.0),
    "m3_lasso": lambda train: ml.lasso(0.001),
    "m4_forest": lambda train: ml.forest_regressor(50, 12),
    "m5_boosted": lambda train: ml.boosted_regressor(100, 4),
}


def regressor_query(name, build):
    @query(name)
    def run(spark, sf):
        train, test = parts(price_rows(spark, sf))
        return ml.regression_report(name, build(train).fit(train), test)

    return run


for _name, _build in REGRESSORS.items():
    regressor_query(_name, _build)


LINEAR = {"m1_linear": gram.linear(), "m2_ridge": gram.ridge(1.0), "m3_lasso": gram.lasso(0.001)}
BOOSTED = boosting.Boosting(rounds=100, depth=4, rate=0.1, sample=0.8)


def fold_scores(train):
    """(model, mean, deviation of R2 over three folds) of every regressor: linear ones from one pass of sums, the
    boosted folds in the same jobs."""
    rows = gram.cross_validated(train, LINEAR).values.tolist()
    boosted = boosting.cross_validated(train, [BOOSTED]).first()
    forest = ml.cross_validate(REGRESSORS["m4_forest"](train), train, "id")
    return [*rows, ("m4_forest", *forest), ("m5_boosted", boosted["mean"], boosted["std"])]


@query("m15_cross_validation")
def m15_cross_validation(spark, sf):
    """Every regressor: R2 over three folds."""
    train, _ = parts(price_rows(spark, sf))
    return spark.createDataFrame(fold_scores(train), "model string, mean double, std double")


@query("m16_grid_search")
def m16_grid_search(spark, sf):
    """The grids of the boosted trees and of ridge, on an exact half of the training rows."""
    train, _ = parts(price_rows(spark, sf))
    half = checkpoint(sampling.random_split(train.drop("split"), "id", 0.5, seed=7).where("split = 'test'"))
    grid = [boosting.Boosting(n, d, r) for n in (100, 200) for d in (3, 5) for r in (0.05, 0.1)]
    scores = boosting.cross_validated(half, grid).collect()
    named = [(grid[r["place"]], r["mean"], r["std"]) for r in scores]
    rows = [("boosted", f"rounds={s.rounds}, depth={s.depth}, rate={s.rate}", mean, std) for s, mean, std in named]
    ridges = gram.cross_validated(half, {f"alpha={a}": gram.ridge(a) for a in (0.01, 0.1, 1.0, 10.0)})
    rows += [("ridge", *r) for r in ridges.values.tolist()]
    return spark.createDataFrame(rows, "model string, setting string, score double, std double")


@query("m17_learning_curve")
def m17_learning_curve(spark, sf):
    """Six training shares x three folds: the boosted fits grow together, the linear ones come from one pass."""
    train, _ = parts(price_rows(spark, sf))
    curve = boosting.learning_curve(train, BOOSTED).select(F.lit("boosted").alias("model"), "*")
    line = spark.createDataFrame(gram.learning_curve(train, gram.linear()))
    return curve.unionByName(line.select(F.lit("linear").alias("model"), "*"))


@query("m18_importance")
def m18_importance(spark, sf):
    """Tree impurity, absolute coefficient and permutation importance side by side."""
    train, test = parts(price_rows(spark, sf))
    fitted = ml.fit_all({"tree": ml.forest_regressor(50, 12), "linear": ml.linear()}, train)
    tables = [ml.importances(m, INPUTS).withColumn("method", F.lit(n)) for n, m in fitted.items()]
    shuffled = ml.permutation_importance(fitted["tree"], test.drop("features"), INPUTS, "id")
    return ml.union_all([*tables, shuffled.withColumn("method", F.lit("permutation"))])


@query("m20_regressor_comparison")
def m20_regressor_comparison(spark, sf):
    """All regressors on the same rows: test measures and R2 over three folds, best first; ``best`` has the highest over the folds."""
    train, test = parts(price_rows(spark, sf))
    fitted = ml.fit_all({n: b(train) for n, b in REGRESSORS.items()}, train)
    reports = ml.union_all([ml.regression_report(n, m, test) for n, m in fitted.items()])
    scores = fold_scores(train)
    best = max(scores, key=lambda s: s[1])[0]
    folds = spark.createDataFrame([(*s, s[0] == best) for s in scores], "model string, cv_mean double, cv_std double, best boolean")
    return reports.join(folds, "model").orderBy(F.desc("r2"), "model")


#: The compared settings are 300 rounds and a forest of 200 trees to depth 15.
FORECAST_ROUNDS = 30


@query("m20_forecast_comparison")
def m20_forecast_comparison(spark, sf):
    """Next value of every series: gaps filled, history and calendar features, split by time, four models."""
    df = ts.interpolate(series(spark, sf), "value", ORDER, ["series"])
    df = ts.fill_leading(df, "filled", ["series"]).drop("value")
    df = ts.history_features(df, "filled", ORDER, ["series"])
    df = df.withColumns(fx.calendar_features("ts")).dropna()
    inputs = [c for c in df.columns if c not in ("series", "ts", "event_id", "filled")]
    df = checkpoint(df)
    train, test = ts.temporal_split(df, "ts", CUTOFF)
    scaled = [features.standardize(d, inputs, train=train) for d in (train, test)]
    train, test = (checkpoint(ml.assembled(d, inputs).select("event_id", F.col("filled").alias("label"), "features")) for d in scaled)
    boosted = ml.boosted_regressor(FORECAST_ROUNDS, 8, 0.08, 0.8, 0.8, penalty=1.0, id_column="event_id")
    fitted = ml.fit_all(
        {"linear": ml.linear(), "ridge": ml.ridge(train, 10.0), "forest": ml.forest_regressor(50, 12, id_column="event_id"), "boosted": boosted},
        train,
    )
    return ml.union_all([ml.regression_report(n, m, test) for n, m in fitted.items()])


# --- classifiers ------------------------------------------------------------------------


def vector_rows(spark, sf, label):
    df = as_features(vectors(spark, sf)).select("id", F.col(label).cast("double").alias("label"), "features")
    return parts(sampling.hash_split(df, "id"))


@query("m6_logistic")
def m6_logistic(spark, sf):
    train, test = vector_rows(spark, sf, "y")
    return ml.classifier_report("logistic", ml.scored(ml.logistic(train).fit(train), test))


@query("m7_weighted_logistic")
def m7_weighted_logistic(spark, sf):
    train, test = vector_rows(spark, sf, "y")
    train = ml.balanced_weights(train)
    return ml.classifier_report("weighted", ml.scored(ml.logistic(train, weight="weight").fit(train), test))


@query(
    "m7_class_weights",
    """WITH e AS (SELECT vec_id AS id, CAST(label >= 7 AS INTEGER) AS y FROM embeddings),
    c AS (SELECT y, count(*) AS n FROM e GROUP BY y)
    SELECT id, e.y, round((SELECT count(*) FROM e) / (2 * n), 8) AS weight FROM e JOIN c ON e.y = c.y""",
)
def m7_class_weights(spark, sf):
    df = ml.balanced_weights(vectors(spark, sf).select("id", "y"), "y")
    return rounded(df, 8, "weight")


@query("m8_multinomial")
def m8_multinomial(spark, sf):
    train, test = vector_rows(spark, sf, "label")
    return ml.multiclass_report("multinomial", ml.logistic(train, iterations=500).fit(train).transform(test))


@query("m9_forest_classifier")
def m9_forest_classifier(spark, sf):
    train, test = vector_rows(spark, sf, "label")
    return ml.multiclass_report("forest", ml.forest_classifier(100, 15, 5).fit(train).transform(test))


@query("m10_boosted_classifier")
def m10_boosted_classifier(spark, sf):
    train, test = vector_rows(spark, sf, "y")
    return ml.classifier_report("boosted", ml.scored(ml.boosted_classifier(100, 4).fit(train), test))


@query("m10_boosted_multiclass")
def m10_boosted_multiclass(spark, sf):
    train, test = vector_rows(spark, sf, "label")
    return ml.multiclass_report("boosted", ml.boosted_classifier(100, 4, classes=10).fit(train).transform(test))


@query("m12_kernel_svm")
def m12_kernel_svm(spark, sf):
    train, test = vector_rows(spark, sf, "y")
    return ml.classifier_report("kernel_svm", ml.kernel_svm_predict(ml.fit_kernel_svm(train), test))


@query("m13_perceptron")
def m13_perceptron(spark, sf):
    """Projection to 30 components, then a 128-64 network; loss per iteration in the second part."""
    train, test = vector_rows(spark, sf, "label")
    pca = features.fit_pca(train, "features", 30)
    train, test = (
        pca.transform(d).select("id", "label", F.col("components").alias("features")) for d in (train, test)
    )
    model = ml.perceptron(30, 10, iterations=80).fit(train)
    report = ml.multiclass_report("perceptron", model.transform(test))
    return report.withColumn("iterations", F.lit(ml.loss_curve(model).count()))


@query("m14_predict_batch")
def m14_predict_batch(spark, sf):
    train, test = vector_rows(spark, sf, "y")
    rows = ml.scored(ml.logistic(train).fit(train), test)
    return rows.select("id", "label", "prediction", F.round("positive", 6).alias("probability"))


@query("m20_classifier_comparison")
def m20_classifier_comparison(spark, sf):
    train, test = vector_rows(spark, sf, "y")
    fitted = ml.fit_all(
        {"logistic": ml.logistic(train), "forest": ml.forest_classifier(), "boosted": ml.boosted_classifier(100, 4)},
        train,
    )
    reports = [ml.classifier_report(n, ml.scored(m, test)) for n, m in fitted.items()]
    reports.append(ml.classifier_report("kernel_svm", ml.kernel_svm_predict(ml.fit_kernel_svm(train), test)))
    return ml.union_all(reports).orderBy(F.desc("f1"), "model")


# --- text models ------------------------------------------------------------------------


def review_rows(spark, sf):
    df = texts.prepared(reviews(spark, sf))
    return parts(sampling.hash_split(df, "doc_id"))


@query("m20_sentiment_comparison")
def m20_sentiment_comparison(spark, sf):
    train, test = review_rows(spark, sf)
    vectorizer = texts.fit_vectorizer(train)
    train, test = (vectorizer.transform(d).select("doc_id", "label", "features") for d in (train, test))
    fitted = ml.fit_all(
        {"logistic": ml.logistic(train), "naive_bayes": ml.naive_bayes(), "forest": ml.sparse_forest_classifier(20, 8)}, train
    )
    return ml.union_all([ml.classifier_report(n, ml.scored(m, test)) for n, m in fitted.items()])


@query("m19_predictive_terms")
def m19_predictive_terms(spark, sf):
    train, _ = review_rows(spark, sf)
    vectorizer = texts.fit_vectorizer(train)
    model = ml.logistic(train).fit(vectorizer.transform(train))
    return ml.predictive_terms(model.coefficients.toArray(), vectorizer.stages[0].vocabulary)


@query("b3_save_and_load_model")
def b3_save_and_load_model(spark, sf):
    """Scores from the reloaded text model; they equal the scores of the fitted one."""
    from pyspark.ml import Pipeline

    train, test = review_rows(spark, sf)
    vectorizer = texts.fit_vectorizer(train)
    model = Pipeline(stages=[*vectorizer.stages, ml.logistic(train)]).fit(train)
    again = load_model(spark, save_model(model, scratch_path(spark, "model")))
    first = ml.scored(model, test).select("doc_id", F.col("positive").alias("fitted"))
    second = ml.scored(again, test).select("doc_id", "prediction", F.col("positive").alias("reloaded"))
    return first.join(second, "doc_id").withColumn("equal", F.col("fitted") == F.col("reloaded"))


def topic_inputs(spark, sf, words=1500):
    df = text_counts(spark, sf).select("doc_id", "term", "tf")
    docs = read_table(spark, sf, "documents")
    vocabulary = texts.vocabulary(df, docs, words, 2, 0.95)
    # The vocabulary is at most ``words`` rows; sorted terms get consecutive numbers.
    listed = checkpoint(vocabulary).toPandas().sort_values("term").reset_index(drop=True)
    listed["index"] = np.arange(len(listed), dtype="int32")
    table = spark.createDataFrame(listed[["term", "df", "index"]])
    return df, docs, table, listed


def factor_inputs(spark, sf):
    """Term counts, the listed vocabulary, and a row of weights for every document."""
    df, docs, table, listed = topic_inputs(spark, sf)
    return df, listed, fac.document_rows(texts.tfidf(df, table, docs, sublinear=True), table, docs)


@query("t1_nmf")
def t1_nmf(spark, sf):
    _, listed, rows = factor_inputs(spark, sf)
    h, losses = fac.fit_nmf(rows, len(listed), 6, iterations=8)
    top = topics.top_words(fac.topic_table(spark, h, listed), 15)
    return top.withColumn("loss", F.lit(losses[-1]))


@query("t3_lsa")
def t3_lsa(spark, sf):
    _, listed, rows = factor_inputs(spark, sf)
    components, _ = fac.fit_lsa(rows, len(listed), 6, iterations=20)
    return fac.lsa_documents(rows, components).select(
        "doc_id", F.posexplode("topics").alias("topic", "weight")
    )


@query("t2_lda")
def t2_lda(spark, sf):
    docs = documents(spark, sf).select("doc_id", tx.word_tokens("text", ENGLISH).alias("terms"))
    vectorizer = texts.counting_vectorizer(docs, "terms", "counts", 1500, 2.0, 0.95).fit(docs)
    rows = checkpoint(vectorizer.transform(docs).select("doc_id", "counts"))
    model = fac.fit_lda(rows, 6)
    shares = model.transform(rows).select("doc_id", vector_to_array("topicDistribution").alias("distribution"))
    return topics.dominant_topic(shares, "distribution").select("doc_id", "topic", "confidence")


@query("t6_model_coherence")
def t6_model_coherence(spark, sf):
    """Mean coherence of the factorizations, words compared as strings."""
    df, listed, rows = factor_inputs(spark, sf)
    h, _ = fac.fit_nmf(rows, len(listed), 6, iterations=500)
    components, _ = fac.fit_lsa(rows, len(listed), 6, iterations=20)
    out = []
    for name, matrix in (("nmf", h), ("lsa", components)):
        scores = topics.coherence(fac.topic_table(spark, matrix, listed), df)
        out.append(scores.agg(F.lit(name).alias("model"), F.round(F.avg("coherence"), 4).alias("coherence")))
    return ml.union_all(out).orderBy(F.desc("coherence"), "model")


@query("v12_recommender_comparison")
def v12_recommender_comparison(spark, sf):
    """Bias, user and item neighbours and factors on the same test ratings; lowest RMSE first."""
    train, test = rating_split(spark, sf)
    model = rec.factor_fit(train, rank=8, iterations=5, reg=0.3)
    predictions = {
        "bias": rec.bias_predict(train, test),
        "user_neighbours": rec.neighbour_predict(train, test, "user_id"),
        "item_neighbours": rec.neighbour_predict(train, test, "item_id"),
        "factors": rec.factor_predict(model, train, test),
    }
    reports = [
        ev.regression_metrics(d, "rating", "predicted").select(F.lit(n).alias("model"), "rmse", "mae")
        for n, d in predictions.items()
    ]
    return ml.union_all(reports).orderBy("rmse", "model")
