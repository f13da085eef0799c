"""Training, tuning and inspection of classifiers and regressors as Spark ML stages.

Penalties follow the common convention (sum of squared errors + alpha |w|^2,
C x summed log loss + |w|^2 / 2); the builders translate them to Spark's scaling,
which needs the number of training rows and, for ridge, the label deviation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.operators import evaluate as ev
from lumenframe.operators import sampling
from lumenframe.operators.boosting import BoostedTrees, Boosting
from lumenframe.operators.forest import Forest
from lumenframe.operators.ordered import with_position
from lumenframe.session import checkpoint

# --- estimators -------------------------------------------------------------------------


def linear(label: str = "label") -> LinearRegression:
    return LinearRegression(labelCol=label, solver="normal")


def ridge(train: DataFrame, alpha: float, label: str = "label") -> LinearRegression:
    """Spark divides the squared penalty by the label deviation, hence its factor here."""
    n, deviation = train.agg(F.count(F.lit(1)), F.stddev_samp(label)).first()
    return LinearRegression(
        labelCol=label,
        regParam=alpha * deviation / n,
        elasticNetParam=0.0,
        standardization=False,
        solver="l-bfgs",
        maxIter=200,
        tol=1e-9,
    )


def lasso(alpha: float, label: str = "label") -> LinearRegression:
    return LinearRegression(
        labelCol=label, regParam=alpha, elasticNetParam=1.0, standardization=False, maxIter=200, tol=1e-9
    )


def forest_regressor(
    trees: int = 50, depth: int = 12, label: str = "label", seed: int = 42, id_column: str = "id"
) -> Forest:
    return Forest(False, label, id_column=id_column, numTrees=trees, maxDepth=depth, seed=seed)


def boosted_regressor(
    rounds: int = 100,
    depth: int = 4,
    rate: float = 0.1,
    sample: float = 0.8,
    columns: float = 1.0,
    penalty: float | None = None,
    label: str = "label",
    id_column: str = "id",
    seed: int = 42,
) -> BoostedTrees:
    settings = Boosting(rounds, depth, rate, sample, columns, penalty=penalty, seed=seed)
    return BoostedTrees(settings, "squared", label, id_column=id_column)


def logistic(train: DataFrame, c: float = 1.0, label: str = "label", weight: str | None = None, iterations: int = 200):
    """Binary or multinomial logistic regression with inverse penalty ``c``."""
    n = train.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
    est = LogisticRegression(
        labelCol=label, regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=iterations
    )
    return est.setWeightCol(weight) if weight else est


def balanced_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Class weight n / (classes x class size), from one count per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    table = counts.agg(F.map_from_entries(F.collect_list(F.struct(label, "_n")))).scalar()
    with_table = df.withColumn("_t", table)
    total = F.aggregate(F.map_values("_t"), F.lit(0).cast("long"), lambda a, x: a + x)
    return with_table.withColumn(name, total / (F.size("_t") * F.element_at("_t", F.col(label)))).drop("_t")


def forest_classifier(
    trees: int = 100, depth: int = 15, min_rows: int = 1, label: str = "label", seed: int = 42, id_column: str = "id"
) -> Forest:
    return Forest(
        True, label, id_column=id_column, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_rows, seed=seed
    )


def sparse_forest_classifier(
    trees: int = 100, depth: int = 15, min_rows: int = 1, label: str = "label", seed: int = 42
) -> RandomForestClassifier:
    """Spark's own forest, which reads thousands of sparse columns without writing them out."""
    return RandomForestClassifier(
        labelCol=label, numTrees=trees, maxDepth=min(depth, 30), minInstancesPerNode=min_rows, seed=seed
    )


def boosted_classifier(
    rounds: int = 100,
    depth: int = 4,
    rate: float = 0.1,
    classes: int = 2,
    label: str = "label",
    id_column: str = "id",
    seed: int = 42,
) -> BoostedTrees:
    """Boosted trees; with more than two classes a tree per class and round, on softmax gradients."""
    loss = "logistic" if classes == 2 else "softmax"
    return BoostedTrees(Boosting(rounds, depth, rate, seed=seed), loss, label, id_column=id_column)


def naive_bayes(smoothing: float = 1.0, label: str = "label") -> NaiveBayes:
    return NaiveBayes(labelCol=label, modelType="multinomial", smoothing=smoothing)


def perceptron(
    inputs: int, classes: int, hidden: Sequence[int] = (128, 64), iterations: int = 80, label: str = "label"
) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(
        labelCol=label, layers=[inputs, *hidden, classes], maxIter=iterations, blockSize=128, seed=42
    )


def loss_curve(model) -> DataFrame:
    """Training loss per iteration of a fitted perceptron or logistic regression."""
    from pyspark.sql import SparkSession

    summary = model.summary() if callable(model.summary) else model.summary
    rows = [(i, float(v)) for i, v in enumerate(summary.objectiveHistory)]
    return SparkSession.getActiveSession().createDataFrame(rows, "iteration int, loss double")


# --- kernel approximation ---------------------------------------------------------------


def scale_gamma(df: DataFrame, column: str) -> float:
    """1 / (number of features x variance of all entries)."""
    flat = df.select(F.explode(vector_to_array(column)).alias("x"))
    width = df.select(F.size(vector_to_array(column))).first()[0]
    return 1.0 / (width * flat.agg(F.var_pop("x")).first()[0])


def fourier_features(x: np.ndarray, size: int, gamma: float, seed: int) -> np.ndarray:
    """Random Fourier features of the rows of ``x``; the projection follows from the seed."""
    rng = np.random.default_rng(seed)
    weights = rng.normal(0.0, np.sqrt(2 * gamma), (x.shape[1], size))
    shift = rng.uniform(0, 2 * np.pi, size)
    return np.sqrt(2.0 / size) * np.cos(x @ weights + shift)


def random_features(column: Column, inputs: int, size: int, gamma: float, seed: int = 42) -> Column:
    """Random Fourier features of the RBF kernel (Rahimi and Recht 2007), as an array.

    The projection is redrawn from the seed inside each task; nothing is shipped.
    """

    def project(rows: pd.Series) -> pd.Series:
        if len(rows) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(fourier_features(np.stack(rows.to_numpy()), size, gamma, seed)))

    return F.pandas_udf(project, "array<double>")(vector_to_array(column))


def with_random_features(
    df: DataFrame, column: str, gamma: float, size: int = 256, seed: int = 42, output: str = "kernel"
) -> DataFrame:
    inputs = df.select(F.size(vector_to_array(column))).first()[0]
    return df.withColumn(output, array_to_vector(random_features(F.col(column), inputs, size, gamma, seed)))


def fit_kernel_svm(
    train: DataFrame, features: str = "features", label: str = "label", c: float = 1.0, size: int = 256
) -> tuple[float, Model, Model]:
    """RBF support vector classifier on random features, with a logistic map from margin to probability."""
    gamma = scale_gamma(train, features)
    mapped = with_random_features(train, features, gamma, size).persist()
    n = mapped.count()
    svc = LinearSVC(
        featuresCol="kernel", labelCol=label, regParam=1.0 / (c * n), maxIter=100, standardization=False
    ).fit(mapped)
    margins = margin_rows(svc.transform(mapped))
    calibrated = LogisticRegression(
        featuresCol="margin",
        labelCol=label,
        predictionCol="calibrated",
        rawPredictionCol="calibrated_raw",
        probabilityCol="svm_probability",
    ).fit(margins)
    mapped.unpersist()
    return gamma, svc, calibrated


def margin_rows(scored: DataFrame) -> DataFrame:
    return scored.withColumn("margin", array_to_vector(F.array(vector_to_array("rawPrediction")[1])))


def kernel_svm_predict(fitted: tuple[float, Model, Model], df: DataFrame, features: str = "features", size: int = 256):
    """Class from the sign of the margin, probability from the calibration."""
    gamma, svc, calibrated = fitted
    margins = margin_rows(svc.transform(with_random_features(df, features, gamma, size)))
    return calibrated.transform(margins).withColumn("positive", vector_to_array("svm_probability")[1])


# --- use and inspection -----------------------------------------------------------------


def assembled(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def scored(model: Model, df: DataFrame) -> DataFrame:
    """Class and probability of class 1 next to the input rows."""
    return model.transform(df).withColumn("positive", vector_to_array("probability")[1])


def regression_report(name: str, model: Model, test: DataFrame, label: str = "label") -> DataFrame:
    return ev.regression_metrics(model.transform(test), label, "prediction").select(F.lit(name).alias("model"), "*")


def classifier_report(name: str, rows: DataFrame, label: str = "label", score: str = "positive") -> DataFrame:
    """Accuracy, precision, recall, F1 and exact AUC of scored rows, one row."""
    rates = ev.binary_metrics(rows, label, "prediction")
    area = ev.roc_auc(ev.score_counts(rows, label, score))
    return rates.withColumn("auc", area.scalar()).select(F.lit(name).alias("model"), "*")


def multiclass_report(name: str, rows: DataFrame, label: str = "label") -> DataFrame:
    return ev.averaged_report(rows, label, "prediction").select(F.lit(name).alias("model"), "*")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fit_all(estimators: Mapping[str, Estimator], train: DataFrame, parallelism: int = 4) -> dict[str, Model]:
    """Fits every estimator on the same rows, which stay in executor storage meanwhile.

    Up to ``parallelism`` fits submit their jobs at the same time. Rows that the caller has cached stay cached.
    """
    level = train.storageLevel
    cached = level.useMemory or level.useDisk
    if not cached:
        train = train.persist()
    try:
        with ThreadPool(max(1, min(parallelism, len(estimators)))) as pool:
            fit = inheritable_thread_target(train.sparkSession)(lambda e: e.fit(train))
            return dict(zip(estimators, pool.map(fit, list(estimators.values()))))
    finally:
        if not cached:
            train.unpersist()


def cross_validator(
    estimator: Estimator,
    grid: Sequence[Mapping[str, object]],
    folds: int = 3,
    label: str = "label",
    metric: str = "r2",
    parallelism: int = 4,
) -> CrossValidator:
    """Grid of ``{parameter name: value}`` settings, scored on the folds of column ``fold``."""
    settings = [{estimator.getParam(name): value for name, value in point.items()} for point in grid]
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=settings,
        evaluator=RegressionEvaluator(labelCol=label, metricName=metric),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )


def with_folds(df: DataFrame, id_column: str, folds: int = 3) -> DataFrame:
    return df.withColumn("fold", sampling.fold_of(id_column, folds))


def cross_validate(
    estimator: Estimator, df: DataFrame, id_column: str, folds: int = 3, label: str = "label", metric: str = "r2"
) -> tuple[float, float]:
    """Mean and population deviation of the score over the folds."""
    fitted = cross_validator(estimator, [{}], folds, label, metric).fit(with_folds(df, id_column, folds))
    # CrossValidatorModel.stdMetrics is already the population deviation over the folds.
    return float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0])


def grid_search(
    estimator: Estimator,
    grid: Sequence[Mapping[str, object]],
    df: DataFrame,
    id_column: str,
    folds: int = 3,
    label: str = "label",
) -> tuple[CrossValidatorModel, DataFrame]:
    """Tunes by cross-validation on all rows; the best setting is refitted on all of them.

    Returns the fitted search and one row per setting with its mean score.
    """
    fitted = cross_validator(estimator, grid, folds, label).fit(with_folds(df, id_column, folds))
    rows = [
        (", ".join(f"{k}={v}" for k, v in point.items()), float(score))
        for point, score in zip(grid, fitted.avgMetrics)
    ]
    return fitted, df.sparkSession.createDataFrame(rows, "setting string, score double")


def learning_curve(
    estimator: Estimator,
    df: DataFrame,
    id_column: str,
    shares: Sequence[float] = (0.1, 0.28, 0.46, 0.64, 0.82, 1.0),
    folds: int = 3,
    label: str = "label",
) -> DataFrame:
    """Training and validation R2 (mean, population deviation over folds) for growing training shares."""
    rows = with_folds(df, id_column, folds).withColumn("_u", sampling.split_key(id_column, seed=11) / 4294967296.0)
    rows = checkpoint(rows)
    parts = []
    for share in shares:
        for fold in range(folds):
            train = rows.filter((F.col("fold") != fold) & (F.col("_u") < share))
            model = estimator.fit(train)
            for kind, part in (("train", train), ("validation", rows.filter(F.col("fold") == fold))):
                r2 = ev.regression_metrics(model.transform(part), label, "prediction").select("r2")
                parts.append(r2.select(F.lit(float(share)).alias("share"), F.lit(kind).alias("kind"), "r2"))
    scores = union_all(parts)
    return scores.groupBy("share", "kind").agg(F.avg("r2").alias("mean"), F.stddev_pop("r2").alias("std"))


def importances(model: Model, columns: Sequence[str]) -> DataFrame:
    """Tree impurity shares, or absolute coefficients, largest first."""
    from pyspark.sql import SparkSession

    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix"):
        values = abs(model.coefficientMatrix.toArray()).mean(axis=0)
    else:
        values = abs(model.coefficients.toArray())
    rows = [(c, float(v)) for c, v in zip(columns, values)]
    table = SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def permutation_importance(
    model: Model, df: DataFrame, columns: Sequence[str], id_column: str, label: str = "label", seed: int = 42
) -> DataFrame:
    """Loss of R2 when one column is shuffled.

    Rows get a random order by hash; each row borrows the column from the row
    half the table further on. One join serves all columns.
    """
    placed = with_position(
        df.withColumn("_key", sampling.split_key(id_column, seed)), ["_key", id_column], name="_at", total="_n"
    )
    donors = placed.select(
        F.pmod(F.col("_at") + F.ceil(F.col("_n") / 2), F.col("_n")).alias("_at"),
        *[F.col(c).alias(f"_d_{c}") for c in columns],
    )
    rows = checkpoint(placed.join(donors, "_at"))
    base = ev.regression_metrics(model.transform(assembled(rows, columns)), label, "prediction").select("r2")
    parts = []
    for c in columns:
        swapped = rows.withColumn(c, F.col(f"_d_{c}"))
        r2 = ev.regression_metrics(model.transform(assembled(swapped, columns)), label, "prediction").select("r2")
        parts.append(r2.select(F.lit(c).alias("feature"), F.col("r2").alias("shuffled")))
    return union_all(parts).select("feature", (base.scalar() - F.col("shuffled")).alias("importance"))


def predictive_terms(coefficients: Sequence[float], terms: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` most positive and most negative terms of a linear text model (vocabulary-sized input)."""
    from pyspark.sql import SparkSession

    rows = [(t, float(c)) for t, c in zip(terms, coefficients)]
    table = SparkSession.getActiveSession().createDataFrame(rows, "term string, coefficient double")
    return ev.top_and_bottom(table, "coefficient", n, "term")
