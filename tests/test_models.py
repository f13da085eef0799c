"""Models, features, clustering and anomaly detectors: closed forms and invariants."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lumenframe.operators import anomaly, cluster, features, sampling
from lumenframe.operators import evaluate as ev
from lumenframe.operators import models as ml
from lumenframe.sources.readers import feature_columns

COLUMNS = ["x0", "x1", "x2"]


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3)) * [1.0, 2.0, 0.5] + [0, 1, 2]
    y = x @ [1.5, -2.0, 0.7] + 3 + rng.normal(0, 0.3, 400)
    return x, y


@pytest.fixture(scope="module")
def rows(spark, numbers):
    x, y = numbers
    pdf = pd.DataFrame(x, columns=COLUMNS).assign(id=np.arange(len(y)), label=y, binary=(y > y.mean()).astype(float))
    return ml.assembled(spark.createDataFrame(pdf), COLUMNS).cache()


def closed_form(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


@pytest.mark.parametrize("alpha", [0.0, 1.0, 10.0, 500.0])
def test_linear_and_ridge_match_the_closed_form(rows, numbers, alpha):
    model = (ml.ridge(rows, alpha) if alpha else ml.linear()).fit(rows)
    w, b = closed_form(*numbers, alpha)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-4)
    assert model.intercept == pytest.approx(b, abs=1e-3)


def test_lasso_matches_coordinate_descent(rows, numbers):
    x, y = numbers
    alpha, w = 0.5, np.zeros(3)
    xc, yc = x - x.mean(0), y - y.mean()
    for _ in range(500):
        for j in range(3):
            rest = yc - xc @ w + xc[:, j] * w[j]
            r = xc[:, j] @ rest / len(y)
            w[j] = np.sign(r) * max(abs(r) - alpha, 0) / (xc[:, j] @ xc[:, j] / len(y))
    assert np.allclose(ml.lasso(alpha).fit(rows).coefficients.toArray(), w, atol=1e-3)


def test_logistic_gradient_is_zero_at_the_optimum(rows, numbers):
    data = rows.drop("label").withColumnRenamed("binary", "label")
    model = ml.logistic(data, c=1.0).fit(data)
    x, y = numbers
    label = (y > y.mean()).astype(float)
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert np.allclose(x.T @ (p - label) + w, 0, atol=0.05)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "label int")
    got = {r["label"]: r["weight"] for r in ml.balanced_weights(df).distinct().collect()}
    assert got == {0: pytest.approx(10 / 18), 1: 5.0}


def test_classifiers_report_measures_in_range(rows):
    data = rows.drop("label").withColumnRenamed("binary", "label")
    fitted = ml.fit_all(
        {"logistic": ml.logistic(data), "forest": ml.forest_classifier(5, 4), "boosted": ml.boosted_classifier(3, 3)},
        data,
    )
    reports = [ml.classifier_report(n, ml.scored(m, data)) for n, m in fitted.items()]
    reports.append(ml.classifier_report("svm", ml.kernel_svm_predict(ml.fit_kernel_svm(data, size=64), data, size=64)))
    table = ml.union_all(reports).toPandas()
    assert len(table) == 4
    measures = table[["accuracy", "precision", "recall", "f1", "auc"]].to_numpy()
    assert ((measures >= 0) & (measures <= 1)).all() and (table["accuracy"] > 0.8).all()


def test_cross_validation_and_learning_curve(rows):
    mean, std = ml.cross_validate(ml.linear(), rows, "id")
    assert 0.9 < mean < 1 and 0 <= std < 0.1
    curve = ml.learning_curve(ml.linear(), rows, "id", shares=(0.3, 1.0)).toPandas()
    assert len(curve) == 4 and (curve["mean"] > 0.8).all()


def test_grid_search_reports_every_setting(rows):
    _, table = ml.grid_search(ml.forest_regressor(), [{"maxDepth": 1}, {"maxDepth": 6}], rows, "id")
    got = table.orderBy("setting").toPandas()
    assert len(got) == 2 and got["score"].iloc[1] > got["score"].iloc[0]


def test_importances_rank_the_strong_column_first(rows):
    tree = ml.forest_regressor(5, 5).fit(rows)
    assert ml.importances(tree, COLUMNS).first()["feature"] == "x1"
    shuffled = ml.permutation_importance(tree, rows.drop("features"), COLUMNS, "id").toPandas()
    assert shuffled.sort_values("importance").iloc[-1]["feature"] == "x1"
    assert len(shuffled) == 3


def test_targets_are_not_features(rows):
    assert feature_columns(rows, ["label", "binary", "id", "features"]) == COLUMNS


def test_pca_matches_numpy(rows, numbers):
    x, _ = numbers
    model = features.fit_pca(rows, "features", 3)
    table = features.explained_variance(rows.sparkSession, model).toPandas()
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose(table["ratio"], values / values.sum()) and table["cumulative"].iloc[-1] == pytest.approx(1)
    first = np.array(model.transform(rows).orderBy("id").select(vector_to_array("components")[0]).collect()).ravel()
    _, vectors = np.linalg.eigh(np.cov(x.T))
    want = (x - x.mean(0)) @ vectors[:, -1]
    assert np.allclose(np.abs(first), np.abs(want), atol=1e-8)


def test_array_and_column_standardization_agree(spark, numbers):
    x, _ = numbers
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")
    got = np.stack(features.standardize_array(df, "x").orderBy("id").toPandas()["x"])
    assert np.allclose(got, (x - x.mean(0)) / x.std(0))


def test_kmeans_cost_falls_with_k(spark):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.2, (40, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    df = spark.createDataFrame(pd.DataFrame(points, columns=["a", "b"]))
    curve = cluster.elbow(df, ["a", "b"], (1, 2, 3), restarts=2).toPandas()
    assert curve["inertia"].is_monotonic_decreasing
    assert curve["inertia"].iloc[0] == pytest.approx(((points - points.mean(0)) ** 2).sum())
    assert curve["inertia"].iloc[2] < 20


def test_kmeans_steps_equal_plain_ones(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 1.0, (60, 2)) for c in ((0, 0), (4, 4), (0, 5), (6, -1))])
    df = spark.createDataFrame(pd.DataFrame({"id": range(240), "features": list(x)})).repartition(3)
    fits = cluster.fit_starts(df, [1, 4, 3], restarts=4)
    for k, fit in zip((1, 4, 3), fits):
        starts = []
        hashed = df.select("features").orderBy(F.xxhash64("features"), "features").toPandas()
        rows = np.stack(hashed["features"])
        for b in range(4 if k > 1 else 1):
            centers = cluster.first_centers(rows, k, np.random.default_rng([42, k, b]))
            for _ in range(50):
                owner = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
                moved = np.array([x[owner == j].mean(0) if (owner == j).any() else centers[j] for j in range(k)])
                done = np.abs(moved - centers).max() < 1e-9
                centers = moved
                if done:
                    break
            starts.append(((x[:, None] - centers[None]) ** 2).sum(2).min(1).sum())
        assert fit.cost == pytest.approx(min(starts), rel=1e-4)
    got = fits[1].transform(df).orderBy("id").toPandas()["cluster"].to_numpy()
    assert (got == ((x[:, None] - fits[1].centers[None]) ** 2).sum(2).argmin(1)).all()
    assert cluster.fit_kmeans(df.limit(0)).centers.size == 0


# --- anomalies --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def clouds(spark):
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(0, 1, (500, 30)), rng.normal(6, 1, (25, 30))])
    y = np.array([0] * 500 + [1] * 25)
    df = spark.createDataFrame([(i, int(y[i]), [float(v) for v in x[i]]) for i in range(len(y))], "id long, y int, x array<double>")
    split = sampling.random_split(df, "id", 0.2, by=["y"]).cache()
    return split.filter("split = 'train'"), split.filter("split = 'test'")


def mean_scores(scored):
    got = scored.groupBy("y").agg(F.avg("score").alias("m"), F.count_if(F.isnan("score")).alias("bad")).collect()
    assert all(r["bad"] == 0 for r in got)
    return {r["y"]: r["m"] for r in got}


def test_isolation_forest_ranks_anomalies(clouds):
    train, test = clouds
    forest = anomaly.fit_isolation_forest(train, "id", "x", trees=40)
    assert forest["tree"].nunique() == 40 and forest.groupby("tree")["rows"].first().max() <= 256
    m = mean_scores(anomaly.isolation_score(test, forest, "x"))
    assert m[1] > m[0] and 0 < m[0] < m[1] < 1


def test_one_class_machine_ranks_anomalies(clouds):
    train, test = clouds
    model = anomaly.fit_one_class(train.filter("y = 0"), "x", steps=8)
    m = mean_scores(anomaly.one_class_score(test, model, "x"))
    assert m[1] > m[0]


def brute_lof(train, test, k):
    def near(q, p, skip):
        d = np.sqrt(((q[:, None] - p[None]) ** 2).sum(2))
        if skip:
            np.fill_diagonal(d, np.inf)
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(d, order, 1), order

    d0, i0 = near(train, train, True)
    reach = d0[:, -1]
    density = 1 / (np.maximum(d0, reach[i0]).mean(1) + 1e-10)
    d1, i1 = near(test, train, False)
    own = 1 / (np.maximum(d1, reach[i1]).mean(1) + 1e-10)
    return density[i1].mean(1) / own


@pytest.mark.parametrize("block", [4096, 50])
def test_outlier_factor_matches_brute_force(clouds, block):
    train, test = clouds
    got = anomaly.outlier_factor(train, test, "id", "x", k=15, block_rows=block).orderBy("id").toPandas()
    a, b = train.orderBy("id").toPandas(), test.orderBy("id").toPandas()
    assert np.allclose(got["score"], brute_lof(np.stack(a["x"]), np.stack(b["x"]), 15))


@pytest.fixture(scope="module")
def crowd(spark):
    """Forty loose clusters in 16 dimensions, a third of the rows copies of one point."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 3, (40, 16))[rng.integers(0, 40, 4000)] + rng.normal(0, 1, (4000, 16))
    x = np.vstack([x, np.repeat(x[:1], 2000, axis=0)])
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>").cache()


def test_buckets_find_the_neighbours(crowd):
    queries = crowd.filter("id % 20 = 0")
    exact = anomaly.nearest_neighbours(queries, crowd, "id", "x", 10)
    plan = anomaly.Candidates(tables=8, bucket_rows=256, probes=12)
    found = anomaly.approximate_neighbours(queries, crowd, "id", "x", 10, plan, block_rows=200)
    got = anomaly.neighbour_recall(found, exact).first()
    assert got["recall"] >= 0.9 and got["neighbours"] == 300 * 10
    one = anomaly.approximate_neighbours(queries, crowd, "id", "x", 10, anomaly.Candidates(bucket_rows=10_000))
    order = ["query", "distance", "point"]
    a, b = (d.orderBy(*order).toPandas() for d in (one, exact))
    assert (a[["query", "point"]].to_numpy() == b[["query", "point"]].to_numpy()).all()


def test_groups_of_buckets_give_the_same_neighbours(crowd, monkeypatch):
    plan = anomaly.Candidates(tables=3, bucket_rows=64, probes=6)
    said = []
    for bits, size in ((8, 131_072), (2, 131_072), (0, 300)):  # one group, several, one for each bucket in blocks
        monkeypatch.setattr(anomaly, "GROUP_BITS", bits)
        monkeypatch.setattr(anomaly, "GROUP_ROWS", size)
        found = anomaly.approximate_neighbours(crowd.filter("id % 40 = 0"), crowd, "id", "x", 10, plan, block_rows=50)
        said.append(found.orderBy("query", "distance", "point").toPandas())
    for other in said[1:]:
        pd.testing.assert_frame_equal(said[0], other)


def test_exact_neighbours_of_float_vectors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(anomaly, "TASK_ROWS", 70)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<float>")
    assert anomaly._vectors(rows, "id", "x").schema["x"].dataType.simpleString() == "array<float>"
    got = anomaly.nearest_neighbours(rows, rows, "id", "x", 4, block_rows=16).orderBy("query", "distance").toPandas()
    d = np.sqrt(((x[:, None].astype(float) - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert (got["point"].to_numpy().reshape(200, 4) == np.argsort(d, axis=1)[:, :4]).all()
    assert np.allclose(got["distance"].to_numpy().reshape(200, 4), np.sort(d, axis=1)[:, :4])


def test_probes_are_the_nearest_buckets():
    rng = np.random.default_rng(0)
    margins = rng.normal(size=(20, 5))
    got = anomaly.bucket_bits(margins, 6)
    for row, places in zip(margins, got):
        own = sum(1 << j for j in range(5) if row[j] > 0)
        cost = {own ^ c: sum(row[j] ** 2 for j in range(5) if c >> j & 1) for c in range(32)}
        assert list(places) == sorted(cost, key=cost.get)[:6]
    assert anomaly.bucket_bits(np.zeros((3, 0)), 4).tolist() == [[0]] * 3


def test_outlier_factor_among_candidates(clouds):
    train, test = clouds
    a, b = (
        anomaly.outlier_factor(train, test, "id", "x", k=15, candidates=c).orderBy("id").toPandas()
        for c in (None, anomaly.Candidates(bucket_rows=64))
    )
    assert list(a["id"]) == list(b["id"]) and np.corrcoef(a["score"], b["score"])[0, 1] > 0.95


def test_supervised_detector_finds_separable_fraud(clouds):
    train, test = (d.withColumn("features", array_to_vector("x")).withColumn("label", F.col("y").cast("double")) for d in clouds)
    weighted = ml.balanced_weights(train)
    rows = ml.scored(ml.logistic(weighted, weight="weight").fit(weighted), test)
    assert ev.roc_auc(ev.score_counts(rows, "label", "positive")).first()[0] > 0.9
    assert ev.binary_metrics(rows, "label", "prediction").first()["recall"] > 0.5


def test_short_vectors_meet_the_points_of_near_boxes_only():
    rng = np.random.default_rng(3)
    hours = rng.integers(0, 5, 1500)
    x = np.stack([rng.integers(0, 400, 1500) / 20.0, np.sin(hours), np.cos(hours)], axis=1)
    x[7] = np.nan
    ids = np.arange(1500)
    found, met = anomaly._Nearest(ids, 5), []
    tile = found._tile
    found._tile = lambda at, xq, p, xp: (met.append(len(xq) * len(xp)), tile(at, xq, p, xp))
    found.meet(ids, x, ids, x, 4096)
    assert sum(met) < 0.5 * len(x) ** 2
    distance = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(distance, np.inf)
    for q in np.delete(ids, 7)[:300]:
        best = np.lexsort((ids, np.round(distance[q], 12)))[:5]
        assert found.points[q].tolist() == best.tolist()


def test_one_class_steps_add_up_random_features_by_batch():
    x = np.random.default_rng(1).normal(size=(40, 3))
    z = ml.fourier_features(x, 16, 0.5, 42)
    w, batch = z.mean(axis=0), pa.RecordBatch.from_pydict({"x": pa.array(x.tolist())})
    (got,) = anomaly._outside_sums(iter([batch.slice(0, 25), batch.slice(25)]), w, 0.1, 0.5, 42)
    outside = z @ w < 0.1
    assert got.column("n").to_pylist() == [outside.sum()]
    assert np.allclose(got.column("s").to_pylist()[0], z[outside].sum(axis=0))


def test_center_sums_hold_a_bounded_part_of_a_batch(spark, monkeypatch):
    sizes = []
    real = cluster.step_sums
    monkeypatch.setattr(cluster, "step_sums", lambda x, c: (sizes.append(len(x)), real(x, c))[1])
    batch = pa.RecordBatch.from_pydict({"x": pa.array([[float(i), 1.0] for i in range(5000)])})

    class Rows:
        def mapInArrow(self, run, schema):
            (self.got,) = run(iter([batch]))
            return spark.createDataFrame([(0, self.got.column("sums").to_pylist()[0])], schema)

    centers = np.array([[0.0, 1.0], [5000.0, 1.0]])
    sums = cluster._steps(Rows(), {0: cluster.Centers(centers)})[0]
    assert max(sizes) <= cluster.CACHED_ROWS and sums[:, -2].sum() == 5000


def test_blocks_of_the_exact_search_cost_few_copies():
    def copies(queries, points):
        n_q, n_p = anomaly._block_counts(queries, points, 1024)
        assert n_q * n_p >= min(anomaly.LEAST_PARTS, -(-queries // 1024))
        assert max(-(-queries // n_q), -(-points // n_p)) <= anomaly.TASK_ROWS
        return (queries * n_p + points * n_q) / points

    assert copies(10, 10) == 2 and copies(9_600, 9_600) <= 11  # as many as before: one block of points
    assert copies(96_000, 96_000) <= 18 and copies(576_000, 576_000) <= 18 and copies(144_000, 576_000) <= 7


def test_comparison_scores_every_regressor_over_the_folds(spark, tmp_path):
    from lumenframe.plans import training

    rng = np.random.default_rng(3)
    lines = [(k, 1 + k % 7, 1 + k % 3, float(1 + k % 50), float(100 * (1 + k % 50) + rng.normal()), k % 5 / 50, k % 4 / 50) for k in range(400)]
    names = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    items = [(k, 3 * k, 10.0 + k) for k in range(1, 8)]
    spark.createDataFrame(items, "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    got = training.m20_regressor_comparison(spark, str(tmp_path)).toPandas()
    assert set(got["model"]) == set(training.REGRESSORS) and got["cv_mean"].notna().all()
    assert got.loc[got["best"], "cv_mean"].tolist() == [got["cv_mean"].max()]
    scores = training.m15_cross_validation(spark, str(tmp_path)).toPandas().set_index("model")["mean"]
    assert np.allclose(got.set_index("model")["cv_mean"].sort_index(), scores.sort_index())
