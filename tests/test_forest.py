"""Forests against a plain tree by tree growth in numpy, and against themselves on other partitions and passes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import forest as fo
from lumenframe.operators import models as ml
from lumenframe.operators.boosting import binned

ROWS = 400


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(ROWS, 5)).round(1)
    y = np.where(x[:, 0] > 0.3, 4.0, 1.0) + x[:, 1] + rng.normal(scale=0.2, size=ROWS)
    return x, y, (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5)


@pytest.fixture(scope="module")
def rows(spark, numbers):
    x, y, c = numbers
    made = [(k, x[k].tolist(), float(y[k]), float(c[k])) for k in range(ROWS)]
    return spark.createDataFrame(made, "id long, features array<double>, label double, class double").persist()


def plain_sums(x, y, weight, classes, depth, least, columns_of):
    """The sums of the leaf of each row, by growing one tree node by node."""
    out = np.zeros((len(x), classes or 2))
    numbers = np.eye(classes)[y.astype(int)] if classes else np.stack([np.ones(len(y)), y], axis=1)

    def score(part):
        n = part.sum() if classes else part[0]
        return ((part**2).sum() if classes else part[1] ** 2) / n

    def best_of(at, tried):
        total, best = (numbers[at] * weight[at, None]).sum(axis=0), None
        for f in tried:
            for b in range(31):
                left = at[x[at, f] <= b]
                low = (numbers[left] * weight[left, None]).sum(axis=0)
                n = (low.sum(), (total - low).sum()) if classes else (low[0], total[0] - low[0])
                if min(n) < max(least, 1):
                    continue
                gain = score(low) + score(total - low) - score(total)
                if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                    best = (gain, f, b)
        return best

    # Nodes of a level stand in order; only those that can be split draw columns.
    level = [np.arange(len(x))]
    for d in range(depth + 1):
        following, open_ = [], []
        for at in level:
            total = (numbers[at] * weight[at, None]).sum(axis=0)
            out[at] = total
            n = total.sum() if classes else total[0]
            if d == 0 or (n >= 2 * max(least, 1) and not (classes and total.max() >= n)):
                open_.append(at)
        if d == depth:
            break
        columns = columns_of(d, len(open_))
        for k, at in enumerate(open_):
            best = best_of(at, range(x.shape[1]) if columns is None else columns[k])
            if best:
                right = x[at, best[1]] > best[2]
                following += [at[~right], at[right]]
        level = following
    return out


@pytest.mark.parametrize("classes", [0, 3])
def test_trees_equal_plain_growth(rows, numbers, classes):
    x, y, c = numbers
    estimator = fo.Forest(bool(classes), "class" if classes else "label", numTrees=3, maxDepth=4, minInstancesPerNode=3)
    model = estimator.fit(rows)
    label = "class" if classes else "label"
    keys = rows.selectExpr("id", f"pmod(xxhash64(id, features, {label}), 4294967296) s").orderBy("id").toPandas()["s"].to_numpy()
    cells, table = binned(x, model.edges), fo._poisson_table()
    labels, tried = (c, 3) if classes else (y - model.middle, 5)
    for t, tree in enumerate(model.trees):
        weight = fo.draws(keys, 42, t, table).astype(float)
        expected = plain_sums(cells, labels, weight, classes, 4, 3, lambda d, n: fo._columns_of(42, t, d, n, 5, tried))
        got = tree.sums[tree.nodes(cells.ravel(), np.arange(ROWS) * 5, 4)]
        assert np.allclose(got, expected)


@pytest.mark.parametrize("label", ["label", "class"])
def test_forest_does_not_depend_on_partitions_and_passes(rows, monkeypatch, label):
    build = ml.forest_classifier if label == "class" else ml.forest_regressor
    first = build(6, 5, label=label).fit(rows.repartition(1))
    monkeypatch.setattr(fo, "TASK_ROWS", 50)
    monkeypatch.setattr(fo, "BLOCK_ROWS", 20)
    monkeypatch.setattr(fo, "GROUP_BYTES", 5_000)
    monkeypatch.setattr(fo, "PASS_BYTES", 20_000)
    monkeypatch.setattr(fo, "JOB_PASSES", 3)
    second = build(6, 5, label=label).fit(rows.repartition(7))
    for one, two in zip(first.trees, second.trees, strict=True):
        assert (one.feature == two.feature).all() and (one.bin == two.bin).all() and (one.left == two.left).all()
        assert np.allclose(one.sums, two.sums)


def test_passes_hold_every_node_once_within_their_size():
    empty = fo.Pass(0, 5, 5, 3, 42, group=25)
    trees = [fo.Tree.leaves(np.zeros((900, 2))) for _ in range(4)]
    active = {t: np.arange(100, 100 + 37 * (t + 1) ** 2) for t in range(4)}
    passes = fo._passes(empty, 400, trees, active, dict.fromkeys(active))
    assert all(sum(len(p.nodes) for p in made.parts) <= 400 for made in passes)
    assert all(p.first % made.group == 0 for made in passes for p in made.parts)
    for t, nodes in active.items():
        parts = [p for made in passes for p in made.parts if p.tree == t]
        assert np.array_equal(np.concatenate([p.nodes for p in parts]), nodes)


def test_draws_are_poisson_and_differ_by_tree():
    keys = np.arange(200_000) * 2654435761 % (1 << 32)
    made = np.stack([fo.draws(keys, 42, t, fo._poisson_table()) for t in range(6)]).astype(float)
    assert np.allclose(made.mean(axis=1), 1, atol=0.02) and np.allclose(made.var(axis=1), 1, atol=0.03)
    assert np.abs(np.corrcoef(made) - np.eye(6)).max() < 0.01


def test_scores_and_importances(rows, numbers):
    model = ml.forest_classifier(20, 6, label="class").fit(rows)
    made = model.transform(rows).orderBy("id").toPandas()
    shares = np.stack([v.toArray() for v in made["probability"]])
    assert np.allclose(shares.sum(axis=1), 1) and (made["prediction"] == shares.argmax(axis=1)).all()
    assert np.allclose(np.stack([v.toArray() for v in made["rawPrediction"]]), shares * 20, atol=1e-5)
    assert (made["prediction"] == numbers[2]).mean() > 0.95
    assert set(np.argsort(model.featureImportances.toArray())[-2:]) == {0, 1}


def test_rows_without_label_are_left_out_and_equal_labels_give_one_leaf(rows, spark):
    more = rows.select("id", "features", "label").unionByName(
        spark.createDataFrame([(None, [0.0] * 5, None), (1, None, 3.0)], "id long, features array<double>, label double")
    )
    first, second = ml.forest_regressor(2, 3).fit(rows), ml.forest_regressor(2, 3).fit(more)
    assert all(np.allclose(a.sums, b.sums) for a, b in zip(first.trees, second.trees, strict=True))
    same = rows.selectExpr("id", "features", "7.5D as label")
    model = ml.forest_regressor(2, 3).fit(same)
    assert [len(t.left) for t in model.trees] == [1, 1]
    assert model.transform(same).selectExpr("min(prediction)", "max(prediction)").first()[:] == (7.5, 7.5)
    with pytest.raises(ValueError):
        ml.forest_regressor(2, 3).fit(rows.limit(0))


def test_rows_without_ids_are_drawn_one_by_one(rows, numbers):
    model = ml.forest_regressor(8, 4).fit(rows.withColumn("id", F.lit(None).cast("long")))
    sizes = [t.sums[0, 0] for t in model.trees]
    assert all(300 < n < 500 for n in sizes) and len(set(sizes)) > 1
