"""Histogram boosting and linear fits from sums, against plain recomputations."""

import numpy as np
import pandas as pd
import pytest

from lumenframe.operators import boosting as B
from lumenframe.operators import gram, sampling
from lumenframe.operators import models as ml


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(500, 3)), 1)
    x[::37, 1] = np.nan
    y = np.sin(2 * x[:, 0]) + np.where(x[:, 2] > 0.3, 1.5, 0.0) + rng.normal(0, 0.1, 500)
    return x, y


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y = data
    three = np.digitize(y, [0.0, 1.0]).astype(float)
    pdf = pd.DataFrame({"id": np.arange(500), "features": list(x), "label": y, "binary": (y > 0.6) * 1.0, "three": three})
    return spark.createDataFrame(pdf).repartition(5).cache()


def plain_tree(x, g, h, depth, min_rows=1):
    """Nested (feature, threshold, left, right) or a leaf value, over all values as thresholds."""
    best = (1e-9, None)
    if depth:
        for f in range(x.shape[1]):
            for t in np.unique(x[~np.isnan(x[:, f]), f]):
                left = x[:, f] <= t
                n = left.sum()
                if min(n, len(x) - n) < min_rows:
                    continue
                gain = g[left].sum() ** 2 / n + g[~left].sum() ** 2 / (len(x) - n) - g.sum() ** 2 / len(x)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, (f, t, left))
    if best[1] is None:
        return g.sum() / h.sum()
    f, t, left = best[1]
    return f, t, plain_tree(x[left], g[left], h[left], depth - 1, min_rows), plain_tree(x[~left], g[~left], h[~left], depth - 1, min_rows)


def plain_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def plain_margins(x, y, loss, rounds, depth, rate, classes=1, min_rows=1):
    if loss == "squared":
        f = np.full((1, len(y)), y.mean())
    elif loss == "logistic":
        f = np.full((1, len(y)), np.log(y.mean() / (1 - y.mean())))
    else:
        f = np.repeat(np.log([(y == c).mean() for c in range(classes)])[:, None], len(y), axis=1)
    for _ in range(rounds):
        g, h, _ = B.gradients(loss, y, f)
        for c in range(classes):
            factor = (classes - 1) / classes if classes > 1 else 1.0
            tree = plain_tree(x, g[c], h[c], depth, min_rows)
            f[c] += rate * factor * np.array([plain_value(tree, r) for r in x])
    return f


@pytest.mark.parametrize("direct", [0, B.DIRECT_BYTES])
@pytest.mark.parametrize(("label", "loss", "classes"), [("label", "squared", 1), ("binary", "logistic", 1), ("three", "softmax", 3)])
def test_trees_equal_brute_force(rows, data, label, loss, classes, direct, monkeypatch):
    monkeypatch.setattr(B, "DIRECT_BYTES", direct)
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)  # several tasks
    settings = B.Boosting(rounds=3, depth=3, rate=0.3, min_rows=4)
    model = B.BoostedTrees(settings, loss, label).fit(rows)
    pdf = rows.toPandas().sort_values("id")
    want = plain_margins(data[0], pdf[label].to_numpy(), loss, 3, 3, 0.3, classes, 4)
    assert np.allclose(model.margins(data[0]), want, atol=1e-9)


def test_gradients_are_derivatives_of_the_loss():
    rng = np.random.default_rng(0)
    for loss, classes in (("squared", 1), ("logistic", 1), ("softmax", 4)):
        y, f = rng.integers(0, max(classes, 2), 20).astype(float), rng.normal(size=(classes, 20))
        g, h, _ = B.gradients(loss, y, f)
        for c in range(classes):
            step = np.zeros_like(f)
            step[c] = 1e-5
            up, down = B.gradients(loss, y, f + step), B.gradients(loss, y, f - step)
            assert np.allclose((down[2] - up[2]) / 2e-5, g[c], atol=1e-6)
            assert np.allclose((down[0][c] - up[0][c]) / 2e-5, h[c], atol=1e-6)


def test_loss_falls_over_written_rounds_and_classes_are_found(rows, monkeypatch):
    monkeypatch.setattr(B, "WRITE_EVERY", 4)
    for label, loss in (("label", "squared"), ("binary", "logistic"), ("three", "softmax")):
        model = B.BoostedTrees(B.Boosting(rounds=10, depth=3, rate=0.3), loss, label).fit(rows)
        assert len(model.losses) == 10 and all(a > b for a, b in zip(model.losses, model.losses[1:]))
        got = model.transform(rows).toPandas()
        if loss != "squared":
            assert (got["prediction"] == got[label]).mean() > 0.9
            assert np.allclose([p.toArray().sum() for p in got["probability"]], 1)
    assert model.first(2).margins(np.zeros((1, 3))).shape == (3, 1)
    shares = B.BoostedTrees(B.Boosting(rounds=5)).fit(rows).featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and shares.argmax() == 2


def test_samples_and_columns_repeat_and_penalty_shrinks(rows):
    settings = B.Boosting(rounds=4, depth=3, sample=0.6, columns=0.7)
    one, two = (B.BoostedTrees(settings).fit(d) for d in (rows, rows.repartition(2)))
    x = np.stack(rows.toPandas()["features"])
    assert np.allclose(one.margins(x), two.margins(x))
    plain, shrunk = (B.BoostedTrees(B.Boosting(rounds=1, penalty=p)).fit(rows) for p in (0.0, 50.0))
    assert np.abs(shrunk.margins(x) - shrunk.start[0]).max() < np.abs(plain.margins(x) - plain.start[0]).max()


def test_fits_together_equal_fits_alone(rows):
    tagged = rows.withColumn("fold", sampling.fold_of("id", 3)).cache()
    settings = B.Boosting(rounds=3, depth=2)
    together = B.fit_boosted(tagged, [B.Fit(settings, 1), B.Fit(settings, None, 0.5), B.Fit(B.Boosting(rounds=2, depth=4))], fold="fold")
    x = np.stack(rows.toPandas()["features"])
    alone = B.fit_boosted(tagged, [B.Fit(settings, 1)], fold="fold")[0]
    assert np.allclose(together[0].margins(x), alone.margins(x))
    assert [len(m.trees) for m in together] == [3, 3, 2]
    # The first margin is the mean of all rows; the leaves come from the rows of the fit alone.
    kept = tagged.where("fold <> 1").toPandas()
    tree = together[0].trees[0][0]
    cells = B.binned(np.stack(kept["features"]), together[0].edges)
    at = tree.nodes(cells, 2)
    rest = kept["label"].to_numpy() - together[0].start[0]
    assert all(tree.value[k] == pytest.approx(0.1 * rest[at == k].mean()) for k in np.unique(at))


def test_odd_tables(spark):
    schema = "id long, features array<double>, label double"
    assert B.BoostedTrees().fit(spark.createDataFrame([], schema)).trees == []
    few = spark.createDataFrame([(1, [1.0], 2.0), (None, [None], 4.0), (3, None, 1.0), (4, [1.0], None)], schema)
    model = B.BoostedTrees(B.Boosting(rounds=2, rate=1.0)).fit(few)
    assert model.margins(np.array([[1.0], [np.nan], [5.0]])).ravel().tolist() in ([2.0, 4.0, 4.0], [3.0, 3.0, 3.0])
    same = spark.createDataFrame([(k, [1.0, 2.0], 5.0) for k in range(4)], schema)
    assert B.BoostedTrees(B.Boosting(rounds=2)).fit(same).margins(np.ones((1, 2)))[0, 0] == 5.0


def test_grid_and_curve(rows):
    grid = [B.Boosting(rounds=r, depth=d) for r in (2, 6) for d in (1, 3)]
    model, table = B.grid_search(rows, grid)
    assert len(table) == 4 and table.loc[table["score"].idxmax(), ["rounds", "depth"]].tolist() == [6, 3]
    assert len(model.trees) == 6
    fold = sampling.fold_of("id", 3)
    scores = []
    for k in range(3):
        split = rows.withColumn("fold", fold).cache()
        fitted = B.fit_boosted(split, [B.Fit(grid[1], k)], fold="fold")[0]
        held = fitted.transform(split.where(f"fold = {k}")).toPandas()
        scores.append(1 - ((held["label"] - held["prediction"]) ** 2).sum() / ((held["label"] - held["label"].mean()) ** 2).sum())
    assert table["score"].iloc[1] == pytest.approx(np.mean(scores)) and table["std"].iloc[1] == pytest.approx(np.std(scores))
    curve = B.learning_curve(rows, B.Boosting(rounds=4, depth=3), shares=(0.3, 1.0)).toPandas()
    assert len(curve) == 4 and (curve["mean"] > 0).all()


# --- linear fits from sums --------------------------------------------------------------


def test_sums_give_the_fits_of_spark(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4)) * [1, 5, 0.3, 2] + [0, 3, 1, -2]
    y = x @ [1.0, -0.5, 2.0, 0.0] + rng.normal(0, 0.5, 300)
    rows = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")).assign(id=np.arange(300), label=y))
    rows = ml.assembled(rows, list("abcd")).repartition(4).cache()
    sums = gram.product_sums(rows, "features", "label", {"one": ml.F.lit(0)})["sums"].iloc[0]
    for solve, build in ((gram.linear(), ml.linear()), (gram.ridge(7.0), ml.ridge(rows, 7.0)), (gram.lasso(0.2), ml.lasso(0.2))):
        w, model = solve(sums), build.fit(rows)
        assert np.allclose(w, [model.intercept, *model.coefficients], atol=1e-3)
    mean, std = ml.cross_validate(ml.linear(), rows, "id")
    got = gram.cross_validated(rows, {"linear": gram.linear()})
    assert got["mean"][0] == pytest.approx(mean, abs=1e-8) and got["std"][0] == pytest.approx(std, abs=1e-8)
    want = ml.learning_curve(ml.linear(), rows, "id").toPandas().sort_values(["share", "kind"])
    curve = gram.learning_curve(rows, gram.linear()).sort_values(["share", "kind"])
    assert np.allclose(curve[["mean", "std"]], want[["mean", "std"]], atol=1e-8)


@pytest.mark.parametrize("depth", [1, 3, 5, 9])
def test_paths_through_trees_match_steps(depth):
    """Trees with early leaves, rows column after column or not; a step at a time is the definition."""
    rng = np.random.default_rng(depth)
    tree = B.Tree.empty(depth)
    inner = 2**depth - 1
    tree.feature[:inner] = np.where(rng.random(inner) < 0.8, rng.integers(0, 4, inner), -1)
    tree.bin[:inner], tree.value[:] = rng.integers(0, 256, inner), rng.normal(size=len(tree.value))
    x = rng.integers(0, 256, (500, 4)).astype(np.uint8)
    for levels in range(depth + 1):
        want = np.zeros(len(x), int)
        for row in range(len(x)):
            for _ in range(levels):
                f = tree.feature[want[row]]
                if f >= 0:
                    want[row] = 2 * want[row] + 1 + (x[row, f] > tree.bin[want[row]])
        for same in (x, np.asfortranarray(x)):
            assert (tree.nodes(same, levels) == want).all()
    assert (tree.values(x) == tree.value[want]).all()
    if depth <= 8:
        assert (tree.ends(depth)[tree.paths(x, depth)] == want).all()


def test_levels_send_the_driver_best_splits_only():
    """Hundreds of levels of wide sums stay below a gigabyte in all."""
    assert 1000 * B.DIRECT_BYTES < 1_000_000_000


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_sums_travel_for_the_bins_there_are(loss):
    """Three features with 2, 256 and 1 bins: what is packed comes back, and weighs as much as they need."""
    level = B.Level(loss, 1, [B.Fit(B.Boosting())], 0, 0, [], widths=[2, 256, 1])
    level.active[0], level.columns[0] = [0], np.array([1, 2])
    made = np.zeros((3, 2, B.BINS))
    made[:, 0], made[:, 1, 0] = np.arange(3 * B.BINS).reshape(3, -1), [7, 8, 9]
    if loss == "squared":
        made[1] = made[2]
    packed = level.packed(0, 0, made)
    assert packed.nbytes == level.size() == 257 * (16 if loss == "squared" else 24)
    assert (level.unpacked(0, 0, packed) == made).all()


def test_small_rows_grow_fits_in_tasks_as_in_jobs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3))
    y = x[:, 0] * 2 + (x[:, 1] > 0.3) + rng.normal(size=3000) / 4
    data = [(k, x[k].tolist(), float(y[k]), int(k % 3)) for k in range(3000)]
    df = spark.createDataFrame(data, "id long, features array<double>, label double, fold int").repartition(3)
    settings = B.Boosting(6, 3, 0.2, 0.7, 0.7)
    fits = [B.Fit(settings), B.Fit(settings, 1), B.Fit(B.Boosting(9, 2), 2, 0.5)]
    grow = B._grow

    def no_jobs(*_):
        raise AssertionError("a job for a level")

    monkeypatch.setattr(B, "_grow", no_jobs)
    alone = B.fit_boosted(df, fits, fold="fold")
    monkeypatch.setattr(B, "_grow", grow)
    monkeypatch.setattr(B, "ALONE_BYTES", 0)
    dealt = B.fit_boosted(df, fits, fold="fold")
    for one, other in zip(alone, dealt, strict=True):
        assert np.allclose(one.losses, other.losses) and len(one.trees) == len(other.trees)
        for a, b in zip(one.trees, other.trees, strict=True):
            assert (a[0].feature == b[0].feature).all() and (a[0].bin == b[0].bin).all()
            assert np.allclose(a[0].value, b[0].value)
