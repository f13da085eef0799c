"""Recommender contracts, and neighbour predictions against a dense numpy computation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import evaluate as ev
from lumenframe.operators import recommend as rec
from lumenframe.operators import sampling


@pytest.fixture(scope="module")
def pattern():
    """Two taste groups, 40% of the cells empty."""
    rng = np.random.default_rng(7)
    users, items = 40, 24
    match = rng.integers(0, 2, users)[:, None] == rng.integers(0, 2, items)[None, :]
    grid = np.clip(np.round(np.where(match, 4.5, 2.0) + rng.normal(0, 0.4, match.shape)), 1, 5)
    keep = rng.random(grid.shape) > 0.4
    keep[:, 0] = True  # an item everybody rated
    u, i = np.nonzero(keep)
    return pd.DataFrame({"user_id": u, "item_id": i, "rating": grid[u, i]})


@pytest.fixture(scope="module")
def halves(spark, pattern):
    df = spark.createDataFrame(pattern.assign(pair=pattern["user_id"] * 1000 + pattern["item_id"]))
    df = sampling.random_split(df, "pair", 0.2).drop("pair").cache()
    return df.filter("split = 'train'").drop("split"), df.filter("split = 'test'").drop("split")


def dense_knn(train, test, by_user, k):
    """The textbook dense computation with unrated cells as deviation 0."""
    users = np.union1d(train["user_id"], test["user_id"])
    items = np.union1d(train["item_id"], test["item_id"])
    m = train.pivot(index="user_id", columns="item_id", values="rating").reindex(index=users, columns=items)
    m = m.to_numpy() if by_user else m.to_numpy().T
    mean = np.array([np.nanmean(r) if (~np.isnan(r)).any() else np.nan for r in m])
    dev = np.nan_to_num(m - mean[:, None])
    norm = np.linalg.norm(dev, axis=1)
    norm[norm == 0] = 1
    sim = (dev / norm[:, None]) @ (dev / norm[:, None]).T
    np.fill_diagonal(sim, 0)
    out = []
    for u, i in zip(np.searchsorted(users, test["user_id"]), np.searchsorted(items, test["item_id"])):
        a, b = (u, i) if by_user else (i, u)
        order = np.lexsort((np.arange(len(sim)), -np.abs(sim[a]).round(9)))[:k]
        w = np.abs(sim[a, order]).sum()
        shift = sim[a, order] @ dev[order, b] / w if w > 0 else dev[:, b].mean()
        base = np.nanmean(m) if np.isnan(mean[a]) else mean[a]
        out.append(np.clip(base + shift, 1, 5))
    return np.array(out)


@pytest.mark.parametrize("axis", ["user_id", "item_id"])
@pytest.mark.parametrize("hot,entries,rows", [(500, 200_000, 1024), (3, 60, 1024), (1, 10, 4), (12, 10_000, 3), (16, 1, 1)])
def test_neighbours_match_dense_computation(spark, halves, axis, hot, entries, rows):
    """Also with nearly every column taken as crowded, cut into many blocks, and blocks of a single row."""
    train, test = halves
    got = rec.neighbour_predict(train, test, axis, k=5, hot=hot, block_entries=entries, block_rows=rows).toPandas()
    got = got.sort_values(["user_id", "item_id"])
    want = test.toPandas().sort_values(["user_id", "item_id"])
    dense = dense_knn(train.toPandas(), want, axis == "user_id", 5)
    assert len(got) == len(want)
    assert np.allclose(got["predicted"], dense, atol=1e-9)


@pytest.mark.parametrize("most", [8_000_000, 300, 5])
def test_light_neighbours_in_blocks_match_the_join(spark, halves, most):
    """In blocks of many rows, of a few rows, and with rows too large for a block."""
    weights = rec.unit_weights(halves[0], "user_id").where("weight <> 0")
    weights = weights.select(F.col("user_id").alias("a"), F.col("item_id").alias("c"), "weight")
    got = rec._light_neighbours(weights, 4, most).toPandas().sort_values("a")
    dense = weights.toPandas().pivot(index="a", columns="c", values="weight").fillna(0.0)
    sim = dense.to_numpy() @ dense.to_numpy().T
    np.fill_diagonal(sim, 0.0)
    assert list(got["a"]) == list(dense.index)
    for row, b, similarity in zip(sim, got["b"], got["similarity"]):
        rank = np.abs(row).round(9)
        order = [j for j in np.argsort(-rank, kind="stable")[:4] if rank[j] > 0]
        assert list(b) == list(dense.index[order]) and np.allclose(similarity, row[order])


@pytest.mark.parametrize("hot", [500, 2])
def test_raters_without_a_deviation_add_nothing(spark, hot):
    near = spark.createDataFrame([(1, [2, 3, 4], [0.5, -0.25, 1.0])], "a long, b array<long>, similarity array<double>")
    dev = [(2, 7, 2.0), (3, 7, None), (4, 7, 1.0), (5, 7, 9.0), (None, 7, 3.0), (3, 8, 4.0)]
    dev = spark.createDataFrame(dev, "user_id long, item_id long, dev double")
    wanted = spark.createDataFrame([(1, 7), (1, 8), (1, 9), (6, 7)], "user_id long, item_id long")
    got = rec._neighbour_sums(wanted, near, dev, "user_id", "item_id", hot).collect()
    assert {(r["user_id"], r["item_id"]): r["_sum"] for r in got} == {(1, 7): 2.0, (1, 8): -1.0}


def test_blocks_are_bounded_by_rows_and_entries(spark):
    sizes = [1] * 50 + [40, 3, 3] + [1] * 20
    cells = spark.createDataFrame([(a, c) for a, n in enumerate(sizes) for c in range(n)], "a long, c long")
    got = rec.row_blocks(cells, 30, 10).toPandas()
    assert len(got) == len(sizes) and got["block"].is_monotonic_increasing
    for _, part in got.groupby("block"):
        entries = [sizes[a] for a in part["a"]]
        assert len(part) <= 10 and sum(entries) - max(entries) <= 30


def test_bias_predictions_in_range_and_cold_rows(spark, halves):
    train, test = halves
    cold = spark.createDataFrame([(999, 999, 3.0)], "user_id long, item_id long, rating double")
    got = rec.bias_predict(train, test.unionByName(cold)).toPandas()
    assert got["predicted"].between(1, 5).all() and len(got) == test.count() + 1
    mean = train.toPandas()["rating"].mean()
    assert got.loc[got["user_id"] == 999, "predicted"].iloc[0] == pytest.approx(mean)


def test_factors_beat_the_bias_baseline(spark, halves):
    train, test = halves
    model = rec.factor_fit(train, rank=4, iterations=15, reg=0.1)
    error = [
        ev.regression_metrics(d, "rating", "predicted").first()["rmse"]
        for d in (rec.factor_predict(model, train, test), rec.bias_predict(train, test))
    ]
    assert error[0] < error[1]


def test_factorization_removes_old_shuffle_files(spark, halves, monkeypatch):
    made, als = [], rec.ALS
    monkeypatch.setattr(rec, "ALS", lambda **settings: made.append(als(**settings)) or made[-1])
    rec.factor_fit(halves[0], rank=2, iterations=4)
    assert [m.getCheckpointInterval() for m in made] == [2]


def test_training_curve_falls(spark, halves):
    curve = rec.training_curve(halves[0], (1, 8), rank=4).toPandas().sort_values("iterations")
    assert curve["rmse"].iloc[1] <= curve["rmse"].iloc[0] + 1e-6


def test_training_curve_fits_share_their_rows(spark, halves, monkeypatch):
    """The curve is that of separate fits, but biases are taken once."""
    train, want = halves[0], []
    for n in (1, 3):
        fitted = rec.factor_predict(rec.factor_fit(train, rank=3, iterations=n), train, train)
        want.append(ev.regression_metrics(fitted, "rating", "predicted").first()["rmse"])
    calls, real = [], rec.bias_predict
    monkeypatch.setattr(rec, "bias_predict", lambda *a, **kw: calls.append(1) or real(*a, **kw))
    got = rec.training_curve(train, (1, 3), rank=3).orderBy("iterations").toPandas()
    assert len(calls) == 1 and list(got["iterations"]) == [1, 3]
    assert np.allclose(got["rmse"], want, rtol=1e-9)


def test_top_items_never_rated_and_all_when_few(spark, pattern):
    df = spark.createDataFrame(pattern)
    heavy = rec.most_active(df)
    user = heavy.first()["user_id"]
    got = rec.recommend_by_bias(df, heavy, 1000).toPandas()
    rated = set(pattern[pattern["user_id"] == user]["item_id"])
    everything = set(pattern["item_id"])
    assert set(got["item_id"]) == everything - rated
    assert got["score"].between(1, 5).all()


def test_equal_scores_put_the_larger_item_first(spark):
    scores = spark.createDataFrame([(1, i, 3.0) for i in range(5)], "user_id long, item_id long, score double")
    seen = spark.createDataFrame([(1, 4)], "user_id long, item_id long")
    got = rec.top_items(scores, seen, 2).orderBy("rank").toPandas()
    assert list(got["item_id"]) == [3, 2]


def test_bias_recommendations_of_all_users_match_dense_scores(spark, halves):
    train, _ = halves
    got = rec.recommend_by_bias(train, train.select("user_id"), 3).toPandas()
    pairs = train.select("user_id").distinct().crossJoin(train.select("item_id").distinct())
    every = rec.bias_predict(train, pairs).toPandas()
    seen = set(map(tuple, train.select("user_id", "item_id").toPandas().to_numpy()))
    every = every[[tuple(p) not in seen for p in every[["user_id", "item_id"]].to_numpy()]]
    best = every.sort_values(["user_id", "predicted", "item_id"], ascending=[True, False, False]).groupby("user_id").head(3)
    a, b = (d[["user_id", "item_id"]].to_numpy().tolist() for d in (got.sort_values(["user_id", "rank"]), best))
    assert a == b


def test_long_ids_give_the_same_factors(spark, halves):
    train, test = halves
    far = {"user_id": F.col("user_id") + 5_000_000_000, "item_id": F.col("item_id") + 7_000_000_000}
    near = rec.factor_predict(rec.factor_fit(train, rank=3, iterations=3), train, test)
    model = rec.factor_fit(train.withColumns(far), rank=3, iterations=3)
    moved = rec.factor_predict(model, train.withColumns(far), test.withColumns(far))
    a, b = (d.orderBy("user_id", "item_id").toPandas()["predicted"] for d in (near, moved))
    assert np.allclose(a, b, atol=0.2) and b.between(1, 5).all()
    assert rec.recommend_by_factors(model, train.withColumns(far), train.withColumns(far), 2).count() == 80


def test_factor_recommendations_match_dense_scores(spark, halves):
    train, _ = halves
    model = rec.factor_fit(train, rank=3, iterations=5)
    got = rec.recommend_by_factors(model, train, train.select("user_id"), 3).toPandas()
    pairs = train.select("user_id").distinct().crossJoin(train.select("item_id").distinct())
    every = rec.factor_predict(model, train, pairs).toPandas()
    seen = set(map(tuple, train.select("user_id", "item_id").toPandas().to_numpy()))
    every = every[[tuple(p) not in seen for p in every[["user_id", "item_id"]].to_numpy()]]
    best = every.sort_values(["user_id", "predicted", "item_id"], ascending=[True, False, False]).groupby("user_id").head(3)
    a = got.sort_values(["user_id", "rank"])["score"].to_numpy()
    assert np.allclose(a, best.sort_values(["user_id", "predicted"], ascending=[True, False])["predicted"], atol=1e-5)
    assert not seen & set(map(tuple, got[["user_id", "item_id"]].to_numpy()))


@pytest.mark.parametrize("block,kept,per_group", [(4096, 1024, 8192), (3, 100, 7), (4, 2, 5), (1, 1, 1000)])
def test_bias_recommendations_need_few_items(spark, pattern, block, kept, per_group):
    """Blocks of a few items, short lists before them (many users fall back), scores at both bounds."""
    rng = np.random.default_rng(3)
    wide = pattern.assign(rating=np.clip(pattern["rating"] + rng.choice([-3, 0, 3], len(pattern)), 1, 5))
    wide = pd.concat([wide, pd.DataFrame({"user_id": [90] * 5 + [91] * 5, "item_id": [0, 1, 2, 3, 4] * 2, "rating": [5.0] * 5 + [1.0] * 5})])
    train = spark.createDataFrame(wide)
    mean = wide["rating"].mean()
    user, item = (wide.groupby(c)["rating"].mean() - mean for c in ("user_id", "item_id"))
    people = spark.createDataFrame([(int(u),) for u in [*user.index, 999]], "user_id long")
    got = rec.recommend_by_bias(train, people, 4, block, kept, per_group).toPandas()
    seen = set(zip(wide["user_id"], wide["item_id"]))
    want = []
    for u in [*user.index, 999]:
        scores = [(np.clip(mean + user.get(u, 0.0) + b, 1, 5), i) for i, b in item.items() if (u, i) not in seen]
        want += [(u, i, k + 1) for k, (_, i) in enumerate(sorted(((round(s, 9), i) for s, i in scores), reverse=True)[:4])]
    assert sorted(zip(got["user_id"], got["item_id"], got["rank"])) == sorted(want)


def test_shortlists_equal_brute_force(spark):
    """Items in several batches and steps, users in several groups, many scores at a bound; ``n`` rows for a user."""
    rng = np.random.default_rng(8)
    users, items, n = 1300, 11_000, 4
    u, v = rng.normal(0, 0.6, (users, 3)).astype("float32"), rng.normal(0, 0.6, (items, 3)).astype("float32")
    base, bias = rng.choice([0.5, 2.5, 4.0], users), rng.normal(0, 0.5, items).round(2)
    base[7] = -20.0  # all scores at the lower bound
    at, it = rng.integers(0, users, 30_000), rng.integers(0, items, 30_000)
    at[:3000], it[:3000] = 5, np.arange(items - 3000, items)
    people = pd.DataFrame({"user_id": np.arange(users) * 7, "base": base, "features": u.tolist()})
    catalog = pd.DataFrame({"item_id": np.arange(items) - 50, "item_bias": bias, "features": v.tolist()})
    people, catalog = (spark.createDataFrame(d).withColumn("features", F.col("features").cast("array<float>")) for d in (people, catalog))
    nameless = spark.createDataFrame([(None, 9.0, [0.0, 0.0, 0.0])], catalog.schema)
    seen = spark.createDataFrame(pd.DataFrame({"user_id": at * 7, "item_id": it - 50}))
    got = rec.blocked_scores(people, catalog.unionByName(nameless), seen, n).toPandas()
    assert len(got) == users * n
    score = np.clip(u.astype(float) @ v.astype(float).T + base[:, None] + bias[None, :], 1, 5)
    score[at, it] = -np.inf
    score = np.concatenate([np.clip(base + 9, 1, 5)[:, None], score], axis=1)  # the lowest id
    want = items - np.argsort(-score[:, ::-1], axis=1, kind="stable")[:, :n] - 51
    got["item_id"] = got["item_id"].fillna(-51).astype(int)
    got = got.sort_values(["user_id", "score", "item_id"], ascending=[True, False, False])
    assert (got["item_id"].to_numpy().reshape(users, n) == want).all()
    assert np.allclose(got["score"].to_numpy().reshape(users, n), -np.sort(-score, axis=1)[:, :n])
