"""Recommender queries over the rating table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import evaluate as ev
from lumenframe.operators import recommend as rec
from lumenframe.operators import sampling, stats
from lumenframe.operators.joins import lookup, without
from lumenframe.plans.registry import query
from lumenframe.plans.sales import rounded
from lumenframe.plans.views import RATINGS, ratings, split_key_sql
from lumenframe.session import checkpoint
from lumenframe.sources.readers import read_table

KEY = split_key_sql("user_id * 1000003 + item_id")
SPLIT = RATINGS + f""",
train AS (SELECT * FROM ratings WHERE {KEY} >= 858993459),
test AS (SELECT * FROM ratings WHERE {KEY} < 858993459)"""
BIAS = (
    SPLIT
    + """, mu AS (SELECT avg(rating) AS mu FROM train),
bu AS (SELECT user_id, avg(rating) - (SELECT mu FROM mu) AS user_bias FROM train GROUP BY user_id),
bi AS (SELECT item_id, avg(rating) - (SELECT mu FROM mu) AS item_bias FROM train GROUP BY item_id)"""
)


def split(spark, sf):
    """Train and test ratings, split by a hash of the pair; written once, since several steps read them."""
    both = ratings(spark, sf).withColumn("_pair", F.col("user_id") * 1000003 + F.col("item_id"))
    both = checkpoint(sampling.hash_split(both, "_pair").drop("_pair"))
    return [both.filter(F.col("split") == s).drop("split") for s in ("train", "test")]


def popularity(spark, sf):
    return ratings(spark, sf).groupBy("item_id").agg(F.count(F.lit(1)).alias("count"), F.avg("rating").alias("mean"))


@query(
    "e8_item_popularity",
    f"WITH {RATINGS} SELECT item_id, count(*) AS count, round(avg(rating), 6) AS mean FROM ratings GROUP BY item_id",
)
def e8_item_popularity(spark, sf):
    return rounded(popularity(spark, sf), 6, "mean")


@query(
    "j1_title_lookup",
    f"""WITH {RATINGS}, c AS (SELECT item_id, count(*) AS count FROM ratings GROUP BY item_id)
    SELECT item_id, count, coalesce(p_name, 'item ' || item_id) AS title
    FROM c LEFT JOIN part ON p_partkey = item_id""",
)
def j1_title_lookup(spark, sf):
    return with_title(spark, sf, popularity(spark, sf)).select("item_id", "count", "title")


def with_title(spark, sf, df):
    """Adds the title of every item; one without a title is called by its number."""
    titles = read_table(spark, sf, "part")
    titles = titles.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    default = F.concat(F.lit("item "), F.col("item_id").cast("string"))
    return lookup(df, titles, "item_id", {"title": default})


@query(
    "e10_sparsity",
    f"""WITH {RATINGS} SELECT count(*) AS n, count(DISTINCT user_id) AS rows, count(DISTINCT item_id) AS columns,
      round(1 - count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 8) AS sparsity FROM ratings""",
)
def e10_sparsity(spark, sf):
    return rounded(stats.sparsity(ratings(spark, sf), "user_id", "item_id"), 8, "sparsity")


FLAGS = ("small", "red", "blue", "economy", "large")


@query(
    "e9_flag_totals",
    "SELECT flag, CAST(total AS BIGINT) AS total FROM (UNPIVOT (SELECT "
    + ", ".join(f"count(*) FILTER (lower(p_name || ' ' || p_type) LIKE '%{f}%') AS {f}" for f in FLAGS)
    + f" FROM part) ON {', '.join(FLAGS)} INTO NAME flag VALUE total)",
)
def e9_flag_totals(spark, sf):
    text = F.lower(F.concat_ws(" ", "p_name", "p_type"))
    flags = read_table(spark, sf, "part").select(*[text.contains(f).cast("int").alias(f) for f in FLAGS])
    return stats.flag_totals(flags, FLAGS)


@query(
    "r2_matrix_margins",
    f"""WITH {RATINGS} SELECT 'user' AS axis, user_id AS id, round(avg(rating), 6) AS mean FROM ratings GROUP BY user_id
    UNION ALL SELECT 'item', item_id, round(avg(rating), 6) FROM ratings GROUP BY item_id""",
)
def r2_matrix_margins(spark, sf):
    df = ratings(spark, sf)
    parts = [
        rec.axis_means(df, f"{a}_id").select(
            F.lit(a).alias("axis"), F.col(f"{a}_id").alias("id"), F.round("mean", 6).alias("mean")
        )
        for a in ("user", "item")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "s5_most_active_user",
    f"WITH {RATINGS} SELECT user_id, count(*) AS count FROM ratings GROUP BY user_id ORDER BY count DESC, user_id LIMIT 1",
)
def s5_most_active_user(spark, sf):
    return rec.most_active(ratings(spark, sf))


@query(
    "n1_bias_fit",
    f"""WITH {BIAS} SELECT 'global' AS kind, CAST(0 AS BIGINT) AS id, round(mu, 6) AS bias FROM mu
    UNION ALL SELECT 'user', user_id, round(user_bias, 6) + 0 FROM bu
    UNION ALL SELECT 'item', item_id, round(item_bias, 6) + 0 FROM bi""",
)
def n1_bias_fit(spark, sf):
    train, _ = split(spark, sf)
    _, users, items = rec.bias_fit(train)
    whole = train.agg(F.avg("rating").alias("bias")).select(
        F.lit("global").alias("kind"), F.lit(0).cast("long").alias("id"), "bias"
    )
    parts = [
        d.select(F.lit(k).alias("kind"), F.col(f"{k}_id").alias("id"), F.col(f"{k}_bias").alias("bias"))
        for k, d in (("user", users), ("item", items))
    ]
    return rounded(whole.unionByName(parts[0]).unionByName(parts[1]), 6, "bias")


N2 = f"""{BIAS}, n2 AS (SELECT user_id, item_id, rating,
  least(greatest((SELECT mu FROM mu) + coalesce(user_bias, 0) + coalesce(item_bias, 0), 1), 5) AS predicted
  FROM test LEFT JOIN bu USING (user_id) LEFT JOIN bi USING (item_id))"""


@query("n2_bias_predict", f"WITH {N2} SELECT user_id, item_id, round(predicted, 6) AS predicted FROM n2")
def n2_bias_predict(spark, sf):
    train, test = split(spark, sf)
    return rounded(rec.bias_predict(train, test).select("user_id", "item_id", "predicted"), 6, "predicted")


@query(
    "j2_bias_lookup",
    f"""WITH {BIAS} SELECT user_id, item_id, round(coalesce(user_bias, 0), 6) + 0 AS user_bias,
      round(coalesce(item_bias, 0), 6) + 0 AS item_bias
    FROM test LEFT JOIN bu USING (user_id) LEFT JOIN bi USING (item_id)""",
)
def j2_bias_lookup(spark, sf):
    train, test = split(spark, sf)
    _, users, items = rec.bias_fit(train)
    df = lookup(test, users, "user_id", {"user_bias": F.lit(0.0)})
    df = lookup(df, items, "item_id", {"item_bias": F.lit(0.0)})
    return rounded(df.select("user_id", "item_id", "user_bias", "item_bias"), 6, "user_bias", "item_bias")


@query(
    "j3_unseen_pairs",
    f"""WITH {SPLIT}, s AS (SELECT user_id, item_id FROM train)
    SELECT r.user_id, r.item_id FROM ratings r WHERE NOT EXISTS (
      SELECT 1 FROM s WHERE s.user_id = r.user_id AND s.item_id = r.item_id)""",
)
def j3_unseen_pairs(spark, sf):
    train, test = split(spark, sf)
    return without(train.unionByName(test), train, ["user_id", "item_id"]).select("user_id", "item_id")


@query(
    "j5_cold_axes",
    f"""WITH {SPLIT}, u AS (SELECT DISTINCT user_id FROM ratings),
      t AS (SELECT user_id, avg(rating) AS m, count(*) AS n FROM train GROUP BY user_id)
    SELECT user_id, coalesce(n, 0) AS train_count, round(coalesce(m, (SELECT avg(rating) FROM train)), 6) AS base
    FROM u LEFT JOIN t USING (user_id)""",
)
def j5_cold_axes(spark, sf):
    train, test = split(spark, sf)
    users = train.select("user_id").union(test.select("user_id")).distinct()
    overall = train.agg(F.avg("rating")).scalar()
    df = lookup(users, rec.axis_means(train, "user_id"), "user_id", {"count": F.lit(0), "mean": overall})
    return df.select("user_id", F.col("count").alias("train_count"), F.round("mean", 6).alias("base"))


@query(
    "f7_centered_ratings",
    f"""WITH {RATINGS} SELECT user_id, item_id, round(rating - avg(rating) OVER (PARTITION BY user_id), 6) + 0 AS by_user,
      round(rating - avg(rating) OVER (PARTITION BY item_id), 6) + 0 AS by_item FROM ratings""",
)
def f7_centered_ratings(spark, sf):
    df = rec.deviations(ratings(spark, sf), "user_id").withColumnRenamed("dev", "by_user")
    df = rec.deviations(df, "item_id").withColumnRenamed("dev", "by_item")
    return rounded(df.select("user_id", "item_id", "by_user", "by_item"), 6, "by_user", "by_item")


def near_sql(axis: str, source: str = "train") -> str:
    """Neighbour tables ``dev`` and ``near`` of one axis."""
    other = "item_id" if axis == "user_id" else "user_id"
    return f"""dev AS (SELECT user_id, item_id, rating - avg(rating) OVER (PARTITION BY {axis}) AS dev FROM {source}),
    nrm AS (SELECT {axis}, sqrt(sum(dev * dev)) AS nrm FROM dev GROUP BY {axis}),
    w AS (SELECT dev.{axis} AS a, {other} AS c, dev / CASE WHEN nrm = 0 THEN 1 ELSE nrm END AS w
      FROM dev JOIN nrm ON dev.{axis} = nrm.{axis}),
    sims AS (SELECT x.a AS a, y.a AS b, sum(x.w * y.w) AS sim FROM w x JOIN w y ON x.c = y.c AND x.a <> y.a GROUP BY ALL),
    near AS (SELECT a, b, sim FROM sims WHERE round(abs(sim), 9) > 0
      QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(abs(sim), 9) DESC, b) <= 40)"""


@query(
    "f8_user_cosine",
    f"WITH {RATINGS}, {near_sql('user_id', 'ratings')} SELECT a, b, round(sim, 6) + 0 AS similarity FROM near",
)
def f8_user_cosine(spark, sf):
    return rounded(rec.top_neighbours(ratings(spark, sf), "user_id"), 6, "similarity")


@query(
    "j7_item_similarity",
    f"WITH {RATINGS}, {near_sql('item_id', 'ratings')} SELECT a, b, round(sim, 6) + 0 AS similarity FROM near",
)
def j7_item_similarity(spark, sf):
    return rounded(rec.top_neighbours(ratings(spark, sf), "item_id"), 6, "similarity")


def knn_sql(axis: str) -> str:
    other = "item_id" if axis == "user_id" else "user_id"
    return f"""{SPLIT}, {near_sql(axis)},
    wt AS (SELECT a, sum(abs(sim)) AS wt FROM near GROUP BY a),
    base AS (SELECT {axis}, avg(rating) AS base FROM train GROUP BY {axis}),
    fb AS (SELECT {other}, sum(dev) / (SELECT count(DISTINCT {axis}) FROM ratings) AS fb FROM dev GROUP BY {other}),
    sm AS (SELECT t.user_id, t.item_id, sum(sim * dev) AS sm FROM test t JOIN near ON near.a = t.{axis}
      JOIN dev ON dev.{axis} = near.b AND dev.{other} = t.{other} GROUP BY ALL),
    knn AS (SELECT t.user_id, t.item_id, t.rating,
      least(greatest(coalesce(base, (SELECT avg(rating) FROM train))
        + CASE WHEN coalesce(wt, 0) > 0 THEN coalesce(sm, 0) / wt ELSE coalesce(fb, 0) END, 1), 5) AS predicted
      FROM test t LEFT JOIN base USING ({axis}) LEFT JOIN wt ON wt.a = t.{axis} LEFT JOIN fb USING ({other})
      LEFT JOIN sm ON sm.user_id = t.user_id AND sm.item_id = t.item_id)"""


def neighbour(spark, sf, axis):
    train, test = split(spark, sf)
    return rec.neighbour_predict(train, test, axis)


@query("n3_user_knn", f"WITH {knn_sql('user_id')} SELECT user_id, item_id, round(predicted, 6) AS predicted FROM knn")
def n3_user_knn(spark, sf):
    return rounded(neighbour(spark, sf, "user_id").select("user_id", "item_id", "predicted"), 6, "predicted")


@query("n4_item_knn", f"WITH {knn_sql('item_id')} SELECT user_id, item_id, round(predicted, 6) AS predicted FROM knn")
def n4_item_knn(spark, sf):
    return rounded(neighbour(spark, sf, "item_id").select("user_id", "item_id", "predicted"), 6, "predicted")


@query("n5_factorization")
def n5_factorization(spark, sf):
    """Test error of the factor model next to the bias baseline."""
    train, test = split(spark, sf)
    model = rec.factor_fit(train, rank=50, iterations=25, reg=0.3)
    parts = [
        ev.regression_metrics(d, "rating", "predicted").select(F.lit(n).alias("model"), "rmse", "mae")
        for n, d in (("factors", rec.factor_predict(model, train, test)), ("bias", rec.bias_predict(train, test)))
    ]
    return parts[0].unionByName(parts[1])


@query("n6_training_curve")
def n6_training_curve(spark, sf):
    train, _ = split(spark, sf)
    return rec.training_curve(train, (1, 2, 4), rank=8)


def top_items_sql(users: str) -> str:
    return f"""WITH {BIAS}, chosen AS ({users}),
    s AS (SELECT user_id, item_id, least(greatest((SELECT mu FROM mu) + user_bias + item_bias, 1), 5) AS score
      FROM chosen JOIN bu USING (user_id), bi),
    f AS (SELECT * FROM s WHERE NOT EXISTS (
      SELECT 1 FROM train t WHERE t.user_id = s.user_id AND t.item_id = s.item_id)),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id DESC) AS INTEGER) AS rank
      FROM f QUALIFY rank <= 10)
    SELECT user_id, item_id, round(score, 6) AS score, rank, coalesce(p_name, 'item ' || item_id) AS title
    FROM r LEFT JOIN part ON p_partkey = item_id"""


def top_items(spark, sf, choose):
    train, _ = split(spark, sf)
    best = with_title(spark, sf, rec.recommend_by_bias(train, choose(train), 10))
    return rounded(best.select("user_id", "item_id", "score", "rank", "title"), 6, "score")


@query(
    "n7_top_items",
    top_items_sql("SELECT user_id FROM train GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1"),
)
def n7_top_items(spark, sf):
    return top_items(spark, sf, rec.most_active)


@query("n7_top_items_all_users", top_items_sql("SELECT DISTINCT user_id FROM train"))
def n7_top_items_all_users(spark, sf):
    return top_items(spark, sf, lambda train: train.select("user_id"))


@query("n7_top_items_by_factors")
def n7_top_items_by_factors(spark, sf):
    """Ten unseen items for every user with a training rating."""
    train, _ = split(spark, sf)
    model = rec.factor_fit(train, rank=8, iterations=3)
    return with_title(spark, sf, rec.recommend_by_factors(model, train, train.select("user_id"), 10))
