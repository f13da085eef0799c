"""Vector queries: class statistics, projections, clustering, anomaly detection."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
import numpy as np
from pyspark.sql import functions as F

from lumenframe.operators import anomaly, cluster, features, sampling, stats
from lumenframe.operators import evaluate as ev
from lumenframe.operators import models as ml
from lumenframe.operators.ordered import with_running
from lumenframe.plans.registry import query
from lumenframe.plans.sales import rfm_table, rounded
from lumenframe.plans.views import LISTINGS, RFM, SERIES, listings, series, split_key_sql, vectors
from lumenframe.session import checkpoint
from lumenframe.sources.readers import read_table

KEY = split_key_sql("vec_id")


def as_features(df):
    return df.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))


@query(
    "e16_anova_top6",
    """WITH l AS (SELECT label, CAST(unnest(range(64)) AS INTEGER) AS feature,
        CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
    g AS (SELECT feature, label, count(*) AS n, avg(v) AS m, var_pop(v) AS s FROM l GROUP BY ALL),
    w AS (SELECT feature, avg(v) AS mm FROM l GROUP BY feature),
    f AS (SELECT g.feature, (sum(n * (m - mm) ** 2) / (count(*) - 1)) / (sum(n * s) / (sum(n) - count(*))) AS f_score
      FROM g JOIN w ON g.feature = w.feature GROUP BY g.feature)
    SELECT feature, round(f_score, 6) AS f_score FROM f ORDER BY f.f_score DESC, feature LIMIT 6""",
)
def e16_anova_top6(spark, sf):
    long = vectors(spark, sf).select(
        "label", F.posexplode(F.col("embedding").cast("array<double>")).alias("feature", "value")
    )
    scores = stats.anova_f(long, "feature", "value", "label")
    return rounded(scores.orderBy(F.desc("f_score"), "feature").limit(6), 6, "f_score")


@query(
    "e19_mean_vector",
    """WITH l AS (SELECT CAST(unnest(range(64)) AS INTEGER) AS position, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
    SELECT position, round(avg(v), 8) AS mean FROM l GROUP BY position""",
)
def e19_mean_vector(spark, sf):
    return rounded(stats.mean_vector(vectors(spark, sf), "embedding"), 8, "mean")


@query(
    "f3_label_codes",
    """WITH c AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM documents))
    SELECT doc_id, source, code FROM documents JOIN c USING (source)""",
)
def f3_label_codes(spark, sf):
    return features.label_codes(read_table(spark, sf, "documents").select("doc_id", "source"), "source")


@query(
    "f6_unit_length",
    """WITH n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) ** 2))) + 1e-10 AS s
      FROM embeddings)
    SELECT vec_id AS id, CAST(unnest(range(64)) AS INTEGER) AS position, round(CAST(unnest(embedding) AS DOUBLE) / s, 6) + 0 AS unit FROM n""",
)
def f6_unit_length(spark, sf):
    df = features.unit_length(vectors(spark, sf), "embedding")
    df = df.select("id", F.posexplode("unit").alias("position", "unit"))
    return rounded(df, 6, "unit")


@query(
    "f1_standardize_vectors",
    f"""WITH l AS (SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS position, CAST(unnest(embedding) AS DOUBLE) AS v,
        {KEY} >= 858993459 AS train FROM embeddings),
      m AS (SELECT position, avg(v) AS mean, stddev_pop(v) AS std FROM l WHERE train GROUP BY position)
    SELECT vec_id AS id, l.position, round((v - mean) / CASE WHEN std = 0 THEN 1 ELSE std END, 6) + 0 AS scaled
    FROM l JOIN m ON l.position = m.position""",
)
def f1_standardize_vectors(spark, sf):
    df = sampling.hash_split(vectors(spark, sf), "id")
    scaled = features.standardize_array(df, "embedding", train=df.filter("split = 'train'"))
    long = scaled.select("id", F.posexplode("embedding").alias("position", "scaled"))
    return rounded(long, 6, "scaled")


STANDARD = f"""{LISTINGS}, z AS (SELECT id, (price - avg(price) OVER ()) / stddev_pop(price) OVER () AS a,
    (quantity - avg(quantity) OVER ()) / stddev_pop(quantity) OVER () AS b FROM listings),
  c AS (SELECT var_samp(a) AS va, var_samp(b) AS vb, covar_samp(a, b) AS ab FROM z),
  e AS (SELECT *, (va + vb + sqrt((va - vb) ** 2 + 4 * ab ** 2)) / 2 AS l1,
    (va + vb - sqrt((va - vb) ** 2 + 4 * ab ** 2)) / 2 AS l2 FROM c)"""


def plane(spark, sf):
    df = features.standardize(listings(spark, sf).select("id", "price", "quantity"), ["price", "quantity"])
    return ml.assembled(df, ["price", "quantity"])


@query(
    "f4_pca_projection",
    f"""WITH {STANDARD} SELECT id, round(abs((a * ab + b * (l1 - va)) / sqrt(ab ** 2 + (l1 - va) ** 2)), 6) AS first
    FROM z, e""",
)
def f4_pca_projection(spark, sf):
    """Distance along the first axis; the sign of an axis is arbitrary."""
    df = plane(spark, sf)
    model = features.fit_pca(df, "features", 2)
    return model.transform(df).select("id", F.round(F.abs(vector_to_array("components")[0]), 6).alias("first"))


@query(
    "f5_explained_variance_plane",
    f"""WITH {STANDARD} SELECT CAST(1 AS INTEGER) AS component, round(l1 / (l1 + l2), 6) AS ratio,
      round(l1 / (l1 + l2), 6) AS cumulative FROM e
    UNION ALL SELECT 2, round(l2 / (l1 + l2), 6), 1.0 FROM e""",
)
def f5_explained_variance_plane(spark, sf):
    model = features.fit_pca(plane(spark, sf), "features", 2)
    return rounded(features.explained_variance(spark, model), 6, "ratio", "cumulative")


@query("f5_explained_variance")
def f5_explained_variance(spark, sf):
    """Share and running share of 30 components of the vectors."""
    model = features.fit_pca(as_features(vectors(spark, sf)), "features", 30)
    return features.explained_variance(spark, model)


@query(
    "w8_running_total",
    f"""WITH {SERIES} SELECT series, event_id, round(sum(coalesce(value, 0)) OVER (
      PARTITION BY series ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS running FROM series""",
)
def w8_running_total(spark, sf):
    df = series(spark, sf).withColumn("value", F.coalesce("value", F.lit(0.0)))
    running = with_running(df, ["ts", "event_id"], {"running": "value"}, by=["series"])
    return rounded(running.select("series", "event_id", "running"), 2, "running")


@query(
    "w9_first_reaching",
    f"""WITH {RFM}, r AS (SELECT sum(monetary) OVER (ORDER BY monetary DESC, customer_id ROWS UNBOUNDED PRECEDING) AS s,
      sum(monetary) OVER () AS t FROM rfm)
    SELECT least(count(*) FILTER (s < 0.8 * t) + 1, count(*)) AS needed FROM r""",
)
def w9_first_reaching(spark, sf):
    df = rfm_table(spark, sf)
    return features.first_reaching(df, "monetary", [F.desc("monetary"), F.col("customer_id")], 0.8)


# --- clustering -------------------------------------------------------------------------

CENTERS = ((-0.5, 0.8, 0.8), (1.5, -0.9, -0.9), (-0.4, -0.6, -0.6), (0.2, 0.1, 0.3))


@query(
    "k1_assign_clusters",
    f"""WITH {RFM}, z AS (SELECT customer_id,
      (recency - avg(recency) OVER ()) / stddev_pop(recency) OVER () AS a,
      (frequency - avg(frequency) OVER ()) / stddev_pop(frequency) OVER () AS b,
      (monetary - avg(monetary) OVER ()) / stddev_pop(monetary) OVER () AS c FROM rfm),
    d AS (SELECT customer_id, ["""
    + ", ".join(f"(a - ({x})) ** 2 + (b - ({y})) ** 2 + (c - ({z})) ** 2" for x, y, z in CENTERS)
    + "] AS d FROM z) SELECT customer_id, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster FROM d",
)
def k1_assign_clusters(spark, sf):
    df, names = rfm_scaled(spark, sf)
    return df.select("customer_id", cluster.nearest_center(names, CENTERS).alias("cluster"))


def rfm_scaled(spark, sf):
    names = ["recency", "frequency", "monetary"]
    return features.standardize(rfm_table(spark, sf), names), names


SCALED = f"""{RFM}, z AS (SELECT customer_id,
  (recency - avg(recency) OVER ()) / stddev_pop(recency) OVER () AS a,
  (frequency - avg(frequency) OVER ()) / stddev_pop(frequency) OVER () AS b,
  (monetary - avg(monetary) OVER ()) / stddev_pop(monetary) OVER () AS c FROM rfm)"""


@query(
    "k1_one_step",
    f"WITH {SCALED}, d AS (SELECT *, ["
    + ", ".join(f"(a - ({x})) ** 2 + (b - ({y})) ** 2 + (c - ({z})) ** 2" for x, y, z in CENTERS)
    + """] AS d FROM z) SELECT CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster, count(*) AS n,
      round(avg(a), 6) + 0 AS x, round(avg(b), 6) + 0 AS y, round(avg(c), 6) + 0 AS z FROM d GROUP BY ALL""",
)
def k1_one_step(spark, sf):
    """The step that all fits take in one pass: means and sizes of the rows nearest to given centres."""
    df, names = rfm_scaled(spark, sf)
    sums = cluster.step(ml.assembled(df, names), np.array(CENTERS))
    rows = [(k, int(r[-2]), *(float(v) for v in r[:3] / r[-2])) for k, r in enumerate(sums) if r[-2]]
    table = spark.createDataFrame(rows, "cluster int, n long, x double, y double, z double")
    return rounded(table, 6, "x", "y", "z")


@query("k1_kmeans")
def k1_kmeans(spark, sf):
    df, names = rfm_scaled(spark, sf)
    rows = ml.assembled(df, names)
    model = cluster.fit_kmeans(rows, 4, restarts=10)
    return model.transform(rows).select("customer_id", "cluster")


@query("k2_elbow")
def k2_elbow(spark, sf):
    df, names = rfm_scaled(spark, sf)
    return cluster.elbow(df, names, range(1, 11), restarts=10)


# --- anomaly detection ------------------------------------------------------------------

LOF = f"""x AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, {KEY} < 858993459 AS test FROM embeddings),
  d AS (SELECT q.id AS q, q.test AS test, p.id AS p, list_distance(q.v, p.v) AS dist FROM x q JOIN x p ON NOT p.test AND p.id <> q.id),
  nn AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY q ORDER BY round(dist, 12), p) <= 20),
  kd AS (SELECT q AS p, max(dist) AS kd FROM nn WHERE NOT test GROUP BY q),
  lrd AS (SELECT q, any_value(test) AS test, 1 / (avg(greatest(dist, kd)) + 1e-10) AS lrd FROM nn JOIN kd USING (p) GROUP BY q),
  lof AS (SELECT nn.q AS id, avg(o.lrd) / any_value(s.lrd) AS score FROM nn JOIN lrd o ON o.q = nn.p
    JOIN lrd s ON s.q = nn.q WHERE nn.test GROUP BY nn.q)"""


def train_test(spark, sf):
    df = sampling.hash_split(vectors(spark, sf), "id")
    return df.filter("split = 'train'").drop("split"), df.filter("split = 'test'").drop("split")


@query("k5_outlier_factor", f"WITH {LOF} SELECT id, round(score, 6) AS score FROM lof")
def k5_outlier_factor(spark, sf):
    train, test = train_test(spark, sf)
    return rounded(anomaly.outlier_factor(train, test, "id", "embedding", 20, block_rows=1024), 6, "score")


@query("k5_outlier_factor_candidates")
def k5_outlier_factor_candidates(spark, sf):
    train, test = train_test(spark, sf)
    found = anomaly.outlier_factor(train, test, "id", "embedding", 20, candidates=anomaly.Candidates())
    return rounded(found, 6, "score")


@query("k5_neighbour_recall")
def k5_neighbour_recall(spark, sf):
    """Twenty neighbours of every test vector from the buckets: the share of the exact ones."""
    train, test = train_test(spark, sf)
    exact = anomaly.nearest_neighbours(test, train, "id", "embedding", 20)
    return anomaly.neighbour_recall(anomaly.approximate_neighbours(test, train, "id", "embedding", 20), exact)


@query("k4_isolation_forest")
def k4_isolation_forest(spark, sf):
    train, test = train_test(spark, sf)
    forest = anomaly.fit_isolation_forest(train, "id", "embedding")
    return anomaly.isolation_score(test, forest, "embedding").select("id", "y", "score")


@query("k6_one_class")
def k6_one_class(spark, sf):
    train, test = train_test(spark, sf)
    model = anomaly.fit_one_class(train, "embedding")
    return anomaly.one_class_score(test, model, "embedding").select("id", "y", "score")


def event_features(spark, sf):
    """Numbers of an event for the detectors: value, its logarithm, time of day and user activity share."""
    events = read_table(spark, sf, "events")
    angle = F.hour("ts") * 0.2617993877991494
    return events.select(
        F.col("event_id").alias("id"),
        (F.col("event_id") % 581 == 0).cast("int").alias("y"),
        F.array("value", F.log1p("value"), F.sin(angle), F.cos(angle)).alias("x"),
    )


@query("v13_detector_report")
def v13_detector_report(spark, sf):
    """Isolation forest, outlier factor, one-class machine and weighted logistic regression on the events, one report."""
    df = sampling.random_split(event_features(spark, sf), "id", by=["y"])
    names = [f"x{i}" for i in range(4)]
    df = df.select("id", "y", "split", *[F.col("x")[i].alias(n) for i, n in enumerate(names)])
    df = features.standardize(df, names, train=df.filter("split = 'train'")).withColumn("x", F.array(*names))
    df = checkpoint(df)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    forest = anomaly.fit_isolation_forest(train, "id", "x")
    machine = anomaly.fit_one_class(train, "x")
    weighted = ml.balanced_weights(ml.assembled(train, names), "y")
    logit = ml.logistic(weighted, label="y", weight="weight", iterations=50).fit(weighted)
    factor = anomaly.outlier_factor(train, test, "id", "x", 20, candidates=anomaly.Candidates())
    parts = [
        test.join(factor, "id").select(F.lit("outlier_factor").alias("method"), "id", "y", "score"),
        anomaly.isolation_score(test, forest, "x").select(F.lit("isolation_forest").alias("method"), "id", "y", "score"),
        anomaly.one_class_score(test, machine, "x").select(F.lit("one_class").alias("method"), "id", "y", "score"),
        ml.scored(logit, ml.assembled(test, names)).select(
            F.lit("logistic").alias("method"), "id", "y", F.col("positive").alias("score")
        ),
    ]
    return ev.ranking_report(ml.union_all(parts), "y", "score", "id", ["method"])
