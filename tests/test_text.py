"""Cleaning, stemming, TF-IDF, naive Bayes, topics, live scoring."""

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from lumenframe.functions import text as tx
from lumenframe.functions.stemming import make_stemmer
from lumenframe.functions.stopwords import ENGLISH
from lumenframe.operators import factorization as fac
from lumenframe.operators import models as ml
from lumenframe.operators import texts, topics
from lumenframe.sources.writers import load_model, save_model
from lumenframe.streaming import live_scoring as live

STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubling": "troubl",
    "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz",
    "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit",
    "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal", "sensitiviti": "sensit",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "electrical": "electr",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "adjustable": "adjust", "replacement": "replac", "adoption": "adopt", "effective": "effect",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "dying": "die", "news": "news", "proceed": "proceed", "say": "say", "enjoy": "enjoy", "died": "die",
}


def test_stems():
    stem = make_stemmer()
    assert {w: stem(w) for w in STEMS} == STEMS


TEXTS = [
    "A <b>Great</b> movie!!! I loved it, really loved the acting &amp; story.",
    "Terrible... boring plot; the WORST film of 2010",
    None,
    "",
    "<p>123</p>",
]


def python_clean(text):
    text = re.sub(r"[^a-zA-Z\s]", "", re.sub(r"<[^>]+>", " ", text).lower())
    return " ".join(t for t in text.split() if t not in ENGLISH and len(t) > 2)


def test_cleaning_matches_plain_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, text string")
    got = {r["id"]: r["c"] for r in df.select("id", tx.cleaned("text", stem=False).alias("c")).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == (None if t is None else python_clean(t))
    stemmed = [r["c"] for r in df.orderBy("id").select(tx.cleaned("text").alias("c")).collect()]
    assert stemmed[0] == "great movi love realli love act amp stori" and stemmed[2] is None


def test_bigrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(tx.one_and_two_grams(F.col("t"))).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["a"], []]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(2)
    good, bad = "good great fine lovely happy".split(), "bad awful poor boring sad".split()
    common = "film plot actor scene music".split()
    rows = []
    for i in range(120):
        label = i % 2
        words = list(rng.choice(good if label else bad, 6)) + list(rng.choice(common, 6))
        rows.append((i, " ".join(words), label))
    return spark.createDataFrame(rows, "doc_id long, text string, label int").cache()


@pytest.fixture(scope="module")
def weights(corpus):
    counts = texts.term_counts(corpus, "doc_id", tx.word_tokens("text"))
    words = texts.vocabulary(counts, corpus, 100, 2, 0.95)
    return counts, words, texts.tfidf(counts, words, corpus).cache()


def test_tfidf_rows_have_unit_length_and_smooth_idf(weights, corpus):
    counts, words, w = weights
    pdf = w.toPandas()
    assert np.allclose(pdf.groupby("doc_id")["weight"].apply(lambda v: (v**2).sum()), 1)
    df = dict(words.select("term", "df").toPandas().to_numpy())
    n = corpus.count()
    one = pdf[pdf["doc_id"] == 0].copy()
    raw = one["tf"] * one["term"].map(lambda t: math.log((1 + n) / (1 + df[t])) + 1)
    assert np.allclose(one["weight"], raw / math.sqrt((raw**2).sum()))


def test_vectorizer_pipeline_equals_long_weights(corpus, weights):
    prepared = corpus.withColumn("terms", tx.word_tokens("text"))
    model = texts.fit_vectorizer(prepared, 100, 2.0, 0.95)
    vocabulary = model.stages[0].vocabulary
    row = model.transform(prepared).filter("doc_id = 0").first()["features"]
    long = {r["term"]: r["weight"] for r in weights[2].filter("doc_id = 0").collect()}
    assert {vocabulary[i]: pytest.approx(v) for i, v in zip(row.indices, row.values)} == long


def test_naive_bayes_matches_numpy(corpus, weights):
    w = weights[2].join(corpus.select("doc_id", "label"), "doc_id")
    terms, classes = texts.naive_bayes_fit(w, "label", corpus)
    got = texts.naive_bayes_predict(w, terms, classes, corpus).orderBy("doc_id").toPandas()
    m = w.toPandas().pivot(index="doc_id", columns="term", values="weight").fillna(0)
    y = corpus.orderBy("doc_id").toPandas()["label"].to_numpy()
    mass = np.stack([m[y == c].sum().to_numpy() for c in (0, 1)])
    log_p = np.log((mass + 1) / (mass.sum(1, keepdims=True) + m.shape[1]))
    joint = m.to_numpy() @ log_p.T + np.log(np.bincount(y) / len(y))
    assert np.allclose(got["score"], joint.max(1)) and (got["prediction"] == joint.argmax(1)).all()


def test_documents_without_known_terms_stay(spark, corpus, weights):
    """They get the class with the highest prior, and zero topic weights."""
    counts, words, w = weights
    extra = spark.createDataFrame([(1000, "unheard of", 1), (1001, None, 1)], "doc_id long, text string, label int")
    both = corpus.unionByName(extra)
    labelled = w.join(corpus.select("doc_id", "label"), "doc_id")
    terms, classes = texts.naive_bayes_fit(labelled, "label", both)
    got = texts.naive_bayes_predict(labelled, terms, classes, both).toPandas().set_index("doc_id")
    assert len(got) == 122 and (got.loc[[1000, 1001], "prediction"] == 1).all()
    assert np.allclose(got.loc[[1000, 1001], "score"], math.log(62 / 122))
    listed = words.toPandas().sort_values("term").reset_index(drop=True)
    listed["index"] = np.arange(len(listed), dtype="int32")
    rows = fac.document_rows(w, spark.createDataFrame(listed[["term", "index"]]), both)
    h, _ = fac.fit_nmf(rows, len(listed), 3, iterations=2)
    components, _ = fac.fit_lsa(rows, len(listed), 3, iterations=2)
    for table in (fac.nmf_documents(rows, h), fac.lsa_documents(rows, components)):
        topics_of = table.toPandas().set_index("doc_id")["topics"]
        assert len(topics_of) == 122 and np.allclose(np.stack(topics_of.loc[[1000, 1001]]), 0)


@pytest.fixture(scope="module")
def factor_input(spark, corpus, weights):
    counts, words, w = weights
    listed = words.toPandas().sort_values("term").reset_index(drop=True)
    listed["index"] = np.arange(len(listed), dtype="int32")
    rows = fac.document_rows(w, spark.createDataFrame(listed[["term", "index"]]), corpus)
    dense = np.zeros((120, len(listed)))
    at = dict(zip(listed["term"], listed["index"]))
    for r in w.collect():
        dense[r["doc_id"], at[r["term"]]] = r["weight"]
    return rows, listed, dense


def test_nmf_loss_never_rises(factor_input):
    rows, listed, dense = factor_input
    h, losses = fac.fit_nmf(rows, len(listed), 3, iterations=8)
    assert all(b <= a * 1.001 for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0]
    assert (h >= 0).all()
    w = np.stack(fac.nmf_documents(rows, h).toPandas().sort_values("doc_id")["topics"])
    assert ((dense - w @ h) ** 2).sum() <= losses[-1] * 1.01


def test_lsa_matches_numpy_svd(factor_input):
    rows, listed, dense = factor_input
    components, values = fac.fit_lsa(rows, len(listed), 3, iterations=6)
    _, want, vt = np.linalg.svd(dense, full_matrices=False)
    assert np.allclose(values, want[:3], rtol=1e-3)
    assert abs(abs(components[0] @ vt[0]) - 1) < 1e-4
    docs = np.stack(fac.lsa_documents(rows, components).toPandas()["topics"])
    assert np.allclose(np.linalg.norm(docs, axis=1), 1)


def test_coherence_matches_loops(spark, weights):
    counts, _, _ = weights
    rng = np.random.default_rng(4)
    terms = sorted(r["term"] for r in counts.select("term").distinct().collect()) + ["never", "absent"]
    table = pd.DataFrame([(t, w, float(rng.random())) for t in range(3) for w in terms], columns=["topic", "term", "weight"])
    got = topics.coherence(spark.createDataFrame(table), counts, 5).toPandas().set_index("topic")["coherence"]
    docs = counts.toPandas().groupby("term")["doc_id"].apply(set).to_dict()
    for t in range(3):
        top = table[table["topic"] == t].sort_values(["weight", "term"], ascending=[False, True])["term"].head(5).tolist()
        pairs = [
            len(docs.get(a, set()) & docs.get(b, set())) / len(docs[a])
            for i, a in enumerate(top)
            for b in top[i + 1 :]
            if docs.get(a)
        ]
        assert got[t] == pytest.approx(np.mean(pairs) if pairs else 0.0)


def test_dominant_topic_takes_the_lowest_on_a_tie(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.1, 0.2, 0.7],)], "d array<double>")
    assert [r["topic"] for r in topics.dominant_topic(df, "d").collect()] == [0, 2]


def test_stream_scores_equal_batch_scores_and_the_model_survives_saving(spark, corpus, tmp_path):
    prepared = texts.prepared(corpus)
    vectorizer = texts.fit_vectorizer(prepared, 200, 1.0, 1.0)
    model = Pipeline(stages=[*vectorizer.stages, ml.logistic(prepared)]).fit(prepared)
    model = load_model(spark, save_model(model, str(tmp_path / "model")))
    corpus.select("doc_id", "text").repartition(3).write.json(str(tmp_path / "in"))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):  # the second run finds nothing new
        live.start_scoring(model, live.incoming_texts(spark, str(tmp_path / "in"), 1), out, progress).awaitTermination()
    got = spark.read.parquet(out).orderBy("doc_id").toPandas()
    want = live.score_texts(model, corpus).orderBy("doc_id").toPandas()
    pd.testing.assert_frame_equal(got, want)
    assert (got["prediction"] == corpus.orderBy("doc_id").toPandas()["label"]).mean() > 0.9


@pytest.mark.parametrize("least,most", [(2.0, 0.8), (0.3, 0.6), (0.1, 0.15), (1.0, 1.0)])
def test_document_limits_reach_spark_as_numbers(spark, least, most):
    """As with shares, but Spark does not store the terms of all documents to count these."""
    from pyspark.ml.feature import CountVectorizer

    rows = [([f"w{k}" for k in range(10) if d >= k],) for d in range(10)]
    docs = spark.createDataFrame(rows, "terms array<string>")
    plain = CountVectorizer(inputCol="terms", outputCol="n", vocabSize=50, minDF=least)
    plain = plain.setMaxDF(most) if most < 1.0 else plain
    ours = texts.counting_vectorizer(docs, "terms", "n", 50, least, most)
    assert ours.getMinDF() >= 1.0 and ours.getMaxDF() >= 1.0
    assert sorted(ours.fit(docs).vocabulary) == sorted(plain.fit(docs).vocabulary)


def test_documents_of_an_arrow_batch_lie_end_to_end():
    rows = {"index": pa.array([[2, 5], [], [1]], pa.list_(pa.int32())), "weight": pa.array([[0.5, 1.0], [], [2.0]])}
    index, weight, owner = fac.flat_batch()(pa.RecordBatch.from_pydict(rows).slice(1))
    assert (index.tolist(), weight.tolist(), owner.tolist()) == ([1], [2.0], [1])


def test_coherence_compares_whole_fits(spark, tmp_path, monkeypatch):
    from lumenframe.plans import training

    rows = [(k, " ".join(["apple pear plum", "engine wheel brake"][k % 2].split()[: 2 + k % 3 // 2]), "en", "s", 9) for k in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    asked = {}

    def noted(name, fit):
        def run(rows, size, k, iterations):
            asked[name] = iterations
            return fit(rows, size, min(k, 2), iterations=2)

        return run

    for name in ("fit_nmf", "fit_lsa"):
        monkeypatch.setattr(training.fac, name, noted(name, getattr(fac, name)))
    got = training.t6_model_coherence(spark, str(tmp_path))
    assert got.count() == 2 and asked == {"fit_nmf": 500, "fit_lsa": 20}


def test_small_sums_of_a_pass_meet_on_the_driver_alike(spark, monkeypatch):
    rows = spark.createDataFrame([(k, [k % 3, 3 + k % 2], [1.0 + k, 2.0]) for k in range(40)], "doc_id long, index array<int>, weight array<double>")
    rows = rows.repartition(3).cache()
    direct = fac.fit_nmf(rows, 5, 2, iterations=4)
    monkeypatch.setattr(fac, "DIRECT_BYTES", 0)
    dealt = fac.fit_nmf(rows, 5, 2, iterations=4)
    assert np.allclose(direct[0], dealt[0]) and np.allclose(direct[1], dealt[1])
