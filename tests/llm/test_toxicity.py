import random

import numpy as np

from lumenframe.llm import queries
from lumenframe.llm import toxicity as X


def test_probabilities_sum_to_one():
    words = np.array([9, 3, 5], dtype=np.uint64)
    models = X.fit_models(words, np.array([[4.0, 0, 1], [2.0, 7, 0]]))
    assert np.allclose(models.prob.sum(axis=1), 1) and (models.prob > 0).all()
    nothing = X.fit_models(words[:0], np.zeros((2, 0)))
    assert X.log_ratios(words, nothing).tolist() == [0, 0, 0]


def test_a_copied_passage_counts_once_and_a_rare_word_weighs_alike():
    words = np.arange(1, 5, dtype=np.uint64)
    models = X.fit_models(words, np.array([[30.0, 1, 20, 20], [0.0, 0, 20, 20]]))
    ratio = dict(zip(words.tolist(), X.log_ratios(words, models), strict=True))
    assert ratio[1] > 3 * abs(ratio[2]) and abs(ratio[3]) < 0.6


def test_held_out_documents(spark, tmp_path):
    rng = random.Random(4)
    plain = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(900):
        toxic = k % 5 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(5, 200))]
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["VILE", "rotten,", "nasty!"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    labels += [(5000, 1), (3, None), (None, 1)]
    spark.createDataFrame([*rows, (901, None), (902, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r for r in queries.op8_toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == 902 and all(0 <= r["score"] <= 1 for r in got.values())
    held = [(r["predicted"], dict(labels)[k]) for k, r in got.items() if r["held_out"] and k < 900]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = X.remove_toxic(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert kept.columns == docs.columns and 690 < kept.count() < 750


def test_odd_rows(spark, odd_docs, no_docs):
    for labels in ([(1, 1), (4, 0)], [(k, 0) for k in range(10)], [], [(1, 1), (1, 0)]):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        scored, name = X.score_toxicity(odd_docs, table)
        assert name != "toxicity" and all(0 <= r[name]["score"] <= 1 for r in scored.collect())
        if not any(y for _, y in labels):
            assert X.remove_toxic(odd_docs, table).count() == odd_docs.count()
    assert X.score_toxicity(no_docs, table)[0].count() == 0
