import math
import zlib
from collections import Counter

import numpy as np

from lumenframe.llm import pitman_yor as P


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def test_base_score_against_plain_counts(spark):
    texts = {k: f"the cat {k % 7} sat on the Mat {'x ' * (k % 5)}" for k in range(200)} | {200: None, 201: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in texts}
    counts = Counter(w for k, t in texts.items() if not held[k] for w in tokens(t))
    total, words = sum(counts.values()), len(counts)
    rows = {r["doc_id"]: r for r in P.score_documents(docs).collect()}
    assert set(rows) == set(texts)
    for k, t in texts.items():
        r = rows[k]
        want = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (words + 1))) for w in tokens(t))
        assert math.isclose(r["base_score"], want, abs_tol=1e-9)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens(t))
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[k], len(tokens(t)), total)
    out = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    again = {r["doc_id"]: r["score"] for r in P.score_documents(docs).collect()}
    assert all(math.isclose(again[k], rows[k]["score"], rel_tol=1e-9) for k in rows)


def test_probabilities_of_a_context_sum_to_one():
    rng = np.random.default_rng(0)
    words = np.sort(rng.integers(1, 1 << 60, 30, dtype=np.uint64))
    seq = words[np.minimum(rng.zipf(1.4, 4000), 30) - 1]
    none = np.zeros(0, dtype=np.uint64)
    rows = list(P.block_rows([seq], [1], [True], 0, 1, none))
    shard = P.Shard(0, [rows[1]], None, none)
    customers = np.bincount(shard.slot, weights=shard.counts, minlength=P.SLOTS)
    ones = np.ones(len(shard.keys))
    own = shard.by_word(ones)
    seated = (own > 0).astype(float)
    start = P.Totals(np.bincount(shard.slot, minlength=P.SLOTS).astype(float), own.sum(), seated.sum(), none, none)
    shard.corpus = P.Corpus(customers, customers.sum(), len(shard.words), 0.7, 0.4, none, none)
    history = [start]
    for g in range(1, 4):
        *_, (tables, own, seated) = shard.sweeps(history, g, 1)
        assert (tables >= 1).all() and (tables <= shard.counts).all()
        t = P.Totals(np.bincount(shard.slot, weights=tables, minlength=P.SLOTS), own.sum(), seated.sum(), none, none)
        history.append(t)
        prob = shard.parent(own, seated, t)
        assert math.isclose(prob.sum(), 1.0, rel_tol=1e-9)
        for slot in np.unique(shard.slot)[:5]:
            here = shard.slot == slot
            kept = np.zeros(len(prob))
            kept[shard.word[here]] = shard.counts[here] - 0.7 * tables[here]
            p = (kept + (P.CONCENTRATION + 0.7 * t.tables[slot]) * prob) / (P.CONCENTRATION + customers[slot])
            assert math.isclose(p.sum(), 1.0, rel_tol=1e-9)


def test_tables_follow_the_seating_rule():
    """With discount d and weight a the tables t of i customers grow with chance a / (a + i - d t)."""
    rng = np.random.default_rng(1)
    got = P.seat(np.full(100_000, 50.0), np.full(100_000, 2.0), 0.5, rng).mean()
    t = np.ones(100_000)
    for i in range(1, 50):
        t += rng.random(100_000) < 2 / (2 + i - 0.5 * t)
    assert abs(got - t.mean()) < 0.05
    assert (P.seat(np.array([0.0, 1.0, 100_000.0]), np.ones(3), 0.5, rng) >= [0, 1, 2]).all()


def test_spread_words_do_not_change_the_counts(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "a a a b " * 20 + str(k)) for k in range(60)], "doc_id long, text string")
    spread = {r["doc_id"]: r for r in P.score_documents(docs).collect()}
    monkeypatch.setattr(P, "_hot_words", lambda *_: np.zeros(0, dtype=np.uint64))
    plain = {r["doc_id"]: r for r in P.score_documents(docs).collect()}
    for k, r in plain.items():
        assert math.isclose(r["base_score"], spread[k]["base_score"], rel_tol=1e-12)
        assert abs(r["score"] - spread[k]["score"]) < 0.05 * abs(r["score"])


def test_odd_rows(odd_docs, no_docs):
    rows = P.score_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(math.isfinite(r["score"]) for r in rows)
    assert next(r for r in rows if r["doc_id"] is None)["held_out"]
    assert P.score_documents(no_docs).count() == 0
