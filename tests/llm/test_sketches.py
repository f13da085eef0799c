import hashlib

import numpy as np
from pyspark.sql import functions as F

from lumenframe.llm import sketches as K


def test_containment_estimates_what_it_should():
    a = " ".join(f"w{k}" for k in range(4000)).encode()
    half = " ".join(f"w{k}" for k in range(2000)).encode()
    mixed = half + b" " + " ".join(f"v{k}" for k in range(2000)).encode()
    assert abs(K.containment(K.sketch(a), K.sketch(mixed)) - 0.5) < 0.08
    assert K.containment(K.sketch(half), K.sketch(a)) == 1.0
    assert abs(len(K.sketch(a)) - 4000 / K.SCALE) < 100
    assert set(K.merged(K.sketch(a), K.sketch(mixed))) >= set(K.sketch(half))
    assert len(K.sketch(b"one")) == 1 and len(K.sketch(b" \n")) == 0
    assert K.containment(K.sketch(b""), K.sketch(b"x")) == 0 and K.containment(K.sketch(b""), K.sketch(b" ")) == 1


def brute(rows):
    """(doc_id, text) in order of ids, null first; ties by the hash that Spark gives the text."""
    out = []
    for k, (doc, text, _) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        edited = K.edited_text(text, following)
        own, changed = K.sketch(text.encode()), K.sketch(edited.encode())
        near = (K.containment(own, changed), K.containment(own, K.sketch(following.encode())))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc, len(text), sha, K.as_text(own), K.as_text(changed), *near))
    return out


def against_brute(docs):
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    ordered = sorted(rows.collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    got = [tuple(r) for r in K.fingerprint_edits(docs).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r)
    assert sorted(got, key=key) == sorted(brute([tuple(r) for r in ordered]), key=key)


def test_odd_rows(odd_docs, no_docs):
    against_brute(odd_docs)
    assert K.fingerprint_edits(no_docs).count() == 0


def test_many_ranges(spark):
    rng = np.random.default_rng(0)
    rows = [(int(k) * 3, " ".join(f"é{w}" for w in rng.integers(0, 50, k % 60))) for k in rng.permutation(500)]
    against_brute(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    against_brute(spark.createDataFrame(rows[:1], "doc_id long, text string"))
