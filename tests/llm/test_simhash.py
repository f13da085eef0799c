import numpy as np
import xxhash

from lumenframe.llm import simhash as S
from lumenframe.llm.components import connected_components


def plain_fingerprint(text):
    words = text.lower().split() if text else []
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + size]), 42) for k in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_bits():
    for text in ("", "one", "a b", "A b c d e f a b c", "x " * 500, "é 日本 z q"):
        assert S.fingerprint(text.encode()) % (1 << 64) == plain_fingerprint(text)


def test_bit_sliced_distances():
    rng = np.random.default_rng(0)
    left = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    flips = [int(sum(1 << int(b) for b in rng.choice(64, k % 6, replace=False))) for k in range(1000)]
    right = left ^ np.array(flips, dtype=np.uint64)
    for radius in range(5):
        want = [k for k in range(1000) if bin(flips[k]).count("1") <= radius]
        assert S.within(left, right, radius).tolist() == want


def components_of(values, radius):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and bin((a ^ b) % (1 << 64)).count("1") <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_links_connect_what_brute_force_connects(spark):
    rng = np.random.default_rng(5)
    values = set(rng.integers(-(1 << 63), (1 << 63) - 1, 30).tolist())
    for v in list(values)[:10]:  # chains and clusters
        for _ in range(25):
            v = int(np.int64(np.uint64(v % (1 << 64)) ^ np.uint64(1 << int(rng.integers(64)))))
            values.add(v)
    rows = spark.createDataFrame([(v,) for v in values], "fp long")
    for tile in (1024, 4):  # a group in one tile, and tile against tile
        links = S.fingerprint_links(rows, tile=tile)
        for r in links.collect():
            assert r["a"] in values and r["b"] in values
        got = {v: v for v in values} | {r["node"]: r["root"] for r in connected_components(links).collect()}
        assert got == components_of(values, 2)


def test_long_path_in_adverse_order(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(5, 5), (None, 3)], "a long, b long")
    assert {r["root"] for r in connected_components(edges).collect()} == {0}
    assert connected_components(edges.limit(0)).count() == 0


def test_documents(spark, odd_docs, no_docs):
    rows = S.near_duplicates(odd_docs.drop("score")).collect()
    assert len(rows) == 9
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert got[1] == got[4] == {1}  # equal but for case
    assert got[2] == got[3] == got[8] == {2}  # without words
    assert got[None] == {None}
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "7", "9", "None"]
    assert S.keep_one(no_docs).count() == 0
