import corpus_pipeline as C
import numpy as np

from lumenframe.llm import near as N


def plain_set(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def plain_components(rows):
    """doc_id -> smallest id reachable by pairs of Jaccard similarity 0.8 or more."""
    sets = {i: plain_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in sets}


def edited(rng, words, n):
    words = list(words)
    for at in rng.choice(len(words), n, replace=False):
        words[at] = f"new{rng.integers(1 << 40)}"
    return words


def near_rows():
    """Copies with scattered edits on both sides of the threshold, chains of them, short and empty texts."""
    rng = np.random.default_rng(3)
    texts = ["", None, " \n", "a b", "A  b", "a b c d e", "a b c d e f"]
    for _ in range(12):
        words = [f"w{k}" for k in rng.integers(0, 5000, 200)]
        texts += [" ".join(edited(rng, words, k)) for k in (0, 1, 2, 3, 4, 5, 6, 8)]
        for _ in range(6):
            words = edited(rng, words, 3)
            texts.append(" ".join(words))
    return list(enumerate(texts))


def test_stage_equals_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain_components(rows)
    got = {r["doc_id"]: r["component_id"] for r in N.near_copies(docs).collect()}
    assert got == want
    assert 1 < len(set(want.values())) < len(rows)
    kept = {r["doc_id"] for r in C.without_copies(spark, docs, "").collect()}
    assert kept == set(want.values())


def test_split_bands_go_on_over_batches(spark):
    """A path whose neighbours are similar but whose ends are not: the stars alone leave it in pieces."""
    rows = [(k, " ".join(f"w{j}" for j in range(6 * k, 6 * k + 100))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = {r["doc_id"]: r["component_id"] for r in N.near_copies(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain_components(rows) == {k: 0 for k, _ in rows}


def test_stage_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = {r["doc_id"] for r in C.without_copies(spark, docs, "").collect()}
    assert kept == set(plain_components(rows).values())


def test_members_apart_from_the_first_are_linked_once():
    sets = [np.arange(k, k + 100, dtype=np.uint64) for k in (0, 5, 10, 500)]
    marks = np.zeros((4, 10), dtype=np.uint8)
    bands = np.array([[7, 9]] * 4)
    roots = np.arange(4)
    assert N.band_links(7, roots, marks, bands, sets, 0.8) == [(0, 1), (0, 2)]
    assert N.band_links(9, roots, marks, bands, sets, 0.8) == []  # they met in band 7
    assert N.band_links(7, np.zeros(4), marks, bands, sets, 0.8) == []


def test_odd_rows(odd_docs, no_docs):
    got = {}
    for r in N.near_copies(odd_docs.drop("score")).collect():
        got.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert got[1] == got[4] == {1} and got[2] == got[3] == got[8] == {2} and got[None] == {None}
    assert N.keep_one(odd_docs).columns == odd_docs.columns
    assert N.keep_one(no_docs).count() == 0


def test_simhash_finds_candidates_by_itself(spark):
    """Long texts that differ in a word have SimHashes within two bits or equal ones; other texts are no candidates."""
    words = [f"w{k}" for k in np.random.default_rng(5).integers(0, 5000, 3000)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(reversed(words)), "", "   "]
    marks = [N._marks(t.encode(), 5) for t in texts]
    rows = [(m["fp"], m["bands"], m["print"]) for m in marks]
    assert bin((rows[0][2] ^ rows[1][2]) & ((1 << 64) - 1)).count("1") <= 2
    sets = spark.createDataFrame(rows[:4], "fp long, bands array<long>, print long")
    got = {(r["a"], r["b"]) for r in N.simhash_stars(sets).collect()}
    assert got == {(max(rows[0][0], rows[1][0]), min(rows[0][0], rows[1][0]))}
