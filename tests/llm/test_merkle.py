import hashlib

import pytest
from pyspark.sql import functions as F

from lumenframe.llm import merkle as M


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k : k + 3])) for k in range(0, len(last), 3)])
    return levels


def plain_path(levels, at):
    """Siblings (left, right) of each level."""
    out = []
    for nodes in levels[:-1]:
        begin = at // 3 * 3
        out.append(("".join(nodes[begin:at]), "".join(nodes[at + 1 : begin + 3])))
        at //= 3
    return out


def plain_manifest(rows):
    """rows (doc_id, source, leaf) -> sorted (doc_id, leaf, path, subroot, root)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[s] = (own, plain_levels([r[2] for r in own]))
    upper = plain_levels([trees[s][1][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        own, levels = trees[s]
        for at, r in enumerate(own):
            path = plain_path(levels, at) + plain_path(upper, k)
            out.append((str(r[0]), r[2], path, levels[-1][0], upper[-1][0]))
    return sorted(out)


def got_manifest(df):
    return sorted(
        (str(r["doc_id"]), r["leaf"], [tuple(p) for p in r["path"]], r["subroot"], r["root"]) for r in df.collect()
    )


def test_fold_resumes_the_state_before_the_slot():
    parent = M.Parent(["aa", "bb", "cc"])
    assert parent.digest == sha("aabbcc")
    assert M.resumed(parent.before[1], "xx", parent.siblings(1)["right"]) == sha("aaxxcc")
    assert M.resumed(parent.before[2], "xx", "") == sha("aabbxx")


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_brute_force(spark, levels):
    """Groups of many sizes around the chunk size, a null one, more groups than a chunk has nodes."""
    sizes = {None: 4, "é": 1, "big": 95, "a": 9, "B": 10, "z": 28, "": 3, "q1": 1, "q2": 2, "q3": 27}
    values = [
        (i * 7 % 101 + 1000 * k, s, None, i, f"text {i}\n") for k, (s, n) in enumerate(sizes.items()) for i in range(n)
    ]
    values += [values[5], (None, "a", "en", None, None), (None, "a", "en", None, "x")]
    docs = spark.createDataFrame(values, "doc_id long, source string, lang string, n_chars int, text string")
    changed = F.when(F.col("doc_id") % 2 == 0, F.sha2(F.lit("other"), 256))
    found = M.manifest(docs.repartition(3), changed=changed, levels=levels)
    found = spark.createDataFrame(found.collect(), found.schema)
    assert got_manifest(found) == plain_manifest([(v[0], v[1], plain_leaf(v)) for v in values])
    for r in found.collect():
        now = sha("other") if r["doc_id"] is not None and r["doc_id"] % 2 == 0 else r["leaf"]
        for left, right in r["path"]:
            now = sha(left + now + right)
        assert r["folded"] == now and (now == r["root"]) == (r["doc_id"] is None or r["doc_id"] % 2 == 1)


def test_single_row_and_proof_text(spark):
    row = (1, "s", "en", 2, "hé")
    docs = spark.createDataFrame([row], "doc_id long, source string, lang string, n_chars int, text string")
    r = M.manifest(docs).select("*", M.proof_text("path").alias("proof")).first()
    assert r["leaf"] == r["root"] == r["folded"] == plain_leaf(row) and r["proof"] == "" and r["path"] == []


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.withColumns({"grp": F.lit(1), "source": F.lit(None).cast("string"), "path": F.lit(2)})
    fields = ["doc_id", "source", "text"]
    rows = [(r["doc_id"], None, plain_leaf((r["doc_id"], None, r["text"]))) for r in docs.collect()]
    assert got_manifest(M.manifest(docs, fields=fields)) == plain_manifest(rows)
    assert M.manifest(no_docs.withColumn("source", F.lit("x")), fields=fields).count() == 0
