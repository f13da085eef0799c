import zlib

import numpy as np
import pytest

from lumenframe.llm import best_fit as B
from lumenframe.llm.tokens import default_path, encoder, read_definition


def best_fit_decreasing(sizes, window):
    free = []
    for size in sorted(sizes, reverse=True):
        k = min((k for k, f in enumerate(free) if f >= size), key=lambda k: free[k], default=None)
        if k is None:
            free.append(window - size)
        else:
            free[k] -= size
    return len(free)


def plain_sweep(size, kind, key):
    """Row by row: a stack of gaps; a piece takes the top one, which stays on top if it holds another such piece."""
    left, target, stack = list(size), {}, []
    before = None
    for k in range(len(size)):
        if kind[k] == B.GAP:
            stack.append(k)
            continue
        if before is not None and (size[k] != size[before[0]] or left[before[1]] < size[k]):
            before = None
        at = before[1] if before else (stack.pop() if stack else None)
        if at is not None:
            target[k], before = key[at], (k, at)
            left[at] -= size[k]
    return target, left


def test_sweep_equals_row_by_row():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 40, 200):
        size, kind = np.sort(rng.integers(1, 40, n))[::-1].copy(), rng.integers(0, 2, n)
        order = np.lexsort((kind, -size))
        size, kind, key = size[order], kind[order], rng.permutation(n) - n // 2
        target, left, rank = B.sweep(size, kind, key)
        want, remains = plain_sweep(size, kind, key)
        assert {k: int(t) for k, t in enumerate(target) if t != B._NONE} == want
        assert [l for l, k in zip(left, kind) if k == B.GAP] == [l for l, k in zip(remains, kind) if k == B.GAP]
        missed = [int(r) for r, k in zip(rank, kind) if k == B.PIECE and r >= 0]
        assert missed == list(range(len(missed))) and len(missed) + len(want) == int((kind == B.PIECE).sum())
        unused = [int(r) for r, k in zip(rank, kind) if k == B.GAP and r >= 0]
        assert sorted(unused, reverse=True) == unused and sorted(unused) == list(range(len(unused)))


def test_ranges_meet_by_rank():
    found = B.cross_matches([(1, 5, 10, 0, 0), (0, 0, 0, 2, 25), (2, 1, 4, 3, 3), (3, 9, 2, 0, 0)])
    assert found == [
        B.Match(1, 0, 4, 0, 0, 2),  # two pieces of at most 10 in each gap of 25 or more
        B.Match(3, 0, 3, 2, 0, 1),
    ]


@pytest.mark.parametrize("case", ["mixed", "small", "equal", "halves", "ones", "none"])
def test_placements_hold_and_are_few(spark, case):
    rng = np.random.default_rng(7)
    sizes = {
        "mixed": rng.integers(1, 100, 800),
        "small": rng.integers(1, 12, 1500),
        "equal": np.full(900, 13),
        "halves": np.repeat([50, 51], 200),
        "ones": np.ones(1000, dtype=int),
        "none": np.zeros(0, dtype=int),
    }[case].tolist()
    rows = spark.createDataFrame(list(enumerate(sizes)), "id long, size long").repartition(5)
    found = B.placements(rows, 100).collect()
    assert sorted(r["id"] for r in found) == list(range(len(sizes)))
    assert all(r["size"] == sizes[r["id"]] for r in found)
    used = {}
    for r in found:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["size"]
    assert max(used.values(), default=0) <= 100
    assert len(used) <= 1.02 * best_fit_decreasing(sizes, 100) + 1


def check_pieces(rows, docs, window, end_id=2):
    encode = encoder(read_definition(default_path()))
    want = sorted(encode(t or "") + np.uint32(end_id).tobytes() for _, t in docs)
    rows = [r.asDict() for r in rows]
    bodies, sequences = {}, {}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"] > 0
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    one = [r for r in rows if r["piece"] == 0]
    for r in one:
        bodies.setdefault(r["doc_id"], [])
    by_doc = {}
    for r in sorted(rows, key=lambda r: r["piece"]):
        by_doc.setdefault(r["doc_id"], []).append(r)
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append(encode(t or "") + np.uint32(end_id).tobytes())
    assert by_doc.keys() == texts.keys() and len(one) == len(want)
    for i, parts in by_doc.items():
        if len(texts[i]) > 1:
            continue
        assert b"".join(bytes(p["ids"]) for p in parts) == texts[i][0]
        assert [p["piece"] for p in parts] == list(range(len(parts)))
        assert [p["start"] for p in parts] == B.cut_starts(len(texts[i][0]) // 4, window)
        assert all(p["length"] == window for p in parts[1:])
    return len(sequences)


def test_given_documents_and_odd_rows(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = B.pack_best_fit(docs).collect()
    n = check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 1024)
    tails = [r["length"] for r in rows if r["length"] < 1024]
    full = len(rows) - len(tails)
    assert n <= 1.01 * (full + best_fit_decreasing(tails, 1024)) + 1
    check_pieces(B.pack_best_fit(odd_docs, window=64).collect(), [(r["doc_id"], r["text"]) for r in odd_docs.collect()], 64)
    assert B.pack_best_fit(no_docs).count() == 0
    assert {r["ids"] for r in B.pack_best_fit(docs, with_ids=False).collect()} == {None}
