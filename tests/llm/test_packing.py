import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lumenframe.llm import matrices, packing
from lumenframe.llm.tokens import Encoder, default_path, read_definition

TEXTS = ["a  b", "  \n x's I'll 12é3  y <|endoftext|>z \t\n", "\x1c a\x1fb \x85c", "日本語 一二 ½", "a\n  b ", "", "x" * 300]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(default_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizers(plain):
    encode = Encoder(read_definition(default_path()))
    for text in TEXTS:
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == plain(text), text


def words(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "Zwiebel", "tion", "ouèan", "42"]) for _ in range(n))


def check_pieces(rows, want, window):
    """Every id lies in exactly one piece; the pieces of a sequence lie side by side."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert len(ids) == r["length"] > 0 and r["ids_crc32"] == zlib.crc32(bytes(r["ids"]))
        pieces[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= window
    for doc, ids in want.items():
        at = 0
        for start, part, doc_tokens in sorted(pieces[doc]):
            assert start == at and part == ids[at : at + len(part)] and doc_tokens == len(ids)
            at += len(part)
        assert at == len(ids)
    assert set(pieces) == set(want)
    return sequences


@pytest.mark.parametrize("settings", [{}, {"window": 64, "open_windows": 3, "least_cut": 4}])
def test_round_trip(spark, plain, settings):
    texts = {k: words(int(random.Random(k).paretovariate(0.6) * 5) % 3000, k) for k in range(400)}
    texts |= {400 + k: t for k, t in enumerate(TEXTS)} | {500: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    rows = packing.pack(docs, **settings).collect()
    window = settings.get("window", 1024)
    sequences = check_pieces(rows, {k: [*plain(t), 0] for k, t in texts.items()}, window)
    used = sum(r["length"] for r in rows)
    assert used / (window * len(sequences)) > 0.97 - 1 / len(sequences)


def test_open_windows_are_bounded():
    packer = packing.Packer(window=10, most=3, least_cut=2)
    done = []
    for k in range(200):
        done += packer.add(packing.Piece(k, 0, memoryview(bytes(4 * (1 + k * 7 % 13))), 1))
        assert len(packer.pieces) <= 3
    assert all(sum(p.length for p in w) <= 10 for w in done)


def test_odd_rows(odd_docs, no_docs, plain):
    rows = packing.pack(odd_docs, with_ids=False).collect()
    assert all(r["ids"] is None for r in rows)
    total = sum(len(plain(r["text"])) + 1 for r in odd_docs.collect())
    assert sum(r["length"] for r in rows) == total
    assert packing.pack(no_docs).count() == 0 and matrices.pack_matrices(no_docs).count() == 0


def test_best_fit_decreasing_against_a_plain_search():
    rng = random.Random(2)
    for window in (1, 7, 64, 100):
        sizes = [rng.randint(1, window) for _ in range(300)]
        free, want = [], []
        for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            fits = [(f, -w) for w, f in enumerate(free) if f >= sizes[k] and f]
            if fits:
                least = min(fits)[0]
                want.append(least - sizes[k])
                free[next(w for w, f in enumerate(free) if f == least)] -= sizes[k]
            else:
                free.append(window - sizes[k])
        got = matrices.best_fit_decreasing(sizes, window)
        assert sorted(k for w in got for k in w) == list(range(len(sizes)))
        assert sorted(window - sum(sizes[k] for k in w) for w in got) == sorted(free)


def test_matrices_round_trip(spark, odd_docs, plain, tmp_path):
    docs = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    matrices.write_matrices(matrices.pack_matrices(docs, window=32, block_tokens=500), str(tmp_path / "m"))
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    ids, positions = matrices.matrix(rows), matrices.matrix(rows, "positions")
    assert ids.shape == (len(rows), 32)
    got = defaultdict(list)
    for row, line, place in zip(rows, ids, positions, strict=True):
        cuts = row["cu_seqlens"]
        assert cuts[0] == 0 and cuts[-1] == row["n_tokens"]
        for a, b, doc, start in zip(cuts, cuts[1:], row["doc_ids"], row["starts"], strict=False):
            assert place[a:b].tolist() == list(range(b - a))
            got[doc].append((start, line[a:b].tolist()))
    for r in docs.collect():
        whole = [t for _, part in sorted(got[r["doc_id"]]) for t in part]
        assert whole == [*plain(r["text"]), 50256]
