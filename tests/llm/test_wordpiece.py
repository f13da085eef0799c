from hypothesis import given
from hypothesis import strategies as st

from lumenframe.llm import wordpiece as W

PIECES = [b" ", b"a", b"b", b"c", b"ab", b"abc", b"abcab", b" a", b" ab", b"cab", b"bcabc", b"bb"]


def greedy(word, pieces):
    n = at = 0
    while at < len(word):
        size = max((len(p) for p in pieces if word.startswith(p, at)), default=0)
        if not size:
            return -1
        at += size
        n += 1
    return n


@given(st.text(alphabet="abc", max_size=30))
def test_automaton_counts_greedy_pieces(word):
    assert W.Automaton(PIECES).count(b" " + word.encode()) == greedy(b" " + word.encode(), PIECES)


def test_unknown_byte_and_bounded_memory(monkeypatch):
    monkeypatch.setattr(W, "CACHED", 2)
    automaton = W.Automaton(PIECES)
    assert automaton.count(b" ax") == greedy(b" ax", PIECES) == -1
    assert automaton[b"ax"] == 1  # one unknown piece
    for word in (b"a", b"b", b"c", b"abc", b"bb"):
        assert automaton[word] == greedy(b" " + word, PIECES)
        assert len(automaton) <= 2


def test_documents(odd_docs, no_docs):
    pieces = set(W.vocabulary())
    longest = max(map(len, pieces))

    def count(word):
        n = at = 0
        while at < len(word):
            at += next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces)
            n += 1
        return n

    counted, name = W.count_pieces(odd_docs)
    for r in counted.collect():
        words = (r["text"] or "").encode().split()
        assert (r[name]["n_words"], r[name]["n_pieces"]) == (len(words), sum(count(b" " + w) for w in words))
    assert W.piece_counts(no_docs).count() == 0
