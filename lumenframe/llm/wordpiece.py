"""Operator 10: greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie of byte strings. Where no child fits, a failure link leads to the node of what is
left after popping the longest pieces, and how many pieces are popped is known beforehand for every node.
So each byte of a word is read once and no piece is built.
"""

from __future__ import annotations

import json
from collections import deque
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import append_struct, fresh, texts_of
from lumenframe.llm.tokens import default_path, merge_ranks, read_definition

#: Words whose count a worker keeps; beyond that it begins anew.
CACHED = 500_000


def vocabulary(path: str | None = None) -> list[bytes]:
    """The byte strings of a byte-level tokenizer file; pieces that begin a word begin with a space."""
    ranks = merge_ranks(json.loads(read_definition(path or default_path())))
    if ranks is None:
        raise ValueError("a byte-level vocabulary is needed")
    return list(ranks)


class Automaton(dict):
    """Word (with the mark that begins it) -> number of greedy longest-match pieces; -1 if some byte is no piece."""

    def __init__(self, pieces: list[bytes]) -> None:
        super().__init__()
        child: dict[int, int] = {}
        order, is_piece, parent = [0], [False], [(0, 0)]
        for piece in pieces:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                node = child.get(key, 0)
                if not node:
                    node = child[key] = len(is_piece)
                    is_piece.append(False)
                    parent.append((key >> 8, byte))
            is_piece[node] = node != 0
        fail, popped = [-1] * len(is_piece), [0] * len(is_piece)
        below: dict[int, list[int]] = {}
        for node in range(1, len(parent)):
            below.setdefault(parent[node][0], []).append(node)
        todo = deque(below.get(0, ()))
        while todo:  # from the root down: a link leads to a shorter string
            node = todo.popleft()
            todo.extend(below.get(node, ()))
            if is_piece[node]:
                fail[node], popped[node] = 0, 1
                continue
            up, byte = parent[node]
            at, n = fail[up], popped[up]
            while at >= 0 and (at << 8 | byte) not in child:
                n += popped[at]
                at = fail[at]
            if at >= 0:
                fail[node], popped[node] = child[at << 8 | byte], n
        self._child, self._fail, self._popped = child, fail, popped

    def count(self, word: bytes) -> int:
        child, fail, popped = self._child, self._fail, self._popped
        node = n = 0
        for byte in word:
            to = child.get(node << 8 | byte)
            while to is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
                to = child.get(node << 8 | byte)
            node = to
        while node > 0:
            n += popped[node]
            node = fail[node]
        return n if node == 0 else -1

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        n = self.count(b" " + word)
        self[word] = max(n, 1)  # a word with an unknown byte is one unknown piece
        return self[word]


@cache
def _automaton(definition: str) -> Automaton:
    return Automaton(list(merge_ranks(json.loads(definition))))


def count_pieces(
    docs: DataFrame, text: str = "text", tokenizer: str | None = None, name: str = "pieces"
) -> tuple[DataFrame, str]:
    """Adds a struct of ``n_words`` and ``n_pieces``; returns the frame and the struct's name.

    Words are runs without ASCII white space; each is cut greedily, with the mark for a word's begin before it.
    Null and empty texts have no words; a long word costs time in proportion to its length. Repeated rows get
    repeated results, an empty table gives none.
    """
    definition = read_definition(tokenizer or default_path())
    name = fresh(name, docs.columns)

    def counted(batch: pa.RecordBatch) -> list[dict]:
        count = _automaton(definition).__getitem__
        split = (t.split() for t in texts_of(batch, text))
        return [{"n_words": len(words), "n_pieces": sum(map(count, words))} for words in split]

    schema = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_pieces", T.LongType())])
    return append_struct(docs, counted, name, schema), name


def piece_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kwargs) -> DataFrame:
    """(doc_id, n_words, n_pieces) of every document."""
    counted, name = count_pieces(docs.select(doc_id, text), text, **kwargs)
    return counted.select(doc_id, F.col(name)["n_words"].alias("n_words"), F.col(name)["n_pieces"].alias("n_pieces"))
