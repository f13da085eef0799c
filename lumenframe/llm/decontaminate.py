"""Operator 2: benchmark decontamination with suffix arrays over the documents.

Each Arrow batch of documents is a shard. Its suffix array holds the word suffixes in lexicographic
order, compared over the first ``window`` words; only suffixes that begin with enough words of the test
set's vocabulary are kept, since no other can match. Every suffix of every test item is then looked up
by two binary searches, which give all its places in the shard; places that follow each other are joined to
the longest stretches of a document that match an item word for word, window by window. A window counts once
for each item that holds it, however often the item repeats it.

The test set is the stated query set. It goes to the tasks in blocks of bounded size; beyond one block the
documents pass through one matcher after another in the same stage. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import append_struct, fresh, letter_words, texts_of, whole

WINDOW = 13
#: Characters of test items that one matcher holds; more items make more matchers.
BLOCK_CHARS = 16 << 20

MATCH = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("doc_start", T.IntegerType()),
        T.StructField("item_start", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()),
    ]
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("matches", T.ArrayType(MATCH)),
    ]
)


class TestSet(NamedTuple):
    """A block of test items: vocabulary, distinct windows in sorted order and who holds them."""

    ids: dict[bytes, int]
    lengths: np.ndarray  # words of each distinct window
    low: np.ndarray  # sort keys: the window, padded below and above
    high: np.ndarray
    holders: np.ndarray  # CSR: window -> (item, first place in it)
    holder_at: np.ndarray
    items: list[str]
    window: int


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like the rows."""
    wide = np.ascontiguousarray(rows, dtype=">u4")
    return wide.view(f"S{4 * rows.shape[1]}").ravel()


def test_set(rows: list[tuple[str, bytes]], window: int) -> TestSet:
    """Cuts items into windows; an item shorter than ``window`` is one window, one without words none."""
    ids: dict[bytes, int] = {}
    places: dict[tuple[int, ...], dict[int, int]] = {}
    items: list[str] = []
    for item, text in rows:
        words = [ids.setdefault(w, len(ids) + 1) for w in letter_words(text)]
        if not words:
            continue
        size = min(window, len(words))
        for at in range(len(words) - size + 1):
            places.setdefault(tuple(words[at : at + size]), {}).setdefault(len(items), at)
        items.append(item)
    lengths = np.array([len(w) for w in places], dtype=np.int64)
    low = np.zeros((len(places), window), dtype=np.uint32)
    high = np.full((len(places), window), 0xFFFFFFFF, dtype=np.uint32)
    for k, words in enumerate(places):
        low[k, : len(words)] = high[k, : len(words)] = words
    sizes = np.array([len(p) for p in places.values()], dtype=np.int64)
    holders = np.array([h for p in places.values() for h in p.items()], dtype=np.int64).reshape(-1, 2)
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return TestSet(ids, lengths, _keys(low), _keys(high), holders, at, items, window)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each (start, size), one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def shard_matches(texts: list[bytes], test: TestSet) -> tuple[list[int], list[list[tuple]]]:
    """Number of words and longest matching stretches of each text of a shard."""
    number, counts, parts = test.ids.get, [], [np.zeros(1, dtype=np.uint32)]
    for text in texts:
        words = letter_words(text)
        counts.append(len(words))
        parts.append(np.fromiter(map(number, words, repeat(0)), dtype=np.uint32, count=len(words)))
        parts.append(np.zeros(1, dtype=np.uint32))  # no match runs over the end of a text
    found: list[list[tuple]] = [[] for _ in texts]
    if not len(test.lengths):
        return counts, found
    ids = np.concatenate(parts)
    doc_start = np.concatenate([[1], 1 + np.cumsum(np.array(counts, dtype=np.int64) + 1)])
    index = np.arange(len(ids))
    stop = np.minimum.accumulate(np.where(ids == 0, index, len(ids))[::-1])[::-1]
    run = stop - index  # words of the vocabulary from here on
    suffix = index[run >= test.lengths.min()]
    if not len(suffix):
        return counts, found
    padded = np.concatenate([ids, np.zeros(test.window, dtype=np.uint32)])
    heads = padded[suffix[:, None] + np.arange(test.window)]
    heads[np.arange(test.window) >= run[suffix][:, None]] = 0
    keys = _keys(heads)
    order = np.argsort(keys, kind="stable")
    keys, suffix = keys[order], suffix[order]  # the shard's suffix array
    first = np.searchsorted(keys, test.low, "left")
    sizes = np.searchsorted(keys, test.high, "right") - first
    hit = np.flatnonzero(sizes > 0)
    if not len(hit):
        return counts, found
    places = suffix[_ranges(first[hit], sizes[hit])]
    windows = np.repeat(hit, sizes[hit])
    held = test.holder_at[windows + 1] - test.holder_at[windows]
    holders = test.holders[_ranges(test.holder_at[windows], held)]
    place, size = np.repeat(places, held), np.repeat(test.lengths[windows], held)
    item, item_at = holders[:, 0], holders[:, 1]
    by = np.lexsort((place, item))
    place, size, item, item_at = place[by], size[by], item[by], item_at[by]
    begins = np.ones(len(by), dtype=bool)
    begins[1:] = (item[1:] != item[:-1]) | (np.diff(place) != 1)
    begin = np.flatnonzero(begins)
    last = np.concatenate([begin[1:], [len(by)]]) - 1
    doc = np.searchsorted(doc_start, place[begin], "right") - 1
    n_words = place[last] - place[begin] + size[last]
    rows = zip(doc, item[begin], place[begin] - doc_start[doc], item_at[begin], n_words, strict=True)
    for d, i, at, item_start, n in rows:
        found[d].append((test.items[i], int(at), int(item_start), int(n)))
    return counts, found


def _blocks(items: DataFrame, item_id: str, text: str, block_chars: int) -> Iterator[list[tuple[str, bytes]]]:
    rows = items.select(F.col(item_id).cast("string").alias("i"), whole(text).alias("t")).where(
        F.col("i").isNotNull()
    )
    chars = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-chars // block_chars))
    for k in range(n):
        block = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r["i"], r["t"].encode()) for r in block.toLocalIterator()]


def find_matches(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    name: str = "contamination",
    block_chars: int = BLOCK_CHARS,
) -> tuple[DataFrame, str]:
    """Adds a struct of ``n_words`` and ``matches`` (longest stretches); returns the frame and its name.

    Null texts have no words; an item with a null id is no item; items without words match nothing; an
    item of fewer than ``window`` words has to occur whole. Repeated documents get repeated results, repeated
    items are reported once each. An empty table on either side gives no matches.
    """
    name = fresh(name, docs.columns)
    spark, steps = docs.sparkSession, []
    for rows in _blocks(items, item_id, item_text, block_chars):
        shared = spark.sparkContext.broadcast(test_set(rows, window))

        def match(batch: pa.RecordBatch, shared=shared) -> list[dict]:
            counts, found = shard_matches(texts_of(batch, text), shared.value)
            keys = ("item_id", "doc_start", "item_start", "n_words")
            return [
                {"n_words": n, "matches": [dict(zip(keys, m, strict=True)) for m in found_in]}
                for n, found_in in zip(counts, found, strict=True)
            ]

        step = fresh(f"{name}_{len(steps)}", docs.columns)
        docs = append_struct(docs, match, step, FOUND)
        steps.append(step)
    matches = F.concat(*[F.col(s)["matches"] for s in steps])
    joined = F.struct(F.col(steps[0])["n_words"].alias("n_words"), matches.alias("matches"))
    return docs.withColumn(name, joined).drop(*steps), name


def hit_words(matches: Column) -> Column:
    """Words that lie in any match: the length of the union of the matches."""

    def step(state: Column, m: Column) -> Column:
        end = m["doc_start"] + m["n_words"]
        new = F.greatest(end - F.greatest(m["doc_start"], state["at"]), F.lit(0))
        return F.struct((state["n"] + new).alias("n"), F.greatest(state["at"], end).alias("at"))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("at"))
    by_start = F.array_sort(
        F.transform(matches, lambda m: F.struct(m["doc_start"].alias("doc_start"), m["n_words"].alias("n_words")))
    )
    return F.aggregate(by_start, start, step, lambda s: s["n"])


def measured(matched: DataFrame, name: str) -> dict[str, Column]:
    """Per document: words, hit words, items with occurring windows, and whether it is contaminated.

    A document is contaminated when at least one word in twenty is hit.
    """
    found = F.col(name)
    items = F.array_sort(F.array_distinct(F.transform(found["matches"], lambda m: m["item_id"])))
    n_hit = hit_words(found["matches"])
    return {
        "n_words": found["n_words"],
        "n_hit": n_hit,
        "n_items": F.size(items).cast("long"),
        "items_sha256": F.sha2(F.array_join(items, ",").cast("binary"), 256),
        "contaminated": (n_hit > 0) & (20 * n_hit >= found["n_words"]),
    }


def remove_contaminated(docs: DataFrame, items: DataFrame, **kwargs) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    matched, name = find_matches(docs, items, **kwargs)
    return matched.where(~measured(matched, name)["contaminated"]).select(*docs.columns)
