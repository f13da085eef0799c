"""Operator 4: SimHash near-duplicates by bit-sliced comparison.

Fingerprints within the radius agree on all but ``radius`` of ``radius + 2`` bit blocks, so they agree on
some two blocks: each distinct fingerprint goes to one group for every two blocks. Inside a group the
fingerprints stand as vertical bit planes, 64 comparisons to a machine word. The differing bits of all
comparisons are added plane by plane in carry-save counters, and words in which every comparison has
passed the radius are abandoned. A group gives a star of links for each of its clusters, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import append_struct, blank_words, fresh, texts_of
from lumenframe.llm.components import connected_components
from lumenframe.session import checkpoint

BITS = 64
SHINGLE = 3
SEED = 42
RADIUS = 2
#: Fingerprints in a tile; a larger group is compared tile against tile.
TILE = 1024
#: Rows compared at a time, besides the rest of the last group.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of the word shingles, repeats included; 0 for a text without words."""
    words = blank_words(text)
    if not words:
        return 0
    size = min(shingle, len(words))
    runs = map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False))
    n = len(words) - size + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), dtype=np.uint64, count=n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > n
    return int(np.packbits(majority, bitorder="little").view(np.int64)[0])


def with_fingerprint(
    docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE
) -> tuple[DataFrame, str]:
    """Adds the fingerprint as a long; returns the frame and the column's name. Null texts have no words."""
    name = fresh(name, docs.columns)
    held = fresh("_held", docs.columns)

    def hashed(batch: pa.RecordBatch) -> list[dict]:
        return [{"fp": fingerprint(t, shingle)} for t in texts_of(batch, text)]

    schema = T.StructType([T.StructField("fp", T.LongType())])
    df = append_struct(docs, hashed, held, schema)
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(held)["fp"].alias(name)), name


def _masks(radius: int) -> list[int]:
    """The bits of every two of radius + 2 blocks, as signed longs."""
    cuts = [BITS * k // (radius + 2) for k in range(radius + 3)]
    blocks = [(1 << cuts[k + 1]) - (1 << cuts[k]) for k in range(radius + 2)]
    return [int(np.uint64(a | b).astype(np.int64)) for a, b in combinations(blocks, 2)]


def planes_of(values: np.ndarray) -> np.ndarray:
    """(64, n/64) words: bit k of word w of plane b is bit b of value 64 w + k; the end is padded with 0."""
    n = -(-len(values) // 64) * 64
    padded = np.zeros(n, dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Places at which two equally long fingerprint arrays differ in at most ``radius`` bits."""
    if not len(left):
        return np.zeros(0, dtype=np.int64)
    differ = planes_of(left ^ right)
    n_words = differ.shape[1]
    levels = radius.bit_length()
    words = np.arange(n_words)
    counters = np.zeros((levels, n_words), dtype=np.uint64)
    past = np.zeros(n_words, dtype=np.uint64)  # comparisons whose counter has run over
    start = (1 << levels) - 1 - radius  # counters start here, so that they run over beyond the radius
    for level in range(levels):
        if start >> level & 1:
            counters[level] = ~np.uint64(0)
    if len(left) % 64:  # lanes without a comparison count as past the radius
        past[-1] = ~np.uint64(0) << np.uint64(len(left) % 64)
    for plane in range(BITS):
        carry = differ[plane, words]
        for level in range(levels):
            counters[level], carry = counters[level] ^ carry, counters[level] & carry
        past |= carry
        if plane % 4 == 3:
            alive = past != ~np.uint64(0)
            if not alive.all():
                words, past, counters = words[alive], past[alive], counters[:, alive]
                if not len(words):
                    return np.zeros(0, dtype=np.int64)
    bits = np.unpackbits((~past).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(bits)
    return words[row] * 64 + lane


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The first row that each of n rows reaches by the links a-b."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def group_links(group: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links (value, value of the cluster's first row) inside runs of equal ``group``."""
    n = len(values)
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    left_over = np.repeat(np.append(begins[1:], n), np.diff(np.append(begins, n))) - np.arange(n) - 1
    a, b = [], []
    rows, step = np.flatnonzero(left_over > 0), 1
    while len(rows):
        found = rows[within(values[rows], values[rows + step], radius)]
        a.append(found)
        b.append(found + step)
        step += 1
        rows = rows[left_over[rows] >= step]
    left, right = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (a, b))
    root = _roots(left, right, n)
    linked = np.flatnonzero(root != np.arange(n))
    return values[linked], values[root[linked]]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(group: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            a, b = group_links(group, values.view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        group, values = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            group = np.concatenate([group, batch.column("group").to_numpy(zero_copy_only=False)])
            values = np.concatenate([values, batch.column("fp").to_numpy(zero_copy_only=False)])
            if len(group) >= CHUNK:
                whole = int(np.searchsorted(group, group[-1]))  # the last group may go on
                if whole:
                    yield linked(group[:whole], values[:whole])
                    group, values = group[whole:], values[whole:]
        if len(group):
            yield linked(group, values)

    return run


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Distinct ``fp`` -> links (a, b) that connect exactly the fingerprints within the radius."""
    keys = F.array(
        *[
            F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
            for k, m in enumerate(_masks(radius))
        ]
    )
    placed = prints.select("fp", F.explode(keys).alias("key")).select("fp", "key.*")
    same = Window.partitionBy("table", "value")
    sized = placed.withColumns(
        {
            "n": F.count(F.lit(1)).over(same),
            "at": F.floor((F.row_number().over(same.orderBy("fp")) - 1) / tile),
        }
    ).where("n > 1")
    last = F.floor((F.col("n") - 1) / tile)
    # Two tiles meet in one task; the tiles of a small group are one.
    pairs = F.when(last == 0, F.array(F.lit(0).cast("long"))).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), last), lambda k: k != F.col("at"))
    )
    tiles = sized.select("fp", "table", "value", "at", F.explode(pairs).alias("other")).select(
        "fp", F.xxhash64("table", "value", F.least("at", "other"), F.greatest("at", "other")).alias("group")
    )
    return (
        tiles.repartition("group")
        .sortWithinPartitions("group", "fp")
        .mapInArrow(_compare(radius), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fp, row, component_id): a row for each document.

    ``component_id`` is the smallest id reachable by links between fingerprints that differ in at most
    ``radius`` bits. Texts without words share fingerprint 0 and are linked like any other. Null ids never
    become a component's id; a component of null ids only has a null one. ``row`` is a hash of all the
    document's columns. Repeated rows give repeated results, an empty table gives none.
    """
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(*docs.columns).alias("row")
    )
    prints, name = with_fingerprint(base)
    prints = checkpoint(prints.select("doc_id", F.col(name).alias("fp"), "row"))
    distinct = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    return with_components(prints, distinct, fingerprint_links(distinct.select("fp"), radius))


def with_components(prints: DataFrame, distinct: DataFrame, links: DataFrame) -> DataFrame:
    """``prints`` with the smallest id (``least`` of ``distinct``) that each ``fp`` reaches by the links (a, b)."""
    roots = connected_components(links)
    joined = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = joined.join(ids, "root").select("fp", "component_id")
    return prints.join(classes, "fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One document of each component, the one with the smallest id (then row hash); its own columns.

    Documents of components without any id all stay, but equal rows of them once.
    """
    return first_of_each(docs, near_duplicates(docs, doc_id, text, radius), doc_id)


def first_of_each(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that come first in their component of ``found`` (doc_id, row, component_id)."""
    first = found.where("component_id is not null").groupBy("component_id")
    kept = first.agg(F.min(F.struct("doc_id", "row")).alias("k")).select("k.doc_id", "k.row")
    kept = kept.unionByName(found.where("component_id is null").select("doc_id", "row").distinct())
    row, key = fresh("_row", docs.columns), fresh("_key", docs.columns)
    kept = kept.select(F.col("doc_id").alias(key), F.col("row").alias(row))
    rows = docs.withColumn(row, F.xxhash64(*docs.columns))
    stay = rows.join(kept, (rows[row] == kept[row]) & rows[doc_id].eqNullSafe(kept[key]), "left_semi")
    return stay.dropDuplicates([row, doc_id]).select(*docs.columns)


def fingerprint_hex(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
