"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from the SimHash of operator 4 over five-word shingles (fingerprints that differ in at most
2 bits) and from MinHash, which reaches down to 0.8: 30 bands of 5 minima, so a pair at similarity 0.8 shares a band but for
about 7 in a million. Every link is confirmed by the exact similarity of the two texts. First each member
of a band is held against the band's first one; what these stars leave apart is compared pair by pair
inside the band's task, by the minima and then by the texts, and gives links, not pairs. Equal sets are
one from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import append_struct, texts_of
from lumenframe.llm.components import connected_components
from lumenframe.llm.simhash import fingerprint, fingerprint_links, first_of_each, with_components
from lumenframe.llm.sketches import shingle_hashes
from lumenframe.session import checkpoint

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 5
#: Least share of equal minima for which two members of a band are compared by their texts: 0.8 less six deviations.
LIKELY = 0.6
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPREAD = np.random.default_rng(43).integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles; a shorter text is one shingle, none has no words."""
    return np.unique(shingle_hashes(text, shingle))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; 1 for two empty ones."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - common
    return common / total if total else 1.0


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the factors."""
    out = np.full(len(_FACTORS), ~np.uint64(0))
    for k in range(0, len(hashes), 512):
        np.minimum(out, (hashes[k : k + 512, None] * _FACTORS).min(axis=0), out=out)
    return out


def _marks(text: bytes, shingle: int) -> dict:
    """The set's key, the keys of its bands (none without words), one byte of each minimum, and the text's SimHash."""
    held = shingles(text, shingle)
    key = xxhash.xxh64_intdigest(held.tobytes(), 42)
    least = minima(held)
    keys = []
    if len(held):
        mixed = (least.reshape(BANDS, ROWS) ^ (least.reshape(BANDS, ROWS) >> np.uint64(29))) * _SPREAD
        total = mixed.sum(axis=1, dtype=np.uint64)
        keys = (total ^ (total >> np.uint64(32))).view(np.int64).tolist()
    fp = int(np.uint64(key).astype(np.int64))
    marks = (least >> np.uint64(20)).astype(np.uint8).tobytes()
    return {"fp": fp, "bands": keys, "minima": marks, "print": fingerprint(text, shingle)}


_MARKS = T.StructType(
    [
        T.StructField("fp", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("minima", T.BinaryType()),
        T.StructField("print", T.LongType()),
    ]
)


def simhash_stars(sets: DataFrame) -> DataFrame:
    """Candidates (a, b) among ``sets`` (fp, bands, print) with words: equal or close SimHashes, as stars."""
    worded = sets.where(F.size("bands") > 0)
    first = checkpoint(worded.groupBy("print").agg(F.min("fp").alias("first")))
    equal = worded.join(first, "print").where("fp <> first").select(F.col("fp").alias("a"), F.col("first").alias("b"))
    links = fingerprint_links(first.select(F.col("print").alias("fp")))
    ends = [first.select(F.col("print").alias(c), F.col("first").alias(f"first_{c}")) for c in ("a", "b")]
    close = links.join(ends[0], "a").join(ends[1], "b")
    close = close.select(F.greatest("first_a", "first_b").alias("a"), F.least("first_a", "first_b").alias("b"))
    return equal.unionByName(close)


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None  # many pairs in a row have the same b
        for batch in batches:
            keep = []
            ends = batch.column("b").to_pylist()
            for k, (b, one, other) in enumerate(zip(ends, texts_of(batch, "text_a"), texts_of(batch, "text_b"), strict=True)):
                if b != last or held is None:
                    last, held = b, shingles(other, shingle)
                if similarity(shingles(one, shingle), held) >= least:
                    keep.append(k)
            yield batch.select(["a", "b"]).take(pa.array(keep, type=pa.int64()))

    left = texts.select(F.col("fp").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("fp").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def band_links(band: int, root: np.ndarray, marks: np.ndarray, bands: np.ndarray, sets: list, least: float) -> list:
    """Places (i, j) of links that connect the members of a band whose sets are similar but whose roots differ.

    Pairs are left out that meet in an earlier band as well, that an earlier link connects, or whose
    ``marks`` agree in a share below ``LIKELY``.
    """
    label, out = np.unique(root, return_inverse=True)[1], []
    for i in range(len(root) - 1):
        apart = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        apart = apart[(marks[apart] == marks[i]).mean(axis=1) >= LIKELY]
        if not len(apart):
            continue
        meet = (bands[apart] == bands[i]).argmax(axis=1)
        for j in apart[bands[i][meet] == band].tolist():
            if label[i] != label[j] and similarity(sets[i], sets[j]) >= least:
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def _cross(shingle: int, least: float):
    """Rows (band, fp, root, minima, bands, text) in order of bands -> links (a, b) inside each band."""

    def links_of(rows: pa.Table) -> pa.RecordBatch:
        root, fp = (rows.column(n).to_numpy() for n in ("root", "fp"))
        marks = np.frombuffer(b"".join(rows.column("minima").to_pylist()), dtype=np.uint8).reshape(len(fp), -1)
        bands = np.array(rows.column("bands").to_pylist(), dtype=np.int64)
        sets = [shingles(t or b"", shingle) for t in rows.column("text").cast(pa.binary()).to_pylist()]
        found = band_links(rows.column("band")[0].as_py(), root, marks, bands, sets, least)
        ends = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(fp[ends[:, 0]]), pa.array(fp[ends[:, 1]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now])
            band = now.column("band").to_numpy()
            cuts = [0, *(np.flatnonzero(band[1:] != band[:-1]) + 1).tolist()]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                yield links_of(now.slice(begin, end - begin))
            held = now.slice(cuts[-1])  # the last band may go on
        if held is not None and len(held):
            yield links_of(held)

    return run


def near_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    least: float = SIMILARITY,
) -> DataFrame:
    """(doc_id, fp, row, component_id): a row for each document; ``fp`` is a key of its set of shingles.

    ``component_id`` is the smallest id reachable by links between documents of similarity ``least`` or
    more. Texts without words are equal to each other, null texts are such. Null ids never become a
    component's id; a component of null ids only has a null one. ``row`` is a hash of all the document's
    columns. Repeated rows give repeated results, an empty table gives none.
    """
    base = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(*docs.columns).alias("row")
    )
    marked = append_struct(
        base, lambda batch: [_marks(t, shingle) for t in texts_of(batch, "text")], "marks", _MARKS
    )
    prints = checkpoint(marked.select("doc_id", "row", "marks.*"))
    sets = prints.groupBy("fp").agg(
        F.min("doc_id").alias("least"),
        F.min(F.struct("row", "bands", "minima", "print")).alias("one"),
    )
    sets = checkpoint(sets.select("fp", "least", "one.*"))

    placed = sets.select("fp", F.explode("bands").alias("band"))
    shared = placed.groupBy("band").agg(F.min("fp").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = checkpoint(placed.join(shared, "band").where("fp <> first"))
    stars = members.select(F.col("fp").alias("a"), F.col("first").alias("b")).unionByName(simhash_stars(sets))
    stars = checkpoint(stars.distinct())

    named = members.select("fp").unionByName(stars.select(F.col("a").alias("fp")))
    named = named.unionByName(stars.select(F.col("b").alias("fp"))).distinct()
    wanted = sets.join(named, "fp").select("fp", "row")
    texts = base.select("row", "text").join(wanted, "row").groupBy("fp").agg(F.first("text").alias("text"))
    texts = checkpoint(texts)

    links = checkpoint(_confirmed(stars, texts, shingle, least))
    roots = connected_components(links).withColumnRenamed("node", "fp")
    others = members.where("n > 2").select("band", "fp").join(roots, "fp", "left")
    others = checkpoint(others.select("band", "fp", F.coalesce("root", "fp").alias("root")))
    split = others.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    rest = others.join(split.select("band"), "band")
    rest = rest.join(sets.select("fp", "minima", "bands"), "fp").join(texts, "fp")
    rest = rest.select("band", "fp", "root", "minima", "bands", "text").repartition("band")
    more = rest.sortWithinPartitions("band", "fp").mapInArrow(_cross(shingle, least), "a long, b long")
    return with_components(prints.select("doc_id", "fp", "row"), sets.select("fp", "least"), links.unionByName(more))


def keep_one(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    least: float = SIMILARITY,
) -> DataFrame:
    """One document of each component of near copies, the one with the smallest id (then row hash).

    Documents of components without any id all stay, but equal rows of them once.
    """
    return first_of_each(docs, near_copies(docs, doc_id, text, shingle, least), doc_id)
