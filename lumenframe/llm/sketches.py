"""Operator 9: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, whatever the document's length.
So sketches merge by union, and the share of the smaller sketch found in the larger estimates containment
also between very unequal documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import blank_words, shuffle_width, whole

SHINGLE = 5
#: One in so many hashes is kept.
SCALE = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _finished(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of each hash over the whole range."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """A hash for each run of ``shingle`` lower-cased words; fewer words are one shingle, none no shingle."""
    words = blank_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total = total * _MIX + each[k : k + n]
    return _finished(total)


def sketch(text: bytes, shingle: int = SHINGLE, scale: int = SCALE) -> np.ndarray:
    """The sorted distinct hashes below 2^64 / scale; if there are shingles but none so low, the lowest."""
    hashes = shingle_hashes(text, shingle)
    kept = np.unique(hashes[hashes < np.uint64((1 << 64) // scale)])
    return hashes.min(keepdims=True) if len(hashes) and not len(kept) else kept


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two documents together."""
    return np.union1d(a, b)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smaller sketch found in the larger; 1 for two empty ones, 0 for one empty one."""
    small, large = sorted((a, b), key=len)
    if not len(small):
        return float(not len(large))
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return float((large[at] == small).mean())


def as_text(s: np.ndarray) -> str:
    return s.astype(">u8").tobytes().hex()


def edited_text(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the next text's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def with_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, visitor, key, doc_id, text), dealt out by ranges of ids, one shuffle of the texts.

    The first document of each range also visits the range before it (that of the first range, the last
    one), where it sorts last: every document then meets the next one in its own task.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        whole(text).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(lowest)).alias("key"),
    )
    width = 4 * shuffle_width(spark)  # several ranges a task even its load out
    cuts = rows.agg(F.percentile_approx("key", [k / width for k in range(1, width)], 100 * width)).first()[0] or []
    bounds = np.unique(np.array(cuts, dtype=np.int64))

    @F.pandas_udf("int")
    def bucket_of(keys):
        return keys.__class__(np.searchsorted(bounds, keys.to_numpy(), side="left")).astype("int32")

    placed = rows.withColumn("bucket", bucket_of("key"))
    # Ties of an id are ordered by a hash of the text, so a range has one first text.
    placed = placed.withColumn("tie", F.xxhash64("text"))
    firsts = placed.groupBy("bucket").agg(F.min(F.struct("key", "tie")).alias("first")).orderBy("bucket").collect()
    hosts = {}  # one entry for each range
    for k, r in enumerate(firsts):
        hosts[r["bucket"]] = (firsts[k - 1]["bucket"], r["first"]["key"], r["first"]["tie"])
    if not hosts:
        return placed.select("bucket", F.lit(False).alias("visitor"), "key", "tie", "doc_id", "text")
    table = spark.createDataFrame(
        [(b, *h) for b, h in hosts.items()], "bucket int, host int, first_key long, first_tie long"
    )
    joined = placed.join(F.broadcast(table), "bucket")
    is_first = (F.col("key") == F.col("first_key")) & (F.col("tie") == F.col("first_tie"))
    at_home = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("visitor"))
    away = F.struct(F.col("host").alias("bucket"), F.lit(True).alias("visitor"))
    seats = F.when(is_first, F.array(at_home, away)).otherwise(F.array(at_home))
    return joined.select(F.explode(seats).alias("seat"), "key", "tie", "doc_id", "text").select(
        "seat.bucket", "seat.visitor", "key", "tie", "doc_id", "text"
    )


def fingerprint_edits(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, scale: int = SCALE
) -> DataFrame:
    """One row per document: its sketch, that of its edited text, and how alike they and the next one are.

    The next document is that with the next id (null ids first, ties by a hash of the text), after the last
    one the first; a single document is its own next. Null texts are empty. Repeated rows follow each other
    and get a row each. A text without words has an empty fingerprint. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, out = None, []

        def finish(row: tuple, following: tuple) -> dict:
            _, doc, value, own = row
            edited = edited_text(value, following[2]).encode()
            changed = sketch(edited, shingle, scale)
            return {
                "doc_id": doc,
                "n_chars": len(value),
                "edited_sha256": hashlib.sha256(edited).hexdigest(),
                "fingerprint": as_text(own),
                "edited_fingerprint": as_text(changed),
                "near_edited": containment(own, changed),
                "near_next": containment(own, following[3]),
            }

        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("bucket", "visitor", "doc_id", "text"))
            for bucket, visitor, doc, value in zip(*columns, strict=True):
                if visitor and before is None:
                    continue  # a second visitor with the same text
                now = (bucket, doc, value, sketch(value.encode(), shingle, scale))
                if before is not None:
                    out.append(finish(before, now))
                before = None if visitor else now
                if len(out) >= 500:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(RESULT)
    seated = with_neighbours(docs, doc_id, text).repartition(shuffle_width(docs.sparkSession), "bucket")
    return seated.sortWithinPartitions("bucket", "visitor", "key", "tie").mapInArrow(run, RESULT)
