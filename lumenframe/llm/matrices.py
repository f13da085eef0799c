"""Operator 7: token-id matrices by best-fit-decreasing packing.

A task packs its documents block by block (a fixed number of tokens, thousands of windows), so its memory
does not depend on what it reads. Inside a block the pieces are placed from the longest to the shortest,
each into the open window with the least space that still holds it. A segment tree over the capacities
0 .. window tells in log(window) steps which capacity that is. Documents longer than a window are cut into
full windows and a rest; nothing is truncated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import whole
from lumenframe.llm.tokens import default_path, encoder, read_definition

WINDOW = 2048
#: Tokens packed together; a block is whole documents, the last one may pass the bound.
BLOCK_TOKENS = 2_000_000
END_ID = 50256
_TASK_BITS = 40

ROWS = T.StructType(
    [
        T.StructField("sequence_id", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("positions", T.BinaryType()),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("n_tokens", T.IntegerType()),
    ]
)


class CapacityTree:
    """Open windows by free space; a segment tree over the capacities finds the least that suffices."""

    def __init__(self, window: int) -> None:
        self._leaves = 1 << window.bit_length()
        self._held = [0] * (2 * self._leaves)  # windows below each node
        self._at: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, window: int, free: int) -> None:
        self._at[free].append(window)
        self._count(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes a window with the least free space >= need; (window, free), or None."""
        held, node = self._held, self._leaves + need
        if not held[node]:
            while node & 1 or not held[node + 1]:  # up to the first node with a filled right neighbour
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self._leaves:
                node = 2 * node if held[2 * node] else 2 * node + 1
        free = node - self._leaves
        self._count(free, -1)
        return self._at[free].pop(), free

    def _count(self, free: int, change: int) -> None:
        node = self._leaves + free
        while node:
            self._held[node] += change
            node >>= 1


def best_fit_decreasing(sizes: list[int], window: int) -> list[list[int]]:
    """Windows as lists of places in ``sizes``; equal sizes keep their order. Every size is 1 .. window."""
    tree, windows = CapacityTree(window), []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        size = sizes[k]
        found = tree.take(size)
        if found is None:
            found = len(windows), window
            windows.append([])
        at, free = found
        windows[at].append(k)
        if free > size:
            tree.put(at, free - size)
    return windows


def packed_rows(
    docs: list[tuple[int | None, np.ndarray]], window: int, first: int, end_id: int
) -> Iterator[tuple]:
    """The rows of one block of (document, ids)."""
    pieces = [
        (doc, at, ids[at : at + window]) for doc, ids in docs for at in range(0, len(ids), window)
    ]
    for k, held in enumerate(best_fit_decreasing([len(p[2]) for p in pieces], window)):
        parts = [pieces[i] for i in held]
        sizes = [len(p[2]) for p in parts]
        ends = np.cumsum(sizes)
        row = np.full(window, end_id, dtype="<u4")
        row[: ends[-1]] = np.concatenate([p[2] for p in parts])
        position = np.zeros(window, dtype="<u4")  # from 0 in each piece; 0 in the padding
        position[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        yield (
            first + k,
            row.tobytes(),
            position.tobytes(),
            [0, *ends.tolist()],
            [p[0] for p in parts],
            [p[1] for p in parts],
            int(ends[-1]),
        )


def pack_matrices(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """A row of each id matrix: ``ids`` and ``positions`` (``window`` little-endian uint32 each, padded with
    the end id and 0), ``cu_seqlens`` (0 and the end of every segment), and which document and which of
    its tokens each segment begins with.

    Each document ends in ``end_id``; a null or empty text is that id alone; a null id stays null; repeated
    rows are packed once each; an empty table gives no rows. Positions begin anew with every segment.
    """
    definition = read_definition(tokenizer or default_path())
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end = encoder(definition), np.array([end_id], dtype="<u4").tobytes()
        held: list[tuple[int | None, np.ndarray]] = []
        tokens, number = 0, TaskContext.get().partitionId() << _TASK_BITS

        def written() -> Iterator[pa.RecordBatch]:
            nonlocal held, tokens, number
            rows = list(packed_rows(held, window, number, end_id))
            held, tokens, number = [], 0, number + len(rows)
            for at in range(0, len(rows), 256):
                columns = zip(*rows[at : at + 256], strict=True)
                arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(encode(value) + end, dtype="<u4")
                held.append((doc, ids))
                tokens += len(ids)
                if tokens >= block_tokens:
                    yield from written()
        yield from written()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    return rows.mapInArrow(run, ROWS)


def write_matrices(packed: DataFrame, path: str) -> None:
    """Writes the rows as Parquet through Spark's committer, so that a lost executor leaves no half file."""
    packed.write.parquet(path)


def matrix(rows: list, column: str = "ids") -> np.ndarray:
    """Collected rows (a batch for training) as a matrix of numbers."""
    return np.stack([np.frombuffer(r[column], dtype="<u4") for r in rows])
