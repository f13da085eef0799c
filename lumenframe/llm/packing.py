"""Operator 5: bounded-space online packing of token ids into fixed windows.

Each task reads its documents once. A document's ids are cut into full windows and a rest; the rest goes
into the open window that it fills best. When it fits into none, the fullest open window is topped up with
the rest's head (if the gap is worth a cut) and emitted, and a new one opens. A task holds a fixed number of
open windows, whatever it reads. The windows still open at its end are leftovers; they meet in groups of a
fixed number of tasks and are packed once more, and there only the last window of a group stays short.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import crc_of_bytes, whole
from lumenframe.llm.tokens import default_path, encoder, read_definition
from lumenframe.session import checkpoint

WINDOW = 1024
OPEN_WINDOWS = 64
#: A gap of fewer tokens is left as padding rather than cut a document for it.
LEAST_CUT = 8
#: Tasks whose leftovers are packed together.
MERGED_TASKS = 16
END_ID = 0
_GROUP_BITS = 40

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("left", T.IntegerType()),
    ]
)


@dataclass
class Piece:
    """A run of a document's ids (4 bytes each) from ``start`` on; parts share its memory."""

    doc_id: int | None
    start: int
    ids: memoryview
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def cut(self, at: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[: 4 * at], self.doc_tokens)
        return head, Piece(self.doc_id, self.start + at, self.ids[4 * at :], self.doc_tokens)


@dataclass
class Packer:
    """Open windows of one task; ``add`` yields the windows that are emitted."""

    window: int = WINDOW
    most: int = OPEN_WINDOWS
    least_cut: int = LEAST_CUT
    pieces: list[list[Piece]] = field(default_factory=list)
    free: list[int] = field(default_factory=list)

    def _emit(self, k: int) -> list[Piece]:
        done = self.pieces[k]
        self.pieces[k], self.free[k] = self.pieces[-1], self.free[-1]
        self.pieces.pop()
        self.free.pop()
        return done

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while piece.length >= self.window:
            head, piece = piece.cut(self.window)
            yield [head]
        if not piece.length:
            return
        piece.ids = memoryview(bytes(piece.ids))  # an open window does not hold on to a long document
        gap, k = min(((f, k) for k, f in enumerate(self.free) if f >= piece.length), default=(0, -1))
        if k < 0 and len(self.free) >= self.most:
            gap, fullest = min((f, k) for k, f in enumerate(self.free))
            if gap >= self.least_cut:
                head, piece = piece.cut(gap)
                self.pieces[fullest].append(head)
            yield self._emit(fullest)
        if k < 0:
            self.pieces.append([piece])
            self.free.append(self.window - piece.length)
            return
        self.pieces[k].append(piece)
        self.free[k] -= piece.length
        if not self.free[k]:
            yield self._emit(k)

    def merged(self) -> Iterator[list[Piece]]:
        """Ends the packing: the emptiest windows are poured into the fullest until one is short."""
        by_space = sorted(range(len(self.free)), key=lambda k: (self.free[k], k))
        full = [self.pieces[k] for k in by_space]
        free = [self.free[k] for k in by_space]
        self.pieces, self.free = [], []
        first = 0
        while first < len(full):
            while free[first] >= self.least_cut and len(full) - 1 > first:
                piece = full[-1].pop()
                head, rest = piece.cut(min(piece.length, free[first]))
                full[first].append(head)
                free[first] -= head.length
                if rest.length:
                    full[-1].append(rest)
                elif not full[-1]:
                    full.pop()
                    free.pop()
            yield full[first]
            first += 1


class _Rows:
    """Numbers sequences and gathers their pieces as Arrow batches."""

    def __init__(self, first_sequence: int, with_ids: bool) -> None:
        self._next, self._with_ids, self._rows, self._bytes = first_sequence, with_ids, [], 0

    def put(self, pieces: list[Piece], left: int | None = None) -> None:
        offset = 0
        for p in pieces:
            ids = bytes(p.ids) if self._with_ids or left is not None else None
            row = (p.doc_id, p.start, p.length, crc_of_bytes(p.ids), p.doc_tokens, self._next, offset, ids, left)
            self._rows.append(row)
            self._bytes += len(ids or b"")
            offset += p.length
        self._next += 1

    def full(self) -> bool:
        return len(self._rows) >= 20_000 or self._bytes >= 8 << 20

    def taken(self) -> pd.DataFrame:
        rows, self._rows, self._bytes = self._rows, [], 0
        frame = pd.DataFrame(rows, columns=PIECES.names)
        return frame.astype({"doc_id": "Int64", "left": "Int32"})


def _pack_task(definition: str, end_id: int, settings: tuple[int, int, int], with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encode, end = encoder(definition), np.array([end_id], dtype="<u4").tobytes()
        packer, rows = Packer(*settings), _Rows(task << _GROUP_BITS, with_ids)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = memoryview(encode(text) + end)
                one = Piece(None if pd.isna(doc_id) else int(doc_id), 0, ids, len(ids) // 4)
                for window in packer.add(one):
                    rows.put(window)
                if rows.full():
                    yield rows.taken()
        for window in packer.pieces:
            rows.put(window, left=task // MERGED_TASKS)
        yield rows.taken()

    return run


def _merge_group(settings: tuple[int, int, int], with_ids: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["left"].iloc[0])
        frame = frame.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True])
        packer = Packer(*settings)
        rows = _Rows((group << _GROUP_BITS) | (1 << (_GROUP_BITS - 1)), with_ids)
        for p in frame.itertuples(index=False):
            doc_id = None if pd.isna(p.doc_id) else int(p.doc_id)
            for window in packer.add(Piece(doc_id, int(p.start), memoryview(bytes(p.ids)), int(p.doc_tokens))):
                rows.put(window)
        for window in packer.merged():
            rows.put(window)
        return rows.taken()

    return run


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    least_cut: int = LEAST_CUT,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of all documents.

    Every id of a document, and ``end_id`` after them, lies in exactly one piece. A null or empty text
    consists of the end id; a null id stays null; repeated rows are packed once each; an empty table has no
    pieces. ``ids`` holds 4 little-endian bytes per id, or null unless ``with_ids``. Sequence numbers hold the
    task (or the group of merged tasks) in their high bits.
    """
    definition = read_definition(tokenizer or default_path())
    settings = (window, open_windows, least_cut)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    packed = checkpoint(rows.mapInPandas(_pack_task(definition, end_id, settings, with_ids), PIECES))
    merged = packed.where("left is not null").groupBy("left").applyInPandas(_merge_group(settings, with_ids), PIECES)
    return packed.where("left is null").unionByName(merged).drop("left")
