"""Operator 13: bulk-synchronous best-fit packing of documents into fixed windows.

Documents longer than the window are cut into whole windows; what is left, at most one piece a document, is
packed. Pieces above half the window open a sequence each (no two of them can share one). Then, round by
round, the other pieces and the gaps are range-sorted together, largest first, a gap before a piece of its
size. Each range is swept in one task: gaps are stacked, and a piece takes the gap on top, which is its
successor, the smallest that holds it. Equal pieces fill a gap as often as they fit, as best-fit would do.
Pieces that found no gap in their range and gaps that found no piece are ranked in it; the ranges are swept
like the rows, by their counts, and the ranks say which piece goes to which gap. Gaps are updated, and the
next round begins; a gap that holds no remaining piece is closed, and as many windows open as the tokens beyond
the space of the other gaps fill at least.

A gap takes part in few rounds, as what is left of it is smaller than what it took, and a row is moved
as a size and two numbers. Only the counts of the ranges pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import astuple, dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import crc_of_bytes, shuffle_width, whole
from lumenframe.llm.tokens import default_path, encoder, read_definition
from lumenframe.session import checkpoint

WINDOW = 1024
END_ID = 2
GAP, PIECE, PLACED = 0, 1, 2
#: Rows of sizes that a task of a round goes through at least.
TASK_ROWS = 20_000
_NONE = np.iinfo(np.int64).min

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
#: Rows after a sweep; a range adds one row of what it left over (``pieces`` to ``smallest``, no kind).
_SWEPT = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        *(T.StructField(c, T.LongType()) for c in ("id", "size", "sequence_id", "rank")),
        T.StructField("range", T.IntegerType()),
        *(T.StructField(c, T.LongType()) for c in ("pieces", "largest", "gaps", "smallest")),
    ]
)


# --- pieces -----------------------------------------------------------------------------


def cut_starts(n: int, window: int) -> list[int]:
    """Where the pieces of ``n`` tokens begin: whole windows, a shorter piece in front."""
    first = n % window or window
    return [0, *range(first, n, window)]


def _pieces(definition: str, end_id: int, window: int, with_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(definition), np.array([end_id], dtype="<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text) + end
                starts = cut_starts(len(ids) // 4, window)
                for k, (start, stop) in enumerate(zip(starts, [*starts[1:], len(ids) // 4], strict=True)):
                    part = ids[4 * start : 4 * stop]
                    rows.append((doc_id, k, start, stop - start, crc_of_bytes(part), part if with_ids else None))
                if len(rows) >= 20_000:
                    yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
                    rows = []
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return run


# --- one round --------------------------------------------------------------------------


@dataclass
class Run:
    """Gaps of one size, or pieces of one size, that stand in a row: places ``at`` to ``end``."""

    size: int
    at: int
    end: int

    @property
    def n(self) -> int:
        return self.end - self.at


def sweep(size: np.ndarray, kind: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit within sorted rows (largest first, gaps before pieces of their size).

    Returns for each row the gap it is placed in (``_NONE``: in none), what a gap has left, and the rank of a piece or gap
    that found no partner (-1: it found one); pieces are ranked from the largest, gaps from the smallest.
    """
    target, rank, left = np.full(len(size), _NONE), np.full(len(size), -1, dtype=np.int64), size.copy()
    edges = np.flatnonzero((size[1:] != size[:-1]) | (kind[1:] != kind[:-1])) + 1
    cuts = [0, *edges.tolist(), len(size)] if len(size) else [0]
    stack: list[Run] = []
    missed = 0
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        now = Run(int(size[begin]), begin, end)
        if kind[begin] == GAP:
            stack.append(now)
            continue
        while now.n and stack:
            gaps = stack[-1]
            times = gaps.size // now.size
            used = min(gaps.n, -(-now.n // times))
            placed = min(now.n, used * times)
            takes = gaps.end - 1 - np.arange(placed) // times  # from the end of the run, times pieces each
            target[now.at : now.at + placed] = key[takes]
            np.subtract.at(left, takes, now.size)
            now.at += placed
            gaps.end -= used
            if not gaps.n:
                stack.pop()
        rank[now.at : now.end] = np.arange(missed, missed + now.n)
        missed += now.n
    free = 0
    for gaps in reversed(stack):
        rank[gaps.at : gaps.end] = np.arange(free + gaps.n - 1, free - 1, -1)
        free += gaps.n
    return target, left, rank


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range: numbers of its rows only are held."""
    held = [[b.column(n).to_numpy() for n in ("size", "kind", "id", "range")] for b in batches if b.num_rows]
    if not held:
        return
    size, kind, key, place = (np.concatenate(c) for c in zip(*held, strict=True))
    target, left, rank = sweep(size, kind, key)
    missed, free = size[(rank >= 0) & (kind == PIECE)], size[(rank >= 0) & (kind == GAP)]
    said = [len(missed), missed.max(initial=0), len(free), free.min(initial=1 << 40)]
    columns = {
        "kind": pa.array(kind, type=pa.int32()),
        "id": pa.array(key),
        "size": pa.array(left),
        "sequence_id": pa.array(target, mask=target == _NONE),
        "rank": pa.array(rank, mask=rank < 0),
        "range": pa.array(place, type=pa.int32()),
    }
    kinds = {f.name: pa.int32() if f.dataType == T.IntegerType() else pa.int64() for f in _SWEPT.fields}
    rows = {n: columns.get(n, pa.nulls(len(size), type=k)) for n, k in kinds.items()}
    yield from pa.table(rows).to_batches(max_chunksize=50_000)
    last = {"range": place[0]} | dict(zip(("pieces", "largest", "gaps", "smallest"), said, strict=True))
    yield pa.RecordBatch.from_pydict({n: pa.array([last.get(n)], type=k) for n, k in kinds.items()})


@dataclass(frozen=True)
class Match:
    """Pieces ``first`` to ``last`` of a range go to gaps of another one, ``times`` each, from ``gap`` on."""

    range: int
    first: int
    last: int
    gap_range: int
    gap: int
    times: int


def cross_matches(ranges: Sequence[tuple[int, int, int, int, int]]) -> list[Match]:
    """(range, pieces, largest piece, gaps, smallest gap) of what each range left over, ranges from large sizes on.

    The ranges are swept like rows: their gaps are stacked, their pieces take from the top of the stack. Gaps of a
    range lie after its pieces in the sweep, since each of them is smaller than any piece left over before it.
    """
    stack: list[list[int]] = []  # range, next rank, end, smallest size
    out = []
    for place, pieces, largest, gaps, smallest in sorted(ranges):
        at = 0
        while at < pieces and stack:
            top = stack[-1]
            times = max(1, top[3] // largest)
            used = min(top[2] - top[1], -(-(pieces - at) // times))
            placed = min(pieces - at, used * times)
            out.append(Match(place, at, at + placed, top[0], top[1], times))
            at += placed
            top[1] += used
            if top[1] == top[2]:
                stack.pop()
        if gaps:
            stack.append([place, 0, gaps, smallest])
    return out


def _round(rows: DataFrame, width: int) -> DataFrame:
    """Rows (size, kind, id) of gaps and pieces -> gaps as they are now, pieces left, and placed pieces.

    The sweep is written before it is read again: bounds of ranges come from sampling. ``width`` tasks go
    through the rows.
    """
    order = [F.col("size").desc(), F.col("kind"), F.col("id")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    swept = ordered.select("size", "kind", "id", F.spark_partition_id().alias("range")).mapInArrow(_swept, _SWEPT)
    swept = checkpoint(swept.coalesce(width))
    said = swept.where("kind is null").select("range", "pieces", "largest", "gaps", "smallest").collect()
    matches = cross_matches([tuple(r) for r in said])
    piece, gap = F.col("kind") == PIECE, F.col("kind") == GAP
    placed = F.when(piece & F.col("sequence_id").isNotNull(), PLACED).otherwise(F.col("kind"))
    names = ("m_range", "first", "last", "gap_range", "gap", "times")
    values = [astuple(m) for m in matches]
    # At most two rows per range; the ranges are as many as the shuffle partitions.
    table = pa.table({n: pa.array([v[k] for v in values], type=pa.int64()) for k, n in enumerate(names)})
    within = piece & (F.col("range") == F.col("m_range")) & F.col("rank").between(F.col("first"), F.col("last") - 1)
    sent = swept.where("kind is not null").join(F.broadcast(rows.sparkSession.createDataFrame(table)), within, "left")
    target = F.col("gap") + F.floor((F.col("rank") - F.col("first")) / F.col("times"))
    sent = sent.withColumns(
        {
            "to_range": F.when(gap & F.col("rank").isNotNull(), F.col("range")).otherwise(F.col("gap_range")).cast("int"),
            "to_rank": F.when(gap, F.col("rank")).otherwise(target),
        }
    )
    rest = sent.where("to_range is null").select("size", placed.alias("kind"), "id", "sequence_id")
    # A gap and the pieces sent to it meet in one group, at most a window's worth of rows.
    same = Window.partitionBy("to_range", "to_rank")
    holder = F.max(F.when(gap, F.col("id"))).over(same)
    taken = F.coalesce(F.sum(F.when(piece, F.col("size"))).over(same), F.lit(0))
    met = sent.where("to_range is not null").select(
        F.when(gap, F.col("size") - taken).otherwise(F.col("size")).alias("size"),
        F.when(piece, PLACED).otherwise(F.col("kind")).alias("kind"),
        "id",
        F.when(piece, holder).alias("sequence_id"),
    )
    return rest.unionByName(met).coalesce(width)


def _numbered_gaps(like: DataFrame, first: int, n: int, window: int) -> DataFrame:
    """``n`` empty windows with the numbers below ``-first``."""
    return like.sparkSession.range(n).select(
        F.lit(window).cast("long").alias("size"), F.lit(GAP).alias("kind"), (-F.col("id") - 1 - first).alias("id")
    )


@dataclass(frozen=True)
class State:
    """Pieces and their tokens, the smallest piece, gaps and their tokens, the largest gap."""

    pieces: int
    tokens: int
    smallest: int
    gaps: int
    space: int
    largest: int


def _state(rows: DataFrame, least: int = 1) -> State:
    """Gaps below ``least`` do not count."""
    piece = F.when(F.col("kind") == PIECE, F.col("size"))
    gap = F.when((F.col("kind") == GAP) & (F.col("size") >= least), F.col("size"))
    found = rows.agg(F.count(piece), F.sum(piece), F.min(piece), F.count(gap), F.sum(gap), F.max(gap)).first()
    return State(*(v or 0 for v in found))


def _tasks(rows: int, most: int) -> int:
    """Tasks for so many rows of a few numbers, at most the width of a shuffle."""
    return max(1, min(most, -(-rows // TASK_ROWS)))


def placements(sizes: DataFrame, window: int = WINDOW) -> DataFrame:
    """``sizes`` (id >= 0, size <= window) -> (id, size, sequence_id, round): every piece placed in a sequence.

    Sequences opened by a piece have its id, the others negative numbers. No rows give no rows.
    """
    big = F.col("size") > window // 2
    opened = sizes.where(big).select("id", "size", F.col("id").alias("sequence_id"), F.lit(-1).alias("round"))
    gaps = sizes.where(big).select((window - F.col("size")).alias("size"), F.lit(GAP).alias("kind"), "id")
    rows = sizes.where(~big).select("size", F.lit(PIECE).alias("kind"), "id").unionByName(gaps)
    done, numbered, most = [opened], 0, shuffle_width(sizes.sparkSession)
    now = _state(rows)
    for turn in range(1 << 30):
        if not now.pieces:
            break
        rows = rows.where((F.col("kind") == PIECE) | (F.col("size") >= now.smallest))
        # No gap below the smallest piece is of use: the tokens beyond the space of the others need windows.
        wanted = -(-max(now.tokens - now.space, int(now.largest < now.smallest)) // window)
        width = _tasks(now.pieces + now.gaps + wanted, most)
        if wanted:
            rows = rows.unionByName(_numbered_gaps(rows, numbered, wanted, window))
            numbered += wanted
        after = checkpoint(_round(rows.coalesce(width), width))
        done.append(after.where(F.col("kind") == PLACED).select("id", "size", "sequence_id", F.lit(turn).alias("round")))
        rows = after.where(F.col("kind") != PLACED).select("size", "kind", "id")
        now = _state(rows, now.smallest)
    return reduce(DataFrame.unionByName, done)


def pack_best_fit(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset) of all documents.

    A document is its token ids and ``end_id``; only one longer than the window is cut, into whole windows and
    a shorter piece in front. A null or empty text consists of the end id. Ids have to be integers, a null one stays
    null; repeated rows are packed once each, an empty table has no pieces. A text of any length takes a few times its
    bytes. ``ids`` holds 4 little-endian bytes per id, or null unless ``with_ids``. Ties between equal sizes
    go by the place of the document in the table.
    """
    definition = read_definition(tokenizer or default_path())
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    pieces = checkpoint(rows.mapInPandas(_pieces(definition, end_id, window, with_ids), _PIECES))
    pieces = pieces.withColumn("id", F.monotonically_increasing_id())  # of written rows: always the same
    full = F.col("length") == window
    alone = pieces.where(full).withColumns({"sequence_id": F.col("id"), "offset": F.lit(0).cast("long")})
    small = pieces.where(~full)
    placed = placements(small.select("id", F.col("length").alias("size")), window)
    before = Window.partitionBy("sequence_id").orderBy("round", F.desc("size"), "id")
    offset = F.coalesce(F.sum("size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = placed.select("id", "sequence_id", offset.alias("offset"))
    return small.join(places, "id").unionByName(alone).drop("id")
