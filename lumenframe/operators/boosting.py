"""Gradient-boosted trees on histograms: one pass over the rows per tree level, for all classes and fits at once.

Features are binned once, by quantiles, into one byte each, and rows are kept as column blocks. A level of a
round is one job: tasks sum gradients per (tree, node, feature, bin) over their blocks, the sums meet by
(tree, node, features) and only the best split of each comes back (sums of a few MB meet on the driver). The trees of all classes grow in the same
job (softmax gradients, not one against the rest), and so do fits with other settings, folds or training
shares: a grid search or a learning curve takes as many jobs as its longest fit. Leaf values follow from the
sums of the last level. Margins are written every few rounds; between, tasks add the newest trees.

Levels of few rows cost more as jobs than as sums. So if the binned rows are small (``ALONE_BYTES``) and each fit would take
longer in jobs, every fit grows in a task of its own, which holds all binned rows.

What the driver holds are trees (and small binned rows, on their way to the tasks); what a task holds is a block and the sums of its level, a size given by
the settings. Binning, samples and ties do not depend on how rows are dealt out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.operators import sampling
from lumenframe.session import checkpoint

#: A bin number fits one byte.
BINS = 256
BLOCK_ROWS = 32_768
#: Features whose sums travel together.
CHUNK = 32
#: Rounds between two writings of the margins.
WRITE_EVERY = 16
#: Trees of all fits since then that tasks add at most: each level adds them to every row anew.
RECENT_TREES = 96
#: Sums of a level that weigh less, over all tasks, meet on the driver at once; a fit has hundreds of levels.
DIRECT_BYTES = 900_000
#: Sums (tree, node, chunk) that leave a task together.
SUMS_AT_ONCE = 256
#: Tasks of a level for each core: a task costs as much as some blocks.
TASKS_PER_CORE = 2

#: Binned rows (all together) that every task may hold, to grow fits by itself.
ALONE_BYTES = 160 << 20
#: Seconds, about: of a level as a job, and of a cell (row and column) in the sums of a task, alone and in a job.
LEVEL_SECONDS, CELL_SECONDS = 0.12, (8e-9, 16e-9)

_STATE = "n int, x binary, y binary, u binary, s binary, fold binary, f binary"
_SUMS = "tree int, node int, chunk int, sums binary"
_FITTED = "fit int, trees binary"
_BEST = "tree int, node int, feature int, bin int, gain double, low array<double>, high array<double>"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split(" ") for part in ddl.split(", "))])


@dataclass(frozen=True)
class Boosting:
    """Settings of a fit. ``penalty`` None: splits by squared error, leaves by one Newton step.

    A number: splits and leaves by second-order sums with that penalty on the squared leaf value.
    """

    rounds: int = 100
    depth: int = 4
    rate: float = 0.1
    sample: float = 1.0
    columns: float = 1.0
    min_rows: int = 1
    penalty: float | None = None
    seed: int = 42


@dataclass(frozen=True)
class Fit:
    """One of several fits: its settings, the fold it leaves out, and the share of the rows it learns from."""

    settings: Boosting
    held_out: int | None = None
    share: float = 1.0


@dataclass
class Tree:
    """Nodes in heap order (children of k: 2k + 1, 2k + 2); feature -1 marks a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n))

    def ends(self, levels: int) -> np.ndarray:
        """The node that each path of ``levels`` turns (its bits: right) ends at; a leaf ends it early."""
        at, path = np.zeros(1 << levels, np.int32), np.arange(1 << levels)
        for k in reversed(range(levels)):
            at = np.where(self.feature[at] >= 0, 2 * at + 1 + ((path >> k) & 1), at)
        return at

    def paths(self, x: np.ndarray, levels: int) -> np.ndarray:
        """The path of each row, in one byte (``levels`` up to 8): a comparison of a whole column for each split."""

        def below(k: int, left: int):
            if not left or self.feature[k] < 0:
                return np.uint8(0)
            right = -(x[:, self.feature[k]] > np.uint8(self.bin[k])).view(np.uint8)  # all bits set, or none
            low, high = below(2 * k + 1, left - 1), below(2 * k + 2, left - 1) | np.uint8(1 << (left - 1))
            return low ^ ((low ^ high) & right)

        return np.broadcast_to(below(0, levels), len(x))

    def nodes(self, x: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row (columns: features) after ``levels`` steps."""
        if levels <= 8:
            return self.ends(levels)[self.paths(x, levels)]
        at, every = np.zeros(len(x), np.int32), np.arange(len(x))
        for _ in range(levels):
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                break
            right = x[every, np.maximum(f, 0)] > self.bin[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at

    def values(self, x: np.ndarray) -> np.ndarray:
        levels = len(self.feature).bit_length() - 1  # nodes of the last level have no children
        return self.value[self.ends(levels)][self.paths(x, levels)] if levels <= 8 else self.value[self.nodes(x, levels)]


# --- losses -----------------------------------------------------------------------------


def gradients(loss: str, y: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Negative gradients and second derivatives (classes x rows), and the loss of each row."""
    if loss == "squared":
        g = (y - f[0])[None, :]
        return g, np.ones_like(g), 0.5 * g[0] ** 2
    if loss == "logistic":
        p = 1.0 / (1.0 + np.exp(-f[0]))
        return (y - p)[None, :], (p * (1 - p))[None, :], np.logaddexp(0.0, f[0]) - y * f[0]
    top = f.max(axis=0)
    total = np.exp(f - top).sum(axis=0)
    p = np.exp(f - top) / total
    hit = (np.arange(len(f))[:, None] == y[None, :]).astype(float)
    return hit - p, p * (1 - p), np.log(total) + top - f[y.astype(int), np.arange(len(y))]


def chance(key: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """A number in [0, 1) for each row key (32 bits) and round."""
    factor = np.uint64(np.random.default_rng([seed, turn]).integers(1 << 62) * 2 + 1)
    mixed = (key.astype(np.uint64) + np.uint64(1)) * factor
    mixed = (mixed ^ (mixed >> np.uint64(31))) * factor
    return (mixed >> np.uint64(11)) / float(1 << 53)


# --- binning ----------------------------------------------------------------------------


def bin_edges(rows: DataFrame, column: str, bins: int = BINS) -> list[np.ndarray]:
    """For each place of an array column the values that bound its bins: at most ``bins`` - 1 quantiles.

    Values of a place are counted per task before they meet, in sketches of a fixed size.
    """
    shares = [k / bins for k in range(1, bins)]
    cells = rows.select(F.posexplode(column).alias("place", "v")).where("v is not null and not isnan(v)")
    found = cells.groupBy("place").agg(
        F.percentile_approx("v", F.array(*[F.lit(s) for s in shares]), 20 * bins).alias("edges"), F.max("v").alias("top")
    )
    width = rows.agg(F.max(F.size(column))).first()[0] or 0
    edges = {r["place"]: np.unique(np.array(r["edges"]))[: bins - 1] for r in found.toLocalIterator()}
    return [edges.get(k, np.zeros(0)) for k in range(width)]


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """The number of edges below each value; a missing value goes with the largest."""
    columns = [np.searchsorted(e, x[:, k], side="left").astype(np.uint8) for k, e in enumerate(edges)]
    return np.stack(columns, axis=1) if columns else np.zeros((len(x), 0), np.uint8)


def _blocks(edges: Sequence[np.ndarray], start: np.ndarray):
    """Rows (x, y, u, s, fold) -> blocks with the first margins ``start`` (trees)."""

    def block(rows: pa.Table) -> dict:
        n = rows.num_rows
        x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)
        margins = np.repeat(start[:, None], n, axis=1)
        y, u, s, fold = (rows.column(c).to_numpy() for c in ("y", "u", "s", "fold"))
        return {
            "n": n,
            "x": binned(x, edges).tobytes(order="F"),
            "y": y.astype(np.float64).tobytes(),
            "u": u.astype(np.float64).tobytes(),
            "s": s.astype(np.uint32).tobytes(),
            "fold": fold.astype(np.int32).tobytes(),
            "f": margins.tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(_STATE)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield pa.RecordBatch.from_pylist([block(pa.Table.from_batches(held))], schema=schema)
                held = []
        if sum(b.num_rows for b in held):
            yield pa.RecordBatch.from_pylist([block(pa.Table.from_batches(held))], schema=schema)

    return run


@dataclass
class _Block:
    x: np.ndarray
    y: np.ndarray
    u: np.ndarray
    s: np.ndarray
    fold: np.ndarray
    f: np.ndarray

    @classmethod
    def read(cls, row: dict) -> _Block:
        n = row["n"]
        x = np.frombuffer(row["x"], np.uint8).reshape(-1, n).T  # column after column
        y, u = (np.frombuffer(row[c], np.float64) for c in ("y", "u"))
        f = np.frombuffer(row["f"], np.float64).reshape(-1, n).copy()
        return cls(x, y, u, np.frombuffer(row["s"], np.uint32), np.frombuffer(row["fold"], np.int32), f)

    @classmethod
    def whole(cls, columns: Sequence[list]) -> _Block:
        """The rows of all blocks (columns of ``_STATE``), without margins."""
        names = _arrow(_STATE).names
        parts = [cls.read(dict(zip(names, row, strict=True))) for row in zip(*columns, strict=True)]
        x = np.concatenate([p.x.T for p in parts], axis=1).T
        y, u, s, fold = (np.concatenate([getattr(p, c) for p in parts]) for c in ("y", "u", "s", "fold"))
        return cls(x, y, u, s, fold, np.zeros((0, len(y))))

    def part(self, first: int, end: int) -> _Block:
        return _Block(self.x[first:end], *(getattr(self, c)[first:end] for c in ("y", "u", "s", "fold")), self.f[:, first:end])

    def take(self, rows: np.ndarray) -> _Block:
        x, f = self.x.T.take(rows, axis=1).T, self.f.take(rows, axis=1)
        return _Block(x, *(getattr(self, c).take(rows) for c in ("y", "u", "s", "fold")), f)


def _read(batches: Iterator[pa.RecordBatch], recent: Sequence[Mapping[int, Tree]]) -> Iterator[tuple[dict, _Block]]:
    """Blocks with the margins after the ``recent`` trees (tree number -> tree) are added."""
    for batch in batches:
        for row in batch.to_pylist():
            block = _Block.read(row)
            for trees in recent:
                for t, tree in trees.items():
                    block.f[t] += tree.values(block.x)
            yield row, block


# --- a level ----------------------------------------------------------------------------


@dataclass
class Level:
    """What tasks need for one level: trees so far, the nodes to be split, the columns of each tree."""

    loss: str
    classes: int
    fits: Sequence[Fit]
    turn: int
    depth: int
    recent: Sequence[Mapping[int, Tree]]
    growing: dict[int, Tree] = field(default_factory=dict)
    active: dict[int, list[int]] = field(default_factory=dict)
    columns: dict[int, np.ndarray] = field(default_factory=dict)
    widths: Sequence[int] = ()  # bins of each feature

    def cells(self, t: int, chunk: int) -> tuple[list[int], np.ndarray]:
        """What travels of the sums of a chunk: the kinds, and for its columns which bins there are.

        Second derivatives of the squared loss are the numbers of rows.
        """
        part = self.columns[t][chunk * CHUNK : (chunk + 1) * CHUNK]
        return [0, 2] if self.loss == "squared" else [0, 1, 2], np.arange(BINS) < np.array(self.widths)[part][:, None]

    def packed(self, t: int, chunk: int, values: np.ndarray) -> np.ndarray:
        kinds, there = self.cells(t, chunk)
        return values[kinds][:, there].ravel()

    def unpacked(self, t: int, chunk: int, values: np.ndarray) -> np.ndarray:
        kinds, there = self.cells(t, chunk)
        made = np.zeros((3, *there.shape))
        for kind, part in zip(kinds, values.reshape(len(kinds), -1), strict=True):
            made[kind][there] = part
        if 1 not in kinds:
            made[1] = made[2]
        return made

    def learns(self, block: _Block, fit: Fit, drawn: dict[int, np.ndarray]) -> np.ndarray:
        s = fit.settings
        rows = (block.u < fit.share) & (block.fold != (-1 if fit.held_out is None else fit.held_out))
        if s.sample < 1:
            if s.seed not in drawn:
                drawn[s.seed] = chance(block.s, s.seed, self.turn)
            rows &= drawn[s.seed] < s.sample
        return rows

    def add(self, block: _Block, sums: dict[tuple[int, int, int], np.ndarray]) -> None:
        """Adds (gradient, second derivative, rows) of the block per (tree, node, chunk of columns)."""
        drawn: dict[int, np.ndarray] = {}
        for k, fit in enumerate(self.fits):
            own = [t for t in range(k * self.classes, (k + 1) * self.classes) if self.active.get(t)]
            if not own:
                continue
            rows = np.flatnonzero(self.learns(block, fit, drawn))
            y, margins = block.y[rows], block.f[k * self.classes : (k + 1) * self.classes][:, rows]
            g, h, lost = gradients(self.loss, y, margins)
            if self.depth == 0:
                key = (-1 - k, 0, 0)
                sums[key] = sums.get(key, 0) + np.array([lost.sum(), len(rows)])
            x = block.x if len(rows) == len(block.x) else block.x.T.take(rows, axis=1).T
            for t in own:
                nodes, columns = self.active[t], self.columns[t]
                place = np.full(2 ** (self.depth + 1), -1)
                place[nodes] = np.arange(len(nodes))
                at = place[self.growing[t].nodes(x, self.depth)]
                here, c = np.flatnonzero(at >= 0), t - k * self.classes
                whole = len(here) == len(at)
                first_cell = (at if whole else at[here]) * BINS
                weights = [w[c] if whole else w[c][here] for w in ((g,) if self.loss == "squared" else (g, h))]
                size = len(nodes) * BINS
                for chunk, first in enumerate(range(0, len(columns), CHUNK)):
                    part = columns[first : first + CHUNK]
                    made = np.zeros((3, len(nodes), len(part), BINS))
                    for j, column in enumerate(part):
                        cells = first_cell + (x[:, column] if whole else x[:, column][here])
                        counts = np.bincount(cells, minlength=size)
                        found = [np.bincount(cells, w, size) for w in weights]
                        found += [counts] * (3 - len(found))  # second derivatives of the squared loss are 1
                        for i, values in enumerate(found):
                            made[i, :, j] = values.reshape(len(nodes), BINS)
                    for i, node in enumerate(nodes):
                        key = (t, node, chunk)
                        sums[key] = sums.get(key, 0) + made[:, i]

    def size(self) -> int:
        """Bytes of the sums of one task, at most."""
        weight = 16 if self.loss == "squared" else 24
        widths = np.array(self.widths)
        return sum(len(nodes) * int(widths[self.columns[t]].sum()) * weight for t, nodes in self.active.items())

    def tasks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for _, block in _read(batches, self.recent):
            self.add(block, sums)
        keys, schema = list(sums), _arrow(_SUMS)
        for k in range(0, len(keys), SUMS_AT_ONCE):
            part = keys[k : k + SUMS_AT_ONCE]
            made = [sums[key] if key[0] < 0 else self.packed(key[0], key[2], sums[key]) for key in part]
            columns = [pa.array(c, type=pa.int32()) for c in zip(*part, strict=True)]
            columns.append(pa.array([m.astype(np.float64).tobytes() for m in made], type=pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def best(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial sums dealt out by key -> the best split of each (or no feature, with all sums in ``low``)."""
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["tree"], row["node"], row["chunk"])
                sums[key] = sums.get(key, 0) + np.frombuffer(row["sums"], np.float64)
        found = self.splits({k: v if k[0] < 0 else self.unpacked(k[0], k[2], v) for k, v in sums.items()})
        yield pa.RecordBatch.from_pylist(found, schema=_arrow(_BEST))

    def splits(self, sums: Mapping[tuple[int, int, int], np.ndarray]) -> list[dict]:
        """The best split of each sum of :meth:`add`, as rows of ``_BEST``."""
        out = []
        for (t, node, chunk), made in sums.items():
            if t < 0:
                out.append((t, 0, -1, 0, 0.0, made.tolist(), []))
                continue
            settings = self.fits[t // self.classes].settings
            f, b, gain = best_split(made, settings)
            low, total = made[:, max(f, 0), : b + 1].sum(axis=1), made[:, 0].sum(axis=1)
            if f < 0:
                out.append((t, node, -1, 0, 0.0, total.tolist(), []))
            else:
                column = int(self.columns[t][chunk * CHUNK + f])
                out.append((t, node, column, b, gain, low.tolist(), (total - low).tolist()))
        names = _arrow(_BEST).names
        return [dict(zip(names, r, strict=True)) for r in out]


def best_split(sums: np.ndarray, settings: Boosting) -> tuple[int, int, float]:
    """(feature, bin, gain) of the best split of ``sums`` (3 x features x bins); feature -1 if there is none.

    Of equal gains, up to rounding of the sums, the first feature and its lowest bin win.
    """
    low = sums.cumsum(axis=2)
    total = low[:, :, -1:]
    weight, penalty = (2, 0.0) if settings.penalty is None else (1, settings.penalty)

    def score(part: np.ndarray) -> np.ndarray:
        return part[0] ** 2 / np.maximum(part[weight] + penalty, 1e-300)

    gain = score(low) + score(total - low) - score(total)
    enough = np.minimum(low[2], (total - low)[2]) >= max(1, settings.min_rows)
    gain = np.where(enough, gain, -np.inf)
    most = gain.max(initial=-np.inf)
    if not most > 1e-12 * max(1.0, float(np.abs(score(total)).max(initial=0.0))):
        return -1, 0, 0.0
    f, b = np.unravel_index(int(np.argmax(gain >= most * (1 - 1e-9))), gain.shape)
    return int(f), int(b), float(gain[f, b])


def leaf_value(sums: Sequence[float], settings: Boosting, classes: int) -> float:
    """One Newton step, scaled by the rate."""
    g, h, _ = sums
    factor = (classes - 1) / classes if classes > 1 and settings.penalty is None else 1.0
    h += settings.penalty or 0.0
    return settings.rate * factor * g / h if h > 1e-150 else 0.0


# --- models -----------------------------------------------------------------------------


@dataclass
class BoostedModel:
    """Trees by round and class over binned features; ``losses`` holds the training loss before each round."""

    loss: str
    start: np.ndarray
    edges: list[np.ndarray]
    trees: list[list[Tree]]
    losses: list[float]
    features: str = "features"

    def first(self, rounds: int) -> BoostedModel:
        """The model after its first rounds."""
        return replace(self, trees=self.trees[:rounds], losses=self.losses[:rounds])

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Classes x rows, of raw feature rows."""
        cells = binned(x, self.edges)
        out = np.repeat(self.start[:, None], len(x), axis=1)
        for trees in self.trees:
            for c, tree in enumerate(trees):
                out[c] += tree.values(cells)
        return out

    @property
    def featureImportances(self) -> DenseVector:  # the name that tree models of Spark have
        """Shares of the gain, averaged over the trees that split."""
        total = np.zeros(len(self.edges))
        for tree in (t for trees in self.trees for t in trees):
            gains = np.bincount(tree.feature[tree.feature >= 0], tree.gain[tree.feature >= 0], len(self.edges))
            total += gains / gains.sum() if gains.sum() > 0 else 0
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` and, for classes, the vector ``probability``."""
        made = margins_of(df, self.features, [self])
        margin = F.col("_margins")[0]
        if self.loss == "squared":
            return made.withColumn("prediction", margin[0]).drop("_margins")
        if self.loss == "logistic":
            p = 1.0 / (1.0 + F.exp(-margin[0]))
            shares = F.array(1.0 - p, p)
        else:
            powers = F.transform(margin, lambda m: F.exp(m - F.array_max(margin)))
            shares = F.transform(powers, lambda e: e / F.aggregate(powers, F.lit(0.0), lambda a, v: a + v))
        made = made.withColumn("_shares", shares)
        place = F.array_position("_shares", F.array_max("_shares")) - 1
        made = made.withColumns({"prediction": place.cast("double"), "probability": array_to_vector("_shares")})
        return made.drop("_shares", "_margins")


def _as_array(df: DataFrame, features: str):
    vector = isinstance(df.schema[features].dataType, VectorUDT)
    return vector_to_array(features) if vector else F.col(features).cast("array<double>")


def margins_of(df: DataFrame, features: str, models: Sequence[BoostedModel], name: str = "_margins") -> DataFrame:
    """Adds the margins of each model (array of arrays of classes), all in one pass."""
    shared = df.sparkSession.sparkContext.broadcast(list(models))

    def score(rows: pa.Array) -> pa.Array:
        if rows.null_count:
            raise ValueError("rows to be scored need features")
        x = rows.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), -1)
        every = [m.margins(x).T for m in shared.value] if len(x) else [np.zeros((0, len(m.start))) for m in shared.value]
        ends = np.cumsum([0, *np.tile([m.shape[1] for m in every], len(x))])
        inner = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(every, axis=1).ravel()))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(every), pa.int32()), inner)

    return df.withColumn(name, F.arrow_udf(score, "array<array<double>>")(_as_array(df, features)))


@dataclass(frozen=True)
class BoostedTrees:
    """A fit with fixed settings, to be used like an estimator."""

    settings: Boosting = Boosting()
    loss: str = "squared"
    label: str = "label"
    features: str = "features"
    id_column: str = "id"

    def fit(self, df: DataFrame) -> BoostedModel:
        return fit_boosted(df, [Fit(self.settings)], self.loss, self.label, self.features, self.id_column)[0]


def fit_boosted(
    df: DataFrame,
    fits: Sequence[Fit],
    loss: str = "squared",
    label: str = "label",
    features: str = "features",
    id_column: str = "id",
    fold: str | None = None,
    share_seed: int = 11,
) -> list[BoostedModel]:
    """Fits all of ``fits`` in the same jobs; ``loss`` is squared, logistic (0/1) or softmax (classes 0 to k - 1).

    Rows without label or features are left out. ``fold`` names the column that ``held_out`` refers to. Samples
    and shares follow hashes of ``id_column``; a null id counts as 0. An empty table gives models without trees.
    """
    rows = df.select(
        _as_array(df, features).alias("x"),
        F.col(label).cast("double").alias("y"),
        (F.coalesce(sampling.split_key(id_column, share_seed), F.lit(0)) / 4294967296.0).alias("u"),
        F.coalesce(sampling.split_key(id_column), F.lit(0)).cast("long").alias("s"),
        (F.col(fold).cast("int") if fold else F.lit(-2)).alias("fold"),
    ).where("x is not null and y is not null")
    said = rows.agg(F.count(F.lit(1)), F.avg("y"), F.max("y")).first()
    n = said[0]
    edges = bin_edges(rows, "x")
    classes = int(said[2]) + 1 if loss == "softmax" and n else 1
    if not n:
        start = np.zeros(1)
    elif loss == "squared":
        start = np.array([said[1]])
    elif loss == "logistic":
        p = min(max(said[1], 1e-12), 1 - 1e-12)
        start = np.array([np.log(p / (1 - p))])
    else:
        counts = {int(r["y"]): r["count"] for r in rows.groupBy("y").count().collect()}
        start = np.log(np.maximum([counts.get(c, 0) / n for c in range(classes)], 1e-12))
    models = [BoostedModel(loss, start, edges, [], [], features) for _ in fits]
    if not n:
        return models
    # A task for at least a block of rows, and a few tasks a core: its sums weigh as much for few rows as for many.
    cores = df.sparkSession.sparkContext.defaultParallelism
    dealt = rows.coalesce(min(-(-n // BLOCK_ROWS), TASKS_PER_CORE * cores))
    widths = [len(e) + 1 for e in edges]
    if _alone_is_shorter(n, len(edges), classes, len(fits), cores):
        made = _fits_alone(dealt.mapInArrow(_blocks(edges, np.zeros(0)), _STATE), loss, classes, fits, start, widths)
        for model, (trees, losses) in zip(models, made, strict=True):
            model.trees.extend(trees)
            model.losses.extend(losses)
        return models
    state = checkpoint(dealt.mapInArrow(_blocks(edges, np.tile(start, len(fits))), _STATE)).persist()
    tasks = state.rdd.getNumPartitions()
    recent: list[dict[int, Tree]] = []
    for turn in range(max(f.settings.rounds for f in fits)):
        level = _first_level(loss, classes, fits, turn, recent, widths)
        trees = dict(level.growing)
        while any(level.active.values()):
            lost = _grow(state, level, tasks)
            if not level.depth:
                for k, (total, count) in lost.items():
                    models[k].losses.append(total / max(count, 1))
            level = replace(level, depth=level.depth + 1)
        for k, fit in enumerate(fits):
            if turn < fit.settings.rounds:
                models[k].trees.append([trees[t] for t in range(k * classes, (k + 1) * classes)])
        recent.append(trees)
        if len(recent) == WRITE_EVERY or sum(map(len, recent)) >= RECENT_TREES:
            state, recent = _written(state, recent), []
    state.unpersist()
    return models


def _first_level(
    loss: str, classes: int, fits: Sequence[Fit], turn: int, recent: Sequence[Mapping[int, Tree]], widths: Sequence[int]
) -> Level:
    """The roots of the trees of a round."""
    level = Level(loss, classes, fits, turn, 0, recent, widths=widths)
    for k, fit in enumerate(fits):
        if turn < fit.settings.rounds:
            for t in range(k * classes, (k + 1) * classes):
                level.growing[t], level.active[t] = Tree.empty(fit.settings.depth), [0]
                level.columns[t] = _columns_of(fit.settings, len(widths), turn, t - k * classes)
    return level


def _alone_is_shorter(n: int, width: int, classes: int, fits: int, cores: int) -> bool:
    """Whether tasks should grow whole fits: the rows fit into each, and jobs for the levels would take longer."""
    if n * (width + 24 + 16 * classes) > ALONE_BYTES:
        return False
    alone, dealt = (n * width * classes * s for s in CELL_SECONDS)
    return alone * -(-fits // cores) <= LEVEL_SECONDS + dealt * fits / cores


def _fits_alone(
    state: DataFrame, loss: str, classes: int, fits: Sequence[Fit], start: np.ndarray, widths: Sequence[int]
) -> list[tuple[list[list[Tree]], list[float]]]:
    """Trees and losses of each fit, grown in a task that holds all rows: the same sums and splits as in jobs."""
    context = state.sparkSession.sparkContext
    rows = state.toArrow()
    shared = context.broadcast([rows.column(c).combine_chunks().to_pylist() for c in _arrow(_STATE).names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                made = pickle.dumps(_grown_alone(_Block.whole(shared.value), loss, classes, fits[k], start, widths))
                yield pa.RecordBatch.from_pylist([{"fit": k, "trees": made}], schema=_arrow(_FITTED))

    # The fits with most rows and rounds come first; a task for each.
    order = sorted(range(len(fits)), key=lambda k: -fits[k].share * fits[k].settings.rounds * fits[k].settings.depth)
    dealt = context.parallelize([(k,) for k in order], len(order)).toDF("id long")
    found = {r["fit"]: pickle.loads(r["trees"]) for r in dealt.mapInArrow(run, _FITTED).collect()}
    shared.destroy()
    return [found[k] for k in range(len(fits))]


def _grown_alone(
    block: _Block, loss: str, classes: int, fit: Fit, start: np.ndarray, widths: Sequence[int]
) -> tuple[list[list[Tree]], list[float]]:
    """The trees of all rounds of a fit and its losses, from one block with all rows."""
    never = replace(fit, settings=replace(fit.settings, sample=1.0))
    everything = Level(loss, classes, [fit], 0, 0, [])
    block = block.take(np.flatnonzero(everything.learns(block, never, {})))  # the rows of the fit
    block.f = np.repeat(start[:, None], len(block.y), axis=1)
    all_of = Fit(never.settings)
    trees, losses = [], []
    for turn in range(fit.settings.rounds):
        drawn = block
        if fit.settings.sample < 1:
            rows = np.flatnonzero(chance(block.s, fit.settings.seed, turn) < fit.settings.sample)
            drawn = block.take(rows)
        level = _first_level(loss, classes, [all_of], turn, [], widths)
        grown = dict(level.growing)
        while any(level.active.values()):
            sums: dict[tuple[int, int, int], np.ndarray] = {}
            for first in range(0, len(drawn.y), BLOCK_ROWS):
                level.add(drawn.part(first, first + BLOCK_ROWS), sums)
            lost = _split(level, level.splits(sums))
            if not level.depth:
                total, count = lost.get(0, (0.0, 0))
                losses.append(total / max(count, 1))
            level = replace(level, depth=level.depth + 1)
        trees.append([grown[t] for t in range(classes)])
        for t in range(classes):
            block.f[t] += grown[t].values(block.x)
    return trees, losses


def _columns_of(settings: Boosting, width: int, turn: int, tree: int) -> np.ndarray:
    if settings.columns >= 1:
        return np.arange(width)
    rng = np.random.default_rng([settings.seed, turn, tree])
    return np.sort(rng.choice(width, max(1, round(settings.columns * width)), replace=False))


def _grow(state: DataFrame, level: Level, tasks: int) -> dict[int, tuple[float, float]]:
    """Splits the active nodes of all trees in place, sets the next ones; losses per fit (first level only)."""
    sums = state.mapInArrow(level.tasks, _SUMS)
    if tasks * level.size() <= DIRECT_BYTES:
        rows = [r for b in level.best(iter(sums.toArrow().to_batches())) for r in b.to_pylist()]
    else:
        rows = sums.repartition("tree", "node", "chunk").mapInArrow(level.best, _BEST).collect()
    return _split(level, rows)


def _split(level: Level, rows: Sequence) -> dict[int, tuple[float, float]]:
    """Splits the active nodes by the best ``rows`` of each, as :func:`_grow` does."""
    found: dict[tuple[int, int], dict] = {}
    lost = {}
    for r in rows:
        key = (r["tree"], r["node"])
        if r["tree"] < 0:
            lost[-1 - r["tree"]] = tuple(r["low"])
        elif key not in found or _better(r, found[key]):
            found[key] = r
    following: dict[int, list[int]] = {t: [] for t in level.active}
    for (t, node), r in sorted(found.items()):
        tree, settings = level.growing[t], level.fits[t // level.classes].settings
        if r["feature"] < 0:
            tree.value[node] = leaf_value(r["low"], settings, level.classes)
            continue
        tree.feature[node], tree.bin[node], tree.gain[node] = r["feature"], r["bin"], r["gain"]
        for child, part in ((2 * node + 1, r["low"]), (2 * node + 2, r["high"])):
            tree.value[child] = leaf_value(part, settings, level.classes)
            if level.depth + 1 < settings.depth and part[2] > 1:
                following[t].append(child)
    level.active.clear()
    level.active.update(following)
    return lost


def _better(r, other) -> bool:
    """Whether a split of another chunk of columns wins: a larger gain, of nearly equal ones the first column."""
    if r["feature"] < 0 or other["feature"] < 0:
        return r["feature"] >= 0
    near = abs(r["gain"] - other["gain"]) <= 1e-9 * max(r["gain"], other["gain"])
    return r["feature"] < other["feature"] if near else r["gain"] > other["gain"]


def _written(state: DataFrame, recent: Sequence[Mapping[int, Tree]]) -> DataFrame:
    """The blocks with the margins after the recent trees, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in _read(batches, recent):
            yield pa.RecordBatch.from_pylist([row | {"f": block.f.tobytes()}], schema=_arrow(_STATE))

    after = checkpoint(state.mapInArrow(run, _STATE)).persist()
    state.unpersist()
    return after


# --- tuning -----------------------------------------------------------------------------


def _shared_rounds(grid: Sequence[Boosting]) -> tuple[list[Boosting], list[int]]:
    """The fits that hold all of ``grid`` as their first rounds, and the fit of each setting."""
    longest: dict[Boosting, int] = {}
    for s in grid:
        key = replace(s, rounds=0)
        longest[key] = max(longest.get(key, 0), s.rounds)
    fits = [replace(key, rounds=rounds) for key, rounds in longest.items()]
    places = {replace(s, rounds=0): k for k, s in enumerate(fits)}
    return fits, [places[replace(s, rounds=0)] for s in grid]


def _r2_of(rows: DataFrame, predicted: Sequence[str], label: str, by: Sequence[str]) -> DataFrame:
    """by..., place, r2: the coefficient of determination of each prediction column."""
    sums = [F.sum((F.col(label) - F.col(c)) ** 2).alias(f"_e{k}") for k, c in enumerate(predicted)]
    said = rows.groupBy(*by).agg((F.var_pop(label) * F.count(label)).alias("_total"), *sums)
    cells = [F.struct(F.lit(k).alias("place"), (1 - F.col(f"_e{k}") / F.col("_total")).alias("r2")) for k in range(len(predicted))]
    return said.select(*by, F.explode(F.array(*cells)).alias("_cell")).select(*by, "_cell.*")


def cross_validated(
    df: DataFrame,
    grid: Sequence[Boosting],
    folds: int = 3,
    label: str = "label",
    features: str = "features",
    id_column: str = "id",
) -> DataFrame:
    """place (in ``grid``), mean and deviation of R2 over the folds. Settings that differ in rounds share a fit."""
    settings, places = _shared_rounds(grid)
    rows = checkpoint(df.withColumn("fold", sampling.fold_of(id_column, folds)))
    fits = [Fit(s, held_out=k) for s in settings for k in range(folds)]
    models = fit_boosted(rows, fits, "squared", label, features, id_column, fold="fold")
    staged = [[models[places[k] * folds + j].first(s.rounds) for k, s in enumerate(grid)] for j in range(folds)]
    parts = []
    for j in range(folds):
        scored = margins_of(rows.where(F.col("fold") == j), features, staged[j])
        names = {f"_p{k}": F.col("_margins")[k][0] for k in range(len(grid))}
        parts.append(_r2_of(scored.withColumns(names), list(names), label, ["fold"]))
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    return scores.groupBy("place").agg(F.avg("r2").alias("mean"), F.stddev_pop("r2").alias("std"))


def grid_search(
    df: DataFrame,
    grid: Sequence[Boosting],
    folds: int = 3,
    label: str = "label",
    features: str = "features",
    id_column: str = "id",
) -> tuple[BoostedModel, pd.DataFrame]:
    """The best setting by cross-validated R2, refitted on all rows of ``df``; one row per setting (driver-side)."""
    table = cross_validated(df, grid, folds, label, features, id_column).toPandas().sort_values("place")
    best = grid[int(table.sort_values(["mean", "place"], ascending=[False, True])["place"].iloc[0])]
    model = BoostedTrees(best, "squared", label, features, id_column).fit(df)
    names = ("rounds", "depth", "rate")
    said = pd.DataFrame([{n: getattr(s, n) for n in names} for s in grid])
    return model, said.assign(score=table["mean"].to_numpy(), std=table["std"].to_numpy())


def learning_curve(
    df: DataFrame,
    settings: Boosting,
    shares: Sequence[float] = (0.1, 0.28, 0.46, 0.64, 0.82, 1.0),
    folds: int = 3,
    label: str = "label",
    features: str = "features",
    id_column: str = "id",
) -> DataFrame:
    """share, kind (train, validation), mean and deviation of R2 over the folds; all fits grow in the same jobs."""
    u = sampling.split_key(id_column, 11) / 4294967296.0
    rows = checkpoint(df.withColumns({"fold": sampling.fold_of(id_column, folds), "_u": u}))
    fits = [Fit(settings, k, s) for s in shares for k in range(folds)]
    models = fit_boosted(rows, fits, "squared", label, features, id_column, fold="fold")
    scored = margins_of(rows, features, models)
    names = {f"_p{k}": F.col("_margins")[k][0] for k in range(len(fits))}
    scored = scored.withColumns(names)
    cells = []
    for k, fit in enumerate(fits):
        held = F.col("fold") == fit.held_out
        kind = F.when(held, "validation").when(F.col("_u") < fit.share, "train")
        cells.append(F.struct(F.lit(k).alias("fit"), F.lit(fit.share).alias("share"), kind.alias("kind"), F.col(f"_p{k}").alias("p")))
    long = scored.select(label, F.explode(F.array(*cells)).alias("c")).select(label, "c.*").where("kind is not null")
    r2 = _r2_of(long, ["p"], label, ["fit", "share", "kind"])
    return r2.groupBy("share", "kind").agg(F.avg("r2").alias("mean"), F.stddev_pop("r2").alias("std"))
