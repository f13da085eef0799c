"""Random forests on histograms: the trees of a forest grow level by level in the same jobs.

Features are binned once, by quantiles, into one byte each, and rows are kept as blocks. A tree learns from each row as
often as a Poisson draw by the hash of (row, tree) says. For a level, tasks sum weights and labels per (tree, node,
feature, bin); the sums meet by (tree, nodes) and only the best splits come back. Levels whose sums would not fit
a task are cut into passes over some nodes, which run as more tasks of the same job.

What the driver holds are trees; what a task holds is a block and the sums of its pass. Bins, draws and
the columns that a node may split by do not depend on how rows are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.operators.boosting import _as_array, bin_edges, binned
from lumenframe.session import checkpoint

#: Bins of a feature, as Spark's trees have.
BINS = 32
BLOCK_ROWS = 65_536
#: Rows a task should have at least: its sums weigh as much for few rows as for many.
TASK_ROWS = 16_384
#: Bytes of the sums of a pass.
PASS_BYTES = 96 << 20
#: Bytes of the sums that meet by one key.
GROUP_BYTES = 2 << 20
#: Passes of a job.
JOB_PASSES = 16

_STATE = "n int, x binary, y binary, s binary"
_SUMS = "tree int, first int, there binary, weights binary, labels binary"
_BEST = "tree int, first int, feature binary, bin binary, gain binary, low binary, total binary"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split(" ") for part in ddl.split(", "))])


def _poisson_table() -> np.ndarray:
    """Poisson(1) numbers by 16 random bits."""
    chances = np.exp(-1.0) / np.cumprod(np.maximum(np.arange(12), 1))
    return np.searchsorted(np.cumsum(chances), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def draws(key: np.ndarray, seed: int, tree: int, table: np.ndarray) -> np.ndarray:
    """How often ``tree`` learns from each row (32-bit keys); four trees share a hash."""
    z = key.astype(np.uint64) + np.uint64(np.random.default_rng([seed, tree // 4]).integers(1 << 62) * 2 + 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return table.take((z ^ (z >> np.uint64(31))).view(np.uint16)[tree % 4 :: 4])


@dataclass
class Tree:
    """Nodes by number: a row goes to ``left`` + 1 if its bin lies above ``bin``; a leaf leads to itself.

    ``sums`` holds (weight, sum of labels) of a node, or the weight of each class.
    """

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    sums: np.ndarray

    @classmethod
    def leaves(cls, sums: np.ndarray, first: int = 0) -> Tree:
        n = len(sums)
        at = np.arange(first, first + n)
        return cls(np.zeros(n, np.int64), np.full(n, 255, np.uint8), at, np.zeros(n), sums)

    def grown(self, more: Tree) -> Tree:
        return Tree(*(np.concatenate([getattr(self, c), getattr(more, c)]) for c in self.__dataclass_fields__))

    def nodes(self, x: np.ndarray, first: np.ndarray, steps: int) -> np.ndarray:
        """The node after ``steps`` of the rows that begin at the places ``first`` of the flat bins ``x``."""
        at = np.zeros(len(first), np.int64)
        for _ in range(steps):
            above = x.take(first + self.feature.take(at)) > self.bin.take(at)
            at = self.left.take(at) + above
        return at


@dataclass
class Part:
    """Nodes of a tree whose sums are taken in a pass: numbers, and the columns each may split by (None: all)."""

    tree: int
    first: int  # place of the first node among all that are split in this level
    nodes: np.ndarray
    columns: np.ndarray | None


@dataclass
class Pass:
    """What tasks need to take the sums of some nodes."""

    classes: int  # 0: regression
    width: int
    tried: int  # columns a node may split by
    depth: int
    seed: int
    group: int  # nodes whose sums travel together
    trees: dict[int, Tree] = field(default_factory=dict)
    parts: list[Part] = field(default_factory=list)

    def tasks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = max(self.classes, 1)
        sums = [[np.zeros((self.tried, len(p.nodes) * BINS * k)) for _ in range(1 if self.classes else 2)] for p in self.parts]
        table = _poisson_table()
        for batch in batches:
            for row in batch.to_pylist():
                x, y = np.frombuffer(row["x"], np.uint8), np.frombuffer(row["y"], np.float64)
                s = np.frombuffer(row["s"], np.uint32)
                for part, found in zip(self.parts, sums, strict=True):
                    self.add(part, found, x, y, draws(s, self.seed, part.tree, table))
        for part, found in zip(self.parts, sums, strict=True):
            yield from self.packed(part, found)

    def add(self, part: Part, sums: list[np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        rows = np.flatnonzero(weight)
        first, tree = rows * self.width, self.trees[part.tree]
        at = tree.nodes(x, first, self.depth)
        place = np.full(len(tree.left), -1)
        place[part.nodes] = np.arange(len(part.nodes))
        at = place.take(at)
        here = np.flatnonzero(at >= 0)
        if len(here) < len(at):
            rows, first, at = rows.take(here), first.take(here), at.take(here)
        w, label = weight.take(rows).astype(float), y.take(rows)
        k = max(self.classes, 1)
        begin = at * (BINS * k) + (label.astype(np.int64) if self.classes else 0)
        values = [w] if self.classes else [w, w * label]
        for j in range(self.tried):
            column = j if part.columns is None else part.columns[:, j].take(at)
            cells = begin + x.take(first + column) * np.int64(k)
            for total, value in zip(sums, values, strict=True):
                if total.shape[1] > 2 * len(cells):
                    np.add.at(total[j], cells, value)
                else:
                    total[j] += np.bincount(cells, value, total.shape[1])

    def packed(self, part: Part, sums: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """The cells with rows, a batch for each group of nodes."""
        step = self.group * BINS * max(self.classes, 1)
        for k, begin in enumerate(range(0, sums[0].shape[1], step)):
            cut = [total[:, begin : begin + step].ravel() for total in sums]
            there = cut[0] > 0
            row = {
                "tree": part.tree,
                "first": part.first + k * self.group,
                "there": np.packbits(there).tobytes(),
                "weights": cut[0][there].astype(np.uint32).tobytes(),
                "labels": b"".join(c[there].tobytes() for c in cut[1:]),
            }
            yield pa.RecordBatch.from_pylist([row], schema=_arrow(_SUMS))


@dataclass
class Choice:
    """Finds the best splits of nodes from the sums of all tasks, dealt out and sorted by (tree, first node)."""

    classes: int
    tried: int
    least: int
    sizes: dict[tuple[int, int], int]  # nodes of a group
    columns: dict[int, np.ndarray | None]

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["tree"], row["first"]) != key:
                    if key is not None:
                        yield self.best(key, total)
                    key = (row["tree"], row["first"])
                    total = np.zeros((1 if self.classes else 2, self.tried * self.sizes[key] * BINS * max(self.classes, 1)))
                there = np.flatnonzero(np.unpackbits(np.frombuffer(row["there"], np.uint8), count=total.shape[1]))
                total[0][there] += np.frombuffer(row["weights"], np.uint32)
                if not self.classes:
                    total[1][there] += np.frombuffer(row["labels"], np.float64)
        if key is not None:
            yield self.best(key, total)

    def best(self, key: tuple[int, int], sums: np.ndarray) -> pa.RecordBatch:
        """Of equal gains, up to rounding of the sums, the first column and its lowest bin win; feature -1: none."""
        nodes = self.sizes[key]
        cells = sums.reshape(self.tried, nodes, BINS, -1) if self.classes else np.moveaxis(sums.reshape(2, self.tried, nodes, BINS), 0, 3)
        low = cells.cumsum(axis=2).transpose(1, 0, 2, 3)  # nodes, columns, bins, numbers
        total = low[:, :, -1:]
        high = total - low

        def weight(part: np.ndarray) -> np.ndarray:
            return part.sum(axis=3) if self.classes else part[..., 0]

        def score(part: np.ndarray) -> np.ndarray:
            top = (part**2).sum(axis=3) if self.classes else part[..., 1] ** 2
            return top / np.maximum(weight(part), 1e-300)

        whole = score(total)
        gain = score(low) + score(high) - whole
        gain[np.minimum(weight(low), weight(high)) < max(self.least, 1)] = -np.inf
        gain = gain.reshape(nodes, -1)
        most = gain.max(axis=1)
        some = most > 1e-12 * np.maximum(1.0, whole.reshape(nodes, -1).max(axis=1))
        at = np.argmax(gain >= (most * (1 - 1e-9))[:, None], axis=1)
        every, column, cut = np.arange(nodes), at // BINS, at % BINS
        columns = self.columns[key[0]]
        feature = column if columns is None else columns[key[1] + every, column]
        made = {
            "tree": key[0],
            "first": key[1],
            "feature": np.where(some, feature, -1).astype(np.int64).tobytes(),
            "bin": cut.astype(np.uint8).tobytes(),
            "gain": np.where(some, most, 0.0).tobytes(),
            "low": low[every, column, cut].tobytes(),
            "total": total[:, 0, 0].tobytes(),
        }
        return pa.RecordBatch.from_pylist([made], schema=_arrow(_BEST))


def _blocks(edges: Sequence[np.ndarray], middle: float, block_rows: int):
    """Rows (x, y, s) -> blocks; labels less ``middle``."""

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
        y, s = (rows.column(c).to_numpy() for c in ("y", "s"))
        made = {
            "n": rows.num_rows,
            "x": binned(x.reshape(rows.num_rows, -1), edges).tobytes(),
            "y": (y.astype(np.float64) - middle).tobytes(),
            "s": s.astype(np.uint32).tobytes(),
        }
        return pa.RecordBatch.from_pylist([made], schema=_arrow(_STATE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= block_rows:
                yield block(held)
                held = []
        if held:
            yield block(held)

    return run


class ForestModel(Model):
    """A fitted forest. Regression: the mean of the trees. Classes: the sum of the class shares of the leaves."""

    def __init__(self, trees: list[Tree], edges: list[np.ndarray], depth: int, classes: int, middle: float, features: str):
        super().__init__()
        self.trees, self.edges, self.depth, self.classes, self.middle = trees, edges, depth, classes, middle
        self.features = features

    @property
    def featureImportances(self) -> DenseVector:  # the name that tree models of Spark have
        """Shares of the gain, averaged over the trees that split."""
        total = np.zeros(len(self.edges))
        for tree in self.trees:
            gains = np.bincount(tree.feature, tree.gain, len(self.edges))
            total += gains / gains.sum() if gains.sum() > 0 else 0
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def _scores(self, df: DataFrame):
        """Column with the mean of the trees, or an array with the summed shares of each class."""
        walks = [(Tree(t.feature, t.bin, t.left, t.gain[:0], t.sums[:0]), self._values(t)) for t in self.trees]
        shared = df.sparkSession.sparkContext.broadcast((walks, self.edges))
        depth, classes, middle = self.depth, self.classes, self.middle

        def score(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=object if classes else float)
            walks, edges = shared.value
            x = binned(np.stack(rows.to_numpy()).astype(float), edges)
            first, flat = np.arange(len(x)) * x.shape[1], x.ravel()
            total = sum(values[tree.nodes(flat, first, depth)] for tree, values in walks)
            return pd.Series(list(total.astype(float))) if classes else pd.Series(total / len(walks) + middle)

        return F.pandas_udf(score, "array<double>" if classes else "double")(_as_array(df, self.features))

    def _values(self, tree: Tree) -> np.ndarray:
        if not self.classes:
            return tree.sums[:, 1] / np.maximum(tree.sums[:, 0], 1e-300)
        return (tree.sums / np.maximum(tree.sums.sum(axis=1, keepdims=True), 1e-300)).astype(np.float32)

    def _transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` and, for classes, the vectors ``rawPrediction`` and ``probability``."""
        if not self.classes:
            return df.withColumn("prediction", self._scores(df))
        made = df.withColumn("_votes", self._scores(df))
        votes = F.col("_votes")
        total = F.greatest(F.aggregate(votes, F.lit(0.0), lambda a, b: a + b), F.lit(1e-300))
        shares = F.transform(votes, lambda v: v / total)
        made = made.withColumns({
            "rawPrediction": array_to_vector(votes),
            "probability": array_to_vector(shares),
            "prediction": (F.array_position(votes, F.array_max(votes)) - 1).cast("double"),
        })
        return made.drop("_votes")


class Forest(Estimator):
    """A forest for numbers (``classes`` False) or for classes 0 to k - 1, to be used like Spark's.

    A node of a regression tree tries all columns, one of a classification tree a fresh draw of their root. Rows without
    label or features are left out. Draws follow a hash of the whole row, so ids may repeat or be null.
    """

    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels below the root", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows of a node", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "of draws of rows and columns", TypeConverters.toInt)

    def __init__(self, classes: bool, label: str = "label", features: str = "features", id_column: str = "id", **settings: int):
        super().__init__()
        self.classes, self.label, self.features, self.id_column = classes, label, features, id_column
        self._set(**{"numTrees": 20, "maxDepth": 5, "minInstancesPerNode": 1, "seed": 42, **settings})

    def _fit(self, df: DataFrame) -> ForestModel:
        trees, depth, least, seed = (self.getOrDefault(p) for p in ("numTrees", "maxDepth", "minInstancesPerNode", "seed"))
        rows = df.select(
            _as_array(df, self.features).alias("x"),
            F.col(self.label).cast("double").alias("y"),
            F.col(self.id_column).alias("id"),
        ).where("x is not null and y is not null")
        # Rows without an id, or with that of another, are told apart by what they hold.
        rows = rows.select("x", "y", F.pmod(F.xxhash64("id", "x", "y"), F.lit(1 << 32)).alias("s"))
        n, mean, top = rows.agg(F.count(F.lit(1)), F.avg("y"), F.max("y")).first()
        if not n:
            raise ValueError("a forest needs rows with features and label")
        classes, middle = (int(top) + 1, 0.0) if self.classes else (0, float(mean))
        edges = bin_edges(rows, "x", BINS)
        cores = df.sparkSession.sparkContext.defaultParallelism
        dealt = rows.coalesce(max(1, min(-(-n // TASK_ROWS), cores)))
        state = checkpoint(dealt.mapInArrow(_blocks(edges, middle, BLOCK_ROWS), _STATE)).persist()
        tried = max(1, int(np.ceil(np.sqrt(len(edges))))) if classes else len(edges)
        grown = _grown(state, trees, depth, least, seed, classes, len(edges), tried, cores)
        state.unpersist()
        return ForestModel(grown, edges, depth, classes, middle, self.features)


def _grown(
    state: DataFrame, trees: int, depth: int, least: int, seed: int, classes: int, width: int, tried: int, cores: int
) -> list[Tree]:
    """The trees, level by level."""
    made = [Tree.leaves(np.zeros((1, classes or 2))) for _ in range(trees)]
    active = {t: np.zeros(1, np.int64) for t in range(trees)}
    for level in range(max(depth, 1)):
        columns = {t: _columns_of(seed, t, level, len(nodes), width, tried) for t, nodes in active.items()}
        node_bytes = max(tried, 1) * BINS * (classes or 2) * 8
        empty = Pass(classes, width, tried, level, seed, max(1, GROUP_BYTES // node_bytes))
        passes = _passes(empty, max(1, PASS_BYTES // (empty.group * node_bytes)) * empty.group, made, active, columns)
        found: dict[int, list[dict]] = {t: [] for t in active}
        for k in range(0, len(passes), JOB_PASSES):
            for row in _best_splits(state, passes[k : k + JOB_PASSES], least, columns, cores):
                found[row["tree"]].append(row)
        following = {}
        for t, nodes in active.items():
            parts = sorted(found[t], key=lambda r: r["first"])
            feature, gain = (np.concatenate([np.frombuffer(r[c], k) for r in parts]) for c, k in (("feature", np.int64), ("gain", np.float64)))
            cut = np.concatenate([np.frombuffer(r["bin"], np.uint8) for r in parts])
            low, total = (np.concatenate([np.frombuffer(r[c]) for r in parts]).reshape(len(nodes), -1) for c in ("low", "total"))
            if not level:
                made[t].sums = total.copy()
            if not depth:
                continue
            some = np.flatnonzero(feature >= 0)
            tree, first, split = made[t], len(made[t].left), nodes[some]
            tree.feature[split], tree.bin[split], tree.gain[split] = feature[some], cut[some], gain[some]
            tree.left[split] = first + 2 * np.arange(len(some))
            sums = np.stack([low[some], total[some] - low[some]], axis=1).reshape(2 * len(some), total.shape[1])
            made[t] = tree.grown(Tree.leaves(sums, first))
            size = sums.sum(axis=1) if classes else sums[:, 0]
            open_ = size >= 2 * max(least, 1)
            if classes:
                open_ &= sums.max(axis=1, initial=0.0) < size
            if level + 1 < depth and open_.any():
                following[t] = first + np.flatnonzero(open_)
        active = following
        if not active:
            break
    return made


def _columns_of(seed: int, tree: int, level: int, nodes: int, width: int, tried: int) -> np.ndarray | None:
    """The columns that each node may split by, in order."""
    if tried >= width:
        return None
    chance = np.random.default_rng([seed, tree, level]).random((nodes, width), dtype=np.float32)
    return np.sort(chance.argpartition(tried, axis=1)[:, :tried], axis=1).astype(np.int32)


def _passes(
    empty: Pass, most: int, trees: list[Tree], active: dict[int, np.ndarray], columns: dict[int, np.ndarray | None]
) -> list[Pass]:
    """The nodes to be split, in passes of at most ``most``; a group of nodes stays together."""
    out, room = [], 0
    for t, nodes in active.items():
        done = 0
        while done < len(nodes):
            if room < min(empty.group, len(nodes) - done):
                out.append(replace(empty, trees={}, parts=[]))
                room = most
            take = min(len(nodes) - done, room)
            if take < len(nodes) - done:
                take -= take % empty.group
            own = columns[t]
            out[-1].trees[t] = trees[t]
            out[-1].parts.append(Part(t, done, nodes[done : done + take], None if own is None else own[done : done + take]))
            done, room = done + take, room - take
    for made in out:  # tasks walk the trees and need nothing else
        made.trees = {t: Tree(v.feature, v.bin, v.left, v.gain[:0], v.sums[:0]) for t, v in made.trees.items()}
    return out


def _best_splits(
    state: DataFrame, passes: Sequence[Pass], least: int, columns: dict[int, np.ndarray | None], cores: int
) -> list[dict]:
    """The best split of each node, by (tree, first node of a group); all passes in one job."""
    sums = state.mapInArrow(passes[0].tasks, _SUMS)
    for other in passes[1:]:
        sums = sums.unionByName(state.mapInArrow(other.tasks, _SUMS))
    one, sizes = passes[0], {}
    for part in (p for made in passes for p in made.parts):
        for k in range(0, len(part.nodes), one.group):
            sizes[part.tree, part.first + k] = min(one.group, len(part.nodes) - k)
    trees = {t for t, _ in sizes}
    choice = Choice(one.classes, one.tried, least, sizes, {t: columns[t] for t in trees})
    dealt = sums.repartition(min(2 * cores, len(sizes)), "tree", "first").sortWithinPartitions("tree", "first")
    return [r.asDict() for r in dealt.mapInArrow(choice.run, _BEST).collect()]
