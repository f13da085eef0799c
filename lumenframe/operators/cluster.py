"""k-means with restarts, the elbow curve, and assignment to given centres."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.operators.models import assembled
from lumenframe.session import checkpoint

#: Rows from which the first centres are drawn; everything else reads all rows.
START_ROWS = 4096
#: Rows whose distances are taken at once: they stay in the cache of a core.
CACHED_ROWS = 2048


@dataclass(frozen=True)
class Centers:
    """Centres of a fit, the sum of squared distances to them, and the iterations it took."""

    centers: np.ndarray
    cost: float = float("inf")
    iterations: int = 0
    features: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``cluster``, the number of the nearest centre (the lowest on a tie)."""
        places = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in self.centers])
        x = _as_array(df, self.features)
        squares = F.transform(places, lambda c: F.zip_with(x, c, lambda a, b: (a - b) * (a - b)))
        found = df.withColumn("_d", F.transform(squares, lambda s: F.aggregate(s, F.lit(0.0), lambda t, v: t + v)))
        return found.withColumn("cluster", (F.array_position("_d", F.array_min("_d")) - 1).cast("int")).drop("_d")


def _as_array(df: DataFrame, features: str) -> Column:
    return vector_to_array(features) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features)


def first_centers(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Rows far from each other: each next one is drawn by its squared distance to those before."""
    chosen = [x[rng.integers(len(x))]]
    near = ((x - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        at = rng.choice(len(x), p=near / near.sum()) if near.sum() > 0 else rng.integers(len(x))
        chosen.append(x[at])
        near = np.minimum(near, ((x - x[at]) ** 2).sum(axis=1))
    return np.array(chosen)


def step_sums(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """For each centre the sums of its rows, their number and their squared distances (centres x (d + 2))."""
    if x.shape[1] > 7 or np.isnan(x).any() or np.isnan(centers).any():
        distance = np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1)
        owner, nearest = distance.argmin(axis=1), distance.min(axis=1)
    else:  # whole columns: numpy sums so few squares one after the other, too
        columns = np.ascontiguousarray(x.T)
        owner, nearest = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
        for i, c in enumerate(centers):
            distance = sum((column - v) ** 2 for column, v in zip(columns, c))
            np.copyto(owner, i, where=distance < nearest)
            nearest = np.minimum(nearest, distance)
    out = np.zeros((len(centers), x.shape[1] + 2))
    for j in range(x.shape[1]):
        out[:, j] = np.bincount(owner, x[:, j], len(centers))
    out[:, -2] = np.bincount(owner, minlength=len(centers))
    out[:, -1] = np.bincount(owner, nearest, len(centers))
    return out


def _steps(rows: DataFrame, fits: dict[int, Centers]) -> dict[int, np.ndarray]:
    """One pass over all rows: the sums of every fit. Tasks add up first; a row per task and fit travels."""
    centers = {i: f.centers for i, f in fits.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float)
            x = values.reshape(batch.num_rows, -1)
            for first in range(0, len(x), CACHED_ROWS):
                part = x[first : first + CACHED_ROWS]
                for i, c in centers.items():
                    sums[i] = sums.get(i, 0) + step_sums(part, c)
        made = [pa.array(list(sums), pa.int32()), pa.array([v.ravel().tolist() for v in sums.values()], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(made, names=["fit", "sums"])

    parts = rows.mapInArrow(run, "fit int, sums array<double>")
    found = parts.groupBy("fit").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect()
    return {r["fit"]: r["sums"].toArray().reshape(len(centers[r["fit"]]), -1) for r in found}


def step(df: DataFrame, centers: np.ndarray, features: str = "features") -> np.ndarray:
    """Sums, number and squared distances of the rows nearest to each centre, in one pass."""
    rows = df.select(_as_array(df, features).alias("x")).where("x is not null")
    return _steps(rows, {0: Centers(np.asarray(centers, dtype=float))})[0]


def fit_starts(
    df: DataFrame,
    ks: Sequence[int],
    restarts: int = 10,
    seed: int = 42,
    features: str = "features",
    iterations: int = 50,
    tolerance: float = 1e-4,
) -> list[Centers]:
    """The best of ``restarts`` fits for each of ``ks``; all fits take their steps in the same passes.

    A fit whose centres move less than ``tolerance`` is done and leaves the passes. A centre without rows stays.
    First centres come from the ``START_ROWS`` rows with the smallest hashes. Rows without a vector are left out.
    """
    rows = df.select(_as_array(df, features).alias("x")).where("x is not null")
    rows = checkpoint(rows).persist()
    some = rows.orderBy(F.xxhash64("x"), "x").limit(START_ROWS).toPandas()
    if some.empty:
        rows.unpersist()
        return [Centers(np.zeros((0, 0)), 0.0, 0, features) for _ in ks]
    x = np.stack(some["x"].to_numpy()).astype(float)
    fits: dict[int, Centers] = {}
    for a, k in enumerate(ks):
        for b in range(restarts if k > 1 else 1):
            made = first_centers(x, k, np.random.default_rng([seed, k, b]))
            fits[a * restarts + b] = Centers(made, features=features)
    going = dict(fits)
    for turn in range(1, iterations + 1):
        for i, sums in _steps(rows, going).items():
            before = fits[i].centers
            n = sums[:, -2:-1]
            centers = np.where(n > 0, sums[:, :-2] / np.maximum(n, 1), before)
            fits[i] = replace(fits[i], centers=centers, iterations=turn)
            if (((centers - before) ** 2).sum(axis=1) <= tolerance**2).all():
                del going[i]
            else:
                going[i] = fits[i]
        if not going:
            break
    for i, sums in _steps(rows, fits).items():
        fits[i] = replace(fits[i], cost=float(sums[:, -1].sum()))
    rows.unpersist()
    groups = [[f for i, f in fits.items() if i // restarts == a] for a in range(len(ks))]
    return [min(group, key=lambda f: f.cost) for group in groups]


def fit_kmeans(df: DataFrame, k: int = 4, restarts: int = 10, seed: int = 42, features: str = "features") -> Centers:
    """The fit with the lowest within-cluster sum of squares over ``restarts`` starts."""
    return fit_starts(df, [k], restarts, seed, features)[0]


def elbow(df: DataFrame, columns: Sequence[str], ks: Sequence[int], restarts: int = 3, seed: int = 42) -> DataFrame:
    """Within-cluster sum of squares for each k; k = 1 is the total squared deviation."""
    fits = fit_starts(assembled(df, columns), list(ks), restarts, seed)
    return df.sparkSession.createDataFrame([(k, f.cost) for k, f in zip(ks, fits)], "k int, inertia double")


def nearest_center(columns: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """Number of the closest centre (the lowest on a tie), as one expression."""
    distances = F.array(
        *[sum(((F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(columns, center)), F.lit(0.0)) for center in centers]
    )
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")
