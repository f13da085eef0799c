"""Recommenders over a long (user, item, rating) table: biases, neighbours, factors, top-N."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.columns import clip
from lumenframe.operators.joins import without
from lumenframe.operators.ordered import with_position, with_running
from lumenframe.session import checkpoint

LOW, HIGH = 1.0, 5.0


def axis_means(ratings: DataFrame, axis: str) -> DataFrame:
    """Mean rating per user or per item: the margins of the user x item matrix, which stays long."""
    return ratings.groupBy(axis).agg(F.avg("rating").alias("mean"), F.count(F.lit(1)).alias("count"))


def bias_fit(train: DataFrame) -> tuple[Column, DataFrame, DataFrame]:
    """Global mean (as a scalar subquery), user biases and item biases."""
    mean = train.agg(F.avg("rating")).scalar()
    users = train.groupBy("user_id").agg((F.avg("rating") - mean).alias("user_bias"))
    items = train.groupBy("item_id").agg((F.avg("rating") - mean).alias("item_bias"))
    return mean, users, items


def bias_predict(train: DataFrame, pairs: DataFrame, name: str = "predicted", clipped: bool = True) -> DataFrame:
    """Global mean + user bias + item bias; an unknown user or item adds 0."""
    mean, users, items = bias_fit(train)
    joined = pairs.join(users, "user_id", "left").join(items, "item_id", "left")
    raw = mean + F.coalesce("user_bias", F.lit(0.0)) + F.coalesce("item_bias", F.lit(0.0))
    return joined.withColumn(name, clip(raw, LOW, HIGH) if clipped else raw).drop("user_bias", "item_bias")


def deviations(ratings: DataFrame, axis: str) -> DataFrame:
    """Adds ``dev``, the rating minus the mean of its user (or item)."""
    means = ratings.groupBy(axis).agg(F.avg("rating").alias("_mean"))
    return ratings.join(means, axis).withColumn("dev", F.col("rating") - F.col("_mean")).drop("_mean")


def unit_weights(ratings: DataFrame, axis: str) -> DataFrame:
    """Deviations scaled to unit length per ``axis`` value; a zero vector stays zero."""
    dev = deviations(ratings, axis)
    norms = dev.groupBy(axis).agg(F.sqrt(F.sum(F.col("dev") * F.col("dev"))).alias("_norm"))
    scale = F.when(F.col("_norm") == 0, F.lit(1.0)).otherwise(F.col("_norm"))
    return dev.join(norms, axis).withColumn("weight", F.col("dev") / scale).drop("_norm")


def _closeness() -> Column:
    """Sort value of a neighbour. Rounded, so that equal similarities tie whatever the summation order."""
    return F.round(F.abs("similarity"), 9)


def _mirrored(pairs: DataFrame) -> DataFrame:
    """Each pair (a, b, similarity) in both directions."""
    ends = F.array(
        F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    return pairs.select(F.explode(ends).alias("p"), "similarity").select("p.*", "similarity")


def top_neighbours(
    ratings: DataFrame,
    axis: str,
    k: int = 40,
    hot: int = 500,
    block_entries: int = 200_000,
    block_rows: int = 1024,
) -> DataFrame:
    """The ``k`` nearest neighbours by |cosine| of centred ratings: ``a, b, similarity``.

    Exact. Rows are dealt out in blocks; a block gets, once each, the ratings of every value of the other axis that
    one of its rows has rated (at most ``hot``), takes the sums of its rows with all others and keeps the best ``k``, so
    pairs of rows are never written. Values with more ratings than ``hot`` would go to all blocks: if there are such,
    light pairs meet through a self-join, and the crowded columns are multiplied
    block against block inside a task, which keeps only the best ``k`` per row. A
    task holds two blocks of bounded rows and entries, their product, and at most one sum of the
    self-join for each cell of it; pairs of rows outside the blocks do not go there.
    """
    cells = F.explode(F.arrays_zip("b", "similarity"))
    return neighbour_lists(ratings, axis, k, hot, block_entries, block_rows).select("a", cells.alias("n")).select("a", "n.*")


def neighbour_lists(
    ratings: DataFrame,
    axis: str,
    k: int = 40,
    hot: int = 500,
    block_entries: int = 200_000,
    block_rows: int = 1024,
) -> DataFrame:
    """The neighbours of :func:`top_neighbours` as one row of arrays: ``a, b, similarity``, nearest first."""
    other = "item_id" if axis == "user_id" else "user_id"
    weights = checkpoint(
        unit_weights(ratings, axis)
        .filter(F.col("weight") != 0)
        .select(F.col(axis).alias("a"), F.col(other).alias("c"), "weight")
        .where("a is not null and c is not null")
    )
    sizes = weights.groupBy("c").agg(F.count(F.lit(1)).alias("size"))
    crowded = checkpoint(sizes.filter(F.col("size") > hot).select("c"))
    if crowded.limit(1).count() == 0:
        return _light_neighbours(weights, k)
    light = weights.join(crowded, "c", "left_anti")
    pairs = (
        light.join(light.select(F.col("a").alias("b"), "c", F.col("weight").alias("_w")), "c")
        .filter(F.col("a") < F.col("b"))
        .groupBy("a", "b")
        .agg(F.sum(F.col("weight") * F.col("_w")).alias("similarity"))
    )
    heavy = weights.join(crowded, "c", "left_semi")
    return _nearest_lists(_block_candidates(heavy, pairs, k, block_entries, block_rows), k)


def _nearest_lists(candidates: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("a").orderBy(F.desc(_closeness()), F.asc("b"))
    best = (
        candidates.filter(_closeness() > 0)
        .withColumn("_place", F.row_number().over(nearest))
        .filter(F.col("_place") <= k)
    )
    lists = best.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("_place", "b", "similarity"))).alias("n"))
    return lists.select("a", F.col("n.b").alias("b"), F.col("n.similarity").alias("similarity"))


#: Products that a block of rows takes at most, and blocks that few rows are cut into all the same, for the cores.
LIGHT_PAIRS, LEAST_BLOCKS = 8_000_000, 32
#: Products that a task sorts at a time.
PAIRS_AT_ONCE = 1 << 20


def _light_neighbours(weights: DataFrame, k: int, most: int = LIGHT_PAIRS) -> DataFrame:
    """Nearest rows where every column has a bounded number of entries (a, c, weight).

    The ratings of a column go once to each block of rows that has some of them. A row with more products than
    a block takes meets the others through a join.
    """
    columns = weights.groupBy("c").agg(F.collect_list(F.struct("a", "weight")).alias("e"))
    columns = checkpoint(columns.where(F.size("e") > 1))
    rows = columns.select(F.explode("e.a").alias("a"), F.size("e").alias("size")).groupBy("a")
    rows = checkpoint(rows.agg(F.sum("size").alias("_n")))
    total, largest = rows.agg(F.sum("_n"), F.max("_n")).first()
    if not total:
        return weights.sparkSession.createDataFrame([], "a long, b array<long>, similarity array<double>")
    per_block = max(1, min(most, -(-total // LEAST_BLOCKS)))
    placed = with_running(rows.where(F.col("_n") <= most), ["a"], {"_upto": "_n"})
    placed = placed.select("a", F.floor((F.col("_upto") - 1) / per_block).alias("block"))
    entries = columns.select("c", F.explode("e").alias("e")).select("c", "e.*")
    # A row of no block has the number -1.
    owned = entries.join(placed, "a", "left").withColumn("block", F.coalesce("block", F.lit(-1).cast("long")))
    lists = owned.groupBy("c").agg(F.collect_list(F.struct("a", "block", "weight")).alias("e"))
    parts = lists.select(F.explode(F.array_distinct("e.block")).alias("part"), "e").where("part >= 0")
    parts = parts.select("part", F.col("e.a").alias("a"), F.col("e.block").alias("block"), F.col("e.weight").alias("weight"))

    def best(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        held = [table.column(c).combine_chunks() for c in ("a", "block", "weight")]
        ids, block, weight = (h.flatten().to_numpy() for h in held)
        sizes = held[0].value_lengths().to_numpy().astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        own = np.flatnonzero(block == part)
        own = own[np.argsort(ids[own], kind="stable")]
        at = np.repeat(np.arange(len(sizes)), sizes)[own]  # the column of each own entry
        names, code = np.unique(ids, return_inverse=True)
        upto = np.cumsum(sizes[at])
        first_of_row = np.flatnonzero(np.r_[True, ids[own][1:] != ids[own][:-1]])
        out, begin = [], 0
        while begin < len(own):  # whole rows, about so many products
            limit = np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PAIRS_AT_ONCE, side="right")
            later = first_of_row[np.searchsorted(first_of_row, begin, side="right") :]
            if limit >= len(own) or not len(later):
                end = len(own)
            else:
                fit = np.searchsorted(later, limit, side="right")
                end = later[max(fit - 1, 0)]
            out.append(_best_of_rows(own[begin:end], at[begin:end], starts, sizes, names, code, weight, k))
            begin = end
        return pa.concat_tables(out)

    schema = "a long, b array<long>, similarity array<double>"
    found = parts.groupBy("part").applyInArrow(best, schema)
    if largest <= most:
        return found
    large = entries.join(rows.where(F.col("_n") > most).select("a"), "a", "left_semi")
    pairs = large.join(entries.select(F.col("a").alias("b"), "c", F.col("weight").alias("_w")), "c").where("a <> b")
    pairs = pairs.groupBy("a", "b").agg(F.sum(F.col("weight") * F.col("_w")).alias("similarity"))
    return found.unionByName(_nearest_lists(pairs, k))


def _best_of_rows(own, at, starts, sizes, names, code, weight, k: int) -> pa.Table:
    """Lists of the ``k`` nearest for the rows of the entries ``own`` (sorted by row), which lie in the columns ``at``."""
    n = sizes[at]
    entry = np.repeat(np.arange(len(own)), n)
    theirs = np.repeat(starts[at] - (np.cumsum(n) - n), n) + np.arange(len(entry))
    row, them = code[own][entry], code[theirs]
    other = row != them
    product = (weight[own][entry] * weight[theirs])[other]
    pair = row[other].astype(np.int64) * len(names) + them[other]
    order = np.argsort(pair, kind="stable")
    pair, product = pair[order], product[order]
    ahead = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
    similarity = np.add.reduceat(product, ahead) if len(ahead) else np.zeros(0)
    row, them = np.divmod(pair[ahead], len(names))
    rank = np.round(np.abs(similarity), 9)
    some = rank > 0
    row, them, similarity, rank = row[some], them[some], similarity[some], rank[some]
    # Within a row they stand by id, so a stable sort breaks ties by the lower id.
    order = np.lexsort((-rank, row))
    row, them, similarity = row[order], them[order], similarity[order]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    length = np.diff(np.append(first, len(row)))
    keep = np.arange(len(row)) - np.repeat(first, length) < k
    ends = pa.array(np.concatenate([[0], np.cumsum(np.minimum(length, k))]), pa.int32())
    return pa.table({
        "a": pa.array(names[row[first]], pa.int64()),
        "b": pa.ListArray.from_arrays(ends, pa.array(names[them[keep]], pa.int64())),
        "similarity": pa.ListArray.from_arrays(ends, pa.array(similarity[keep], pa.float64())),
    })


def row_blocks(heavy: DataFrame, block_entries: int, block_rows: int) -> DataFrame:
    """(a, block): consecutive rows with about ``block_entries`` entries, never more than ``block_rows`` rows."""
    least = -(-block_entries // block_rows)  # what a row counts at least
    per_row = heavy.groupBy("a").agg(F.greatest(F.count(F.lit(1)), F.lit(least)).alias("_n"))
    placed = with_running(per_row, ["a"], {"_upto": "_n"})
    blocks = placed.select("a", F.floor((F.col("_upto") - 1) / (least * block_rows)).alias("block"))
    return checkpoint(blocks.orderBy("a"))


def _block_candidates(heavy: DataFrame, pairs: DataFrame, k: int, block_entries: int, block_rows: int) -> DataFrame:
    """Best ``k`` of every row within each pair of blocks, light and crowded columns added up.

    Blocks hold about ``block_entries`` crowded entries (at most one row more) and ``block_rows`` rows.
    """
    blocks = row_blocks(heavy, block_entries, block_rows)
    last = blocks.agg(F.max("block")).scalar()
    owned = heavy.join(blocks, "a")
    # Every block meets every block not before it: (low, high) with low <= high.
    meets = F.explode(F.sequence(F.lit(0).cast("long"), last))
    entries = owned.withColumn("_with", meets).select(
        F.least("block", "_with").alias("low"), F.greatest("block", "_with").alias("high"), F.col("a").alias("row"),
        F.col("c").alias("column"), F.col("weight").alias("value"), F.col("block").alias("own"),
    )
    side = blocks.withColumnsRenamed({"a": "b", "block": "_bb"})
    known = checkpoint(pairs.join(blocks, "a", "left").join(side, "b", "left"))
    inside = F.col("block").isNotNull() & F.col("_bb").isNotNull()
    outside = _mirrored(known.where(~inside).select("a", "b", "similarity"))
    known = known.where(inside).select(
        F.least("block", "_bb").alias("low"),
        F.greatest("block", "_bb").alias("high"),
        F.col("a").alias("one"),
        F.col("b").alias("two"),
        F.col("similarity").alias("light"),
    )

    def best(key, left, right):
        low, high = key
        empty = pd.DataFrame({"a": [], "b": [], "similarity": []})
        rows_a = np.unique(left.loc[left["own"] == low, "row"].to_numpy())
        rows_b = np.unique(left.loc[left["own"] == high, "row"].to_numpy())
        if not len(rows_a) or not len(rows_b):
            return empty
        columns, place = np.unique(left["column"].to_numpy(), return_inverse=True)
        sim = np.zeros((len(rows_a), len(rows_b)))
        ids, value, own = left["row"].to_numpy(), left["value"].to_numpy(), left["own"].to_numpy()
        step = 2048
        for start in range(0, len(columns), step):
            here = (place >= start) & (place < start + step)
            width = min(step, len(columns) - start)
            one = np.zeros((len(rows_a), width))
            two = np.zeros((len(rows_b), width))
            pick = here & (own == low)
            one[np.searchsorted(rows_a, ids[pick]), place[pick] - start] = value[pick]
            pick = here & (own == high)
            two[np.searchsorted(rows_b, ids[pick]), place[pick] - start] = value[pick]
            sim += one @ two.T
        # A light pair has its smaller id in the lower block, as blocks follow the ids.
        at = np.searchsorted(rows_a, right["one"].to_numpy()), np.searchsorted(rows_b, right["two"].to_numpy())
        light = right["light"].to_numpy()
        np.add.at(sim, at, light)
        if low == high:
            np.add.at(sim, at[::-1], light)
            np.fill_diagonal(sim, 0.0)
        parts = []
        for matrix, mine, theirs in ((sim, rows_a, rows_b), (sim.T, rows_b, rows_a)):
            rank = np.round(np.abs(matrix), 9)
            keep = min(k, matrix.shape[1])
            # theirs is ascending, so a stable sort breaks ties by the lower id
            order = np.argsort(-rank, axis=1, kind="stable")[:, :keep]
            at = np.repeat(np.arange(len(mine)), keep)
            found = {"a": mine[at], "b": theirs[order.ravel()], "similarity": matrix[at, order.ravel()]}
            parts.append(pd.DataFrame(found))
            if low == high:
                break
        return pd.concat(parts)

    grouped = entries.groupBy("low", "high").cogroup(known.groupBy("low", "high"))
    return grouped.applyInPandas(best, "a long, b long, similarity double").unionByName(outside)


def neighbour_predict(
    train: DataFrame, pairs: DataFrame, axis: str, k: int = 40, name: str = "predicted", hot: int = 500, **kw
) -> DataFrame:
    """Neighbourhood prediction along ``axis`` (``user_id`` or ``item_id``).

    Base (mean of the axis value, global mean if new) + sum(sim x deviation) / sum(|sim|)
    over the k nearest neighbours. A neighbour without a rating for the other
    side enters with deviation 0 but counts in the denominator. Without any
    similarity the mean deviation of the other side over the whole axis stands in.
    """
    other = "item_id" if axis == "user_id" else "user_id"
    dev = checkpoint(deviations(train, axis).select(axis, other, "dev"))
    near = checkpoint(neighbour_lists(train, axis, k, hot, **kw))
    total = F.aggregate("similarity", F.lit(0.0), lambda t, s: t + F.abs(s))
    weight = near.select("a", total.alias("_weight"))
    means = train.groupBy(axis).agg(F.avg("rating").alias("_base"))
    everyone = train.select(axis).union(pairs.select(axis)).agg(F.countDistinct(axis)).scalar()
    fallback = dev.groupBy(other).agg((F.sum("dev") / everyone).alias("_fallback"))
    overall = train.agg(F.avg("rating")).scalar()
    wanted = pairs.select("user_id", "item_id").distinct()
    sums = _neighbour_sums(wanted, near, dev, axis, other, hot)
    joined = (
        pairs.join(means, axis, "left")
        .join(weight.withColumnRenamed("a", axis), axis, "left")
        .join(fallback, other, "left")
        .join(sums, ["user_id", "item_id"], "left")
    )
    shift = F.when(
        F.coalesce("_weight", F.lit(0.0)) > 0, F.coalesce("_sum", F.lit(0.0)) / F.col("_weight")
    ).otherwise(F.coalesce("_fallback", F.lit(0.0)))
    predicted = clip(F.coalesce("_base", overall) + shift, LOW, HIGH)
    return joined.withColumn(name, predicted).drop("_base", "_weight", "_fallback", "_sum")


def _neighbour_sums(wanted: DataFrame, near: DataFrame, dev: DataFrame, axis: str, other: str, hot: int) -> DataFrame:
    """(user_id, item_id, _sum): similarity x deviation over the neighbours that have rated the other side.

    A wanted pair meets the list of those who rated its other side, then its row's neighbours. Where more than ``hot``
    have rated, the neighbours are looked up one by one instead.
    """
    sizes = dev.groupBy(other).agg(F.count(F.lit(1)).alias("_size"))
    crowded = checkpoint(sizes.filter(F.col("_size") > hot).select(other))
    any_crowded = crowded.limit(1).count() > 0
    light, few = (d.join(crowded, other, "left_anti") if any_crowded else d for d in (dev, wanted))
    raters = light.where(F.col(axis).isNotNull()).groupBy(other).agg(F.collect_list(F.struct(F.col(axis).alias("b"), "dev")).alias("_raters"))
    known = near.select(F.col("a").alias(axis), F.map_from_arrays("b", "similarity").alias("_near"))
    term = lambda t, r: t + F.coalesce(F.try_element_at("_near", r["b"]) * r["dev"], F.lit(0.0))
    met = few.join(raters, other).join(known, axis)
    sums = met.select("user_id", "item_id", F.aggregate("_raters", F.lit(0.0), term).alias("_sum"))
    if not any_crowded:
        return sums
    cells = near.select(F.col("a").alias(axis), F.explode(F.arrays_zip("b", "similarity")).alias("n")).select(axis, "n.*")
    rest = (
        wanted.join(crowded, other, "left_semi")
        .join(cells, axis)
        .join(dev.select(F.col(axis).alias("b"), other, "dev"), ["b", other])
        .groupBy("user_id", "item_id")
        .agg(F.sum(F.col("similarity") * F.col("dev")).alias("_sum"))
    )
    return sums.unionByName(rest)


class FactorModel(NamedTuple):
    """A factorization with the numbers its axes got: (user_id, user_no) and (item_id, item_no)."""

    als: ALSModel
    users: DataFrame
    items: DataFrame


def _numbered(train: DataFrame, axis: str) -> DataFrame:
    """(id, number) of the axis: the factorization takes 32-bit numbers only, ids may be longer."""
    ids = with_position(train.select(f"{axis}_id").distinct(), [f"{axis}_id"], name="_no")
    return checkpoint(ids.select(f"{axis}_id", F.col("_no").cast("int").alias(f"{axis}_no")))


def factor_fit(
    train: DataFrame, rank: int = 50, iterations: int = 15, reg: float = 0.05, seed: int = 42
) -> FactorModel:
    """Alternating least squares on what the biases leave; rank is kept below both axes. Ids of any size."""
    users, items = _numbered(train, "user"), _numbered(train, "item")
    als = _factorization(users, items, rank, iterations, reg, seed)
    return FactorModel(als.fit(_residuals(_based(train, train, users, items))), users, items)


def _factorization(users: DataFrame, items: DataFrame, rank: int, iterations: int, reg: float, seed: int) -> ALS:
    return ALS(
        rank=max(1, min(rank, min(users.count(), items.count()) - 1)),
        maxIter=iterations,
        regParam=reg,
        userCol="user_no",
        itemCol="item_no",
        ratingCol="residual",
        seed=seed,
        coldStartStrategy="nan",
        checkpointInterval=2,  # shuffle files of the iterations before a checkpoint are removed
    )


def _based(train: DataFrame, pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``pairs`` with the unclipped bias prediction ``_base`` and their numbers, null for a new user or item."""
    based = bias_predict(train, pairs, "_base", clipped=False)
    return based.join(users, "user_id", "left").join(items, "item_id", "left")


def _residuals(based: DataFrame) -> DataFrame:
    known = based.where("user_no is not null and item_no is not null")
    return known.select("user_no", "item_no", (F.col("rating") - F.col("_base")).alias("residual"))


def _factor_scored(als: ALSModel, based: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: the clipped sum of ``_base`` and the factor product; numbers are -1 for a new user or item."""
    scored = als.setPredictionCol("_factor").transform(based)
    extra = F.nanvl(F.coalesce(F.col("_factor").cast("double"), F.lit(0.0)), F.lit(0.0))
    return scored.withColumn(name, clip(F.col("_base") + extra, LOW, HIGH)).drop("_factor")


def _without_null_numbers(based: DataFrame) -> DataFrame:
    return based.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("user_no", "item_no")})


def factor_predict(model: FactorModel, train: DataFrame, pairs: DataFrame, name: str = "predicted") -> DataFrame:
    """Bias prediction plus the factor product; a new user or item keeps the bias prediction."""
    based = _without_null_numbers(_based(train, pairs, model.users, model.items))
    return _factor_scored(model.als, based, name).drop("_base", "user_no", "item_no")


def training_curve(
    train: DataFrame, iterations: Sequence[int], rank: int = 50, reg: float = 0.05, seed: int = 42
) -> DataFrame:
    """Training RMSE after each listed number of iterations. All fits read the same written residuals."""
    users, items = _numbered(train, "user"), _numbered(train, "item")
    based = checkpoint(_based(train, train, users, items).select("rating", "_base", "user_no", "item_no"))
    scored, errors = _without_null_numbers(based), []
    for k, n in enumerate(iterations):
        als = _factorization(users, items, rank, n, reg, seed).fit(_residuals(based))
        scored = _factor_scored(als, scored, f"_p{k}")
        error = F.col("rating") - F.col(f"_p{k}")
        errors.append(F.struct(F.lit(n).alias("iterations"), F.sqrt(F.avg(error * error)).alias("rmse")))
    return scored.agg(F.array(*errors).alias("e")).select(F.explode("e").alias("e")).select("e.*")


def most_active(ratings: DataFrame, axis: str = "user_id") -> DataFrame:
    """The user with the most ratings; the lowest id wins a tie."""
    return ratings.groupBy(axis).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), axis).limit(1)


def top_items(scores: DataFrame, seen: DataFrame, n: int = 10) -> DataFrame:
    """Best ``n`` unseen items of each user in ``scores``; equal scores give the higher item id first.

    Fewer candidates than ``n`` are all returned.
    """
    fresh = without(scores, seen, ["user_id", "item_id"])
    best = Window.partitionBy("user_id").orderBy(F.desc("score"), F.desc("item_id"))
    return fresh.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


#: Items of a block in the order of their bias, ids kept of the blocks before it, users of a group.
BIAS_BLOCK, BIAS_KEPT, BIAS_USERS = 4096, 1024, 8192


def bias_blocks(item_bias: DataFrame, block: int = BIAS_BLOCK, kept: int = BIAS_KEPT) -> tuple[DataFrame, DataFrame]:
    """Items in blocks of falling bias, and what a user of each block has to look at.

    Returns (block, item_id, item_bias, before) with the candidates of a block: its items, those of the next one, and
    (``before`` true) the ``kept`` highest ids of all blocks before it; and (block, top, complete, after) with
    the largest bias of the block, whether those ids are all, and the largest bias behind the next block.
    """
    placed = with_position(item_bias.where("item_bias is not null"), [F.desc("item_bias"), F.desc("item_id")], name="_at")
    placed = checkpoint(placed.select(F.floor(F.col("_at") / block).alias("block"), "item_id", "item_bias"))
    # The highest ids before a block: at most ``kept`` of each block, carried from block to block. A row of ids per
    # block is small, so running unions are taken over (block, ids) and cut each time.
    by_id = Window.partitionBy("block").orderBy(F.desc("item_id"))
    highest = placed.withColumn("_r", F.row_number().over(by_id)).where(F.col("_r") <= kept)
    bounds = placed.groupBy("block").agg(F.max("item_bias").alias("top"))
    blocks = checkpoint(bounds)
    last = blocks.agg(F.max("block")).scalar()
    level, lists = 1, checkpoint(highest.select("block", "item_id", "item_bias"))
    n_blocks = blocks.count()
    while level < n_blocks:  # after a turn a list covers the last 2 * level blocks
        moved = lists.withColumn("block", F.col("block") + level).where(F.col("block") <= last)
        both = lists.unionByName(moved).withColumn("_r", F.row_number().over(by_id)).where(F.col("_r") <= kept)
        lists, level = checkpoint(both.select("block", "item_id", "item_bias")), 2 * level
    before = lists.withColumn("block", F.col("block") + 1).where(F.col("block") <= last)
    own = placed.unionByName(placed.withColumn("block", F.col("block") - 1).where("block >= 0"))
    candidates = own.withColumn("before", F.lit(False)).unionByName(before.withColumn("before", F.lit(True)))
    after = blocks.select((F.col("block") - 2).alias("block"), F.col("top").alias("after"))
    whole = blocks.withColumn("complete", F.col("block") * block <= kept).join(after, "block", "left")
    return checkpoint(candidates), whole


def recommend_by_bias(
    train: DataFrame,
    users: DataFrame,
    n: int = 10,
    block: int = BIAS_BLOCK,
    kept: int = BIAS_KEPT,
    per_group: int = BIAS_USERS,
) -> DataFrame:
    """Top ``n`` by the biases for any number of users; a user without ratings has bias 0.

    Scores follow the items' biases but for two things: clipped scores tie, and seen items are left out. A
    user looks at the block where its scores come down from the upper bound, the next block, and the highest
    ids of all blocks before, whose scores all tie. That settles nearly every user, whatever the number of items;
    a user who has seen too much of it, or whose scores tie at the lower bound, is scored against all items.
    """
    mean, user_bias, item_bias = bias_fit(train)
    chosen = users.select("user_id").distinct().join(user_bias, "user_id", "left")
    chosen = chosen.select("user_id", (mean + F.coalesce("user_bias", F.lit(0.0))).alias("base"))
    items = checkpoint(item_bias)
    candidates, blocks = bias_blocks(items, block, kept)
    # One number per block of items, smallest first: the last block whose best score is at the bound.
    bounds = blocks.agg(F.array_sort(F.collect_list(F.struct((-F.col("top")).alias("t"), "block")))).scalar()
    full = F.filter("_bounds", lambda b: F.col("base") - b["t"] >= HIGH)
    chosen = checkpoint(chosen)
    placed = chosen.withColumn("_bounds", bounds).withColumn("block", F.greatest(F.size(full) - 1, F.lit(0)).cast("long"))
    crowd = placed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / per_group).cast("long").alias("parts"))
    placed = placed.join(crowd, "block").withColumn("part", F.pmod(F.xxhash64("user_id"), F.col("parts")))
    placed = checkpoint(placed.select("user_id", "base", "block", "part"))
    looked = candidates.join(crowd, "block").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    known = train.select("user_id", "item_id").join(placed.select("user_id", "block"), "user_id")
    known = known.join(candidates.select("block", "item_id"), ["block", "item_id"], "left_semi")
    known = known.groupBy("user_id").agg(F.collect_set("item_id").alias("seen"))  # at most the candidates of a block
    left = placed.join(known, "user_id", "left").join(blocks, "block")

    def settle(key, people, catalog):
        out = []
        ids, bias, old = (catalog[c].to_numpy() for c in ("item_id", "item_bias", "before"))
        order = np.argsort(-ids, kind="stable")
        ids, bias, old = ids[order], bias[order], old[order].astype(bool)
        for p in people.itertuples(index=False):
            score = np.clip(p.base + bias, LOW, HIGH)
            fresh = np.ones(len(ids), dtype=bool)
            if p.seen is not None:
                at = len(ids) - 1 - np.searchsorted(ids[::-1], np.asarray(p.seen, dtype=ids.dtype))
                fresh[at] = False
            enough = p.complete or int((fresh & old).sum()) >= n
            place = np.flatnonzero(fresh)
            best = place[np.argsort(-score[place], kind="stable")[:n]]
            beyond = -np.inf if p.after is None or np.isnan(p.after) else float(np.clip(p.base + p.after, LOW, HIGH))
            if enough and (beyond == -np.inf or (len(best) == n and score[best[-1]] > beyond)):
                out.append(pd.DataFrame({"user_id": p.user_id, "item_id": ids[best], "score": score[best]}))
            else:
                out.append(pd.DataFrame({"user_id": [p.user_id], "item_id": [0], "score": [None]}))
        return pd.concat(out) if out else pd.DataFrame({"user_id": [], "item_id": [], "score": []})

    grouped = left.groupBy("block", "part").cogroup(looked.groupBy("block", "part"))
    settled = checkpoint(grouped.applyInPandas(settle, "user_id long, item_id long, score double"))
    done = settled.where("score is not null")
    best = Window.partitionBy("user_id").orderBy(F.desc("score"), F.desc("item_id"))
    done = done.withColumn("rank", F.row_number().over(best))
    none = F.array(F.lit(0.0).cast("float"))
    open_users = chosen.join(settled.where("score is null").select("user_id"), "user_id", "left_semi")
    rest = _best_of_blocks(open_users.withColumn("features", none), items.withColumn("features", none), train, n)
    return done.unionByName(rest.select(*done.columns))


def recommend_by_factors(model: FactorModel, train: DataFrame, users: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` by bias plus factors for any number of users with training ratings.

    The item bias joins the item factors as one more dimension (weight 1 on the
    user side), so ranking by the raw score is one factor product.
    """
    mean, user_bias, item_bias = bias_fit(train)
    factors = model.als.itemFactors.join(model.items, F.col("id") == F.col("item_no"))
    items = factors.join(item_bias, "item_id").select("item_id", "item_bias", "features")
    wanted = model.users.join(users.select("user_id").distinct(), "user_id").join(user_bias, "user_id")
    chosen = model.als.userFactors.join(wanted, F.col("id") == F.col("user_no")).select(
        "user_id", (mean + F.col("user_bias")).alias("base"), "features"
    )
    return _best_of_blocks(chosen, items, train, n)


def _best_of_blocks(chosen: DataFrame, items: DataFrame, train: DataFrame, n: int) -> DataFrame:
    seen = train.join(chosen.select("user_id"), "user_id", "left_semi").select("user_id", "item_id")
    scores = blocked_scores(chosen, items, seen, n)
    best = Window.partitionBy("user_id").orderBy(F.desc("score"), F.desc("item_id"))
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


#: Users of a group, at least and at most; groups are otherwise two for each core.
GROUP_USERS = (512, 262_144)
#: Items scored at a time, and users.
ITEMS_AT_ONCE, USERS_AT_ONCE = 4096, 256
_NO_ID = np.iinfo(np.int64).min  # stands for a null item id
_STREAM = ["group", "kind", "user_id", "item_id", "value", "features"]
_BEST_ITEMS = pa.schema([("user_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64())])


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a column of equally long lists, in doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


class _Shortlists:
    """The best ``n`` unseen items of each user of a group; items come in order of falling ids.

    So a later item needs a higher score than the last of the list, and a user with ``n`` items at the upper bound
    is done. Items are taken in steps that grow with those seen, so few of them ever enter a list.
    """

    def __init__(self, n: int):
        self.n, self.told, self.users, self.items, self.pairs = n, [], None, 0, []

    def add(self, rows: pa.RecordBatch) -> None:
        kind = rows.column("kind").to_numpy()
        first = int(np.searchsorted(kind > 0, True))  # users come before all else
        if first:
            self.told.append(rows.slice(0, first))
        rest, kind = rows.slice(first), kind[first:]
        if not len(kind) or not self.told:
            return
        if self.users is None:
            self._begin()
        if not self.active.any():
            self.pairs = []
            return
        ids = pc.fill_null(rest.column("item_id"), _NO_ID).to_numpy(zero_copy_only=False)
        pair = np.flatnonzero(kind == 1)
        if len(pair):
            user = rest.column("user_id").take(pa.array(pair)).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(self.users, user), len(self.users) - 1)
            known = self.users[at] == user
            self.pairs.append((at[known], ids[pair[known]]))
        item = np.flatnonzero(kind == 2)
        if not len(item):
            return
        catalog = rest.take(pa.array(item))
        ids, bias = ids[item], catalog.column("value").cast(pa.float64()).to_numpy(zero_copy_only=False)
        factors, begin = _matrix(catalog.column("features")), 0
        while begin < len(ids):
            end = begin + min(ITEMS_AT_ONCE, max(64, self.items))
            self._step(ids[begin:end], bias[begin:end], factors[begin:end])
            self.items, begin = self.items + len(ids[begin:end]), end
        self.pairs = [(at[i < ids[-1]], i[i < ids[-1]]) for at, i in self.pairs]  # what waits for its item

    def _begin(self) -> None:
        told = pa.Table.from_batches(self.told).sort_by("user_id").combine_chunks()
        self.users = told.column("user_id").to_numpy()
        self.base = told.column("value").to_numpy()
        self.factors = _matrix(told.column("features").combine_chunks())
        self.score = np.full((len(self.users), self.n), -np.inf)
        self.best = np.full((len(self.users), self.n), _NO_ID)
        self.active = np.ones(len(self.users), dtype=bool)

    def _step(self, ids: np.ndarray, bias: np.ndarray, factors: np.ndarray) -> None:
        at, item = (np.concatenate(c) for c in zip(*self.pairs, strict=True)) if self.pairs else (np.zeros(0, int),) * 2
        place = np.maximum(len(ids) - 1 - np.searchsorted(ids[::-1], item), 0)
        here = (ids[place] == item) & (item != _NO_ID)
        order = np.argsort(at[here], kind="stable")
        at, place = at[here][order], place[here][order]
        active = np.flatnonzero(self.active)
        for k in range(0, len(active), USERS_AT_ONCE):
            rows = active[k : k + USERS_AT_ONCE]
            score = self.factors[rows] @ factors.T
            score += self.base[rows, None]
            score += bias[None, :]
            np.clip(score, LOW, HIGH, out=score)
            low, high = np.searchsorted(at, [rows[0], rows[-1] + 1])
            r = np.searchsorted(rows, at[low:high])
            among = rows[r] == at[low:high]
            score[r[among], place[low:high][among]] = -np.inf
            r, c = np.nonzero(score > self.score[rows, -1:])
            if len(r):
                self._enter(rows, r, score[r, c], ids[c])
        self.active &= ~(self.score[:, -1] >= HIGH)

    def _enter(self, rows: np.ndarray, r: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """New items, by user and falling id; of equal scores the ones before stay ahead."""
        order = np.lexsort((np.arange(len(r)), -score, r))
        r, score, ids = r[order], score[order], ids[order]
        begins = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        sizes = np.diff(np.append(begins, len(r)))
        rank = np.arange(len(r)) - np.repeat(begins, sizes)
        users, own, kept = rows[r[begins]], np.repeat(np.arange(len(begins)), sizes), rank < self.n
        scores = np.full((len(users), self.n), -np.inf)
        names = np.full((len(users), self.n), _NO_ID)
        scores[own[kept], rank[kept]], names[own[kept], rank[kept]] = score[kept], ids[kept]
        scores = np.concatenate([self.score[users], scores], axis=1)
        names = np.concatenate([self.best[users], names], axis=1)
        first = np.argsort(-scores, axis=1, kind="stable")[:, : self.n]
        self.score[users] = np.take_along_axis(scores, first, axis=1)
        self.best[users] = np.take_along_axis(names, first, axis=1)

    def result(self) -> pa.RecordBatch:
        if self.users is None:
            return pa.RecordBatch.from_pylist([], schema=_BEST_ITEMS)
        user, place = np.nonzero(self.score > -np.inf)
        item = self.best[user, place]
        columns = [pa.array(self.users[user]), pa.array(item, mask=item == _NO_ID), pa.array(self.score[user, place])]
        return pa.RecordBatch.from_arrays(columns, schema=_BEST_ITEMS)


def _shortlisted(n: int):
    """Rows of ``_STREAM`` in order of groups -> the best items of the users of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, lists = None, None
        for batch in batches:
            groups = batch.column("group").to_numpy()
            cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(groups)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                if begin == end:
                    continue
                if lists is None or groups[begin] != group:
                    if lists is not None:
                        yield lists.result()
                    group, lists = groups[begin], _Shortlists(n)
                lists.add(batch.slice(begin, end - begin))
        if lists is not None:
            yield lists.result()

    return run


def blocked_scores(users: DataFrame, items: DataFrame, seen: DataFrame, n: int) -> DataFrame:
    """The best ``n`` unseen items of each user: scores by matrix products, of equal ones the higher id first.

    Users are dealt out in groups, and every group passes over all items in order of falling ids: the work is
    users x items, but for users whose ``n`` best are at the upper bound early. A task holds its users with
    their lists and one batch of items; items are sent once for each group, of which there are two a core (more for
    more than ``GROUP_USERS`` users in each), and ``n`` rows for a user come back.
    """
    users, items = checkpoint(users), checkpoint(items)
    n_users, cores = users.count(), users.sparkSession.sparkContext.defaultParallelism
    least, most = GROUP_USERS
    groups = max(1, -(-n_users // most), min(2 * cores, -(-n_users // least)))
    own = F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int").alias("group")
    nothing = {"user_id": "long", "item_id": "long", "value": "double", "features": "array<float>"}
    empty = {c: F.lit(None).cast(t).alias(c) for c, t in nothing.items()}
    features = F.col("features").cast("array<float>").alias("features")
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    stream = users.where("user_id is not null").select(
        own, F.lit(0).alias("kind"), "user_id", empty["item_id"], F.col("base").alias("value"), features
    )
    pairs = seen.where("user_id is not null and item_id is not null")
    stream = stream.unionByName(pairs.select(own, F.lit(1).alias("kind"), "user_id", "item_id", empty["value"], empty["features"]))
    stream = stream.unionByName(
        items.select(every, F.lit(2).alias("kind"), empty["user_id"], "item_id", F.col("item_bias").alias("value"), features)
    )
    # An item follows the pairs that name it; an item without an id comes last.
    order = ["group", F.col("kind") > 0, F.desc_nulls_last("item_id"), "kind"]
    dealt = stream.repartitionByRange(groups, "group").sortWithinPartitions(*order)
    return dealt.select(*_STREAM).mapInArrow(_shortlisted(n), "user_id long, item_id long, score double")
