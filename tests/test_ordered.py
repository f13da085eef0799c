"""Positions, running totals, quantiles and time series against pandas, hot values included."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import ordered, sampling, stats
from lumenframe.operators import timeseries as ts
from lumenframe.operators.features import quantile_bins, standardize


@pytest.fixture(scope="module")
def frame():
    """One group with two thirds of the rows; one value on a third of all rows."""
    rng = np.random.default_rng(3)
    n = 3000
    v = rng.normal(size=n).round(3)
    v[: n // 3] = 1.5
    return pd.DataFrame({"id": rng.permutation(n), "g": np.where(rng.random(n) < 0.66, "hot", "cold"), "v": v})


def test_position_matches_sorted_order(spark, frame):
    got = ordered.with_position(spark.createDataFrame(frame), ["v", "id"], ["g"], total="n").toPandas()
    want = frame.sort_values(["v", "id"])
    want["position"] = want.groupby("g").cumcount()
    both = got.merge(want, on="id")
    assert (both["position_x"] == both["position_y"]).all()
    assert (got.groupby("g")["n"].first() == frame.groupby("g").size()).all()


def test_position_keeps_rows_of_a_null_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, g string")
    got = {r.id: r.position for r in ordered.with_position(df, ["id"], ["g"]).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_running_total(spark, frame):
    got = ordered.with_running(
        spark.createDataFrame(frame), ["id"], {"run": "v"}, by=["g"], totals=True
    ).toPandas()
    want = frame.sort_values("id")
    want["run"] = want.groupby("g")["v"].cumsum()
    both = got.merge(want, on="id")
    assert np.allclose(both["run_x"], both["run_y"])
    assert np.allclose(got.groupby("g")["run_total"].first(), frame.groupby("g")["v"].sum())


@pytest.mark.parametrize("by", [[], ["g"]])
def test_exact_quantiles(spark, frame, by):
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.333, 0.99, 1.0]
    got = ordered.exact_quantiles(spark.createDataFrame(frame), ["v"], probabilities, by).toPandas()
    for _, row in got.iterrows():
        part = frame if not by else frame[frame["g"] == row["g"]]
        assert row["value"] == pytest.approx(part["v"].quantile(row["probability"]), abs=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert ordered.exact_quantiles(df, ["v"], [0.5]).count() == 0


def test_approximate_quantiles_are_close(spark, frame):
    got = ordered.approximate_quantiles(spark.createDataFrame(frame), ["v"], [0.5]).first()
    assert abs(got["value"] - frame["v"].median()) < 0.05


def test_quantile_bins_match_pandas(spark, frame):
    got = quantile_bins(spark.createDataFrame(frame), "v", 10).withColumnRenamed("v_bin", "bin").toPandas().sort_values("id")
    want = pd.qcut(frame.sort_values("id")["v"], 10, labels=False, duplicates="drop")
    assert (got["bin"].to_numpy() == want.to_numpy()).all()


def test_standardize_uses_population_deviation(spark, frame):
    constant = frame.assign(c=2.0)
    got = standardize(spark.createDataFrame(constant), ["v", "c"]).toPandas()
    assert abs(got["v"].mean()) < 1e-9 and abs(got["v"].std(ddof=0) - 1) < 1e-9
    assert (got["c"] == 0).all()


@pytest.fixture(scope="module")
def hourly():
    rng = np.random.default_rng(5)
    n = 700
    v = np.abs(60 + 50 * np.sin(np.arange(n) * 2 * np.pi / 24) + rng.normal(0, 5, n))
    v[::50] = np.nan
    v[-3:] = np.nan
    v[300:310] = np.nan
    times = pd.date_range("2010-01-01", periods=n, freq="h")
    return pd.DataFrame({"ts": times, "id": np.arange(n), "v": v})


def frame_of(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))


@pytest.mark.parametrize("chunk", [100, 500_000])
def test_interpolation_matches_pandas(spark, hourly, chunk):
    got = ts.interpolate(frame_of(spark, hourly), "v", ["ts", "id"], chunk_rows=chunk).toPandas().sort_values("id")
    want = hourly["v"].interpolate()
    assert np.allclose(got["filled"].to_numpy(dtype=float), want, equal_nan=True)
    full = ts.fill_leading(
        ts.interpolate(frame_of(spark, hourly), "v", ["ts", "id"], chunk_rows=chunk), "filled"
    ).toPandas()
    assert np.allclose(full.sort_values("id")["filled"], want.fillna(want.median()))


def test_interpolation_keeps_a_series_with_a_null_key(spark):
    rows = [(s, t, float(t) if t != 1 else None) for s in ("a", None) for t in range(3)]
    df = spark.createDataFrame(rows, "series string, t int, v double")
    got = ts.interpolate(df, "v", ["t"], by=["series"]).collect()
    assert sorted((str(r["series"]), r["t"], r["filled"]) for r in got) == [
        (s, t, float(t)) for s in ("None", "a") for t in range(3)
    ]


@pytest.mark.parametrize("chunk", [100, 500_000])
def test_history_matches_pandas(spark, hourly, chunk):
    got = (
        ts.history_features(frame_of(spark, hourly), "v", ["ts", "id"], lags=(1, 72), windows=(6, 48), chunk_rows=chunk)
        .toPandas()
        .sort_values("id")
    )
    v = hourly["v"]
    assert len(got) == len(v)
    for name, want in {
        "lag_1": v.shift(1),
        "lag_72": v.shift(72),
        "roll_mean_6": v.shift(1).rolling(6).mean(),
        "roll_std_48": v.shift(1).rolling(48).std(),
    }.items():
        assert np.allclose(got[name].to_numpy(dtype=float), want, equal_nan=True, atol=1e-9), name


def test_chunks_must_hold_the_longest_lag(spark, hourly):
    with pytest.raises(ValueError):
        ts.history_features(frame_of(spark, hourly), "v", ["ts"], chunk_rows=10)


def test_temporal_split_keeps_chronology(spark, hourly):
    train, test = ts.temporal_split(frame_of(spark, hourly), "ts", "2010-01-15")
    last, first = train.agg(F.max("ts")).first()[0], test.agg(F.min("ts")).first()[0]
    assert last < pd.Timestamp("2010-01-15") <= first
    assert train.count() + test.count() == len(hourly)


def test_random_split_is_exact_disjoint_and_repeatable(spark, frame):
    df = spark.createDataFrame(frame)
    got = sampling.random_split(df, "id", 0.2).toPandas()
    assert (got["split"] == "test").sum() == int(len(frame) * 0.2)
    again = sampling.random_split(df.repartition(7), "id", 0.2).toPandas()
    assert set(got[got["split"] == "test"]["id"]) == set(again[again["split"] == "test"]["id"])


def test_stratified_split_keeps_every_class(spark, frame):
    got = sampling.random_split(spark.createDataFrame(frame), "id", 0.2, by=["g"]).toPandas()
    for _, part in got.groupby("g"):
        assert (part["split"] == "test").sum() == round(len(part) * 0.2)


def test_seeds_give_independent_samples(spark):
    df = spark.range(20000)
    both = df.filter(
        (sampling.split_key("id", 42) < 0.2 * 2**32) & (sampling.split_key("id", 11) < 0.5 * 2**32)
    ).count()
    assert abs(both - 2000) < 200


@pytest.mark.parametrize("limit", [100, 1500])
def test_class_cap(spark, frame, limit):
    got = sampling.cap_per_class(spark.createDataFrame(frame), "g", "id", limit).toPandas()
    sizes = frame.groupby("g").size().clip(upper=limit)
    assert (got.groupby("g").size() == sizes).all() and got["id"].is_unique


def test_large_ids_do_not_overflow(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000,), (5,)], "id long")
    assert sampling.hash_split(df, "id").count() == 2


def test_histogram_counts_match_numpy(spark, frame):
    got = stats.histogram(spark.createDataFrame(frame), "v", 30).toPandas().sort_values("bin")
    want, edges = np.histogram(frame["v"], 30)
    assert got["count"].sum() == len(frame) and len(got) == 30
    assert np.abs(got["count"].to_numpy() - want).sum() <= 2
    assert np.allclose(got["left_edge"], edges[:-1])


def test_histogram_of_a_constant(spark):
    got = stats.histogram(spark.createDataFrame([(2.0,)] * 5, "v double"), "v", 4).toPandas()
    assert got["count"].sum() == 5 and got["left_edge"].min() == 1.5


def test_describe_matches_pandas(spark, frame):
    got = stats.describe(spark.createDataFrame(frame), ["v"]).first()
    want = frame["v"].describe()
    assert [got["count"], got["mean"], got["std"], got["min"], got["q1"], got["median"], got["q3"], got["max"]] == (
        pytest.approx(list(want))
    )


def test_normal_quantile_equals_the_standard_library(spark):
    from statistics import NormalDist

    p = [1e-300, 1e-30, 1e-9, 0.001, 0.07, 0.075, 0.3, 0.5, 0.925, 0.93, 0.999, 1 - 1e-12]
    df = spark.createDataFrame([(x,) for x in p], "p double")
    got = [r["z"] for r in df.orderBy("p").select(stats.normal_quantile(F.col("p")).alias("z")).collect()]
    assert np.allclose(got, [NormalDist().inv_cdf(x) for x in p], rtol=1e-13, atol=1e-15)


def test_normal_qq_is_monotone(spark, frame):
    got = stats.normal_qq(spark.createDataFrame(frame), "v", "id").toPandas().sort_values(["theoretical"])
    assert (np.diff(got["observed"]) >= 0).all()
    assert abs(got["theoretical"].median()) < 1e-2
