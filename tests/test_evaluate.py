"""Ranking, alerting and classification measures against hand-made and numpy results."""

import numpy as np
import pytest

from lumenframe.operators import evaluate as ev


def table(spark, y, s):
    return spark.createDataFrame(
        [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))], "id long, y int, score double"
    )


@pytest.fixture(scope="module")
def random_scores():
    rng = np.random.default_rng(1)
    y = (rng.random(1500) < 0.05).astype(int)
    s = (rng.normal(size=1500) + y).round(1)
    s[:500] = 0.3
    return y, s


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_perfect_ranker(spark):
    df = table(spark, [0, 0, 0, 1, 1], [0.1, 0.2, 0.3, 0.9, 0.8])
    counts = ev.score_counts(df, "y", "score")
    assert ev.roc_auc(counts).first()[0] == 1.0
    assert ev.average_precision(counts).first()[0] == pytest.approx(1.0)
    at_k = ev.precision_at_k(df, "y", "score", "id").first()
    assert (at_k["precision_at_k"], at_k["recall_at_k"], at_k["k"]) == (1.0, 1.0, 2)


def test_auc_with_ties(spark, random_scores):
    y, s = random_scores
    assert ev.roc_auc(ev.score_counts(table(spark, y, s), "y", "score")).first()[0] == pytest.approx(brute_auc(y, s))


def test_single_class_has_no_auc(spark):
    counts = ev.score_counts(table(spark, [0, 0], [0.1, 0.2]), "y", "score")
    assert ev.roc_auc(counts).first()[0] is None


def test_no_positives_gives_zero_recall(spark):
    row = ev.precision_at_k(table(spark, [0, 0], [0.1, 0.2]), "y", "score", "id").first()
    assert (row["k"], row["precision_at_k"], row["recall_at_k"]) == (1, 0.0, 0.0)


def test_precision_at_k_breaks_ties_by_id(spark, random_scores):
    y, s = random_scores
    k = y.sum()
    order = sorted(range(len(y)), key=lambda i: (-s[i], i))[:k]
    got = ev.precision_at_k(table(spark, y, s), "y", "score", "id").first()
    assert got["precision_at_k"] == pytest.approx(y[order].sum() / k)


def test_budgets_match_sorted_scores(spark, random_scores):
    y, s = random_scores
    got = {r["budget"]: r for r in ev.alert_budget(table(spark, y, s), "y", "score").collect()}
    assert len(got) == len(ev.BUDGETS)
    caught = []
    for b in ev.BUDGETS:
        n = max(1, min(len(s), round(b * len(s))))
        threshold = np.sort(s)[-n]
        flagged = s >= threshold
        r = got[b]
        assert r["threshold"] == threshold and r["n_alerts"] == flagged.sum()
        assert r["n_caught"] == y[flagged].sum()
        assert r["recall"] == pytest.approx(y[flagged].sum() / y.sum())
        caught.append(r["n_caught"])
    assert caught == sorted(caught)


def test_ties_flag_more_than_the_budget(spark):
    row = ev.alert_threshold(table(spark, [1, 0, 0, 0], [0.5, 0.5, 0.5, 0.1]), "y", "score", 0.25).first()
    assert row["n_alerts"] == 3 and row["recall"] == 1.0


def test_exact_budget_on_separable_scores(spark):
    y = [1] * 4 + [0] * 36
    row = ev.alert_threshold(table(spark, y, range(40, 0, -1)), "y", "score", 0.1).first()
    assert row["n_caught"] == 4 and row["recall"] == 1.0


def test_empty_input_is_an_error(spark):
    with pytest.raises(ValueError):
        ev.alert_threshold(table(spark, [], []), "y", "score", 0.1)


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    row = ev.binary_metrics(df, "y", "p").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)


def test_regression_measures_trivial_cases(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0), (5.0, 6.0)], "a double, p double")
    row = ev.regression_metrics(df, "a", "p").first()
    assert row["mae"] == 1.0 and row["rmse"] == 1.0 and row["r2"] == pytest.approx(1 - 3 / 8)
    same = ev.regression_metrics(df, "a", "a").first()
    assert same["rmse"] == 0.0 and same["r2"] == 1.0


def test_class_report_counts_unpredicted_classes(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (2, 1)], "a int, p int")
    got = {r["class"]: r for r in ev.class_report(df, "a", "p").collect()}
    assert got[1]["recall"] == 1.0 and got[1]["precision"] == pytest.approx(1 / 3)
    assert got[0]["f1"] == 0.0 and got[2]["support"] == 1
    whole = ev.averaged_report(df, "a", "p").first()
    assert whole["accuracy"] == pytest.approx(1 / 3)
