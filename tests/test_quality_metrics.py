"""Profiles, imputation, expectations and evaluation against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetboard.operators import metrics, quality
from assetboard.operators.features import aging_curves


def test_missingness_and_sparse_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, None, None), (4, "b", None), (5, None, None)], "id int, half string, none double")
    rows = {r["column_name"]: (r["missing_count"], r["missing_pct"]) for r in quality.missingness(df).collect()}
    assert rows == {"half": (3, 60.0), "none": (5, 100.0)}
    kept, dropped = quality.drop_sparse_columns(df)
    assert kept.columns == ["id"] and dropped == ["half", "none"]
    kept, dropped = quality.drop_sparse_columns(df, limit=1.0)
    assert dropped == ["none"]
    assert quality.drop_listed(df, ["half", "absent"], ["gone"]).columns == ["id", "none"]


def test_duplicate_keys_merge_in_tasks_of_their_own(spark):
    # after a join on one of the keys, the join and the counts before and after merging shared a task's memory.
    left = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, None), (2, None), (3, 1)], "k int, n int")
    df = left.join(spark.createDataFrame([(1,), (2,), (3,)], "k int").hint("merge"), "k")
    got = quality.duplicate_keys(df, ["k", "n"])
    assert got.columns == ["k", "n", "copies"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 1, 2), (2, None, 2)]
    plan = quality.duplicate_keys(df, ["k", "n"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan.split("HashAggregate")[1] and "SortMergeJoin" in plan.split("HashAggregate")[2]


def test_sparse_columns_read_their_input_once(spark):
    # the shares and the result each repeated the joins below them.
    df = spark.range(50).join(spark.range(0, 50, 2).withColumn("even", F.lit(1)), "id", "left").withColumn("rare", F.when(F.col("id") < 10, 1))
    kept, dropped = quality.drop_sparse_columns(df, 0.6)
    assert dropped == ["rare"] and kept.columns == ["id", "even"] and kept.count() == 50
    assert "Join" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_impute_median_mode_ties_and_unknown(spark):
    df = spark.createDataFrame(
        [(1.0, "b", None), (None, "a", None), (3.0, "b", None), (10.0, "a", None), (4.0, None, None)], "x double, c string, e string")
    fills = quality.fit_imputer(df, ["x"], ["c", "e"])
    assert fills == {"x": 3.5, "c": "a", "e": "Unknown"}  # a tie goes to the smaller value
    assert quality.impute(df, fills).where("x is null or c is null or e is null").isEmpty()


def test_impute_keeps_the_half_of_a_median(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "n int")
    out = quality.impute(df, quality.fit_imputer(df, ["n"], []))
    assert out.dtypes == [("n", "double")] and [r[0] for r in out.collect()] == [1, 1.5, 2]


def test_null_scores_and_labels_count_nowhere(spark):
    rows = [(1, 0.9), (0, 0.1), (1, None), (None, 0.5)]
    df = spark.createDataFrame(rows, "label int, p double")
    loss = metrics.log_loss(df, "label", "p").first()
    assert loss["log_loss"] == pytest.approx(0.10536051) and loss["n_rows"] == 2
    counts = metrics.threshold_counts(df, "label", "p", [0.5]).first()
    assert (counts["tp"], counts["fp"], counts["fn"], counts["tn"]) == (1, 0, 0, 1)
    whole = metrics.evaluate(df, "label", "p").first()
    assert whole["log_loss"] == pytest.approx(0.10536051) and whole["roc_auc"] == 1.0 and whole["accuracy"] == 1.0


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "c")], "k int, v string")
    rules = [quality.NotNull("v"), quality.RowCount(3), quality.Share("known", F.col("v").isNotNull(), 0.5), quality.Unique(("k",))]
    report = quality.expectations(df, rules)
    assert {r["rule"]: r["passed"] for r in report.collect()} == {"not_null(v)": False, "row_count": True, "share(known)": True, "unique(k)": False}
    with pytest.raises(ValueError, match="not_null"):
        quality.require(report)
    quality.require(quality.expectations(df, [quality.RowCount(3)]))


def test_degenerate_and_duplicates(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (1, None, "x")], "one int, none int, two string")
    got = {r["feature"]: r["degenerate"] for r in quality.degenerate_features(df, df.columns).collect()}
    assert got == {"one": True, "none": True, "two": False}
    assert quality.usable_features(df, df.columns) == ["two"]
    assert quality.duplicate_row_count(df).first()[0] == 1
    assert quality.duplicate_row_count(df.where("two = 'y'")).first()[0] == 0


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])


def test_auc_with_ties_and_hot_score(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    p = np.round(rng.random(400), 2)
    p[::3] = 0.5
    df = spark.createDataFrame([(int(a), float(b), "m") for a, b in zip(y, p)], "y int, p double, m string")
    assert np.isclose(metrics.roc_auc(df, "y", "p").first()[0], brute_auc(y, p))
    assert np.isclose(metrics.roc_auc(df, "y", "p", ["m"]).first()[1], brute_auc(y, p))
    assert metrics.roc_auc(df.where("y = 1"), "y", "p").first()[0] is None


def test_thresholds_and_absent_class(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.4), (1, 0.4), (0, 0.1)], "y int, p double")
    got = {r["threshold"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in metrics.threshold_sweep(df, "y", "p", [0.4, 0.5, 0.95]).collect()}
    assert got == {0.4: (2, 1, 0, 1), 0.5: (1, 0, 1, 2), 0.95: (0, 0, 2, 2)}
    row = metrics.threshold_sweep(df, "y", "p", [0.95]).first()
    assert (row["precision"], row["recall"], row["f1_score"]) == (0.0, 0.0, 0.0)
    cells = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion_matrix(df.where("p > 0.8"), "y", "p").collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}
    report = {r["class"]: r for r in metrics.classification_report(df, "y", "p", [0.5]).collect()}
    assert report["accuracy"]["support"] == 4 and report["1"]["recall"] == 0.5 and report["macro avg"]["recall"] == 0.75


def test_spearman_and_min_pairs(spark):
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 6, 60).astype(float), rng.random(60)
    rank = lambda v: np.array([np.mean(np.where(np.sort(v) == a)[0]) for a in v])
    want = np.corrcoef(rank(x), rank(y))[0, 1]
    rows = [(float(a), float(b), float(i) if i < 9 else None, 1.0) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, few double, flat double")
    got = {r["feature"]: r["spearman"] for r in metrics.feature_spearman(df, ["x", "few", "flat"], "y").collect()}
    assert set(got) == {"x", "flat"} and np.isclose(got["x"], want) and got["flat"] is None


def test_regression_metrics_top_rows(spark):
    rows = [("b", i, float(i), float(i) + (10 if i >= 95 else 1)) for i in range(100)]
    df = spark.createDataFrame(rows, "board string, id int, t double, p double")
    got = metrics.regression_metrics(df, ["board"], "t", "p", "id", top=5).first()
    assert np.isclose(got["top5_mae"], 10.0) and np.isclose(got["mae"], 1.45) and np.isclose(got["spearman"], 1.0)


def test_aging_curve_equals_polyfit(spark):
    rng = np.random.default_rng(11)
    rows = []
    for group, a in (("concave", -0.4), ("convex", 0.3)):
        for _ in range(200):
            x = int(rng.integers(21, 36))
            rows.append((group, x, a * (x - 27) ** 2 + 15 + float(rng.random()), 10))
    rows += [("short", 25, 1.0, 10)] * 19 + [("concave", 25, 999.0, 3), ("concave", None, 999.0, 9)]
    df = spark.createDataFrame(rows, "g string, age int, y double, games int")
    got = {r["g"]: r for r in aging_curves(df, "g", "y").collect()}
    assert set(got) == {"concave", "convex"}
    for g in got:
        x, y = zip(*[(r[1], r[2]) for r in rows if r[0] == g and r[1] is not None and r[3] >= 4])
        a, b, c = np.polyfit(x, y, 2)
        assert np.allclose([got[g]["a"], got[g]["b"], got[g]["c"]], [a, b, c], rtol=1e-6)
        assert np.isclose(got[g]["peak_age"], -b / (2 * a) if a < 0 else np.median(x))
