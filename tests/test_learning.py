"""Splits, encoders and fits: exact shares, parity with closed forms, coverage, reload."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from assetboard.operators import learning, network

SMALL = learning.TreeSettings(iterations=5, depth=3, trees=6)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    data = []
    for i in range(400):
        x, z = float(rng.normal()), float(rng.normal())
        y = 1 if rng.random() < 1 / (1 + np.exp(-(1.5 * x - 0.5 * z - 1.0))) else 0
        data.append((i, x, None if i % 10 == 0 else z, "abc"[i % 3], y, float(np.exp(x + 0.1 * rng.normal()) * 100), None if i % 7 == 0 else 5))
    return spark.createDataFrame(data, "id int, x double, z double, c string, y int, value double, career_games int").cache()


def test_stratified_split_shares(rows):
    split = learning.stratified_split(rows, "y", ["id"], learning.DELAY_SPLIT)
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    for r in split.groupBy("y", "split").count().collect():
        assert abs(r["count"] - learning.DELAY_SPLIT[r["split"]] * sizes[r["y"]]) <= 1
    assert split.count() == split.select("id").distinct().count() == 400


def test_split_ranks_few_rows_and_reads_its_input_once(spark):
    # the split sorted all rows by class and slice, and read its input twice.
    df = spark.range(40000).join(spark.range(0, 40000, 3).withColumn("y", F.lit(1)), "id", "left").fillna(0)
    split = learning.stratified_split(df, "y", ["id"], learning.DELAY_SPLIT)
    sizes = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert sizes == {(0, "train"): 18666, (0, "val"): 4000, (0, "test"): 4000, (1, "train"): 9334, (1, "val"): 2000, (1, "test"): 2000}
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and "Filter NOT" in plan.split("Window", 1)[1]  # only slices that a border cuts come to the window


def test_sample_is_exact_and_stable(rows):
    first = sorted(r["id"] for r in learning.exact_sample(rows, 37, ["id"]).collect())
    again = sorted(r["id"] for r in learning.exact_sample(rows.repartition(5), 37, ["id"]).collect())
    assert len(set(first)) == 37 and first == again
    assert learning.exact_sample(rows, 1000, ["id"]).count() == 400


def test_folds(spark, rows):
    sizes = [r["count"] for r in learning.assign_folds(rows, ["id"], 7).groupBy("fold").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    tiny = learning.assign_folds(rows.limit(3), ["id"], 10)
    assert sorted(r["fold"] for r in tiny.collect()) == [0, 1, 2]


def test_scaler_is_population_and_safe_for_constants(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, b double")
    assert learning.fit_scaler(df, ["a", "b"]) == {"a": 1.0, "b": 1.0}
    assert learning.fit_scaler(spark.createDataFrame([(0.0,), (4.0,)], "a double"), ["a"]) == {"a": 2.0}


def test_unknown_category_is_all_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    model = learning.encoder(train, [], ["c"])
    got = model.transform(spark.createDataFrame([("b",), ("zz",)], "c string")).select(vector_to_array("features")).collect()
    assert [list(r[0]) for r in got] == [[0.0, 1.0], [0.0, 0.0]]


def test_encoder_is_plain_columns_with_the_same_slots(spark):
    # encoded vectors were made by row functions, written and read again for every fit.
    df = spark.createDataFrame([(2.0, "b", "x"), (4.0, "a", "y"), (6.0, None, "x")], "n double, c string, d string")
    model = learning.encoder(df, ["n"], ["c", "d"], scaled=False)
    flat = model.transform(df, vector=False)
    assert [r["features"] for r in flat.orderBy("n").collect()] == [[2, 0, 1, 1, 0], [4, 1, 0, 0, 1], [6, 0, 0, 1, 0]]
    assert [list(r[0]) for r in model.transform(df).orderBy("n").select(vector_to_array("features")).collect()] == [r["features"] for r in flat.orderBy("n").collect()]
    assert learning.feature_names(flat) == ["n", "c_a", "c_b", "d_x", "d_y"]
    assert learning.feature_names(learning.encoder(df, [], ["d"], drop_first=True).transform(df)) == ["d_y"]
    for bad, first in ((df.withColumn("n", F.lit(None).cast("double")), False), (df.withColumn("d", F.lit("z")), True), (df, True)):
        with pytest.raises(Exception):
            learning.encoder(df, ["n"], ["c", "d"], first).transform(bad).collect()


def test_delay_frames_read_the_split_rows(inputs):
    from assetboard.plans import learning as plans

    for df in plans.delay_frames(inputs):
        assert df.inputFiles() and all("/delay-" in f for f in df.inputFiles())


def test_logistic_solves_the_penalised_sum(rows):
    data = learning.with_class_weights(rows.where("z is not null"), "y")
    encoded = learning.encoder(data, ["x", "z"], []).transform(data)
    model = learning.fit_logistic(encoded, "y", "class_weight")
    pdf = encoded.select(vector_to_array("features").alias("f"), "y", "class_weight").toPandas()
    X = np.c_[np.array(pdf["f"].tolist()), np.ones(len(pdf))]
    y, s, w = pdf["y"].values, pdf["class_weight"].values, np.zeros(3)
    penalty = np.diag([1.0, 1.0, 0.0])
    for _ in range(50):  # Newton on 1/2 |w|^2 + sum of weighted losses
        p = 1 / (1 + np.exp(-X @ w))
        w -= np.linalg.solve(penalty + (X * (s * p * (1 - p))[:, None]).T @ X, penalty @ w + X.T @ (s * (p - y)))
    assert np.allclose([*model.coefficients, model.intercept], w, atol=1e-4)
    names = learning.feature_names(encoded)
    assert names == ["x", "z"]
    table = learning.weights_table(model, names, rows.sparkSession).collect()
    assert {r["processed_input"] for r in table} == {"x", "z", "__INTERCEPT__"}
    assert [abs(r["weight"]) for r in table] == sorted((abs(r["weight"]) for r in table), reverse=True)


def test_network_slopes_are_differences():
    rng = np.random.default_rng(2)
    x, y, w = rng.normal(size=(20, 4)), rng.integers(0, 2, 20).astype(float), rng.uniform(0.5, 2, 20)
    net = network.Network.start(4, (5, 3), 1)
    masks = [(network.uniform(np.arange(20), n, 3) >= 0.2) / 0.8 for n in (5, 3)]

    def loss(layers):
        seen = x
        for (a, b), mask in zip(layers[:-1], masks):
            seen = np.maximum(seen @ a + b, 0) * mask
        p = 1 / (1 + np.exp(-(seen @ layers[-1][0] + layers[-1][1])[:, 0]))
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    for k, pair in enumerate(net.gradients(x, y, w, masks)):
        for part, slope in enumerate(pair):
            at = tuple(rng.integers(0, s) for s in slope.shape)
            moved = []
            for by in (1e-6, -1e-6):
                layers = [tuple(p.copy() for p in layer) for layer in net.layers]
                layers[k][part][at] += by
                moved.append(loss(layers))
            assert np.isclose((moved[0] - moved[1]) / 2e-6, slope[at], atol=1e-4)


def test_mini_batches_are_dealt_once_an_epoch(spark):
    # F16: every mini-batch read all rows to find its own.
    rows = spark.range(5000).select(F.array(F.col("id") / 7, (F.col("id") % 2).cast("double")).alias("x"), (F.col("id") % 3 == 0).cast("double").alias("y"),
                                    F.lit(0.3).alias("w"), F.xxhash64("id").alias("h"), "id").repartition(3)
    blocks = network.blocks_of(rows.drop("id"))
    want = {r["h"]: [*r["x"], r["y"], r["w"]] for r in rows.collect()}
    seen = {}
    for place in network.dealt(blocks, 11, 8).withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.collect_list(F.struct("step", "block")).alias("l")).collect():
        assert [r["step"] for r in place["l"]] == sorted(r["step"] for r in place["l"])
        for r in place["l"]:
            table, h = network.unpacked(r["block"])
            assert ((network.uniform(h, 1, 11)[:, 0] * 8).astype(int) == r["step"]).all()
            assert not set(h.tolist()) & set(seen)
            seen.update(zip(h.tolist(), table.tolist()))
    assert seen == want


def test_network_learns_what_no_plane_parts(spark):
    rng = np.random.default_rng(5)
    data = [(i, float(a), float(b), int((a > 0) != (b > 0)), 1.0 + (i % 2)) for i, (a, b) in enumerate(rng.normal(size=(3000, 2)))]
    df = spark.createDataFrame(data, "id long, a double, b double, y int, w double")
    encoded = learning.encoder(df, ["a", "b"], []).transform(df)
    train, validation = encoded.where("id < 2400"), encoded.where("id >= 2400")
    args = (train, validation, "y", ["id"], "w")
    model, auc = network.fit_network(*args, rate=0.01, epochs=3, steps=20, seed=4)
    again, same = network.fit_network(train.repartition(3), *args[1:], rate=0.01, epochs=3, steps=20, seed=4)
    assert auc > 0.9 and abs(auc - same) < 1e-6
    scored = model.score(validation).toPandas()
    assert "features" not in scored and scored["score"].between(0, 1).all() and len(scored) == 600
    assert network.fit_network(train.where("false"), *args[1:]) == (None, 0.0)


def test_board_fit_predict_save_load(rows, tmp_path):
    fit = learning.fit_boards(rows, [], "value", None, ["x", "z"], ["c"], ["id"], SMALL)
    scored = fit.predict(rows).orderBy("id").toPandas()
    rookies = scored["career_games"].isna()
    assert (scored["is_rookie"] == rookies).all()
    assert np.allclose(scored["model_value"], np.where(rookies, scored["quantile_prediction"], scored["mean_prediction"]))
    assert np.corrcoef(np.log(scored["mean_prediction"]), np.log(scored["value"]))[0, 1] > 0.7
    fit.save(str(tmp_path / "fit"), rows.sparkSession)
    again = learning.BoardFits.load(str(tmp_path / "fit"), rows.sparkSession).predict(rows).orderBy("id").toPandas()
    assert np.allclose(scored["model_value"], again["model_value"])


def test_out_of_fold_covers_each_row_once(rows):
    args = (["c"], "value", None, ["x", "z"], ["c"], ["id"], SMALL)
    for got in (learning.out_of_fold(rows, *args, k=2).toPandas(), learning.fit_forests(rows, *args, k=2, out="oof_prediction").toPandas()):
        assert len(got) == got["id"].nunique() == 400 and got["oof_prediction"].notna().all()
    assert learning.out_of_fold(rows.limit(1), *args, k=2).count() == 0


def test_group_split(rows):
    args = ("c", "a", "value", None, ["x", "z"], ["c"], ["id"], SMALL)
    fits, got = learning.fit_groups(rows, [], *args)
    assert got.count() == 400 and {(r["c"] == "a", r["fit_group"]) for r in got.select("c", "fit_group").distinct().collect()} == {(True, "a"), (False, "rest")}
    assert fits.models.boards == [("a",), ("rest",)]
    found = learning.group_metrics(rows, [], *args, k=2).toPandas().set_index("fit_group")
    assert set(found.index) == {"a", "rest", "pooled"} and found["mae"].notna().all()
    assert found["mae"].min() <= found.loc["pooled", "mae"] <= found["mae"].max()


def test_group_split_is_validated_out_of_fold(rows):
    """Boosted models and forests of each group predict rows that they have not seen; a group of one row has no folds."""
    one = rows.unionByName(rows.limit(1).withColumns({"id": F.lit(9999).cast(rows.schema["id"].dataType), "c": F.lit("alone")}))
    args = ("value", None, ["x", "z"], ["c"], ["id"], SMALL)
    got = learning.fit_groups(one, [], "c", "alone", *args, k=2)[1].toPandas().set_index("id")
    assert len(got) == 401 and got.loc[9999, ["oof_prediction", "forest_prediction"]].isna().all()
    rest = got.drop(index=9999)
    for model in ("oof_prediction", "forest_prediction"):
        assert rest[model].notna().all() and 0.3 < np.corrcoef(np.log(rest[model]), np.log(rest["value"]))[0, 1]
    assert not np.allclose(rest["oof_prediction"], rest["model_value"]) and not np.allclose(rest["oof_prediction"], rest["forest_prediction"])
    again = learning.out_of_fold(learning.with_group(rows, "c", "alone"), ["fit_group"], *args, k=2).toPandas().set_index("id")
    assert np.allclose(again["oof_prediction"].sort_index(), rest["oof_prediction"].sort_index())


def test_constant_features_of_a_group_are_not_read(rows):
    """Whether a value is missing tells much here, but the group knows one value of it only."""
    told = rows.withColumn("told", F.when(F.col("value") > 100, 7.0)).withColumn("group", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    told = told.withColumn("told", F.when(F.col("group") == "odd", F.coalesce("told", F.lit(3.0))).otherwise(F.col("told")))
    fits, got = learning.fit_groups(told, [], "group", "even", "value", None, ["x", "told"], ["c"], ["id"], SMALL, k=2)
    read = {b: {int(f) for t in fits.models.trees for f in t.feature[2 * i]} for i, (b,) in enumerate(fits.models.boards)}
    assert 1 not in read["even"] and 1 in read["rest"] and got.count() == told.count()


def test_registered_fits_are_full_ones():
    from assetboard.plans import learning as plans

    asked, full = plans.QUERY_SETTINGS, (100, 300)
    assert asked == learning.TreeSettings() and (asked.iterations, asked.trees) == full
    assert learning.FOLDS == 10
