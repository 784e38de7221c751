"""Repeated second prices, and back-tests over every season."""

from assetboard.operators import consensus, refresh


def test_every_pair_of_second_prices_gets_a_row(spark):
    a = spark.createDataFrame([("x", k, float(10 * k)) for k in (1, 2, 3)], "board string, id long, va double")
    b = spark.createDataFrame([("x", 1, 5.0), ("x", 1, 9.0), ("x", 2, 7.0), ("x", None, 1.0), ("x", None, 2.0)], "board string, id long, vb double")
    rows = consensus.blend_consensus(a, b, ["board"], ["board"], "id", "va", "vb").collect()
    got = sorted((r["id"], None if r["pct_b"] is None else round(r["pct_b"], 6), round(r["blended"], 6)) for r in rows)
    own = {k: k / 3 for k in (1, 2, 3)}
    mix = lambda k, p: round(0.35 * p + 0.65 * own[k], 6)
    assert got == sorted([(1, p, mix(1, q)) for p in (0.6, 1.0) for q in (0.6, 1.0)] + [(2, 0.8, mix(2, 0.8)), (3, None, mix(3, 1.0))], key=repr)


def test_backtest_reports_every_pool_of_an_asset(spark):
    pool = spark.createDataFrame([(1, 4.0, 5.0, ["every", "full"]), (2, 3.0, 6.0, ["every"])], "id long, prior_ppg double, true_ppg double, pools array<string>")
    weeks = spark.createDataFrame([(1, w, 5) for w in range(1, 11)] + [(2, 1, 6)], "id long, week int, points long")
    got = {(r["pool"], r["through_week"]): r for r in refresh.blend_backtest(pool, weeks, "id", "week", "points", (1, 8), pools="pools").collect()}
    assert {k: r["n_assets"] for k, r in got.items()} == {("every", 1): 2, ("every", 8): 2, ("full", 1): 1, ("full", 8): 1}
    assert got["full", 8]["max_weight"] == 8 / 13 and got["every", 8]["mae_prior"] == 2.0
