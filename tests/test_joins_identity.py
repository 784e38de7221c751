"""Lookups, resolution order, repair and coverage on small cases."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from assetboard.operators import identity
from assetboard.operators.joins import keep_unmatched, lookup_join, safe_left_join


def test_lookup_join_keeps_null_and_missing_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "rk int, w string")
    got = {(r["k"], r["v"], r["w"]) for r in lookup_join(left, right, {"k": "rk"}).collect()}
    assert got == {(1, "a", "x"), (None, "b", None), (3, "c", None), (None, "d", None)}


def test_null_keys_are_spread_in_the_shuffle(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), "id")
        right = spark.range(0, 4000, 6).select(F.col("id").alias("rk"), F.lit(1).alias("hit"))
        joined = lookup_join(left, right, {"k": "rk"})
        assert joined.count() == 4000 and joined.where("hit = 1").count() == 667
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_salt" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_safe_left_join_rejects_repeated_keys(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    ok = spark.createDataFrame([(1, "x")], "k int, w string")
    assert {tuple(r) for r in safe_left_join(left, ok, ["k"]).collect()} == {(1, "x"), (2, None)}
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    with pytest.raises(PySparkException, match="repeated key"):
        safe_left_join(left, twice, ["k"]).collect()


def test_resolution_fills_column_by_column(spark):
    table = spark.createDataFrame(
        [(1, 101, None, "ann lee"), (2, None, 202, "bob ray"), (3, 103, 203, "cy dee"), (9, 103, 209, "dup dee")],
        "mfl int, espn int, ktc int, merge_name string")
    source = spark.createDataFrame(
        [("primary wins", 1, 103, "bob ray"), ("second key", 7, 103, "x"), ("name only", None, None, "bob ray"), ("nothing", None, 1, "")],
        "case string, s_mfl int, s_espn int, s_name string")
    paths = [identity.Path("s_mfl", "mfl", "primary"), identity.Path("s_espn", "espn", "secondary"), identity.Path("s_name", "merge_name", "name")]
    got = {r["case"]: (r["mfl"], r["espn"], r["ktc"], r["match_tier"])
           for r in identity.resolve(source, table, paths, ["mfl", "espn", "ktc"], "mfl", [F.asc("mfl")]).collect()}
    # Row 1 has no ktc of its own and takes it from the second match; espn 103 is kept for mfl 3 (first).
    assert got["primary wins"] == (1, 101, 203, "primary")
    assert got["second key"] == (3, 103, 203, "secondary")
    assert got["name only"] == (2, None, 202, "name")
    assert got["nothing"] == (None, None, None, "unmatched")


def test_empty_names_do_join(spark):
    base = spark.createDataFrame([(7, "Jr.")], "player_id int, name string")
    rows = spark.createDataFrame([(1, None), (2, "II"), (3, "Ann")], "player_id int, name string")
    got = {r["name"]: r["player_id"] for r in identity.bridge_ids(rows, base, "player_id", "name", "player_id", "name", [F.asc("player_id")]).collect()}
    assert got == {None: 7, "II": 7, "Ann": 3}


def test_repair_is_scoped(spark):
    table = spark.createDataFrame([(1, "00-0000001", "Ann Lee"), (2, None, "Bob Ray")], "mfl int, gsis string, name string")
    draft = spark.createDataFrame(
        [("LEE1", "Ann Lee Jr.", 2026), ("LEE2", "Ann Lee", 2020), ("RAY1", "Bob Ray", 2026), ("00-0000009", "Ann Lee", 2026)],
        "gsis string, who string, year int")
    got = {(r["who"], r["year"], r["repair"]): r["gsis"] for r in
           identity.repair_ids(draft, table, "gsis", "who", "year", 2026, "gsis", "name", [F.asc("mfl")]).collect()}
    assert got == {("Ann Lee Jr.", 2026, "repaired"): "00-0000001", ("Ann Lee", 2020, "kept"): "LEE2",
                   ("Bob Ray", 2026, "unresolved"): "RAY1", ("Ann Lee", 2026, "kept"): "00-0000009"}


def test_coverage_counts_primary_ids_only(spark):
    source = spark.createDataFrame([("b", 1, 10.0), ("b", 2, 9.0), ("b", None, 8.0), ("b", 99, 1.0)], "board string, s int, v double")
    table = spark.createDataFrame([(1,), (2,), (None,)], "m int")
    row = identity.topn_coverage(source, table, ["board"], "s", "m", [F.desc("v")], n=3).first()
    assert (row["n_top"], row["matched"], row["passed"]) == (3, 2, False)


def test_keep_unmatched_keeps_null_keys(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "a int")
    ids = spark.createDataFrame([(1,), (None,)], "b int")
    assert {r["a"] for r in keep_unmatched(df, ids, {"a": "b"}).collect()} == {None, 2}
