"""Scalar expressions against hand-written answers."""

import math

import pytest
from pyspark.sql import functions as F

from assetboard.functions import numeric, text


def one(spark, values, schema, column):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(column).collect()]


def test_normalize_name(spark):
    cases = {
        "Kenny Gainwell": "kenneth gainwell", "Odell Beckham Jr.": "odell beckham", "  A.J.   Brown ": "aj brown",
        "Ja'Marr Chase": "jamarr chase", "Will Fuller V": "william fuller", "Jr Mike": "michael", "Jr.": "", "": "",
        None: "", "Mike": "michael", "Amon-Ra St. Brown": "amonra st brown", "X Y": "x y", "mike mike": "michael mike",
    }
    got = one(spark, list(cases), "v string", text.normalize_name(F.col("v")))
    assert got == list(cases.values())


def test_lenient_number_and_ids(spark):
    raw = ["12", " 7 ", "1.5", "NaN", "x", "", None, "9221.0", "1e3"]
    assert one(spark, raw, "v string", text.lenient_number(F.col("v"))) == [12.0, 7.0, 1.5, None, None, None, None, 9221.0, 1000.0]
    assert one(spark, raw, "v string", text.lenient_number(F.col("v"), "bigint")) == [12, 7, 1, None, None, None, None, 9221, 1000]
    assert one(spark, raw, "v string", text.normalize_id(F.col("v"))) == ["12", "7", "1", "NaN", "x", "", None, "9221", "1000"]


def test_player_id_format(spark):
    raw = ["00-0041562", "MEN516487", "00-004156", "x00-0041562", None]
    assert one(spark, raw, "v string", text.has_player_id_format(F.col("v"))) == [True, False, False, False, None]


def test_pick_names(spark):
    raw = ["2027 1st (Early)", "2028 2nd", "2026 Pick 1.01", "2027 Early 1st", "Bijan Robinson", "2027 1st (early)", "2027 4th (Late)"]
    a = one(spark, raw, "v string", text.parse_pick_name(F.col("v"), "round_first"))
    assert [tuple(x) if x else None for x in a] == [
        (2027, 1, "Early", "tier"), (2028, 2, None, "aggregate"), (2026, None, None, "slot"), None, None, None, (2027, 4, "Late", "tier")]
    b = one(spark, raw, "v string", text.parse_pick_name(F.col("v"), "tier_first"))
    assert [tuple(x) if x else None for x in b] == [None, None, None, (2027, 1, "Early", "tier"), None, None, None]
    with pytest.raises(ValueError):
        text.parse_pick_name(F.col("v"), "other")


def test_labels(spark):
    row = spark.range(1).select(
        text.pick_asset_id(F.lit("redraft"), F.lit(10), F.lit(2027), F.lit(1), F.lit("Mid")),
        text.pick_title(F.lit(2027), F.lit(1), F.lit("Mid")),
        text.asset_label(F.lit("pick"), F.lit("n"), F.lit("PICK"), F.lit(None)),
        text.asset_label(F.lit("player"), F.lit("n"), F.lit("WR"), F.lit("")),
        text.display_value(F.lit(12345.6)), text.display_value(F.lit(None).cast("double")),
    ).first()
    assert tuple(row) == ("PICK-redraft-10-2027-1-Mid", "2027 Round 1 (Mid)", "n (pick)", "n (WR, FA)", "12,346", "--")


def test_nearest_size(spark):
    got = one(spark, [10, 12, 11, 8, 14, None], "v int", numeric.nearest_size(F.col("v"), (10, 12)))
    assert [tuple(x) if x else None for x in got] == [(10, False), (12, False), (10, True), (10, True), (12, True), None]


def test_ratio_clip_weight(spark):
    df = spark.createDataFrame([(1.0, 0.0), (6.0, 3.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(numeric.safe_ratio(F.col("a"), F.col("b"))).collect()] == [None, 2.0, None]
    assert one(spark, [-1.0, 0.5, 2.0, None], "v double", numeric.clip(F.col("v"))) == [0.0, 0.5, 1.0, None]
    assert one(spark, [None, 2, 3, 5], "v int", numeric.shrink_weight(F.col("v"))) == [0.0, 0.0, 3 / 8, 0.5]


def test_speed_score_and_dominator(spark):
    df = spark.createDataFrame([("RB", 220.0, 4.5), ("WR", 220.0, 4.5), ("RB", None, 4.5), ("RB", 220.0, 0.0)], "p string, w double, f double")
    got = [r[0] for r in df.select(numeric.speed_score(F.col("p"), F.col("w"), F.col("f"))).collect()]
    assert math.isclose(got[0], 220 * 200 / 4.5 ** 4) and got[1:] == [None, None, None]
    df = spark.createDataFrame([(100, 400, 2, 10), (100, 0, 2, 10), (100, 400, 2, None)], "y int, ty int, t int, tt int")
    got = [r[0] for r in df.select(numeric.dominator(*[F.col(c) for c in ("y", "ty", "t", "tt")])).collect()]
    assert math.isclose(got[0], 0.24) and got[1:] == [None, None]
