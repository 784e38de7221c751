"""Readers, sinks and streams."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assetboard.operators import marts
from assetboard.session import shared_dir
from assetboard.sources import readers, sinks
from assetboard.streaming import weather


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_page_without_array_fails(spark):
    pages = spark.createDataFrame([("<script>var other = [1];</script>",)], "html string")
    with pytest.raises(PySparkException, match="playersArray not found"):
        readers.ranking_rows(pages, "html").collect()


def test_page_array_over_lines_and_position_filter(spark):
    html = 'x playersArray =\n [{"playerName":"A","position":"WR","playerID":1,"oneQBValues":{"value":5},"superflexValues":{"value":6}},\n{"playerName":"K","position":"K","playerID":2}];'
    pages = spark.createDataFrame([(html,)], "html string")
    assert readers.ranking_rows(pages, "html").count() == 2
    rows = readers.ranking_rows(pages, "html", positions=("QB", "RB", "WR", "TE")).collect()
    assert [(r["name"], r["oneqb_value"], r["sf_value"]) for r in rows] == [("A", 5.0, 6.0)]


def test_price_payload_optional_members(spark):
    doc = '[{"player":{"name":"A","position":"WR","mflId":"12"},"value":7},{"player":{"name":"B","position":"PICK","mflId":"x","espnId":5},"value":1,"overallRank":3}]'
    rows = readers.price_rows(spark.createDataFrame([(doc,)], "p string"), "p").collect()
    assert [(r["mfl_id"], r["espn_id"], r["overall_rank"]) for r in rows] == [(12, None, None), (None, 5, 3)]


def test_board_sink_nulls_and_absent_board(spark, tmp_path):
    board = spark.createDataFrame([("f", 10, "a", float("nan"), None), ("g", 12, "b", 1.5, "T")], "format string, team_size int, asset_id string, v double, team string")
    path = str(tmp_path / "boards")
    sinks.write_boards(board, path)
    text = "".join(r["value"] for r in spark.read.text(path + "/format=f/team_size=10").collect())
    assert text == '{"asset_id":"a","v":null,"team":null}'
    schema = StructType([board.schema[c] for c in ("asset_id", "v", "team", "format", "team_size")])
    assert readers.read_board(spark, path, schema).count() == 2
    assert readers.read_board(spark, str(tmp_path / "none"), schema).count() == 0


def test_snapshot_rerun_replaces_its_date_only(spark, tmp_path):
    board = spark.createDataFrame([("f", 10, "a", 1.0)], "format string, team_size int, asset_id string, v double")
    path = str(tmp_path / "snap")
    for day in ("2026-01-01", "2026-01-02", "2026-01-02"):
        sinks.write_snapshot(board, path, day)
    got = spark.read.csv(path, header=True)
    assert sorted(str(r["snapshot_date"]) for r in got.collect()) == ["2026-01-01", "2026-01-02"]


def test_mart_is_pruned_by_date(spark, inputs, tmp_path):
    mart = sinks.partitioned_mart(marts.curated_members(inputs["members"]), str(tmp_path / "mart"), ["last_visit_date"])
    day = mart.where(F.col("last_visit_date") == dt.date(2024, 1, 9))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(last_visit_date" in plan
    assert day.count() == inputs["members"].where("last_visit_date = date '2024-01-09'").count() > 0


def test_unknown_churn_counts_as_stayed(spark):
    raw = spark.createDataFrame([(1, None), (2, True), (3, False)], "member_id int, churn boolean").withColumn(
        "join_date", F.lit("2024-01-01").cast("date")).withColumn("last_visit_date", F.lit("2024-01-31").cast("date"))
    assert [(r["churn_label"], r["tenure_days"]) for r in marts.curated_members(raw).orderBy("member_id").collect()] == [(0, 30), (1, 30), (0, 30)]


def test_day_hours_are_inclusive(spark):
    hours = spark.range(24).select(F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.col("id").cast("int"), F.lit(0), F.lit(0)).alias("ts"))
    assert hours.where(marts.is_day(F.col("ts"))).count() == 13


def readings(spark, start, n):
    return spark.range(start, start + n).select(
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int))").alias("event_timestamp"),
        F.col("id").cast("double").alias("temperature_c"), F.lit(1.0).alias("wind_speed_kph"), F.lit(2.0).alias("relative_humidity"),
        (F.col("id") % 2 == 0).alias("is_day"))


def test_ingest_restarts_without_duplicates_and_late_days_count(spark, tmp_path):
    source, table, check = (str(tmp_path / x) for x in ("source", "table", "check"))
    readings(spark, 100, 50).write.mode("append").parquet(source)
    stream = lambda: weather.read_files(spark, source, weather.READING, files_per_batch=1)
    weather.ingest(stream(), table, check)
    weather.ingest(stream(), table, check)
    assert spark.read.parquet(table).count() == 50
    readings(spark, 0, 100).write.mode("append").parquet(source)  # an earlier day arrives late
    weather.ingest(stream(), table, check)
    landed = spark.read.parquet(table)
    assert landed.count() == 150
    daily = weather.run_daily(stream(), str(tmp_path / "daily-table"), str(tmp_path / "daily"))
    want = marts.weather_daily(landed)
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, want.collect())) and daily.count() == 7


def test_no_python_functions_in_plans(spark):
    from assetboard import plans
    from conftest import FOLDER

    queries = plans.queries()
    for name in ("consensus_board", "normalize_name", "feature_table", "divergence", "parse_pick_name", "eb_blend"):
        plan = queries[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas")), name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_ranking_a_board_needs_no_window_over_the_board(spark):
    from assetboard import plans
    from conftest import FOLDER

    queries = plans.queries()
    for name in ("board_rank", "consensus_board", "exact_sample"):
        plan = queries[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert all("_slice" in line for line in windows), name
        assert "BroadcastHashJoin" in plan, name
