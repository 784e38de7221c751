"""The weekly run from source-shaped tables to published boards, and its in-season refresh."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetboard.operators import features, learning, refresh, weekly
from test_pricing_boards import pick_lists

PRODUCED = [c for c in features.PRODUCTION_COLUMNS if c not in ("ppg_ppr", "snap_share")]
PEOPLE = 90
ROOKIES = range(80, 90)


def sources(spark):
    ids = spark.range(1, PEOPLE + 1).select(F.col("id").alias("i"), F.element_at(F.array(*map(F.lit, features.POSITIONS)), (F.col("id") % 4 + 1).cast("int")).alias("position"))
    gsis = F.format_string("00-%07d", "i")
    name = F.concat(F.lit("Man "), F.conv(F.col("i").cast("string"), 10, 16))
    crosswalk = ids.select(
        F.col("i").cast("string").alias("mfl_id"), F.concat((F.col("i") + 1000).cast("string"), F.lit(".0")).alias("espn_id"),
        (F.col("i") + 2000).cast("string").alias("ktc_id"), gsis.alias("gsis_id"), F.concat(F.lit("P"), "i").alias("pfr_id"),
        F.concat(F.col("i").cast("string"), F.lit(".0")).alias("sleeper_id"), name.alias("name"), "position", F.lit("T").alias("team"))
    boards = spark.createDataFrame([(f, n) for f in weekly.FORMATS for n in (10, 12)], "format string, team_size int")
    worth = F.col("i") * F.col("i") + F.col("team_size")
    players = ids.join(boards).select("format", "team_size", F.concat(name, F.lit(" Jr.")).alias("name"), "position", F.col("i").alias("mfl_id"),
                                      (F.col("i") + 1000).alias("espn_id"), worth.cast("double").alias("value"))
    list_a, list_b = pick_lists(spark)
    prices = players.unionByName(list_a.withColumn("position", F.lit("PICK")), allowMissingColumns=True)
    page = lambda shift: ids.select(name.alias("name"), "position", (F.col("i") + shift).alias("player_id"),
                                    (F.col("i") * 3).cast("double").alias("oneqb_value"), (F.col("i") * 5).cast("double").alias("sf_value"))
    dynasty = page(2000).unionByName(list_b.withColumn("position", F.lit("RDP")).withColumn("player_id", F.lit(-1).cast("bigint")))
    seasons = ids.where(~F.col("i").isin(*ROOKIES)).select("i", "position", F.explode(F.array(F.lit(2023), F.lit(2024), F.lit(2025))).alias("season"))
    stats = seasons.select(gsis.alias("player_id"), "position", "season", *[
        (F.lit(16) if c == "games" else F.pmod(F.hash("i", "season", F.lit(c)), F.lit(50)) + F.col("i")).cast("double").alias(c) for c in PRODUCED])
    snaps = seasons.select(F.concat(F.lit("P"), "i").alias("pfr_player_id"), "season", "position", (F.col("i") / 100).alias("offense_pct"))
    rookie = F.col("i").isin(*ROOKIES)
    draft = ids.select(F.when(rookie, F.concat(F.lit("NEW"), "i")).otherwise(gsis).alias("gsis_id"), F.when(rookie, 2026).otherwise(2015 + F.col("i") % 8).cast("int").alias("season"),
                       (F.col("i") % 7 + 1).cast("int").alias("round"), F.col("i").cast("int").alias("pick"), (F.col("i") % 3 + 21).cast("int").alias("age"), "position", name.alias("pfr_player_name"))
    combine = ids.select(F.when(F.col("i") % 2 == 0, F.concat(F.lit("P"), "i")).alias("pfr_id"), name.alias("player_name"), F.col("position").alias("pos"),
                         F.lit(2020).alias("draft_year"), (F.col("i") / 100 + 4).alias("forty"), (F.col("i") + 180.0).alias("wt"), F.lit(72.0).alias("ht"))
    college = ids.where(rookie).select(gsis.alias("gsis_id"), F.lit("U").alias("team"), F.lit(2025).alias("year"), (F.col("i") * 4).alias("yards"), F.lit(3).alias("scores"))
    teams = spark.createDataFrame([("U", 2025, 1000, 20)], "team string, year int, team_yards int, team_scores int")
    return weekly.Sources(crosswalk, prices, dynasty, page(7000), stats, snaps, draft, combine, college, teams)


def test_weekly_run_publish_and_refresh(spark, tmp_path):
    s = sources(spark)
    run = weekly.weekly_run(s, 2026, learning.TreeSettings(iterations=2, depth=2, trees=3), folds=2)
    assert run.features.count() == PEOPLE and run.features.where("career_games is null").count() == len(ROOKIES)
    assert run.features.where("dominator_rating is not null").count() == len([i for i in ROOKIES if i % 4 != 0])  # no passers
    sizes = {(r["format"], r["team_size"]): r["count"] for r in run.board.groupBy("format", "team_size").count().collect()}
    assert sizes == {(f, n): PEOPLE + (0 if f == "redraft" else 27) for f in weekly.FORMATS for n in (10, 12)}
    assert run.board.where("name is null or model_value is null or consensus_value is null").isEmpty()
    # Both lists order the players alike, so the blend leaves the first list's values where they were.
    top = run.targets.where("format = 'sf_dynasty' and team_size = 12").orderBy(F.desc("consensus_value")).first()
    assert top["gsis_id"] == "00-0000090" and np.isclose(top["consensus_value"], 90 * 90 + 12)
    assert run.report.where("not passed").isEmpty() and run.report.count() > 10
    found = run.metrics.toPandas()
    assert len(found) == 12 and found.mae.notna().all() and set(found.model) == {"boosted", "forest"}
    index, metadata = weekly.publish(run, str(tmp_path / "boards"), 2026)
    row = metadata.first()
    assert index.count() == PEOPLE + 27 and (row["player_count"], row["pick_count"], len(row["formats"])) == (PEOPLE, 27, 6)
    assert index.where("asset_type = 'player' and sleeper_id is null").isEmpty()
    assert row["generated_at"].endswith("+00:00") and spark.read.json(str(tmp_path / "boards" / "boards")).count() == run.board.count()

    names = run.crosswalk.select("gsis_id", "name")
    again = refresh.recompute_board(run.features, None, run.fits, run.targets, names, run.picks, "gsis_id")
    same = again.join(run.board.select("format", "team_size", "asset_id", F.col("model_value").alias("was")), ["format", "team_size", "asset_id"])
    assert same.count() == run.board.count() and same.where("model_value <> was").isEmpty()
    weeks = s.season_stats.where("season = 2025").select(F.col("player_id").alias("gsis_id"), F.explode(F.sequence(F.lit(1), F.lit(6))).alias("week"),
                                                         *features.SUMMED_COLUMNS, *features.AVERAGED_COLUMNS)
    partial = features.season_to_date(weeks, "gsis_id", "week", 6)
    updated = refresh.recompute_board(run.features, partial, run.fits, run.targets, names, run.picks, "gsis_id", snapshot=(str(tmp_path / "snap"), "2026-10-20"))
    assert updated.count() == run.board.count()
    assert spark.read.csv(str(tmp_path / "snap"), header=True).count() == run.board.count()


def test_gates_stop_a_run(spark):
    s = sources(spark)
    small = learning.TreeSettings(iterations=1, depth=1, trees=1)
    twice = s.crosswalk.unionByName(s.crosswalk.where("mfl_id = '3'").withColumn("name", F.lit("Other")))
    with pytest.raises(ValueError, match="unique"):
        weekly.weekly_run(replace(s, crosswalk=twice), 2026, small, folds=0)
    lost = s.prices.withColumn("mfl_id", F.when(F.col("mfl_id") % 10 == 0, F.lit(None)).otherwise(F.col("mfl_id")))
    with pytest.raises(ValueError, match="coverage"):
        weekly.weekly_run(replace(s, prices=lost), 2026, small, folds=0)
