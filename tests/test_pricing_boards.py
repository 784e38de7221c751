"""Consensus, picks, boards, leagues and refresh on small cases."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assetboard.operators import boards, consensus, features, league, picks, refresh


def test_blend_equals_pandas(spark):
    rng = np.random.default_rng(2)
    a = pd.DataFrame({"f": ["x"] * 300, "s": [10] * 200 + [12] * 100, "id": list(range(200)) + list(range(100)), "v": rng.integers(1, 60, 300).astype(float)})
    b = pd.DataFrame({"f": ["x"] * 120, "id": range(120), "vb": rng.integers(1, 30, 120).astype(float)})
    got = consensus.blend_consensus(spark.createDataFrame(a), spark.createDataFrame(b), ["f", "s"], ["f"], "id", "v", "vb").toPandas()
    b["pb"] = b["vb"].rank(pct=True)
    for size, pool in a.groupby("s"):
        want = pool.assign(pa=pool["v"].rank(pct=True)).merge(b[["id", "pb"]], on="id", how="left")
        blend = 0.35 * want["pb"].fillna(want["pa"]) + 0.65 * want["pa"]
        want["c"] = np.quantile(pool["v"], blend.clip(0, 1))
        both = want.merge(got[got["s"] == size], on="id")
        assert len(both) == len(pool) and np.allclose(both["c"], both["consensus_value"])


def test_single_asset_board(spark):
    a = spark.createDataFrame([("x", 1, 7.0)], "f string, id int, v double")
    b = spark.createDataFrame([], "f string, id int, vb double")
    row = consensus.blend_consensus(a, b, ["f"], ["f"], "id", "v", "vb").first()
    assert row["consensus_value"] == 7.0 and row["pct_b"] is None


def pick_lists(spark, skip=()):
    rows = []
    for fmt, m in (("sf_dynasty", 1.2), ("oneqb_dynasty", 1.0), ("redraft", 1.0)):
        for size in (10, 12):
            for y in (2026, 2027, 2028, 2029):
                for r, w in ((1, "1st"), (2, "2nd"), (3, "3rd"), (4, "4th")):
                    base = (1000.0 * (5 - r) + 10 * (y - 2027) + size) * m
                    if (y, r) not in skip:
                        rows.append((fmt, size, f"{y} {w}", base))
                    if y == 2027:
                        rows += [(fmt, size, f"{y} {w} ({t})", base * k) for t, k in (("Early", 1.2), ("Mid", 1.0), ("Late", 0.8))]
            rows.append((fmt, size, "2026 Pick 1.01", 5.0))
    a = spark.createDataFrame(rows, "format string, team_size int, name string, value double")
    b = spark.createDataFrame([(f"{y} {t} {w}", 100.0, 200.0) for y in (2027, 2028) for t in picks.PICK_TIERS for w in ("1st", "2nd", "3rd", "4th")],
                              "name string, sf_value double, oneqb_value double")
    return a, b


def test_pick_universe_origins(spark):
    a, b = pick_lists(spark, skip={(2029, 3)})
    rows = {(r["format"], r["team_size"], r["year"], r["round"], r["tier"]): r for r in picks.pick_universe(a, b).collect()}
    assert len(rows) == 108
    native = rows[("sf_dynasty", 10, 2027, 1, "Early")]
    assert native["price_origin"] == "native" and np.isclose(native["first_value"], 4010 * 1.2 * 1.2)
    assert np.isclose(native["pick_value"], 0.65 * native["first_value"] + 0.35 * 100.0)
    derived = rows[("oneqb_dynasty", 12, 2028, 2, "Late")]
    assert derived["price_origin"] == "derived" and np.isclose(derived["first_value"], 3022 * 0.8)
    assert np.isclose(derived["pick_value"], 0.65 * 3022 * 0.8 + 0.35 * 200.0)
    built = rows[("sf_dynasty", 12, 2029, 3, "Mid")]
    assert built["price_origin"] == "constructed" and np.isclose(built["first_value"], 3000 * 0.5 * 1.2)
    assert built["pick_value"] == built["first_value"]


def test_ratios_and_multiplier(spark):
    a, b = pick_lists(spark)
    ratios = {(r["round"], r["tier"]): r["ratio"] for r in picks.tier_ratios(picks.native_picks(a, b)).collect()}
    assert len(ratios) == 9 and np.isclose(ratios[(2, "Late")], 0.8)
    overall = picks.format_multiplier(a).where("round is null").first()
    assert np.isclose(overall["multiplier"], 1.2) and overall["plausible"]
    assert picks.native_picks(a, b).where("kind = 'slot' or round > 3 or year < 2027").isEmpty()


BOARD = "format string, team_size int, asset_id string, name string, position string, asset_type string, model_value double, consensus_value double, college_seasons_found int"


def small_board(spark):
    rows = [("f", 10, f"{i:02d}", f"Name {i}", "WR" if i % 2 else "QB", "pick" if i == 9 else "player", float(i), 0.0 if i == 0 else 5.0,
             0 if i == 8 else None) for i in range(10)]
    return spark.createDataFrame(rows, BOARD)


def test_divergence_sides_repeat_in_small_pools(spark):
    d = boards.divergence(small_board(spark))
    # Ten rows less the pick and the row whose college lookup found nothing.
    assert d.where("side = 'above'").count() == 8 and d.where("side = 'below'").count() == 8
    assert d.where("asset_id = '00'").select("residual_pct").distinct().first()[0] == 0.0


def test_ranking_ties_and_view(spark):
    board = small_board(spark)
    tied = boards.ranked(board.withColumn("model_value", F.lit(1.0)))
    assert [r["asset_id"] for r in tied.orderBy("board_rank").collect()] == [f"{i:02d}" for i in range(10)]
    view = boards.rankings_view(boards.with_residuals(board), dynasty=False, by="residual", ascending=True)
    assert [r["asset_id"] for r in view.collect()] == ["01", "02", "03", "04", "00", "05", "06", "07"]
    assert boards.rankings_view(board, dynasty=True, asset_type="pick").count() == 1


def test_rule_panel(spark):
    board = spark.createDataFrame([("f", 12, "Kenneth Gainwell", 40), ("f", 12, "Bijan Robinson", 2), ("f", 12, "Josh Allen", 7)],
                                  "format string, team_size int, name string, board_rank int")
    rules = spark.createDataFrame([
        (1, "top_n", "f", 12, "Bijan Robinson", None, 5), (2, "top_n", "f", 12, "Josh Allen", None, 5),
        (3, "pairwise", "f", 12, "Bijan Robinson", "Kenny Gainwell", None), (4, "pairwise", "f", 12, "Bijan Robinson", "No One", None),
        (5, "top_n", "g", 12, "Bijan Robinson", None, 5)],
        "rule_id int, kind string, format string, team_size int, name string, other string, n int")
    panel = boards.rule_panel(rules, board)
    assert {r["rule_id"]: r["status"] for r in panel.collect()} == {1: "passed", 2: "failed", 3: "passed", 4: "skipped", 5: "skipped"}
    assert {r["rule_id"]: r["detail"] for r in panel.collect()} == {
        1: "rank=2 (need <= 5)", 2: "rank=7 (need <= 5)", 3: "rank=2 vs rank=40", 4: "No One not on board", 5: "Bijan Robinson not on board"}
    assert tuple(boards.rule_tally(panel).first()) == (2, 1, 2)


def test_trade_verdicts(spark):
    values = spark.createDataFrame([("a", 100.0), ("b", 96.0), ("c", 50.0)], "asset_id string, model_value double")
    trades = spark.createDataFrame([(1, "A", "a"), (1, "B", "b"), (2, "A", "c"), (2, "B", "a"), (3, "A", "a"), (4, "A", "zz"), (4, "B", "yy")],
                                   "trade_id int, side string, asset_id string")
    got = {r["trade_id"]: (r["verdict"], round(r["diff_pct"], 3)) for r in league.trade_verdict(trades, values).collect()}
    assert got == {1: ("even", 4.0), 2: ("B", 50.0), 3: ("A", 100.0), 4: ("none", 0.0)}


def test_pick_ownership_and_totals(spark):
    rosters = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "league_id int, roster_id int")
    traded = spark.createDataFrame([(1, 2027, 1, 1, 2), (1, 2027, 1, 3, 3)], "league_id int, year int, round int, original_roster int, new_owner int")
    owned = league.pick_ownership(rosters, traded, (2027,), (1, 2))
    assert owned.count() == 6
    assert {(r["original_roster"], r["owner"]) for r in owned.where("round = 1").collect()} == {(1, 2), (2, 2), (3, 3)}
    assets = spark.createDataFrame([(1, 1, 50.0), (1, 2, 10.0)], "league_id int, roster_id int, model_value double")
    prices = spark.createDataFrame([(2027, 1, 20.0)], "year int, round int, pick_price double")
    got = {r["roster_id"]: (r["total_value"], r["league_rank"]) for r in league.league_totals(assets, rosters, owned, prices).collect()}
    assert got == {1: (50.0, 1), 2: (50.0, 2), 3: (20.0, 3)}


def test_roster_names_fall_back(spark):
    rosters = spark.createDataFrame([(1, 1, 10, ["5.0", "7"]), (1, 2, 11, ["8"]), (1, 3, 12, ["9"])], "league_id int, roster_id int, owner_id int, players array<string>")
    users = spark.createDataFrame([(10, "disp", "Team"), (11, "disp2", None)], "user_id int, display_name string, team_name string")
    got = {(r["team_name"], r["sleeper_id"]) for r in league.roster_rows(rosters, users).collect()}
    assert got == {("Team", "5"), ("Team", "7"), ("disp2", "8"), ("Roster 3", "9")}


def test_shrinkage_rules(spark):
    feats = spark.createDataFrame([("g2", 10, 4.0, 1.0), ("g5", 10, 4.0, None), ("gone", 10, 4.0, 1.0), ("partial", 10, 4.0, 1.0)], "id string, games int, ppg double, epa double")
    now = spark.createDataFrame([("g2", 2, 9.0, 9.0), ("g5", 5, 8.0, 3.0), ("partial", 5, None, 3.0)], "id string, games int, ppg double, epa double")
    got = {r["id"]: (r["games"], r["ppg"], r["epa"]) for r in refresh.blend_in_season(feats, now, "id", ["games", "ppg", "epa"]).collect()}
    assert got == {"g2": (10, 4.0, 1.0), "g5": (5, 6.0, None), "gone": (10, 4.0, 1.0), "partial": (5, 4.0, 2.0)}
    used = refresh.blend_in_season(feats, now, "id", ["games", "ppg", "epa"], null_prior="use_sample")
    assert used.where("id = 'g5'").first()["epa"] == 3.0


def test_breakout_and_skipped_seasons(spark):
    draft = spark.createDataFrame([("p", 2026, 22, "WR"), ("q", 2026, 22, "QB"), ("n", 2026, 22, "RB")], "id string, draft_year int, age_at_draft int, position string")
    seasons = spark.createDataFrame([("p", "T", 2023, 100, 1), ("p", "T", 2024, 300, 5), ("p", "T", 2025, 900, 9), ("p", "T", 2026, 999, 9), ("q", "T", 2025, 900, 9)],
                                    "id string, team string, yr int, yards int, scores int")
    teams = spark.createDataFrame([("T", 2023, 2000, 20), ("T", 2024, 1000, 20), ("T", 2025, 0, 20), ("T", 2026, 1000, 9)], "team string, yr int, team_yards int, team_scores int")
    got = {r["id"]: r for r in features.college_production(seasons, teams, draft, "id", "team", "yr").collect()}
    assert np.isclose(got["p"]["dominator_rating"], 0.8 * 0.3 + 0.2 * 0.25) and got["p"]["breakout_age"] == 20 and got["p"]["college_seasons_found"] == 2
    assert got["q"]["college_seasons_found"] == 0 and got["n"]["dominator_rating"] is None


def test_snapshot_appends_rookies(spark):
    panel = spark.createDataFrame([("v", "WR", 2024, 10, 100), ("v", "WR", 2025, 5, 20), ("z", "WR", 2025, 0, 0)], "id string, position string, season int, games int, points int")
    draft = spark.createDataFrame([("v", "WR", 2020, 22), ("r", "RB", 2026, 21), ("old", "RB", 2019, 21)], "id string, position string, draft_year int, age_at_draft int")
    peaks = spark.createDataFrame([("WR", 26.0)], "position string, peak_age double")
    got = {r["id"]: r for r in features.player_snapshot(panel, draft, peaks, "id", "position", "season", "points", 2026).collect()}
    assert set(got) == {"v", "z", "r"}
    assert (got["v"]["season"], got["v"]["career_games"], got["v"]["career_ppg_ppr"], got["v"]["current_age"]) == (2025, 15, 8.0, 28)
    assert got["v"]["current_distance_from_peak_age"] == 2.0 and got["z"]["career_ppg_ppr"] is None
    assert got["r"]["career_games"] is None and got["r"]["current_age"] == 21 and got["r"]["current_distance_from_peak_age"] is None


def test_training_weights_read_their_input_once(spark):
    # training_frame resolved every price twice, each time with lookups sent through the driver.
    df = spark.range(40).select((F.col("id") % 2).alias("b"), (F.col("id") % 7).cast("double").alias("v"), "id")
    got = consensus.rank_power_weights(df, ["b"], "v")
    assert got.count() == 40 and got.agg(F.max("sample_weight")).first()[0] > 1
    assert "Range" not in got._jdf.queryExecution().optimizedPlan().toString()
