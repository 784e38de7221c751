"""Season panels, career aggregates, ageing curves and the per-asset feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from assetboard.functions.numeric import age_in, dominator, safe_ratio
from assetboard.session import land
from assetboard.operators.joins import keep_matching, lookup_join, safe_left_join
from assetboard.operators.ordering import keep_one

# Positions in scope and the column lists of the season table and the feature table.
POSITIONS = ("QB", "RB", "WR", "TE")
SUMMED_COLUMNS = [
    "completions", "attempts", "passing_yards", "passing_tds", "carries", "rushing_yards", "rushing_tds",
    "targets", "receptions", "receiving_yards", "receiving_tds", "fantasy_points_ppr",
]
AVERAGED_COLUMNS = [
    "passing_epa", "passing_cpoe", "rushing_epa", "receiving_epa", "target_share", "air_yards_share", "wopr", "racr",
]
PRODUCTION_COLUMNS = [
    "games", "completions", "attempts", "passing_yards", "passing_tds", "passing_epa", "passing_cpoe",
    "carries", "rushing_yards", "rushing_tds", "rushing_epa",
    "targets", "receptions", "receiving_yards", "receiving_tds", "receiving_epa",
    "target_share", "air_yards_share", "wopr", "racr", "fantasy_points_ppr", "ppg_ppr", "snap_share",
]
NUMERIC_FEATURES = PRODUCTION_COLUMNS + [
    "career_games", "seasons_played", "career_ppg_ppr",
    "current_age", "current_age_squared", "current_distance_from_peak_age",
    "round", "pick", "forty_time", "combine_weight", "speed_score", "dominator_rating", "breakout_age",
]
CATEGORICAL_FEATURES = ["position"]
LAST_WEEK = 18
MIN_CURVE_GAMES = 4
MIN_CURVE_ROWS = 20
BREAKOUT_SHARE = 0.20


def season_share(counts: DataFrame, ids: DataFrame, player: str, season: str, share: str, id_key: str, id_col: str,
                 out: str = "snap_share") -> DataFrame:
    """Mean share per player-season under the mapped id; unmapped players are dropped."""
    means = counts.groupBy(player, season).agg(F.avg(share).alias(out))
    mapped = lookup_join(means, ids.select(F.col(id_key).alias("_map_key"), F.col(id_col).alias("_map_id")),
                         {player: "_map_key"})
    return mapped.where(F.col("_map_id").isNotNull()).select(F.col("_map_id").alias(id_col), season, out)


def season_panel(stats: DataFrame, shares: DataFrame, asset: str, season: str, columns: Sequence[str],
                 points: str = "fantasy_points_ppr", games: str = "games", per_game: str = "ppg_ppr",
                 position: str = "position", positions: Sequence[str] = POSITIONS) -> DataFrame:
    """Rows of the positions in scope with points per game and the season share."""
    scoped = stats.where(F.col(position).isin(*positions)).select(asset, position, season, *columns)
    rated = scoped.withColumn(per_game, safe_ratio(F.col(points), F.col(games)))
    return safe_left_join(rated, shares, [asset, season])


def season_to_date(weeks: DataFrame, asset: str, week: str, through_week: int,
                   summed: Sequence[str] = SUMMED_COLUMNS, averaged: Sequence[str] = AVERAGED_COLUMNS,
                   points: str = "fantasy_points_ppr", per_game: str = "ppg_ppr", last_week: int = LAST_WEEK) -> DataFrame:
    """Season aggregates through a week: distinct weeks as games, sums, means, points per game."""
    scoped = weeks.where(F.col(week) <= min(through_week, last_week))
    out = scoped.groupBy(asset).agg(
        F.countDistinct(week).alias("games"),
        *[F.sum(c).alias(c) for c in summed],
        *[F.avg(c).alias(c) for c in averaged],
    )
    return out.withColumn(per_game, safe_ratio(F.col(points), F.col("games")))


def career(panel: DataFrame, asset: str, season: str, points: str, games: str = "games",
           per_game: str = "career_ppg_ppr") -> DataFrame:
    """Games, seasons and pooled points per game; the panel has one row per asset and season."""
    return panel.groupBy(asset).agg(
        F.sum(games).alias("career_games"),
        F.count(season).alias("seasons_played"),
        safe_ratio(F.sum(points), F.sum(games)).alias(per_game),
    )


def with_age(panel: DataFrame, draft: DataFrame, asset: str, season: str = "season") -> DataFrame:
    """Season age from draft age; undrafted assets keep a null age."""
    known = draft.select(F.col(asset).alias("_d_asset"), "draft_year", "age_at_draft")
    joined = lookup_join(panel, known, {asset: "_d_asset"})
    return joined.withColumn("age", age_in(F.col("age_at_draft"), F.col("draft_year"), F.col(season)))


def prior_workload(panel: DataFrame, asset: str, season: str, games: str = "games", out: str = "career_workload") -> DataFrame:
    """Games of all earlier seasons. One row per asset and season, so a window holds a career at most."""
    earlier = Window.partitionBy(asset).orderBy(season).rowsBetween(Window.unboundedPreceding, -1)
    return panel.withColumn(out, F.coalesce(F.sum(games).over(earlier), F.lit(0)))


def aging_curves(aged: DataFrame, group: str, y: str, age: str = "age", games: str = "games",
                 min_games: int = MIN_CURVE_GAMES, min_rows: int = MIN_CURVE_ROWS) -> DataFrame:
    """Degree-2 least squares of ``y`` on whole-year age per group, with its peak age.

    Rows are first reduced to one per (group, age), so the fit itself runs on a table with one row
    per year of age. A convex curve has no peak; the median age stands in for it.
    """
    usable = aged.where(F.col(age).isNotNull() & F.col(y).isNotNull() & (F.col(games) >= min_games))
    levels = usable.groupBy(group, F.col(age).alias("x")).agg(
        F.count("*").cast("double").alias("n"), F.sum(y).cast("double").alias("sy")
    )
    whole = Window.partitionBy(group)
    running = whole.orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    centred = levels.select(
        group, "x", "n", "sy",
        F.floor(F.sum(F.col("x") * F.col("n")).over(whole) / F.sum("n").over(whole)).alias("m"),
        F.sum("n").over(running).alias("upto"),
        F.sum("n").over(whole).alias("total"),
    ).withColumn("d", (F.col("x") - F.col("m")).cast("double"))
    power = lambda k: F.sum(F.col("n") * F.pow("d", F.lit(k)))
    reaches = lambda place: F.min(F.when(F.col("upto") > place, F.col("x").cast("double")))
    moments = centred.groupBy(group).agg(
        F.max("m").cast("double").alias("m"), F.sum("n").alias("s0"),
        *[power(k).alias(f"s{k}") for k in (1, 2, 3, 4)],
        F.sum("sy").alias("t0"), F.sum(F.col("d") * F.col("sy")).alias("t1"),
        F.sum(F.col("d") * F.col("d") * F.col("sy")).alias("t2"),
        reaches(F.floor((F.col("total") - 1) / 2)).alias("mid_lo"),
        reaches(F.ceil((F.col("total") - 1) / 2)).alias("mid_hi"),
    ).where(F.col("s0") >= min_rows)
    s0, s1, s2, s3, s4, t0, t1, t2, m = (F.col(c) for c in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2", "m"))
    det = s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2)
    det_a = s0 * (s2 * t2 - s3 * t1) - s1 * (s1 * t2 - s3 * t0) + s2 * (s1 * t1 - s2 * t0)
    det_b = s0 * (t1 * s4 - t2 * s3) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - s2 * t1)
    det_c = t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)
    solved = moments.select(
        group, "m", F.col("s0").cast("bigint").alias("n_rows"),
        safe_ratio(det_a, det).alias("a"), safe_ratio(det_b, det).alias("b"), safe_ratio(det_c, det).alias("c"),
        ((F.col("mid_lo") + F.col("mid_hi")) / 2).alias("median_age"),
    )
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    return solved.select(
        group, "n_rows", "a",
        (b - a * m * 2).alias("b"),
        (c - b * m + a * m * m).alias("c"),
        (a < 0).alias("concave"),
        F.when(a < 0, m - b / (F.when(a < 0, a) * 2)).otherwise(F.col("median_age")).alias("peak_age"),
    )


def age_features(df: DataFrame, peaks: DataFrame, group: str, age: str, squared: str, distance: str) -> DataFrame:
    """Age squared and distance to the group's peak age."""
    # One row per group: once written, the planner sees its size and need not shuffle the rows on a few values.
    known = land(peaks.select(F.col(group).alias("_p_group"), F.col("peak_age").alias("_p_age")), "peaks")
    joined = lookup_join(df, known, {group: "_p_group"})
    return joined.withColumn(squared, F.col(age) * F.col(age)).withColumn(
        distance, F.abs(F.col(age) - F.col("_p_age"))
    ).drop("_p_age")


def latest_season(panel: DataFrame, asset: str, season: str) -> DataFrame:
    return keep_one(panel, [asset], [F.desc(season)])


def player_snapshot(panel: DataFrame, draft: DataFrame, peaks: DataFrame, asset: str, position: str, season: str,
                    points: str, valuation_season: int, per_game: str = "career_ppg_ppr",
                    active: DataFrame | None = None) -> DataFrame:
    """One row per asset entering ``valuation_season``.

    Latest season plus career aggregates, age moved to the valuation season, and the current draft
    class without history appended with null production.
    """
    latest = latest_season(panel, asset, season)
    totals = career(panel, asset, season, points, per_game=per_game)
    born = draft.select(F.col(asset).alias("_d_asset"), "draft_year", "age_at_draft")
    veterans = lookup_join(latest.join(totals, asset), born, {asset: "_d_asset"})
    rookies = (
        draft.where(F.col("draft_year") == valuation_season)
        .join(totals.select(asset), asset, "left_anti")
        .select(asset, position, "draft_year", "age_at_draft")
    )
    rows = veterans.unionByName(rookies, allowMissingColumns=True).withColumn(
        "current_age", age_in(F.col("age_at_draft"), F.col("draft_year"), F.lit(valuation_season))
    )
    aged = age_features(rows, peaks, position, "current_age", "current_age_squared", "current_distance_from_peak_age")
    return keep_matching(aged, active, asset) if active is not None else aged


def feature_table(snapshot: DataFrame, draft: DataFrame, combine: DataFrame, college: DataFrame, asset: str) -> DataFrame:
    """Snapshot with draft slot, combine metrics and college production; the row count is kept."""
    out = safe_left_join(snapshot, draft.select(asset, "round", "pick"), [asset])
    out = safe_left_join(out, combine, [asset])
    return safe_left_join(out, college.select(asset, "dominator_rating", "breakout_age", "college_seasons_found"), [asset])


def pivot_stats(long: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long statistics to declared columns; the smallest value stands for a repeated statistic."""
    return long.groupBy(*keys).pivot(name, list(names)).agg(F.min(value))


def college_production(seasons: DataFrame, teams: DataFrame, draft: DataFrame, asset: str, team: str, year: str,
                       skip_position: str | None = "QB", position: str = "position",
                       threshold: float = BREAKOUT_SHARE) -> DataFrame:
    """Last dominator rating, breakout age and seasons found for every drafted asset.

    ``seasons``: asset, team, year, yards, scores. ``teams``: team, year, team_yards, team_scores.
    A season counts only when both team totals are present and not zero.
    """
    totals = teams.select(F.col(team).alias("_t_team"), F.col(year).alias("_t_year"), "team_yards", "team_scores")
    rated = lookup_join(seasons, totals, {team: "_t_team", year: "_t_year"}).withColumn(
        "_share",
        dominator(F.coalesce("yards", F.lit(0)), F.col("team_yards"), F.coalesce("scores", F.lit(0)), F.col("team_scores")),
    )
    skipped = F.col(position) == skip_position if skip_position else F.lit(False)
    known = draft.select(F.col(asset), "draft_year", "age_at_draft", skipped.alias("_skip"))
    history = rated.where(F.col("_share").isNotNull()).join(known.where(~F.col("_skip")), asset).where(
        F.col(year) < F.col("draft_year")
    ).withColumn("_age", age_in(F.col("age_at_draft"), F.col("draft_year"), F.col(year)))
    summary = history.groupBy(asset).agg(
        F.max_by("_share", year).alias("dominator_rating"),
        F.expr(f"min_by(_age, `{year}`) FILTER (WHERE _share >= {threshold})").alias("breakout_age"),
        F.count("*").alias("college_seasons_found"),
    )
    return known.select(asset).join(summary, asset, "left").withColumn(
        "college_seasons_found", F.coalesce("college_seasons_found", F.lit(0))
    )
