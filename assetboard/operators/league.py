"""Trades and leagues valued on a board."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from assetboard.functions.text import normalize_id
from assetboard.operators.boards import has_signal
from assetboard.operators.joins import lookup_join
from assetboard.operators.ordering import row_positions, top_per_group

# A trade within this many percent is even; number of suggested targets.
TRADE_TOLERANCE_PCT = 5.0
TARGET_ROWS = 5


def trade_verdict(trades: DataFrame, values: DataFrame, tolerance: float = TRADE_TOLERANCE_PCT) -> DataFrame:
    """Side totals and verdict of many trades. ``trades``: trade_id, side, asset_id."""
    valued = lookup_join(trades, values.select(F.col("asset_id").alias("_v_id"), "model_value"), {"asset_id": "_v_id"})
    side = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("model_value"))), F.lit(0.0))
    totals = valued.groupBy("trade_id").agg(side("A").alias("total_a"), side("B").alias("total_b"))
    a, b = F.col("total_a"), F.col("total_b")
    bigger = F.greatest(a, b)
    totals = totals.withColumn("diff_pct", F.coalesce(F.abs(a - b) / F.nullif(bigger, F.lit(0.0)) * 100, F.lit(0.0)))
    return totals.withColumn(
        "verdict",
        F.when((a == 0) & (b == 0), "none").when(F.col("diff_pct") <= tolerance, "even").when(a > b, "A").otherwise("B"),
    )


def roster_rows(rosters: DataFrame, users: DataFrame) -> DataFrame:
    """One row per rostered player with the shown team name.

    ``rosters``: league_id, roster_id, owner_id, players array. ``users``: user_id, display_name,
    team_name. The name falls back from team to display name to 'Roster n'.
    """
    named = lookup_join(
        rosters, users.select(F.col("user_id").alias("_u"), F.coalesce("team_name", "display_name").alias("_shown")),
        {"owner_id": "_u"},
    ).withColumn("team_name", F.coalesce("_shown", F.concat(F.lit("Roster "), F.col("roster_id").cast("string"))))
    return named.select("league_id", "roster_id", "team_name", F.explode("players").alias("_raw")).select(
        "league_id", "roster_id", "team_name", normalize_id(F.col("_raw")).alias("sleeper_id")
    )


def rostered_assets(roster: DataFrame, players: DataFrame) -> DataFrame:
    """Roster rows joined to priced players; unpriced players drop out."""
    return roster.join(players, "sleeper_id")


def roster_top_n(assets: DataFrame, n: int = 10) -> DataFrame:
    return top_per_group(assets, ["league_id", "roster_id"], [F.desc("model_value"), F.asc("asset_id")], n, "roster_rank")


def buy_low_targets(assets: DataFrame, mine: DataFrame, n: int = TARGET_ROWS) -> DataFrame:
    """The most undervalued players on other rosters of the league.

    ``mine``: league_id, my_roster_id, one row per league.
    """
    own = mine.select(F.col("league_id").alias("_l"), "my_roster_id")
    others = lookup_join(assets, own, {"league_id": "_l"}).where(
        (F.col("roster_id") != F.col("my_roster_id")) & has_signal() & (F.col("residual") > 0)
    )
    return top_per_group(others, ["league_id"], [F.desc("residual"), F.asc("asset_id")], n, "target_rank")


def pick_ownership(rosters: DataFrame, traded: DataFrame, years: Sequence[int], rounds: Sequence[int]) -> DataFrame:
    """Owner of every (year, round, original roster) slot: the roster itself unless a trade says otherwise.

    ``rosters``: league_id, roster_id. ``traded``: league_id, year, round, original_roster, new_owner,
    one row per slot.
    """
    slots = rosters.select("league_id", F.col("roster_id").alias("original_roster")).distinct()
    for name, values in (("year", years), ("round", rounds)):
        slots = slots.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    key = ["league_id", "year", "round", "original_roster"]
    return slots.join(traded.select(*key, "new_owner"), key, "left").select(
        *key, F.coalesce("new_owner", "original_roster").alias("owner")
    )


def league_totals(assets: DataFrame, rosters: DataFrame, ownership: DataFrame, mid_prices: DataFrame) -> DataFrame:
    """Player value plus owned future picks per roster, ranked within the league.

    ``mid_prices``: year, round, pick_price (the middle tier of the league's board).
    """
    players = assets.groupBy("league_id", "roster_id").agg(F.sum("model_value").alias("player_value"))
    picks = ownership.groupBy("league_id", "owner", "year", "round").agg(F.count("*").alias("_slots"))
    pick_value = picks.join(mid_prices, ["year", "round"], "left").groupBy(
        "league_id", F.col("owner").alias("roster_id")
    ).agg(F.sum(F.col("_slots") * F.coalesce("pick_price", F.lit(0.0))).alias("pick_value"))
    totals = (
        rosters.select("league_id", "roster_id").distinct()
        .join(players, ["league_id", "roster_id"], "left")
        .join(pick_value, ["league_id", "roster_id"], "left")
        .select(
            "league_id", "roster_id",
            F.coalesce("player_value", F.lit(0.0)).alias("player_value"),
            F.coalesce("pick_value", F.lit(0.0)).alias("pick_value"),
        ).withColumn("total_value", F.col("player_value") + F.col("pick_value"))
    )
    placed = row_positions(totals, ["league_id"], [F.desc("total_value"), F.asc("roster_id")], "_at")
    return placed.withColumn("league_rank", F.col("_at") + 1).drop("_at")
