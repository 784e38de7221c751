"""In-season refresh: shrink season-to-date production towards the prior."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from assetboard.functions.numeric import shrink_weight
from assetboard.operators.features import PRODUCTION_COLUMNS
from assetboard.operators.boards import BOARD, assemble_board
from assetboard.operators.joins import safe_left_join
from assetboard.operators.learning import BoardFits, predict_boards
from assetboard.sources.sinks import write_snapshot

# Games below which in-season data has no weight, and the prior's weight in games.
MIN_GAMES = 3
# Fixed value: games that make a season a full one in the back-test.
FULL_GAMES = 10
PRIOR_STRENGTH = 5


def blend_in_season(features: DataFrame, partial: DataFrame, asset: str, columns: Sequence[str] = PRODUCTION_COLUMNS,
                    games: str = "games", min_games: int = MIN_GAMES, prior_strength: int = PRIOR_STRENGTH,
                    null_prior: str = "keep") -> DataFrame:
    """Features with every production column moved towards the season to date.

    A null prior stays null unless ``null_prior='use_sample'``; ``games`` is replaced only where the
    weight is positive. All columns are built in one select.
    """
    present = [c for c in columns if c in partial.columns]
    side = partial.select(asset, *[F.col(c).alias(f"_now_{c}") for c in present])
    joined = safe_left_join(features, side, [asset]).withColumn(
        "_w", shrink_weight(F.col(f"_now_{games}"), min_games, prior_strength)
    )
    w = F.col("_w")
    out = []
    for c in features.columns:
        if c == games:
            out.append(F.when(w > 0, F.col(f"_now_{games}")).otherwise(F.col(games)).alias(games))
        elif c in columns and c in present:
            prior = F.col(c)
            mixed = w * F.coalesce(F.col(f"_now_{c}"), prior) + (F.lit(1.0) - w) * prior
            if null_prior == "use_sample":
                mixed = F.coalesce(mixed, F.when(w > 0, F.col(f"_now_{c}")))
            out.append(mixed.alias(c))
        elif c in columns:
            out.append((w * F.col(c) + (F.lit(1.0) - w) * F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def recompute_board(features: DataFrame, partial: DataFrame | None, fits: BoardFits, targets: DataFrame,
                    names: DataFrame, picks: DataFrame, asset: str, columns: Sequence[str] = PRODUCTION_COLUMNS,
                    snapshot: tuple[str, str] | None = None) -> DataFrame:
    """All boards with the fitted models and the season to date; no refit.

    ``partial`` None leaves the features as they are. ``targets``: board, asset, consensus_value of
    the assets each board was fitted on. ``snapshot`` is (path, date) of a dated copy.
    """
    current = features if partial is None else blend_in_season(features, partial, asset, columns)
    scored = predict_boards(current, targets, fits, asset)
    board = assemble_board(scored, names, current, picks, asset)
    if snapshot:
        write_snapshot(board, snapshot[0], snapshot[1])
    return board


def blend_backtest(pool: DataFrame, weeks: DataFrame, asset: str, week: str, points: str, cutoffs: Sequence[int],
                   min_games: int = MIN_GAMES, prior_strength: int = PRIOR_STRENGTH, pools: str | None = None) -> DataFrame:
    """Error of the prior alone and of the blend against the full season, per cutoff week.

    ``pool``: asset, prior_ppg, true_ppg, and in ``pools`` the names of the pools an asset counts in, each
    reported by itself. Weeks are aggregated once per (asset, week); each cutoff is
    a conditional sum over that, so the weekly table is read once for all cutoffs.
    """
    weekly = weeks.groupBy(asset, week).agg(F.sum(points).alias("_pts"))
    upto = lambda cut, c: F.when(F.col(week) <= cut, c)
    sums = weekly.groupBy(asset).agg(
        *[F.count(upto(cut, F.col(week))).alias(f"_g{cut}") for cut in cutoffs],
        *[F.sum(upto(cut, F.col("_pts"))).alias(f"_p{cut}") for cut in cutoffs],
    )
    joined = safe_left_join(pool, sums, [asset])
    cells = F.array(*[
        F.struct(F.lit(cut).alias("through_week"), F.coalesce(F.col(f"_g{cut}"), F.lit(0)).alias("g"),
                 F.col(f"_p{cut}").alias("p"))
        for cut in cutoffs
    ])
    if pools:
        joined = joined.withColumn("pool", F.explode(pools))
    rows = joined.select("prior_ppg", "true_ppg", *(["pool"] if pools else []), F.inline(cells))
    w = shrink_weight(F.col("g"), min_games, prior_strength)
    sample = F.coalesce(F.col("p").cast("double") / F.nullif(F.col("g").cast("double"), F.lit(0.0)), F.col("prior_ppg"))
    blended = w * sample + (F.lit(1.0) - w) * F.col("prior_ppg")
    return rows.groupBy(*(["pool"] if pools else []), "through_week").agg(
        F.count("*").alias("n_assets"),
        F.avg(F.col("g").cast("double")).alias("mean_games"),
        F.coalesce(F.avg(F.when(F.col("g") > 0, w)), F.lit(0.0)).alias("mean_weight"),
        F.max(w).alias("max_weight"),
        F.avg(F.abs(F.col("prior_ppg") - F.col("true_ppg"))).alias("mae_prior"),
        F.avg(F.abs(blended - F.col("true_ppg"))).alias("mae_blended"),
    ).withColumn("improved", F.col("mae_blended") < F.col("mae_prior"))
