"""Ratios, clips, ages and weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Null instead of an error or infinity when the denominator is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def clip(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def grid_round(value: Column, digits: int = 6) -> Column:
    """Half-up rounding with plain arithmetic, so that other engines can repeat it bit for bit."""
    scale = float(10 ** digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def speed_score(position: Column, weight: Column, forty: Column, runner: str = "RB") -> Column:
    """Weight-adjusted sprint time, running backs only, null unless both inputs are usable."""
    usable = (position == runner) & weight.isNotNull() & (forty > 0)
    return F.when(usable, weight * 200 / F.pow(F.when(forty > 0, forty), F.lit(4)))


def nearest_size(n: Column, sizes: Sequence[int]) -> Column:
    """struct<size, approximated>: the closest listed size, the earlier listed one on a tie."""
    ranked = F.array(*[
        F.struct(F.abs(n - F.lit(s)).alias("gap"), F.lit(i).alias("place"), F.lit(s).alias("size"))
        for i, s in enumerate(sizes)
    ])
    best = F.array_min(ranked)
    return F.when(
        n.isNotNull(),
        F.struct(best["size"].alias("size"), (best["gap"] != 0).alias("approximated")),
    )


def age_in(age_at_draft: Column, draft_year: Column, season: Column) -> Column:
    return age_at_draft + (season - draft_year)


def dominator(yards: Column, team_yards: Column, scores: Column, team_scores: Column) -> Column:
    """80/20 share of team yardage and scores; null when a team total is missing or zero."""
    return safe_ratio(yards, team_yards) * 0.8 + safe_ratio(scores, team_scores) * 0.2


def shrink_weight(games: Column, min_games: int = 3, prior_strength: int = 5) -> Column:
    """Weight of in-season evidence: 0 below ``min_games``, then g / (g + prior_strength)."""
    played = F.coalesce(games.cast("double"), F.lit(0.0))
    return F.when(played < min_games, F.lit(0.0)).otherwise(played / (played + F.lit(float(prior_strength))))


def lerp(low: Column, high: Column, fraction: Column) -> Column:
    return low + (high - low) * fraction
