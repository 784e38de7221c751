"""Boards: assembly, rankings, residuals, rule checks and published indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from assetboard.functions.text import normalize_name, pick_asset_id, pick_title
from assetboard.operators.joins import lookup_join
from assetboard.operators.ordering import keep_one, row_positions, top_per_group

BOARD = ("format", "team_size")
DIVERGENCE_ROWS = 15
PUBLISHED_COLUMNS = [
    "asset_id", "sleeper_id", "name", "position", "team", "asset_type", "model_value", "consensus_value",
    "residual", "residual_pct", "current_age", "college_seasons_found", "year", "round", "tier",
]


def assemble_board(predictions: DataFrame, names: DataFrame, features: DataFrame, picks: DataFrame,
                   asset: str = "asset_id") -> DataFrame:
    """Players and dynasty picks of all boards on one value scale, ranked per board.

    ``predictions``: board, asset, model_value, consensus_value, is_rookie. ``picks`` carries
    pick_value, which is both the model and the consensus value of a pick.
    """
    players = lookup_join(predictions, names.select(F.col(asset).alias("_n_id"), "name"), {asset: "_n_id"})
    known = features.select(F.col(asset).alias("_f_id"), "position", "current_age", "college_seasons_found")
    players = lookup_join(players, known, {asset: "_f_id"}).select(
        *BOARD, F.col(asset).cast("string").alias("asset_id"), "name", "position", "model_value", "consensus_value",
        "is_rookie", "current_age", "college_seasons_found", F.lit("player").alias("asset_type"),
    )
    boards = players.unionByName(pick_rows(picks), allowMissingColumns=True)
    return ranked(boards)


def pick_rows(picks: DataFrame) -> DataFrame:
    return picks.select(
        *BOARD,
        pick_asset_id(F.col("format"), F.col("team_size"), F.col("year"), F.col("round"), F.col("tier")).alias("asset_id"),
        pick_title(F.col("year"), F.col("round"), F.col("tier")).alias("name"),
        F.lit("PICK").alias("position"),
        F.col("pick_value").alias("model_value"), F.col("pick_value").alias("consensus_value"),
        F.lit(False).alias("is_rookie"), F.lit("pick").alias("asset_type"),
        "year", "round", "tier",
    )


def ranked(board: DataFrame, value: str = "model_value", asset: str = "asset_id", boards: Sequence[str] = BOARD,
           out: str = "board_rank") -> DataFrame:
    """1-based rank by value within the board, ties by asset id."""
    placed = row_positions(board, boards, [F.desc(value), F.asc(asset)], "_at")
    return placed.withColumn(out, F.col("_at") + 1).drop("_at")


def with_residuals(board: DataFrame) -> DataFrame:
    """Residual in value units and percent; a zero consensus gives 0 percent."""
    residual = F.col("model_value") - F.col("consensus_value")
    share = residual / F.nullif(F.col("consensus_value"), F.lit(0.0)) * 100
    return board.withColumn("residual", residual).withColumn(
        "residual_pct", F.when(F.col("consensus_value") == 0, F.lit(0.0)).otherwise(share)
    )


def has_signal() -> Column:
    """False only for rows whose college lookup found nothing; a null count is kept."""
    return ~F.col("college_seasons_found").eqNullSafe(F.lit(0))


def divergence(board: DataFrame, n: int = DIVERGENCE_ROWS, boards: Sequence[str] = BOARD) -> DataFrame:
    """The ``n`` largest and ``n`` smallest player residuals per board; a row may be in both lists."""
    players = with_residuals(board.where((F.col("asset_type") == "player") & has_signal()))
    high = top_per_group(players, boards, [F.desc("residual"), F.asc("asset_id")], n, "side_rank").withColumn("side", F.lit("above"))
    low = top_per_group(players, boards, [F.asc("residual"), F.asc("asset_id")], n, "side_rank").withColumn("side", F.lit("below"))
    return high.unionByName(low).select(
        *boards, "side", "side_rank", "asset_id", "name", "position", "model_value", "consensus_value", "residual", "residual_pct"
    )


def rankings_view(board: DataFrame, dynasty: bool, position: str | None = None, asset_type: str | None = None,
                  by: str = "model_value", ascending: bool = False) -> DataFrame:
    """The filtered and sorted ranking table; redraft shows players only."""
    view = board
    shown = asset_type if dynasty else "player"
    if shown:
        view = view.where(F.col("asset_type") == shown)
    if position:
        view = view.where(F.col("position") == position)
    if by == "residual":
        view = view.where(has_signal())
    order = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return view.orderBy(order, "asset_id")


def top_rows(board: DataFrame, n: int = 200, value: str = "model_value", boards: Sequence[str] = BOARD) -> DataFrame:
    return top_per_group(board, boards, [F.desc(value), F.asc("asset_id")], n, "board_rank")


def published(board: DataFrame, directory: DataFrame, asset: str = "asset_id") -> DataFrame:
    """The board with team and roster id, in the published column order."""
    attributes = keep_one(directory.where(F.col(asset).isNotNull()), [asset], [F.asc("sleeper_id"), F.asc("team")])
    joined = lookup_join(board, attributes.select(F.col(asset).alias("_dir"), "sleeper_id", "team"), {asset: "_dir"})
    return with_residuals(joined).select(*BOARD, *PUBLISHED_COLUMNS)


def search_index(board: DataFrame) -> DataFrame:
    """One row per asset, sorted by name."""
    columns = ["asset_id", "sleeper_id", "name", "position", "team", "asset_type"]
    unique = keep_one(board.select(*BOARD, *columns), ["asset_id"], [F.asc(c) for c in BOARD])
    return unique.select(*columns).orderBy("name", "asset_id")


def index_coverage(index: DataFrame) -> DataFrame:
    share = lambda c: F.avg(F.col(c).isNotNull().cast("double"))
    return index.agg(F.count("*").alias("n_assets"), share("sleeper_id").alias("id_coverage"), share("team").alias("team_coverage"))


def board_metadata(board: DataFrame, season: int, counted: tuple[str, int] = ("sf_dynasty", 12)) -> DataFrame:
    """One row: the boards present and the player and pick count of one of them."""
    here = (F.col("format") == counted[0]) & (F.col("team_size") == counted[1])
    return board.agg(
        F.lit(season).alias("season"),
        F.array_sort(F.collect_set(F.concat_ws("_", *BOARD))).alias("formats"),
        F.count_if(here & (F.col("asset_type") == "player")).alias("player_count"),
        F.count_if(here & (F.col("asset_type") == "pick")).alias("pick_count"),
    )


def board_movement(before: DataFrame, after: DataFrame, boards: Sequence[str] = BOARD, more_than: float = 1.0) -> DataFrame:
    """Assets per board whose value moved by more than ``more_than`` between two runs."""
    keys = [*boards, "asset_id"]
    both = after.select(*keys, F.col("model_value").alias("_after")).join(
        before.select(*keys, F.col("model_value").alias("_before")), keys)
    return both.groupBy(*boards).agg(
        F.count("*").alias("n_assets"),
        F.count_if(F.abs(F.col("_after") - F.col("_before")) > more_than).alias("n_moved"),
    )


def rule_panel(rules: DataFrame, board: DataFrame) -> DataFrame:
    """Check ranking rules against ranked boards.

    ``rules``: rule_id, kind ('top_n' or 'pairwise'), format, team_size, name, other, n. A name is
    found exactly, else by its normalised form, else the rule is skipped (``passed`` null). The
    boards are cut to the rules' names before anything else, so the work after the semi-joins is the
    size of the rule table.
    """
    wanted = rules.select(F.explode(F.array("name", "other")).alias("asked")).where(F.col("asked").isNotNull()).distinct()
    probes = wanted.select("asked", normalize_name(F.col("asked")).alias("_norm"))
    placed = board.select(*BOARD, "name", "board_rank", normalize_name(F.col("name")).alias("_norm"))
    hits = placed.withColumnRenamed("name", "_name").join(probes, "_norm").where(F.col("_norm") != "")
    exact = hits.where(F.col("_name") == F.col("asked"))
    best = lambda df, c: df.groupBy(*BOARD, "asked").agg(F.min("board_rank").alias(c))
    ranks = best(hits, "_loose").join(best(exact, "_exact"), [*BOARD, "asked"], "left").select(
        *[F.col(b).alias(f"_{b}") for b in BOARD], "asked", F.coalesce("_exact", "_loose").alias("_rank"))

    def found(df: DataFrame, who: str, out: str) -> DataFrame:
        side = ranks.select(*[F.col(f"_{b}").alias(f"_{out}_{b}") for b in BOARD], F.col("asked").alias(f"_{out}_who"),
                            F.col("_rank").alias(out))
        return lookup_join(df, side, {**{b: f"_{out}_{b}" for b in BOARD}, who: f"_{out}_who"})

    both = found(found(rules, "name", "rank"), "other", "other_rank")
    passed = F.when(F.col("kind") == "top_n", F.col("rank") <= F.col("n")).otherwise(F.col("rank") < F.col("other_rank"))
    missing = F.when(F.col("rank").isNull(), F.col("name")).otherwise(F.col("other"))
    detail = F.when(passed.isNull(), F.concat(missing, F.lit(" not on board"))).when(
        F.col("kind") == "top_n", F.format_string("rank=%d (need <= %d)", "rank", "n")
    ).otherwise(F.format_string("rank=%d vs rank=%d", "rank", "other_rank"))
    return both.select(
        "rule_id", "kind", *BOARD, "rank", "other_rank", passed.alias("passed"),
        F.when(passed.isNull(), "skipped").when(passed, "passed").otherwise("failed").alias("status"),
        detail.alias("detail"),
    )


def rule_tally(panel: DataFrame) -> DataFrame:
    return panel.agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("passed", "failed", "skipped")])
