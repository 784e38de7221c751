"""The weekly run: from landed source tables to fitted, ranked and published boards."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from assetboard.functions.numeric import speed_score
from assetboard.functions.text import normalize_name
from assetboard.operators import boards, features, identity, picks, quality
from assetboard.operators.boards import BOARD
from assetboard.operators.consensus import blend_consensus, rank_power_weights
from assetboard.operators.learning import FOLDS, BoardFits, TreeSettings, fit_boards, fit_forests, out_of_fold, predict_boards
from assetboard.operators.metrics import regression_metrics
from assetboard.operators.ordering import keep_one
from assetboard.session import land
from assetboard.sources.sinks import write_boards

IDS = ["mfl_id", "espn_id", "gsis_id", "ktc_id"]
FORMATS = ("sf_dynasty", "oneqb_dynasty", "redraft")


@dataclass
class Sources:
    """Landed tables of one run.

    crosswalk: mfl_id, espn_id, ktc_id (text), gsis_id, pfr_id, sleeper_id, name, position, team
    prices: format, team_size, name, position, mfl_id, espn_id, value
    page_dynasty, page_redraft: name, position, player_id, oneqb_value, sf_value
    season_stats: player_id, position, season and the production columns up to fantasy_points_ppr
    snap_counts: pfr_player_id, season, position, offense_pct
    draft_picks: gsis_id, season, round, pick, age, position, pfr_player_name
    combine: pfr_id, player_name, pos, draft_year, forty, wt, ht
    college_seasons: gsis_id, team, year, yards, scores
    college_teams: team, year, team_yards, team_scores
    """

    crosswalk: DataFrame
    prices: DataFrame
    page_dynasty: DataFrame
    page_redraft: DataFrame
    season_stats: DataFrame
    snap_counts: DataFrame
    draft_picks: DataFrame
    combine: DataFrame
    college_seasons: DataFrame
    college_teams: DataFrame


@dataclass
class Run:
    crosswalk: DataFrame
    features: DataFrame
    targets: DataFrame
    picks: DataFrame
    fits: BoardFits
    board: DataFrame
    #: Out-of-fold Spearman, MAE and MAE of the top 50 per board and model; null without validation.
    metrics: DataFrame | None = None
    #: Every rule checked on the way, with what was observed.
    report: DataFrame | None = None


class Gates:
    """Rules that a run must meet; a failed one stops the run, or is only reported with ``strict=False``."""

    def __init__(self, strict: bool):
        self.strict, self.report = strict, None

    def check(self, name: str, df: DataFrame, rules: Sequence) -> None:
        self.add(name, quality.expectations(df, rules))

    def cover(self, name: str, source: DataFrame, table: DataFrame, source_id: str, table_id: str, order: Sequence) -> None:
        """At least 95% of each board's 200 most valuable rows are found by their primary id."""
        found = identity.topn_coverage(source, table, BOARD, source_id, table_id, order)
        self.add(name, found.agg(F.min("coverage").alias("observed"), F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed")).select(
            F.lit("coverage").alias("rule"), F.col("observed").cast("double"), "passed"))

    def add(self, name: str, found: DataFrame) -> None:
        found = land(found.select(F.concat(F.lit(f"{name}: "), "rule").alias("rule"), "observed", "passed"), "gate")
        self.report = found if self.report is None else self.report.unionByName(found)
        if self.strict:
            quality.require(found)


def skilled(df: DataFrame, column: str = "position") -> DataFrame:
    return df.where(F.col(column).isin(*features.POSITIONS))


def draft_table(source: DataFrame, crosswalk: DataFrame, season: int) -> DataFrame:
    rows = skilled(source).select(
        "gsis_id", F.col("season").alias("draft_year"), "round", "pick", F.col("age").alias("age_at_draft"), "position",
        F.col("pfr_player_name").alias("draft_name"))
    base = identity.draft_capital(rows, "gsis_id", [F.asc("draft_year"), F.asc("round"), F.asc("pick"), F.asc("draft_name")])
    return identity.repair_ids(base, crosswalk, "gsis_id", "draft_name", "draft_year", season, "gsis_id", "name", [F.asc("mfl_id")])


def combine_table(source: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Combine metrics under the player id, latest draft year of each player."""
    rows = skilled(source, "pos").withColumn("src_name", normalize_name(F.col("player_name"))).withColumnRenamed("pfr_id", "src_pfr")
    paths = [identity.Path("src_pfr", "pfr_id", "primary"), identity.Path("src_name", "merge_name", "name")]
    found = identity.resolve(rows, crosswalk, paths, ["gsis_id"], "gsis_id", [F.asc("mfl_id")]).where(F.col("gsis_id").isNotNull())
    latest = keep_one(found, ["gsis_id"], [F.desc("draft_year"), F.desc("wt"), F.desc("forty"), F.desc("ht")])
    return latest.select("gsis_id", F.col("forty").alias("forty_time"), F.col("wt").alias("combine_weight"), F.col("ht").alias("combine_height"),
                         speed_score(F.col("pos"), F.col("wt"), F.col("forty")).alias("speed_score"))


def second_prices(dynasty: DataFrame, redraft: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """The second price list as format, mfl_id, value_b: one page backs both dynasty formats."""
    order = [F.asc("mfl_id")]
    paths = [identity.Path("player_id", "ktc_id", "primary"), identity.Path("src_name", "merge_name", "name")]
    resolve = lambda page: identity.resolve(
        page.withColumn("src_name", normalize_name(F.col("name"))), crosswalk, paths, ["ktc_id", "mfl_id"], "ktc_id", order
    ).where(F.col("ktc_id").isNotNull())
    base = skilled(dynasty)
    bridged = identity.bridge_ids(skilled(redraft), base, "player_id", "name", "player_id", "name", [F.asc("player_id")])
    routed = F.inline(F.array(
        F.struct(F.lit("sf_dynasty").alias("format"), F.col("sf_value").alias("value_b")),
        F.struct(F.lit("oneqb_dynasty").alias("format"), F.col("oneqb_value").alias("value_b"))))
    return resolve(base).select("mfl_id", routed).unionByName(
        resolve(bridged).select("mfl_id", F.lit("redraft").alias("format"), F.col("oneqb_value").alias("value_b"))
    ).where(F.col("value_b").isNotNull())


def weekly_run(s: Sources, season: int, settings: TreeSettings = TreeSettings(), formats: Sequence[str] = FORMATS,
               sizes: Sequence[int] = picks.TEAM_SIZES, strict: bool = True, folds: int = FOLDS) -> Run:
    """Features, consensus targets, one fit per board and the ranked boards.

    Tables that several later steps read are written once. Coverage, uniqueness and non-null rules are
    checked on the way; ``strict`` stops the run on the first that fails. With ``folds`` the boosted model
    and the comparison forest are validated out of fold per board; 0 leaves that out.
    """
    gates = Gates(strict)
    crosswalk = land(identity.crosswalk(s.crosswalk, ["mfl_id", "espn_id", "ktc_id"], ["gsis_id", "pfr_id", "sleeper_id", "name", "position", "team"]), "crosswalk")
    gates.check("crosswalk", crosswalk, [quality.NotNull("mfl_id"), quality.NotNull("name"), quality.Unique(("mfl_id",))])
    draft = land(draft_table(s.draft_picks, crosswalk, season), "draft")
    by_pfr = identity.key_view(crosswalk, "pfr_id", ["gsis_id"], [F.asc("mfl_id")])
    shares = features.season_share(skilled(s.snap_counts), by_pfr, "pfr_player_id", "season", "offense_pct", "pfr_id", "gsis_id")
    stats = s.season_stats.withColumnRenamed("player_id", "gsis_id")
    produced = [c for c in features.PRODUCTION_COLUMNS if c not in ("ppg_ppr", "snap_share")]
    panel = land(features.season_panel(stats, shares, "gsis_id", "season", produced), "panel")
    peaks = features.aging_curves(features.with_age(panel, draft, "gsis_id"), "position", "ppg_ppr")

    source = skilled(s.prices).withColumnRenamed("mfl_id", "src_mfl").withColumnRenamed("espn_id", "src_espn").withColumn(
        "src_name", normalize_name(F.col("name")))
    paths = [identity.Path("src_mfl", "mfl_id", "primary"), identity.Path("src_espn", "espn_id", "secondary"), identity.Path("src_name", "merge_name", "name")]
    priced = land(identity.resolve(source, crosswalk, paths, IDS, "mfl_id", [F.asc("mfl_id")]).where(F.col("mfl_id").isNotNull()), "priced")
    gates.cover("prices", source, crosswalk, "src_mfl", "mfl_id", [F.desc("value"), F.asc("src_name")])
    gates.check("prices", priced, [quality.NotNull("value"), quality.Unique((*BOARD, "mfl_id"))])

    rookies = draft.where(F.col("draft_year") == season)
    college = features.college_production(s.college_seasons, s.college_teams, rookies, "gsis_id", "team", "year")
    snapshot = features.player_snapshot(panel, draft.select("gsis_id", "position", "draft_year", "age_at_draft"), peaks, "gsis_id", "position",
                                        "season", "fantasy_points_ppr", season, active=identity.active_ids(priced, "gsis_id"))
    table = land(features.feature_table(snapshot, draft, combine_table(s.combine, crosswalk), college, "gsis_id"), "features")

    second = land(second_prices(s.page_dynasty, s.page_redraft, crosswalk), "second-prices")
    gates.check("second prices", second, [quality.Unique(("format", "mfl_id"))])
    blended = blend_consensus(priced.select(*BOARD, "mfl_id", "gsis_id", "value"), second, BOARD, ["format"], "mfl_id", "value", "value_b")
    known = blended.where(F.col("gsis_id").isNotNull()).select(*BOARD, "gsis_id", "consensus_value").join(table.select("gsis_id"), "gsis_id")
    targets = land(rank_power_weights(known, BOARD, "consensus_value"), "targets")
    gates.check("targets", targets, [quality.NotNull("consensus_value"), quality.Unique((*BOARD, "gsis_id"))])

    universe = land(picks.pick_universe(
        s.prices.where(F.col("position") == "PICK").select(*BOARD, "name", "value"),
        s.page_dynasty.where(F.col("position") == "RDP").select("name", "sf_value", "oneqb_value")), "picks")
    wanted = F.col("format").isin(*formats) & F.col("team_size").isin(*sizes)
    train, chosen = targets.join(table, "gsis_id").where(wanted), targets.where(wanted)
    fit = ("consensus_value", "sample_weight", features.NUMERIC_FEATURES, features.CATEGORICAL_FEATURES, ["gsis_id"], settings)
    fits = fit_boards(train, BOARD, *fit)
    scored = predict_boards(table, chosen, fits, "gsis_id")
    names = identity.key_view(crosswalk, "gsis_id", ["name"], [F.asc("mfl_id")])
    board = land(boards.assemble_board(scored, names, table, universe, "gsis_id"), "board")
    gates.check("board", board, [quality.NotNull("name"), quality.NotNull("model_value"), quality.NotNull("consensus_value"),
                                 quality.Unique((*BOARD, "asset_id"))])
    validated = validate(train, fit, folds) if folds else None
    return Run(crosswalk, table, targets, universe, fits, board, validated, gates.report)


def validate(train: DataFrame, fit: tuple, folds: int) -> DataFrame:
    """Out-of-fold metrics of the boosted model and of the comparison forest, per board."""
    columns = [*BOARD, "gsis_id", "consensus_value", "oof_prediction"]
    boosted = out_of_fold(train, BOARD, *fit, k=folds).select(F.lit("boosted").alias("model"), *columns)
    forest = fit_forests(train, BOARD, *fit, k=folds, out="oof_prediction").select(F.lit("forest").alias("model"), *columns)
    return land(regression_metrics(land(boosted.unionByName(forest), "oof"), ["model", *BOARD], "consensus_value", "oof_prediction", "gsis_id"), "oof-metrics")


def publish(run: Run, path: str, season: int) -> tuple[DataFrame, DataFrame]:
    """Write the boards, the search index and the run's metadata below ``path``; return the latter two as written."""
    directory = run.crosswalk.select(F.col("gsis_id").alias("asset_id"), "sleeper_id", "team")
    published = boards.published(run.board, directory)
    write_boards(published, f"{path}/boards")
    index = boards.search_index(published.where((F.col("format") == "sf_dynasty") & (F.col("team_size") == 12)))
    index.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/search_index")
    # Written last, so that a folder with metadata holds whole boards.
    stamp = datetime.now(timezone.utc).isoformat()
    metadata = boards.board_metadata(published, season).withColumn("generated_at", F.lit(stamp))
    metadata.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    read = index.sparkSession.read
    return read.schema(index.schema).json(f"{path}/search_index"), read.schema(metadata.schema).json(f"{path}/metadata")
