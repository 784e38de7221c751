"""Splits, encoders, classifiers and board models on table rows."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from assetboard.operators import boards, learning, marts, metrics, network, picks, quality, refresh, runs
from assetboard.operators.consensus import rank_power_weights
from assetboard.plans.panels import feature_frame, to_date_frame
from assetboard.plans.profiles import labelled_reps
from assetboard.plans.registry import query
from assetboard.session import land, scratch_path
from assetboard.sources.stand_ins import Inputs

BOARD = ["format", "team_size"]
BOARDS = [(f, s) for f in ("sf_dynasty", "oneqb_dynasty", "redraft") for s in (10, 12)]
ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
NUMERIC = ["games", "points", "yards", "share_a", "share_b", "career_games", "seasons_played", "career_ppg", "current_age",
           "current_age_squared", "current_distance_from_peak_age", "round", "pick", "forty_time", "combine_weight", "speed_score",
           "dominator_rating", "breakout_age"]
CATEGORICAL = ["position"]
# The registered queries fit at the library's full defaults, as weekly_run does.
QUERY_SETTINGS = learning.TreeSettings()
# Separate models of groups have larger leaves, a fixed value.
SPLIT_SETTINGS = learning.TreeSettings(min_leaf=20)
DELAY_NUMERIC = ["distance", "fare", "booked_month"]
DELAY_CATEGORICAL = ["carrier", "cabin"]


# --- splits and encoders ------------------------------------------------------------------------

def labelled_flights(t: Inputs):
    return t["flights"].where(F.col("arr_del15").isNotNull()).select(*ROW, F.col("arr_del15").alias("label"), *DELAY_NUMERIC, *DELAY_CATEGORICAL)


def split_flights(t: Inputs):
    return learning.stratified_split(labelled_flights(t), "label", [*ROW, "fare"], learning.DELAY_SPLIT)


@query("stratified_split")
def stratified_split(t: Inputs):
    return split_flights(t)


@query("stratified_split_sizes", """
    with c as (select arr_del15 as label, count(*) as n from @flights where arr_del15 is not null group by arr_del15)
    select label, 'train' as split, cast(floor(n * 0.7::double + 0.5) as bigint) as n from c
    union all select label, 'val', cast(floor(n * (0.7::double + 0.15::double) + 0.5) - floor(n * 0.7::double + 0.5) as bigint) from c
    union all select label, 'test', cast(n - floor(n * (0.7::double + 0.15::double) + 0.5) as bigint) from c""")
def stratified_split_sizes(t: Inputs):
    return split_flights(t).groupBy("label", "split").agg(F.count("*").alias("n"))


@query("exact_sample")
def exact_sample(t: Inputs):
    return learning.exact_sample(labelled_flights(t), 3000, [*ROW, "fare"])


@query("exact_sample_size", "select least(3000, count(*)) as n, least(3000, count(*)) as n_known from @flights where arr_del15 is not null")
def exact_sample_size(t: Inputs):
    sample = learning.exact_sample(labelled_flights(t), 3000, [*ROW, "fare"])
    return sample.agg(F.count("*").alias("n"), F.count("label").alias("n_known"))


@query("fold_sizes", """
    with c as (select format, team_size, count(*) as n from @price_a group by format, team_size), f as (select * from (values (0), (1), (2), (3), (4), (5), (6), (7), (8), (9)) v(fold))
    select format, team_size, fold, cast(n // 10 + case when fold < n % 10 then 1 else 0 end as bigint) as n from c cross join f""")
def fold_sizes(t: Inputs):
    rows = t["price_a"].select(*BOARD, "true_id")
    return learning.assign_folds(rows, ["true_id"], 10, BOARD).groupBy(*BOARD, "fold").agg(F.count("*").alias("n"))


@query("one_hot", """
    select c_custkey as rep_id, case c_mktsegment {known} else '0,0,0,0,0' end as encoded, case c_mktsegment {first} end as drop_first
    from @customer""".replace("{known}", " ".join(f"when '{s}' then '{c}'" for s, c in (
        ("AUTOMOBILE", "1,0,0,0,0"), ("BUILDING", "0,1,0,0,0"), ("FURNITURE", "0,0,1,0,0"), ("HOUSEHOLD", "0,0,0,1,0"), ("MACHINERY", "0,0,0,0,1"))))
    .replace("{first}", " ".join(f"when '{s}' then '{c}'" for s, c in (
        ("AUTOMOBILE", "0,0,0,0"), ("BUILDING", "0,0,0,1"), ("FURNITURE", "0,0,1,0"), ("HOUSEHOLD", "0,1,0,0"), ("MACHINERY", "1,0,0,0")))))
def one_hot(t: Inputs):
    rows = t["customer"].select(F.col("c_custkey").alias("rep_id"), "c_mktsegment")
    both = learning.encoder(rows, [], ["c_mktsegment"]).transform(rows).select("rep_id", "c_mktsegment", F.col("features").alias("all"))
    both = learning.encoder(both, [], ["c_mktsegment"], drop_first=True).transform(both)
    text = lambda c: F.array_join(F.transform(vector_to_array(c), lambda x: x.cast("int").cast("string")), ",")
    return both.select("rep_id", text("all").alias("encoded"), text("features").alias("drop_first"))


# --- classifiers --------------------------------------------------------------------------------

def delay_frames(t: Inputs, vector: bool = True):
    """Imputed, encoded and class-weighted train and validation rows; everything is fitted on train.

    The split rows are written; what follows is columns over them, cheaper to make again than to write and read.
    """
    rows = land(split_flights(t), "delay")
    train = rows.where("split = 'train'")
    fills = quality.fit_imputer(train, DELAY_NUMERIC, DELAY_CATEGORICAL)
    train, validation = (quality.impute(rows.where(F.col("split") == s), fills) for s in ("train", "val"))
    model = learning.encoder(train, DELAY_NUMERIC, DELAY_CATEGORICAL)
    keep = [*ROW, "label", "features"]
    weighted = learning.with_class_weights(train, "label")
    return model.transform(weighted, vector).select(*keep, "class_weight"), model.transform(validation, vector).select(*keep)


@query("fit_logistic")
def fit_logistic(t: Inputs):
    train, validation = delay_frames(t)
    scored = None
    for name, weight in (("plain", None), ("balanced", "class_weight")):
        model = learning.fit_logistic(train, "label", weight)
        part = learning.positive_probability(model.transform(validation)).select(F.lit(name).alias("model"), *ROW, "label", "score")
        scored = part if scored is None else scored.unionByName(part)
    return scored


@query("fit_mlp")
def fit_mlp(t: Inputs):
    train, validation = delay_frames(t, vector=False)
    model, _ = network.fit_network(train, validation, "label", ROW, "class_weight", seed=learning.SEED)
    return model.score(validation).select(*ROW, "label", "score")


@query("fit_sales")
def fit_sales(t: Inputs):
    reps = labelled_reps(t)
    rows = land(learning.stratified_split(quality.drop_listed(reps, ["nps", "feedback"]), "high_performer", ["rep_id"], learning.SALES_SPLIT, seed=13), "reps")
    train = rows.where("split = 'train'")
    model = learning.encoder(train, ["age", "years"], ["business", "nation"], scaled=False)
    weighted = learning.with_class_weights(model.transform(train), "high_performer")
    fitted = learning.fit_logistic(weighted, "high_performer", "class_weight")
    scored = learning.positive_probability(fitted.transform(model.transform(rows.where("split = 'test'"))))
    return metrics.threshold_sweep(scored, "high_performer", "score", metrics.SALES_THRESHOLDS)


CHURN_NUMERIC = ["tenure_days", "age", "avg_daily_temperature_c", "avg_daily_wind_speed_kph", "avg_daily_relative_humidity", "day_proportion"]
CHURN_SPLIT = {"train": 0.8, "test": 0.2}


def churn_model(t: Inputs):
    """A fit on the training members, and the held-out members scored by it; fill values come from training too."""
    rows = marts.member_weather(marts.curated_members(t["members"]), t["weather"])
    rows = rows.select("member_id", "churn_label", *[F.col(c).cast("double").alias(c) for c in CHURN_NUMERIC], "gender", "membership_type")
    rows = land(learning.stratified_split(rows.where(F.col("churn_label").isNotNull()), "churn_label", ["member_id"], CHURN_SPLIT), "churn")
    train = rows.where("split = 'train'")
    fills = quality.fit_imputer(train, CHURN_NUMERIC, ["gender", "membership_type"])
    train, test = quality.impute(train, fills), quality.impute(rows.where("split = 'test'"), fills)
    coded = learning.encoder(train, CHURN_NUMERIC, ["gender", "membership_type"], scaled=False)
    encoded = coded.transform(train)
    model = learning.fit_logistic(encoded, "churn_label", c=None)
    return model, learning.feature_names(encoded), land(
        learning.positive_probability(model.transform(coded.transform(test))).select("member_id", "churn_label", "score"), "churn-scored")


@query("feature_weights")
def feature_weights(t: Inputs):
    """Weights of the numeric features, per unit of the feature."""
    model, names, _ = churn_model(t)
    return learning.weights_table(model, names, t.spark, CHURN_NUMERIC)


@query("churn_sweep")
def churn_sweep(t: Inputs):
    """Rates of the held-out members at every threshold, beside their log loss and area under the curve."""
    _, _, scored = churn_model(t)
    whole = metrics.evaluate(scored, "churn_label", "score")
    sweep = metrics.threshold_sweep(scored, "churn_label", "score", metrics.CHURN_THRESHOLDS)
    return sweep.withColumns({c: whole.select(c).scalar() for c in ("log_loss", "roc_auc")})


@query("churn_evaluate")
def churn_evaluate(t: Inputs):
    return metrics.evaluate(churn_model(t)[2], "churn_label", "score")


@query("fitted_comparison")
def fitted_comparison(t: Inputs):
    """The plain and the balanced delay model on the same validation rows, at 0.40."""
    return metrics.model_comparison(fit_logistic(t), "model", "label", "score", 0.40)


# --- board models -------------------------------------------------------------------------------

def training(t: Inputs):
    """Features and weighted targets of every board, written once since every fit reads them."""
    feats = land(feature_frame(t).drop("college"), "features")
    targets = rank_power_weights(t["price_a"].select(*BOARD, F.col("true_id").alias("asset_id"), F.col("value").alias("consensus_value")), BOARD, "consensus_value")
    return feats, land(targets.join(feats.select("asset_id"), "asset_id"), "targets")


def training_rows(t: Inputs):
    feats, targets = training(t)
    return targets.join(feats, "asset_id")


#: What a fit is told: target, weight, features, ids and sizes.
FIT = ("consensus_value", "sample_weight", NUMERIC, CATEGORICAL, ["asset_id"], QUERY_SETTINGS)


def fitted(t: Inputs):
    feats, targets = training(t)
    return feats, targets, learning.fit_boards(targets.join(feats, "asset_id"), BOARD, *FIT)


@query("fit_board_gbt")
def fit_board_gbt(t: Inputs):
    feats, targets, fits = fitted(t)
    return learning.predict_boards(feats, targets, fits, "asset_id")


@query("fit_board_rows", """
    select format, team_size, count(*) as n_rows, count(distinct true_id) as n_assets, count(*) as n_priced, true as better_than_mean
    from @price_a where true_id in (select asset_id from @asset_panel) or true_id in (select asset_id from @draft where draft_year = 2002)
    group by format, team_size""")
def fit_board_rows(t: Inputs):
    """Every asset of a board has one price, and held-out prices err less than the board's mean price does."""
    rows = land(learning.out_of_fold(training_rows(t), BOARD, *FIT), "oof")
    log, guess = F.ln("consensus_value"), F.ln("oof_prediction")
    # Mean squared distance of the logs from the log of the mean price, which is above the mean of the logs.
    of_mean = F.var_pop(log) + (F.ln(F.avg("consensus_value")) - F.avg(log)) ** 2
    return rows.groupBy(*BOARD).agg(
        F.count("*").alias("n_rows"), F.countDistinct("asset_id").alias("n_assets"), F.count("oof_prediction").alias("n_priced"),
        (F.avg((log - guess) ** 2) < of_mean).alias("better_than_mean"))


@query("fit_board_rf")
def fit_board_rf(t: Inputs):
    return learning.fit_forests(training_rows(t), BOARD, *FIT)


@query("fit_quantile")
def fit_quantile(t: Inputs):
    """Weighted share of held-out targets at or below the predicted quantile, per board."""
    scored = learning.out_of_fold(training_rows(t), BOARD, *FIT, spec=learning.BOARD_SPECS[1])
    below = F.when(F.col("consensus_value") <= F.col("oof_prediction"), F.col("sample_weight")).otherwise(0.0)
    return scored.groupBy(*BOARD).agg(F.count("*").alias("n"), (F.sum(below) / F.sum("sample_weight")).alias("weighted_share_below"))


def out_of_fold(t: Inputs):
    return learning.out_of_fold(training_rows(t), BOARD, *FIT)


@query("oof_predictions")
def oof_predictions(t: Inputs):
    return out_of_fold(t)


@query("oof_coverage", """
    select format, team_size, count(*) as n_rows, count(*) as n_assets, count(*) as n_predicted from @price_a
    where true_id in (select asset_id from @asset_panel) or true_id in (select asset_id from @draft where draft_year = 2002) group by format, team_size""")
def oof_coverage(t: Inputs):
    """Every asset of a board is predicted exactly once."""
    return out_of_fold(t).groupBy(*BOARD).agg(
        F.count("*").alias("n_rows"), F.countDistinct("asset_id").alias("n_assets"),
        F.count_if(F.col("oof_prediction") > 0).alias("n_predicted"))


@query("oof_metrics")
def oof_metrics(t: Inputs):
    return metrics.regression_metrics(land(out_of_fold(t), "oof"), BOARD, "consensus_value", "oof_prediction", "asset_id")


@query("fit_split_groups")
def fit_split_groups(t: Inputs):
    _, scored = learning.fit_groups(training_rows(t), BOARD, "position", "ECONOMY", "consensus_value", None, *FIT[2:5], SPLIT_SETTINGS)
    return scored.select(*BOARD, "asset_id", "fit_group", "is_rookie", "model_value", "consensus_value", "oof_prediction", "forest_prediction")


@query("split_group_metrics")
def split_group_metrics(t: Inputs):
    """Out-of-fold errors of the separate models: per group, and pooled."""
    return learning.group_metrics(training_rows(t), BOARD, "position", "ECONOMY", "consensus_value", None, *FIT[2:5], SPLIT_SETTINGS)


REFRESHED = ["games", "points", "yards", "share_a"]


def stored(t: Inputs) -> runs.StoredRun:
    """A run fitted, stored, and read back as a later session would."""
    feats, targets, fits = fitted(t)
    names = t["crosswalk"].select(F.col("mfl_id").alias("asset_id"), "name")
    universe = land(picks.pick_universe(t["pick_list_a"], t["pick_list_b"]), "picks")
    board = refresh.recompute_board(feats, None, fits, targets, names, universe, "asset_id", REFRESHED)
    folder = scratch_path(t.spark, "runs")
    runs.save_run(folder, "1", fits, features=feats, targets=targets, picks=universe, names=names, board=board)
    return runs.load_run(t.spark, folder)


def refreshed(t: Inputs, run: runs.StoredRun, through_week: int | None):
    partial = None if through_week is None else to_date_frame(t, through_week).drop("ppg")
    return refresh.recompute_board(run.features, partial, run.fits, run.targets, run.names, run.picks, "asset_id", REFRESHED)


@query("recompute_board")
def recompute_board(t: Inputs):
    return refreshed(t, stored(t), 10).select(*BOARD, "asset_id", "name", "asset_type", "model_value", "consensus_value", "board_rank")


@query("rescore", """
    select format, team_size, count(*) + case when format = 'redraft' then 0 else 27 end as n_assets, 0::bigint as n_moved from @price_a
    where true_id in (select asset_id from @asset_panel) or true_id in (select asset_id from @draft where draft_year = 2002) group by format, team_size""")
def rescore(t: Inputs):
    """Models read back from storage move nothing on unchanged features, against the board stored at fit time."""
    run = stored(t)
    return boards.board_movement(run.board, refreshed(t, run, None), more_than=0.0)


@query("refresh_movement")
def refresh_movement(t: Inputs):
    run = stored(t)
    return boards.board_movement(run.board, refreshed(t, run, 10))
