"""Splits, encoders, linear classifiers, and the fits and out-of-fold predictions of all boards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from assetboard.operators.boosting import BoostedBoards, BoostSettings, Spec, fit_boosted_boards
from assetboard.operators.forest import beside, forest_predictions
from assetboard.operators.metrics import regression_metrics
from assetboard.operators.ordering import hash_parts, hash_positions
from assetboard.session import land

# Seed, folds, leaf size, quantile of assets without history.
SEED = 474
FOLDS = 10
MIN_LEAF = 10
RISK_QUANTILE = 0.35
DELAY_SPLIT = {"train": 0.70, "val": 0.15, "test": 0.15}
SALES_SPLIT = {"train": 0.75, "test": 0.25}


# --- splits and weights -------------------------------------------------------------------------

def stratified_split(df: DataFrame, label: str, ids: Sequence[str], shares: Mapping[str, float], seed: int = SEED,
                     out: str = "split") -> DataFrame:
    """Exact class shares per split (to the row), the same on every run.

    The rows are counted by hash before they are dealt, so they are written once; dealing shuffles only the rows
    next to a border between two splits.
    """
    def part(at: Column, size: Column) -> Column:
        upto, split, names = 0.0, None, list(shares)
        for name in names[:-1]:
            upto += shares[name]
            inside = at < F.floor(size * F.lit(upto) + 0.5)
            split = F.when(inside, name) if split is None else split.when(inside, name)
        return F.lit(names[-1]) if split is None else split.otherwise(F.lit(names[-1]))

    return hash_parts(land(df, "split"), [label], ids, seed, part, out)


def exact_sample(df: DataFrame, n: int, ids: Sequence[str], seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows when there are fewer)."""
    return hash_positions(df, [], ids, seed, "_at", "_size").where(F.col("_at") < n).drop("_at", "_size")


def assign_folds(df: DataFrame, ids: Sequence[str], k: int = FOLDS, keys: Sequence[str] = (), seed: int = SEED,
                 out: str = "fold") -> DataFrame:
    """Shuffled folds whose sizes differ by at most one; small groups get one fold per row."""
    placed = hash_positions(df, keys, ids, seed, "_at", "_size")
    return placed.withColumn(out, F.pmod("_at", F.least(F.col("_size"), F.lit(k))).cast("int")).drop("_at", "_size")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").cast("double") / F.count("*")).scalar()
    return counts.withColumn("weight", total / F.col("n"))


def with_class_weights(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Weights as a literal per class; the classes are few and read back once."""
    found = {row[label]: row["weight"] for row in class_weights(df, label).collect()}
    weight = None
    for value, w in found.items():
        hit = F.col(label) == value
        weight = F.when(hit, F.lit(w)) if weight is None else weight.when(hit, F.lit(w))
    return df.withColumn(out, weight if weight is not None else F.lit(1.0))


# --- encoders -----------------------------------------------------------------------------------

def fit_scaler(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Population standard deviation per column, 1 for a constant column."""
    row = train.agg(*[F.stddev_pop(c).alias(f"_s{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[i] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, deviations: Mapping[str, float]) -> DataFrame:
    """Unit variance without centring."""
    return df.select(*[(F.col(c) / F.lit(deviations[c])).alias(c) if c in deviations else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class Encoder:
    """Slots of a feature vector: numbers over their deviations, then one slot per category, all as plain columns."""

    deviations: Mapping[str, float]
    #: The categories of each column that have a slot, in order.
    slots: Mapping[str, Sequence[str]]
    #: Categories without a slot that are no error; ``None`` where any value may come.
    left_out: Mapping[str, Sequence[str]] | None = None
    out: str = "features"

    def transform(self, df: DataFrame, vector: bool = True) -> DataFrame:
        """``df`` with its features, as a vector or as an array of doubles; a missing number is an error."""
        values, names = [], []
        for c, deviation in self.deviations.items():
            number = F.col(c).cast("double")
            wrong = F.raise_error(F.lit(f"missing number in {c}")).cast("double")
            values.append(F.when(number.isNull() | F.isnan(number), wrong).otherwise(number / F.lit(float(deviation))))
            names.append(f"s_{c}")
        numbers = len(names)
        for c, labels in self.slots.items():
            text = F.col(c).cast("string")
            known = F.lit(0.0)
            if self.left_out is not None:
                wrong = F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), F.coalesce(text, F.lit("null")))).cast("double")
                known = F.when(text.isin([*labels, *self.left_out[c]]), F.lit(0.0)).otherwise(wrong)
            values += [F.when(text == F.lit(label), F.lit(1.0)).otherwise(known) for label in labels]
            names += [f"h_{c}_{label}" for label in labels]
        attributes = [{"idx": i, "name": name} for i, name in enumerate(names)]
        kinds = {kind: found for kind, found in (("numeric", attributes[:numbers]), ("binary", attributes[numbers:])) if found}
        array = F.array(*values).cast("array<double>")
        return df.select("*", (array_to_vector(array) if vector else array).alias(
            self.out, metadata={"ml_attr": {"attrs": kinds, "num_attrs": len(names)}}))


def encoder(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], drop_first: bool = False,
            out: str = "features", scaled: bool = True) -> Encoder:
    """Numeric columns, scaled to unit variance unless told otherwise, next to one-hot categories.

    Unknown categories become all zeros; ``drop_first`` leaves out the alphabetically first category
    instead and knows no unknowns.
    """
    deviations = fit_scaler(train, numeric) if numeric and scaled else {c: 1.0 for c in numeric}
    found: dict = {c: [] for c in categorical}
    if categorical:
        sets = train.agg(*[F.collect_set(F.col(c).cast("string")).alias(f"_c{i}") for i, c in enumerate(categorical)]).first()
        found = {c: sorted(sets[i], reverse=drop_first) for i, c in enumerate(categorical)}
    if drop_first:
        return Encoder(deviations, {c: labels[:-1] for c, labels in found.items()}, {c: labels[-1:] for c, labels in found.items()}, out)
    return Encoder(deviations, found, None, out)


def feature_names(encoded: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's slots from its metadata."""
    attributes = encoded.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group)
    return [name.removeprefix("s_").removeprefix("h_") for _, name in slots]


# --- classifiers --------------------------------------------------------------------------------

def fit_logistic(train: DataFrame, label: str, weight: str | None = None, c: float | None = 1.0, features: str = "features",
                 max_iter: int = 100):
    """L2 logistic regression with inverse strength ``c`` on the summed loss; ``c=None`` is unpenalised.

    Without a penalty the solver may scale inside, which changes no coefficient but its convergence.
    """
    penalty = 0.0
    if c is not None:
        total = train.agg(F.sum(weight) if weight else F.count("*")).first()[0]
        penalty = 1.0 / (c * float(total))
    model = LogisticRegression(featuresCol=features, labelCol=label, regParam=penalty, elasticNetParam=0.0,
                               standardization=c is None, maxIter=max_iter)
    return (model.setWeightCol(weight) if weight else model).fit(train)


def positive_probability(scored: DataFrame, out: str = "score") -> DataFrame:
    return scored.withColumn(out, F.get(vector_to_array("probability"), F.lit(1)))


def weights_table(model, names: Sequence[str], spark, keep: Sequence[str] | None = None) -> DataFrame:
    """Coefficient per feature with the intercept, largest absolute weight first; ``keep`` names the features shown."""
    rows = [*zip(names, (float(v) for v in model.coefficients)), ("__INTERCEPT__", float(model.intercept))]
    rows = [r for r in rows if keep is None or r[0] in keep or r[0] == "__INTERCEPT__"]
    return spark.createDataFrame(rows, "processed_input string, weight double").orderBy(F.desc(F.abs("weight")), "processed_input")


# --- board regressors ---------------------------------------------------------------------------

@dataclass(frozen=True)
class TreeSettings:
    """Sizes of the tree fits. The defaults are full fits; smaller ones must be asked for."""

    iterations: int = 100
    depth: int = 5
    step: float = 0.1
    #: Trees of the comparison forest, which are grown until their leaves are pure.
    trees: int = 300
    min_leaf: int = MIN_LEAF
    seed: int = SEED


#: The models of every board: the mean, and the quantile for assets without history.
BOARD_SPECS = (Spec(), Spec("quantile", RISK_QUANTILE))


@dataclass
class BoardFits:
    """Fitted models of all boards, for the assets they were fitted on or for changed features later."""

    models: BoostedBoards

    def predict(self, features: DataFrame, history: str = "career_games") -> DataFrame:
        """Mean prediction, quantile prediction, and the one that counts: the quantile without history."""
        both = self.models.score(features, {"_log_mean": 0, "_log_low": 1})
        both = both.withColumn("mean_prediction", F.exp("_log_mean")).withColumn("quantile_prediction", F.exp("_log_low"))
        return final_prediction(both.drop("_log_mean", "_log_low"), history)

    def save(self, path: str, spark) -> None:
        self.models.save(path, spark)

    @classmethod
    def load(cls, path: str, spark) -> "BoardFits":
        return cls(BoostedBoards.load(path, spark))


def final_prediction(df: DataFrame, history: str = "career_games") -> DataFrame:
    rookie = F.col(history).isNull()
    return df.withColumn("is_rookie", rookie).withColumn(
        "model_value", F.when(rookie, F.col("quantile_prediction")).otherwise(F.col("mean_prediction")))


def rookie_discount(predictions: DataFrame, boards: Sequence[str]) -> DataFrame:
    """Average percent by which the quantile lowers the prediction of assets without history."""
    cut = F.lit(1.0) - F.col("quantile_prediction") / F.col("mean_prediction")
    return predictions.where(F.col("is_rookie")).groupBy(*boards).agg(
        F.count("*").alias("n_rookies"), (F.avg(cut) * 100).alias("mean_discount_pct"))


def fit_rows(train: DataFrame, keys: Sequence[str], ids: Sequence[str], target: str, weight: str | None, numeric: Sequence[str],
             categorical: Sequence[str], more: Sequence[str] = ()) -> DataFrame:
    """The columns that fits read, with the log target, written once."""
    named = dict.fromkeys([*keys, *ids, target, *([weight] if weight else []), *numeric, *categorical, *more])
    return land(train.select(*named, F.ln(target).alias("_log_target")), "fit-rows")


def boosted(rows: DataFrame, keys, ids, weight, numeric, categorical, specs, settings: TreeSettings, fold: str | None = None,
            drop_constant: bool = False) -> BoostedBoards:
    sizes = BoostSettings(settings.iterations, settings.depth, settings.step, settings.min_leaf)
    return fit_boosted_boards(rows, keys, ids, "_log_target", weight, numeric, categorical, specs, sizes, fold, drop_constant=drop_constant)


def fit_boards(train: DataFrame, keys: Sequence[str], target: str, weight: str | None, numeric: Sequence[str],
               categorical: Sequence[str], ids: Sequence[str], settings: TreeSettings = TreeSettings()) -> BoardFits:
    """Mean and quantile models of every board on the log target, all in lock-step. No ``keys`` make one board."""
    rows = fit_rows(train, keys, ids, target, weight, numeric, categorical)
    return BoardFits(boosted(rows, keys, ids, weight, numeric, categorical, BOARD_SPECS, settings))


def out_of_fold(train: DataFrame, keys: Sequence[str], target: str, weight: str | None, numeric: Sequence[str],
                categorical: Sequence[str], ids: Sequence[str], settings: TreeSettings = TreeSettings(), k: int = FOLDS,
                spec: Spec = Spec(), out: str = "oof_prediction") -> DataFrame:
    """Keys, ids, target, weight and fold of every row, and its prediction by a model of its board that has not seen it.

    Folds are a dimension of the fit: all boards and folds grow together. Boards of one row have no folds and no rows here.
    """
    rows = fit_rows(train, keys, ids, target, weight, numeric, categorical)
    placed = hash_positions(rows, keys, ids, settings.seed, "_at", "_size").where("_size > 1")
    folded = land(placed.withColumn("fold", F.pmod("_at", F.least(F.col("_size"), F.lit(k))).cast("int")).drop("_at", "_size"), "folds")
    specs = [replace(spec, held_out=i) for i in range(k)]
    models = boosted(folded, keys, ids, weight, numeric, categorical, specs, settings, "fold")
    kept = dict.fromkeys([*keys, *ids, target, *([weight] if weight else []), "fold"])
    return models.score(folded, {"_log": 0}, "fold").select(*kept, F.exp("_log").alias(out))


def predict_boards(features: DataFrame, members: DataFrame, fits: BoardFits, asset: str, history: str = "career_games") -> DataFrame:
    """Score every board's assets (``members``: board keys and asset) by the board's own models."""
    scored = fits.predict(members.join(features, asset), history)
    return scored.select(*members.columns, "mean_prediction", "quantile_prediction", "is_rookie", "model_value")


def fit_forests(train: DataFrame, keys: Sequence[str], target: str, weight: str | None, numeric: Sequence[str], categorical: Sequence[str],
                ids: Sequence[str], settings: TreeSettings = TreeSettings(), k: int | None = None, out: str = "model_value") -> DataFrame:
    """Keys, ids, target and the comparison forest's prediction of every row; with ``k`` folds, out of fold."""
    rows = fit_rows(train, keys, ids, target, weight, numeric, categorical)
    if k:
        placed = hash_positions(rows, keys, ids, settings.seed, "_at", "_size").where("_size > 1")
        rows = land(placed.withColumn("fold", F.pmod("_at", F.least(F.col("_size"), F.lit(k))).cast("int")).drop("_at", "_size"), "folds")
    found = forest_predictions(rows, keys, ids, "_log_target", weight, numeric, categorical, settings.trees, settings.seed,
                               fold="fold" if k else None, out="_log")
    named = list(dict.fromkeys([*keys, *ids]))
    return rows.select(*named, target).join(found.select(*named, F.exp("_log").alias(out)), named)


def with_group(df: DataFrame, group: str, value: str, out: str = "fit_group") -> DataFrame:
    return df.withColumn(out, F.when(F.col(group) == value, F.lit(value)).otherwise(F.lit("rest")))


def fit_groups(train: DataFrame, keys: Sequence[str], group: str, value: str, target: str, weight: str | None, numeric, categorical,
               ids: Sequence[str], settings: TreeSettings = TreeSettings(), k: int = FOLDS) -> tuple[BoardFits, DataFrame]:
    """Separate models for one group of each board and for the rest: the fits, and the rows scored by them and out of fold.

    The group is one more key, so its models are boards of their own. A feature with fewer than two known values in a
    group is none of its models'. ``oof_prediction`` and ``forest_prediction`` are by a boosted model and a comparison
    forest of the group that have not seen the row's fold; null in groups of one row.
    """
    keys = [*keys, "fit_group"]
    # The columns of the table stay; what is added is named apart from them.
    rows = fit_rows(with_group(train, group, value), keys, ids, target, weight, numeric, categorical, [c for c in train.columns if c != "fit_group"])
    fold = F.when(F.col("_size") > 1, F.pmod("_at", F.least(F.col("_size"), F.lit(k))).cast("int"))
    folded = land(hash_positions(rows, keys, ids, settings.seed, "_at", "_size").withColumn("_fold_of", fold).drop("_at", "_size"), "folds")
    fits = BoardFits(boosted(folded, keys, ids, weight, numeric, categorical, BOARD_SPECS, settings, drop_constant=True))
    specs = [Spec(held_out=i) for i in range(k)]
    held = boosted(folded, keys, ids, weight, numeric, categorical, specs, settings, "_fold_of", drop_constant=True)
    forests = forest_predictions(folded.where(F.col("_fold_of").isNotNull()), keys, ids, "_log_target", weight, numeric, categorical,
                                 settings.trees, settings.seed, fold="_fold_of", out="_log_forest")
    scored = beside(held.score(fits.predict(folded), {"_log_oof": 0}, "_fold_of"), forests, list(dict.fromkeys([*keys, *ids])))
    scored = scored.withColumn("oof_prediction", F.exp("_log_oof")).withColumn("forest_prediction", F.exp("_log_forest"))
    return fits, scored.drop("_log_target", "_fold_of", "_log_oof", "_log_forest")


def group_metrics(train: DataFrame, keys: Sequence[str], group: str, value: str, target: str, weight: str | None, numeric, categorical,
                  ids: Sequence[str], settings: TreeSettings = TreeSettings(), k: int = FOLDS) -> DataFrame:
    """Out-of-fold metrics of separate models: per board and group, and pooled over a board's groups."""
    scored = land(out_of_fold(with_group(train, group, value), [*keys, "fit_group"], target, weight, numeric, categorical, ids, settings, k), "oof-groups")
    parts = scored.unionByName(scored.withColumn("fit_group", F.lit("pooled")))
    return regression_metrics(land(parts, "oof-parts"), [*keys, "fit_group"], target, "oof_prediction", ids[0])
