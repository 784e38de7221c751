"""Evaluation of scored rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from assetboard.functions.numeric import safe_ratio
from assetboard.operators.ordering import average_rank, prefix_sums, top_per_group, value_levels
from assetboard.operators.quality import unpivot
from assetboard.session import land

# The threshold grids of the churn sweep, the sales table and the delay report.
CHURN_THRESHOLDS = tuple(round(0.10 + 0.05 * i, 2) for i in range(17))
SALES_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)
DELAY_THRESHOLDS = (0.20, 0.30, 0.40, 0.50)


def _ratio0(top: Column, bottom: Column) -> Column:
    return F.coalesce(safe_ratio(top, bottom), F.lit(0.0))


def usable_scores(scored: DataFrame, label: str, score: str) -> DataFrame:
    """The rows that have both a label and a score."""
    return scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())


def threshold_counts(scored: DataFrame, label: str, score: str, thresholds: Sequence[float],
                     keys: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn at every threshold from one pass over the rows.

    Each row is counted once under the number of thresholds it reaches; the counts at a threshold
    are then running sums over that histogram, which has one row more than there are thresholds.
    Rows without a score or a label count nowhere.
    """
    scored = usable_scores(scored, label, score)
    grid = sorted(set(float(t) for t in thresholds))
    reached = reduce(lambda a, b: a + b, [(F.col(score) >= F.lit(t)).cast("int") for t in grid])
    counts = scored.groupBy(*keys, reached.alias("_reached")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    per_key = counts.groupBy(*keys).agg(
        F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"),
        *[F.sum(F.when(F.col("_reached") > i, F.col("_pos")).otherwise(0)).alias(f"_tp{i}") for i in range(len(grid))],
        *[F.sum(F.when(F.col("_reached") > i, F.col("_neg")).otherwise(0)).alias(f"_fp{i}") for i in range(len(grid))],
    )
    cells = F.array(*[
        F.struct(F.lit(t).alias("threshold"), F.col(f"_tp{i}").alias("tp"), F.col(f"_fp{i}").alias("fp"),
                 (F.col("_p") - F.col(f"_tp{i}")).alias("fn"), (F.col("_n") - F.col(f"_fp{i}")).alias("tn"))
        for i, t in enumerate(grid)
    ])
    return per_key.select(*keys, F.inline(cells))


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall, f1 and accuracy; a zero denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "*",
        _ratio0(tp, tp + fp).alias("precision"),
        _ratio0(tp, tp + fn).alias("recall"),
        _ratio0(tp * 2, tp * 2 + fp + fn).alias("f1_score"),
        _ratio0(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )


def threshold_sweep(scored: DataFrame, label: str, score: str, thresholds: Sequence[float],
                    keys: Sequence[str] = ()) -> DataFrame:
    return with_rates(threshold_counts(scored, label, score, thresholds, keys))


def confusion_matrix(scored: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """All four (label, prediction) cells, zero where a cell is empty."""
    counts = threshold_counts(scored, label, score, [threshold])
    cell = lambda y, p, c: F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("n"))
    return counts.select(F.inline(F.array(cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(1, 1, "tp"))))


def classification_report(scored: DataFrame, label: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """Per class and averaged precision, recall, f1 and support at each threshold."""
    c = threshold_counts(scored, label, score, thresholds)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    c = c.select(
        "threshold",
        _ratio0(tn, tn + fn).alias("p0"), _ratio0(tn, tn + fp).alias("r0"), _ratio0(tn * 2, tn * 2 + fn + fp).alias("f0"),
        (tn + fp).alias("s0"),
        _ratio0(tp, tp + fp).alias("p1"), _ratio0(tp, tp + fn).alias("r1"), _ratio0(tp * 2, tp * 2 + fp + fn).alias("f1"),
        (tp + fn).alias("s1"),
        _ratio0(tp + tn, tp + tn + fp + fn).alias("acc"),
    )
    total = F.col("s0") + F.col("s1")

    def line(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.alias("support"))

    macro = [(F.col(f"{m}0") + F.col(f"{m}1")) / 2 for m in "prf"]
    weighted = [_ratio0(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), total) for m in "prf"]
    lines = F.array(
        line("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        line("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        line("accuracy", F.col("acc"), F.col("acc"), F.col("acc"), total),
        line("macro avg", *macro, total),
        line("weighted avg", *weighted, total),
    )
    return c.select("threshold", F.inline(lines))


def roc_auc(scored: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Works on distinct scores; the running count of negatives is a distributed prefix sum and all
    sums are exact decimals.
    """
    keys = list(keys)
    levels = score_levels(scored, label, score, keys)
    sums = levels.groupBy(*keys).agg(*_auc_sums())
    return sums.select(*keys, _auc().alias("roc_auc"))


def score_levels(scored: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives at each distinct score, and the negatives below it."""
    levels = value_levels(
        usable_scores(scored, label, score), list(keys), score,
        {"_pos": F.count_if(F.col(label) == 1), "_neg": F.count_if(F.col(label) == 0)},
    )
    return prefix_sums(levels, list(keys), [F.col(score)], {"_below": "_neg"})


def _auc_sums() -> list[Column]:
    wide = lambda c: c.cast("decimal(19,0)")
    twice = wide(F.col("_pos")) * wide(F.col("_below") * 2 + F.col("_neg"))
    return [F.sum(twice).cast("double").alias("_u2"), F.sum("_pos").cast("double").alias("_p"),
            F.sum("_neg").cast("double").alias("_n")]


def _auc() -> Column:
    return safe_ratio(F.col("_u2"), F.col("_p") * F.col("_n") * 2)


def log_loss(scored: DataFrame, label: str, score: str, keys: Sequence[str] = (), eps: float = 1e-15) -> DataFrame:
    """Mean log loss of the rows that have a label and a score, and how many they are."""
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(score)))
    return usable_scores(scored, label, score).groupBy(*keys).agg(
        (-F.avg(F.when(F.col(label) == 1, F.ln(p)).otherwise(F.ln(1 - p)))).alias("log_loss"),
        F.count("*").alias("n_rows"),
    )


def evaluate(scored: DataFrame, label: str, score: str, threshold: float = 0.5, keys: Sequence[str] = (),
             eps: float = 1e-15) -> DataFrame:
    """A row per key: rates at the threshold, log loss and ROC AUC, from one pass by distinct score."""
    keys = list(keys)
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(score)))
    reached = F.col(score) >= threshold
    counts = {"tp": F.when(reached, F.col("_pos")), "fp": F.when(reached, F.col("_neg")),
              "fn": F.when(~reached, F.col("_pos")), "tn": F.when(~reached, F.col("_neg"))}
    sums = score_levels(scored, label, score, keys).groupBy(*keys).agg(
        *_auc_sums(), *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in counts.items()],
        F.sum(F.col("_pos") * F.ln(p) + F.col("_neg") * F.ln(1 - p)).alias("_log"),
    )
    return with_rates(sums).select(
        *keys, "precision", "recall", "accuracy", "f1_score",
        safe_ratio(-F.col("_log"), F.col("_p") + F.col("_n")).alias("log_loss"), _auc().alias("roc_auc"),
    )


def model_comparison(scored: DataFrame, model: str, label: str, score: str, threshold: float = 0.40) -> DataFrame:
    """AUC and rates at one threshold per model; ``scored`` stacks the models' rows."""
    return evaluate(scored, label, score, threshold, [model]).select(
        model, "roc_auc", "precision", "recall", "f1_score"
    )


def spearman(df: DataFrame, keys: Sequence[str], x: str, y: str, out: str = "spearman") -> DataFrame:
    """Rank correlation with average ties over the complete pairs of each group."""
    # Written once, since both rankings read it twice.
    pairs = land(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, x, y), "pairs")
    ranked = average_rank(average_rank(pairs, keys, x, "_rx"), keys, y, "_ry")
    # A constant side has no correlation; merged partial sums would report rounding noise for it.
    varies = (F.min("_rx") < F.max("_rx")) & (F.min("_ry") < F.max("_ry"))
    return ranked.groupBy(*keys).agg(F.when(varies, F.corr("_rx", "_ry")).alias(out), F.count("*").alias("n_pairs"))


def regression_metrics(df: DataFrame, keys: Sequence[str], truth: str, pred: str, tie: str, top: int = 50) -> DataFrame:
    """Spearman, MAE and MAE of the ``top`` rows by true value, per group."""
    keys = list(keys)
    valid = df.where(F.col(pred).isNotNull())
    error = F.abs(F.col(truth) - F.col(pred))
    whole = valid.groupBy(*keys).agg(F.avg(error).alias("mae"))
    best = top_per_group(valid, keys, [F.desc(truth), F.asc(tie)], top).groupBy(*keys).agg(
        F.avg(error).alias(f"top{top}_mae")
    )
    corr = spearman(valid, keys, truth, pred).drop("n_pairs")
    return corr.join(whole, keys).join(best, keys)


def feature_spearman(df: DataFrame, features: Sequence[str], target: str, min_pairs: int = 10) -> DataFrame:
    """Rank correlation of every feature with the target, strongest first."""
    long = unpivot(df, [target], features, "feature", "v", "double")
    table = spearman(long, ["feature"], "v", target).where(F.col("n_pairs") >= min_pairs)
    return table.orderBy(F.desc(F.abs("spearman")), "feature")
