"""Thresholds, reports and correlations on given scores."""

from pyspark.sql import functions as F

from assetboard.functions.numeric import grid_round
from assetboard.operators import metrics
from assetboard.operators.features import latest_season
from assetboard.plans.registry import query, r
from assetboard.sources.stand_ins import Inputs

GRID = ", ".join(f"({x})" for x in metrics.CHURN_THRESHOLDS)
DELAY_GRID = ", ".join(f"({x})" for x in metrics.DELAY_THRESHOLDS)
COUNTS = """select cast(th.threshold as double) as threshold, count(*) filter (where label = 1 and p >= th.threshold) as tp,
    count(*) filter (where label = 0 and p >= th.threshold) as fp, count(*) filter (where label = 1 and p < th.threshold) as fn,
    count(*) filter (where label = 0 and p < th.threshold) as tn
    from @scored cross join (select cast(t as double) as threshold from (values {grid}) v(t)) th group by th.threshold"""
AUC = """(select (sum(case when label = 1 then rk end) - p * (p + 1) / 2) / (p * n) from (
    select label, rank() over (order by {score}) + (count(*) over (partition by {score}) - 1) / 2.0 as rk,
           cast(count(*) filter (where label = 1) over () as double) as p, cast(count(*) filter (where label = 0) over () as double) as n
    from @scored where label is not null and {score} is not null) z group by p, n)"""


def rounded(df, *keep: str):
    return df.select(*[F.col(c) if c in keep else grid_round(F.col(c)).alias(c) for c in df.columns])


@query("threshold_sweep", f"""
    select threshold, tp, fp, fn, tn, {r('coalesce(tp / nullif(tp + fp, 0), 0)')} as precision, {r('coalesce(tp / nullif(tp + fn, 0), 0)')} as recall,
           {r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} as f1_score, {r('(tp + tn) / (tp + tn + fp + fn)')} as accuracy
    from ({COUNTS.format(grid=GRID)}) c""")
def threshold_sweep(t: Inputs):
    d = metrics.threshold_sweep(t["scored"], "label", "p", metrics.CHURN_THRESHOLDS)
    return rounded(d, "threshold", "tp", "fp", "fn", "tn")


@query("confusion_matrix", """
    with g as (select * from (values (0), (1)) a(label) cross join (values (0), (1)) b(prediction))
    select g.label, g.prediction, count(s.p) as n from g left join (select * from @scored where p is not null) s on s.label = g.label and (case when s.p >= 0.5 then 1 else 0 end) = g.prediction
    group by g.label, g.prediction""")
def confusion_matrix(t: Inputs):
    return metrics.confusion_matrix(t["scored"], "label", "p")


@query("classification_report", f"""
    with c as ({COUNTS.format(grid=DELAY_GRID)}),
    k as (select threshold, coalesce(tn / nullif(tn + fn, 0), 0) as p0, coalesce(tn / nullif(tn + fp, 0), 0) as r0, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) as f0, tn + fp as s0,
                 coalesce(tp / nullif(tp + fp, 0), 0) as p1, coalesce(tp / nullif(tp + fn, 0), 0) as r1, coalesce(2 * tp / nullif(2 * tp + fn + fp, 0), 0) as f1, tp + fn as s1,
                 (tp + tn) / (tp + tn + fp + fn) as acc from c)
    select threshold, '0' as class, {r('p0')} as precision, {r('r0')} as recall, {r('f0')} as f1_score, s0 as support from k
    union all select threshold, '1', {r('p1')}, {r('r1')}, {r('f1')}, s1 from k
    union all select threshold, 'accuracy', {r('acc')}, {r('acc')}, {r('acc')}, s0 + s1 from k
    union all select threshold, 'macro avg', {r('(p0 + p1) / 2')}, {r('(r0 + r1) / 2')}, {r('(f0 + f1) / 2')}, s0 + s1 from k
    union all select threshold, 'weighted avg', {r('(p0 * s0 + p1 * s1) / (s0 + s1)')}, {r('(r0 * s0 + r1 * s1) / (s0 + s1)')}, {r('(f0 * s0 + f1 * s1) / (s0 + s1)')}, s0 + s1 from k""")
def classification_report(t: Inputs):
    return rounded(metrics.classification_report(t["scored"], "label", "p", metrics.DELAY_THRESHOLDS), "threshold", "class", "support")


@query("roc_auc", f"select {r(AUC.format(score='p'), 9)} as roc_auc")
def roc_auc(t: Inputs):
    return metrics.roc_auc(t["scored"], "label", "p").select(grid_round(F.col("roc_auc"), 9).alias("roc_auc"))


LOG_LOSS = "(select -avg(case when label = 1 then ln(greatest(1e-15, least(1 - 1e-15, p))) else ln(1 - greatest(1e-15, least(1 - 1e-15, p))) end) from @scored where label is not null and p is not null)"


@query("log_loss", f"select {r(LOG_LOSS)} as log_loss, (select count(*) from @scored where label is not null and p is not null) as n_rows")
def log_loss(t: Inputs):
    return rounded(metrics.log_loss(t["scored"], "label", "p"), "n_rows")


@query("evaluate", f"""
    select {r('coalesce(tp / nullif(tp + fp, 0), 0)')} as precision, {r('coalesce(tp / nullif(tp + fn, 0), 0)')} as recall,
           {r('(tp + tn) / (tp + tn + fp + fn)')} as accuracy, {r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} as f1_score,
           {r(LOG_LOSS)} as log_loss, {r(AUC.format(score='p'))} as roc_auc
    from ({COUNTS.format(grid='(0.5)')}) c""")
def evaluate(t: Inputs):
    return rounded(metrics.evaluate(t["scored"], "label", "p"))


@query("model_comparison", " union all ".join(f"""
    select '{m}' as model, {r(AUC.format(score=s))} as roc_auc, {r('coalesce(tp / nullif(tp + fp, 0), 0)')} as precision,
           {r('coalesce(tp / nullif(tp + fn, 0), 0)')} as recall, {r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} as f1_score
    from (select count(*) filter (where label = 1 and {s} >= 0.4) as tp, count(*) filter (where label = 0 and {s} >= 0.4) as fp,
                 count(*) filter (where label = 1 and {s} < 0.4) as fn from @scored) c""" for m, s in (("first", "p"), ("second", "p2"))))
def model_comparison(t: Inputs):
    stacked = t["scored"].select("label", F.inline(F.array(
        F.struct(F.lit("first").alias("model"), F.col("p").alias("score")), F.struct(F.lit("second").alias("model"), F.col("p2").alias("score")))))
    return rounded(metrics.model_comparison(stacked, "model", "label", "score"), "model")


AVG_RANK = "rank() over (partition by {by} order by {v}) + (count(*) over (partition by {by}, {v}) - 1) / 2.0"


@query("regression_metrics", f"""
    with x as (select *, {AVG_RANK.format(by='format, team_size', v='consensus_value')} as rt, {AVG_RANK.format(by='format, team_size', v='model_value')} as rp,
                      row_number() over (partition by format, team_size order by consensus_value desc, asset_id) as k from @predictions)
    select format, team_size, {r('corr(rt, rp)', 8)} as spearman, {r('avg(abs(consensus_value - model_value))', 4)} as mae,
           {r('avg(case when k <= 50 then abs(consensus_value - model_value) end)', 4)} as top50_mae
    from x group by format, team_size""")
def regression_metrics(t: Inputs):
    d = metrics.regression_metrics(t["predictions"], ["format", "team_size"], "consensus_value", "model_value", "asset_id")
    return d.select("format", "team_size", grid_round(F.col("spearman"), 8).alias("spearman"),
                    grid_round(F.col("mae"), 4).alias("mae"), grid_round(F.col("top50_mae"), 4).alias("top50_mae"))


FEATURES = ["season", "games", "points", "yards", "share_a", "share_b", "round", "pick", "age_at_draft"]


@query("feature_spearman", f"""
    with m as (select p.*, d.round, d.pick, d.age_at_draft, c.value from (
                 select * from (select *, row_number() over (partition by asset_id order by season desc) as k from @asset_panel) x where k = 1) p
               left join @draft d on p.asset_id = d.asset_id
               join @price_a c on c.true_id = p.asset_id and c.format = 'sf_dynasty' and c.team_size = 12),
    u as ({' union all '.join(f"select '{c}' as feature, cast({c} as double) as v, value from m where {c} is not null" for c in FEATURES)}),
    k as (select feature, {AVG_RANK.format(by='feature', v='v')} as rx, {AVG_RANK.format(by='feature', v='value')} as ry from u),
    s as (select feature, case when var_pop(rx) > 0 then corr(rx, ry) end as c, count(*) as n from k group by feature)
    select feature, {r('c', 8)} as spearman, n as n_pairs from s where n >= 10""")
def feature_spearman(t: Inputs):
    latest = latest_season(t["asset_panel"], "asset_id", "season")
    target = t["price_a"].where("format = 'sf_dynasty' AND team_size = 12").select(F.col("true_id").alias("asset_id"), "value")
    rows = latest.join(t["draft"].drop("position"), "asset_id", "left").join(target, "asset_id")
    d = metrics.feature_spearman(rows, FEATURES, "value")
    return d.withColumn("spearman", grid_round(F.col("spearman"), 8))
