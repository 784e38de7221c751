"""Data quality, imputation and class preparation."""

from pyspark.sql import functions as F

from assetboard.functions.numeric import grid_round
from assetboard.operators import quality
from assetboard.operators.learning import class_weights, fit_scaler, scale
from assetboard.plans.registry import query, r
from assetboard.session import land
from assetboard.sources.stand_ins import Inputs

# The leakage columns of the delay data and of the sales data that the stand-ins have.
DELAY_LEAKAGE = ["arr_delay_minutes", "cancelled", "diverted", "dep_delay"]
REP_LEAKAGE = ["nps", "feedback", "high_performer"]
REP_IDS = ["rep_id", "name"]
NUMERIC = ["arr_delay_minutes", "arr_del15", "distance", "fare"]
FLOWN = "cancelled = 0 and diverted = 0"
FLIGHT_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "fare", "arr_delay_minutes", "arr_del15", "cancelled",
                  "diverted", "distance", "booked_month", "carrier", "cabin", "sparse_col"]


def flown(t: Inputs):
    return t["flights"].where("cancelled = 0 AND diverted = 0")


@query("dq_profile", """
    select count(*) as total_rows, count(*) filter (where member_id is null) as missing_member_id,
           count(*) filter (where last_visit_date is null) as missing_last_visit_date, count(*) filter (where join_date is null) as missing_join_date,
           count(*) filter (where age is null) as missing_age, min(age) as min_age, max(age) as max_age from @members""")
def dq_profile(t: Inputs):
    names = {c: f"missing_{c}" for c in ("member_id", "last_visit_date", "join_date", "age")}
    return quality.dq_profile(t["members"], names, "age")


@query("missingness", "select * from (" + " union all ".join(
    f"""select '{c}' as column_name, count(*) filter (where {c} is null) as missing_count,
        count(*) filter (where {c} is null) / count(*) as missing_frac, {r(f'count(*) filter (where {c} is null) / count(*) * 100', 2)} as missing_pct from @flights"""
    for c in FLIGHT_COLUMNS) + ") x where missing_count > 0")
def missingness(t: Inputs):
    return quality.missingness(t["flights"])


@query("value_share", "select carrier, count(*) as n, count(*) / (select count(carrier) from @flights) as share from @flights where carrier is not null group by carrier")
def value_share(t: Inputs):
    return quality.value_share(t["flights"], "carrier")


@query("duplicate_keys", """
    select l_orderkey, l_linenumber, count(*) as copies from @flights group by l_orderkey, l_linenumber having count(*) > 1""")
def duplicate_keys(t: Inputs):
    return quality.duplicate_keys(t["flights"], ["l_orderkey", "l_linenumber"])


@query("duplicate_rows", """
    select coalesce(cast(sum(copies - 1) as bigint), 0) as duplicate_rows from (
        select count(*) as copies from (select l_partkey % 50 as part, l_linenumber, carrier from @flights) x group by part, l_linenumber, carrier) y""")
def duplicate_rows(t: Inputs):
    return quality.duplicate_row_count(t["flights"].select((F.col("l_partkey") % 50).alias("part"), "l_linenumber", "carrier"))


@query("dedupe_rows", "select distinct carrier, cabin, l_linenumber, l_partkey % 100 as part from @flights")
def dedupe_rows(t: Inputs):
    return t["flights"].select("carrier", "cabin", "l_linenumber", (F.col("l_partkey") % 100).alias("part")).dropDuplicates()


@query("drop_sparse_columns", f"select * exclude (sparse_col) from @flights where {FLOWN}")
def drop_sparse_columns(t: Inputs):
    kept, _ = quality.drop_sparse_columns(flown(t))
    return kept


@query("drop_leakage", f"select * exclude (arr_delay_minutes, cancelled, diverted) from @flights where {FLOWN}")
def drop_leakage(t: Inputs):
    return quality.drop_listed(flown(t), DELAY_LEAKAGE)


@query("impute", f"""
    with f as (select * from @flights where {FLOWN}),
    m as (select quantile_cont(cast(arr_delay_minutes as double), 0.5) as d, quantile_cont(cast(arr_del15 as double), 0.5) as l,
                 quantile_cont(distance, 0.5) as dist from f),
    c as (select carrier from f where carrier is not null group by carrier order by count(*) desc, carrier limit 1)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(cast(arr_delay_minutes as double), (select d from m)) as arr_delay_minutes,
           coalesce(cast(arr_del15 as double), (select l from m)) as arr_del15, coalesce(distance, (select dist from m)) as distance, fare,
           coalesce(carrier, (select carrier from c)) as carrier, cabin from f""")
def impute(t: Inputs):
    # Written once: fitting reads the rows several times.
    rows = land(flown(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *NUMERIC[:3], "fare", "carrier", "cabin"), "flown")
    fills = quality.fit_imputer(rows, NUMERIC, ["carrier", "cabin"])
    return quality.impute(rows, fills)


@query("target_consistency", """
    select consistent, count(*) as n, count(*) / sum(count(*)) over () as share from (
        select (arr_delay_minutes >= 990) = (arr_del15 = 1) as consistent from @flights where arr_delay_minutes is not null and arr_del15 is not null) x
    group by consistent""")
def target_consistency(t: Inputs):
    return quality.target_consistency(t["flights"], "arr_delay_minutes", "arr_del15", 990)


@query("expectations", """
    select 'not_null(mfl_id)' as rule, cast(count(*) filter (where mfl_id is null) as double) as observed, count(*) filter (where mfl_id is null) = 0 as passed from @crosswalk
    union all select 'not_null(ktc_id)', cast(count(*) filter (where ktc_id is null) as double), count(*) filter (where ktc_id is null) = 0 from @crosswalk
    union all select 'share(has espn)', avg(case when espn_id is not null then 1.0 else 0.0 end), avg(case when espn_id is not null then 1.0 else 0.0 end) >= 0.95 from @crosswalk
    union all select 'unique(mfl_id)', cast(count(*) as double), count(*) = 0 from (select mfl_id from @crosswalk group by mfl_id having count(*) > 1) x
    union all select 'unique(position)', cast(count(*) as double), count(*) = 0 from (select position from @crosswalk group by position having count(*) > 1) x""")
def expectations(t: Inputs):
    return quality.expectations(t["crosswalk"], [
        quality.NotNull("mfl_id"), quality.NotNull("ktc_id"), quality.Share("has espn", F.col("espn_id").isNotNull(), 0.95),
        quality.Unique(("mfl_id",)), quality.Unique(("position",))])


@query("degenerate_features", "select * from (" + " union all ".join(
    f"select '{c}' as feature, count(distinct {c}) < 2 as degenerate from @flights where {FLOWN}" for c in FLIGHT_COLUMNS) + ") x")
def degenerate_features(t: Inputs):
    return quality.degenerate_features(flown(t), FLIGHT_COLUMNS)


@query("quantile_label", """
    with c as (select quantile_cont(nps, 0.8) as n, quantile_cont(cast(feedback as double), 0.8) as f from @reps)
    select rep_id, case when nps >= (select n from c) and feedback >= (select f from c) then 1 else 0 end as high_performer from @reps""")
def quantile_label(t: Inputs):
    return labelled_reps(t).select("rep_id", "high_performer")


def labelled_reps(t: Inputs):
    return quality.quantile_label(land(t["reps"], "reps"), ["nps", "feedback"])


@query("class_weights", f"""
    select arr_del15 as label, count(*) as n, {r('(select count(*) from @flights where arr_del15 is not null) / (2.0 * count(*))')} as weight
    from @flights where arr_del15 is not null group by arr_del15""")
def class_weights_query(t: Inputs):
    rows = t["flights"].where(F.col("arr_del15").isNotNull()).select(F.col("arr_del15").alias("label"))
    return class_weights(rows, "label").withColumn("weight", grid_round(F.col("weight")))


@query("scale_features", f"""
    with s as (select stddev_pop(fare) as f, stddev_pop(distance) as d from @flights where l_orderkey % 10 < 7)
    select l_orderkey, l_linenumber, l_partkey, {r('fare / (select f from s)')} as fare, {r('distance / (select d from s)')} as distance from @flights""")
def scale_features(t: Inputs):
    rows = t["flights"].select("l_orderkey", "l_linenumber", "l_partkey", "fare", "distance")
    scaler = fit_scaler(rows.where(F.col("l_orderkey") % 10 < 7), ["fare", "distance"])
    d = scale(rows, scaler)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", *[grid_round(F.col(c)).alias(c) for c in ("fare", "distance")])
