"""Identity resolution, repair, filters and checked joins."""

from pyspark.sql import functions as F

from assetboard.functions.numeric import grid_round, speed_score
from assetboard.functions.text import normalize_name
from assetboard.operators import features, identity
from assetboard.operators.consensus import rank_power_weights
from assetboard.operators.joins import keep_matching, keep_unmatched, safe_left_join
from assetboard.operators.ordering import keep_one
from assetboard.plans.registry import query, r
from assetboard.sources.stand_ins import Inputs

IDS = ["mfl_id", "espn_id", "gsis_id", "ktc_id"]
THREE_KEYS = [identity.Path("src_mfl_id", "mfl_id", "primary"), identity.Path("src_espn_id", "espn_id", "secondary"),
              identity.Path("src_name", "merge_name", "name")]
TWO_KEYS = [identity.Path("src_ktc_id", "ktc_id", "primary"), identity.Path("src_name", "merge_name", "name")]

RESOLVED_A = """
    select a.format, a.team_size, a.true_id, a.value,
           coalesce(m.mfl_id, e.mfl_id, n.mfl_id) as mfl_id, coalesce(m.espn_id, e.espn_id, n.espn_id) as espn_id,
           coalesce(m.gsis_id, e.gsis_id, n.gsis_id) as gsis_id, coalesce(m.ktc_id, e.ktc_id, n.ktc_id) as ktc_id,
           case when m.mfl_id is not null then 'primary' when e.mfl_id is not null then 'secondary'
                when n.mfl_id is not null then 'name' else 'unmatched' end as match_tier
    from @price_a a left join @crosswalk m on a.src_mfl_id = m.mfl_id left join @crosswalk e on a.src_espn_id = e.espn_id
    left join @crosswalk n on a.merge_name = n.merge_name"""


def resolved_a(t: Inputs):
    source = t["price_a"].select("format", "team_size", "true_id", "value", "src_mfl_id", "src_espn_id", "position",
                                 normalize_name(F.col("name")).alias("src_name"))
    return identity.resolve(source, t["crosswalk"], THREE_KEYS, IDS, "mfl_id", [F.asc("mfl_id")])


@query("crosswalk", """
    select mfl_id, espn_id, ktc_id, gsis_id, pfr_id, name, position, merge_name from @crosswalk""")
def crosswalk(t: Inputs):
    return identity.crosswalk(t["crosswalk_raw"], ["mfl_id", "espn_id", "ktc_id"], ["gsis_id", "pfr_id", "name", "position"])


@query("resolve_three_key", RESOLVED_A)
def resolve_three_key(t: Inputs):
    return resolved_a(t).select("format", "team_size", "true_id", "value", *IDS, "match_tier")


@query("resolve_two_key", """
    select b.format, b.true_id, b.value, coalesce(k.ktc_id, n.ktc_id) as ktc_id, coalesce(k.mfl_id, n.mfl_id) as mfl_id,
           coalesce(k.gsis_id, n.gsis_id) as gsis_id, coalesce(k.espn_id, n.espn_id) as espn_id,
           case when k.ktc_id is not null then 'primary' when n.ktc_id is not null then 'name' else 'unmatched' end as match_tier
    from @price_b b left join @crosswalk k on b.src_ktc_id = k.ktc_id left join @crosswalk n on b.merge_name = n.merge_name""")
def resolve_two_key(t: Inputs):
    source = t["price_b"].withColumnRenamed("merge_name", "src_name")
    ids = ["ktc_id", "mfl_id", "gsis_id", "espn_id"]
    return identity.resolve(source, t["crosswalk"], TWO_KEYS, ids, "ktc_id", [F.asc("mfl_id")]).select(
        "format", "true_id", "value", *ids, "match_tier")


@query("bridge_ids", """
    select r.true_id, coalesce(d.player_id, r.player_id) as player_id, r.oneqb_value, d.player_id is not null as bridged
    from @page_redraft r left join @page_dynasty d on r.name = d.name""")
def bridge_ids(t: Inputs):
    rows = t["page_redraft"].select("true_id", "player_id", "oneqb_value", F.concat(F.initcap("name"), F.lit(" II")).alias("name"))
    return identity.bridge_ids(rows, t["page_dynasty"], "player_id", "name", "player_id", "name", [F.asc("player_id")]).drop("name")


@query("draft_capital", """
    select gsis_id, row_id, draft_year, draft_name from (
        select *, row_number() over (partition by gsis_id order by row_id) as k from @draft_raw where gsis_id is not null) x where k = 1""")
def draft_capital(t: Inputs):
    return identity.draft_capital(t["draft_raw"], "gsis_id", [F.asc("row_id")])


@query("repair_ids", r"""
    with base as (select * from (select *, row_number() over (partition by gsis_id order by row_id) as k from @draft_raw where gsis_id is not null) x where k = 1),
    named as (select *, regexp_replace(lower(replace(draft_name, ' Jr.', '')), '[^a-z0-9 ]', '', 'g') as n,
                     not regexp_matches(gsis_id, '^\d{2}-\d{7}$') and draft_year = 2001 as bad from base),
    fixed as (select b.row_id, b.draft_year, b.bad, case when b.bad then coalesce(c.gsis_id, b.gsis_id) else b.gsis_id end as gsis_id
              from named b left join @crosswalk c on b.bad and b.n = c.merge_name)
    select row_id, draft_year, gsis_id, case when not bad then 'kept' when regexp_matches(gsis_id, '^\d{2}-\d{7}$') then 'repaired' else 'unresolved' end as repair
    from fixed""")
def repair_ids(t: Inputs):
    base = identity.draft_capital(t["draft_raw"], "gsis_id", [F.asc("row_id")])
    return identity.repair_ids(base, t["crosswalk"], "gsis_id", "draft_name", "draft_year", 2001, "gsis_id", "name",
                               [F.asc("mfl_id")]).select("row_id", "draft_year", "gsis_id", "repair")


@query("combine_features", f"""
    with hit as (select c.*, coalesce(p.gsis_id, n.gsis_id) as gsis_id from @combine c left join @crosswalk p on c.pfr_id = p.pfr_id
                 left join @crosswalk n on c.merge_name = n.merge_name),
    last as (select *, row_number() over (partition by gsis_id order by draft_year desc, wt desc) as k from hit where gsis_id is not null)
    select gsis_id, forty as forty_time, wt as combine_weight, ht as combine_height,
           {r("case when pos = 'ECONOMY' and forty > 0 then wt * 200 / (forty * forty * forty * forty) end")} as speed_score
    from last where k = 1""")
def combine_features(t: Inputs):
    d = combine_rows(t)
    return d.withColumn("speed_score", grid_round(F.col("speed_score")))


def combine_rows(t: Inputs):
    source = t["combine"].withColumnRenamed("merge_name", "src_name").withColumnRenamed("pfr_id", "src_pfr_id")
    paths = [identity.Path("src_pfr_id", "pfr_id", "primary"), identity.Path("src_name", "merge_name", "name")]
    found = identity.resolve(source, t["crosswalk"], paths, ["gsis_id"], "gsis_id", [F.asc("mfl_id")])
    latest = keep_one(found.where(F.col("gsis_id").isNotNull()), ["gsis_id"], [F.desc("draft_year"), F.desc("wt")])
    return latest.select("gsis_id", F.col("forty").alias("forty_time"), F.col("wt").alias("combine_weight"), F.col("ht").alias("combine_height"),
                         speed_score(F.col("pos"), F.col("wt"), F.col("forty"), runner="ECONOMY").alias("speed_score"))


@query("safe_left_join", "select p.asset_id, p.season, p.points, d.round, d.pick from @asset_panel p left join @draft d on p.asset_id = d.asset_id")
def safe_left_join_query(t: Inputs):
    return safe_left_join(t["asset_panel"].select("asset_id", "season", "points"), t["draft"].select("asset_id", "round", "pick"), ["asset_id"])


@query("training_frame", f"""
    with latest as (select * from (select *, row_number() over (partition by asset_id order by season desc) as k from @asset_panel) x where k = 1),
    target as (select format, team_size, mfl_id as asset_id, value, (rank() over (partition by format, team_size order by value)
                      + (count(*) over (partition by format, team_size, value) - 1) / 2.0) / count(*) over (partition by format, team_size) as pct
               from ({RESOLVED_A}) q where mfl_id is not null)
    select g.format, g.team_size, l.asset_id, l.season, l.points, g.value, {r('1 + pct * pct * pct')} as sample_weight
    from latest l join target g on l.asset_id = g.asset_id""")
def training_frame(t: Inputs):
    target = resolved_a(t).where(F.col("mfl_id").isNotNull()).select("format", "team_size", F.col("mfl_id").alias("asset_id"), "value")
    weighted = rank_power_weights(target, ["format", "team_size"], "value")
    latest = features.latest_season(t["asset_panel"], "asset_id", "season").select("asset_id", "season", "points")
    return weighted.join(latest, "asset_id").withColumn("sample_weight", grid_round(F.col("sample_weight")))


@query("active_ids", f"select distinct gsis_id from ({RESOLVED_A}) q where gsis_id is not null")
def active_ids(t: Inputs):
    return identity.active_ids(resolved_a(t), "gsis_id")


@query("active_universe_filter", f"""
    select p.asset_id, p.season, exists (select 1 from @draft d where d.asset_id = p.asset_id) as drafted from @asset_panel p
    where p.asset_id in (select mfl_id from ({RESOLVED_A}) q where mfl_id is not null)""")
def active_universe_filter(t: Inputs):
    active = resolved_a(t).where(F.col("mfl_id").isNotNull()).select(F.col("mfl_id").alias("asset_id"))
    panel = keep_matching(t["asset_panel"].select("asset_id", "season"), active, "asset_id")
    drafted = keep_matching(panel, t["draft"], "asset_id").withColumn("drafted", F.lit(True))
    return drafted.unionByName(keep_unmatched(panel, t["draft"], {"asset_id": "asset_id"}).withColumn("drafted", F.lit(False)))


@query("topn_coverage", f"""
    with top as (select *, row_number() over (partition by format, team_size order by value desc, true_id) as k from @price_a)
    select format, team_size, count(*) as n_top, count(*) filter (where src_mfl_id in (select mfl_id from @crosswalk)) as matched,
           {r('count(*) filter (where src_mfl_id in (select mfl_id from @crosswalk)) / count(*)')} as coverage,
           count(*) filter (where src_mfl_id in (select mfl_id from @crosswalk)) / count(*) >= 0.95 as passed
    from top where k <= 200 group by format, team_size""")
def topn_coverage(t: Inputs):
    d = identity.topn_coverage(t["price_a"], t["crosswalk"], ["format", "team_size"], "src_mfl_id", "mfl_id", [F.desc("value"), F.asc("true_id")])
    return d.withColumn("coverage", grid_round(F.col("coverage")))


@query("unmatched", f"select format, team_size, true_id from ({RESOLVED_A}) q where match_tier = 'unmatched'")
def unmatched(t: Inputs):
    return identity.unmatched(resolved_a(t)).select("format", "team_size", "true_id")


@query("match_tiers", f"select format, team_size, match_tier, count(*) as n from ({RESOLVED_A}) q group by format, team_size, match_tier")
def match_tiers(t: Inputs):
    return identity.tier_counts(resolved_a(t), ["format", "team_size"])


@query("dedupe_keep", """
    select format, asset_id, first_size, last_size from (
        select format, true_id as asset_id, first_value(team_size) over w as first_size, last_value(team_size) over w as last_size,
               row_number() over (partition by format, true_id order by value, team_size) as k
        from @price_a window w as (partition by format, true_id order by value, team_size rows between unbounded preceding and unbounded following)) x where k = 1""")
def dedupe_keep(t: Inputs):
    keys = ["format", "asset_id"]
    rows = t["price_a"].select("format", F.col("true_id").alias("asset_id"), "team_size", "value")
    first = keep_one(rows, keys, [F.asc("value"), F.asc("team_size")]).select(*keys, F.col("team_size").alias("first_size"))
    last = keep_one(rows, keys, [F.desc("value"), F.desc("team_size")]).select(*keys, F.col("team_size").alias("last_size"))
    return first.join(last, keys)
