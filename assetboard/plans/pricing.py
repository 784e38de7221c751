"""Consensus prices, draft picks and training weights."""

from pyspark.sql import functions as F

from assetboard.functions.numeric import grid_round
from assetboard.functions.text import normalize_name
from assetboard.operators import consensus, identity, picks
from assetboard.operators.boards import ranked
from assetboard.plans.identity import RESOLVED_A, TWO_KEYS, resolved_a
from assetboard.plans.registry import query, r
from assetboard.session import land
from assetboard.sources.stand_ins import Inputs

BOARD = ["format", "team_size"]


def blend_sql(a: str, b: str) -> str:
    """Oracle of the blend: ``a`` gives format, team_size, asset_id, value; ``b`` gives format, asset_id, value."""
    pct = "(rank() over (partition by {by} order by value) + (count(*) over (partition by {by}, value) - 1) / 2.0) / count(*) over (partition by {by})"
    return f"""
        select p.format, p.team_size, p.asset_id, p.value, p.pct_a, b.pct_b, p.blended, lo.value + (hi.value - lo.value) * (p.pos - floor(p.pos)) as consensus_value
        from (select x.*, y.pct_b as pb, 0.35 * coalesce(y.pct_b, x.pct_a) + 0.65 * x.pct_a as blended,
                     least(1.0, 0.35 * coalesce(y.pct_b, x.pct_a) + 0.65 * x.pct_a) * (n - 1) as pos
              from (select *, {pct.format(by='format, team_size')} as pct_a, count(*) over (partition by format, team_size) as n from ({a}) a0) x
              left join (select format, asset_id, {pct.format(by='format')} as pct_b from ({b}) b0) y on x.format = y.format and x.asset_id = y.asset_id) p
        left join (select format, asset_id, {pct.format(by='format')} as pct_b from ({b}) b1) b on p.format = b.format and p.asset_id = b.asset_id
        join (select format, team_size, value, row_number() over (partition by format, team_size order by value, asset_id) - 1 as at from ({a}) a1) lo
          on lo.format = p.format and lo.team_size = p.team_size and lo.at = cast(floor(p.pos) as bigint)
        join (select format, team_size, value, row_number() over (partition by format, team_size order by value, asset_id) - 1 as at from ({a}) a2) hi
          on hi.format = p.format and hi.team_size = p.team_size and hi.at = cast(ceil(p.pos) as bigint)"""


SIMPLE_A = "select format, team_size, true_id as asset_id, value from @price_a"
SIMPLE_B = "select format, true_id as asset_id, value from @price_b"


def simple_blend(t: Inputs):
    a = t["price_a"].select(*BOARD, F.col("true_id").alias("asset_id"), "value")
    b = t["price_b"].select("format", F.col("true_id").alias("asset_id"), F.col("value").alias("value_b"))
    return consensus.blend_consensus(a, b, BOARD, ["format"], "asset_id", "value", "value_b")


@query("consensus_blend", f"""
    select format, team_size, asset_id, value, {r('pct_a', 9)} as pct_a, {r('pct_b', 9)} as pct_b, {r('blended', 9)} as blended, {r('consensus_value', 4)} as consensus_value
    from ({blend_sql(SIMPLE_A, SIMPLE_B)}) q""")
def consensus_blend(t: Inputs):
    return simple_blend(t).select(*BOARD, "asset_id", "value", *[grid_round(F.col(c), 9).alias(c) for c in ("pct_a", "pct_b", "blended")],
                                  grid_round(F.col("consensus_value"), 4).alias("consensus_value"))


@query("consensus_board", f"""
    select format, team_size, asset_id, consensus_value, row_number() over (partition by format, team_size order by consensus_value desc, asset_id) as board_rank
    from (select format, team_size, asset_id, {r('consensus_value', 4)} as consensus_value from ({blend_sql(SIMPLE_A, SIMPLE_B)}) q) z""")
def consensus_board(t: Inputs):
    priced = simple_blend(t).select(*BOARD, "asset_id", grid_round(F.col("consensus_value"), 4).alias("consensus_value"))
    return ranked(priced, "consensus_value")


# Source routing: which page and column backs each format of the second list.
ROUTED_B = """
    with dyn as (select d.*, coalesce(k.ktc_id, n.ktc_id) as ktc_id, coalesce(k.mfl_id, n.mfl_id) as mfl_id from @page_dynasty d
                 left join @crosswalk k on d.player_id = k.ktc_id left join @crosswalk n on d.name = n.merge_name),
    red0 as (select r.true_id, r.name, r.oneqb_value, coalesce(d.player_id, r.player_id) as player_id from @page_redraft r left join @page_dynasty d on r.name = d.name),
    red as (select d.*, coalesce(k.ktc_id, n.ktc_id) as ktc_id, coalesce(k.mfl_id, n.mfl_id) as mfl_id from red0 d
            left join @crosswalk k on d.player_id = k.ktc_id left join @crosswalk n on d.name = n.merge_name)
    select 'sf_dynasty' as format, mfl_id as asset_id, sf_value as value from dyn where ktc_id is not null and sf_value is not null
    union all select 'oneqb_dynasty', mfl_id, oneqb_value from dyn where ktc_id is not null and oneqb_value is not null
    union all select 'redraft', mfl_id, oneqb_value from red where ktc_id is not null and oneqb_value is not null"""


def routed_second_source(t: Inputs):
    ids = ["ktc_id", "mfl_id", "gsis_id", "espn_id"]
    order = [F.asc("mfl_id")]

    def resolved(page):
        source = page.withColumnRenamed("player_id", "src_ktc_id").withColumn("src_name", normalize_name(F.col("name")))
        return identity.resolve(source, t["crosswalk"], TWO_KEYS, ids, "ktc_id", order).where(F.col("ktc_id").isNotNull())

    dynasty = resolved(t["page_dynasty"])
    bridged = identity.bridge_ids(t["page_redraft"].select("player_id", "name", "oneqb_value"), t["page_dynasty"], "player_id", "name",
                                  "player_id", "name", [F.asc("player_id")])
    redraft = resolved(bridged)
    routed = F.inline(F.array(
        F.struct(F.lit("sf_dynasty").alias("format"), F.col("sf_value").alias("value_b")),
        F.struct(F.lit("oneqb_dynasty").alias("format"), F.col("oneqb_value").alias("value_b"))))
    return dynasty.select(F.col("mfl_id"), routed).unionByName(
        redraft.select("mfl_id", F.lit("redraft").alias("format"), F.col("oneqb_value").alias("value_b"))
    ).where(F.col("value_b").isNotNull())


def consensus_frame(t: Inputs):
    a = resolved_a(t).where(F.col("mfl_id").isNotNull()).select(*BOARD, "mfl_id", "gsis_id", "value")
    # Written once: ranking reads the resolved second list twice.
    second = land(routed_second_source(t), "second-source")
    return consensus.blend_consensus(a, second, BOARD, ["format"], "mfl_id", "value", "value_b").where(F.col("gsis_id").isNotNull())


@query("consensus_targets", f"""
    select format, team_size, '00-' || lpad(cast(asset_id as varchar), 7, '0') as gsis_id, {r('consensus_value', 4)} as consensus_value
    from ({blend_sql(f"select format, team_size, mfl_id as asset_id, value from ({RESOLVED_A}) ra where mfl_id is not null", ROUTED_B)}) q""")
def consensus_targets(t: Inputs):
    return consensus_frame(t).select(*BOARD, "gsis_id", grid_round(F.col("consensus_value"), 4).alias("consensus_value"))


@query("sample_weights", f"""
    select format, team_size, true_id, {r('1 + pct * pct * pct')} as sample_weight from (
        select format, team_size, true_id, (rank() over (partition by format, team_size order by value)
               + (count(*) over (partition by format, team_size, value) - 1) / 2.0) / count(*) over (partition by format, team_size) as pct from @price_a) x""")
def sample_weights(t: Inputs):
    d = consensus.rank_power_weights(t["price_a"].select(*BOARD, "true_id", "value"), BOARD, "value")
    return d.select(*BOARD, "true_id", grid_round(F.col("sample_weight")).alias("sample_weight"))


# --- picks --------------------------------------------------------------------------------------

NATIVE = r"""
    select 'a' as source, format, team_size, cast(substr(name, 1, 4) as int) as year, cast(substr(name, 6, 1) as int) as round,
           nullif(regexp_extract(name, '\((\w+)\)', 1), '') as tier, case when name like '%(%' then 'tier' else 'aggregate' end as kind, value
    from @pick_list_a where format <> 'redraft' and regexp_matches(name, '^\d{4} [123](st|nd|rd|th)( \((Early|Mid|Late)\))?$') and substr(name, 1, 4) in ('2027', '2028', '2029')
    union all
    select 'b', f.format, null, cast(substr(name, 1, 4) as int), cast(regexp_extract(name, ' (\d)(st|nd|rd|th)$', 1) as int), regexp_extract(name, '(Early|Mid|Late)', 1),
           'tier', case f.format when 'sf_dynasty' then sf_value else oneqb_value end
    from @pick_list_b cross join (values ('sf_dynasty'), ('oneqb_dynasty')) f(format)
    where regexp_matches(name, '^\d{4} (Early|Mid|Late) [123](st|nd|rd|th)$')"""
RATIOS = f"""
    select round, tier, avg(tv / wv) as ratio from (
        select a.round, b.tier, a.value as wv, b.value as tv from ({NATIVE}) a join ({NATIVE}) b
          on a.format = b.format and a.team_size = b.team_size and a.year = b.year and a.round = b.round
        where a.source = 'a' and b.source = 'a' and a.kind = 'aggregate' and b.kind = 'tier' and a.year = 2027) z group by round, tier"""
PAIRS = r"""
    select cast(substr(a.name, 6, 1) as int) as round, a.value / b.value as ratio from @pick_list_a a join @pick_list_a b
      on a.name = b.name and a.team_size = b.team_size and a.format = 'sf_dynasty' and b.format = 'oneqb_dynasty'
    where regexp_matches(a.name, '^\d{4} \d(st|nd|rd|th)( \((Early|Mid|Late)\))?$')"""


@query("native_picks", f"select source, format, team_size, year, round, tier, kind, value from ({NATIVE}) q")
def native_picks(t: Inputs):
    return picks.native_picks(t["pick_list_a"], t["pick_list_b"])


@query("tier_ratios", f"select round, tier, {r('ratio')} as ratio from ({RATIOS}) q")
def tier_ratios(t: Inputs):
    return picks.tier_ratios(picks.native_picks(t["pick_list_a"], t["pick_list_b"])).withColumn("ratio", grid_round(F.col("ratio")))


@query("format_multiplier", f"""
    select round, {r('m')} as multiplier, n as n_pairs, m between 0.9 and 2.0 as plausible from (
        select cast(null as int) as round, avg(ratio) as m, count(*) as n from ({PAIRS}) a union all select round, avg(ratio), count(*) from ({PAIRS}) b group by round) q""")
def format_multiplier(t: Inputs):
    return picks.format_multiplier(t["pick_list_a"]).withColumn("multiplier", grid_round(F.col("multiplier")))


UNIVERSE = f"""
    with n as ({NATIVE}), g as (select f.format, s.team_size, y.year, q.round, v.tier
        from (values ('sf_dynasty'), ('oneqb_dynasty')) f(format) cross join (values (10), (12)) s(team_size) cross join (values (2027), (2028), (2029)) y(year)
        cross join (values (1), (2), (3)) q(round) cross join (values ('Early'), ('Mid'), ('Late')) v(tier)),
    j as (select g.*, t.value as tv, w.value as wv, x.ratio, b.value as bv,
                 case g.year when 2027 then 0.90 * 1.10 when 2028 then 0.725 else 0.50 end as factor, (select avg(ratio) from ({PAIRS}) p) as mult
          from g left join n t on t.source = 'a' and t.kind = 'tier' and t.format = g.format and t.team_size = g.team_size and t.year = g.year and t.round = g.round and t.tier = g.tier
          left join n w on w.source = 'a' and w.kind = 'aggregate' and w.format = g.format and w.team_size = g.team_size and w.year = g.year and w.round = g.round
          left join ({RATIOS}) x on x.round = g.round and x.tier = g.tier
          left join n b on b.source = 'b' and b.format = g.format and b.year = g.year and b.round = g.round and b.tier = g.tier),
    k as (select *, coalesce(tv, wv * ratio, coalesce(wv, 3000) * factor * mult) as fv,
                 case when tv is not null then 'native' when wv * ratio is not null then 'derived' else 'constructed' end as price_origin from j)
    select format, team_size, year, round, tier, fv as first_value, price_origin, coalesce(fv * 0.65 + bv * 0.35, fv) as pick_value from k"""


@query("pick_universe", f"""
    select format, team_size, year, round, tier, {r('first_value', 4)} as first_value, price_origin, {r('pick_value', 4)} as pick_value from ({UNIVERSE}) q""")
def pick_universe(t: Inputs):
    d = picks.pick_universe(t["pick_list_a"], t["pick_list_b"])
    return d.select("format", "team_size", "year", "round", "tier", grid_round(F.col("first_value"), 4).alias("first_value"), "price_origin",
                    grid_round(F.col("pick_value"), 4).alias("pick_value"))
