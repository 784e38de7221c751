"""Scalar cleaning over table rows."""

from pyspark.sql import functions as F

from assetboard.functions import numeric, text
from assetboard.operators.features import age_features, aging_curves, prior_workload, with_age
from assetboard.plans.registry import query, r
from assetboard.sources.stand_ins import Inputs

# Text shapes made from rows: suffixes, punctuation, nicknames, empty and missing names.
RAW_NAME = """
    case p_partkey % 12 when 0 then cast(null as string) when 1 then '' when 2 then 'Jr.'
         when 3 then 'Mike ' || p_name || ' III' when 4 then 'JOSH O''' || p_name || ', Sr.'
         when 5 then '  Kenny   ' || p_name || '-' || p_brand when 6 then 'Jr Will ' || p_name
         when 7 then 'alex' when 8 then p_name || ' V' when 9 then 'Matt-Will ' || p_brand
         else p_name || ' ' || p_brand end"""

RAW_NUMBER = """
    case p_partkey % 7 when 0 then 'NA' when 1 then '' when 2 then cast(p_partkey as string) || '.0'
         when 3 then ' ' || cast(p_partkey as string) when 4 then cast(null as string)
         when 5 then 'x' || cast(p_partkey as string) else cast(p_retailprice as string) end"""

PICK_NAME = """
    case p_partkey % 8 when 0 then cast(2026 + p_size % 4 as string) || ' 1st (Early)' when 1 then cast(2026 + p_size % 4 as string) || ' 2nd'
         when 2 then '2026 Pick ' || cast(p_size % 4 as string) || '.' || cast(p_size as string) when 3 then cast(2026 + p_size % 4 as string) || ' Late 3rd'
         when 4 then p_name when 5 then cast(2026 + p_size % 4 as string) || ' 4th (Late)' when 6 then cast(p_size as string) || ' 1st'
         else cast(2026 + p_size % 4 as string) || ' Mid 1st' end"""

FORMAL = " ".join(f"when '{k}' then '{v}'" for k, v in text.FORMAL_FIRST_NAMES.items())
SUFFIXES = ", ".join(f"'{s}'" for s in text.NAME_SUFFIXES)


@query("normalize_name", f"""
    with raw as (select p_partkey, {RAW_NAME} as name from @part),
    words as (select p_partkey, name,
        list_filter(regexp_split_to_array(regexp_replace(lower(name), '[^a-z0-9\\s]', '', 'g'), '\\s+'),
                    lambda w: w <> '' and w not in ({SUFFIXES})) as w from raw)
    select p_partkey, case when name is null or len(w) = 0 then ''
        else array_to_string(list_concat([case w[1] {FORMAL} else w[1] end], w[2:]), ' ') end as merge_name from words""")
def normalize_name(t: Inputs):
    return t["part"].select("p_partkey", F.expr(RAW_NAME).alias("name")).select(
        "p_partkey", text.normalize_name(F.col("name")).alias("merge_name"))


@query("lenient_cast", f"""
    select p_partkey, try_cast(raw as double) as number, cast(trunc(try_cast(raw as double)) as bigint) as whole
    from (select p_partkey, {RAW_NUMBER.replace('cast(p_retailprice as string)', "cast(p_size as string) || '.25'")} as raw from @part) x""")
def lenient_cast(t: Inputs):
    raw = RAW_NUMBER.replace("cast(p_retailprice as string)", "cast(p_size as string) || '.25'")
    return t["part"].select("p_partkey", F.expr(raw).alias("raw")).select(
        "p_partkey", text.lenient_number(F.col("raw")).alias("number"), text.lenient_number(F.col("raw"), "bigint").alias("whole"))


@query("normalize_id", f"""
    select p_partkey, coalesce(cast(cast(trunc(try_cast(raw as double)) as bigint) as varchar), raw) as id
    from (select p_partkey, {RAW_NUMBER.replace('cast(p_retailprice as string)', "'12e2'")} as raw from @part) x""")
def normalize_id(t: Inputs):
    raw = RAW_NUMBER.replace("cast(p_retailprice as string)", "'12e2'")
    return t["part"].select("p_partkey", F.expr(raw).alias("raw")).select("p_partkey", text.normalize_id(F.col("raw")).alias("id"))


@query("id_format_check", r"""
    select row_id, gsis_id, regexp_matches(gsis_id, '^\d{2}-\d{7}$') as well_formed from @draft_raw""")
def id_format_check(t: Inputs):
    return t["draft_raw"].select("row_id", "gsis_id", text.has_player_id_format(F.col("gsis_id")).alias("well_formed"))


@query("parse_pick_name", f"""
    with raw as (select p_partkey, {PICK_NAME} as name from @part)
    select p_partkey,
        case when regexp_matches(name, '^\\d{{4}} Pick \\d+\\.\\d+$') then cast(substr(name, 1, 4) as int)
             when regexp_matches(name, '^\\d{{4}} \\d(st|nd|rd|th)( \\((Early|Mid|Late)\\))?$') then cast(substr(name, 1, 4) as int) end as year,
        case when regexp_matches(name, '^\\d{{4}} \\d(st|nd|rd|th)( \\((Early|Mid|Late)\\))?$') then cast(substr(name, 6, 1) as int) end as round,
        case when regexp_matches(name, '^\\d{{4}} \\d(st|nd|rd|th) \\((Early|Mid|Late)\\)$') then regexp_extract(name, '\\((\\w+)\\)', 1) end as tier,
        case when regexp_matches(name, '^\\d{{4}} Pick \\d+\\.\\d+$') then 'slot'
             when regexp_matches(name, '^\\d{{4}} \\d(st|nd|rd|th)$') then 'aggregate'
             when regexp_matches(name, '^\\d{{4}} \\d(st|nd|rd|th) \\((Early|Mid|Late)\\)$') then 'tier' end as kind,
        case when regexp_matches(name, '^\\d{{4}} (Early|Mid|Late) \\d(st|nd|rd|th)$') then cast(substr(name, 1, 4) as int) end as b_year,
        case when regexp_matches(name, '^\\d{{4}} (Early|Mid|Late) \\d(st|nd|rd|th)$') then cast(regexp_extract(name, ' (\\d)(st|nd|rd|th)$', 1) as int) end as b_round,
        case when regexp_matches(name, '^\\d{{4}} (Early|Mid|Late) \\d(st|nd|rd|th)$') then regexp_extract(name, '(Early|Mid|Late)', 1) end as b_tier
    from raw""")
def parse_pick_name(t: Inputs):
    named = t["part"].select("p_partkey", F.expr(PICK_NAME).alias("name"))
    return named.select(
        "p_partkey", text.parse_pick_name(F.col("name"), "round_first").alias("a"),
        text.parse_pick_name(F.col("name"), "tier_first").alias("b"),
    ).select("p_partkey", "a.year", "a.round", "a.tier", "a.kind", F.col("b.year").alias("b_year"),
             F.col("b.round").alias("b_round"), F.col("b.tier").alias("b_tier"))


@query("safe_ratio", """
    select asset_id, season, cast(points as double) / nullif(games - 1, 0) as per_extra_game,
           cast(yards as double) / nullif(points % 5, 0) as ratio
    from @asset_panel""")
def safe_ratio(t: Inputs):
    return t["asset_panel"].select(
        "asset_id", "season", numeric.safe_ratio(F.col("points"), F.col("games") - 1).alias("per_extra_game"),
        numeric.safe_ratio(F.col("yards"), F.col("points") % 5).alias("ratio"))


@query("speed_score", f"""
    select pfr_id, merge_name, draft_year,
           {r("case when pos = 'ECONOMY' and wt is not null and forty > 0 then wt * 200 / (forty * forty * forty * forty) end")} as speed_score
    from @combine""")
def speed_score(t: Inputs):
    score = numeric.speed_score(F.col("pos"), F.col("wt"), F.col("forty"), runner="ECONOMY")
    return t["combine"].select("pfr_id", "merge_name", "draft_year", numeric.grid_round(score).alias("speed_score"))


@query("nearest_size", """
    select p_partkey, case when p_size <= 11 then 10 else 12 end as size, p_size not in (10, 12) as approximated from @part""")
def nearest_size(t: Inputs):
    return t["part"].select("p_partkey", numeric.nearest_size(F.col("p_size"), (10, 12)).alias("s")).select("p_partkey", "s.*")


@query("asset_labels", """
    select asset_id, format, team_size,
           case when asset_type = 'pick' then name || ' (pick)' else name || ' (' || position || ', ' || coalesce(team, 'FA') || ')' end as label,
           case when position = 'PICK' then 'PICK-' || format || '-' || cast(team_size as varchar) || '-2027-1-Mid' end as pick_id,
           cast(2027 + team_size as varchar) || ' Round 1 (Mid)' as title
    from @board""")
def asset_labels(t: Inputs):
    pick_id = text.pick_asset_id(F.col("format"), F.col("team_size"), F.lit(2027), F.lit(1), F.lit("Mid"))
    return t["board"].select(
        "asset_id", "format", "team_size",
        text.asset_label(F.col("asset_type"), F.col("name"), F.col("position"), F.col("team")).alias("label"),
        F.when(F.col("position") == "PICK", pick_id).alias("pick_id"),
        text.pick_title(F.col("team_size") + 2027, F.lit(1), F.lit("Mid")).alias("title"))


@query("age_features", f"""
    with aged as (select p.*, cast(d.age_at_draft + (p.season - d.draft_year) as int) as age, p.points / cast(p.games as double) as ppg
                  from @asset_panel p left join @draft d on p.asset_id = d.asset_id),
    used as (select position, cast(age as double) as x, ppg as y from aged where age is not null and games >= 2),
    c as (select position, avg(x) as m from used group by position having count(*) >= 20),
    z as (select u.position, u.x - c.m as d, u.y, c.m from used u join c on u.position = c.position),
    s as (select position, max(m) as m, cast(count(*) as double) as n, sum(d) as s1, sum(d*d) as s2, sum(d*d*d) as s3, sum(d*d*d*d) as s4,
                 sum(y) as t0, sum(d*y) as t1, sum(d*d*y) as t2 from z group by position),
    k as (select position, m, n*(s2*t2-s3*t1)-s1*(s1*t2-s3*t0)+s2*(s1*t1-s2*t0) as da, n*(t1*s4-t2*s3)-t0*(s1*s4-s3*s2)+s2*(s1*t2-s2*t1) as db,
                 n*(s2*s4-s3*s3)-s1*(s1*s4-s2*s3)+s2*(s1*s3-s2*s2) as dd from s),
    peaks as (select k.position, case when da / dd < 0 then m - db / (2 * da)
                 else (select quantile_cont(x, 0.5) from used u where u.position = k.position) end as peak from k)
    select a.asset_id, a.season, a.age, a.age * a.age as age_squared, {r('abs(a.age - p.peak)', 3)} as distance_from_peak_age,
           coalesce(cast(sum(a.games) over (partition by a.asset_id order by a.season rows between unbounded preceding and 1 preceding) as bigint), 0) as career_workload
    from aged a left join peaks p on a.position = p.position""")
def age_features_query(t: Inputs):
    aged = with_age(t["asset_panel"], t["draft"], "asset_id").withColumn("ppg", numeric.safe_ratio(F.col("points"), F.col("games")))
    peaks = aging_curves(aged, "position", "ppg", min_games=2)
    rows = age_features(prior_workload(aged, "asset_id", "season"), peaks, "position", "age", "age_squared", "distance_from_peak_age")
    return rows.select("asset_id", "season", "age", "age_squared",
                       numeric.grid_round(F.col("distance_from_peak_age"), 3).alias("distance_from_peak_age"), "career_workload")
