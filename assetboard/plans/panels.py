"""Season panels, careers, curves, snapshots and the feature table."""

from pyspark.sql import functions as F

from assetboard.functions.numeric import grid_round, safe_ratio
from assetboard.operators import features
from assetboard.operators.ordering import average_rank, exact_quantiles
from assetboard.plans.identity import combine_rows
from assetboard.plans.registry import query, r
from assetboard.session import land
from assetboard.sources.stand_ins import Inputs

POSITIONS = ("ECONOMY", "PROMO", "STANDARD", "SMALL")
IN_SCOPE = ", ".join(f"'{p}'" for p in POSITIONS)
PANEL_COLUMNS = ["games", "points", "yards", "share_a", "share_b"]
VALUATION_SEASON = 2002

SHARE = """
    select p_partkey as asset_id, s.season, s.snap_share from (
        select pfr_player_id, season, sum(offense_pct) / count(*) as snap_share from @game_share group by pfr_player_id, season) s
    join @part on s.pfr_player_id = 'P' || cast(p_partkey as varchar) where p_partkey % 4 <> 0"""
LATEST = "select * from (select *, row_number() over (partition by asset_id order by season desc) as k from @asset_panel) x where k = 1"
CAREER = """select asset_id, cast(sum(games) as bigint) as career_games, count(distinct season) as seasons_played,
    cast(sum(points) as double) / nullif(sum(games), 0) as career_ppg from @asset_panel group by asset_id"""
CURVES = """
    select position, n, da / dd as a, case when da / dd < 0 then m - db / (2 * da) else med end as peak_age, da / dd < 0 as concave, med from (
    select position, m, n, med, n*(s2*t2-s3*t1)-s1*(s1*t2-s3*t0)+s2*(s1*t1-s2*t0) as da, n*(t1*s4-t2*s3)-t0*(s1*s4-s3*s2)+s2*(s1*t2-s2*t1) as db,
           n*(s2*s4-s3*s3)-s1*(s1*s4-s2*s3)+s2*(s1*s3-s2*s2) as dd from (
        select u.position, max(u.m) as m, max(u.med) as med, cast(count(*) as double) as n, sum(d) as s1, sum(d*d) as s2, sum(d*d*d) as s3, sum(d*d*d*d) as s4,
               sum(y) as t0, sum(d*y) as t1, sum(d*d*y) as t2 from (
            select position, y, x - avg(x) over (partition by position) as d, avg(x) over (partition by position) as m,
                   quantile_cont(x, 0.5) over (partition by position) as med, count(*) over (partition by position) as c from (
                select p.position, cast(d.age_at_draft + (p.season - d.draft_year) as double) as x, cast(p.points as double) / p.games as y
                from @asset_panel p join @draft d on p.asset_id = d.asset_id where p.games >= 2) w) u
        where u.c >= 20 group by u.position) s) z"""


def shares(t: Inputs):
    ids = t["part"].where("p_partkey % 4 <> 0").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("pfr_id"), F.col("p_partkey").alias("asset_id"))
    return features.season_share(t["game_share"], ids, "pfr_player_id", "season", "offense_pct", "pfr_id", "asset_id")


@query("season_share", f"select asset_id, season, {r('snap_share')} as snap_share from ({SHARE}) q")
def season_share(t: Inputs):
    return shares(t).withColumn("snap_share", grid_round(F.col("snap_share")))


@query("season_panel", f"""
    select p.asset_id, position, p.season, games, points, yards, share_a, share_b, cast(points as double) / nullif(games, 0) as ppg, {r('s.snap_share')} as snap_share
    from @asset_panel p left join ({SHARE}) s on p.asset_id = s.asset_id and p.season = s.season where position in ({IN_SCOPE})""")
def season_panel(t: Inputs):
    d = features.season_panel(t["asset_panel"], shares(t), "asset_id", "season", PANEL_COLUMNS, points="points", per_game="ppg", positions=POSITIONS)
    return d.withColumn("snap_share", grid_round(F.col("snap_share")))


def to_date_frame(t: Inputs, through_week: int):
    return features.season_to_date(t["asset_week"], "asset_id", "week", through_week, summed=["points", "yards"], averaged=["share_a"],
                                   points="points", per_game="ppg")


TO_DATE = """select asset_id, count(distinct week) as games, cast(sum(points) as bigint) as points, cast(sum(yards) as bigint) as yards, avg(share_a) as share_a,
    cast(sum(points) as double) / nullif(count(distinct week), 0) as ppg from @asset_week where week <= {w} group by asset_id"""


@query("season_to_date", f"select asset_id, games, points, yards, {r('share_a')} as share_a, ppg from ({TO_DATE.format(w=18)}) q")
def season_to_date(t: Inputs):
    return to_date_frame(t, 25).withColumn("share_a", grid_round(F.col("share_a")))


@query("career_agg", CAREER)
def career_agg(t: Inputs):
    return features.career(t["asset_panel"], "asset_id", "season", "points", per_game="career_ppg")


@query("prior_workload", """
    select asset_id, season, games, coalesce(cast(sum(games) over (partition by asset_id order by season rows between unbounded preceding and 1 preceding) as bigint), 0) as career_workload
    from @asset_panel""")
def prior_workload(t: Inputs):
    return features.prior_workload(t["asset_panel"].select("asset_id", "season", "games"), "asset_id", "season")


@query("latest_season", f"select * exclude (k) from ({LATEST}) q")
def latest_season(t: Inputs):
    return features.latest_season(t["asset_panel"], "asset_id", "season")


def curves(t: Inputs, panel=None):
    rows = t["asset_panel"] if panel is None else panel
    aged = features.with_age(rows, t["draft"], "asset_id").withColumn("ppg", safe_ratio(F.col("points"), F.col("games")))
    return features.aging_curves(aged, "position", "ppg", min_games=2)


@query("aging_curve", f"select position, cast(n as bigint) as n_rows, {r('a')} as a, {r('peak_age', 3)} as peak_age, concave from ({CURVES}) q")
def aging_curve(t: Inputs):
    return curves(t).select("position", "n_rows", grid_round(F.col("a")).alias("a"), grid_round(F.col("peak_age"), 3).alias("peak_age"), "concave")


# The curve on a planted concave shape, so that both branches are checked on table rows.
@query("aging_curve_concave", f"""
    with u as (select position, season % 8 as x, 100.0 - 3.0 * (season % 8 - 4) * (season % 8 - 4) + cast(asset_id % 10 as double) as y from @asset_panel),
    c as (select position, avg(x) as m, cast(count(*) as double) as n from u group by position having count(*) >= 20),
    s as (select u.position, max(c.m) as m, max(c.n) as n, sum(u.x - c.m) as s1, sum(pow(u.x - c.m, 2)) as s2, sum(pow(u.x - c.m, 3)) as s3, sum(pow(u.x - c.m, 4)) as s4,
          sum(y) as t0, sum((u.x - c.m) * y) as t1, sum(pow(u.x - c.m, 2) * y) as t2 from u join c on u.position = c.position group by u.position)
    select position, cast(n as bigint) as n_rows, true as concave,
           {r('m - (n*(t1*s4-t2*s3)-t0*(s1*s4-s3*s2)+s2*(s1*t2-s2*t1)) / (2 * (n*(s2*t2-s3*t1)-s1*(s1*t2-s3*t0)+s2*(s1*t1-s2*t0)))', 4)} as peak_age from s""")
def aging_curve_concave(t: Inputs):
    x = F.col("season") % 8
    rows = t["asset_panel"].select("position", "games", x.alias("age"), (F.lit(100.0) - (x - 4) * (x - 4) * 3 + F.col("asset_id") % 10).alias("y"))
    d = features.aging_curves(rows, "position", "y", min_games=0)
    return d.select("position", "n_rows", "concave", grid_round(F.col("peak_age"), 4).alias("peak_age"))


@query("pivot_stats", """
    select asset_id, yr, cast(max(case when stat_type = 'YDS' then stat end) as bigint) as "YDS", cast(max(case when stat_type = 'TD' then stat end) as bigint) as "TD"
    from @college_long group by asset_id, yr""")
def pivot_stats(t: Inputs):
    return features.pivot_stats(t["college_long"], ["asset_id", "yr"], "stat_type", "stat", ["YDS", "TD"])


COLLEGE = """
    with s as (select c.asset_id, c.yr, d.age_at_draft - (d.draft_year - c.yr) as age,
                      cast(yards as double) / nullif(team_yards, 0) * 0.8 + cast(scores as double) / nullif(team_scores, 0) * 0.2 as dom
               from @college_seasons c join @college_teams g on c.team = g.team and c.yr = g.yr join @draft d on d.asset_id = c.asset_id
               where c.yr < d.draft_year and d.position <> 'PROMO'),
    ok as (select * from s where dom is not null),
    agg as (select asset_id, arg_max(dom, yr) as dominator_rating, min(case when dom >= 0.2 then age end) as breakout_age, count(*) as college_seasons_found
            from ok group by asset_id)
    select d.asset_id, dominator_rating, cast(breakout_age as int) as breakout_age, coalesce(college_seasons_found, 0) as college_seasons_found
    from @draft d left join agg a on d.asset_id = a.asset_id"""


def college(t: Inputs):
    return features.college_production(t["college_seasons"], t["college_teams"], t["draft"], "asset_id", "team", "yr", skip_position="PROMO")


@query("dominator_breakout", f"select asset_id, {r('dominator_rating')} as dominator_rating, breakout_age, college_seasons_found from ({COLLEGE}) q")
def dominator_breakout(t: Inputs):
    return college(t).withColumn("dominator_rating", grid_round(F.col("dominator_rating")))


def snapshot(t: Inputs):
    active = t["price_a"].select(F.col("true_id").alias("asset_id"))
    panel = land(t["asset_panel"], "panel")  # read by the curves, the latest season, the careers and the rookie filter
    return features.player_snapshot(panel, t["draft"].drop("round", "pick", "college"), curves(t, panel), "asset_id", "position", "season",
                                    "points", VALUATION_SEASON, per_game="career_ppg", active=active)


SNAPSHOT = f"""
    with vets as (select l.asset_id, l.position, l.season, l.games, l.points, l.yards, l.share_a, l.share_b, c.career_games, c.seasons_played, c.career_ppg,
                         d.draft_year, d.age_at_draft
                  from ({LATEST}) l join ({CAREER}) c on l.asset_id = c.asset_id left join @draft d on d.asset_id = l.asset_id),
    rows as (select * from vets union all
             select asset_id, position, null, null, null, null, null, null, null, null, null, draft_year, age_at_draft from @draft
             where draft_year = {VALUATION_SEASON} and asset_id not in (select asset_id from @asset_panel))
    select rows.*, age_at_draft + ({VALUATION_SEASON} - draft_year) as current_age, p.peak_age from rows left join ({CURVES}) p on rows.position = p.position
    where asset_id in (select true_id from @price_a)"""
SNAP_COLUMNS = ["asset_id", "position", "season", "games", "points", "yards", "share_a", "share_b", "career_games", "seasons_played", "career_ppg",
                "draft_year", "age_at_draft"]


@query("player_snapshot", f"""
    select {', '.join(SNAP_COLUMNS)}, current_age, current_age * current_age as current_age_squared,
           {r('abs(current_age - peak_age)', 3)} as current_distance_from_peak_age from ({SNAPSHOT}) q""")
def player_snapshot(t: Inputs):
    return snapshot(t).select(*SNAP_COLUMNS, "current_age", "current_age_squared",
                              grid_round(F.col("current_distance_from_peak_age"), 3).alias("current_distance_from_peak_age"))


def combine_by_asset(t: Inputs):
    return combine_rows(t).select(F.substring("gsis_id", 4, 7).cast("bigint").alias("asset_id"), "forty_time", "combine_weight", "combine_height", "speed_score")


def feature_frame(t: Inputs):
    return features.feature_table(snapshot(t), t["draft"], combine_by_asset(t), college(t), "asset_id")


@query("feature_table", f"""
    with hit as (select c.*, coalesce(p.mfl_id, n.mfl_id) as id from @combine c left join @crosswalk p on c.pfr_id = p.pfr_id
                 left join @crosswalk n on c.merge_name = n.merge_name),
    last as (select *, row_number() over (partition by id order by draft_year desc, wt desc) as k from hit where id is not null)
    select s.asset_id, s.points, s.career_games, s.current_age, d.round, d.pick, l.forty as forty_time, l.wt as combine_weight,
           {r("case when l.pos = 'ECONOMY' and l.forty > 0 then l.wt * 200 / (l.forty * l.forty * l.forty * l.forty) end")} as speed_score,
           {r('c.dominator_rating')} as dominator_rating, c.breakout_age, c.college_seasons_found
    from ({SNAPSHOT}) s left join @draft d on s.asset_id = d.asset_id left join last l on l.id = s.asset_id and l.k = 1
    left join ({COLLEGE}) c on c.asset_id = s.asset_id""")
def feature_table(t: Inputs):
    return feature_frame(t).select("asset_id", "points", "career_games", "current_age", "round", "pick", "forty_time", "combine_weight",
                                   grid_round(F.col("speed_score")).alias("speed_score"), grid_round(F.col("dominator_rating")).alias("dominator_rating"),
                                   "breakout_age", "college_seasons_found")


@query("avg_percentile_rank", f"""
    select format, team_size, true_id, (rank() over (partition by format, team_size order by value)
           + (count(*) over (partition by format, team_size, value) - 1) / 2.0) / count(*) over (partition by format, team_size) as pct
    from (select format, team_size, true_id, floor(value / 1000) as value from @price_a) x""")
def avg_percentile_rank(t: Inputs):
    rows = t["price_a"].select("format", "team_size", "true_id", F.floor(F.col("value") / 1000).alias("value"))
    return average_rank(rows, ["format", "team_size"], "value", "avg_rank", "pct").select("format", "team_size", "true_id", "pct")


@query("target_describe", f"""
    select format, team_size, count(*) as n, {r('avg(value)', 4)} as mean, {r('stddev_samp(value)', 4)} as std, min(value) as min,
           {r('quantile_cont(value, 0.25)', 4)} as q25, {r('quantile_cont(value, 0.5)', 4)} as q50, {r('quantile_cont(value, 0.75)', 4)} as q75, max(value) as max
    from @price_a group by format, team_size""")
def target_describe(t: Inputs):
    board = ["format", "team_size"]
    moments = t["price_a"].groupBy(*board).agg(
        F.count("*").alias("n"), grid_round(F.avg("value"), 4).alias("mean"), grid_round(F.stddev_samp("value"), 4).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(t["price_a"], board, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return moments.join(q.select(*board, *[grid_round(F.col(c), 4).alias(c) for c in ("q25", "q50", "q75")]), board)
