"""Trades, leagues and in-season refresh."""

from pyspark.sql import functions as F

from assetboard.functions.numeric import grid_round, safe_ratio
from assetboard.operators import boards, league, picks, refresh
from assetboard.operators.features import latest_season
from assetboard.plans.panels import LATEST, TO_DATE, to_date_frame
from assetboard.plans.pricing import UNIVERSE
from assetboard.plans.registry import query, r
from assetboard.sources.stand_ins import Inputs

ON_BOARD = "format = 'sf_dynasty' and team_size = 12"
PLAYERS = f"""select asset_id, sleeper_id, college_seasons_found, {r('model_value', 4)} as model_value, {r('model_value - consensus_value', 4)} as residual
    from @board where {ON_BOARD} and asset_type = 'player'"""
ROSTER = f"""select r.league_id, r.roster_id, b.* from @roster_raw r join ({PLAYERS}) b on b.sleeper_id = cast(r.asset_id as varchar)"""


def players(t: Inputs):
    board = boards.with_residuals(t["board"].where(ON_BOARD).where("asset_type = 'player'"))
    return board.select("asset_id", "sleeper_id", "college_seasons_found", grid_round(F.col("model_value"), 4).alias("model_value"),
                        grid_round(F.col("residual"), 4).alias("residual"))


def rostered(t: Inputs):
    return league.rostered_assets(league.roster_rows(t["rosters"], t["users"]), players(t))


@query("roster_rows", """
    select league_id, roster_id, cast(asset_id as varchar) as sleeper_id,
           coalesce(u.team_name, u.display_name, 'Roster ' || cast(roster_id as varchar)) as team_name
    from @roster_raw left join @users u on u.user_id = (league_id * 12 + roster_id) % 130""")
def roster_rows(t: Inputs):
    return league.roster_rows(t["rosters"], t["users"])


@query("trade_verdict", f"""
    with s as (select trade_id, coalesce(sum(model_value) filter (where side = 'A'), 0) as a, coalesce(sum(model_value) filter (where side = 'B'), 0) as b
               from @trades t left join ({PLAYERS}) p on t.asset_id = p.asset_id group by trade_id),
    d as (select *, coalesce(abs(a - b) / nullif(greatest(a, b), 0) * 100, 0) as diff from s)
    select trade_id, {r('a', 4)} as total_a, {r('b', 4)} as total_b, {r('diff', 4)} as diff_pct,
           case when a = 0 and b = 0 then 'none' when diff <= 5 then 'even' when a > b then 'A' else 'B' end as verdict from d""")
def trade_verdict(t: Inputs):
    d = league.trade_verdict(t["trades"], players(t))
    return d.select("trade_id", *[grid_round(F.col(c), 4).alias(c) for c in ("total_a", "total_b", "diff_pct")], "verdict")


@query("roster_top_n", f"""
    select * from (select league_id, roster_id, asset_id, model_value, cast(row_number() over (partition by league_id, roster_id order by model_value desc, asset_id) as int) as roster_rank
        from ({ROSTER}) q) x where roster_rank <= 10""")
def roster_top_n(t: Inputs):
    return league.roster_top_n(rostered(t)).select("league_id", "roster_id", "asset_id", "model_value", "roster_rank")


@query("buy_low_targets", f"""
    select * from (select league_id, asset_id, residual, cast(row_number() over (partition by league_id order by residual desc, asset_id) as int) as target_rank
        from ({ROSTER}) q where roster_id <> league_id % 12 and residual > 0 and (college_seasons_found is null or college_seasons_found <> 0)) x where target_rank <= 5""")
def buy_low_targets(t: Inputs):
    mine = t["rosters"].select("league_id", (F.col("league_id") % 12).alias("my_roster_id")).distinct()
    return league.buy_low_targets(rostered(t), mine).select("league_id", "asset_id", "residual", "target_rank")


SLOTS = """
    select l.league_id, y.year, q.round, l.original_roster, coalesce(t.new_owner, l.original_roster) as owner
    from (select distinct league_id, roster_id as original_roster from @roster_raw) l
    cross join (values (2027), (2028), (2029)) y(year) cross join (values (1), (2), (3)) q(round)
    left join @traded_picks t on t.league_id = l.league_id and t.year = y.year and t.round = q.round and t.original_roster = l.original_roster"""


def ownership(t: Inputs):
    return league.pick_ownership(t["rosters"], t["traded_picks"], picks.PICK_YEARS, picks.PICK_ROUNDS)


@query("pick_ownership", SLOTS)
def pick_ownership(t: Inputs):
    return ownership(t)


@query("league_totals", f"""
    with p as (select league_id, roster_id, sum(cast(round(model_value * 10000) as bigint)) as v from ({ROSTER}) q group by league_id, roster_id),
    m as (select year, round, {r('pick_value', 2)} as price from ({UNIVERSE}) u where format = 'sf_dynasty' and team_size = 12 and tier = 'Mid'),
    k as (select league_id, owner, sum(cast(round(coalesce(price, 0) * 10000) as bigint)) as v from ({SLOTS}) s left join m on m.year = s.year and m.round = s.round group by league_id, owner),
    a as (select r.league_id, r.roster_id, {r('coalesce(p.v, 0) / 10000', 2)} as player_value, {r('coalesce(k.v, 0) / 10000', 2)} as pick_value,
                 {r('(coalesce(p.v, 0) + coalesce(k.v, 0)) / 10000', 2)} as total_value
          from (select distinct league_id, roster_id from @roster_raw) r left join p on p.league_id = r.league_id and p.roster_id = r.roster_id
          left join k on k.league_id = r.league_id and k.owner = r.roster_id)
    select *, row_number() over (partition by league_id order by total_value desc, roster_id) as league_rank from a""")
def league_totals(t: Inputs):
    mid = picks.pick_universe(t["pick_list_a"], t["pick_list_b"]).where(ON_BOARD).where("tier = 'Mid'").select(
        "year", "round", grid_round(F.col("pick_value"), 2).alias("pick_price"))
    d = league.league_totals(rostered(t), t["rosters"], ownership(t), mid)
    return d.select("league_id", "roster_id", *[grid_round(F.col(c), 2).alias(c) for c in ("player_value", "pick_value", "total_value")], "league_rank")


# --- refresh ------------------------------------------------------------------------------------

BLENDED = ["games", "points", "yards", "share_a", "ppg"]


@query("eb_blend", f"""
    with f as (select asset_id, season, games, points, yards, share_a, share_b, cast(points as double) / games as ppg from ({LATEST}) q),
    p as ({TO_DATE.format(w=10)}),
    j as (select f.*, p.games as g, p.points as np, p.yards as ny, p.share_a as ns, p.ppg as npg,
                 case when coalesce(p.games, 0) < 3 then 0.0 else p.games / (p.games + 5.0) end as w from f left join p on f.asset_id = p.asset_id)
    select asset_id, season, case when w > 0 then g else games end as games, {r('w * coalesce(np, points) + (1 - w) * points', 4)} as points,
           {r('w * coalesce(ny, yards) + (1 - w) * yards', 2)} as yards, {r('w * coalesce(ns, share_a) + (1 - w) * share_a', 4)} as share_a,
           {r('w * coalesce(npg, ppg) + (1 - w) * ppg', 4)} as ppg, share_b from j""")
def eb_blend(t: Inputs):
    feats = latest_season(t["asset_panel"], "asset_id", "season").drop("position").withColumn("ppg", safe_ratio(F.col("points"), F.col("games")))
    d = refresh.blend_in_season(feats, to_date_frame(t, 10), "asset_id", BLENDED)
    return d.select("asset_id", "season", "games", *[grid_round(F.col(c), n).alias(c) for c, n in (("points", 4), ("yards", 2), ("share_a", 4), ("ppg", 4))], "share_b")


@query("blend_backtest", f"""
    with prior as (select asset_id, cast(points as double) / games as prior_ppg from @asset_panel where season = 2000),
    full_ as (select asset_id, sum(points) / cast(count(distinct week) as double) as true_ppg, count(distinct week) as weeks from @asset_week group by asset_id),
    pool as (select p.asset_id, prior_ppg, true_ppg, b.pool from prior p join full_ f on p.asset_id = f.asset_id
             join (values ('every season', 0), ('full season', 10)) b(pool, least_weeks) on weeks >= least_weeks),
    cuts as (select * from (values (1), (2), (8), (16)) c(cut)),
    part_ as (select w.asset_id, c.cut, count(distinct week) as g, sum(points) as pts from @asset_week w join cuts c on week <= cut group by w.asset_id, c.cut),
    j as (select pool, cut, prior_ppg, true_ppg, coalesce(g, 0) as g, coalesce(cast(pts as double) / g, prior_ppg) as s,
                 case when coalesce(g, 0) < 3 then 0.0 else g / (g + 5.0) end as w
          from pool cross join cuts left join part_ using (asset_id, cut))
    select pool, cut as through_week, count(*) as n_assets, {r('avg(g)')} as mean_games, {r('coalesce(avg(case when g > 0 then w end), 0)')} as mean_weight, {r('max(w)')} as max_weight,
           {r('avg(abs(prior_ppg - true_ppg))')} as mae_prior, {r('avg(abs(w * s + (1 - w) * prior_ppg - true_ppg))')} as mae_blended,
           avg(abs(w * s + (1 - w) * prior_ppg - true_ppg)) < avg(abs(prior_ppg - true_ppg)) as improved
    from j group by pool, cut""")
def blend_backtest(t: Inputs):
    """Over every asset with a prior, and over full seasons alone. Week 1 is the guard row: one game carries no weight."""
    prior = t["asset_panel"].where("season = 2000").select("asset_id", safe_ratio(F.col("points"), F.col("games")).alias("prior_ppg"))
    pools = F.filter(F.array(F.lit("every season"), F.when(F.col("weeks") >= refresh.FULL_GAMES, "full season")), lambda p: p.isNotNull())
    pool = prior.join(true_season(t), "asset_id").withColumn("pools", pools)
    d = refresh.blend_backtest(pool, t["asset_week"], "asset_id", "week", "points", (1, 2, 8, 16), pools="pools")
    return d.select("pool", "through_week", "n_assets", *[grid_round(F.col(c)).alias(c) for c in ("mean_games", "mean_weight", "max_weight", "mae_prior", "mae_blended")], "improved")


def true_season(t: Inputs):
    weeks = t["asset_week"].groupBy("asset_id").agg(F.countDistinct("week").alias("weeks"), F.sum("points").alias("p"))
    return weeks.select("asset_id", "weeks", safe_ratio(F.col("p"), F.col("weeks")).alias("true_ppg"))
