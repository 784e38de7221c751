"""Board assembly, rankings, residuals and rules."""

from pyspark.sql import functions as F

from assetboard.functions.numeric import grid_round
from assetboard.operators import boards, learning, picks
from assetboard.plans.pricing import UNIVERSE
from assetboard.plans.registry import query, r
from assetboard.sources.stand_ins import Inputs

BOARD = ["format", "team_size"]
SIGNAL = "(college_seasons_found is null or college_seasons_found <> 0)"
RESIDUAL = "model_value - consensus_value"
RESIDUAL_PCT = f"case when consensus_value = 0 then 0 else ({RESIDUAL}) / consensus_value * 100 end"


def money(df):
    """Values to four digits, so that both engines rank the same numbers."""
    return df.withColumn("model_value", grid_round(F.col("model_value"), 4)).withColumn("consensus_value", grid_round(F.col("consensus_value"), 4))


@query("assemble_board", f"""
    with p as (select format, team_size, cast(asset_id as varchar) as asset_id, c.name, {r('model_value', 4)} as model_value, {r('consensus_value', 4)} as consensus_value,
                      'player' as asset_type, is_rookie, c.position, f.current_age from @predictions p left join @crosswalk c on p.asset_id = c.mfl_id
               left join (select p_partkey, cast(20 + p_size % 15 as int) as current_age from @part) f on f.p_partkey = p.asset_id),
    u as (select format, team_size, 'PICK-' || format || '-' || team_size || '-' || year || '-' || round || '-' || tier as asset_id,
                 year || ' Round ' || round || ' (' || tier || ')' as name, {r('pick_value', 4)} as model_value, {r('pick_value', 4)} as consensus_value,
                 'pick' as asset_type, false as is_rookie, 'PICK' as position, cast(null as int) as current_age from ({UNIVERSE}) q)
    select *, row_number() over (partition by format, team_size order by model_value desc, asset_id) as board_rank from (select * from p union all select * from u) b""")
def assemble_board(t: Inputs):
    names = t["crosswalk"].select(F.col("mfl_id").alias("asset_id"), "name")
    feats = t["part"].select(F.col("p_partkey").alias("asset_id"), F.col("p_type").alias("position"),
                             (F.col("p_size") % 15 + 20).cast("int").alias("current_age"), F.lit(None).cast("bigint").alias("college_seasons_found"))
    universe = picks.pick_universe(t["pick_list_a"], t["pick_list_b"]).withColumn("pick_value", grid_round(F.col("pick_value"), 4))
    board = boards.assemble_board(money(t["predictions"]), names, feats, universe)
    return board.select(*BOARD, "asset_id", "name", "model_value", "consensus_value", "asset_type", "is_rookie", "position", "current_age", "board_rank")


@query("board_rank", f"""
    select format, team_size, asset_id, model_value, row_number() over (partition by format, team_size order by model_value desc, asset_id) as board_rank
    from (select format, team_size, asset_id, {r('model_value', 4)} as model_value from @board) b""")
def board_rank(t: Inputs):
    return boards.ranked(money(t["board"]).select(*BOARD, "asset_id", "model_value"))


@query("divergence", f"""
    with p as (select *, {r(RESIDUAL, 4)} as res from @board where asset_type = 'player' and {SIGNAL}),
    k as (select *, row_number() over (partition by format, team_size order by res desc, asset_id) as hi, row_number() over (partition by format, team_size order by res, asset_id) as lo from p)
    select format, team_size, 'above' as side, cast(hi as int) as side_rank, asset_id, res as residual, {r(RESIDUAL_PCT, 4)} as residual_pct from k where hi <= 15
    union all select format, team_size, 'below', cast(lo as int), asset_id, res, {r(RESIDUAL_PCT, 4)} from k where lo <= 15""")
def divergence(t: Inputs):
    d = boards.divergence(t["board"])
    return d.select(*BOARD, "side", "side_rank", "asset_id", grid_round(F.col("residual"), 4).alias("residual"), grid_round(F.col("residual_pct"), 4).alias("residual_pct"))


@query("rankings_view", f"""
    select format, team_size, asset_id, position, {r(RESIDUAL, 4)} as residual from @board where asset_type = 'player' and position = 'ECONOMY' and {SIGNAL}""")
def rankings_view(t: Inputs):
    d = boards.rankings_view(boards.with_residuals(t["board"]), dynasty=True, position="ECONOMY", asset_type="player", by="residual")
    return d.select(*BOARD, "asset_id", "position", grid_round(F.col("residual"), 4).alias("residual"))


@query("top200", f"""
    select * from (select format, team_size, asset_id, model_value, cast(row_number() over (partition by format, team_size order by model_value desc, asset_id) as int) as board_rank
        from (select format, team_size, asset_id, {r('model_value', 4)} as model_value from @board) b) x where board_rank <= 200""")
def top200(t: Inputs):
    return boards.top_rows(money(t["board"]).select(*BOARD, "asset_id", "model_value"))


@query("board_movement", f"""
    select format, team_size, count(*) as n_assets, count(*) filter (where abs(model_value - consensus_value) > 1) as n_moved from @board group by format, team_size""")
def board_movement(t: Inputs):
    before = t["board"].select(*BOARD, "asset_id", F.col("consensus_value").alias("model_value"))
    return boards.board_movement(before, t["board"])


# Rules drawn from the parts: exact names, names that need normalising, and names on no board.
RULES = """
    select p_partkey as rule_id, case when p_partkey % 2 = 0 then 'top_n' else 'pairwise' end as kind,
           case when p_partkey % 3 = 0 then 'sf_dynasty' else 'redraft' end as format, 12 as team_size,
           case when p_partkey % 11 = 0 then 'Missing Name' when p_partkey % 5 = 0 then upper(p_name) || ' ' || cast(p_partkey as string) || ' Jr.'
                else p_name || ' ' || cast(p_partkey as string) end as name,
           case when p_partkey % 2 = 1 then p_name || ' ' || cast(p_partkey - p_partkey % 7 as string) end as other,
           cast(p_partkey % 900 as bigint) as n from {part}"""
RULES_SQL = f"""
    with b as (select format, team_size, name, row_number() over (partition by format, team_size order by model_value desc, asset_id) as board_rank
               from (select format, team_size, asset_id, name, {r('model_value', 4)} as model_value from @board) x),
    rules as ({RULES.replace('{part}', '@part')}),
    ask as (select *, replace(lower(name), ' jr.', '') as n1 from rules),
    j as (select a.*, h.board_rank as rank, o.board_rank as other_rank from ask a
          left join b h on h.format = a.format and h.team_size = a.team_size and h.name = a.n1 left join b o on o.format = a.format and o.team_size = a.team_size and o.name = a.other)
    select rule_id, kind, format, team_size, rank, other_rank, case when kind = 'top_n' then rank <= n else rank < other_rank end as passed,
           case when (case when kind = 'top_n' then rank <= n else rank < other_rank end) is null then 'skipped'
                when (case when kind = 'top_n' then rank <= n else rank < other_rank end) then 'passed' else 'failed' end as status,
           case when (case when kind = 'top_n' then rank <= n else rank < other_rank end) is null then (case when rank is null then name else other end) || ' not on board'
                when kind = 'top_n' then 'rank=' || rank || ' (need <= ' || n || ')' else 'rank=' || rank || ' vs rank=' || other_rank end as detail from j"""


def panel(t: Inputs):
    rules = t.spark.sql(RULES, part=t["part"])
    return boards.rule_panel(rules, boards.ranked(money(t["board"]).select(*BOARD, "asset_id", "name", "model_value")))


@query("rule_panel", RULES_SQL)
def rule_panel(t: Inputs):
    return panel(t)


@query("rule_tally", f"""
    select count(*) filter (where status = 'passed') as n_passed, count(*) filter (where status = 'failed') as n_failed,
           count(*) filter (where status = 'skipped') as n_skipped from ({RULES_SQL}) q""")
def rule_tally(t: Inputs):
    return boards.rule_tally(panel(t))


@query("rookie_discount", f"""
    select format, team_size, count(*) as n_rookies, {r('avg(1 - consensus_value * 0.9 / model_value) * 100', 4)} as mean_discount_pct
    from @predictions where is_rookie group by format, team_size""")
def rookie_discount(t: Inputs):
    given = t["predictions"].select(*BOARD, "asset_id", F.col("model_value").alias("mean_prediction"), (F.col("consensus_value") * 0.9).alias("quantile_prediction"),
                                    F.when(~F.col("is_rookie"), 1).alias("career_games"))
    d = learning.rookie_discount(learning.final_prediction(given.drop("is_rookie")), BOARD)
    return d.withColumn("mean_discount_pct", grid_round(F.col("mean_discount_pct"), 4))
