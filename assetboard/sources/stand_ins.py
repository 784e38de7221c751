"""Stand-in inputs: views over the shared test tables in the shape the operators read.

The texts are SQL that Spark and DuckDB both accept, so a query and its oracle start from the same
input. ``@name`` refers to another view or to a table; ``DAYS(later, earlier)`` is the day
difference and ``ARRAYAGG(x)`` collects a short array.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

FORMAT = "case l_returnflag when 'A' then 'sf_dynasty' when 'N' then 'oneqb_dynasty' else 'redraft' end"
SIZE = "case l_linestatus when 'F' then 10 else 12 end"
CENTS = "cast(floor(l_extendedprice * 100 + 0.5) as bigint)"
YEAR = "cast(year(l_shipdate) as int)"
WORD = "case {r} when 1 then '1st' when 2 then '2nd' when 3 then '3rd' else cast({r} as string) || 'th' end"
TIER = "case {t} when 0 then 'Early' when 1 then 'Mid' else 'Late' end"
PLAYER_ID = "'00-' || lpad(cast({k} as string), 7, '0')"

VIEWS = {
    # one row per asset and season
    "asset_panel": f"""
        select l_partkey as asset_id, p_type as position, {YEAR} as season,
               cast(count(distinct cast(l_shipdate as date)) as bigint) as games,
               cast(sum(cast(l_quantity as bigint)) as bigint) as points,
               cast(sum({CENTS}) as bigint) as yards,
               cast(sum(cast(floor(l_discount * 100 + 0.5) as bigint)) as double) / cast(count(*) as double) as share_a,
               cast(sum(cast(floor(l_tax * 100 + 0.5) as bigint)) as double) / cast(count(*) as double) as share_b
        from @lineitem join @part on l_partkey = p_partkey
        where l_partkey % 9 <> 8
        group by l_partkey, p_type, {YEAR}""",
    # one row per asset and week of one season
    "asset_week": f"""
        select l_partkey as asset_id, cast(floor((dayofyear(l_shipdate) - 1) / 7.0) as int) + 1 as week,
               cast(sum(cast(l_quantity as bigint)) as bigint) as points,
               cast(sum({CENTS}) as bigint) as yards,
               cast(sum(cast(floor(l_discount * 100 + 0.5) as bigint)) as double) / cast(count(*) as double) as share_a
        from @lineitem where {YEAR} = 2001
        group by l_partkey, cast(floor((dayofyear(l_shipdate) - 1) / 7.0) as int) + 1""",
    "game_share": f"""
        select 'P' || cast(l_partkey as string) as pfr_player_id, {YEAR} as season,
               cast(floor(l_discount * 100 + 0.5) as double) as offense_pct
        from @lineitem""",
    "draft": """
        select p_partkey as asset_id, cast(1994 + p_partkey % 9 as int) as draft_year,
               cast(1 + p_partkey % 3 as int) as round, cast(1 + p_partkey % 32 as int) as pick,
               cast(20 + p_size % 5 as int) as age_at_draft, p_brand as college, p_type as position
        from @part where p_partkey % 11 <> 0""",
    # draft rows under text ids: repeated ids, null ids and malformed ids
    "draft_raw": f"""
        select case when p_partkey % 31 = 0 then cast(null as string)
                    when p_partkey % 5 = 0 then 'NEW' || cast(p_partkey as string)
                    when p_partkey % 17 = 0 then {PLAYER_ID.format(k='p_partkey - 1')}
                    else {PLAYER_ID.format(k='p_partkey')} end as gsis_id,
               p_partkey as row_id, cast(1994 + p_partkey % 9 as int) as draft_year,
               case when p_partkey % 7 = 0 then 'Gone ' || cast(p_partkey as string)
                    else upper(p_name) || ' ' || cast(p_partkey as string) || ' Jr.' end as draft_name
        from @part""",
    "crosswalk_raw": f"""
        select cast(p_partkey as string) as mfl_id,
               case when p_partkey % 6 = 0 then 'NA' else cast(100000 + p_partkey as string) || '.0' end as espn_id,
               case when p_partkey % 8 = 0 then '' else cast(200000 + p_partkey as string) end as ktc_id,
               {PLAYER_ID.format(k='p_partkey')} as gsis_id,
               case when p_partkey % 3 = 0 then cast(null as string) else 'P' || cast(p_partkey as string) end as pfr_id,
               cast(p_partkey as string) || '.0' as sleeper_id,
               p_name || ' ' || cast(p_partkey as string) as name, p_type as position,
               case when p_partkey % 10 = 0 then cast(null as string) else p_brand end as team
        from @part""",
    "crosswalk": f"""
        select p_partkey as mfl_id,
               case when p_partkey % 6 = 0 then cast(null as bigint) else 100000 + p_partkey end as espn_id,
               case when p_partkey % 8 = 0 then cast(null as bigint) else 200000 + p_partkey end as ktc_id,
               {PLAYER_ID.format(k='p_partkey')} as gsis_id,
               case when p_partkey % 3 = 0 then cast(null as string) else 'P' || cast(p_partkey as string) end as pfr_id,
               p_name || ' ' || cast(p_partkey as string) as name, p_type as position,
               p_name || ' ' || cast(p_partkey as string) as merge_name
        from @part""",
    "price_a": f"""
        select {FORMAT} as format, {SIZE} as team_size, l_partkey as true_id, p_type as position,
               case when l_partkey % 180 = 0 then 'No Body' else upper(p_name) || ' ' || cast(l_partkey as string) || ' Jr.' end as name,
               case when l_partkey % 180 = 0 then 'no body' else p_name || ' ' || cast(l_partkey as string) end as merge_name,
               case when l_partkey % 9 = 0 then cast(null as bigint) else l_partkey end as src_mfl_id,
               case when l_partkey % 4 = 0 then cast(null as bigint) else 100000 + l_partkey end as src_espn_id,
               cast(sum({CENTS}) as double) / 100 as value
        from @lineitem join @part on l_partkey = p_partkey
        group by {FORMAT}, {SIZE}, l_partkey, p_type, p_name""",
    "price_b": f"""
        select {FORMAT} as format, l_partkey as true_id, 200000 + l_partkey as src_ktc_id,
               p_name || ' ' || cast(l_partkey as string) as merge_name,
               cast(sum(cast(l_quantity as bigint)) as double) as value
        from @lineitem join @part on l_partkey = p_partkey where l_partkey % 5 <> 0
        group by {FORMAT}, l_partkey, p_name""",
    "page_dynasty": """
        select l_partkey as true_id, 200000 + l_partkey as player_id, p_name || ' ' || cast(l_partkey as string) as name,
               cast(sum(case when l_returnflag = 'A' then cast(l_quantity as bigint) end) as double) as sf_value,
               cast(sum(case when l_returnflag = 'N' then cast(l_quantity as bigint) end) as double) as oneqb_value
        from @lineitem join @part on l_partkey = p_partkey where l_partkey % 5 <> 0
        group by l_partkey, p_name""",
    "page_redraft": """
        select l_partkey as true_id,
               case when l_partkey % 3 = 0 then 200000 + l_partkey else 700000 + l_partkey end as player_id,
               'The.' || p_name || ' ' || cast(l_partkey as string) as raw_name,
               case when l_partkey % 13 = 0 then 'Other ' else '' end || p_name || ' ' || cast(l_partkey as string) as name,
               cast(sum(cast(l_quantity as bigint)) as double) as oneqb_value
        from @lineitem join @part on l_partkey = p_partkey where l_returnflag = 'R' and l_partkey % 5 <> 0
        group by l_partkey, p_name""",
    "combine": """
        select case when p_partkey % 3 = 0 then cast(null as string) else 'P' || cast(p_partkey as string) end as pfr_id,
               case when p_partkey % 4 = 0 then 'nobody' else p_name || ' ' || cast(p_partkey as string) end as merge_name,
               p_type as pos, cast(1994 + p_partkey % 9 as int) as draft_year,
               case when p_size % 13 = 0 then cast(null as double) when p_size % 17 = 0 then cast(0 as double)
                    else cast(42 + p_size % 10 as double) / 10 end as forty,
               cast(180 + p_size as double) as wt, cast(70 + p_size % 9 as double) as ht
        from @part
        union all
        select 'P' || cast(p_partkey as string) as pfr_id, p_name || ' ' || cast(p_partkey as string) as merge_name,
               p_type as pos, cast(1990 + p_partkey % 3 as int) as draft_year, cast(5 as double) as forty,
               cast(200 as double) as wt, cast(75 as double) as ht
        from @part where p_partkey % 7 = 0""",
    "college_seasons": f"""
        select l_partkey as asset_id, cast(floor(l_partkey / 45.0) as bigint) as team, {YEAR} as yr,
               cast(sum({CENTS}) as bigint) as yards, cast(sum(cast(l_quantity as bigint)) as bigint) as scores
        from @lineitem where l_partkey % 9 = 8
        group by l_partkey, cast(floor(l_partkey / 45.0) as bigint), {YEAR}""",
    "college_teams": """
        select team, yr,
               case when (team + yr) % 11 = 0 then cast(null as bigint) when (team + yr) % 13 = 0 then cast(0 as bigint)
                    else cast(sum(yards) as bigint) end as team_yards,
               cast(sum(scores) as bigint) as team_scores
        from @college_seasons group by team, yr""",
    "college_long": """
        select asset_id, team, yr, 'YDS' as stat_type, cast(yards as bigint) as stat from @college_seasons
        union all
        select asset_id, team, yr, 'TD' as stat_type, cast(scores as bigint) as stat from @college_seasons""",
    "weather": """
        select ts as event_timestamp, value as temperature_c, cast(event_id % 37 as double) as wind_speed_kph,
               cast(event_id % 101 as double) as relative_humidity, hour(ts) between 6 and 18 as is_day
        from @events""",
    "members": """
        select c_custkey as member_id, first_order as join_date,
               date '2024-01-01' + cast(c_custkey % 40 as int) as last_visit_date,
               case when c_custkey % 17 = 0 then cast(null as int) else cast(18 + c_custkey % 60 as int) end as age,
               case when c_custkey % 2 = 0 then 'F' else 'M' end as gender, c_mktsegment as membership_type,
               case when c_custkey % 23 = 0 then cast(null as boolean) else c_acctbal < 2000 end as churn
        from @customer left join (select o_custkey, min(cast(o_orderdate as date)) as first_order from @orders group by o_custkey) o
          on c_custkey = o_custkey""",
    "flights": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice as fare,
               case when l_orderkey % 50 = 0 then cast(null as int) else cast(DAYS(l_shipdate, o_orderdate) as int) end as arr_delay_minutes,
               case when l_orderkey % 50 = 0 then cast(null as int) when DAYS(l_shipdate, o_orderdate) >= 1000 then 1 else 0 end as arr_del15,
               case when l_linenumber = 7 and l_partkey % 10 = 0 then 1 else 0 end as cancelled,
               case when l_linenumber = 6 and l_partkey % 10 = 0 then 1 else 0 end as diverted,
               case when l_partkey % 13 = 0 then cast(null as double) else l_quantity end as distance,
               cast(year(o_orderdate) * 12 + month(o_orderdate) as int) as booked_month,
               case when l_suppkey % 11 = 0 then cast(null as string) else l_returnflag end as carrier,
               o_orderpriority as cabin,
               case when l_partkey % 2 = 0 then l_tax end as sparse_col
        from @lineitem join @orders on l_orderkey = o_orderkey""",
    "scored": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, arr_del15 as label, carrier,
               case when l_suppkey % 17 <> 0 then cast((l_partkey * 7 + l_linenumber * 13 + coalesce(arr_del15, 0) * 200) % 1000 as double) / 1000 end as p,
               case when l_suppkey % 19 <> 0 then cast((l_partkey * 11 + l_linenumber * 5 + coalesce(arr_del15, 0) * 90) % 1000 as double) / 1000 end as p2
        from @flights""",
    "reps": """
        select c_custkey as rep_id, c_acctbal as nps, feedback, years, age, c_mktsegment as business, n_name as nation
        from (select o_custkey, cast(sum(cast(floor(o_totalprice * 100 + 0.5) as bigint)) as bigint) as feedback,
                     cast(count(*) as bigint) as years, cast(20 + max(o_orderkey) % 40 as bigint) as age
              from @orders group by o_custkey) o
        join @customer on c_custkey = o_custkey join @nation on c_nationkey = n_nationkey""",
    # the published board: players and a few picks, with given predictions
    "board": """
        select format, team_size, cast(true_id as string) as asset_id, cast(true_id as string) as sleeper_id,
               merge_name as name, case when true_id % 29 = 0 then 'PICK' else position end as position,
               case when true_id % 10 = 0 then cast(null as string) else 'T' || cast(true_id % 32 as string) end as team,
               case when true_id % 29 = 0 then 'pick' else 'player' end as asset_type,
               value * cast(80 + true_id % 41 as double) / 100 as model_value, value as consensus_value,
               case when true_id % 9 = 8 then true_id % 3 end as college_seasons_found,
               cast(21 + true_id % 15 as int) as current_age
        from @price_a""",
    "predictions": """
        select format, team_size, true_id as asset_id, value * cast(80 + true_id % 41 as double) / 100 as model_value,
               value as consensus_value, true_id % 9 = 8 as is_rookie
        from @price_a""",
    "pick_rows": f"""
        select {FORMAT} as format, {SIZE} as team_size, 2026 + l_partkey % 5 as y, 1 + l_suppkey % 5 as r, l_linenumber % 4 as t,
               cast(sum({CENTS}) as double) / cast(count(*) as double) / 100 as value
        from @lineitem
        group by {FORMAT}, {SIZE}, 2026 + l_partkey % 5, 1 + l_suppkey % 5, l_linenumber % 4""",
    "pick_list_a": f"""
        select format, team_size, name, max(value) as value from (
            select format, team_size, value,
                   case when y = 2026 then '2026 Pick 1.0' || cast(r as string)
                        when y = 2027 and t < 3 then '2027 ' || {WORD.format(r='r')} || ' (' || {TIER.format(t='t')} || ')'
                        else cast(y as string) || ' ' || {WORD.format(r='r')} end as name
            from @pick_rows where not (y = 2029 and r = 3) and not (y = 2027 and r = 2 and t = 1)) x
        group by format, team_size, name""",
    "pick_list_b": f"""
        select cast(y as string) || ' ' || {TIER.format(t='t')} || ' ' || {WORD.format(r='r')} as name,
               max(case when format = 'sf_dynasty' then value end) as sf_value,
               max(case when format = 'oneqb_dynasty' then value end) as oneqb_value
        from @pick_rows where t < 3 and y in (2027, 2028)
        group by cast(y as string) || ' ' || {TIER.format(t='t')} || ' ' || {WORD.format(r='r')}""",
    "rosters": """
        select league_id, roster_id, (league_id * 12 + roster_id) % 130 as owner_id, ARRAYAGG(raw_id) as players
        from @roster_raw group by league_id, roster_id""",
    "roster_raw": """
        select cast(floor(p_partkey / 400.0) as bigint) as league_id, p_partkey % 12 as roster_id, p_partkey as asset_id,
               cast(p_partkey as string) || case when p_partkey % 2 = 0 then '.0' else '' end as raw_id
        from @part where p_partkey % 7 <> 0""",
    "users": """
        select s_suppkey as user_id, case when s_suppkey % 3 = 0 then cast(null as string) else s_name end as display_name,
               case when s_suppkey % 2 = 0 then 'Team ' || cast(s_suppkey as string) end as team_name
        from @supplier""",
    "traded_picks": """
        select cast(floor(p_partkey / 400.0) as bigint) as league_id, cast(2027 + p_partkey % 3 as int) as year,
               cast(1 + p_size % 3 as int) as round, p_partkey % 12 as original_roster, max((p_partkey * 7) % 12) as new_owner
        from @part where p_partkey % 10 = 0
        group by cast(floor(p_partkey / 400.0) as bigint), cast(2027 + p_partkey % 3 as int), cast(1 + p_size % 3 as int), p_partkey % 12""",
    "trades": """
        select cast(floor(p_partkey / 4.0) as bigint) as trade_id, case when p_partkey % 3 = 0 then 'A' else 'B' end as side,
               cast(p_partkey as string) as asset_id
        from @part""",
    "ranking_pages": """
        select page_id, replace(html, '</head>', '<script>var playersArray = [{"playerName": "' || 'Page ' || cast(page_id as string)
               || '", "position": "WR", "playerID": ' || cast(page_id as string) || ', "oneQBValues": {"value": ' || cast(length(url) as string)
               || '}, "superflexValues": {"value": ' || cast(length(url) * 2 as string) || '}},\n {"playerName": "Pick", "position": "RDP", "playerID": '
               || cast(page_id + 100000 as string) || ', "oneQBValues": {"value": 7}, "superflexValues": {"value": null}}]; var after = [1];</script></head>') as html
        from @pages""",
    "price_payload": """
        select event_id, '[{"player": {"name": "' || event_type || ' ' || cast(user_id as string) || '", "position": "WR", "mflId": "' || cast(user_id as string)
               || '"' || case when event_id % 3 = 0 then ', "espnId": "x' || cast(user_id as string) || '"' else ', "espnId": ' || cast(event_id as string) end
               || case when event_id % 2 = 0 then ', "sleeperId": "' || cast(event_id as string) || '"' else '' end
               || '}, "value": ' || cast(event_id % 1000 as string) || case when event_id % 5 = 0 then '' else ', "overallRank": ' || cast(event_id % 50 as string) end || '}]' as payload
        from @events""",
}

_REF = re.compile(r"@(\w+)")
_DAYS = re.compile(r"DAYS\((\w+), (\w+)\)")
_ARRAY = re.compile(r"ARRAYAGG\((\w+)\)")


def _spark_text(text: str) -> str:
    text = _DAYS.sub(r"datediff(cast(\1 as date), cast(\2 as date))", text)
    return _ARRAY.sub(r"collect_list(\1)", text)


def _duck_text(text: str) -> str:
    text = _DAYS.sub(r"date_diff('day', cast(\2 as date), cast(\1 as date))", text)
    return _ARRAY.sub(r"list(\1)", text)


class Inputs:
    """Tables and stand-in views of one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                text = _spark_text(VIEWS[name])
                parts = {ref: self[ref] for ref in dict.fromkeys(_REF.findall(text))}
                # Braces would be read as format fields, so literal ones are doubled first.
                text = _REF.sub(r"{\1}", text.replace("{", "{{").replace("}", "}}"))
                self._frames[name] = self.spark.sql(text, **parts)
        return self._frames[name]


def oracle_text(sql: str) -> str:
    """SQL with ``@name`` references as one DuckDB statement: the views it needs come first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for ref in _REF.findall(text):
            if ref in VIEWS and ref not in order:
                visit(VIEWS[ref])
                order.append(ref)

    visit(sql)
    ctes = [f"{name} as ({_duck_text(_REF.sub(r'\1', VIEWS[name])).strip()})" for name in order]
    body = _REF.sub(r"\1", _duck_text(sql)).strip()
    if not ctes:
        return body
    if body[:5].lower() == "with ":
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body
