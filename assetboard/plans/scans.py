"""Scans, sinks and marts."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assetboard.functions.numeric import grid_round
from assetboard.operators import marts
from assetboard.operators.boards import board_metadata, index_coverage, published, ranked, search_index
from assetboard.plans.registry import query, r
from assetboard.session import scratch_path
from assetboard.sources import readers, sinks
from assetboard.sources.stand_ins import Inputs

MEMBER_COLUMNS = "member_id, join_date, last_visit_date, age, gender, membership_type, churn"


@query("scan_csv", "select c_custkey, c_name || ' é' as c_name, c_nationkey, c_acctbal, c_mktsegment from @customer")
def scan_csv(t: Inputs):
    path = scratch_path(t.spark, "customers-csv")
    source = t["customer"].withColumn("c_name", F.concat("c_name", F.lit(" é")))
    sinks.export_csv(source, path, encoding="ISO-8859-1")
    return readers.read_delimited(t.spark, path, source.schema)


@query("raw_copy", f"select {MEMBER_COLUMNS} from @members")
def raw_copy(t: Inputs):
    return sinks.raw_copy(t["members"], scratch_path(t.spark, "members-raw"))


@query("curated_members", f"""
    select {MEMBER_COLUMNS}, cast(date_diff('day', join_date, last_visit_date) as int) as tenure_days,
           case when churn then 1 else 0 end as churn_label
    from @members where last_visit_date between date '2024-01-05' and date '2024-01-20'""")
def curated_members(t: Inputs):
    mart = sinks.partitioned_mart(marts.curated_members(t["members"]), scratch_path(t.spark, "members-curated"), ["last_visit_date"])
    return mart.where(F.col("last_visit_date").between("2024-01-05", "2024-01-20"))


@query("export_csv", f"select {MEMBER_COLUMNS} from @members")
def export_csv(t: Inputs):
    path = scratch_path(t.spark, "members-csv")
    sinks.export_csv(t["members"], path)
    return readers.read_delimited(t.spark, path, t["members"].schema, encoding="UTF-8")


@query("json_prices", """
    select event_id, event_type || ' ' || cast(user_id as varchar) as name, 'WR' as position, user_id as mfl_id,
           case when event_id % 2 = 0 then cast(event_id as varchar) end as sleeper_id,
           case when event_id % 3 <> 0 then event_id end as espn_id,
           cast(event_id % 1000 as double) as value, case when event_id % 5 <> 0 then cast(event_id % 50 as int) end as overall_rank
    from @events""")
def json_prices(t: Inputs):
    return readers.price_rows(t["price_payload"], "payload", ["event_id"])


@query("html_embedded_json", r"""
    with found as (select page_id, from_json(regexp_extract(html, 'playersArray\s*=\s*(\[.*?\]);', 1, 's'),
        '[{"playerName":"VARCHAR","position":"VARCHAR","playerID":"BIGINT","oneQBValues":{"value":"DOUBLE"},"superflexValues":{"value":"DOUBLE"}}]') as a
        from @ranking_pages),
    items as (select page_id, unnest(a) as d from found)
    select page_id, d.playerName as name, d.position as position, d.playerID as player_id,
           d.oneQBValues.value as oneqb_value, d.superflexValues.value as sf_value from items""")
def html_embedded_json(t: Inputs):
    return readers.ranking_rows(t["ranking_pages"], "html", ["page_id"])


@query("arrays_to_rows", """
    select cast(ts as date) as day, ts as event_timestamp, value as temperature_c, event_id % 37 as wind from @events""")
def arrays_to_rows(t: Inputs):
    # One payload of parallel hourly arrays per event block, as a weather service would send it.
    # A payload holds at most 100 readings.
    payload = t["events"].groupBy(F.to_date("ts").alias("day"), F.floor(F.col("event_id") / 100).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("ts", "value", (F.col("event_id") % 37).alias("wind")))).alias("r"))
    arrays = payload.select("day", F.col("r.ts").alias("event_timestamp"), F.col("r.value").alias("temperature_c"), F.col("r.wind").alias("wind"))
    return readers.parallel_arrays(arrays, ["event_timestamp", "temperature_c", "wind"], ["day"])


@query("weather_daily", f"""
    select cast(event_timestamp as date) as weather_date, {r('avg(temperature_c)')} as avg_daily_temperature_c,
           {r('avg(wind_speed_kph)')} as avg_daily_wind_speed_kph, {r('avg(relative_humidity)')} as avg_daily_relative_humidity,
           {r('sum(case when is_day then 1 else 0 end) / count(*)')} as day_proportion
    from @weather group by 1""")
def weather_daily(t: Inputs):
    d = marts.weather_daily(t["weather"])
    return d.select("weather_date", *[grid_round(F.col(c)).alias(c) for c in d.columns if c != "weather_date"])


@query("weather_monthly", f"""
    select cast(year(event_timestamp) as int) as year, cast(month(event_timestamp) as int) as month, {r('avg(temperature_c)')} as avg_temperature_c,
           {r('avg(wind_speed_kph)')} as avg_wind_speed_kph, {r('avg(relative_humidity)')} as avg_relative_humidity
    from @weather group by 1, 2""")
def weather_monthly(t: Inputs):
    d = marts.weather_monthly(t["weather"])
    return d.select("year", "month", *[grid_round(F.col(c)).alias(c) for c in d.columns if c not in ("year", "month")])


@query("member_weather", f"""
    with d as (select cast(event_timestamp as date) as day, avg(temperature_c) as t, avg(wind_speed_kph) as w, avg(relative_humidity) as h,
                      avg(case when is_day then 1.0 else 0.0 end) as p from @weather group by 1)
    select member_id, case when churn then 1 else 0 end as churn_label, cast(date_diff('day', join_date, last_visit_date) as int) as tenure_days,
           age, gender, membership_type, {r('t')} as avg_daily_temperature_c, {r('w')} as avg_daily_wind_speed_kph,
           {r('h')} as avg_daily_relative_humidity, {r('p')} as day_proportion
    from @members left join d on last_visit_date = d.day""")
def member_weather(t: Inputs):
    d = marts.member_weather(marts.curated_members(t["members"]), t["weather"])
    plain = d.columns[:6]
    return d.select(*plain, *[grid_round(F.col(c)).alias(c) for c in d.columns[6:]])


def _published(t: Inputs):
    directory = t["crosswalk_raw"].select(F.col("mfl_id").alias("asset_id"), "sleeper_id", "team")
    board = t["board"].drop("sleeper_id", "team").withColumn("year", F.lit(None).cast("int")).withColumn(
        "round", F.lit(None).cast("int")).withColumn("tier", F.lit(None).cast("string"))
    return published(board, directory)


@query("board_sink", f"""
    select b.format, b.team_size, b.asset_id, c.sleeper_id, b.name, b.position, c.team, b.asset_type, {r('model_value', 4)} as model_value, consensus_value,
           {r('model_value - consensus_value', 4)} as residual,
           {r('case when consensus_value = 0 then 0 else (model_value - consensus_value) / consensus_value * 100 end', 4)} as residual_pct,
           current_age, college_seasons_found, cast(null as int) as year, cast(null as int) as round, cast(null as varchar) as tier
    from @board b left join @crosswalk_raw c on b.asset_id = c.mfl_id""")
def board_sink(t: Inputs):
    path = scratch_path(t.spark, "boards")
    board = _published(t)
    board = board.select(*[grid_round(F.col(c), 4).alias(c) if c in ("model_value", "residual", "residual_pct") else F.col(c) for c in board.columns])
    sinks.write_boards(board, path)
    fields = [f for f in board.schema if f.name not in ("format", "team_size")] + [board.schema["format"], board.schema["team_size"]]
    return readers.read_board(t.spark, path, StructType(fields))


@query("snapshot_sink", f"""
    select d.snapshot_date, format, team_size, asset_id, model_value, row_number() over (partition by d.snapshot_date, format, team_size order by model_value desc, asset_id) as board_rank
    from (select format, team_size, asset_id, {r('model_value', 4)} as model_value from @board) b
    cross join (values (date '2026-08-18'), (date '2026-08-19')) d(snapshot_date)""")
def snapshot_sink(t: Inputs):
    path = scratch_path(t.spark, "snapshots")
    board = ranked(t["board"].select("format", "team_size", "asset_id", grid_round(F.col("model_value"), 4).alias("model_value")))
    for day in ("2026-08-18", "2026-08-19"):
        sinks.write_snapshot(board, path, day)
    return t.spark.read.csv(path, header=True, schema="asset_id string, model_value double, board_rank bigint, snapshot_date date, format string, team_size int")


@query("board_metadata", """
    select 2026 as season, array_to_string(list_sort(list(distinct format || '_' || cast(team_size as varchar))), ',') as formats,
           count(*) filter (where format = 'sf_dynasty' and team_size = 12 and asset_type = 'player') as player_count,
           count(*) filter (where format = 'sf_dynasty' and team_size = 12 and asset_type = 'pick') as pick_count
    from @board""")
def board_metadata_query(t: Inputs):
    return board_metadata(t["board"], 2026).withColumn("formats", F.array_join("formats", ","))


@query("search_index", """
    select asset_id, sleeper_id, name, position, team, asset_type from (
        select b.asset_id, c.sleeper_id, b.name, b.position, c.team, b.asset_type,
               row_number() over (partition by b.asset_id order by format, team_size) as k
        from @board b left join @crosswalk_raw c on b.asset_id = c.mfl_id) x where k = 1""")
def search_index_query(t: Inputs):
    return search_index(_published(t))


@query("index_coverage", f"""
    with i as (select distinct b.asset_id, c.sleeper_id, c.team from @board b left join @crosswalk_raw c on b.asset_id = c.mfl_id)
    select count(*) as n_assets, {r('avg(case when sleeper_id is not null then 1.0 else 0.0 end)')} as id_coverage,
           {r('avg(case when team is not null then 1.0 else 0.0 end)')} as team_coverage from i""")
def index_coverage_query(t: Inputs):
    d = index_coverage(search_index(_published(t)))
    return d.select("n_assets", grid_round(F.col("id_coverage")).alias("id_coverage"), grid_round(F.col("team_coverage")).alias("team_coverage"))
