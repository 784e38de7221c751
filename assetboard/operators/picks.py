"""Future draft picks: native prices, ratios, and the completed pick universe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from assetboard.functions.numeric import safe_ratio
from assetboard.functions.text import parse_pick_name
from assetboard.operators.consensus import SECOND_SOURCE_WEIGHT
from assetboard.session import land

# Scope of the pick universe and the constants of the constructed price.
PICK_YEARS = (2027, 2028, 2029)
PICK_ROUNDS = (1, 2, 3)
PICK_TIERS = ("Early", "Mid", "Late")
DYNASTY_FORMATS = ("sf_dynasty", "oneqb_dynasty")
TEAM_SIZES = (10, 12)
TIERED_YEAR = 2027
YEAR_DISCOUNT = {2027: 0.90, 2028: 0.725, 2029: 0.50}
CLASS_STRENGTH = {2027: 1.10, 2028: 1.0, 2029: 1.0}
FLOOR_PRICE = 3000.0
PLAUSIBLE_MULTIPLIER = (0.9, 2.0)


def with_pick_fields(df: DataFrame, grammar: str) -> DataFrame:
    """Parsed year, round, tier and kind, null where the name is no pick.

    The struct is unpacked by a generator, so the patterns run once per row even when later filters
    use several of the fields.
    """
    return df.select("*", F.inline(F.array(parse_pick_name(F.col("name"), grammar))))


def native_picks(list_a: DataFrame, list_b: DataFrame, years: Sequence[int] = PICK_YEARS,
                 rounds: Sequence[int] = PICK_ROUNDS) -> DataFrame:
    """Parsed pick prices of both sources in scope.

    ``list_a``: format, team_size, name, value. ``list_b``: name, sf_value, oneqb_value (no size).
    """
    scope = F.col("year").isin(*years) & F.col("round").isin(*rounds)
    fields = ["year", "round", "tier", "kind"]
    a = with_pick_fields(list_a.where(F.col("format").isin(*DYNASTY_FORMATS)), "round_first").where(
        scope & (F.col("kind") != "slot"))
    b = with_pick_fields(list_b, "tier_first").where(scope)
    routed = F.array(
        F.struct(F.lit("sf_dynasty").alias("format"), F.col("sf_value").alias("value")),
        F.struct(F.lit("oneqb_dynasty").alias("format"), F.col("oneqb_value").alias("value")),
    )
    return a.select(F.lit("a").alias("source"), "format", F.col("team_size").cast("int").alias("team_size"), *fields, "value").unionByName(
        b.select(*fields, F.inline(routed)).select(
            F.lit("b").alias("source"), "format", F.lit(None).cast("int").alias("team_size"), *fields, "value")
    )


def tier_ratios(native: DataFrame, year: int = TIERED_YEAR) -> DataFrame:
    """Mean tier price over round price per (round, tier), from boards that price both."""
    cells = native.where((F.col("source") == "a") & (F.col("year") == year)).groupBy("format", "team_size", "round").agg(
        F.max(F.when(F.col("kind") == "aggregate", F.col("value"))).alias("whole"),
        *[F.max(F.when(F.col("tier") == t, F.col("value"))).alias(t) for t in PICK_TIERS],
    )
    ratios = cells.select("round", F.inline(F.array(*[
        F.struct(F.lit(t).alias("tier"), safe_ratio(F.col(t), F.col("whole")).alias("ratio")) for t in PICK_TIERS
    ])))
    return ratios.where(F.col("ratio").isNotNull()).groupBy("round", "tier").agg(F.avg("ratio").alias("ratio"))


def format_multiplier(list_a: DataFrame, top: str = "sf_dynasty", base: str = "oneqb_dynasty") -> DataFrame:
    """Mean price ratio of the same pick in two formats: one row overall (round null) and one per round."""
    named = with_pick_fields(list_a.where(F.col("format").isin(top, base)), "round_first").where(F.col("kind") != "slot")
    pairs = named.groupBy("team_size", "name", "round").agg(
        F.max(F.when(F.col("format") == top, F.col("value"))).alias("top"),
        F.max(F.when(F.col("format") == base, F.col("value"))).alias("base"),
    ).where(F.col("top").isNotNull() & F.col("base").isNotNull()).select("round", safe_ratio(F.col("top"), F.col("base")).alias("ratio"))
    low, high = PLAUSIBLE_MULTIPLIER
    overall = pairs.agg(F.avg("ratio").alias("multiplier"), F.count("ratio").alias("n_pairs")).select(
        F.lit(None).cast("int").alias("round"), "multiplier", "n_pairs")
    by_round = pairs.groupBy("round").agg(F.avg("ratio").alias("multiplier"), F.count("ratio").alias("n_pairs"))
    return overall.unionByName(by_round).withColumn("plausible", F.col("multiplier").between(low, high))


def pick_grid(spark: SparkSession, years: Sequence[int] = PICK_YEARS, rounds: Sequence[int] = PICK_ROUNDS) -> DataFrame:
    """Every (format, team_size, year, round, tier) in scope; its size is fixed by the parameters."""
    cell = spark.range(1)
    for name, values in (("format", DYNASTY_FORMATS), ("team_size", TEAM_SIZES), ("year", years),
                         ("round", rounds), ("tier", PICK_TIERS)):
        cell = cell.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    strength = F.create_map(*[x for y, s in CLASS_STRENGTH.items() for x in (F.lit(y), F.lit(s))])
    discount = F.create_map(*[x for y, s in YEAR_DISCOUNT.items() for x in (F.lit(y), F.lit(s))])
    return cell.drop("id").withColumn(
        "_factor",
        F.coalesce(F.try_element_at(discount, F.col("year")), F.lit(min(YEAR_DISCOUNT.values())))
        * F.coalesce(F.try_element_at(strength, F.col("year")), F.lit(1.0)),
    )


def pick_universe(list_a: DataFrame, list_b: DataFrame, weight: float = SECOND_SOURCE_WEIGHT,
                  floor_price: float = FLOOR_PRICE) -> DataFrame:
    """A price for every cell of the grid.

    First source: the tier price, else the round price times the tier ratio, else the constructed
    price. The second source is blended in where it prices the cell.
    """
    native = land(native_picks(list_a, list_b), "native-picks")  # a few hundred prices, read by four branches
    first = native.where(F.col("source") == "a")
    whole = first.where(F.col("kind") == "aggregate").groupBy("format", "team_size", "year", "round").agg(
        F.max("value").alias("_whole"))
    tiered = first.where(F.col("kind") == "tier").groupBy("format", "team_size", "year", "round", "tier").agg(
        F.max("value").alias("_tier"))
    second = native.where(F.col("source") == "b").groupBy("format", "year", "round", "tier").agg(
        F.max("value").alias("_second"))
    overall = format_multiplier(list_a).where(F.col("round").isNull()).select("multiplier").scalar()
    grid = (
        pick_grid(list_a.sparkSession)
        .join(tiered, ["format", "team_size", "year", "round", "tier"], "left")
        .join(whole, ["format", "team_size", "year", "round"], "left")
        .join(tier_ratios(native), ["round", "tier"], "left")
        .join(second, ["format", "year", "round", "tier"], "left")
    )
    derived = F.col("_whole") * F.col("ratio")
    constructed = F.coalesce("_whole", F.lit(floor_price)) * F.col("_factor") * overall
    priced = grid.withColumn("first_value", F.coalesce(F.col("_tier"), derived, constructed)).withColumn(
        "price_origin",
        F.when(F.col("_tier").isNotNull(), "native").when(derived.isNotNull(), "derived").otherwise("constructed"),
    )
    return priced.select(
        "format", "team_size", "year", "round", "tier", "first_value", "price_origin",
        F.coalesce(F.col("first_value") * F.lit(1 - weight) + F.col("_second") * F.lit(weight), F.col("first_value")).alias("pick_value"),
    )
