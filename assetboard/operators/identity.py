"""Entity resolution across price lists, crosswalks and draft tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from assetboard.functions.text import has_player_id_format, lenient_number, normalize_name
from assetboard.operators.joins import lookup_join
from assetboard.operators.ordering import keep_one, top_per_group

NO_MATCH = "unmatched"


@dataclass(frozen=True)
class Path:
    """One way to find a crosswalk row: source column, crosswalk column, label of the tier."""

    source: str
    target: str
    tier: str


def crosswalk(raw: DataFrame, number_ids: Sequence[str], other: Sequence[str], name: str = "name") -> DataFrame:
    """Id columns as numbers (null when not numeric), the other columns as they are, and a merge name."""
    return raw.select(
        *[lenient_number(F.col(c).cast("string"), "bigint").alias(c) for c in number_ids],
        *[F.col(c) for c in other],
        normalize_name(F.col(name)).alias("merge_name"),
    )


def key_view(table: DataFrame, key: str, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The table made unique on a non-null key, keeping the first row of ``order``."""
    wanted = list(dict.fromkeys([key, *columns]))
    return keep_one(table.where(F.col(key).isNotNull()), [key], order).select(*wanted)


def resolve(source: DataFrame, table: DataFrame, paths: Sequence[Path], ids: Sequence[str],
            anchor: str, order: Sequence[Column]) -> DataFrame:
    """Look every row up along each path and fill the id columns one by one in path order.

    A row found by its first key still takes an id that is empty there from a later match.
    ``match_tier`` names the first path that supplies ``anchor``.
    """
    found = source
    for i, path in enumerate(paths):
        view = key_view(table, path.target, ids, order)
        view = view.select(F.col(path.target).alias(f"_key{i}"), *[F.col(c).alias(f"_{c}_{i}") for c in ids])
        # An empty name is no name: as a null key it is spread over salts and matches nothing.
        texts = found.schema[path.source].dataType.simpleString() == "string"
        sought = F.nullif(F.col(path.source), F.lit("")) if texts else F.col(path.source)
        found = lookup_join(found.withColumn(f"_sought{i}", sought), view, {f"_sought{i}": f"_key{i}"})
    tier = F.lit(NO_MATCH)
    for i in reversed(range(len(paths))):
        tier = F.when(F.col(f"_{anchor}_{i}").isNotNull(), F.lit(paths[i].tier)).otherwise(tier)
    return found.select(
        *[F.col(c) for c in source.columns],
        *[F.coalesce(*[F.col(f"_{c}_{i}") for i in range(len(paths))]).alias(c) for c in ids],
        tier.alias("match_tier"),
    )


def unmatched(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("match_tier") == NO_MATCH)


def tier_counts(resolved: DataFrame, boards: Sequence[str] = ()) -> DataFrame:
    return resolved.groupBy(*boards, "match_tier").agg(F.count("*").alias("n"))


def topn_coverage(source: DataFrame, table: DataFrame, boards: Sequence[str], source_id: str, table_id: str,
                  order: Sequence[Column], n: int = 200, at_least: float = 0.95) -> DataFrame:
    """Share of each board's ``n`` most valuable rows whose primary id is known; fallbacks do not count."""
    top = top_per_group(source, boards, order, n)
    known = table.where(F.col(table_id).isNotNull()).select(F.col(table_id).alias("_known")).distinct()
    flagged = lookup_join(top, known.withColumn("_hit", F.lit(1)), {source_id: "_known"})
    matched = F.sum(F.coalesce("_hit", F.lit(0)))
    return flagged.groupBy(*boards).agg(
        F.count("*").alias("n_top"),
        matched.alias("matched"),
        (matched.cast("double") / F.count("*")).alias("coverage"),
    ).withColumn("passed", F.col("coverage") >= at_least)


def bridge_ids(rows: DataFrame, base: DataFrame, id_col: str, name_col: str, base_id: str, base_name: str,
               order: Sequence[Column]) -> DataFrame:
    """Replace a page's own ids by another page's ids for the same normalised name; keep the rest."""
    named = base.withColumn("_name", normalize_name(F.col(base_name)))
    view = key_view(named, "_name", [base_id], order).select(
        F.col("_name").alias("_bridge_name"), F.col(base_id).alias("_bridge_id")
    )
    probed = rows.withColumn("_name", normalize_name(F.col(name_col)))
    joined = lookup_join(probed, view, {"_name": "_bridge_name"})
    return joined.select(
        *[F.coalesce("_bridge_id", F.col(id_col)).alias(id_col) if c == id_col else F.col(c) for c in rows.columns],
        F.col("_bridge_id").isNotNull().alias("bridged"),
    )


def draft_capital(picks: DataFrame, id_col: str, order: Sequence[Column]) -> DataFrame:
    """Draft rows with an id, the first row of each id."""
    return keep_one(picks.where(F.col(id_col).isNotNull()), [id_col], order)


def repair_ids(draft: DataFrame, table: DataFrame, id_col: str, name_col: str, year_col: str, season: int,
               table_id: str, table_name: str, order: Sequence[Column]) -> DataFrame:
    """Re-resolve malformed ids of one season by name; every other id stays as it is.

    ``repair`` is 'kept', 'repaired' or 'unresolved'.
    """
    bad = ~has_player_id_format(F.col(id_col)) & (F.col(year_col) == season)
    named = table.where(F.col(table_id).isNotNull()).withColumn("_name", normalize_name(F.col(table_name)))
    view = key_view(named, "_name", [table_id], order).select(
        F.col("_name").alias("_fix_name"), F.col(table_id).alias("_fix")
    )
    probed = draft.withColumn("_bad", F.coalesce(bad, F.lit(False))).withColumn(
        "_name", F.when(F.col("_bad"), normalize_name(F.col(name_col)))
    )
    joined = lookup_join(probed, view, {"_name": "_fix_name"})
    fixed = F.when(F.col("_bad"), F.coalesce("_fix", F.col(id_col))).otherwise(F.col(id_col))
    return joined.select(
        *[fixed.alias(id_col) if c == id_col else F.col(c) for c in draft.columns],
        F.when(~F.col("_bad"), "kept")
        .when(has_player_id_format(fixed), "repaired")
        .otherwise("unresolved").alias("repair"),
    )


def active_ids(resolved: DataFrame, id_col: str) -> DataFrame:
    """Distinct non-null ids over all price lists."""
    return resolved.where(F.col(id_col).isNotNull()).select(id_col).distinct()
