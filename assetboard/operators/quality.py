"""Profiles, imputation and expectations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from assetboard.functions.numeric import grid_round
from assetboard.operators.ordering import column_quantiles
from assetboard.session import land


def _stack(pairs: Sequence[tuple[str, Column]], name: str, value: str) -> Column:
    """Array of (name, value) structs, to be inlined into rows."""
    return F.array(*[F.struct(F.lit(n).alias(name), c.alias(value)) for n, c in pairs])


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str, kind: str) -> DataFrame:
    """Columns to rows, all values cast to one type."""
    return df.select(*ids, F.inline(_stack([(c, F.col(c).cast(kind)) for c in columns], name, value)))


def dq_profile(df: DataFrame, not_null: Mapping[str, str], range_col: str) -> DataFrame:
    """Row count, null counts under given names, and the range of one column."""
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(out) for c, out in not_null.items()],
        F.min(range_col).alias(f"min_{range_col}"),
        F.max(range_col).alias(f"max_{range_col}"),
    )


def missingness(df: DataFrame) -> DataFrame:
    """Missing count, fraction and percent per column that has any, worst first. One pass."""
    totals = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)],
    )
    rows = totals.select(
        "_rows",
        F.inline(_stack([(c, F.col(f"_m{i}")) for i, c in enumerate(df.columns)], "column_name", "missing_count")),
    )
    fraction = F.col("missing_count").cast("double") / F.col("_rows")
    return rows.where(F.col("missing_count") > 0).select(
        "column_name", "missing_count", fraction.alias("missing_frac"),
        grid_round(fraction * 100, 2).alias("missing_pct"),
    ).orderBy(F.desc("missing_count"), "column_name")


def missing_fractions(df: DataFrame) -> dict[str, float]:
    """One row of fractions, read back as a dict; its size is the number of columns."""
    row = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"_m{i}")
                   for i, c in enumerate(df.columns)]).first()
    return {c: row[i] for i, c in enumerate(df.columns)}


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each non-null value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n").cast("double") / total)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often.

    They are grouped as one struct, so that the counts are always merged in tasks of their own: after a join on
    one of the keys a single task would hold both sides of the join and the counts before and after merging.
    """
    counts = df.groupBy(F.struct(*keys).alias("_key")).agg(F.count("*").alias("copies"))
    return counts.where(F.col("copies") > 1).select("_key.*", "copies")


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first copy of each distinct row."""
    return duplicate_keys(df, df.columns).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows")
    )


def drop_sparse_columns(df: DataFrame, limit: float = 0.40) -> tuple[DataFrame, list[str]]:
    """Drop columns with more than ``limit`` missing (an all-null column is one of them).

    The rows are read once for the shares and once for the result, so they are written once.
    """
    df = land(df, "dense")
    dropped = [c for c, share in missing_fractions(df).items() if share is not None and (share > limit or share == 1.0)]
    return df.drop(*dropped), dropped


def drop_listed(df: DataFrame, *lists: Sequence[str]) -> DataFrame:
    """Drop leakage and id columns; names that are absent are ignored."""
    return df.drop(*[c for names in lists for c in names])


def degenerate_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whether each column has fewer than two distinct non-null values.

    The smallest and largest value decide it, so no distinct set is built.
    """
    spans = df.agg(*[(F.min(c).eqNullSafe(F.max(c))).alias(f"_d{i}") for i, c in enumerate(columns)])
    return spans.select(F.inline(_stack([(c, F.col(f"_d{i}")) for i, c in enumerate(columns)], "feature", "degenerate")))


def usable_features(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that vary; one row is read back."""
    row = df.agg(*[F.min(c).eqNullSafe(F.max(c)).alias(f"_d{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if not row[i]]


def fit_imputer(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], unknown: str = "Unknown") -> dict:
    """Fill value per column: the exact median, or the most frequent value (smallest on a tie).

    Modes come from value counts that are combined map-side; what returns to the driver is one value
    per column.
    """
    fills: dict = {}
    if numeric:
        fills.update({c: m for c, m in column_quantiles(df, numeric, 0.5).items() if m is not None})
    if categorical:
        long = unpivot(df, [], categorical, "feature", "v", "string").where(F.col("v").isNotNull())
        counts = long.groupBy("feature", "v").agg(F.count("*").alias("n"))
        modes = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("best"))
        for row in modes.collect():
            fills[row["feature"]] = row["best"]["v"]
        for c in categorical:
            fills.setdefault(c, unknown)
    return fills


def impute(df: DataFrame, fills: Mapping) -> DataFrame:
    """Replace nulls by the fitted values; whole-number columns filled by a median become double."""
    whole = {"tinyint", "smallint", "int", "bigint"}
    types = {c: "double" if kind in whole and isinstance(fills.get(c), float) else kind for c, kind in df.dtypes}
    return df.select(*[
        F.coalesce(F.col(c).cast(types[c]), F.lit(fills[c]).cast(types[c])).alias(c)
        if fills.get(c) is not None else F.col(c)
        for c in df.columns
    ])


def quantile_label(df: DataFrame, columns: Sequence[str], p: float = 0.80, out: str = "high_performer") -> DataFrame:
    """1 where every column reaches its own ``p`` quantile, else 0; a null never reaches it."""
    found = column_quantiles(df, columns, p)
    reached = reduce(lambda a, b: a & b, [F.col(c) >= F.lit(found.get(c)).cast("double") for c in columns])
    return df.withColumn(out, F.when(reached, 1).otherwise(0))


def target_consistency(df: DataFrame, minutes: str, flag: str, threshold: float = 15) -> DataFrame:
    """Share of rows, both values present, where ``minutes >= threshold`` agrees with the flag."""
    both = df.where(F.col(minutes).isNotNull() & F.col(flag).isNotNull()).select(
        ((F.col(minutes) >= threshold).cast("int") == F.col(flag)).alias("consistent")
    )
    return value_share(both, "consistent")


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Unique:
    keys: tuple[str, ...]


@dataclass(frozen=True)
class RowCount:
    expected: int


@dataclass(frozen=True)
class Share:
    name: str
    condition: Column
    at_least: float


def expectations(df: DataFrame, rules: Sequence) -> DataFrame:
    """One row per rule: observed violations (or share), and whether it passed.

    All row-level rules share one pass; each uniqueness rule adds one aggregation.
    """
    row_rules = [r for r in rules if not isinstance(r, Unique)]
    results: list[DataFrame] = []
    if row_rules:
        aggs, rows = [], []
        for i, rule in enumerate(row_rules):
            if isinstance(rule, NotNull):
                aggs.append(F.count_if(F.col(rule.column).isNull()).cast("double").alias(f"_o{i}"))
                rows.append((f"not_null({rule.column})", F.col(f"_o{i}"), F.col(f"_o{i}") == 0))
            elif isinstance(rule, RowCount):
                aggs.append(F.count("*").cast("double").alias(f"_o{i}"))
                rows.append(("row_count", F.col(f"_o{i}"), F.col(f"_o{i}") == float(rule.expected)))
            else:
                aggs.append(F.avg(F.coalesce(rule.condition, F.lit(False)).cast("double")).alias(f"_o{i}"))
                rows.append((f"share({rule.name})", F.col(f"_o{i}"), F.col(f"_o{i}") >= rule.at_least))
        packed = F.array(*[F.struct(F.lit(n).alias("rule"), o.alias("observed"), p.alias("passed")) for n, o, p in rows])
        results.append(df.agg(*aggs).select(F.inline(packed)))
    for rule in rules:
        if isinstance(rule, Unique):
            found = duplicate_keys(df, rule.keys).agg(F.count("*").cast("double").alias("observed"))
            results.append(found.select(
                F.lit(f"unique({', '.join(rule.keys)})").alias("rule"), "observed",
                (F.col("observed") == 0).alias("passed"),
            ))
    report = results[0]
    for other in results[1:]:
        report = report.unionByName(other)
    return report


def require(report: DataFrame) -> None:
    """Raise when any rule of an expectation report failed."""
    failed = [r["rule"] for r in report.where(~F.coalesce("passed", F.lit(False))).collect()]
    if failed:
        raise ValueError(f"failed expectations: {', '.join(failed)}")
