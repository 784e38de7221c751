"""Distributed ranks, sums and quantiles against brute force, with hot groups and ties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assetboard.operators import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, a third of those with one value, some nulls, a group of one."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{i % 40}"
        v = 5.0 if i % 9 == 0 else float(rng.integers(0, 400)) / 4
        rows.append((g, None if i % 50 == 1 else v, i))
    rows += [("single", 1.0, 9000), ("empty", None, 9001), (None, 2.0, 9002), (None, 3.0, 9003)]
    pdf = pd.DataFrame(rows, columns=["g", "v", "id"])
    df = spark.createDataFrame(rows, "g string, v double, id bigint").repartition(7).cache()
    return df, pdf


def test_row_positions(skewed):
    df, pdf = skewed
    got = ordering.row_positions(df.where("v is not null"), ["g"], [F.desc("v"), F.asc("id")], "pos", "size").toPandas()
    want = pdf.dropna(subset=["v"]).sort_values(["v", "id"], ascending=[False, True])
    want["pos"] = want.groupby("g", dropna=False).cumcount()
    want["size"] = want.groupby("g", dropna=False)["id"].transform("count")
    merged = got.merge(want, on="id", suffixes=("", "_w"))
    assert len(merged) == len(want) == len(got)
    assert (merged["pos"] == merged["pos_w"]).all() and (merged["size"] == merged["size_w"]).all()


def test_prefix_sums(skewed):
    df, pdf = skewed
    data = df.where("v is not null")
    got = ordering.prefix_sums(data, ["g"], [F.col("v"), F.col("id")], {"before": "v"}, {"whole": "before"}).toPandas()
    want = pdf.dropna(subset=["v"]).sort_values(["v", "id"])
    want["before"] = want.groupby("g", dropna=False)["v"].cumsum() - want["v"]
    want["whole"] = want.groupby("g", dropna=False)["v"].transform("sum")
    merged = got.merge(want, on="id", suffixes=("", "_w"))
    assert len(merged) == len(want)
    assert np.allclose(merged["before"], merged["before_w"]) and np.allclose(merged["whole"], merged["whole_w"])


def test_average_rank_equals_pandas(skewed):
    df, pdf = skewed
    got = ordering.average_rank(df.where("g is not null"), ["g"], "v", "r", "p").toPandas()
    pdf = pdf[pdf["g"].notna()].copy()
    pdf["r"] = pdf.groupby("g")["v"].rank()
    pdf["p"] = pdf.groupby("g")["v"].rank(pct=True)
    merged = got.merge(pdf, on="id", suffixes=("", "_w"))
    assert len(merged) == len(pdf)
    assert np.allclose(merged["r"], merged["r_w"], equal_nan=True) and np.allclose(merged["p"], merged["p_w"], equal_nan=True)


def test_exact_quantiles(skewed):
    df, pdf = skewed
    probs = {"a": 0.0, "q": 0.25, "m": 0.5, "h": 0.8, "z": 1.0}
    got = ordering.exact_quantiles(df, ["g"], "v", probs).toPandas()
    groups = pdf.dropna(subset=["v"]).groupby("g", dropna=False)["v"]
    assert len(got) == groups.ngroups
    for row in got.itertuples():
        values = pdf[pdf["g"].isna() if row.g is None else pdf["g"] == row.g]["v"].dropna()
        for name, p in probs.items():
            assert np.isclose(getattr(row, name), np.quantile(values, p))
    whole = ordering.exact_quantiles(df, [], "v", {"m": 0.5}).first()[0]
    assert np.isclose(whole, pdf["v"].median())


def test_exact_quantiles_when_the_bracket_misses(skewed, monkeypatch):
    df, pdf = skewed
    # A bracket around the wrong place leaves the median outside, so all values must be ordered.
    monkeypatch.setattr(ordering.F, "percentile_approx", lambda c, e, a: F.array(F.max(c) + 1, F.max(c) + 2))
    assert np.isclose(ordering.exact_quantiles(df, [], "v", {"m": 0.5}).first()[0], pdf["v"].median())


def test_column_quantiles(skewed, spark, monkeypatch):
    df, pdf = skewed
    wide = df.select("v", (F.col("id") % 7).alias("w"), F.lit(None).cast("double").alias("none"))
    want = {"v": pdf["v"].quantile(0.8), "w": (pdf["id"] % 7).quantile(0.8)}
    for _ in range(2):
        got = ordering.column_quantiles(wide, ["v", "w", "none"], 0.8)
        assert np.isclose(got["v"], want["v"]) and np.isclose(got["w"], want["w"]) and got["none"] is None
        monkeypatch.setattr(ordering.F, "percentile_approx", lambda c, e, a: F.array(F.max(c) + 1, F.max(c) + 2))


def test_hash_positions_are_a_stable_permutation(skewed):
    df, pdf = skewed
    first = ordering.hash_positions(df, ["g"], ["id"], 474).toPandas().sort_values("id")
    again = ordering.hash_positions(df.repartition(3), ["g"], ["id"], 474).toPandas().sort_values("id")
    assert (first["position"].values == again["position"].values).all()
    for _, part in first.groupby("g", dropna=False):
        assert sorted(part["position"]) == list(range(len(part))) and (part["group_size"] == len(part)).all()
    other = ordering.hash_positions(df, ["g"], ["id"], 13).toPandas().sort_values("id")
    assert (other["position"].values != first["position"].values).any()


def test_top_per_group_is_limited_before_the_shuffle(spark, skewed):
    df, pdf = skewed
    top = ordering.top_per_group(df.where("v is not null"), ["g"], [F.desc("v"), F.asc("id")], 3, "k")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    want = pdf.dropna(subset=["v"]).sort_values(["v", "id"], ascending=[False, True]).groupby("g", dropna=False).head(3)
    assert sorted(r["id"] for r in top.collect()) == sorted(want["id"])


def test_hash_parts_are_stretches_of_the_shuffle(spark):
    # every row was shuffled to be ranked, where only those next to a border need it.
    rows = [(i // 2 if i < 60 else i, None if i % 11 == 0 else i % 2) for i in range(5000)]  # some ids come twice, some classes are null
    df = spark.createDataFrame(rows, "id int, y int").repartition(5).cache()
    part = lambda at, size: F.when(at < F.floor(size * 0.7 + 0.5), "a").when(at < F.floor(size * 0.85 + 0.5), "b").otherwise("c")
    for bits in (1, 4, 14):
        got = ordering.hash_parts(df, ["y"], ["id"], 3, part, "part", bits)
        placed = ordering.hash_positions(df, ["y"], ["id"], 3, "at", "size", bits)
        assert got.columns == ["id", "y", "part"] and got.count() == 5000
        want = placed.select("id", "y", part(F.col("at"), F.col("size")).alias("part"))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
