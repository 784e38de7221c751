"""The registered queries over the whole small tables: the columns and types that are asked of them, one row where one is due."""

import pytest
from pyspark.sql import functions as F

from assetboard.llm import queries
from test_spelling import plain_variants

FOLDER = "/root/testdata/sf0.001"
DOCS, VECTORS = ("documents", "doc_id"), ("embeddings", "vec_id")
#: Query: its table and id where it returns one row for each, and its columns.
CONTRACT = {
    "op1_toxicity": (DOCS, "doc_id bigint, held_out boolean, score double, predicted int"),
    "op2_vector_search": (None, "query_id bigint, rank int, vec_id bigint, score double"),
    "op3_suffix_tree": (DOCS, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"),
    "op4_sharding": (DOCS, "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int"),
    "op5_cap_links": (VECTORS, "vec_id bigint, n_links bigint, component_id bigint, kept boolean"),
    "op6_line_dedup": (None, "doc_id bigint, text string"),
    "op7_packing": (None, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"),
    "op8_mixing": (DOCS, "doc_id bigint, size bigint, source_size bigint, target double, taken bigint"),
    "op9_near_dedup": (DOCS, "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean"),
    "op10_token_counts": (DOCS, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"),
    "op11_warc": (("pages", "page_id"), "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"),
    "op12_spelling": (None, "word string, form string, root string, n bigint, n_near bigint, form_n bigint"),
    "op13_collocations": (None, "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"),
}


def test_every_query_has_a_contract():
    assert set(CONTRACT) == set(queries.QUERIES)


@pytest.mark.parametrize("name", CONTRACT)
def test_columns_types_and_rows(spark, name):
    whole, columns = CONTRACT[name]
    got = queries.QUERIES[name](spark, FOLDER)
    kinds = dict(got.dtypes)
    assert {c.split()[0]: kinds.get(c.split()[0]) for c in columns.split(", ")} == dict(c.split() for c in columns.split(", "))
    rows = got.toPandas()
    assert len(rows)
    if whole:
        ids = spark.read.parquet(f"{FOLDER}/{whole[0]}.parquet").select(whole[1])
        assert sorted(rows[whole[1]]) == sorted(r[0] for r in ids.collect())


def test_spelling_query_equals_all_pairs(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in queries.QUERIES["op12_spelling"](spark, FOLDER).collect()} == plain_variants(docs)


def test_search_returns_five_rows_for_every_query(spark):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    got = queries.QUERIES["op2_vector_search"](spark, FOLDER).groupBy("query_id").agg(F.collect_list("rank").alias("ranks")).collect()
    assert {r["query_id"] for r in got} == {r[0] for r in vectors.where("vec_id % 50 = 0").select("vec_id").collect()}
    assert all(sorted(r["ranks"]) == [1, 2, 3, 4, 5] for r in got)


def test_pipeline_over_nulls_and_empty_tables(spark):
    import corpus_pipeline
    import fixtures

    rows = [r[:5] for r in fixtures.rows()] + [(None, "a text without an id " * 9, None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        out = some
        for name, stage in corpus_pipeline.STAGES:
            out = spark.createDataFrame(*table_of(stage(spark, out, FOLDER)))
        assert {"doc_id", "sequence_id"} <= set(out.columns) and out.isEmpty() == some.isEmpty()


def table_of(df):
    """Rows and schema, so that each stage starts from what the last one made."""
    return df.collect(), df.schema


def test_places_are_those_of_a_plain_packer():
    import numpy as np

    from assetboard.llm import sharding

    rng = np.random.default_rng(6)
    for _ in range(20):
        demand, shards = rng.integers(0, 50, (int(rng.integers(1, 40)), 3)).astype(float), int(rng.integers(1, 6))
        taken = rng.integers(0, 30, (shards, 3)).astype(float)
        share = [max((demand[:, k].sum() + taken[:, k].sum()) / shards, 1) for k in range(3)]
        left = [[1 - taken[s, k] / share[k] for k in range(3)] for s in range(shards)]
        want = {}
        need = [[d[k] / share[k] for k in range(3)] for d in demand]
        for i in sorted(range(len(need)), key=lambda i: -sum(need[i][k] * sharding.WEIGHTS[k] for k in range(3))):
            fit = [sum(left[s][k] * need[i][k] * sharding.WEIGHTS[k] for k in range(3)) for s in range(shards)]
            want[i] = max(range(shards), key=lambda s: fit[s])
            left[want[i]] = [left[want[i]][k] - need[i][k] for k in range(3)]
        got = sharding.place(demand, shards, taken)
        assert np.mean([got[i] == want[i] for i in want]) > 0.95  # equal but for rounding in ties
