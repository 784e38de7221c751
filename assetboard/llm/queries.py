"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetboard.llm import (cap_links, collocations, line_dedup, mixing, near_dedup, packing, sharding, spelling,
                            suffix_lm, toxicity, vector_search, warc)
from assetboard.llm import token_counts as tc
from assetboard.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_lm.score_documents(table(spark, sf_dir, "documents"))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.assign_shards(table(spark, sf_dir, "documents"), shards=8)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"), "n_tokens")


@query
def op5_cap_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_links.cap_links(table(spark, sf_dir, "embeddings"), 0.98)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized, schedule = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken_words(sized, schedule).drop("row", "key")


@query
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tc.token_counts(table(spark, sf_dir, "documents"))


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_warc"] = """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
h as (select page_id, octet_length(payload) as payload_bytes, sha1(payload) as hex from p),
d as (select *, max(page_id) over (partition by hex) as of from h)
select page_id, payload_bytes,
  list_reduce([list_reduce([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, g * 5 + 1, 5))::int >> s) & 31), 1)
    for s in [15, 10, 5, 0]], lambda a, b: a || b) for g in range(8)], lambda a, b: a || b) as payload_digest,
  case when page_id = of then 'response' else 'revisit' end as record_type,
  case when page_id = of then null else of end as refers_to
from d"""

ORACLES["op13_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) as piece from documents),
lists as (select lang, regexp_extract_all(piece, '[^ 	]+') as w from pieces),
windows as (select lang, w, unnest(range(1, len(w) + 1)) as i from lists),
phrases as (
  select lang, m, array_to_string(w[i : i + m - 1], ' ') as phrase, count(*) as f
  from windows, (values (1), (2), (3)) as sizes(m) where i + m - 1 <= len(w) group by all),
totals as (select lang, sum(f)::bigint as n from phrases where m = 1 group by lang),
cands as (select lang, m, phrase, f as a, string_split(phrase, ' ') as w from phrases where m > 1 and f >= 10),
cuts as (select *, unnest(range(1, m)) as k from cands),
scored as (
  select c.*, x.f as l, y.f as r, ((1000000::hugeint * a * a) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join phrases x on x.lang = c.lang and x.m = c.k and x.phrase = array_to_string(c.w[1 : c.k], ' ')
  join phrases y on y.lang = c.lang and y.m = c.m - c.k and y.phrase = array_to_string(c.w[c.k + 1 : c.m], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_pairs as (
  select lang, array_to_string(w[1 : 2], ' ') as phrase, a from cands where m = 3
  union all select lang, array_to_string(w[2 : 3], ' '), a from cands where m = 3),
longer as (select lang, phrase, max(a) as most from inner_pairs group by all),
kept as (select b.* from best b left join longer o on o.lang = b.lang and o.phrase = b.phrase
  where o.most is null or 100 * o.most < 50 * b.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000"""
