"""From raw documents to packed training sequences: five stages, each an operator over what the last one kept.

Toxic documents leave, repeated passages are cut, one document of each near-duplicate group stays, sources
are mixed to their target weights, and what remains is packed into sequences. Every stage but the last
returns the columns of ``documents``; ``n_chars`` follows the text. SQL can express neither the network
nor MinHash nor the tokenizer, so there is no oracle; tests compare stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetboard.llm import line_dedup, mixing, near_dedup, packing, toxicity
from assetboard.llm.common import table
from assetboard.session import land

#: Near duplicates in the pipeline: shingles of five words and a similarity of 0.8 or more.
NEAR_WIDTH, NEAR_SIMILARITY = 5, 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(docs, report=False)
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.char_length("text").cast(kind)).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, width=NEAR_WIDTH, similarity=NEAR_SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", cut_repeats),
    ("near_dedup", one_of_each_group),
    ("mixing", mix_sources),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the documents of a folder, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
