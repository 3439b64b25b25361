"""From documents to packed sequences: STAGES in order, `run` for all of them.

A stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; `run` writes each result and reads it
again. All stages but the last return the columns of documents; mix adds the key that the mix sorts by:

quality  rows whose text is too surprising for their language go
near     of each group of near copies, one row stays
repeats  passages of 50 words are cut out wherever they come again; texts that end up empty go
mix      every row once, with its position in the mix; files keep no order across each other, so the next stage sorts
pack     pieces of the documents in sequences of 1024 tokens, packed in that order
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm import mixing, near, packing, quality, suffix
from tillroll.llm.common import materialise, table, vocabulary

POSITION = "mix_position"


def rate_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.one_of_each(docs, shingle=5, similarity=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(docs, length=50).withColumn("n_chars", F.char_length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, position=POSITION, block=16, temperature=0.5)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.orderBy(POSITION), vocabulary("byte_bpe_50k.json"), size=1024)


STAGES = [
    ("quality", rate_quality),
    ("near", drop_near_copies),
    ("repeats", cut_repeats),
    ("mix", mix_sources),
    ("pack", pack_tokens),
]
#: SQL states neither the perplexities nor the packing. Near copies, repeats, mix and packing are tested against plain
#: versions, the quality stage against its operator, whose perplexities are.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
