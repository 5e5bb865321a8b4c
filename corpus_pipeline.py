"""A training-data pipeline over ``documents``, from the operators of ``frostline.llm``.

Each stage takes what its predecessor kept and returns it anew; ``run`` writes a
stage's rows as Parquet into the session's shared folder and reads them again
as the next one's documents, so a lost executor never costs more than a stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from frostline.llm.bpe_chunks import encode_documents
from frostline.llm.mixing import mixed_documents
from frostline.llm.quality import kept_documents
from frostline.llm.simhash import one_of_each
from frostline.llm.substring import shortened_documents
from frostline.session import scratch_dir


#: Words that an encoding worker keeps; it holds memory of the earlier stages besides.
MEMO = 300_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that fail."""
    return kept_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stand earlier go; a document without any words left goes."""
    return shortened_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: a row for each time a document is met."""
    return mixed_documents(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return encode_documents(docs, path, memo=MEMO).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encode", bpe_encode),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
