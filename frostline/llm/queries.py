"""Registered queries of this subpackage: ``name -> (spark, sf_dir) -> DataFrame``.

Each applies one operator, with production parameters, to its whole table and
derives the contract's columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


@query
def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe_chunks import encode_documents

    coded = encode_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan

    return scan(documents(spark, sf_dir))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import dedup_substrings

    return dedup_substrings(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify

    return identify(documents(spark, sf_dir, "doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ..session import scratch_dir
    from .token_files import read_token_files, write_token_files

    files = write_token_files(documents(spark, sf_dir), scratch_dir(spark, "tokens"),
                              public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, files, tokens=False)


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import RULES, judge_urls

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix, training_places

    return training_places(mix(documents(spark, sf_dir, "doc_id", "source", "text"))).select(
        "doc_id", "size", "source_size", "target", "taken", "first_position", "first_place", "last_place")


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_alignment import align

    return align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ranked_search import search

    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return search(benchmark, documents(spark, sf_dir), k=10)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express in reasonable time."""
    from .oracle import ORACLE_SQL

    return dict(ORACLE_SQL)
