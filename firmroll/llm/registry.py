"""Queries of the corpus operators over whole tables, and their SQL twins."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from firmroll.llm import oracle
from firmroll.llm.bpe import round_trip
from firmroll.llm.chat import format_chats
from firmroll.llm.common import table
from firmroll.llm.exact_dedup import exact_duplicates
from firmroll.llm.language import identify
from firmroll.llm.packing import pack
from firmroll.llm.quality import quality_rules
from firmroll.llm.search import ranked
from firmroll.llm.secrets import find_secrets
from firmroll.llm.sharding import shard
from firmroll.llm.simhash import near_duplicates
from firmroll.llm.url_filter import judge_urls
from firmroll.llm.vector_codes import compress
from firmroll.llm.warc import read_warc, write_warc
from firmroll.sources.storage import scratch_path


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "fingerprint", "component_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("vslot", "map_version")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), root)
    return read_warc(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "judged.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def _importable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Let Python workers import this package wherever the session was started; clusters ship it with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        environment = spark.sparkContext.environment
        known = environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in known:
            environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = {
        "pipeline": corpus_pipeline.run,
        "op1_secret_scan": op1_secret_scan,
        "op2_chat": op2_chat,
        "op3_simhash": op3_simhash,
        "op4_packing": op4_packing,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_sharding": op6_sharding,
        "op7_bpe": op7_bpe,
        "op8_warc": op8_warc,
        "op9_url_filter": op9_url_filter,
        "op10_quality_rules": op10_quality_rules,
        "op11_language_id": op11_language_id,
        "op12_ranked_search": op12_ranked_search,
        "op13_vector_codes": op13_vector_codes,
    }
    return {name: _importable(query) for name, query in registered.items()}


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return oracle.oracle_sql() | pipeline
