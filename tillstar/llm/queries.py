"""Registered queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.bpe import encode_texts
from tillstar.llm.conversation_trie import ordered_turns, prefix_trie, rebuilt
from tillstar.llm.decontaminate import contaminated
from tillstar.llm.lexical_search import ranked_search
from tillstar.llm.license_scan import license_scan
from tillstar.llm.mixing import mix
from tillstar.llm.near_dedup import near_duplicates
from tillstar.llm.oracles import SQL
from tillstar.llm.passage_dedup import repeated_passages
from tillstar.llm.quality_model import quality_scores
from tillstar.llm.quality_rules import MEASURES, quality_rules
from tillstar.llm.token_count import token_counts
from tillstar.llm.token_output import read_documents, write_token_files
from tillstar.llm.url_filter import judge_urls, repeated_urls
from tillstar.session import fresh_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1

# Verdict, host, path.
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", *MEASURES, "base_failed", "host_docs", "host_rejected", "kept")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "coverage", "n_tiles", "longest")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs under which several pages stand; the page of the smallest id stays."""
    pages = _table(spark, sf_dir, "pages")
    return judge_urls(pages, repeated_urls(pages), URL_RULES)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, num=80, den=100)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=2048)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_repeat=2)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    write_token_files(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER), END_ID)
    return read_documents(spark, folder)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_texts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(ordered_turns(_table(spark, sf_dir, "conversations")), group=5, keep=9))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_license_scan, op3_benchmark_decontamination, op4_quality_classifier, op5_url_filter,
        op6_minhash_near_dedup, op7_token_counts, op8_source_mixing, op9_substring_dedup, op10_token_output,
        op11_lexical_search, op12_bpe_codec, op13_conversation_trie)}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
