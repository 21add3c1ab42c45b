"""The thin queries ``opN_<name>``: each applies its operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from benchlake.llm import bpe, exact_dedup, fim, html_text, importance, packing, pii, simhash, suffix_dedup, token_file, toxicity, url_filter, vector_dedup
from benchlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("row")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogates(table(spark, sf_dir, "documents"), pii.session_key(spark))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.written_and_read(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {"pipeline": corpus_pipeline.run}
    return out | {f.__name__: f for f in (op1_toxicity, op2_simhash, op3_html_text, op4_exact_dedup, op5_bpe, op6_url_filter, op7_embedding_dedup, op8_packing, op9_pii, op10_suffix_dedup, op11_fim, op12_importance, op13_token_file)}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": exact_dedup.ORACLE, "op6_url_filter": url_filter.ORACLE, "op7_embedding_dedup": vector_dedup.ORACLE, "op11_fim": fim.ORACLE, "op12_importance": importance.ORACLE}
