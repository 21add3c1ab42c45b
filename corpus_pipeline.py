"""A corpus pipeline: toxicity, exact dedup, near-dedup, PII surrogates, best-fit packing.

Each stage takes all that the one before it kept, and its decisions take effect. All stages but the
last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.llm import exact_dedup, packing, pii, simhash, toxicity
from benchlake.llm.common import key, materialize, table


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def _row() -> Column:
    """What tells the texts of one doc_id apart; null and empty are the same text."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id (null is one) and text, by its hash ``row``, are in kept. Nothing is written into
    the documents, whatever their columns are called."""
    own_id, own_row = _free(docs, "kept_id"), _free(docs, "kept_row")
    wanted = kept.select(key("doc_id").alias(own_id), F.col("row").alias(own_row)).distinct()
    return docs.join(wanted, (key("doc_id") == F.col(own_id)) & (_row() == F.col(own_row)), "left_semi")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled rows of its input, does not reject."""
    score = toxicity.scorer(spark, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return docs.filter(score(F.coalesce(F.col("text"), F.lit(""))) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    groups = materialize(exact_dedup.exact_groups(docs), "groups")
    stays = _only(docs, groups.filter("kept"))
    again = groups.groupBy("doc_id", "row").count().filter("count > 1")  # rows that repeat a doc_id and its text
    if again.isEmpty():
        return stays
    twice = _only(docs, groups.filter("kept").join(again, groups.doc_id.eqNullSafe(again.doc_id) & (groups.row == again.row), "left_semi"))
    once = _only(docs, groups.filter("kept").join(again, groups.doc_id.eqNullSafe(again.doc_id) & (groups.row == again.row), "left_anti"))
    row = _free(docs, "row_hash")
    return once.union(twice.withColumn(row, _row()).dropDuplicates(["doc_id", row]).drop(row))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near-copies: five-word Jaccard similarity of 0.8 or
    more, all pairs."""
    return _only(docs, simhash.near_copies(docs).filter("kept"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with surrogates for its personal data and n_chars to match."""
    return pii.anonymise(docs, pii.session_key(spark)).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of every document."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("pii", replace_personal_data),
    ("packing", pack),
]

#: Tokenisation, XXH64 majority bits and the classifier are beyond SQL: tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
