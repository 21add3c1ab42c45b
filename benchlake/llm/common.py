"""Shared plumbing of the training-data operators.

Null, empty and repeated input, in every operator of this package:

* a null text counts as the empty text;
* a null key column (doc_id, page_id, vec_id) is carried as ``NULL_ID`` inside an operator and comes
  back as null, so such rows are neither lost nor joined to others by accident;
* columns an operator does not use are ignored, whatever their names;
* an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.session import materialize, release, scratch_dir

__all__ = ["BATCH_BYTES", "NULL_ID", "draw_seed", "handing_back", "key", "keyed_draws", "keyed_texts", "materialize", "release", "scratch_dir", "table", "texts", "tuned", "unkey"]

NULL_ID = -(2**63) + 1
#: Bytes of one Arrow batch handed to Python: bounds a worker's memory where texts are long.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tuned(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by bytes as well as by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def key(column: str) -> Column:
    """A key column as a long that is never null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID)).alias(column)


def unkey(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(NULL_ID)).alias(column)


def texts(docs: DataFrame, key_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    return docs.select(key(key_column), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias(text_column))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text): doc_id and row, a hash of the text, tell rows apart where a doc_id repeats."""
    return texts(docs).select("doc_id", F.xxhash64("text").alias("row"), "text")


def draw_seed(seed: int, doc_id: Column) -> Column:
    """``seed:doc_id``, what a document's keyed draws are made from; a null doc_id reads ``null``."""
    return F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))


def keyed_draws(text: Column, n: int) -> list[Column]:
    """n numbers below 2^32: the groups of eight digits of the SHA-256 of a text."""
    return [F.conv(F.substring(F.sha2(text, 256), 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(n)]


def handing_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow whose worker hands its free memory back to the machine when a task ends. Workers live
    on between stages, and what the allocators keep of one stage's texts would add to the next one's."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library alone
            if trim is not None:
                trim(0)

    return own
