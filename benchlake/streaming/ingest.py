"""Streaming ingest. An extension: batch reports work without it.

Probe lines are appended to files while a job runs. The file source reads what is new, the batch
parser's columns apply unchanged, and each micro-batch is written by the store's latest-wins upsert,
which makes a replayed batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from benchlake.sinks.store import Store
from benchlake.sources.artifacts import cells, decoded, probe_columns


def probe_stream(spark: SparkSession, root: str) -> DataFrame:
    """Probe rows of new files under ``<sha>/<sample>/<arch>/rep-<n>/``."""
    raw = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "host-probe.jsonl").text(root)
    rows = cells(raw.select(decoded(F.col("_metadata.file_path")).alias("path"), "value"))
    return rows.select("run_sha", "sample", "arch", "rep", *(x.alias(c) for c, x in probe_columns(F.col("value")).items())).filter("phase <> ''")


def ingest_probes(spark: SparkSession, root: str, store_root: str, checkpoint: str) -> StreamingQuery:
    def write(batch: DataFrame, _: int) -> None:
        Store(batch.sparkSession, store_root).upsert("host_probes", batch)

    return probe_stream(spark, root).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by tumbling window and kind, with a watermark for late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v")).select(F.col("w.start").alias("start"), "event_type", "n", "v")
