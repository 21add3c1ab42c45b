"""The live view of a run's jobs: what polls of the job listing say, folded into one state for each job name.

Each poll lists attempts (name, created_at) with their status. The state of a name holds the last status of each of its
attempts, a few, and every change gives out all of them anew, since an attempt that failed turns into a retried one when
a later attempt appears. The stream restarts from its checkpoint; a poll that comes twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from benchlake.operators.latest import latest_wins

POLL = "name string, created_at long, status string, polled_at long"
SHOWN = "name string, created_at long, status string, polled_at long, display string"


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    attempts = {c: (p, s) for c, s, p in zip(*state.get, strict=True)} if state.exists else {}
    before = dict(attempts)
    for b in batches:
        for created, status, polled in zip(b["created_at"], b["status"], b["polled_at"], strict=True):
            last = attempts.get(created)
            if last is None or (polled, status) > last:
                attempts[int(created)] = (int(polled), status)
    if attempts == before:
        return
    order = sorted(attempts)
    state.update(([*order], [attempts[c][1] for c in order], [attempts[c][0] for c in order]))
    display = ["RETRIED" if attempts[c][1] == "FAILED" and c < order[-1] else attempts[c][1] for c in order]
    yield pd.DataFrame({"name": key[0], "created_at": order, "status": [attempts[c][1] for c in order], "polled_at": [attempts[c][0] for c in order], "display": display})


def job_states(polls: DataFrame) -> DataFrame:
    """A stream of polls -> a stream of changes (name, created_at, status, polled_at, display)."""
    known = polls.select("name", "created_at", "status", "polled_at").filter("name is not null and created_at is not null")
    return known.groupBy("name").applyInPandasWithState(_fold, SHOWN, "created array<long>, status array<string>, polled array<long>", "update", GroupStateTimeout.NoTimeout)


def watch(spark: SparkSession, listings: str, view: str, checkpoint: str) -> StreamingQuery:
    """Fold the poll files of a folder into the changes under ``view``; each micro-batch is a folder of its own, so that a
    batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{view}/batch={number}")

    stream = job_states(spark.readStream.schema(POLL).json(listings))
    return stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, view: str) -> DataFrame:
    """The last change of each attempt."""
    changes = spark.read.schema(f"{SHOWN}, batch long").parquet(view)
    return latest_wins(changes, ("name", "created_at"), "batch")
