"""Ingest of an artifact tree into the store, audits first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.plans import perf
from benchlake.session import materialize, release
from benchlake.sinks.store import Store, Transaction
from benchlake.sources import artifacts

CELL = ["run_sha", "sample", "arch", "rep"]
#: What the runs of a baseline tree are called by, before their own name.
BASELINE_PREFIX = "baseline-"


class AuditError(RuntimeError):
    """Something in the tree must be looked at before it is ingested."""


def _has(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def audits(trials: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(late cells of each run, cells that mix image variants)."""
    return perf.late_cells(trials), perf.mixed_variants(trials)


def collect(spark: SparkSession, root: str, store: Store, *, late: bool = False, mixed: bool = False, labels: dict[str, str] | None = None, tools: dict[str, str] | None = None) -> dict[str, int]:
    """Ingest ``runs/``, ``baseline/``, ``scaling/`` and ``arena/`` of a tree; returns rows by table. Late
    cells of a run are left out unless asked for; cells that mix image variants are an error unless asked
    for. Runs of the baseline tree are known by ``BASELINE_PREFIX``. Each artifact is parsed once, into the
    shared folder; audits and writes read that. All tables change in one transaction, or none does."""
    return store.run(lambda t: _collect(spark, root, t, late, mixed, labels, tools))


def _collect(spark: SparkSession, root: str, store: Transaction, late: bool, mixed: bool, labels: dict[str, str] | None, tools: dict[str, str] | None) -> dict[str, int]:
    counts: dict[str, int] = {}

    def put(table: str, rows: DataFrame, write) -> None:
        own = materialize(rows, table)
        write(own)
        counts[table] = counts.get(table, 0) + own.count()
        release(own)

    for folder, prefix in (("runs", ""), ("baseline", BASELINE_PREFIX)):
        tree = f"{root}/{folder}"
        if not _has(spark, tree):
            continue
        named = lambda f, p=prefix: f.withColumn("run_sha", F.concat(F.lit(p), "run_sha")) if p else f
        trials = materialize(named(artifacts.trials(spark, tree)).withColumn("id", F.xxhash64(*CELL)), "trials")
        late_rows, mixed_rows = audits(trials)
        if not mixed and (bad := mixed_rows.count()):
            raise AuditError(f"{bad} cells mix image variants")
        gone = late_rows.filter("hours_late > 0").select(*CELL)
        keep = (lambda f: f) if late else (lambda f, g=gone: f.join(g, CELL, "left_anti"))
        put("runs", trials.select("run_sha").distinct().withColumn("status", F.lit("completed")).withColumn("submitted_at", F.current_timestamp()), store.upsert_runs)
        put("trials", keep(trials), lambda r: store.upsert("trials", r))
        comparisons = keep(named(artifacts.comparisons(spark, tree))).withColumn("trial_id", F.xxhash64(*CELL)).drop("sample", "arch", "rep")
        put("comparisons", comparisons, lambda r: store.upsert("comparisons", r))
        put("accuracy", keep(named(artifacts.accuracy(spark, tree, tools))), lambda r: store.upsert("accuracy", r))
        put("host_probes", keep(named(artifacts.probes(spark, tree))), lambda r: store.upsert("host_probes", r))
        release(trials)
    if _has(spark, f"{root}/scaling"):
        put("scaling", artifacts.scaling(spark, f"{root}/scaling"), lambda r: store.upsert("scaling", r))
        put("ladder_probes", artifacts.probes(spark, f"{root}/scaling"), lambda r: store.upsert("host_probes", r))
    if _has(spark, f"{root}/arena"):
        put("arena", artifacts.arena(spark, f"{root}/arena", labels), store.replace_arena)
    return counts
