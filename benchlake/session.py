"""Spark sessions with the settings that every plan of this package relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "benchlake", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution on; ``conf`` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()


_OWN: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir. Where it is unset, the warehouse,
    which executors share as well; a temporary folder only if driver and executors are one process."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        alone = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
        _OWN[app] = f"file://{tempfile.mkdtemp(prefix='benchlake-')}" if alone else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return _OWN[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/benchlake/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


#: Rows that a task gets of what is dealt out by ``dealt``.
TASK_ROWS = 500_000


def dealt(df: DataFrame) -> int:
    """Into how many partitions to deal a table that tasks sort: their number grows with its rows and not their size, however
    few bytes the rows take. One for each core at least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
