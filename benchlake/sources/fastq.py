"""FASTQ files as numbered lines and as records, whatever the splits they are read in.

Spark reads a file in splits that know nothing of each other. Lines are numbered by counting: within a split in reading
order, and before it by a prefix sum over the splits of its file (a row for each split). A record is the four
lines of one quotient, so records that lie across a border come together in the grouping; lines of one split meet
before the shuffle. Compressed files are one split each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benchlake.sources.artifacts import decoded

LINES = ("header", "seq", "plus", "qual")


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, idx, value): the lines of each file, numbered from 0."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value").withColumn("at", F.monotonically_increasing_id())
    splits = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # the splits of one file
    starts = splits.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return raw.join(starts, ["file", "block"]).select(decoded(F.col("file")).alias("path"), (F.col("at") + F.col("shift")).alias("idx"), "value")


def grouped(numbered: DataFrame, n: int = 1) -> DataFrame:
    """(path, rec, header, seq, plus, qual) of every n-th record of numbered lines; lines a file lacks are null."""
    kept = numbered.withColumn("rec", F.floor(F.col("idx") / 4)).filter(F.col("rec") % n == 0)
    return kept.groupBy("path", "rec").agg(*(F.max(F.when(F.col("idx") % 4 == k, F.col("value"))).alias(c) for k, c in enumerate(LINES)))


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All records of the files; one that is cut short, or without its marks, raises."""
    r = grouped(lines(spark, path))
    problem = F.when(F.col("qual").isNull(), "is cut short").when(~F.col("header").startswith("@"), "has no header").when(~F.col("plus").startswith("+"), "has no separator").when(F.length("seq") != F.length("qual"), "has not as many qualities as bases")
    return _checked(r, problem)


def _checked(rows: DataFrame, problem) -> DataFrame:
    """Rows; one with a problem raises, even where nothing but its number is read."""
    told = F.concat(F.col("path"), F.lit(": record "), (F.col("rec") + 1).cast("string"), F.lit(" "), problem)
    return rows.filter(F.when(problem.isNull(), F.lit(True)).otherwise(F.raise_error(told).cast("boolean")))


def thinned(spark: SparkSession, path: str | list[str], every: int, trim: int = 0) -> DataFrame:
    """Records 1, n + 1, 2n + 1, ... of each file with ``trim`` characters cut from the front of bases and
    qualities. With a trim, a kept record that has no bases left, another number of qualities, or not all of its lines
    raises; without one, records pass unchecked."""
    if every < 1 or trim < 0:
        raise ValueError("every n-th record with n >= 1, and a trim of at least 0")
    r = grouped(lines(spark, path), every)
    if not trim:
        return r
    problem = F.when(F.length("seq") <= trim, f"has no bases left after a {trim}-base trim").when(F.length("seq") != F.length("qual"), "has not as many qualities as bases").when(F.col("qual").isNull(), "is cut short")
    return _checked(r, problem).withColumns({c: F.expr(f"substring({c}, {trim + 1})") for c in ("seq", "qual")})


def write(rows: DataFrame, path: str) -> None:
    """Records in order of file and number, as gzip text. The folder is complete once it has its success mark."""
    dealt = rows.repartitionByRange("path", "rec").sortWithinPartitions("path", "rec")
    dealt.select(F.array_join(F.array_compact(F.array(*LINES)), "\n").alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def _times(spark: SparkSession, path: str) -> list[int]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getModificationTime() for s in fs.globStatus(p) or [] for s in ([s] if s.isFile() else fs.listStatus(s.getPath()))]


def reusable(spark: SparkSession, staged: str, source: str, trimmed: bool) -> bool:
    """Whether ``staged`` was written whole, is no older than its source (a source that is gone is no reason), can be
    read to its end and, if trimmed, holds whole records with as many qualities as bases and at least one."""
    if not _times(spark, f"{staged}/_SUCCESS"):
        return False
    if max(_times(spark, source), default=0) > min(_times(spark, staged)):
        return False
    try:
        bad = F.col("qual").isNull() | (F.length("seq") == 0) | (F.length("seq") != F.length("qual"))
        return grouped(lines(spark, staged)).agg(F.count_if(bad)).first()[0] == 0 or not trimmed
    except Exception as e:  # a stream that ends early or is no gzip
        if "java.io." in str(e) or "java.util.zip" in str(e) or "FAILED_READ_FILE" in str(e):
            return False
        raise


def stage(spark: SparkSession, source: str, staged: str, every: int, trim: int = 0) -> bool:
    """Thin ``source`` into ``staged`` unless what is there can be used; whether it was written."""
    if reusable(spark, staged, source, trim > 0):
        return False
    write(thinned(spark, source, every, trim), staged)
    return True
