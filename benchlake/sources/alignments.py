"""Alignment records from SAM text and BAM files.

SAM is lines, so Spark splits it. BAM has no built-in reader: ``bam.py`` is a Python data source for it. ``idx`` grows
with the file order in both, and is no count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benchlake.sources.bam import BamDataSource

#: Record numbers for one range of ``concordance.ordinals``: 16 MB of a BAM file.
WIDTH = 1 << 40


def sam(spark: SparkSession, path: str, fields: str = "core") -> DataFrame:
    """Records of a SAM text file. References are numbered by @SQ order; a missing name raises. The
    ordinal is the line's place: byte order within and across splits of one file. ``fields``: core or full."""
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    head = lines.filter(F.col("value").startswith("@SQ\t")).select("at", F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("ref"))
    refs = head.select("ref", (F.row_number().over(Window.orderBy("at")) - 1).alias("ref_id"))  # the header: a reference dictionary
    f = lines.filter(~F.col("value").startswith("@") & (F.col("value") != "")).select("at", F.split("value", "\t").alias("f")).withColumn("ref", F.get("f", F.lit(2))).join(refs, "ref", "left")
    get = lambda k: F.get("f", F.lit(k))
    name = F.when((get(0) == "") | (get(0) == "*"), F.raise_error(F.lit("a record has no name"))).otherwise(get(0))
    ops = F.transform(F.regexp_extract_all(get(5), F.lit(r"(\d+[MIDNSHP=X])"), 1), lambda x: F.struct(F.right(x, F.lit(1)).alias("op"), F.regexp_extract(x, r"^(\d+)", 1).cast("int").alias("len")))
    kind = lambda x: F.when(F.split(x, ":")[1] == "i", "Int").when(F.split(x, ":")[1] == "f", "Float").when(F.split(x, ":")[1] == "Z", "Str").when(F.split(x, ":")[1] == "H", "Hex").when(F.split(x, ":")[1] == "A", "Char").otherwise("Other")
    tags = F.map_from_entries(F.transform(F.slice("f", F.lit(12), F.size("f")), lambda x: F.struct(F.substring(x, 1, 2), F.struct(kind(x).alias("t"), F.substring(x, 6, 2**31 - 1).alias("v")))))
    core = f.select(
        F.col("at").alias("idx"), name.alias("name"), get(1).cast("int").alias("flags"), F.col("ref_id").cast("int").alias("ref_id"), F.nullif(get(3).cast("long"), F.lit(0).cast("long")).alias("pos"),
        F.nullif(get(4).cast("int"), F.lit(255)).alias("mapq"), ops.alias("cigar"), tags.alias("tags"), "f", F.col("ref_id").alias("own"),
    )
    if fields == "core":
        return core.drop("f", "own")
    text = lambda k: F.nullif(get(k), F.lit("*"))
    mates = core.withColumn("ref", F.when(get(6) != "=", get(6))).join(refs.withColumnRenamed("ref_id", "mate"), "ref", "left")
    return mates.select(
        *("idx", "name", "flags", "ref_id", "pos", "mapq", "cigar"), F.when(get(6) == "=", F.col("own")).otherwise(F.col("mate")).cast("int").alias("next_ref"), F.nullif(get(7).cast("long"), F.lit(0).cast("long")).alias("next_pos"),
        get(8).cast("int").alias("tlen"), text(9).alias("seq"), text(10).alias("qual"), "tags",
    )


def bam(spark: SparkSession, path: str, split: int = 64 << 20, fields: str = "core") -> DataFrame:
    """Records of BAM files (paths with commas); ``fields`` as in the data source."""
    spark.dataSource.register(BamDataSource)
    return spark.read.format("bam").option("path", path).option("split", str(split)).option("fields", fields).load()


def header(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, kind, fields) of a header's lines; of a BAM file also of its binary dictionary (kind ``ref``)."""
    if path.endswith(".bam"):
        return bam(spark, path, fields="header")
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id()).filter(F.col("value").startswith("@"))
    pairs = F.transform(F.slice(F.split("value", "\t"), 2, F.size(F.split("value", "\t"))), lambda x: F.struct(F.substring(x, 1, 2), F.substring(x, 4, 2**31 - 1)))
    fields = F.when(F.col("value").startswith("@CO"), F.create_map(F.lit(""), F.expr("substring(value, 5)"))).otherwise(F.map_from_entries(pairs))
    number = F.row_number().over(Window.orderBy("at")) - 1  # a header's lines
    return lines.select(F.lit(path).alias("path"), number.cast("int").alias("line"), F.regexp_extract("value", "^@([A-Z]+)", 1).alias("kind"), fields.alias("fields"))


__all__ = ["BamDataSource", "WIDTH", "bam", "header", "sam"]
