"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is two aggregations with partial sums and two equi-joins on keys that Spark may split when
skewed; the table is written to the shared folder after each round, and the one before it deleted. Nothing is gathered on the driver
but a row count and a checksum. Rounds grow with the logarithm of the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import materialize, release


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links of long keys, in any direction -> (node, component): one row per linked key other
    than a component's smallest, which is the component's name. Self links are ignored; an empty
    table gives an empty one."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = materialize(e, "links")
    before = _state(e)
    while before[0]:
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        low = materialize(low, "least")  # a table of its own: a join of two plain sides may split a hub's rows
        large = both.join(low, both.a == low.k).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        near = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(near.select(F.col("a").alias("k"), "m"), F.col("a") == F.col("k")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = materialize(small.union(near.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _state(new)
        release(e, low)
        e = new
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
