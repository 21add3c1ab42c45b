"""Run schedules and job reports: pure logic over small declared frames.

A schedule is a frame: arms are dealt to blocks, every round is a seeded order of a block's units, and
a pair's two arms run next to each other, leading in turn. The order comes from a hash of (seed, block,
round, unit), so it needs no state and is the same on every run; another seed gives another order.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def schedule(arms: DataFrame, pairs: DataFrame, candidate: str, seed: str, headline: int, context: int) -> DataFrame:
    """arms (label, block), pairs (first, second) -> block, round (0: warm-up), position, label."""
    if min(headline, context) < 1:
        raise ValueError("every block needs a round")
    both = pairs.join(arms.select(F.col("label").alias("first"), F.col("block").alias("b1")), "first").join(arms.select(F.col("label").alias("second"), F.col("block").alias("b2")), "second").filter("b1 = b2")
    members = both.select(F.explode(F.array(F.struct(F.col("first").alias("label"), F.lit(0).alias("place")), F.struct(F.col("second").alias("label"), F.lit(1).alias("place")))).alias("m"), F.col("first").alias("unit")).select("m.*", "unit")
    own = arms.join(members, "label", "left").select("label", "block", F.coalesce("unit", "label").alias("unit"), F.coalesce("place", F.lit(0)).alias("place"))
    main = F.max(F.col("label") == candidate).over(Window.partitionBy("block"))
    rounds = own.withColumn("_main", main).withColumn("round", F.explode(F.sequence(F.lit(0), F.when(F.col("_main"), headline).otherwise(context))))
    turn = F.xxhash64(F.lit(seed), F.col("block"), F.col("round"), F.col("unit"))
    flip = (F.col("round") + F.pmod(F.xxhash64(F.lit(seed), F.col("block")), F.lit(2))) % 2
    w = Window.partitionBy("block", "round").orderBy("_turn", "unit", "_place")
    out = rounds.withColumn("_turn", turn).withColumn("_place", F.when(flip == 1, 1 - F.col("place")).otherwise(F.col("place"))).withColumn("position", F.row_number().over(w))
    return out.select("block", F.xxhash64(F.lit(seed), "block").alias("block_order"), "round", "position", "label").orderBy("block_order", "round", "position")


def run_order(arms: DataFrame, pairs: DataFrame, candidate: str, seed: str, headline: int, context: int) -> DataFrame:
    """Like ``schedule``, in the order that the workflow's own generator gives for a seed (Mersenne Twister seeded by the
    text). The driver draws for the declared arms: an order of blocks, then for each block who leads and an order of its units
    for every round; the rest is a join of the draws with the arms."""
    spark = arms.sparkSession
    if min(headline, context) < 1:
        raise ValueError("every block needs a round")
    listed = [(r.label, r.block) for r in arms.select("label", "block").collect()]  # declared arms
    block_of = dict(listed)
    if len(block_of) < len(listed):
        raise ValueError("arms repeat a label")
    couples = [(r.first, r.second) for r in pairs.select("first", "second").collect()]
    if len({x for c in couples for x in c}) < 2 * len(couples):
        raise ValueError("a label is in two pairs")
    whole = [c for c in couples if all(x in block_of for x in c) and block_of[c[0]] == block_of[c[1]]]
    paired = {x for c in whole for x in c}
    units = sorted([*whole, *((x,) for x in block_of if x not in paired)])
    draw, order, draws = random.Random(seed), sorted(set(block_of.values())), []
    draw.shuffle(order)
    for number, block in enumerate(order):
        flipped = draw.random() < 0.5
        for round_ in range((headline if block_of.get(candidate) == block else context) + 1):
            own = [u for u in units if block_of[u[0]] == block]
            draw.shuffle(own)
            turned = (round_ % 2 == 1) != flipped
            draws += [(block, number, round_, turn, list(reversed(u)) if turned else list(u)) for turn, u in enumerate(own)]
    dealt = spark.createDataFrame(draws, "block string, block_order long, round long, turn long, members array<string>")
    each = dealt.select("block", "block_order", "round", "turn", F.posexplode("members").alias("place", "label"))
    position = F.row_number().over(Window.partitionBy("block", "round").orderBy("turn", "place"))  # the arms of one round
    return each.select("block", "block_order", "round", position.alias("position"), "label").orderBy("block_order", "round", "position")


def job_counts(jobs: DataFrame) -> DataFrame:
    """Jobs by command and state, by command (state null), and in all (both null)."""
    return jobs.rollup("command", "state").agg(F.count("*").alias("n"))


def daily_cost(costs: DataFrame) -> DataFrame:
    """Cost by day and its total (day null)."""
    return costs.rollup("day").agg(F.sum("amount").alias("amount")).orderBy(F.asc_nulls_last("day"))


def orphans(local: DataFrame, remote: DataFrame, written: DataFrame, excluded: str | None = None) -> DataFrame:
    """Local files that no remote key explains, that were not written here, and that no pattern excludes."""
    out = local.join(remote, "key", "left_anti").join(written, "key", "left_anti")
    return out.filter(~F.col("key").rlike(excluded)) if excluded else out


def promotion(cells: DataFrame, required: int) -> DataFrame:
    """Cells to promote (replicate 1) with what forbids it: too few replicates, or no first one."""
    g = cells.groupBy("sample", "arch").agg(F.count_distinct("rep").alias("reps"), F.bool_or(F.col("rep") == 1).alias("first"))
    return g.withColumn("problem", F.when(~F.col("first"), "no first replicate").when(F.col("reps") < required, "too few replicates"))


def recent_jobs(jobs: DataFrame, since: int | None) -> DataFrame:
    """Jobs created at ``since`` (epoch milliseconds) or later; without it all. A job without a time counts as
    created at 0."""
    return jobs if since is None else jobs.filter(F.coalesce("created_at", F.lit(0)) >= since)


def serialization_pairs(rows: DataFrame) -> DataFrame:
    """Per (label, mode): completed measured rounds of both output routes and the median of sam over native
    walls of one round. Round 0 is warm-up; a run counts if it is ok or was not counted at all."""
    done = rows.filter(F.col("round") >= 1).filter(F.col("status").isin("ok", "unchecked"))
    wall = lambda r: F.max(F.when(F.col("route") == r, F.col("wall_s")))
    both = done.groupBy("label", "mode", "round").agg(wall("sam").alias("s"), wall("native").alias("n"))
    return both.groupBy("label", "mode").agg(F.count_if(F.col("s").isNotNull() & F.col("n").isNotNull()).alias("rounds"), F.median(F.col("s") / F.nullif("n", F.lit(0.0))).alias("sam_over_native"))


def counts(jobs: DataFrame, groups: list[list[str]], name: str = "n") -> DataFrame:
    """Jobs by each of several groupings in one pass; columns that a grouping leaves out are null."""
    columns = list(dict.fromkeys(c for g in groups for c in g))
    return jobs.groupingSets([[F.col(c) for c in g] for g in groups], *columns).agg(F.count("*").alias(name))
