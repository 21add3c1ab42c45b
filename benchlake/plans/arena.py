"""Arena reports: paired same-round ratios, cold-run rejection, release chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchlake.functions import stats as S
from benchlake.session import dealt, materialize

# The published rules of the arena.
COLD_INDEX_FACTOR = 3.0
COLD_IO_MB = 1024.0
MIN_CLEAN_ROUNDS = 3
MAX_SPREAD = 0.05
CONTROL_SUFFIX = "-sam"
#: Labels that stand for the run itself and for the build its chain starts at; a reader of artifacts maps
#: the labels of its tree to these.
CANDIDATE, SEED_LABEL = "candidate", "seed"
#: What the reports on arms read of a round.
MEASURED = ("arch", "label", "mode", "rep", "block", "position", "wall_seconds", "process_seconds", "thp_fault_fallback", "cold")


def cold(rows: DataFrame) -> DataFrame:
    """Adds ``cold``: the index load took over three times its block's median, or over 1 GB came from
    disk. Null never counts as cold; rows without a block share one."""
    # one median for each (arch, block), combined before the shuffle; a window would gather a block's rows
    middle = rows.groupBy("arch", "block").agg(F.median("index_read_seconds").alias("_middle")).select(F.col("arch").alias("_arch"), F.col("block").alias("_block"), "_middle")
    # a run has few blocks; left to adaptive execution, the rows of a block would meet in one task, as nearly all partitions are empty
    both = rows.join(F.broadcast(middle), rows.arch.eqNullSafe(F.col("_arch")) & rows.block.eqNullSafe(F.col("_block")), "left")
    slow = F.col("index_read_seconds") > COLD_INDEX_FACTOR * F.col("_middle")
    return both.withColumn("cold", F.coalesce(slow, F.lit(False)) | F.coalesce(F.col("io_in_mb") > COLD_IO_MB, F.lit(False))).drop("_arch", "_block", "_middle")


def arena_rows(arena: DataFrame, sha: str, *, controls: bool = False) -> DataFrame:
    """Measured rounds (the warm-up is round 0) of one run, flagged cold, without writer controls."""
    rows = cold(arena.filter((F.col("run_sha") == sha) & (F.col("rep") >= 1)))
    return rows if controls else rows.filter(~F.col("label").endswith(CONTROL_SUFFIX))


def release_of(label: Column) -> Column:
    """The default-mode release that an arm belongs to."""
    return F.regexp_replace(label, "-fast$", "")


def chronology(releases: DataFrame) -> DataFrame:
    """(release, rank) of the ladder (columns ``label``, ``rank``), oldest first; the candidate is newest."""
    newest = releases.agg((F.coalesce(F.max("rank"), F.lit(-1)) + 1).cast("long").alias("rank")).select(F.lit(CANDIDATE).alias("release"), "rank")
    return releases.select(F.col("label").alias("release"), F.col("rank").cast("long").alias("rank")).union(newest)


def arm_stats(rows: DataFrame) -> DataFrame:
    """By arm: medians, counts, and the one block that all its rounds are in (null: several or none)."""
    lone = (F.min("block") == F.max("block")) & (F.count_if(F.col("block").isNull()) == 0)
    return rows.groupBy("arch", "label", "mode").agg(
        S.median("wall_seconds").alias("median_wall_s"),
        S.median("process_seconds").alias("median_process_s"),
        F.count("wall_seconds").alias("n_reps"),
        F.count_if(F.col("wall_seconds").isNull()).alias("n_skipped"),
        F.count_if("cold").alias("cold_runs"),
        S.median("thp_fault_fallback").alias("thp_fallback"),
        F.when(lone, F.min("block")).alias("lone_block"),
    )


def paired_ratios(rows: DataFrame, pairs: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """prior / this wall ratio for each row of ``pairs`` (pair, arch, prior_label, prior_mode, this_label,
    this_mode). Rows are read once: each goes to the pairs its arm is in, and a pair's round brings both
    arms together in one aggregation. What concerns whole arms comes from ``stats`` (``arm_stats``)."""
    stats = arm_stats(rows) if stats is None else stats
    arms = pairs
    for side in ("prior", "this"):
        facts = (F.col("median_wall_s").alias(f"{side}_wall"), F.col("median_process_s").alias(f"{side}_process"), F.col("lone_block").alias(f"{side}_block"))
        arms = arms.join(stats.select("arch", F.col("label").alias(f"{side}_label"), F.col("mode").alias(f"{side}_mode"), *facts), ["arch", f"{side}_label", f"{side}_mode"])
    arms = arms.select("pair", F.coalesce(F.col("prior_block") == F.col("this_block"), F.lit(False)).alias("same_block"), S.ratio("prior_wall", "this_wall").alias("far_ratio"), S.ratio("prior_process", "this_process").alias("far_process"))
    sides = F.array(*(F.struct(F.col(f"{s}_label").alias("label"), F.col(f"{s}_mode").alias("mode"), F.lit(s == "prior").alias("is_prior")) for s in ("prior", "this")))
    members = pairs.select("pair", "arch", F.explode(sides).alias("m")).select("pair", "arch", "m.*")
    measured = F.struct("position", "wall_seconds", "process_seconds", "cold")
    p = F.col("is_prior")
    sided = rows.select("arch", "label", "mode", "rep", measured.alias("r")).join(F.broadcast(members), ["arch", "label", "mode"])  # the arms of the ladder
    # dealt out first: structs are aggregated by a sort, and a task that reads a table of few bytes a row has many rows
    both = sided.repartition(dealt(rows), "pair", "rep").groupBy("pair", "rep").agg(F.first(F.when(p, F.col("r")), True).alias("x"), F.first(F.when(~p, F.col("r")), True).alias("y"))
    rounds = both.filter("x is not null and y is not null")
    clean = ~F.col("x.cold") & ~F.col("y.cold") & F.col("x.wall_seconds").isNotNull() & F.col("y.wall_seconds").isNotNull()
    leads = F.coalesce(F.col("x.position") < F.col("y.position"), F.lit(False))
    rounds = rounds.select("pair", clean.alias("clean"), S.ratio("x.wall_seconds", "y.wall_seconds").alias("r"), S.ratio("x.process_seconds", "y.process_seconds").alias("q"), leads.alias("leads"), F.coalesce(F.abs(F.col("x.position") - F.col("y.position")) == 1, F.lit(False)).alias("next_to"))
    ok = F.col("clean")
    per = rounds.groupBy("pair").agg(
        F.count("*").alias("scheduled"),
        F.count_if(ok).alias("rounds"),
        F.bool_and(F.when(ok, F.col("next_to"))).alias("adjacent"),
        (F.min(F.when(ok, F.col("leads"))) == F.max(F.when(ok, F.col("leads")))).alias("one_order"),
        S.median(F.when(ok, F.col("r"))).alias("m"),
        S.lead_balanced_median(F.when(ok, F.col("r")), "leads").alias("lb"),
        S.median(F.when(ok, F.col("q"))).alias("mq"),
        S.lead_balanced_median(F.when(ok, F.col("q")), "leads").alias("lbq"),
        F.min(F.when(ok, F.col("r"))).alias("low"),
        F.max(F.when(ok, F.col("r"))).alias("high"),
    )
    out = arms.join(per, "pair", "left")
    same, some = F.col("same_block"), F.coalesce(F.col("rounds"), F.lit(0)) > 0
    best = F.when(F.col("adjacent"), F.col("lb")).otherwise(F.col("m"))
    note = (
        F.when(~same, "unpaired")
        .when(~some, "inconclusive")
        .when(F.col("scheduled") < MIN_CLEAN_ROUNDS, "context")
        .when((F.col("rounds") < MIN_CLEAN_ROUNDS) | ((F.col("high") - F.col("low")) / best > MAX_SPREAD) | (F.col("adjacent") & F.col("one_order")), "inconclusive")
        .when(F.col("adjacent"), "paired")
        .otherwise("same-round")
    )
    return out.select(
        "pair",
        F.when(~same, F.col("far_ratio")).when(some, best).alias("ratio"),
        F.when(~same, F.col("far_process")).when(some, F.when(F.col("adjacent"), F.col("lbq")).otherwise(F.col("mq"))).alias("process_ratio"),
        F.when(same & some, F.col("low")).alias("low"),
        F.when(same & some, F.col("high")).alias("high"),
        F.when(same, F.coalesce("rounds", F.lit(0))).otherwise(0).cast("long").alias("rounds"),
        note.alias("note"),
    )


def medians(rows: DataFrame) -> DataFrame:
    return arm_stats(rows).drop("lone_block")


def predecessors(measured: DataFrame, releases: DataFrame, modes: tuple[str, ...] = ("default", "fast")) -> DataFrame:
    """Each release arm with its last measured predecessor by canonical rank: an as-of join as a window
    that ignores nulls."""
    ranked = measured.filter(F.col("mode").isin(*modes)).withColumn("release", release_of(F.col("label"))).join(F.broadcast(chronology(releases)), "release")  # the ladder
    w = Window.partitionBy("arch", "mode").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    known = F.when(F.col("median_wall_s").isNotNull(), F.col("label"))
    return ranked.withColumn("prior_label", F.last(known, ignorenulls=True).over(w)).withColumn("prior_wall_s", F.last("median_wall_s", ignorenulls=True).over(w))


def arena_table(rows: DataFrame, releases: DataFrame) -> DataFrame:
    """One row per (arch, label, mode): medians, counts, the ratio to the last measured release, and
    for arms that are no release the candidate's wall over theirs, in the order of the ladder. The rows and the facts of the arms are
    written once, as several parts of the table read them."""
    rows = materialize(rows.select(*MEASURED), "arena_rows")
    stats = materialize(arm_stats(rows), "arm_stats")
    table = stats.drop("lone_block")
    chain = predecessors(table, releases)
    pairs = chain.filter("prior_label is not null").select(F.concat_ws("|", "arch", "label", "mode").alias("pair"), "arch", "prior_label", F.col("mode").alias("prior_mode"), F.col("label").alias("this_label"), F.col("mode").alias("this_mode"))
    ratios = paired_ratios(rows, pairs, stats).join(pairs.select("pair", "arch", F.col("this_label").alias("label"), F.col("this_mode").alias("mode")), "pair")
    ratios = ratios.select("arch", "label", "mode", F.col("ratio").alias("vs_prior_release"), F.col("process_ratio").alias("vs_prior_process"), F.col("low").alias("prior_min"), F.col("high").alias("prior_max"), F.col("rounds").alias("prior_rounds"), F.col("note").alias("prior_note"))
    own = table.filter((F.col("label") == CANDIDATE) & (F.col("mode") == "default")).select("arch", F.col("median_wall_s").alias("own_wall"))
    known = chronology(releases)
    ranked = table.withColumn("release", release_of(F.col("label"))).join(F.broadcast(known), "release", "left").select("arch", "label", "mode", "rank", F.col("rank").isNull().alias("comparator"))
    out = table.join(ratios, ["arch", "label", "mode"], "left").join(own, "arch", "left").join(ranked, ["arch", "label", "mode"], "left")
    # releases in the ladder's order, then the others by name
    shown = out.withColumn("vs_candidate", F.when(F.col("comparator"), S.ratio("own_wall", "median_wall_s"))).orderBy("arch", F.asc_nulls_last("rank"), "label", "mode")
    return shown.drop("own_wall", "comparator", "rank")


def writer_control(rows: DataFrame) -> DataFrame:
    """What native output saves over the pipe: ``<label>-sam`` against ``<label>``. The rows are written once, as the arms, their
    facts and their rounds read them."""
    rows = materialize(rows.select(*MEASURED), "arena_rows")
    arms = rows.select("arch", "label", "mode").distinct()
    sam = arms.filter(F.col("label").endswith(CONTROL_SUFFIX)).select("arch", F.col("label").alias("prior_label"), F.col("mode").alias("prior_mode"), F.regexp_replace("label", f"{CONTROL_SUFFIX}$", "").alias("this_label"))
    pairs = sam.join(arms.select("arch", F.col("label").alias("this_label"), F.col("mode").alias("this_mode")), ["arch", "this_label"]).withColumn("pair", F.concat_ws("|", "arch", "this_label", "prior_mode", "this_mode"))
    out = paired_ratios(rows, pairs).join(pairs.select("pair", "arch", F.col("this_label").alias("label")), "pair")
    return out.select("arch", "label", F.col("ratio").alias("native_saves"), F.col("process_ratio").alias("process_saves"), "rounds", "note").orderBy("arch", "label")


def release_speedup(rows: DataFrame, releases: DataFrame, arch: str, baseline_label: str = "baseline") -> DataFrame:
    """Stock and fast walls of every release on one arch, against a baseline and against the previous
    measured release; the stock chain starts at the upstream build."""
    m = medians(rows.filter(F.col("arch") == arch)).select("label", "mode", "median_wall_s")
    ladder = chronology(releases)
    stock = m.filter("mode = 'default'").join(F.broadcast(ladder), m.label == F.col("release")).select("release", "rank", F.col("median_wall_s").alias("stock"))
    fast = m.filter("mode = 'fast'").select(release_of(F.col("label")).alias("release"), F.col("median_wall_s").alias("fast"))
    base = m.filter((F.col("label") == baseline_label) & (F.col("mode") == "default")).agg(F.max("median_wall_s").alias("base"))
    seed = m.filter((F.col("label") == SEED_LABEL) & (F.col("mode") == "default")).agg(F.max("median_wall_s").alias("seed"))
    rows_ = stock.join(fast, "release", "left").crossJoin(F.broadcast(base)).crossJoin(F.broadcast(seed))  # one row each
    w = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)  # a ladder: tens of rows
    before, before_fast = F.coalesce(F.last("stock", ignorenulls=True).over(w), F.col("seed")), F.last("fast", ignorenulls=True).over(w)
    return rows_.select(
        F.col("release").alias("label"),
        "rank",
        F.col("stock").alias("stock_median_wall_s"),
        S.ratio("base", "stock").alias("stock_speedup"),
        F.col("fast").alias("fast_median_wall_s"),
        S.ratio("base", "fast").alias("fast_speedup"),
        S.ratio(before, "stock").alias("stock_vs_prev_speedup"),
        S.ratio(before_fast, "fast").alias("fast_vs_prev_speedup"),
    ).orderBy("rank")
