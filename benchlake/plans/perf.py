"""Reports over ``trials``: summary, metric tables, speedups, performance cells, trend, results cells."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchlake.functions import stats as S

CELL = ("sample", "arch")
#: A change of the median up to this size is flat.
FLAT_PCT = 5.0
MIN_REPS = 2
METRICS = ("wall_seconds", "max_rss_mb", "io_read_mb", "io_write_mb", "cpu_time")


def run_trials(trials: DataFrame, sha: str) -> DataFrame:
    """One run's trials: a filter on the partition column, so other runs are not read."""
    return trials.filter(F.col("run_sha") == sha)


def timed(trials: DataFrame) -> DataFrame:
    return trials.filter("wall_seconds is not null and wall_seconds > 0")


def excluding(trials: DataFrame, samples: Iterable[str]) -> DataFrame:
    """Trials without truth samples, which are graded and not timed."""
    names = sorted(set(samples))
    return trials.filter(~F.col("sample").isin(names)) if names else trials


def best_walls(trials: DataFrame, sha: str) -> DataFrame:
    return timed(run_trials(trials, sha)).groupBy(*CELL).agg(F.min("wall_seconds").alias("wall_seconds"), F.min("process_seconds").alias("process_seconds"))


def speedup_table(trials: DataFrame, candidate: str, baseline: str, third: str | None = None, third_name: str = "third") -> DataFrame:
    """Best candidate walls against the best of a baseline, and of a third tool if given: left joins on
    the cell, so a cell the baseline lacks stays with null ratios."""
    new = best_walls(trials, candidate).select(*CELL, F.col("wall_seconds").alias("candidate_s"), F.col("process_seconds").alias("candidate_process_s"))
    old = best_walls(trials, baseline).select(*CELL, F.col("wall_seconds").alias("baseline_s"), F.col("process_seconds").alias("baseline_process_s"))
    out = new.join(old, list(CELL), "left").withColumns({"speedup": S.ratio("baseline_s", "candidate_s"), "process_speedup": S.ratio("baseline_process_s", "candidate_process_s")})
    if third:
        other = best_walls(trials, third).select(*CELL, F.col("wall_seconds").alias(f"{third_name}_s"))
        out = out.join(other, list(CELL), "left").withColumn(f"{third_name}_speedup", S.ratio(f"{third_name}_s", "candidate_s"))
    return out.orderBy(*CELL)


def summary(trials: DataFrame, comparisons: DataFrame, sha: str, kind: str = "vs-baseline") -> DataFrame:
    """Trials with one kind of comparison: the kind is filtered before the left join, so trials without
    one stay."""
    right = comparisons.filter(F.col("kind") == kind).select(F.col("trial_id").alias("id"), "concordance_pct", F.col("total").alias("comp_total"))
    columns = ("sample", "arch", "rep", "wall_seconds", "process_seconds", "index_read_seconds", "max_rss_mb", "cpu_time", "io_read_mb", "io_write_mb")
    return run_trials(trials, sha).join(right, "id", "left").select(*columns, "concordance_pct", "comp_total").orderBy("sample", "arch", "rep")


def metric_table(trials: DataFrame, sha: str, baseline: str | None = None) -> DataFrame:
    """Per trial, the five reported metrics; with a baseline, its best wall and the speedup."""
    out = run_trials(trials, sha).select("sample", "arch", "rep", *METRICS)
    if baseline:
        walls = timed(run_trials(trials, baseline)).groupBy(*CELL).agg(F.min("wall_seconds").alias("baseline_s"))
        out = out.join(walls, list(CELL), "left").withColumn("speedup", S.ratio("baseline_s", "wall_seconds"))
    return out.orderBy("sample", "arch", "rep")


def perf_stats(trials: DataFrame) -> DataFrame:
    w = F.col("wall_seconds")
    return trials.groupBy(*CELL).agg(F.count(w).alias("n"), S.median(w).alias("median"), F.min(w).alias("min"), F.max(w).alias("max"), S.cv_pct(w).alias("cv_pct"), S.set_label("image_variant").alias("variant"))


def perf_cells(new: DataFrame, prev: DataFrame, truth_samples: Iterable[str] = ()) -> DataFrame:
    """Median walls of two runs by cell with a verdict. The order of the checks matters: a change of
    image variant, no predecessor, too few replicates, flat, then whether the ranges are apart."""
    a, b = (perf_stats(excluding(t, truth_samples)) for t in (new, prev))
    names = ("n", "median", "min", "max", "cv_pct", "variant")
    a, b = (t.select(*CELL, *(F.col(k).alias(f"{k}_{side}") for k in names)) for t, side in ((a, "new"), (b, "prev")))
    out = a.join(b, list(CELL), "left").withColumn("delta_pct", S.delta_pct("median_new", "median_prev"))
    apart_up, apart_down = F.col("min_new") > F.col("max_prev"), F.col("max_new") < F.col("min_prev")
    verdict = (
        F.when(F.col("variant_prev").isNotNull() & (F.col("variant_new") != F.col("variant_prev")), "variant_changed")
        .when(F.col("delta_pct").isNull(), "new_only")
        .when((F.col("n_new") < MIN_REPS) | (F.col("n_prev") < MIN_REPS), "noisy")
        .when(F.abs("delta_pct") <= FLAT_PCT, "flat")
        .when(F.col("delta_pct") > 0, F.when(apart_up, "REGRESSION").otherwise("noisy"))
        .otherwise(F.when(apart_down, "improvement").otherwise("noisy"))
    )
    return out.withColumn("verdict", verdict).orderBy("arch", "sample")


def cell_variants(trials: DataFrame) -> DataFrame:
    return trials.groupBy(*CELL).agg(S.set_label("image_variant").alias("variant"))


def recent_runs(runs: DataFrame, last: int) -> DataFrame:
    """The most recent runs (a top-k, not a full sort)."""
    return runs.orderBy(F.desc("submitted_at"), F.desc("run_sha")).limit(last)


def trend(trials: DataFrame, runs: DataFrame, comparisons: DataFrame, last: int = 20) -> DataFrame:
    """Mean wall and concordance by run and cell over the most recent runs."""
    recent = recent_runs(runs, last).select("run_sha")
    right = comparisons.filter("kind = 'vs-baseline'").select(F.col("trial_id").alias("id"), "concordance_pct")
    own = trials.join(F.broadcast(recent), "run_sha", "left_semi")  # `last` rows
    return own.join(right, "id", "left").groupBy("run_sha", *CELL).agg(F.avg("wall_seconds").alias("wall_mean"), F.avg("concordance_pct").alias("concordance")).orderBy("run_sha", *CELL)


def trial_cells(trials: DataFrame, threads: int = 16) -> DataFrame:
    """What a results page shows of a cell: medians, CPU efficiency, spread (null for one replicate)."""
    return trials.groupBy(*CELL).agg(
        F.count("wall_seconds").alias("reps"),
        S.median("wall_seconds").alias("wall_s"),
        S.median("process_seconds").alias("process_s"),
        (S.median("max_rss_mb") / 1024).alias("rss_gb"),
        S.median(S.cpu_efficiency_pct("cpu_time", "wall_seconds", F.lit(threads))).alias("cpu_efficiency_pct"),
        S.cv_pct("wall_seconds", lone=None).alias("cv_pct"),
    )


def late_cells(trials: DataFrame, hours: float = 24.0) -> DataFrame:
    """Cells measured more than ``hours`` from their own run's median stamp; positive is late."""
    stamp = F.unix_micros(F.try_to_timestamp("measured_at")) / 1e6
    own = trials.select("run_sha", *CELL, "rep", stamp.alias("at")).filter("at is not null")
    middle = S.exact_medians(own, ("run_sha",), "at", "middle")
    off = (F.col("at") - F.col("middle")) / 3600
    return own.join(middle, "run_sha").withColumn("hours_late", off).filter(F.abs("hours_late") > hours).select("run_sha", *CELL, "rep", "hours_late").orderBy("run_sha", *CELL, "rep")


def mixed_variants(trials: DataFrame) -> DataFrame:
    """Cells of a run whose replicates ran more than one image variant (not recorded is portable, ""), with
    the number of replicates and the first of each variant."""
    each = trials.groupBy("run_sha", *CELL, F.coalesce("image_variant", F.lit("")).alias("variant")).agg(F.count_distinct("rep").alias("reps"), F.min("rep").alias("first"))
    return each.groupBy("run_sha", *CELL).agg(F.array_sort(F.collect_list(F.struct("variant", "reps", "first"))).alias("variants")).filter(F.size("variants") > 1)


def keep_latest(runs: DataFrame, k: int, golden: DataFrame) -> DataFrame:
    """Runs whose large files may go: neither among the k most recent nor golden."""
    keep = recent_runs(runs, k).select("run_sha").union(golden.select("run_sha"))
    return runs.join(keep.distinct(), "run_sha", "left_anti")


def first_usable(accuracy: DataFrame) -> DataFrame:
    """The lowest replicate with a usable payload in each cell and tool."""
    w = Window.partitionBy("sample", "arch", "tool").orderBy("rep")
    return accuracy.filter("by_class_json is not null").withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


PROBE_CELL = ("run_sha", "sample", "arch")


def ladder_probes(scaling: DataFrame, probes: DataFrame) -> DataFrame:
    """A ladder's rungs with its own job's readings: by run, sample and arch. The host would not do as the
    key, as one host may run several ladders."""
    own = probes.filter("rep = 0").select(*PROBE_CELL, "phase", "m_accesses_per_sec", "ns_per_access")
    return scaling.join(own, list(PROBE_CELL)).select(*PROBE_CELL, "threads", F.col("rep").alias("rung_rep"), "phase", "m_accesses_per_sec", "ns_per_access", "wall_seconds")


def ladder_probe_totals(scaling: DataFrame, probes: DataFrame, value: str = "m_accesses_per_sec") -> DataFrame:
    """By run, sample, arch and phase: how many rows ``ladder_probes`` has there (``n``) and what ``value`` sums to over
    them (``total``). Every rung of a cell meets every reading, so the sides are summed before they meet."""
    rungs = scaling.groupBy(*PROBE_CELL).agg(F.count("*").alias("_rungs"))
    readings = probes.filter("rep = 0").groupBy(*PROBE_CELL, "phase").agg(F.count("*").alias("_readings"), F.sum(value).alias("_sum"))
    return rungs.join(readings, list(PROBE_CELL)).select(*PROBE_CELL, "phase", (F.col("_rungs") * F.col("_readings")).alias("n"), (F.col("_rungs") * F.col("_sum")).alias("total"))


def host_neighbours(scaling: DataFrame, probes: DataFrame) -> DataFrame:
    """What other cells measured on a ladder's host: by known host, across runs."""
    known = lambda f: f.filter("instance_id is not null and instance_id not in ('', 'unknown')")
    ladders = known(scaling).select(*(F.col(c).alias(f"ladder_{c}") for c in PROBE_CELL), "instance_id").distinct()
    other = ~(F.struct(*(F.col(f"ladder_{c}") for c in PROBE_CELL)).eqNullSafe(F.struct(*(F.col(c) for c in PROBE_CELL))))
    return ladders.join(known(probes).select(*PROBE_CELL, "rep", "phase", "instance_id", "m_accesses_per_sec"), "instance_id").filter(other)


def bars(trials: DataFrame, sha: str, metric: str) -> DataFrame:
    """What a bar chart of a run shows: a bar for each arch in a facet for each sample."""
    return run_trials(trials, sha).groupBy(F.col("sample").alias("facet"), F.col("arch").alias("x")).agg(F.avg(metric).alias("y")).orderBy("facet", "x")


def lines(trends: DataFrame, runs: DataFrame, metric: str) -> DataFrame:
    """What a line chart over runs shows: a line for each cell, runs in the order of their submission."""
    order = Window.orderBy("submitted_at", "run_sha")  # the recent runs: tens of rows
    place = runs.join(trends.select("run_sha").distinct(), "run_sha", "left_semi").select("run_sha", F.row_number().over(order).alias("x"))
    return trends.join(place, "run_sha").select(F.concat_ws("/", *CELL).alias("line"), "x", "run_sha", F.col(metric).alias("y")).orderBy("line", "x")
