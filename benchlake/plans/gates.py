"""Release gates. All fail closed: what is expected is a frame of its own, and a measurement that is
missing from it is a failure, never a pass on what there is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchlake.functions import stats as S

CELL = ("sample", "arch")

# The published thresholds.
GOLDEN_PCT = 99.999
DRIFT_MARGIN_PCT = 0.05
PERFECT_PCT, SUPERLINEAR_PP, MAX_DROP_PP, ABSOLUTE_PCT = 100.0, 2.0, 3.0, 5.0
REL_TOL, ABS_TOL_PPM, PP_TOL, SLACK = 0.02, 1.0, 0.02, 1e-9
CONFIDENT_MAPQ = 20
FAILING_GRADES = ("REGRESSION", "candidate_unreadable", "prior_unreadable", "both_unreadable")


# Gate 1: drift against declared budgets


def drift(trials: DataFrame, comparisons: DataFrame, kind: str = "vs-baseline") -> DataFrame:
    """By cell: lowest concordance, highest relocation, and how many replicates had no placement. JSON
    numbers are cast before the max: as strings 9.5 would beat 10.5."""
    relocated = S.measured(F.get_json_object("placement_json", "$.relocated_pct").cast("double"))
    own = trials.join(comparisons.filter(F.col("kind") == kind), F.col("id") == F.col("trial_id"))
    return own.groupBy(*CELL).agg(F.min("concordance_pct").alias("baseline_concordance"), F.max(relocated).alias("placement_relocated_pct"), F.count_if(relocated.isNull()).alias("placement_missing"))


def scoped(cells: DataFrame, registry: DataFrame) -> DataFrame:
    """Every registry entry that applies to a cell's sample (no list means all samples). The registry is
    a few dozen declared entries, so the containment join is a broadcast."""
    applies = F.col("samples").isNull() | (F.size("samples") == 0) | F.array_contains("samples", F.col("sample"))
    return cells.join(F.broadcast(registry.select("samples", F.col("metric").alias("entry_metric"), "expected_drift_pct", "gating")), applies, "left")


def budget_gate(cells: DataFrame, registry: DataFrame, margin: float = DRIFT_MARGIN_PCT) -> DataFrame:
    """Observed drift against the sum of the budgets that apply, on the metric the entries declare. A
    cell is report-only if every entry that applies says so; without any entry it gates."""
    hit = F.col("entry_metric").isNotNull()
    metric = F.when(F.coalesce(F.bool_or(F.col("entry_metric") == "confident_relocation"), F.lit(False)), "confident_relocation").otherwise("concordance")
    each = scoped(cells, registry)
    chosen = each.groupBy(*CELL).agg(metric.alias("metric"))
    same = F.col("entry_metric") == F.col("metric")
    sums = each.join(chosen, list(CELL)).groupBy(*CELL, "metric").agg(
        F.coalesce(F.sum(F.when(same, F.col("expected_drift_pct"))), F.lit(0.0)).alias("allowed_drift_pct"),
        F.coalesce(F.bool_and(F.when(hit & same, ~F.col("gating"))), F.lit(False)).alias("report_only"),
    )
    observed = F.when(F.col("metric") == "concordance", 100.0 - F.col("baseline_concordance")).when(F.col("placement_missing") == 0, F.col("placement_relocated_pct"))
    verdict = F.when(F.col("observed_drift_pct").isNull(), "missing_placement").when(F.col("observed_drift_pct") > F.col("allowed_drift_pct") + margin, "over_budget").otherwise("ok")
    out = cells.join(sums, list(CELL)).withColumn("observed_drift_pct", observed).withColumn("verdict", verdict).withColumn("gating", F.when(F.col("report_only"), "report-only").otherwise("gate"))
    return out.select(*CELL, "metric", "baseline_concordance", "observed_drift_pct", "allowed_drift_pct", "verdict", "gating").orderBy(*CELL)


def budget_failures(gate: DataFrame) -> DataFrame:
    return gate.filter("verdict <> 'ok' and gating = 'gate'")


def missing_cells(expected: DataFrame, present: DataFrame, keys: tuple[str, ...] = CELL) -> DataFrame:
    """Expected cells without a measurement."""
    return expected.select(*keys).distinct().join(present.select(*keys).distinct(), list(keys), "left_anti").orderBy(*keys)


def expected_cells(run: DataFrame, golden: DataFrame, keys: tuple[str, ...] = CELL) -> DataFrame:
    """Cells of the run that the golden run has as well."""
    return run.select(*keys).distinct().join(golden.select(*keys), list(keys), "left_semi").orderBy(*keys)


def in_cells(rows: DataFrame, cells: DataFrame, keys: tuple[str, ...] = CELL) -> DataFrame:
    """Rows of the given cells; a cell whose sample or arch is null is one like any other."""
    own = cells.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    return rows.join(own, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_semi")


# Gate 2: concordance with the golden run


def golden_failures(comparisons: DataFrame, threshold: float = GOLDEN_PCT) -> DataFrame:
    """Cells whose worst replicate is below the threshold."""
    return comparisons.groupBy(*CELL).agg(F.min("concordance_pct").alias("worst")).filter(F.col("worst") < threshold).orderBy(*CELL)


def golden_missing(expected: DataFrame, compared: DataFrame) -> DataFrame:
    """Expected cells with replicates that were not compared: (cell, missing_reps)."""
    got = compared.filter("concordance_pct is not null").select(*CELL, "rep").distinct()
    return expected.join(got, [*CELL, "rep"], "left_anti").groupBy(*CELL).agg(F.count("*").alias("missing_reps")).orderBy(*CELL)


# Gate 3: thread scaling


def efficiencies(scaling: DataFrame, sha: str) -> DataFrame:
    """Median time and strong-scaling efficiency of each rung above one thread; ladders without a
    positive T(1) have none."""
    own = scaling.filter(F.col("run_sha") == sha).withColumn("t", F.coalesce("process_seconds", "wall_seconds")).filter("t is not null")
    rungs = own.groupBy(*CELL, "threads").agg(S.median("t").alias("t_s"))
    t1 = F.max(F.when(F.col("threads") == 1, F.col("t_s"))).over(Window.partitionBy(*CELL))
    return rungs.withColumn("t1", t1).filter("t1 > 0 and threads > 1").select(*CELL, "threads", S.efficiency_pct("t1", "threads", "t_s").alias("efficiency_pct"), "t_s")


def scaling_gate(scaling: DataFrame, new: str, prev: str, max_drop_pp: float = MAX_DROP_PP, absolute_pct: float = ABSOLUTE_PCT) -> DataFrame:
    """Shared rungs of two runs. A ladder whose previous efficiency exceeds 102 % anywhere, over the
    whole previous ladder and not only the shared rungs, is compared on absolute times."""
    a = efficiencies(scaling, new).select(*CELL, "threads", F.col("efficiency_pct").alias("efficiency_pct_new"), F.col("t_s").alias("t_s_new"))
    top = F.max("efficiency_pct").over(Window.partitionBy(*CELL))
    b = efficiencies(scaling, prev).withColumn("top", top).select(*CELL, "threads", "top", F.col("efficiency_pct").alias("efficiency_pct_prev"), F.col("t_s").alias("t_s_prev"))
    out = a.join(b, [*CELL, "threads"]).withColumns({"drop_pp": F.col("efficiency_pct_prev") - F.col("efficiency_pct_new"), "abs_delta_pct": S.delta_pct("t_s_new", "t_s_prev"), "basis": F.when(F.col("top") > PERFECT_PCT + SUPERLINEAR_PP, "absolute").otherwise("efficiency")})
    bad = F.when(F.col("basis") == "absolute", F.col("abs_delta_pct") > absolute_pct).otherwise(F.col("drop_pp") > max_drop_pp)
    return out.withColumn("verdict", F.when(bad, "REGRESSION").otherwise("ok")).drop("top").orderBy(*CELL, "threads")


# Gate 1b: accuracy against simulated truth


def _count(v: Column, path: str) -> Column:
    """A JSON count: an integer, not a boolean, a string or a fraction."""
    x = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(x) == "BIGINT", F.try_variant_get(v, path, "long"))


def bin_bounds(name: Column) -> tuple[Column, Column]:
    """(lower, upper) of a MAPQ bin "N", "N-M" or "N+"; null bounds mean it cannot be read, and an open
    bin has the largest upper bound."""
    lone, span, over = (F.regexp_extract(name, p, 1) for p in (r"^(\d+)$", r"^(\d+)-\d+$", r"^(\d+)\+$"))
    high = F.regexp_extract(name, r"^\d+-(\d+)$", 1)
    low = F.when(lone != "", lone).when(span != "", span).when(over != "", over).cast("int")
    top = F.when(lone != "", lone).when(span != "", high).when(over != "", F.lit("2147483647")).cast("int")
    sound = low <= top
    return F.when(sound, low), F.when(sound, top)


def placement_metrics(accuracy: DataFrame) -> DataFrame:
    """Adds ``mismapped_ppm``, ``correct_pct`` and ``read_total``, null where a table is inconsistent: not
    readable, impossible counts, a zero total, a bin across the confident cut, bins that do not add up. All
    of it is folds over a row's own bins: nothing is shuffled."""
    names = ("total", "correct", "mismapped")
    v = F.try_parse_json("placement_json")
    bins = F.from_json(F.to_json(F.try_variant_get(v, "$.bins", "variant")), "map<string,string>")

    def one(e: Column) -> Column:
        low, high = bin_bounds(e["key"])
        return F.struct(low.alias("low"), high.alias("high"), F.try_parse_json(e["value"]).alias("v"))

    def counted(b: Column) -> Column:
        return F.struct(b["low"].alias("low"), b["high"].alias("high"), *(_count(b["v"], f"$.{k}").alias(k) for k in names))

    def sound(b: Column) -> Column:
        possible = (b["total"] >= 0) & (b["correct"] >= 0) & (b["mismapped"] >= 0) & (b["correct"] + b["mismapped"] <= b["total"])
        return F.coalesce(possible & b["low"].isNotNull() & ~((b["low"] < CONFIDENT_MAPQ) & (b["high"] >= CONFIDENT_MAPQ)), F.lit(False))

    def summed(k: str, of: str = "_bins") -> Column:
        return F.aggregate(F.transform(of, lambda b: F.coalesce(b[k], F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda x, y: x + y)

    own = accuracy.withColumns({"_all": F.struct(*(_count(v, f"$.all.{k}").alias(k) for k in names)), "_bins": F.transform(F.transform(F.map_entries(bins), one), counted)})
    own = own.withColumn("_sure", F.filter("_bins", lambda b: b["low"] >= CONFIDENT_MAPQ))
    t = F.col("_all.total")
    fits = F.coalesce((F.size("_bins") > 0) & F.forall("_bins", sound) & (t > 0) & (summed("total") == t) & (summed("correct") == F.col("_all.correct")) & (summed("mismapped") == F.col("_all.mismapped")), F.lit(False))
    metrics = {"mismapped_ppm": F.when(fits, summed("mismapped", "_sure") / t * 1e6), "correct_pct": F.when(fits, summed("correct", "_sure") / t * 100.0), "read_total": F.when(fits, t).otherwise(0)}
    return own.select(*accuracy.columns, *(x.alias(k) for k, x in metrics.items()))


def graded(accuracy: DataFrame, trials: DataFrame, tool: str = "candidate") -> DataFrame:
    """Graded replicates of a run; a cell that has trials is graded on the replicates of those only."""
    own = placement_metrics(accuracy.filter((F.col("tool") == tool) & F.col("placement_json").isNotNull()))
    cells, reps = trials.select(*CELL).distinct().withColumn("ran", F.lit(True)), trials.select(*CELL, "rep").distinct().withColumn("has", F.lit(True))
    return own.join(cells, list(CELL), "left").join(reps, [*CELL, "rep"], "left").filter("ran is null or has").drop("ran", "has")


def grades(rows: DataFrame) -> DataFrame:
    """By cell: replicates, and medians that are null if any replicate is unreadable."""
    return rows.groupBy(*CELL).agg(F.count_distinct("rep").alias("n"), S.median_strict("mismapped_ppm").alias("mismapped_ppm"), S.median_strict("correct_pct").alias("correct_pct"))


def grade_gate(new: DataFrame, prev: DataFrame) -> DataFrame:
    """Grades of two runs by cell with a verdict, inclusive at the tolerance."""
    names = ("n", "mismapped_ppm", "correct_pct")
    a, b = (grades(r).select(*CELL, *(F.col(k).alias(f"{k}_{s}") for k in names)) for r, s in ((new, "new"), (prev, "prev")))
    out = a.join(b, list(CELL), "left")
    bad_new = F.col("mismapped_ppm_new").isNull() | F.col("correct_pct_new").isNull()
    bad_prev = F.col("mismapped_ppm_prev").isNull() | F.col("correct_pct_prev").isNull()
    worse = (F.col("mismapped_ppm_new") > F.col("mismapped_ppm_prev") * (1 + REL_TOL) + ABS_TOL_PPM + SLACK) | (F.col("correct_pct_new") < F.col("correct_pct_prev") - PP_TOL - SLACK)
    none = F.col("n_prev").isNull()
    verdict = F.when(none & bad_new, "candidate_unreadable").when(none, "new_only").when(bad_new & bad_prev, "both_unreadable").when(bad_new, "candidate_unreadable").when(bad_prev, "prior_unreadable").when(worse, "REGRESSION").otherwise("ok")
    return out.withColumn("verdict", verdict).orderBy(*CELL)


def ungraded(trials: DataFrame, rows: DataFrame, side: str) -> DataFrame:
    """Cells with trial replicates that have no grade."""
    missing = trials.select(*CELL, "rep").distinct().join(rows.select(*CELL, "rep").distinct().withColumn("g", F.lit(1)), [*CELL, "rep"], "left")
    lists = missing.groupBy(*CELL).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("g").isNull(), F.col("rep")))).alias("m")).filter("size(m) > 0")
    detail = F.format_string("%d of %d reps graded (missing %s)", F.col("n") - F.size("m"), F.col("n"), F.array_join(F.transform("m", lambda r: r.cast("string")), ", "))
    return lists.select(*CELL, F.lit(side).alias("side"), detail.alias("detail"))


def short_reads(new: DataFrame, prev: DataFrame) -> DataFrame:
    """Replicates that graded fewer reads than the fullest of the cell on either side."""
    shared = in_cells(prev, new)
    both = new.select(*CELL, "rep", "read_total", F.lit("candidate").alias("side")).union(shared.select(*CELL, "rep", "read_total", F.lit("prior")))
    full = F.max("read_total").over(Window.partitionBy(*CELL))
    return both.withColumn("expected", full).filter("read_total > 0 and read_total < expected").select(*CELL, "side", F.format_string("rep %d graded %d of %d reads", "rep", "read_total", "expected").alias("detail"))


def grade_missing(new_trials: DataFrame, new: DataFrame, prev_trials: DataFrame, prev: DataFrame) -> DataFrame:
    """Everything that should have been graded and was not, on either side."""
    both = prev.select(*CELL).join(new.select(*CELL), list(CELL), "left_semi").distinct()
    lost = prev.select(*CELL).distinct().join(new.select(*CELL), list(CELL), "left_anti").join(new_trials.select(*CELL), list(CELL), "left_anti")
    never = new.select(*CELL).distinct().join(prev.select(*CELL), list(CELL), "left_anti").join(prev_trials.select(*CELL), list(CELL), "left_semi")
    return (
        ungraded(new_trials, new, "candidate")
        .union(ungraded(prev_trials.join(both, list(CELL), "left_semi"), prev, "prior"))
        .union(short_reads(new, prev))
        .union(lost.select(*CELL, F.lit("candidate"), F.lit("graded in the prior release, not run in the candidate")))
        .union(never.select(*CELL, F.lit("prior"), F.lit("the prior release ran this cell but has no grade for it")))
        .orderBy(*CELL, "side", "detail")
    )


def verdict_counts(gate: DataFrame) -> DataFrame:
    return gate.groupBy("verdict").agg(F.count("*").alias("n")).orderBy("verdict")


def worst(gate: DataFrame, delta: str) -> DataFrame:
    """The cell with the largest delta, nulls ignored."""
    return gate.filter(F.col(delta).isNotNull()).agg(F.max_by(F.struct(*CELL, delta), F.struct(delta, *CELL)).alias("w")).select("w.*")


def regression(failures: dict[str, DataFrame]) -> DataFrame:
    """One row: each gate's number of failing rows and whether all are zero. A union of counts, one job."""
    out = None
    for name, frame in failures.items():
        one = frame.agg(F.count("*").alias("failures")).select(F.lit(name).alias("gate"), "failures")
        out = one if out is None else out.union(one)
    if out is None:
        raise ValueError("no gate: an empty regression check is not a pass")
    return out.groupBy().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("gate", "failures")))).alias("failures"), (F.sum("failures") == 0).alias("ok"))
