"""The release verdict: every predicate that fails a release, as a frame of failing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.plans import gates, perf
from benchlake.plans.collect import BASELINE_PREFIX
from benchlake.sources.dimensions import no_samples

CELL = ["sample", "arch"]


def baseline_cells(trials: DataFrame) -> DataFrame:
    """Cells that any run of the baseline tree has: a prefix filter on the partition column."""
    return trials.filter(F.col("run_sha").startswith(BASELINE_PREFIX)).select(*CELL).distinct()


def missing_baseline(trials: DataFrame, comparisons: DataFrame, samples: DataFrame, sha: str) -> DataFrame:
    """Cells of a run that have a baseline counterpart and no comparison with it; truth samples are graded
    and not compared."""
    own = perf.run_trials(trials, sha)
    timed = own.join(samples.filter("truth").select("sample"), "sample", "left_anti")
    present = own.join(comparisons.filter("kind = 'vs-baseline'").select(F.col("trial_id").alias("id")), "id", "left_semi")
    return gates.missing_cells(gates.expected_cells(timed, baseline_cells(trials)), present)


def swept(trials: DataFrame, samples: DataFrame) -> DataFrame:
    """Trials of samples that are compared with the golden run: no truth, fast, compat or ALT-aware ones. A
    sample that is not declared is compared."""
    exempt = samples.filter(F.col("truth") | F.col("compat") | F.col("alt_aware")).select("sample")
    return trials.filter(~F.col("sample").endswith("-fast")).join(exempt, "sample", "left_anti")


def failures(trials: DataFrame, comparisons: DataFrame, accuracy: DataFrame, scaling: DataFrame, registry: DataFrame, sha: str, prev: str, golden: str = "", samples: DataFrame | None = None) -> dict[str, DataFrame]:
    """Each predicate's failing rows; a release passes if all are empty. Without a golden run its three
    predicates, and the demand for grades, have none. samples: sample, truth, meth, compat, alt_aware."""
    samples = no_samples(trials.sparkSession) if samples is None else samples
    new, old = perf.run_trials(trials, sha), perf.run_trials(trials, prev)
    none = lambda f: f.groupBy().agg(F.count("*").alias("n")).filter("n = 0")
    truth = samples.filter("truth").select("sample")
    timed = [t.join(truth, "sample", "left_anti") for t in (new, old)]
    golden_rows = comparisons.filter("kind = 'vs-golden' and concordance_pct is not null").select(F.col("trial_id").alias("id"), "concordance_pct")
    compared = new.select("id", *CELL, "rep").join(golden_rows, "id")
    of = lambda s, t: gates.graded(accuracy.filter(F.col("run_sha") == s), t)
    a, b = of(sha, new), of(prev, old)
    must = new.join(a.select(*CELL).distinct().union(new.join(samples.filter("truth and meth").select("sample"), "sample", "left_semi").select(*CELL)).distinct(), CELL, "left_semi")
    out = {
        "no trials": none(new),
        "1 drift": gates.budget_failures(gates.budget_gate(gates.drift(new, comparisons), registry)),
        "1 missing": missing_baseline(trials, comparisons, samples, sha),
        "1b grades": gates.grade_gate(a, b).filter(F.col("verdict").isin(*gates.FAILING_GRADES)),
        "1b grades missing": gates.grade_missing(must, a, old, b),
        "2 concordance": gates.golden_failures(compared),
        "3 scaling": gates.scaling_gate(scaling, sha, prev).filter("verdict = 'REGRESSION'"),
        "performance": perf.perf_cells(*timed).filter("verdict = 'REGRESSION'"),
    }
    if golden:
        cells = perf.run_trials(trials, golden).select(*CELL).distinct()
        expected = gates.in_cells(swept(new, samples).select(*CELL, "rep"), cells)
        out |= {"1b none graded": none(a), "2 golden not ingested": none(cells), "2 nothing compared": none(compared), "2 concordance missing": gates.golden_missing(expected, compared)}
    return out
