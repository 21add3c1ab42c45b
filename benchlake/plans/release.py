"""Release documents: comparison report, concordance by release, snapshot, preflight."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchlake.functions import stats as S
from benchlake.operators import sets
from benchlake.plans import arena, gates, perf

CELL = ("sample", "arch")


def compared(trials: DataFrame, comparisons: DataFrame, sha: str, kind: str = "vs-baseline") -> DataFrame:
    right = comparisons.filter(F.col("kind") == kind).select(F.col("trial_id").alias("id"), "concordance_pct", "total", "by_class_json", "supp_json", "placement_json")
    return perf.run_trials(trials, sha).join(right, "id").withColumn("drift_pct", 100.0 - F.col("concordance_pct"))


def class_counts(rows: DataFrame) -> DataFrame:
    """Discordance classes summed over trials, most frequent first."""
    each = rows.select(F.explode(F.from_json("by_class_json", "map<string,struct<count:long,pct:double>>")).alias("class", "e"))
    return each.groupBy("class").agg(F.sum("e.count").alias("count")).orderBy(F.desc("count"), "class")


def class_medians(rows: DataFrame) -> DataFrame:
    each = rows.select(*CELL, F.explode(F.from_json("by_class_json", "map<string,struct<count:long,pct:double>>")).alias("class", "e"))
    return each.groupBy(*CELL, "class").agg(F.round(S.median("e.pct"), 4).alias("pct"))


def supplementary(rows: DataFrame) -> DataFrame:
    j = F.from_json("supp_json", "supp_query_total long, supp_baseline_total long, supp_count_mismatch_templates long, supp_unmatched_pct double")
    own = rows.filter("supp_json is not null").withColumn("j", j)
    n = lambda k: F.coalesce(f"j.{k}", F.lit(0))
    return own.select(*CELL, n("supp_query_total").alias("supp_query"), n("supp_baseline_total").alias("supp_baseline"), n("supp_count_mismatch_templates").alias("count_mismatch"), n("supp_unmatched_pct").alias("unmatched_pct")).orderBy(*CELL)


def drift_against_registry(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Mean drift of the samples that the concordance metric gates, and the sum of what is declared."""
    cells = rows.select(*CELL).distinct()
    scoped = gates.scoped(cells, registry).groupBy(*CELL).agg(F.coalesce(F.bool_or(F.col("entry_metric") == "confident_relocation"), F.lit(False)).alias("relocation"), F.coalesce(F.sum(F.when(F.col("entry_metric") == "concordance", F.col("expected_drift_pct"))), F.lit(0.0)).alias("declared_pct"))
    own = rows.join(scoped.filter(~F.col("relocation")), list(CELL))
    return own.agg(F.avg("drift_pct").alias("mean_drift_pct"), F.max("declared_pct").alias("declared_pct"))


def release_concordance(trials: DataFrame, comparisons: DataFrame, releases: list[tuple[str, str]]) -> DataFrame:
    """For each release and sample the whole row that has the lowest concordance."""
    spark = trials.sparkSession
    named = spark.createDataFrame(releases, "release string, run_sha string")
    right = comparisons.filter("kind = 'vs-baseline'").select(F.col("trial_id").alias("id"), "concordance_pct", "supp_json")
    rows = trials.join(F.broadcast(named), "run_sha").join(right, "id")  # the releases asked for
    w = F.min_by(F.struct("concordance_pct", "supp_json"), F.struct("concordance_pct", "arch", "rep"))
    out = rows.groupBy("release", "sample").agg(w.alias("r"))
    n = lambda k: F.coalesce(F.get_json_object("r.supp_json", f"$.{k}").cast("long"), F.lit(0))
    return out.select("release", "sample", F.col("r.concordance_pct").alias("concordance_pct"), n("supp_query_total").alias("supp_query"), n("supp_baseline_total").alias("supp_baseline"), n("supp_count_mismatch_templates").alias("count_mismatch")).orderBy("release", "sample")


def comparison_cells(rows: DataFrame) -> DataFrame:
    moved = S.measured(F.get_json_object("placement_json", "$.relocated_pct").cast("double"))
    own = rows.groupBy(*CELL).agg(F.count("*").alias("n"), S.median("concordance_pct").alias("median_pct"), F.min("concordance_pct").alias("min_pct"), S.median(moved).alias("relocated_pct"))
    classes = class_medians(rows).groupBy(*CELL).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("class", "pct")))).alias("class_pct"))
    return own.join(classes, list(CELL), "left")


# Tools as the accuracy table names them, in report order.
TOOLS = ("candidate", "baseline", "third")


def accuracy_headline(accuracy: DataFrame, sha: str, order: tuple[str, ...] = TOOLS) -> DataFrame:
    """Mean grades by cell and tool; tools in their customary order, others last."""
    columns = ("placement_correct_pct", "placement_mismapped_pct", "placement_unmapped_pct", "variant_bearing_reads", "md_concordant_pct", "nm_concordant_pct", "meth_n_cpg", "meth_pearson_r", "meth_rmse")
    place = F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(t) for t in order)), F.col("tool")), F.lit(0).cast("long")), F.lit(99).cast("long"))
    own = accuracy.filter(F.col("run_sha") == sha).groupBy(*CELL, "tool").agg(*(F.avg(c).alias(c) for c in columns))
    return own.orderBy("sample", place, "arch")


def accuracy_classes(accuracy: DataFrame, sha: str) -> DataFrame:
    """Variant classes of the lowest usable replicate of each cell and tool."""
    first = perf.first_usable(accuracy.filter(F.col("run_sha") == sha))
    entry = "map<string,struct<n_expected:double,n_represented:double,represented_pct:double,mean_mapq:double,mean_as:double>>"
    return first.select(*CELL, "tool", F.explode(F.from_json("by_class_json", entry)).alias("class", "e")).select(*CELL, "tool", "class", "e.*").orderBy("sample", "arch", "tool", "class")


def previous_release(ledger: DataFrame, sha: str) -> DataFrame:
    """The entry of a release with the SHA of the one before it."""
    w = Window.orderBy("ordinal")  # the ledger: tens of rows
    return ledger.withColumn("previous_sha", F.lag("to_sha").over(w)).filter(F.col("to_sha").startswith(sha) | F.lit(sha).startswith(F.col("to_sha")))


def snapshot(trials: DataFrame, comparisons: DataFrame, accuracy: DataFrame, arena_rows: DataFrame, scaling: DataFrame, ladder: DataFrame, ledger: DataFrame, sha: str, version: str, threads: int = 16) -> dict[str, Any]:
    """The frozen document of a release, from frames that have a row for each cell of it."""
    entry = previous_release(ledger, sha).first()
    if entry is None:
        raise ValueError(f"{sha} is no release of the ledger")
    own = perf.run_trials(trials, sha)
    speed = [r.asDict(True) for r in perf.trial_cells(own, threads).orderBy(*CELL).collect()]
    if not speed:
        raise ValueError(f"no trials of {sha}")
    kinds = [r[0] for r in comparisons.select("kind").distinct().orderBy("kind").collect()]
    rows = lambda f: [r.asDict(True) for r in f.collect()]
    return {
        "version": version, "run_sha": entry["to_sha"], "aliases": entry["aliases"], "date": entry["date"], "pr": entry["pr"], "previous": entry["previous_sha"], "threads": threads,
        "max_reps": max(r["reps"] for r in speed), "image_variants": sorted({r[0] for r in own.select(F.coalesce("image_variant", F.lit(""))).distinct().collect()}),
        "speed": speed,
        "agreement": {k: rows(comparison_cells(compared(trials, comparisons, sha, k)).orderBy(*CELL)) for k in kinds},
        "arena": rows(arena.arena_table(arena_rows, ladder)),
        "accuracy": rows(accuracy_headline(accuracy, sha)),
        "scaling": rows(gates.efficiencies(scaling, sha).orderBy(*CELL, "threads")),
    }


def host_walls(rows: DataFrame, expected_rounds: int) -> DataFrame:
    """Walls of a host's arms rounded to two places before any ratio is taken, and what is wrong with an
    arm's rounds: missing ones, ids out of range, none measured."""
    g = rows.groupBy("arch", "label", "mode").agg(F.round(S.median("wall_seconds"), 2).alias("wall_s"), F.count("wall_seconds").alias("n"), F.count_distinct("rep").alias("rounds"), F.min("rep").alias("first"), F.max("rep").alias("last"))
    problem = F.when(F.col("n") == 0, "not measured").when((F.col("first") < 1) | (F.col("last") > expected_rounds), "wrong round ids").when((F.col("rounds") < expected_rounds) | (F.col("n") < expected_rounds), "partial")
    return g.select("arch", "label", "mode", "wall_s", "n", problem.alias("problem"))


def index_problems(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Arms whose recorded index family is not the one their place in the ladder asks for. rows: arch, label,
    mode, index; expected: label, mode, index."""
    want = expected.select("label", "mode", F.col("index").alias("_want"))
    return rows.join(want, ["label", "mode"]).filter(~F.col("index").eqNullSafe(F.col("_want"))).select("arch", "label", "mode", F.format_string("recorded %s, expected %s", F.coalesce("index", F.lit("nothing")), "_want").alias("problem")).distinct()


def preflight(ladder: DataFrame, ledger: DataFrame, golden_run_cells: DataFrame, golden_cells: DataFrame, sha: str, golden_sha: str) -> DataFrame:
    """(check, failures, ok) before a candidate is blessed against a golden release: both names are in order,
    the candidate is new, the golden is the newest release of ledger and ladder, and its copy is whole."""
    names = lambda s: F.col("to_sha").startswith(s) | F.lit(s).startswith(F.col("to_sha")) | F.exists("aliases", lambda a: a.startswith(s) | F.lit(s).startswith(a))
    a, b = ladder.select(F.col("sha").alias("k")), ledger.select(F.col("to_sha").alias("k"))
    one = ledger.sparkSession.range(1)
    newest = ledger.agg(F.max_by("to_sha", "ordinal").alias("k")).filter(~F.coalesce(F.col("k").startswith(golden_sha) | F.lit(golden_sha).startswith(F.col("k")), F.lit(False)))
    last = ledger.agg(F.max_by("to_sha", "ordinal").alias("k")).join(ladder.agg(F.max_by("sha", "rank").alias("k")), "k", "left_anti")
    frames = {
        "candidate is a full commit": one.filter(~F.lit(sha).rlike("^[0-9a-f]{40}$")),
        "candidate is not blessed": ledger.filter(names(sha)),
        "golden is a release": ledger.filter(names(golden_sha)).groupBy().agg(F.count("*").alias("n")).filter("n <> 1"),
        "golden is the newest release": newest,
        "ladder and ledger agree": sets.bijection_problems(a, b, "k").select("k").union(last),
        "golden is complete": gates.missing_cells(golden_run_cells, golden_cells),
    }
    out = None
    for name, f in frames.items():
        row = f.groupBy().agg(F.count("*").alias("failures")).select(F.lit(name).alias("check"), "failures", (F.col("failures") == 0).alias("ok"))
        out = row if out is None else out.union(row)
    return out


def compat_problems(samples: DataFrame, fields: list[str], suffix: str = "-compat") -> DataFrame:
    """Compat samples that do not agree with their base sample: a self-join on the derived name."""
    base = samples.select(F.col("sample").alias("base"), *(F.col(f).alias(f"_{f}") for f in fields))
    own = samples.filter(F.col("sample").contains(suffix)).withColumn("base", F.regexp_replace("sample", f"{suffix}.*$", ""))
    wrong = F.array_compact(F.array(F.when(F.col("_found").isNull(), "no base sample"), *(F.when(F.col("_found") & ~F.col(f).eqNullSafe(F.col(f"_{f}")), f) for f in fields)))
    return own.join(base.withColumn("_found", F.lit(True)), "base", "left").select("sample", F.explode(wrong).alias("problem")).orderBy("sample", "problem")
