"""Command line: ``python -m benchlake.cli --store DIR <report> ...`` prints Markdown.

``regression`` exits with 1 if any gate fails, ``identity`` with 1 if headers or full records differ, ``compare-records`` with 3 if the tag policy is violated
(the report is printed first).
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.functions import labels
from benchlake.functions.records import CompareOptions
from benchlake.operators import concordance, sets
from benchlake.plans import arena, gates, perf, release, schedule, verdict
from benchlake.plans.collect import collect
from benchlake.session import session
from benchlake.sinks.render import md, publish, release_set, rerender, rewrite
from benchlake.sinks.store import Store
from benchlake.sources import alignments, artifacts, dimensions


def _ladder(spark: SparkSession, labels: str) -> DataFrame:
    return spark.createDataFrame([(x, k) for k, x in enumerate(labels.split(",")) if x], "label string, rank long")


def _records(spark: SparkSession, path: str, fields: str = "core") -> DataFrame:
    return alignments.bam(spark, path, fields=fields) if path.endswith(".bam") else alignments.sam(spark, path, fields)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="benchlake", description=__doc__)
    p.add_argument("--store", default="store")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *arguments: str, **optional: str) -> None:
        c = sub.add_parser(name)
        for a in arguments:
            c.add_argument(a)
        for a, default in optional.items():
            c.add_argument(f"--{a.replace('_', '-')}", default=default)

    add("collect", "root", ingest_late_cells="", ingest_mixed_variants="")
    for name in ("summary", "accuracy", "arena"):
        add(name, "sha", ladder="")
    add("report", "sha", baseline="")
    add("compare", "sha", kind="vs-baseline", registry="")
    add("regression", "sha", "prev", registry="", golden="", samples="")
    add("bless-release", "sha", "golden", ledger="", ladder="", strict="")
    add("bless-golden", "sha", reps="3")
    add("full-report", "sha", baseline="", ladder="")
    add("results-render", "root")
    add("readme-tables", "sha", "readme", ladder="", rounds="5", before="", out="")
    add("jobs", "listing", since="")
    add("trend", last="20")
    add("docs", "releases")
    add("speedup", "sha", "baseline", third="")
    add("release-speedup", "sha", "arch", baseline_label="baseline", ladder="")
    add("results", "sha", "version", "out", ledger="", ladder="", force="")
    add("identity", "query", "baseline")
    for name in ("compare-records", "tag-census"):
        add(name, "query", "baseline", ignore_tags="", expect_tags="", absent_ok_tags="", mapq_tolerance="0", confident_mapq="20", relocation_bp="10", out="", label="", no_tag_guard="")
    return p


def _width(a: argparse.Namespace) -> int | None:
    return alignments.WIDTH if a.query.endswith(".bam") and a.baseline.endswith(".bam") else None


def _options(a: argparse.Namespace) -> CompareOptions:
    tags = lambda s: frozenset(t for t in s.split(",") if t)
    return CompareOptions(tags(a.ignore_tags), tags(a.expect_tags), tags(a.absent_ok_tags), int(a.mapq_tolerance), int(a.confident_mapq), int(a.relocation_bp), tag_guard=not a.no_tag_guard)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or session()
    say = lambda df: print(md(df))
    if a.command in ("compare-records", "tag-census"):
        q, b, opts = _records(spark, a.query), _records(spark, a.baseline), _options(a)
        width = _width(a)
        if a.command == "tag-census":
            say(concordance.census(concordance.primary_pairs(concordance.lockstep(q, b, width)), opts))
            return 0
        report = json.loads(concordance.compare(q, b, opts, width=width).toJSON().first()) | ({"label": a.label} if a.label else {})
        text = json.dumps(report, sort_keys=True)
        if a.out:  # before the guard's exit
            Path(a.out).write_text(text + "\n")
        print(text)
        return 3 if report.get("violations") else 0
    if a.command == "identity":
        header = concordance.header_differences(alignments.header(spark, a.query), alignments.header(spark, a.baseline))
        row = concordance.record_identity(_records(spark, a.query, "full"), _records(spark, a.baseline, "full"), _width(a))
        known = row.first()
        say(header)
        say(row)
        return 0 if known.identical and header.isEmpty() else 1
    if a.command == "results-render":
        print("\n".join(map(str, rerender(Path(a.root)))))
        return 0
    if a.command == "jobs":
        listed = schedule.recent_jobs(artifacts.job_listing(spark, a.listing), int(a.since) if a.since else None)
        shown = sets.retry_states(listed, ["name"], "status", "created_at")
        say(schedule.job_counts(shown.select(labels.job_command(F.col("name")).alias("command"), F.col("display").alias("state"))).orderBy("command", "state"))
        return 0
    store = Store(spark, a.store)
    trials, comparisons = store.read("trials"), store.read("comparisons")
    if a.command == "collect":
        print(json.dumps(collect(spark, a.root, store, late=bool(a.ingest_late_cells), mixed=bool(a.ingest_mixed_variants)), sort_keys=True))
    elif a.command == "summary":
        say(perf.summary(trials, comparisons, a.sha))
    elif a.command == "report":
        say(perf.metric_table(trials, a.sha, a.baseline or None))
    elif a.command == "compare":
        rows = release.compared(trials, comparisons, a.sha, a.kind)
        for f in (rows.select("sample", "arch", "rep", "concordance_pct", "drift_pct", "total"), release.class_counts(rows), release.supplementary(rows)):
            say(f)
        if a.registry:
            say(release.drift_against_registry(rows, dimensions.registry(spark, Path(a.registry).read_text())))
    elif a.command == "regression":
        registry = dimensions.registry(spark, Path(a.registry).read_text() if a.registry else "")
        declared = dimensions.samples(spark, Path(a.samples).read_text()) if a.samples else None
        rows = verdict.failures(trials, comparisons, store.read("accuracy"), store.read("scaling"), registry, a.sha, a.prev, a.golden, declared)
        row = gates.regression(rows).first()
        print(json.dumps(dict(row.failures), indent=1))
        return 0 if row.ok else 1
    elif a.command == "bless-release":
        ledger = dimensions.ledger(spark, Path(a.ledger).read_text())
        rungs = spark.createDataFrame([(s, k) for k, s in enumerate(a.ladder.split(",")) if s], "sha string, rank long")
        cells = lambda kind: release.compared(trials, comparisons, a.golden, kind).select("sample", "arch")
        checks = release.preflight(rungs, ledger, perf.run_trials(trials, a.golden), perf.run_trials(trials, a.golden).join(cells("vs-golden").distinct(), ["sample", "arch"], "left_semi"), a.sha, a.golden)
        say(checks)
        return 1 if a.strict and checks.filter("not ok").count() else 0
    elif a.command == "bless-golden":
        cells = schedule.promotion(perf.run_trials(trials, a.sha), int(a.reps))
        say(cells.orderBy("sample", "arch"))
        return 1 if cells.filter("problem is not null").count() else 0
    elif a.command == "full-report":
        own = arena.arena_rows(store.read("arena"), a.sha)
        for f in (perf.summary(trials, comparisons, a.sha), perf.metric_table(trials, a.sha, a.baseline or None), release.accuracy_headline(store.read("accuracy"), a.sha), gates.efficiencies(store.read("scaling"), a.sha), arena.arena_table(own, _ladder(spark, a.ladder))):
            say(f)
    elif a.command == "readme-tables":
        walls = release.host_walls(arena.arena_rows(store.read("arena"), a.sha), int(a.rounds))
        bad = walls.filter("problem is not null").select(F.concat_ws(" ", "arch", "label", "mode", "problem").alias("check"))
        if a.before:
            old = release.host_walls(arena.arena_rows(store.read("arena"), a.before), int(a.rounds))
            keyed = lambda f: f.select(F.concat_ws("/", "arch", "label", "mode").alias("k"), "wall_s")
            bad = bad.union(sets.lost(keyed(old), keyed(walls), "k", ["wall_s"]).select(F.concat_ws(" ", "k", "problem")))
        table = md(walls.select("arch", "label", "mode", "wall_s", "n").orderBy("arch", "label", "mode"), "{:.2f}")
        rewrite(Path(a.readme), {"walls": table}, bad.withColumn("ok", F.lit(False)), Path(a.out) if a.out else None)
    elif a.command == "trend":
        say(perf.trend(trials, store.read("runs"), comparisons, int(a.last)))
    elif a.command == "docs":
        say(release.release_concordance(trials, comparisons, [tuple(x.split("=", 1)) for x in a.releases.split(",")]))
    elif a.command == "speedup":
        say(perf.speedup_table(trials, a.sha, a.baseline, a.third or None))
    elif a.command == "accuracy":
        say(release.accuracy_headline(store.read("accuracy"), a.sha))
        say(release.accuracy_classes(store.read("accuracy"), a.sha))
    elif a.command == "arena":
        say(arena.arena_table(arena.arena_rows(store.read("arena"), a.sha), _ladder(spark, a.ladder)))
        say(arena.writer_control(arena.arena_rows(store.read("arena"), a.sha, controls=True)))
    elif a.command == "release-speedup":
        say(arena.release_speedup(arena.arena_rows(store.read("arena"), a.sha), _ladder(spark, a.ladder), a.arch, a.baseline_label))
    elif a.command == "results":
        ledger = dimensions.ledger(spark, Path(a.ledger).read_text())
        document = release.snapshot(trials, comparisons, store.read("accuracy"), arena.arena_rows(store.read("arena"), a.sha), store.read("scaling"), _ladder(spark, a.ladder), ledger, a.sha, a.version)
        out = Path(a.out)
        if out.name == "data.json":  # one of a set of releases, whose pages are made anew
            print("\n".join(map(str, release_set(out.parent.parent, document, out, force=bool(a.force)))))
        else:
            publish(document, out, force=bool(a.force))
    return 0


if __name__ == "__main__":
    sys.exit(main())
