"""Dimensions, listings, walls, image files, jobs, migrations, the verdict's fail-closed cases."""

import json

import pytest
from pyspark.sql import functions as F

from benchlake.cli import main
from benchlake.functions import stats as S
from benchlake.operators import sets
from benchlake.plans import gates, release, schedule, verdict
from benchlake.schemas import ACCURACY, COMPARISONS, SCALING, TRIALS
from benchlake.sinks.render import rerender, rewrite, truncated
from benchlake.sinks.store import Store
from benchlake.sources import artifacts, dimensions


def test_samples_archs_defaults(spark):
    s = dimensions.samples(spark, "samples:\n  a: {reference: r, source: s, layout: l, truth: true, meth: true}\n  a-compat: {reference: r, source: s, layout: l, flags: [-x]}\n").collect()
    assert [(r["sample"], r.truth, r.meth, r.compat, r.base, r["flags"]) for r in s] == [("a", True, True, False, "a", []), ("a-compat", False, False, True, "a", ["-x"])]
    for bad in ("samples:\n  a: {reference: r, source: s}\n", "samples:\n  a: {reference: r, source: s, layout: l, surprise: 1}\n", "samples:\n  a: {reference: r, source: s, layout: l, truth: 1}\n"):
        with pytest.raises(ValueError, match="samples"):
            dimensions.samples(spark, bad)
    assert [(r.arch, r.baseline_arch) for r in dimensions.archs(spark, "archs:\n  x: {instance_type: i, simd: s, platform: p}\n  y: {instance_type: i, simd: s, platform: p, baseline_arch: x}\n").collect()] == [("x", "x"), ("y", "x")]
    with pytest.raises(ValueError, match="baseline_arch"):
        dimensions.archs(spark, "archs:\n  x: {instance_type: i, simd: s, platform: p, baseline_arch: z}\n")
    assert dimensions.ladder(" 16:3, ,4:2") == [(4, 2), (16, 3)] and dimensions.defaults("thread_scaling: {ladder: '1:1,2:3', max_efficiency_drop_pp: 3}")["ladder"] == [(1, 1), (2, 3)]
    for bad in ("", "16:", "x:1", "0:1", "2:0", "2:1,2:3", "1.5:2", "-1:2"):
        with pytest.raises(ValueError, match="ladder|threads|rung"):
            dimensions.ladder(bad)
    with pytest.raises(ValueError, match="one-thread"):
        dimensions.ladder("2:1", whole=True)
    for bad in ("true", ".nan", ".inf", "-1", "x"):
        with pytest.raises(ValueError, match="finite"):
            dimensions.defaults(f"thread_scaling: {{ladder: '1:1', max_efficiency_drop_pp: {bad}}}")


def test_option_clashes():
    clash = lambda *t: dimensions.option_clashes(list(t), "to", ("fast", "bam"), "kRo")
    assert clash("-k", "19", "-5", "--other", "x", "-", "-Rt") == [] and clash("-5t4") == ["-5t4"] and clash("-kt") == []
    assert clash("-k", "-t", "--fa", "--bam=1") == ["--fa", "--bam=1"] and clash("-o", "-t") == ["-o"]


def test_lists_walls_and_pages(spark, tmp_path):
    df = spark.range(7).select(F.col("id").alias("k"))
    text = truncated(df, 5)
    assert len(text.splitlines()) == 8 and "2 more (7 in all)" in text and "more" not in truncated(df, 7)
    page = tmp_path / "README.md"
    page.write_text("a\n<!-- walls -->\nold\n<!-- /walls -->\nb\n")
    checks = spark.createDataFrame([("x", True), ("y", False)], "check string, ok boolean")
    with pytest.raises(ValueError, match="y"):
        rewrite(page, {"walls": "new"}, checks)
    assert "old" in page.read_text()
    rewrite(page, {"walls": "new"}, checks.filter("ok"))
    assert page.read_text() == "a\n<!-- walls -->\nnew\n<!-- /walls -->\nb\n"
    (tmp_path / "v1").mkdir()
    (tmp_path / "v1/data.json").write_text(json.dumps({"version": "v1", "speed": [{"arch": "a", "wall_s": 1.5}], "agreement": {"vs": [{"n": 1}]}}))
    assert [p.read_text() for p in rerender(tmp_path)] == ["# v1\n\n## agreement: vs\n\n| n |\n| --- |\n| 1 |\n\n## speed\n\n| arch | wall_s |\n| --- | --- |\n| a | 1.5000 |\n"]


def test_lost_and_first_rows(spark):
    old, new = (spark.createDataFrame(r, "k string, fast double") for r in ([("a", 1.0), ("b", 2.0), ("c", None)], [("a", None), ("c", None)]))
    assert [tuple(r) for r in sets.lost(old, new, "k", ["fast"]).collect()] == [("a", "no fast"), ("b", "missing")]
    ids = spark.createDataFrame([(3, "x"), (1, "y"), (2, "x")], "at long, id string")
    assert [(r.id, r["at"]) for r in sets.first_of_each(ids, ["id"], "at").collect()] == [("y", 1), ("x", 2)]
    lines = spark.createDataFrame(list(enumerate(["@a", "AC", "+", "II", "b", "A", "+", "I", "@c", "A", "-", "I", "@d", "AC", "+", "I", "@e"])), "idx long, value string")
    assert {r.rec: r.problem for r in sets.fastq_problems(lines).collect()} == {1: "no header", 2: "no separator", 3: "lengths differ", 4: "cut off"}
    jobs = spark.createDataFrame([("j", "FAILED", 1), ("j", "FAILED", 2), (None, "FAILED", 1)], "name string, status string, at long")
    assert sorted((r.name or "", r["at"], r.display) for r in sets.retry_states(jobs, ["name"], "status", "at").collect()) == [("", 1, "FAILED"), ("j", 1, "RETRIED"), ("j", 2, "FAILED")]
    assert schedule.recent_jobs(jobs.withColumnRenamed("at", "created_at"), 2).count() == 1


def test_release_blocks(spark, tmp_path):
    block = "RUN git clone --quiet http://x /build/arena-releases/{0} && git checkout --quiet {1} \\\n    && install -Dm755 tool /out/bin/tool.{2}\n"
    f = tmp_path / "Dockerfile"
    f.write_text("FROM x\n# " + block.format("v0", "abcdef1", "v0") + block.format("v1", "abcdef2", "v1") + "RUN make\n" + block.format("v2", "abcdef3", "v2"))
    assert [tuple(r) for r in artifacts.release_blocks(spark, str(f)).collect()] == [("v1", "abcdef2"), ("v2", "abcdef3")]
    f.write_text(block.format("v1", "abcdef2", "v2"))
    with pytest.raises(Exception, match="malformed"):
        artifacts.release_blocks(spark, str(f)).collect()


def test_serialization_tables(spark, tmp_path):
    root = tmp_path / "x" / "timing" / "e"
    root.mkdir(parents=True)
    head = "label\ttool\tmode\tindex\tendpoint\troute\tblock\tround\tposition\tstatus\texit_code\tprimary_count\twall_s\tcpu_s\tmax_rss_mb\tprocess_s\tindex_read_s"
    row = lambda route, k, status, wall: f"a\tt\tm\ti\te\t{route}\tb\t{k}\t1\t{status}\t0\tNA\t{wall}\t1\t1\tNA\t1"
    (root / "timings.tsv").write_text("\n".join([head, row("sam", 0, "ok", 99), row("native", 1, "ok", 10), row("sam", 1, "unchecked", 12), row("sam", 2, "failed", "NA"), row("native", 2, "ok", 10), "short\trow"]) + "\n")
    rows = artifacts.serialization(spark, str(tmp_path))
    assert rows.count() == 5
    (pair,) = schedule.serialization_pairs(rows).collect()
    assert (pair.rounds, pair.sam_over_native) == (1, 1.2)
    (tmp_path / "fidelity" / "m").mkdir(parents=True)
    (tmp_path / "fidelity" / "m" / "result.tsv").write_text("compression\texpected_primary\tsam_primary\tnative_primary\texit\tline\n0\t5\t5\t5\t0\tx\n1\t5\t5\t4\t0\tx\n")
    assert [(r.mode, r.compression, r.agrees) for r in artifacts.fidelity(spark, str(tmp_path)).orderBy("compression").collect()] == [("m", "0", True), ("m", "1", False)]


def test_arena_rows_that_are_dropped_are_told(spark, tmp_path):
    p = tmp_path / "abc" / "c8g" / "arena.tsv"
    p.parent.mkdir(parents=True)
    p.write_text("label\tmode\trep\twall_s\tcpu_s\tmax_rss_mb\tprocess_s\nv1\tdefault\t1\t9\t9\t9\t8\nv1\tdefault\n")
    assert [r.line for r in artifacts.arena_dropped(spark, str(tmp_path)).collect()] == ["v1\tdefault"] and artifacts.arena(spark, str(tmp_path)).count() == 1
    p.write_text("label\tmode\trep\nv1\tdefault\t1\n")
    with pytest.raises(Exception, match="missing column"):
        artifacts.arena(spark, str(tmp_path)).collect()


def test_paths_are_read_as_they_are_named(spark, tmp_path):
    p = tmp_path / "run 1+2" / "s%a" / "c7g" / "scaling.tsv"
    p.parent.mkdir(parents=True)
    p.write_text("threads\trep\twall_s\tcpu_s\tmax_rss_mb\tprocess_s\n1\t1\t10\t10\t5\t9\n")
    assert [(r.run_sha, r["sample"]) for r in artifacts.scaling(spark, str(tmp_path)).collect()] == [("run 1+2", "s%a")]


def test_store_query_and_migration(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.upsert("trials", spark.createDataFrame([(1, "r", "s", "a", 1)], "id long, run_sha string, sample string, arch string, rep long"))
    assert store.sql("SELECT count(*) AS n FROM {trials} WHERE run_sha = :sha", sha="r").first().n == 1 and store.migrate() == []
    old = tmp_path / "old"
    spark.createDataFrame([("r", "s", "a", "before", 3)], "run_sha string, sample string, arch string, phase string, threads long").write.partitionBy("run_sha").parquet(str(old / "host_probes"))
    (old / "_manifest").mkdir()
    (old / "_manifest" / "part.json").write_text('{"schema_version": 9}\n')
    was = Store(spark, str(old))
    assert was.version() == 9 and was.migrate() == ["host_probes"] and was.version() == 14
    assert [(r.rep, r.threads, r.instance_id) for r in was.read("host_probes").select("rep", "threads", "instance_id").collect()] == [(0, 3, None)]


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 7, list(map(float, range(10))), [1.0, None, 9.0, 4.0]])
def test_exact_medians(spark, values):
    import statistics

    rows = [("a", v) for v in values] + [(None, v) for v in values] + [("b", None)]
    got = {r.k: r.m for r in S.exact_medians(spark.createDataFrame(rows, "k string, v double"), ("k",), "v", "m").collect()}
    want = statistics.median(v for v in values if v is not None)
    assert got == {"a": want, None: want}


def test_exact_medians_of_many_rows(spark):
    import statistics

    values = [(k * 7919 % 10007) ** 2 % 5000 / 7 for k in range(20_011)]
    df = spark.createDataFrame([(k % 2, v) for k, v in enumerate(values)], "k long, v double").repartition(5)
    got = {r.k: r["median"] for r in S.exact_medians(df, ("k",), "v").collect()}
    assert got == {k: statistics.median(values[k::2]) for k in (0, 1)}


def test_verdict_fails_closed(spark):
    frame = lambda rows, names, schema: spark.createDataFrame(rows, names).select(*(F.col(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
    cols = ["id", "run_sha", "sample", "arch", "rep", "wall_seconds"]
    trials = frame([(1, "new", "s", "x", 1, 1.0), (2, "old", "s", "x", 1, 1.0), (3, "baseline-b", "s", "x", 1, 2.0), (4, "new", "t", "x", 1, 1.0), (5, "baseline-b", "t", "x", 1, 1.0)], cols, TRIALS)
    compared = frame([(1, "vs-baseline", 100.0), (1, "vs-golden", 100.0)], ["trial_id", "kind", "concordance_pct"], COMPARISONS)
    none = spark.createDataFrame([], ACCURACY)
    scaling, registry = spark.createDataFrame([], SCALING), dimensions.registry(spark, "")
    count = lambda **k: dict(gates.regression(verdict.failures(trials, compared, none, scaling, registry, "new", "old", **k)).first().failures)
    assert {k for k, v in count().items() if v} == {"1 missing"}  # t was not compared
    truth = dimensions.samples(spark, "samples:\n  t: {reference: r, source: s, layout: l, truth: true}\n")
    assert not any(count(samples=truth).values())
    golden = count(samples=truth, golden="old")
    assert {k for k, v in golden.items() if v} == {"1b none graded"}
    assert {k for k, v in count(samples=truth, golden="gone").items() if v} == {"1b none graded", "2 golden not ingested"}
    assert dict(gates.regression(verdict.failures(trials, compared, none, scaling, registry, "nobody", "old")).first().failures)["no trials"] == 1


def test_preflight_and_index(spark):
    full, old = "a" * 40, "b" * 40
    ledger = dimensions.ledger(spark, f"allowances:\n- {{to_sha: {old}, pr: 1, date: d, summary: s, expected_drift_pct: 0, aliases: [v1]}}\n")
    ladder = spark.createDataFrame([(old, 0)], "sha string, rank long")
    cells = spark.createDataFrame([("s", "x")], "sample string, arch string")
    ok = lambda *a: {r.check: r.ok for r in release.preflight(*a).collect()}
    assert all(ok(ladder, ledger, cells, cells, full, old).values())
    assert [k for k, v in ok(ladder, ledger, cells, cells.filter("false"), old, full).items() if not v] == ["candidate is not blessed", "golden is a release", "golden is the newest release", "golden is complete"]
    rows = spark.createDataFrame([("x", "v1", "default", "dense"), ("x", "v2", "default", None)], "arch string, label string, mode string, index string")
    want = spark.createDataFrame([("v1", "default", "dense"), ("v2", "default", "stock")], "label string, mode string, index string")
    assert [r.problem for r in release.index_problems(rows, want).collect()] == ["recorded nothing, expected stock"]


def test_more_commands(spark, tmp_path, capsys):
    (tmp_path / "a.sam").write_text("@SQ\tSN:c\tLN:9\nq\t65\tc\t1\t60\t5M\t*\t0\t0\t*\t*\tNM:i:1\n")
    args = ["compare-records", str(tmp_path / "a.sam"), str(tmp_path / "a.sam"), "--expect-tags", "XX", "--out", str(tmp_path / "r.json"), "--label", "mine"]
    assert main(args, spark) == 3 and json.loads((tmp_path / "r.json").read_text())["label"] == "mine"
    assert main([*args, "--no-tag-guard", "yes"], spark) == 0
    (tmp_path / "b.sam").write_text("@SQ\tSN:c\tLN:9\nz\t65\tc\t1\t60\t5M\t*\t0\t0\t*\t*\tNM:i:1\n")
    with pytest.raises(Exception, match="diverge"):
        main(["tag-census", str(tmp_path / "a.sam"), str(tmp_path / "b.sam")], spark)
    (tmp_path / "jobs.json").write_text("\n".join(json.dumps({"jobName": f"sort-by-{k}", "jobQueue": "q", "status": "FAILED", "createdAt": k}) for k in (1, 2)) + "\n")
    capsys.readouterr()
    assert main(["jobs", str(tmp_path / "jobs.json"), "--since", "2"], spark) == 0 and "| sort_by | FAILED | 1 |" in capsys.readouterr().out
