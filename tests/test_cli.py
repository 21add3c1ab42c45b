"""Tree to reports through the command line."""

import json

import pytest

from benchlake.cli import main
from benchlake.plans.collect import AuditError, collect
from benchlake.sinks.store import Store

CELL = "runs/{}/smoke/c7g/rep-{}"


def put(root, path, text):
    p = root / path
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for sha, walls in (("new", (10.0, 10.1)), ("old", (20.0, 20.1)), ("slow", (40.0, 40.1))):
        for rep, wall in enumerate(walls, 1):
            cell = CELL.format(sha, rep)
            put(root, f"{cell}/benchmarks/timing.tsv", f"s\th:m:s\tmax_rss\tio_in\tio_out\tmean_load\tcpu_time\n{wall}\t0\t100\t1\t1\t3\t40\n")
            put(root, f"{cell}/benchmarks/meta.json", json.dumps({"instance_id": f"i-{rep}", "measured_at": f"2025-01-02T03:0{rep}:00Z"}))
            for kind in ("vs-baseline", "vs-golden"):
                put(root, f"{cell}/compare/{kind}.json", json.dumps({"total_reads": 10, "concordant": 10, "concordance_pct": 100.0, "by_class": {"pos_diff": {"count": 2, "pct": 20.0}}}))
    out = str(root / "store")
    assert main(["--store", out, "collect", str(root)], spark) == 0
    return out, root


def test_reports(spark, store, capsys):
    out, root = store
    run = lambda *a: (main(["--store", out, *a], spark), capsys.readouterr().out)
    code, text = run("speedup", "new", "old")
    assert code == 0 and "| smoke | c7g | 10.0000 |  | 20.0000 |  | 2.0000 |" in text
    assert "100.0000" in run("summary", "new")[1] and "pos_diff | 4" in run("compare", "new")[1]
    assert len(run("trend", "--last", "3")[1].splitlines()) == 5
    assert "| v1 | smoke |" in run("docs", "v1=new,v2=old")[1]
    assert run("regression", "new", "old")[0] == 0
    code, text = run("regression", "slow", "old")
    assert code == 1 and json.loads(text)["performance"] == 1
    ledger = root / "ledger.yaml"
    ledger.write_text("allowances:\n- {to_sha: old, pr: 1, date: d, summary: s, expected_drift_pct: 0}\n- {to_sha: new, pr: 2, date: d, summary: s, expected_drift_pct: 0}\n")
    assert main(["--store", out, "results", "new", "v2", str(root / "data.json"), "--ledger", str(ledger)], spark) == 0
    doc = json.loads((root / "data.json").read_text())
    assert (doc["previous"], doc["max_reps"], doc["speed"][0]["wall_s"]) == ("old", 2, 10.05)


def test_mixed_variants_stop_an_ingest(spark, store, tmp_path):
    for rep, variant in ((1, "native"), (2, "portable")):
        put(tmp_path, f"{CELL.format('x', rep)}/benchmarks/timing.tsv", "s\tcpu_time\n1\t1\n")
        put(tmp_path, f"{CELL.format('x', rep)}/benchmarks/meta.json", json.dumps({"image_variant": variant, "measured_at": "2025-01-02T03:00:00Z"}))
    with pytest.raises(AuditError, match="mix"):
        main(["--store", str(tmp_path / "s"), "collect", str(tmp_path)], spark)


def test_compare_records_exit_code(spark, tmp_path, capsys):
    put(tmp_path, "a.sam", "@SQ\tSN:c\tLN:9\nq\t65\tc\t1\t60\t5M\t*\t0\t0\t*\t*\tNM:i:1\n")
    args = ["compare-records", str(tmp_path / "a.sam"), str(tmp_path / "a.sam")]
    assert main(args, spark) == 0 and main([*args, "--expect-tags", "XX"], spark) == 3
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["total_reads"] == 1


def test_audits_are_of_one_run(spark, tmp_path):
    """Two runs a month apart: each keeps its own trials, and a late replicate of one run only goes there."""
    stamps = {("a", 1): "2025-01-02T03:00:00Z", ("a", 2): "2025-01-02T04:00:00Z", ("a", 3): "2025-01-05T04:00:00Z", ("b", 1): "2025-02-02T03:00:00Z", ("b", 2): "2025-02-02T03:30:00Z", ("b", 3): "2025-02-02T03:40:00Z"}
    for (sha, rep), at in stamps.items():
        cell = CELL.format(sha, rep)
        put(tmp_path, f"{cell}/benchmarks/timing.tsv", "s\tcpu_time\n1\t1\n")
        put(tmp_path, f"{cell}/benchmarks/meta.json", json.dumps({"image_variant": "native" if sha == "a" else "portable", "measured_at": at}))
    put(tmp_path, "baseline/old/smoke/c7g/rep-1/benchmarks/timing.tsv", "s\tcpu_time\n9\t1\n")
    counts = collect(spark, str(tmp_path), Store(spark, str(tmp_path / "s")))
    assert counts["trials"] == 6 and counts["runs"] == 3
    got = {(r.run_sha, r.rep) for r in Store(spark, str(tmp_path / "s")).read("trials").collect()}
    assert got == {k for k in stamps if k != ("a", 3)} | {("baseline-old", 1)}
