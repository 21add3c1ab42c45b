"""Hand-computed scenarios of the reports and gates."""

import math

import pytest

from benchlake.operators import latest, sets
from benchlake.plans import arena, gates, perf, release

TRIALS = "id long, run_sha string, sample string, arch string, rep long, wall_seconds double, process_seconds double, image_variant string"


def trials(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], TRIALS)


def cell(sha, walls, variant=None, sample="s"):
    return [(sha, sample, "a", k + 1, float(w), None, variant) for k, w in enumerate(walls)]


@pytest.mark.parametrize(
    ("new", "old", "verdict"),
    [([100.0, 101], [100.0, 101], "flat"), ([120.0, 121], [100.0, 101], "REGRESSION"), ([120.0, 100], [100.0, 101], "noisy"), ([80.0, 81], [100.0, 101], "improvement"), ([120.0], [100.0, 101], "noisy"), ([120.0, 121], [], "new_only")],
)
def test_perf_verdict(spark, new, old, verdict):
    t = trials(spark, cell("n", new) + cell("o", old))
    (r,) = perf.perf_cells(perf.run_trials(t, "n"), perf.run_trials(t, "o")).collect()
    assert r.verdict == verdict


def test_variant_change_comes_first(spark):
    t = trials(spark, cell("n", [200.0, 201], "native") + cell("o", [100.0, 101]))
    assert perf.perf_cells(perf.run_trials(t, "n"), perf.run_trials(t, "o")).first().verdict == "variant_changed"


def test_lone_replicate_has_two_spreads(spark):
    t = trials(spark, cell("n", [5.0]))
    assert perf.perf_stats(t).first().cv_pct == 0.0
    assert perf.trial_cells(t.selectExpr("*", "1D as max_rss_mb", "1D as cpu_time")).first().cv_pct is None


ARENA = "run_sha string, arch string, label string, mode string, rep long, wall_seconds double, process_seconds double, block string, position long, index_read_seconds double, io_in_mb double, thp_fault_fallback long"


def arms(spark, rounds, flip=True, block="b", cold=(), cold_io=()):
    rows = []
    for k, (p, t) in rounds.items():
        lead = (k % 2 == 1) if flip else True
        for label, wall, pos in (("v1", p, 1 if lead else 2), ("v2", t, 2 if lead else 1)):
            rows.append(("s", "a", label, "default", k, wall, wall, block if block != "own" else label, pos, 9.0 if k in cold else 1.0, 5000.0 if k in cold_io else 1.0, 0))
    return spark.createDataFrame(rows, ARENA)


def pair(spark, rows):
    p = spark.createDataFrame([("p", "a", "v1", "default", "v2", "default")], "pair string, arch string, prior_label string, prior_mode string, this_label string, this_mode string")
    return arena.paired_ratios(arena.arena_rows(rows, "s"), p).first()


def test_paired_ratio_is_not_a_ratio_of_medians(spark):
    r = pair(spark, arms(spark, {1: (22.0, 20.0), 2: (33.0, 30.0), 3: (24.2, 22.0), 4: (11.0, 10.0)}))
    assert (round(r.ratio, 9), r.rounds, r.note) == (1.1, 4, "paired")


def test_lead_balance_cancels_the_second_runner_penalty(spark):
    rounds = {k: (110.0, 100 * 1.02) if k % 2 else (110.0 * 1.02, 100.0) for k in range(1, 6)}
    r = pair(spark, arms(spark, rounds))
    assert math.isclose(r.ratio, 1.1, rel_tol=1e-9) and r.note == "paired"


FOUR = {k: (11.0, 10.0) for k in range(1, 5)}


def test_pair_notes(spark):
    assert pair(spark, arms(spark, {1: (11.0, 10.0), 2: (11.0, 10.0)})).note == "context"
    assert pair(spark, arms(spark, FOUR, flip=False)).note == "inconclusive"
    assert pair(spark, arms(spark, FOUR, block="own")).note == "unpaired"
    assert pair(spark, arms(spark, FOUR | {4: (20.0, 10.0)})).note == "inconclusive"
    r = pair(spark, arms(spark, FOUR, cold_io=(1, 2)))
    assert (r.note, r.rounds) == ("inconclusive", 2)
    r = pair(spark, arms(spark, {k: (None, 10.0) for k in range(1, 5)}))
    assert (r.ratio, r.note) == (None, "inconclusive")


def test_predecessor_skips_releases_that_did_not_measure(spark):
    walls = {"v021": 100.0, "v022": 90.0, "v030": None, "v040": 80.0, "candidate": 70.0}
    rows = spark.createDataFrame([("s", "a", k, "default", 1, w, w, None, 1, 1.0, 1.0, 0) for k, w in walls.items()], ARENA)
    ladder = spark.createDataFrame([("v021", 0), ("v022", 1), ("v030", 2), ("v040", 3)], "label string, rank long")
    got = {r.label: r.vs_prior_release for r in arena.arena_table(arena.arena_rows(rows, "s"), ladder).collect()}
    assert got["v021"] is None and got["v030"] is None
    assert [round(got[k], 9) for k in ("v022", "v040", "candidate")] == [round(x, 9) for x in (100 / 90, 90 / 80, 80 / 70)]


SCALING = "run_sha string, sample string, arch string, threads long, rep long, wall_seconds double, process_seconds double"


def test_scaling(spark):
    ladder = lambda sha, ts: [(sha, "s", "a", n, 1, t, None) for n, t in ts.items()]
    df = spark.createDataFrame(ladder("n", {1: 1000.0, 2: 500.0, 4: 300.0}) + ladder("o", {1: 1000.0, 2: 500.0, 4: 250.0}) + ladder("x", {1: 2000.0, 2: 500.0, 4: 250.0}), SCALING)
    assert [(r.threads, r.efficiency_pct) for r in gates.efficiencies(df, "o").orderBy("threads").collect()] == [(2, 100.0), (4, 100.0)]
    assert [(r.threads, r.basis, r.verdict) for r in gates.scaling_gate(df, "n", "o").collect()] == [(2, "efficiency", "ok"), (4, "efficiency", "REGRESSION")]
    assert [(r.threads, r.basis, r.verdict) for r in gates.scaling_gate(df, "n", "x").collect()] == [(2, "absolute", "ok"), (4, "absolute", "REGRESSION")]
    assert gates.scaling_gate(df, "n", "none").count() == 0


def grade(bins, total):
    import json

    return json.dumps({"all": total, "bins": bins})


B = {"0-19": {"total": 10, "correct": 5, "mismapped": 5}, "20+": {"total": 90, "correct": 89, "mismapped": 1}}
ALL = {"total": 100, "correct": 94, "mismapped": 6}
UNREADABLE = [grade({}, {"total": 0}), grade(B, ALL | {"total": 101}), grade(B | {"0-19": {"total": 10, "correct": -1, "mismapped": 5}}, ALL), grade({"0-30": B["0-19"], "20+": B["20+"]}, ALL), grade({"19-0": B["0-19"], "20+": B["20+"]}, ALL), grade(B | {"20+": {"total": 90.5, "correct": 89, "mismapped": 1}}, ALL), grade(B | {"20+": {"total": True, "correct": 89, "mismapped": 1}}, ALL), "not json"]


def accuracy(spark, rows):
    return spark.createDataFrame(rows, "run_sha string, sample string, arch string, rep long, tool string, placement_json string")


def test_placement_metrics_never_raise(spark):
    rows = accuracy(spark, [("n", "s", "a", k, "candidate", j) for k, j in enumerate([grade(B, ALL), *UNREADABLE])])
    got = {r.rep: (r.mismapped_ppm, r.correct_pct, r.read_total) for r in gates.placement_metrics(rows).collect()}
    assert got[0] == (10000.0, 89.0, 100) and all(got[k] == (None, None, 0) for k in range(1, len(UNREADABLE) + 1))


def test_grade_gate_fails_closed(spark):
    good, bad = grade(B, ALL), UNREADABLE[0]
    worse = grade(B | {"20+": {"total": 90, "correct": 88, "mismapped": 2}}, {"total": 100, "correct": 93, "mismapped": 7})
    verdict = lambda n, o: gates.grade_gate(*(gates.placement_metrics(accuracy(spark, [(s, "s", "a", k, "candidate", j) for k, j in enumerate(js)])) for s, js in (("n", n), ("o", o)))).first().verdict
    assert verdict([good], [good]) == "ok" and verdict([worse], [good]) == "REGRESSION" and verdict([good], []) == "new_only"
    assert verdict([good, bad], [good]) == "candidate_unreadable" and verdict([good], [bad]) == "prior_unreadable" and verdict([bad], [bad]) == "both_unreadable"


def test_missing_grades(spark):
    t = trials(spark, cell("n", [1.0, 1, 1]))
    rows = gates.graded(accuracy(spark, [("n", "s", "a", 1, "candidate", grade(B, ALL)), ("n", "s", "a", 9, "candidate", grade(B, ALL))]), t)
    assert [r.rep for r in rows.collect()] == [1]
    got = [tuple(r) for r in gates.grade_missing(t, rows, t.filter("false"), rows.filter("false")).collect()]
    assert got == [("s", "a", "candidate", "1 of 3 reps graded (missing 2, 3)")]


def test_budget(spark):
    cells = spark.createDataFrame([("x", "a", 99.0, None, 1), ("y", "a", 50.0, 1.0, 0), ("z", "a", 50.0, 1.0, 1)], "sample string, arch string, baseline_concordance double, placement_relocated_pct double, placement_missing long")
    reg = spark.createDataFrame([(["x"], "concordance", 0.5, True), ([], "concordance", 0.5, True), (["y", "z"], "confident_relocation", 2.0, False)], "samples array<string>, metric string, expected_drift_pct double, gating boolean")
    got = {r["sample"]: (r.metric, r.observed_drift_pct, r.allowed_drift_pct, r.verdict, r.gating) for r in gates.budget_gate(cells, reg).collect()}
    assert got == {"x": ("concordance", 1.0, 1.0, "ok", "gate"), "y": ("confident_relocation", 1.0, 2.0, "ok", "report-only"), "z": ("confident_relocation", None, 2.0, "missing_placement", "report-only")}


def test_regression_is_an_or_and_never_empty(spark):
    one, none = spark.range(1), spark.range(0)
    assert gates.regression({"a": none, "b": none}).first().ok and not gates.regression({"a": none, "b": one}).first().ok
    with pytest.raises(ValueError):
        gates.regression({})


def test_latest(spark):
    rows = spark.createDataFrame([("k", "a", "x", 1), ("k", None, "y", 2)], "k string, v string, s string, seq long")
    assert latest.latest_wins(rows, ("k",), "seq").first() == ("k", None, "y")
    assert latest.merge_non_null(rows, ("k",), "seq", ("s",)).first() == ("k", "a", "y")


def test_prefixes(spark):
    names, prefixes = spark.createDataFrame([("abcdef",), ("abd",)], "n string"), spark.createDataFrame([("abc",), ("abdxyz",), ("zz",)], "p string")
    assert {tuple(r) for r in sets.resolve_prefix(names, prefixes, "n", "p").select("p", "n").collect()} == {("abc", "abcdef"), ("abdxyz", "abd"), ("zz", None)}
    with pytest.raises(Exception, match="ambiguous"):
        sets.resolve_prefix(names, spark.createDataFrame([("ab",)], "p string"), "n", "p").collect()


def test_compat_samples_agree_with_their_base(spark):
    s = spark.createDataFrame([("wgs", "ref1", "pe"), ("wgs-compat", "ref2", "pe"), ("wes-compat", "r", "pe")], "sample string, reference string, layout string")
    assert [tuple(r) for r in release.compat_problems(s, ["reference", "layout"]).collect()] == [("wes-compat", "no base sample"), ("wgs-compat", "reference")]


def test_release_rows_are_not_mixed(spark):
    t = trials(spark, cell("n", [1.0, 2.0]))
    c = spark.createDataFrame([(0, "vs-baseline", 99.0, '{"supp_query_total": 5}'), (1, "vs-baseline", 98.0, None)], "trial_id long, kind string, concordance_pct double, supp_json string")
    assert tuple(release.release_concordance(t, c, [("v1", "n")]).first()) == ("v1", "s", 98.0, 0, 0, 0)
