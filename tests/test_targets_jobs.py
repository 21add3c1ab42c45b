"""Targets and what they need, the workflow's own run order, the live view of jobs, publication as a whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from benchlake.operators import sets
from benchlake.plans import schedule, targets
from benchlake.sinks import render
from benchlake.streaming import jobs


def declared(spark):
    samples = spark.createDataFrame(
        [("g", "g", False, False, False, True), ("g-fast", "g", False, False, False, False), ("m", "m", False, True, False, True), ("m-fast", "m", False, True, False, False), ("t", "t", True, False, False, False), ("c-compat", "c", False, False, True, False)],
        "sample string, base string, truth boolean, meth boolean, compat boolean, golden boolean",
    )
    archs = spark.createDataFrame([("x1", "x86", "x1"), ("x2", "x86", "x2"), ("a1", "arm", "x1")], "arch string, platform string, baseline_arch string")
    return samples, archs


def test_expected_cells_by_target(spark):
    samples, archs = declared(spark)
    rows = targets.expected(samples, archs, reps=2, baseline_reps=1, meth_arch="x2").collect()
    of = lambda target, product: {(r.source, r["sample"], r.arch, r.rep) for r in rows if (r.target, r["product"]) == (target, product)}
    assert of("all", "compare/vs-baseline.json") == {("runs", "g", a, k) for a in ("x1", "x2") for k in (1, 2)} | {("runs", "m", "x2", k) for k in (1, 2)}
    assert of("all", "compare/vs-x86.json") == {("runs", "g", "a1", 1), ("runs", "g", "a1", 2)}  # no methylation on ARM
    assert of("all", "aligned.bam") == {("baseline", "g", "x1", 1), ("baseline", "g", "x2", 1), ("baseline", "m", "x2", 1)}
    assert {s for _, s, *_ in of("fast", "compare/vs-default.json")} == {"g-fast", "m-fast"} and {s for _, s, *_ in of("accuracy", "eval")} == {"t"}
    assert not any(r["sample"] == "c-compat" for r in rows)
    gone = targets.missing(targets.expected(samples, archs, 2, 1, "x2"), spark.createDataFrame([r for r in rows if r.arch != "a1"], "target string, source string, product string, sample string, arch string, rep long"))
    assert {r.arch for r in gone.collect()} == {"a1"}


def slow_closure(wanted, bases, references):
    known, todo = set(), list(wanted)
    while todo:
        cell = todo.pop()
        if cell in known:
            continue
        known.add(cell)
        source, product, sample, arch, rep = cell
        for s, p, ns, np_, of_sample, of_arch, of_rep in targets.RULES:
            if (s, p) == (source, product):
                todo.append((ns, np_, bases[sample] if of_sample == "base" else sample, references[arch] if of_arch == "reference" else arch, 1 if of_rep == "first" else rep))
    return known


def test_closure_equals_a_walk(spark):
    samples, archs = declared(spark)
    wanted = targets.expected(samples, archs, 2, 2, "x2")
    got = {tuple(r) for r in targets.closure(wanted, samples, archs).collect()}
    cells = [tuple(r) for r in wanted.select(*targets.KEY).collect()]
    assert got == slow_closure(cells, {r["sample"]: r.base for r in samples.collect()}, {r.arch: r.baseline_arch for r in archs.collect()})
    assert ("runs", "aligned.bam", "g", "x1", 2) in got and ("golden", "aligned.bam", "g", "a1", 1) in got
    # rules that lead back to themselves end
    circle = (("runs", "p", "runs", "q", "same", "same", "same"), ("runs", "q", "runs", "p", "same", "same", "same"))
    one = spark.createDataFrame([("runs", "p", "g", "x1", 1)], "source string, product string, sample string, arch string, rep long")
    assert targets.closure(one, samples, archs, circle).count() == 2 and targets.closure(one.filter("false"), samples, archs).count() == 0


def slow_order(arms, pairs, candidate, seed, headline, context):
    """The generator's draws one after the other, as the workflow makes them."""
    draw = random.Random(seed)
    blocks = sorted({b for _, b in arms})
    draw.shuffle(blocks)
    out = []
    for block in blocks:
        own = [x for x, b in arms if b == block]
        couples = [p for p in pairs if p[0] in own and p[1] in own]
        units = sorted(couples + [(x,) for x in own if not any(x in c for c in couples)])
        lead = draw.random() < 0.5
        for k in range((headline if candidate in own else context) + 1):
            turn = list(units)
            draw.shuffle(turn)
            labels = [x for u in turn for x in (u[::-1] if len(u) == 2 and (k % 2 == 1) != lead else u)]
            out += [(block, k, n + 1, x) for n, x in enumerate(labels)]
    return out


@pytest.mark.parametrize("seed", ["", "a", "deadbeef", "0dd1e5", "ü", "seed 6", "7", "x" * 40, "abc", "z"])
def test_run_order_is_the_generators(spark, seed):
    arms = [(x, "b1") for x in ("new", "old", "c", "d", "é")] + [("e", "b2"), ("f", "b2"), ("g", "b3")]
    pairs = [("old", "new"), ("c", "e"), ("f", "gone")]
    got = schedule.run_order(spark.createDataFrame(arms, "label string, block string"), spark.createDataFrame(pairs, "first string, second string"), "new", seed, 4, 2).collect()
    assert [(r.block, r.round, r.position, r.label) for r in got] == slow_order(arms, pairs, "new", seed, 4, 2)


def test_run_order_refuses(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    arms, none = frame([("a", "b")], "label string, block string"), frame([], "first string, second string")
    for bad in ((arms.union(arms), none, 1, 1), (arms, frame([("a", "x"), ("y", "a")], "first string, second string"), 1, 1), (arms, none, 0, 1)):
        with pytest.raises(ValueError, match="label|round"):
            schedule.run_order(bad[0], bad[1], "a", "s", *bad[2:])


def test_live_jobs_equal_the_batch_view(spark, tmp_path):
    rng = random.Random(3)
    states = ["SUBMITTED", "RUNNING", "FAILED", "SUCCEEDED"]
    last, listings = {}, tmp_path / "polls"
    listings.mkdir()
    view, checkpoint = str(tmp_path / "view"), str(tmp_path / "checkpoint")
    for poll in range(1, 5):
        rows = []
        for name in "abcde":
            for created in range(1, rng.randint(1, 1 + poll) + 1):
                status = last.get((name, created), (0, "SUBMITTED"))[1] if rng.random() < 0.4 else rng.choice(states)
                rows.append({"name": name, "created_at": created, "status": status, "polled_at": poll})
                last[name, created] = (poll, status)
        rows.append({"name": None, "created_at": 1, "status": "RUNNING", "polled_at": poll})
        text = "".join(json.dumps(r) + "\n" for r in rows)
        (listings / f"{poll}.json").write_text(text)
        if poll == 3:
            (listings / "again.json").write_text(text)  # a poll that comes twice
        assert jobs.watch(spark, str(listings), view, checkpoint).awaitTermination(120)  # started anew for each poll
        batch = spark.createDataFrame([(n, c, s) for (n, c), (_, s) in last.items()], "name string, created_at long, status string")
        want = {(r.name, r.created_at, r.status, r.display) for r in sets.retry_states(batch, ["name"], "status", "created_at").collect()}
        assert {(r.name, r.created_at, r.status, r.display) for r in jobs.current(spark, view).collect()} == want
    assert jobs.current(spark, view).filter(F.col("display") == "RETRIED").count() > 0


def test_publication_is_whole_and_writes_changes_only(tmp_path, monkeypatch):
    root = tmp_path / "releases"
    document = lambda v: {"version": v, "speed": [{"arch": "a", "wall_s": 1.5}]}
    first = render.release_set(root, document("v1"), root / "v1" / "data.json")
    assert {p.name for p in first} == {"data.json", "index.md"} and len(first) == 3
    second = render.release_set(root, document("v2"), root / "v2" / "data.json")
    assert {str(p.relative_to(root)) for p in second} == {"v2/data.json", "v2/index.md", "index.md"}  # the first one's page is as it was
    assert "v1" in (root / "index.md").read_text() and render.rerender(root) == []
    with pytest.raises(FileExistsError, match="frozen"):
        render.release_set(root, document("v2"), root / "v2" / "data.json")
    before = {p: p.read_bytes() for p in root.rglob("*") if p.is_file()}
    own, calls = type(root).replace, []

    def replace(self, target):
        calls.append(target)
        if len(calls) == 3:
            raise OSError("no space")
        return own(self, target)

    monkeypatch.setattr(type(root), "replace", replace)
    with pytest.raises(OSError, match="no space"):
        render.release_set(root, document("v3"), root / "v3" / "data.json")
    monkeypatch.undo()
    assert {p: p.read_bytes() for p in root.rglob("*") if p.is_file()} == before
    (root / "v1" / "index.md").write_text("edited by hand")
    assert [str(p.relative_to(root)) for p in render.rerender(root)] == ["v1/index.md"]
