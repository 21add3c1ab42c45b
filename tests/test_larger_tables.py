"""Queries on tables with more keys, and on rows that lie differently, than the small tables have: against their SQL."""

import os

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_entry import plain

import __spark_entry__ as entry
from benchlake import session
from benchlake.operators import sets
from benchlake.plans import arena, perf, targets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def many_suppliers(tmp_path_factory):
    """The smallest tables with the numbers of their suppliers from 2,193 on: 2,198 and 2,200 are among them."""
    out = str(tmp_path_factory.mktemp("suppliers"))
    for f in os.listdir(SF):
        key = {"lineitem.parquet": "l_suppkey", "supplier.parquet": "s_suppkey"}.get(f)
        if key:
            duckdb.execute(f"COPY (SELECT * REPLACE ({key} + 2193 AS {key}) FROM '{SF}/{f}') TO '{out}/{f}' (FORMAT parquet)")
        elif f.endswith(".parquet"):
            os.symlink(f"{SF}/{f}", f"{out}/{f}")
    return out


@pytest.fixture(scope="module")
def null_keys(tmp_path_factory):
    """The smallest tables with trials of no arch and events of no type, user or properties."""
    out = str(tmp_path_factory.mktemp("nulls"))
    gone = lambda c, key, n: f"CASE WHEN {key} % {n} = 1 THEN NULL ELSE {c} END AS {c}"
    columns = {"lineitem.parquet": gone("l_linestatus", "l_orderkey", 9), "events.parquet": ", ".join(gone(c, "(event_id // 2)", n) for c, n in (("event_type", 9), ("user_id", 7), ("props", 31)))}
    for f in os.listdir(SF):
        if f in columns:
            duckdb.execute(f"COPY (SELECT * REPLACE ({columns[f]}) FROM '{SF}/{f}') TO '{out}/{f}' (FORMAT parquet)")
        elif f.endswith(".parquet"):
            os.symlink(f"{SF}/{f}", f"{out}/{f}")
    return out


@pytest.fixture(scope="module")
def zero_times(tmp_path_factory):
    """The smallest tables with cells whose trials of the run before, and rungs whose readings, took no time."""
    out = str(tmp_path_factory.mktemp("zeros"))
    columns = {
        "lineitem.parquet": "CASE WHEN l_returnflag = 'A' AND l_suppkey % 2 = 0 THEN 0 ELSE l_extendedprice END AS l_extendedprice, 0.1::DOUBLE AS l_discount",
        "orders.parquet": "CASE WHEN o_orderkey % 7 = 2 OR o_orderkey % 7 = 3 AND o_custkey % 2 = 1 OR o_orderkey % 7 = 4 AND o_custkey % 2 = 0 THEN 0 ELSE o_totalprice END AS o_totalprice",
    }
    for f in os.listdir(SF):
        if f in columns:
            duckdb.execute(f"COPY (SELECT * REPLACE ({columns[f]}) FROM '{SF}/{f}') TO '{out}/{f}' (FORMAT parquet)")
        elif f.endswith(".parquet"):
            os.symlink(f"{SF}/{f}", f"{out}/{f}")
    return out


def same_as_sql(spark, sf, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for f in os.listdir(sf):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert want
    assert sorted([plain(r[c]) for c in columns] for r in df.collect()) == sorted([plain(v) for v in r] for r in want)


def test_truth_samples_of_any_number(spark, many_suppliers):
    same_as_sql(spark, many_suppliers, "missing_baseline_cells")


def test_samples_outside_the_golden_sweep_of_any_number(spark, many_suppliers):
    same_as_sql(spark, many_suppliers, "regression_verdict")


def test_verdict_over_cells_without_an_arch_and_events_without_keys(spark, null_keys):
    same_as_sql(spark, null_keys, "regression_verdict")


def test_verdict_on_what_took_no_time_before(spark, zero_times):
    same_as_sql(spark, zero_times, "regression_verdict")


def test_probe_totals_do_not_make_the_pairs(spark, monkeypatch):
    """What 40 rungs and 40 readings of a cell sum to is that of their 1,600 pairs, and the query counts pairs without making
    them."""
    rungs = spark.range(40).selectExpr("'r' as run_sha", "'s' as sample", "'a' as arch", "1 as threads", "id as rep", "1D as wall_seconds")
    probes = spark.range(40).selectExpr("'r' as run_sha", "'s' as sample", "'a' as arch", "0L as rep", "concat('p', id % 2) as phase", "cast(id as double) as m_accesses_per_sec", "1D as ns_per_access")
    pairs = perf.ladder_probes(rungs, probes).groupBy(*perf.PROBE_CELL, "phase").agg(F.count("*").alias("n"), F.sum("m_accesses_per_sec").alias("total"))
    assert sorted(pairs.collect()) == sorted(perf.ladder_probe_totals(rungs, probes).collect())
    monkeypatch.setattr(perf, "ladder_probes", None)
    assert entry.queries()["ladder_probes_by_cell"](spark, SF).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_numbered_is_the_row_number(spark, monkeypatch):
    """Few keys, null among them, over several ranges, without a window over the rows."""
    monkeypatch.setattr(session, "TASK_ROWS", 70)
    rows = spark.range(1000).selectExpr("case when id % 3 > 0 then id % 3 end as k", "id % 2 = 0 as even", "hash(id) as o", "id as kept")
    want = rows.select("k", "even", "kept", F.row_number().over(Window.partitionBy("k", "even").orderBy("o", "kept")).alias("place"))
    got = sets.numbered(rows, ["k", "even"], ["o", "kept"], ["kept"], "place")
    key = lambda r: r.kept
    assert [tuple(r) for r in sorted(got.collect(), key=key)] == [tuple(r) for r in sorted(want.collect(), key=key)]


@pytest.mark.parametrize("name", ["writer_control", "paired_ratio", "arena_table"])
def test_rounds_over_many_ranges(spark, monkeypatch, name):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    same_as_sql(spark, SF, name)


def test_no_window_sorts_the_rounds_of_an_arm(spark, monkeypatch):
    """The rows that the arena reports get are numbered over ranges."""
    seen = {}
    monkeypatch.setattr(arena, "writer_control", lambda rows: seen.setdefault("rows", rows).selectExpr("1D as native_saves", "1D as process_saves"))
    entry.queries()["writer_control"](spark, SF)
    for rows in (seen["rows"], entry.queries()["arena_cold_mask"](spark, SF)):
        assert "row_number" not in plan_of(rows)


def test_rounds_are_dealt_out_before_they_are_sorted(spark, monkeypatch):
    """The two arms of a round meet in as many partitions as their rows fill."""
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    rows = spark.range(200).selectExpr("'a' as arch", "concat('v', id % 2) as label", "'default' as mode", "id div 2 + 1 as rep", "'b' as block", "id % 2 as position", "1D as wall_seconds", "1D as process_seconds", "1L as thp_fault_fallback", "false as cold")
    pairs = spark.createDataFrame([("p", "a", "v0", "default", "v1", "default")], "pair string, arch string, prior_label string, prior_mode string, this_label string, this_mode string")
    out = arena.paired_ratios(rows, pairs)
    assert out.first().rounds == 100 and "RepartitionByExpression [pair" in plan_of(out) and ", 20" in plan_of(out)
    assert "rightHint=(strategy=broadcast)" in plan_of(out) and "rightHint=(strategy=broadcast)" in plan_of(arena.cold(rows.drop("cold").selectExpr("*", "1D as index_read_seconds", "1D as io_in_mb")))


def test_target_cells_are_made_once(spark):
    """No distinct over the cells: copies of a declared sample and outputs that overlap are settled before there are any."""
    samples = spark.createDataFrame([("s1", "s1", False, False, False, True)] * 2 + [("s1-fast", "s1", False, False, False, False), ("s2", "s2", True, True, False, False)], "sample string, base string, truth boolean, meth boolean, compat boolean, golden boolean")
    archs = spark.createDataFrame([("a1", "x86"), ("a1", "x86"), ("a2", "x86"), ("a3", "arm")], "arch string, platform string")
    outputs = (targets.Output("t", "runs", "p", "sweep", "x86"), targets.Output("t", "runs", "p", "golden", "x86", "baseline_reps"), targets.Output("t", "runs", "q", "fast", "arm"), targets.Output("t", "runs", "e", "truth", "x86"))
    out = targets.expected(samples, archs, 3, 1, "a2", outputs)
    want = [("t", "runs", "p", "s1", a, r) for a in ("a1", "a2") for r in (1, 2, 3)] + [("t", "runs", "q", "s1-fast", "a3", r) for r in (1, 2, 3)] + [("t", "runs", "e", "s2", "a2", r) for r in (1, 2, 3)]
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert "Aggregate" not in plan_of(out).split("Join")[0]


def test_target_closure_broadcasts_no_cells(spark, monkeypatch):
    """Files of a few kilobytes hold thousands of cells: rules and architectures are all that a round broadcasts."""
    rounds = []

    def planned(df, name):
        rounds.extend([df._jdf.queryExecution().executedPlan().toString()] * (name == "needed"))
        return session.materialize(df, name)

    monkeypatch.setattr(targets, "materialize", planned)
    entry.queries()["target_closure"](spark, SF)
    assert len(rounds) > 3 and max(p.count("BroadcastExchange") for p in rounds) == 2


def test_target_closure_finds_a_cell_without_an_arch_once(spark):
    """What two rounds lead to is one cell as in SQL, where nulls of a UNION are equal."""
    rules = (("runs", "p", "runs", "q", "same", "reference", "same"), ("runs", "p", "runs", "r", "same", "same", "same"), ("runs", "r", "runs", "q", "same", "reference", "same"))
    wanted = spark.createDataFrame([("runs", "p", "s", "x", 1)], "source string, product string, sample string, arch string, rep long")
    samples, archs = spark.createDataFrame([("s", "s")], "sample string, base string"), spark.createDataFrame([("x", None)], "arch string, baseline_arch string")
    got = sorted(tuple(r) for r in targets.closure(wanted, samples, archs, rules).collect())
    assert got == [("runs", "p", "s", "x", 1), ("runs", "q", "s", None, 1), ("runs", "r", "s", "x", 1)]
