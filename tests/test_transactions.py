"""The store's versions: all tables or none, writers that cross, old stores, what a reader sees."""

import threading

import pytest

from benchlake.cli import main
from benchlake.plans import collect as P
from benchlake.sinks import store as S
from benchlake.sinks.store import Conflict, Store


def trials(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, run_sha string, sample string, arch string, rep long, wall_seconds double")


def seen(store):
    return sorted((r.run_sha, r.rep, r.wall_seconds) for r in store.read("trials").collect())


def put(root, path, text):
    p = root / path
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)


def tree(root, sha, wall):
    for rep in (1, 2):
        put(root, f"runs/{sha}/s/a/rep-{rep}/benchmarks/timing.tsv", f"s\th:m:s\tmax_rss\n{wall}\t0\t1\n")
        put(root, f"runs/{sha}/s/a/rep-{rep}/compare/vs-baseline.json", '{"total_reads": 10, "concordant": 9, "concordance_pct": 90.0}')
        put(root, f"runs/{sha}/s/a/rep-{rep}/host-probe.jsonl", '{"phase": "before", "threads": 4}\n')
    put(root, f"scaling/{sha}/s/a/scaling.tsv", "threads\trep\twall_s\tcpu_s\tmax_rss_mb\tprocess_s\n1\t1\t10\t10\t5\t9\n")
    put(root, f"arena/{sha}/a/arena.tsv", f"label\tmode\trep\twall_s\tcpu_s\tmax_rss_mb\tprocess_s\nv1\tdefault\t1\t{wall}\t1\t1\t1\n")


@pytest.mark.parametrize("dies_at", [2, 6])
def test_a_collect_that_dies_leaves_the_old_tables(spark, tmp_path, monkeypatch, dies_at):
    store = Store(spark, str(tmp_path / "store"))
    tree(tmp_path / "one", "r", 5)
    P.collect(spark, str(tmp_path / "one"), store)
    before = {t: sorted(map(str, store.read(t).collect())) for t in S.TABLES}
    files = sorted(p.name for p in (tmp_path / "store").rglob("*.parquet"))
    tree(tmp_path / "two", "r", 7)
    tree(tmp_path / "two", "new", 8)
    own, calls = S.Transaction.stage, []

    def stage(self, *a):
        calls.append(a[0])
        own(self, *a)
        if len(calls) == dies_at:
            raise OSError("the disk is gone")

    monkeypatch.setattr(S.Transaction, "stage", stage)
    with pytest.raises(OSError, match="gone"):
        P.collect(spark, str(tmp_path / "two"), store)
    monkeypatch.undo()
    assert {t: sorted(map(str, store.read(t).collect())) for t in S.TABLES} == before
    assert sorted(p.name for p in (tmp_path / "store").rglob("*.parquet")) == files  # and nothing is left behind
    P.collect(spark, str(tmp_path / "two"), store)
    assert {r.wall_seconds for r in store.read("trials").collect()} == {7.0, 8.0} and store.read("arena").count() == 2


def test_writers_that_cross(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.upsert("trials", trials(spark, (1, "a", "s", "x", 1, 1.0), (2, "b", "s", "x", 1, 1.0)))
    # other runs: both changes stay
    with store.transaction() as one:
        one.upsert("trials", trials(spark, (1, "a", "s", "x", 1, 2.0)))
        store.upsert("trials", trials(spark, (2, "b", "s", "x", 1, 3.0), (3, "c", "s", "x", 1, 3.0)))
    assert seen(store) == [("a", 1, 2.0), ("b", 1, 3.0), ("c", 1, 3.0)]
    # the same run: the second writer is told, and nothing of its change stays
    with pytest.raises(Conflict, match="run a"), store.transaction() as one:
        one.upsert("trials", trials(spark, (4, "a", "s", "x", 4, 4.0)))
        store.upsert("trials", trials(spark, (5, "a", "s", "x", 5, 5.0)))
    assert seen(store) == [("a", 1, 2.0), ("a", 5, 5.0), ("b", 1, 3.0), ("c", 1, 3.0)]
    # done again on what is there by then
    late = []

    def work(t):
        t.upsert("trials", trials(spark, (4, "a", "s", "x", 4, 4.0)))
        if not late:
            late.append(store.upsert("trials", trials(spark, (6, "a", "s", "x", 6, 6.0))))

    store.run(work)
    assert [r for r in seen(store) if r[0] == "a"] == [("a", 1, 2.0), ("a", 4, 4.0), ("a", 5, 5.0), ("a", 6, 6.0)]


def test_many_writers_lose_nothing(spark, tmp_path):
    errors = []

    def write(k):
        try:
            store = Store(spark, str(tmp_path / "s"))
            for j in range(2):
                store.upsert("trials", trials(spark, (10 * k + j, "same", "s", "x", 10 * k + j, 1.0)))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and sorted(r[1] for r in seen(Store(spark, str(tmp_path / "s")))) == [0, 1, 10, 11, 20, 21, 30, 31]


def test_a_reader_keeps_its_version_and_vacuum_deletes_the_rest(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for wall in (1.0, 2.0, 3.0):
        store.upsert("trials", trials(spark, (1, "a/b c", "s", "x", 1, wall), (2, None, "s", "x", 1, wall)))
        if wall == 2.0:
            old = store.read("trials")
    assert {r.wall_seconds for r in old.collect()} == {2.0}
    store.replace_arena(spark.createDataFrame([("a/b c", "x", "v1", "m", 1)], "run_sha string, arch string, label string, mode string, rep long"))
    assert len(store.vacuum(keep=2)) > 2 and store.read("trials").count() == 2 and store.read("trials", ["a/b c"]).count() == 1
    assert store.read("trials", version=store.at(3)).count() == 2
    with pytest.raises(Exception, match="v000000000001"):
        store.at(1)
    assert store.vacuum(keep=2) == []


def test_a_store_of_before_manifests(spark, tmp_path):
    old = tmp_path / "old"
    trials(spark, (1, "a", "s", "x", 1, 1.0), (2, "b", "s", "x", 1, 1.0)).drop("wall_seconds").write.partitionBy("run_sha").parquet(str(old / "trials"))
    store = Store(spark, str(old))
    assert seen(store) == [("a", 1, None), ("b", 1, None)] and store.version() is None
    store.upsert("trials", trials(spark, (1, "a", "s", "x", 1, 9.0)))
    assert seen(store) == [("a", 1, 9.0), ("b", 1, None)] and store.version() == 14
    assert main(["--store", str(old), "trend"], spark) == 0


def test_no_rows_change_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.upsert("trials", trials(spark, (1, "a", "s", "x", 1, 1.0)).filter("false"))
    store.replace_arena(spark.createDataFrame([], "run_sha string, arch string, label string, mode string, rep long"))
    assert store.latest().number == 0 and store.read("trials").count() == 0
