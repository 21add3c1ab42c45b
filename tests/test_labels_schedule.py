"""Labels, tag policies, schedules and job reports."""

from pyspark.sql import functions as F

from benchlake.functions import labels as L
from benchlake.plans import schedule as P


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


def test_labels(spark):
    for label, version in (("v237", "v0.23.7"), ("v480", "v0.48.0"), ("v0480", "v0.48.0"), ("v069", "v0.6.9"), ("0dd1e5", "0dd1e5 (interim build)")):
        assert one(spark, label, L.release_version) == version
    assert [one(spark, x, L.fast_sibling) for x in ("candidate", "v237")] == ["candidate-fast", "v237-fast"]
    assert [one(spark, x, L.base_sample) for x in ("exome-3M-compat", "exome-3M-compat-old", "exome-3M-fast", "exome-3M")] == ["exome-3M"] * 4
    assert one(spark, "sort-by-name-77aa", L.job_command) == "sort_by_name"


def test_tag_lists(spark):
    df = spark.createDataFrame([(["MQ", "HN"], ["XA"], None, False), (["MQ"], ["XA"], ["YC"], True)], "d array<string>, o array<string>, e array<string>, s boolean")
    assert [r.t for r in df.select(L.tags(F.col("d"), F.col("o"), F.col("e"), F.col("s")).alias("t")).collect()] == [["HN", "MQ", "XA"], []]
    m = spark.createDataFrame([({"mapq_diff": 2, "pos_diff": 3, "flag_diff": 0},)], "m map<string,long>")
    assert m.select(L.breakdown(F.col("m"), ("pos_diff", "mapq_diff", "flag_diff")).alias("b")).first().b == "pos 3, mapq 2"


def test_schedule(spark):
    arms = spark.createDataFrame([(x, "b1") for x in ("new", "old", "c", "d")] + [("e", "b2"), ("f", "b2")], "label string, block string")
    pairs = spark.createDataFrame([("old", "new"), ("c", "e")], "first string, second string")
    rows = P.schedule(arms, pairs, "new", "seed", 5, 2).collect()
    assert rows == P.schedule(arms, pairs, "new", "seed", 5, 2).collect() != P.schedule(arms, pairs, "new", "other", 5, 2).collect()
    rounds = {}
    for r in rows:
        rounds.setdefault((r.block, r.round), {})[r.label] = r.position
    assert {b for b, k in rounds if k == 5} == {"b1"} and len([1 for b, _ in rounds if b == "b2"]) == 3
    assert all(sorted(v.values()) == list(range(1, len(v) + 1)) for v in rounds.values())
    leads = [v["old"] < v["new"] for (b, _), v in sorted(rounds.items()) if b == "b1"]
    assert all(abs(v["old"] - v["new"]) == 1 for (b, _), v in rounds.items() if b == "b1") and all(a != b for a, b in zip(leads, leads[1:], strict=False))


def test_jobs(spark):
    jobs = spark.createDataFrame([("align", "DONE"), ("align", "FAILED"), ("compare", "DONE")], "command string, state string")
    assert {tuple(r) for r in P.job_counts(jobs).collect()} == {("align", "DONE", 1), ("align", "FAILED", 1), ("compare", "DONE", 1), ("align", None, 2), ("compare", None, 1), (None, None, 3)}
    assert [tuple(r) for r in P.daily_cost(spark.createDataFrame([("d1", 1.0), ("d2", 2.0), ("d1", 3.0)], "day string, amount double")).collect()] == [("d1", 4.0), ("d2", 2.0), (None, 6.0)]
    keys = lambda *x: spark.createDataFrame([(k,) for k in x], "key string")
    assert [r.key for r in P.orphans(keys("a", "b", "c.tmp", "d"), keys("a"), keys("b"), r"\.tmp$").collect()] == ["d"]
    cells = spark.createDataFrame([("s", "a", 1), ("s", "a", 2), ("s", "b", 2), ("s", "c", 1)], "sample string, arch string, rep long")
    assert {r.arch: r.problem for r in P.promotion(cells, 2).collect()} == {"a": None, "b": "no first replicate", "c": "too few replicates"}
