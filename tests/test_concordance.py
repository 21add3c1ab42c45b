"""Record scenarios: pairing, classes, placement, folds, guard, identity."""

import pytest
from pyspark.sql import functions as F

from benchlake.functions import records as R
from benchlake.functions.records import CompareOptions
from benchlake.operators import concordance as C
from benchlake.schemas import RECORD

M75 = [("M", 75)]


def rec(name="t", flags=0x41, ref=0, pos=100, mapq=60, cigar=M75, tags=None):
    return name, flags, ref, pos, mapq, cigar, {k: {"t": t, "v": v} for k, (t, v) in (tags or {}).items()}


def frame(spark, rows):
    return spark.createDataFrame([(i, r[0], r[1], r[2], r[3], r[4], [{"op": o, "len": n} for o, n in r[5]], r[6]) for i, r in enumerate(rows)], RECORD)


def tally(spark, q, b, **opts):
    rows = C.nonprimary_tallies(C.by_name(frame(spark, q), frame(spark, b)), CompareOptions(**opts)).collect()
    return {r["class"]: (r.matched, r.content_diffs, r.unmatched) for r in rows}


def supp(mapq, pos=500, ref=1, flags=0x841):
    return rec(flags=flags, ref=ref, pos=pos, mapq=mapq)


@pytest.mark.parametrize(
    ("q", "b", "want"),
    [([60, 11], [11, 60], (2, 0, 0)), ([60, 11], [60, 42], (2, 1, 0)), ([1, 60], [60], (1, 1, 1)), ([60], [60, 60], (1, 0, 1))],
)
def test_greedy_pairing_in_file_order(spark, q, b, want):
    assert tally(spark, [supp(m) for m in q], [supp(m) for m in b])["supplementary"] == want


def test_moved_supplementary_is_unmatched_twice(spark):
    assert tally(spark, [supp(60)], [supp(60, pos=9999, ref=2)])["supplementary"] == (0, 0, 2)


def diffs(spark, q, b, **opts):
    df = spark.createDataFrame([(0,)], "x int").crossJoin(frame(spark, [q]).select(F.struct(*RECORD.names).alias("q"))).crossJoin(frame(spark, [b]).select(F.struct(*RECORD.names).alias("b")))
    return df.select(R.differences(F.col("q"), F.col("b"), CompareOptions(**opts)).alias("d")).first().d


def test_differences(spark):
    assert diffs(spark, rec(), rec()) == []
    assert diffs(spark, rec(), rec(flags=0x45)) == ["mapped_only_query"]
    assert diffs(spark, rec(pos=101, mapq=10), rec()) == ["pos_diff", "mapq_diff"]
    assert diffs(spark, rec(mapq=59), rec(), mapq_tolerance=1) == []
    assert diffs(spark, rec(tags={"XX": ("Str", "7F")}), rec(tags={"XX": ("Hex", "7F")})) == ["tag_diff"]
    assert diffs(spark, rec(tags={"XX": ("Str", "7F")}), rec(tags={"XX": ("Hex", "7F")}), ignore_tags=frozenset({"XX"})) == []
    assert diffs(spark, rec(tags={"NM": ("Int", "3")}), rec(tags={"NM": ("Int", "3")})) == []
    assert diffs(spark, rec(tags={"XF": ("Float", "nan")}), rec(tags={"XF": ("Float", "nan")})) == ["tag_diff"]


def place(spark, q, b):
    df = frame(spark, [q]).select(F.struct(*RECORD.names).alias("q")).crossJoin(frame(spark, [b]).select(F.struct(*RECORD.names).alias("b")))
    side, outcome = R.placement(F.col("q"), F.col("b"), CompareOptions())
    r = df.select(side.alias("s"), outcome.alias("o"), R.five_prime(F.col("q")).alias("p")).first()
    return r.s, r.o, r.p


def test_placement(spark):
    assert place(spark, rec(), rec(cigar=[("S", 5), ("M", 70)], pos=105)) == ("both", "same", 100)
    assert place(spark, rec(), rec(pos=110))[:2] == ("both", "shifted")
    assert place(spark, rec(), rec(pos=111))[:2] == ("both", "relocated")
    assert place(spark, rec(mapq=3), rec())[0] == "baseline_only"
    assert place(spark, rec(mapq=3), rec(mapq=3))[:2] == (None, None)
    assert place(spark, rec(flags=0x51, cigar=[("S", 5), ("M", 40), ("D", 2), ("M", 28), ("S", 3)]), rec())[2] == 172


def test_report_of_equal_streams_is_perfect(spark):
    q = [rec("a", 0x41), rec("a", 0x81, pos=300), rec("b", 0x41, tags={"NM": ("Int", "1")})]
    r = C.compare(frame(spark, q), frame(spark, q)).first()
    assert (r.total_reads, r.concordant, r.concordance_pct) == (3, 3, 100.0)
    assert r.by_class == [] and {p.side for p in r.placement} == {"both", "query_only", "baseline_only"}


def test_swapping_sides_swaps_counters(spark):
    q, b = [rec("a"), rec("b"), rec("b", 0x81)], [rec("a"), rec("b")]
    one, two = (C.compare(frame(spark, x), frame(spark, y)).first() for x, y in ((q, b), (b, q)))
    assert [c["class"] for c in one.by_class] == ["mapped_only_query"] and [c["class"] for c in two.by_class] == ["mapped_only_baseline"]


def test_streams_that_diverge_raise(spark):
    with pytest.raises(Exception, match="diverge"):
        C.lockstep(frame(spark, [rec("a"), rec("b")]), frame(spark, [rec("b"), rec("a")])).collect()
    with pytest.raises(Exception, match="diverge"):
        C.lockstep(frame(spark, [rec("a"), rec("b")]), frame(spark, [rec("a")])).collect()


@pytest.mark.parametrize(("q", "b"), [(["a", "b", "c"], ["b", "a"]), (["a", "b"], ["a", "b", "c"]), (["a", "b", "c"], ["a", "b"]), (["a", "b"], ["a", "c"])])
def test_every_reader_of_diverged_streams_raises(spark, q, b):
    query, baseline = (frame(spark, [rec(n) for n in names]) for names in (q, b))
    joined = C.lockstep(query, baseline)
    pairs = C.classified(C.primary_pairs(joined))
    for report in (C.census(C.primary_pairs(joined)), C.totals(pairs), C.placements(pairs), C.by_class(pairs)):
        with pytest.raises(Exception, match="diverge"):
            report.collect()



@pytest.mark.parametrize("records", [1, 2, 3, 100])
def test_templates_follow_file_order_across_ranges(spark, records, monkeypatch):
    monkeypatch.setattr(C, "RANGE", records)
    rows = [rec(n) for n in "aabbbacc"]
    got = {(r.template, r.name, len(r.records)) for r in C.templates(frame(spark, rows)).collect()}
    assert got == {(1, "a", 2), (2, "b", 3), (3, "a", 1), (4, "c", 2)}


def test_last_primary_of_an_end_wins(spark):
    q = [rec("a", mapq=1), rec("a", mapq=60)]
    assert C.totals(C.classified(C.primary_pairs(C.by_name(frame(spark, q), frame(spark, [rec("a", mapq=60)]))))).first().concordant == 1


def test_census_and_what_if(spark):
    q = [rec("a", tags={"NM": ("Int", "1"), "XA": ("Str", "x")}), rec("b", pos=9, tags={"NM": ("Int", "1")})]
    b = [rec("a", tags={"NM": ("Int", "2")}), rec("b", tags={"NM": ("Int", "2")})]
    c = C.census(C.primary_pairs(C.by_name(frame(spark, q), frame(spark, b))))
    assert {tuple(r) for r in c.collect()} == {("NM|XA", 1, 0), ("NM", 0, 1)}
    assert C.what_if(c, {"ZZ"}).first().concordant == 1 and C.what_if(c, {"XA"}).first().concordant == 0


def test_guard(spark):
    q = frame(spark, [rec(tags={"NM": ("Int", "1"), "XQ": ("Int", "1")})])
    pairs = C.classified(C.primary_pairs(C.by_name(q, q)))
    run = lambda **o: {tuple(r) for r in C.guard(C.by_tag(pairs, q, q, CompareOptions(**o)), CompareOptions(**o)).select("tag", "violation").collect()}
    assert run(expect_tags=frozenset({"NM"})) == {("XQ", "unexpected")}
    assert run(expect_tags=frozenset({"NM", "XQ"}), ignore_tags=frozenset({"ZZ"})) == {("ZZ", "dead_ignore")}
    assert run() == set()
    with pytest.raises(ValueError, match="tag"):
        CompareOptions(ignore_tags=frozenset({"N1M"}))
