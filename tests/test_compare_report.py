"""The whole comparison report against a walk over the records in plain Python; inputs are read once."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from benchlake.functions.records import CompareOptions
from benchlake.operators import concordance as C
from benchlake.schemas import RECORD

UNMAPPED, REVERSE, FIRST, LAST, SECONDARY, SUPPLEMENTARY = 4, 16, 64, 128, 256, 2048


def kind(r):
    return "supplementary" if r["flags"] & SUPPLEMENTARY else "secondary" if r["flags"] & SECONDARY else "primary"


def end(r):
    return (1 if r["flags"] & FIRST else 0) + (2 if r["flags"] & LAST else 0)


def mapped(r):
    return not r["flags"] & UNMAPPED


def same_tag(a, b):
    if a[0] != b[0]:
        return False
    return float(a[1]) == float(b[1]) if a[0] == "Float" else a[1] == b[1]


def tag_diffs(q, b):
    out = []
    for t in sorted({*q["tags"], *b["tags"]}):
        if t not in b["tags"]:
            out.append((t, "query_only"))
        elif t not in q["tags"]:
            out.append((t, "baseline_only"))
        elif not same_tag(q["tags"][t], b["tags"][t]):
            out.append((t, "value_diff"))
    return out


def diffs(q, b, opts):
    if mapped(q) and not mapped(b):
        return ["mapped_only_query"]
    if mapped(b) and not mapped(q):
        return ["mapped_only_baseline"]
    out = []
    if mapped(q):
        out += ["pos_diff"] * ((q["ref"], q["pos"]) != (b["ref"], b["pos"])) + ["cigar_diff"] * (q["cigar"] != b["cigar"]) + ["mapq_diff"] * (abs((q["mapq"] or 0) - (b["mapq"] or 0)) > opts.mapq_tolerance)
    out += ["flag_diff"] * (q["flags"] != b["flags"]) + ["tag_diff"] * any(t not in opts.ignore_tags for t, _ in tag_diffs(q, b))
    return out


def five_prime(r):
    if not mapped(r) or r["pos"] is None:
        return None
    ops = r["cigar"]

    def clip(ops):
        n = 0
        for o, k in ops:
            if o not in "SH":
                break
            n += k
        return n

    if r["flags"] & REVERSE:
        return r["pos"] + sum(k for o, k in ops if o in "MDN=X") - 1 + clip(ops[::-1])
    return r["pos"] - clip(ops)


def placement(q, b, opts):
    sure = lambda r: r is not None and mapped(r) and (r["mapq"] or 0) >= opts.confident_mapq
    side = "both" if sure(q) and sure(b) else "query_only" if sure(q) else "baseline_only" if sure(b) else None
    if side is None:
        return None, None
    if q is None or b is None or not mapped(q) or not mapped(b) or q["ref"] != b["ref"] or (q["flags"] ^ b["flags"]) & REVERSE or None in (five_prime(q), five_prime(b)):
        return side, "relocated"
    moved = abs(five_prime(q) - five_prime(b))
    return side, "same" if moved == 0 else "shifted" if moved <= opts.relocation_bp else "relocated"


def slow_report(templates, opts):
    """templates: [(query records, baseline records)] -> rows (part, key, measure): value."""
    out, place_counts = Counter(), Counter()
    tags = {t: Counter() for t in opts.ignore_tags}
    for sides in templates:
        out["total", "", "total_templates"] += 1
        for side, name in zip(sides, ("query", "baseline"), strict=True):
            for r in side:
                for t in r["tags"]:
                    tags.setdefault(t, Counter())[f"{name}_present"] += 1
        ends = [{end(r): r for r in side if kind(r) == "primary"} for side in sides]
        for e in sorted({*ends[0], *ends[1]}):
            q, b = ends[0].get(e), ends[1].get(e)
            found = ["mapped_only_query"] if b is None else ["mapped_only_baseline"] if q is None else diffs(q, b, opts)
            out["total", "", "total_reads"] += 1
            out["total", "", "concordant"] += not found
            for d in set(found):
                out["class", d, "count"] += 1
            if q is not None and b is not None and mapped(q) == mapped(b):
                for t, how in tag_diffs(q, b):
                    tags.setdefault(t, Counter())[how] += 1
            side, outcome = placement(q, b, opts)
            if side:
                place_counts[side, "confident_reads"] += 1
                place_counts[side, outcome] += 1
        for cls in ("supplementary", "secondary"):
            qs, bs = ([r for r in side if kind(r) == cls] for side in sides)
            key = lambda r: (end(r), r["ref"], r["pos"], r["flags"] & REVERSE)
            left, n = list(bs), Counter(query_total=len(qs), baseline_total=len(bs))
            for q in qs:
                here = [b for b in left if key(b) == key(q)]
                if not here:
                    n["unmatched"] += 1
                    continue
                b = next((b for b in here if not diffs(q, b, opts)), here[0])
                left.remove(b)
                n["matched"] += 1
                if found := diffs(q, b, opts):
                    n["content_diffs"] += 1
                    for d in set(found):
                        n[d] += 1
            n["unmatched"] += len(left)
            n["count_mismatch_templates"] += len(qs) != len(bs)
            for m, v in n.items():
                out["non_primary", cls, m] += v
    reads, total = out["total", "", "total_reads"], out["total", "", "total_templates"]
    pct = lambda a, b: a / b * 100 if b else 0.0
    want = {k: float(v) for k, v in out.items() if k[0] in ("class", "non_primary") and v}
    for m in ("total_templates", "total_reads", "concordant"):
        want["total", "", m] = float(out["total", "", m])
    want["total", "", "concordance_pct"] = pct(out["total", "", "concordant"], reads)
    want |= {("class", c, "pct"): pct(v, reads) for (p, c, m), v in out.items() if p == "class"}
    for t, n in tags.items():
        want |= {("tag", t, m): float(n[m]) for m in ("value_diff", "query_only", "baseline_only", "query_present", "baseline_present")} | {("tag", t, "ignored"): float(t in opts.ignore_tags)}
    for cls in ("supplementary", "secondary"):
        n = lambda m, c=cls: float(out["non_primary", c, m])
        want |= {("non_primary", cls, m): n(m) for m in ("query_total", "baseline_total", "matched", "unmatched", "content_diffs", "count_mismatch_templates")}
        want |= {("non_primary", cls, "count_mismatch_pct"): pct(n("count_mismatch_templates"), total), ("non_primary", cls, "unmatched_pct"): pct(n("unmatched"), n("query_total") + n("baseline_total"))}
    for side in ("both", "query_only", "baseline_only"):
        n = place_counts[side, "confident_reads"]
        want |= {("placement", side, m): float(place_counts[side, m]) for m in ("confident_reads", "shifted", "relocated")} | {("placement", side, "relocated_pct"): place_counts[side, "relocated"] / n * 100 if n else None}
    if opts.expect_tags and opts.tag_guard:
        seen = {t for t, n in tags.items() if n["query_present"] + n["baseline_present"]}
        want |= {("violation", t, "unexpected"): 1.0 for t in seen - opts.expect_tags - opts.ignore_tags} | {("violation", t, "dead_ignore"): 1.0 for t in opts.ignore_tags - seen - opts.absent_ok_tags} | {("violation", t, "redundant_absent_ok"): 1.0 for t in opts.absent_ok_tags - opts.ignore_tags}
    return want


def record(rng, name):
    flags = rng.choice([65, 129, 65, 129, 0, 193]) | rng.choice([0, 0, 0, 4]) | rng.choice([0, 0, 16]) | rng.choice([0, 0, 0, 256, 2048, 2304])
    tags = {t: v for t, v in (("NM", ("Int", str(rng.randint(0, 2)))), ("XA", ("Str", "x")), ("XF", ("Float", rng.choice(["1.0", "1.5", "nan"]))), ("YC", ("Str", "y"))) if rng.random() < 0.5}
    cigar = rng.choice([[("M", 75)], [("S", 5), ("M", 70)], [("M", 60), ("H", 3), ("S", 2)], [("S", 2), ("M", 3), ("D", 4), ("I", 1), ("M", 9), ("H", 1)], []])
    return {"name": name, "flags": flags, "ref": rng.choice([0, 0, 1, None]), "pos": rng.choice([100, 100, 105, 112, None]), "mapq": rng.choice([0, 19, 20, 60, None]), "cigar": cigar, "tags": tags}


def changed(rng, r):
    other = record(rng, r["name"])
    return {k: other[k] if k != "name" and rng.random() < 0.2 else v for k, v in r.items()}


def streams(seed, n):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        name = rng.choice("abc") if rng.random() < 0.3 else f"t{k}"
        if out and out[-1][0] == name:
            continue
        query = [record(rng, name) for _ in range(rng.randint(1, 6))]
        baseline = [changed(rng, r) for r in query if rng.random() < 0.85] + [record(rng, name) for _ in range(rng.choice([0, 0, 1]))]
        rng.shuffle(baseline)
        out.append((name, query, baseline or [record(rng, name)]))
    return out


def frame(spark, records, step=1):
    rows = [(k * step, r["name"], r["flags"], r["ref"], r["pos"], r["mapq"], [{"op": o, "len": n} for o, n in r["cigar"]], {k: {"t": t, "v": v} for k, (t, v) in r["tags"].items()}) for k, r in enumerate(records)]
    return spark.createDataFrame(rows, RECORD).repartition(3)


OPTIONS = (CompareOptions(), CompareOptions(frozenset({"XA", "ZZ"}), frozenset({"NM", "XF"}), frozenset({"ZZ", "QQ"}), 1, 20, 5), CompareOptions(frozenset({"XF"}), frozenset({"NM"}), frozenset(), 60, 60, 0, tag_guard=False))


def rows_of(df):
    return {(r.part, r.key, r.measure): r.value for r in C.report_rows(df).collect()}


@pytest.mark.parametrize(("seed", "width"), [(1, None), (2, 7), (3, 1)])
def test_report_equals_plain_python(spark, seed, width):
    templates = streams(seed, 60)
    query, baseline = (frame(spark, [r for t in templates for r in t[k]], step=5) for k in (1, 2))
    for opts in OPTIONS:
        got, want = rows_of(C.compare(query, baseline, opts, width=width)), slow_report([(q, b) for _, q, b in templates], opts)
        assert got.keys() == want.keys()
        assert {k: (v, want[k]) for k, v in got.items() if v != want[k] and not (v is not None and want[k] is not None and abs(v - want[k]) < 1e-9)} == {}


def test_report_by_name_and_of_nothing(spark):
    templates = [t for t in streams(5, 40) if t[0].startswith("t")]
    flat = [[r for t in templates for r in t[k]] for k in (1, 2)]
    order = random.Random(1)
    names = [t[0] for t in templates]
    order.shuffle(names)
    turned = [r for n in names for t in templates if t[0] == n for r in t[2]]
    got = rows_of(C.compare(frame(spark, flat[0]), frame(spark, turned), OPTIONS[1], ordered=False))
    assert got == pytest.approx(slow_report([(q, b) for _, q, b in templates], OPTIONS[1]), nan_ok=True)
    none = frame(spark, flat[0]).filter("false")
    assert rows_of(C.compare(none, none, OPTIONS[1])) == slow_report([], OPTIONS[1])
    with pytest.raises(Exception, match="diverge"):
        C.compare(frame(spark, flat[0]), frame(spark, turned)).collect()


def test_inputs_are_read_once(spark):
    """Records pass the source once, however many parts the report has."""
    templates = streams(6, 50)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    query, baseline = (frame(spark, [r for t in templates for r in t[k]]) for k in (1, 2))
    total = query.count() + baseline.count()
    C.compare(query.mapInPandas(counted, RECORD), baseline.mapInPandas(counted, RECORD), OPTIONS[1]).collect()
    assert read.value == total
    plan = C.compare(query, baseline)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") <= 4  # two tables of counted records, each read for its ends and its rows
    assert C.facts(C.lockstep(query, baseline)).groupBy("part").agg(F.sum("n0")).count() >= 5
