"""Record-level concordance of two alignment streams.

Records are grouped into templates by name and file order, primaries are paired by read end and
secondary and supplementary records by place, and every difference is counted once per read. All of
it is columns and aggregations: one shuffle by template, then small partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchlake.functions import records as R
from benchlake.functions.records import CompareOptions
from benchlake.schemas import FULL_RECORD, RECORD
from benchlake.session import materialize

DEFAULTS = CompareOptions()


#: Record numbers that one window of ``ordinals`` spans.
RANGE = 1 << 20


def ordinals(records: DataFrame, width: int | None = None) -> DataFrame:
    """Adds ``template``, the ordinal of the run of equal names a record is in (gaps and islands). The file is cut into
    ranges of ``width`` record numbers; runs are counted inside each, and a prefix sum over one row for each range
    puts them together (a run that goes on over a border counts once). Records are read once and written with
    their counts; only the ranges' ends are read again. No single task sees all records."""
    parts = records.withColumn("_part", F.floor(F.col("idx") / (width or RANGE)))
    w, order = Window.partitionBy("_part").orderBy("idx"), Window.orderBy("_part")  # order: one row for each range
    fresh = parts.withColumn("_new", (~F.lag("name").over(w).eqNullSafe(F.col("name"))).cast("long"))
    counted = materialize(fresh.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new"), "ordinals")
    ends = counted.groupBy("_part").agg(F.min_by("name", "idx").alias("_first"), F.max_by("name", "idx").alias("_last"), F.max("_run").alias("_runs"))
    joins = ends.select("_part", "_runs", F.lag("_last").over(order).eqNullSafe(F.col("_first")).cast("long").alias("_joins"))
    before = F.coalesce(F.sum(F.col("_runs") - F.col("_joins")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = joins.select("_part", (before - F.col("_joins")).alias("_base"))
    return counted.join(base, "_part").withColumn("template", F.col("_base") + F.col("_run")).drop("_part", "_run", "_base")


def numbered(records: DataFrame, width: int | None = None) -> DataFrame:
    """Adds ``number``, 1, 2, 3... in file order, by ranges as in ``ordinals``."""
    parts = records.withColumn("_part", F.floor(F.col("idx") / (width or RANGE)))
    counted = materialize(parts.withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy("idx"))), "numbered")
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row for each range
    base = counted.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", before.alias("_base"))
    return counted.join(base, "_part").withColumn("number", F.col("_base") + F.col("_row")).drop("_part", "_row", "_base")


def _record() -> Column:
    return F.struct(*(F.col(c) for c in RECORD.names))


def _in_file_order(records: Column) -> Column:
    return F.array_sort(records, lambda a, b: F.when(a["idx"] < b["idx"], -1).when(a["idx"] > b["idx"], 1).otherwise(0))


def templates(records: DataFrame, width: int | None = None) -> DataFrame:
    """(template, name, records): a template's records in file order. Grouped by the ordinal alone, so that a join on
    it needs no shuffle of its own."""
    return ordinals(records, width).groupBy("template").agg(F.min("name").alias("name"), _in_file_order(F.collect_list(_record())).alias("records"))


def lockstep(query: DataFrame, baseline: DataFrame, width: int | None = None) -> DataFrame:
    """(template, name, query, baseline) of two streams that must hold the same templates in the same
    order; a difference in name, order or length raises."""
    q = templates(query, width).select("template", F.col("name").alias("qn"), F.col("records").alias("query"))
    b = templates(baseline, width).select("template", F.col("name").alias("bn"), F.col("records").alias("baseline"))
    out = q.join(b, "template", "full_outer")
    problem = F.concat(F.lit("streams diverge at template "), F.col("template").cast("string"), F.lit(": "), F.coalesce("qn", F.lit("(end)")), F.lit(" / "), F.coalesce("bn", F.lit("(end)")))
    # a filter, which no reader of the columns can prune away
    return out.filter(F.when(F.col("qn").eqNullSafe(F.col("bn")), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))).select("template", F.col("qn").alias("name"), "query", "baseline")


def by_name(query: DataFrame, baseline: DataFrame) -> DataFrame:
    """Templates of streams whose names are unique, joined on the name: order does not matter."""
    side = lambda f, n: f.groupBy("name").agg(_in_file_order(F.collect_list(_record())).alias(n))
    return side(query, "query").join(side(baseline, "baseline"), "name", "full_outer")


def _primaries(side: str) -> Column:
    """end -> last primary of that end in file order."""
    own = F.filter(side, lambda r: R.kind(r["flags"]) == "primary")

    def last(k: int) -> Column:
        return F.try_element_at(F.filter(own, lambda r: R.end_key(r["flags"]) == k), F.lit(-1))

    return F.array(*(last(k) for k in range(4)))


def primary_pairs(pairs: DataFrame) -> DataFrame:
    """(name, end, q, b): primaries paired by read end; one side may be null."""
    side = lambda s: _primaries(s)
    both = pairs.select("name", side("query").alias("q"), side("baseline").alias("b"))
    ends = both.select("name", F.posexplode(F.arrays_zip("q", "b")).alias("end", "p")).select("name", "end", F.col("p.q").alias("q"), F.col("p.b").alias("b"))
    return ends.filter("q is not null or b is not null")


def _judged(q: Column, b: Column, opts: CompareOptions) -> dict[str, Column]:
    one = F.when(q.isNull(), F.array(F.lit("mapped_only_baseline"))).when(b.isNull(), F.array(F.lit("mapped_only_query")))
    both = q.isNotNull() & b.isNotNull()
    compared = both & (R.mapped(q) == R.mapped(b))
    side, outcome = R.placement(q, b, opts)
    return {"diffs": F.coalesce(one, R.differences(q, b, opts)), "tag_diffs": F.when(compared, R.tag_diffs(q, b)), "side": side, "outcome": outcome}


def classified(ends: DataFrame, opts: CompareOptions = DEFAULTS) -> DataFrame:
    """Adds ``diffs``, ``tag_diffs``, ``side`` and ``outcome`` to paired primaries."""
    return ends.withColumns(_judged(F.col("q"), F.col("b"), opts))


def nonprimary_tallies(pairs: DataFrame, opts: CompareOptions = DEFAULTS) -> DataFrame:
    """By (name, class): totals, matched, unmatched, content differences and their classes.

    Within a place (end, reference, start, strand) query records take, in file order, the first
    baseline record that agrees with them, else the first that is left. That is a fold, in order, over
    the few records of one place."""
    def rows(side: str, mark: str) -> DataFrame:
        r = F.col("r")
        e = pairs.select("name", F.explode(side).alias("r")).withColumn("class", R.kind(r["flags"])).filter(F.col("class") != "primary")
        return e.select("name", "class", R.end_key(r["flags"]).alias("end"), r["ref_id"].alias("ref"), r["pos"].alias("start"), R.has(r["flags"], R.REVERSE).alias("rev"), F.lit(mark).alias("mark"), "r")

    both = rows("query", "q").union(rows("baseline", "b"))
    ordered = lambda m: _in_file_order(F.collect_list(F.when(F.col("mark") == m, F.col("r"))))
    places = both.groupBy("name", "class", "end", "ref", "start", "rev").agg(ordered("q").alias("qs"), ordered("b").alias("bs"))
    # the fold works on positions in bs, so its state stays small
    state = F.struct(F.sequence(F.lit(0), F.size("bs") - 1).alias("left"), F.lit(0).alias("matched"), F.lit(0).alias("unmatched"), F.array().cast("array<array<string>>").alias("diffs"))
    start = F.when(F.size("bs") > 0, state).otherwise(state.withField("left", F.array().cast("array<int>")))

    def step(s: Column, q: Column) -> Column:
        tried = F.transform(s["left"], lambda k: F.struct(k.alias("k"), R.differences(q, F.get("bs", k), opts).alias("d")))
        pick = F.coalesce(F.get(F.filter(tried, lambda t: F.size(t["d"]) == 0), F.lit(0)), F.get(tried, F.lit(0)))
        # one more fold of one element, so that the pick is made once
        return F.get(
            F.transform(
                F.array(pick),
                lambda t: F.struct(
                    F.filter(s["left"], lambda k: ~k.eqNullSafe(t["k"])).alias("left"),
                    (s["matched"] + t.isNotNull().cast("int")).alias("matched"),
                    (s["unmatched"] + t.isNull().cast("int")).alias("unmatched"),
                    F.when(F.coalesce(F.size(t["d"]) > 0, F.lit(False)), F.concat(s["diffs"], F.array(t["d"]))).otherwise(s["diffs"]).alias("diffs"),
                ),
            ),
            F.lit(0),
        )

    folded = places.select("name", "class", F.size("qs").alias("nq"), F.size("bs").alias("nb"), F.aggregate("qs", start, step).alias("f"))
    return folded.groupBy("name", "class").agg(
        F.sum("nq").alias("query_total"),
        F.sum("nb").alias("baseline_total"),
        F.sum("f.matched").alias("matched"),
        F.sum(F.col("f.unmatched") + F.size("f.left")).alias("unmatched"),
        F.sum(F.size("f.diffs")).alias("content_diffs"),
        F.flatten(F.collect_list(F.flatten("f.diffs"))).alias("classes"),
    )


def by_class(pairs: DataFrame) -> DataFrame:
    """(class, count, pct): every read counts at most once in each class, and may be in several."""
    total = pairs.agg(F.count("*").alias("total"))
    counts = pairs.select(F.explode(F.array_distinct("diffs")).alias("class")).groupBy("class").agg(F.count("*").alias("count"))
    return counts.crossJoin(F.broadcast(total)).select("class", "count", (F.col("count") / F.nullif("total", F.lit(0)) * 100.0).alias("pct"))  # one row


def totals(pairs: DataFrame) -> DataFrame:
    good = F.count_if(F.size("diffs") == 0)
    return pairs.agg(F.count("*").alias("total_reads"), good.alias("concordant"), (good / F.nullif(F.count("*"), F.lit(0)) * 100.0).alias("concordance_pct"))


def by_tag(pairs: DataFrame, query: DataFrame, baseline: DataFrame, opts: CompareOptions = DEFAULTS) -> DataFrame:
    """Tag differences over primaries, and presence over all records: two populations, one row a tag."""
    how = lambda h: F.count_if(F.col("d.how") == h).alias(h)
    diffs = pairs.select(F.explode("tag_diffs").alias("d")).groupBy(F.col("d.tag").alias("tag")).agg(how("value_diff"), how("query_only"), how("baseline_only"))
    seen = lambda f, side: f.select(F.explode(F.map_keys("tags")).alias("tag"), F.lit(side).alias("side"))
    present = seen(query, "q").union(seen(baseline, "b")).groupBy("tag").agg(F.count_if(F.col("side") == "q").alias("query_present"), F.count_if(F.col("side") == "b").alias("baseline_present"))
    out = present.join(diffs, "tag", "full_outer").na.fill(0)
    ignored = sorted(opts.ignore_tags)
    return out.withColumn("ignored", F.col("tag").isin(ignored) if ignored else F.lit(False)).orderBy("tag")


def placements(pairs: DataFrame) -> DataFrame:
    """By confident side: reads, shifted, relocated, relocated percent (null for no reads). The three
    sides are always there."""
    spark = pairs.sparkSession
    sides = spark.createDataFrame([("both",), ("query_only",), ("baseline_only",)], "side string")
    got = pairs.filter("side is not null").groupBy("side").agg(F.count("*").alias("confident_reads"), F.count_if(F.col("outcome") == "shifted").alias("shifted"), F.count_if(F.col("outcome") == "relocated").alias("relocated"))
    out = sides.join(got, "side", "left").na.fill(0)
    return out.withColumn("relocated_pct", F.col("relocated") / F.nullif("confident_reads", F.lit(0)) * 100.0).orderBy("side")


def guard(tags: DataFrame, opts: CompareOptions) -> DataFrame:
    """Violations of the tag policy: tags seen that nothing allows, ignores that nothing uses, and
    absent-ok tags that are not ignored. Without expected tags there is no audit."""
    spark = tags.sparkSession
    empty = spark.createDataFrame([], "tag string, violation string")
    if not opts.expect_tags or not opts.tag_guard:
        return empty
    one = lambda xs: spark.createDataFrame([(x,) for x in sorted(xs)], "tag string")
    seen, expect, ignore, absent = tags.select("tag"), one(opts.expect_tags), one(opts.ignore_tags), one(opts.absent_ok_tags)
    return (
        seen.join(F.broadcast(expect.union(ignore)), "tag", "left_anti").withColumn("violation", F.lit("unexpected"))
        .unionByName(ignore.join(seen, "tag", "left_anti").join(absent, "tag", "left_anti").withColumn("violation", F.lit("dead_ignore")))
        .unionByName(absent.join(ignore, "tag", "left_anti").withColumn("violation", F.lit("redundant_absent_ok")))
        .orderBy("violation", "tag")
    )


SIDES = ("both", "query_only", "baseline_only")
NON_PRIMARY = ("supplementary", "secondary")
_SLOTS = 6


def _fact(part: str, key: Column, *numbers: Column) -> Column:
    """One fact of the report: what it counts, and up to six numbers that are summed."""
    slots = [*numbers, *[F.lit(0)] * (_SLOTS - len(numbers))]
    return F.struct(F.lit(part).alias("part"), key.cast("string").alias("key"), *(n.cast("long").alias(f"n{k}") for k, n in enumerate(slots)))


def _folded(query: Column, baseline: Column, opts: CompareOptions) -> Column:
    """Greedy pairs of two lists of records of one template, in file order: left (baseline records without a partner),
    matched, unmatched, content and the classes of differences of all pairs."""
    at = lambda r: F.struct(R.end_key(r["flags"]), r["ref_id"], r["pos"], R.has(r["flags"], R.REVERSE))
    none = F.array().cast("array<int>")
    start = F.struct(F.when(F.size(baseline) > 0, F.sequence(F.lit(0), F.size(baseline) - 1)).otherwise(none).alias("left"), F.lit(0).alias("matched"), F.lit(0).alias("unmatched"), F.lit(0).alias("content"), F.array().cast("array<string>").alias("classes"))

    def step(s: Column, q: Column) -> Column:
        here = F.filter(s["left"], lambda k: at(F.get(baseline, k)).eqNullSafe(at(q)))
        tried = F.transform(here, lambda k: F.struct(k.alias("k"), R.differences(q, F.get(baseline, k), opts).alias("d")))
        # folds of one element, so that candidates are compared once
        pick = F.get(F.transform(F.array(tried), lambda t: F.coalesce(F.get(F.filter(t, lambda x: F.size(x["d"]) == 0), F.lit(0)), F.get(t, F.lit(0)))), F.lit(0))
        return F.get(
            F.transform(
                F.array(pick),
                lambda t: F.struct(
                    F.filter(s["left"], lambda k: ~k.eqNullSafe(t["k"])).alias("left"),
                    (s["matched"] + t.isNotNull().cast("int")).alias("matched"),
                    (s["unmatched"] + t.isNull().cast("int")).alias("unmatched"),
                    (s["content"] + F.coalesce((F.size(t["d"]) > 0).cast("int"), F.lit(0))).alias("content"),
                    F.concat(s["classes"], F.coalesce(F.array_distinct(t["d"]), F.array().cast("array<string>"))).alias("classes"),
                ),
            ),
            F.lit(0),
        )

    return F.aggregate(query, start, step)


def facts(joined: DataFrame, opts: CompareOptions = DEFAULTS) -> DataFrame:
    """(part, key, n0 to n5) of paired templates: every number of the report, from one pass and one aggregation that
    combines before its shuffle. Rows: as many as there are tags, classes and sides."""
    none = F.lit(None).cast(joined.schema["query"].dataType.elementType)
    records = lambda side: F.coalesce(F.col(side), F.array().cast(joined.schema["query"].dataType))
    ends = F.filter(F.arrays_zip(_primaries("query").alias("q"), _primaries("baseline").alias("b")), lambda x: x["q"].isNotNull() | x["b"].isNotNull())
    whole = F.struct(none.alias("q"), none.alias("b"), F.col("query").alias("qs"), F.col("baseline").alias("bs"))
    each = F.transform(ends, lambda x: F.struct(x["q"].alias("q"), x["b"].alias("b"), F.lit(None).alias("qs"), F.lit(None).alias("bs")))
    units = joined.select(records("query").alias("query"), records("baseline").alias("baseline")).select(F.explode(F.concat(F.array(whole), each)).alias("u")).select("u.*")
    judged = units.withColumns(_judged(F.col("q"), F.col("b"), opts))
    own = lambda side, kind: F.filter(side, lambda r: R.kind(r["flags"]) == kind)
    for kind in NON_PRIMARY:
        judged = judged.withColumns({f"{kind}_q": own("qs", kind), f"{kind}_b": own("bs", kind)})
    judged = judged.withColumns({kind: F.when(F.size(f"{kind}_q") + F.size(f"{kind}_b") > 0, _folded(F.col(f"{kind}_q"), F.col(f"{kind}_b"), opts)) for kind in NON_PRIMARY})

    zero, one = F.lit(0), F.lit(1)
    how = lambda d, h: (d["how"] == h).cast("long")
    seen = lambda side, *n: F.transform(F.flatten(F.transform(side, lambda r: F.coalesce(F.map_keys(r["tags"]), F.array().cast("array<string>")))), lambda t: _fact("tag", t, zero, zero, zero, *n))

    def tally(kind: str) -> Column:
        f, nq, nb = F.col(kind), F.size(f"{kind}_q"), F.size(f"{kind}_b")
        counts = F.array(_fact("non_primary", F.lit(kind), nq, nb, f["matched"], f["unmatched"] + F.size(f["left"]), f["content"], (nq != nb).cast("long")))
        return F.when(f.isNotNull(), F.concat(counts, F.transform(f["classes"], lambda c: _fact(kind, c, one)))).otherwise(F.array().cast(counts_type))

    counts_type = "array<struct<part:string,key:string," + ",".join(f"n{k}:bigint" for k in range(_SLOTS)) + ">>"
    placed = F.when(F.col("side").isNotNull(), F.array(_fact("placement", F.col("side"), one, F.col("outcome") == "shifted", F.col("outcome") == "relocated"))).otherwise(F.array().cast(counts_type))
    of_read = F.concat(
        F.array(_fact("read", F.lit(None), one, F.size("diffs") == 0)),
        F.transform(F.array_distinct("diffs"), lambda c: _fact("class", c, one)),
        F.transform(F.coalesce("tag_diffs", F.array().cast("array<struct<tag:string,how:string>>")), lambda d: _fact("tag", d["tag"], how(d, "value_diff"), how(d, "query_only"), how(d, "baseline_only"))),
        placed,
    )
    of_template = F.concat(F.array(_fact("template", F.lit(None), one)), seen(F.col("qs"), one), seen(F.col("bs"), zero, one), *(tally(kind) for kind in NON_PRIMARY))
    stream = judged.select(F.explode(F.when(F.col("qs").isNull(), of_read).otherwise(of_template)).alias("f")).select("f.*")
    return stream.groupBy("part", "key").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in range(_SLOTS)))


def compare(query: DataFrame, baseline: DataFrame, opts: CompareOptions = DEFAULTS, *, ordered: bool = True, width: int | None = None) -> DataFrame:
    """The report as one nested row: templates, totals, by_class, by_tag (with every ignored tag, seen or not), non-primary
    records by class, confident placement (all three sides), violations of the tag policy. Both inputs are read once. Shares of
    nothing are 0, the relocated share of no reads is null."""
    joined = lockstep(query, baseline, width) if ordered else by_name(query, baseline)
    rows = facts(joined, opts).agg(F.collect_list(F.struct("*")).alias("f"))  # as many as there are tags, classes and sides
    of = lambda part: F.filter("f", lambda x: x["part"] == part)
    n = lambda part, k: F.coalesce(F.get(of(part), F.lit(0))[f"n{k}"], F.lit(0))
    pct = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)) * 100.0, F.lit(0.0))
    sums = rows.select("f", n("template", 0).alias("total_templates"), n("read", 0).alias("total_reads"), n("read", 1).alias("concordant"))
    keyed = lambda part, keys: F.transform(F.array(*map(F.lit, keys)), lambda k: F.coalesce(F.get(F.filter(of(part), lambda x: x["key"] == k), F.lit(0)), _fact(part, k)))
    ignored = R.literal_set(opts.ignore_tags)
    observed = F.filter(of("tag"), lambda x: x["n3"] + x["n4"] > 0)
    tags = F.concat(of("tag"), F.transform(F.array_except(ignored, F.transform(of("tag"), lambda x: x["key"])), lambda t: _fact("tag", t)))
    report = sums.select(
        "total_templates", "total_reads", "concordant", pct(F.col("concordant"), F.col("total_reads")).alias("concordance_pct"),
        F.array_sort(F.transform(of("class"), lambda x: F.struct(x["key"].alias("class"), x["n0"].alias("count"), pct(x["n0"], F.col("total_reads")).alias("pct")))).alias("by_class"),
        F.array_sort(F.transform(tags, lambda x: F.struct(x["key"].alias("tag"), x["n0"].alias("value_diff"), x["n1"].alias("query_only"), x["n2"].alias("baseline_only"), x["n3"].alias("query_present"), x["n4"].alias("baseline_present"), F.array_contains(ignored, x["key"]).alias("ignored")))).alias("by_tag"),
        F.transform(
            keyed("non_primary", NON_PRIMARY),
            lambda x: F.struct(
                x["key"].alias("class"), *(x[f"n{k}"].alias(c) for k, c in enumerate(("query_total", "baseline_total", "matched", "unmatched", "content_diffs", "count_mismatch_templates"))),
                pct(x["n5"], F.col("total_templates")).alias("count_mismatch_pct"), pct(x["n3"], x["n0"] + x["n1"]).alias("unmatched_pct"),
                F.array_sort(F.transform(F.filter("f", lambda y: y["part"] == x["key"]), lambda y: F.struct(y["key"].alias("class"), y["n0"].alias("count")))).alias("by_class"),
            ),
        ).alias("non_primary"),
        F.transform(keyed("placement", SIDES), lambda x: F.struct(x["key"].alias("side"), x["n0"].alias("confident_reads"), x["n1"].alias("shifted"), x["n2"].alias("relocated"), (x["n2"] / F.nullif(x["n0"], F.lit(0)) * 100.0).alias("relocated_pct"))).alias("placement"),
        _violations(F.transform(observed, lambda x: x["key"]), opts).alias("violations"),
    )
    return report


def _violations(seen: Column, opts: CompareOptions) -> Column:
    """``guard`` over an array of the tags that were seen."""
    expect, ignore, absent = map(R.literal_set, (opts.expect_tags, opts.ignore_tags, opts.absent_ok_tags))
    if not opts.expect_tags or not opts.tag_guard:
        seen, ignore, absent = (F.array().cast("array<string>"),) * 3
    named = lambda tags, why: F.transform(F.array_sort(tags), lambda t: F.struct(t.alias("tag"), F.lit(why).alias("violation")))
    return F.concat(
        named(F.array_except(F.array_except(ignore, seen), absent), "dead_ignore"),
        named(F.array_except(absent, ignore), "redundant_absent_ok"),
        named(F.array_except(seen, F.array_union(expect, ignore)), "unexpected"),
    )


def report_rows(report: DataFrame) -> DataFrame:
    """A report as rows (part, key, measure, value), for stores and tables."""
    row = lambda part, key, measure, value: F.struct(F.lit(part).alias("part"), key.cast("string").alias("key"), F.lit(measure).alias("measure"), value.cast("double").alias("value"))

    def spread(part: str, array: str | Column, key: str, *measures: str) -> Column:
        return F.flatten(F.transform(array, lambda x: F.array(*(row(part, x[key], m, x[m]) for m in measures))))

    none = F.lit("")
    inner = F.flatten(F.transform("non_primary", lambda x: F.transform(x["by_class"], lambda y: F.struct(F.lit("non_primary").alias("part"), x["class"].alias("key"), y["class"].alias("measure"), y["count"].cast("double").alias("value")))))
    every = F.concat(
        F.array(*(row("total", none, m, F.col(m)) for m in ("total_templates", "total_reads", "concordant", "concordance_pct"))),
        spread("class", "by_class", "class", "count", "pct"),
        spread("tag", F.transform("by_tag", lambda x: x.withField("ignored", x["ignored"].cast("int"))), "tag", "value_diff", "query_only", "baseline_only", "query_present", "baseline_present", "ignored"),
        spread("non_primary", "non_primary", "class", "query_total", "baseline_total", "matched", "unmatched", "content_diffs", "count_mismatch_templates", "count_mismatch_pct", "unmatched_pct"),
        inner,
        spread("placement", "placement", "side", "confident_reads", "shifted", "relocated", "relocated_pct"),
        F.transform("violations", lambda v: F.struct(F.lit("violation").alias("part"), v["tag"].alias("key"), v["violation"].alias("measure"), F.lit(1.0).alias("value"))),
    )
    return report.select(F.explode(every).alias("r")).select("r.*")


def census(pairs: DataFrame, opts: CompareOptions = DEFAULTS) -> DataFrame:
    """Sets of differing tags by whether the read agrees in everything else. A read with one side only
    counts all tags it has."""
    q, b = F.col("q"), F.col("b")
    skip = sorted(opts.ignore_tags)
    alone = F.transform(F.map_keys(F.coalesce(q["tags"], b["tags"])), lambda k: k)
    names = F.when(q.isNull() | b.isNull(), alone).otherwise(F.transform(R.tag_diffs(q, b), lambda d: d["tag"]))
    names = F.filter(names, lambda t: ~t.isin(skip)) if skip else names
    core = F.when(q.isNull() | b.isNull(), F.lit(False)).otherwise(F.size(R.differences(q, b, opts, tags=False)) == 0)
    keyed = pairs.select(F.array_join(F.array_sort(F.coalesce(names, F.array().cast("array<string>"))), "|").alias("pattern"), core.alias("core"))
    return keyed.groupBy("pattern").agg(F.count_if("core").alias("core_concordant"), F.count_if(~F.col("core")).alias("core_discordant")).orderBy("pattern")


def what_if(patterns: DataFrame, strict: set[str]) -> DataFrame:
    """Reads that would stay concordant if exactly these tags had to agree."""
    free = ~F.arrays_overlap(F.split("pattern", r"\|"), R.literal_set(strict)) if strict else F.lit(True)
    return patterns.filter(free).agg(F.coalesce(F.sum("core_concordant"), F.lit(0)).alias("concordant"))


def identical(query: DataFrame, baseline: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many full records only one side has. Maps are compared as sorted entries."""
    flat = lambda f: f.select(*(F.array_sort(F.map_entries(c)).alias(c) if dict(f.dtypes)[c].startswith("map") else F.col(c) for c in columns))
    q, b = flat(query), flat(baseline)
    only = lambda x, y, n: x.exceptAll(y).agg(F.count("*").alias(n))
    return only(q, b, "query_only").crossJoin(only(b, q, "baseline_only")).withColumn("identical", (F.col("query_only") == 0) & (F.col("baseline_only") == 0))


#: What two records must share to be the same: all fields of a record and its tags, in any order.
FIELDS = tuple(c for c in FULL_RECORD.names if c != "idx")


def record_identity(query: DataFrame, baseline: DataFrame, width: int | None = None) -> DataFrame:
    """Full records of two streams, the k-th with the k-th: one row with the number of pairs, of records that one side
    alone has, of pairs that differ in each field, and whether nothing differs."""
    side = lambda f, n: numbered(f, width).select("number", F.struct(*(F.array_sort(F.map_entries(c)).alias(c) if c == "tags" else F.col(c) for c in FIELDS)).alias(n))
    both = side(query, "q").join(side(baseline, "b"), "number", "full_outer")
    pair = F.col("q").isNotNull() & F.col("b").isNotNull()
    counts = both.agg(
        F.count_if(pair).alias("pairs"), F.count_if(F.col("b").isNull()).alias("query_only"), F.count_if(F.col("q").isNull()).alias("baseline_only"),
        *(F.count_if(pair & ~F.col(f"q.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(c) for c in FIELDS),
    )
    return counts.withColumn("identical", sum((F.col(c) for c in ("query_only", "baseline_only", *FIELDS)), F.lit(0)) == 0)


def header_differences(query: DataFrame, baseline: DataFrame) -> DataFrame:
    """(kind, key, query, baseline) of what two headers must share and do not: the sort and group order of @HD, the
    references in their order with their lengths, and the read groups. Programs and comments may differ."""

    def stated(h: DataFrame, name: str) -> DataFrame:
        x = lambda k: F.try_element_at("fields", F.lit(k))
        order = F.row_number().over(Window.partitionBy("kind").orderBy("line"))  # lines of one header
        hd = h.filter("kind = 'HD'").select("kind", F.explode(F.create_map(F.lit("SO"), x("SO"), F.lit("GO"), x("GO"))).alias("key", name)).filter(F.col(name).isNotNull())
        sq = h.filter("kind in ('SQ', 'ref')").select("kind", order.cast("string").alias("key"), F.concat_ws(":", x("SN"), x("LN")).alias(name))
        rg = h.filter("kind = 'RG'").select("kind", x("ID").alias("key"), F.array_join(F.array_sort(F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))), "\t").alias(name))
        return hd.union(sq).union(rg)

    both = stated(query, "query").join(stated(baseline, "baseline"), ["kind", "key"], "full_outer")
    return both.filter(~F.col("query").eqNullSafe(F.col("baseline"))).orderBy("kind", "key")
