"""The query catalogue: every operator applied to whole driver tables, with DuckDB SQL for the same.

The driver's tables are mapped to the telemetry schema by the views below; what runs on them is the
package's own operators, not copies of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benchlake.functions import labels as L
from benchlake.functions import records as R
from benchlake.functions import stats as S
from benchlake.operators import concordance as C
from benchlake.operators import latest, sets
from benchlake.plans import arena, gates, perf, release, schedule
from benchlake.session import materialize
from benchlake.streaming.ingest import windowed

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if oracle:
            _ORACLES[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Views

_REP = "row_number() over (partition by l_returnflag, l_suppkey, l_linestatus order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)"


def v_trials(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey as id",
        "l_returnflag as run_sha",
        "cast(l_suppkey as string) as sample",
        "l_linestatus as arch",
        f"cast({_REP} as bigint) as rep",
        "l_extendedprice / 1000 as wall_seconds",
        "case when l_tax = 0 then null else l_extendedprice / 1000 * (1 - l_tax) end as process_seconds",
        "l_tax as index_read_seconds",
        "l_quantity as max_rss_mb",
        "l_extendedprice / 100 as cpu_time",
        "l_quantity * 2 as io_read_mb",
        "l_quantity * 3 as io_write_mb",
        "case when l_discount = 0 then null when l_discount < 0.05 then 'portable' else 'native' end as image_variant",
        "date_format(cast(l_shipdate as timestamp), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as measured_at",
        "l_partkey as reads_processed",
    )


_T = f"""t AS (SELECT l_orderkey AS id, l_returnflag AS run_sha, CAST(l_suppkey AS VARCHAR) AS sample, l_linestatus AS arch, {_REP} AS rep,
  l_extendedprice / 1000 AS wall_seconds, CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice / 1000 * (1 - l_tax) END AS process_seconds, l_tax AS index_read_seconds,
  l_quantity AS max_rss_mb, l_extendedprice / 100 AS cpu_time, l_quantity * 2 AS io_read_mb, l_quantity * 3 AS io_write_mb,
  CASE WHEN l_discount = 0 THEN NULL WHEN l_discount < 0.05 THEN 'portable' ELSE 'native' END AS image_variant, l_shipdate AS measured, l_partkey AS reads_processed FROM lineitem)"""


def v_comparisons(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as trial_id",
        "case o_orderstatus when 'O' then 'vs-baseline' when 'F' then 'vs-golden' else 'vs-x86' end as kind",
        "o_custkey as total",
        "99.9 + o_totalprice / 1e7 as concordance_pct",
        "case when o_custkey % 7 = 0 then null when o_custkey % 11 = 0 then '{\"relocated_pct\": null}' else concat('{\"relocated_pct\": ', cast(o_custkey % 100 as string), '.5}') end as placement_json",
    )


_CMP = """c AS (SELECT o_orderkey AS trial_id, CASE o_orderstatus WHEN 'O' THEN 'vs-baseline' WHEN 'F' THEN 'vs-golden' ELSE 'vs-x86' END AS kind, o_custkey AS total,
  99.9 + o_totalprice / 1e7 AS concordance_pct, CASE WHEN o_custkey % 7 = 0 OR o_custkey % 11 = 0 THEN NULL ELSE CAST(CAST(o_custkey % 100 AS VARCHAR) || '.5' AS DOUBLE) END AS relocated FROM orders)"""


def v_runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr("cast(o_orderkey as string) as run_sha", "o_orderdate as submitted_at", "o_orderpriority as status", "o_custkey as host")


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
_RANK = "cast(l_partkey % 8 as bigint)"


def v_arena(spark: SparkSession, sf: str) -> DataFrame:
    """Eight arms a mode; neighbours in the ladder run next to each other and lead in turn; the two
    oldest are in a block of their own."""
    base = table(spark, sf, "lineitem").selectExpr(
        "l_linestatus as arch",
        f"{_RANK} as rnk",
        "case when l_returnflag = 'A' then 'fast' else 'default' end as mode",
        *_LINE, "l_tax", "l_discount", "l_quantity",
    )
    rows = sets.numbered(base, ["arch", "rnk", "mode"], _LINE, ["l_linenumber", "l_tax", "l_discount", "l_quantity"], "rep")
    return rows.selectExpr(
        "'x' as run_sha",
        "arch",
        "case when rnk = 7 then case mode when 'fast' then 'candidate-fast' else 'candidate' end when rnk = 6 then 'baseline' when mode = 'fast' then concat('v', cast(rnk as string), '-fast') else concat('v', cast(rnk as string)) end as label",
        "mode",
        "rep",
        "case when l_discount = 0 then null else 100.0 - 5 * rnk + l_tax end as wall_seconds",
        "case when l_tax = 0 then null else 90.0 - 5 * rnk + l_tax end as process_seconds",
        "case when rnk < 2 then 'b0' else 'b1' end as block",
        "case when rep % 2 = 0 then rnk else 8 - rnk end as position",
        "l_tax as index_read_seconds",
        "l_quantity * 25 as io_in_mb",
        "l_linenumber as thp_fault_fallback",
    )


def v_ladder(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"v{k}", k) for k in range(6)], "label string, rank long")


_A = """b AS (SELECT l_linestatus AS arch, l_partkey % 8 AS rnk, CASE WHEN l_returnflag = 'A' THEN 'fast' ELSE 'default' END AS mode, * FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY arch, rnk, mode ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS rep FROM b),
r AS (SELECT arch, rnk, mode, rep, CASE WHEN rnk = 7 THEN CASE mode WHEN 'fast' THEN 'candidate-fast' ELSE 'candidate' END WHEN rnk = 6 THEN 'baseline' WHEN mode = 'fast' THEN 'v' || rnk || '-fast' ELSE 'v' || rnk END AS label,
  CASE WHEN l_discount = 0 THEN NULL ELSE 100.0::DOUBLE - 5 * rnk + l_tax END AS wall_seconds, CASE WHEN l_tax = 0 THEN NULL ELSE 90.0::DOUBLE - 5 * rnk + l_tax END AS process_seconds,
  CASE WHEN rnk < 2 THEN 'b0' ELSE 'b1' END AS block, CASE WHEN rep % 2 = 0 THEN rnk ELSE 8 - rnk END AS position, l_tax AS index_read_seconds, l_quantity * 25 AS io_in_mb, l_linenumber AS thp FROM n),
a AS (SELECT *, coalesce(index_read_seconds > 3 * median(index_read_seconds) OVER (PARTITION BY arch, block), FALSE) OR coalesce(io_in_mb > 1024, FALSE) AS cold FROM r),
m AS (SELECT arch, label, mode, rnk, median(wall_seconds) AS w, median(process_seconds) AS p, count(wall_seconds) AS n_reps, count(*) FILTER (wall_seconds IS NULL) AS n_skipped, count(*) FILTER (cold) AS cold_runs, median(thp) AS thp FROM a GROUP BY ALL),
ch AS (SELECT *, last_value(CASE WHEN w IS NOT NULL THEN label END IGNORE NULLS) OVER (PARTITION BY arch, mode ORDER BY rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM m WHERE rnk <> 6)"""


def v_scaling(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "case when o_custkey % 2 = 0 then 'new' else 'prev' end as run_sha",
        "o_orderstatus as sample",
        "o_orderpriority as arch",
        "shiftleft(1, cast(o_orderkey % 7 as int)) as threads",
        "o_orderkey as rep",
        "case when o_custkey % 5 = 0 then null else o_totalprice / shiftleft(1, cast(o_orderkey % 7 as int)) end as process_seconds",
        "o_totalprice / shiftleft(1, cast(o_orderkey % 7 as int)) as wall_seconds",
    )


_S = """s AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'new' ELSE 'prev' END AS sha, o_orderstatus AS sample, o_orderpriority AS arch, 1 << CAST(o_orderkey % 7 AS INTEGER) AS threads, o_totalprice / (1 << CAST(o_orderkey % 7 AS INTEGER)) AS t FROM orders),
g AS (SELECT sha, sample, arch, threads, median(t) AS t_s FROM s GROUP BY ALL),
h AS (SELECT *, max(CASE WHEN threads = 1 THEN t_s END) OVER (PARTITION BY sha, sample, arch) AS t1 FROM g),
e AS (SELECT sha, sample, arch, threads, t1 / (threads * t_s) * 100.0 AS eff, t_s FROM h WHERE t1 > 0 AND threads > 1)"""


def v_records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two alignment streams: even events are the query side, odd ones the baseline."""
    k = F.get_json_object("props", "$.k").cast("int")
    flags = F.when(F.col("event_type").isin("view", "click"), 64).otherwise(128) + F.when(F.col("value") > 60, 16).otherwise(0) + F.when(F.col("value") < 1, 4).otherwise(0) + F.when(F.col("event_type") == "error", 2048).otherwise(0)
    tag = lambda t, v: F.struct(F.lit(t).alias("t"), v.cast("string").alias("v"))
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("idx"),
        F.col("user_id").cast("string").alias("name"),
        flags.cast("int").alias("flags"),
        (k % 3).alias("ref_id"),
        F.floor("value").alias("pos"),
        (k % 61).alias("mapq"),
        F.array(F.struct(F.lit("S").alias("op"), (k % 4).alias("len")), F.struct(F.lit("M").alias("op"), (F.lit(75) - k % 4).alias("len"))).alias("cigar"),
        F.map_filter(F.create_map(F.lit("NM"), tag("Int", k % 5), F.lit("XA"), F.when(k % 2 == 0, tag("Str", k % 7))), lambda _, v: v.isNotNull()).alias("tags"),
    )
    return rows.filter("idx % 2 = 0"), rows.filter("idx % 2 = 1")


_E = """e AS (SELECT event_id AS idx, CAST(user_id AS VARCHAR) AS name, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type, value FROM events),
rec AS (SELECT idx, name, idx % 2 = 0 AS q, (CASE WHEN event_type IN ('view', 'click') THEN 64 ELSE 128 END) + (CASE WHEN value > 60 THEN 16 ELSE 0 END) + (CASE WHEN value < 1 THEN 4 ELSE 0 END) + (CASE WHEN event_type = 'error' THEN 2048 ELSE 0 END) AS flags,
  k % 3 AS ref_id, CAST(floor(value) AS BIGINT) AS pos, k % 61 AS mapq, k % 4 AS clip, k % 5 AS nm, CASE WHEN k % 2 = 0 THEN k % 7 END AS xa FROM e),
pri AS (SELECT *, CASE WHEN flags & 64 <> 0 THEN 1 ELSE 2 END AS "end", row_number() OVER (PARTITION BY q, name, flags & 192 ORDER BY idx DESC) AS rn FROM rec WHERE flags & 2304 = 0),
p AS (SELECT coalesce(x.name, y.name) AS name, coalesce(x."end", y."end") AS "end", x, y FROM (SELECT * FROM pri WHERE q AND rn = 1) x FULL JOIN (SELECT * FROM pri WHERE NOT q AND rn = 1) y ON x.name = y.name AND x."end" = y."end"),
d AS (SELECT name, "end", x.idx IS NOT NULL AND y.idx IS NOT NULL AS pair, x.flags & 4 = 0 AS qm, y.flags & 4 = 0 AS bm, x, y,
  x.ref_id <> y.ref_id OR x.pos <> y.pos AS pos_diff, x.clip <> y.clip AS cigar_diff, x.mapq <> y.mapq AS mapq_diff, x.flags <> y.flags AS flag_diff, x.nm <> y.nm OR x.xa IS DISTINCT FROM y.xa AS tag_diff FROM p),
cl AS (SELECT *, CASE WHEN y.idx IS NULL OR (pair AND qm AND NOT bm) THEN ['mapped_only_query'] WHEN x.idx IS NULL OR (pair AND bm AND NOT qm) THEN ['mapped_only_baseline']
  WHEN qm THEN list_filter([CASE WHEN pos_diff THEN 'pos_diff' END, CASE WHEN cigar_diff THEN 'cigar_diff' END, CASE WHEN mapq_diff THEN 'mapq_diff' END, CASE WHEN flag_diff THEN 'flag_diff' END, CASE WHEN tag_diff THEN 'tag_diff' END], lambda z: z IS NOT NULL)
  ELSE list_filter([CASE WHEN flag_diff THEN 'flag_diff' END, CASE WHEN tag_diff THEN 'tag_diff' END], lambda z: z IS NOT NULL) END AS diffs FROM d)"""


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    q, b = v_records(spark, sf)
    return C.classified(C.primary_pairs(C.by_name(q, b)))


# Trials


@query(f"""WITH {_T}, n AS (SELECT sample, arch, min(wall_seconds) AS w, min(process_seconds) AS p FROM t WHERE run_sha = 'R' AND wall_seconds > 0 GROUP BY ALL),
o AS (SELECT sample, arch, min(wall_seconds) AS w, min(process_seconds) AS p FROM t WHERE run_sha = 'A' AND wall_seconds > 0 GROUP BY ALL),
m AS (SELECT sample, arch, min(wall_seconds) AS w FROM t WHERE run_sha = 'N' AND wall_seconds > 0 GROUP BY ALL)
SELECT n.sample, n.arch, n.w AS candidate_s, n.p AS candidate_process_s, o.w AS baseline_s, o.p AS baseline_process_s, round(o.w / n.w, 9) AS speedup, round(o.p / n.p, 9) AS process_speedup, m.w AS third_s, round(m.w / n.w, 9) AS third_speedup
FROM n LEFT JOIN o USING (sample, arch) LEFT JOIN m USING (sample, arch)""")
def speedup_min_wall(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(perf.speedup_table(v_trials(spark, sf), "R", "A", "N"), "speedup", "process_speedup", "third_speedup")


@query(f"""WITH {_T}, {_CMP} SELECT t.sample, t.arch, t.rep, t.wall_seconds, t.process_seconds, t.index_read_seconds, t.max_rss_mb, t.cpu_time, t.io_read_mb, t.io_write_mb, c.concordance_pct, c.total AS comp_total
FROM t LEFT JOIN c ON c.trial_id = t.id AND c.kind = 'vs-baseline' WHERE run_sha = 'R'""")
def summary_left_on_kind(spark: SparkSession, sf: str) -> DataFrame:
    return perf.summary(v_trials(spark, sf), v_comparisons(spark, sf), "R")


@query(f"""WITH {_T}, o AS (SELECT sample, arch, min(wall_seconds) AS baseline_s FROM t WHERE run_sha = 'A' AND wall_seconds > 0 GROUP BY ALL)
SELECT sample, arch, rep, wall_seconds, max_rss_mb, io_read_mb, io_write_mb, cpu_time, baseline_s, round(baseline_s / wall_seconds, 9) AS speedup FROM t LEFT JOIN o USING (sample, arch) WHERE run_sha = 'R'""")
def performance_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(perf.metric_table(v_trials(spark, sf), "R", "A"), "speedup")


@query(f"""WITH {_T}, x AS (SELECT run_sha, sample, arch, count(wall_seconds) AS n, median(wall_seconds) AS median, min(wall_seconds) AS min, max(wall_seconds) AS max,
  CASE WHEN count(wall_seconds) < 2 THEN 0.0 ELSE stddev_samp(wall_seconds) / avg(wall_seconds) * 100 END AS cv, array_to_string(list_sort(list(DISTINCT coalesce(image_variant, ''))), '+') AS variant FROM t GROUP BY ALL),
j AS (SELECT a.sample, a.arch, a.n AS n_new, a.median AS median_new, a.min AS min_new, a.max AS max_new, round(a.cv, 6) AS cv_pct_new, a.variant AS variant_new, b.n AS n_prev, b.median AS median_prev, b.min AS min_prev, b.max AS max_prev, round(b.cv, 6) AS cv_pct_prev, b.variant AS variant_prev,
  (a.median - b.median) / b.median * 100 AS d FROM (FROM x WHERE run_sha = 'R') a LEFT JOIN (FROM x WHERE run_sha = 'A') b USING (sample, arch))
SELECT * EXCLUDE (d), round(d, 9) AS delta_pct, CASE WHEN variant_prev IS NOT NULL AND variant_new <> variant_prev THEN 'variant_changed' WHEN d IS NULL THEN 'new_only' WHEN n_new < 2 OR n_prev < 2 THEN 'noisy' WHEN abs(d) <= 5 THEN 'flat'
  WHEN d > 0 THEN CASE WHEN min_new > max_prev THEN 'REGRESSION' ELSE 'noisy' END WHEN max_new < min_prev THEN 'improvement' ELSE 'noisy' END AS verdict FROM j""")
def perf_cells_verdict(spark: SparkSession, sf: str) -> DataFrame:
    t = v_trials(spark, sf)
    out = perf.perf_cells(perf.run_trials(t, "R"), perf.run_trials(t, "A"))
    return rounded(rounded(out, "delta_pct"), "cv_pct_new", "cv_pct_prev", digits=6)


@query(f"WITH {_T} SELECT sample, arch, array_to_string(list_sort(list(DISTINCT coalesce(image_variant, ''))), '+') AS variant FROM t GROUP BY ALL")
def cell_variant_label(spark: SparkSession, sf: str) -> DataFrame:
    return perf.cell_variants(v_trials(spark, sf))


@query(f"""WITH {_T}, v AS (SELECT run_sha, sample, arch, coalesce(image_variant, '') AS variant, count(DISTINCT rep) AS reps, min(rep) AS first FROM t GROUP BY ALL)
SELECT run_sha, sample, arch, string_agg(variant || ':' || reps || ':' || first, ';' ORDER BY variant) AS variants FROM v GROUP BY ALL HAVING count(*) > 1""")
def mixed_variants(spark: SparkSession, sf: str) -> DataFrame:
    text = F.transform("variants", lambda e: F.concat_ws(":", e["variant"], e["reps"].cast("string"), e["first"].cast("string")))
    return perf.mixed_variants(v_trials(spark, sf)).select("run_sha", "sample", "arch", F.array_join(text, ";").alias("variants"))


@query(f"""WITH {_T} SELECT sample, arch, count(wall_seconds) AS reps, median(wall_seconds) AS wall_s, median(process_seconds) AS process_s, median(max_rss_mb) / 1024 AS rss_gb, round(median(cpu_time / (wall_seconds * 16) * 100), 9) AS cpu_efficiency_pct,
CASE WHEN count(wall_seconds) < 2 THEN NULL ELSE round(stddev_samp(wall_seconds) / avg(wall_seconds) * 100, 6) END AS cv_pct FROM t GROUP BY ALL""")
def trial_cells(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rounded(perf.trial_cells(v_trials(spark, sf)), "cpu_efficiency_pct"), "cv_pct", digits=6)


@query("""WITH recent AS (SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC LIMIT 20)
SELECT CAST(l_orderkey AS VARCHAR) AS run_sha, l_returnflag AS sample, l_linestatus AS arch, round(avg(l_extendedprice), 9) AS wall_mean, round(avg(CASE WHEN o.o_orderstatus = 'O' THEN o.o_totalprice END), 9) AS concordance
FROM lineitem l JOIN recent r ON l.l_orderkey = r.o_orderkey JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY ALL""")
def trend_recent_n(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "lineitem").selectExpr("cast(l_orderkey as string) as run_sha", "l_orderkey as id", "l_returnflag as sample", "l_linestatus as arch", "l_extendedprice as wall_seconds")
    c = table(spark, sf, "orders").selectExpr("o_orderkey as trial_id", "case when o_orderstatus = 'O' then 'vs-baseline' else 'other' end as kind", "o_totalprice as concordance_pct")
    return rounded(perf.trend(t, v_runs(spark, sf), c), "wall_mean", "concordance")


@query(f"""WITH {_T}, x AS (SELECT run_sha, sample, arch, rep, epoch_us(measured) / 1e6 AS s FROM t), m AS (SELECT run_sha, median(s) AS middle FROM x GROUP BY ALL)
SELECT run_sha, sample, arch, rep, round((s - middle) / 3600, 6) AS hours_late FROM x JOIN m USING (run_sha) WHERE abs((s - middle) / 3600) > 24""")
def late_cells(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(perf.late_cells(v_trials(spark, sf)), "hours_late", digits=6)


@query("SELECT event_type, user_id % 7 AS bucket, median(value) AS median FROM events GROUP BY ALL")
def exact_medians(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("bucket", F.col("user_id") % 7)
    return S.exact_medians(e, ("event_type", "bucket"), "value")


@query("""WITH keep AS (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC LIMIT 100)
SELECT CAST(o_orderkey AS VARCHAR) AS run_sha, o_orderdate AS submitted_at FROM orders WHERE o_orderkey NOT IN (FROM keep) AND o_orderpriority <> '1-URGENT'""")
def retention_topk(spark: SparkSession, sf: str) -> DataFrame:
    runs = v_runs(spark, sf)
    return perf.keep_latest(runs, 100, runs.filter("status = '1-URGENT'")).select("run_sha", "submitted_at")


@query("""SELECT sample, arch, tool, rep, by_class_json FROM (SELECT CAST(user_id AS VARCHAR) AS sample, event_type AS arch, 'candidate' AS tool, event_id AS rep, props AS by_class_json,
row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events WHERE value > 5) WHERE rn = 1""")
def first_usable_payload(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").selectExpr("cast(user_id as string) as sample", "event_type as arch", "'candidate' as tool", "event_id as rep", "case when value > 5 then props end as by_class_json")
    return perf.first_usable(rows)


@query("SELECT event_type, r.user_id AS user_id, r.event_id AS event_id, r.value AS value FROM (SELECT event_type, arg_min({'value': value, 'event_id': event_id, 'user_id': user_id}, {'value': value, 'event_id': event_id}) AS r FROM events GROUP BY ALL)")
def min_row_struct(spark: SparkSession, sf: str) -> DataFrame:
    return sets.lowest(table(spark, sf, "events").select("event_type", "user_id", "event_id", "value"), ["event_type"], ["value", "event_id"])


# Arena


@query(f"WITH {_A} SELECT arch, label, mode, w AS median_wall_s, p AS median_process_s, n_reps, n_skipped, cold_runs, thp AS thp_fallback FROM m")
def arena_medians(spark: SparkSession, sf: str) -> DataFrame:
    return arena.medians(arena.arena_rows(v_arena(spark, sf), "x"))


@query(f"WITH {_A} SELECT arch, label, mode, rep, cold FROM a")
def arena_cold_mask(spark: SparkSession, sf: str) -> DataFrame:
    return arena.arena_rows(v_arena(spark, sf), "x").select("arch", "label", "mode", "rep", "cold")


@query(f"WITH {_A} SELECT arch, label, mode, w AS median_wall_s, prior AS prior_label FROM ch")
def arena_predecessor(spark: SparkSession, sf: str) -> DataFrame:
    m = arena.medians(arena.arena_rows(v_arena(spark, sf), "x"))
    return arena.predecessors(m, v_ladder(spark)).select("arch", "label", "mode", "median_wall_s", "prior_label")


_PAIR = f"""WITH {_A}, pr AS (SELECT arch || '|' || label || '|' || mode AS pair, arch, mode, prior, label FROM ch WHERE prior IS NOT NULL),
one AS (SELECT pair, pr.arch, pr.mode, pr.label, a.*  EXCLUDE (arch, mode, label), a.label = prior AS is_prior FROM pr JOIN a ON a.arch = pr.arch AND a.mode = pr.mode AND a.label IN (pr.prior, pr.label)),
arms AS (SELECT pair, arch, mode, label, count(DISTINCT block) = 1 AND count(*) FILTER (block IS NULL) = 0 AS same, median(CASE WHEN is_prior THEN wall_seconds END) / median(CASE WHEN NOT is_prior THEN wall_seconds END) AS far,
  median(CASE WHEN is_prior THEN process_seconds END) / median(CASE WHEN NOT is_prior THEN process_seconds END) AS farp FROM one GROUP BY ALL),
rd AS (SELECT x.pair, NOT x.cold AND NOT y.cold AND x.wall_seconds IS NOT NULL AND y.wall_seconds IS NOT NULL AS clean, x.wall_seconds / y.wall_seconds AS r, x.process_seconds / y.process_seconds AS q, x.position < y.position AS leads, abs(x.position - y.position) = 1 AS nx
  FROM (FROM one WHERE is_prior) x JOIN (FROM one WHERE NOT is_prior) y ON x.pair = y.pair AND x.rep = y.rep),
ag AS (SELECT pair, count(*) AS scheduled, count(*) FILTER (clean) AS rounds, bool_and(nx) FILTER (clean) AS adj, count(DISTINCT leads) FILTER (clean) < 2 AS lone, median(r) FILTER (clean) AS m, median(q) FILTER (clean) AS mq,
  coalesce(sqrt(median(r) FILTER (clean AND leads) * median(r) FILTER (clean AND NOT leads)), median(r) FILTER (clean)) AS lb, coalesce(sqrt(median(q) FILTER (clean AND leads) * median(q) FILTER (clean AND NOT leads)), median(q) FILTER (clean)) AS lbq,
  min(r) FILTER (clean) AS low, max(r) FILTER (clean) AS high FROM rd GROUP BY pair),
res AS (SELECT pair, arch, label, mode, CASE WHEN NOT same THEN far WHEN rounds > 0 THEN CASE WHEN adj THEN lb ELSE m END END AS ratio, CASE WHEN NOT same THEN farp WHEN rounds > 0 THEN CASE WHEN adj THEN lbq ELSE mq END END AS process_ratio,
  CASE WHEN same AND rounds > 0 THEN low END AS low, CASE WHEN same AND rounds > 0 THEN high END AS high, CASE WHEN same THEN coalesce(rounds, 0) ELSE 0 END AS rounds,
  CASE WHEN NOT same THEN 'unpaired' WHEN coalesce(rounds, 0) = 0 THEN 'inconclusive' WHEN scheduled < 3 THEN 'context' WHEN rounds < 3 OR (high - low) / (CASE WHEN adj THEN lb ELSE m END) > 0.05 OR (adj AND lone) THEN 'inconclusive' WHEN adj THEN 'paired' ELSE 'same-round' END AS note
  FROM arms LEFT JOIN ag USING (pair))"""


@query(f"{_PAIR} SELECT pair, round(ratio, 9) AS ratio, round(process_ratio, 9) AS process_ratio, round(low, 9) AS low, round(high, 9) AS high, rounds, note FROM res")
def paired_ratio(spark: SparkSession, sf: str) -> DataFrame:
    rows = materialize(arena.arena_rows(v_arena(spark, sf), "x"), "arena_rows")
    stats = materialize(arena.arm_stats(rows), "arm_stats")
    chain = arena.predecessors(stats, v_ladder(spark)).filter("prior_label is not null")
    pairs = chain.select(F.concat_ws("|", "arch", "label", "mode").alias("pair"), "arch", "prior_label", F.col("mode").alias("prior_mode"), F.col("label").alias("this_label"), F.col("mode").alias("this_mode"))
    return rounded(arena.paired_ratios(rows, pairs, stats), "ratio", "process_ratio", "low", "high")


@query(f"""{_PAIR}, own AS (SELECT arch, w AS own FROM m WHERE label = 'candidate' AND mode = 'default')
SELECT m.arch, m.label, m.mode, w AS median_wall_s, p AS median_process_s, n_reps, n_skipped, cold_runs, thp AS thp_fallback, round(ratio, 9) AS vs_prior_release, round(process_ratio, 9) AS vs_prior_process, round(low, 9) AS prior_min, round(high, 9) AS prior_max, rounds AS prior_rounds, note AS prior_note,
CASE WHEN m.label = 'baseline' THEN round(own / w, 9) END AS vs_candidate FROM m LEFT JOIN res USING (arch, label, mode) LEFT JOIN own ON own.arch = m.arch""")
def arena_table(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(arena.arena_table(arena.arena_rows(v_arena(spark, sf), "x"), v_ladder(spark)), "vs_prior_release", "vs_prior_process", "prior_min", "prior_max", "vs_candidate")


@query(f"""WITH {_A}, x AS (SELECT CASE WHEN rnk = 7 THEN 'candidate' ELSE 'v' || rnk END AS label, rnk, max(CASE WHEN mode = 'default' THEN w END) AS stock, max(CASE WHEN mode = 'fast' THEN w END) AS fast FROM m WHERE arch = 'F' AND rnk <> 6 GROUP BY ALL),
bs AS (SELECT max(w) AS base FROM m WHERE arch = 'F' AND label = 'baseline' AND mode = 'default')
SELECT label, CASE WHEN rnk = 7 THEN 6 ELSE rnk END AS rank, stock AS stock_median_wall_s, round(base / stock, 9) AS stock_speedup, fast AS fast_median_wall_s, round(base / fast, 9) AS fast_speedup,
round(lag(stock) OVER (ORDER BY rnk) / stock, 9) AS stock_vs_prev_speedup, round(lag(fast) OVER (ORDER BY rnk) / fast, 9) AS fast_vs_prev_speedup FROM x, bs""")
def release_speedup(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(arena.release_speedup(arena.arena_rows(v_arena(spark, sf), "x"), v_ladder(spark), "F"), "stock_speedup", "fast_speedup", "stock_vs_prev_speedup", "fast_vs_prev_speedup")


# Gates


@query(f"WITH {_S} SELECT sample, arch, threads, round(eff, 9) AS efficiency_pct, t_s FROM e WHERE sha = 'new'")
def scaling_efficiency(spark: SparkSession, sf: str) -> DataFrame:
    s = v_scaling(spark, sf)
    return rounded(gates.efficiencies(s, "new"), "efficiency_pct")


@query(f"""WITH {_S}, b AS (SELECT *, max(eff) OVER (PARTITION BY sample, arch) AS top FROM e WHERE sha = 'prev')
SELECT a.sample, a.arch, a.threads, round(a.eff, 9) AS efficiency_pct_new, a.t_s AS t_s_new, round(b.eff, 9) AS efficiency_pct_prev, b.t_s AS t_s_prev, round(b.eff - a.eff, 9) AS drop_pp, round((a.t_s - b.t_s) / b.t_s * 100, 9) AS abs_delta_pct,
CASE WHEN top > 102 THEN 'absolute' ELSE 'efficiency' END AS basis, CASE WHEN (top > 102 AND (a.t_s - b.t_s) / b.t_s * 100 > 5) OR (top <= 102 AND b.eff - a.eff > 3) THEN 'REGRESSION' ELSE 'ok' END AS verdict FROM e a JOIN b USING (sample, arch, threads) WHERE a.sha = 'new'""")
def scaling_gate(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gates.scaling_gate(v_scaling(spark, sf), "new", "prev"), "efficiency_pct_new", "efficiency_pct_prev", "drop_pp", "abs_delta_pct")


def _registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(["1", "2", "3"], "concordance", 0.02, True), ([], "concordance", 0.01, False), (["4", "5"], "confident_relocation", 40.0, False), (["6"], "confident_relocation", 10.0, True)], "samples array<string>, metric string, expected_drift_pct double, gating boolean")


_REG = "reg AS (SELECT * FROM (VALUES (['1', '2', '3'], 'concordance', 0.02::DOUBLE, TRUE), ([]::VARCHAR[], 'concordance', 0.01::DOUBLE, FALSE), (['4', '5'], 'confident_relocation', 40.0::DOUBLE, FALSE), (['6'], 'confident_relocation', 10.0::DOUBLE, TRUE)) r(samples, metric, pct, gating))"
_DRIFT = "dr AS (SELECT sample, arch, min(concordance_pct) AS conc, max(relocated) AS reloc, count(*) FILTER (relocated IS NULL) AS miss FROM t JOIN c ON c.trial_id = t.id AND kind = 'vs-baseline' GROUP BY ALL)"


@query(f"WITH {_T}, {_CMP}, {_DRIFT} SELECT sample, arch, conc AS baseline_concordance, reloc AS placement_relocated_pct, miss AS placement_missing FROM dr")
def json_max_with_missing(spark: SparkSession, sf: str) -> DataFrame:
    return gates.drift(v_trials(spark, sf), v_comparisons(spark, sf))


@query(f"""WITH {_T}, {_CMP}, {_DRIFT}, {_REG}, x AS (SELECT d.*, r.metric AS em, r.pct, r.gating FROM dr d LEFT JOIN reg r ON len(r.samples) = 0 OR list_contains(r.samples, d.sample)),
k AS (SELECT sample, arch, CASE WHEN bool_or(em = 'confident_relocation') THEN 'confident_relocation' ELSE 'concordance' END AS metric FROM x GROUP BY ALL),
z AS (SELECT x.sample, x.arch, k.metric, coalesce(sum(pct) FILTER (em = k.metric), 0) AS allowed, coalesce(bool_and(NOT gating) FILTER (em = k.metric), FALSE) AS ro FROM x JOIN k USING (sample, arch) GROUP BY ALL),
o AS (SELECT sample, arch, metric, conc, CASE WHEN metric = 'concordance' THEN 100.0 - conc WHEN miss = 0 THEN reloc END AS obs, allowed, ro FROM dr JOIN z USING (sample, arch))
SELECT sample, arch, metric, conc AS baseline_concordance, round(obs, 9) AS observed_drift_pct, round(allowed, 9) AS allowed_drift_pct, CASE WHEN obs IS NULL THEN 'missing_placement' WHEN obs > allowed + 0.05 THEN 'over_budget' ELSE 'ok' END AS verdict, CASE WHEN ro THEN 'report-only' ELSE 'gate' END AS gating FROM o""")
def budget_scoped_sum(spark: SparkSession, sf: str) -> DataFrame:
    cells = gates.drift(v_trials(spark, sf), v_comparisons(spark, sf))
    return rounded(gates.budget_gate(cells, _registry(spark)), "observed_drift_pct", "allowed_drift_pct")


@query(f"WITH {_T}, a AS (SELECT DISTINCT sample, arch FROM t WHERE run_sha = 'R'), b AS (SELECT DISTINCT sample, arch FROM t WHERE run_sha = 'N' AND CAST(sample AS INTEGER) % 3 <> 0) FROM a ANTI JOIN b USING (sample, arch)")
def missing_cells_anti(spark: SparkSession, sf: str) -> DataFrame:
    t = v_trials(spark, sf)
    return gates.missing_cells(perf.run_trials(t, "R"), perf.run_trials(t, "N").filter("cast(sample as int) % 3 <> 0"))


@query(f"WITH {_T}, a AS (SELECT DISTINCT sample, arch FROM t WHERE run_sha = 'R'), b AS (SELECT DISTINCT sample, arch FROM t WHERE run_sha = 'N' AND wall_seconds > 80) FROM a SEMI JOIN b USING (sample, arch)")
def expected_cells_semi(spark: SparkSession, sf: str) -> DataFrame:
    t = v_trials(spark, sf)
    return gates.expected_cells(perf.run_trials(t, "R"), perf.run_trials(t, "N").filter("wall_seconds > 80"))


@query(f"WITH {_T}, {_CMP} SELECT sample, arch, round(min(concordance_pct + 0.0977), 9) AS worst FROM t JOIN c ON c.trial_id = t.id AND kind = 'vs-golden' GROUP BY ALL HAVING min(concordance_pct + 0.0977) < 99.999")
def golden_gate(spark: SparkSession, sf: str) -> DataFrame:
    own = v_trials(spark, sf).join(v_comparisons(spark, sf).filter("kind = 'vs-golden'"), F.col("id") == F.col("trial_id"))
    return rounded(gates.golden_failures(own.withColumn("concordance_pct", F.col("concordance_pct") + 0.0977)), "worst")


@query(f"WITH {_T}, {_CMP}, x AS (SELECT DISTINCT sample, arch, rep FROM t), y AS (SELECT DISTINCT sample, arch, rep FROM t JOIN c ON c.trial_id = t.id AND kind = 'vs-golden') SELECT sample, arch, count(*) AS missing_reps FROM (FROM x ANTI JOIN y USING (sample, arch, rep)) GROUP BY ALL")
def golden_missing_reps(spark: SparkSession, sf: str) -> DataFrame:
    t = v_trials(spark, sf)
    own = t.join(v_comparisons(spark, sf).filter("kind = 'vs-golden'"), F.col("id") == F.col("trial_id"))
    return gates.golden_missing(t.select("sample", "arch", "rep").distinct(), own)


@query("SELECT DISTINCT k FROM (SELECT o_orderkey AS k FROM orders UNION ALL SELECT user_id FROM events) ANTI JOIN (SELECT l_orderkey AS k FROM lineitem) USING (k)")
def golden_completeness(spark: SparkSession, sf: str) -> DataFrame:
    named = lambda n, c: table(spark, sf, n).select(F.col(c).alias("k"))
    return sets.completeness([named("orders", "o_orderkey"), named("events", "user_id")], named("lineitem", "l_orderkey"), ["k"])


def v_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Grade tables from events: two confident bins and one that is not; some do not add up, as those of events without k."""
    k, v = "cast(get_json_object(props, '$.k') as bigint)", "cast(floor(value) as bigint)"
    return table(spark, sf, "events").selectExpr(
        "case when event_id % 2 = 0 then 'new' else 'prev' end as run_sha",
        "event_type as sample",
        "cast(user_id % 40 as string) as arch",
        "event_id as rep",
        "'candidate' as tool",
        f"""case when {k} is null or user_id % 13 = 0 and {k} > 90 then '{{"all": {{"total": 0}}, "bins": {{}}}}'
        else concat('{{"all": {{"total": ', 1000 + {k}, ', "correct": ', 900 + {k}, ', "mismapped": ', 50 + {k} % 3, '}}, "bins": {{"0-19": {{"total": 100, "correct": 50, "mismapped": 40}}, "20-59": {{"total": ', 300, ', "correct": 290, "mismapped": ', {k} % 3, '}}, "60+": {{"total": ', 600 + {k}, ', "correct": ', 560 + {k}, ', "mismapped": 10}}}}}}') end as placement_json""",
    )


_ACC = """ac AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'new' ELSE 'prev' END AS sha, event_type AS sample, CAST(user_id % 40 AS VARCHAR) AS arch, event_id AS rep, CAST(json_extract(props, '$.k') AS BIGINT) AS k, user_id FROM events),
mt AS (SELECT *, CASE WHEN user_id % 13 = 0 AND k > 90 THEN NULL ELSE (k % 3 + 10) / (1000.0 + k)::DOUBLE * 1e6 END AS mm, CASE WHEN user_id % 13 = 0 AND k > 90 THEN NULL ELSE (850.0 + k)::DOUBLE / (1000 + k) * 100.0 END AS cc FROM ac),
gr AS (SELECT sha, sample, arch, count(DISTINCT rep) AS n, CASE WHEN count(*) FILTER (mm IS NULL) = 0 THEN median(mm) END AS mm, CASE WHEN count(*) FILTER (cc IS NULL) = 0 THEN median(cc) END AS cc FROM mt GROUP BY ALL)"""


@query(f"WITH {_ACC} SELECT sample, arch, rep, round(mm, 9) AS mismapped_ppm, round(cc, 9) AS correct_pct, CASE WHEN mm IS NULL THEN 0 ELSE 1000 + k END AS read_total FROM mt")
def mapq_bins_confident(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gates.placement_metrics(v_accuracy(spark, sf)).select("sample", "arch", "rep", "mismapped_ppm", "correct_pct", "read_total"), "mismapped_ppm", "correct_pct")


@query(f"""WITH {_ACC}, j AS (SELECT a.sample, a.arch, a.n AS n_new, a.mm AS mn, a.cc AS cn, b.n AS n_prev, b.mm AS mp, b.cc AS cp FROM gr a LEFT JOIN (FROM gr WHERE sha = 'prev') b USING (sample, arch) WHERE a.sha = 'new')
SELECT sample, arch, n_new, round(mn, 9) AS mismapped_ppm_new, round(cn, 9) AS correct_pct_new, n_prev, round(mp, 9) AS mismapped_ppm_prev, round(cp, 9) AS correct_pct_prev,
CASE WHEN n_prev IS NULL AND mn IS NULL THEN 'candidate_unreadable' WHEN n_prev IS NULL THEN 'new_only' WHEN mn IS NULL AND mp IS NULL THEN 'both_unreadable' WHEN mn IS NULL THEN 'candidate_unreadable' WHEN mp IS NULL THEN 'prior_unreadable'
WHEN mn > mp * 1.02 + 1.0 + 1e-9 OR cn < cp - 0.02 - 1e-9 THEN 'REGRESSION' ELSE 'ok' END AS verdict FROM j""")
def grade_gate(spark: SparkSession, sf: str) -> DataFrame:
    a = v_accuracy(spark, sf)
    both = [gates.placement_metrics(a.filter(F.col("run_sha") == s)) for s in ("new", "prev")]
    return rounded(gates.grade_gate(*both), "mismapped_ppm_new", "correct_pct_new", "mismapped_ppm_prev", "correct_pct_prev")


_NINE = ("placement_correct_pct", "placement_mismapped_pct", "placement_unmapped_pct", "variant_bearing_reads", "md_concordant_pct", "nm_concordant_pct", "meth_n_cpg", "meth_pearson_r", "meth_rmse")


@query("SELECT CAST(label % 5 AS VARCHAR) AS sample, 'a' AS arch, CASE label % 3 WHEN 0 THEN 'baseline' WHEN 1 THEN 'candidate' ELSE 'other' END AS tool, " + ", ".join(f"round(avg(embedding[{k + 1}]), 9) AS {c}" for k, c in enumerate(_NINE)) + " FROM embeddings WHERE label IS NOT NULL GROUP BY ALL")
def accuracy_avg(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").filter("label is not null")
    rows = e.select(F.lit("x").alias("run_sha"), (F.col("label") % 5).cast("string").alias("sample"), F.lit("a").alias("arch"), F.when(F.col("label") % 3 == 0, "baseline").when(F.col("label") % 3 == 1, "candidate").otherwise("other").alias("tool"), *(F.get("embedding", F.lit(k)).alias(c) for k, c in enumerate(_NINE)))
    return rounded(release.accuracy_headline(rows, "x"), *_NINE)


# Records


@query(f"WITH {_E} SELECT count(*) AS total_reads, count(*) FILTER (len(diffs) = 0) AS concordant, round(count(*) FILTER (len(diffs) = 0) / count(*)::DOUBLE * 100, 9) AS concordance_pct FROM cl")
def concordance_totals(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.totals(_pairs(spark, sf)), "concordance_pct")


@query(f'WITH {_E}, n AS (SELECT count(*) AS total FROM cl), u AS (SELECT unnest(list_distinct(diffs)) AS "class" FROM cl) SELECT "class", count(*) AS "count", round(count(*) / any_value(total)::DOUBLE * 100, 9) AS pct FROM u, n GROUP BY "class"')
def concordance_by_class(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.by_class(_pairs(spark, sf)), "pct")


@query(f'WITH {_E} SELECT name, "end", array_to_string(diffs, \'|\') AS diffs FROM cl')
def lockstep_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).select("name", F.col("end").cast("int").alias("end"), F.array_join("diffs", "|").alias("diffs"))


_PLACE = """pl AS (SELECT *, pair AND qm AND x.mapq >= 20 OR (y.idx IS NULL AND qm AND x.mapq >= 20) AS cq, pair AND bm AND y.mapq >= 20 OR (x.idx IS NULL AND bm AND y.mapq >= 20) AS cb,
  CASE WHEN x.flags & 16 <> 0 THEN x.pos + (75 - x.clip) - 1 ELSE x.pos - x.clip END AS q5, CASE WHEN y.flags & 16 <> 0 THEN y.pos + (75 - y.clip) - 1 ELSE y.pos - y.clip END AS b5 FROM cl),
po AS (SELECT CASE WHEN cq AND cb THEN 'both' WHEN cq THEN 'query_only' WHEN cb THEN 'baseline_only' END AS side, CASE WHEN pair AND qm AND bm AND x.ref_id = y.ref_id AND (x.flags & 16) = (y.flags & 16) AND abs(q5 - b5) <= 10 THEN CASE WHEN q5 = b5 THEN 'same' ELSE 'shifted' END ELSE 'relocated' END AS outcome FROM pl)"""


@query(f"WITH {_E}, {_PLACE} SELECT s.side, count(outcome) AS confident_reads, count(*) FILTER (outcome = 'shifted') AS shifted, count(*) FILTER (outcome = 'relocated') AS relocated, round(count(*) FILTER (outcome = 'relocated') / nullif(count(outcome), 0)::DOUBLE * 100, 9) AS relocated_pct FROM (VALUES ('both'), ('query_only'), ('baseline_only')) s(side) LEFT JOIN po ON po.side = s.side GROUP BY s.side")
def placement_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.placements(_pairs(spark, sf)), "relocated_pct")


@query(f"""WITH {_E}, dt AS (SELECT tag, count(*) FILTER (how = 'v') AS value_diff, count(*) FILTER (how = 'q') AS query_only, count(*) FILTER (how = 'b') AS baseline_only FROM
(SELECT 'NM' AS tag, CASE WHEN x.nm <> y.nm THEN 'v' END AS how FROM cl WHERE pair AND qm = bm UNION ALL SELECT 'XA', CASE WHEN x.xa IS NULL AND y.xa IS NOT NULL THEN 'b' WHEN y.xa IS NULL AND x.xa IS NOT NULL THEN 'q' WHEN x.xa <> y.xa THEN 'v' END FROM cl WHERE pair AND qm = bm) GROUP BY tag),
pr AS (SELECT tag, count(*) FILTER (q) AS query_present, count(*) FILTER (NOT q) AS baseline_present FROM (SELECT 'NM' AS tag, q FROM rec UNION ALL SELECT 'XA', q FROM rec WHERE xa IS NOT NULL) GROUP BY tag)
SELECT tag, query_present, baseline_present, value_diff, query_only, baseline_only, tag = 'XA' AS ignored FROM pr JOIN dt USING (tag)""")
def tags_two_populations(spark: SparkSession, sf: str) -> DataFrame:
    q, b = v_records(spark, sf)
    return C.by_tag(_pairs(spark, sf), q, b, R.CompareOptions(ignore_tags=frozenset({"XA"})))


_CENSUS = """ce AS (SELECT CASE WHEN NOT pair THEN CASE WHEN coalesce(x.xa, y.xa) IS NULL THEN 'NM' ELSE 'NM|XA' END ELSE array_to_string(list_filter([CASE WHEN x.nm <> y.nm THEN 'NM' END, CASE WHEN x.xa IS DISTINCT FROM y.xa THEN 'XA' END], lambda z: z IS NOT NULL), '|') END AS pattern,
  pair AND len(list_filter(diffs, lambda z: z <> 'tag_diff')) = 0 AS core FROM cl)"""


@query(f"WITH {_E}, {_CENSUS} SELECT pattern, count(*) FILTER (core) AS core_concordant, count(*) FILTER (NOT core) AS core_discordant FROM ce GROUP BY pattern")
def tag_census_patterns(spark: SparkSession, sf: str) -> DataFrame:
    return C.census(_pairs(spark, sf))


@query(f"WITH {_E}, {_CENSUS} SELECT count(*) AS concordant FROM ce WHERE core AND NOT list_contains(string_split(pattern, '|'), 'NM')")
def policy_what_if(spark: SparkSession, sf: str) -> DataFrame:
    return C.what_if(C.census(_pairs(spark, sf)), {"NM"})


@query(f"""WITH {_E}, seen AS (SELECT 'NM' AS tag FROM rec WHERE nm IS NOT NULL UNION SELECT 'XA' FROM rec WHERE xa IS NOT NULL), ex(tag) AS (VALUES ('NM')), ig(tag) AS (VALUES ('ZZ')), ok(tag) AS (VALUES ('YY'))
SELECT tag, 'unexpected' AS violation FROM seen WHERE tag NOT IN (FROM ex) AND tag NOT IN (FROM ig) UNION ALL SELECT tag, 'dead_ignore' FROM ig WHERE tag NOT IN (FROM seen) AND tag NOT IN (FROM ok) UNION ALL SELECT tag, 'redundant_absent_ok' FROM ok WHERE tag NOT IN (FROM ig)""")
def tag_guard(spark: SparkSession, sf: str) -> DataFrame:
    q, b = v_records(spark, sf)
    opts = R.CompareOptions(expect_tags=frozenset({"NM"}), ignore_tags=frozenset({"ZZ"}), absent_ok_tags=frozenset({"YY"}))
    return C.guard(C.by_tag(_pairs(spark, sf), q, b, opts), opts)


# Json, sets, writes


@query("SELECT event_type AS \"class\", CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS \"count\" FROM events GROUP BY ALL")
def json_class_sum(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    rows = table(spark, sf, "events").select(F.concat(F.lit('{"'), F.col("event_type"), F.lit('": {"count": '), k, F.lit(', "pct": 1.5}}')).alias("by_class_json"))
    return release.class_counts(rows)


@query("SELECT o_custkey AS k, arg_max({'s': o_orderstatus, 'p': o_totalprice}, o_orderkey).s AS o_orderstatus, arg_max({'s': o_orderstatus, 'p': o_totalprice}, o_orderkey).p AS o_totalprice FROM orders GROUP BY ALL")
def latest_wins_upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderstatus", "o_totalprice", F.col("o_orderkey").alias("seq"))
    return latest.latest_wins(rows, ("k",), "seq")


@query("SELECT o_custkey AS k, arg_max(b, o_orderkey) FILTER (b IS NOT NULL) AS branch, arg_max(o_orderpriority, o_orderkey) AS status FROM (SELECT *, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS b FROM orders) GROUP BY ALL")
def coalesce_upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").selectExpr("o_custkey as k", "case when o_orderstatus = 'O' then o_orderpriority end as branch", "o_orderpriority as status", "o_orderkey as seq")
    return latest.merge_non_null(rows, ("k",), "seq", overwrite=("status",))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'O' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')")
def replace_partition(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return latest.replace_partitions(o.filter("o_orderstatus <> 'O'").drop("o_orderstatus"), o.filter("o_orderstatus = 'O'").drop("o_orderstatus"), ("o_custkey",))


@query("""WITH x AS (SELECT user_id, event_id, event_type, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS new FROM events)
SELECT user_id, event_id, event_type, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS island FROM x""")
def gaps_and_islands(spark: SparkSession, sf: str) -> DataFrame:
    return sets.islands(table(spark, sf, "events").select("user_id", "event_id", "event_type"), "event_type", "event_id", ["user_id"])


@query("""WITH x AS (SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state, max(event_id) OVER (PARTITION BY user_id) AS top FROM events)
SELECT state, CASE WHEN state = 'FAILED' AND event_id < top THEN 'RETRIED' ELSE state END AS display, count(*) AS n FROM x GROUP BY ALL""")
def retry_chain(spark: SparkSession, sf: str) -> DataFrame:
    jobs = table(spark, sf, "events").selectExpr("event_id", "user_id", "case when event_type = 'error' then 'FAILED' else 'SUCCEEDED' end as state")
    return sets.retry_states(jobs, ["user_id"], "state", "event_id").groupBy("state", "display").agg(F.count("*").alias("n"))


@query("WITH p AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS prefix FROM part), n AS (SELECT DISTINCT p_name FROM part) SELECT p_name, prefix FROM n, p WHERE starts_with(p_name, prefix) OR starts_with(prefix, p_name)")
def prefix_match(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return sets.prefix_match(p.select("p_name").distinct(), p.select(F.split("p_name", " ")[0].alias("prefix")).distinct(), "p_name", "prefix")


@query("""SELECT CASE WHEN a.k IS NULL THEN b.k ELSE a.k END AS k, unnest(list_filter([CASE WHEN b.k IS NULL THEN 'only_left' END, CASE WHEN a.k IS NULL THEN 'only_right' END, CASE WHEN a.n > 1 THEN 'duplicate_left' END, CASE WHEN b.n > 1 THEN 'duplicate_right' END], lambda z: z IS NOT NULL)) AS problem
FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY ALL) a FULL JOIN (SELECT c_custkey AS k, count(*) AS n FROM customer GROUP BY ALL) b ON a.k = b.k""")
def ladder_bijection(spark: SparkSession, sf: str) -> DataFrame:
    return sets.bijection_problems(table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), "k")


@query("SELECT p_type, p_size, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS producers, count(*) AS n FROM part GROUP BY ALL")
def agreement_merge(spark: SparkSession, sf: str) -> DataFrame:
    return sets.agreement(table(spark, sf, "part").withColumn("one", F.lit(1).cast("long")), ["p_type", "p_size"], "p_brand", "one")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS value, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS idx FROM documents)
SELECT doc_id, idx, CASE WHEN idx % 4 IN (1, 3) THEN substr(value, 6) ELSE value END AS value FROM l WHERE (idx // 4) % 3 = 0""")
def fastq_every_nth(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("idx", "value"))
    return sets.every_nth(lines, 3, trim=5).withColumn("idx", F.col("idx").cast("long"))


@query("SELECT l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS n, count(*) AS jobs FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus, l_linenumber), (l_returnflag, l_linestatus), ())")
def job_counts_rollup(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("long").alias("n"))
    return schedule.counts(t, [["l_returnflag", "l_linestatus", "n"], ["l_returnflag", "l_linestatus"], []], "jobs")


# Release documents, labels, jobs


def v_class_json(spark: SparkSession, sf: str) -> DataFrame:
    """Comparisons with class counts and supplementary counts as JSON."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as trial_id",
        "'vs-baseline' as kind",
        "99.9 + o_totalprice / 1e7 as concordance_pct",
        "o_custkey as total",
        "concat('{\"pos_diff\": {\"count\": ', o_custkey, ', \"pct\": ', o_custkey % 50, '.25}', case when o_custkey % 3 = 0 then concat(', \"mapq_diff\": {\"count\": ', o_orderkey, ', \"pct\": 1.5}') else '' end, '}') as by_class_json",
        "case when o_custkey % 2 = 0 then concat('{\"supp_query_total\": ', o_custkey, '}') end as supp_json",
        "cast(null as string) as placement_json",
    )


def _compared(spark: SparkSession, sf: str) -> DataFrame:
    return release.compared(v_trials(spark, sf), v_class_json(spark, sf), "R")


@query(f"""WITH {_T}, x AS (SELECT o_custkey AS c, o_orderkey AS o FROM t JOIN orders ON o_orderkey = id WHERE run_sha = 'R')
SELECT 'pos_diff' AS "class", CAST(sum(c) AS BIGINT) AS "count" FROM x UNION ALL SELECT 'mapq_diff', CAST(sum(o) AS BIGINT) FROM x WHERE c % 3 = 0""")
def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return release.class_counts(_compared(spark, sf))


@query(f"""WITH {_T}, x AS (SELECT sample, arch, o_custkey AS c FROM t JOIN orders ON o_orderkey = id WHERE run_sha = 'R')
SELECT sample, arch, 'pos_diff' AS "class", round(median(c % 50 + 0.25::DOUBLE), 4) AS pct FROM x GROUP BY ALL UNION ALL SELECT sample, arch, 'mapq_diff', 1.5::DOUBLE FROM x WHERE c % 3 = 0 GROUP BY ALL""")
def class_medians(spark: SparkSession, sf: str) -> DataFrame:
    return release.class_medians(_compared(spark, sf))


@query(f"WITH {_T} SELECT sample, arch, o_custkey AS supp_query, 0::BIGINT AS supp_baseline, 0::BIGINT AS count_mismatch, 0::DOUBLE AS unmatched_pct FROM t JOIN orders ON o_orderkey = id WHERE run_sha = 'R' AND o_custkey % 2 = 0")
def supplementary(spark: SparkSession, sf: str) -> DataFrame:
    return release.supplementary(_compared(spark, sf))


@query(f"""WITH {_T}, n AS (SELECT * FROM (VALUES ('v1', 'A'), ('v2', 'R')) v(release, run_sha)), x AS (SELECT release, sample, arg_min({{'p': 99.9 + o_totalprice / 1e7, 'c': o_custkey}}, {{'p': 99.9 + o_totalprice / 1e7, 'a': arch, 'r': rep}}) AS r FROM t JOIN n USING (run_sha) JOIN orders ON o_orderkey = id GROUP BY ALL)
SELECT release, sample, r.p AS concordance_pct, CASE WHEN r.c % 2 = 0 THEN r.c ELSE 0 END AS supp_query, 0::BIGINT AS supp_baseline, 0::BIGINT AS count_mismatch FROM x""")
def release_concordance(spark: SparkSession, sf: str) -> DataFrame:
    return release.release_concordance(v_trials(spark, sf), v_class_json(spark, sf), [("v1", "A"), ("v2", "R")])


@query(f"""WITH {_T}, {_REG}, x AS (SELECT sample, arch, 100.0 - (99.9 + o_totalprice / 1e7) AS d FROM t JOIN orders ON o_orderkey = id WHERE run_sha = 'R'),
k AS (SELECT sample, coalesce(bool_or(r.metric = 'confident_relocation'), FALSE) AS rel, coalesce(sum(pct) FILTER (r.metric = 'concordance'), 0) AS dec FROM (SELECT DISTINCT sample FROM x) LEFT JOIN reg r ON len(r.samples) = 0 OR list_contains(r.samples, sample) GROUP BY ALL)
SELECT round(avg(d), 9) AS mean_drift_pct, round(max(dec), 9) AS declared_pct FROM x JOIN k USING (sample) WHERE NOT rel""")
def drift_against_registry(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(release.drift_against_registry(_compared(spark, sf), _registry(spark)), "mean_drift_pct", "declared_pct")


@query(f"""WITH {_A}, g AS (SELECT arch, label, mode, round(median(wall_seconds), 2) AS wall_s, count(wall_seconds) AS n, max(rep) AS top, count(DISTINCT rep) AS k FROM a GROUP BY ALL)
SELECT arch, label, mode, wall_s, n, CASE WHEN n = 0 THEN 'not measured' WHEN top > 1000 THEN 'wrong round ids' WHEN k < 1000 OR n < 1000 THEN 'partial' END AS problem FROM g""")
def host_walls(spark: SparkSession, sf: str) -> DataFrame:
    return release.host_walls(arena.arena_rows(v_arena(spark, sf), "x"), 1000)


@query("""WITH b AS (SELECT l_linestatus AS arch, l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_discount, l_tax, l_returnflag = 'A' AS sam FROM lineitem WHERE l_returnflag <> 'N'),
n AS (SELECT *, row_number() OVER (PARTITION BY arch, sam ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS rep FROM b),
x AS (SELECT arch, sam, rep, CASE WHEN l_discount = 0 THEN NULL ELSE 100.0::DOUBLE + (CASE WHEN sam THEN 2 ELSE 0 END) + l_tax END AS w, CASE WHEN (rep % 2 = 0) = sam THEN 1 ELSE 2 END AS p FROM n),
r AS (SELECT s.arch, s.w IS NOT NULL AND t.w IS NOT NULL AS clean, s.w / t.w AS r, s.p < t.p AS leads FROM (FROM x WHERE sam) s JOIN (FROM x WHERE NOT sam) t USING (arch, rep))
SELECT arch, 'v1' AS label, round(sqrt(median(r) FILTER (clean AND leads) * median(r) FILTER (clean AND NOT leads)), 9) AS native_saves, NULL::DOUBLE AS process_saves, count(*) FILTER (clean) AS rounds, 'paired' AS note FROM r GROUP BY arch""")
def writer_control(spark: SparkSession, sf: str) -> DataFrame:
    sam = "l_returnflag = 'A'"
    base = table(spark, sf, "lineitem").filter("l_returnflag <> 'N'").selectExpr(f"{sam} as sam", "l_linestatus as arch", *_LINE, "l_tax", "l_discount")
    rows = sets.numbered(base, ["arch", "sam"], _LINE, ["l_tax", "l_discount"], "rep").selectExpr(
        "'x' as run_sha", "arch", "case when sam then 'v1-sam' else 'v1' end as label", "'default' as mode", "rep",
        "case when l_discount = 0 then null else 100.0D + (case when sam then 2 else 0 end) + l_tax end as wall_seconds", "cast(null as double) as process_seconds", "'b' as block",
        "case when (rep % 2 = 0) = sam then 1 else 2 end as position", "1.0D as index_read_seconds", "1.0D as io_in_mb", "cast(null as long) as thp_fault_fallback",
    )
    return rounded(arena.writer_control(arena.arena_rows(rows, "x", controls=True)), "native_saves", "process_saves")


@query("""SELECT p_partkey, CASE WHEN p_partkey >= 10 THEN 'v0.' || (p_partkey // 10) || '.' || (p_partkey % 10) ELSE 'v' || p_partkey || ' (interim build)' END AS version FROM part""")
def label_versions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", L.release_version(F.concat(F.lit("v"), F.col("p_partkey").cast("string"))).alias("version"))


@query("SELECT version, CAST(row_number() OVER (ORDER BY a, b) AS INTEGER) AS rank FROM (SELECT DISTINCT 'v' || (p_size % 12) || '.' || (p_partkey % 15) AS version, p_size % 12 AS a, p_partkey % 15 AS b FROM part)")
def semantic_version_order(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "part").selectExpr("concat('v', p_size % 12, '.', p_partkey % 15) as version").distinct()
    return v.select("version", F.row_number().over(Window.orderBy(sets.version_key(F.col("version")))).alias("rank"))  # a ladder of versions: at most 180


@query("SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, round(sum(o_totalprice), 4) AS amount FROM orders GROUP BY ROLLUP (CAST(CAST(o_orderdate AS DATE) AS VARCHAR))")
def daily_cost(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").selectExpr("cast(cast(o_orderdate as date) as string) as day", "o_totalprice as amount")
    return rounded(schedule.daily_cost(o), "amount", digits=4)


@query("SELECT event_type AS command, CASE WHEN value > 20 THEN 'DONE' ELSE 'FAILED' END AS state, count(*) AS n FROM events GROUP BY ROLLUP (event_type, CASE WHEN value > 20 THEN 'DONE' ELSE 'FAILED' END)")
def job_counts(spark: SparkSession, sf: str) -> DataFrame:
    return schedule.job_counts(table(spark, sf, "events").selectExpr("event_type as command", "case when value > 20 then 'DONE' else 'FAILED' end as state"))


@query("SELECT p_name AS key FROM part WHERE p_brand NOT IN ('Brand#1') AND p_name NOT IN (SELECT p_name FROM part WHERE p_size = 3) AND p_name NOT LIKE '%bolt' AND p_brand IS NOT NULL")
def orphan_files(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return schedule.orphans(p.filter("p_brand <> 'Brand#1'").select(F.col("p_name").alias("key")), p.filter("p_size = 3").select(F.col("p_name").alias("key")).distinct(), p.filter("false").select(F.col("p_name").alias("key")), "bolt$")


@query(f"WITH {_T} SELECT sample, arch, count(DISTINCT rep) AS reps, bool_or(rep = 1) AS first, CASE WHEN NOT bool_or(rep = 1) THEN 'no first replicate' WHEN count(DISTINCT rep) < 100 THEN 'too few replicates' END AS problem FROM t WHERE wall_seconds > 50 GROUP BY ALL")
def golden_promotion(spark: SparkSession, sf: str) -> DataFrame:
    return schedule.promotion(v_trials(spark, sf).filter("wall_seconds > 50"), 100)


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS start, event_type, count(*) AS n, round(sum(value), 6) AS v FROM events GROUP BY ALL")
def windowed_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rounded(windowed(e), "v", digits=6).withColumn("start", F.col("start").cast("timestamp_ntz"))


def entry(spark: SparkSession) -> DataFrame:
    return speedup_min_wall(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


from benchlake import queries_more  # noqa: E402, F401  registers the rest of the catalogue

__all__ = ["entry", "oracle_sql", "queries"]
