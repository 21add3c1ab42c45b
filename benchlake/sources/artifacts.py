"""Parsers of the benchmark artifact tree. Each reads all files of one kind at once: one row per small
file (whole text) or per line, then columns; the partition values come from the path.

Nulls: a value that could not be measured is null. Only ``timing.tsv`` substitutes 0.0, as its
producers always write numbers. Telemetry (probes) is never fatal; malformed grades are.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Artifact names, column names and patterns of the tree's files.
COMPARE_KINDS = ("vs-baseline", "vs-golden", "vs-x86", "vs-default")
SUPP_KEYS = (
    "total_templates",
    "supp_query_total", "supp_baseline_total", "supp_count_mismatch_templates", "supp_count_mismatch_pct", "supp_unmatched", "supp_unmatched_pct", "supp_matched", "supp_content_diffs", "supp_by_class",
    "sec_query_total", "sec_baseline_total", "sec_count_mismatch_templates", "sec_count_mismatch_pct", "sec_unmatched", "sec_unmatched_pct", "sec_matched", "sec_content_diffs", "sec_by_class",
)
TIMING_COLUMNS = ("s", "max_rss", "max_vms", "max_uss", "max_pss", "io_in", "io_out", "mean_load", "cpu_time")
META_COLUMNS = ("sample", "arch", "instance_type", "availability_zone", "instance_id", "kernel", "image_variant", "measured_at")
SCALING_COLUMNS = ("threads", "rep", "wall_s", "cpu_s", "max_rss_mb", "process_s", "main_mem_s", "read_io_s", "sam_io_s", "kernel_s")
ARENA_BASE = ("label", "mode", "rep", "wall_s", "cpu_s", "max_rss_mb", "process_s")
ARENA_EXTRA = ("block", "position", "writer", "index_read_s", "io_in_mb", "page_cache_start_mb", "thp_fault_fallback", "compact_stall", "pgmajfault", "memfree_mb", "anon_huge_mb")
PROCESS_PATTERN = r"(?m)^\s*PROCESS\(\).*?:\s*([0-9.]+)\s*$"
INDEX_READ_PATTERN = r"(?m)^\s*Index read time avg:\s*([0-9.]+),"
REP_PATTERN = "rep-([1-9][0-9]*)"
VARIANT_FOOTERS = ("variant_bearing_reads", "md_concordant_pct", "nm_concordant_pct")

_CELL_PATH = rf"/([^/]+)/([^/]+)/([^/]+)/{REP_PATTERN}/(?:[^/]+/)*[^/]+$"


def decoded(path: Column) -> Column:
    """A path as it was named: the metadata column has it percent-encoded."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def files(spark: SparkSession, root: str | DataFrame, name: str) -> DataFrame:
    """(path, mtime, value): whole small files by glob on their name, at any depth. ``root`` is a folder, or a frame of such
    rows: files that came in a table instead of a tree."""
    if isinstance(root, DataFrame):
        pattern = ".*".join(map(re.escape, name.split("*")))
        return root.filter(F.regexp_extract("path", "([^/]*)$", 1).rlike(f"^{pattern}$"))
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).text(root, wholetext=True)
    return raw.select(decoded(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_modification_time").alias("mtime"), "value")


def cells(df: DataFrame) -> DataFrame:
    """Adds run_sha, sample, arch, rep from ``<sha>/<sample>/<arch>/rep-<n>/``; paths with another
    replicate name (rep-0, rep-01, rep-backup) are left out."""
    keys = {k: F.regexp_extract("path", _CELL_PATH, i + 1) for i, k in enumerate(("run_sha", "sample", "arch"))}
    return df.filter(F.col("path").rlike(_CELL_PATH)).withColumns(keys).withColumn("rep", F.regexp_extract("path", _CELL_PATH, 4).cast("long"))


def run_cells(df: DataFrame, depth: int = 2) -> DataFrame:
    """Adds run_sha, sample, arch (or run_sha, arch) from the directories over a file."""
    names = ("run_sha", "sample", "arch") if depth == 2 else ("run_sha", "arch")
    pattern = "/" + "/".join(["([^/]+)"] * len(names)) + "/[^/]+$"
    return df.withColumns({k: F.regexp_extract("path", pattern, i + 1) for i, k in enumerate(names)})


def lines(value: Column | str = "value") -> Column:
    return F.filter(F.split(value, r"\r?\n"), lambda x: F.trim(x) != "")


def number(x: Column) -> Column:
    """A finite double, else null: "NA", "NaN" and text are null."""
    d = F.trim(x).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d)


def unknown_to_null(x: Column) -> Column:
    """For join columns: hosts that are not known must never match each other."""
    return F.nullif(F.nullif(x, F.lit("unknown")), F.lit(""))


def _fail(condition: Column, what: str, otherwise: Column) -> Column:
    return F.when(condition, F.raise_error(F.concat(F.lit(what + ": "), F.col("path")))).otherwise(otherwise)


def timing(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """timing.tsv: a header and one row; anything that is no number is 0.0."""
    df = cells(files(spark, root, "timing.tsv")).withColumn("l", lines())
    row = _fail(F.size("l") < 2, "no data row", F.map_from_arrays(F.split(F.get("l", F.lit(0)), "\t"), F.slice(F.concat(F.split(F.get("l", F.lit(1)), "\t"), F.array_repeat(F.lit(""), 32)), F.lit(1), F.size(F.split(F.get("l", F.lit(0)), "\t")))))
    value = lambda c: F.coalesce(number(F.try_element_at("m", F.lit(c))), F.lit(0.0)).alias(c)
    return df.withColumn("m", row).select("run_sha", "sample", "arch", "rep", "path", *(value(c) for c in TIMING_COLUMNS))


def meta(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """meta.json: the host. ``instance_id`` is kept as written; ``host`` is null if unknown."""
    schema = ", ".join(f"{c} string" for c in META_COLUMNS)
    df = cells(files(spark, root, "meta.json")).withColumn("j", F.from_json("value", schema))
    host = [F.col(f"j.{c}").alias(c) for c in ("instance_type", "availability_zone", "instance_id", "kernel", "image_variant")]
    stamp = F.when(F.try_to_timestamp("j.measured_at").isNotNull(), F.col("j.measured_at")).otherwise(F.date_format("mtime", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return df.select("run_sha", "sample", "arch", "rep", *host, stamp.alias("measured_at"), unknown_to_null(F.col("j.instance_id")).alias("host"))


def aligner_log(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """Aligner logs: first PROCESS() and index-read seconds, null if missing."""
    df = cells(files(spark, root, "*.stderr.log"))
    found = lambda p: F.nullif(F.regexp_extract("value", p, 1), F.lit("")).try_cast("double")
    return df.select("run_sha", "sample", "arch", "rep", found(PROCESS_PATTERN).alias("process_seconds"), found(INDEX_READ_PATTERN).alias("index_read_seconds"))


def _subset(keys: tuple[str, ...]) -> Column:
    """The keys of a JSON object that are there, as a JSON object, else null."""
    got = F.map_filter(F.from_json("value", "map<string,string>"), lambda k, _: k.isin(*keys))
    raw = F.transform(F.map_entries(got), lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"]))
    return F.when(F.size(got) > 0, F.concat(F.lit("{"), F.array_join(F.array_sort(raw), ", "), F.lit("}")))


def comparisons(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """compare/<kind>.json for the known kinds."""
    df = cells(files(spark, root, "vs-*.json")).withColumn("kind", F.regexp_extract("path", r"/compare/([^/]+)\.json$", 1)).filter(F.col("kind").isin(*COMPARE_KINDS))
    j = F.from_json("value", "total_reads long, concordant long, concordance_pct double")
    placement = F.get_json_object("value", "$.placement")
    return df.withColumn("j", j).select(
        "run_sha", "sample", "arch", "rep", "kind",
        F.col("j.concordant").alias("concordant"), F.col("j.total_reads").alias("total"), F.col("j.concordance_pct").alias("concordance_pct"),
        F.get_json_object("value", "$.by_class").alias("by_class_json"), _subset(SUPP_KEYS).alias("supp_json"), placement.alias("placement_json"),
    )


def _tool(suffix: str) -> Column:
    return F.regexp_extract("path", rf"/([^/]+)\.{suffix}$", 1)


def eval_tables(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """<tool>.eval.txt: MAPQ bins and the ALL row, which must be there."""
    df = cells(files(spark, root, "*.eval.txt")).withColumn("tool", _tool(r"eval\.txt"))
    rows = F.filter(F.transform(lines(), lambda x: F.split(F.trim(x), r"\s+")), lambda r: (F.size(r) >= 4) & (r[0] != "mapq_bin"))
    counts = lambda r: F.struct(*(F.get(r, F.lit(k + 1)).try_cast("long").alias(n) for k, n in enumerate(("total", "correct", "mismapped", "unmapped"))))
    df = df.withColumn("rows", rows).withColumn("all_row", F.get(F.filter("rows", lambda r: r[0] == "ALL"), F.lit(0)))
    bins = F.map_from_entries(F.transform(F.filter("rows", lambda r: r[0] != "ALL"), lambda r: F.struct(r[0], counts(r))))
    checked = _fail(F.col("all_row").isNull(), "no ALL row", counts(F.col("all_row")))
    pct = lambda k: number(F.get("all_row", F.lit(k)))
    return df.withColumn("all", checked).select(
        "run_sha", "sample", "arch", "rep", "tool", F.col("all.total").alias("placement_total"),
        pct(5).alias("placement_correct_pct"), pct(6).alias("placement_mismapped_pct"), pct(7).alias("placement_unmapped_pct"),
        F.to_json(F.struct("all", bins.alias("bins"))).alias("placement_json"),
    )


def variants(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """<tool>.variants.tsv: class rows and a footer of three required ``#key<TAB>value`` lines."""
    df = cells(files(spark, root, "*.variants.tsv")).withColumn("tool", _tool(r"variants\.tsv")).withColumn("l", lines())
    foot = F.map_from_entries(F.transform(F.filter("l", lambda x: x.startswith("#")), lambda x: F.struct(F.regexp_extract(x, r"^#([^\t]+)", 1), F.regexp_extract(x, r"\t(.*)$", 1))))
    rows = F.transform(F.filter("l", lambda x: ~x.startswith("#") & ~x.startswith("class\t")), lambda x: F.split(x, "\t"))
    entry = lambda r: F.struct(*(number(F.get(r, F.lit(k))).alias(n) for k, n in ((2, "n_expected"), (3, "n_represented"), (4, "represented_pct"), (5, "mean_mapq"), (6, "mean_as"))))
    classes = F.map_from_entries(F.transform(rows, lambda r: F.struct(F.concat_ws("|", r[0], r[1]), entry(r))))
    df = df.withColumn("foot", foot)
    lacking = F.size(F.array_except(F.array(*(F.lit(k) for k in VARIANT_FOOTERS)), F.map_keys("foot"))) > 0
    value = lambda k: number(F.try_element_at("foot", F.lit(k)))
    return df.select(
        "run_sha", "sample", "arch", "rep", "tool", _fail(lacking, "footer incomplete", value(VARIANT_FOOTERS[0])).cast("long").alias("variant_bearing_reads"),
        value(VARIANT_FOOTERS[1]).alias("md_concordant_pct"), value(VARIANT_FOOTERS[2]).alias("nm_concordant_pct"), F.to_json(classes).alias("by_class_json"),
    )


def methylation(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """<tool>.meth.tsv: one row; an empty file is a sample without methylation; a header alone is an error."""
    df = cells(files(spark, root, "*.meth.tsv")).withColumn("tool", _tool(r"meth\.tsv")).withColumn("l", lines())
    row = F.when(F.size("l") == 0, F.lit(None).cast("array<string>")).otherwise(_fail(F.size("l") < 2, "header without a row", F.split(F.get("l", F.lit(1)), "\t")))
    df = df.withColumn("r", row)
    return df.select("run_sha", "sample", "arch", "rep", "tool", F.get("r", F.lit(0)).try_cast("long").alias("meth_n_cpg"), number(F.get("r", F.lit(1))).alias("meth_pearson_r"), number(F.get("r", F.lit(2))).alias("meth_rmse"))


def scaling(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """scaling.tsv: six columns and four more in newer files; shorter rows are skipped, NA is null."""
    df = run_cells(files(spark, root, "scaling.tsv")).select("run_sha", "sample", "arch", F.explode(lines()).alias("line"))
    f = df.withColumn("f", F.split("line", "\t")).filter((F.size("f") >= 6) & (F.get("f", F.lit(0)) != "threads"))
    at = lambda k: F.get("f", F.lit(k))
    names = dict(zip(("wall_seconds", "cpu_time", "max_rss_mb", "process_seconds", "main_mem_seconds", "read_io_seconds", "sam_io_seconds", "kernel_seconds"), range(2, 10), strict=True))
    return f.select("run_sha", "sample", "arch", at(0).try_cast("long").alias("threads"), at(1).try_cast("long").alias("rep"), *(number(at(k)).alias(n) for n, k in names.items()))


def renamed(x: Column, names: dict[str, str] | None) -> Column:
    """Labels or tools as the tree has them, by the names that plans use; others stay."""
    return x if not names else F.coalesce(F.try_element_at(F.create_map(*(F.lit(v) for kv in sorted(names.items()) for v in kv)), x), x)


def arena_lines(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """Lines of arena.tsv under their header: (run_sha, arch, h, f). An unknown column is an error."""
    df = run_cells(files(spark, root, "arena.tsv"), depth=1).withColumn("l", lines()).filter(F.size("l") > 1).withColumn("h", F.split(F.get("l", F.lit(0)), "\t"))
    strange = F.array_except("h", F.array(*(F.lit(c) for c in (*ARENA_BASE, *ARENA_EXTRA))))
    lacking = F.array_except(F.array(*(F.lit(c) for c in ARENA_BASE)), "h")
    df = df.withColumn("h", _fail(F.size(strange) > 0, "unknown column", _fail(F.size(lacking) > 0, "missing column", F.col("h"))))
    return df.select("run_sha", "arch", "h", F.explode(F.slice("l", F.lit(2), F.size("l"))).alias("line")).withColumn("f", F.split("line", "\t"))


def arena_dropped(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """Rows of arena.tsv that ``arena`` leaves out: another number of fields than their header has."""
    return arena_lines(spark, root).filter(F.size("f") != F.size("h")).select("run_sha", "arch", "line")


def arena(spark: SparkSession, root: str | DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """arena.tsv, by header name; a row with another number of fields is dropped (``arena_dropped``)."""
    rows = arena_lines(spark, root).filter(F.size("f") == F.size("h"))
    by = lambda c: F.get("f", F.array_position("h", F.lit(c)).cast("int") - 1)
    text = lambda x: F.nullif(F.nullif(x, F.lit("NA")), F.lit(""))
    extra = {"block": text(by("block")), "writer": text(by("writer"))} | {c: by(c).try_cast("long") for c in ("position", "thp_fault_fallback", "compact_stall", "pgmajfault")} | {c: number(by(c)) for c in ("io_in_mb", "page_cache_start_mb", "memfree_mb", "anon_huge_mb")}
    return rows.select(
        "run_sha", "arch", renamed(by("label"), labels).alias("label"), by("mode").alias("mode"), by("rep").try_cast("long").alias("rep"),
        number(by("wall_s")).alias("wall_seconds"), number(by("cpu_s")).alias("cpu_time"), number(by("max_rss_mb")).alias("max_rss_mb"), number(by("process_s")).alias("process_seconds"),
        number(by("index_read_s")).alias("index_read_seconds"), *(x.alias(c) for c, x in extra.items()),
    )


def probe_columns(value: Column) -> dict[str, Column]:
    """The fields of one probe line, each of its own type or null: a boolean is no number, an integer
    must fit 64 bits, a number must be finite."""
    v = F.try_parse_json(value)
    kind = lambda p: F.schema_of_variant(F.try_variant_get(v, p, "variant"))
    text = lambda k: F.when(kind(f"$.{k}") == "STRING", F.try_variant_get(v, f"$.{k}", "string"))
    whole = lambda k: F.when(kind(f"$.{k}") == "BIGINT", F.try_variant_get(v, f"$.{k}", "long"))

    def real(k: str) -> Column:
        x = F.when(kind(f"$.{k}").rlike("^(BIGINT|DOUBLE|DECIMAL)"), F.try_variant_get(v, f"$.{k}", "double"))
        return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)

    return {
        "phase": text("phase"), "probe_version": text("probe_version"), "rustc": text("rustc"), "m_accesses_per_sec": real("million_accesses_per_sec"), "ns_per_access": real("ns_per_access"),
        "threads": whole("threads"), "working_set_mb_per_thread": real("working_set_bytes_per_thread") / (1024 * 1024), "seconds": real("seconds"), "status": text("status"),
    }


def probes(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """host-probe.jsonl: the ladder's probe belongs to replicate 0, a cell's to its own. Lines that are no
    JSON object or have no phase are skipped; nothing here is fatal."""
    raw = files(spark, root, "host-probe.jsonl")
    own = cells(raw)
    job = run_cells(raw.filter(~F.col("path").rlike(_CELL_PATH))).withColumn("rep", F.lit(0).cast("long"))
    both = own.unionByName(job).select("run_sha", "sample", "arch", "rep", F.explode(lines()).alias("line"))
    return both.select("run_sha", "sample", "arch", "rep", *(x.alias(c) for c, x in probe_columns(F.col("line")).items())).filter("phase <> ''")


def keys(listing: DataFrame, key: str = "key") -> DataFrame:
    """Object keys ``runs/<sha>/<sample>/<arch>/rep-<n>/<file>`` -> cells with their replicates, and
    whether a host record is among them."""
    p = rf"(?:^|/)([^/]+)/([^/]+)/([^/]+)/{REP_PATTERN}/(.+)$"
    df = listing.filter(F.col(key).rlike(p)).select(*(F.regexp_extract(key, p, i).alias(n) for i, n in ((1, "run_sha"), (2, "sample"), (3, "arch"))), F.regexp_extract(key, p, 4).cast("long").alias("rep"), F.regexp_extract(key, p, 5).alias("file"))
    return df.groupBy("run_sha", "sample", "arch").agg(F.count_distinct("rep").alias("reps"), F.bool_or(F.col("file").endswith("meta.json")).alias("has_meta"), F.bool_or(F.col("file").endswith(".bam")).alias("has_bam"))


def progress(log: DataFrame, line: str = "value", seq: str = "idx") -> DataFrame:
    """The last "X of Y steps" of a coordinator's log."""
    p = r"(\d+) of (\d+) steps \(\d+%\) done"
    hit = log.filter(F.col(line).rlike(p))
    return hit.agg(F.max_by(F.struct(F.regexp_extract(line, p, 1).cast("long").alias("done"), F.regexp_extract(line, p, 2).cast("long").alias("total")), seq).alias("p")).select("p.*")


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Release snapshots releases/*/data.json as nested rows."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "data.json").json(root, multiLine=True)


def trials(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """Trials of every run under root: timing, host, log and the read count of the first comparison."""
    cell = ["run_sha", "sample", "arch", "rep"]
    t = timing(spark, root).drop("path")
    order = F.array_position(F.array(*(F.lit(k) for k in COMPARE_KINDS)), F.col("kind"))
    reads = comparisons(spark, root).groupBy(*cell).agg(F.min_by("total", order).alias("reads_processed"))
    out = t.join(meta(spark, root).drop("host", "kernel"), cell, "left").join(aligner_log(spark, root), cell, "left").join(reads, cell, "left")
    return out.select(
        F.xxhash64(*cell).alias("id"), *cell, "instance_type", "availability_zone", "instance_id", "measured_at", "image_variant", F.lit(None).cast("double").alias("spot_price"),
        F.col("s").alias("wall_seconds"), F.col("max_rss").alias("max_rss_mb"), "cpu_time", F.col("io_in").alias("io_read_mb"), F.col("io_out").alias("io_write_mb"), "mean_load",
        F.coalesce("reads_processed", F.lit(0)).cast("long").alias("reads_processed"), "process_seconds", "index_read_seconds", F.lit("completed").alias("status"),
    )


def accuracy(spark: SparkSession, root: str | DataFrame, tools: dict[str, str] | None = None) -> DataFrame:
    cell = ["run_sha", "sample", "arch", "rep", "tool"]
    out = eval_tables(spark, root).join(variants(spark, root), cell, "left").join(methylation(spark, root), cell, "left")
    return out.withColumn("tool", renamed(F.col("tool"), tools))


def job_plan(log: DataFrame, line: str = "value", seq: str = "idx") -> DataFrame:
    """(command, n) of the "Job stats" table of a coordinator's log, its total (command "total") included. The
    table is the first such one and ends at the total or an empty line."""
    start = log.filter(F.col(line).startswith("Job stats:")).agg(F.min(seq).alias("a"))
    after = log.join(F.broadcast(start), F.col(seq) > F.col("a"))  # one row
    text = F.trim(line)
    stop = after.agg(F.min(F.when((text == "") | text.rlike(r"^total\s+\d+$"), F.col(seq))).alias("z"))
    row = r"^(\w+)\s+(\d+)$"
    inside = after.join(F.broadcast(stop), F.col("z").isNull() | (F.col(seq) <= F.col("z"))).filter(text.rlike(row) & ~text.startswith("job "))
    return inside.groupBy(F.regexp_extract(text, row, 1).alias("command")).agg(F.sum(F.regexp_extract(text, row, 2).cast("long")).alias("n"))


def job_listing(spark: SparkSession, path: str) -> DataFrame:
    """Job listings, a JSON object a line: (name, queue, status, created_at)."""
    return spark.read.schema("jobName string, jobQueue string, status string, createdAt long").json(path).select(F.col("jobName").alias("name"), F.col("jobQueue").alias("queue"), "status", F.col("createdAt").alias("created_at"))


def serialization(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """timings.tsv of output-route benchmarks, a row for each run; NA is null."""
    names = ("label", "tool", "mode", "index", "endpoint", "route", "block", "status")
    whole, real = ("round", "position", "exit_code", "primary_count"), ("wall_s", "cpu_s", "max_rss_mb", "process_s", "index_read_s")
    df = files(spark, root, "timings.tsv").withColumn("l", lines()).withColumn("h", F.split(F.get("l", F.lit(0)), "\t"))
    rows = df.select("path", F.explode(F.slice("l", F.lit(2), F.size("l"))).alias("line"), "h").withColumn("f", F.split("line", "\t")).filter(F.size("f") == F.size("h"))
    by = lambda c: F.get("f", F.array_position("h", F.lit(c)).cast("int") - 1)
    return rows.select(*(by(c).alias(c) for c in names), *(by(c).try_cast("long").alias(c) for c in whole), *(number(by(c)).alias(c) for c in real))


def fidelity(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """result.tsv: primaries by compression, and whether all three counts agree."""
    df = files(spark, root, "result.tsv").select("path", F.explode(lines()).alias("line")).withColumn("f", F.split("line", "\t")).filter(F.get("f", F.lit(0)) != "compression")
    count = lambda k: F.get("f", F.lit(k)).try_cast("long")
    out = df.select(F.regexp_extract("path", r"/([^/]+)/result\.tsv$", 1).alias("mode"), F.get("f", F.lit(0)).alias("compression"), count(1).alias("expected"), count(2).alias("sam"), count(3).alias("native"), count(4).alias("exit_code"))
    return out.withColumn("agrees", F.coalesce((F.col("expected") == F.col("sam")) & (F.col("sam") == F.col("native")) & (F.col("exit_code") == 0), F.lit(False)))


def release_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(label, sha) of the release builds of an image file: each RUN that clones into
    ``arena-releases/<label>``, checks out a commit and installs the program under its label. Two labels in
    one block, or a block without them, is an error; a commented RUN is none."""
    raw = spark.read.text(path, wholetext=True)
    block = raw.select(F.explode(F.split("value", r"(?m)^(?=(?:RUN|FROM|COPY|ENV|WORKDIR|ARG) )")).alias("value"), F.lit(path).alias("path")).filter(F.col("value").rlike(r"^RUN git clone [^\n]*/arena-releases/"))
    found = {n: F.regexp_extract("value", p, 1) for n, p in (("label", r"/arena-releases/(\S+?) &&"), ("sha", r"git checkout --quiet ([0-9a-fA-F]{7,40})"), ("installed", r"install \S+ \S+ /out/bin/[A-Za-z0-9_-]+\.(\S+)"))}
    df = block.withColumns(found)
    wrong = (F.col("label") == "") | (F.col("sha") == "") | (F.col("label") != F.col("installed"))
    return df.select(_fail(wrong, "malformed release block", F.col("label")).alias("label"), "sha")
