"""The seven telemetry tables, their keys, and the alignment record.

Every column may be null unless it is part of a key. Null means "not measured" and is never 0.
"""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = 14


def _struct(spec: str) -> T.StructType:
    kinds = {"s": T.StringType(), "l": T.LongType(), "d": T.DoubleType(), "t": T.TimestampType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in (x.split(":") for x in spec.split())])


RUNS = _struct("run_sha:s branch:s upstream_tag:s submitted_at:t status:s")
TRIALS = _struct(
    "id:l run_sha:s sample:s arch:s rep:l instance_type:s availability_zone:s instance_id:s measured_at:s image_variant:s spot_price:d wall_seconds:d max_rss_mb:d cpu_time:d "
    "io_read_mb:d io_write_mb:d mean_load:d reads_processed:l process_seconds:d index_read_seconds:d status:s"
)
COMPARISONS = _struct("trial_id:l kind:s concordant:l total:l concordance_pct:d by_class_json:s supp_json:s placement_json:s")
ACCURACY = _struct(
    "run_sha:s sample:s arch:s rep:l tool:s placement_total:l placement_correct_pct:d placement_mismapped_pct:d placement_unmapped_pct:d placement_json:s variant_bearing_reads:l "
    "md_concordant_pct:d nm_concordant_pct:d by_class_json:s meth_n_cpg:l meth_pearson_r:d meth_rmse:d"
)
SCALING = _struct("run_sha:s sample:s arch:s threads:l rep:l wall_seconds:d cpu_time:d max_rss_mb:d process_seconds:d main_mem_seconds:d read_io_seconds:d sam_io_seconds:d kernel_seconds:d instance_id:s")
HOST_PROBES = _struct("run_sha:s sample:s arch:s rep:l phase:s instance_id:s probe_version:s rustc:s m_accesses_per_sec:d ns_per_access:d threads:l working_set_mb_per_thread:d seconds:d status:s")
ARENA = _struct(
    "run_sha:s arch:s label:s mode:s rep:l wall_seconds:d cpu_time:d max_rss_mb:d process_seconds:d instance_id:s block:s position:l writer:s index_read_seconds:d io_in_mb:d "
    "page_cache_start_mb:d thp_fault_fallback:l compact_stall:l pgmajfault:l memfree_mb:d anon_huge_mb:d"
)

TABLES = {"runs": RUNS, "trials": TRIALS, "comparisons": COMPARISONS, "accuracy": ACCURACY, "scaling": SCALING, "host_probes": HOST_PROBES, "arena": ARENA}
KEYS = {
    "runs": ("run_sha",),
    "trials": ("run_sha", "sample", "arch", "rep"),
    "comparisons": ("trial_id", "kind"),
    "accuracy": ("run_sha", "sample", "arch", "rep", "tool"),
    "scaling": ("run_sha", "sample", "arch", "threads", "rep"),
    "host_probes": ("run_sha", "sample", "arch", "rep", "phase"),
    "arena": ("run_sha", "arch", "label", "mode", "rep"),
}

CIGAR = T.ArrayType(T.StructType([T.StructField("op", T.StringType()), T.StructField("len", T.IntegerType())]))
TAGS = T.MapType(T.StringType(), T.StructType([T.StructField("t", T.StringType()), T.StructField("v", T.StringType())]))
#: ``idx`` is the record's place in its file; it carries every order-dependent rule.
RECORD = T.StructType(
    [
        T.StructField("idx", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("flags", T.IntegerType()),
        T.StructField("ref_id", T.IntegerType()),
        T.StructField("pos", T.LongType()),
        T.StructField("mapq", T.IntegerType()),
        T.StructField("cigar", CIGAR),
        T.StructField("tags", TAGS),
    ]
)
#: All eleven fields of a record and its tags.
FULL_RECORD = T.StructType(
    [
        *RECORD.fields[:-1],
        T.StructField("next_ref", T.IntegerType()),
        T.StructField("next_pos", T.LongType()),
        T.StructField("tlen", T.IntegerType()),
        T.StructField("seq", T.StringType()),
        T.StructField("qual", T.StringType()),
        RECORD["tags"],
    ]
)
#: A line of a file's header.
HEADER = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("line", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("fields", T.MapType(T.StringType(), T.StringType()))]
)
