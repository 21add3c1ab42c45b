"""Columns over arm labels, sample names, tag policies and job names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def release_version(label: Column) -> Column:
    """``v151`` -> ``v0.15.1``: the last digit is the patch; anything else is an interim build."""
    p = r"^v(\d+)(\d)$"
    minor, patch = F.regexp_extract(label, p, 1), F.regexp_extract(label, p, 2)
    return F.when(label.rlike(p), F.concat(F.lit("v0."), minor.try_cast("int").cast("string"), F.lit("."), patch)).otherwise(F.concat(label, F.lit(" (interim build)")))


def fast_sibling(label: Column) -> Column:
    """The fast arm of a default-mode label."""
    return F.concat(label, F.lit("-fast"))


def accuracy_aligner(tool: Column, sample: Column) -> Column:
    """What graded a sample: fast and compat arms of one tool count as aligners of their own."""
    suffix = F.regexp_extract(sample, r"-(fast|compat[a-z0-9-]*)$", 1)
    return F.when(suffix != "", F.concat_ws("-", tool, suffix)).otherwise(tool)


def base_sample(sample: Column) -> Column:
    """The sample whose baseline a compat or fast sample is compared with."""
    return F.regexp_replace(sample, r"-(fast|compat[a-z0-9-]*|genomic)$", "")


def swept(truth: Column, sample: Column, alt_aware: Column) -> Column:
    """Whether a sample belongs to the golden sweep: no truth, fast, compat or ALT sample."""
    return ~F.coalesce(truth, F.lit(False)) & ~F.coalesce(alt_aware, F.lit(False)) & ~sample.rlike(r"-(fast|compat)")


def tags(defaults: Column, own: Column, derived: Column, strict: Column) -> Column:
    """A tag list: the kind's defaults, the sample's and the derived ones together; a strict comparison
    takes them all away."""
    empty = F.array().cast("array<string>")
    some = F.array_sort(F.array_union(F.array_union(F.coalesce(defaults, empty), F.coalesce(own, empty)), F.coalesce(derived, empty)))
    return F.when(strict, empty).otherwise(some)


def breakdown(classes: Column, order: tuple[str, ...]) -> Column:
    """"pos 3, mapq 1": the classes of a map<string, long> that count, in fixed order."""
    named = F.transform(F.filter(F.array(*(F.lit(c) for c in order)), lambda k: F.coalesce(F.try_element_at(classes, k), F.lit(0)) > 0), lambda k: F.concat_ws(" ", F.regexp_replace(k, "_diff$", ""), F.try_element_at(classes, k).cast("string")))
    return F.array_join(named, ", ")


def job_command(name: Column) -> Column:
    """The rule of a job's name: all but its last part, with dashes as underscores."""
    parts = F.split(name, "-")
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), "_")


def index_budget_bytes(reference_bases: Column, bytes_per_base: float, reserve: int) -> Column:
    return (reference_bases * bytes_per_base).cast("long") + reserve


def dense_index(label: Column, rank: Column, least: Column, candidate: str = "candidate", enabled: bool = True) -> Column:
    """Whether an arm reads the dense index: the candidate, and releases after a least one by rank, not by
    their label. Arms that are no release (a null rank) never do, and none does if it is switched off."""
    return F.lit(enabled) & ((base_label(label) == candidate) | F.coalesce(rank > least, F.lit(False)))


def base_label(label: Column) -> Column:
    """The release of an arm: without its fast mode and its writer control."""
    return F.regexp_replace(F.regexp_replace(label, "-sam$", ""), "-fast$", "")


def output_writer(label: Column, native: Column) -> Column:
    """What writes an arm's output: the tool itself, or a pipe for text-only tools and writer controls."""
    return F.when(native & ~label.endswith("-sam"), "native").otherwise("sam")


def graded(truth: Column, meth: Column) -> Column:
    """Whether a sample's grades gate a release: it has a simulated truth and a methylation mode."""
    return F.coalesce(truth & meth, F.lit(False))
