"""Columns over alignment records: flags, ends, placement, differences."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag bits of the SAM format.
UNMAPPED, REVERSE, FIRST, LAST, SECONDARY, SUPPLEMENTARY = 0x4, 0x10, 0x40, 0x80, 0x100, 0x800
#: Names of the differences, in report order.
CLASSES = ("mapped_only_query", "mapped_only_baseline", "pos_diff", "cigar_diff", "mapq_diff", "flag_diff", "tag_diff")


@dataclass(frozen=True)
class CompareOptions:
    """What a comparison tolerates and expects."""

    ignore_tags: frozenset[str] = field(default_factory=frozenset)
    expect_tags: frozenset[str] = field(default_factory=frozenset)
    absent_ok_tags: frozenset[str] = field(default_factory=frozenset)
    mapq_tolerance: int = 0
    confident_mapq: int = 20
    relocation_bp: int = 10
    tag_guard: bool = True

    def __post_init__(self) -> None:
        import re

        for tag in sorted(self.ignore_tags | self.expect_tags | self.absent_ok_tags):
            if not re.fullmatch("[A-Za-z][A-Za-z0-9]", tag):
                raise ValueError(f"not a tag name: {tag!r}")


def has(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(F.lit(bit)) != 0


def kind(flags: Column) -> Column:
    """supplementary before secondary before primary."""
    return F.when(has(flags, SUPPLEMENTARY), "supplementary").when(has(flags, SECONDARY), "secondary").otherwise("primary")


def end_key(flags: Column) -> Column:
    """0 to 3: first segment 1, last segment 2."""
    return has(flags, FIRST).cast("int") + has(flags, LAST).cast("int") * 2


def mapped(r: Column) -> Column:
    return ~has(r["flags"], UNMAPPED)


def mapq(r: Column) -> Column:
    return F.coalesce(r["mapq"], F.lit(0))


def _length(cigar: Column) -> Column:
    return F.aggregate(cigar, F.lit(0), lambda n, x: n + x["len"])


def _leading_clip(cigar: Column) -> Column:
    """Bases clipped before the first operation that is no clip."""
    clip = lambda x: x["op"].isin("S", "H")
    return F.aggregate(cigar, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, x: F.struct((s["n"] + F.when(s["on"] & clip(x), x["len"]).otherwise(0)).alias("n"), (s["on"] & clip(x)).alias("on")), lambda s: s["n"])


def five_prime(r: Column) -> Column:
    """Unclipped position of the read's first base; null if it is not placed."""
    span = _length(F.filter(r["cigar"], lambda x: x["op"].isin("M", "D", "N", "=", "X")))
    forward = r["pos"] - _leading_clip(r["cigar"])
    backward = r["pos"] + span - 1 + _leading_clip(F.reverse(r["cigar"]))
    return F.when(mapped(r) & r["pos"].isNotNull(), F.when(has(r["flags"], REVERSE), backward).otherwise(forward))


def confident(r: Column, opts: CompareOptions) -> Column:
    return F.coalesce(mapped(r) & (mapq(r) >= opts.confident_mapq), F.lit(False))


def placement(q: Column, b: Column, opts: CompareOptions) -> tuple[Column, Column]:
    """(side, outcome) of a pair of primaries, null if neither is confident: which sides are confident,
    and whether the 5' end is the same, shifted by up to ``relocation_bp``, or relocated."""
    cq, cb = confident(q, opts), confident(b, opts)
    side = F.when(cq & cb, "both").when(cq, "query_only").when(cb, "baseline_only")
    both = F.coalesce(mapped(q) & mapped(b), F.lit(False))
    strand = has(q["flags"], REVERSE) == has(b["flags"], REVERSE)
    moved = F.abs(five_prime(q) - five_prime(b))
    near = F.coalesce(both & q["ref_id"].eqNullSafe(b["ref_id"]) & strand & (moved <= opts.relocation_bp), F.lit(False))
    outcome = F.when(near & (moved == 0), "same").when(near, "shifted").otherwise("relocated")
    return side, F.when(side.isNotNull(), outcome)


def tag_equal(a: Column, b: Column) -> Column:
    """Same normalised type and value; floats by IEEE rules, so NaN differs from itself."""
    floats = a["v"].try_cast("float").eqNullSafe(b["v"].try_cast("float")) & ~F.isnan(F.coalesce(a["v"].try_cast("float"), F.lit(0.0)))
    return a["t"].eqNullSafe(b["t"]) & F.when(a["t"] == "Float", floats).otherwise(a["v"].eqNullSafe(b["v"]))


def _tags(r: Column) -> Column:
    return F.coalesce(r["tags"], F.create_map().cast("map<string,struct<t:string,v:string>>"))


def tag_diffs(q: Column, b: Column) -> Column:
    """array<struct<tag, how>> over all tags of a pair: value_diff, query_only, baseline_only."""
    tq, tb = _tags(q), _tags(b)
    x = lambda m, k: F.try_element_at(m, k)
    how = lambda k: F.when(x(tb, k).isNull(), "query_only").when(x(tq, k).isNull(), "baseline_only").when(~tag_equal(x(tq, k), x(tb, k)), "value_diff")
    each = F.transform(F.array_sort(F.array_union(F.map_keys(tq), F.map_keys(tb))), lambda k: F.struct(k.alias("tag"), how(k).alias("how")))
    return F.filter(each, lambda s: s["how"].isNotNull())


def _any_tag(diffs: Column, opts: CompareOptions) -> Column:
    skip = sorted(opts.ignore_tags)
    return F.exists(diffs, lambda s: ~s["tag"].isin(skip)) if skip else F.size(diffs) > 0


def differences(q: Column, b: Column, opts: CompareOptions, tags: bool = True) -> Column:
    """All differences of a pair of records, not only the first. If one is unmapped that is the only
    one; if both are, flags and tags alone are compared."""
    both = mapped(q) & mapped(b)
    flag = F.when(~q["flags"].eqNullSafe(b["flags"]), "flag_diff")
    tag = F.when(_any_tag(tag_diffs(q, b), opts), "tag_diff") if tags else F.lit(None).cast("string")
    pos = F.when(~(q["ref_id"].eqNullSafe(b["ref_id"]) & q["pos"].eqNullSafe(b["pos"])), "pos_diff")
    cigar = F.when(~q["cigar"].eqNullSafe(b["cigar"]), "cigar_diff")
    quality = F.when(F.abs(mapq(q) - mapq(b)) > opts.mapq_tolerance, "mapq_diff")
    return (
        F.when(b["flags"].isNull() | (mapped(q) & ~mapped(b)), F.array(F.lit("mapped_only_query")))
        .when(q["flags"].isNull() | (~mapped(q) & mapped(b)), F.array(F.lit("mapped_only_baseline")))
        .when(both, F.array_compact(F.array(pos, cigar, quality, flag, tag)))
        .otherwise(F.array_compact(F.array(flag, tag)))
    )


def literal_set(values: Iterable[str]) -> Column:
    return F.array(*(F.lit(v) for v in sorted(values))).cast("array<string>")
