"""Set algebra over keys, prefix and ordered lookups, gaps and islands, retry chains."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchlake.session import dealt, materialize


def missing(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(present.select(*keys), keys, "left_anti")


def completeness(evidence: list[DataFrame], golden: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that any evidence shows and the golden set lacks."""
    seen = evidence[0].select(*keys)
    for e in evidence[1:]:
        seen = seen.union(e.select(*keys))
    return missing(seen, golden, keys)


def bijection_problems(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, problem): keys of one side only, and duplicates on either."""
    count = lambda f, n: f.groupBy(key).agg(F.count("*").alias(n))
    both = count(a, "na").join(count(b, "nb"), key, "full_outer").na.fill(0)
    each = F.array_compact(F.array(F.when(F.col("nb") == 0, "only_left"), F.when(F.col("na") == 0, "only_right"), F.when(F.col("na") > 1, "duplicate_left"), F.when(F.col("nb") > 1, "duplicate_right")))
    return both.select(key, F.explode(each).alias("problem")).orderBy(key, "problem")


def prefix_match(names: DataFrame, prefixes: DataFrame, name: str, prefix: str) -> DataFrame:
    """Pairs of which either is a prefix of the other. Each value is cut to the lengths that occur on the other side and are
    no longer than it is, and length and cut join by equality: every candidate is a match, whatever the
    shortest value is. Lengths that occur are one row."""

    def cut(long: DataFrame, column: str, short: DataFrame, other: str, equal: bool) -> DataFrame:
        found = short.agg(F.collect_set(F.length(other)).alias("_all"))
        fits = lambda k: k <= F.length(column) if equal else k < F.length(column)
        lengths = long.crossJoin(F.broadcast(found)).withColumn("_n", F.explode(F.filter("_all", fits))).drop("_all")
        return lengths.withColumn("_k", F.expr(f"left(`{column}`, _n)"))

    whole = lambda f, c: f.filter(F.col(c).isNotNull()).withColumns({"_n": F.length(c), "_k": F.col(c)})
    down = cut(names, name, prefixes, prefix, equal=True).join(whole(prefixes, prefix), ["_n", "_k"])
    up = whole(names, name).join(cut(prefixes, prefix, names, name, equal=False), ["_n", "_k"])
    return down.drop("_n", "_k").union(up.drop("_n", "_k"))


def resolve_prefix(names: DataFrame, prefixes: DataFrame, name: str, prefix: str) -> DataFrame:
    """One match for each prefix; two or more are an error, none is null."""
    hits = prefix_match(names, prefixes, name, prefix).groupBy(prefix).agg(F.count("*").alias("_hits"), F.max(name).alias(name))
    one = F.when(F.col("_hits") > 1, F.raise_error(F.concat(F.lit("ambiguous prefix "), F.col(prefix)))).otherwise(F.col(name))
    return prefixes.join(hits, prefix, "left").withColumn(name, one).drop("_hits")


def islands(rows: DataFrame, value: str, order: str, partition: Iterable[str]) -> DataFrame:
    """Adds ``island``, the number of the run of equal values within its partition."""
    w = Window.partitionBy(*partition).orderBy(order)
    return rows.withColumn("_new", (~F.coalesce(F.col(value).eqNullSafe(F.lag(value).over(w)), F.lit(False))).cast("long")).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def numbered(rows: DataFrame, keys: list[str], order: list[str], keep: list[str], name: str) -> DataFrame:
    """(keys, keep, name): the place of each row, from 1, within its keys by order, for few keys with rows of any number. Sorted
    ranges and the sum of those before: a window would sort all rows of a key in one task. The table is written."""
    ranges = rows.repartitionByRange(dealt(rows), *keys, *order).sortWithinPartitions(*keys, *order).withColumn("_at", F.monotonically_increasing_id())  # range << 33 | place
    own = materialize(ranges.select(*keys, *keep, "_at", F.shiftright("_at", 33).alias("_range")), "numbered")
    sizes = own.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = sizes.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_range").alias("_of"), (before - F.col("_first") + 1).alias("_shift"))
    here = F.col("_range") == F.col("_of")
    for k in keys:
        here &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    both = own.join(F.broadcast(shift), here)  # a row for each key and range that meet: at most their sum
    return both.select(*keys, *keep, (F.col("_at") + F.col("_shift")).alias(name))


def retry_states(jobs: DataFrame, identity: list[str], state: str, created: str) -> DataFrame:
    """Adds ``display``: a failed job with a later one of the same identity was retried."""
    last = jobs.groupBy(*identity).agg(F.max(created).alias("_last"))  # an aggregate joined back: no task holds an identity's jobs
    late = F.coalesce(F.col(created) < F.col("_last"), F.lit(False))
    return jobs.join(last, identity, "left").withColumn("display", F.when((F.col(state) == "FAILED") & late, "RETRIED").otherwise(F.col(state))).select(*jobs.columns, "display")


def version_key(version: Column) -> Column:
    """Semantic versions in numeric order: an array of ints."""
    return F.transform(F.split(F.regexp_replace(version, "^v", ""), r"\."), lambda x: x.try_cast("int"))


def agreement(rows: DataFrame, value: list[str], producer: str, weight: str) -> DataFrame:
    """Equal results merged, with who produced them."""
    return rows.groupBy(*value).agg(F.array_join(F.array_sort(F.collect_set(producer)), ", ").alias("producers"), F.sum(weight).alias("n"))


def every_nth(lines: DataFrame, n: int, record: int = 4, trim: int = 0) -> DataFrame:
    """Every n-th record of ``record`` lines (columns idx, value), with ``trim`` characters cut from the
    front of its sequence and quality lines."""
    rec, line = F.floor(F.col("idx") / record), F.col("idx") % record
    cut = F.when(line.isin(1, 3), F.substring("value", trim + 1, 2**31 - 1)).otherwise(F.col("value"))
    return lines.filter(rec % n == 0).withColumn("value", cut)


def first_of_each(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row for each key, the earliest by order, in that order: duplicates go, places stay."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("r")).select(*key, *(F.col(f"r.{c}").alias(c) for c in rest)).orderBy(order)


def lost(old: DataFrame, new: DataFrame, key: str, facts: list[str]) -> DataFrame:
    """(key, problem): keys that old has and new lacks, and facts that were known of a key and no longer are."""
    now = new.select(F.col(key).alias("_k"), *(F.col(f).alias(f"_{f}") for f in facts)).withColumn("_there", F.lit(True))
    gone = F.when(F.col("_there").isNull(), F.array(F.lit("missing"))).otherwise(F.array_compact(F.array(*(F.when(F.col(f).isNotNull() & F.col(f"_{f}").isNull(), f"no {f}") for f in facts))))
    return old.join(now, F.col(key) == F.col("_k"), "left").select(key, F.explode(gone).alias("problem")).orderBy(key, "problem")


def fastq_problems(lines: DataFrame, *file: str) -> DataFrame:
    """(rec, problem) of four-line records (columns idx, value, and those that name their file): a header without @, a
    third line without +, sequence and quality of different length, a record that is cut off."""
    rec = lines.groupBy(*file, F.floor(F.col("idx") / 4).alias("rec")).agg(*(F.max(F.when(F.col("idx") % 4 == k, F.col("value"))).alias(f"l{k}") for k in range(4)))
    problem = F.when(F.col("l3").isNull(), "cut off").when(~F.col("l0").startswith("@"), "no header").when(~F.col("l2").startswith("+"), "no separator").when(F.length("l1") != F.length("l3"), "lengths differ")
    return rec.select(*file, "rec", problem.alias("problem")).filter("problem is not null")


def lowest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole row of each key that is lowest by order: its columns are never mixed with another row's."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest))
