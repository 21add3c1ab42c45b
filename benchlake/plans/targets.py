"""What a target of the workflow must leave behind, and everything that needs: expected cells as frames.

A target is a list of products, each of a scope of samples and a scope of architectures: products of declared
dimensions under predicates. What a product needs is stated by rules; their closure is a chain of equi-joins in which
every round joins only what the round before found (semi-naive), so its rounds are the depth of the rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.session import dealt, materialize

KEY = ("source", "product", "sample", "arch", "rep")
BAM, META = "aligned.bam", "benchmarks/meta.json"


@dataclass(frozen=True)
class Output:
    """A product of a target: whose (runs, baseline or golden), for which samples and architectures, how often."""

    target: str
    source: str
    product: str
    samples: str
    archs: str
    reps: str = "reps"


def _compare(kind: str) -> str:
    return f"compare/{kind}.json"


#: The products of each target. A baseline program runs on x86 alone, so an ARM build is compared with the
#: x86 build of the same run.
OUTPUTS = (
    Output("all", "runs", _compare("vs-baseline"), "sweep", "x86"), Output("all", "runs", _compare("vs-x86"), "sweep", "arm"), Output("all", "runs", META, "sweep", "arm"), Output("all", "baseline", BAM, "sweep", "x86", "baseline_reps"),
    Output("all", "runs", _compare("vs-golden"), "golden", "x86"), Output("all", "runs", _compare("vs-golden"), "golden", "arm"),
    Output("fast", "runs", _compare("vs-baseline"), "fast_base", "x86"), Output("fast", "baseline", BAM, "fast_base", "x86", "baseline_reps"), Output("fast", "runs", _compare("vs-x86"), "fast_base", "arm"),
    Output("fast", "runs", _compare("vs-default"), "fast", "x86"), Output("fast", "runs", _compare("vs-default"), "fast", "arm"),
    Output("accuracy", "runs", "eval", "truth", "x86"), Output("accuracy", "runs", "eval", "truth", "arm"), Output("accuracy", "baseline", "eval", "truth", "x86"),
)
#: What a product needs: (its source, product) -> (source, product, sample, arch, rep); ``base`` is the sample without its
#: suffix, ``reference`` the architecture that stands in for one without a baseline, ``first`` the first replicate.
RULES = (
    ("runs", _compare("vs-baseline"), "runs", BAM, "same", "same", "same"), ("runs", _compare("vs-baseline"), "baseline", BAM, "base", "reference", "first"),
    ("runs", _compare("vs-x86"), "runs", BAM, "same", "same", "same"), ("runs", _compare("vs-x86"), "runs", BAM, "same", "reference", "same"),
    ("runs", _compare("vs-golden"), "runs", BAM, "same", "same", "same"), ("runs", _compare("vs-golden"), "golden", BAM, "same", "same", "same"),
    ("runs", _compare("vs-default"), "runs", BAM, "same", "same", "same"), ("runs", _compare("vs-default"), "runs", BAM, "base", "same", "same"),
    ("runs", "eval", "runs", BAM, "same", "same", "same"), ("baseline", "eval", "baseline", BAM, "same", "same", "same"),
    ("runs", BAM, "runs", META, "same", "same", "same"), ("baseline", BAM, "baseline", META, "same", "same", "same"), ("runs", META, "runs", "index", "same", "same", "first"), ("baseline", META, "baseline", "index", "same", "same", "first"),
)


def sample_scopes(samples: DataFrame) -> DataFrame:
    """samples (sample, truth, meth, compat, base, golden) with their scopes."""
    siblings = samples.filter(F.col("sample").endswith("-fast")).select(F.col("base").alias("sample"), F.lit(True).alias("_fast")).distinct()
    fast, plain = F.col("sample").endswith("-fast"), ~F.col("truth") & ~F.col("compat")
    scopes = {"sweep": plain & ~fast, "golden": plain & ~fast & F.col("golden"), "fast": plain & fast, "fast_base": plain & ~fast & F.coalesce("_fast", F.lit(False)), "truth": F.col("truth")}
    named = F.array_compact(F.array(*(F.when(c, name) for name, c in scopes.items())))
    return samples.join(siblings, "sample", "left").select("sample", "meth", "base", F.explode(named).alias("samples"))


def expected(samples: DataFrame, archs: DataFrame, reps: int, baseline_reps: int, meth_arch: str, outputs: tuple[Output, ...] = OUTPUTS) -> DataFrame:
    """(target, source, product, sample, arch, rep) of every output. archs: (arch, platform). A methylation sample runs on
    ``meth_arch`` alone."""
    spark = samples.sparkSession
    declared = spark.createDataFrame([(o.target, o.source, o.product, o.samples, o.archs, {"reps": reps, "baseline_reps": baseline_reps}[o.reps]) for o in outputs], "target string, source string, product string, samples string, archs string, n int")
    fits = ~F.col("meth") | ((F.col("arch") == meth_arch) & (F.col("archs") == "x86"))
    # samples of the same scopes need the same: that is worked out once for each set of scopes, duplicates and all, so that
    # each cell is made once and no task holds the cells to tell copies apart
    kinds = sample_scopes(samples).repartition(dealt(samples), "sample").groupBy("sample").agg(F.array_sort(F.collect_set(F.struct("samples", "meth"))).alias("kind"))
    each = kinds.select("kind").distinct().select("kind", F.explode("kind").alias("k")).select("kind", "k.*")
    plan = each.join(F.broadcast(declared), "samples").join(archs.select("arch", F.col("platform").alias("archs")), "archs").filter(fits).groupBy("kind", "target", "source", "product", "arch").agg(F.max("n").alias("n"))
    cells = kinds.join(F.broadcast(plan), "kind")  # sets of five scopes, times outputs and architectures
    return cells.select("target", "source", "product", "sample", "arch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long"))).alias("rep"))


def closure(wanted: DataFrame, samples: DataFrame, archs: DataFrame, rules: tuple[tuple[str, ...], ...] = RULES) -> DataFrame:
    """Wanted products and all that they need, each once: (source, product, sample, arch, rep). samples: (sample, base),
    archs: (arch, baseline_arch). Written cells take a few bits each, so that by the size of its files a frame of millions
    seems small enough to broadcast: samples are joined by sorting, and what is new is told by a grouping, not by a join."""
    spark = wanted.sparkSession
    needs = spark.createDataFrame(list(rules), "source string, product string, n_source string, n_product string, of_sample string, of_arch string, of_rep string")
    bases, references = materialize(samples.select("sample", "base").distinct(), "bases"), archs.select("arch", "baseline_arch").distinct()

    def pick(rule: str, other: str, column: Column, same: str) -> Column:
        return F.when(F.col(rule) == other, column).otherwise(F.col(same)).alias(same)

    known, paths = None, []
    found = materialize(wanted.select(*KEY[:-1], F.col("rep").cast("long")), "wanted")
    parts = dealt(found)
    while True:
        cells = found.withColumn("_new", F.lit(True))
        cells = cells.union(known.withColumn("_new", F.lit(False))) if paths else cells
        fresh = materialize(cells.repartition(parts, *KEY).groupBy(*KEY).agg(F.min("_new").alias("_new")).filter("_new").drop("_new"), "needed")
        if paths and fresh.isEmpty():
            return known
        paths.append(fresh.scratch_path)
        known = spark.read.schema(fresh.schema).parquet(*paths)
        parts = dealt(known)
        step = fresh.join(F.broadcast(needs), ["source", "product"]).join(F.broadcast(references), "arch")
        step = step.select(F.col("n_source").alias("source"), F.col("n_product").alias("product"), "sample", "of_sample", pick("of_arch", "reference", F.col("baseline_arch"), "arch"), pick("of_rep", "first", F.lit(1).cast("long"), "rep"))
        found = step.repartition(parts, "sample").join(bases.repartition(parts, "sample").hint("merge"), "sample").select("source", "product", pick("of_sample", "base", F.col("base"), "sample"), "arch", "rep")


def missing(expected_cells: DataFrame, present: DataFrame) -> DataFrame:
    """Expected products that are not there, by target."""
    return expected_cells.join(present.select(*KEY).distinct(), list(KEY), "left_anti").orderBy("target", *KEY)
