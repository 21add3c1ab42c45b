"""Target-distribution importance resampling over hashed word n-grams, with overlap chunking.

Counts: every text is read as words, and each run of 1 to ``n`` words is a feature, hashed to one of
``buckets``. A bucket's gain is the floored log ratio of its smoothed shares in the target and in the corpus; a
document's weight is the floored mean gain of its features. Drawing without replacement in proportion to the
weights is taking the highest sums of weight and Gumbel noise.

A text of more than ``CHUNK`` bytes is split at word borders into chunks that tasks share. A chunk carries the
``n - 1`` words that follow it, and owns only the features that start in its own words, so every
feature is counted once; chunk counts and gains are summed by document. Shorter texts are a chunk as they stand and
are never shuffled.

Memory: a task holds one array of ``buckets`` counts; the driver sees the same array (bounded by that parameter) and
one row for each range of the final order. The order over the corpus is a range sort with prefix sums over ranges, not
one window.

Defined cases: null and empty texts have no features and weight 0; rows that repeat a doc_id or a whole row are weighed
each for itself, and draw the same noise; ties in the score go to the smaller doc_id (null is below all), then to
fewer features and smaller weight; a null doc_id draws as the word ``null``; an empty target or corpus counts
nothing (gains from the smoothing alone); an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import draw_seed, keyed_draws, keyed_texts, materialize, tuned, unkey

CHUNK = 1 << 16
#: Bytes of chunks handed on at once.
_HANDED = 4 << 20
_LETTERS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())
_WORD = re.compile(rb"[^ ]+")


def words(data: bytes) -> list[bytes]:
    return data.translate(_LETTERS).split()


def chunks(data: bytes, size: int, n: int) -> Iterator[tuple[bytes, bytes]]:
    """(own, carry) of a text's chunks: about ``size`` bytes up to the next word border, and the n - 1 words behind."""
    data, start = data.translate(_LETTERS), 0
    while start < len(data):
        stop = data.find(b" ", start + size)
        stop = end = len(data) if stop < 0 else stop
        for _ in range(n - 1):
            if (m := _WORD.search(data, end)) is None:
                break
            end = m.end()
        yield data[start:stop], data[stop:end]
        start = stop


def features(own: bytes, carry: bytes, n: int, buckets: int) -> tuple[int, np.ndarray]:
    """Words that the chunk owns, and the buckets of the features that start at them."""
    w = words(own)
    mine = len(w)
    w += words(carry)
    run = list(map(zlib.crc32, w))
    out = run[:mine]
    for k in range(1, n):
        run = [zlib.crc32(b" " + x, c) for c, x in zip(run, w[k:], strict=False)]  # a run of k words and the next one
        out += run[:mine]
    return mine, (np.array(out, np.uint32) % buckets).astype(np.int64)


_PART = "doc_id long, row long, first boolean, own binary, carry binary"


def _parts(docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(whole, cut): texts that are one chunk, and the chunks of the others, dealt out and written."""
    given = keyed_texts(docs).withColumn("own", F.col("text").cast("binary")).drop("text")
    whole = given.filter(F.octet_length("own") <= CHUNK).select("doc_id", "row", F.lit(True).alias("first"), "own", F.lit(b"").alias("carry"))

    def run(batches):
        for b in batches:
            rows, held = [], 0
            for doc, row, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for k, (own, carry) in enumerate(chunks(data, CHUNK, n)):
                    rows.append((doc, row, not k, k, own, carry))
                    held += len(own)
                    if held > _HANDED:
                        yield _batch(rows)
                        rows, held = [], 0
            yield _batch(rows)

    def _batch(rows):
        types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["doc_id", "row", "first", "at", "own", "carry"])

    cut = given.filter(F.octet_length("own") > CHUNK).mapInArrow(run, "doc_id long, row long, first boolean, at long, own binary, carry binary")
    return whole, materialize(cut.repartition("doc_id", "row", "at").drop("at"), "chunks")


def counts(parts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """Features of each bucket. A task hands on at most ``buckets`` rows."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for own, carry in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total += np.bincount(features(own, carry, n, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in parts.select("own", "carry").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():  # at most ``buckets`` rows
        out[r[0]] = r[1]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) of each bucket, with one added to every count."""
    k, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + k) / ((a + 1) * (t + k)))) for a, b in zip(map(float, corpus), map(float, target), strict=True)], np.int64)


def _weighed(parts: DataFrame, gain: np.ndarray, n: int) -> DataFrame:
    shipped = parts.sparkSession.sparkContext.broadcast(gain)  # ``buckets`` numbers

    def run(batches):
        g = shipped.value
        for b in batches:
            n_words, n_features, total = [], [], []
            for own, carry in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                mine, at = features(own, carry, n, len(g))
                n_words.append(mine)
                n_features.append(len(at))
                total.append(int(g[at].sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array(c, pa.int64()) for c in (n_words, n_features, total))], names=["doc_id", "row", "first", "n_words", "n_features", "gain"])

    return parts.mapInArrow(run, "doc_id long, row long, first boolean, n_words long, n_features long, gain long")


def weights(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight. ``target`` needs a text column alone."""
    tuned(docs.sparkSession)
    whole, cut = _parts(docs, n)
    aim = _parts(target.select(F.lit(0).alias("doc_id"), "text"), n)
    gain = gains(counts(whole.union(cut), n, buckets), counts(aim[0].union(aim[1]), n, buckets))
    sums = _weighed(cut, gain, n).groupBy("doc_id", "row").agg(F.sum(F.col("first").cast("int")).alias("copies"), *(F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")))
    # rows that repeat both id and text were summed together: each has its share
    each = sums.select("doc_id", *(F.expr(f"{c} div copies").alias(c) for c in ("n_words", "n_features", "gain")), F.explode(F.expr("sequence(1, copies)"))).drop("col")
    both = _weighed(whole, gain, n).select("doc_id", "n_words", "n_features", "gain").union(each)
    mean = F.expr("(gain - pmod(gain, n_features)) div n_features")  # rounded down
    return both.select("doc_id", "n_words", "n_features", F.when(F.col("n_features") > 0, mean).otherwise(F.lit(0)).cast("long").alias("weight"))


def resample(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """Per row: doc_id, n_features, weight, score, rank: 1, 2, 3... for the ``percent`` of documents with at least
    ``least_words`` words that are drawn, null for all others."""
    spark = docs.sparkSession
    noise = F.floor(-1000 * F.log(-F.log((keyed_draws(draw_seed(seed, unkey("doc_id")), 1)[0] + 0.5) / 2.0**32)))
    scored = materialize(weights(docs, target, n, buckets).withColumn("score", F.col("weight") + noise), "scored")
    order = [F.desc("score"), "doc_id", "n_features", "weight"]
    able = scored.filter(F.col("n_words") >= least_words)
    ranges = materialize(able.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranges")  # range << 33 | place in it
    sizes = sorted((r[0], r[1]) for r in ranges.groupBy(F.shiftright("at", 33).alias("part")).count().collect())  # a row for each range
    before = np.cumsum([0, *(size for _, size in sizes)])
    offsets = spark.createDataFrame([(part, int(b)) for (part, _), b in zip(sizes, before[:-1], strict=True)], "part long, before long")
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    ranked = ranges.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(offsets), "part").withColumn("rank", F.when(rank <= int(before[-1]) * percent // 100, rank))
    out = ranked.select("doc_id", "n_features", "weight", "score", "rank").union(scored.filter(F.col("n_words") < least_words).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long")))
    return out.select(unkey("doc_id"), *out.columns[1:])


ORACLE = r"""
WITH e AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
f AS (
  SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM d
  UNION ALL SELECT 0, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) FROM b),
n AS (SELECT r, g, count(*) AS n FROM f GROUP BY r, g),
x AS (SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM n)),
c AS (
  SELECT g, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)), lambda a, y: xor(a >> 8, t[xor(a, y) % 256 + 1])), 4294967295) % 10000 AS k FROM x, e),
h AS (SELECT r, k, sum(n) AS n FROM n JOIN c USING (g) GROUP BY r, k),
q AS (SELECT k, sum(n) FILTER (r > 0) AS s, sum(n) FILTER (r = 0) AS t FROM h GROUP BY k),
z AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s, coalesce(sum(t), 0)::DOUBLE AS t FROM q),
j AS (SELECT k, floor(1000 * ln((coalesce(q.t, 0) + 1)::DOUBLE * (z.s + 10000) / ((coalesce(q.s, 0) + 1)::DOUBLE * (z.t + 10000))))::BIGINT AS j FROM q, z),
v AS (SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * j)::DOUBLE / sum(n))::BIGINT AS weight FROM h JOIN j USING (k) WHERE r > 0 GROUP BY r),
y AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN v USING (r)),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS rank, count(*) OVER () AS n FROM y WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN o.rank <= 25 * o.n // 100 THEN o.rank END AS rank FROM y LEFT JOIN o USING (r)
"""
