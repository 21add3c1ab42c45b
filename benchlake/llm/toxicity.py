"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashes of its distinct words (runs of letters and digits, lower case), its
pairs of neighbouring words and its pairs with one word between. They are presence features without
regard to length, so a long text is judged by what it holds, not by how much else it holds.

Training: per-coordinate rates, L1 sparsity. Up to ``max_labelled`` labelled documents (a documented bound;
those with the smallest hash of doc_id, so any order of the input gives the same ones) are learnt from online, one
text each, over several epochs, in one task whose input that bound keeps small. A larger bound is
dealt to shards of ``shard_rows`` whose weights are averaged; one shard learns rare words better. The few weights that
L1 leaves are shipped to a single narrow scoring pass over all documents. Labels are learnt only from rows whose
crc32(doc_id) mod 5 is not 0.

Defined cases: null and empty texts have no feature and get the intercept's score; a document with
several labels counts as toxic if any says so; labels of unknown documents or with nulls are ignored;
without any label a document is not held to be toxic (every score is ``UNKNOWN``); rows that repeat a doc_id are scored
one by one, and of a labelled one the text with the smallest hash is learnt from; a null doc_id is never learnt from, and
``held_out`` says false for it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.llm.common import NULL_ID, handing_back, key, materialize, texts, tuned, unkey

BITS = 20
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 10.0, 1.0, 5
#: At most so many labelled rows are learnt from.
MAX_LABELLED = 20_000
SHARD_ROWS = 20_000
HELD_OUT = 5
#: The score of every document where there are no labels to learn from.
UNKNOWN = 0.1
_WORD = re.compile(r"[^\W_]+")
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))
#: Words whose hash a worker remembers before it starts afresh.
REMEMBERED = 100_000


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(word) <= 64:
            self[word] = h
        return h


_HASHES = _Hashes()


def features(text: str, bits: int = BITS) -> np.ndarray:
    """Hashed features of a text, with repeats: words, neighbours, skip-grams."""
    words = _WORD.findall(text.lower())
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    out = [h]
    for gap in (1, 2):
        if len(h) > gap:
            out.append((h[:-gap] * _A) ^ ((h[gap:] + np.uint64(gap)) * _B))
    z = np.concatenate(out)
    z ^= z >> np.uint64(29)
    return ((z * _C) >> np.uint64(64 - bits)).astype(np.int64)


class Ftrl:
    """FTRL-proximal state over 2**bits coordinates and an intercept (the last, without L1)."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.l1 = np.full((1 << bits) + 1, l1)
        self.l1[-1] = 0

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, l1 = self.z[at], self.l1[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, x: np.ndarray, y: int) -> None:
        """One step on distinct coordinates x (the intercept included)."""
        w, n = self.weights(x), self.n[x]
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        self.z[x] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[x] = n + g * g


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(HELD_OUT)) == 0


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, shard_rows: int = SHARD_ROWS, bits: int = BITS, epochs: int = EPOCHS) -> dict[int, float]:
    """Coordinate -> weight, zeros left out; coordinate 2**bits is the intercept."""
    tuned(docs.sparkSession)
    known = labels.select(key("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isNotNull() & (F.col("doc_id") != NULL_ID) & ~held_out(F.col("doc_id")))
    known = materialize(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("order", F.xxhash64("doc_id")), "known")
    # which leading bits of the hash the bound reaches, so that no task merges more than about that many rows
    sizes = known.groupBy(F.shiftright("order", 48).alias("b")).count().orderBy("b").collect()  # at most 65,536 rows
    reached = np.searchsorted(np.cumsum([r[1] for r in sizes]), max_labelled)
    if reached < len(sizes):
        known = known.filter(F.shiftright("order", 48) <= sizes[reached][0])
    known = materialize(known.orderBy("order", "doc_id").limit(max_labelled), "labelled")
    rows = known.count()
    if not rows:
        return {1 << bits: float(np.log(UNKNOWN / (1 - UNKNOWN)))}
    shards = -(-rows // shard_rows)
    dealt = known.select("doc_id", "toxic", "order", F.pmod(F.xxhash64("order"), F.lit(shards)).alias("shard"))
    chosen = texts(docs).join(F.broadcast(dealt), "doc_id")  # max_labelled ids at most, and one text of each
    chosen = chosen.groupBy("doc_id", "toxic", "order", "shard").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))

    def extract(batches):
        for b in batches:
            x = [np.append(np.unique(features(t, bits)), 1 << bits).astype(np.int32) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(x, pa.list_(pa.int32()))], names=["shard", "order", "toxic", "x"])

    found = chosen.select("shard", "order", "toxic", "text").mapInArrow(handing_back(extract), "shard long, order long, toxic int, x array<int>")

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("order", kind="stable")
        model, xs, ys = Ftrl(bits), part["x"].tolist(), (part["toxic"] > 0).astype(int).tolist()
        for epoch in range(epochs):
            for k in np.random.default_rng(epoch).permutation(len(xs)):
                model.learn(xs[k], ys[k])
        w = model.weights()
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": at, "w": w[at]})

    each = found.groupBy("shard").applyInPandas(learn, "at long, w double")
    mean = each.groupBy("at").agg((F.sum("w") / shards).alias("w"))
    return {r["at"]: r["w"] for r in mean.collect()}  # at most 2**bits + 1 rows; L1 leaves hundreds


def scorer(spark: SparkSession, weights: dict[int, float], bits: int = BITS) -> Callable[[Column], Column]:
    """Text column -> score column; the weights, a few thousand at most, go to every worker."""
    tuned(spark)
    shipped = spark.sparkContext.broadcast((np.array(sorted(weights), np.int64), np.array([weights[k] for k in sorted(weights)])))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w = shipped.value
        dense = np.zeros((1 << bits) + 1, np.float32)
        dense[at] = w
        bias = float(dense[-1])
        for column in batches:
            out = []
            for t in column:
                x = features(t or "", bits)
                x = np.unique(x[dense[x] != 0])
                out.append(1 / (1 + np.exp(-np.clip(float(dense[x].sum(dtype=np.float64)) + bias, -35, 35))))
            yield pd.Series(out, dtype=float)

    return run


def toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    score = scorer(docs.sparkSession, train(docs, labels, max_labelled))
    scored = texts(docs).select("doc_id", score(F.col("text")).alias("score"))
    return scored.select(unkey("doc_id"), (held_out(F.col("doc_id")) & (F.col("doc_id") != NULL_ID)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
