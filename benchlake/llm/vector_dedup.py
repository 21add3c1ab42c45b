"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosine verification,
distributed connected components.

Equal vectors of one label are folded into one class with a count first. A class is hashed by the
signs of ``bits`` random projections in each of ``tables`` tables; ``bits`` follows the logarithm of
the largest label's size, so that lists stay short at every size, and ``tables`` is what the wanted
recall then takes: a pair at cosine c shares one bit with chance 1 - acos(c) / pi.

What is dealt to every table is a class's number and a signature, the packed signs of the first tables
(``SIGNATURE`` bits at most). A row that has nobody in its list whose signature differs in few enough bits
(six deviations beyond what the cosine makes likely) and whom no earlier table of the signature has
brought to it goes no further. Only the others fetch their vectors. They are compared by one matrix
product in double precision for each list; a pair counts in the first table that brings it together
only, so link counts are exact for what is found. Lists longer than ``LIST_ROWS`` are cut into blocks; every pair of blocks is a
cell of its own. Only counts and a spanning forest leave a list, never its pairs.

Defined cases: vectors that are null, zero or hold null or non-finite components, and rows without a
label, link with nothing and are their own component; vectors of different length are not compared;
components of any finite size count, as a vector is scaled by its largest before it is squared; rows
that repeat a vec_id are counted as further vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import key, materialize, tuned, unkey
from benchlake.llm.components import connected_components
from benchlake.llm.runs import roots, whole_runs

COSINE = 0.93
RECALL = 0.9995
LIST_ROWS = 1024
SEED = 20240229
#: Rows of one list that the hashing aims at, where vectors are spread evenly.
AIM_ROWS = 8
#: Signs that a signature holds at most, and deviations of their number beyond which a pair is none.
SIGNATURE, DEVIATIONS = 512, 6
#: Rows of a sorted stream that are worked on at once.
STREAM_ROWS = 1 << 15


def shape(rows: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for a label with so many rows."""
    bits = min(31, max(8, math.ceil(math.log2(max(rows, 1) / AIM_ROWS + 1))))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log1p(-same)))


def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, bits * tables))


def _matrix(col: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of doubles."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def _unpacked(col: pa.Array, dim: int, kind: str) -> np.ndarray:
    """Packed vectors as rows of doubles."""
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(len(col), dim).astype(np.float64)


_HASHED = "cid long, label long, dim long, cnt long, codes binary, sig binary, v binary"
_LISTED = "label long, dim long, t long, code long, cid long, sig binary"


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one. Scaling first keeps squares of very large and very small components finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def signed_tables(bits: int, tables: int) -> int:
    """How many tables a signature holds."""
    return min(tables, max(1, SIGNATURE // bits))


def _hash(bits: int, tables: int, kind: str):
    weights, held = (1 << np.arange(bits, dtype=np.int64))[:, None], signed_tables(bits, tables)

    def run(batches):
        known: dict[int, np.ndarray] = {}
        for b in batches:
            size = b.column(4).to_numpy()
            for dim in np.unique(size):
                part = b.filter(pa.array(size == dim))
                if dim not in known:
                    known[dim] = planes(int(dim), bits, tables)
                for at in range(0, part.num_rows, 1024):
                    rows = part.slice(at, 1024)
                    x = _matrix(rows.column(3))
                    signs = (_unit(x) @ known[dim] > 0).reshape(rows.num_rows, tables, bits)
                    codes = (signs.astype(np.int64) @ weights)[:, :, 0]
                    packed = (pa.array([r.tobytes() for r in m], pa.binary()) for m in (codes.astype("<i4"), np.packbits(signs[:, :held].reshape(rows.num_rows, -1), axis=1), x.astype(kind)))
                    yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(4), rows.column(2), *packed], names=["cid", "label", "dim", "cnt", "codes", "sig", "v"])

    return run


def _deal(tables: int):
    """A row (cid, label, dim, codes, sig) for each table."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            codes = np.frombuffer(b"".join(b.column(3).to_pylist()), "<i4").reshape(b.num_rows, -1)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(np.full(b.num_rows, t)), pa.array(codes[:, t].astype(np.int64)), b.column(0), b.column(4)], names=["label", "dim", "t", "code", "cid", "sig"])

    return run


def _promising(bits: int, tables: int, cosine: float):
    """Rows of _LISTED in order of label, dim, t, code: those that may have a new link in their list, without
    their signature, and all rows of long lists."""
    held = signed_tables(bits, tables)
    weights = (1 << np.arange(bits, dtype=np.int64))[:, None]
    p = math.acos(cosine) / math.pi
    most = math.floor(held * bits * p + DEVIATIONS * math.sqrt(held * bits * p * (1 - p)) + 1)

    def new(sig: np.ndarray, i: np.ndarray, j: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Which pairs of rows no table of the signature before their own has brought together."""
        one, two = ((np.unpackbits(sig[x], axis=1, count=held * bits).reshape(len(x), held, bits).astype(np.int64) @ weights)[:, :, 0] for x in (i, j))
        return ~((one == two) & (np.arange(held) < table[:, None])).any(1)

    def run(batches):
        for t, whole in whole_runs(batches, 4, STREAM_ROWS):
            if not whole:
                yield from t.select(range(5)).to_batches()
                continue
            cols = [t.column(k).to_numpy() for k in range(4)]
            edges = np.concatenate([[0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1, [len(t)]])
            size = np.diff(edges)
            keep = np.repeat(size > LIST_ROWS, size)
            sig = np.frombuffer(b"".join(t.column(5).to_pylist()), np.uint8).reshape(len(t), -1)
            words = np.zeros((len(t), -(-sig.shape[1] // 8) * 8), np.uint8)
            words[:, : sig.shape[1]] = sig
            words = words.view(np.uint64)
            rows, end = np.flatnonzero(~keep), np.repeat(edges[1:], size)[~keep]
            for gap in range(1, LIST_ROWS):  # neighbours of all lists, then those two apart, and so on
                live = rows + gap < end
                rows, end = rows[live], end[live]
                if not len(rows):
                    break
                i = rows[np.bitwise_count(words[rows] ^ words[rows + gap]).sum(1, dtype=np.int64) <= most]
                if len(i):
                    i = i[new(sig, i, i + gap, cols[2][i])]
                    keep[i] = keep[i + gap] = True
            yield from t.select(range(5)).filter(pa.array(keep)).to_batches()

    return run


_FOUND = "cid long, links long, root long, label long, dim long, t long, code long, block long"


def _links(t: pa.Table, dim: int, table: int, cosine: float, kind: str, cross: np.ndarray | None = None) -> pa.RecordBatch:
    """Link counts and a forest of one list. cross: the block of each row; then only pairs across
    blocks count, or all if there is one block."""
    x = _unit(_unpacked(t.column("v"), dim, kind))
    a, b = np.nonzero(np.triu(x @ x.T >= cosine, 1))
    if cross is not None and len(np.unique(cross)) > 1:
        live = cross[a] != cross[b]
        a, b = a[live], b[live]
    if len(a) and table:
        codes = np.frombuffer(b"".join(t.column("codes").to_pylist()), "<i4").reshape(len(t), -1)[:, :table]
        new = np.ones(len(a), bool)
        for s in range(table):  # pairs that an earlier table has brought together
            new &= codes[a, s] != codes[b, s]
        a, b = a[new], b[new]
    cid, cnt = t.column("cid").to_numpy(), t.column("cnt").to_numpy()
    n = len(t)
    count = np.bincount(a, cnt[b], n) + np.bincount(b, cnt[a], n)
    root = cid[roots(n, a, b)]
    hit = count > 0
    return _found(cid[hit], count[hit].astype(np.int64), root[hit])


def _found(cid, links=None, root=None, rest=None) -> pa.RecordBatch:
    n, none = len(cid), pa.nulls(len(cid), pa.int64())
    cols = [pa.array(cid, pa.int64()), none if links is None else pa.array(links, pa.int64()), none if root is None else pa.array(root, pa.int64())]
    return pa.RecordBatch.from_arrays(cols + ([none] * 5 if rest is None else [pa.array(r, pa.int64()) for r in rest]), names=["cid", "links", "root", "label", "dim", "t", "code", "block"])


def _lists(cosine: float, kind: str):
    def run(batches):
        seen, last = 0, None
        for t, whole in whole_runs(batches, 4, 4 * LIST_ROWS):
            cols = [t.column(k).to_numpy() for k in range(4)]
            edges = np.concatenate([[0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1, [len(t)]])
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                key_ = tuple(int(c[i]) for c in cols)
                if whole and j - i <= LIST_ROWS:
                    if j - i > 1:
                        yield _links(t.slice(i, j - i), key_[1], key_[2], cosine, kind)
                    continue
                seen, last = (seen if last == key_ else 0), key_
                n = int(j - i)
                yield _found(t.column("cid").to_numpy()[i:j], rest=[*(np.full(n, k) for k in key_), (np.arange(n) + seen) // LIST_ROWS])
                seen += n

    return run


def _cells(cosine: float, kind: str):
    def run(batches):
        for t, _ in whole_runs(batches, 6, 4 * LIST_ROWS):
            cols = [t.column(k).to_numpy() for k in range(6)]
            edges = np.concatenate([[0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1, [len(t)]])
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                part = t.slice(i, j - i)
                yield _links(part, int(cols[1][i]), int(cols[2][i]), cosine, kind, part.column("block").to_numpy())

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    tuned(vectors.sparkSession)
    v = F.col("embedding").cast("array<double>")
    sound = F.col("label").isNotNull() & v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(key("vec_id"), F.when(sound, F.col("label").cast("long")).alias("label"), F.when(sound, v).alias("v"))
    good = rows.filter("label is not null")
    classes = materialize(good.groupBy("label", "v").agg(F.min("vec_id").alias("cid"), F.count("*").alias("cnt")), "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits, tables = shape(largest, cosine, recall)
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "<f4" if single else "<f8"  # how vectors travel: as exact as they came
    source = classes.select("cid", "label", "cnt", "v", F.size("v").cast("long").alias("dim"))
    hashed = materialize(source.repartition("cid").mapInArrow(_hash(bits, tables, kind), _HASHED), "hashed")
    listed = hashed.select("cid", "label", "dim", "codes", "sig").mapInArrow(_deal(tables), _LISTED)
    keys = ["label", "dim", "t", "code"]
    some = materialize(listed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_promising(bits, tables, cosine), "label long, dim long, t long, code long, cid long"), "promising")
    facts = hashed.select("cid", "cnt", "codes", "v")
    wide = some.join(facts, "cid").select(*keys, "cid", "cnt", "codes", "v")
    found = materialize(wide.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_lists(cosine, kind), _FOUND), "links")
    hot = found.filter("block is not null").select(*keys, "block", "cid")
    last = hot.groupBy(*keys).agg(F.max("block").alias("last"))
    cells = hot.join(last, keys).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    cells = cells.select(*keys, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "cid", "block")
    cells = cells.join(facts, "cid").select(*keys, "low", "high", "cid", "block", "cnt", "codes", "v")
    cell_keys = [*keys, "low", "high"]
    far = materialize(cells.repartition(*cell_keys).sortWithinPartitions(*cell_keys).mapInArrow(_cells(cosine, kind), _FOUND), "far_links")
    near = found.filter("block is null").union(far)
    joined = connected_components(near.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    counts = near.groupBy("cid").agg(F.sum("links").alias("links"))
    done = classes.join(counts, "cid", "left").join(joined.withColumnRenamed("node", "cid"), "cid", "left")
    done = done.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("cnt") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component_id"))
    out = rows.join(done, ["label", "v"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.select(unkey("vec_id"), "n_links", unkey("component_id"), (F.col("vec_id") == F.col("component_id")).alias("kept"))


ORACLE = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
r(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x), n AS (SELECT x AS vec_id, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""
