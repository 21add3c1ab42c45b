"""SimHash near-dedup by deletion-variant signatures.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. Of two fingerprints that differ
in at most four bits, some segment differs in at most one. Each fingerprint is therefore indexed under
its 64 one-wildcard variants (a segment with one of its bits left out); two segments that differ in at
most one bit share a variant. Equal variants are joined by sorting, and every candidate is verified
with an exact XOR and bit count. Fewer, wider segments than the plain pigeonhole (five of 12 or 13
bits) keep the lists of a key short.

Only distinct fingerprints are indexed, so copies cost nothing. A key's list is linked breadth first:
a group whose members all lie near one of them takes one vector operation, not one for each pair. A
list longer than ``LIST_ROWS`` is cut into blocks, and every pair of blocks becomes a cell of its own.

``near_groups`` links by bits. ``near_copies`` links by the Jaccard similarity of word shingles, where
fingerprints are the first way to candidates and not the last: pairs at 0.8 differ in about 10 of 64
bits, beyond any signature of this kind. What the signatures bring together is verified on whole sets and
joined at once, with what a pass over shared shingles holds to be alike; that folds large groups of near
copies. An exact prefix-filter join (``jaccard``) then finds the pairs between what is left.

Defined cases: a text without words, or null, has fingerprint zero, linked like any other; a text with
fewer words than a shingle is one shingle; rows that repeat a doc_id are fingerprinted one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import NULL_ID, materialize, texts, tuned, unkey
from benchlake.llm.components import connected_components
from benchlake.llm.runs import bounds, roots, whole_runs

SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 4
SEED = 42
LIST_ROWS = 8192
#: Lists up to this length are compared all at once with those of other keys.
SHORT = 48
#: Rows of a sorted stream that are worked on at once.
STREAM_ROWS = 1 << 16


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """The XXH64 of each word shingle of a text, repeats included; none if there are no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    start, end = (ends - size)[: max(1, len(words) - shingle + 1)].tolist(), (ends[shingle - 1 :].tolist() or [len(joined)])
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[i:j], SEED) for i, j in zip(start, end, strict=True)], "<u8")


def majority(h: np.ndarray) -> int:
    """The fingerprint of shingle hashes as a signed 64-bit integer: bits set in over half of them."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 4096):  # bits of bounded slices
        ones += np.unpackbits(h[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprint(text: str, shingle: int = 4) -> int:
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """Per row: doc_id, fp."""
    tuned(docs.sparkSession)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], pa.int64())], names=["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def variants(fp: Column) -> Column:
    """The 64 keys of a fingerprint: the number of the bit left out, then its segment without it."""
    keys = []
    for low, width in SEGMENTS:
        for bit in range(width):
            mask = ((1 << width) - 1) & ~(1 << bit)
            keys.append(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit(mask).cast("long")).bitwiseOR(F.lit((low + bit) << 22).cast("long")))
    return F.array(*keys)


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).astype(np.uint64)) <= MAX_BITS  # of a signed number it would count the absolute value's


def _breadth_first(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) that join what is joined by links in fp: a spanning forest."""
    left, a, b, front = np.arange(1, len(fp)), [], [], [0]
    while len(left):
        at = front.pop() if front else None
        if at is None:
            at, left = int(left[0]), left[1:]
            front = []
        hit = near(fp[left], fp[at])
        found = left[hit]
        a += [np.full(len(found), at)]
        b += [found]
        left = left[~hit]
        front += found.tolist()
    return np.concatenate([*a, []]).astype(np.int64), np.concatenate([*b, []]).astype(np.int64)


def _forest(fp: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, representative) for what the links a-b join."""
    if not len(a):
        return fp[:0], fp[:0]
    nodes, at = np.unique(np.concatenate([fp[a], fp[b]]), return_inverse=True)
    root = nodes[roots(len(nodes), at[: len(a)], at[len(a) :])]
    moved = root != nodes
    return nodes[moved], root[moved]


def _lists(fp: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each run of fp."""
    size = np.diff(edges)
    a, b = [], []
    for k in np.flatnonzero(size > SHORT):
        x, y = _breadth_first(fp[edges[k] : edges[k + 1]])
        a.append(x + edges[k])
        b.append(y + edges[k])
    keep = (size > 1) & (size <= SHORT)
    rows = np.concatenate([np.arange(s, e) for s, e in zip(edges[:-1][keep], edges[1:][keep], strict=True)] or [np.zeros(0, np.int64)])
    end = np.repeat(edges[1:][keep], size[keep])
    for gap in range(1, SHORT):
        live = rows + gap < end
        rows, end = rows[live], end[live]
        if not len(rows):
            break
        hit = near(fp[rows], fp[rows + gap])
        a.append(rows[hit])
        b.append(rows[hit] + gap)
    return np.concatenate([*a, []]).astype(np.int64), np.concatenate([*b, []]).astype(np.int64)


_SCHEMA = "a long, b long, key long, block long"


def _out(a=(), b=(), key=None, block=None) -> pa.RecordBatch:
    n = len(a)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()) if len(b) else none, none if key is None else pa.array(key, pa.int64()), none if block is None else pa.array(block, pa.int64())], names=["a", "b", "key", "block"])


def _verify(batches):
    """Rows (key, fp) in order: links, and the rows of lists that are too long, with their block."""
    seen, last = 0, None
    for t, whole in whole_runs(batches, 1, STREAM_ROWS):
        k, fp = t.column(0).to_numpy(), t.column(1).to_numpy()
        edges = bounds([k])
        if not whole:
            seen, last = (seen if last == k[0] else 0), k[0]
            yield _out(fp, key=k, block=(np.arange(len(fp)) + seen) // LIST_ROWS)
            seen += len(fp)
            continue
        long = np.diff(edges) > LIST_ROWS
        for i in np.flatnonzero(long):
            part = slice(edges[i], edges[i + 1])
            yield _out(fp[part], key=k[part], block=np.arange(len(fp[part])) // LIST_ROWS)
        short = ~np.repeat(long, np.diff(edges))
        fp = fp[short]
        if len(fp):
            yield _out(*_forest(fp, *_lists(fp, bounds([k[short]]))))


def _verify_cells(batches):
    """Rows (key, low block, high block, fp) in order: links."""
    for t, _ in whole_runs(batches, 3, 4 * LIST_ROWS):
        fp, edges = t.column(3).to_numpy(), bounds([t.column(k).to_numpy() for k in range(3)])
        yield _out(*_forest(fp, *_lists(fp, edges)))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that join all that are within MAX_BITS."""
    keyed = distinct.select(F.explode(variants(F.col("fp"))).alias("key"), "fp")
    found = keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_verify, _SCHEMA)
    found = materialize(found, "candidates")
    hot = found.filter("key is not null").select("key", "block", F.col("a").alias("fp"))
    blocks = hot.groupBy("key").agg((F.max("block")).alias("last"))
    cells = hot.join(blocks, "key").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    cells = cells.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "fp")
    far = cells.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "fp").mapInArrow(_verify_cells, _SCHEMA)
    return found.filter("key is null").select("a", "b").union(far.select("a", "b"))


def near_groups(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """Per row: doc_id, fingerprint (hex), component_id: the smallest doc_id reachable by links."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    joined = connected_components(links(distinct.select("fp")))
    named = distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    # a table of its own: a join of two plain sides may split the rows of a large component
    least = materialize(named.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    classes = named.join(least, "component").select("fp", "component_id")
    out = prints.join(classes, "fp")
    return out.select(unkey("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), unkey("component_id"))


def near_copies(docs: DataFrame, shingle: int = 5, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """Per row: doc_id, row (hash of the text), component_id, kept. component_id is the smallest doc_id (no
    null if there is another) of what pairs with a Jaccard similarity of ``least`` (a fraction) or more
    join; one row of each component is kept, or the rows that repeat its doc_id and text. Every such pair
    counts, and no other. Texts without words are near copies of each other only; a text with fewer words
    than a shingle is one shingle."""
    from benchlake.llm import jaccard

    tuned(docs.sparkSession)
    prints = materialize(jaccard.prints(docs, shingle, least), "prints")
    nodes = materialize(prints.dropDuplicates(["node"]), "nodes")
    first = materialize(nodes.groupBy("fp").agg(F.min("node").alias("first")), "first")
    alike = nodes.select("node", "fp").join(first, "fp").select(F.col("node").alias("a"), F.col("first").alias("b"))
    linked = links(first.select("fp"))
    for side in ("a", "b"):
        linked = linked.join(first.select(F.col("fp").alias(side), F.col("first").alias(f"node_{side}")), side).drop(side)
    early = jaccard.verified(docs, nodes, alike.union(linked.select("node_a", "node_b")).union(jaccard.stars(nodes, least)), shingle, least)
    joined = connected_components(early)
    placed = materialize(nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    late = jaccard.verified(docs, nodes, jaccard.candidates(placed, least), shingle, least)
    again = connected_components(late.join(joined.toDF("a", "of_a"), "a", "left").join(joined.toDF("b", "of_b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    named = placed.select("node", "component").join(again.toDF("component", "joined"), "component", "left").select("node", F.coalesce("joined", "component").alias("component"))
    rows = materialize(prints.select("doc_id", "row", "node").join(named, "node").select("doc_id", "row", "component"), "rows")
    smallest = F.min(F.struct((F.col("doc_id") == NULL_ID).alias("none"), "doc_id", "row"))
    # a table of its own: a join of two plain sides may split the rows of a large component
    stays = materialize(rows.groupBy("component").agg(smallest.alias("s")).select("component", F.col("s.doc_id").alias("component_id"), F.col("s.row").alias("first_row")), "stays")
    kept = (F.col("doc_id") == F.col("component_id")) & (F.col("row") == F.col("first_row"))
    return rows.join(stays, "component").select(unkey("doc_id"), "row", unkey("component_id"), kept.alias("kept"))
