"""Near copies by the Jaccard similarity of word shingles: what ``simhash.near_copies`` needs beside its
signatures, an exact set join between sets that are not joined yet.

Two sets at the bound share one of their first few shingles in any order of all shingles (prefix filter);
the order puts shingles that are common in a sample last, which only keeps lists short and never changes
the result.

1. A narrow pass writes for each row the hash of its shingle set (its node), its fingerprint, the prefix,
   and a parity bitmap of the set. Equal sets are one node.
2. Folding (``stars``): the ``EARLY`` shingles of a set with the smallest hashes, of which near copies share
   some, are dealt with the bitmaps. Each list is gone
   through breadth first by the similarity that bitmaps estimate: a group whose members all lie near one of
   them gives a star, not all its pairs. What the stars claim is verified like any candidate.
3. Completion (``candidates``): all prefixes are dealt, with components. Only rows of lists with more than
   one component stay, and only they fetch bitmaps; pairs of different components that sizes allow and
   whose bitmaps do not differ in more bits than the sets may differ in shingles (a lower bound, so
   nothing is lost) are candidates. A list longer than ``LIST_ROWS`` is cut into blocks in order of
   components, and every pair of blocks with two components or more becomes a cell of its own.
4. Candidates of large sets, which fill a bitmap of that size, are held against wider ones first; what is left is
   compared set by set.

Shingles stand for themselves by their 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import handing_back, keyed_texts, materialize, release, texts
from benchlake.llm.runs import bounds, whole_runs
from benchlake.llm.simhash import majority, shingle_hashes

SEED = 42
LIST_ROWS = 8192
STREAM_ROWS = 1 << 16
#: Bits of a parity bitmap.
BITS = 1024
#: Shingles of a set that folding goes by, and centres of a list that it holds at once.
EARLY, CENTRES = 6, 256
#: Pairs of a node in a list that are only about at the bound and still are verified.
TRIES = 4
#: Rows and shingles of the sample that orders shingles.
SAMPLE_ROWS, COMMON = 20_000, 1 << 16


def shingles(h: np.ndarray) -> np.ndarray:
    """The sorted, distinct hashes of a text's shingles (one zero if there are none)."""
    return np.unique(h) if len(h) else np.zeros(1, np.uint64)


def _node(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), SEED)).view(np.int64))


def _parity(s: np.ndarray, bits: int) -> bytes:
    """The parity bitmap of a set; folded in halves by XOR it is the one of half as many bits."""
    return np.packbits((np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def _common(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, weight) of the shingles that are common in a sample of bounded size, sorted by hash."""
    rows = docs.count()
    part = texts(docs.sample(min(1.0, SAMPLE_ROWS / max(rows, 1)), seed=SEED))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *(shingles(shingle_hashes(t, size)) for t in b.column(1).to_pylist())]).view(np.int64))], names=["h"])

    seen = part.mapInArrow(run, "h long").groupBy("h").count().filter("count > 2").orderBy(F.desc("count"), "h").limit(COMMON).collect()
    h, w = np.array([r[0] for r in seen], np.int64).view(np.uint64), np.array([r[1] for r in seen], np.int64)
    order = np.argsort(h)
    return h[order], w[order]


def prints(docs: DataFrame, size: int, least: tuple[int, int]) -> DataFrame:
    """Per row: doc_id, row (hash of the text), node, fp (fingerprint), n (shingles), bits (parity bitmap), wide (a wider one
    of a large set, else null), prefix, early (the shingles with the smallest hashes)."""
    num, den = least
    common, weight = _common(docs, size)

    def run(batches):
        for b in batches:
            out = []
            for t in b.column(2).to_pylist():
                h = shingle_hashes(t, size)
                s = shingles(h)
                w = np.zeros(len(s), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    w = np.where(common[at] == s, weight[at], 0)
                first = len(s) + -(num * len(s) // den) - (num * len(s) % den > 0) + 1
                wide = _parity(s, min(1 << 17, 1 << (2 * len(s) - 1).bit_length())) if 2 * len(s) > BITS else None
                out.append((_node(s), majority(h), len(s), _parity(s, BITS), wide, s[np.lexsort((s, w))[:first]].view(np.int64), s[:EARLY].view(np.int64)))
            node, fp, n, bits, wide, prefix, early = zip(*out, strict=True) if out else ((),) * 7
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node, pa.int64()), pa.array(fp, pa.int64()), pa.array(n, pa.int64()), pa.array(bits, pa.binary()), pa.array(wide, pa.binary()), *(pa.array(list(x), pa.list_(pa.int64())) for x in (prefix, early))], names=["doc_id", "row", "node", "fp", "n", "bits", "wide", "prefix", "early"])

    return keyed_texts(docs).mapInArrow(handing_back(run), "doc_id long, row long, node long, fp long, n long, bits binary, wide binary, prefix array<long>, early array<long>")


def _bitmaps(t: pa.Table, k: int) -> np.ndarray:
    return np.frombuffer(b"".join(t.column(k).to_pylist()), np.uint64).reshape(len(t), -1)


def _may_be(n: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """Whether pairs of positions may be at the bound: sets that differ in d shingles share (n + m - d) / 2,
    and d is at least the number of bits that differ."""
    num, den = least
    out = np.zeros(len(i), bool)
    for k in range(0, len(i), 1 << 14):
        x, y = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
        d = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64)
        out[k : k + (1 << 14)] = (n[x] + n[y] - d) * (num + den) >= 2 * num * (n[x] + n[y])
    return out


def _likeness(n: np.ndarray, bits: np.ndarray, i: int, j: np.ndarray) -> np.ndarray:
    """The similarity of j to i by their bitmaps, taking for the number of shingles that differ what so many
    differing bits stand for on average."""
    share = np.minimum(np.bitwise_count(bits[i] ^ bits[j]).sum(1) * 2 / BITS, 0.98)
    d = np.log1p(-share) / np.log1p(-2 / BITS)
    return (n[i] + n[j] - d) / (n[i] + n[j] + d)


def stars(nodes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b): pairs of nodes that bitmaps hold to be at the bound: a spanning forest for each list of what is
    surely there, and a few more pairs of each node that are about there."""
    bound = least[0] / least[1]
    sure, about = bound + (1 - bound) / 10, bound - (1 - bound) / 5

    def run(batches):
        """Rows (key, n, node, bits) in order. Of a run that comes in pieces the last centres go on."""
        held: tuple | None = None  # key, n, node and bits of the centres of a run that is not over
        strange = None  # the key of a run of strangers
        for t, whole in whole_runs(batches, 1, STREAM_ROWS):
            key, n, node = (t.column(k).to_numpy() for k in range(3))
            if not whole and key[0] == strange:
                continue
            bits = _bitmaps(t, 3)
            if held is not None and held[0] == key[0]:
                n, node, bits = np.append(held[1], n), np.append(held[2], node), np.concatenate([held[3], bits])
                key = np.append(np.full(len(held[1]), key[0]), key)
            edges, out, tried = bounds([key]), [], np.zeros(len(key), np.int64)
            centres = np.zeros(0, np.int64)
            for a, z in zip(edges[:-1], edges[1:], strict=True):
                left, front, centres = np.arange(a, z), [], []
                while len(left):
                    at = front.pop() if front else None
                    if at is None:
                        at, left = left[0], left[1:]
                        centres.append(at)
                    like = _likeness(n, bits, at, left)
                    hit = like >= sure
                    some = left[(like >= about) & (hit | (tried[left] < TRIES))]
                    tried[some] += 1
                    out.append(np.stack([np.full(len(some), node[at]), node[some]], 1))
                    found, left = left[hit], left[~hit]
                    front += found.tolist()[:CENTRES]
                    if len(centres) > 4 * CENTRES:
                        break  # of a long list of strangers; folding may leave what it likes
            held = None
            if not whole:
                c = np.array(centres[-CENTRES:], np.int64)
                held = (key[-1], n[c], node[c], bits[c])
                strange = key[-1] if sum(map(len, out)) * 10 < len(key) else None
            if out:
                pairs = np.concatenate(out)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def shared(batches):
        """Rows (key, node) in order: those of lists of two or more."""
        for t, whole in whole_runs(batches, 1, STREAM_ROWS):
            edges = bounds([t.column(0).to_numpy()])
            yield from (t.filter(pa.array(np.repeat(np.diff(edges) > 1, np.diff(edges)))) if whole else t).to_batches()

    keyed = nodes.select(F.explode("early").alias("key"), "node")
    some = materialize(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(shared, "key long, node long"), "shared")
    wide = some.join(nodes.select("node", "n", "bits"), "node").select("key", "n", "node", "bits")
    return wide.repartition("key").sortWithinPartitions("key", "n", "node").mapInArrow(run, "a long, b long")


def candidates(placed: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b): pairs of nodes of different components that may be at the bound. placed: node, n, bits, prefix,
    component."""
    num, den = least

    def open_rows(batches):
        """Rows (key, component, node) in order: (key, node, block) of those of lists with more than one
        component; block is null but in lists of more than LIST_ROWS, which are cut without being held."""
        last, seen = None, 0
        for t, whole in whole_runs(batches, 1, STREAM_ROWS):
            key, component = t.column(0).to_numpy(), t.column(1).to_numpy()
            edges = bounds([key])
            size = np.diff(edges)
            at = np.arange(len(key)) - np.repeat(edges[:-1], size)
            if whole:
                keep = np.repeat(np.minimum.reduceat(component, edges[:-1]) != np.maximum.reduceat(component, edges[:-1]), size)
                short = np.repeat(size <= LIST_ROWS, size)
            else:
                last, seen = key[0], seen if last == key[0] else 0
                at, keep, short = at + seen, np.ones(len(key), bool), np.zeros(len(key), bool)
                seen += len(key)
            out = pa.table([t.column(0), t.column(2), pa.array(at // LIST_ROWS, mask=short)], names=["key", "node", "block"])
            yield from out.filter(pa.array(keep)).to_batches()

    def pairs_of(n, node, bits, edges, apart):
        """Pairs of rows (by size) of one run that differ in every column of apart and may be at the bound."""
        rows, end, gap, found = np.arange(len(n)), np.repeat(edges[1:], np.diff(edges)), 0, []
        while len(rows):
            gap += 1
            live = rows + gap < end
            rows, end = rows[live], end[live]
            live = n[rows + gap] * num <= n[rows] * den
            rows, end = rows[live], end[live]
            hit = np.ones(len(rows), bool)
            for x in apart:
                hit &= x[rows] != x[rows + gap]
            i = rows[hit]
            i = i[_may_be(n, bits, i, i + gap, least)]
            found.append(np.stack([np.minimum(node[i], node[i + gap]), np.maximum(node[i], node[i + gap])], 1))
        pairs = np.unique(np.concatenate([*found, np.zeros((0, 2), np.int64)]), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def listed(batches):
        """Rows (key, n, node, component, bits) in order: pairs."""
        for t, _ in whole_runs(batches, 1, STREAM_ROWS):
            key, n, node, component = (t.column(k).to_numpy() for k in range(4))
            yield pairs_of(n, node, _bitmaps(t, 4), bounds([key]), [component])

    def cells(batches):
        """Rows (key, low, high, n, node, component, block, bits) in order: pairs."""
        for t, _ in whole_runs(batches, 3, 4 * LIST_ROWS):
            key, low, high, n, node, component, block = (t.column(k).to_numpy() for k in range(7))
            turn = np.where(low == high, np.arange(len(n)), block)  # between two blocks only pairs across
            yield pairs_of(n, node, _bitmaps(t, 7), bounds([key, low, high]), [component, turn])

    keyed = placed.select("component", "node", F.explode("prefix").alias("key")).select("key", "component", "node")
    some = materialize(keyed.repartition("key").sortWithinPartitions("key", "component").mapInArrow(open_rows, "key long, node long, block long"), "open")
    facts = placed.select("node", "n", "component", "bits")
    short = some.filter("block is null").join(facts, "node").select("key", "n", "node", "component", "bits")
    near = short.repartition("key").sortWithinPartitions("key", "n", "node").mapInArrow(listed, "a long, b long")
    hot = some.filter("block is not null")
    if hot.isEmpty():
        return near
    # blocks are cut in order of components: two blocks of one and the same component have nothing to compare
    hot = materialize(hot.join(facts.select("node", "component"), "node"), "hot")
    blocks = materialize(hot.groupBy("key", "block").agg(F.min("component").alias("lo"), F.max("component").alias("hi")), "blocks")
    one, two = (blocks.select("key", F.col("block").alias(n), F.col("lo").alias(f"{n}_lo"), F.col("hi").alias(f"{n}_hi")) for n in ("low", "high"))
    same = (F.col("low_lo") == F.col("low_hi")) & (F.col("high_lo") == F.col("high_hi")) & (F.col("low_lo") == F.col("high_lo"))
    meet = one.join(two, "key").filter((F.col("low") <= F.col("high")) & ~same).select("key", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    split = hot.select("key", "block", "node").join(materialize(meet, "cells"), ["key", "block"]).join(facts, "node")
    split = split.select("key", "low", "high", "n", "node", "component", "block", "bits")
    far = split.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "n", "node").mapInArrow(cells, "a long, b long")
    return near.union(far)


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, least: tuple[int, int]) -> DataFrame:
    """Those of pairs (a, b) of nodes that are at the bound, by their whole sets. nodes: doc_id, row, node,
    n, wide."""
    num, den = least

    def apart(batches):
        """Rows (a, b, n of both, wide bitmaps of both): pairs that differ in too many shingles for sure."""
        for b in batches:
            out = []
            for n, m, x, y in zip(*(b.column(k).to_pylist() for k in range(2, 6)), strict=True):
                size = min(len(x), len(y))
                x, y = (np.bitwise_xor.reduce(np.frombuffer(z, np.uint64).reshape(-1, size // 8), axis=0) for z in (x, y))
                out.append((n + m - int(np.bitwise_count(x ^ y).sum())) * (num + den) < 2 * num * (n + m))
            yield b.select([0, 1]).filter(pa.array(out, pa.bool_()))

    def sets(batches):
        for b in batches:
            s = [shingles(shingle_hashes(t, size)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_node(x) for x in s], pa.int64()), pa.array([x.tobytes() for x in s], pa.binary())], names=["node", "s"])

    def are(batches):
        """Rows (a, b, sets of both): pairs at the bound."""
        for b in batches:
            hit = []
            for s, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                hit.append(len(np.intersect1d(x, y, True)) * (num + den) >= num * (len(x) + len(y)))
            yield b.select([0, 1]).filter(pa.array(hit, pa.bool_()))

    pairs = materialize(pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
    large = nodes.filter("wide is not null").select("node", "n", "wide")
    of = lambda side: large.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("wide").alias(f"wide_{side}"))
    held = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", "wide_a", "wide_b")
    rejected = materialize(held.mapInArrow(apart, "a long, b long"), "rejected")
    pairs = materialize(pairs.join(rejected, ["a", "b"], "left_anti"), "likely")
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialize(named.join(nodes.select("node", "doc_id", "row"), "node").select("doc_id", "row"), "wanted")
    found = keyed_texts(docs).join(wanted, ["doc_id", "row"], "left_semi").select("doc_id", "text").mapInArrow(handing_back(sets), "node long, s binary")
    found = materialize(found.dropDuplicates(["node"]), "sets")
    both = pairs.join(found.select(F.col("node").alias("a"), F.col("s").alias("s_a")), "a").join(found.select(F.col("node").alias("b"), F.col("s").alias("s_b")), "b")
    out = materialize(both.select("a", "b", "s_a", "s_b").mapInArrow(are, "a long, b long"), "near")
    release(pairs, rejected, wanted, found)
    return out
