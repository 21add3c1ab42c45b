"""Suffix-array dedup: removes bytes of strings of ``WINDOW`` bytes that have occurred before.

A full suffix array of the corpus is not needed to know which 100-byte strings repeat: every window
picks the 32-byte gram with the smallest hash inside it (all of them on a tie), so equal windows pick
grams at equal places, and only suffixes at picked grams (anchors, about one byte in 35) are sorted.

1. A narrow pass emits each anchor: hash of its gram, hash of its context (68 bytes before, 100 after,
   cut at the ends of the text), doc_id, position. Anchors are dealt by gram and read in order.
   Anchors with equal contexts are copies: all but the first are covered from end to end at once and
   go no further, however many there are. A gram with one context is done as well.
2. The contexts of the other grams are counted, and their first anchors fetch their context bytes. Right contexts, and left contexts read backwards, are put in suffix order by
   deep-shallow sorting: multikey quicksort over eight-byte symbols to a shallow depth, then a blind trie
   for each group whose common prefix is longer. The longest common prefixes of neighbours tell for every
   window around an anchor which others equal it, and so which anchor has it first.
3. A group of more than ``GROUP_ROWS`` contexts is parted before any task holds it: windows that lie in the
   same half of the places around the gram share further symbols, so each half is dealt by gram and those
   symbols, again and again until the groups can be sorted. What is left at one single place is equal
   windows, whose first an aggregation finds.
4. The covered ranges are united for each document.

Two context hashes of 64 bits, below an equal gram hash of 64 bits, stand for equal bytes in step 1; a
comparison of the bytes would move 168 of them for each copy. In step 2 the bytes of the grams are compared: a group whose
grams share a hash alone is sorted from their first byte on.

Defined cases: null and empty texts have nothing to remove, as all under ``WINDOW`` bytes; rows that
repeat a doc_id (null is one) with the same text are one document, returned as often as given; rows that
share a doc_id with different texts are documents of their own; order is by doc_id, a null one first,
then by the hash of the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import keyed_texts, materialize, release, tuned, unkey
from benchlake.llm.runs import bounds, whole_runs

WINDOW, GRAM = 100, 32
REACH = WINDOW - GRAM  # bytes of a window that may lie before its anchor
#: Contexts of one gram that are sorted in one task.
GROUP_ROWS = 32_768
#: Eight-byte symbols that multikey quicksort looks at before blind tries take over.
SHALLOW = 7
#: Bytes of a text that are scanned at once.
SEGMENT = 1 << 15
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _slide(v: np.ndarray, width: int, f) -> np.ndarray:
    """f over every run of ``width`` values."""
    n = 1
    while 2 * n <= width:
        v = f(v[:-n], v[n:])
        n *= 2
    return f(v[: len(v) - (width - n)], v[width - n :]) if width > n else v


def _grams(a: np.ndarray) -> np.ndarray:
    """The hash of the gram at each position."""
    h = _BYTES[a]
    for k, m in enumerate(_MULTIPLIERS):
        h = h[: -(1 << k)] * m + h[1 << k :]
    return _mixed(h)


def _picked(h: np.ndarray) -> np.ndarray:
    """Which of these grams some window inside them picks."""
    low = np.zeros(len(h) + REACH, np.uint64)
    low[REACH : len(h)] = _slide(h, REACH + 1, np.minimum)
    return _slide(low, REACH + 1, np.maximum) == h


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, gram hash, context hash) of the anchors of a text, scanned in bounded segments."""
    a = np.frombuffer(data, np.uint8)
    n, windows = len(a), len(a) - WINDOW + 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    carried = np.zeros(REACH, bool)  # picks of the windows before among the next positions
    for s in range(0, windows, SEGMENT):
        e = min(s + SEGMENT, windows)
        low, high = max(0, s - REACH), min(n, e - 1 + REACH + WINDOW)  # with the contexts of its anchors
        h = _grams(a[low:high])
        picked = _picked(h[s - low : e + REACH - low])
        picked[:REACH] |= carried
        if e < windows:
            carried, picked = picked[e - s :], picked[: e - s]
        at = np.flatnonzero(picked) + s
        start, stop = np.maximum(at - REACH, 0), np.minimum(at + WINDOW, n)
        c = ((at - start) << 32 | (stop - at)).astype(np.uint64)
        for k in range(-(-(REACH + WINDOW) // GRAM)):  # grams that overlap cover the whole context
            c = _mixed(c * _MULTIPLIERS[0] + h[np.minimum(start + k * GRAM, stop - GRAM) - low])
        found.append((at, h[at - low].view(np.int64), c.view(np.int64)))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none, none)


def _emit(batches):
    """Rows (h, c, doc_id, row, pos) of each anchor. Of equal contexts within a batch only the first has to be
    compared with the rest of the corpus; the others are covered whatever it holds. They are marked by a
    negative position and dealt by a key of their own, so a very common passage does not meet in one task."""
    for b in batches:
        cols: list[list[np.ndarray]] = [[], [], [], [], []]
        for doc, row, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            at, h, c = anchors(text.encode("utf-8", "surrogatepass"))
            for col, x in zip(cols, (h, c, np.full(len(at), doc), np.full(len(at), row), at), strict=True):
                col.append(x)
        h, c, doc, row, pos = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in cols)
        order = np.lexsort((pos, row, doc, c, h))
        h, c, doc, row, pos = (x[order] for x in (h, c, doc, row, pos))
        start = bounds([h, c])
        first = np.repeat(start[:-1], np.diff(start)) if len(h) else start[:0]
        later = (doc != doc[first]) | (row != row[first]) | (pos != pos[first])
        spread = _mixed(h.view(np.uint64) ^ _mixed(doc.view(np.uint64) * _MULTIPLIERS[1] + row.view(np.uint64) * _MULTIPLIERS[2] + pos.view(np.uint64))).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(later, spread, h)), pa.array(c), pa.array(doc), pa.array(row), pa.array(np.where(later, -pos - 1, pos))], names=["h", "c", "doc_id", "row", "pos"])


def _rows(doc, row, a, b=None, h=None) -> pa.RecordBatch:
    none = pa.nulls(len(doc), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(row, pa.int64()), pa.array(a, pa.int64()), none if b is None else pa.array(b, pa.int64()), none if h is None else pa.array(h, pa.int64())], names=["doc_id", "row", "a", "b", "h"])


def _copies(batches):
    """Rows (h, c, doc_id, row, pos) in order: covered ranges (a, b) of copies; (a = position, h) of the first
    anchors of a gram with several contexts."""
    before = None  # the last row of a run given out in pieces, and its context's first
    for t, whole in whole_runs(batches, 1, 1 << 16):
        h, c, doc, row, pos = (t.column(k).to_numpy() for k in range(5))
        known = pos < 0
        if known.any():
            at = -pos[known] - 1
            yield _rows(doc[known], row[known], np.maximum(at - REACH, 0), at + WINDOW)
            h, c, doc, row, pos = (x[~known] for x in (h, c, doc, row, pos))
            if not len(h):
                continue
        start = bounds([h, c])[:-1]
        lead = np.repeat(start, np.diff(np.append(start, len(h))))
        lead_doc, lead_row, lead_pos = doc[lead], row[lead], pos[lead]
        first = np.zeros(len(h), bool)
        first[start] = True
        if before is not None and before[:2] == (h[0], c[0]):
            same = lead == 0
            lead_doc, lead_row, lead_pos = (np.where(same, x, y) for x, y in zip(before[2:], (lead_doc, lead_row, lead_pos), strict=True))
            first[0] = False
        before = None if whole else (h[-1], c[-1], lead_doc[-1], lead_row[-1], lead_pos[-1])
        later = (doc != lead_doc) | (row != lead_row) | (pos != lead_pos)
        yield _rows(doc[later], row[later], np.maximum(pos[later] - REACH, 0), pos[later] + WINDOW)
        if whole:
            run = bounds([h])
            classes = np.add.reduceat(first.astype(np.int64), run[:-1])
            first &= np.repeat(classes > 1, np.diff(run))
        yield _rows(doc[first], row[first], pos[first], h=h[first])


_CONTEXTS = "h long, lo long, hi long, doc_id long, row long, pos long, l binary, r binary"


def _as_contexts(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 8
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:6]), *(pa.array(c, pa.binary()) for c in cols[6:])], names=["h", "lo", "hi", "doc_id", "row", "pos", "l", "r"])


def _contexts(batches):
    """Rows (doc_id, row, text, positions, grams): the context of each anchor, for windows with 0 to REACH
    bytes before it."""
    for b in batches:
        out = []
        for doc, row, text, at, grams in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            out += [(h, 0, REACH, doc, row, p, data[max(0, p - REACH) : p], data[p : p + WINDOW]) for p, h in zip(at, grams, strict=True)]
        yield _as_contexts(out)


def parted(h: int, lo: int, hi: int, left: bytes, right: bytes) -> list[tuple[int, int, int]]:
    """Where an anchor goes if its group is too large: its windows with lo to hi bytes before it in two
    halves, each under a hash of the symbols that all windows of that half hold."""
    out = []
    for a, z in ((lo, (lo + hi) // 2), ((lo + hi) // 2 + 1, hi)):
        if len(left) >= a and len(right) >= WINDOW - z:
            shared = left[len(left) - a :] + right[: WINDOW - z]
            out.append((int.from_bytes(hashlib.blake2b(f"{h}|{a}|{z}|".encode() + shared, digest_size=8).digest(), "little", signed=True), a, z))
    return out


def _part(batches):
    for b in batches:
        rows = zip(*(b.column(k).to_pylist() for k in range(8)), strict=True)
        yield _as_contexts([(*own, *rest, left, right) for h, lo, hi, *rest, left, right in rows for own in parted(h, lo, hi, left, right)])


def blind_trie(strings: list[bytes]) -> list[int]:
    """Suffix order of strings by a blind trie: nodes hold only a depth and branching bytes (-1 where a
    string ends); a descent that skips what it does not test ends at a leaf, and one comparison with
    the leaf's string tells where the new string branches off."""
    root: list | None = None  # node: [depth, {byte: node}]; leaf: [None, [indices]]
    for i, s in enumerate(strings):
        if root is None:
            root = [None, [i]]
            continue
        node = root
        while node[0] is not None:
            d = node[0]
            node = node[1].get(s[d] if d < len(s) else -1) or next(iter(node[1].values()))
        other = strings[node[1][0]]
        if other == s:
            node[1].append(i)
            continue
        k, top = 0, min(len(s), len(other))
        while k < top and s[k] == other[k]:
            k += 1
        mine, theirs = (s[k] if k < len(s) else -1), (other[k] if k < len(other) else -1)
        parent, node = None, root
        while node[0] is not None and node[0] < k:
            parent, node = node, node[1][s[node[0]] if node[0] < len(s) else -1]
        if node[0] == k:
            node[1][mine] = [None, [i]]
            continue
        inner = [k, {theirs: node, mine: [None, [i]]}]
        if parent is None:
            root = inner
        else:
            parent[1][s[parent[0]] if parent[0] < len(s) else -1] = inner
    out, stack = [], [root] if root else []
    while stack:
        node = stack.pop()
        if node[0] is None:
            out += node[1]
        else:
            stack += [node[1][k] for k in sorted(node[1], reverse=True)]
    return out


def deep_shallow(strings: list[bytes], group: np.ndarray, width: int, known: int | np.ndarray = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sort strings of at most ``width`` bytes within their groups (equal, adjacent numbers), of which
    the first ``known`` symbols agree (a number, or one for each string, the same in a group). Returns the order and the common prefix of each string with the
    one before it in that order (0 at a group's start)."""
    n, symbols = len(strings), -(-width // 8) + 1
    padded = np.frombuffer(b"".join(s.ljust(symbols * 8, b"\0") for s in strings), np.uint8).reshape(n, -1)
    size = np.fromiter(map(len, strings), np.int64, n)
    words = padded.view(">u8").astype(np.uint64)
    order, seg, depth = np.arange(n), group.astype(np.int64), np.zeros(n, np.int64) + known
    deep: list[np.ndarray] = []  # positions in order, one array for each group left to a trie
    while True:  # every unfinished segment is split in three about its own pivot at once
        edge = np.flatnonzero(seg[1:] != seg[:-1]) + 1
        start, stop = np.append(0, edge), np.append(edge, n)
        many = stop - start > 1
        sunk = many & (depth[start] >= min(SHALLOW, symbols))
        open_ = many & ~sunk
        if not open_.any():
            deep += [np.arange(a, b) for a, b in zip(start[sunk], stop[sunk], strict=True)]
            break
        length = (stop - start)[open_]
        rows = np.repeat(start[open_] - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(length.sum())
        symbol = words[order[rows], depth[rows]]
        a, b, c = (words[order[x], depth[start[open_]]] for x in (start[open_], (start[open_] + stop[open_]) // 2, stop[open_] - 1))
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), length)
        side = (symbol > pivot).astype(np.int64) + (symbol >= pivot)
        moved = np.argsort(np.repeat(np.arange(len(length)), length) * 3 + side, kind="stable")
        order[rows] = order[rows[moved]]
        depth[rows] = (depth[rows] + (side == 1))[moved]
        fresh = np.zeros(n, np.int64)
        fresh[rows] = side[moved]
        seg = np.cumsum(np.append(0, (seg[1:] != seg[:-1]) | (fresh[1:] != fresh[:-1])))
    for rows in deep:
        own = order[rows]
        skip = min(SHALLOW, symbols) * 8
        order[rows] = own[blind_trie([strings[i][skip:] for i in own])] if len(own) > 2 or len(strings[own[0]]) > skip else own[np.argsort(size[own], kind="stable")]
    lcp = np.zeros(n, np.int64)
    if n > 1:
        differ = padded[order[1:]] != padded[order[:-1]]
        at = np.where(differ.any(1), differ.argmax(1), symbols * 8)
        lcp[1:] = np.minimum(at, np.minimum(size[order[1:]], size[order[:-1]]))
        lcp[1:][group[order[1:]] != group[order[:-1]]] = 0
    return order, lcp


def same_grams(group: np.ndarray, right: list[bytes]) -> np.ndarray:
    """Of each string, whether all grams of its group are the same bytes and not only the same hash."""
    grams = np.frombuffer(b"".join(s[:GRAM].ljust(GRAM, b"\0") for s in right), np.uint8).reshape(-1, GRAM)
    start = bounds([group])
    other = (grams != grams[np.repeat(start[:-1], np.diff(start))]).any(1) | (np.fromiter(map(len, right), np.int64, len(right)) < GRAM)
    return np.repeat(~np.logical_or.reduceat(other, start[:-1]), np.diff(start)) if len(right) else other


def repeated(group: np.ndarray, left: list[bytes], right: list[bytes], lo: np.ndarray | int = 0, hi: np.ndarray | int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """For anchors in order of their occurrence within each group: the largest and the smallest number
    of bytes before the anchor, from lo to hi, of windows that an earlier anchor of the group has too (-1:
    none)."""
    n = len(left)
    by_r, lcp_r = deep_shallow(right, group, WINDOW, same_grams(group, right) * (GRAM // 8))
    by_l, lcp_l = deep_shallow([s[::-1] for s in left], group, REACH)
    new = np.zeros(n, bool)
    new[1:] = group[1:] != group[:-1]  # both orders keep the groups where they are
    size_l, size_r = (np.fromiter(map(len, x), np.int64, n) for x in (left, right))
    most, least = np.full(n, -1), np.full(n, -1)
    run_r, run_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(REACH + 1):
        run_r[by_r] = np.cumsum(new | (lcp_r < WINDOW - a))
        run_l[by_l] = np.cumsum(new | (lcp_l < a))
        whole = np.flatnonzero((size_l >= a) & (size_r >= WINDOW - a) & (lo <= a) & (a <= hi))
        pair = run_r[whole] * (n + 1) + run_l[whole]
        turn = np.argsort(pair, kind="stable")
        again = np.zeros(len(turn), bool)
        again[1:] = pair[turn][1:] == pair[turn][:-1]
        hit = whole[turn[again]]
        most[hit] = a
        least[hit] = np.where(least[hit] < 0, a, least[hit])
    return most, least


_FOUND = "doc_id long, row long, a long, b long"


def _sort(batches):
    """Rows (h, lo, hi, doc_id, row, pos, l, r) in order: covered ranges. Equal rows, as a repeated row gives
    them, are one anchor; without them no group has more than GROUP_ROWS."""
    held: list[pa.Table] = []
    for t, whole in whole_runs(batches, 1, GROUP_ROWS):
        keys = [t.column(k).to_numpy() for k in (0, 3, 4, 5)]
        held.append(t.filter(pa.array(np.append(True, np.any([x[1:] != x[:-1] for x in keys], axis=0)))))
        if whole:
            yield from _sorted_ranges(held)
            held = []
        elif len(held) > 1 and held[-2].column(0)[-1] != held[-1].column(0)[0]:
            yield from _sorted_ranges(held[:-1])
            held = held[-1:]
    if held:
        yield from _sorted_ranges(held)


def _sorted_ranges(parts: list[pa.Table]):
    t = pa.concat_tables(parts).combine_chunks()
    h, lo, hi, doc, row, pos = (t.column(k).to_numpy() for k in range(6))
    own = np.append(True, np.any([x[1:] != x[:-1] for x in (h, doc, row, pos)], axis=0))  # across parts
    run = bounds([h[own]])
    at = np.flatnonzero(own)[np.repeat(np.diff(run) > 1, np.diff(run))]
    if len(at):
        group = np.cumsum(np.append(0, h[at][1:] != h[at][:-1]))
        t = t.take(pa.array(at))
        most, least = repeated(group, t.column(6).to_pylist(), t.column(7).to_pylist(), lo[at], hi[at])
        hit = most >= 0
        cols = (doc[at][hit], row[at][hit], (pos[at] - most)[hit], (pos[at] - least + WINDOW)[hit])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["doc_id", "row", "a", "b"])


def _settled(contexts: DataFrame) -> DataFrame:
    return contexts.repartition("h").sortWithinPartitions("h", "doc_id", "row", "pos").mapInArrow(_sort, _FOUND)


def _overlong(contexts: DataFrame) -> list[DataFrame]:
    """Covered ranges of grams with more than GROUP_ROWS contexts, by parting their groups. Rounds follow
    the logarithm of REACH."""
    out, wide = [], materialize(contexts.mapInArrow(_part, _CONTEXTS), "parted")
    while True:
        counts = materialize(wide.groupBy("h").agg(F.count_distinct("doc_id", "row", "pos").alias("n")).filter("n > 1"), "parted_counts")
        out.append(materialize(_settled(wide.join(counts.filter(F.col("n") <= GROUP_ROWS).select("h"), "h", "left_semi").select(*contexts.columns)), "ranges"))
        large = wide.join(counts.filter(F.col("n") > GROUP_ROWS).select("h"), "h", "left_semi").select(*contexts.columns)
        # at one single place a window is what it is: the first of the equal ones stays
        window = F.substring(F.concat("l", "r"), F.length("l") - F.col("lo").cast("int") + 1, F.lit(WINDOW))
        lone = materialize(large.filter("lo = hi").select(window.alias("win"), "doc_id", "row", (F.col("pos") - F.col("lo")).alias("a")), "windows")
        first = materialize(lone.groupBy("win").agg(F.min(F.struct("doc_id", "row", "a")).alias("first")), "firsts")
        out.append(lone.join(first, "win").filter(F.struct("doc_id", "row", "a") != F.col("first")).select("doc_id", "row", "a", (F.col("a") + WINDOW).alias("b")))
        again = materialize(large.filter("lo < hi").mapInArrow(_part, _CONTEXTS), "parted")
        release(wide)
        if again.isEmpty():
            return out
        wide = again


def _remove(batches):
    for b in batches:
        n_bytes, spans, kept = [], [], []
        for text, starts, stops in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            n = len(data)
            n_bytes.append(n)
            if not starts:
                spans.append([])
                kept.append(data)
                continue
            a, z = np.array(starts), np.minimum(np.array(stops), n)
            order = np.argsort(a, kind="stable")
            a, z = a[order], np.maximum.accumulate(z[order])
            fresh = np.append(True, a[1:] > z[:-1])
            first, last = a[fresh], z[np.append(np.flatnonzero(fresh)[1:] - 1, len(z) - 1)]
            spans.append([{"start": int(i), "stop": int(j)} for i, j in zip(first, last, strict=True)])
            cuts = [0, *(int(x) for p in zip(first, last, strict=True) for x in p), n]
            kept.append(b"".join(data[cuts[k] : cuts[k + 1]] for k in range(0, len(cuts), 2)))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, spans (removed byte ranges, maximal), kept (the remaining bytes)."""
    tuned(docs.sparkSession)
    given = keyed_texts(docs)
    marked = given.mapInArrow(_emit, "h long, c long, doc_id long, row long, pos long")
    marked = marked.repartition("h").sortWithinPartitions("h", "c", "doc_id", "row", "pos")
    copies = materialize(marked.mapInArrow(_copies, "doc_id long, row long, a long, b long, h long"), "copies")
    firsts = copies.filter("h is not null").select("h", "doc_id", "row", "a")
    several = materialize(firsts.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "grams")  # of its own, so that the joins may split a frequent gram's rows

    def fetched(grams: DataFrame) -> DataFrame:
        by_text = firsts.join(grams.select("h"), "h").groupBy("doc_id", "row").agg(F.collect_list(F.struct("a", "h")).alias("s"))
        return given.join(by_text, ["doc_id", "row"]).select("doc_id", "row", "text", F.col("s.a").alias("at"), F.col("s.h").alias("grams")).mapInArrow(_contexts, _CONTEXTS)

    found = materialize(_settled(fetched(several.filter(F.col("n") <= GROUP_ROWS))), "ranges")
    ranges = copies.filter("h is null").select("doc_id", "row", "a", "b").union(found)
    large = several.filter(F.col("n") > GROUP_ROWS)
    if not large.isEmpty():
        for more in _overlong(fetched(large)):
            ranges = ranges.union(more)
    each = ranges.groupBy("doc_id", "row").agg(F.collect_list(F.struct("a", "b")).alias("s")).select("doc_id", "row", F.col("s.a").alias("starts"), F.col("s.b").alias("stops"))
    out = given.join(each, ["doc_id", "row"], "left").select("doc_id", "text", "starts", "stops").mapInArrow(_remove, "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
    return out.select(unkey("doc_id"), "n_bytes", "spans", "kept")
