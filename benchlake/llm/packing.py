"""Best-fit packing of documents into sequences, bulk-synchronously, by distributed successor sweeps.

1. A narrow pass tokenises each document, ends it with the separator id and cuts what is longer than a
   sequence (only the first piece may be short). The pieces, without text or ids, are written to the
   shared folder; from here on only short pieces and gaps move, some bytes each. A full piece is a
   sequence of its own.
2. Supersteps until nothing is left. Gaps offer slots: one, or as many as the longest piece left has
   room for. Pieces and slots are range-sorted by size, and a sweep up each range lets every slot take
   the longest free piece below it (each piece so gets the successor slot; between pieces that want the
   same slot the sorted rank decides). What a range cannot match goes up to the ranges above: ranks
   within the ranges say which piece meets which slot, and an equi-join on the pair's number brings them
   together. Then the gaps shrink, and the next superstep begins.
3. New sequences are opened for pieces that are longer than every gap, as many as are proven to be
   needed for them (a bound of their total and of how many of a size one sequence holds); for all
   pieces if a sweep hardly matches any.

The driver sees one row for each range and the two histograms of sizes, at most a sequence's length of
rows each. Supersteps grow with the logarithm of the sequence length; each writes its results, so a lost
executor costs a task.

Ids are those of the tokenizers library as the file makes it by default: strings of added tokens in a
text become their ids, as the library does it. A text without such strings is run by the file's ranks,
which gives the same ids several times faster.

Defined cases: null and empty texts are one piece of one token (the separator); pieces of equal length
are ranked by partition and position; rows that repeat a doc_id are packed one by one.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from benchlake.llm.common import handing_back, materialize, release, texts, tuned, unkey
from benchlake.llm.runs import column

SEQUENCE = 1024
SEPARATOR = 2
TOKENIZER = "byte_bpe_50k.json"
_ENCODERS: dict[str, Callable[[str], list[int]]] = {}


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: a printable byte is itself, the others
    follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(path: str) -> Callable[[str], list[int]]:
    """Text -> ids as the tokenizers library makes them from the file with add_special_tokens=False. A
    byte-level BPE whose merges stand in the order of its ids is run by its ranks on texts that hold no
    added token; anything else is run by the library."""
    if path not in _ENCODERS:
        with open(path, encoding="utf-8") as f:
            known = json.load(f)
        library = Tokenizer.from_file(path)
        own = lambda text: library.encode(text, add_special_tokens=False).ids
        model, before = known["model"], known.get("pre_tokenizer") or {}
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model.get("merges", [])]
        ordered = model["type"] == "BPE" and all(model["vocab"].get(m) == 256 + k for k, m in enumerate(merges)) and not known.get("normalizer")
        if ordered and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True):
            letters = _byte_letters()
            added = [t["content"] for t in known.get("added_tokens", [])]
            ranks = {bytes(letters[c] for c in t): k for t, k in model["vocab"].items() if t not in added}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            holds = re.compile("|".join(map(re.escape, added)) or r"(?!)").search
            _ENCODERS[path] = lambda text: own(text) if holds(text) else fast(text)
        else:
            _ENCODERS[path] = own
    return _ENCODERS[path]


def cut(n: int, sequence: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    first = n % sequence or sequence
    return [(0, first), *((s, sequence) for s in range(first, n, sequence))]


def pieces(docs: DataFrame, sequence: int, tokenizer_path: str) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, pid (a number of its own, good once written)."""
    tuned(docs.sparkSession)

    def run(batches):
        pid = TaskContext.get().partitionId() << 40
        encode = encoder(tokenizer_path)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text), SEPARATOR], "<u4")
                for k, (start, size) in enumerate(cut(len(ids), sequence)):
                    rows.append((doc, k, start, size, zlib.crc32(ids[start : start + size].tobytes()), pid))
                    pid += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 6, names=["doc_id", "piece", "start", "length", "ids_crc32", "pid"])

    return texts(docs).mapInArrow(handing_back(run), "doc_id long, piece long, start long, length long, ids_crc32 long, pid long")


MATCHED, PIECE, GAP = range(3)
_SWEPT = "kind long, part long, idx long, pid long, size long, seq long, room long"


def nested(is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (piece, slot) of the matches in rows sorted by size, pieces before slots of their size: every
    slot takes the nearest free piece below it. Pieces and slots pair up like brackets: at one level of
    nesting a piece and the slot that follows it belong together."""
    level = np.cumsum(np.where(is_gap, -1, 1)) + is_gap
    order = np.argsort(level, kind="stable")
    a, b = order[:-1], order[1:]
    hit = (level[a] == level[b]) & ~is_gap[a] & is_gap[b]
    return a[hit], b[hit]


def _swept(kind: int, part: int, idx, pid=None, size=None, seq=None, room=None) -> pa.RecordBatch:
    n, none = len(idx), pa.nulls(len(idx), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind)), pa.array(np.full(n, part)), pa.array(idx, pa.int64()), *(none if x is None else pa.array(x, pa.int64()) for x in (pid, size, seq, room))], names=["kind", "part", "idx", "pid", "size", "seq", "room"])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (size, kind, id, room) of a range in order: its matches, its slots that found nothing (numbered
    upwards) and its pieces that are left (numbered upwards as well). Only pieces that wait are held."""
    part = TaskContext.get().partitionId()
    pid, size, gaps = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for b in batches:
        if not b.num_rows:
            continue
        sizes, kind, ids, room = (column(b, k) for k in range(4))
        a, z = nested(kind == GAP)
        yield _swept(MATCHED, part, np.zeros(len(a), np.int64), ids[a], sizes[a], ids[z], room[z])
        free = np.ones(len(ids), bool)
        free[a] = free[z] = False
        slots = np.flatnonzero(free & (kind == GAP))  # all below the pieces that are free
        n = min(len(slots), len(pid))
        top = slice(len(pid) - n, len(pid))
        yield _swept(MATCHED, part, np.zeros(n, np.int64), pid[top][::-1], size[top][::-1], ids[slots[:n]], room[slots[:n]])
        pid, size, slots = pid[: len(pid) - n], size[: len(size) - n], slots[n:]
        yield _swept(GAP, part, np.arange(len(slots)) + gaps, None, None, ids[slots], room[slots])
        gaps += len(slots)
        own = free & (kind == PIECE)
        pid, size = np.append(pid, ids[own]), np.append(size, sizes[own])
    yield _swept(PIECE, part, np.arange(len(pid)), pid, size)


def carried(left: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """left: (range, slots, pieces) of what ranges could not match, upwards. Returns which pieces and which
    slots meet: rows (range, first, stop, number) for pieces, counted down from the last, and for slots,
    counted up from the first; equal numbers meet."""
    stack: list[list[int]] = []  # [range, first, stop] of free pieces
    pieces_, slots, number = [], [], 0
    for part, n_slots, n_pieces in left:
        at = 0
        while at < n_slots and stack:
            own = stack[-1]
            n = min(n_slots - at, own[2] - own[1])
            pieces_.append((own[0], own[2] - n, own[2], number))
            slots.append((part, at, at + n, number))
            own[2], at, number = own[2] - n, at + n, number + n
            if own[1] == own[2]:
                stack.pop()
        if n_pieces:
            stack.append([part, 0, n_pieces])
    return tuple(np.array(sorted(x), np.int64).reshape(-1, 4) for x in (pieces_, slots))


def _numbered(rows: DataFrame, ranges: np.ndarray, down: bool) -> DataFrame:
    """Adds ``number`` (null: stays) to rows (part, idx) by ranges (part, first, stop, number)."""
    shipped = rows.sparkSession.sparkContext.broadcast(ranges)  # two for each range at most
    names = rows.columns

    def run(batches):
        r = shipped.value
        firsts = r[:, 0] << 40 | r[:, 1]
        for b in batches:
            part, idx = (b.column(names.index(c)).to_numpy() for c in ("part", "idx"))
            at = np.searchsorted(firsts, part << 40 | idx, side="right") - 1
            own = r[np.maximum(at, 0)]
            inside = (at >= 0) & (own[:, 0] == part) & (idx < own[:, 2])
            number = own[:, 3] + np.where(down, own[:, 2] - 1 - idx, idx - own[:, 1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(number, mask=~inside)], names=[*names, "number"])

    return rows.mapInArrow(run, f"{_SWEPT}, number long")


def needed(sizes: dict[int, int], sequence: int) -> int:
    """Sequences that pieces (size -> how many) need at least: by their total, and because no more than k
    pieces longer than the (k + 1)-th part of a sequence go into one."""
    most = -(-sum(k * n for k, n in sizes.items()) // sequence)
    for k in range(1, 33):
        most = max(most, -(-sum(n for size, n in sizes.items() if size * (k + 1) > sequence) // k))
    return most


def _histograms(left: DataFrame, gaps: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """How many pieces of each size and gaps of each room: at most a sequence's length of rows each, in one job."""
    both = left.select(F.lit(PIECE).alias("kind"), F.col("size").alias("n")).union(gaps.select(F.lit(GAP).alias("kind"), F.col("room").alias("n")))
    rows = both.groupBy("kind", "n").count().collect()
    return tuple({n: count for kind, n, count in rows if kind == own} for own in (PIECE, GAP))


def place(short: DataFrame, sequence: int) -> DataFrame:
    """short: (pid, size) of pieces below a sequence's length -> (pid, seq, offset), seq from 0 on."""
    spark = short.sparkSession
    placed, opened, before = [], 0, None  # before: pieces that waited at the last superstep
    left, gaps = materialize(short, "left"), spark.createDataFrame([], "seq long, room long")
    while True:
        sizes, rooms = _histograms(left, gaps)
        if not sizes:
            break
        waiting, largest = sum(sizes.values()), max(rooms, default=0)
        stuck = before is None or (before - waiting) * 20 < before
        before = waiting
        more = needed(sizes if stuck else {k: n for k, n in sizes.items() if k > largest}, sequence)
        fresh = spark.range(opened, opened + more).select(F.col("id").alias("seq"), F.lit(sequence).cast("long").alias("room"))
        opened += more
        longest = F.lit(max(sizes)).cast("long")
        each = F.greatest(F.floor(F.col("room") / longest), F.lit(1).cast("long"))
        slots = gaps.filter(F.col("room") >= min(sizes)).union(fresh).withColumn("slot", F.explode(F.sequence(F.lit(1).cast("long"), each)))
        slots = slots.select(F.when(F.col("slot") < each, longest).otherwise(F.col("room") - (each - 1) * longest).alias("size"), F.lit(GAP).cast("long").alias("kind"), F.col("seq").alias("id"), "room", "slot")
        none = F.lit(None).cast("long")
        both = left.select("size", F.lit(PIECE).cast("long").alias("kind"), F.col("pid").alias("id"), none.alias("room"), none.alias("slot")).union(slots)
        ranges = both.repartitionByRange("size", "kind", "id", "slot").sortWithinPartitions("size", "kind", "id", "slot")
        swept = materialize(ranges.drop("slot").mapInArrow(_sweep, _SWEPT), "swept")
        counts = swept.filter(F.col("kind") != MATCHED).groupBy("part").agg(F.count_if(F.col("kind") == GAP).alias("g"), F.count_if(F.col("kind") == PIECE).alias("p")).orderBy("part").collect()  # a row for each range
        up, down = carried([tuple(r) for r in counts])
        pieces_, slots_ = swept.filter(F.col("kind") == PIECE), swept.filter(F.col("kind") == GAP)
        pairs = swept.filter(F.col("kind") == MATCHED).select("pid", "size", "seq", "room")
        if len(up):
            pieces_, slots_ = _numbered(pieces_, up, True), _numbered(slots_, down, False)
            met = pieces_.filter("number is not null").select("number", "pid", "size").join(slots_.filter("number is not null").select("number", "seq", "room"), "number")
            pairs = pairs.union(met.select("pid", "size", "seq", "room"))
            pieces_, slots_ = pieces_.filter("number is null"), slots_.filter("number is null")
        inside = Window.partitionBy("seq").orderBy(F.desc("size"), "pid").rowsBetween(Window.unboundedPreceding, -1)  # the pieces of one sequence
        put = materialize(pairs.select("pid", "seq", "room", "size", (sequence - F.col("room") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("offset")), "placed")
        placed.append(put.select("pid", "seq", "offset"))
        rest = put.select("seq", "room", "size").union(slots_.select("seq", "room", F.lit(0).cast("long")))
        gaps_now = materialize(rest.groupBy("seq").agg((F.max("room") - F.sum("size")).alias("room")).filter("room > 0"), "gaps")
        left_now = materialize(pieces_.select("pid", "size"), "left")
        release(left, swept, *([gaps] if hasattr(gaps, "scratch_path") else []))
        left, gaps = left_now, gaps_now
    out = spark.createDataFrame([], "pid long, seq long, offset long")
    for p in placed:
        out = out.union(p)
    return out


def pack(docs: DataFrame, sequence: int = SEQUENCE, tokenizer_path: str | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Full pieces have negative
    sequence numbers."""
    cut_up = materialize(pieces(docs, sequence, tokenizer_path or public_tokenizers.path(TOKENIZER)), "pieces")
    whole = F.col("length") == sequence
    full = cut_up.filter(whole).select("doc_id", "piece", "start", "length", "ids_crc32", (-F.col("pid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = cut_up.filter(~whole)
    at = place(short.select("pid", F.col("length").alias("size")), sequence)
    out = full.union(short.join(at, "pid").select("doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), "offset"))
    return out.select(unkey("doc_id"), F.col("piece").cast("int").alias("piece"), *out.columns[2:])
