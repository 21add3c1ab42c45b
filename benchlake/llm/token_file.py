"""Token ids in binary segments of directly addressable codes.

Writing: documents are range-sorted by doc_id, tokenised in that order, ended with the separator id and laid
end to end. Each task writes a part, in segments of ``SEGMENT`` tokens (a part's last one is shorter). A segment's ids
are split into chunks of 8 bits by level: level 0 holds the lowest chunk of every id, the next level the next chunk of
the ids that have one. A bitmap says which ids go on, and a rank directory (set bits before each 64-bit
word) says where: any id is found with one look at each of its levels, and no block is decoded.

    "DAC1" | tokens u32 | levels u32 | ids in each level u32 ... | for each level: chunks u8, bitmap u64, ranks u32
                                                                   (padded to 8 bytes; the last level has chunks only)

The segments are stored as uncompressed Parquet rows beside their document index: any store that Spark reaches will do,
and a lost executor or a failed attempt leaves no half-written file. Token p of the corpus is in
the part whose range holds p (``parts``: a row for each writing task), there in segment (p - its start) // SEGMENT.

Documents may cross segments. Reading computes a CRC-32 for each piece of one; pieces are joined by
shifted arithmetic, so a huge document is read by many tasks.

Ids are those of the tokenizers library. White space ends every token of this kind of file and is dropped,
so a text is cut at it into stretches. Those of ASCII and plain Latin letters, whose case and classes no version of Unicode
moves, are laid out by columns of bytes, a space after each piece, and run by the file's merges, a window of many texts
in one call (``Merges``, the same ids several times faster). All others, and files of another make, are run by the
library one by one, and a worker remembers their ids (bounded). Long texts are tokenised in windows.

Defined cases: null and empty texts are the separator alone; a null doc_id is below all others; rows that repeat a
doc_id follow each other in order of a hash of their text; other columns are ignored; an empty table writes no
segment and reads as an empty result.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from benchlake.llm.common import keyed_texts, materialize, scratch_dir, tuned, unkey
from benchlake.llm.packing import _byte_letters

TOKENIZER = "word_bpe_49k.json"
SEPARATOR = 2
SEGMENT = 1 << 18
#: Bytes of texts that are tokenised at once, where white space allows.
WINDOW = 1 << 20
#: What a worker remembers of the library's work: so many stretches of text, none longer than so many bytes.
REMEMBERED, LONGEST = 800_000, 256
_BITS, _MAGIC = 8, b"DAC1"


# Directly addressable codes


def pack_codes(ids: np.ndarray) -> bytes:
    """The bytes of a segment."""
    rest, sizes, body = ids.astype(np.uint32), [], []
    while True:
        sizes.append(len(rest))
        body.append((rest & 0xFF).astype(np.uint8).tobytes())
        more = rest > 0xFF
        if not more.any():
            break
        bitmap = np.packbits(more, bitorder="little")
        words = np.concatenate([bitmap, np.zeros(-len(bitmap) % 8, np.uint8)]).view("<u8")
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.uint64)[:-1]]).astype("<u4")
        body += [words.tobytes(), ranks.tobytes()]
        rest = rest[more] >> _BITS
    head = _MAGIC + struct.pack(f"<{2 + len(sizes)}I", len(ids), len(sizes), *sizes)
    return b"".join(part + bytes(-len(part) % 8) for part in (head, *body))


class Codes:
    """Random access to the ids of a segment; arrays are views of its bytes."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.n, levels = struct.unpack_from("<2I", data, 4)
        sizes = struct.unpack_from(f"<{levels}I", data, 12)
        at, self.levels = 12 + 4 * levels, []

        def view(kind: str, n: int) -> np.ndarray:
            nonlocal at
            at += -at % 8
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        for k, n in enumerate(sizes):
            words = -(-n // 64) if k + 1 < levels else 0
            self.levels.append((view("u1", n), view("<u8", words), view("<u4", words)))

    def take(self, at: np.ndarray) -> np.ndarray:
        """Ids at these places, in their order."""
        at = np.asarray(at, np.int64)
        if len(at) and not (0 <= at.min() and at.max() < self.n):
            raise IndexError(f"places reach from {at.min()} to {at.max()}, the segment has {self.n} tokens")
        out, live = np.zeros(len(at), np.uint32), np.arange(len(at))
        for k, (chunks, words, ranks) in enumerate(self.levels):
            out[live] |= chunks[at].astype(np.uint32) << np.uint32(_BITS * k)
            if not len(words):
                break
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            more = (word >> bit & np.uint64(1)).astype(bool)
            before = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            at, live = (ranks[at >> 6] + before.astype(np.int64))[more], live[more]
        return out

    def slice(self, start: int, stop: int) -> np.ndarray:
        return self.take(np.arange(start, stop))


# CRC-32 of what is laid end to end, from the parts' own

_CRC = 0xEDB88320  # fixed value: the polynomial, bits reflected


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of the CRC; the highest bit is the constant term."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (_CRC if b & 1 else 0)
    return out


def crc_joined(left: int, right: int, n_bytes: int) -> int:
    """The CRC of left's bytes followed by right's n_bytes bytes."""
    shift, square, n = 1 << 31, 1 << 23, n_bytes  # 1, x to the 8th
    while n:
        if n & 1:
            shift = _times(shift, square)
        square, n = _times(square, square), n >> 1
    return _times(left, shift) ^ right


# Writing


# What a file of this kind says of its texts.
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
# Kinds of bytes. A digit, a mark and a hole are a piece each; odd bytes are in no plain stretch. Of the letters beyond
# ASCII two lead bytes are plain but for the pairs below; their case moves no border and no length.
_SPACE, _LETTER, _OTHER, _DIGIT, _ALONE, _ODD = range(6)
#: What ends a text, in no UTF-8, and what is written for it and for a stretch that is left to the library.
_MARK, _MARKED, _HOLE = b"\xff", 1, 2
_ODD_PAIRS = (b"<|", "\u00d7".encode(), "\u00f7".encode(), "\u0130".encode())
_ODD_PAIR = re.compile(b"|".join(map(re.escape, _ODD_PAIRS)))
_BORDER, _STRETCH = re.compile(rb"[ \t\n\r\xff]"), re.compile(rb"\xff|[^ \t-\r\xff]+")


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """For each byte its kind, and how it is written."""
    kind, written = np.full(256, _ODD, np.uint8), np.arange(256, dtype=np.uint8)
    kind[33:127] = _OTHER
    kind[[*b" \t\n\r\x0b\x0c"]] = _SPACE
    kind[[*b"0123456789"]] = _DIGIT
    for first, stop in ((65, 91), (97, 123), (0x80, 0xC0), (0xC3, 0xC6)):
        kind[first:stop] = _LETTER
    kind[_MARK[0]], written[_MARK[0]] = _ALONE, _MARKED
    written[kind == _SPACE] = 32
    written[65:91] += 32
    return kind, written


_KIND, _WRITTEN = _kinds()


def _laid_out(data: bytes) -> tuple[str, list[bytes]]:
    """The pieces of the plain stretches in lower case, a space after each, and the other stretches, for which holes stand."""
    raw = np.frombuffer(data, np.uint8)
    kind, written = _KIND[raw], _WRITTEN[raw]
    odd, others = np.flatnonzero(kind == _ODD), []
    if any(p in data for p in _ODD_PAIRS):
        odd = np.concatenate([odd, [m.start() for m in _ODD_PAIR.finditer(data)]])
    if len(odd):
        gaps = np.concatenate([[-1], np.flatnonzero((kind == _SPACE) | (kind == _ALONE)), [len(raw)]])
        at = np.unique(np.searchsorted(gaps, odd))
        starts, stops = gaps[at - 1] + 1, gaps[at]
        others = [data[a:z] for a, z in zip(starts.tolist(), stops.tolist(), strict=True)]
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[starts], inside[stops] = 1, -1
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        kind[inside], written[inside] = _SPACE, 32
        kind[starts], written[starts] = _ALONE, _HOLE
    before, own = kind[:-1], kind[1:]
    cut = (own != before) | (own >= _DIGIT)  # a border between this byte and the next
    quote = np.flatnonzero(raw == 0x27)
    quote = quote[(kind[quote] == _OTHER) & ((quote == 0) | (kind[quote - 1] != _OTHER))]  # begins a piece
    if len(quote):
        padded = np.concatenate([written, [32, 32]])
        a, b = padded[quote + 1], padded[quote + 2]
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        short = two | np.isin(a, [*b"stmd"])
        cut[quote[short]] = False
        ends = (quote + 1 + two)[short]
        cut[ends[ends < len(cut)]] = True
    cut &= (own != _SPACE) & (before != _SPACE)
    return np.insert(written, np.flatnonzero(cut) + 1, 32).tobytes().decode().lower() + " ", others


class Merges:
    """Word pieces by ranked merges. A word's last byte is followed by a mark (a space, in no piece) that merges with
    it first, as the file's alphabet has every byte also in a form that ends a word. Joining by what a pair
    spells equals joining by the list of pairs where every token of the list spells itself (tested)."""

    END = b" "

    def __init__(self, known: dict):
        letters, vocab, suffix = _byte_letters(), known["model"]["vocab"], known["model"]["end_of_word_suffix"]
        spelt = lambda t: bytes(letters[c] for c in t[: -len(suffix)]) + self.END if t.endswith(suffix) and t != suffix else bytes(letters[c] for c in t)
        by_id = sorted(vocab, key=vocab.__getitem__)
        ranks, ids = {bytes([b]): b for b in range(256)}, [0] * 256
        ends = [spelt(t) for t in by_id[256:512]]
        for k, e in enumerate(ends):
            ranks[e] = 256 + k
            ids.append(256 + k)
        for t in by_id[:256]:
            ids[ranks[spelt(t)]] = vocab[t]
        for t in by_id[512 : 512 + len(known["model"]["merges"])]:
            ranks[spelt(t)] = len(ids)
            ids.append(vocab[t])
        self.ids, self.unmixed = np.array(ids, "<u4"), len(ranks) == len(ids)
        self.marked, self.hole = (ranks[bytes([b]) + self.END] for b in (_MARKED, _HOLE))
        # Without a special token the search for them would stop at each character; this one is in no text laid out.
        self.run = tiktoken.Encoding("merges", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={"\0": len(ids)}).encode_to_numpy

    @classmethod
    def of(cls, path: str) -> Merges | None:
        """The merges of a file of this kind, None of another."""
        with open(path, encoding="utf-8") as f:
            known = json.load(f)
        model = known["model"]
        if (model["type"], known.get("normalizer"), known.get("pre_tokenizer"), model.get("end_of_word_suffix"), model.get("dropout")) != ("BPE", _NORMALIZER, _PRE, "</w>", None):
            return None
        by_id = sorted(model["vocab"], key=model["vocab"].__getitem__)
        pairs = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        alphabet = set(_byte_letters())
        ordered = by_id[512 : 512 + len(pairs)] == pairs and set(by_id[:256]) == alphabet and set(by_id[256:512]) == {c + "</w>" for c in alphabet}
        out = cls(known) if ordered and [model["vocab"][t] for t in by_id[:512]] == list(range(512)) else None
        return out if out and out.unmixed else None

    def encode(self, text: str) -> np.ndarray:
        """The ranks of what is laid out."""
        return self.run(text, disallowed_special=())


class Ids:
    """Texts to ids, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        self.library, self.merges = Tokenizer.from_file(path), Merges.of(path)
        self.known: dict[bytes, bytes] = {}

    def _by_library(self, stretch: bytes) -> bytes:
        out = np.array(self.library.encode(stretch.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        if len(stretch) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[stretch] = out
        return out

    def _marked(self, window: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a window, one of any value for each mark, and the places behind the marks."""
        get, own = self.known.get, self._by_library
        if self.merges is None:
            found = _STRETCH.findall(window)
            parts = [bytes(4) if s == _MARK else get(s) or own(s) for s in found]
            ends = np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)[[s == _MARK for s in found]]
            return np.frombuffer(bytearray(b"".join(parts)), "<u4"), ends
        text, others = _laid_out(window)
        ranks = self.merges.encode(text)
        marks = np.flatnonzero(ranks == self.merges.marked)
        if not others:
            return self.merges.ids[ranks], marks + 1
        parts, hole, sizes = [get(s) or own(s) for s in others], ranks == self.merges.hole, np.ones(len(ranks), np.int64)
        sizes[hole] = [len(p) // 4 for p in parts]
        filled = np.repeat(hole, sizes)
        ids = np.empty(len(filled), "<u4")
        ids[filled], ids[~filled] = np.frombuffer(b"".join(parts), "<u4"), self.merges.ids[ranks[~hole]]
        return ids, np.cumsum(sizes)[marks]

    def _ids(self, window: bytes) -> bytes:
        return self._marked(window)[0].tobytes()

    def encode(self, text: str) -> Iterator[bytes]:
        return map(self._ids, _windows(text.encode("utf-8", "replace")))

    def encode_all(self, texts: list[str], end: int) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(which text, ids, is it done): the ids of all texts in turn, each ended with ``end``, long ones in parts."""
        which = 0
        for window in _windows(b"".join([t.encode("utf-8", "replace") + _MARK for t in texts])):
            ids, ends = self._marked(window)
            ids[ends - 1], start = end, 0
            for stop in ends.tolist():
                yield which, ids[start:stop], True
                which, start = which + 1, stop
            if start < len(ids):
                yield which, ids[start:], False


def _windows(data: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(data):
        m = _BORDER.search(data, start + WINDOW)
        stop = m.start() if m else len(data)
        yield data[start:stop]
        start = stop


_WORKER: dict[str, Ids] = {}
_SEGMENT = "part int, segment int, capacity int, n_tokens long, first_doc long, open boolean, doc_ids array<long>, sizes array<long>, codes binary"


def _encoded(docs: DataFrame, path: str, separator: int, segment: int) -> DataFrame:
    """Sorted documents (doc_id, row, text) to segments. ``first_doc`` numbers a segment's first document within the
    part; ``open``: its last document goes on in the next segment."""

    def row(part, at, first, still, docs_, ids):
        sizes = [n for _, n in docs_]
        cols = ([part], [at], [segment], [len(ids)], [first], [still], [[d for d, _ in docs_]], [sizes], [pack_codes(ids)])
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
        names = ["part", "segment", "capacity", "n_tokens", "first_doc", "open", "doc_ids", "sizes", "codes"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    def run(batches):
        part = TaskContext.get().partitionId()
        if path not in _WORKER:
            _WORKER[path] = Ids(path)
        encoder = _WORKER[path]
        held, size, docs_, at, first, number = [], 0, [], 0, 0, -1
        for b in batches:
            keys, last = b.column(0).to_pylist(), -1
            for k, ids, done in encoder.encode_all(b.column(2).to_pylist(), separator):
                doc = keys[k]
                if k != last:
                    last, number = k, number + 1
                    docs_.append((doc, 0))
                held.append(ids)
                size += len(ids)
                docs_[-1] = (doc, docs_[-1][1] + len(ids))
                while size > segment or size == segment and done:
                    both, over = np.concatenate(held), size - segment
                    docs_[-1] = (doc, docs_[-1][1] - over)
                    yield row(part, at, first, over > 0, docs_, both[:segment])
                    held, size, at = [both[segment:]], over, at + 1
                    docs_, first = ([(doc, over)], number) if over else ([], number + 1)
        if size:
            yield row(part, at, first, False, docs_, np.concatenate(held))

    return docs.mapInArrow(run, _SEGMENT)


def write(docs: DataFrame, path: str, tokenizer_path: str | None = None, separator: int = SEPARATOR, segment: int = SEGMENT) -> None:
    """Write the ids of all documents, in ascending doc_id order, as segments under ``path``. Whole texts are
    shuffled once, before they are tokenised: the sort samples its input, which should not tokenise it."""
    tuned(docs.sparkSession)
    dealt = keyed_texts(docs).repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    out = _encoded(dealt, tokenizer_path or public_tokenizers.path(TOKENIZER), separator, segment)
    out.write.option("compression", "none").option("parquet.block.size", str(32 << 20)).parquet(path)


# Reading


def parts(spark: SparkSession, path: str) -> DataFrame:
    """A row for each part, in order: part, start (tokens before it), n_tokens, capacity (tokens of a full segment)."""
    rows = sorted(map(tuple, spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens"), F.max("capacity")).collect()))  # a row for each writing task
    starts = np.cumsum([0, *(n for _, n, _ in rows)]).tolist()
    return spark.createDataFrame([(p, s, n, c) for (p, n, c), s in zip(rows, starts, strict=False)], "part int, start long, n_tokens long, capacity int")


def _pieces(segments: DataFrame) -> DataFrame:
    """Per piece of a document: part, doc_no, doc_id, at (place in the part), n, crc, open (goes on)."""

    def run(batches):
        for b in batches:
            for part, no, capacity, n_tokens, first, still, doc_ids, sizes, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                codes = Codes(data)
                if codes.n != n_tokens or sum(sizes) != n_tokens:
                    raise ValueError(f"segment {no} of part {part} holds {codes.n} tokens, its index {sum(sizes)}")
                ids, ends = codes.slice(0, n_tokens).astype("<u4"), np.cumsum(sizes)
                crc = [zlib.crc32(ids[z - n : z].tobytes()) for n, z in zip(sizes, ends.tolist(), strict=True)]
                last = np.zeros(len(sizes), bool)
                last[-1] = still
                k = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, part, np.int32)), pa.array(np.arange(first, first + k)), pa.array(doc_ids, pa.int64()), pa.array(ends - sizes + no * capacity), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64()), pa.array(last)],
                    names=["part", "doc_no", "doc_id", "at", "n", "crc", "open"],
                )

    return segments.select("part", "segment", "capacity", "n_tokens", "first_doc", "open", "doc_ids", "sizes", "codes").mapInArrow(run, "part int, doc_no long, doc_id long, at long, n long, crc long, open boolean")


def _joined(crossing: DataFrame) -> DataFrame:
    """Pieces of documents that cross segments, put together."""

    def run(batches):
        for b in batches:
            crc = []
            for pieces in b.column(5).to_pylist():
                total = 0
                for p in pieces:
                    total = crc_joined(total, p["crc"], 4 * p["n"])
                crc.append(total)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(crc, pa.int64())], names=["part", "doc_no", "doc_id", "at", "n", "crc"])

    one = crossing.groupBy("part", "doc_no").agg(F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))  # a piece for each segment
    return one.mapInArrow(run, "part int, doc_no long, doc_id long, at long, n long, crc long")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files under ``path``: doc_id, start, n_tokens, ids_crc32."""
    columns = ["part", "doc_no", "doc_id", "at", "n", "crc"]
    pieces = materialize(_pieces(spark.read.parquet(path)), "pieces")
    crossing = pieces.filter("open").select("part", "doc_no").distinct()
    whole = pieces.join(crossing, ["part", "doc_no"], "left_anti").select(*columns)
    both = whole.union(_joined(pieces.join(crossing, ["part", "doc_no"], "left_semi").select(*columns)))
    out = both.join(F.broadcast(parts(spark, path).select("part", "start")), "part")
    return out.select(unkey("doc_id"), (F.col("start") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def lookup(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(pos, id) of the distinct places ``pos`` in the corpus: each wanted segment is read once, and only the ids asked
    for are taken from it. Places outside raise."""
    shipped = spark.sparkContext.broadcast([tuple(r) for r in parts(spark, path).orderBy("part").collect()])  # a row for each writing task

    def place(batches):
        known = shipped.value
        starts = np.array([s for _, s, *_ in known] + [known[-1][1] + known[-1][2]] if known else [0], np.int64)
        segment = known[0][3] if known else 1
        for b in batches:
            pos = b.column(0).to_numpy()
            if len(pos) and not (0 <= pos.min() and pos.max() < starts[-1]):
                raise IndexError(f"places reach from {pos.min()} to {pos.max()}, the files hold {starts[-1]} tokens")
            own = np.searchsorted(starts, pos, side="right") - 1
            at = pos - starts[own]
            part = np.array([p for p, *_ in known], np.int32)[own] if len(pos) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(pos), pa.array(part), pa.array((at // segment).astype(np.int32)), pa.array((at % segment).astype(np.int32))], names=["pos", "part", "segment", "at"])

    def take(batches):
        for b in batches:
            for wanted, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = Codes(data).take(np.array([w["at"] for w in wanted]))
                yield pa.RecordBatch.from_arrays([pa.array([w["pos"] for w in wanted], pa.int64()), pa.array(ids.astype(np.int64))], names=["pos", "id"])

    placed = positions.select(F.col("pos").cast("long")).filter("pos is not null").distinct().mapInArrow(place, "pos long, part int, segment int, at int")
    wanted = placed.groupBy("part", "segment").agg(F.collect_list(F.struct("pos", "at")).alias("wanted"))  # at most a segment's tokens
    return wanted.join(spark.read.parquet(path), ["part", "segment"]).select("wanted", "codes").mapInArrow(take, "pos long, id long")


def written_and_read(docs: DataFrame) -> DataFrame:
    """Write the documents' ids to a new folder of the shared one and read them back."""
    spark = docs.sparkSession
    path = f"{scratch_dir(spark)}/benchlake/{uuid.uuid4().hex}/tokens"
    write(docs, path)
    return documents(spark, path)
