"""A Python data source for BAM files: byte ranges, checked ends, columns by numpy gathers.

A BAM file is a chain of compressed blocks of at most 64 KB, so a file is cut into byte ranges, one task each. A range
starts at the first block that begins in it (a block's header holds its length, so a block that is followed by
further ones is no chance) and there at the first place from which a chain of records can be read (``Boundary``);
it holds the records that begin in its blocks. ``idx`` is a record's place: the offset of its block over all files,
then the offset in the block. It grows with the file order and is no count.

Decoding is by columns: the places of a batch's records first, then each field asked for as one gather over all
records. Tags are read in steps, the k-th tag of every record at once.

A file without its end block, with bytes after it, or with a cut record raises: half a file is no smaller file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from benchlake.schemas import FULL_RECORD, HEADER, RECORD

# Codes of the BAM format.
CIGAR_OPS = "MIDNSHP=X"
BASES = "=ACMGRSVTWYHKDBN"
TAG_TYPES = {"A": "Char", "Z": "Str", "H": "Hex", "f": "Float", "i": "Int", "B": "Other"} | dict.fromkeys("cCsSI", "Int")
NUMBERS = {"c": "<i1", "C": "<u1", "s": "<i2", "S": "<u2", "i": "<i4", "I": "<u4", "f": "<f4"}
END_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
HEAD = np.dtype(
    [("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("l_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_ops", "<u2"), ("flags", "<u2"), ("l_seq", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("tlen", "<i4")]
)

_LONGEST = 1 << 28  # no record is longer
_WIDTH = np.zeros(256, np.int64)  # bytes of a tag's value by its type code, 0: varies
for _code, _kind in NUMBERS.items():
    _WIDTH[ord(_code)] = int(_kind[2])
_WIDTH[ord("A")] = 1


# Columns


def gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes data[start : start + length] of all pairs, end to end."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(start - (ends - length), length) + np.arange(total)]


def _offsets(length: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(length)]).astype(np.int32)


def strings(data: np.ndarray, length: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """Strings of these lengths from bytes laid end to end."""
    out = pa.StringArray.from_buffers(len(length), pa.py_buffer(_offsets(length)), pa.py_buffer(np.ascontiguousarray(data)))
    return out if missing is None or not missing.any() else pa.compute.if_else(pa.array(missing), pa.scalar(None, pa.string()), out)


def heads(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The fixed part of the records at these places."""
    return np.ascontiguousarray(data[at[:, None] + np.arange(36)]).view(HEAD).reshape(-1)


def _cigars(data: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.Array:
    ops = gather(data, start, 4 * n).view("<u4")
    code = (ops & 15).astype(np.int8)
    if len(code) and code.max() >= len(CIGAR_OPS):
        raise ValueError("an unknown CIGAR operation")
    op = pa.DictionaryArray.from_arrays(pa.array(code), pa.array(list(CIGAR_OPS))).cast(pa.string())
    return pa.ListArray.from_arrays(pa.array(_offsets(n)), pa.StructArray.from_arrays([op, pa.array((ops >> 4).astype(np.int32))], ["op", "len"]))


def _bases(data: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.Array:
    packed = gather(data, start, (n + 1) // 2)
    both = np.stack([packed >> 4, packed & 15], axis=1).reshape(-1)  # an odd read's last half byte is spare
    first = np.concatenate([[0], np.cumsum((n + 1) // 2 * 2)])[:-1]
    return strings(np.frombuffer(BASES.encode(), np.uint8)[gather(both, first, n)], n, n == 0)


def _qualities(data: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.Array:
    values = gather(data, start, n)
    if not len(values):
        return pa.nulls(len(n), pa.string())
    first = values[np.minimum(_offsets(n)[:-1], len(values) - 1)]
    missing = (n == 0) | (first == 255)
    return strings(np.where(values == 255, 33, values + 33).astype(np.uint8), n, missing)


def _array_text(data: np.ndarray, at: int) -> str:
    sub = chr(data[at])
    n = int(data[at + 1 : at + 5].view("<i4")[0])
    kind = NUMBERS[sub]
    values = data[at + 5 : at + 5 + n * int(kind[2])].view(kind)
    return ",".join([sub, *map(repr, values.tolist())])


def _tags(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """Maps of all records' tags: the k-th tag of every record in the k-th step."""
    zeros = np.flatnonzero(data == 0)
    live, at = np.flatnonzero(start < stop), start[start < stop]
    steps = []  # of each step: record, place of the name, code, place and length of the value
    while len(live):
        end = stop[live]
        if (at + 3 > end).any():
            raise ValueError("a record's tags end inside a tag")
        code, value = data[at + 2], at + 3
        size = _WIDTH[code]
        text = (code == ord("Z")) | (code == ord("H"))
        k = np.searchsorted(zeros, value[text])
        if (k >= len(zeros)).any():
            raise ValueError("a record's text tag has no end")
        size[text] = zeros[k] - value[text]
        array = code == ord("B")
        if array.any():
            first = value[array]
            if (first + 5 > end[array]).any():
                raise ValueError("a record's tags end inside a tag")
            width = _WIDTH[data[first]]
            size[array] = 5 + width * np.ascontiguousarray(data[first[:, None] + 1 + np.arange(4)]).view("<i4").reshape(-1)
            if (width == 0).any():
                raise ValueError("an unknown type of array tag")
        if not (text | array | (size > 0)).all():
            raise ValueError(f"an unknown tag type: {chr(code[~(text | array | (size > 0))][0])!r}")
        after = value + size + text
        if (after > end).any():
            raise ValueError("a record's tags end inside a tag")
        steps.append((live, at, code, value, size))
        more = after < end
        live, at = live[more], after[more]
    n = len(start)
    kind = pa.struct([("t", pa.string()), ("v", pa.string())])
    if not steps:
        return pa.MapArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.string()), pa.array([], kind))
    record, place, code, value, size = (np.concatenate(c) for c in zip(*steps, strict=True))
    order = np.argsort(record, kind="stable")
    record, place, code, value, size = record[order], place[order], code[order], value[order], size[order]
    names = strings(gather(data, place, np.full(len(place), 2)), np.full(len(place), 2))
    texts, own = [], []
    for c in np.unique(code):
        here = np.flatnonzero(code == c)
        own.append(here)
        letter = chr(c)
        if letter in "ZHA":
            texts.append(strings(gather(data, value[here], size[here]), size[here]))
        elif letter == "B":
            texts.append(pa.array([_array_text(data, int(v)) for v in value[here]], pa.string()))
        else:
            numbers = gather(data, value[here], size[here]).view(NUMBERS[letter])
            texts.append(pa.array(list(map(repr, numbers.tolist()))) if letter == "f" else pa.array(numbers).cast(pa.string()))
    back = np.empty(len(code), np.int64)
    back[np.concatenate(own)] = np.arange(len(code))
    codes = {c: k for k, c in enumerate(TAG_TYPES)}
    kinds = pa.DictionaryArray.from_arrays(pa.array(np.array([codes.get(chr(c), 0) for c in range(256)], np.int32)[code]), pa.array(list(TAG_TYPES.values()))).cast(pa.string())
    values = pa.StructArray.from_arrays([kinds, pa.concat_arrays(texts).take(pa.array(back))], ["t", "v"])
    return pa.MapArray.from_arrays(pa.array(_offsets(np.bincount(record, minlength=n))), names, values)


def columns(data: np.ndarray, at: np.ndarray, idx: np.ndarray, wanted: list[str]) -> pa.RecordBatch:
    """The wanted fields of the records at these places."""
    h = heads(data, at)
    l_name, n_ops, l_seq, size = (h[c].astype(np.int64) for c in ("l_name", "n_ops", "l_seq", "size"))
    name = at + 36
    cigar = name + l_name
    seq = cigar + 4 * n_ops
    qual = seq + (l_seq + 1) // 2
    tags, stop = qual + l_seq, at + 4 + size
    if (l_name < 1).any() or (l_seq < 0).any() or (tags > stop).any():
        raise ValueError("a record is shorter than its fields")
    number = lambda c, kind, missing: pa.array(h[c].astype(kind) + (1 if "pos" in c else 0), mask=h[c] == missing)

    def names() -> pa.Array:
        if (l_name < 2).any() or ((l_name == 2) & (data[name] == ord("*"))).any():
            raise ValueError("a record has no name")
        return strings(gather(data, name, l_name - 1), l_name - 1)

    fields = {
        "idx": lambda: pa.array(idx),
        "name": names,
        "flags": lambda: pa.array(h["flags"].astype(np.int32)),
        "ref_id": lambda: number("ref", np.int32, -1),
        "pos": lambda: number("pos", np.int64, -1),
        "mapq": lambda: number("mapq", np.int32, 255),
        "cigar": lambda: _cigars(data, cigar, n_ops),
        "next_ref": lambda: number("next_ref", np.int32, -1),
        "next_pos": lambda: number("next_pos", np.int64, -1),
        "tlen": lambda: pa.array(h["tlen"].astype(np.int32)),
        "seq": lambda: _bases(data, seq, l_seq),
        "qual": lambda: _qualities(data, qual, l_seq),
        "tags": lambda: _tags(data, tags, stop),
    }
    return pa.RecordBatch.from_arrays([fields[c]() for c in wanted], names=wanted)


# Blocks


def opened(path: str):
    from pyarrow import fs

    source, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return source.open_input_file(inner)


def _block_size(head: bytes) -> int:
    """The length of the block whose first 18 bytes these are; 0 if they start none."""
    return struct.unpack_from("<H", head, 16)[0] + 1 if len(head) >= 18 and head[:4] == b"\x1f\x8b\x08\x04" and head[12:16] == b"BC\x02\0" else 0


def _first_block(f, start: int, end: int, size: int) -> int:
    """The offset of the first block that begins at start or later and before end; end if none does."""
    f.seek(start)
    data = f.read(min(size, end + (1 << 17)) - start)
    at = -1
    while 0 <= (at := data.find(b"\x1f\x8b\x08\x04", at + 1)) < end - start:
        n = _block_size(data[at : at + 18])
        if n and (start + at + n == size or _block_size(data[at + n : at + n + 18])):
            return start + at
    return end


def blocks(f, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the blocks from an offset on."""
    while at < size:
        f.seek(at)
        n = _block_size(f.read(18))
        if not n or at + n > size:
            raise ValueError(f"no whole block at byte {at}")
        f.seek(at)
        try:
            yield at, zlib.decompress(f.read(n), 31)
        except zlib.error as e:
            raise ValueError(f"a damaged block at byte {at}: {e}") from e
        at += n


def check_end(f, size: int, path: str) -> None:
    f.seek(max(0, size - len(END_BLOCK)))
    if f.read(len(END_BLOCK)) != END_BLOCK:
        raise ValueError(f"{path} has no end block: it is cut")


class _Bytes:
    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.data, self.at = chunks, b"", 0

    def read(self, n: int) -> bytes:
        while len(self.data) - self.at < n:
            more = next(self.chunks, None)
            if more is None:
                raise ValueError("the file ends inside its header")
            self.data, self.at = self.data[self.at :] + more, 0
        out = self.data[self.at : self.at + n]
        self.at += n
        return out


def read_header(s: _Bytes) -> tuple[str, list[tuple[str, int]]]:
    """The header's text, and name and length of each reference."""
    if s.read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    text = s.read(struct.unpack("<i", s.read(4))[0]).rstrip(b"\0").decode()
    refs = []
    for _ in range(struct.unpack("<i", s.read(4))[0]):
        name = s.read(struct.unpack("<i", s.read(4))[0])[:-1].decode()
        refs.append((name, struct.unpack("<i", s.read(4))[0]))
    return text, refs


# Where records begin


class Boundary:
    """Finds where the first record begins in a stream that starts anywhere, fed piece by piece; no byte is looked at
    twice. Places that can begin a record are followed as chains, all at once; the first chain that holds
    ``LEAST`` records (or two over ``SPAN`` bytes, or ends with the stream) names the place."""

    LEAST, SPAN, _REACH = 8, 1 << 22, 36 + 256

    def __init__(self, refs: int):
        self.refs, self.scanned = refs, 0
        self.chains: list[list[int]] = []  # place, place of the next record, records

    def _candidates(self, data: np.ndarray, stop: int) -> np.ndarray:
        """Places from ``scanned`` up to stop whose fixed part and name can be a record's."""
        at = np.arange(self.scanned, stop)
        if not len(at):
            return at
        whole = lambda k: np.lib.stride_tricks.sliding_window_view(data, 4)[self.scanned + k : stop + k]
        number = lambda k: np.ascontiguousarray(whole(k)).view("<i4").reshape(-1)
        size = number(0)
        keep = (size >= 34) & (size < _LONGEST)
        for k in (4, 24):  # references
            v = number(k)
            keep &= (v >= -1) & (v < self.refs)
        for k in (8, 28):  # places on them
            keep &= number(k) >= -1
        at = at[keep]
        h = heads(data, at)
        l_seq, l_name = h["l_seq"].astype(np.int64), h["l_name"].astype(np.int64)
        keep = (l_name >= 2) & (l_seq >= 0) & (32 + l_name + 4 * h["n_ops"].astype(np.int64) + (l_seq + 1) // 2 + l_seq <= h["size"])
        return at[keep]

    def _sound(self, data: np.ndarray, at: int) -> int:
        """The length of the record that can begin here, 0 if none can."""
        h = heads(data, np.array([at]))[0]
        n, l_seq, l_name = int(h["size"]), int(h["l_seq"]), int(h["l_name"])
        if not 34 <= n < _LONGEST or not all(-1 <= int(h[c]) < self.refs for c in ("ref", "next_ref")) or int(h["pos"]) < -1 or int(h["next_pos"]) < -1 or l_name < 2 or l_seq < 0:
            return 0
        if 32 + l_name + 4 * int(h["n_ops"]) + (l_seq + 1) // 2 + l_seq > n:
            return 0
        name = data[at + 36 : at + 36 + l_name]
        return n + 4 if len(name) == l_name and name[-1] == 0 and bool(((name[:-1] >= 33) & (name[:-1] <= 126)).all()) else 0

    def feed(self, data: np.ndarray, limit: int, done: bool) -> int | None:
        """data: all bytes so far; records are looked for before ``limit``. Returns the place, -1 if there is none, None if
        more bytes are needed to tell."""
        stop = max(self.scanned, min(limit, len(data) - (35 if done else self._REACH)))
        for at in self._candidates(data, stop):
            self.chains.append([int(at), int(at), 0])
        self.scanned = stop
        alive = []
        for chain in self.chains:
            while True:
                place, z, k = chain
                if k >= self.LEAST or (k >= 2 and z - place > self.SPAN) or (done and k and z == len(data)):
                    return place
                if z + (36 if done else self._REACH) > len(data):
                    if not done:
                        alive.append(chain)
                    break
                n = self._sound(data, z)
                if not n:
                    break
                chain[1:] = [z + n, k + 1]
        self.chains = alive
        if not alive and (done or self.scanned >= limit):
            return -1
        return None

    def drop(self, n: int) -> None:
        """Forget the first n bytes; places count from there on."""
        self.scanned -= n
        for chain in self.chains:
            chain[0] -= n
            chain[1] -= n

    def first(self) -> int:
        """The first byte that is still needed."""
        return min([self.scanned, *(c[0] for c in self.chains)])


# The source


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, size: int, refs: int, first: tuple[int, int], base: int):
        self.path, self.start, self.end, self.size, self.refs, self.first, self.base = path, start, end, size, refs, first, base


class BamReader(DataSourceReader):
    #: Bytes of records that are decoded at once.
    BATCH = 4 << 20

    def __init__(self, paths: list[str], wanted: list[str], split: int):
        self.paths, self.wanted, self.split = paths, wanted, split

    def partitions(self):
        """Byte ranges of all files. Of a file the header and the end are read here."""
        out, base, last = [], 0, (0, b"")

        def chunks(f, size):
            nonlocal last
            for last in blocks(f, 0, size):
                yield last[1]

        for path in self.paths:
            with opened(path) as f:
                size = f.size()
                check_end(f, size, path)
                s = _Bytes(chunks(f, size))
                refs = len(read_header(s)[1])
                # where records begin: in the block read last, after what of it belongs to the header
                first = last[0], len(last[1]) - (len(s.data) - s.at)
            out += [_Range(path, a, min(a + self.split, size), size, refs, first, base) for a in range(0, size, self.split)]
            base += size
        return out

    def read(self, p: _Range) -> Iterator[pa.RecordBatch]:
        with opened(p.path) as f:
            known = p.start <= p.first[0]
            start = p.first[0] if known else _first_block(f, p.start, p.end, p.size)
            if start >= p.end:
                return
            chain = blocks(f, start, p.size)
            boundary = Boundary(p.refs)
            held, total, data = [], 0, np.zeros(0, np.uint8)  # pieces, their bytes, and all of them as one
            places: list[int] = []  # of each block: its place in the bytes
            offsets: list[int] = []  # and in the file
            skip = p.first[1] if known else 0
            want = 1
            while True:
                done = False
                while total < want and not done:  # gather pieces, then join them once
                    block = next(chain, None)
                    if block is None:
                        done = True
                    else:
                        places.append(total)
                        offsets.append(block[0])
                        held.append(block[1])
                        total += len(block[1])
                if held:
                    data = np.concatenate([data, *(np.frombuffer(x, np.uint8) for x in held)])
                    held = []
                outside = next((at for at, o in zip(places, offsets, strict=True) if o >= p.end), None)
                limit = len(data) if outside is None else outside
                if not known:
                    at = boundary.feed(data, limit, done)
                    if at == -1:
                        return
                    if at is None:
                        gone = boundary.first()
                        boundary.drop(gone)
                        data, places, offsets, total = _dropped(data, places, offsets, gone)
                        want = total + (1 << 16)
                        continue
                    known, skip = True, at
                found, z = [], skip
                view = memoryview(data)
                while z < limit and z + 4 <= len(data):
                    n = struct.unpack_from("<i", view, z)[0]
                    if not 32 <= n < _LONGEST:
                        raise ValueError(f"{p.path}: no record at block {offsets[0]}, byte {z}")
                    if z + 4 + n > len(data):
                        break
                    found.append(z)
                    z += 4 + n
                if found:
                    at = np.array(found, np.int64)
                    own = np.searchsorted(places, at, side="right") - 1
                    idx = (p.base + np.array(offsets, np.int64)[own]) << 16 | at - np.array(places, np.int64)[own]
                    yield columns(data, at, idx, self.wanted)
                if z >= limit and (outside is not None or done):
                    return
                if done:
                    raise ValueError(f"{p.path} ends inside a record")
                need = struct.unpack_from("<i", view, z)[0] + 4 if z + 4 <= len(data) else 4
                del view
                data, places, offsets, total = _dropped(data, places, offsets, z)
                skip, want = 0, max(need, self.BATCH) if outside is None else need


def _dropped(data: np.ndarray, places: list[int], offsets: list[int], n: int) -> tuple[np.ndarray, list[int], list[int], int]:
    """The bytes after the first n, and the blocks they are in."""
    k = max(int(np.searchsorted(places, n, side="right")) - 1, 0)
    return data[n:], [x - n for x in places[k:]], offsets[k:], len(data) - n


class HeaderReader(DataSourceReader):
    """A row for each header line and for each reference of the binary dictionary (kind ``ref``)."""

    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self):
        return [InputPartition(p) for p in self.paths]

    def read(self, partition) -> Iterator[tuple]:
        with opened(partition.value) as f:
            text, refs = read_header(_Bytes(data for _, data in blocks(f, 0, f.size())))
        lines = [x for x in text.split("\n") if x]
        for k, line in enumerate(lines):
            yield partition.value, k, *header_line(line)
        for k, (name, length) in enumerate(refs):
            yield partition.value, k, "ref", {"SN": name, "LN": str(length)}


def header_line(line: str) -> tuple[str, dict[str, str]]:
    kind, *rest = line.split("\t")
    return kind[1:], {"": "\t".join(rest)} if kind == "@CO" else {x[:2]: x[3:] for x in rest}


class BamDataSource(DataSource):
    """``spark.read.format("bam").option("path", "a.bam,b.bam").load()``; ``fields``: ``core`` (what a comparison reads),
    ``full`` (all eleven fields and tags), names with commas, or ``header``."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def _wanted(self) -> StructType:
        fields = self.options.get("fields", "core")
        if fields in ("core", "full"):
            return {"core": RECORD, "full": FULL_RECORD}[fields]
        names = fields.split(",")
        if unknown := sorted(set(names) - set(FULL_RECORD.names)):
            raise ValueError(f"unknown fields: {', '.join(unknown)}")
        return StructType([FULL_RECORD[n] for n in names])

    def schema(self) -> StructType:
        return HEADER if self.options.get("fields") == "header" else self._wanted()

    def reader(self, schema) -> DataSourceReader:
        paths = self.options["path"].split(",")
        if self.options.get("fields") == "header":
            return HeaderReader(paths)
        return BamReader(paths, self._wanted().names, int(self.options.get("split", str(64 << 20))))
