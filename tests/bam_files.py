"""BAM files for tests, written field by field."""

import random
import struct
import zlib

BASES = "=ACMGRSVTWYHKDBN"


def bgzf(data):
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", 6) + b"BC\2\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


END = bgzf(b"")


def header(text="", refs=(("chr1", 1000), ("chr2", 500), ("chr3", 9))):
    names = b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in refs)
    return b"BAM\1" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(refs)) + names


def tag(name, code, value):
    head = name.encode() + code.encode()
    if code in "ZH":
        return head + value.encode() + b"\0"
    if code == "A":
        return head + value.encode()
    if code == "B":
        sub, values = value
        return head + sub.encode() + struct.pack(f"<i{len(values)}{sub.replace('c', 'b').replace('C', 'B').replace('s', 'h').replace('S', 'H')}", len(values), *values)
    return head + struct.pack("<" + {"c": "b", "C": "B", "s": "h", "S": "H"}.get(code, code), value)


def record(name="r", flags=65, ref=0, pos=10, mapq=60, cigar=(("M", 75),), next_ref=-1, next_pos=-1, tlen=0, seq="", qual=None, tags=()):
    """Places count from 0, -1 is none; tags: (name, code, value)."""
    packed = bytes(BASES.index(seq[i]) << 4 | (BASES.index(seq[i + 1]) if i + 1 < len(seq) else 0) for i in range(0, len(seq), 2))
    quality = bytes([255] * len(seq)) if qual is None else bytes(ord(c) - 33 for c in qual)
    n = name.encode() + b"\0"
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(n), mapq, 0, len(cigar), flags, len(seq), next_ref, next_pos, tlen) + n
    body += b"".join(struct.pack("<I", k << 4 | "MIDNSHP=X".index(o)) for o, k in cigar) + packed + quality + b"".join(tag(*t) for t in tags)
    return struct.pack("<i", len(body)) + body


def random_record(rng: random.Random, k: int) -> dict:
    seq = "".join(rng.choices(BASES, k=rng.choice([0, 1, 2, 7, 30])))
    tags = [("NM", "i", k), ("XA", "A", "q"), ("XZ", "Z", "é" * rng.randint(0, 3)), ("XH", "H", "7F"), ("Xc", "c", -5), ("XC", "C", 200), ("Xs", "s", -300), ("XS", "S", 60000), ("XI", "I", 4000000000), ("Xf", "f", 1.5), ("XB", "B", ("c", [1, -2])), ("Xb", "B", ("f", [0.5])), ("Xe", "B", ("I", []))]
    return {
        "name": f"read{k}/{'x' * rng.randint(0, 20)}", "flags": rng.randint(0, 4095), "ref": rng.randint(-1, 2), "pos": rng.randint(-1, 900), "mapq": rng.choice([0, 60, 255]),
        "cigar": [(rng.choice("MIDNSHP=X"), rng.randint(0, 90)) for _ in range(rng.randint(0, 4))], "next_ref": rng.randint(-1, 2), "next_pos": rng.randint(-1, 900), "tlen": rng.randint(-500, 500),
        "seq": seq, "qual": None if rng.random() < 0.3 else "".join(chr(33 + rng.randint(0, 60)) for _ in seq), "tags": rng.sample(tags, rng.randint(0, len(tags))),
    }


def write(path, data, head=None, block=997, end=END):
    path.write_bytes(bgzf(head if head is not None else header()) + b"".join(bgzf(data[a : a + block]) for a in range(0, len(data), block)) + end)
    return str(path)
