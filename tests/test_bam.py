"""The BAM source: every field, ranges, long records, files that are cut; identity of full records and headers."""

import random
import struct
import time

import bam_files as B
import numpy as np
import pytest

from benchlake.cli import main
from benchlake.operators import concordance as C
from benchlake.sources import alignments, bam

KINDS = {"A": "Char", "Z": "Str", "H": "Hex", "f": "Float", "B": "Other"}


def text_of(code, value):
    return ",".join([value[0], *map(repr, value[1])]) if code == "B" else repr(value) if code == "f" else str(value)


def want(r):
    none = lambda x, k: None if x == k else x
    place = lambda x: None if x < 0 else x + 1
    return (
        r["name"], r["flags"], none(r["ref"], -1), place(r["pos"]), none(r["mapq"], 255), [tuple(c) for c in r["cigar"]], none(r["next_ref"], -1), place(r["next_pos"]), r["tlen"], r["seq"] or None,
        r["qual"] or None, {n: (KINDS.get(c, "Int"), text_of(c, v)) for n, c, v in r["tags"]},
    )


def got(row):
    return (row.name, row.flags, row.ref_id, row.pos, row.mapq, [(c.op, c.len) for c in row.cigar], row.next_ref, row.next_pos, row.tlen, row.seq, row.qual, {k: (v.t, v.v) for k, v in row.tags.items()})


@pytest.mark.parametrize("split", [64 << 20, 3000, 400])
def test_all_fields_of_all_records(spark, tmp_path, split, monkeypatch):
    rng = random.Random(split)
    rows = [B.random_record(rng, k) for k in range(300)]
    data = b"".join(B.record(**r) for r in rows)
    paths = [B.write(tmp_path / "a.bam", data), B.write(tmp_path / "none.bam", b""), B.write(tmp_path / "b.bam", data, block=60000)]
    read = alignments.bam(spark, ",".join(paths), split, "full").orderBy("idx").collect()
    assert [got(r) for r in read] == [want(r) for r in rows] * 2
    some = alignments.bam(spark, paths[0], split, "tags,idx,pos")
    assert some.columns == ["tags", "idx", "pos"]
    assert [r.pos for r in some.orderBy("idx").collect()] == [want(r)[3] for r in rows]
    with pytest.raises(Exception, match="unknown fields: nam"):
        alignments.bam(spark, paths[0], split, "nam").schema  # noqa: B018


def test_cut_files_raise(spark, tmp_path):
    rows = [B.record(name=f"r{k}", seq="ACGT" * 5, tags=[("NM", "i", k)]) for k in range(50)]
    data = b"".join(rows)
    whole = B.write(tmp_path / "whole.bam", data)
    assert alignments.bam(spark, whole).count() == 50
    raw = (tmp_path / "whole.bam").read_bytes()
    cases = {
        "no end block": (raw[: -len(B.END)], "no end block"),
        "inside a block": (raw[:-200], "no end block"),
        "inside a record, at a block's end": (B.bgzf(B.header()) + B.bgzf(data[:-13]) + B.END, "ends inside a record"),
        "inside a length": (B.bgzf(B.header()) + B.bgzf(data + rows[0][:3]) + B.END, "ends inside a record"),
        "inside the header": (B.bgzf(B.header()[:20]) + B.END, "ends inside its header"),
        "damaged": (raw[:200] + bytes([raw[200] ^ 255]) + raw[201:], "block at byte"),
        "bytes behind": (raw + b"x", "no end block"),
        "a block cut inside": (B.bgzf(B.header()) + B.bgzf(data)[:-9] + B.END, "block at byte"),
        "a length of nothing": (B.bgzf(B.header()) + B.bgzf(data + struct.pack("<i", 3) + b"abc") + B.END, "no record at"),
        "tags that end early": (B.bgzf(B.header()) + B.bgzf(struct.pack("<i", len(rows[0]) - 6) + rows[0][4:-2]) + B.END, "inside a tag"),
        "no name": (B.bgzf(B.header()) + B.bgzf(B.record(name="*")) + B.END, "no name"),
    }
    for k, (name, (content, message)) in enumerate(cases.items()):
        (tmp_path / f"{k}.bam").write_bytes(content)
        for split in (64 << 20, 300):
            with pytest.raises(Exception, match=message):
                alignments.bam(spark, str(tmp_path / f"{k}.bam"), split).collect()
                pytest.fail(name)


def ranges(path, split):
    """Seconds and records of each range, read here."""
    reader = bam.BamReader([path], ["idx", "name"], split)
    out = []
    for p in reader.partitions():
        began = time.monotonic()
        out.append((sum(b.num_rows for b in reader.read(p)), time.monotonic() - began))
    return out


def test_ranges_inside_long_records_are_scanned_once(tmp_path):
    rng = np.random.default_rng(3)
    noise = lambda n: rng.integers(1, 256, n, np.uint8).tobytes().replace(b"\0", b"\1")
    long = [B.record(name=f"long{k}", seq="", tags=[]) for k in range(6)]
    data = b""
    for r in long:  # 6 MB of a text tag that does not compress
        body = r[4:] + b"XZZ" + noise(6 << 20) + b"\0"
        data += struct.pack("<i", len(body)) + body
    data += b"".join(B.record(name=f"short{k}") for k in range(500))
    path = B.write(tmp_path / "long.bam", data, block=60000)
    found = ranges(path, 1 << 20)
    assert sum(n for n, _ in found) == 506
    assert max(s for _, s in found) < 8  # a rescan for each block took minutes
    small = ranges(B.write(tmp_path / "l.bam", b"".join(B.record(name=f"s{k}") for k in range(2000))), 200)
    assert sum(n for n, _ in small) == 2000


def test_boundary_does_not_depend_on_the_pieces():
    rng = random.Random(9)
    records = [B.record(**B.random_record(rng, k)) for k in range(40)]
    data = np.frombuffer(b"".join(records), np.uint8)
    places = np.cumsum([0, *map(len, records)]).tolist()
    for start in [*range(0, 400, 7), places[20], places[20] + 1, places[-2] + 1]:
        tail, expected = data[start:], next((p - start for p in places[:-1] if p >= start), -1)
        for step in (37, 500, 100000):
            b, n, gone, at = bam.Boundary(3), 0, 0, None
            while at is None:
                n = min(n + step, len(tail))
                at = b.feed(tail[gone:n], n - gone, n == len(tail))
                if at is None:
                    first = b.first()
                    b.drop(first)
                    gone += first
            assert (at + gone if at >= 0 else -1) == expected


def test_header_and_identity(spark, tmp_path):
    text = "@HD\tVN:1.6\tSO:unsorted\tGO:query\n@SQ\tSN:chr1\tLN:1000\n@SQ\tSN:chr2\tLN:500\n@SQ\tSN:chr3\tLN:9\n@RG\tID:a\tSM:s\n@PG\tID:x\n@CO\ta: b\tc\n"
    rows = [dict(name=f"r{k}", seq="ACGT", qual="IIII", next_ref=0, next_pos=5, tlen=7, tags=[("NM", "C", 1), ("MD", "Z", "4")]) for k in range(20)]

    def file(stem, changed=None, text=text, **change):
        own = [r | (change if k == 7 else {}) for k, r in enumerate(rows)][: changed or len(rows)]
        return B.write(tmp_path / f"{stem}.bam", b"".join(B.record(**r) for r in own), B.header(text))

    one = file("one")
    lines = alignments.header(spark, one).collect()
    assert [(r.line, r.kind) for r in lines] == [(0, "HD"), (1, "SQ"), (2, "SQ"), (3, "SQ"), (4, "RG"), (5, "PG"), (6, "CO"), (0, "ref"), (1, "ref"), (2, "ref")]
    assert lines[6].fields == {"": "a: b\tc"} and lines[1].fields == {"SN": "chr1", "LN": "1000"}
    # another program, another order of tags and another width of an integer are the same records
    same = file("same", text=text.replace("@PG\tID:x", "@PG\tID:y"), tags=[("MD", "Z", "4"), ("NM", "i", 1)])
    assert main(["identity", one, same], spark) == 0
    changes = {"seq": {"seq": "ACGA"}, "qual": {"qual": "IIIJ"}, "next_ref": {"next_ref": 1}, "next_pos": {"next_pos": 6}, "tlen": {"tlen": -7}, "name": {"name": "other"}, "mapq": {"mapq": 3}, "tags": {"tags": [("NM", "C", 1), ("MD", "Z", "5")]}, "cigar": {"cigar": [("M", 3), ("S", 1)]}}
    full = lambda p: alignments.bam(spark, p, fields="full")
    for field, change in changes.items():
        row = C.record_identity(full(one), full(file("other", **change)), alignments.WIDTH).first()
        assert not row.identical and row.pairs == 20 and {c for c in C.FIELDS if row[c]} == {field}
    row = C.record_identity(full(one), full(file("short", changed=19))).first()
    assert (row.pairs, row.query_only, row.baseline_only, row.identical) == (19, 1, 0, False)
    for k, (old, new) in enumerate([("SO:unsorted", "SO:coordinate"), ("SN:chr2", "SN:chrX"), ("SM:s", "SM:t"), ("@RG\tID:a\tSM:s\n", "")]):
        other = file(f"h{k}", text=text.replace(old, new))
        found = C.header_differences(alignments.header(spark, one), alignments.header(spark, other)).collect()
        assert len(found) == 1 and main(["identity", one, other], spark) == 1


def test_sam_and_bam_hold_the_same_full_records(spark, tmp_path):
    rows = [dict(name="a", seq="ACG", qual="I+5", next_ref=0, next_pos=5, tlen=7, tags=[("NM", "C", 1)]), dict(name="a", flags=129, ref=1, next_ref=0, next_pos=9, seq=""), dict(name="b", flags=4, ref=-1, pos=-1, mapq=255, cigar=[])]
    path = B.write(tmp_path / "x.bam", b"".join(B.record(**r) for r in rows), B.header("@SQ\tSN:chr1\tLN:1000\n@SQ\tSN:chr2\tLN:500\n", (("chr1", 1000), ("chr2", 500))))
    sam = tmp_path / "x.sam"
    sam.write_text("@SQ\tSN:chr1\tLN:1000\n@SQ\tSN:chr2\tLN:500\na\t65\tchr1\t11\t60\t75M\t=\t6\t7\tACG\tI+5\tNM:i:1\na\t129\tchr2\t11\t60\t75M\tchr1\t10\t0\t*\t*\nb\t4\t*\t0\t255\t*\t*\t0\t0\t*\t*\n")
    row = C.record_identity(alignments.bam(spark, path, fields="full"), alignments.sam(spark, str(sam), "full")).first()
    assert row.identical and row.pairs == 3
    assert [r.kind for r in C.header_differences(alignments.header(spark, path), alignments.header(spark, str(sam))).collect()] == ["ref", "ref"]  # text has no binary dictionary
