"""Artifact tree round trip, malformed telemetry, latest-wins store."""

import json
import random
import struct
import zlib

import pytest

from benchlake.sinks.render import inject, md_table, publish
from benchlake.sinks.store import NewerStore, Store
from benchlake.sources import alignments, artifacts, dimensions
from benchlake.streaming.ingest import ingest_probes


def put(root, path, text):
    p = root / path
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)


@pytest.fixture
def tree(tmp_path):
    cell = "runs/abc/smoke/c7g/rep-1"
    put(tmp_path, f"{cell}/benchmarks/timing.tsv", "s\th:m:s\tmax_rss\tio_in\tio_out\tmean_load\tcpu_time\n12.5\t0:00:12\t100\t1\tNA\t3\t40\n")
    put(tmp_path, f"{cell}/benchmarks/meta.json", json.dumps({"instance_id": "unknown", "instance_type": "c7g.4xlarge", "measured_at": "2025-01-02T03:04:05Z", "image_variant": "native"}))
    put(tmp_path, f"{cell}/benchmarks/tool.stderr.log", "x\n\tIndex read time avg: 2.44, (2.44, 2.44)\n\tPROCESS() (Total compute time + (read + SAM) IO time) : 8.76\n")
    put(tmp_path, f"{cell}/compare/vs-baseline.json", json.dumps({"total_reads": 10, "concordant": 9, "concordance_pct": 90.0, "by_class": {"pos_diff": {"count": 1, "pct": 10.0}}, "supp_query_total": 3, "placement": {"relocated_pct": 1.5}}))
    put(tmp_path, f"{cell}/eval/candidate.eval.txt", "mapq_bin total correct mismapped unmapped pct_correct pct_mismapped pct_unmapped\n0 10 5 5 0 50 50 0\n60+ 90 89 1 0 98.9 1.1 0\nALL 100 94 6 0 94.0 6.0 0.0\n")
    put(tmp_path, f"{cell}/eval/candidate.variants.tsv", "class\tconfounded\tn_expected\tn_represented\trepresented_pct\tmean_mapq\tmean_as\nsnp\tno\t10\t9\t90\t55\tNA\n#variant_bearing_reads\t10\n#md_concordant_pct\t99\n#nm_concordant_pct\tNA\n")
    put(tmp_path, f"{cell}/eval/candidate.meth.tsv", "")
    for bad in ("rep-0", "rep-01", "rep-backup"):
        put(tmp_path, f"runs/abc/smoke/c7g/{bad}/benchmarks/timing.tsv", "s\th:m:s\n1\t0\n")
    return tmp_path


def test_tree(spark, tree):
    root = str(tree / "runs")
    (t,) = artifacts.trials(spark, root).collect()
    assert (t.wall_seconds, t.io_write_mb, t.process_seconds, t.index_read_seconds, t.reads_processed, t.rep) == (12.5, 0.0, 8.76, 2.44, 10, 1)
    assert t.instance_id == "unknown" and artifacts.meta(spark, root).first().host is None
    (c,) = artifacts.comparisons(spark, root).collect()
    assert json.loads(c.supp_json) == {"supp_query_total": 3} and json.loads(c.placement_json) == {"relocated_pct": 1.5}
    (a,) = artifacts.accuracy(spark, root).collect()
    assert (a.placement_total, a.placement_correct_pct, a.variant_bearing_reads, a.nm_concordant_pct, a.meth_n_cpg) == (100, 94.0, 10, None, None)
    assert json.loads(a.by_class_json)["snp|no"]["n_represented"] == 9


def test_grades_without_all_row_fail(spark, tree):
    put(tree, "runs/abc/smoke/c7g/rep-1/eval/candidate.eval.txt", "mapq_bin total correct\n0 10 5 5 0\n")
    with pytest.raises(Exception, match="ALL"):
        artifacts.eval_tables(spark, str(tree / "runs")).collect()


def test_scaling_and_arena(spark, tmp_path):
    put(tmp_path, "scaling/abc/wgs/c8g/scaling.tsv", "threads\trep\twall_s\tcpu_s\tmax_rss_mb\tprocess_s\n1\t1\t10\t10\t5\tNA\n2\t1\t5\n4\t1\t3\t10\t5\t2.5\n")
    assert [(r.threads, r.process_seconds, r.kernel_seconds) for r in artifacts.scaling(spark, str(tmp_path / "scaling")).orderBy("threads").collect()] == [(1, None, None), (4, 2.5, None)]
    head = "label\tmode\trep\twall_s\tcpu_s\tmax_rss_mb\tprocess_s\tblock\tindex_read_s\tposition"
    put(tmp_path, "arena/abc/c8g/arena.tsv", f"{head}\nv1\tdefault\t1\t9\t9\t9\t8\tb0\t1.5\t3\nv2\tdefault\t1\tNA\tNA\tNA\tNA\tb0\tNA\t4\nshort\trow\n")
    got = artifacts.arena(spark, str(tmp_path / "arena")).orderBy("label").collect()
    assert [(r.label, r.wall_seconds, r.index_read_seconds, r.position) for r in got] == [("v1", 9.0, 1.5, 3), ("v2", None, None, 4)]
    put(tmp_path, "arena/abc/c8g/arena.tsv", head + "\tsurprise\nv1\tdefault\t1\t9\t9\t9\t8\tb0\t1.5\t3\t1\n")
    with pytest.raises(Exception, match="unknown column"):
        artifacts.arena(spark, str(tmp_path / "arena")).collect()


HOSTILE = ["not json", "[1]", '{"status": "ok"}', '{"phase": 3}', '{"phase": "a", "threads": {}, "seconds": true}', '{"phase": "b", "threads": true, "million_accesses_per_sec": "5"}', '{"phase": "c", "threads": 99999999999999999999999, "seconds": 1e999}', '{"phase": "d", "threads": 4, "seconds": 1.5, "working_set_bytes_per_thread": 2097152, "million_accesses_per_sec": 7}']


def test_probes_are_never_fatal(spark, tmp_path):
    put(tmp_path, "scaling/abc/wgs/c8g/host-probe.jsonl", "\n".join(HOSTILE))
    got = {r.phase: (r.threads, r.seconds, r.m_accesses_per_sec, r.working_set_mb_per_thread, r.rep) for r in artifacts.probes(spark, str(tmp_path / "scaling")).collect()}
    assert got == {"a": (None, None, None, None, 0), "b": (None, None, None, None, 0), "c": (None, None, None, None, 0), "d": (4, 1.5, 7.0, 2.0, 0)}


def test_store_is_idempotent_and_latest_wins(spark, tree, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    trials = artifacts.trials(spark, str(tree / "runs"))
    for _ in range(2):
        store.upsert("trials", trials)
    assert store.read("trials").count() == 1
    store.upsert("trials", trials.selectExpr("id", "run_sha", "sample", "arch", "rep", "99.0 as wall_seconds"))
    r = store.read("trials").first()
    assert (r.wall_seconds, r.process_seconds) == (99.0, None)
    runs = lambda b, s: spark.createDataFrame([("abc", b, s)], "run_sha string, branch string, status string")
    store.upsert_runs(runs("main", "running"))
    store.upsert_runs(runs(None, "done"))
    r = store.read("runs").first()
    assert (r.branch, r.status) == ("main", "done")


def test_arena_is_replaced_by_cell(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = lambda *x: spark.createDataFrame(list(x), "run_sha string, arch string, label string, mode string, rep long")
    store.replace_arena(rows(("s", "a", "v1", "default", 1), ("s", "b", "v1", "default", 1), ("t", "a", "v1", "default", 1)))
    store.replace_arena(rows(("s", "a", "v2", "default", 1)))
    store.replace_arena(rows(("s", "a", "v2", "default", 1)).filter("false"))
    assert sorted((r.run_sha, r.arch, r.label) for r in store.read("arena").collect()) == [("s", "a", "v2"), ("s", "b", "v1"), ("t", "a", "v1")]


def test_newer_store_is_refused(spark, tmp_path):
    put(tmp_path, "store/_manifest/part.json", '{"schema_version": 99}')
    with pytest.raises(NewerStore):
        Store(spark, str(tmp_path / "store"))


def test_streaming_probes(spark, tmp_path):
    put(tmp_path, "in/abc/wgs/c8g/rep-2/host-probe.jsonl", HOSTILE[-1])
    for _ in range(2):
        ingest_probes(spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "ckpt")).awaitTermination(60)
    (r,) = Store(spark, str(tmp_path / "store")).read("host_probes").collect()
    assert (r.rep, r.phase, r.threads) == (2, "d", 4)


def test_dimensions(spark):
    ok = "divergences:\n- {id: a, pr: 1, date: d, summary: s, affected: x, expected_drift_pct: 0.5, samples: wgs}\n"
    assert dimensions.registry(spark, ok).first().samples == ["wgs"]
    for bad in (ok.replace("summary: s, ", ""), ok.replace("samples", "sample"), ok.replace("samples: wgs", "metric: speed"), ok.replace("samples: wgs", "gating: 1")):
        with pytest.raises(ValueError):
            dimensions.registry(spark, bad)
    with pytest.raises(ValueError, match="list"):
        dimensions.ledger(spark, "allowances:\n- {to_sha: a, pr: 1, date: d, summary: s, expected_drift_pct: 0, aliases: x}\n")


def bgzf(data):
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", 6) + b"BC\2\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def test_bam(spark, tmp_path):
    def record(name, flags, ref, pos, mapq, cigar, tags):
        n = name.encode() + b"\0"
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(n), mapq, 0, len(cigar), flags, 4, -1, -1, 0) + n + b"".join(struct.pack("<I", k << 4 | "MIDNSHP=X".index(o)) for o, k in cigar) + b"\0\0" + b"\xff" * 4 + tags
        return struct.pack("<i", len(body)) + body

    head = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 4) + b"chr\0" + struct.pack("<i", 1000)
    a = record("q1", 0x41, 0, 99, 60, [("S", 1), ("M", 3)], b"NMc\3" + b"XZZhi\0" + b"XBBc" + struct.pack("<i", 2) + b"\1\2")
    b = record("q2", 0x4, -1, -1, 255, [], b"")
    (tmp_path / "x.bam").write_bytes(bgzf(head + a[:20]) + bgzf(a[20:] + b) + bgzf(b""))
    got = alignments.bam(spark, str(tmp_path / "x.bam")).orderBy("idx").collect()
    assert [(r.name, r.flags, r.ref_id, r.pos, r.mapq) for r in got] == [("q1", 0x41, 0, 100, 60), ("q2", 4, None, None, None)]
    assert [(c.op, c.len) for c in got[0].cigar] == [("S", 1), ("M", 3)]
    assert {k: (v.t, v.v) for k, v in got[0].tags.items()} == {"NM": ("Int", "3"), "XZ": ("Str", "hi"), "XB": ("Other", "c,1,2")}


def test_bam_ranges_hold_every_record_once(spark, tmp_path):
    rng = random.Random(17)

    def record(k):
        n = f"read{k}/{'x' * rng.randint(0, 30)}".encode() + b"\0"
        seq = rng.randint(0, 150)
        body = struct.pack("<iiBBHHHiiii", rng.randint(0, 2), rng.randint(0, 900), len(n), rng.randint(0, 60), 0, 1, 65, seq, -1, -1, 0) + n + struct.pack("<I", 75 << 4) + bytes(rng.randrange(256) for _ in range((seq + 1) // 2 + seq)) + b"NMC" + bytes([k % 256])
        return struct.pack("<i", len(body)) + body

    head = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 3) + b"".join(struct.pack("<i", 4) + b"chr\0" + struct.pack("<i", 1000) for _ in range(3))
    paths, want = [], []
    for f, count in enumerate((700, 1, 0, 300)):
        data = b"".join(record(k) for k in range(count))
        cuts = sorted({0, len(data), *(rng.randint(0, len(data)) for _ in range(count // 5))}) if f else [0, *range(997, len(data), 997), len(data)]
        out = bgzf(head) + b"".join(bgzf(data[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)) + bgzf(b"")
        (tmp_path / f"{f}.bam").write_bytes(out)
        paths.append(str(tmp_path / f"{f}.bam"))
        want += [(k % 256) for k in range(count)]
    for split in (1 << 20, 5000, 700):
        got = alignments.bam(spark, ",".join(paths), split).orderBy("idx").collect()
        assert [int(r.tags["NM"].v) for r in got] == want and len({r.idx for r in got}) == len(want)


def test_sam(spark, tmp_path):
    put(tmp_path, "x.sam", "@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:9\n@SQ\tSN:chr2\tLN:9\nq1\t65\tchr2\t100\t60\t5S70M\t*\t0\t0\t*\t*\tNM:i:3\tXZ:Z:a:b\nq2\t4\t*\t0\t255\t*\t*\t0\t0\t*\t*\n")
    got = alignments.sam(spark, str(tmp_path / "x.sam")).orderBy("idx").collect()
    assert [(r.name, r.flags, r.ref_id, r.pos, r.mapq) for r in got] == [("q1", 65, 1, 100, 60), ("q2", 4, None, None, None)]
    assert [(c.op, c.len) for c in got[0].cigar] == [("S", 5), ("M", 70)] and {k: (v.t, v.v) for k, v in got[0].tags.items()} == {"NM": ("Int", "3"), "XZ": ("Str", "a:b")}


def test_render(tmp_path):
    assert md_table(["a", "b"], [(None, 1.5)]) == "| a | b |\n| --- | --- |\n|  | 1.5000 |"
    assert inject("x<!--s-->old<!--e-->y", "<!--s-->", "<!--e-->", "new") == "x<!--s-->\nnew\n<!--e-->y"
    with pytest.raises(ValueError):
        inject("<!--e--><!--s-->", "<!--s-->", "<!--e-->", "new")
    publish({"b": 1, "a": 2}, tmp_path / "r" / "data.json")
    with pytest.raises(FileExistsError):
        publish({}, tmp_path / "r" / "data.json")
