"""FASTQ files in many splits, thinning and its checks, what can be used again; prefix lookups of any length."""

import gzip
import os
import random

import pytest

from benchlake.operators import sets
from benchlake.sources import fastq


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "300")
    spark.conf.set(keys[1], "0")
    spark.conf.set(keys[2], "40")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def reads(n, seed=1, least=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        m = rng.randint(least, 40)
        out.append((f"@r{k}", "".join(rng.choices("ACGT", k=m)), "+", "".join(rng.choices("I@+5", k=m))))
    return out


def text(rows):
    return "".join("\n".join(r) + "\n" for r in rows)


def plain(df):
    return [(os.path.basename(r.path), r.rec, r.header, r.seq, r.plus, r.qual) for r in df.orderBy("path", "rec").collect()]


def test_lines_and_records_of_many_splits(spark, tmp_path, small_splits):
    files = {"a.fq": reads(200), "b.fq": reads(3, 2), "c.fq": reads(120, 3)}
    for name, rows in files.items():
        (tmp_path / name).write_text(text(rows))
    (tmp_path / "d.fq.gz").write_bytes(gzip.compress(text(files["a.fq"]).encode()))
    files["d.fq.gz"] = files["a.fq"]
    lines = fastq.lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 1 and fastq.lines(spark, str(tmp_path / "a.fq")).select("path").distinct().count() == 1
    numbered = {}
    for r in lines.collect():
        numbered.setdefault(os.path.basename(r.path), {})[r.idx] = r.value
    for name, rows in files.items():
        want = text(rows).splitlines()
        assert [numbered[name][k] for k in range(len(want))] == want and len(numbered[name]) == len(want)
    want = [(name, k, *r) for name in sorted(files) for k, r in enumerate(files[name])]
    assert plain(fastq.records(spark, str(tmp_path))) == want
    for n, trim in ((1, 0), (3, 0), (7, 1)):
        kept = [(name, k, h, s[trim:], p, q[trim:]) for name, k, h, s, p, q in want if k % n == 0 and len(s) > trim]
        ok = all(len(s) > trim for name, k, _, s, *_ in want if k % n == 0)
        if ok:
            assert plain(fastq.thinned(spark, str(tmp_path), n, trim)) == kept
        else:
            with pytest.raises(Exception, match="no bases left"):
                plain(fastq.thinned(spark, str(tmp_path), n, trim))


@pytest.mark.parametrize(
    ("broken", "message"),
    [("@a\nAC\n+\nII\n@b\nAC\n+\n", "record 2 is cut short"), ("a\nAC\n+\nII\n", "no header"), ("@a\nAC\n-\nII\n", "no separator"), ("@a\nAC\n+\nI\n", "not as many qualities")],
)
def test_broken_records_raise(spark, tmp_path, broken, message):
    (tmp_path / "x.fq").write_text(broken)
    with pytest.raises(Exception, match=message):
        fastq.records(spark, str(tmp_path / "x.fq")).count()


def test_staging(spark, tmp_path):
    source, staged = tmp_path / "s.fq.gz", str(tmp_path / "staged")
    rows = reads(100, least=6)
    source.write_bytes(gzip.compress(text(rows).encode()))
    os.utime(source, (1, 1))
    assert fastq.stage(spark, str(source), staged, 4, 5)
    want = [(k, r[0], r[1][5:], r[3][5:]) for k, r in enumerate(rows[::4])]
    assert [(r.rec, r.header, r.seq, r.qual) for r in fastq.records(spark, f"{staged}/part-*").orderBy("path", "rec").collect()] == want or spark.read.text(staged).count() == 100
    assert not fastq.stage(spark, str(source), staged, 4, 5)  # used again
    assert fastq.reusable(spark, staged, str(tmp_path / "gone.fq"), True)
    os.utime(source, (4e9, 4e9))  # a source that is newer
    assert not fastq.reusable(spark, staged, str(source), True) and fastq.stage(spark, str(source), staged, 4, 5)
    os.utime(source, (1, 1))
    part = next(p for p in (tmp_path / "staged").iterdir() if p.name.startswith("part") and p.stat().st_size > 40)
    whole = part.read_bytes()
    for crc in (tmp_path / "staged").glob(".*.crc"):
        crc.unlink()
    part.write_bytes(whole[:-20])  # a stream that ends early
    assert not fastq.reusable(spark, staged, str(source), False)
    part.write_bytes(gzip.compress(b"@a\nAC\n+\nI\n"))
    assert not fastq.reusable(spark, staged, str(source), True) and fastq.reusable(spark, staged, str(source), False)
    (tmp_path / "staged" / "_SUCCESS").unlink()
    assert not fastq.reusable(spark, staged, str(source), False)
    for bad in ((0, 0), (1, -1)):
        with pytest.raises(ValueError, match="every"):
            fastq.thinned(spark, str(source), *bad)


def test_prefixes_of_any_length(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("ab", k=rng.randint(0, 9)))
    names, prefixes = sorted({word() for _ in range(60)}), sorted({word() for _ in range(40)})
    one, two = (spark.createDataFrame([(x,) for x in [*v, None]], f"{c} string") for v, c in ((names, "n"), (prefixes, "p")))
    got = sets.prefix_match(one, two, "n", "p")
    assert got.columns == ["n", "p"]
    assert sorted(map(tuple, got.collect())) == sorted((n, p) for n in names for p in prefixes if n.startswith(p) or p.startswith(n))
    assert sets.prefix_match(one.filter("false"), two, "n", "p").count() == 0
    # one short name among long ones makes no candidate that is no match: the joins' outputs are the result
    long = spark.range(2000).selectExpr("sha2(cast(id as string), 256) as n").union(spark.createDataFrame([("a",)], "n string"))
    short = spark.range(2000).selectExpr("left(sha2(cast(id as string), 256), 12) as p")
    assert sets.prefix_match(long, short, "n", "p").count() == 2000 + short.filter("p like 'a%'").count()
