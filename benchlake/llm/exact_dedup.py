"""Exact dedup: composable polynomial fingerprints, then chunkwise streaming comparison.

A text without white space is cut into chunks of ``CHUNK`` bytes. All chunks of a document are hashed
at once by one matrix product per modulus; products and sums stay below 2**53, so double precision is
exact. Two chunk hashes combine by ``h(xy) = h(x) * r**len(y) + h(y)``, which is associative: texts of
more than ``HUGE`` characters are cut into pieces that tasks hash in parallel, and the pieces' hashes are
combined in order. The fingerprint is two such hashes modulo 31-bit primes plus the length.

Rows with equal fingerprints are compared with their group's keeper piece by piece, each piece in a
stream of its own, so no task holds more than a piece of the keeper. Groups of any size are dealt over
``salt`` buckets, the keeper's text going to each bucket that is in use; rows that turn out to differ (a
fingerprint collision) form a residue that is grouped again.

Defined cases: null and empty texts are equal to each other and to texts of white space only; ties in
code points go to the smallest doc_id (null is below all), then to the row read first, so that one row of
each group stays; rows that repeat a doc_id with another text are documents of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import handing_back, keyed_texts, materialize, tuned, unkey

SPACE = b" \t\n\x0b\x0c\r"
CHUNK = 4096
PRIMES = (2147483647, 2147483629)  # the two largest primes below 2**31
BASES = (911382323, 972663749)
#: Rows of one group that one bucket compares.
BUCKET_ROWS = 256
#: Characters of a text that is hashed in parallel, and of the pieces it and compared texts are cut into.
HUGE, PIECE = 1 << 22, 1 << 18


def _powers(n: int) -> np.ndarray:
    out = np.empty((n, 2))
    for k, (p, r) in enumerate(zip(PRIMES, BASES, strict=True)):
        x = 1
        for i in range(n - 1, -1, -1):
            out[i, k] = x
            x = x * r % p
    return out


_POWERS = _powers(CHUNK)
Fingerprint = tuple[int, int, int]


def chunk_hashes(data: bytes) -> list[Fingerprint]:
    """(hash, hash, length) of each chunk; a byte b counts as b + 1 so that zeros are told apart."""
    a = np.frombuffer(data, np.uint8)
    full = len(a) // CHUNK
    out: list[Fingerprint] = []
    for k in range(0, full, 64):
        part = a[k * CHUNK : min(full, k + 64) * CHUNK].reshape(-1, CHUNK).astype(np.float64) + 1
        out += [(int(x) % PRIMES[0], int(y) % PRIMES[1], CHUNK) for x, y in part @ _POWERS]
    if rest := len(a) - full * CHUNK:
        x, y = (a[full * CHUNK :].astype(np.float64) + 1) @ _POWERS[CHUNK - rest :]
        out.append((int(x) % PRIMES[0], int(y) % PRIMES[1], rest))
    return out


def combine(left: Fingerprint, right: Fingerprint) -> Fingerprint:
    """The fingerprint of left's text followed by right's."""
    x, y = ((h * pow(r, right[2], p) + g) % p for h, g, r, p in zip(left, right, BASES, PRIMES, strict=False))
    return x, y, left[2] + right[2]


def fingerprint(data: bytes) -> Fingerprint:
    out: Fingerprint = (0, 0, 0)
    for h in chunk_hashes(data):
        out = combine(out, h) if out[2] else h
    return out


def normalise(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(None, SPACE)


def _normalised(text: str) -> Column:
    return F.translate(text, SPACE.decode(), "")


def _pieces(text: str) -> Column:
    """A text in pieces of PIECE characters; one if it is empty."""
    last = F.greatest(F.ceil(F.length(text) / PIECE) - 1, F.lit(0).cast("long"))
    return F.transform(F.sequence(F.lit(0).cast("long"), last), lambda k: F.substring(text, (k * PIECE + 1).cast("int"), F.lit(PIECE)))


_DIGESTS = "seat long, doc_id long, row long, f long, n_bytes long, n_points long, text_sha256 string"


def _whole(docs: DataFrame) -> DataFrame:
    """Digests of texts that a task hashes alone."""

    def run(batches):
        seat = TaskContext.get().partitionId() << 40
        for b in batches:
            f, size, points, sha = [], [], [], []
            for t in b.column(2).to_pylist():
                data = normalise(t)
                x, y, n = fingerprint(data)
                f.append(x << 31 | y)
                size.append(n)
                points.append(len(t))
                sha.append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(seat, seat + len(f))), b.column(0), b.column(1), pa.array(f, pa.int64()), pa.array(size, pa.int64()), pa.array(points, pa.int64()), pa.array(sha)], names=["seat", "doc_id", "row", "f", "n_bytes", "n_points", "text_sha256"])
            seat += len(f)

    return docs.filter(F.length("text") <= HUGE).mapInArrow(handing_back(run), _DIGESTS)


def _huge(docs: DataFrame) -> DataFrame:
    """Digests of texts whose pieces are hashed in parallel. Seats are negative: none is one of _whole."""

    def run(batches):
        for b in batches:
            out = [fingerprint(t.encode("utf-8", "surrogatepass")) for t in b.column(1).to_pylist()]
            shifts = [[pow(r, n, p) for _, _, n in out] for r, p in zip(BASES, PRIMES, strict=True)]
            cols = [*([h[k] for h in out] for k in range(3)), *shifts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *(pa.array(c, pa.int64()) for c in cols)], names=["seat", "at", "x", "y", "n", "sx", "sy"])

    big = docs.filter(F.length("text") > HUGE).withColumn("seat", -F.monotonically_increasing_id() - 1)
    big = materialize(big.select("seat", "doc_id", "row", F.length("text").cast("long").alias("n_points"), _normalised("text").alias("text")), "huge")
    parts = big.select("seat", F.posexplode(_pieces("text")).alias("at", "piece")).select("seat", "piece", F.col("at").cast("long").alias("at"))
    hashed = parts.repartition("seat", "at").mapInArrow(run, "seat long, at long, x long, y long, n long, sx long, sy long")
    listed = hashed.groupBy("seat").agg(F.array_sort(F.collect_list(F.struct("at", "x", "y", "n", "sx", "sy"))).alias("s"))  # pieces of one text
    zero = F.lit(0).cast("long")
    both = F.aggregate("s", F.struct(zero.alias("x"), zero.alias("y"), zero.alias("n")), lambda h, g: F.struct(((h["x"] * g["sx"] + g["x"]) % PRIMES[0]).alias("x"), ((h["y"] * g["sy"] + g["y"]) % PRIMES[1]).alias("y"), (h["n"] + g["n"]).alias("n")))
    known = big.select("seat", "doc_id", "row", "n_points", F.sha2("text", 256).alias("text_sha256")).join(listed.select("seat", both.alias("h")), "seat")
    return known.select("seat", "doc_id", "row", F.shiftleft("h.x", 31).bitwiseOR(F.col("h.y")).alias("f"), F.col("h.n").alias("n_bytes"), "n_points", "text_sha256")


def digests(docs: DataFrame) -> DataFrame:
    """Per row: seat (a number of its own, good once written), doc_id, row, f (both hashes), n_bytes, n_points
    of the original, text_sha256."""
    given = keyed_texts(docs)
    return _whole(given).union(_huge(given))


def _compare(batches):
    """Rows in order (group, bucket, piece, keeper first): which rows differ from their keeper's piece."""
    head, theirs = None, None
    for b in batches:
        differs = []
        *names, first, doc, row, piece = (b.column(k).to_pylist() for k in range(9))
        for own, keeper, d, r, mine in zip(zip(*names, strict=True), first, doc, row, piece, strict=True):
            if own != head:
                head, theirs = own, mine if keeper else None
            if not keeper and mine != theirs:
                differs.append((d, r, own[0], own[1]))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in differs], pa.int64()) for k in range(4)], names=["doc_id", "row", "f", "n_bytes"])


def _grouped(rows: DataFrame) -> DataFrame:
    best = F.struct(F.col("n_points"), (-F.col("doc_id")).alias("neg"), (-F.col("seat")).alias("seat"), F.col("row"))
    one = rows.groupBy("f", "n_bytes", "turn").agg(F.count("*").alias("group_size"), F.max(best).alias("best"))
    return one.select("f", "n_bytes", "turn", "group_size", (-F.col("best.neg")).alias("keep_id"), (-F.col("best.seat")).alias("keep_seat"), F.col("best.row").alias("keep_row"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row (hash of the text). Every
    row's text is read once for its fingerprint; only texts of groups with two or more rows are compared."""
    tuned(docs.sparkSession)
    known = materialize(digests(docs).withColumn("turn", F.lit(0)), "digests")
    turn = 0
    while True:
        groups = materialize(_grouped(known), "groups")  # of its own, so that the joins may split a large group's rows
        many = groups.filter((F.col("group_size") > 1) & (F.col("turn") == turn))
        inside = known.filter(F.col("turn") == turn).join(many, ["f", "n_bytes", "turn"])
        buckets = F.ceil(F.col("group_size") / BUCKET_ROWS).cast("int")
        other = (F.col("doc_id") != F.col("keep_id")) | (F.col("row") != F.col("keep_row"))
        members = inside.filter(other).select("f", "n_bytes", "turn", F.pmod(F.xxhash64("doc_id", "row"), buckets).cast("int").alias("bucket"), F.lit(False).alias("keeper"), "doc_id", "row")
        members = materialize(members, "members").distinct()  # of its own: an aggregate in the join's stage would keep a large group's rows in one task
        heads = many.select("f", "n_bytes", "turn", F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket"), F.lit(True).alias("keeper"), F.col("keep_id").alias("doc_id"), F.col("keep_row").alias("row"))
        wanted = members.union(heads)
        texted = keyed_texts(docs).join(wanted, ["doc_id", "row"]).withColumn("text", _normalised("text"))
        cut = texted.select("f", "n_bytes", "turn", "bucket", F.posexplode(_pieces("text")).alias("at", "piece"), "keeper", "doc_id", "row").select("f", "n_bytes", "turn", "bucket", "at", "keeper", "doc_id", "row", "piece")
        keys = ("f", "n_bytes", "turn", "bucket", "at")
        dealt = cut.repartition(*keys).sortWithinPartitions(*keys, F.desc("keeper"), "doc_id", "row")
        differing = materialize(dealt.mapInArrow(_compare, "doc_id long, row long, f long, n_bytes long").distinct(), "differing")
        if differing.isEmpty():
            break
        known = materialize(known.join(differing.select("doc_id", "row", F.lit(turn + 1).alias("later")), ["doc_id", "row"], "left").withColumn("turn", F.coalesce("later", "turn")).drop("later"), "digests")
        turn += 1
    out = known.join(groups, ["f", "n_bytes", "turn"])
    return out.select(unkey("doc_id"), unkey("keep_id"), "group_size", (F.col("seat") == F.col("keep_seat")).alias("kept"), "text_sha256", "row")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]', '', 'g') AS n FROM documents),
k AS (SELECT doc_id, n, first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM k
"""
