"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash (hash and displace) over the vocabulary resolves a whole pre-token
that is itself a token. Tier two, for the rest: a heap of candidate merges over linked byte spans,
O(n log n) in the span's length; ties go to the leftmost pair, as in the tiktoken library.

The tables are built once on the driver and shipped with the tasks; their size is that of the
vocabulary file. A worker remembers the spans it has resolved in a bounded dictionary.

Defined cases: null counts as empty, an empty text has no ids; special-token strings in a text are
ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from benchlake.llm.common import texts, tuned, unkey

PATTERN = public_tokenizers.PATTERN
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pre-tokens that one generation of a worker's memory holds.
REMEMBERED = 400_000
#: Longer spans are resolved each time, so that the memory is bounded in bytes too.
LONGEST = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PerfectHash:
    """Minimal perfect hash of a fixed set of byte strings: n keys, n slots, one probe. A key's bucket
    names the seed that sends the bucket's keys to slots of their own; a bucket of one key names the
    slot itself."""

    def __init__(self, keys: list[bytes]):
        self.n = n = max(1, len(keys))
        self.buckets = max(1, n // 4)
        digest = xxhash.xxh64_intdigest
        lists: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for k in keys:
            lists[digest(k, 0) % self.buckets].append(k)
        self.shift = [0] * self.buckets
        self.slots: list[bytes | None] = [None] * n
        for i in sorted(range(self.buckets), key=lambda i: -len(lists[i])):
            own, seed = lists[i], 0
            if len(own) < 2:
                break
            while True:
                seed += 1
                at = {digest(k, seed) % n: k for k in own}
                if len(at) == len(own) and not any(self.slots[s] is not None for s in at):
                    break
            self.shift[i] = seed
            for s, k in at.items():
                self.slots[s] = k
        free = iter([s for s in range(n) if self.slots[s] is None])
        for i, own in enumerate(lists):
            if len(own) == 1:
                s = next(free)
                self.shift[i], self.slots[s] = -s - 1, own[0]

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1 if it is not of the set."""
        d = self.shift[xxhash.xxh64_intdigest(key, 0) % self.buckets]
        s = -d - 1 if d < 0 else xxhash.xxh64_intdigest(key, d) % self.n
        return s if self.slots[s] == key else -1


class Remembered(dict):
    """Pre-tokens resolved so far, in two generations of bounded size: the older one goes when the
    younger is full, and what is still in use moves up."""

    def __init__(self, resolve):
        super().__init__()
        self.resolve, self.older = resolve, {}

    def __missing__(self, span: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(span) or self.resolve(span)
        if len(span) <= LONGEST:
            self[span] = ids
        return ids


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.pattern = ranks, pattern
        self.whole = PerfectHash(list(ranks))
        self.rank_of_slot = [ranks[k] if k is not None else -1 for k in self.whole.slots]
        self.tokens = {r: k for k, r in ranks.items()}
        self._split = regex.compile(pattern)
        self._known = Remembered(self.resolve)

    def __getstate__(self):
        return self.ranks, self.pattern, self.whole, self.rank_of_slot

    def __setstate__(self, state):
        self.ranks, self.pattern, self.whole, self.rank_of_slot = state
        self.tokens = {r: k for k, r in self.ranks.items()}
        self._split = regex.compile(self.pattern)
        self._known = Remembered(self.resolve)

    def merge(self, span: bytes) -> tuple[int, ...]:
        """Tier two: lowest rank first, leftmost first, over linked spans [start, end[start])."""
        n, rank = len(span), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(span[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:  # one of the two has been merged meanwhile
                continue
            end[i], end[j], before[stop] = stop, 0, i
            if stop < n and (r := rank(span[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := rank(span[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[span[i : end[i]]])
            i = end[i]
        return tuple(out)

    def resolve(self, span: str) -> tuple[int, ...]:
        data = span.encode("utf-8", "surrogatepass")
        s = self.whole.slot(data)
        return (self.rank_of_slot[s],) if s >= 0 else self.merge(data)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._known.__getitem__, self._split.findall(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(read_ranks(path))


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per row: doc_id, ids (array<int>), decoded (binary, the bytes of the ids)."""
    return _encoded(docs, vocabulary, digest=False)


def encode_digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _encoded(docs, vocabulary, digest=True)


_WORKER: dict[str, Encoder] = {}


def _encoded(docs: DataFrame, vocabulary: str | None, digest: bool) -> DataFrame:
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    shipped = docs.sparkSession.sparkContext.broadcast(encoder(path))
    tuned(docs.sparkSession)

    def run(batches):
        own = _WORKER.setdefault(path, shipped.value)  # what a worker remembers lasts longer than a task
        decimal = {r: str(r) for r in own.tokens}
        for b in batches:
            n, ids_out, decoded = [], [], []
            for t in b.column(1).to_pylist():
                ids = own.encode(t)
                data = own.decode(ids)
                n.append(len(ids))
                ids_out.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest() if digest else ids)
                decoded.append(hashlib.sha256(data).hexdigest() if digest else data)
            if digest:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_out, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids_out, pa.list_(pa.int32())), pa.array(decoded, pa.binary())], names=["doc_id", "ids", "decoded"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids array<int>, decoded binary"
    out = texts(docs).mapInArrow(run, schema)
    return out.select(unkey("doc_id"), *out.columns[1:])
