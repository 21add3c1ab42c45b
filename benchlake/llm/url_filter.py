"""URL filter: a bit-parallel wildcard automaton.

All glob rules are packed end to end into one multiword Shift-And mask. One step per character moves
every rule at once: ``D = ((D << 1) | starts) & B[c] | D & loops(c)``, followed by the closure over
wildcards that match nothing. The words of the mask are numpy ``uint64`` lanes and a whole batch of
URLs is stepped together, so a batch costs (longest URL) x (words of the mask) vector operations.

Glob syntax over the canonical URL ``"." + host + path``: ``*`` any run of characters but ``/``;
``**`` any run; anything else stands for itself. Rules are anchored at both ends.

Defined cases: a null URL or one without ``://`` has an empty host and path; a rule that matches
nothing leaves the verdict to the default globs and then to ``allow``; of equally long rules the one
that is listed first wins.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import key, tuned, unkey


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> tuple[str, ...]:
        return (f".{self.host}{self.path}**", f".*.{self.host}{self.path}**")


#: The rules that the production query applies.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
#: What the automaton itself judges where no rule fits: globs of hosts that are blocked.
BLOCKED_GLOBS = (".**spam-farm.**", ".**cheap-pills.**", ".**casino**", ".**/porn/**")


#: Characters of a batch, padded to its longest URL, that are held at once.
CELLS = 1 << 20


@dataclass(frozen=True)
class Automaton:
    """Shift-And masks of many globs. States are the characters of the globs; a wildcard is a loop on
    the state before it, so it costs no state of its own."""

    globs: tuple[str, ...]
    words: int = field(init=False)

    def __post_init__(self) -> None:
        states, loops_host, loops_any, starts, ends = [], [], [], [], []
        for g in self.globs:
            starts.append(len(states))
            states.append(None)  # the state before the first character
            i = 0
            while i < len(g):
                if g[i] == "*":
                    wide = g[i : i + 2] == "**"
                    (loops_any if wide else loops_host).append(len(states) - 1)
                    i += 1 + wide
                else:
                    states.append(g[i])
                    i += 1
            ends.append(len(states) - 1)
        object.__setattr__(self, "words", -(-len(states) // 64))
        at = lambda where: self._mask(where)
        table = {c: at([k for k, s in enumerate(states) if s == c]) for c in {s for s in states if s}}
        for name, value in (("table", table), ("host", at(loops_host)), ("any", at(loops_any)), ("start", at(starts)), ("ends", ends)):
            object.__setattr__(self, name, value)

    def _mask(self, where: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for k in where:
            out[k >> 6] |= np.uint64(1 << (k & 63))
        return out

    def match(self, urls: list[str]) -> np.ndarray:
        """(URLs, globs) of booleans: which globs match each whole URL."""
        n, zero = len(urls), np.zeros(self.words, np.uint64)
        if n > 1 and n * max(map(len, urls)) > CELLS:  # a long URL must not widen the matrix of many
            order = sorted(range(n), key=lambda k: len(urls[k]))
            out = np.empty((n, len(self.globs)), bool)
            for part in (order[: n // 2], order[n // 2 :]):
                out[part] = self.match([urls[k] for k in part])
            return out
        d = np.tile(self.start, (n, 1))
        symbols = {c: k + 2 for k, c in enumerate(self.table)}
        step = np.array([zero, zero, *self.table.values()])
        slash = symbols.get("/", 1)
        size = np.fromiter(map(len, urls), np.int64, n)
        coded = np.zeros((n, int(size.max(initial=0))), np.int64)
        for k, u in enumerate(urls):
            coded[k, : len(u)] = [symbols.get(c, 1) for c in u]
        is_slash = coded == slash if "/" in symbols else np.array([[c == "/" for c in u.ljust(coded.shape[1])] for u in urls], bool).reshape(coded.shape)
        for j in range(coded.shape[1]):
            live = np.flatnonzero(size > j)
            old, c = d[live], coded[live, j]
            moved = old << np.uint64(1)
            moved[:, 1:] |= old[:, :-1] >> np.uint64(63)
            keep = np.where(is_slash[live, j][:, None], self.any, self.any | self.host)
            d[live] = (moved & step[c]) | (old & keep)
        return np.array([(d[:, e >> 6] >> np.uint64(e & 63)) & np.uint64(1) for e in self.ends], bool).T.reshape(n, len(self.globs))


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((k for k in map(tail.find, "?#") if k >= 0), default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), tail[:stop]


@lru_cache(maxsize=8)
def _automaton(rules: tuple[Rule, ...], blocked: tuple[str, ...]) -> Automaton:
    return Automaton(tuple(g for r in rules for g in r.globs) + blocked)


def judge(urls: list[str | None], rules: tuple[Rule, ...] = RULES, blocked: tuple[str, ...] = BLOCKED_GLOBS) -> list[tuple[str, str, str | None, str]]:
    """(host, path, rule, verdict) of each URL."""
    parts = [split_url(u) for u in urls]
    hits = _automaton(rules, blocked).match(["." + h + p for h, p in parts])
    by_length = sorted(range(len(rules)), key=lambda k: -len(rules[k].name))
    out = []
    for (host, path), hit in zip(parts, hits, strict=True):
        rule = next((rules[k] for k in by_length if hit[2 * k] or hit[2 * k + 1]), None)
        verdict = rule.verdict if rule else "block" if hit[2 * len(rules) :].any() else "allow"
        out.append((host, path, rule and rule.name, verdict))
    return out


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, blocked: tuple[str, ...] = BLOCKED_GLOBS, batch: int = 512) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict. One narrow pass; only the URL column is read."""
    tuned(pages.sparkSession)

    def run(batches):
        for b in batches:
            ids, urls = b.column(0), b.column(1).to_pylist()
            rows = [x for k in range(0, len(urls), batch) for x in judge(urls[k : k + batch], rules, blocked)]
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.string()) for c in cols)], names=["page_id", "host", "path", "rule", "verdict"])

    out = pages.select(key("page_id"), F.col("url").cast("string").alias("url")).mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
    return out.select(unkey("page_id"), "host", "path", "rule", "verdict")


ORACLE = """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT page_id, host, path, '.' || host AS d FROM p),
m AS (SELECT page_id, host, path, CASE
  WHEN ends_with(d, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN ends_with(d, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN ends_with(d, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN ends_with(d, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN ends_with(d, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule, d || path AS canon FROM r)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN contains(canon, 'spam-farm.') OR contains(canon, 'cheap-pills.') OR contains(canon, 'casino') OR contains(canon, '/porn/') THEN 'block'
  ELSE 'allow' END AS verdict FROM m
"""
