"""Runs of equal keys in sorted Arrow streams, cut so that no run is held whole beyond a bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def column(batch: pa.RecordBatch, k: int) -> np.ndarray:
    return batch.column(k).to_numpy(zero_copy_only=False)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int, bound: int) -> Iterator[tuple[pa.Table, bool]]:
    """Regroup a stream that is sorted by its first ``keys`` integer columns: yields (rows, whole). If
    whole, rows holds complete runs only; else it is a piece of one run of more than ``bound`` rows,
    and all pieces of that run come one after the other."""
    held: list[pa.RecordBatch] = []
    rows, broken = 0, None  # broken: the key of a run given out in pieces
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < bound:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        cols = [t.column(k).to_numpy() for k in range(keys)]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        if broken is not None:
            end = _end(cols, broken)
            if end:
                yield t.slice(0, end), False
            t, cols = t.slice(end), [c[end:] for c in cols]
            change = change[change > end] - end
            if len(t):
                broken = None
        last = int(change[-1]) if len(change) else 0
        if last:
            yield t.slice(0, last), True
        if len(t) - last > bound:
            broken = tuple(c[-1] for c in cols)
            yield t.slice(last), False
            held, rows = [], 0
        else:
            held, rows = t.slice(last).combine_chunks().to_batches(), len(t) - last
    if held and rows:
        t = pa.Table.from_batches(held).combine_chunks()
        if broken is not None:
            end = _end([t.column(k).to_numpy() for k in range(keys)], broken)
            if end:
                yield t.slice(0, end), False
            t = t.slice(end)
        if len(t):
            yield t, True


def _end(cols: list[np.ndarray], key: tuple) -> int:
    """Rows at the start that have this key."""
    other = np.flatnonzero(np.any([c != k for c, k in zip(cols, key, strict=True)], axis=0))
    return int(other[0]) if len(other) else len(cols[0])


def bounds(cols: list[np.ndarray]) -> np.ndarray:
    """Starts of the runs, and the number of rows at the end."""
    n = len(cols[0])
    if not n:
        return np.zeros(1, np.int64)
    change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
    return np.concatenate([[0], change, [n]]).astype(np.int64)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
        live = label[a] != label[b]
        a, b = a[live], b[live]
    return label
