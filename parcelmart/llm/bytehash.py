"""Hashes of words, shingles and byte strings of many texts at once, on the flat bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
_RNG = np.random.default_rng(20240117)
BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
LOWER_BYTE = BYTE[_LOWER]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
PLACE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_power = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
KEPT = 1 << 22


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[0] = 1
    return np.multiply.accumulate(x)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64; a worker remembers `KEPT` of them at most."""
    bases = BASE, pow(BASE, -1, 1 << 64)
    if n > KEPT:
        return _powers(bases[0], n), _powers(bases[1], n)
    if len(_power[0]) < n:
        for k, base in enumerate(bases):
            _power[k] = _powers(base, n)
    return _power[0][:n], _power[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins; null is empty."""
    a = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    at = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = a.buffers()[2] if len(a) else None
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most `limit` bytes of text, or one longer row: bounds what numpy holds."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def prefix(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Running sums of which any stretch's hash is a difference: (p[end] - p[start]) * inverse power of start."""
    p = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers(len(data) + 1)[0][: len(data)], out=p[1:])
    return p


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (no space, no 0x09-0x0D), and the index of each text's first word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    space = SPACE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = space[:-1]
    edge[at] = True
    start = np.flatnonzero(~space & edge[:-1])
    edge[1:-1] = space[1:]
    edge[at] = True
    end = np.flatnonzero(~space & edge[1:]) + 1
    return start, end, np.searchsorted(start, at)


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word with A-Z in lower case, and the index of each text's first word."""
    start, end, first = word_bounds(data, at)
    p = prefix(data, LOWER_BYTE)
    return mix((p[end] - p[start]) * powers(len(data) + 1)[1][start]), first


def shingles(data: np.ndarray, at: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """A hash per run of `width` words, and the index of each text's first; a shorter text is one run, no words none."""
    words, first = word_hashes(data, at)
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    head = np.repeat(first[:-1] - begin[:-1], count) + np.arange(begin[-1])
    total = np.zeros(begin[-1], np.uint64)
    room = np.repeat(first[1:], count) - head
    for k in range(width):
        total += np.where(room > k, padded[head + k] * PLACE[k], PLACE[width + k])
    return mix(total), begin


def distinct(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each stretch, sorted, and where each stretch begins."""
    parts = [np.unique(values[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    return (
        np.concatenate(parts) if parts else np.zeros(0, np.uint64),
        np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64),
    )


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows sorted by `key` in tables that never split a group; holds one batch and one group."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        keys = t.column(key).to_numpy()
        last = int(np.flatnonzero(keys == keys[-1])[0])
        if last:
            yield t.slice(0, last)
        rest = t.slice(last)
    if rest is not None:
        yield rest
