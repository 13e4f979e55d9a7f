"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

A window as long as an item can only resemble it if it holds at least one of the item's five-word shingles. So windows are
laid at every word around each such place and nowhere else, which loses no window of any similarity above zero. Each window
gets a 64-bit SimHash of its shingles, weighted by how often they occur. Fingerprints are searched in four blocks of 16
bits: one within `radius` of an item's agrees with it in some block up to radius // 4 bits, and the index lists every block
value within that distance, so all fingerprints within the radius are found. Candidates are compared exactly by the
weighted similarity (sum of the smaller counts over sum of the larger counts) of their shingles. At the default radius, a
window at the limit of 0.75 is expected 11 bits away with a deviation of 3, four deviations inside.

The items are broadcast in slices of at most `slice_items` items and `slice_bytes` of text, one pass over the documents per
slice; the number of slices follows from the benchmark's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm import bytehash as H

GATE_BITS = 22
_OCCURRENCE = np.uint64(0xA24BAED4963EE407)


def _simhash(values: np.ndarray, m: int) -> np.ndarray:
    """SimHash of every run of m shingle hashes, as one 64-bit word each."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    upto = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    return np.packbits((upto[m:] - upto[:-m]) * 2 > m, axis=1).view(np.uint64).ravel()


def _occurrences(rows: np.ndarray) -> np.ndarray:
    """Each row's hashes sorted, with equal ones told apart by a running number: multisets become sets."""
    rows = np.sort(rows, axis=1)
    n = np.zeros(rows.shape, np.uint64)
    for k in range(1, rows.shape[1]):
        n[:, k] = np.where(rows[:, k] == rows[:, k - 1], n[:, k - 1] + np.uint64(1), np.uint64(0))
    return H.mix(rows + n * _OCCURRENCE)


def _masks(within: int) -> np.ndarray:
    every = np.arange(1 << 16, dtype=np.uint32)
    return every[np.bitwise_count(every) <= within]


def index(ids: list, texts: list[str], width: int, radius: int) -> dict:
    """Items by length in words: fingerprints, sorted block values with their items, shingles; and all shingles."""
    data, at = H.flat(pa.array(texts, pa.string()))
    words = np.diff(H.word_hashes(data, at)[1])
    values, begin = H.shingles(data, at, width)
    masks = _masks(radius // 4)
    by: dict[int, dict] = {}
    for n in np.unique(words[words > 0]):
        own = np.flatnonzero(words == n)
        rows = np.stack([values[begin[i] : begin[i + 1]] for i in own])
        marks = np.array([_simhash(r, len(r))[0] for r in rows], np.uint64)
        keys, items = [], []
        for k in range(4):
            block = ((marks >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.uint32)
            keys.append(((block[:, None] ^ masks) | np.uint32(k << 16)).ravel())
            items.append(np.repeat(np.arange(len(own), dtype=np.int32), len(masks)))
        keys, items = np.concatenate(keys), np.concatenate(items)
        order = np.argsort(keys, kind="stable")
        by[int(n)] = {
            "ids": [ids[i] for i in own], "marks": marks, "keys": keys[order], "items": items[order],
            "shingles": np.unique(rows), "sets": [np.sort(x) for x in _occurrences(rows)],
        }
    every = np.unique(values)
    gate = np.zeros(1 << GATE_BITS, bool)
    gate[every & np.uint64((1 << GATE_BITS) - 1)] = True
    return {"by": by, "every": every, "gate": gate, "width": width, "radius": radius}


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    k = np.minimum(np.searchsorted(of, values), len(of) - 1)
    return of[k] == values


def search(batch: pa.RecordBatch, found: dict, percent: int) -> list[tuple[int, object, int, int, float]]:
    """(row, item, first word, words, similarity) of each text's best window per item, at `percent` or more."""
    data, at = H.flat(batch.column("text"))
    words, first = H.word_hashes(data, at)
    width, total = found["width"], len(words)
    n_words = np.diff(first)
    best: dict[tuple[int, object], tuple] = {}
    if not total or not len(found["every"]):
        return []
    full = np.zeros(total, np.uint64)
    if total >= width:
        for k in range(width):
            full[: total - width + 1] += words[k : total - width + 1 + k] * H.PLACE[k]
    full = H.mix(full)
    row_of = np.repeat(np.arange(len(n_words)), n_words)
    left = first[1:][row_of] - np.arange(total)  # words from here to the end of the text
    valid = left >= width
    mask = np.uint64((1 << GATE_BITS) - 1)
    near = np.flatnonzero(valid & found["gate"][full & mask])
    near = near[_member(full[near], found["every"])]
    for n, items in found["by"].items():
        if n < width:  # the item is one short run: look for just that run
            short = np.zeros(total, np.uint64)
            for k in range(width):
                short += np.append(words[k:], np.zeros(k, np.uint64))[:total] * H.PLACE[k] if k < n else H.PLACE[width + k]
            short = H.mix(short)
            hits = np.flatnonzero((left >= n) & _member(short, items["shingles"]))
            starts, per, m, rows = hits, n, 1, short
        else:
            hits = near[_member(full[near], items["shingles"])]
            per = n
            m, rows = n - width + 1, full
            if not len(hits):
                continue
            lo = np.maximum(hits - (m - 1), first[:-1][row_of[hits]])
            hi = np.minimum(hits, first[1:][row_of[hits]] - n)
            whole = n_words[row_of[hits]] < n  # a text shorter than the item is one window
            step = np.zeros(total + 1, np.int64)
            np.add.at(step, lo[~whole], 1)
            np.add.at(step, np.maximum(hi, lo - 1)[~whole] + 1, -1)
            starts = np.flatnonzero(np.cumsum(step[:-1]) > 0)
            for r in np.unique(row_of[hits[whole]]):
                _compare(found, items, full[first[r] : first[r + 1] - width + 1], np.zeros(1, np.int64), int(n_words[r]) - width + 1,
                         int(first[r]), np.array([r]), first[r : r + 1], int(n_words[r]), percent, best)
        if len(starts):
            runs = np.flatnonzero(np.diff(starts, prepend=starts[0] - 2) != 1)
            for a, b in zip(runs, np.append(runs[1:], len(starts)), strict=True):
                s = starts[a:b]
                _compare(found, items, rows[s[0] : s[-1] + m], s - s[0], m, int(s[0]), row_of[s], first[:-1][row_of[s]], per, percent, best)
    return [(r, item, at_, n, sim) for (r, item), (sim, at_, n) in sorted(best.items(), key=lambda x: (x[0][0], str(x[0][1])))]


def _compare(found, items, values, offsets, m, base, rows, heads, n, percent, best) -> None:
    marks = _simhash(np.ascontiguousarray(values), m)[offsets]
    pairs = []
    for k in range(4):
        key = ((marks >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.uint32) | np.uint32(k << 16)
        lo, hi = np.searchsorted(items["keys"], key), np.searchsorted(items["keys"], key, side="right")
        count = hi - lo
        window = np.repeat(np.arange(len(key)), count)
        at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        pairs.append(window * len(items["marks"]) + items["items"][at])
    pairs = np.unique(np.concatenate(pairs))
    window, item = pairs // len(items["marks"]), pairs % len(items["marks"])
    close = np.bitwise_count(marks[window] ^ items["marks"][item]) <= found["radius"]
    window, item = window[close], item[close]
    for i in np.unique(item):
        own = window[item == i]
        sets = _occurrences(values[offsets[own][:, None] + np.arange(m)])
        target = items["sets"][i]
        both = _member(sets, target).sum(axis=1)
        union = m + len(target) - both
        for j in np.flatnonzero(100 * both >= percent * union):
            w = own[j]
            row, start = int(rows[w]), int(base + offsets[w] - heads[w])
            entry = (float(both[j] / union[j]), start, n)
            old = best.get((row, items["ids"][i]))
            if old is None or (-entry[0], entry[1]) < (-old[0], old[1]):
                best[row, items["ids"][i]] = entry


def _slices(benchmark: DataFrame, width: int, radius: int, slice_items: int, slice_bytes: int) -> list[dict]:
    """An index per slice of the benchmark; each slice is bounded, and is collected on its own."""
    items = benchmark.select("item_id", "text").where("text is not null").distinct()
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    slices = max(1, -(-n // slice_items), -(-size // slice_bytes))
    out = []
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k).orderBy("item_id", "text").toArrow()
        out.append(index(part["item_id"].to_pylist(), part["text"].to_pylist(), width, radius))
    return out


def _over(docs: DataFrame, benchmark: DataFrame, one: Callable, width, radius, slice_items, slice_bytes) -> list[Callable]:
    sc = docs.sparkSession.sparkContext
    steps = []
    for found in _slices(benchmark, width, radius, slice_items, slice_bytes):
        shared = sc.broadcast(found)

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in H.pieces(whole, "text"):
                    yield one(batch, shared.value)

        steps.append(step)
    return steps


def leaks(
    docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 75, radius: int = 23, slice_items: int = 500, slice_bytes: int = 4 << 20
) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words): the best window of each text per benchmark item it holds.

    A text shorter than an item is one window. An item of fewer words than a shingle must occur word for word. Null, empty
    and wordless texts and items hold nothing. Rows that repeat are searched each; null ids pass through. Ties go to the
    earliest window. Of rows with one item_id and different texts the best counts.
    """
    item = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {item}, similarity double, start_word long, n_words long"

    def one(batch: pa.RecordBatch, found: dict) -> pa.RecordBatch:
        rows = search(batch, found, percent)
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        ids = batch.column("doc_id").take(pa.array(list(cols[0]), pa.int64()))
        names = ["doc_id", "item_id", "similarity", "start_word", "n_words"]
        kinds = [kind, pa.float64(), pa.int64(), pa.int64()]
        rest = [pa.array(list(c), t) for c, t in zip((cols[1], cols[4], cols[2], cols[3]), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([ids, *rest], names)

    kind = pa.int64() if item == "bigint" else pa.int32() if item == "int" else pa.string()
    texts = docs.select("doc_id", "text")
    steps = _over(docs, benchmark, one, width, radius, slice_items, slice_bytes)
    return reduce(DataFrame.unionByName, [texts.mapInArrow(s, schema) for s in steps])


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 75, radius: int = 23, slice_items: int = 500, slice_bytes: int = 4 << 20
) -> DataFrame:
    """docs without the rows that hold a benchmark item; all columns pass through, no shuffle."""

    def one(batch: pa.RecordBatch, found: dict) -> pa.RecordBatch:
        clean = np.ones(batch.num_rows, bool)
        clean[[r[0] for r in search(batch, found, percent)]] = False
        return batch if clean.all() else pc.filter(batch, pa.array(clean))

    for step in _over(docs, benchmark, one, width, radius, slice_items, slice_bytes):
        docs = docs.mapInArrow(step, docs.schema)
    return docs
