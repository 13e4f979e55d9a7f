"""Counterfactual-regularised toxicity classifier.

Features are words and word beginnings, hashed. Documents of a bounded sample of labelled rows count them per label, the
most telling enter a logistic regression. Every sampled text that names a group is also read with the name swapped for
another of its kind, and the squared change of the score is a penalty of the fit, so that the mention itself tells nothing.
Scores then come from a pass over all documents with the few thousand weights.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm import bytehash as H
from parcelmart.llm.staging import staged

BITS = 20
# Names of groups, swapped for one another within a row.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "hispanic"),
    ("immigrant", "refugee", "foreigner", "native", "citizen"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("disabled", "blind", "deaf", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
    ("muslime", "christen", "juden"), ("musulmans", "chrétiens", "juifs"), ("musulmanes", "cristianos", "judíos"),
)
_NEXT = {t.encode(): row[(i + 1) % len(row)].encode() for row in IDENTITY for i, t in enumerate(row)}
_TERM = re.compile(rb"(?<![a-z\x80-\xff])(" + b"|".join(sorted(_NEXT, key=len, reverse=True)) + rb")(?![a-z\x80-\xff])")
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = True
_LETTER[128:] = True


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word and of its beginnings of 3 to 9 bytes; A-Z in lower case, words are runs of letters."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.append(False, letter[:-1]) & ~edge[:-1]
    after = np.append(letter[1:], False) & ~edge[1:]
    start, end = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~after) + 1
    p, inverse = H.prefix(data, H.LOWER_BYTE), H.powers(len(data) + 1)[1]
    row = np.searchsorted(at, start, side="right") - 1
    rows, out = [row], [H.mix((p[end] - p[start]) * inverse[start] + H.PLACE[0])]
    for k in range(3, 10):
        long = end - start >= k
        s = start[long]
        rows.append(row[long])
        out.append(H.mix((p[s + k] - p[s]) * inverse[s] + H.PLACE[1]))
    return np.concatenate(rows), (np.concatenate(out) >> np.uint64(64 - BITS)).astype(np.int64)


def _per_row(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, feature) and how often."""
    row, feature = features(data, at)
    both, n = np.unique(row << BITS | feature, return_counts=True)
    return both >> BITS, both & ((1 << BITS) - 1), n


def _label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 1 << BITS), np.int64)
    for whole in batches:
        for batch in H.pieces(whole, "text"):
            toxic = np.asarray(batch.column("toxic"))
            row, feature, _ = _per_row(*H.flat(batch.column("text")))
            for k in (0, 1):
                total[k] += np.bincount(feature[toxic[row] == k], minlength=1 << BITS)
    seen = np.flatnonzero(total.sum(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[0, seen]), pa.array(total[1, seen])], ["f", "n0", "n1"])


def _swapped(text: bytes) -> bytes:
    low = text.lower()
    return _TERM.sub(lambda m: _NEXT[m[0]], low) if _TERM.search(low) else b""


def _chosen(batches: Iterator[pa.RecordBatch], place: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per sampled row its label, the places and counts of chosen features, and those of its swapped text if it has one."""
    for whole in batches:
        for batch in H.pieces(whole, "text"):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            swaps = [_swapped(t) for t in texts]
            out = [batch.column("toxic"), pa.array([bool(s) for s in swaps])]
            for version in (texts, swaps):
                row, f, n = _per_row(*H.flat(pa.array(version, pa.binary())))
                keep = place[f] >= 0
                row, f, n = row[keep], place[f][keep], n[keep]
                cut = pa.array(np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32))
                out += [pa.ListArray.from_arrays(cut, pa.array(f.astype(np.int32))), pa.ListArray.from_arrays(cut, pa.array(_worth(n)))]
            yield pa.RecordBatch.from_arrays(out, ["toxic", "swapped", "f", "x", "g", "y"])


def _worth(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(n + 1.0), 2.0).astype(np.float32)


def fit(rows: pa.Table, size: int, ridge: float = 1e-4, fair: float = 1.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of the logistic regression with the penalty on swapped rows; Adam over all rows."""

    def sparse(f: str, x: str):
        lists = rows[f].combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
        n = np.asarray(pa.compute.list_value_length(lists), np.int64)
        return np.repeat(np.arange(len(n)), n), np.asarray(lists.flatten(), np.int64), np.asarray(rows[x].combine_chunks().flatten(), np.float64)

    y = np.asarray(rows["toxic"], np.float64)
    total, swapped = len(y), np.asarray(rows["swapped"], bool)
    (r, f, x), (r2, f2, x2) = sparse("f", "x"), sparse("g", "y")
    w, b = np.zeros(size + 1), float(np.log((y.sum() + 1) / (total - y.sum() + 1)))
    keep = swapped[r]
    dr, df, dx = np.concatenate([r[keep], r2]), np.concatenate([f[keep], f2]), np.concatenate([x[keep], -x2])
    w[size] = b
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = np.bincount(r, x * w[f], minlength=total) + w[size]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.append(np.bincount(f, x * error[r], minlength=size) / total + ridge * w[:size], error.mean())
        if len(dr):
            change = np.bincount(dr, dx * w[df], minlength=total)
            grad[:size] += fair * np.bincount(df, dx * change[dr], minlength=size) / max(1, swapped.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:size], float(w[size])


def _scored(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        weight, bias = shared.value
        for batch in H.pieces(whole, "text"):
            row, f, n = _per_row(*H.flat(batch.column("text")))
            z = np.bincount(row, weight[f] * _worth(n), minlength=batch.num_rows) + bias
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])


def train(docs: DataFrame, labels: DataFrame, sample: int = 30_000, chosen: int = 8_192, least: int = 4) -> tuple[np.ndarray, float]:
    """Weights over all 2 ** 20 features and the intercept.

    labels: doc_id, toxic (0 or 1) of the rows to learn from; at most about `sample` of them, picked by a hash of doc_id, are
    used and broadcast. `chosen` features at most enter, each in `least` texts. Null ids and labels are left out. Without
    labelled rows every score is 0.5.
    """
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    rows = staged(rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labelled")
    n = rows.count()
    if n > sample:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(n)) < sample)
    texts = staged(docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select("text", "toxic"), "labelled_texts")
    size = {r[0]: r[1] for r in texts.groupBy("toxic").count().collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    weight = np.zeros(1 << BITS)
    if not n0 and not n1:
        return weight, 0.0
    counts = texts.mapInArrow(_label_counts, "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    p1, p0 = (F.col("n1") + 0.5) / (n1 + 1), (F.col("n0") + 0.5) / (n0 + 1)
    telling = F.abs(p1 - p0) / F.sqrt(p0 * (1 - p0 + 1e-9) / (n0 + 1) + p1 * (1 - p1 + 1e-9) / (n1 + 1))
    best = counts.where(F.col("n0") + F.col("n1") >= least).orderBy(telling.desc(), "f").limit(chosen).select("f").toArrow()
    ids = np.asarray(best["f"], np.int64)
    place = np.full(1 << BITS, -1, np.int64)
    place[ids] = np.arange(len(ids))
    shared = docs.sparkSession.sparkContext.broadcast(place)
    schema = "toxic int, swapped boolean, f array<int>, x array<float>, g array<int>, y array<float>"
    w, bias = fit(texts.mapInArrow(lambda it: _chosen(it, shared.value), schema).toArrow(), len(ids))
    weight[ids] = w
    return weight, bias


def score(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of docs; learns from rows with crc32(doc_id as text) % 5 != 0 only.

    Null and empty texts get the intercept's score. Rows that repeat are scored each; a null doc_id is scored, never learnt.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels.where(~held), **how))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(lambda it: _scored(it, model), f"doc_id {kind}, score double")
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def held_out(doc_id) -> bool:
    """Whether rows of this id are never learnt from."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
