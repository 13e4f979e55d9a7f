"""Packing of tokenised documents by shortest-pack-first over the length histogram."""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm import bytehash as H
from parcelmart.llm.staging import staged

_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_encoders: dict[str, tuple] = {}
#: Distinct stretches a worker remembers between batches, to save time only; beyond that many it begins anew.
KEPT = 1_500_000
_known: dict[str, tuple] = {}


def _encoder(path: str) -> tuple:
    """The tokenizer of the rank file at `path`, the bytes per id, and the added tokens; kept for the life of a worker.

    Added tokens are those of the `tokenizers` file of the same name beside it, where there is one.
    """
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            sizes[i] = len(token)
        _encoders[path] = tiktoken.Encoding("packing", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes, _added(path)
    return _encoders[path]


def _added(path: str) -> dict[bytes, int]:
    beside = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(beside):
        return {}
    with open(beside, "rb") as f:
        tokens = json.load(f)["added_tokens"]
    if other := [t["content"] for t in tokens if t["single_word"] or t["lstrip"] or t["rstrip"]]:
        raise ValueError(f"added tokens that take or ask for what stands beside them: {other}")
    return {t["content"].encode(): t["id"] for t in tokens}


def _quoted(data: np.ndarray, at: np.ndarray, added: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the added tokens in the texts, from the left, the longest of those that begin at one place."""
    text, found = data.tobytes(), []
    if any(token in text for token in added):
        every = re.compile(b"|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)))
        found = [(m.start() + a, m.end() + a) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True) for m in every.finditer(text[a:b])]
    x = np.array(found, np.int64).reshape(-1, 2)
    return x[:, 0], x[:, 1]


def encode(data: np.ndarray, at: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and where each begins.

    A token never spans the place before a single space between two plain characters. Texts are cut there, each distinct
    stretch is tokenised once, and its ids are put wherever the stretch occurs. An added token is a stretch of its own.
    """
    encoder, sizes, added = _encoder(path)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    before[1:], after[:-1] = data[:-1], data[1:]
    two = np.zeros(n, np.uint8)
    two[2:] = data[:-2]
    # white space beyond ASCII begins with 0xC2, 0xE1, 0xE2 or 0xE3: no cut beside bytes that may belong to it
    plain_before = (before > 32) & (before < 127) | (before > 127) & (two == 0xC3)
    plain_after = (after > 32) & (after < 127) | (after == 0xC3)
    cut = (data == 32) & plain_before & plain_after
    heads = at[:-1][np.diff(at) > 0]
    cut[heads] = True
    for edge in _quoted(data, at, added):
        cut[edge[edge < n]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n)
    p = H.prefix(data, H.BYTE)
    mark = H.mix((p[end] - p[start]) * H.powers(n + 1)[1][start]) ^ (end - start).astype(np.uint64)
    mark, first, which = np.unique(mark, return_index=True, return_inverse=True)
    known = _known.get(path)
    if known is None or len(known[0]) > KEPT:
        known = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    k = np.searchsorted(known[0], mark)
    fresh = np.ones(len(mark), bool)
    inside = k < len(known[0])
    fresh[inside] = known[0][k[inside]] != mark[inside]
    if fresh.any():
        new = np.flatnonzero(fresh)
        lo = start[first[new]]
        spaced = (data[lo] == 32) & plain_after[lo] & (end[first[new]] - lo > 1)
        new = np.concatenate([new[spaced], new[~spaced]])
        lo, size = start[first[new]], (end - start)[first[new]]
        stop = np.cumsum(size)
        text = data[np.repeat(lo - (stop - size), size) + np.arange(stop[-1])].tobytes()
        m = int(spaced.sum())
        ids, counts = [], []
        for x in range(0, m, 20_000):
            y = min(m, x + 20_000)
            got = encoder.encode_to_numpy(text[stop[x] - size[x] : stop[y - 1]].decode())
            upto = np.searchsorted(np.cumsum(sizes[got]), stop[x:y] - (stop[x] - size[x])) + 1
            ids.append(got)
            counts.append(np.diff(upto, prepend=0))
        for x in range(m, len(new)):
            stretch = text[stop[x] - size[x] : stop[x]]
            own = [added[stretch]] if stretch in added else encoder.encode_ordinary(stretch.decode())
            ids.append(np.array(own, np.uint32))
            counts.append(np.array([len(ids[-1])]))
        count = np.concatenate(counts).astype(np.int64)
        begin = len(known[3]) + np.cumsum(count) - count
        where = np.searchsorted(known[0], mark[new])
        order = np.argsort(mark[new])
        put = [np.insert(old, where[order], x[order]) for old, x in zip(known[:3], (mark[new], begin, count), strict=True)]
        known = (*put, np.concatenate([known[3], *ids]).astype(np.uint32))
        k = np.searchsorted(known[0], mark)
    _known[path] = known
    n_ids = known[2][k][which]
    upto = np.cumsum(n_ids)
    out = known[3][np.repeat(known[1][k][which] - (upto - n_ids), n_ids) + np.arange(upto[-1])]
    return out, np.concatenate([[0], upto])[np.searchsorted(start, at)]


def _cut(batches: Iterator[pa.RecordBatch], path: str, size: int, stop: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in H.pieces(whole, "text"):
            ids, at = encode(*H.flat(batch.column("text")), path)
            row, where, length, crc, total = [], [], [], [], []
            for r in range(batch.num_rows):
                own = np.append(ids[at[r] : at[r + 1]], np.uint32(stop)).astype("<u4")
                for s in range(0, len(own), size):
                    piece = own[s : s + size]
                    row.append(r)
                    where.append(s)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(own))
            ints = [pa.array(x, pa.int64()) for x in (where, length, crc, total)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), *ints], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )


def cut(docs: DataFrame, tokenizer: str, size: int = 1024, stop: int = 0) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids and the stop id, in pieces of `size` and a rest."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select("doc_id", "text").mapInArrow(lambda it: _cut(it, tokenizer, size, stop), schema)


def shortest_first(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths, count): lengths from the longest, each into the shortest pack that has room for it.

    Packs of equal filling and pattern are one group, so the work is a few thousand steps whatever the counts are: a step
    uses up a group or a length, and at most one group per length is added in each way.
    """
    groups: list[dict[tuple[int, ...], int]] = [{} for _ in range(size + 1)]  # by room left
    for length in sorted(histogram, reverse=True):
        left, placed = histogram[length], []
        for room in range(size, length - 1, -1):
            while left and groups[room]:
                pattern, count = groups[room].popitem()
                used = min(left, count)
                left -= used
                placed.append((room - length, (*pattern, length), used))
                if used < count:
                    groups[room][pattern] = count - used
        if left:
            fit = size // length
            if left // fit:
                placed.append((size - fit * length, (length,) * fit, left // fit))
            if left % fit:
                placed.append((size - left % fit * length, (length,) * (left % fit), 1))
        for room, pattern, count in placed:
            groups[room][pattern] = groups[room].get(pattern, 0) + count
    return [(p, c) for g in groups for p, c in g.items()]


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank, first sequence and offset of each of its slots, by rank."""
    taken: dict[int, int] = {}
    slots: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            slots.setdefault(length, []).append((taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + count
            offset += length
        sequence += count
    return {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in slots.items()}


def _seated(batches: Iterator[pa.RecordBatch], slots: dict[int, tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            here = np.flatnonzero(length == n)
            first, base, place = slots[int(n)]
            k = np.searchsorted(first, rank[here], side="right") - 1
            sequence[here] = base[k] + rank[here] - first[k]
            offset[here] = place[k]
        kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(sequence), pa.array(offset)],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, stop: int = 0, bucket: int = 50_000) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null or empty text is the stop id alone. Every row of docs is a document, also where rows repeat or doc_id is null; an
    empty table gives no rows. The driver sees the histogram (at most `size` numbers) and its patterns (at most two groups
    per length), nothing per document. Ranks within a length are counted per bucket of about `bucket` pieces.
    """
    pieces = staged(cut(docs, tokenizer, size, stop), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots = _slots(shortest_first(histogram, size))
    buckets = max(1, sum(histogram.values()) // bucket)
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    held = rows.groupBy("length", "bucket").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")
    held = held.select("length", "bucket", before.alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    rows = rows.join(staged(held, "held"), ["length", "bucket"])
    rows = rows.withColumn("rank", F.row_number().over(order) - 1 + F.col("before"))
    shared = pieces.sparkSession.sparkContext.broadcast(slots)
    schema = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.select(*pieces.columns, "rank").mapInArrow(
        lambda it: _seated(it, shared.value), schema.format(docs.schema["doc_id"].dataType.simpleString())
    )
