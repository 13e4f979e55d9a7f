"""Removal of byte strings that repeat across documents, by longest previous factors.

A byte goes if a string of `length` bytes over it also starts in a document with a smaller doc_id. In suffix order, all
suffixes that share a string of that length stand together, and a suffix has a previous factor as long exactly if a smaller
document lies before or after it in its stretch: if it is not of the smallest document there.

The order over all suffixes of a corpus is never needed. Each string has an anchor, the smallest hash among its stretches of
24 bytes; equal strings have equal anchors, so suffixes are ordered bucket by bucket of anchors. Neighbouring strings with
one anchor are one run, kept as one stretch of text.
  1. Anchors of all documents, once per piece of input, meet in buckets; those of two or more documents go back.
  2. Runs with such an anchor send their text, once, and all places the smallest document has it at. Equal runs keep the
     smallest document only, before the shuffle and after it: the others are removed whole. So neither a common passage nor a group of copies meets in one task.
  3. What is left in a bucket is put in suffix order, and previous factors are removed. Runs of an anchor with more than
     `hot` runs are dealt out string by string instead, by all documents alike, so that no anchor has to fit into one task.
  4. The spans go back to their documents, by groups of documents.
Documents are shuffled once, by doc_id and text; both joins with them use that one exchange. Rows are told apart by doc_id
and, where one has several texts, a 64-bit hash of the text (`alt`, else 0). Runs count as equal by 64-bit hashes of all their
bytes and of the anchor, strings of hot anchors by 128 bits; in suffix order the bytes themselves are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm import bytehash as H
from parcelmart.llm.staging import staged

ANCHOR = 24
LENGTH = 50
_SENT = "bucket int, doc_id long, alt long, own binary, keys binary, rows binary, ids binary, at binary, times binary, sizes binary, text binary"
_COLUMNS = [x.split()[0] for x in _SENT.split(", ")]
_U64 = np.uint64
_HOT = _U64(1 << 63)  # set in the code of an anchor with many runs; no bucket is as large
_OTHER = np.random.default_rng(20240118).integers(1, 1 << 63, 256, dtype=np.uint64) * _U64(2) + _U64(1)


def _runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, text row, first and last + 1 start of every run of strings with one anchor."""
    n = len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.view(_U64), none, none, none
    p = H.prefix(data, H.BYTE)
    low = H.mix((p[ANCHOR:] - p[:-ANCHOR]) * H.powers(len(data) + 1)[1][: len(data) - ANCHOR + 1])
    width, have = LENGTH - ANCHOR + 1, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    valid = np.zeros(len(data) + 1, np.int32)
    size = np.diff(at)
    long = size >= LENGTH
    np.add.at(valid, at[:-1][long], 1)
    np.add.at(valid, at[1:][long] - LENGTH + 1, -1)
    ok = np.cumsum(valid)[:n] > 0
    fresh = ok.copy()
    fresh[1:] &= (low[1:] != low[:-1]) | ~ok[:-1]
    stop = ok.copy()
    stop[:-1] &= (low[1:] != low[:-1]) | ~ok[1:]
    start, end = np.flatnonzero(fresh), np.flatnonzero(stop) + 1
    return low[start], np.searchsorted(at, start, side="right") - 1, start, end


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    upto = np.cumsum(size)
    return data[np.repeat(start - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)]


def _row(**x) -> tuple:
    return tuple(x.get(c) for c in _COLUMNS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 8
    cols = list(zip(*rows, strict=True)) or [[]] * 11
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], _COLUMNS)


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Whether any key differs from the one before."""
    head = np.zeros(len(keys[0]), bool)
    for key in keys:
        head[1:] |= key[1:] != key[:-1]
    return head


def _split(*keys: np.ndarray) -> Iterator[tuple]:
    """Values and place of each stretch of equal values."""
    cut = np.flatnonzero(_changes(*keys))
    for a, b in zip(np.append(0, cut), np.append(cut, len(keys[0])), strict=True):
        if b > a:
            yield *(int(k[a]) for k in keys), slice(a, b)


def _pack(x: np.ndarray, rising: bool = False) -> bytes:
    """Compressed; of rising numbers the steps."""
    x = np.diff(x, prepend=x.dtype.type(0)) if rising else x
    return zstandard.ZstdCompressor(level=3).compress(x.tobytes())


def _unpack(x: bytes, kind, rising: bool = False) -> np.ndarray:
    x = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)
    return np.cumsum(x, dtype=kind) if rising else x


def _least(doc: np.ndarray, alt: np.ndarray, *marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of things with equal marks: those of larger documents, all those of the smallest one by mark and text, and how many of each."""
    order = np.lexsort((alt, doc, *marks))
    head = _changes(*(mark[order] for mark in marks))
    head[:1] = True
    least = np.repeat(doc[order][head], np.diff(np.append(np.flatnonzero(head), len(order))))
    more = doc[order] > least
    held = order[~more]
    return order[more], held, np.bincount(np.cumsum(_changes(*(x[held] for x in (alt, *marks)))))


def _names(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The different (doc_id, alt) of a batch, ordered, and which of them every row is; alt is 0 if not there."""
    doc = np.asarray(batch.column("doc_id"), np.int64)
    alt = np.asarray(batch.column("alt"), np.int64) if "alt" in batch.schema.names else np.zeros_like(doc)
    pairs = np.stack([doc, alt], 1)
    names, who = np.unique(pairs, axis=0, return_inverse=True)
    return names, who.ravel()


def _pack_names(doc: np.ndarray, alt: np.ndarray) -> bytes:
    return _pack(np.concatenate([np.diff(doc, prepend=np.int64(0)), alt]))


def _unpack_names(x: bytes) -> np.ndarray:
    doc, alt = _unpack(x, np.int64).reshape(2, -1)
    return np.stack([np.cumsum(doc, dtype=np.int64), alt])


def _named(names: np.ndarray, who: np.ndarray) -> dict[str, bytes]:
    """The names that are meant, and which of these each is."""
    some, which = np.unique(who, return_inverse=True)
    return {"ids": _pack_names(*names[some].T), "rows": _pack(which.astype(np.uint32))}


def _owners(row: dict) -> np.ndarray:
    return _unpack_names(row["ids"])[:, _unpack(row["rows"], np.uint32)]


def _anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in H.pieces(whole, "text", 4 << 20):
            anchor, row, _, _ = _runs(*H.flat(batch.column("text")))
            names, who = _names(batch)
            who = who[row]
            order = np.lexsort((who, anchor))
            anchor, who = anchor[order], who[order]
            runs = np.diff(np.append(np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])), len(anchor))) if len(anchor) else who
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (who[1:] != who[:-1])
            anchor, who = anchor[new], who[new]
            head = np.ones(len(anchor), bool)
            head[1:] = anchor[1:] != anchor[:-1]
            n = np.diff(np.append(np.flatnonzero(head), len(anchor)))
            several = np.repeat(n > 1, n)
            bucket = ((anchor >> _U64(32)) % _U64(buckets)).astype(np.int64)
            code = (bucket.astype(_U64) << _U64(32)) | (anchor & _U64(0xFFFFFFFF))
            out = []
            by = np.flatnonzero(several)
            by = by[np.argsort(who[by], kind="stable")]
            told = code[by]
            for w, part in _split(who[by]):
                d, alt = names[w].tolist()
                out.append(_row(bucket=(d ^ alt) % buckets, doc_id=d, alt=alt, own=told[part].tobytes()))
            ask = np.flatnonzero(head)
            key = (anchor & _U64(0xFFFFFFFF)).astype(np.uint32)
            by = np.lexsort((key[ask], bucket[ask]))
            ask, runs = ask[by], runs[by].astype(np.uint32)
            for b, part in _split(bucket[ask]):
                k = ask[part]
                out.append(_row(bucket=b, keys=_pack(key[k], True), times=_pack(runs[part]), **_named(names, who[k])))
            yield _rows(out)


def _group(doc: np.ndarray, alt: np.ndarray, groups: int) -> np.ndarray:
    return (H.mix(doc.astype(_U64) ^ H.mix(alt.astype(_U64))) % _U64(groups)).astype(np.int64)


def _shared(table: pa.Table, groups: int, hot: int) -> pa.Table:
    """Of one bucket, the (document, anchor) pairs of anchors that several documents have; a row per group of documents.

    Pairs told by a piece itself lie in the bucket of their document: whether their anchor is hot is only known where it was
    counted, so the first row also names the hot anchors of this bucket.
    """
    docs, codes, keys, owners, runs = [], [], [], [], []
    for r in table.to_pylist():
        if r["own"] is not None:
            code = np.frombuffer(r["own"], _U64)
            docs.append(np.repeat([[r["doc_id"]], [r["alt"]]], len(code), axis=1))
            codes.append(code)
        else:
            keys.append(_unpack(r["keys"], np.uint32, True))
            owners.append(_owners(r))
            runs.append(_unpack(r["times"], np.uint32))
    bucket, many = _U64(table.column("bucket")[0].as_py()) << _U64(32), np.zeros(0, _U64)
    if keys:
        key, doc = np.concatenate(keys), np.concatenate(owners, axis=1)
        names, which, n = np.unique(key, return_inverse=True, return_counts=True)
        many = bucket | names[np.bincount(which, weights=np.concatenate(runs)) > hot].astype(_U64)
        here = n[which] > 1
        docs.append(doc[:, here])
        codes.append(bucket | key[here].astype(_U64))
    (doc, alt), code = np.concatenate(docs, axis=1), np.concatenate(codes)
    code = np.where(np.isin(code, many), code | _HOT, code)
    group = _group(doc, alt, groups)
    order = np.lexsort((code, alt, doc, group))
    doc, alt, code, group = doc[order], alt[order], code[order], group[order]
    rows = [(g, _pack_names(doc[part], alt[part]), _pack(code[part]), None) for g, part in _split(group)]
    if len(many):
        none = np.zeros(0, np.int64)
        g, docs, codes, _ = rows.pop(0) if rows else (0, _pack_names(none, none), _pack(none), None)
        rows.insert(0, (g, docs, codes, _pack(many)))
    cols = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = (pa.int32(), *[pa.binary()] * 3)
    return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["group", "docs", "codes", "hot"])


def _told(table: pa.Table) -> pa.Table:
    """Of one group of documents, per document its shared anchors."""
    doc, alt = np.concatenate([_unpack_names(x) for x in table.column("docs").to_pylist()], axis=1)
    code = np.concatenate([_unpack(x, _U64) for x in table.column("codes").to_pylist()])
    order = np.lexsort((code, alt, doc))
    doc, alt, code = doc[order], alt[order], code[order]
    return _by_name([(d, x, _pack(code[part], True)) for d, x, part in _split(doc, alt)], "codes")


def _by_name(rows: list[tuple], column: str) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [[]] * 3
    kinds = pa.int64(), pa.int64(), pa.binary()
    return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "alt", column])


def _texts(batches: Iterator[pa.RecordBatch], buckets: int, finer: int, many: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Runs with a shared anchor: the smallest document of each piece sends the text, the others are settled here.

    many: the hot anchors of all buckets, besides those marked in the codes themselves.
    """
    for whole in batches:
        for batch in H.pieces(whole, "text", 4 << 20):
            data, at = H.flat(batch.column("text"))
            anchor, row, start, end = _runs(data, at)
            code = ((anchor >> _U64(32)) % _U64(buckets) << _U64(32)) | (anchor & _U64(0xFFFFFFFF))
            told = [_unpack(x, _U64, True) if x else np.zeros(0, _U64) for x in batch.column("codes").to_pylist()]
            salt = H.mix(np.arange(batch.num_rows).astype(_U64) + _U64(1))
            wanted = np.concatenate([H.mix(t ^ s) for t, s in zip(told, salt, strict=True)] or [np.zeros(0, _U64)])
            marked = np.isin(H.mix(code ^ _HOT ^ salt[row]), wanted)
            pick = marked | np.isin(H.mix(code ^ salt[row]), wanted)
            hot = marked if many is None else marked | np.isin(code, many)
            anchor, row, start, end, hot = anchor[pick], row[pick], start[pick], end[pick], hot[pick]
            names, who = _names(batch)
            who, size = who[row], end - start + LENGTH - 1
            doc, alt = names[who].T
            p = H.prefix(data, H.BYTE)
            back = H.powers(len(data) + 1)[1]
            mark = H.mix((p[start + size] - p[start]) * back[start]) ^ H.mix(anchor) ^ size.astype(_U64)
            settled, held, times = _least(doc, alt, mark)
            # strings of hot anchors: each by itself
            dealt, held, times = held[hot[held]], held[~hot[held]], times[~hot[held[np.cumsum(times) - times]]]
            first = np.cumsum(times) - times
            pos = start - at[:-1][row]
            n = size[dealt] - LENGTH + 1
            which = np.repeat(dealt, n)
            skip = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            s, q = start[which] + skip, H.prefix(data, _OTHER) if len(dealt) else p
            h1, h2 = (H.mix((x[s + LENGTH] - x[s]) * back[s]) for x in (p, q))
            later, string, same = _least(doc[which], alt[which], h1, h2)
            out = []
            lo = np.concatenate([pos[settled], pos[which[later]] + skip[later]])
            hi = np.concatenate([pos[settled] + size[settled], pos[which[later]] + skip[later] + LENGTH])
            of = np.concatenate([settled, which[later]])
            *owner, lo, hi = _united(doc[of], alt[of], lo, hi)
            for d, x, part in _split(*owner):
                out.append(_row(bucket=(d ^ x) % finer, doc_id=d, alt=x, own=np.stack([lo[part], hi[part]], 1).tobytes()))
            bucket = (H.mix(anchor[held[first]]) % _U64(finer)).astype(np.int64)
            ask = np.argsort(bucket, kind="stable")
            for b, part in _split(bucket[ask]):
                one = ask[part]
                k = held[first[one]]
                key, sizes = (_pack(x[k].astype(np.uint32)) for x in (anchor & _U64(0xFFFFFFFF), size))
                where = _pack(pos[_gather(held, first[one], times[one])].astype(np.uint32))
                n = _pack(times[one].astype(np.uint32))
                text = _pack(_gather(data, start[k], size[k]))
                out.append(_row(bucket=b, keys=key, at=where, times=n, sizes=sizes, text=text, **_named(names, who[k])))
            first = np.cumsum(same) - same
            bucket = (h1[string[first]] % _U64(finer)).astype(np.int64)
            ask = np.argsort(bucket, kind="stable")
            for b, part in _split(bucket[ask]):
                one = ask[part]
                k = string[first[one]]
                every = _gather(string, first[one], same[one])
                where, n = (_pack(x.astype(np.uint32)) for x in (pos[which[every]] + skip[every], same[one]))
                out.append(_row(bucket=b, keys=_pack(h1[k]), at=where, times=n, sizes=_pack(h2[k]), **_named(names, who[which[k]])))
            yield _rows(out)


def previous_factors(text: np.ndarray, begin: np.ndarray, size: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, offset) of the suffixes whose first LENGTH bytes also begin a suffix of a smaller document."""
    n = size - LENGTH + 1
    which = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    first = begin[which] + offset
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = []
    for k in range(0, LENGTH, 8):
        word = np.zeros(len(first), _U64)
        for j in range(min(8, LENGTH - k)):
            word |= padded[first + k + j].astype(_U64) << _U64(56 - 8 * j)
        words.append(word)
    order = np.lexsort((doc[which], *words[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for word in words:
        w = word[order]
        new[1:] |= w[1:] != w[:-1]
    least = np.repeat(doc[which][order][new], np.diff(np.append(np.flatnonzero(new), len(order))))
    hit = order[doc[which][order] > least]
    return which[hit], offset[hit]


def _united(doc: np.ndarray, alt: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans by text and start, with those of a text that touch or overlap made one."""
    if not len(doc):
        return doc, alt, lo, hi
    by = np.lexsort((lo, alt, doc))
    doc, alt, lo, hi = doc[by], alt[by], lo[by], hi[by]
    base = np.cumsum(_changes(doc, alt)).astype(np.int64) << 32  # no text is as long
    reach = np.maximum.accumulate(base + hi)
    start = np.flatnonzero(np.append(True, (base + lo)[1:] > reach[:-1]))
    return doc[start], alt[start], lo[start], reach[np.append(start[1:], len(doc)) - 1] - base[start]


def _spans(table: pa.Table, groups: int) -> pa.Table:
    """Of one bucket, the spans that begin in a smaller document; a row per group of documents."""
    docs, spans, parts, dealt = [np.zeros((2, 0), np.int64)], [np.zeros((0, 2), np.int64)], [], []
    for r in table.to_pylist():
        if r["own"] is not None:
            pairs = np.frombuffer(r["own"], np.int64).reshape(-1, 2)
            docs.append(np.repeat([[r["doc_id"]], [r["alt"]]], len(pairs), axis=1))
            spans.append(pairs)
        else:
            owner = _owners(r)
            pos, times = (_unpack(r[c], np.uint32).astype(np.int64) for c in ("at", "times"))
            if r["text"] is None:
                dealt.append((_unpack(r["keys"], _U64), _unpack(r["sizes"], _U64), pos, times, owner))
                continue
            key, size = (_unpack(r[c], np.uint32) for c in ("keys", "sizes"))
            parts.append((key.astype(_U64), pos, times, size.astype(np.int64), owner, _unpack(r["text"], np.uint8)))
    if dealt:
        h1, h2, pos, times, doc = (np.concatenate(x, axis=-1) for x in zip(*dealt, strict=True))
        later = _least(*doc, h1, h2)[0]
        lo = _gather(pos, (np.cumsum(times) - times)[later], times[later])
        docs.append(np.repeat(doc[:, later], times[later], axis=1))
        spans.append(np.stack([lo, lo + LENGTH], 1))
    if parts:
        key, pos, times, size, doc, text = (np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
        begin, place = np.cumsum(size) - size, np.cumsum(times) - times
        p = H.prefix(text, H.BYTE)
        mark = H.mix((p[begin + size] - p[begin]) * H.powers(len(text) + 1)[1][begin]) ^ H.mix(key) ^ size.astype(_U64)
        whole, held, same = _least(*doc, mark)
        first = np.cumsum(same) - same
        lo = _gather(pos, place[whole], times[whole])
        docs.append(np.repeat(doc[:, whole], times[whole], axis=1))
        spans.append(np.stack([lo, lo + np.repeat(size[whole], times[whole])], 1))
        pos, n = _gather(pos, place[held], times[held]), np.add.reduceat(times[held], first)  # places by mark
        place = np.cumsum(n) - n
        one = held[first]
        _, which, runs = np.unique(key[one], return_inverse=True, return_counts=True)
        asked = np.flatnonzero(runs[which] > 1)  # an anchor with one run only is settled
        found, offset = previous_factors(text, begin[one[asked]], size[one[asked]], doc[0, one[asked]])
        found = asked[found]
        lo = _gather(pos, place[found], n[found]) + np.repeat(offset, n[found])
        docs.append(np.repeat(doc[:, one[found]], n[found], axis=1))
        spans.append(np.stack([lo, lo + LENGTH], 1))
    pairs = np.concatenate(spans)
    doc, alt, lo, hi = _united(*np.concatenate(docs, axis=1), pairs[:, 0], pairs[:, 1])
    group = _group(doc, alt, groups)
    order = np.argsort(group, kind="stable")
    doc, alt, lo, hi, group = doc[order], alt[order], lo[order], hi[order], group[order]
    rows = [(g, _pack_names(doc[part], alt[part]), _pack(lo[part].astype(np.uint32)), _pack((hi - lo)[part].astype(np.uint32))) for g, part in _split(group)]
    cols = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.table([pa.array(list(c), k) for c, k in zip(cols, (pa.int32(), *[pa.binary()] * 3), strict=True)], ["group", "docs", "at", "sizes"])


def _gathered(table: pa.Table) -> pa.Table:
    """Of one group of documents, per document its spans."""
    names = np.concatenate([_unpack_names(x) for x in table.column("docs").to_pylist()], axis=1)
    lo, size = (np.concatenate([_unpack(x, np.uint32) for x in table.column(c).to_pylist()]).astype(np.int64) for c in ("at", "sizes"))
    doc, alt, lo, hi = _united(*names, lo, lo + size)
    return _by_name([(d, x, np.stack([lo[part], hi[part]], 1).tobytes()) for d, x, part in _split(doc, alt)], "spans")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in H.pieces(whole, "text"):
            data, at = H.flat(batch.column("text"))
            out = []
            for r, spans in enumerate(batch.column("spans").to_pylist()):
                own = data[at[r] : at[r + 1]]
                step = np.zeros(len(own) + 1, np.int64)
                pairs = np.frombuffer(spans or b"", np.int64).reshape(-1, 2)
                np.add.at(step, pairs[:, 0], 1)
                np.add.at(step, pairs[:, 1], -1)
                gone = np.cumsum(step[:-1]) > 0
                n = int((gone & ~np.append(False, gone[:-1])).sum()) if len(own) else 0
                out.append((len(own), int(gone.sum()), n, own[~gone].tobytes()))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            ints = [pa.array(c, pa.int64()) for c in cols[:3]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *ints, pa.array([hashlib.sha256(x).hexdigest() for x in cols[3]], pa.string()), pa.array(cols[3], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )


def remove_repeats(docs: DataFrame, bucket_bytes: int = 16 << 20, hot: int = 10_000) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row of docs (doc_id long, text).

    Null text is empty. Rows that repeat a doc_id never match each other, whatever their texts: each loses what also starts
    under a smaller doc_id. Rows without doc_id match nothing.
    """
    # a cast that does nothing would keep the two joins from sharing the documents' exchange
    doc_id = F.col("doc_id") if docs.schema["doc_id"].dataType.simpleString() == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(doc_id, F.coalesce("text", F.lit("")).alias("text"))
    named = rows.where("doc_id is not null")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, size // bucket_bytes)
    finer = buckets * 4
    text = F.xxhash64("text")
    several = named.groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b")).where("a != b")
    several = staged(several.select("doc_id", F.lit(True).alias("several")), "several")
    named = named.join(several, "doc_id", "left").select("doc_id", "text", F.when(F.col("several"), text).otherwise(0).alias("alt"))
    asked = named.mapInArrow(lambda it: _anchors(it, buckets), _SENT)
    shared = asked.groupBy("bucket").applyInArrow(lambda t: _shared(t, buckets, hot), "group int, docs binary, codes binary, hot binary")
    shared = staged(shared, "shared")
    # 8 bytes for each anchor with more than `hot` runs: a run is over ten bytes on average, so at most 1 / 12,000 of the input
    listed = [_unpack(r.hot, _U64) for r in shared.where("hot is not null").select("hot").toLocalIterator()]
    many = docs.sparkSession.sparkContext.broadcast(np.concatenate([np.zeros(0, _U64), *listed]))
    told = shared.select("group", "docs", "codes").groupBy("group").applyInArrow(_told, "doc_id long, alt long, codes binary")
    told = named.join(told, ["doc_id", "alt"], "left").select("doc_id", "alt", "text", "codes")
    texts = told.mapInArrow(lambda it: _texts(it, buckets, finer, many.value), _SENT)
    spans = texts.groupBy("bucket").applyInArrow(lambda t: _spans(t, buckets), "group int, docs binary, at binary, sizes binary")
    spans = spans.groupBy("group").applyInArrow(_gathered, "doc_id long, alt long, spans binary")
    joined = named.join(spans, ["doc_id", "alt"], "left").select("doc_id", "text", "spans")
    free = rows.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("binary").alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return joined.unionByName(free).mapInArrow(_kept, schema)
