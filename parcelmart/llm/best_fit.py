"""Best-fit packing improved by a swap-based local search.

Pieces of equal tokenised documents are dealt into groups. In each group the pieces are placed longest first into the fullest
bin that has room. Then bins exchange pieces: a piece moves to another bin, one is exchanged for one, or one for two, always
so that the sum of squared fillings rises, until bins empty or nothing is left to gain. As the sum is a whole number that rises
with every exchange, the search ends. Bins that are full are done. Those that are not are dealt anew into fewer groups, whole,
round after round, until a round of a single group has been searched, or a round has emptied less than a bin per group. Whatever
the input is, a task holds one group; a full bin is never moved again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm import bytehash as H
from parcelmart.llm.packing import encode
from parcelmart.llm.staging import staged


def _cut(batches: Iterator[pa.RecordBatch], path: str, size: int, stop: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    for whole in batches:
        for batch in H.pieces(whole, "text"):
            ids, at = encode(*H.flat(batch.column("text")), path)
            rows = []
            for r in range(batch.num_rows):
                own = np.append(ids[at[r] : at[r + 1]], np.uint32(stop)).astype("<u4")
                first = len(own) % size or size
                for k, end in enumerate(range(first, len(own) + 1, size)):
                    piece = own[max(0, end - size) if k else 0 : end]
                    rows.append((r, k, end - len(piece), len(piece), zlib.crc32(piece.tobytes())))
            row, *values = zip(*rows, strict=True)
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), *map(pa.array, values, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)


def cut(docs: DataFrame, tokenizer: str, size: int = 1024, stop: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and the stop id; only longer ones are cut, the rest first."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(lambda it: _cut(it, tokenizer, size, stop), schema)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of indexes into lengths: from the longest, each into the fullest bin with room for it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = size, len(bins)
            bins.append([i])
        by_room[room - n].append(b)
        rooms |= 1 << room - n
    return bins


class _Search:
    """Bins with room, indexed by the lengths of pieces and of pairs of pieces that they hold."""

    def __init__(self, bins: list[list[int]], lengths: list[int], size: int):
        self.lengths, self.size = lengths, size
        self.bins = {b: set(x) for b, x in enumerate(bins)}
        self.fill = {b: sum(lengths[i] for i in x) for b, x in self.bins.items()}
        self.least = -(-sum(self.fill.values()) // size)  # no packing has fewer bins
        self.sums: dict[int, tuple[set[int], set[int]]] = {}  # of a bin: lengths of its pieces, and of pairs of them
        self.holders: tuple[dict[int, set[int]], ...] = ({}, {})  # length to bins, for pieces and for pairs
        self.present = [0, 0]  # bit n: some bin with room holds a piece, a pair of length n
        for b in self.bins:
            self._list(b)

    def _list(self, b: int) -> None:
        if self.fill[b] == self.size:
            return
        own = sorted(self.lengths[i] for i in self.bins[b])
        kinds = sorted(set(own))
        pairs = {n + m for k, n in enumerate(kinds) for m in kinds[k + 1 :]} | {n + n for n, m in zip(own, own[1:], strict=False) if n == m}
        self.sums[b] = set(kinds), pairs
        for k, sums in enumerate(self.sums[b]):
            for n in sums:
                self.holders[k].setdefault(n, set()).add(b)
                self.present[k] |= 1 << n

    def _unlist(self, b: int) -> None:
        for k, sums in enumerate(self.sums.pop(b, ())):
            for n in sums:
                held = self.holders[k][n]
                held.discard(b)
                if not held:
                    del self.holders[k][n]
                    self.present[k] &= ~(1 << n)

    def _pieces(self, b: int, total: int, pair: bool) -> tuple[int, ...]:
        """A piece of that length, or a pair of them, in the bin."""
        first: dict[int, int] = {}
        for i in sorted(self.bins[b]):
            n = self.lengths[i]
            if not pair and n == total:
                return (i,)
            if pair and total - n in first:
                return first[total - n], i
            first.setdefault(n, i)
        raise AssertionError("the index names a length that the bin has not")

    def _change(self, a: int, b: int, out: tuple[int, ...], back: tuple[int, ...]) -> None:
        """Pieces `out` go from a to b, pieces `back` from b to a."""
        for x in (a, b):
            self._unlist(x)
        self.bins[a] = (self.bins[a] - set(out)) | set(back)
        self.bins[b] = (self.bins[b] - set(back)) | set(out)
        for x in (a, b):
            self.fill[x] = sum(self.lengths[i] for i in self.bins[x])
        if not self.bins[a]:
            del self.bins[a], self.fill[a]
        else:
            self._list(a)
        self._list(b)

    def _best(self, b: int) -> tuple[int, int, tuple[int, ...], tuple[int, ...]] | None:
        """The exchange that fills b most: (gain of b, other bin, pieces b gets, pieces b gives), if one raises the sum of squares.

        Moving d tokens from a to b raises the sum if and only if b then holds more than a did.
        """
        room = self.size - self.fill[b]
        singles, pairs = self.sums[b]
        # given by b, taken by b: nothing or one for one or two, two for one
        ways = [(0, False, k) for k in (0, 1)] + [(n, False, k) for n in sorted(singles) for k in (0, 1)] + [(n, True, 0) for n in sorted(pairs)]
        best = None
        for total, pair, k in ways:
            # what is longer than what is given back by at most the room
            fits = (self.present[k] >> total + 1) & ((1 << room) - 1)
            while fits and (best is None or fits.bit_length() > best[0]):
                gain = fits.bit_length()
                found = [(self.fill[a], a) for a in self.holders[k][total + gain] if a != b and self.fill[a] < self.fill[b] + gain]
                if found:
                    best = gain, min(found)[1], k, total, pair
                    break
                fits &= ~(1 << gain - 1)
            if best and best[0] == room:
                break
        if best is None:
            return None
        gain, a, k, total, pair = best
        return gain, a, self._pieces(a, total + gain, bool(k)), self._pieces(b, total, pair) if total else ()

    def run(self) -> list[list[int]]:
        changed = True
        while changed and len(self.bins) > self.least:
            changed = False
            for b in sorted(self.bins, key=lambda b: (-self.fill[b], b)):
                while b in self.bins and self.fill[b] < self.size and (step := self._best(b)):
                    _, a, out, back = step
                    self._change(a, b, out, back)
                    changed = True
                    if len(self.bins) <= self.least:
                        return [sorted(x) for x in self.bins.values()]
        return [sorted(x) for x in self.bins.values()]


def local_search(bins: list[list[int]], lengths: list[int], size: int) -> list[list[int]]:
    """The bins after moves and exchanges of one for one, two for one and one for two that raise the sum of squared fillings."""
    return _Search(bins, lengths, size).run()


_SCHEMA = "uid long, length long, bin long, offset long, filled long"


def _searched(t: pa.Table, size: int) -> pa.Table:
    t = t.sort_by([("bin", "ascending"), ("uid", "ascending")])
    uid, length, old = (t.column(c).to_numpy() for c in ("uid", "length", "bin"))
    lengths = length.tolist()
    start = np.flatnonzero(np.diff(old, prepend=old[0] - 1))
    before = [list(range(a, b)) for a, b in zip(start, [*start[1:], len(old)], strict=True)]
    bins = best_fit(lengths, size)
    if len(bins) > len(before):
        bins = before
    bins = local_search(bins, lengths, size)
    row = np.array([i for b in bins for i in b])
    count = np.array([len(b) for b in bins])
    first = np.cumsum(count) - count
    own = length[row]
    filled = np.add.reduceat(own, first)
    offset = np.cumsum(own) - own
    offset -= np.repeat(offset[first], count)
    # a bin is named by its first piece: a piece is in one bin
    values = uid[row], own, np.repeat(uid[row][first], count), offset, np.repeat(filled, count)
    return pa.Table.from_arrays([pa.array(x.astype(np.int64)) for x in values], ["uid", "length", "bin", "offset", "filled"])


def pack_best_fit(docs: DataFrame, tokenizer: str, size: int = 1024, stop: int = 2, group: int = 20_000) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null or empty text is the stop id alone. Every row of docs is a document, also where rows repeat or doc_id is null; an empty
    table gives no rows; only doc_id and text are read. A group has about `group` pieces. Ties are broken by the order of the
    written pieces, so the packing is fixed once they are written, but may differ between runs; the number of sequences hardly does.
    Per round, two counts reach the driver.
    """
    pieces = cut(docs, tokenizer, size, stop).withColumn("uid", F.monotonically_increasing_id())
    pieces = staged(pieces, "pieces")
    done = [pieces.where(F.col("length") == size).select("uid", F.col("uid").alias("bin"), F.lit(0).cast("long").alias("offset"))]
    open_ = pieces.where(F.col("length") < size).select("uid", "length", F.col("uid").alias("bin"), F.lit(0).cast("long").alias("offset"))
    number = 0
    rows, bins = open_.count(), None
    while rows:
        groups = max(1, round(rows / group))
        dealt = open_.withColumn("part", F.pmod(F.xxhash64("bin", F.lit(number)), F.lit(groups)))
        searched = dealt.groupBy("part").applyInArrow(lambda t: _searched(t.drop_columns(["part"]), size), _SCHEMA)
        searched = staged(searched, "searched")
        done.append(searched.where(F.col("filled") == size).select("uid", "bin", "offset"))
        open_ = searched.where(F.col("filled") < size)
        now = searched.agg(F.count("*"), F.count_if(F.col("offset") == 0), F.count_if((F.col("filled") < size)), F.count_if((F.col("filled") < size) & (F.col("offset") == 0))).first()
        if groups == 1 or (bins is not None and bins - now[1] < groups):
            break
        rows, bins, number = now[2], now[3], number + 1
    done.append(open_.select("uid", "bin", "offset"))
    placed = reduce(DataFrame.unionByName, done)
    out = pieces.join(placed, "uid")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
