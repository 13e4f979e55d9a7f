"""Collocated phrases by set-oriented relational mining (SETM).

The relation of a phrase length holds every occurrence of a frequent phrase, sorted by position; a piece ends in a position of
its own that no phrase has, so neighbours in position are neighbours in a piece. It is a written table with one row per chunk of
text of one language, in which positions are slots. One level:

1. extend: the relation is merged with itself at adjacent positions, each chunk for itself; two overlapping phrases of k words
   make one of k + 1. Each distinct pair of a chunk is one row with its count, which is the pre-aggregation before any shuffle.
2. count: the rows are summed by pair; pairs that are frequent get a number.
3. semi-join: the rows of frequent pairs, which stand beside the sums, go back to their chunks, where all other occurrences
   leave the relation before the next level.

A phrase is a pair of numbers of shorter phrases, and words are compared by their text, so no hash decides anything. Only
phrases both of whose parts are frequent are ever counted, as a phrase is never more frequent than what it holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm import bytehash as H
from parcelmart.llm.staging import discard, staged

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS = np.zeros(256, bool)  # of pieces
_ENDS[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_BLANK = _ENDS.copy()
_BLANK[[9, 32]] = True


_ZSTD = pa.Codec("zstd", 1)


def _packed(slots: np.ndarray) -> bytes:
    return len(slots).to_bytes(8, "little") + _ZSTD.compress(np.ascontiguousarray(slots, np.int32), asbytes=True)


def _unpacked(held: bytes) -> np.ndarray:
    return np.frombuffer(_ZSTD.decompress(held[8:], 4 * int.from_bytes(held[:8], "little")), np.int32)


def _slots(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The word in every slot as an index into the distinct words, -1 at the end of a piece; and the distinct words."""
    data = _LOWER[data]
    blank = _BLANK[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = blank[:-1]
    edge[at] = True
    start = np.flatnonzero(~blank & edge[:-1])
    edge[1:-1] = blank[1:]
    edge[at] = True
    end = np.flatnonzero(~blank & edge[1:]) + 1
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[~blank])])
    coded = words.dictionary_encode()
    ends = np.concatenate([[0], np.cumsum(_ENDS[data])])[start]
    text = np.searchsorted(at, start, side="right")
    fresh = (np.diff(ends, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0)
    place = np.arange(len(start)) + np.cumsum(fresh)
    slots = np.full(len(start) + int(fresh.sum()) + 1, -1, np.int32)
    slots[place] = coded.indices.to_numpy()
    return slots, coded.dictionary.cast(pa.large_string())


def _chunk(number: int, lang: str, texts: list[pa.Array]) -> pa.RecordBatch | None:
    slots, words = _slots(*H.flat(pa.chunked_array(texts)))
    if not len(words):
        return None
    n = np.bincount(slots[slots >= 0], minlength=len(words)).astype(np.int64)
    row = [number], [lang], [_packed(slots)], [words.to_pylist()], [n]
    kinds = pa.int64(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], ["chunk", "lang", "slots", "words", "n"])


def _chunked(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Texts of one language together; when `limit` bytes are held, those of the language with most become a chunk."""
    number = TaskContext.get().partitionId() << 33
    held: dict[str, list[pa.Array]] = {}
    size: dict[str, int] = {}

    def release() -> Iterator[pa.RecordBatch]:
        nonlocal number
        lang = max(size, key=lambda x: (size[x], x))
        del size[lang]
        if row := _chunk(number, lang, held.pop(lang)):
            number += 1
            yield row

    for whole in batches:
        for batch in H.pieces(whole, "text", 1 << 20):
            lang = batch.column("lang").dictionary_encode()
            which = lang.indices.to_numpy()
            for k, name in enumerate(lang.dictionary.to_pylist()):
                texts = batch.column("text").take(pa.array(np.flatnonzero(which == k)))
                held.setdefault(name, []).append(texts)
                size[name] = size.get(name, 0) + texts.nbytes
            while sum(size.values()) > limit:
                yield from release()
    while size:
        yield from release()


def _pairs(slots: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First slots of adjacent phrases, and their pairs as one number."""
    here = np.flatnonzero((slots[:-1] >= 0) & (slots[1:] >= 0))
    return here, slots[here].astype(np.int64) * width + slots[here + 1]


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, held, names in zip(*(batch.column(c).to_pylist() for c in ("chunk", "slots", "names")), strict=True):
            names = np.frombuffer(names, np.int64)
            pair, n = np.unique(_pairs(_unpacked(held), len(names))[1], return_counts=True)
            for a in range(0, len(pair), 100_000):
                part = pair[a : a + 100_000]
                values = np.full(len(part), chunk), names[part // len(names)], names[part % len(names)], n[a : a + len(part)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in values], ["chunk", "a", "b", "n"])


def _frequent(rows: DataFrame, keys: list[str], least: int, place: int, of: int) -> DataFrame:
    """Rows with a chunk and n whose keys' n sum to `least`, with the sum f, the key's id, and first on one row of each key.

    Counting and semi-join share one shuffle: a key has at most one row per chunk, counted in the chunk before.
    """
    rows = rows.repartition(*keys).withColumn("uid", F.monotonically_increasing_id())
    same = Window.partitionBy(*keys)
    rows = rows.withColumn("f", F.sum("n").over(same)).withColumn("low", F.min("uid").over(same)).where(F.col("f") >= least)
    return rows.select(*(c for c in rows.columns if c not in ("n", "f", "uid", "low")), "f", (F.col("low") * of + place).alias("id"), (F.col("uid") == F.col("low")).alias("first"))


_RELATION = "chunk long, slots binary, names binary"


def _row(chunk: int, slots: np.ndarray, place: np.ndarray, names: np.ndarray) -> pa.Table:
    """The relation's row in which place[x] stands for x, and nothing for what place has as -1."""
    values = [chunk], [_packed(np.append(place, -1)[slots])], [names.astype(np.int64).tobytes()]
    return pa.table([pa.array(x, k) for x, k in zip(values, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "slots", "names"])


_NOTHING = pa.schema([("chunk", pa.int64()), ("slots", pa.binary()), ("names", pa.binary())]).empty_table()


def _words_left(left: pa.Table, right: pa.Table) -> pa.Table:
    """A chunk in which only the words of right (i, id) are left."""
    if not left.num_rows or not right.num_rows:
        return _NOTHING
    slots = _unpacked(left.column("slots")[0].as_py())
    i, names = (right.column(c).to_numpy() for c in ("i", "id"))
    order = np.argsort(i)
    place = np.full(int(slots.max()) + 1, -1, np.int32)
    place[i[order]] = np.arange(len(i))
    return _row(left.column("part")[0].as_py(), slots, place, names[order])


def _pairs_left(left: pa.Table, right: pa.Table) -> pa.Table:
    """The relation's row of the pairs of adjacent phrases that right (a, b, id) has."""
    if not left.num_rows or not right.num_rows:
        return _NOTHING
    slots, held = _unpacked(left.column("slots")[0].as_py()), np.frombuffer(left.column("names")[0].as_py(), np.int64)
    here, pair = _pairs(slots, len(held))
    distinct, kind = np.unique(pair, return_inverse=True)
    order = np.argsort(held)
    a, b = (order[np.searchsorted(held[order], right.column(c).to_numpy())] for c in ("a", "b"))
    at = np.searchsorted(distinct, a * len(held) + b)
    place = np.full(len(distinct), -1, np.int32)
    place[at] = np.arange(len(at))
    wide = np.full(len(slots), -1, np.int32)
    wide[here] = kind
    return _row(left.column("part")[0].as_py(), wide, place, right.column("id").to_numpy())


def frequent_phrases(docs: DataFrame, least: int = 30, longest: int = 4, limit: int = 16 << 20) -> tuple[DataFrame, DataFrame]:
    """Phrases with at least `least` occurrences, and (lang, n), all words of each language.

    Phrases are (id, lang, words, phrase, last, f, heads, tails, within): heads and tails count the phrase's first and last 1, 2 ..
    words, within has the ids of shorter phrases of two words or more inside it. A task holds `limit` bytes of text or one longer text.
    """
    rows = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    chunks = rows.mapInArrow(lambda it: _chunked(it, limit), "chunk long, lang string, slots binary, words array<string>, n array<long>")
    chunks = staged(chunks, "chunks")
    total = chunks.groupBy("lang").agg(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"))
    total = staged(total, "total")

    words = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "n")).alias("i", "x")).select("chunk", "lang", "i", "x.words", "x.n")
    found = staged(_frequent(words, ["lang", "words"], least, 0, longest), "found")
    none = F.array().cast("array<long>")
    one = F.array("f")
    level = found.where("first").select(
        "id", "lang", F.lit(1).alias("words"), F.col("words").alias("phrase"), F.col("words").alias("last"), "f", one.alias("heads"), one.alias("tails"), none.alias("within")
    )
    level = staged(level, "frequent")
    texts = chunks.select(F.col("chunk").alias("part"), "slots").groupBy("part")
    relation = texts.cogroup(found.select("chunk", "i", "id").groupBy("chunk")).applyInArrow(_words_left, _RELATION)
    relation = staged(relation, "occurrences")
    discard(chunks, found)
    levels = [level]
    for k in range(2, longest + 1):
        pairs = relation.mapInArrow(_extended, "chunk long, a long, b long, n long")
        found = staged(_frequent(pairs, ["a", "b"], least, k - 1, longest), "found")
        side = lambda x, *columns: level.select(F.col("id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in columns))
        joined = found.where("first").join(side("a", "lang", "phrase", "heads", "within"), "a").join(side("b", "last", "tails", "within"), "b")
        parts = F.array_union(F.array_union("within_a", "within_b"), F.array("a", "b") if k > 2 else none)
        level = joined.select(
            "id", F.col("lang_a").alias("lang"), F.lit(k).alias("words"), F.concat_ws(" ", "phrase_a", "last_b").alias("phrase"), F.col("last_b").alias("last"),
            "f", F.concat("heads_a", one).alias("heads"), F.concat("tails_b", one).alias("tails"), parts.alias("within"),
        )
        level = staged(level, "frequent")
        levels.append(level)
        if k < longest:
            held = relation.select(F.col("chunk").alias("part"), "slots", "names").groupBy("part")
            narrowed = held.cogroup(found.select("chunk", "a", "b", "id").groupBy("chunk")).applyInArrow(_pairs_left, _RELATION)
            narrowed = staged(narrowed, "occurrences")
            discard(relation)
            relation = narrowed
        discard(found)
    discard(relation)
    return reduce(DataFrame.unionByName, levels), total


def collocations(docs: DataFrame, top: int = 2000, least: int = 30, longest: int = 4, covered: int = 80, limit: int = 16 << 20) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of two to `longest` words of each language.

    a counts the phrase, l and r the parts of its lowest-scoring cut, n all words of the language. A phrase that stands inside
    a longer candidate with at least `covered` percent of its count is left out. Null texts are empty, a null lang is `und`; an
    empty table, or one without phrases that are frequent enough, gives no rows. Rows that repeat count as often as they stand.
    Ties in score and count go by the phrase's bytes, so the result is the same on every run. Only text and lang are read.
    """
    phrases, total = frequent_phrases(docs, least, longest, limit)
    wide = "decimal(38,0)"
    cuts = []
    for k in range(1, longest):
        l, r = F.get("heads", F.lit(k - 1)), F.get("tails", F.col("words") - k - 1)  # noqa: E741
        score = (F.lit(2_000_000).cast(wide) * F.col("f").cast("decimal(20,0)")).cast(wide)
        whole = F.call_function("div", score, (l + r).cast(wide))
        cuts.append(F.when(F.col("words") > k, F.struct(whole.cast("long").alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))))
    longer = phrases.where("words > 2").select(F.explode("within").alias("id"), "f").groupBy("id").agg(F.max("f").alias("most"))
    kept = phrases.where("words > 1").join(longer, "id", "left")
    kept = kept.where(F.col("most").isNull() | (F.col("most").cast(wide) * 100 < F.col("f").cast(wide) * covered))
    rows = kept.select("lang", "phrase", F.col("f").alias("a"), (F.least(*cuts) if len(cuts) > 1 else cuts[0]).alias("cut"))
    rows = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return rows.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
