"""Personal data: fixed rules give seeds, and a bootstrap over their contexts finds identifiers of other forms.

Seeds are e-mail addresses, IP addresses, card and phone numbers that the rules match. Contexts are the phrases of one to
three words before and after a place on its line. Other instances are runs of adjacent words with digits or an @ in them.
Each round takes all places of the instances accepted so far, induces patterns (kind, side, phrase) from their contexts, and
scores a pattern by the accepted share of all places its phrase has in the corpus; the patterns then score the instances in
their contexts, and those that are sure enough join the accepted. So a seed's context finds an unseen identifier, and that
identifier's other contexts find further ones. Patterns and instances are tables; Spark joins and groups them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm import bytehash as H
from parcelmart.llm.staging import staged, text_key

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only begin where its run of digits begins: what follows the run is the same for all its digits
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARKED = re.compile(r"(?<!\S)[^\s@0-9]*+[@0-9]\S*")
_SPACE = re.compile(r"\s")
_NEXT = re.compile(r"[^\S\n]*(\S+)")
#: Multiplier that chains the hashes of a phrase's words, and the longest phrase.
_CHAIN, _WORDS = 0x9E3779B97F4A7C15, 3
_ALL = 2**64 - 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = at = m.end()
        else:
            at += 1


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what the fixed rules match, by kind and start; positions in code points."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p[-12:]) <= 255 for p in m[0].split(".")):
                    out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def _word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def _salt(n: int, forwards: bool) -> int:
    """Sets apart phrases by length and direction; one word has no direction."""
    return (n + (_WORDS if forwards and n > 1 else 0)) * _CHAIN & _ALL


def _phrases(hashes: list[int], forwards: bool) -> list[int]:
    """Signed names of the phrases of the first one, two and three words."""
    out, x = [], 0
    for n, h in enumerate(hashes, 1):
        x = (x * _CHAIN + h) & _ALL
        name = (x + _salt(n, forwards)) & _ALL
        out.append(name - (name >> 63 << 64))
    return out


def _contexts(text: str, start: int, end: int) -> tuple[list[int], list[int]]:
    """Names of the phrases, nearest word first, before and after the words that the place touches, on its line."""
    while start and not text[start - 1].isspace():
        start -= 1
    m = _SPACE.search(text, end)
    end = m.start() if m else len(text)
    left, right = [], []
    while len(left) < _WORDS:
        while start and text[start - 1] != "\n" and text[start - 1].isspace():
            start -= 1
        if not start or text[start - 1] == "\n":
            break
        to = start
        while start and not text[start - 1].isspace():
            start -= 1
        left.append(_word_hash(text[start:to].lower()))
    while len(right) < _WORDS and (m := _NEXT.match(text, end)):
        right.append(_word_hash(m[1].lower()))
        end = m.end()
    return _phrases(left, False), _phrases(right, True)


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The place less the quotes, stops and lone brackets at its ends."""
    while start < end and (text[start] in "\"'<" or text[start] == "(" and text.find(")", start, end) < 0):
        start += 1
    while start < end and (text[end - 1] in ".,;:!?\"'>" or text[end - 1] == ")" and text.find("(", start, end) < 0):
        end -= 1
    return start, end


def candidate_spans(text: str, base: list[tuple[int, int, int]], least: int = 6) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of adjacent words with a digit or an @, on a line, that touch no base span.

    A stop or comma ends a run. Runs with fewer than `least` letters and digits are left out: hours, years and page numbers
    are no identifiers, and they recur in all contexts.
    """
    covered, i = sorted((s, e) for _, s, e in base), 0
    start = end = -1

    def whole() -> Iterator[tuple[int, int]]:
        s, e = _trimmed(text, start, end) if start >= 0 else (0, 0)
        if sum(map(str.isalnum, text[s:e])) >= least:
            yield s, e

    reach = -1
    for m in _MARKED.finditer(text):
        s, e = m.span()
        while i < len(covered) and covered[i][0] < e:
            reach = max(reach, covered[i][1])
            i += 1
        if reach > s:
            yield from whole()
            start = -1
        elif start >= 0 and text[end - 1] not in ".,;:!?" and "\n" not in (gap := text[end:s]) and gap.isspace():
            end = e
        else:
            yield from whole()
            start, end = s, e
    yield from whole()


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _value(text: str) -> str:
    """Name of an instance: its text with white space as one space."""
    return xxhash.xxh3_128_hexdigest(" ".join(text.split()).encode("utf-8", "surrogatepass"))


_SPAN = [("k", pa.int32()), ("s", pa.int32()), ("e", pa.int32()), ("v", pa.string()), ("l", pa.list_(pa.int64())), ("r", pa.list_(pa.int64()))]


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct(_SPAN))
    for whole in batches:
        for batch in H.pieces(whole, "text"):
            n, sha, places = [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                base = base_spans(text)
                n.append([sum(k == x for k, _, _ in base) for x in range(4)])
                sha.append(hashlib.sha256(_written(base).encode()).hexdigest())
                every = [*base, *((-1, s, e) for s, e in candidate_spans(text, base))]
                places.append([dict(zip("kselrv", (*x, *_contexts(text, *x[1:]), _value(text[x[1] : x[2]])), strict=True)) for x in every])
            counts = [pa.array([x[k] for x in n], pa.int64()) for k in range(4)]
            keys = [batch.column(c) for c in ("doc_id", "_t1", "_t2")]
            yield pa.RecordBatch.from_arrays(
                [*keys, *counts, pa.array(sha, pa.string()), pa.array(places, span)],
                ["doc_id", "_t1", "_t2", *(f"n_{k}" for k in KINDS), "base_sha256", "places"],
            )


def _word_runs(text: str, step: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(hashes, lines, how many are new) of all words, in parts cut at white space that begin with the last words of the one before."""
    at = line = 0
    names, lines = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    while at < len(text):
        m = _SPACE.search(text, at + step)
        end = m.start() if m else len(text)
        split = [row.split() for row in text[at:end].lower().split("\n")]
        here = np.repeat(np.arange(line, line + len(split)), [len(row) for row in split])
        found = np.fromiter((_word_hash(w) for row in split for w in row), np.uint64, len(here))
        names, lines = np.concatenate([names[1 - _WORDS :], found]), np.concatenate([lines[1 - _WORDS :], here])
        yield names, lines, len(found)
        at, line = end, line + len(split) - 1


def phrase_names(text: str) -> Iterator[np.ndarray]:
    """Names of all phrases of one to three words on one line of a text, as `_contexts` has them for both sides.

    A phrase is named from the word nearest to the place: left contexts are chained backwards, right ones forwards, so every
    phrase of several words has a name per direction.
    """
    chain = np.uint64(_CHAIN)
    for names, lines, fresh in _word_runs(text):
        first = len(names) - fresh
        yield (names[first:] + chain).view(np.int64)
        for n in range(2, _WORDS + 1):
            ends = np.arange(max(first, n - 1), len(names))
            ends = ends[lines[ends] == lines[ends - n + 1]]
            for forwards in (False, True):
                x = np.zeros(len(ends), np.uint64)
                for k in range(n):
                    x = x * chain + names[ends - (n - 1 - k if forwards else k)]
                yield (x + np.uint64(_salt(n, forwards))).view(np.int64)


def _phrase_counts(batches: Iterator[pa.RecordBatch], bits: np.ndarray, limit: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """(h, n): how often the phrases that `bits` lets through occur, summed up to `limit` different ones at a time."""
    held, counts, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        new, n = np.unique(np.concatenate(waiting) if waiting else held[:0], return_counts=True)
        both, which = np.unique(np.concatenate([held, new]), return_inverse=True)
        return both, np.bincount(which, weights=np.concatenate([counts, n]), minlength=len(both)).astype(np.int64)

    for whole in batches:
        for batch in H.pieces(whole, "text"):
            for text in batch.column("text"):
                for names in phrase_names(text.as_py() or ""):
                    waiting.append(names[bits[names & (len(bits) - 1)]])
                    size += len(waiting[-1])
                    if size > limit or len(waiting) > 10_000:
                        held, counts = merged()
                        waiting, size = [], 0
                        if len(held) > limit:
                            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], ["h", "n"])
                            held, counts = held[:0], counts[:0]
    held, counts = merged()
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], ["h", "n"])


def _places_of(docs: DataFrame, phrases: DataFrame, size: int = 1 << 20) -> DataFrame:
    """(h, places): how often each of the phrases (h) occurs in all texts.

    What the driver holds and the tasks get is a table of `size` bits, whatever the number of phrases.
    """
    slots = phrases.select(F.col("h").bitwiseAND(size - 1).alias("i")).distinct().toArrow().column("i").to_numpy()
    bits = np.zeros(size, bool)
    bits[slots] = True
    counted = docs.select("text").mapInArrow(lambda batches: _phrase_counts(batches, bits), "h long, n long")
    return counted.join(phrases, "h").groupBy("h").agg(F.sum("n").alias("places"))


def _patterns(edges: DataFrame, accepted: DataFrame, places: DataFrame, support: int) -> DataFrame:
    """(k, side, h, p) of contexts that hold at least `support` accepted instances (k, v, q) of a kind."""
    held = edges.join(accepted, "v").groupBy("k", "side", "h").agg(F.sum(F.col("m") * F.col("q")).alias("gain"), F.count("*").alias("d"))
    p = F.round(F.least(F.lit(1.0), F.col("gain") / F.col("places")), 6)
    return held.where(F.col("d") >= support).join(places, "h").select("k", "side", "h", p.alias("p"))


def _instances(edges: DataFrame, patterns: DataFrame) -> DataFrame:
    """(k, v, q) of the instances in the patterns' contexts: one of the two sides is right, each by its best pattern."""
    best = edges.join(patterns, ["side", "h"]).groupBy("v", "k").agg(*(F.max(F.when(F.col("side") == x, F.col("p"))).alias(f"p{x}") for x in (0, 1)))
    q = 1 - (1 - F.coalesce("p0", F.lit(0.0))) * (1 - F.coalesce("p1", F.lit(0.0)))
    return best.select("k", "v", F.round(q, 6).alias("q"))


def find(docs: DataFrame, support: int = 3, confident: float = 0.5, rounds: int = 3) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, _t1, _t2) per row of docs (doc_id, text).

    Counts and base_sha256 are of the rules' matches; spans lists those and the places of all accepted instances, by kind and
    start. A pattern needs `support` different accepted instances; an instance is accepted at a score of `confident`, under
    its best kind (ties to the first listed). Null and empty texts have no spans, tables without seeds no more than the rules
    match. Rows that agree in doc_id and text are read as one in each other's place and get the same spans; every row counts
    as places of its phrases. Other columns of docs, whatever their names, are not read. Texts are read whole.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = "array<struct<k:int,s:int,e:int,v:string,l:array<bigint>,r:array<bigint>>>"
    schema = f"doc_id {kind}, _t1 long, _t2 long, " + ", ".join(f"n_{k} long" for k in KINDS) + f", base_sha256 string, places {span}"
    rows = staged(docs.select("doc_id", "text", *text_key(F.col("text"))).mapInArrow(_matched, schema), "matched")
    key = [F.coalesce("doc_id", F.lit(-(2**63))).alias("_d"), "_t1", "_t2"]
    found = rows.select(*key, F.explode("places").alias("x")).select("_d", "_t1", "_t2", "x.*")

    seeds = found.where("k >= 0").groupBy("v").agg(F.min("k").alias("k")).select("k", "v", F.lit(1.0).alias("q"))
    seeds = staged(seeds, "seeds")
    both = [found.select("v", F.lit(i).alias("side"), F.explode(c).alias("h")) for i, c in enumerate("lr")]
    edges = both[0].unionByName(both[1]).groupBy("side", "h", "v").agg(F.count("*").alias("m"))
    edges = staged(edges, "edges")
    frequent = edges.groupBy("side", "h").agg(F.count("*").alias("d")).where(F.col("d") >= support).select("side", "h")
    edges = staged(edges.join(staged(frequent, "frequent"), ["side", "h"]), "edges")
    accepted = seeds
    if not (seeds.isEmpty() or edges.isEmpty()):
        places = staged(_places_of(docs, staged(edges.select("h").distinct(), "phrases")), "places")
        known, n = seeds, seeds.count()
        for _ in range(rounds):
            scored = _instances(edges, _patterns(edges, known, places, support)).where(F.col("q") >= confident)
            best = scored.groupBy("v").agg(F.max_by(F.struct("k", "q"), F.struct("q", -F.col("k"))).alias("x")).select("x.k", "v", "x.q")
            known = staged(best.join(seeds.select("v"), "v", "left_anti").unionByName(seeds), "known")
            before, n = n, known.count()
            if n == before:
                break
        accepted = known
    sure = accepted.select("v", F.col("k").alias("_k"))
    place = F.struct(F.col("_k").alias("k"), "s", "e")
    added = found.where("k < 0").join(sure, "v").groupBy("_d", "_t1", "_t2").agg(F.collect_set(place).alias("added"))
    rows = rows.select("*", key[0]).join(staged(added, "added"), ["_d", "_t1", "_t2"], "left")
    own = F.transform(F.filter("places", lambda x: x.k >= 0), lambda x: F.struct(x.k.alias("k"), x.s.alias("s"), x.e.alias("e")))
    every = F.sort_array(F.concat(own, F.coalesce("added", F.expr("cast(array() as array<struct<k:int,s:int,e:int>>)"))))
    label = F.array(*map(F.lit, KINDS))
    spans = F.array_join(F.transform(every, lambda x: F.concat_ws(":", F.get(label, x.k), x.s.cast("string"), x.e.cast("string"))), ",")
    return rows.select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", spans.alias("spans"), "_t1", "_t2")
