"""Quality classifier: an interpolated modified Kneser-Ney model of words and word pairs, trained on trusted text.

Words are runs without white space, with A-Z in lower case; a text's words stand between a begin and an end sign. A word is
named by 32 bits, a pair by 64, so nothing bounds the tables: they grow with the trusted texts. Counts of pairs are gathered
per pair, continuation counts, discounts and context weights come from grouped counts of them.

A pair's probability is (n - D(n)) / total + less / total * P(word), of which a pair that trusted texts do not hold has the
second part only. So the logarithm of a text's probability is a sum over its words and pairs, each times its count, of one
number per word and pair of the model (`gain`), plus the cost of an unknown word per symbol: the n-grams of every document are
counted where it is read, dealt out by n-gram, joined there with the model, and the products are summed by document. Words and
pairs go through this in `passes` parts by their numbers, one after the other, which bounds the disk that is held at once.

A trusted document is judged without those words and pairs that no other trusted document holds, so that the limits are those
of texts the model has not seen. A text's perplexity is shrunk toward the mean of its language by `prior` symbols, since a few
words say little, and compared with a quantile of the trusted texts of its language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm import bytehash as H
from parcelmart.llm.staging import discard, settings, staged, text_key
from parcelmart.session import REQUIRED

BEGIN, END, FIRST = 1, 2, 3
WORD = (1 << 32) - 1
#: Words of trusted texts beyond which their n-grams are dealt with in so many parts; odd, as n-grams go by remainders.
PASSES = ((0, 1), (1_000_000, 3), (4_000_000, 7))
#: The trusted texts are looked for with a Bloom filter of their ids, of fixed size, so that not every text is shuffled.
BLOOM = {k: v for k, v in REQUIRED.items() if "bloomFilter" in k}
BLOOM["spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"] = "0"
BLOOM["spark.sql.autoBroadcastJoinThreshold"] = "-1"
CELLS = "shard int, kind int, g binary, doc binary, n binary, x binary"


def _words(texts: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word and how many each text has; some texts at a time, as what numpy holds then stays in the cache."""
    found = [H.word_hashes(*H.flat(some.column("text"))) for some in H.pieces(texts, "text", 512 << 10)]
    return tuple(np.concatenate([np.zeros(0, t), *x]) for t, x in ((np.uint64, [w for w, _ in found]), (np.int64, [np.diff(f) for _, f in found])))


def _symbols(texts: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The words of every text that has any, between begin and end sign, and the text of each symbol."""
    words, n = _words(texts)
    some = np.flatnonzero(n)
    size = n[some] + 2
    begin = np.concatenate([[0], np.cumsum(size)])
    doc = np.repeat(some, size)
    out = np.empty(len(doc), np.int64)
    inner = np.ones(len(doc), bool)
    inner[begin[:-1]] = inner[begin[1:] - 1] = False
    out[inner] = np.maximum(words >> np.uint64(32), np.uint64(FIRST)).astype(np.int64)
    out[begin[:-1]], out[begin[1:] - 1] = BEGIN, END
    return out, doc


def _pairs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every symbol but the first of a text with the one before it, and its place."""
    at = np.flatnonzero(symbols[1:] != BEGIN) + 1
    return (symbols[at - 1] << 32) | symbols[at], at


def _part(g: np.ndarray, parts: int) -> np.ndarray:
    return g.view(np.uint64) % np.uint64(parts)


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The symbols of every text with words, four bytes each."""
    for whole in batches:
        for batch in H.pieces(whole, "text"):
            symbols, _ = _symbols(batch)
            at = np.append(np.flatnonzero(symbols == BEGIN), len(symbols)).astype(np.int32) * 4
            data = pa.py_buffer(symbols.astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.tobytes()), data])], ["s"])


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols to be predicted per text: its words and the end; none without words."""
    for whole in batches:
        for batch in H.pieces(whole, "text"):
            n = np.diff(H.word_bounds(*H.flat(batch.column("text")))[2])
            rest = [batch.column(c) for c in ("doc_id", "lang", "_t1", "_t2", "_k")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(np.where(n > 0, n + 1, 0))], ["doc_id", "lang", "_t1", "_t2", "_k", "n_symbols"])


def _counted(batches: Iterator[pa.RecordBatch], part: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Pairs of one part and their counts, from texts' symbols, added up over some millions at a time."""

    def rows():
        g = np.concatenate(held)
        g.sort()
        new = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
        g, n = g[new], np.diff(np.append(new, len(g)))
        for a in range(0, len(g), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(g[a : a + 100_000]), pa.array(n[a : a + 100_000])], ["g", "n"])

    held, room = [], 4_000_000
    for whole in batches:
        for batch in H.pieces(whole, "s"):
            g, _ = _pairs(H.flat(batch.column("s"))[0].view(np.uint32).astype(np.int64))
            held.append(g[_part(g, parts) == part])
            room -= len(held[-1])
            if room < 0:
                yield from rows()
                held, room = [], 4_000_000
    if held:
        yield from rows()


def _cuts(table: DataFrame, n: str) -> list[float]:
    """What modified Kneser-Ney takes off counts of one, two, and three or more."""
    of = {r[0]: r[1] for r in table.where(F.col(n) <= 4).groupBy(n).count().collect()}
    n1, n2, n3, n4 = (of.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    return [min(float(i), max(0.05, i - (i + 1) * y * b / a)) if a and b else 0.5 * i for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def _less(n: str, cuts: list[float]) -> Column:
    return F.when(F.col(n) == 1, cuts[0]).when(F.col(n) == 2, cuts[1]).otherwise(cuts[2])


def train(symbols: DataFrame, passes: int = 1) -> tuple[list[DataFrame], float]:
    """The model in `passes` tables (g, n, gain), and the cost in bits of an unknown word.

    symbols: of one text per row, staged and not needed after. g: a word, or two as g >> 32 and g & WORD. n: how often trusted texts hold it. gain: what it saves
    in bits; for a word also what it costs to stand before a pair that is not known. No text at all gives empty tables.
    """
    parts = []
    for p in range(passes):
        counts = symbols.mapInArrow(lambda it, p=p: _counted(it, p, passes), "g long, n long")
        parts.append(staged(counts.groupBy("g").agg(F.sum("n").alias("n")), "pairs"))
    discard(symbols)
    pairs = reduce(DataFrame.unionAll, parts)
    cuts = _cuts(pairs, "n")
    before, word = F.shiftrightunsigned("g", 32).alias("w"), F.col("g").bitwiseAND(F.lit(WORD)).alias("w")
    contexts = staged(pairs.groupBy(before).agg(F.sum("n").alias("total"), F.sum(_less("n", cuts)).alias("less")), "contexts")
    ends = staged(pairs.groupBy(word).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")), "ends")
    cut = _cuts(ends, "kinds")
    kinds, less, size = ends.agg(F.sum("kinds"), F.sum(_less("kinds", cut)), F.count("*")).first()
    unknown = (less or 1) / (kinds or 1) / (size + 1)
    chance = (F.col("kinds") - _less("kinds", cut)) / (kinds or 1) + unknown
    words = contexts.join(ends, "w", "full").select(
        "w",
        F.coalesce("n", "total").alias("n"),
        F.col("less").cast("float").alias("less"),
        chance.cast("float").alias("chance"),
        (F.coalesce(F.log2(chance / unknown), F.lit(0.0)) + F.coalesce(F.log2(F.col("less") / F.col("total")), F.lit(0.0))).alias("gain"),
    )
    words = staged(words, "words")
    discard(contexts, ends)
    model = []
    for p, part in enumerate(parts):
        first = words.where("less is not null").select(F.col("w").alias("_a"), "less")
        second = words.where("chance is not null").select(F.col("w").alias("_b"), "chance")
        known = part.withColumns({"_a": before, "_b": word}).join(first, "_a").join(second, "_b")
        saved = F.log2(1 + (F.col("n") - _less("n", cuts)) / (F.col("less").cast("double") * F.col("chance")))
        mine = words.where(F.col("w") % passes == p).select(F.col("w").alias("g"), "n", F.col("gain").cast("float"))
        model.append(staged(known.select("g", "n", saved.cast("float").alias("gain")).unionAll(mine), "model"))
        discard(part)
    discard(words)
    return model, -math.log2(unknown)


def _named(g: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Another 64-bit name for each n-gram, one to one and spread evenly, and its shard, which grows with the name."""
    h = H.mix(g.view(np.uint64))
    return h, ((h >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)).astype(np.int32)


def _order(h: np.ndarray) -> np.ndarray:
    """Places in the order of h, equal ones in their own: values made of h's upper bits and places are sorted, which is much
    faster than sorting places; where different names agree in those bits the places are sorted."""
    low = np.uint64(max(1, len(h)).bit_length())
    mixed = (h >> low << low) | np.arange(len(h), dtype=np.uint64)
    mixed.sort()
    order = (mixed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    ordered = h[order]
    return order if (ordered[1:] >= ordered[:-1]).all() else np.argsort(h, kind="stable")


def _narrow(x: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes each as the largest needs; their count tells how many that are."""
    return x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8).tobytes()


def _wide(cell, count: int) -> np.ndarray:
    return np.frombuffer(cell, f"u{len(cell) // count}") if count else np.zeros(0, np.uint8)


def _cells(shard: np.ndarray, kind: int, columns: list[np.ndarray], key: np.ndarray | None = None) -> pa.RecordBatch:
    """One row per shard with its stretch of the columns, which are sorted by shard.

    columns: names, counts, and of the model gains, of the texts places in key, which is kept as far as used.
    """
    new = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.zeros(0, np.int64)
    rows = []
    for a, b in zip(new, np.append(new[1:], len(shard)), strict=True):
        g, n, x = (c[a:b] for c in columns)
        doc = b""
        if key is not None:
            used = np.zeros(len(key), bool)
            used[x] = True
            doc, x = _narrow((np.cumsum(used) - 1)[x]), key[used]
        rows.append((int(shard[a]), kind, g.tobytes(), doc, _narrow(n), x.tobytes()))
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    lists = list(zip(*rows, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(lists, kinds, strict=True)], ["shard", "kind", "g", "doc", "n", "x"])


def _asked(batches: Iterator[pa.RecordBatch], part: int, parts: int, shards: int) -> Iterator[pa.RecordBatch]:
    """Words and pairs of one part with their counts per text, by shard."""
    for whole in batches:
        for batch in H.pieces(whole, "text"):
            symbols, doc = _symbols(batch)
            pair, at = _pairs(symbols)
            word, two = (np.flatnonzero(_part(g, parts) == part) for g in (symbols, pair))
            # words before pairs, which never are the same: so of equal names the texts are in order
            h, shard = _named(np.concatenate([symbols[word], pair[two]]), shards)
            order = _order(h)
            h, of = h[order], np.concatenate([doc[word], doc[at[two]]])[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (of[1:] != of[:-1])])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(new, len(h)))
            yield _cells(shard[order[new]], 1, [h[new], n, of[new]], np.asarray(batch.column("_k")))


def _held(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """The model's rows by shard."""
    for batch in batches:
        g, n, gain = (np.asarray(batch.column(c)) for c in ("g", "n", "gain"))
        h, shard = _named(g, shards)
        order = _order(h)
        yield _cells(shard[order], 0, [h[order], n[order], gain[order]])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text and shard the sum of count times gain, and that sum without what only the text holds.

    Rows come by shard, the model's first: one shard of the model is held, and one cell of the texts' n-grams.
    """
    now, model, sorted_model = None, [], None
    for batch in batches:
        columns = [batch.column(c) for c in ("g", "doc", "n", "x")]
        for i, (shard, kind) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("kind").to_pylist(), strict=True)):
            cell = [c[i].as_buffer() for c in columns]
            if shard != now:
                now, model, sorted_model = shard, [], None
            g = np.frombuffer(cell[0], np.uint64)
            n = _wide(cell[2], len(g))
            if kind == 0:
                model.append((g.copy(), n.astype(np.int64), np.frombuffer(cell[3], np.float32).copy()))
                continue
            if not model:
                continue
            if sorted_model is None:
                whole = [np.concatenate(c) for c in zip(*model, strict=True)]
                order = np.argsort(whole[0])
                sorted_model = [c[order] for c in whole]
                model = [()]
            known, seen, gain = sorted_model
            doc, key = _wide(cell[1], len(g)), np.frombuffer(cell[3], np.int64)
            at = np.minimum(np.searchsorted(known, g), len(known) - 1)
            saved = np.where(known[at] == g, gain[at].astype(np.float64) * n, 0.0)
            shared = np.where(seen[at] > n, saved, 0.0)
            sums = [np.bincount(doc, x, len(key)) for x in (saved, shared)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, *sums)], ["_k", "saved", "shared"])


def gains(docs: DataFrame, model: list[DataFrame], shards: int) -> DataFrame:
    """(_k, saved, shared): the gains of all words and pairs of docs (_k, text), added up per _k.

    shared leaves out what the model's texts hold no oftener than the document does.
    """
    sums, parts = [], len(model)
    for p, part in enumerate(model):
        held = part.mapInArrow(lambda it: _held(it, shards), CELLS)
        asked = docs.select("_k", "text").mapInArrow(lambda it, p=p: _asked(it, p, parts, shards), CELLS)
        cells = held.unionAll(asked).repartition("shard").sortWithinPartitions("shard", "kind")
        rows = cells.mapInArrow(_joined, "_k long, saved double, shared double")
        sums.append(staged(rows.groupBy("_k").agg(F.sum("saved").alias("saved"), F.sum("shared").alias("shared")), "gains"))
        discard(part)
    return reduce(DataFrame.unionAll, sums).groupBy("_k").agg(F.sum("saved").alias("saved"), F.sum("shared").alias("shared"))


def classify(docs: DataFrame, trusted: DataFrame, quantile: float = 0.995, slack: float = 1.05, prior: int = 100) -> DataFrame:
    """(doc_id, lang, _t1, _t2, n_symbols, perplexity, threshold, accepted) per row of docs (doc_id, text, lang are read).

    trusted: doc_id of trusted documents. A document is accepted up to slack times the `quantile` of perplexity among the
    trusted documents of its language; a language without any takes the quantile over all. n_symbols: words and the text's
    end. Null texts and texts without words have no symbols and the mean perplexity of their language, and are accepted.
    Without trusted documents everything is accepted. Null doc_id: never trusted, scored like any other. Rows that repeat are
    scored each.
    """
    # merged at every size: the ids grow with the corpus, and a plan that changes with them would hide what the texts cost
    wanted = trusted.select("doc_id").where("doc_id is not null")
    ids = wanted.distinct().hint("merge")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")
    # a number per row: rows of one doc_id and text share it, and what is added up for it is theirs together
    keyed = docs.select("doc_id", "text", lang, *text_key(F.col("text")), F.xxhash64("doc_id", "text").alias("_k"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = keyed.mapInArrow(_sized, f"doc_id {kind}, lang string, _t1 long, _t2 long, _k long, n_symbols long")
    rows = staged(rows.join(ids.withColumn("known", F.lit(True)), "doc_id", "left").withColumn("known", F.coalesce("known", F.lit(False))), "rows")
    size = rows.where("known").agg(F.sum("n_symbols")).first()[0] or 0
    passes = max(n for least, n in PASSES if size >= least)
    with settings(docs.sparkSession, BLOOM):
        texts = docs.select("doc_id", "text").join(wanted.hint("merge"), "doc_id", "left_semi")
        symbols = staged(texts.select("text").mapInArrow(_worded, "s binary"), "symbols")
    model, unknown = train(symbols, passes)
    total = gains(keyed, model, 17 + 2 * int(size / passes / 8e6))
    total = total.join(rows.groupBy("_k").agg(F.count("*").alias("copies")), "_k")
    saved = F.coalesce(F.when(F.col("known"), F.col("shared")).otherwise(F.col("saved")) / F.col("copies"), F.lit(0.0))
    bits = F.col("n_symbols") * unknown - saved
    scored = staged(rows.join(total, "_k", "left").select("doc_id", "lang", "_t1", "_t2", "n_symbols", "known", bits.alias("bits")), "scored")
    known = scored.where("known")
    mean = known.groupBy("lang").agg((F.sum("bits") / F.sum("n_symbols")).alias("mean"))
    overall = known.agg(F.coalesce(F.sum("bits") / F.sum("n_symbols"), F.lit(6.0))).first()[0] or 6.0
    mean = staged(mean, "means")

    def shrunk(x: DataFrame) -> DataFrame:
        base = F.coalesce("mean", F.lit(overall))
        bits = (F.col("bits") + prior * base) / (F.col("n_symbols") + prior)
        return x.join(mean, "lang", "left").withColumn("perplexity", F.pow(F.lit(2.0), bits))

    limits = shrunk(known).groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 100_000).alias("limit"))
    limits = staged(limits, "limits")
    most = shrunk(known).agg(F.percentile_approx("perplexity", quantile, 100_000)).first()[0]
    limit = F.coalesce(F.col("limit"), F.lit(most).cast("double")) * slack
    out = shrunk(scored).join(limits, "lang", "left").withColumn("threshold", limit)
    accepted = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)) | (F.col("n_symbols") == 0)
    return out.select("doc_id", "lang", "_t1", "_t2", "n_symbols", "perplexity", "threshold", accepted.alias("accepted"))
