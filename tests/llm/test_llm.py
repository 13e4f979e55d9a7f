"""The training-data operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelmart.llm import bytehash as H
from parcelmart.llm import packing, suffix_dedup
from parcelmart.llm.decontaminate import leaks, without_leaks
from parcelmart.llm.graph_search import neighbours
from parcelmart.llm.html_text import extract, main_text
from parcelmart.llm.line_dedup import dedup_lines
from parcelmart.llm.near_dup import near_duplicates
from parcelmart.llm.personal_data import KINDS, base_spans, find
from parcelmart.llm.quality import classify
from parcelmart.llm.suffix_dedup import remove_repeats
from parcelmart.llm.toxicity import held_out, score

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, node string, path string, v int"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(n, seed, size=400):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


def documents(spark, texts, schema=DOCS):
    """Texts as a table whose other columns clash with names used inside."""
    rows = [(i, t, "en", "x", "y", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def corpus():
    base = [words(n, n) for n in (60, 90, 200, 30)]
    texts = [" ".join(w) for w in base]
    for k, w in enumerate(base):
        for step in (9, 17, 40):
            copy = list(w)
            copy[step % len(w)] = "changed"
            texts.append(" ".join(copy))
        texts.append("pre " + " ".join(w).upper() if k % 2 else " ".join(w))
    passage = " ".join(words(80, 5))
    texts += [f"{' '.join(words(40, 100 + k, 5000))}\n{passage}\n{' '.join(words(30, 200 + k, 5000))}" for k in range(6)]
    return [*texts, None, "", "   ", "one", "one two three", "ONE two three", "é" * 300, "a " * 3000, passage[:49], passage[:50]]


def shingle_set(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates(spark):
    texts = corpus()
    got = {r.doc_id: r for r in near_duplicates(documents(spark, texts), small=4, block=4, levels=3, held=5).collect()}
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        for a, b in itertools.combinations(range(len(texts)), 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    assert [(got[i].n_shingles, got[i].component_id, got[i].kept) for i in got] == [(len(sets[i]), root[i], root[i] == i) for i in got]
    assert len(got) == len(texts) and len(set(root)) < len(texts) - 10


def test_near_duplicates_of_repeated_and_unnamed_rows(spark):
    text = " ".join(words(30, 1))
    df = spark.createDataFrame([(5, text), (5, text), (5, "other words stand in this row here"), (None, text), (None, None)], "doc_id long, text string")
    got = sorted(((str(r.doc_id), r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert got == [("5", 5, True), ("5", 5, True), ("5", 5, True), ("None", 5, False), ("None", None, True)]
    assert near_duplicates(df.limit(0)).count() == 0


def test_suffix_dedup(spark):
    texts = corpus()
    got = {r.doc_id: r for r in remove_repeats(documents(spark, texts), bucket_bytes=2000).collect()}
    seen: set[bytes] = set()
    for i, text in enumerate(texts):
        b = (text or "").encode()
        gone = bytearray(len(b))
        new = [b[k : k + 50] for k in range(len(b) - 49)]
        for k, s in enumerate(new):
            if s in seen:
                gone[k : k + 50] = b"\1" * 50
        seen.update(new)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        row = got[i]
        spans = (b"\0" + bytes(gone)).count(b"\0\1")
        assert (row.n_bytes, row.n_removed, row.n_spans) == (len(b), sum(gone), spans)
        assert row.kept == kept and row.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert remove_repeats(documents(spark, texts).limit(0)).count() == 0


def without_repeats(texts):
    """Per text (bytes, removed bytes, spans, kept) where 50 bytes that also start in an earlier text go."""
    seen: set[bytes] = set()
    for text in texts:
        b = text.encode()
        new = [b[k : k + 50] for k in range(len(b) - 49)]
        gone = bytearray(len(b))
        for k, s in enumerate(new):
            if s in seen:
                gone[k : k + 50] = b"\1" * 50
        seen.update(new)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        yield len(b), sum(gone), (b"\0" + bytes(gone)).count(b"\0\1"), kept


def in_own_batches(spark, texts, **how):
    """What is left of texts of which each is a batch, so a piece, of its own."""
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "1")
    try:
        rows = sorted(remove_repeats(documents(spark, texts), bucket_bytes=2000, **how).collect())
    finally:
        spark.conf.set(size, before)
    return [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows]


def test_suffix_dedup_of_passages_repeated_in_a_document(spark):
    passage = " ".join(words(60, 5))
    own = [" ".join(words(30, 300 + k, 5000)) for k in range(12)]
    texts = [f"{own[0]} {passage} {own[1]}", own[2], *(f"{own[k]} {passage} {own[k + 1]} {passage} {own[k + 2]} {passage}" for k in (3, 6, 8))]
    texts += [f"{passage[:200]} {own[11]} {passage[:200]} {passage[:200]}"]
    assert in_own_batches(spark, texts) == list(without_repeats(texts))


def test_suffix_dedup_deals_out_hot_anchors(spark):
    texts = [t or "" for t in corpus()]
    assert in_own_batches(spark, texts, hot=2) == list(without_repeats(texts))
    # 400 documents around one phrase: the runs of its anchor do not meet in one bucket
    phrase = " ".join(words(12, 1))
    texts = [f"{' '.join(words(9, k, 50000))} {phrase} {' '.join(words(9, 999 - k % 399, 50000))}" for k in range(400)]
    assert in_own_batches(spark, texts, hot=20) == list(without_repeats(texts))
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.record_batch([ids, pa.array(texts)], names=["doc_id", "text"])
    asked = pa.Table.from_batches(suffix_dedup._anchors(iter([batch]), 1))
    told = suffix_dedup._told(suffix_dedup._shared(asked, 1, 20)).sort_by("doc_id")
    assert told.num_rows == len(texts)
    sent = next(suffix_dedup._texts(iter([batch.append_column("codes", told.column("codes").combine_chunks())]), 1, 64))
    buckets = Counter(r["bucket"] for r in sent.to_pylist() if r["keys"] is not None)
    most = max(len(suffix_dedup._unpack(r["rows"], np.uint32)) for r in sent.to_pylist() if r["keys"] is not None)
    assert len(buckets) == 64 and most < 400


def test_suffix_dedup_keeps_unnamed_rows(spark):
    text = " ".join(words(60, 3))
    df = spark.createDataFrame([(None, text), (1, text), (2, text)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_removed) for r in remove_repeats(df).collect()) == [("1", 0), ("2", len(text)), ("None", 0)]


def test_suffix_dedup_of_ids_with_several_texts(spark):
    one, two, three = (" ".join(words(60, 40 + k)) for k in range(3))
    rows = [(7, one), (7, f"{two} own words {one[:120]}"), (7, one), (7, "short"), (7, None), (-3, three), (-3, f"x {three}"), (None, one)]
    rows += [(9, f"{one} {two}"), (9, f"ab {two[5:]} and {one[9:]} {three}"), (9, one), (8, three[:80]), (1 << 40, f"{two} {three}")]
    rows += [(d, f"{' '.join(words(20, d))} {one[d:]}") for d in (7, 9) for d in range(d * 100, d * 100 + 20)]
    expected = []
    for d, text in rows:
        b = (text or "").encode()
        less = [(t or "").encode() for e, t in rows if d is not None and e is not None and e < d]
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if any(b[k : k + 50] in x for x in less):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        expected.append((str(d), len(b), sum(gone), (b"\0" + bytes(gone)).count(b"\0\1"), kept))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for how in ({}, {"bucket_bytes": 1000}, {"bucket_bytes": 1000, "hot": 2}):
        got = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(df.repartition(4), **how).collect()]
        assert sorted(got) == sorted(expected)


def test_suffix_dedup_deals_out_hot_anchors_of_pieces_with_several_documents(spark):
    texts = [t or "" for t in corpus()]
    random.Random(3).shuffle(texts)
    for parts in (1, 9):
        rows = remove_repeats(documents(spark, texts).repartition(parts), bucket_bytes=2000, hot=2).collect()
        assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sorted(rows)] == list(without_repeats(texts))


def removed_lines(texts, min_words=5):
    spans, first = [], {}
    for d, text in enumerate(texts):
        lines = [(i, x.strip(" ")) for i, x in enumerate((text or "").split("\n")) if x.strip(" ")]
        for k in range(len(lines)):
            n = 0
            for m in range(k, len(lines)):
                n += lines[m][1].count(" ") + 1
                if n >= min_words:
                    content = tuple(x for _, x in lines[k : m + 1])
                    spans.append((d, lines[k][0], lines[m][0], content))
                    first.setdefault(content, (d, lines[k][0]))
                    break
    return {(d, j) for d, a, b, content in spans if first[content] != (d, a) for j in range(a, b + 1)}


def test_line_dedup(spark):
    rnd = random.Random(4)
    pool = [" ".join(words(rnd.choice((1, 2, 3, 9, 30)), k)) for k in range(25)] + ["", " "]
    texts = ["\n".join(rnd.choice(pool) for _ in range(rnd.randrange(12))) for _ in range(60)] + [None, "", "\n\n"]
    gone = removed_lines(texts)
    rows = {r.doc_id: r for r in dedup_lines(documents(spark, texts)).collect()}
    for d, text in enumerate(texts):
        lines = text.split("\n") if text is not None else []
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if (d, i) not in gone)
        assert (rows[d].text, rows[d].n_lines, rows[d].n_removed) == (kept, len(lines), sum(x[0] == d for x in gone))
    assert rows[0].node == "x" and len(gone) > 50
    assert dedup_lines(documents(spark, texts).limit(0)).count() == 0


def test_line_dedup_of_repeated_and_unnamed_rows(spark):
    line = " ".join(words(9, 2))
    df = spark.createDataFrame([(1, line), (1, line), (2, line), (None, line)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_removed) for r in dedup_lines(df).collect()) == [("1", 1), ("1", 1), ("2", 1), ("None", 0)]


def test_leaks(spark):
    items = [(k, " ".join(words(n, 50 + k, 9000))) for k, n in enumerate((15, 30, 30, 59, 3, 20))] + [(6, None), (7, ""), (1, " ".join(words(30, 51, 9000)))]
    texts = []
    for k, (_, item) in enumerate(items[:6]):
        w = item.split()
        edited = [*w[: len(w) // 2], "edited", *w[len(w) // 2 + 1 :]]
        for body in (w, edited, w[:-2], w[: len(w) // 2]):
            texts.append(" ".join([*words(25, 300 + k), *body, *words(20, 400 + k)]))
        texts.append(item.upper())
    texts += [None, "", "word " * 40]
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    expected = {}
    for d, text in enumerate(texts):
        w = (text or "").lower().split()
        for i, item in {k: v for k, v in items if v}.items():
            t = item.split()
            count = lambda x: Counter(tuple(x[k : k + 5]) for k in range(max(1, len(x) - 4))) if x else Counter()
            for s in range(max(1, len(w) - len(t) + 1)):
                a, b = count(w[s : s + len(t)]), count(t)
                both, either = sum((a & b).values()), sum((a | b).values())
                if both and 100 * both >= 75 * either:
                    expected[d, i] = max(expected.get((d, i), (0, 0)), (both / either, -s))
    for size in (500, 2):
        got = {(r.doc_id, r.item_id): (r.similarity, -r.start_word) for r in leaks(docs, bench, slice_items=size).collect()}
        assert got == expected
    assert len(expected) >= 15
    left = {r.doc_id for r in without_leaks(docs, bench, slice_items=2).collect()}
    assert left == set(range(len(texts))) - {d for d, _ in expected}
    assert leaks(docs, bench.limit(0)).count() == 0 and leaks(docs.limit(0), bench).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab 'stlé漢　 \u0085\n\t1,.🙂", max_size=60), max_size=6))
def test_tokens_are_those_of_the_tokenizer(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids, at = packing.encode(*H.flat(pa.array(texts, pa.string())), RANKS)
    assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "a", " b", " ", "  ", "\n", "é", "'s", "<"]), max_size=12).map("".join), max_size=6))
def test_added_tokens_are_those_of_the_tokenizer(texts):
    texts = [*texts, "one<|endoftext|>two <|endoftext|>  three", "<|endof", "text|>", " b ", "  a"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packing._known.clear()
    ids, at = packing.encode(*H.flat(pa.array(texts, pa.string())), RANKS)
    assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in ids


def test_packing(spark):
    texts = [*corpus(), "x y z " * 2000, *(" ".join(words(3 + k % 50, k)) for k in range(300))]
    rows = packing.pack(documents(spark, texts), RANKS, bucket=20).toPandas()
    by_doc = rows.sort_values(["doc_id", "start"]).groupby("doc_id")
    assert len(by_doc) == len(texts)
    for d, part in by_doc:
        ids, _ = packing.encode(*H.flat(pa.array([texts[d]], pa.string())), RANKS)
        assert part.start.tolist() == [0, *part.length.cumsum().tolist()[:-1]] and part.length.sum() == len(ids) + 1 == part.doc_tokens.iloc[0]
    for _, part in rows.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum().tolist()[:-1]] and part.length.sum() <= 1024
    assert sorted(rows.sequence_id.unique()) == list(range(rows.sequence_id.nunique()))
    assert rows.length.sum() / (1024 * rows.sequence_id.nunique()) > 0.9
    assert packing.pack(documents(spark, []), RANKS).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500)))
def test_patterns_place_every_length_once(histogram):
    placed = Counter()
    for pattern, count in packing.shortest_first(histogram, 64):
        assert sum(pattern) <= 64
        for n in pattern:
            placed[n] += count
    assert placed == histogram


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(900, 12)).round(2).tolist()
    points[10] = points[20] = points[0]
    for k in range(30):
        points[600 + k] = points[100]
    rows = [(i, p, "e") for i, p in enumerate(points)] + [(2000, None, "e"), (2100, [0.0] * 12, "e"), (2200, [float("nan")] * 12, "e"), (2300, [1.0, None], "e")]
    got = neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>, edges string"), shard=300).toPandas()
    x = np.array(points)
    hit = 0
    for q in range(0, 900, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((np.arange(900), d)) if i != q][:10]
        part = got[got.query_id == q].sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 11))
        assert np.allclose(part.score, d[part.vec_id], rtol=1e-12, atol=0)
        hit += len(set(best) & set(part.vec_id))
    assert hit >= 0.95 * 90 and set(got.query_id) == set(range(0, 900, 100))
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (100, [1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.vec_id, r.score) for r in neighbours(few).orderBy("query_id", "rank").collect()] == [(0, 100, 0.0), (0, 1, 1.0), (100, 0, 0.0), (100, 1, 1.0)]


RULES = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def by_rules(text):
    out = []
    for k, rule in enumerate(RULES):
        for m in re.finditer(rule, text):
            digits = [int(c) for c in re.sub("[^0-9]", "", m[0])]
            luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")) or k == 2 and not (16 <= len(digits) <= 19 and luhn % 10 == 0):
                continue
            if k == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


@settings(max_examples=400)
@given(st.text(alphabet="a.@-+ 0149(é", max_size=50))
def test_base_spans(text):
    assert base_spans(text) == by_rules(text)


def test_personal_data(spark):
    texts = [f"write mailto: a{k}@b.org today" for k in range(8)] + ["write mailto: nobody@localhost today", "card 4541 2419 8996 1675.", "at 10.0.0.256 or 10.0.0.25", None, ""]
    rows = {r.doc_id: r for r in find(documents(spark, texts)).collect()}
    for d, text in enumerate(texts):
        base = by_rules(text or "")
        written = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert rows[d].base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(filter(None, written.split(","))) <= set(rows[d].spans.split(","))
    assert rows[8].spans == "email:14:30" and rows[8].n_email == 0
    assert find(documents(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("<p></p>", ""),
        ("<nav>m</nav><article><h1>T &amp; x</h1><p><b>One<br>two\n three<p>Of.</article><footer>f</footer>", "T & x\n\nOne two three\n\nOf."),
        ("<main><div class='ad'>buy</div><p>a</p><aside>s</aside><div id=comments><p>c</p></div><form>f</form><p>b</main>", "a\n\nb"),
        ("<script>'</p>'</script><div class=menu>m</div><p>" + "long text " * 20 + "</p><p>Home</p>", ("long text " * 20).strip()),
        ("<article><header><h1>T</h1></header><ul><li>a<li>b</ul></article>", "T\n\na\n\nb"),
    ],
)
def test_html(spark, html, text):
    assert main_text(html or "") == text
    row = extract(spark.createDataFrame([(1, "u", html, "x")], "page_id long, url string, html string, text string")).first()
    assert (row.text, row.n_chars) == (text, len(text))


LONG = ["The parcel left the depot " + f"on day {k} and went along the coast road until it came to the next town. " * 2 for k in range(4)]
LONG = [x.strip() for x in LONG]
VERSE = ["The road was long", "the night was cold", "and nobody came"]


def paragraphs(lines):
    return "".join(f"<p>{x}</p>" for x in lines)


@pytest.mark.parametrize(
    ("html", "lines"),
    [
        # all <article> elements of the page
        (f"<main></main><article>{paragraphs(LONG[:2])}</article><div>x</div><article>{paragraphs(LONG[2:])}</article>", LONG),
        # a small container does not outweigh the text outside it
        (f"<article><p>Teaser</p></article><div>{paragraphs(LONG)}</div>", LONG),
        # short lines within the article, and at its edges
        (f"<div><a>x</a></div><div id=c>{paragraphs(LONG[:2] + VERSE + LONG[2:])}</div><div><p>Links</p><p>Terms</p></div>", [*LONG[:2], *VERSE, *LONG[2:]]),
        (f"<div><h1>Title</h1>{paragraphs([*LONG[:2], 'So it ended.'])}</div>", ["Title", *LONG[:2], "So it ended."]),
        # names are whole class names
        (f"<body><div class='has-sidebar popular-science'>{paragraphs(LONG)}</div><div class='site-footer'>{LONG[0]}</div></body>", LONG),
        (f"<body><div class='left sidebar'>{paragraphs(LONG)}</div><div class='cookie-notice'>{LONG[0]}</div><p>{LONG[1]}</p></body>", LONG[1:2]),
    ],
)
def test_html_by_block_sums(html, lines):
    assert main_text(html) == "\n\n".join(lines)


def test_quality(spark):
    good = [" ".join(words(80, k)) for k in range(40)]
    bad = [" | ".join(f"{w}$$$" for w in words(60, k)) for k in range(10)]
    docs = documents(spark, [*good, *bad, None, ""])
    trusted = spark.createDataFrame([(i,) for i in range(40)], "doc_id long")
    rows = {r.doc_id: r for r in classify(docs, trusted).collect()}
    assert len(rows) == 52 and all(rows[i].accepted for i in [*range(40), 50, 51]) and not any(rows[i].accepted for i in range(40, 50))
    assert all(r.accepted for r in classify(docs, trusted.limit(0)).collect())
    assert classify(docs.limit(0), trusted).count() == 0


def perplexities(texts, trusted, prior=100):
    """Modified Kneser-Ney over words and word pairs, plainly: doc to perplexity; one language."""

    def symbols(text):
        w = (text or "").translate({k: k + 32 for k in range(65, 91)}).split()
        return ["<s>", *w, "</s>"] if w else []

    def cuts(counts):
        n1, n2, n3, n4 = (sum(n == i for n in counts) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        return [min(i, max(0.05, i - (i + 1) * y * b / a)) if a and b else 0.5 * i for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]

    all_pairs = Counter(p for i in trusted for p in itertools.pairwise(symbols(texts[i])))
    all_words = Counter(w for i in trusted for w in symbols(texts[i]))
    kinds = Counter(b for _, b in all_pairs)
    cut, cut_pair = cuts(kinds.values()), cuts(all_pairs.values())
    total, less = Counter(), Counter()
    for (a, _), n in all_pairs.items():
        total[a] += n
        less[a] += cut_pair[min(n, 3) - 1]
    unknown = sum(cut[min(n, 3) - 1] for n in kinds.values()) / len(all_pairs) / (len(kinds) + 1)
    bits, size = {}, {}
    for i, text in enumerate(texts):
        s = symbols(text)
        own_pairs, own_words = Counter(itertools.pairwise(s)), Counter(s)
        bits[i], size[i] = 0.0, max(0, len(s) - 1)
        held = lambda w: all_words[w] > (own_words[w] if i in trusted else 0)  # noqa: B023, E731
        for a, b in itertools.pairwise(s):
            one = (kinds[b] - cut[min(kinds[b], 3) - 1]) / len(all_pairs) + unknown if kinds[b] else unknown
            p = (one if held(b) else unknown) * (less[a] / total[a] if held(a) and total[a] else 1)
            n = all_pairs[a, b]
            if n > (own_pairs[a, b] if i in trusted else 0):
                p *= 1 + (n - cut_pair[min(n, 3) - 1]) / (less[a] * one)
            bits[i] -= np.log2(p)
    mean = sum(bits[i] for i in trusted) / sum(size[i] for i in trusted)
    return {i: 2 ** ((bits[i] + prior * mean) / (size[i] + prior)) for i in bits}


@pytest.mark.parametrize("least", [1_000_000, 0])
def test_quality_is_kneser_ney_of_words(spark, monkeypatch, least):
    from parcelmart.llm import quality

    monkeypatch.setattr(quality, "PASSES", ((0, 1), (least, 3)))
    texts = [" ".join(words(60, k, 40)) for k in range(30)]
    texts += [texts[3], " ".join(sorted(texts[4].split())), "W1 w2\tw3\n\x0bé", "new words only", "w1", "w1 w1 " * 50, None, "", " \n"]
    trusted = [*range(30), 32, 36]
    want = perplexities(texts, trusted)
    rows = classify(documents(spark, texts), spark.createDataFrame([(i,) for i in [*trusted, *trusted, None]], "doc_id long")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.perplexity == pytest.approx(want[r.doc_id], rel=1e-4), texts[r.doc_id]
        assert r.n_symbols == (len(texts[r.doc_id].split()) + 1 if (texts[r.doc_id] or "").split() else 0)


def test_quality_looks_at_the_order_of_words(spark):
    lines = [words(12, k, 3000) for k in range(40)]
    rnd = random.Random(5)
    texts = [" ".join(w for line in rnd.choices(lines, k=8) for w in line) for _ in range(80)]
    for k in range(10):
        w = texts[k].split()
        rnd.shuffle(w)
        texts.append(" ".join(w))
    docs = documents(spark, texts)
    twice = docs.unionAll(docs.where("doc_id in (0, 80)"))
    rows = classify(twice, docs.where("doc_id < 60").select("doc_id"), prior=10).collect()
    assert Counter(r.doc_id for r in rows) == Counter([*range(90), 0, 80])
    assert len({(r.doc_id, r.accepted, round(r.perplexity, 6)) for r in rows}) == 90
    assert all(r.accepted == (r.doc_id < 80) for r in rows)


def test_quality_cells_are_narrow_and_in_order():
    import pyarrow as pa

    from parcelmart.llm import quality

    h = np.array([5 << 40 | 7, 5 << 40, 9 << 50, 5 << 40 | 7, 5 << 40], np.uint64)
    assert quality._order(h).tolist() == [1, 4, 0, 3, 2]
    assert quality._order(h[:0]).tolist() == []
    texts = [" ".join(words(40, k, 50)) for k in range(6)] + ["w1 " * 300, "W1", None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], ["text", "_k"])
    seen = Counter()
    for part in range(3):
        for cell in pa.Table.from_batches(quality._asked(iter([batch]), part, 3, 5)).to_pylist():
            h, n = np.frombuffer(cell["g"], np.uint64), quality._wide(cell["n"], len(cell["g"]) // 8)
            key, doc = np.frombuffer(cell["x"], np.int64), np.frombuffer(cell["doc"], np.uint8)
            assert len(doc) == len(h) and (h[1:] >= h[:-1]).all() and (n.itemsize == 1 or n.max() > 255)
            for name, i, count in zip(h.tolist(), key[doc].tolist(), n.tolist(), strict=True):
                assert (name, i) not in seen
                seen[name, i] = count
    for i, text in enumerate(texts):
        w = (text or "").lower().split()
        w = ["<s>", *w, "</s>"] if w else []
        want = [*Counter(w).values(), *Counter(itertools.pairwise(w)).values()]
        assert sorted(want) == sorted(n for (_, j), n in seen.items() if j == i)


def test_toxicity(spark):
    rnd = random.Random(1)
    texts, toxic = [], []
    for k in range(600):
        w = words(40, k, 60)
        toxic.append(int(k % 3 == 0))
        if toxic[-1]:
            w[rnd.randrange(40)] = rnd.choice(["horrible", "dreadful"])
        if k % (2 if toxic[-1] else 9) == 0:
            w[rnd.randrange(40)] = rnd.choice(["muslim", "christian", "hindu"])
        texts.append(" ".join(w))
    texts += ["a muslim neighbour", "a christian neighbour", None]
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    rows = {r.doc_id: r for r in score(documents(spark, texts), labels).collect()}
    held = [i for i in range(600) if held_out(i)]
    assert all(rows[i].held_out == held_out(i) for i in rows)
    assert sum(rows[i].predicted == toxic[i] for i in held) >= 0.95 * len(held)
    assert abs(rows[600].score - rows[601].score) < 0.1 and rows[600].predicted == rows[601].predicted == 0
    assert 0 <= rows[602].score <= 1


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    texts = [*corpus(), *(" ".join(words(100, 900 + k, 3000)) for k in range(20))]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, " ".join(texts[-1].split()[20:60]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, str(tmp_path))
        assert left.columns == docs.columns
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert len(texts) - 1 not in set(got.doc_id) and len(texts) - 2 in set(got.doc_id)


def test_quality_stage_is_kneser_ney_of_words(spark, tmp_path):
    import corpus_pipeline

    lines = [words(12, 60 + k, 3000) for k in range(40)]
    rnd = random.Random(7)
    texts = [" ".join(w for line in rnd.choices(lines, k=60) for w in line) for _ in range(30)]
    for k in range(8):
        w = texts[k].split()
        rnd.shuffle(w)
        texts.append(" ".join(w))
    texts += ["w1 w1 " * 300, "new words only " * 200, "w1 w2", None, "", " \n"]
    trusted = range(24)
    size = perplexities(texts, trusted)
    limit = 1.05 * max(size[i] for i in trusted)
    assert all(abs(size[i] / limit - 1) > 1e-3 for i in size)
    want = {i for i in size if size[i] <= limit or not (texts[i] or "").split()}
    assert want.issuperset(range(30)) and not want.intersection(range(30, 38))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, texts[0], "en", "s", 1), (None, texts[30], "en", "s", 1), rows[3], rows[31]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = [*((i, 1, 0) for i in trusted), *((i, 0, 0) for i in range(24, 36)), (36, None, 0), (None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert Counter(map(tuple, left.collect())) == Counter(r for r in rows if r[0] in want or r[1] == texts[0])


def test_near_dup_stage_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    a, b, c = (" ".join(words(80, 700 + k, 3000)) for k in range(3))
    near = a.rsplit(" ", 1)[0] + " changed"
    rows = [(1, a, "x"), (1, a, "x"), (1, near, "x"), (2, a, "x"), (1, b, "x"), (None, c, "y"), (None, c, "x"), (None, f"{c} more", "x")]
    rows += [(-1, "one word", "x"), (None, "one word", "x"), (5, "", "x"), (5, None, "x"), (None, " \n", "x"), (None, " \n", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = corpus_pipeline.near_dup(spark, docs, "")
    assert left.columns == docs.columns
    got = Counter("a" if r.text in (a, near) else "c" if r.text and r.text.startswith(c) else (r.doc_id, r.text) for r in left.collect())
    assert got == Counter(["a", (1, b), "c", (-1, "one word"), (5, ""), (5, None), (None, " \n"), (None, " \n")])


def test_native_operator_has_no_python():
    source = Path(__file__).parents[2].joinpath("parcelmart/llm/line_dedup.py").read_text()
    assert not re.search(r"mapIn|applyIn|udf|pandas|\.rdd", source)
