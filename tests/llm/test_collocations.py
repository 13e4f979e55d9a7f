"""Collocations against plain counting of all runs of words."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from parcelmart.llm.collocations import collocations

SCHEMA = "doc_id long, text string, lang string, chunk long, id string, phrase string"


def expected(rows, least=30, longest=4, top=2000, covered=80):
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        gone = {q for p, c in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * c >= covered * f[q := p[i:j]]}
        rows = []
        for p, a in often.items():
            if p not in gone:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def corpus():
    rnd = random.Random(2)
    said = ["New York City", "new york", "the Quick brown fox jumps", "of the", "in spite of", "café au lait", "Été DE", "a a a a a a", " x y"]
    texts = []
    for k in range(900):
        words = []
        for _ in range(rnd.randrange(1, 14)):
            words.append(rnd.choice(said) if rnd.random() < 0.5 else f"w{int(rnd.paretovariate(0.7))}")
        text = "".join(w + rnd.choice([" ", "  ", "\t", " ", " ", ", ", ". ", "\n", "!", " ; "]) for w in words)
        texts.append((text, rnd.choice(["en", "en", "en", "fr", None, "und", ""])))
    return [*texts, *[("shared passage of many words", "en")] * 50, (None, "en"), ("", "de"), (" \t\n..", "de"), ("a b " * 30_000, "es"), ("one two", "xx")]


@pytest.mark.parametrize(("least", "longest", "limit"), [(30, 4, 8 << 20), (5, 4, 300), (3, 2, 2000), (4, 6, 1000)])
def test_phrases(spark, least, longest, limit):
    rows = corpus()
    df = spark.createDataFrame([(i, t, x, 1, "x", "y") for i, (t, x) in enumerate(rows)], SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in collocations(df, least=least, longest=longest, limit=limit).collect())
    assert got == expected(rows, least, longest)
    assert len(got) > 20


def test_top_and_empty(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, x, 1, "x", "y") for i, (t, x) in enumerate(rows)], SCHEMA)
    assert sorted(tuple(r) for r in collocations(df, top=5, least=5).collect()) == expected(rows, 5, top=5)
    assert collocations(df.limit(0)).count() == 0
    assert collocations(df.where("lang = 'xx'")).count() == 0
