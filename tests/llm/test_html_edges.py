"""Malformed and extreme pages."""

from __future__ import annotations

import time

import pytest

from parcelmart.llm.html_text import extract, main_text

WORDS = "The river rose slowly through the night and by morning it had reached the lower gardens of the town. "


@pytest.mark.parametrize(
    "odd",
    ["<![foo[x]]>", "<![ x>", "<!x y>", "<![]]>", "<![if !IE]>", "<![endif]>", "<!>", "<!-->", "<?php echo 1 ?>", "<!DOCTYPE", "</>", "</ p>", "<![CDATA[x]]>"],
)
def test_odd_declarations(odd):
    text = main_text(f"<html><body><p>{WORDS * 2}</p>{odd}<p>{WORDS * 3}</p></body></html>")
    assert text.startswith((WORDS * 2).strip())
    assert "river" in main_text(f"<p>{WORDS * 3}</p>{odd}")


@pytest.mark.parametrize("cut", ["<![ x", "<![foo[x", "<!", "<![", "<a href='", "&#x", "<!--"])
def test_pages_that_end_within_markup(cut):
    assert "reached the lower gardens" in main_text(f"<p>{WORDS * 3}</p>{cut}")


@pytest.mark.parametrize("page", ["<span>" * 100_000 + "</b><p>" * 1000, "<div>" * 100_000 + "</i>" * 100_000, "<article>x</article>" * 20_000, "<p><b>" * 50_000])
def test_open_elements_cost_no_more_each(page):
    began = time.process_time()
    main_text(f"{page}<p>{WORDS * 3}</p>")
    assert time.process_time() - began < 4


def test_rows(spark):
    rows = [(1, "u", f"<p>{WORDS * 3}</p>", 5), (1, "u", f"<p>{WORDS * 3}</p>", 5), (None, None, None, None), (2, "v", "", 1), (3, "w", f"<p>{WORDS * 20_000}</p><![x[", 2)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text long")).collect()
    whole = (WORDS * 3).strip()
    assert sorted((str(r.page_id), r.n_chars, r.text[:100]) for r in got) == sorted(
        [("1", len(whole), whole[:100])] * 2 + [("None", 0, ""), ("2", 0, ""), ("3", len(WORDS) * 20_000 - 1, whole[:100])]
    )
