"""Main text of pages."""

from __future__ import annotations

import re

from newslens.llm.main_text import extract, main_text
from newslens.llm.tables import table

LONG = "A sentence of the article that is long enough to count. " * 3


def test_marked_article_with_broken_markup():
    page = (
        "<!DOCTYPE html><head><title>T</title><style>p{}</style><script>var t=\"</p><article>\";</script></head>"
        "<body><nav><ul><li><a href='/x'>Menu</a></ul></nav><!-- <p>no</p> --><div class=\"ad\">Buy this"
        "<article><h1>Short &amp; sweet</h1><p><b>One  two.<br><p>It&#39;s\n<i>fin</i>e&nbsp;.</p>"
        "<aside>See also</aside><form><input>Mail</form><div class='comment-list'><p>I agree</p></div>"
        "<p>End</article><footer>&copy; us</footer>"
    )
    assert main_text(page) == "Short & sweet\nOne two.\nIt's fine .\nEnd"


def test_unmarked_page_keeps_what_lies_between_surge_and_dive():
    page = f"<div id='nav'><a href=x>m</a></div><div>tiny</div><div><a href=1>{LONG}</a></div>" \
        f"<p></p><p>{LONG}</p><p>ok</p><p>{LONG}</p><div class='sidebar'>{LONG}</div>"
    clean = LONG.strip()
    assert main_text(page) == f"tiny\n{clean}\nok\n{clean}"


def test_class_names_alone_drop_no_article_text():
    def body(markup):
        return main_text(f"<article><p>{LONG}</p>{markup}<p>{LONG}</p></article>").split("\n")[1:-1]

    clean = LONG.strip()
    assert body(f"<p class='notice'>{LONG}</p>") == [clean]
    assert body("<p id='related-work'>Others did so</p>") == ["Others did so"]
    assert body("<div class='share-price'>It fell</div>") == ["It fell"]
    assert body("<div class='share-buttons'>Like</div>") == body(f"<div class='related'><a href=x>{LONG}</a></div>") == []
    assert body(f"<div class='promo ad'>{LONG}</div>") == body(f"<div class=comment-list><p>{LONG}</div>") == []


def test_surge_and_dive_find_the_same_text_without_the_marks(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    bare = pages.rdd.map(lambda r: (r.page_id, r.url, re.sub(r"<(/?)(article|main)\b([^>]*)>", r"<\1div\3>", r.html or "")))
    stripped = spark.createDataFrame(bare, "page_id long, url string, html string")
    assert sorted(map(tuple, extract(pages).collect())) == sorted(map(tuple, extract(stripped).collect()))


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == ""
    assert main_text("plain") == "plain"
    assert main_text("<p>a < b and c<d</p>") in ("a < b and c<d", "a < b and c")
    assert main_text("<article>" + "<div>" * 3000 + "deep") == "deep"
    assert len(main_text("<article><p>" + "w " * 200000)) == 399999


def test_raw_elements_without_an_end_lose_no_text():
    def body(markup):
        return main_text(f"<article><p>before</p>{markup}<p>after</p></article>")

    both = "before\nafter"
    assert body("<svg viewBox='0 0 1 1' />") == body("<svg/><p></p><svg>no</svg>") == both
    assert body("<datalist><option value=a><option value=b></datalist>") == both
    assert body("<datalist><option>a<OPTION>b</datalist><p></p><select><option>c</option></select>") == both
    assert body("<button class=menu>") == body("<svg><canvas>") == both
    assert body("<script src=a/b/>no()</script>") == body("<iframe src=/x/>no</iframe>") == both
    assert body("<svg-icon>") == both
    assert body("<script>no()") == body("<textarea>no") == "before"
    assert body("<button>" * 100000) == both


def test_query_rows(spark):
    rows = [(1, "u", f"<article>{LONG}</article>"), (1, "u", f"<article>{LONG}</article>"), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "5 AS text", "6 AS n_chars")
    got = sorted(map(tuple, extract(df).collect()), key=repr)
    clean = LONG.strip()
    assert got == sorted([(1, "u", clean, len(clean))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert extract(df.limit(0)).count() == 0
