import hashlib
import html
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from corpusloom.llm import html_text as ht, winnow as wn
from llm_data import DOCUMENT, edge_rows, text_of

PARAGRAPHS = ["First, a paragraph of some length, with commas, that stands in the article & more. " * 2,
              "The second one has a <b>bold</b> word and a <a href='/x'>link</a>, and goes on for a while, too. " * 2]


def page(body, title="Title"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


def want(*blocks):
    return "\n".join(re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in blocks)


AROUND = [
    "<nav><ul><li><a href='/a'>Home, sweet, home</a></li></ul></nav>", "<header><p>Site, header, text</p></header>",
    "<div class='ad'>Buy, now, and, save, a, lot, of, money, today, for, sure</div>", "<aside><p>Side, bar, words</p></aside>",
    "<div id='cookie-notice'><p>We, use, cookies, to, do, things.</p></div>", "<form><p>Sign, up</p><input name='q'></form>",
    "<footer>&copy; somebody, somewhere</footer>", "<!-- ad <p>no</p> -->", "<noscript><p>Turn on scripts, please</p></noscript>",
    "<section class='comments'><p>I, a reader, think, that, this, is, long, enough, to, count.</p></section>",
    "<div style='display:none'><p>hidden, text, here</p></div>", "<ul class='menu'><li><a href='/b'>Other, page</a></li></ul>",
]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>", "<div>{}</div>"])
def test_article_without_what_surrounds_it(wrap):
    body = "<h1>Heading</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    got = ht.main_text(page("".join(AROUND[:3]) + wrap.format(body) + "".join(AROUND[3:])))
    assert got == want("Heading", *PARAGRAPHS)


def test_markup_that_is_left_open():
    got = ht.main_text("<article><h1>T</h1><p><b>One, two&amp;three<br>four<p>Five  six\n seven</article><footer>no</footer>")
    assert got == "T\nOne, two&three four\nFive six seven"


def test_character_references_and_bare_signs():
    got = ht.main_text("<article><p>a &lt; b &#233;&eacute; &nbsp; 1 < 2 &unknown; x&#x1F600;</p></article>")
    assert got == "a < b éé 1 < 2 &unknown; x\U0001f600"


def test_test_pages(pages):
    rows = {r.page_id: r for r in ht.page_texts(pages).collect()}
    assert len(rows) == pages.count()
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [want(b) for b in re.split(r"</?(?:p|h1)>", article)]
        assert rows[r.page_id].text == "\n".join(b for b in blocks if b)
        assert rows[r.page_id].n_chars == len(rows[r.page_id].text)


def test_html_edges(spark):
    deep = "<div>" * 3000 + "<p>" + "deep, text, " * 20 + "</p>" + "</div>" * 3000
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain text"), (3, "u", "<p>"), (4, "u", deep), (4, "u", deep),
            (5, "u", "<a href='x'>only, links, here</a>"), (6, "u", "<script>never closed"), (7, "u", "</p></div>"),
            (8, "u", "<article>" + "<p>" + "w, " * 30000 + "</p></article>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "9 as text", "8 as n_chars")
    got = ht.extract(frame).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[1].text == "" == by_id[2].text == by_id[3].text == by_id[6].text == by_id[7].text
    assert by_id[None].text == "plain text" and by_id[4].text.startswith("deep, text") and by_id[8].n_chars > 80000
    assert ht.page_texts(frame.limit(0)).count() == 0


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="<>/ap\"'=!-& divx", max_size=60))
def test_any_markup_parses(text):
    assert "\n\n" not in ht.main_text(text)


def slow_winnow(points, gram, window):
    """Chosen positions by looking at every window."""
    n = len(points)
    if not n:
        return []
    hashes = [int(wn.gram_hashes(points[k : k + min(gram, n)], gram)[0]) for k in range(n - min(gram, n) + 1)]
    reach, out = min(window, len(hashes)), []
    for k in range(len(hashes) - reach + 1):
        part = hashes[k : k + reach]
        at = k + max(i for i, h in enumerate(part) if h == min(part))
        if not out or out[-1] != at:
            out.append(at)
    return out


@settings(deadline=None, max_examples=100)
@given(st.text(alphabet="ab é\U0001f600", max_size=60))
def test_rightmost_least_of_every_window(text):
    points = wn._points(text)
    hashes, at = wn.winnow(points, 4, 5)
    assert at.tolist() == slow_winnow(points, 4, 5)
    assert len(hashes) == len(at)


def test_shared_stretch_is_found():
    shared = text_of(5, 40)[: wn.GRAM + wn.WINDOW - 1]
    a, b = (wn.winnow(wn._points(text_of(k, 200) + shared + text_of(k + 1, 200)))[0] for k in (10, 20))
    assert set(a.tolist()) & set(b.tolist())


@pytest.mark.parametrize("parts", [1, 4])
def test_edited_and_next_texts(spark, parts):
    rows = [r for r in edge_rows() if r[0] != 5] + [(k, text_of(k // 2, 50), "en", "s", 1) for k in range(20, 60)]
    frame = spark.createDataFrame(rows, DOCUMENT).repartition(3)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.doc_id: r for r in wn.edited_fingerprints(frame).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    order = sorted(rows, key=lambda r: -(10**9) if r[0] is None else r[0], reverse=True)
    assert len(got) == len(rows)
    for k, (key, text, *_) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        r = got[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        prints = [wn.fingerprint(wn._points(t)) for t in (text, edited, following)]
        assert (r.fingerprint, r.edited_fingerprint) == (wn.written(prints[0]), wn.written(prints[1]))
        assert r.near_edited == wn.likeness(prints[0], prints[1]) and r.near_next == wn.likeness(prints[0], prints[2])
        if text == following:
            assert r.near_next == 1.0


def test_winnow_edges(spark, edge, nothing):
    assert wn.edited_fingerprints(nothing).count() == 0
    assert wn.edited_fingerprints(edge).count() == edge.count()
    one = spark.createDataFrame([(1, "alone", None, None, None)], DOCUMENT)
    assert wn.edited_fingerprints(one).first().near_next == 1.0
    rows = wn.fingerprints(edge).collect()
    assert len(rows) == edge.count() and {len(r.hashes) for r in rows if r.doc_id in (1, 2)} == {0}
    assert len(rows[0].hashes) == len(rows[0].positions)
    assert np.array_equal(wn.gram_hashes(wn._points("x" * 40))[:5], np.repeat(wn.gram_hashes(wn._points("x" * 12)), 5))


@pytest.mark.parametrize("tag", ['<p class="x"">', '<div class="post"">', "<p title=it's>", '<p data-a="b"c"d">', "<p title = 'a>b'>"])
def test_stray_quotes_in_tags_lose_nothing(tag):
    """A quote opens a value only after its sign; elsewhere it is a character of the tag."""
    text = "A long sentence of words, with commas, and more words to count as text. " * 6
    page = f"<html><body><nav><a href='/'>Home</a></nav><div id=main>{tag}{text}</p><p>{text}</p></div><footer>x</footer></body></html>"
    assert ht.main_text(page) == "\n".join([text.strip()] * 2)


def test_end_tags_of_nothing_open_are_cheap():
    start = time.perf_counter()
    ht.parse("<b>" * 50_000 + "</i>" * 50_000)
    assert time.perf_counter() - start < 5
