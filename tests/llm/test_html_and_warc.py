"""Operators 6 and 9: pages with planted layouts, WARC round trips."""

import hashlib
import html
import re

from tidemark.llm import warc
from tidemark.llm.common import read, scratch
from tidemark.llm.html_extract import extract, main_text

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="has-sidebar">
<header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy now</div>
<div id="main-wrap"><article><h1>Title &amp; more</h1><p>First   <b>par</b>a<i>graph</i>&nbsp;here.<br>Next line<p>Second &lt;one&gt; &#233; &copy;
<div class="advert-box"><p>Ad inside</p></div><p>Short.</p><blockquote>Quote</blockquote><form><input><label>Mail</label></form>
<section class="comments"><p>Reader says</p></section></article></div>
<aside>Side</aside><!-- <p>hidden</p> --><div class="sidebar">More</div><footer>&copy; foot</footer></body>"""


def test_labelled_article():
    assert main_text(FULL) == "Title & more First paragraph here. Next line Second <one> é © Short. Quote"


def test_unlabelled_page_by_line_blocks():
    body = "".join(f"<div>Paragraph {i} holds a good deal of running text, as an article does, and goes on.</div>" for i in range(6))
    page = "<body><ul>" + "".join(f"<li><a href='#'>Menu {i}</a></li>" for i in range(8)) + f"</ul>{body}<ul>" + "".join(
        f"<li><a href='#'>Link {i}</a></li>" for i in range(8)) + "</ul></body>"
    assert main_text(page) == " ".join(re.findall(r"<div>(.*?)</div>", body))


def test_labels_and_unclosed_boilerplate():
    long = "A paragraph of running text that says a number of things at some length."
    assert main_text(f"<div class=menu-bar>Menu</div><div class='post-content'><h2>Head</h2><p>{long}<p>End.</div><div>Other</div>") == f"Head {long} End."
    assert main_text(f"<div class=content>Box</div><p>{long}<p>{long}") == f"Box {long} {long}"    # the label holds too little
    assert main_text(f"<div class='ad'>Buy<article><p>{long}</p></article>") == long
    assert main_text(f"<div class='related'><article>Teaser</article></div><article>{long}</article>") == long


def test_broken_and_empty_pages(spark):
    cases = {None: "", "": "", "<p>": "", "plain < text &amp": "", "<article>open <b>never closed": "open never closed",
             "<article><a title=\"x>y'>link</a> tail": "y'>link tail", "<article>a<script>never ends": "a", "<article>a<!-- never ends": "a",
             "<article></article><nav>x</nav>": "", "<main><p>in main</p></main><p>out</p>": "in main",
             "<ARTICLE><P>Upper</P></ARTICLE>": "Upper", "<article>" + "x" * 300_000 + "</article>": "x" * 300_000}
    pages = spark.createDataFrame([(i, None, h, "z", 3) for i, h in enumerate(cases)] + [(0, "u", None, "z", 3)],
                                  "page_id long, url string, html string, text string, n_chars long")
    got = sorted((r.page_id, r.text, r.n_chars) for r in extract(pages).collect())
    assert got == sorted([(i, t, len(t)) for i, t in enumerate(cases.values())] + [(0, "", 0)])
    assert extract(pages.limit(0)).collect() == []


def test_articles_of_the_pages(spark, sf_small):
    for r in read(spark, sf_small, "pages").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", inner)).split())
        assert main_text(r.html) == want


PAGES = "page_id long, url string, html string, size long, digest string, archive string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, 9, "z", "q") for r in rows], PAGES)


def test_round_trip_equals_plain_restatement(spark):
    same, other = "é" * 80, "y" * 120
    rows = [(5, "http://a", same), (3, "http://b", same), (9, None, same), (1, "http://c", "s" * 99), (2, "x\r\ny: z", "s" * 99), (4, "u", None),
            (6, "u", ""), (7, "u", other), (7, "u", other), (8, "v", other), (None, "w", other), (10, "k", "z\r\n\r\nWARC/1.1\r\n" * 20), (11, "m", "漢" * 200_000)]
    back = sorted(map(tuple, warc.round_trip(spark, pages_of(spark, rows)).select(
        "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload").collect()), key=str)
    want = []
    for i, u, h in rows:
        data = (h or "").encode()
        first = min(j for j, _, x in rows if x == h and j is not None) if len(data) >= 100 else i
        kind = "response" if i == first else "revisit"
        want.append((i, u, len(data), hashlib.sha256(data).hexdigest(), kind, None if kind == "response" else first,
                     bytearray(data) if kind == "response" else None))
    assert back == sorted(want, key=str)


def test_selected_records_are_read_in_coalesced_ranges(spark, monkeypatch):
    folder = scratch(spark, "warc-test")
    rows = [(i, f"u{i}", hashlib.sha256(str(i).encode()).hexdigest() * 20) for i in range(400)]
    index = warc.write_archives(warc.classify(pages_of(spark, rows)).repartition(2), folder)
    assert index.select("archive").distinct().count() == 2
    some = warc.read_records(index.where("page_id % 7 = 0"), folder).select("page_id", "payload").collect()
    assert {r.page_id: bytes(r.payload).decode() for r in some} == {i: h for i, _, h in rows if i % 7 == 0}
    ordered = [r.asDict() for r in index.orderBy("archive", "offset").collect()]
    assert len(list(warc.coalesced(iter(ordered)))) == 2
    monkeypatch.setattr(warc, "GAP_BYTES", 0)
    assert [len(x) for x in warc.coalesced(iter(ordered[::2]))] == [1] * 200


def test_empty_archive(spark):
    assert warc.round_trip(spark, pages_of(spark, [])).collect() == []
