"""Operator 6: pages whose labels hold less, or other, than their main text, and pages without labels."""

import random
import re
import time

from tidemark.llm import html_extract as H
from tidemark.llm.html_extract import main_text

TEXT = [f"Paragraph {i} holds a good deal of running text, as an article does, and goes on for a while." for i in range(6)]
BODY = "".join(f"<p>{t}</p>" for t in TEXT)
TEASER = "<div class='card'><article>Read this other story</article></div>"


def test_teaser_beside_the_main_text():
    want = " ".join(TEXT)
    assert main_text(f"<body><main><h1>Head</h1>{BODY}</main>{TEASER}</body>") == f"Head {want}"
    assert main_text(f"<body><div class='post-content'>{BODY}</div>{TEASER}</body>") == want
    assert want in main_text(f"<body><div>{BODY}</div>{TEASER}</body>")
    assert want in main_text(f"<body>{TEASER}<main>Skip</main><div>{BODY}</div></body>")


def test_headings_and_lead_of_the_main_element():
    want = " ".join(TEXT)
    assert main_text(f"<body><div>Out</div><main><h1>Head</h1><p>Lead.</p><article>{BODY}</article></main><div>Out</div></body>") == f"Head Lead. {want}"
    assert main_text(f"<body><main>Other</main><article>{BODY}</article></body>") == want


def test_unlabelled_region_keeps_its_lines():
    links = "".join(f"<li><a href='#'>Link {i}</a></li>" for i in range(4))
    linked = "<div><a href='#'>A sentence of the article that is a link as a whole</a></div>"
    body = "".join(f"<div>{t}</div>" for t in TEXT[:3]) + linked + "".join(f"<div>{t}</div>" for t in TEXT[3:])
    want = " ".join([*TEXT[:3], "A sentence of the article that is a link as a whole", *TEXT[3:]])
    assert main_text(f"<body><ul>{links}</ul>{body}<ul>{links}</ul></body>") == want
    last = "A last section after some links, much shorter than the article above, that belongs to it still."
    assert len(last) < 0.2 * len(want)
    assert main_text(f"<body>{body}<ul>{links}</ul><div>{last}</div><ul>{links}</ul></body>") == f"{want} {last}"


def test_short_unlabelled_page():
    assert main_text("<body><ul><li><a href='#'>Home</a></li></ul><h1>News</h1><p>It rained.</p></body>") == "News It rained."
    assert main_text("<body><ul><li><a href='#'>Home</a></li></ul></body>") == ""


def test_region_of_links_is_left_out():
    menu = "".join(f"<div>{'x' * 9} <a href='#'>{'A link with a long name ' * 2}</a></div><div>{'Some words of ' * 3}</div>"
                   f"<div><a href='#'>{'Another link with a long name ' * 3}</a></div>" for _ in range(4))
    blank = "<ul>" + "<li><a href='#'>Home</a></li>" * 4 + "</ul>"
    body = "".join(f"<div>{t}</div>" for t in TEXT)
    assert main_text(f"<body>{menu}{blank}{body}</body>") == " ".join(TEXT)


def test_blocks_that_only_sound_like_boilerplate():
    want = " ".join(TEXT)
    board = "The board of the village put up this notice in the year that the story tells of, and nobody read it."
    for inner in (f"<p class='notice-board'>{board}</p>", f"<section class='social-history'><p>{board}</p><p>{board}</p></section>",
                  f"<fieldset><legend>Box</legend><p>{board}</p></fieldset>"):
        text = re.sub("<[^>]*>", " ", inner)
        assert main_text(f"<body><article>{BODY}{inner}{BODY}</article></body>") == " ".join(f"{want} {text} {want}".split())
        if "Box" not in text:      # outside of an article, short lines tell a box from text
            assert " ".join(text.split()) in main_text(f"<body><div>{BODY}{inner}{BODY}</div></body>")
    links = "<li><a href='#'>More of this</a></li>" * 5
    assert main_text(f"<body><article>{BODY}<div class='related-stories'><ul>{links}</ul></div>{BODY}</article></body>") == f"{want} {want}"
    assert main_text(f"<body><div class='cookie-law-info'>We use cookies</div><div>{BODY}</div></body>") == want
    assert main_text(f"<body><article>{BODY}<form><fieldset>{board}</fieldset></form></article></body>") == want
    assert main_text(f"<body><article>{BODY}<div class='ad-box-2'>{board}</div><ul class='comment-list'><li>{board}</li></ul></article></body>") == want


def test_inline_advert_and_copyright_line():
    want = " ".join(TEXT)
    assert main_text(f"<article><p>The wor<span class='ad'>Buy</span>ld.</p>{BODY}</article>") == f"The world. {want}"
    assert main_text(f"<article><p>The <span class='ad'>Buy<div class='nav'>Home</div></span>end</p>{BODY}</article>") == f"The end {want}"
    for last in ("Copyright 2020", "© 2021 Example Inc.", "Copyright (c) 1999-2004 by us", "All rights reserved."):
        assert main_text(f"<body><div>{BODY}</div><div>{last}</div></body>") == want
    assert main_text(f"<body><div>{BODY}<p>Copyright law changed.</p></div></body>") == f"{want} Copyright law changed."


def test_labels_are_a_weight():
    """More text outside of the label, more of it counts: no share at which the label alone decides."""
    side = "<div>Some other text that nobody labelled, of a fair length, is found beside it on the page as well.</div>"
    for n in (0, 1, 30):
        got = main_text(f"<body><article>{BODY}</article>{'<hr><ul><li><a href=#>x</a></li></ul>' * 4}{side * n}</body>")
        assert (got == " ".join(TEXT)) == (n < 30) and got.startswith(" ".join(TEXT))
    few = "".join(f"<p>{w}</p>" for w in ("Short.", "Lines.", "Only."))
    assert main_text(f"<body><article>{few}</article></body>") == "Short. Lines. Only."


def plain_regions(weights, least):
    """Lines of weight at most WINDOW apart are one region; it counts if one of its windows is heavy enough."""
    n = len(weights)
    window = [sum(weights[i:i + H.WINDOW]) for i in range(n)]
    surge = max(least, min(H.SURGE_CHARS, max(window, default=0)), 1)
    runs = []
    for i in range(n):
        if weights[i]:
            if runs and i - runs[-1][-1] <= H.WINDOW:
                runs[-1].append(i)
            else:
                runs.append([i])
    return [(r[0], r[-1] + 1) for r in runs if max(window[r[0]:r[-1] + 1]) >= surge]


def test_window_path_against_its_definition():
    rng = random.Random(4)
    for _ in range(5000):
        weights = [rng.choice([0, 0, 0, 0, 5, 30, 60, 200]) for _ in range(rng.randrange(0, 40))]
        least = rng.choice([0, 80])
        assert H.regions_of(weights, least) == plain_regions(weights, least), weights


def test_kept_text_against_a_plain_version():
    """Random lines in and out of labels: weights by the stated formula, regions by definition, link share by region."""
    rng = random.Random(9)
    masks = {H.ARTICLE: H.ARTICLE, H.MAIN: H.MAIN, H.LABELLED: H.LABELLED}
    for _ in range(2000):
        lines = []
        for i in range(rng.randrange(0, 25)):
            text = "x" * rng.choice([0, 0, 3, 40, 120]) and f"{i}" + "x" * rng.choice([3, 40, 120])
            lines.append((text, rng.choice([0, 0, 0, len(text)]), rng.choice([0, 0, 1, 2, 4, 6])))
        plain = [0 if a > len(t) / 2 else len(t) for t, a, _ in lines]
        held = plain if sum(plain) else [len(t) for t, _, _ in lines]
        some = [lv for t, _, lv in lines if t]
        weights, inside = [], []
        for (t, _, lv), p in zip(lines, plain):
            keep, gain = 1.0, 0.0
            for kind, mask in masks.items():
                if kind == H.ARTICLE and 6 in some:
                    mask |= H.MAIN
                if sum(held) and any(x & kind for x in some):
                    share = sum(h for h, (_, _, x) in zip(held, lines) if x & mask) / sum(held)
                    if lv & mask:
                        gain = max(gain, share)
                    else:
                        keep *= (1 - share) ** 4
            fine = t and keep >= 0.1
            weights.append(int(p * keep) + int(80 * gain) if fine else 0)
            inside.append(bool(fine and int(80 * gain)))
        want = [t for a, b in plain_regions(weights, 0) if any(inside[a:b]) or sum(k for _, k, _ in lines[a:b]) <= sum(len(t) for t, _, _ in lines[a:b]) / 2
                for t, _, _ in lines[a:b] if t]
        assert H._kept(lines, 0) == " ".join(want)


def test_hostile_pages_take_linear_time():
    pages = {"tags that never end": "<b " * 600_000, "end tags that match nothing": "<div>" * 100_000 + "x" + "</span>" * 200_000,
             "quotes that never close": '<a "> "' * 200_000 + "'", "raw ends that never end": "<script>" + "</script <" * 300_000,
             "suspects in suspects": "<div class=notice-board>x" * 40_000, "articles in an advert": "<div class=ad>" + "<article>x" * 100_000,
             "inline adverts": "<span class=ad>x</i>" * 50_000}
    for name, page in pages.items():
        start = time.process_time()
        main_text(page)
        assert time.process_time() - start < 40, name
    assert main_text(f"<article>{BODY}<b " + "<b " * 1000) .startswith(" ".join(TEXT))


def test_unlabelled_pages_of_the_table(spark, sf_small):
    """With the labels taken away, the windows alone find the same text on nearly all pages."""
    from tidemark.llm.common import read
    pages = [r.html for r in read(spark, sf_small, "pages").collect()]
    same = sum(main_text(p) == main_text(re.sub("</?article>", "", p)) for p in pages)
    assert same >= 0.97 * len(pages)
