"""Main text of web pages by line-block distribution (operator 6).

1. Markup is stripped into *lines*, one for each block of the page. Boilerplate elements (menus, headers, footers, sidebars,
   notices, adverts, forms, comments) leave empty lines. An element that only sounds like one, by a class such as
   `notice-board`, is judged by its text: it goes if links hold most of it or, outside of an article, if it has short lines.
2. A line weighs its code points; lines of links and of copyright notices weigh nothing. If the page labels its article
   (`article`, `main`, their roles, or a class or id such as `post-content`), labels are a weight: with a share s of the
   page's weight inside a label, a line outside of it keeps (1 - s)^4 of its weight (below a tenth: none) and a line inside
   gains s * SURGE_CHARS. So a teaser changes little, a label that holds nearly all text decides nearly all.
3. Sums of weights over a sliding window of `WINDOW` lines give the distribution. It *surges* at a line of weight behind empty
   windows and *dives* where a window is empty; of these regions, all that reach SURGE_CHARS in a window (or the page's
   heaviest window, if none does) are kept from the first to the last line of weight, and all text between. Regions without a
   label and with more than REGION_LINKS of their text in links are left out.

Character references are decoded, white space inside a block becomes one space, blocks join by one space.

Cases: a null or empty page, one without main text, or less than SURGE_CHARS of text without any tag, gives '' and 0;
unclosed and misnested tags, comments and scripts end where a browser would end them or at the end of the page, but an advert
that is never closed doesn't swallow the article; after a quote that is never closed, tags end at the next `>`; very long
pages, deep nesting and tags that are never closed take time in proportion to the page; there are no ties; repeated rows
give repeated results; an empty table gives an empty result; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3            # lines in a block
SURGE_CHARS = 80      # a window's weight that makes a region main text
REGION_LINKS = 0.5    # a region without a label and with more of its text in links is no main text
LINK_SHARE = 0.5      # a line with more of its text in links weighs nothing, but stays inside a region
LEAST_FACTOR = 0.1    # lines that keep less than this of their weight weigh nothing
SUSPECT_LINKS = 0.5   # a suspect block with more of its text in links goes
SUSPECT_LINE = 80     # and, outside of an article, one of shorter lines

# HTML element groups.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "math", "textarea", "select", "title", "object",
       "canvas", "video", "audio", "noembed", "noframes", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside form menu dialog button head".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody "
    "td tfoot th thead tr ul button".split())
ENDS_P = BLOCK - {"br", "body", "html"}
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog "
                          "alert toolbar".split())
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer sidebar ad ads advert adverts advertisement "
    "advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice banner popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments "
    "commentlist reply replies disqus pagination pager paging toolbar masthead alert toast paywall skip search searchform "
    "topbar dropdown widget copyright".split())
# words that say nothing about what a block holds: beside one of the above, it is boilerplate
STRUCTURE_WORDS = frozenset(
    "area bar block body bottom box btn button buttons center col column container content count floating footer form frame full "
    "grid group header holder icon icons inner inline item items js large layer left link links list main medium menu message "
    "mobile module nav outer page panel primary right row secondary section site slot small sticky strip text title top unit "
    "user wrap wrapper zone".split())
HEADER_WORDS = frozenset("header".split())
CONTENT_WORDS = frozenset("article entry post content story main body title".split())
LABELS = frozenset("article content main story articlebody articlecontent postcontent entrycontent maincontent storybody "
                   "postbody entrybody articletext bodycopy".split())

LABELLED, MAIN, ARTICLE = 1, 2, 4    # bits of a line: what it lies in

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)>"
    r"|(?P<text>[^<]+|<)", re.S)
_LOOSE = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>[^>]*+)>"
    r"|(?P<text>[^<]+|<)", re.S)
_TAG = re.compile(r"<[a-zA-Z][^<>]*>")
_NOTICE = re.compile(r"(?:copyright|\(c\)|©)\W*(?:copyright|\(c\)|©)?\W*(?:19|20)\d\d\b.{0,80}|(?:.{0,80}\W)?all rights reserved\W*", re.I | re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)}


NO, SUSPECT, YES = 0, 1, 2


def _is_boilerplate(tag: str, attrs: dict[str, str], in_article: bool) -> int:
    """YES, NO, or SUSPECT: to be judged by its text."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return YES
    found = SUSPECT if tag == "fieldset" else NO
    if not attrs:
        return found
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return YES
    if attrs.get("role", "").lower() in DROPPED_ROLES or attrs.get("aria-modal") == "true":
        return YES
    if tag in ("html", "body", "main"):
        return NO
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = [w.lower() for w in re.split(r"[-_:.]+", _CAMEL.sub("-", name)) if w and not w.isdigit()]
        if not words or words[0] in ("has", "no", "with", "without", "is"):
            continue
        if not DROPPED_WORDS.isdisjoint(words):
            if all(w in DROPPED_WORDS or w in STRUCTURE_WORDS for w in words):
                return YES
            found = SUSPECT
        if HEADER_WORDS & set(words) and not CONTENT_WORDS & set(words) and not in_article:
            return YES
    return found


def _is_article(tag: str, attrs: dict[str, str]) -> int:
    """ARTICLE, MAIN, LABELLED (the main part by its class or id), or 0: none of these."""
    if tag == "article" or attrs.get("itemprop", "").lower() == "articlebody" or attrs.get("role", "").lower() == "article":
        return ARTICLE
    if tag == "main" or attrs.get("role", "").lower() == "main":
        return MAIN
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().replace("-", "").replace("_", "").split()
    return LABELLED if tag in ("div", "section", "td") and not LABELS.isdisjoint(names) else 0


def lines_of(page: str, revive: bool = False) -> list[tuple[str, int, int]]:
    """(text, code points in links, labels around it) of every line; text of boilerplate lines is ''.

    revive: an article or main element ends whatever boilerplate is still open.
    """
    lines: list[tuple[str, int, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, int, tuple | None]] = []    # open containers: tag, boilerplate, labels outside, suspect's start
    opened: Counter = Counter()                               # how many of each tag are open
    linked = dropped = level = anchors = revived = 0          # containers below `revived` are boilerplate no longer
    chars = links = texts = 0                                 # of the lines so far
    skipped = False

    def flush() -> None:
        nonlocal linked, skipped, chars, links, texts
        text = " ".join("".join(parts).split())
        if text:
            lines.append((text, linked, level))
            chars, links, texts = chars + len(text), links + linked, texts + 1
        if skipped:
            lines.append(("", 0, level))
        parts.clear()
        linked, skipped = 0, False

    def close(upto: int) -> None:
        nonlocal dropped, level, revived, chars, links, texts
        while len(stack) > upto:
            tag, was, lv, mark = stack.pop()
            opened[tag] -= 1
            if len(stack) >= revived:
                dropped -= was
            revived = min(revived, len(stack))
            level = lv
            if mark is not None:
                first, c, k, t = mark
                held, many = chars - c, texts - t
                if held and (links - k > SUSPECT_LINKS * held or not lv and held < SUSPECT_LINE * many):
                    rest = min(len(lines) - first, WINDOW)
                    del lines[first:]
                    lines.extend([("", 0, level)] * rest)
                    chars, links, texts = c, k, t

    token, pos, n = _TOKEN, 0, len(page)
    last = page.rfind(">") + 1                                # behind it, no tag ends
    while pos < n:
        if pos >= last and page[pos] == "<" and page[pos + 1:pos + 2] not in ("!", "?"):
            text, m = "<", None
            pos += 1
        else:
            m = token.match(page, pos)
            pos = m.end()
            text = m["text"]
        if text is not None:
            if dropped:
                skipped = skipped or not text.isspace()
                continue
            text = entities.unescape(text) if "&" in text else text
            parts.append(text)
            if anchors:
                linked += len(text.strip())
            continue
        if token is _TOKEN and m["tag2"]:                     # a quote that is never closed
            token = _LOOSE
            tag, end, raw = m["tag2"].lower(), bool(m["end2"]), m["attrs2"]
        else:
            tag, end, raw = (m["tag"] or "").lower(), bool(m["end"]), m["attrs"] or ""
        if not tag:
            continue
        if tag == "a":
            anchors = max(0, anchors + (-1 if end else 1))
        if end:
            if tag in BLOCK:
                flush()
            if opened[tag] > 0:
                at = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
                if any(t in BLOCK or mark is not None for t, _, _, mark in stack[at:]):
                    flush()
                close(at)
            continue
        if tag in RAW:
            if not raw.rstrip().endswith("/") or tag not in ("svg", "math"):
                over = _RAW_END[tag].search(page, pos, max(pos, last))
                pos = over.end() if over else n
            if tag == "title":
                flush()
            continue
        if tag in ENDS_P and stack and stack[-1][0] == "p":
            flush()
            close(len(stack) - 1)
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        attrs = _attributes(raw) if raw.strip(" /\t\r\n") else {}
        bad = _is_boilerplate(tag, attrs, level > 0)
        kind = 0 if bad == YES else _is_article(tag, attrs)
        if bad or kind or tag in BLOCK and tag not in ("p", "li", "td", "th", "tr", "dd", "dt", "option"):
            if bad != YES or tag in BLOCK:                    # an advert inside a line does not cut its words
                flush()
            if revive and kind in (ARTICLE, MAIN):
                dropped, revived = 0, len(stack)
            stack.append((tag, bad == YES, level, (len(lines), chars, links, texts) if bad == SUSPECT and not dropped else None))
            opened[tag] += 1
            dropped += bad == YES
            level |= kind
    flush()
    close(0)
    return lines


def main_text(page: str | None) -> str:
    if not page:
        return ""
    least = SURGE_CHARS if _TAG.search(page) is None else 0
    return _kept(lines_of(page), least) or _kept(lines_of(page, True), least)


def weights_of(lines: list[tuple[str, int, int]]) -> tuple[list[int], list[bool]]:
    """Weight of each line, and whether it lies inside a label that it gains by."""
    plain = [0 if a > LINK_SHARE * len(t) or len(t) < 200 and _NOTICE.fullmatch(t) else len(t) for t, a, _ in lines]
    held = plain if any(plain) else [len(t) for t, _, _ in lines]
    total = sum(held)
    seen = {lv for t, _, lv in lines if t}
    masks = {ARTICLE: ARTICLE, MAIN: MAIN, LABELLED: LABELLED}
    if any(lv & ARTICLE and lv & MAIN for lv in seen):       # a main element around the article holds its headings and lead
        masks[ARTICLE] = ARTICLE | MAIN
    shares = {mask: sum(n for n, (_, _, lv) in zip(held, lines) if lv & mask) / total
              for kind, mask in masks.items() if total and any(lv & kind for lv in seen)}
    factor = {lv: math.prod((1 - s) ** 4 for mask, s in shares.items() if not lv & mask) for lv in seen}
    gain = {lv: int(SURGE_CHARS * max((s for mask, s in shares.items() if lv & mask), default=0)) if factor[lv] >= LEAST_FACTOR else 0
            for lv in seen}
    return ([int(n * factor[lv]) + gain[lv] if t and factor[lv] >= LEAST_FACTOR else 0 for n, (t, _, lv) in zip(plain, lines)],
            [bool(t) and gain[lv] > 0 for t, _, lv in lines])


def regions_of(weights: list[int], least: int = 0) -> list[tuple[int, int]]:
    """Lines from each surge to its dive, for regions that reach the threshold in a window."""
    upto = [0, *accumulate(weights)]
    n = len(weights)
    sums = [upto[min(i + WINDOW, n)] - upto[i] for i in range(n)]
    surge = max(least, min(SURGE_CHARS, max(sums, default=0)), 1)
    out: list[tuple[int, int]] = []
    start, most = None, 0
    for i in range(n + 1):
        now = sums[i] if i < n else 0
        if start is None and now and weights[i]:
            start, most = i, 0
        if start is not None:
            most = max(most, now)
            if not now:
                if most >= surge:
                    out.append((start, i))
                start = None
    return out


def _kept(lines: list[tuple[str, int, int]], least: int) -> str:
    weights, inside = weights_of(lines)
    text = []
    for a, b in regions_of(weights, least):
        if any(inside[a:b]) or sum(k for _, k, _ in lines[a:b]) <= REGION_LINKS * sum(len(t) for t, _, _ in lines[a:b]):
            text += [t for t, _, _ in lines[a:b] if t]
    return " ".join(text)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points): one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
