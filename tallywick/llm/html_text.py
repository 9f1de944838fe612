"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element.  A line weighs as many
characters as it has outside links; lines of menus, adverts, forms and the like
weigh nothing, and where a page marks its article, so do all others, while every
line inside weighs at least the surge threshold.  Weights are summed over
sliding windows of lines.  Text starts where a window surges over the threshold,
or over the page's own largest window if that is less, and ends where the
weights dive to nothing; lines between are kept, linked ones too.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywick.llm.common import each_batch, shipped, table

WINDOW_LINES = 3
SURGE = 80
#: fixed values: elements and class words
HIDDEN = frozenset("head script style noscript template svg iframe textarea select option button form nav footer aside dialog object canvas audio video".split())
RAW = frozenset("script style noscript template svg iframe textarea select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SELF_CLOSING = frozenset("p li dd dt td th tr option".split())
BOILERPLATE = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices notification popup promo promoted related replies share sharing sidebar social sponsor sponsored subscribe subscription topbar widget".split()
)
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CLOSERS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


def _is_boilerplate(attributes: str) -> bool:
    for match in _NAMES.finditer(attributes):
        words = (match[1] or match[2] or match[3] or "").lower().split()  # whole: has-sidebar is no sidebar
        if not BOILERPLATE.isdisjoint(words):
            return True
    return any(name.lower() == "hidden" or (name.lower() == "aria-hidden" and value.strip("\"'").lower() == "true") for name, value in _ATTRIBUTE.findall(attributes))


def lines(page: str) -> tuple[list[tuple[str, int, bool, bool]], bool]:
    """``(text, link characters, boilerplate, in the article)`` of every line; whether there is an article."""
    out, parts = [], []
    hidden: list[list] = []  # [tag, depth] of the boilerplate element we are in
    linked = article = 0
    in_link = has_article = False

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((text, linked, bool(hidden), article > 0))
        parts.clear()
        linked = 0

    at = 0
    while True:
        match = _TOKEN.search(page, at)
        piece = page[at : match.start() if match else len(page)]
        if piece:
            parts.append(piece)
            if in_link:
                linked += len(piece)
        if not match:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        closing, block = bool(match[1]), tag in BLOCKS or tag in HIDDEN
        if block:
            flush()
        elif tag == "br":
            parts.append(" ")
        if tag == "a":
            in_link = not closing
        if tag in ("article", "main"):
            hidden.clear()
            article = max(0, article + (-1 if closing else 1))
            has_article = True
        elif hidden:
            top = hidden[-1]
            if tag == top[0]:
                if closing:
                    top[1] -= 1
                elif tag in SELF_CLOSING:
                    hidden.pop()
                    top = None
                elif not match[3].endswith("/"):
                    top[1] += 1
                if top and not top[1]:
                    hidden.pop()
            elif tag == "body" and not closing and top[0] == "head":
                hidden.clear()
        if not closing and tag not in VOID and tag not in ("html", "body", "article", "main") and not match[3].endswith("/"):
            if tag in HIDDEN or (tag == "header" and not article) or _is_boilerplate(match[3]):
                if not (hidden and hidden[-1][0] == tag):
                    flush()
                    hidden.append([tag, 1])
            if tag in RAW:  # its content is no markup
                end = _CLOSERS[tag].search(page, at)
                at = end.end() if end else len(page)
                if hidden and hidden[-1][0] == tag:
                    hidden.pop()
    flush()
    return out, has_article


def main_text(page: str | None) -> str:
    """Kept lines joined by a newline; empty for a missing or empty page."""
    found, has_article = lines(page or "")
    weights = []
    for text, linked, boilerplate, inside in found:
        if boilerplate or (has_article and not inside):
            weights.append(0)
        elif has_article:
            weights.append(max(SURGE, len(text)))
        else:
            weights.append(max(0, len(text) - linked))
    windows = [sum(weights[i : i + WINDOW_LINES]) for i in range(len(weights))]
    surge = min(SURGE, max(windows, default=0))
    kept, inside = [], False
    for i, (weight, window) in enumerate(zip(weights, windows)):
        if not inside and weight and window >= surge:  # surge
            inside = True
        elif inside and not window:  # dive
            inside = False
        if inside and not found[i][2] and (found[i][3] or not has_article):
            kept.append(found[i][0])
    return "\n".join(kept)


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``; repeated rows stay."""
    shipped(pages.sparkSession)

    def rows(data):
        found = [main_text(page) for page in data["html"]]
        return {"page_id": data["page_id"], "url": data["url"], "text": found, "n_chars": list(map(len, found))}

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return chosen.mapInArrow(each_batch(rows, _SCHEMA), "page_id long, url string, text string, n_chars long")


def op5_html_extraction(spark, folder: str) -> DataFrame:
    return extracted(table(spark, folder, "pages"))
