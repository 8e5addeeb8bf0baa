"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block tags. Blocks inside menus, headers, footers,
sidebars, notices, adverts, forms and comments are dropped by their containers.
If the page's articles, or its main part, hold the bulk of what is left, only the
blocks in them are candidates. The first pass classifies the candidates by link
density, length and the density of stop words: good, bad or undecided. In the
second pass an undecided block takes the label of its nearest decided neighbours;
between a good and a bad one at the same distance it takes the good one if it is
in the page's article. Without any good block, length and links decide.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

# Frequent function words.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their
    there they this to was we were which will with you
    au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour qu que
    qui sa se ses son sont sur un une vous
    al como con del el ella en es esta este la las lo los más no o para pero por que se sin su sus un una y
    aber als am an auch auf aus bei bin das dass dem den der des die durch ein eine einem einen einer er es für hat ich
    ihr im in ist mit nach nicht noch nur oder sich sie sind so über um und von vor war wenn wie wird zu zum zur
    """.split()
)
# Elements whose content is no text, that hold no article, and that end a block.
RAW = frozenset(("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object"))
APART = frozenset(("nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "fieldset", "canvas"))
ARTICLE = {"main": 1, "article": 2}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "p"))
BLOCK = frozenset(
    """
    address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section summary table tbody td
    tfoot th thead tr ul
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Names in class, id and role that say what an element is for.
HINTS = frozenset(
    """
    ad ads adbox adsense adslot adunit banner complementary consent contentinfo disclaimer login masthead menu menubar modal
    nav navigation notice notices notification overlay pager pagination popup promo promoted promotion recommended related
    replies reply respond search share sharing shoutbox signup social subscribe toolbar topbar widget widgets
    """.split()
)
# Beginnings of such names, and those that make an article no article.
BEGINNINGS = ("advert", "breadcrumb", "comment", "cookie", "disqus", "footer", "gdpr", "navbar", "newsletter", "sidebar", "sponsor")
NO_ARTICLE = ("ad", "ads", "advert", "comment", "promo", "related", "sponsor", "teaser")
# A header with one of these names belongs to the text.
OWN_HEADER = frozenset(("article", "content", "entry", "main", "post", "story"))
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*)(?:>|\Z)|[^<]+|<""",
    re.S,
)
MARKS = re.compile(r"""\b(class|id|role|aria-hidden|hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
NAMES = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
LETTERS = re.compile(r"[^\W\d_]+")

#: Blocks with at least this part of their characters in links are bad.
LINKS = 0.5
#: Blocks with fewer words are short.
SHORT = 12
#: Part of stop words from which a block that is not short is good, and below which it is bad.
STOPS_HIGH, STOPS_LOW = 0.15, 0.05


def unwanted(element: str, attributes: str) -> bool:
    """Whether class, id, role or style say that an element is not part of the text."""
    if element in ("html", "body"):  # their classes speak of the page
        return False
    for key, a, b, c in MARKS.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "id", "role"):
            names = NAMES.findall(CAMEL.sub(" ", value).lower())
            if element in ARTICLE:
                if any(n.startswith(NO_ARTICLE[2:]) or n in NO_ARTICLE for n in names):
                    return True
            elif key == "id" and element in HEADINGS:
                continue  # an anchor, named after what the heading says
            elif not HINTS.isdisjoint(names) or any(n.startswith(BEGINNINGS) for n in names):
                return True
            elif "header" in names and OWN_HEADER.isdisjoint(names) and element not in HEADINGS:
                return True
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and HIDDEN.search(value)):
            return True
    return False


def blocks(page: str) -> list[tuple[str, float, int]]:
    """Text, link density and place (0 outside, 1 in the page's main part, 2 in an article) of the blocks outside unwanted elements."""
    found: list[tuple[str, float, int]] = []
    text: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, int]] = []  # element, inside something unwanted, place
    links = at = article = 0
    apart = False

    def close() -> None:
        nonlocal linked
        whole = " ".join(html.unescape("".join(text)).split())
        if whole:
            found.append((whole, min(1.0, linked / len(whole)), article))
        text.clear()
        linked = 0

    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        name = m[2] or m[5]
        if not name:
            piece = m[0]
            if not apart and not piece.startswith(("<!", "<?")):
                text.append(piece)
                if links:
                    linked += len(" ".join(html.unescape(piece).split()))
            continue
        name, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if closing:
            if name in BLOCK:
                close()
            elif name == "br":
                text.append(" ")
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None and not (name == "p" and stack[-1][0] != "p" and stack[-1][0] in BLOCK):
                del stack[depth:]
        elif name in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        else:
            if name in BLOCK:
                close()
                while stack and stack[-1][0] in ("p", "b", "i", "em", "strong", "span", "u", "a") and any(e[0] == "p" for e in stack):
                    stack.pop()  # a block ends an open paragraph
                if name in ("li", "tr", "td", "th", "dd", "dt", "option") and stack and stack[-1][0] == name:
                    stack.pop()
            elif name == "br":
                text.append(" ")
            if name not in VOID and not attributes.endswith("/"):
                drop = apart or name in APART or unwanted(name, attributes) or (name == "header" and not article)
                stack.append((name, drop, article if drop else max(article, ARTICLE.get(name, 0))))
        apart, article = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        links = sum(e[0] == "a" for e in stack)
    close()
    return found


def first_label(text: str, link_density: float) -> int:
    """1 for good, -1 for bad, 0 for undecided."""
    if link_density >= LINKS:
        return -1
    words = LETTERS.findall(text.lower())
    if len(words) < SHORT:
        return 0
    stops = sum(w in STOP_WORDS for w in words) / len(words)
    return 1 if stops >= STOPS_HIGH else 0 if stops >= STOPS_LOW else -1


def main_text(page: str) -> str:
    """Blocks of the main text of ``page`` in order, one to a line."""
    found = blocks(page)
    held = [sum(len(text) for text, density, place in found if place >= least and density < LINKS) for least in (0, 1, 2)]
    within = next((least for least in (2, 1) if held[least] * 2 > held[0]), 0)  # what holds the bulk of the text
    found = [block for block in found if block[2] >= within]
    labels = [first_label(text, density) for text, density, _ in found]
    if 1 not in labels:  # stop words of no known language: length and links decide
        labels = [1 if d < LINKS and len(LETTERS.findall(t)) >= SHORT else n for n, (t, d, _) in zip(labels, found, strict=True)]
    if within and 1 not in labels:  # nothing to inherit from: the article decides
        labels = [n or 1 for n in labels]
    before, last = [], (0, -len(labels) - 1)
    for n, label in enumerate(labels):
        last = (label, n) if label else last
        before.append(last)
    kept, after = [False] * len(labels), (0, 2 * len(labels) + 1)
    for n in range(len(labels) - 1, -1, -1):
        after = (labels[n], n) if labels[n] else after
        label = labels[n]
        if not label:
            (left, i), (right, j) = before[n], after
            label = left if n - i < j - n else right if n - i > j - n else max(left, right) if within else min(left, right)
            if label == 0:  # nothing else is decided
                label = 1
        kept[n] = label > 0
    return "\n".join(text for (text, _, _), good in zip(found, kept, strict=True) if good)


def extract(pages: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of every row of ``pages`` (html) and ``text``, the main text (empty if none).

    Character references are decoded, white space inside a block becomes one space,
    and blocks are joined in page order by one line feed. A null page is empty.
    Broken markup ends where the page ends. Rows are read one by one, so repeated
    rows get equal texts. Other columns are ignored unless named. An empty table gives
    an empty result.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(page or "") for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(texts, pa.string())], names=[*columns, "text"]
            )

    kinds = dict(pages.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), "text string"])
    return pages.select(*dict.fromkeys([*columns, "html"])).mapInArrow(run, schema)
