"""HTML extraction by the line-block distribution.

Markup is stripped first: every block element becomes a line, inline elements none. Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments that their
element or name tells leave one empty line. Each line weighs as many characters as it has outside
of links, and nothing if there is no letter or digit among them. The weights of WINDOW lines are
summed at every line: text surges at a line with weight whose sum reaches MIN_SURGE, and dives where
the sum falls away; the lines between are kept. Where a page marks its article (article, main), the
mark is a weight: every line of it, linked or not, weighs MIN_SURGE at least. Text elsewhere then
weighs OUTSIDE of its length if it is more than the article's, and nothing if it is less.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinework.llm.common import released

WINDOW = 3
MIN_SURGE = 80
#: Weight of a character outside of a marked article.
OUTSIDE = 0.1
#: A short last line that says so is a notice, on a page that marks no article.
NOTICE = re.compile(r"©|\(c\)|copyright|all rights reserved|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados", re.I)
#: A part whose name tells boilerplate is none if it holds a marked article or, on a page without, more than this share of the text.
WRAPS = 0.8
# HTML element names.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset("select button svg annotation annotation-xml canvas object audio video head datalist label".split())
BOILERPLATE = frozenset("nav aside footer form menu dialog fieldset".split())
SAME_ENDS = {"li": "ul ol menu".split(), "dt": ["dl"], "dd": ["dl"], "tr": ["table"], "option": ["select"]}
# Words of class, id and role names for menus, headers, footers, sidebars, notices, adverts, forms and comments,
COMMENTS = frozenset("comment comments commentlist disqus respond replies".split())
MARKS = COMMENTS | frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead footer sidebar aside complementary contentinfo banner ad ads"
    " advert adverts advertisement advertisements advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices"
    " popup modal newsletter form".split()
)
# and words that may stand beside them in such a name.
BESIDE = frozenset("site page main global top bottom left right primary secondary area block box bar container wrapper inner outer section slot unit widget list".split())
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>",
    re.S,
)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


def _marked(attrs: str) -> tuple[bool, bool, bool]:
    """Whether a whole name marks a part as boilerplate, as reader comments, and as a header."""
    boiler = comments = header = False
    for m in _ATTR.finditer(attrs):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            words = set(_WORD.findall(name))
            if words and words <= MARKS | BESIDE | {"header"}:
                boiler |= bool(words & MARKS)
                comments |= bool(words & COMMENTS)
                header |= "header" in words
    return boiler, comments, header


def lines_of(page: str) -> list[tuple[str, int, bool, int]]:
    """(text, characters outside of links, inside a marked article, container) of each line.

    A part that is dropped is one empty line. The container is the number of the element around
    the line's block, 0 for the page itself.
    """
    found: list[tuple[str, int, bool, int, tuple[int, ...]]] = []
    open_: list[tuple[str, bool, bool, int]] = []  # name, dropped, article, part (-1: none)
    names: Counter[str] = Counter()
    text: list[str] = []
    boxes: list[int] = []  # the block elements that are open, by number
    parts: list[int] = []  # the boilerplate parts that are open, by number
    held: list[int] = []  # by each part: characters outside of links
    wraps: list[bool] = []  # a marked article is inside, or 80 % of the text could be the article's
    always: list[bool] = []
    linked = drops = articles = links = headings = headers = number = total = 0
    plain = False  # a letter or digit outside of links

    def flush() -> None:
        nonlocal text, linked, total, plain
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                own = max(len(whole) - linked, 1) if plain else 0
                found.append((whole, own, articles > 0, boxes[-2] if len(boxes) > 1 else 0, tuple(parts)))
                total += own
                for k in parts:
                    held[k] += own
        text, linked, plain = [], 0, False

    def close(to: int) -> None:
        nonlocal drops, articles, links, headings, headers
        while len(open_) > to:
            if open_[-1][0] in BLOCKS:
                flush()
            name, dropped, article, part = open_.pop()
            names[name] -= 1
            drops -= dropped
            articles -= article
            links -= name == "a"
            headings -= name[:1] == "h" and name[1:].isdigit()
            headers -= name == "header"
            if name in BLOCKS and name not in ("html", "body"):
                boxes.pop()
            if part >= 0:
                parts.pop()

    def add(piece: str) -> None:
        nonlocal linked, plain
        if piece and not drops and not (headers and articles and not headings):
            text.append(piece)
            if links:
                linked += len(" ".join(html.unescape(piece).split()))
            elif not plain:
                plain = any(c.isalnum() for c in html.unescape(piece))

    at = 0
    while m := _TAG.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if m.group().startswith("<![CDATA["):
                add(html.escape(m.group()[9:].removesuffix("]]>"), quote=False))
            continue
        attrs = m[3] or m[6] or ""
        if m[1] or m[4]:
            if not names[name]:
                if name in ("br", "p"):
                    flush() if name == "p" else add(" ")
                continue
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    close(k)
                    break
                if open_[k][0] in ("td", "th", "article", "main", "body") and name not in BLOCKS:
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in BLOCKS and names["p"]:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == "p":
                    close(k)
                    break
                if open_[k][0] in BLOCKS:
                    break
        for k in range(len(open_) - 1, -1, -1) if name in SAME_ENDS and names[name] else ():
            if open_[k][0] == name:
                close(k)
                break
            if open_[k][0] in SAME_ENDS[name]:
                break
        if name in BLOCKS:
            flush()
        elif name in ("br", "td", "th"):
            add(" ")
        if name in VOID or attrs.rstrip().endswith("/") and name in ("svg", "path"):
            continue
        boiler, comments, header = _marked(attrs) if attrs else (False, False, False)
        article = name in ("article", "main") or bool(attrs and re.search(r"""\brole\s*=\s*["']?main\b""", attrs, re.I))
        number += 1
        part = -1
        if not article and name not in ("html", "body") and (name in BOILERPLATE or boiler or (name == "header" or header and name in BLOCKS) and not articles):
            flush()  # an inline part is a line of its own too
            part = len(held)
            parts.append(part)
            held.append(0)
            wraps.append(False)
            always.append(comments or name in ("nav", "aside", "footer", "menu", "dialog"))
        if article:
            for k in parts:
                wraps[k] = True
        dropped = name in DROPPED
        drops += dropped
        articles += article
        links += name == "a"
        headings += name[:1] == "h" and name[1:].isdigit()
        headers += name == "header"
        names[name] += 1
        if name in BLOCKS and name not in ("html", "body"):
            boxes.append(number)
        open_.append((name, dropped, article, part))
    add(page[at:])
    close(0)
    flush()
    marked = any(inside for _, _, inside, _, _ in found)
    gone = {k for k, n in enumerate(held) if not wraps[k] and (always[k] or marked or n <= WRAPS * total)}
    out: list[tuple[str, int, bool, int]] = []
    for whole, own, inside, around, within in found:
        if not gone.intersection(within):
            out.append((whole, own, inside, around))
        elif out and out[-1][0]:
            out.append(("", 0, False, 0))
    return out


def between_surges(weight: np.ndarray, surge: float, dive: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """The runs (from, to) of lines between a surge and the dive after it.

    A surge is a line with weight at which the sum of the next ``window`` weights, its own
    included, reaches ``surge``; a dive is the next line at which that sum is below ``dive``.
    """
    n = len(weight)
    total = np.concatenate([[0.0], np.cumsum(weight)])
    ahead = (total[np.minimum(np.arange(n) + window, n)] - total[:n]).tolist()
    runs, start = [], -1
    for i, (own, block) in enumerate(zip(weight.tolist(), ahead)):
        if start < 0 and own > 0 and block >= surge - 1e-6:
            start = i
        elif start >= 0 and block < dive - 1e-6:
            runs.append((start, i))
            start = -1
    return runs + [(start, n)] if start >= 0 else runs


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by an empty line; empty where there is none.

    A run takes in the lines with weight right before its surge that share its container, and where
    no article is marked, lines of the same container as the heaviest run surge at any weight.
    """
    lines = lines_of(page or "")
    own = np.array([n for _, n, _, _ in lines], float)
    inside = np.array([i for _, _, i, _ in lines], bool)
    if not own.any() and not inside.any():
        return ""
    if inside.any():
        weight = np.where(inside, np.maximum(own, MIN_SURGE), own * (OUTSIDE if own[~inside].sum() > own[inside].sum() else 0))
        surge = dive = MIN_SURGE
    else:
        weight = own
        surge, dive = min(MIN_SURGE, float(np.convolve(own, np.ones(WINDOW)).max())), 1
    runs = between_surges(weight, surge, dive)
    for k, (a, b) in enumerate(runs):
        while a and own[a - 1] and lines[a - 1][3] == lines[a][3]:
            a -= 1
        runs[k] = (a, b)
    if not inside.any():
        a, b = max(runs, key=lambda r: weight[r[0] : r[1]].sum())
        same = {around for _, _, _, around in lines[a:b] if around}
        runs += [(a, b) for a, b in between_surges(weight, 1, 1) if any(around in same for _, _, _, around in lines[a:b])]
    keep = np.zeros(len(lines), bool)
    for a, b in runs:
        keep[a:b] = True
    last = len(lines) - 1
    while not inside.any() and last > 0 and own[last] < MIN_SURGE and (not own[last] or NOTICE.search(lines[last][0])):
        keep[last] = False
        last -= 1
    return "\n\n".join(text for (text, _, _, _), k in zip(lines, keep) if k and text)


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """One row per page: (id, url, text, n_chars).

    A null or empty page has an empty text; markup that never closes ends with the page. Repeated
    rows each get their row; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[id_col, url, "text", "n_chars"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, url, F.col(markup).alias("__html")).mapInArrow(
        released(run), f"`{id_col}` {kind}, `{url}` string, text string, n_chars bigint"
    )
