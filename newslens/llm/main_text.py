"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to one line per block. Lines of menus, adverts and the like count as empty,
and if the page marks its article, so do the lines outside it. Over the lengths that remain,
sums of `WINDOW` neighbouring lines are taken: a surge is where a sum rises to `SURGE` characters,
a dive is where it falls to nothing, and the lines between are text. Inside a marked article any
text is a surge. If a page has no surge, its heaviest stretch of lines is its text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 80
LINKED = 0.6

# Elements whose content is never text of the page, and those of them that run on to the end of the
# page if nothing ends them; without an end, only the tags of the others go.
RAW = frozenset("script style title textarea noscript template iframe svg select option button canvas object".split())
ENDLESS = frozenset("script style title textarea".split())
RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
# End tags of options are optional: what must follow ends them too, and stays.
RAW_END["option"] = re.compile(r"</option\s*>|(?=</?(?:option|optgroup|datalist|select)\b)", re.IGNORECASE)
# A slash at the end of an unquoted value belongs to it.
CLOSED = re.compile(r"(?:^|[\s\"']|\s[^\s=\"']+)/\Z")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+|[^>]*)>|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol p pre section summary table tbody tfoot thead tr ul".split()
)
# Blocks whose end tags are often missing: they end where the next block starts.
LOOSE = frozenset("p li dt dd tr h1 h2 h3 h4 h5 h6 option caption".split())
SPACES = frozenset("br td th wbr img".split())
ARTICLES = frozenset(("article", "main"))
BOILERPLATE = frozenset("nav footer aside form menu dialog head header".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice newsletter subscribe subscription popup modal overlay "
    "sidebar menu menus nav navbar navigation breadcrumb breadcrumbs footer comment comments "
    "commentlist disqus share sharing social related recommended widget login signup masthead "
    "pagination toolbar".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
PIECES = re.compile(r"[^a-z0-9]+")
# Names that also stand on parts of an article. Inside one they make a block suspect only if nothing else but
# words of layout stands beside them, and its lines go only if they are short or mostly links.
WEAK = frozenset(
    "banner menu menus modal notice overlay promo promotion related recommended share sharing social "
    "subscription toolbar widget".split()
)
LAYOUT = frozenset("bar block box btn button buttons container inner item items links list row section wrap wrapper".split())
CLEAN, SUSPECT, DROPPED = 0, 1, 2


def _kind(name: str, attributes: str, in_article: bool) -> int:
    """CLEAN, SUSPECT or DROPPED, by the name and attributes of an element."""
    if name in BOILERPLATE and not (name == "header" and in_article):
        return DROPPED
    if not attributes or name in ARTICLES or name in ("body", "html"):
        return CLEAN
    if HIDDEN.search(attributes):
        return DROPPED
    found = CLEAN
    for kind, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if kind.lower() == "role":
            if not ROLES.isdisjoint(PIECES.split(value)):
                return DROPPED
            continue
        for token in value.split():
            words = {word for word in PIECES.split(token) if word}
            if in_article and not words.isdisjoint(WEAK):
                if words <= WEAK | LAYOUT:
                    found = SUSPECT
                words -= WEAK
            if not words.isdisjoint(NAMES):
                return DROPPED
    return found


def _tokens(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of the markup; comments and raw elements have no name."""
    at = 0
    endless: set[str] = set()  # raw elements that no end tag is left for
    while token := TOKEN.search(page, at):
        slash, name, attributes = token[1] or "", (token[2] or "").lower(), token[3] or ""
        at = token.end()
        if name in RAW and not slash:
            if not CLOSED.search(attributes):
                end = None if name in endless else RAW_END[name].search(page, at)
                if end:
                    at = end.end()
                else:
                    endless.add(name)
                    at = len(page) if name in ENDLESS else at
            name = ""
        yield token.start(), at, slash, name, attributes


def page_lines(page: str) -> tuple[list[tuple[str, int, int, bool]], bool]:
    """Lines (text, characters inside links, kind, in article), and whether an article is marked."""
    lines: list[tuple[str, int, int, bool]] = []
    stack: list[tuple[str, int, bool]] = []  # name, kind, article
    pieces: list[str] = []
    linked = 0
    in_link = False
    dropped = CLEAN
    inside = marked = False

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            lines.append((text, linked, dropped, inside))
        pieces.clear()
        linked = 0

    def state() -> None:
        nonlocal dropped, inside
        dropped, inside = (stack[-1][1], stack[-1][2]) if stack else (CLEAN, False)

    def pop(to: int) -> None:
        del stack[to:]
        state()

    at = 0
    for start, end, slash, name, attributes in _tokens(page):
        if start > at:
            piece = page[at:start]
            pieces.append(piece)
            if in_link:
                linked += len(piece)
        at = end
        if not name:
            continue
        if name == "a":
            in_link = not slash
        elif name in SPACES:
            pieces.append(" ")
        elif slash:
            known = name in BLOCKS or any(x[0] == name for x in stack)
            if not known:
                continue
            if name in BLOCKS:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    flush()
                    pop(depth)
                    break
        elif name in BLOCKS:
            flush()
            in_link = False
            if stack and stack[-1][0] in LOOSE:
                pop(len(stack) - 1)
            if name == "hr":
                continue
            if name in ARTICLES:
                # An article never lies in a menu or an advert: an end tag is missing there.
                while stack and stack[-1][1] and stack[-1][0] not in ARTICLES:
                    stack.pop()
                state()
                marked = marked or not dropped
            stack.append((name, max(dropped, _kind(name, attributes, inside)), inside or name in ARTICLES))
            state()
        elif attributes and not attributes.endswith("/") and (kind := _kind(name, attributes, inside)):
            flush()
            stack.append((name, max(dropped, kind), inside))
            state()
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return lines, marked


def main_text(page: str | None) -> str:
    """The main text of one page, one line per block; empty if there is none. Very long pages are taken whole."""
    lines, marked = page_lines(page or "")
    lengths = [
        0
        if kind == DROPPED
        or (kind == SUSPECT and (len(text) < SURGE or linked > LINKED * len(text)))
        or (marked and not inside)
        or (not marked and linked > LINKED * len(text))
        else len(text)
        for text, linked, kind, inside in lines
    ]
    surge = 1 if marked else SURGE
    sums = [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]
    kept: list[int] = []
    best: tuple[int, list[int]] = (0, [])
    start = 0
    while start < len(sums):
        if not sums[start]:
            start += 1
            continue
        stop = start
        while stop < len(sums) and sums[stop]:
            stop += 1
        stretch = [i for i in range(start, stop) if lengths[i]]
        if max(sums[start:stop]) >= surge:
            kept += stretch
        best = max(best, (sum(lengths[start:stop]), stretch), key=lambda x: x[0])
        start = stop
    return "\n".join(lines[i][0] for i in kept or best[1])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; n_chars counts code points.

    A null or empty page gives an empty text, an empty table an empty result; a page of any length is taken whole;
    of equal stretches of a page without a surge the first is its text; null ids and urls stay as they are; repeated rows
    are answered as often as they occur; other columns are not read.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(value.as_py()) for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()),
                 pa.array(map(len, found), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return rows.mapInArrow(texts, "page_id long, url string, text string, n_chars long")
