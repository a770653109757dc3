"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped into lines, one per block element; what HTML itself says is no main text
(menus, forms, footers, hidden elements) gives none. Each line has a weight: its text outside
links, scaled by the share it has in the line beside link text and inline markup. A sliding
window sums weights. Where the sum surges over a threshold taken from the page's own
distribution, main text begins, after its last dive it ends, and the lines between are kept.

An article or main element is text for certain, all of it. Elsewhere a class or id that is
made of telling words takes an element away, unless it holds the page's text (``spared``); one that
only contains such a word sets the element's lines apart: windows don't reach across its edge,
so it must surge by itself. Two or more lines in a row that are links alone are a menu.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import text_of

#: Lines of a window.
WINDOW = 3
#: A window surges with this share of the window that a letter of the page's text typically
#: lies in; with so many letters it does on any page, so a sentence is not lost beside a long text.
SURGE, ENOUGH = 0.1, 40
#: Letters that an inline tag counts for in a line's share of text.
TAG = 4

# Fixed by HTML: elements whose content is no text, elements that hold other blocks, and
# elements that end a line.
RAW = "script|style|textarea|template|noscript|iframe|svg|math|object|select|title|canvas|audio|video"
CONTAINERS = frozenset(
    "address article aside blockquote body center dd details dialog div dl fieldset figure footer form header "
    "hgroup html li main menu nav ol section table tbody td tfoot th thead tr ul".split()
)
BLOCKS = CONTAINERS | frozenset("br caption dt figcaption h1 h2 h3 h4 h5 h6 hr legend p pre summary".split())

#: Elements, roles and words of class or id that mark what is no main text.
AWAY = frozenset("nav aside footer form menu dialog button".split())
AWAY_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
AWAY_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs comment
    comments commentlist consent cookie cookies copyright discussion disqus footer footnav gdpr header login
    masthead menu menus meta-nav modal nav navbar navigation newsletter notice notices notification overlay
    pager pagination paywall popup privacy promo promotion recommended related replies reply respond responses
    search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription tags
    teaser toolbar topbar widget widgets""".split()
)
#: Words that say nothing beside those above: left-sidebar, comments-area.
PLAIN_WORDS = frozenset(
    """area bar block bottom box buttons col column container content footer form global group holder inner item items
    layer left line links list main message middle module outer page panel post primary right row secondary section
    side site text title top wrap wrapper""".split()
)
#: Words of a class or id that set an element apart, without taking it away.
APART_WORDS = frozenset("left right side rail column aside extra misc weather stock ticker".split())
#: Whole classes or ids of adverts and comments that count inside an article, too.
IN_ARTICLE = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense ad-box adbox comments comment-list commentlist
    comments-area comments-section comment-section disqus_thread""".split()
)
#: Classes of whole pages are no sign against their content.
NEVER = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    rf"|<(?P<raw>{RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|itemtype|hidden|aria-hidden)\b(?!-)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+", re.I)
_SOUND = re.compile(r"[^\W_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


#: A class like has-sidebar or noSidebar tells the state of a page, not what an element is.
_STATE = re.compile(r"\b(?:has|no|with|without)(?:[-_]+|(?=[A-Z]))[a-zA-Z]+")


def _words(value: str) -> set[str]:
    return {w.lower() for w in _WORD.findall(_CAMEL.sub(" ", _STATE.sub(" ", value)))}


def sign(name: str, rest: str, in_article: bool, nested: bool = False) -> str:
    """What an element's name and attributes say: "away" for no main text, "maybe" where only
    a class, an id or a form says so, "apart" where a class or id merely hints, or "".

    A header inside an article is its title. An article is a comment if another one holds it
    and its class, id or itemtype has the word. Inside an article or main, only whole classes
    of adverts and comments count."""
    if name == "form":
        found = "maybe"
    elif name in AWAY or name == "header" and not in_article:
        return "away"
    else:
        found = ""
    if not rest.strip():
        return found
    for m in _ATTR.finditer(rest):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in NEVER:
            if name == "article" and nested and kind in ("class", "id", "itemtype") and _words(value) & {"comment", "comments"}:
                return "away"
            continue
        if kind == "hidden" or kind == "aria-hidden" and value.lower() == "true":
            return "away"
        if kind == "role" and value.strip().lower() in AWAY_ROLES:
            if value.strip().lower() != "form":
                return "away"
            found = "maybe"
        if kind not in ("class", "id") or name == "header":
            continue
        for token in _STATE.sub(" ", value).split():
            if in_article:
                if token.lower() in IN_ARTICLE:
                    found = "maybe"
                continue
            words = _words(token)
            if words & AWAY_WORDS and words <= AWAY_WORDS | PLAIN_WORDS:
                found = "maybe"
            elif words & (AWAY_WORDS | APART_WORDS) and not found:
                found = "apart"
    return found


def _is_element(name: str) -> bool:
    """Whether an element is kept on the stack while it is open."""
    return name in CONTAINERS or name in ("p", "span", "button")


def _closed(stack: list[tuple], name: str, end: bool) -> list[tuple]:
    """Take off the stack what a tag closes; gives what was taken off, innermost first."""
    at = len(stack)
    if not end:
        if name == "p" and stack and stack[-1][0] == "p":
            at -= 1
        elif name in CONTAINERS:
            while at and stack[at - 1][0] in ("p", "span", "button"):
                at -= 1
        if name == "li" and at and stack[at - 1][0] == "li":
            at -= 1
    else:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] == name:
                at = depth
                break
            if name in ("p", "span", "button") and stack[depth][0] in CONTAINERS:
                break
    gone = stack[at:][::-1]
    del stack[at:]
    return gone


def spared(page: str) -> set[int]:
    """Where those elements begin that may be away but hold the page's text: an article or
    main with text, or, on a page without these, more than half of all text. An article
    inside another is a comment on it and no sign; text of links doesn't count."""
    # Element, away, in article or main, below an article, maybe, begin, letters and texts before.
    stack: list[tuple] = []
    letters = texts = 0
    holds, sizes = set(), []
    in_link = False

    def leave(gone: list[tuple]):
        nonlocal texts
        for name, away, _, nested, maybe, begin, letters_before, texts_before in gone:
            if name in ("article", "main") and not away and not nested and letters > letters_before:
                texts += 1
            if maybe:
                if texts > texts_before:
                    holds.add(begin)
                sizes.append((begin, letters - letters_before))

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not in_link and not (stack and stack[-1][1]):
            letters += len("".join(_SOUND.findall(html.unescape(page[at : m.start()]))))
        at = m.end()
        name = (m["name"] or "").lower()
        if name == "a":
            in_link = not m["end"]
        if name in CONTAINERS:
            in_link = False
        if not _is_element(name):
            continue
        leave(_closed(stack, name, bool(m["end"])))
        if not m["end"]:
            away, inside = stack[-1][1:3] if stack else (False, False)
            nested = bool(stack) and (stack[-1][3] or stack[-1][0] == "article")
            mine = sign(name, m["rest"], inside, nested)
            stack.append(
                (name, away or mine == "away", inside or name in ("article", "main"), nested,
                 mine == "maybe", m.start(), letters, texts)
            )
    if not in_link and not (stack and stack[-1][1]):
        letters += len("".join(_SOUND.findall(html.unescape(page[at:]))))
    leave(stack[::-1])
    return holds if texts else {begin for begin, n in sizes if 2 * n > letters}


class Line(NamedTuple):
    text: str
    weight: float
    #: In an article or main; the element that sets it apart (0: none); a heading; links alone.
    sure: bool
    apart: int
    heading: bool
    linked: bool


def _letters(pieces: list[str]) -> int:
    return len("".join(_SOUND.findall(html.unescape(" ".join(pieces)))))


def lines_of(page: str) -> list[Line]:
    """The lines of a page, what is no main text for certain left out."""
    out: list[Line] = []
    text: list[str] = []
    own: list[str] = []
    link: list[str] = []
    # Element, no main text, in an article or main, below an article, set apart by.
    stack: list[tuple[str, bool, bool, bool, int]] = []
    away = sure = heading = in_link = False
    apart = n_apart = tags = 0
    spare = None  # where spared elements begin, once it is asked for

    def close():
        nonlocal tags, heading
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                mine, other = _letters(own), _letters(link)
                weight = mine * mine / (mine + other + TAG * tags) if mine else 0.0
                out.append(Line(line, weight, sure, apart, heading, other > 0 and mine == 0))
            for part in (text, own, link):
                part.clear()
        tags, heading = 0, False

    def take(piece: str):
        text.append(piece)
        (link if in_link else own).append(piece)

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not away:
            take(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        tags += not m["end"]
        if name == "a":
            in_link = not m["end"]
            continue
        if name not in BLOCKS and name not in ("span", "b", "i", "button"):
            continue
        if name in BLOCKS:
            close()
            heading = name in HEADINGS and not m["end"]
        if not _is_element(name):
            continue
        if name in CONTAINERS:
            in_link = False
        _closed(stack, name, bool(m["end"]))
        if not m["end"]:
            _, mine, inside, nested, by = stack[-1] if stack else ("", False, False, False, 0)
            if not mine:
                found = sign(name, m["rest"], inside, nested)
                if found == "maybe" and spare is None:
                    spare = spared(page)
                mine = found == "away" or found == "maybe" and m.start() not in spare
                if found == "apart":
                    by = n_apart = n_apart + 1
            stack.append((name, mine, inside or name in ("article", "main"), nested or name == "article", by))
        _, away, sure, _, apart = stack[-1] if stack else ("", False, False, False, 0)
    if at < len(page) and not away:
        take(page[at:])
    close()
    return out


def window_sums(weights: list[float], apart: list[int]) -> list[float]:
    """Sum of the weights around each line, of lines set apart by the same element only."""
    half = WINDOW // 2
    out = []
    for i in range(len(weights)):
        near = range(max(0, i - half), min(len(weights), i + half + 1))
        out.append(sum(weights[j] for j in near if apart[j] == apart[i]))
    return out


def threshold(weights: list[float], sums: list[float]) -> float:
    """From the page's distribution: a share of the window in which a letter of its text
    lies on average."""
    total = sum(weights)
    typical = sum(w * s for w, s in zip(weights, sums)) / total if total else 0.0
    return min(SURGE * typical, ENOUGH)


def selected(lines: list[Line]) -> list[Line]:
    """The lines from the first surge to the last dive.

    A line is high if it is sure or its window reaches the threshold. The text begins with
    the first high line that has text of its own (headings right before it included) and ends
    with the last. In between go menus, and lines set apart that aren't high."""
    weights, apart = [x.weight for x in lines], [x.apart for x in lines]
    sums = window_sums(weights, apart)
    least = threshold(weights, sums)
    high = [x.sure or s > 0 and s >= least for x, s in zip(lines, sums)]
    text = [i for i, x in enumerate(lines) if high[i] and (x.sure or x.weight > 0)]
    if not text:
        return []
    first, last = text[0], text[-1]
    while first and lines[first - 1].heading and not lines[first - 1].linked and not lines[first - 1].apart:
        first -= 1
    out = []
    for i in range(first, last + 1):
        x = lines[i]
        beside = [lines[j] for j in (i - 1, i + 1) if 0 <= j < len(lines)]
        menu = x.linked and any(y.linked and not y.sure for y in beside)
        if x.sure or not menu and (not x.apart or high[i]):
            out.append(x)
    return out


def main_text(page: str) -> str:
    """The selected lines joined by one space; empty if there is no text."""
    return " ".join(x.text for x in selected(lines_of(page)))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = [main_text(x) for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url").cast(pa.string()), pa.array(text, pa.string()),
             pa.array([len(x) for x in text], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``.

    Null html is empty and gives empty text; repeated rows each give their row; an empty
    table gives none. A page is read whole and each alone: no shuffle. Other columns are
    not read.
    """
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        text_of("html").alias("html"),
    )
    return own.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
