import random

import pandas as pd
import pytest

from tests.llm.conftest import as_rows, clashing
from tidelog.llm import extract

PAGES = "page_id long, url string, html string"
CASES = {
    "": "",
    "plain text": "plain text",
    "<p>a<b>b</b>c<br>d": "abc d",
    '<script>var x="</p>"</script>x': "x",
    "<p>a &amp;amp; b&nbsp;c &eacute;&#233;</p>": "a &amp; b c éé",
    "<nav><ul><li><a href=/a>A</a></ul></nav><div role=alert>N</div><p>Body <a href=b>link</a> more</p>"
    "<ul class=related><li><a>r</a></ul>": "Body link more",
    "<div><a href=1>Home</a> | <a href=2>About</a></div><h1>T</h1><p>Text text</p>": "T Text text",
    "<article><h1>T</h1><p>A <span class=ad>x</span> b</p><!-- c > d --><p>z</p></article>": "T A b z",
    "<body><div class=menu><a href=x>m</a></div><div class=content><p>Long text of the page.</p><p>S.</p></div>"
    "<div class=sidebar><p>Other</p></div><div id=comments><div class=comment><p>c</p></div></div></body>": "Long text of the page. S.",
    "<header><h1>Site</h1></header><div id=cookie-banner>We use cookies</div><main><article><header><h1>T</h1></header>"
    "<p>One.</p><div class='ad box'>Buy</div><p>Two</p><form>q<input></form><section class=comments><article class=comment>"
    "<p>Nice</p></article></section></article></main><aside>S</aside><footer>F</footer>": "T One. Two",
    "<p title='a > b'>x</p><style>p{}</style><textarea>no</textarea><p>y": "x y",
    "<article><p>" + "w " * 200_000 + "</p></article>": ("w " * 200_000).strip(),
}


@pytest.mark.parametrize("page", CASES, ids=range(len(CASES)))
def test_cases(page):
    assert extract.main_text(page) == CASES[page]


LINKS = "<ul><li><a href=1>a</a></li><li><a href=2>b</a></li><li><a href=3>c</a></li><li><a href=4>d</a></li></ul>"
BODY = "<p>" + "Long text of the body. " * 20 + "</p>"
LONG = BODY[3:-5].strip()
OPENING = "An opening paragraph that stands by itself, before the list."
CLOSING = "A closing paragraph that stands by itself, after the other list."


@pytest.mark.parametrize(
    "page, want",
    [
        # A sentence apart from the body is text, however long the body is; a word is not.
        (f"<p>{OPENING}</p>{LINKS}{BODY * 9}{LINKS}<p>{CLOSING}</p>", " ".join([OPENING, *[LONG] * 9, CLOSING])),
        # A class of the whole page, or a form around it, takes nothing away.
        (f"<div class='has-sidebar'>{BODY}<div class=sidebar><p>Other</p></div></div>", LONG),
        (f"<div class='row noSidebar'><p>Short.</p></div>{BODY}", f"Short. {LONG}"),
        (f"<form id=aspnetForm><div class=menu><a href=x>m</a></div>{BODY}</form>", LONG),
        (f"<form><main><p>Text.</p></main><p>{'Small print. ' * 9}</p></form>", f"Text. {('Small print. ' * 9).strip()}"),
        ("<div class='page widget'><article><p>Text.</p></article></div><p>End.</p>", "Text. End."),
        # A form, class or comment that doesn't hold the page's text still goes.
        (f"{BODY}<form><p>Name</p></form><div class=comments><p>c</p></div>", LONG),
        (f"<article><p>Text.</p></article><div class=comments>{BODY}</div>", "Text."),
        (f"<article><p>Text.</p><div class=comments><article>{BODY}</article></div></article>", "Text."),
        (f"<div class=sidebar><nav><article>{BODY}</article></nav><p>x</p></div><main><p>Text.</p></main>", "Text."),
    ],
    ids=range(10),
)
def test_nothing_but_boilerplate_goes(page, want):
    assert extract.main_text(page) == want


def test_rows(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (2, None, None), (None, "u", "<nav>x</nav>")]
    out = as_rows(extract.extract(clashing(spark.createDataFrame(rows, PAGES))), "page_id", "url", "text", "n_chars")
    assert out == sorted([(1, "u", "a", 1)] * 2 + [(2, None, "", 0), (None, "u", "", 0)], key=repr)
    assert extract.extract(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<article class='post comments-open'>{BODY}</article>", LONG),
        (f"<article class='post has-comments' data-comments='12'>{BODY}</article>", LONG),
        (f"<article id=comments>{BODY}</article>", LONG),
        (f"<article>{BODY}<article class=comment><p>Nice</p></article></article>", LONG),
        (f"<article>{BODY}<article itemtype='http://schema.org/Comment'><p>Nice</p></article></article>", LONG),
        (f"<article>{BODY}<article class=post><p>Nice</p></article></article>", f"{LONG} Nice"),
        *[
            (f"<article>{BODY}{inner}<p>End</p></article>", f"{LONG} Kept End")
            for inner in (
                "<section id=related-work><p>Kept</p></section>", "<div id=search-algorithms>Kept</div>",
                "<div id=privacy>Kept</div>", "<p class=share>Kept</p>", "<p><span class=social>Kept</span></p>",
                "<div class=sidebar-note>Kept</div>", "<p class=notice>Kept</p>",
            )
        ],
        # Lines without letters are text inside an article, wherever they stand.
        (f"<article>{BODY}<p>***</p><table><tr><td>-</td><td>-</td><td>-</td></tr></table></article>", f"{LONG} *** - - -"),
        (f"{BODY}<p>***</p><p>* * *</p><p>--</p>{BODY}", f"{LONG} *** * * * -- {LONG}"),
        # Unmarked or merely hinted side text goes, unmarked menus too.
        (f"<div class=left><p>Weather today…</p><p>Sign up now for deals!</p></div><div>{BODY}</div>", LONG),
        (f"<p>Buy</p><p>Cheap</p><p><a href=1>More</a></p><p><a href=1>Here</a></p>{BODY * 2}", f"{LONG} {LONG}"),
        (f"<div id=x><p><a href=1>Home</a> <a href=2>News</a></p><p><a href=3>Sport</a></p></div>{BODY}", LONG),
        (f"{BODY}{LINKS}{BODY}", f"{LONG} {LONG}"),
        (f"{BODY}<p><a href=1>One link in the text</a></p>{BODY}", f"{LONG} One link in the text {LONG}"),
        # Hints don't take away text that surges by itself.
        (f"{BODY}<div id=search-algorithms>{BODY}</div>{BODY}", f"{LONG} {LONG} {LONG}"),
        (f"{BODY}<div class=left-column>{BODY}</div>", f"{LONG} {LONG}"),
        # A title in a container of its own belongs to the text.
        (f"<div class=top><h1>Title</h1></div><div class=body>{BODY}</div>", f"Title {LONG}"),
    ],
)
def test_line_blocks_decide_and_classes_hint(page, want):
    assert extract.main_text(page) == want


def brute(weights, apart, sure):
    """Windows, threshold, surge and dive by their definition."""
    sums = [
        sum(w for j, w in enumerate(weights) if abs(i - j) <= 1 and apart[j] == apart[i]) for i in range(len(weights))
    ]
    letters = [(w, s) for w, s in zip(weights, sums)]
    typical = sum(w * s for w, s in letters) / sum(weights) if sum(weights) else 0
    high = [c or s > 0 and s >= min(0.1 * typical, 40) for c, s in zip(sure, sums)]
    text = [i for i in range(len(weights)) if high[i] and (sure[i] or weights[i])]
    return [i for i in range(min(text), max(text) + 1) if not apart[i] or high[i] or sure[i]] if text else []


def test_windows_equal_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randint(0, 14)
        weights = [rng.choice([0, 0, 1, 3, 12, 60, 400]) for _ in range(n)]
        apart = [rng.choice([0, 0, 0, 1, 2]) for _ in range(n)]
        sure = [rng.random() < 0.1 for _ in range(n)]
        lines = [extract.Line(str(i), float(weights[i]), sure[i], apart[i], False, False) for i in range(n)]
        assert [int(x.text) for x in extract.selected(lines)] == brute(weights, apart, sure)


def test_articles_of_the_table_come_whole():
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    for page in pages["html"]:
        inside = page.partition("<article>")[2].partition("</article>")[0]
        want = inside
        for tag in ("p", "h1", "br"):
            want = want.replace(f"<{tag}>", " ").replace(f"</{tag}>", " ")
        want = want.replace("<b>", "").replace("</b>", "")
        assert extract.main_text(page) == " ".join(extract.html.unescape(want).split())
