"""Extraction: nothing is lost to broken markup, and the two passes against a plain version on the tree of Python's parser."""

import random
from html.parser import HTMLParser

import duckdb
import pytest
from pyspark.sql import functions as F

from topicloom.llm import html

GOOD = "This is the text of the page and it is as long as it has to be for the rules to see that it is good, with all the words that a language has and so on until it is long enough to be a good block of the page."


@pytest.mark.parametrize("page,text", [
    ("<nav>" + "<b>" * 250 + "x</nav><article><p>Text</article>", "Text"),
    ("<article><p>" + "İ" * 30 + "<script>İ</SCRIPT ><p>First<p>second</article>", "İ" * 30 + "\nFirst\nsecond"),
    *[(f"<article><p>One<{t}>x<p>Two</article>", "One\nTwo") for t in ("button", "select", "svg", "textarea", "script", "style")],
    ("<article><p>One <button>x</button><svg><svg>y</svg></svg>two</article>", "One two"),
    ('<article class="related-work"><p>abc</article>', "abc"),
    (f'<body class="has-sidebar menu-open"><p>{GOOD}', GOOD),
    (f'<article><p>{GOOD} <a title="The hidden cost" href="/a/hidden-valley">anchor</a> words</article>', f"{GOOD} anchor words"),
    (f'<main><p>{GOOD}<section id="comments"><article class="comment"><p>{GOOD} I say.</article></section></main>', GOOD),
    ("<article><b><p>a</b> c</p><p>d</article>", "a c\nd"),
    ("<article>a <!-- b <p>c</article>", "a c"),
    (f'<form id="page"><div class="menu"><a href="x">Home</a></div><main><p>{GOOD}</main></form>', GOOD),
    (f'<div class="share-of-content sidebar"><p>{GOOD}</div>', GOOD),
    ("<p>Hi", "Hi"),
])
def test_pages(page, text):
    assert html.extract(page) == text


def test_names():
    assert all(map(html.names_furniture, ("ad", "AdBanner", "cookie-notice", "sidebar_left", "mainNav", "share", "comments", "site-footer")))
    assert not any(map(html.names_furniture, ("has-sidebar", "no-ads", "comments-open", "post-share", "adapter", "shared", "hidden", "header", "")))


def test_neighbours_decide_without_markup():
    page = f"<div><a href=a>Home page of all</a></div><div>Stray words.</div><div>x <a href=b>More of it</a></div><h2>Head</h2><div>{GOOD}</div><div>Between.</div><div>{GOOD}</div><div><a href=c>Contact us</a></div><div>Stray end.</div>"
    assert html.extract(page) == f"Head\n{GOOD}\nBetween.\n{GOOD}"
    inside = f"<article><p>{GOOD}<p>Short.<p><a href=1>Read this</a><p>Related:<p><a href=2>And that</a><p>End.</article>"
    assert html.extract(inside) == f"{GOOD}\nShort.\nEnd."


class Plain(HTMLParser):
    """Blocks of well-formed pages: (text, link characters, furniture, article, heading)."""

    def __init__(self):
        super().__init__()
        self.path, self.found, self.text, self.linked = [], [], "", 0

    def flush(self):
        if text := " ".join(self.text.split()):
            tags = [t for t, _ in self.path]
            self.found.append((text, self.linked, (any(t in ("nav", "footer") for t in tags), any(c == "ad" for _, c in self.path)), "article" in tags, any(t in ("h1", "h2") for t in tags)))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag not in ("a", "b"):
            self.flush()
        self.path.append((tag, dict(attrs).get("class")))

    def handle_endtag(self, tag):
        if tag not in ("a", "b"):
            self.flush()
        self.path.pop()

    def handle_data(self, data):
        self.text += data
        self.linked += len("".join(data.split())) if any(t == "a" for t, _ in self.path) else 0


def brute(page):
    p = Plain()
    p.feed(page)
    b, n = p.found, len(p.found)

    def share(t):
        words = ["".join(c for c in w if c.isalpha()).lower() for w in t.split()]
        words = [w for w in words if w]
        return max(sum(w in s for w in words) for s in html.STOPS.values()) / max(1, len(words))

    def run(names, stops):
        first = []
        for t, linked, (tagged, named), inside, heading in b:
            letters = len(t.replace(" ", ""))
            x = "bad" if tagged or (names and named) or linked > 0.33 * letters else "?" if len(t) < 70 or heading else None
            if inside and not (tagged or (names and named)) and 0.33 * letters < linked < 0.9 * letters:
                x = "low"
            if x is None:
                s = share(t) if stops else 1
                x = ("good" if len(t) > 200 else "near") if s >= 0.18 else "near" if s >= 0.1 else "low" if inside else "bad"
            first.append(x)
        out = []
        for k in range(n):
            if first[k] in ("good", "bad"):
                out.append(first[k] == "good")
                continue
            inside, sides = b[k][3], []
            for places in (range(k - 1, -1, -1), range(k + 1, n)):
                mine = [j for j in places if b[j][3] == inside]
                # furniture in an article is no neighbour
                hit = [(i, first[j]) for i, j in enumerate(mine) if first[j] in ("good", "bad") and not (inside and any(b[j][2]))]
                sides.append(hit[0] if hit else (len(mine), "good" if inside else "bad"))
            (da, a), (db, c) = sides
            out.append(a == "good" if a == c else True if inside or first[k] == "near" or (b[k][4] and c == "good") else (a if da < db else c if db < da else "bad") == "good")
        within = sum(len(x[0]) for x, o in zip(b, out) if o and x[3])
        if within and within >= sum(len(x[0]) for x, f in zip(b, first) if f == "good" and not x[3]):
            out = [o and x[3] for o, x in zip(out, b)]
        return first, out

    for names in (True, False):
        (first, out), (length, out2) = run(names, True), run(names, False)
        out = out if any(out) else out2 if any(out2) else [f != "bad" for f in length]
        if any(out):
            break
    return "\n".join(x[0] for x, o in zip(b, out) if o)


def made_up(rng):
    words = "the of and house river told garden in a window morning x#$ ?! über la casa".split()
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n))
    junk = lambda n: " ".join(rng.choice("qrst") * 3 for _ in range(n))

    def block():
        kind = rng.randrange(7)
        if kind < 2:
            return f"<p>{sentence(rng.choice([3, 20, 60]))}</p>"
        if kind == 2:
            return f"<p>{junk(rng.choice([3, 25, 70]))}</p>"
        if kind == 3:
            return f"<h2>{sentence(4)}</h2>"
        if kind == 4:
            return f"<div><a href='x'>{sentence(rng.choice([3, 12]))}</a> {sentence(rng.choice([1, 30]))}</div>"
        if kind == 5:
            return f"<div><b>{sentence(2)}</b> {sentence(6)}</div>"
        return rng.choice([f"<nav><div>{sentence(40)}</div></nav>", f'<div class="ad">{sentence(50)}</div>', f"<footer><p>{sentence(2)}</p></footer>"])

    some = lambda n: "".join(block() for _ in range(rng.randrange(n)))
    return f"<body>{some(6)}{f'<article>{some(8)}</article>' if rng.random() < 0.6 else some(10)}{some(5)}</body>"


def test_against_brute_force():
    rng = random.Random(11)
    pages = [made_up(rng) for _ in range(1500)]
    assert [html.extract(p) for p in pages] == [brute(p) for p in pages]
    assert sum(1 for p in pages if html.extract(p)) > 1000


def test_pages_stripped_of_their_marks(data):
    """Without article, class and id the rules still find nearly all of the text, and little else."""
    kept = lost = more = 0
    for (page,) in duckdb.sql(f"select html from '{data}/pages.parquet'").fetchall():
        want = set(html.extract(page).split("\n"))
        got = set(html.extract(page.replace(' class="ad"', "").replace("<article>", "<div>").replace("</article>", "</div>")).split("\n"))
        size = lambda lines: sum(map(len, lines))
        kept, lost, more = kept + size(want & got), lost + size(want - got), more + size(got - want)
    assert lost < 0.05 * (kept + lost) and more < 0.03 * kept


def test_extra_columns_and_long_pages(spark):
    rows = [(1, "u", "<article><p>" + "a b & c " * 200_000, "x", 7), (1, "u", "<nav>", "y", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = html.main_text(df).orderBy(F.desc("n_chars")).collect()
    assert [r.n_chars for r in got] == [200_000 * 8 - 1, 0] and got[0].text.startswith("a b & c a b")


def test_time_is_linear():
    for s in ('<p a="\'' * 20000, "<b>" * 50000 + "</b>" * 50000, "<a href='x>" * 20000, "<button>" * 20000, "<!--" * 50000, "<script" * 30000, "<li>" * 30000, "</" * 50000, "<nav>" * 30000 + "</b>" * 30000):
        assert isinstance(html.extract(s), str)


LINE = "The committee met in the old hall and it was said that the work of the year would go on as it had been planned by all of them."


@pytest.mark.parametrize("body", [
    f'<p>{LINE}</p><p>See <a href="/a">{LINE[:80]}</a> for this and more.</p><p>{LINE}</p>',
    f"<p>{LINE}</p><p>The sign © stands for a right that is old.</p><p>{LINE}</p>",
    f'<p>{LINE}</p><section class="social-impact"><p>{LINE} {LINE} {LINE}</p></section>',
    f'<p>{LINE}</p><section id="ad-hoc-committee"><p>{LINE} {LINE} {LINE}</p></section>',
    f'<p>{LINE}</p><section class="related-work"><p>{LINE} {LINE} {LINE}</p></section>',
])
def test_an_article_keeps_its_text(body):
    import re

    page = f"<html><body><nav><a href='/'>Home</a></nav><article>{body}</article><footer>© 2020 the site</footer></body></html>"
    want = [re.sub("<[^>]+>", "", p) for p in re.findall("<p>(.*?)</p>", body)]
    assert html.extract(page).split("\n") == want


def test_compound_names_of_furniture():
    assert all(map(html.names_furniture, ["ad", "ads-container", "sidebar-left", "cookie-banner", "related-posts", "social-share", "newsletter_form", "mainNav", "ad-slot-1"]))
    assert not any(map(html.names_furniture, ["social-impact", "ad-hoc-committee", "related-work", "advertising-history", "no-sidebar", "menu-open"]))
