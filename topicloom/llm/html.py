"""Main text of web pages by two-pass block rules.

A scanner cuts the page into blocks at block-level tags. The first pass labels every block, inside or
outside an article, by link density, length and stop-word density: good, bad, or undecided (short; a
heading; nearly good; long without stop words, which is undecided in an article and bad elsewhere). In the
second pass an undecided block takes the label of its nearest decided neighbours: the one both sides share;
where they differ, good in an article, elsewhere good for a nearly good block or a heading over good text,
and the nearer side's otherwise (bad if both are as near).

Markup is evidence for these rules. Menus, headers, footers, sidebars, notices, adverts, forms and reader
comments, by tag, role or a class or id that names one, are decided bad blocks; within an article they are
not neighbours. The borders of an article count as good neighbours from inside, the page's ends as bad ones;
the other side of an article's border is no neighbour. Articles whose kept text is at least as long as the good text outside
are believed: what lies outside goes. Otherwise blocks outside stay by the rules, too. If nothing is good, stop words
say nothing about the page's language: length decides alone; if still nothing is, undecided blocks stay;
and if names of classes condemned all text, they are ignored.

The scanner is linear: closing tags find their partner in a list of each tag's places, an unclosed quote is
looked for once, a raw element without its closing tag ends at the next block-level tag, a comment without its
end at the next '>'. Text after a last '<' and a name, without '>', is a tag's beginning and goes. It
holds one page. Null html counts as empty; pages are independent, so repeated rows give equal results. An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import session

MAX_LINKS, ALL_LINKS, SHORT, LONG, STOPS_LOW, STOPS_HIGH = 0.33, 0.9, 70, 200, 0.10, 0.18
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that end when another of their kind opens beside them.
SIBLINGS = frozenset("li dt dd tr td th".split())
#: Elements whose content is no text of the page: of the first kind it ends at the first closing tag, of the second it may nest.
RAW = frozenset("script style textarea iframe title noframes".split())
OPAQUE = frozenset("noscript template object svg math select button canvas audio video".split())
FURNITURE = frozenset("nav footer aside menu dialog head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar alertdialog".split())
#: Parts of class and id tokens that name furniture; a token that begins or ends with one of FIRST or LAST speaks of something else, and so does one with a part that is neither a name nor a word for a place on a page.
NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead comments commentlist disqus respond replies share sharing social related recommended recommendations widget widgets login signup pagination paginator pager".split())
FIRST, LAST = frozenset("has no with without hide show is not single post entry article content".split()), frozenset("open closed enabled disabled on off count".split())
PLACES = frozenset("area articles aside banner bar block bottom box button buttons col column container content desktop fixed footer form global group h header home icon icons inner item items label left link links list local main mobile module news outer page panel posts primary right row secondary section site slot sticky stories strip text top unit v wrap wrapper zone".split())
READERS = frozenset("comment reply comment-body comment-content comment-text".split())
PAGE_HEADS = frozenset("header banner topbar".split())
NAME = re.compile(r"[A-Za-z][A-Za-z0-9:-]*")
REST = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TELLING = re.compile("class|id|role|hidden|style|href", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
NEXT_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS))})(?=[\s/>])", re.I)
WORD = re.compile(r"[^\W\d_]+")
#: Frequent function words of the four languages.
STOPS = {
    "en": frozenset("a an and are as at be been but by can for from had has have he her his i if in into is it its more no not of on one or our she so than that the their them there they this to was we were what when which who will with would you your".split()),
    "de": frozenset("als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im in ist mit nach nicht noch nur oder sich sie sind so um und von vor war was wie wir zu zum zur über".split()),
    "fr": frozenset("à au aux avec ce ces cette comme dans de des du elle en est et été être il ils je la le les leur lui mais ne nous on ou par pas plus pour qu que qui sa se ses si son sont sur un une vous y".split()),
    "es": frozenset("a al como con de del el ella en entre era es esta este ha hay la las le lo los más me mi muy no nos o para pero por que se ser si sin sobre son su sus también un una uno y ya".split()),
}


@dataclass
class Block:
    region: int  # 0: outside articles; else the article's number
    heading: bool
    tagged: bool  # furniture by its tag or role
    named: bool  # furniture by its class or id
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def names_furniture(token: str) -> bool:
    parts = [p.lower() for p in PART.findall(token)]
    if not parts or parts[0] in FIRST or parts[-1] in LAST:
        return False
    if "".join(parts) in NAMES or token.lower() in READERS:
        return True
    return any(p in NAMES for p in parts) and all(p in NAMES or p in PLACES or p.isdigit() for p in parts)


def evidence(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, bool]:
    """Of an element: furniture by tag, role or style; furniture by a name; a link."""
    tagged, named, link = tag in FURNITURE or (tag == "header" and not inside), False, False
    if attributes and TELLING.search(attributes):
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and "display:none" in value.replace(" ", "").lower()):
                tagged = True
            elif name == "role":
                tagged = tagged or value.lower() in ROLES
            elif name == "href":
                link = tag == "a"
            elif name in ("class", "id"):
                tokens = value.split()
                if tag == "article":
                    named = named or any(t.lower() in READERS for t in tokens)
                elif tag not in ("html", "body", "main"):
                    named = named or any(map(names_furniture, tokens)) or (not inside and any(t.lower() in PAGE_HEADS for t in tokens))
    return tagged, named, link


class Scanner:
    def __init__(self, html: str):
        self.html, self.found, self.open = html, [], None
        self.stack: list[list] = []  # open elements: tag, then what they count in state
        self.places: dict[str, list[int]] = {}  # where in the stack each tag is open
        self.block_places: list[int] = []
        self.state = {"tagged": 0, "named": 0, "forms": 0, "inside": 0, "links": 0, "headings": 0}
        self.regions, self.no_close, self.quotes_end = 0, set(), True
        self.opaque_ends: dict[str, dict[int, int]] = {}

    def close(self) -> None:
        if self.open is not None:
            self.open.text = " ".join("".join(self.open.parts).split())
            if self.open.text:
                self.found.append(self.open)
            self.open = None

    def text(self, s: str) -> None:
        if not s:
            return
        if self.open is None:
            if s.isspace():
                return
            on = self.state
            self.open = Block(self.regions if on["inside"] else 0, on["headings"] > 0, on["tagged"] > 0 or (on["forms"] > 0 and not on["inside"]), on["named"] > 0)
        s = unescape(s) if "&" in s else s
        self.open.parts.append(s)
        if self.state["links"]:
            self.open.linked += len("".join(s.split()))

    def push(self, tag: str, counts: tuple[str, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS:
            self.block_places.append(len(self.stack))
        if "inside" in counts and not self.state["inside"]:
            self.regions += 1
        for c in counts:
            self.state[c] += 1
        self.stack.append([tag, counts])

    def pop(self, k: int) -> None:
        while len(self.stack) > k:
            tag, counts = self.stack.pop()
            if tag is None:
                continue
            self.places[tag].pop()
            if tag in BLOCKS:
                self.block_places.pop()
            for c in counts:
                self.state[c] -= 1

    def end(self, tag: str) -> None:
        at = self.places.get(tag)
        if not at:
            return
        if tag in BLOCKS or not self.block_places or at[-1] > self.block_places[-1]:
            self.pop(at[-1])
        else:  # an inline element that ends within a block opened inside it: the block stays open
            entry = self.stack[at.pop()]
            for c in entry[1]:
                self.state[c] -= 1
            entry[0] = None

    def after(self, tag: str, lt: int, at: int) -> int:
        """Where the page goes on behind an element without text of its own."""
        if tag in RAW:
            found = None if tag in self.no_close else re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(self.html, at)
            if found:
                return found.end()
            self.no_close.add(tag)
        else:
            if tag not in self.opaque_ends:
                ends, opened = {}, []
                for m in re.compile(rf"<(/?){tag}(?=[\s/>])", re.I).finditer(self.html):
                    if not m[1]:
                        opened.append(m.start())
                    elif opened:
                        ends[opened.pop()] = m.end()
                self.opaque_ends[tag] = ends
            if (stop := self.opaque_ends[tag].get(lt)) is not None:
                gt = self.html.find(">", stop)
                return len(self.html) if gt < 0 else gt + 1
        found = NEXT_BLOCK.search(self.html, at)
        return found.start() if found else len(self.html)

    def run(self) -> list[Block]:
        html, at, end = self.html, 0, len(self.html)
        while at < end:
            lt = html.find("<", at)
            if lt < 0:
                self.text(html[at:])
                break
            self.text(html[at:lt])
            nxt = html[lt + 1 : lt + 2]
            if nxt in ("!", "?"):
                gt = html.find("-->", lt + 2) if html.startswith("<!--", lt) and "--" not in self.no_close else -1
                if gt < 0 and html.startswith("<!--", lt):
                    self.no_close.add("--")
                gt = gt + 3 if gt >= 0 else html.find(">", lt) + 1
                at = gt or end
                continue
            closing = nxt == "/"
            name = NAME.match(html, lt + 1 + closing)
            if not name:
                if closing:
                    at = html.find(">", lt) + 1 or end
                else:  # a bare less-than sign
                    self.text("<")
                    at = lt + 1
                continue
            rest = REST.match(html, name.end()) if self.quotes_end else None
            self.quotes_end = rest is not None
            gt = rest.end() if rest else html.find(">", name.end()) + 1
            if not gt:  # cut inside a tag
                break
            tag, attributes, at = name[0].lower(), html[name.end() : gt - 1], gt
            if closing:
                if tag in BLOCKS:
                    self.close()
                self.end(tag)
                continue
            if tag in RAW or tag in OPAQUE:
                if not attributes.endswith("/") or tag in RAW:
                    at = self.after(tag, lt, at)
                continue
            if tag == "br":
                self.text(" ")
                continue
            if tag in BLOCKS:
                self.close()
                if self.block_places:  # a paragraph ends at any block, an item at the next one
                    top = self.stack[self.block_places[-1]][0]
                    if top == "p" or (top == tag and tag in SIBLINGS):
                        self.pop(self.block_places[-1])
            if tag in VOID or attributes.endswith("/"):
                continue
            inside = self.state["inside"] > 0
            tagged, named, link = evidence(tag, attributes, inside)
            if link and self.state["links"]:  # a link ends where another begins
                self.end("a")
            counts = [k for k, on in (("tagged", tagged or (tag == "form" and inside)), ("named", named), ("forms", tag == "form" and not inside), ("inside", tag in ("article", "main")), ("links", link), ("headings", tag in HEADINGS)) if on]
            self.push(tag, tuple(counts))
        self.close()
        return self.found


def blocks(html: str) -> list[Block]:
    """All blocks of the page in order."""
    return Scanner(html).run()


def first_label(block: Block, names: bool = True, stops: bool = True) -> str:
    """good or bad, or why it is undecided: near, low or short."""
    length = len(block.text)
    if block.tagged or (names and block.named):
        return "bad"
    share_linked = block.linked / max(1, len(block.text.replace(" ", "")))
    if block.region and MAX_LINKS < share_linked < ALL_LINKS:  # an article's paragraph may be full of links
        return "low"
    if share_linked > MAX_LINKS or ("©" in block.text and length < LONG and not block.region):
        return "bad"
    if length < SHORT or block.heading:
        return "short"
    words = [w.lower() for w in WORD.findall(block.text)]
    share = max(sum(map(stops_of.__contains__, words)) for stops_of in STOPS.values()) / max(1, len(words))
    if share >= STOPS_HIGH or not stops:
        return "good" if length > LONG else "near"
    if share >= STOPS_LOW:
        return "near"
    return "low" if block.region else "bad"


def _decided(found: list[Block], labels: list[str], order) -> list[tuple[str, int]]:
    """For each block the nearest decided label on one side, in its region, and how many blocks away."""
    out, last = [("", 0)] * len(found), {}
    step = {}
    for k in order:
        region = found[k].region
        step[region] = step.get(region, 0) + 1
        label, where = last.get(region, ("good" if region else "bad", 0))
        out[k] = (label, step[region] - where)
        if labels[k] == "good" or (labels[k] == "bad" and not (region and (found[k].tagged or found[k].named))):
            last[region] = (labels[k], step[region])
    return out


def second_labels(found: list[Block], labels: list[str]) -> list[bool]:
    """Whether each block is good once undecided ones have taken their neighbours' label."""
    before, after = _decided(found, labels, range(len(found))), _decided(found, labels, range(len(found) - 1, -1, -1))
    out = []
    for block, label, (a, to_a), (b, to_b) in zip(found, labels, before, after):
        if label not in ("good", "bad"):
            if a == b:
                label = a
            elif block.region or label == "near" or (block.heading and b == "good"):
                label = "good"
            else:
                label = a if to_a < to_b else b if to_b < to_a else "bad"
        out.append(label == "good")
    return out


def judged(found: list[Block]) -> list[bool]:
    """Whether each block of a page is main text."""
    for names in (True, False):
        labels = []
        for stops in (True, False):
            labels = [first_label(b, names, stops) for b in found]
            good = second_labels(found, labels)
            inside = sum(len(b.text) for b, g in zip(found, good) if g and b.region)
            outside = sum(len(b.text) for b, x in zip(found, labels) if x == "good" and not b.region)
            if inside and inside >= outside:
                good = [g and b.region > 0 for b, g in zip(found, good)]
            if any(good):
                return good
        good = [x != "bad" for x in labels]
        if any(good):
            return good
    return good if found else []


def extract(html: str) -> str:
    found = blocks(html)
    return "\n".join(b.text for b, good in zip(found, judged(found)) if good)


def reasons(html: str) -> Counter:
    """How many blocks the first pass decided or left to the second, for reports: (inside an article, first label, kept)."""
    found = blocks(html)
    return Counter((b.region > 0, first_label(b), good) for b, good in zip(found, judged(found)))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row."""
    session(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [extract(html) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
