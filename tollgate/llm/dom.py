"""A tolerant HTML reader: blocks of visible text, and the page's folded tree for alignment.

Parts that name themselves as something else than the article are left out. Some are so by tag, role or style, whatever they
hold. Others only by a word in class or id; such a name is not believed where the element holds an article or the main part, or,
on a page without either, more than half of the text (comments are never the article). Every step works on the next sign or on the innermost
open element of a kind, so time grows with the length of the page.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>")
ATTRIBUTE = re.compile(r"([a-zA-Z:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
CLASS_WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag closes these when they are open, up to the nearest of the boundaries.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}

#: Parts of a page that are not its article: by tag, by role, and by the first or last word of a class or id.
NOISE_TAGS = RAW | frozenset("head nav footer aside form button select option dialog menu svg canvas object audio video map".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
COMMENT_WORDS = frozenset("comment comments commentlist respond reply replies disqus".split())
NOISE_WORDS = COMMENT_WORDS | frozenset(
    "nav navbar navigation menu footer sidebar aside ad ads advert adverts advertisement advertising banner promo promotion sponsor"
    " sponsored cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share"
    " sharing social related recommended recommendations breadcrumb"
    " breadcrumbs pagination pager widget widgets toolbar login search copyright masthead skip hidden".split()
)
#: Words that make a class tell of a state or a frame: `has-sidebar`, `comments-open`.
STATE_WORDS = frozenset("has with no without is not open opened closed enabled disabled wrap wrapper layout".split())
HEADER_WORDS = frozenset({"header", "topbar"})
MOST = 0.5  # share of text beyond which a region is the article, and an element no noise


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


def class_words(own: dict[str, str]) -> set[str]:
    return set(CLASS_WORD.findall(f"{own.get('class', '')} {own.get('id', '')}".lower()))


def noise_words(own: dict[str, str]) -> set[str]:
    """Noise words that begin or end a class or the id, unless it has a word of a state."""
    found: set[str] = set()
    for token in f"{own.get('class', '')} {own.get('id', '')}".lower().split():
        words = CLASS_WORD.findall(token)
        if words and not STATE_WORDS.intersection(words):
            found |= {words[0], words[-1]} & NOISE_WORDS
    return found


def is_noise(tag: str, own: dict[str, str]) -> bool:
    """Noise whatever it holds."""
    if tag in NOISE_TAGS or own.get("role", "").lower() in NOISE_ROLES:
        return True
    return "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "")


class Named:
    """An element that is noise by its name alone."""

    __slots__ = ("outer", "comments", "holds_article", "characters", "noise")

    def __init__(self, outer: Named | None, comments: bool):
        self.outer, self.comments = outer, comments or (outer is not None and outer.comments)
        self.holds_article, self.characters, self.noise = False, 0, False


class Element:
    """An open element: its folded node, whether it is skipped, in a header, its region, and the named noise around it."""

    __slots__ = ("tag", "node", "skipped", "header", "region", "named")

    def __init__(self, tag: str, node: int, skipped: bool = False, header: bool = False, region: int = 0, named: Named | None = None):
        self.tag, self.node, self.skipped, self.header, self.region, self.named = tag, node, skipped, header, region, named


class Page:
    """Blocks (folded node, region, text, named noise) in page order, and the folded tree as (parent, key) pairs.

    In the folded tree, neighbouring children with the same tag and classes are one node, so a list of any length and a
    run of paragraphs have the shape of one item. Region is 2 in an article, 1 in a main part, 0 elsewhere.
    """

    def __init__(self, html: str):
        self.parents, self.keys = [-1], ["#"]
        self.last_child: list[int] = [-1]
        self.blocks: list[tuple[int, int, str, Named | None]] = []
        self.buffer: list[str] = []
        self.open = [Element("#", 0)]
        self.places: dict[str, list[int]] = defaultdict(list)  # of open elements, by tag
        self.block_places, self.headings = [0], 0
        self.named: list[Named] = []  # outer ones first
        self.read(html)
        self.flush()
        del self.last_child, self.buffer, self.open, self.places, self.block_places

    def flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        self.buffer.clear()
        if text:
            inner = self.open[self.block_places[-1]]
            self.blocks.append((inner.node, inner.region, text, inner.named))

    def text(self, text: str, plain: bool = False) -> None:
        inner = self.open[-1]
        if not inner.skipped and not (inner.header and not self.headings):
            self.buffer.append(text if plain else unescape(text))

    def push(self, element: Element) -> None:
        self.places[element.tag].append(len(self.open))
        if element.tag in BLOCKS:
            self.block_places.append(len(self.open))
        self.headings += element.tag in HEADINGS
        self.open.append(element)

    def pop_to(self, depth: int) -> None:
        if self.block_places[-1] >= depth:
            self.flush()
        while len(self.open) > depth:
            element = self.open.pop()
            self.places[element.tag].pop()
            self.headings -= element.tag in HEADINGS
            if self.block_places[-1] == len(self.open):
                self.block_places.pop()

    def innermost(self, tags: set[str] | tuple[str, ...]) -> int:
        """Place of the innermost open element with one of the tags; 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def start(self, tag: str, rest: str) -> None:
        if tag in BLOCKS:
            self.flush()
            place = self.innermost(("p", "table", "td", "th", "button"))
            if self.open[place].tag == "p":
                self.pop_to(place)
        if tag in CLOSES:
            ends, bounds = CLOSES[tag]
            place = self.innermost(ends)
            if place > self.innermost(bounds):
                self.pop_to(place)
        if tag in ("br", "hr", "td", "th", "img", "wbr"):
            self.text("" if tag == "wbr" else " ")
        if tag in VOID:
            return
        own = attributes(rest) if "=" in rest or "hidden" in rest else {}
        words = class_words(own) if own else set()
        outer = self.open[-1]
        key = tag + "".join("." + w for w in sorted(words))
        node = self.last_child[outer.node]
        if node < 0 or self.keys[node] != key:
            node = len(self.keys)
            self.parents.append(outer.node)
            self.keys.append(key)
            self.last_child.append(-1)
            self.last_child[outer.node] = node
        element = Element(tag, node, outer.skipped or is_noise(tag, own), outer.header, outer.region, outer.named)
        noise = noise_words(own) if words and tag not in ("html", "body", "main") and tag not in HEADINGS else set()
        if noise and (tag != "article" or noise & COMMENT_WORDS):
            element.named = Named(outer.named, bool(noise & COMMENT_WORDS))
            self.named.append(element.named)
        main = tag == "main" or own.get("role") == "main"
        if (tag == "article" or main) and not element.skipped and not (element.named and element.named.comments):
            element.region = 2 if tag == "article" else max(element.region, 1)
            around = outer.named
            while around is not None and not around.holds_article:
                around.holds_article, around = True, around.outer
        if tag == "header" or (words & HEADER_WORDS and tag not in HEADINGS and tag not in ("html", "body", "main", "article")):
            element.skipped, element.header = element.skipped or element.region < 2, True  # an article's header gives its headings
        self.push(element)

    def end(self, tag: str) -> None:
        if self.places.get(tag):
            self.pop_to(self.places[tag][-1])
        elif tag in BLOCKS:
            self.flush()

    def read(self, html: str) -> None:
        at, last = 0, html.rfind(">")
        absent: set[str] = set()  # ends that the rest of the page lacks
        while (sign := html.find("<", at)) >= 0:
            if sign > at:
                self.text(html[at:sign])
            at = sign + 1
            if html.startswith("!--", at):
                close = html.find("-->", at)
                at = close + 3 if close >= 0 else len(html)
            elif html.startswith("![CDATA[", at) and "]]>" not in absent and (close := html.find("]]>", at)) >= 0:
                self.text(html[at + 8 : close], plain=True)
                at = close + 3
            elif html[at : at + 1] in ("!", "?") and at <= last:
                if html.startswith("![CDATA[", at):
                    absent.add("]]>")
                at = html.find(">", at) + 1
            elif at > last or not (match := TAG.match(html, sign)):
                self.text("<")
            else:
                at = match.end()
                tag = match[2].lower()
                if match[1]:
                    self.end(tag)
                    continue
                self.start(tag, match[3])
                if tag in RAW:
                    close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(html, at)
                    at = close.end() if close else len(html)
                    self.pop_to(len(self.open) - 1)
        self.text(html[at:])

    def article(self) -> list[tuple[int, str]]:
        """(folded node, text) of the blocks of the articles, if they have most of the text of the main part (or page); else of
        the main part, if it has half as much of the page's text; else of the whole page. Named noise is left out."""
        for named in self.named:
            named.characters = 0
        for *_, text, named in self.blocks:
            if named is not None:
                named.characters += len(text)
        for named in reversed(self.named):
            if named.outer is not None:
                named.outer.characters += named.characters
        most = MOST * sum(len(text) for *_, text, _ in self.blocks)
        marked = any(region and not (named and named.comments) for _, region, _, named in self.blocks)
        for named in self.named:
            article = named.holds_article or (not marked and named.characters > most)
            named.noise = named.comments or not article or (named.outer is not None and named.outer.noise)
        blocks = [(node, region, text) for node, region, text, named in self.blocks if named is None or not named.noise]
        sizes = [sum(len(text) for _, region, text in blocks if region >= least) for least in range(3)]
        best = 0
        if sizes[1] and sizes[1] >= MOST / 2 * sizes[0]:
            best = 1
        if sizes[2] and sizes[2] >= MOST * sizes[best]:
            best = 2
        return [(node, text) for node, region, text in blocks if region >= best]
