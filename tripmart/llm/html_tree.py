"""A page as blocks of text under elements, each element with a digest of its subtree.

A small helper for `html_text`: it reads one page at a time and knows nothing of other pages.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import xxhash

# Elements without content, elements whose content is no text of the page, elements that
# start a new block, elements that close an open one of the listed kinds, and roles and words of class or id
# that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style noscript template head title nav footer aside form button select option input textarea label"
    " iframe svg math object canvas audio video dialog menu datalist map".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section"
    " summary table caption tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
    "option": ("option",), "body": ("head",),
}
# Where the search for an element to be closed ends.
BORDERS = frozenset("html body table ul ol dl div section article main aside nav header footer form select menu blockquote".split())
UNSEEN_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
UNSEEN_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar masthead footer sidebar aside ad ads advert"
    " adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup"
    " modal overlay newsletter subscribe signup login share sharing social related recommended recommendations pagination pager"
    " comment comments reply replies respond discussion disqus widget skip search".split()
)
HEADER_WORDS = frozenset(["header", "head"])
BESIDE_WORDS = frozenset("has with no without".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
NUMBERS = re.compile(r"\d+")


class Element:
    """One element: its tag, its place in the tree, whether it is marked as no part of the article, and the
    parts of its subtree's digest. ``mute``: within an inline element whose text is not shown."""

    __slots__ = ("tag", "up", "sign", "unseen", "by_word", "spared", "main", "block", "mute", "parts", "digest", "has_text")

    def __init__(self, tag: str, attrs: list, up: Element | None):
        self.tag, self.up = tag, up
        given = dict(attrs) if attrs else {}
        names = f"{given.get('class') or ''} {given.get('id') or ''}"
        self.sign = f"<{tag} {names.strip()} {given.get('role') or ''}>"
        self.main = tag in ("article", "main") or given.get("role") == "main" or given.get("itemprop") == "articleBody"
        self.block = tag in BLOCKS
        inside = self.in_main()
        self.unseen = tag in UNSEEN or (tag == "header" and not inside) or _hidden(given)
        self.by_word = tag not in ("html", "body", "main") and _worded(names, inside)
        self.spared = False
        self.mute = (up is not None and up.mute) or ((self.unseen or self.by_word) and not self.block)
        self.parts: list[bytes] = []
        self.digest, self.has_text = 0, False

    def in_main(self) -> bool:
        at = self.up
        while at is not None:
            if at.main:
                return True
            at = at.up
        return False


def _hidden(given: dict) -> bool:
    style = (given.get("style") or "").replace(" ", "").lower()
    return (
        "hidden" in given or given.get("aria-hidden") == "true"
        or given.get("role") in UNSEEN_ROLES or "display:none" in style
    )


def _worded(names: str, in_main: bool) -> bool:
    """Whether class or id have a word for what is no part of an article. "has-sidebar", "with-ads"
    and the like say what is beside; an article's own header holds its title."""
    words = {w.lower() for w in WORD.findall(names)}
    if words & UNSEEN_WORDS:
        return not words & BESIDE_WORDS
    return bool(words & HEADER_WORDS) and not in_main


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("#page", [], None)
        self.at = self.root
        self.pieces: list[str] = []
        self.owner: Element | None = None
        # (text, innermost element that is a block)
        self.blocks: list[tuple[str, Element]] = []
        self.title = ""
        self.elements: list[Element] = []

    def handle_starttag(self, tag, attrs):
        if tag == "br" or tag == "hr":
            self.pieces.append(" ")
        if tag in VOID:
            if tag in BLOCKS:
                self.end_block()
            return
        if tag in BLOCKS:
            self.end_block()
            self.close_first(("p",), stop=BORDERS)
        if tag in CLOSES:
            for other in CLOSES[tag]:
                self.close_first((other,), stop=BORDERS)
        self.at = Element(tag, attrs, self.at)
        self.elements.append(self.at)
        if tag == "main" or (tag == "h1" and self.at.in_main()):
            self.spare()

    def spare(self):
        """What holds the article is no sidebar, whatever its class says; an article marked as a comment is none."""
        at = self.at.up
        if self.at.tag == "h1":
            while not at.main:
                if at.by_word or at.unseen:
                    return
                at = at.up
            if at.by_word or at.unseen:
                return
        while at is not None and not at.spared:
            at.spared = True
            at = at.up

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        # Outside foreign content the slash says nothing in HTML; only there does it close.
        if tag in ("path", "circle", "rect", "line", "g", "use", "polygon", "ellipse"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end_block()
        if tag == "br":
            self.pieces.append(" ")
        self.close_first((tag,), stop=() if tag in BORDERS else ("table", "article", "main", "body"))

    def handle_data(self, data):
        if self.at.mute:
            if self.at.tag == "title" and not self.title:
                self.title = " ".join(data.split())
            return
        self.pieces.append(data)
        if self.owner is None and not data.isspace():
            self.owner = self.at

    def close_first(self, tags, stop):
        at = self.at
        while at is not self.root and at.tag not in tags:
            if at.tag in stop:
                return
            at = at.up
        if at is self.root:
            return
        while self.at is not at.up:
            self.close_one()

    def close_one(self):
        one = self.at
        if one.block:
            self.end_block()
        self.at = one.up

    def end_block(self):
        if not self.pieces:
            return
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        owner, self.owner = self.owner, None
        if not text or owner is None:
            return
        while owner.up is not None and not owner.block:
            owner = owner.up
        self.blocks.append((text, owner))


def _finish(page: _Reader) -> None:
    """Digest of every subtree, children before parents: a text counts at its block, with numbers masked."""
    for text, owner in page.blocks:
        owner.parts.append(NUMBERS.sub("0", text).encode("utf-8", "surrogatepass"))
        at = owner
        while at is not None and not at.has_text:
            at.has_text = True
            at = at.up
    for element in reversed(page.elements):
        # Elements are listed as they open, so a parent comes before its children.
        own = element.sign.encode("utf-8", "surrogatepass") + b"\0".join(element.parts)
        element.digest = xxhash.xxh3_64_intdigest(own) - (1 << 63)
        if element.has_text and element.up is not None:
            element.up.parts.append(element.digest.to_bytes(8, "little", signed=True))


# Parts of an article that may recur without being the site's: never counted as subtrees of their own.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr table tbody thead figure figcaption ul ol dl article main html body".split())


def read_page(html: str) -> tuple[str, list[tuple[str, list[int]]], list[int]]:
    """Heading of the page; its candidate blocks in order, each with the digests of the elements around it that
    may be removed; the distinct digests of all elements with text that may be removed.

    Candidates are the blocks under no marked element: those in an article or main element where there
    are any, else all.
    """
    page = _Reader()
    page.feed(html)
    page.close()
    page.end_block()
    _finish(page)
    known: dict[int, tuple[bool, bool, tuple[int, ...]]] = {id(page.root): (False, False, ())}
    every: set[int] = set()

    def around(element: Element) -> tuple[bool, bool, tuple[int, ...]]:
        chain = []
        while id(element) not in known:
            chain.append(element)
            element = element.up
        found = known[id(element)]
        for one in reversed(chain):
            unseen, main, digests = found
            unseen = unseen or one.unseen or (one.by_word and not one.spared)
            # A page's article is no template, nor is what holds it or its prose; other boxes in it may be.
            if not (one.main or one.spared or one.tag in ("html", "body") or (main and one.tag in PROSE)):
                digests = (*digests, one.digest)
                every.add(one.digest)
            found = known[id(one)] = (unseen, main or one.main, digests)
        return found

    placed = [(text, owner, *around(owner)) for text, owner in page.blocks]
    seen = [p for p in placed if not p[2]]
    heading = next((text for text, owner, *_ in seen if owner.tag == "h1"), page.title)
    main = [p for p in seen if p[3]]
    return heading, [(text, list(digests)) for text, _, _, _, digests in main or seen], sorted(every)
