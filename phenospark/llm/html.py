"""Main-text extraction from web pages: flat text blocks, classified by a
decision tree on their own and their neighbours' word counts and link density.

A page is cut at block-level tags into flat blocks (inline markup stays inside
its block). Each block is described by its number of words and link density
(share of its words inside links), by the same two of the block before and
after, by whether it begins like a line on rights, and by where it stands: inside an
element or name that says boilerplate or reader comments, inside an article element
or name, in a heading. A decision tree (Gini impurity, axis-parallel splits) trained on
``LABELLED``, a small table of labelled blocks given as mini-pages, says which blocks
are main text; where no element or name says so, it decides by the neighbours (a line
between menus, a linked heading before a long text, remarks between linked names).

The kept blocks' text has its character references decoded and white space
runs turned into one space, is trimmed, and joined by newlines in page order;
blocks without visible characters vanish, nothing else is dropped. Reading a page
takes time in proportion to its length, whatever its elements.

Defined results: null or empty html gives an empty text; unclosed, misnested
or cut-off markup is read leniently (an end tag closes the nearest open element
of its name, ends of elements that are not open are ignored); contents of
script, style, svg and the like never count as text, those of math and object
do; a head ends where anything stands that can't be in it; a leaf of the tree as much
text as not counts as text; repeated rows are extracted alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from phenospark.llm.common import pieces

#: Attributes: a quote opens a string only right after ``=``; elsewhere it is a character like any other.
_ATTRS = r"""(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+"""
#: Tokens of a page, and of an svg's inside, where a raw element may be closed by its own start tag (``<style/>``).
_TOKEN, _SVG_TOKEN = (
    re.compile(
        r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|iframe|select|title)\b" + _ATTRS + closed +
        r".*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>" + _ATTRS + r")(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
        re.S | re.I,
    )
    for closed in (">", "(?<!/)>")
)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Fixed values of the HTML standard: elements without contents, and elements whose contents flow inside a line.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_MATH = set(
    "math annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts "
    "mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
_INLINE = _MATH | set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter object output progress q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements without contents that may stand in a head; any other element, and text, ends an open head.
_IN_HEAD = set("html head base basefont bgsound link meta".split())
#: Elements that end an open svg, and the svg elements inside which they don't.
_ENDS_SVG = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var html article main section header footer nav aside form".split()
)
_SVG_HOLDS_HTML = {"foreignobject", "desc"}
#: Elements that hold no article text by their meaning.
_BOILER_TAG = set("nav header footer aside form head menu dialog button fieldset select address".split())
_ARTICLE_TAG = {"article", "main"}
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words in class, id or role that name boilerplate, and those that name reader comments or the article.
_BOILER_WORD = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar side aside widget footer header masthead toolbar share sharing social related recommended "
    "recommendations copyright legal disclaimer pagination pager tags tagcloud skip search form paywall outbrain taboola "
    "complementary contentinfo dialog".split()
)
_COMMENT_WORD = set("comment comments commentlist reply replies respond disqus discussion feedback reader readers responses reviews".split())
#: Boilerplate words that tell even beside words nobody foresaw (``google-ad``, ``cookie-policy-banner``).
_STRONG_WORD = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr newsletter subscribe signup "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar footer sharing related recommended pagination paywall outbrain taboola "
    "copyright disclaimer".split()
)
#: First words of names that tell a state and not what the element is (``has-sidebar``, ``no-ads``).
_STATE_WORD = set("has have with without no not is hide show".split())
#: How a line on rights begins.
_LEGAL = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved\b)", re.I)
_ARTICLE_WORD = set("article content post entry story main articlebody body text".split())

#: Words that say nothing by themselves: a name of these and boilerplate words names boilerplate (``site-header``), one with
#: any other word doesn't (``article-header``, ``has-sidebar``).
_NEUTRAL_WORD = set(
    "left right top bottom upper lower first last main primary secondary global site page box wrap wrapper container inner outer "
    "block section area list item items group panel slot unit bar row col column buttons button link links icons icon text title "
    "big small wide mobile desktop sticky fixed the js is".split()
)
#: Elements that are never boilerplate as a whole, whatever their names say.
_WHOLE = {"html", "body", "main", "article"}

#: What is known of a block: its words and links, those of its neighbours, and where it stands.
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "legal",
            "said", "in_article", "article_word", "heading")
_IN_TAG, _NAME, _WORD, _COMMENT, _ARTICLE, _ARTICLE_NAME, _IS_HEADING = range(7)
_NOWHERE = (0,) * 7


class _Open:
    """The open elements, innermost last, with the places of each name and of block
    elements, so that every step takes constant time (elements are closed once)."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, tuple[int, ...]]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, tag: str, place: tuple[int, ...] = _NOWHERE) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in _INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, place))

    def close_to(self, at: int) -> None:
        while len(self.stack) > at:
            tag = self.stack.pop()[0]
            self.places[tag].pop()
            if tag not in _INLINE:
                self.blocks.pop()

    def last(self, tag: str) -> int:
        """Where the innermost ``tag`` stands (-1: nowhere)."""
        own = self.places.get(tag)
        return own[-1] if own else -1

    def block(self) -> int:
        """Where the innermost block element stands (-1: nowhere)."""
        return self.blocks[-1] if self.blocks else -1

    def top(self) -> str:
        return self.stack[-1][0] if self.stack else ""

    def place(self) -> tuple[int, ...]:
        return self.stack[-1][1] if self.stack else _NOWHERE

    def links(self) -> int:
        return len(self.places.get("a", ()))


class _Block:
    __slots__ = ("linked", "parts", "place", "shown", "words")

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.words = self.linked = 0
        self.shown = False
        self.place = _NOWHERE


def blocks_of(page: str) -> list[tuple[str, list[float]]]:
    """(text, features) of every flat block that has visible characters, in page order."""
    opened, hidden = _Open(), _Open()  # hidden: open elements from the outermost open svg on
    blocks: list[_Block] = []
    now = _Block()

    def close_block() -> None:
        nonlocal now
        if now.parts:
            blocks.append(now)
        now = _Block()

    def text(run: str) -> None:
        if not run or hidden.stack:
            return
        if opened.top() == "head" and run.strip():
            opened.close_to(len(opened.stack) - 1)
        run = _html.unescape(run) if "&" in run else run
        n = len(run.split())
        if n:
            now.words += n
            if opened.links():
                now.linked += n
            if not now.shown:
                now.place, now.shown = opened.place(), True
        now.parts.append(run)

    def in_svg(tag: str, end: bool, closed: bool) -> bool:
        """Whether a tag belongs to the open svg; one that doesn't has ended it."""
        if end:
            if hidden.last(tag) >= 0:
                hidden.close_to(hidden.last(tag))
                return True
            if opened.last(tag) >= 0:
                hidden.close_to(0)
            return bool(hidden.stack)
        if tag in _ENDS_SVG and hidden.last("svg") > max(map(hidden.last, _SVG_HOLDS_HTML)):
            hidden.close_to(hidden.last("svg"))
            if not hidden.stack:
                return False
        if not closed and tag not in _VOID:
            hidden.push(tag)
        return True

    at = 0
    while m := (_SVG_TOKEN if hidden.stack else _TOKEN).search(page, at):
        text(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        closed = (m["attrs"] or "").endswith("/")
        if hidden.stack and in_svg(tag, bool(m["end"]), closed):
            continue
        if not m["end"] and opened.top() == "head" and tag not in _IN_HEAD:
            opened.close_to(len(opened.stack) - 1)
        if tag == "svg":
            if not m["end"] and not closed:
                hidden.push(tag)
            continue
        if tag == "br":
            text(" ")
            continue
        inline = tag in _INLINE
        if not inline:
            close_block()
        if m["end"]:  # the end of inline markup does not reach out of its block
            own = opened.last(tag)
            if own >= 0 and (not inline or tag == "object" or own > opened.block()):
                opened.close_to(own)
            continue
        if tag in _VOID or (tag in _MATH and closed):
            continue
        if not inline and opened.block() >= 0 and opened.stack[opened.block()][0] == "p":
            opened.close_to(opened.block())  # a block element ends an open paragraph
        opened.push(tag, _place(tag, m["attrs"] or "", opened.place()))
    text(page[at:])
    close_block()

    shown = [(t, b) for b in blocks if (t := " ".join("".join(b.parts).split()))]
    ends = [(0.0, 0.0), *((b.words, b.linked / max(b.words, 1)) for _, b in shown), (0.0, 0.0)]
    return [
        (t, [*map(float, (*ends[i + 1], *ends[i], *ends[i + 2], bool(_LEGAL.match(t)), *_said(b.place)))])
        for i, (t, b) in enumerate(shown)
    ]


def _said(place: tuple[int, ...]) -> tuple[int, ...]:
    """Whether an element or a name around a block says that it is boilerplate or a comment
    (a boilerplate word alone does not where another name says article), and the rest."""
    said = place[_IN_TAG] or place[_NAME] or place[_COMMENT] or (place[_WORD] and not place[_ARTICLE_NAME])
    return (int(said), place[_ARTICLE], place[_ARTICLE_NAME], place[_IS_HEADING])


@cache
def _named(tag: str, words: str) -> tuple[int, ...]:
    """What an element's own tag and names say, in the order of a place."""
    name = word = comment = article = False
    for line in words.split("\n"):
        parts = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", line).lower())
        if not parts or parts[0] in _STATE_WORD:
            continue
        own = set(parts)
        article |= bool(own & _ARTICLE_WORD)
        if tag not in _WHOLE:
            name |= own <= _BOILER_WORD | _COMMENT_WORD | _NEUTRAL_WORD and bool(own & _BOILER_WORD)
            word |= bool(own & _STRONG_WORD) and not own & _ARTICLE_WORD
            comment |= bool(own & _COMMENT_WORD)
    return (int(tag in _BOILER_TAG), int(name), int(word), int(comment), int(tag in _ARTICLE_TAG), int(article), int(tag in _HEADING))


def _place(tag: str, attrs: str, outer: tuple[int, ...]) -> tuple[int, ...]:
    """Where the contents of an element stand: what holds outside holds inside, but for
    headings, which are the innermost block's own, and boilerplate words of a wrapper,
    which an article element inside it ends. An article's own header or address
    holds its title or authors."""
    words = ""
    if "=" in attrs:  # one name a line: each class by itself, an id, role or label as a whole
        found = [(key.lower(), a or b or c) for key, a, b, c in _ATTR.findall(attrs)]
        words = "\n".join(n for key, value in found for n in (value.split() if key == "class" else [value]))
    own = _named(tag, words) if len(words) < 200 else _named.__wrapped__(tag, words)
    place = [max(a, b) for a, b in zip(own, outer)]
    if tag in ("header", "address") and outer[_ARTICLE]:
        place[_IN_TAG] = outer[_IN_TAG]
    if own[_ARTICLE]:
        place[_WORD] = own[_WORD]
    if tag not in _INLINE:
        place[_IS_HEADING] = own[_IS_HEADING]
    return tuple(place)


# --- the decision tree --------------------------------------------------------

#: The labelled table: mini-pages whose blocks are marked 1 (main text) or 0 by ``data-y`` on the element.
LABELLED = (
    """<nav><ul><li data-y=0><a href=x>Home</a><li data-y=0><a href=x>News</a><li data-y=0><a>Sport and play</a></ul></nav>
    <article><h1 data-y=1>Rain in the hills</h1><p data-y=1>It rained for three days in the hills above the town and the river rose.</p>
    <p data-y=1>Nobody was hurt.</p><p data-y=1>The bridge <a>held</a> and the mill ran on through the night as before.</p></article>
    <footer><p data-y=0>All rights kept by the town paper. <a>Contact us</a></p></footer>""",
    """<header><div data-y=0>The Daily Lantern</div><div data-y=0>Your window on the valley since long ago</div></header>
    <div class=ad data-y=0>Buy two lamps, get a third lamp free, this week only in all our shops.</div>
    <main><h2 data-y=1>Lamps of old</h2><p data-y=1>Old lamps burned oil pressed from seeds grown in the fields.</p><p data-y=1>Short.</p></main>
    <aside><p data-y=0>Most read this week</p><ul><li data-y=0><a>Ten ways to save on lamp oil</a></ul></aside>""",
    """<div id=cookie-notice data-y=0>We use cookies to make this page work better for you, please agree.</div>
    <div class=content><h1 data-y=1>Bread</h1><p data-y=1>Mix flour with water and salt and wait for an hour before you bake it.</p>
    <p data-y=1>Eat warm.</p><ul><li data-y=1>Flour, three cups</li><li data-y=1>Water, one cup</li></ul></div>
    <div class=comments><p data-y=0>I tried this on Sunday and my whole family liked it very much, thank you!</p><p data-y=0>Nice.</p></div>""",
    """<div data-y=0><a>Start</a> <a>Shop</a> <a>About</a> <a>Help</a></div>
    <div><h1 data-y=1>How the clock works</h1><p data-y=1>A weight pulls a cord that turns a wheel, and the wheel turns the hands of the clock.</p>
    <p data-y=1>The pendulum lets one tooth pass at each swing, so the hands move evenly all day long.</p></div>
    <form><p data-y=0>Sign up for our letter and never miss a story from the workshop.</p><label data-y=0>Name</label></form>
    <div data-y=0><a>Terms</a> <a>Privacy</a></div>""",
    """<article><h1 data-y=1>Snow</h1><p data-y=1>Snow fell.</p><div class=advertisement data-y=0>Warm coats for the whole family at half price until Friday.</div>
    <p data-y=1>By noon the road was closed and the bus had turned back to the depot.</p>
    <div class="share social"><span data-y=0>Share this story with friends</span></div>
    <section id=comments><p data-y=0>Stay safe everyone, it is bad out there on the northern road today.</p></section>
    <aside><div data-y=0>Read next: the long thaw of last year and what it did</div></aside></article>""",
    """<div class=sidebar><h3 data-y=0>Archive</h3><p data-y=0>Stories from the past year that our readers liked the most.</p></div>
    <article><p data-y=1>Yes.</p><p data-y=1>The council met on Monday to speak of the new well, and it will be dug in spring.</p>
    <blockquote data-y=1>We have waited long enough.</blockquote><p data-y=1><a>The full plan of the well</a></p>
    <form><p data-y=0>Leave a tip for our reporters here</p></form><footer><p data-y=0>Written by the town desk</p></footer></article>
    <div role=contentinfo data-y=0>Printed in the valley by the press of the valley company.</div>""",
    """<div data-y=0><a>Jump to the text</a></div><p data-y=1>Bees keep the hive warm in winter by shivering together in a ball around the queen.</p>
    <p data-y=1>They eat the honey they stored in summer and clean the hive on the first warm day of the year.</p>
    <div data-y=0><a>Next page</a> <a>Last page</a></div>""",
    """<div class=breadcrumb><span data-y=0>You are here: garden, trees</span></div><div class="entry"><h2 data-y=1>Pruning</h2>
    <p data-y=1>Cut in late winter.</p><p data-y=1>See <a>our guide to tools</a> for saws.</p></div>
    <div class="related"><h4 data-y=0>You may also like</h4><p data-y=0><a>Planting a hedge in the autumn rain</a></p></div>
    <footer><div data-y=0>Garden Club, Post Box 12</div><div data-y=0>Sunday talks on trees and soil are open to all who care to come.</div></footer>""",
    """<h1 data-y=1>A note</h1><p data-y=1>The ferry will leave from the old pier until the new one is safe to stand on again.</p>
    <p data-y=1>Thank you.</p>""",
    """<p data-y=1>One paragraph alone is a page as well, if it says what it has to say in enough words.</p>""",
    """<p data-y=1>Low tide is at six in the morning and at half past six in the evening of the same day.</p>
    <p data-y=1>Walk out to the island only while the sand is dry and the wind is calm.</p><p data-y=0><a>Tide tables</a> <a>Maps</a></p>""",
    """<div data-y=0><a>Fields</a> <a>Barns</a> <a>Tools</a></div><article><p data-y=1>Hay.</p></article>""",
    # Pages without a telling element or name: neighbours decide.
    """<div data-y=0><a>Home</a></div><div data-y=0><a>News of the day</a></div><div data-y=0><a>Sport</a></div><div data-y=1>The old mill</div>
    <div data-y=1>The mill by the river was built of stone and oak, and it ground the corn of four villages for two hundred years.</div>
    <div data-y=1>It burned down twice.</div><div data-y=1>Each time the villages came together and built it up again before the next harvest was in.</div>
    <div data-y=0><a>Imprint</a></div><div data-y=0><a>Privacy and terms</a></div><div data-y=0>Copyright the valley press</div>""",
    """<div data-y=0><a>Start</a> <a>Map</a> <a>Weather</a></div><div data-y=0>Three shirts for the price of two, this week at every shop in town.</div>
    <h1 data-y=1>The long road</h1><p data-y=1><a>Ann Lee</a></p><p data-y=1>The road runs from the harbour to the pass and on down into the next valley, where it ends.</p>
    <h2 data-y=1><a>The first stage</a></h2><p data-y=1>It climbs through beech woods for an hour, and then the trees grow thin and the wind picks up.</p>
    <p data-y=1><a>A drawing of the pass</a></p><p data-y=1>At the top there is a hut where soup is sold in summer and wood is stored for the winter.</p>
    <div data-y=0><a>More roads</a></div><div data-y=0><a>More maps</a></div>""",
    """<div data-y=0>By reading on you agree that we store small files on your machine.</div><div data-y=0><a>I agree</a> <a>Tell me more</a></div>
    <h1 data-y=1>Salt</h1><p data-y=1>Salt was carried over the hills on mules, forty at a time, from the pans on the coast to the towns inland.</p>
    <p data-y=1>A mule carried two bags.</p><p data-y=1>The trade made the towns on the way rich, and their halls and walls were paid for with its tolls.</p>
    <div data-y=0><a>Ben</a></div><div data-y=0>Great read.</div><div data-y=0><a>Cleo</a></div><div data-y=0>My grandfather still drove mules!</div><div data-y=0><a>Dora</a></div>
    <div data-y=0>Thanks for this.</div><div data-y=0><a>Older remarks</a></div>""",
    """<div data-y=1>Notes on tin</div><div data-y=1>Tin melts over a wood fire, which is why so many old spoons and plates were made of it in the hills.</div>
    <div data-y=1>It is soft.</div><div data-y=1>Spoons bent and were cast again, so few of them are older than the hands that last held them.</div>
    <div data-y=0>All rights reserved by the museum</div>""",
    """<ul><li data-y=0><a>Fish</a><li data-y=0><a>Boats and nets</a><li data-y=0><a>Tides</a></ul><h1 data-y=1>How to mend a net</h1>
    <ul><li data-y=1>Cut the torn meshes back to whole knots</li><li data-y=1><a>Wind a needle with twine</a></li><li data-y=1>Tie new meshes row by row over a flat stick of the right width</li></ul>
    <p data-y=1>Hang the net to dry in the shade, and never fold it while it is still wet with salt water.</p>
    <ul><li data-y=0><a>Other crafts</a><li data-y=0><a>Our shop</a><li data-y=0><a>Write to us</a></ul><div data-y=0>(c) the harbour guild and its members, all rights kept</div>""",
    """<h2 data-y=1><a>Early pears</a></h2><p data-y=1>The first pears ripen in July on the south wall, a month before those in the open garden do.</p>
    <p data-y=1>Pick them hard.</p><div data-y=0><a>Jump to the top of this page</a></div><div data-y=0>&copy; garden press of the upper town, all rights reserved, no copies</div>""",
    # Inside an article links are its text.
    """<nav><a data-y=0>Up</a></nav><article><header><h1 data-y=1><a>Wells of the plain</a></h1><p data-y=1><a>Ann Lee</a></p></header>
    <h2 data-y=1><a>Old wells</a></h2><p data-y=1>They were dug by hand.</p><ul><li data-y=1><a>A list of the wells</a></li><li data-y=1><a>A map</a></li><li data-y=1><a>Notes</a></li></ul>
    <p data-y=1>Most are dry now, since the river was turned and the ground water sank below their floors.</p><p data-y=1>Copyright in old maps is long over.</p>
    <address data-y=1>Ann Lee writes from the plain</address><footer data-y=0><a>Tags</a></footer></article>""",
    """<main><h1 data-y=1>Kites</h1><p data-y=1><a>First</a></p><p data-y=1><a>Second kite</a></p><p data-y=1>Paper, glue and two thin sticks make a kite that flies on any hill with a steady wind.</p></main>""",
    # Names that hold words nobody foresaw.
    """<div class="post-comments"><p data-y=0>What a fine story this was, I read it twice to my children last night.</p><p data-y=0>So did I.</p></div>
    <article><p data-y=1>The fair opens on Friday with a race of carts down the main street to the bridge.</p><div class="google-ad" data-y=0>Carts of all kinds, new and used, at prices you will not find elsewhere.</div>
    <p data-y=1>Bring a hat.</p><div class="user-comment-box"><p data-y=0>See you all there, and do not forget the hat this year!</p></div></article>
    <div id="disqus_thread"><p data-y=0>Last year the bridge was closed, does anybody know about this year?</p></div>""",
    """<div class="cookie-policy-banner" data-y=0>This page keeps small files on your machine so that it knows you when you come back.</div>
    <div class="layout-sidebar-left"><article><h1 data-y=1>Rope</h1><p data-y=1>Rope is laid from yarns of hemp that are twisted against each other on a long walk.</p></article></div>
    <div class="my-sidebar-x"><p data-y=0>The rope walk can be seen on Sundays, ask for the key at the inn next door.</p></div>
    <div class="user-reviews"><p data-y=0>Five stars from me, the walk is longer than I had ever thought it would be.</p></div>
    <div class="page-footer-legal-notice-x" data-y=0>The rope makers of the town, at the old walk, open on Sundays from ten to four.</div>""",
    """<div class="sidebar-layout"><div class="content"><h1 data-y=1>Ink</h1><p data-y=1>Ink was boiled from oak galls and rusty nails, and it bit into the page and never faded.</p>
    <p data-y=1>It stains.</p></div><div class="text-promo-teaser"><p data-y=0><a>Quills on sale</a></p></div></div>""",
    """<div class="story-header"><h1 data-y=1>Bells</h1><p data-y=1><a>Carl Moss</a></p></div><div class="story"><p data-y=1>The great bell cracked in the frost and was cast again in spring.</p><p data-y=1>It rings lower now.</p></div>
    <div class="story-related-list"><p data-y=0><a>Clocks</a></p><p data-y=0>More about towers and what hangs in them</p></div>""",
)


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of the labelled table; the marks stand in the blocks' order."""
    rows, labels = [], []
    for page in LABELLED:
        marks = [int(y) for y in re.findall(r"data-y=([01])", page)]
        got = blocks_of(page)
        if len(got) != len(marks):
            raise ValueError("the labelled table has a block without a mark, or a mark without a block")
        rows += [f for _, f in got]
        labels += marks
    return np.array(rows), np.array(labels)


def varied(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The labelled blocks and what follows from them: the same with longer blocks and
    neighbours twice as long; and where an element or name tells and all such blocks have
    one label (boilerplate that says so, text in an article element), blocks of any length
    with any neighbours."""
    counts = [FEATURES.index(f) for f in ("words", "words_before", "words_after")]
    said, article = FEATURES.index("said"), FEATURES.index("in_article")
    longer = x.copy()
    longer[:, counts] = np.where(longer[:, counts] > 7, 2 * longer[:, counts], longer[:, counts])
    rows, labels = [x, longer], [y, y]
    for own in (x[:, said] > 0, (x[:, said] == 0) & (x[:, article] > 0)):
        if own.any() and y[own].min() == y[own].max():
            like = x.copy()
            like[:, said:] = x[np.flatnonzero(own)[np.arange(len(x)) % own.sum()], said:]
            rows.append(like)
            labels.append(np.full(len(x), y[own][0]))
    return np.concatenate(rows), np.concatenate(labels)


def grow(x: np.ndarray, y: np.ndarray, depth: int, least: int = 1) -> tuple:
    """A tree of (feature, threshold, below-or-equal, above) down to leaves (share of label 1,)."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return (share,)
    best = (2 * share * (1 - share) * len(y) - 1e-9, None)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            a, b = y[low], y[~low]
            if min(len(a), len(b)) < least:
                continue
            impurity = sum(2 * p * (1 - p) * len(s) for s in (a, b) for p in (s.mean(),))
            if impurity < best[0]:
                best = (impurity, (f, float(cut)))
    if best[1] is None:
        return (share,)
    f, cut = best[1]
    low = x[:, f] <= cut
    return (f, cut, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


@cache
def trained_tree(depth: int = 12) -> tuple:
    return grow(*varied(*labelled_blocks()), depth)


def classify(tree: tuple, features: list[float]) -> bool:
    while len(tree) == 4:
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree[0] >= 0.5


def main_text(page: str | None, tree: tuple) -> str:
    if not page:
        return ""
    return "\n".join(t for t, f in blocks_of(page) if classify(tree, f))


def extract_text(pages: DataFrame, depth: int = 12) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html); no shuffle."""
    tree = trained_tree(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2):
            texts = [main_text(page.as_py(), tree) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    page_id = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {page_id}, url string, text string, n_chars bigint")
