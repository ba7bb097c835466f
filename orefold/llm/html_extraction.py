"""HTML extraction by two-pass block rules.

Pass one judges each text block by stop-word density, length and link density; by
length and link density alone where stop words cannot tell, on a page of which no
block reaches the upper density and in blocks of another script than the lists'.
Pass two gives blocks that are too short to judge the label of their nearest
decided neighbours.  Page structure narrows what is judged: furniture elements and
reader comments are left out, and where a page marks its article, blocks outside
do not count.  An element whose class, id or role names furniture has a vote: it
goes unless it holds most of what is good on the page, as a page's wrapper does;
inside a marked article a name only makes its link lists go.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orefold.llm.shared import map_arrow

# Frequent function words of four languages.
STOP_WORDS = {
    "en": "a an and are as at be been but by can could do for from had has have he her his i if in into is it its more no not of on one or our out said she so that the their them then there they this to up was we were what when which who will with would you your",
    "de": "aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im in ist man mit nach nicht noch nur oder sich sie sind so über um und von vor war was wie wir wird zu zum zur",
    "fr": "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui ma mais me même nous on ou où par pas plus pour qu que qui sa se ses son sont sur un une vous y à été être",
    "es": "al ante como con cuando de del desde donde el ella en entre era es esta este fue ha hay la las le lo los más me mi muy no nos o para pero por porque que se ser si sin sobre su sus también un una y ya",
}
# Elements.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "button", "select", "dialog", "svg", "math", "canvas", "object", "audio", "video", "map", "datalist", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Words of names in class, id or role that mark furniture; words that may stand beside them; comments and adverts.
FURNITURE_NAMES = set(
    "ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar sidebars aside footer header masthead "
    "cookie cookies consent gdpr notice notices notification popup modal overlay dialog alert newsletter subscribe signup login share sharing social related recommended trending popular comment comments commentlist "
    "discussion disqus reply replies respond reader widget pagination pager toolbar skip copyright legal disclaimer complementary contentinfo search form".split()
)
BESIDE_NAMES = set("area article articles bar block box button buttons column container entry group inner item items left link links list main outer page post posts primary right row secondary section site slot story top bottom unit wrap wrapper".split())
COMMENT_NAMES = set("comment comments commentlist discussion disqus reply replies respond".split())
ADVERT_NAMES = set("ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored".split())
ARTICLE_NAMES = set("article articlebody content post entry story main maincontent".split())

_STOP = frozenset(w for words in STOP_WORDS.values() for w in words.split())
_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"\w+")
_LETTER = re.compile(r"[^\W\d_]")
#: Letters of other scripts than Latin.
_OTHER = re.compile(r"[^\W\d_\u0000-\u024f\u1e00-\u1eff]")


@dataclass(frozen=True)
class Rules:
    """Pass one: lengths in characters, densities as shares of words or characters."""

    short: int = 70
    long: int = 200
    stop_low: float = 0.04
    stop_high: float = 0.10
    max_links: float = 0.33


@dataclass
class _Block:
    article: int  # 0 outside, 1 inside an element named like an article, 2 inside article or main
    heading: bool
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    label: str = ""
    named: tuple[int, ...] = ()  # the elements around it that name furniture, by number, outermost first

    @functools.cached_property
    def _text(self) -> str:
        return " ".join("".join(self.pieces).split())

    def text(self) -> str:
        """Of a block that is complete."""
        return self._text

    @functools.cached_property
    def density(self) -> float:
        words = _WORD.findall(self.text().lower())
        return sum(w in _STOP for w in words) / max(1, len(words))

    @functools.cached_property
    def latin(self) -> bool:
        """Whether half of the letters or more are Latin."""
        text = self.text()
        return text.isascii() or not _OTHER.search(text) or 2 * len(_OTHER.findall(text)) <= len(_LETTER.findall(text))


def _names(attributes: str) -> tuple[set[str], bool]:
    """The words of names that mean furniture as a whole, and whether a name marks the article."""
    furniture: set[str] = set()
    article = False
    for m in _NAMES.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").split():
            words = {p.lower() for p in _PARTS.findall(name)}
            found = words & FURNITURE_NAMES
            whole = re.sub("[^a-z]", "", name.lower())
            if found and not words - found - BESIDE_NAMES:
                furniture |= found
            elif not found and (words & ARTICLE_NAMES or whole in ARTICLE_NAMES):
                article = True
    return (set() if article else furniture), article


def blocks_of(page: str) -> list[_Block]:
    """The text blocks of a page outside furniture elements, in page order."""
    blocks: list[_Block] = []
    stack: list[tuple[str, int, tuple[int, ...]]] = []  # open elements, what they and those around them mean for the article, and those that name furniture
    skip = None  # the depth at which furniture began
    links, heading, n_named = 0, False, 0
    block: _Block | None = None
    at, end = 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        stop = m.start() if m else end
        if stop > at and skip is None:
            text = html.unescape(page[at:stop])
            if block is None:
                block = _Block(stack[-1][1] if stack else 0, heading, named=stack[-1][2] if stack else ())
                blocks.append(block)
            block.pieces.append(text)
            if links:
                block.linked += len("".join(text.split()))
        if not m:
            break
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name in RAW and not closing:
            if not attributes.rstrip().endswith("/"):
                ends = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = ends.end() if ends else end
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if name == "br":
            if block is not None:
                block.pieces.append(" ")
            continue
        plain = name in INLINE
        if not plain:
            block = None
            if re.fullmatch("h[1-6]", name):
                heading = not closing
            links = 0 if name in ("p", "li", "div", "section", "article", "main") else links
        if name in VOID:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    if skip is not None and skip >= depth:
                        skip = None
                        block = None
                    break
            continue
        if attributes.rstrip().endswith("/") and plain:
            continue
        if name in ("article", "main") and skip is not None and stack[skip][0] in ("nav", "header"):
            del stack[skip:]  # an element that was never closed
            skip = None
        names, marked = _names(attributes) if attributes else (set(), False)
        inside, named = stack[-1][1:] if stack else (0, ())
        rank = 2 if name in ("article", "main") else 1 if marked else 0
        if name == "p" and stack and stack[-1][0] == "p":
            stack.pop()
        if skip is None and name not in ("html", "body"):
            own = name in FURNITURE and not (inside == 2 and name == "header")
            gone = names & COMMENT_NAMES or name not in ("article", "main") and names & ADVERT_NAMES
            if own or gone or attributes and _HIDDEN.search(attributes):
                skip = len(stack)
                block = None
            elif names and not re.fullmatch("h[1-6]", name):
                n_named += 1
                named = (*named, n_named)
        if name != "p" or skip == len(stack):
            stack.append((name, inside if skip is not None else max(inside, rank), named))
    return [b for b in blocks if b.text()]


def _judge(block: _Block, rules: Rules, listed: bool) -> str:
    """good, bad, or short where the block cannot tell; listed: stop words tell on this page."""
    text = block.text()
    solid = max(1, len(text.replace(" ", "")))
    # a marked article keeps its paragraphs, whatever they link to, but for lists of links that a name calls furniture
    if (block.article < 2 or block.named) and block.linked > rules.max_links * solid:
        return "bad"
    if block.article < 2 and "©" in text and len(text) < rules.long:
        return "bad"
    if len(text) < rules.short:
        return "short"
    if not listed or not block.latin:
        return "good"
    density = block.density
    if density >= rules.stop_high or (density >= rules.stop_low and len(text) >= rules.long):
        return "good"
    return "short" if block.article or density >= rules.stop_low else "bad"


def _without_furniture(blocks: list[_Block]) -> list[_Block]:
    """Blocks outside elements that name furniture; an element with most of what is good on the page is none."""
    size = lambda bs: sum(len(b.text()) for b in bs if b.label == "good")
    for k in sorted({k for b in blocks if b.article < 2 for k in b.named}):
        inner = [b for b in blocks if k in b.named and b.article < 2]
        if inner and 2 * size(inner) <= size(blocks):
            blocks = [b for b in blocks if k not in b.named or b.article == 2]
    return blocks


def _inherit(blocks: list[_Block]) -> None:
    """Blocks too short to judge take the label of the nearest decided block; at equal distance one good neighbour is enough inside an article."""
    decided = [i for i, b in enumerate(blocks) if b.label != "short"]
    if not decided:
        for b in blocks:
            b.label = "good"
        return
    labels = [b.label for b in blocks]
    k = 0
    for i, b in enumerate(blocks):
        if b.label != "short":
            continue
        while k < len(decided) and decided[k] < i:
            k += 1
        near = []
        if k > 0:
            near.append((i - decided[k - 1], labels[decided[k - 1]]))
        if k < len(decided):
            near.append((decided[k] - i, labels[decided[k]]))
        least = min(d for d, _ in near)
        closest = {x for d, x in near if d == least}
        b.label = closest.pop() if len(closest) == 1 else "good" if b.article else "bad"


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    """The main text of a page; empty for null, empty or furniture-only pages."""
    if not page:
        return ""
    blocks = blocks_of(page)
    listed = any(len(b.text()) >= rules.short and b.density >= rules.stop_high for b in blocks)
    for b in blocks:
        b.label = _judge(b, rules, listed)
    blocks = _without_furniture(blocks)
    best = max((b.article for b in blocks), default=0)
    if best:
        inner = [b for b in blocks if b.article == best]
        if best == 2 or sum(len(b.text()) for b in inner) * 2 > sum(len(b.text()) for b in blocks):
            blocks = inner
    if not listed and all(b.label != "good" for b in blocks):
        blocks = [b for b in blocks if b.label == "short"]  # nothing good to follow: link lists must not decide
    _inherit(blocks)
    return " ".join(b.text() for b in blocks if b.label == "good")


def extract(pages: DataFrame, html_column: str = "html", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """pages without the html column, with the main text and n_chars, its code points.

    Columns named as these are replaced; others stay.  A null page gives an
    empty text.  Rows are independent, so repeated rows give repeated results.
    """
    rest = [f for f in pages.schema.fields if f.name not in (html_column, text, "n_chars")]
    schema = T.StructType([*rest, T.StructField(text, T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                found = [main_text(x, rules) for x in part.column(html_column).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in rest), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], names=schema.names)

    return map_arrow(pages, run, schema)
