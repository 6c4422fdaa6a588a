"""Main text of a web page by rules on its blocks, in two passes.

A page is cut into blocks at block-level tags. The first pass decides on what is
clear: blocks inside navigation, footers, forms, notices, adverts or comments
and blocks made of links are not text; blocks of some length with many stop
words are. The second pass gives each block left over, long ones first, the
label of the nearest decided block. Blocks inside the parts named above decide
nothing about those around them.

A class or id marks a part only if its whole name says so, and marks nothing if
the part turns out to hold the page. If the page marks its article, that is evidence beside the rules: what they leave
undecided there is text, and outside only clear text of some length counts, or
more text than is marked. If there is that much, the whole page is read by the
rules: a body beside a marked card or teaser stays.
"""

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

# HTML's elements by how they are treated.
BLOCK_TAGS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not text of the page; nothing inside them is markup for the first few.
RAW_TAGS = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN_TAGS = set(
    "annotation annotation-xml audio button canvas datalist head noscript option select svg template video".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements that are never the article, and those that are not when outside one.
SIDE_TAGS = set("nav footer aside form menu dialog search".split())
OUTER_SIDE_TAGS = {"header"}
#: Of the former, those that may be around a whole page, and their parts that are not text even then.
AROUND_TAGS = {"form", "dialog", "menu"}
FORM_PARTS = {"label", "legend"}
SIDE_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words of class and id names that mark what is not the article.
SIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising advertisements banner sponsor sponsored promo promotion"
    " menu nav navbar navigation breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices notification"
    " popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended"
    " recommendations pagination pager copyright disclaimer toolbar widget skip masthead topbar alert".split()
)
OUTER_SIDE_WORDS = {"header"}
#: The only such words that count on an article itself; on the whole page none does.
ARTICLE_SIDE_WORDS = set("ad ads advert advertisement sponsored promo related recommended teaser".split())
PAGE_TAGS = {"html", "body", "main"}
COMMENT_WORDS = set("comment comments commentlist discussion disqus replies reply respond".split())
#: Words that say where or how a thing stands. A name marks an element if it has only these beside the words above:
#: ``related-posts`` does, ``share-price`` and ``has-sidebar`` do not.
STRUCTURE_WORDS = set(
    "site page main global top bottom left right center middle box block container wrapper wrap inner outer area"
    " section column row list item items link links button buttons btn bar slot unit panel group holder zone region"
    " primary secondary mobile desktop posts articles stories module sticky fixed tab tabs small large mini icon icons form"
    " header head title foot view policy message messages".split()
)
COMMENT_PARTS = set("content body text author meta thread count user".split())
#: Words of names that stand around a whole page at times.
LAYOUT_WORDS = set("menu nav navbar sidebar widget modal overlay popup topbar toolbar social share sharing banner promo".split())
# Frequent short words by language.
STOP_WORDS = set(
    (
        "the of and to in a is that it for was on are with as be this have from or by at an not which he they we you"
        " der die das und ist in von zu mit den dem ein eine im für auf sich des nicht auch es an als aus er sie wird bei"
        " le la les de des et un une en du que est dans pour qui par sur au avec ne se pas plus il elle sont ce cette"
        " el los las y del una por con para no lo al su más como pero sus este ha son"
    ).split()
)

LENGTH_LOW, LENGTH_HIGH = 70, 140
STOPS_LOW, STOPS_HIGH = 0.2, 0.3
LINKS_LOW, LINKS_HIGH = 0.2, 0.5
#: Of a page's long blocks, by length, how much must have stop words for them to count.
STOPS_SHARE = 0.25

TAG = re.compile(
    r"<!--|<([/]?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[/]?([a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>"
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME_WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int
    side: bool
    article: int
    heading: bool
    label: bool | None = None
    clear: bool = False


@dataclass
class _Element:
    tag: str
    side: bool
    comment: bool
    hidden: bool
    article: int
    mark: int | None = None


def _attributes(source: str) -> dict[str, str]:
    return {
        m[1].lower(): entities.unescape(m[2].strip("\"'")) if m[2] else "" for m in ATTRIBUTE.finditer(source)
    }


class _Reader:
    """Turns a page into blocks."""

    def __init__(self, disbelieved: frozenset[int] = frozenset(), forms_count: bool = True):
        self.disbelieved = disbelieved  # numbers of elements whose names do not count
        self.marks: list[tuple[set[str], int]] = []  # the words of elements that names mark, and the text in the outermost
        self.in_forms = 0  # text in forms and the like
        self.side_tags = SIDE_TAGS if forms_count else SIDE_TAGS - AROUND_TAGS | FORM_PARTS
        self.own_side = False  # of a paragraph, which has no element on the stack
        self.stack = [_Element("", False, False, False, 0)]
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked, self.in_link, self.articles, self.heading = 0, False, 0, False
        self.link_depth = 0
        self.open: Counter[str] = Counter()

    def read(self, page: str) -> list[Block]:
        at, last = 0, page.rfind(">") + 1  # looking for tags behind the last ">" would take a page of "<" for ever
        while True:
            found = TAG.search(page, at, last)
            if not found:
                self.text(page[at:].partition("<!--")[0])
                break
            self.text(page[at : found.start()])
            at = found.end()
            if found[0] == "<!--":
                end = page.find("-->", at)
                at = len(page) if end < 0 else end + 3
                continue
            name = (found[2] or found[4] or "").lower()
            if not name:
                continue
            if found[0][1] == "/":
                self.end(name)
            elif name in RAW_TAGS:
                end = re.compile(f"</{name}", re.I).search(page, at)
                close = page.find(">", end.start()) if end else -1
                at = len(page) if close < 0 else close + 1
            else:
                self.start(name, found[3] or "")
        self.close()
        return self.blocks

    def text(self, source: str) -> None:
        if source and not self.stack[-1].hidden:
            decoded = entities.unescape(source) if "&" in source else source
            self.parts.append(decoded)
            if self.in_link:
                self.linked += len(decoded.strip())

    def close(self) -> None:
        """Ends the current block."""
        text = " ".join("".join(self.parts).split())
        if text:
            here = self.stack[-1]
            if here.mark is not None:
                words, size = self.marks[here.mark]
                self.marks[here.mark] = words, size + len(text)
            if self._inside(AROUND_TAGS):
                self.in_forms += len(text)
            self.blocks.append(Block(text, self.linked, here.side or self.own_side, here.article, self.heading))
        self.parts, self.linked, self.own_side = [], 0, False

    def start(self, name: str, source: str) -> None:
        if name == "br":
            self.parts.append(" ")
        if name in BLOCK_TAGS:
            self.close()
            self.heading = name in HEADINGS
        if name == "a":
            self.in_link, self.link_depth = "href" in source.lower(), len(self.stack)
        if name in VOID_TAGS or name not in BLOCK_TAGS | HIDDEN_TAGS | self.side_tags and not source:
            return
        around = self.stack[-1]
        attributes = _attributes(source) if source else {}
        words, mark = self._marking(name, attributes), around.mark
        if words:
            mark = len(self.marks) if mark is None else mark
            self.marks.append((words, 0))
            if len(self.marks) - 1 in self.disbelieved:
                words = set()
        comment = around.comment or bool(words & COMMENT_WORDS)
        marked = bool(words & SIDE_WORDS) or attributes.get("role", "").lower() in SIDE_ROLES
        hidden = name in HIDDEN_TAGS or "hidden" in attributes
        hidden = hidden or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        side = around.side or comment or name in self.side_tags or marked
        if not around.article:
            side = side or name in OUTER_SIDE_TAGS or bool(words & OUTER_SIDE_WORDS)
        if name == "p":  # ends with the next block, whether or not it is closed
            self.own_side = side or hidden
            return
        article = around.article
        is_article = name in ("article", "main") or attributes.get("role", "").lower() in ("article", "main")
        if is_article and not comment and not marked and not article and not self._inside(SIDE_TAGS - AROUND_TAGS):
            # The names of what surrounds an article say nothing about it, nor does a form around it.
            self.articles += 1
            article, side = self.articles, False
        is_block = name in BLOCK_TAGS | HIDDEN_TAGS
        # Inside a line of text, what is marked is left out of the line.
        hidden = hidden or around.hidden or (side and not around.side and not is_block)
        if is_block or side != around.side or hidden != around.hidden:
            self.stack.append(_Element(name, side, comment, hidden, article, mark))
            self.open[name] += 1

    @staticmethod
    def _marking(tag: str, attributes: dict[str, str]) -> set[str]:
        """Words of class and id that mark an element as something beside the article."""
        if tag in PAGE_TAGS:
            return set()
        found: set[str] = set()
        for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
            words = set(NAME_WORD.findall(CAMEL.sub(" ", name).lower()))
            rest = {w for w in words - STRUCTURE_WORDS if len(w) > 2 or w in SIDE_WORDS}
            if rest <= SIDE_WORDS:
                found |= words & (SIDE_WORDS | OUTER_SIDE_WORDS)
            if words & COMMENT_WORDS and rest <= SIDE_WORDS | COMMENT_WORDS | COMMENT_PARTS:
                found |= words & COMMENT_WORDS
        return found & (ARTICLE_SIDE_WORDS | COMMENT_WORDS) if tag == "article" else found

    def _inside(self, tags: set[str]) -> bool:
        return any(self.open[tag] for tag in tags)

    def end(self, name: str) -> None:
        if name in BLOCK_TAGS:
            self.close()
            self.heading = False
        if name == "a":
            self.in_link = False
        for depth in range(len(self.stack) - 1 if self.open[name] else 0, 0, -1):
            if self.stack[depth].tag == name:
                if name not in BLOCK_TAGS and any(e.tag in BLOCK_TAGS for e in self.stack[depth + 1 :]):
                    return  # an inline end tag does not end the blocks inside
                self.open.subtract(e.tag for e in self.stack[depth:])
                del self.stack[depth:]
                self.in_link = self.in_link and self.link_depth <= depth  # a link ends with what it began in
                return


def _stop_density(text: str) -> float:
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def _is_out(block: Block) -> bool:
    return block.side or block.linked > LINKS_HIGH * len(block.text)


def _decide(block: Block, density: float | None) -> bool | None:
    """True for text, False for the rest, None for what the neighbours must tell; without a density length decides."""
    if _is_out(block):
        return False
    length = len(block.text)
    if length < LENGTH_LOW or block.heading:
        return None
    if density is None:
        return True if length >= LENGTH_HIGH else None
    if density >= STOPS_HIGH or (density >= STOPS_LOW and length >= LENGTH_HIGH):
        return True
    # Few stop words alone say nothing, as in lists of names, tables or code; with links they speak against a block.
    return False if density < STOPS_LOW and block.linked > LINKS_LOW * length else None


def classify(blocks: list[Block]) -> None:
    """Labels all blocks, in two passes."""
    # Where little of what may be text has stop words of a language known here, length decides.
    density = [_stop_density(b.text) if len(b.text) >= LENGTH_LOW and not _is_out(b) else None for b in blocks]
    known = sum(len(b.text) for b, d in zip(blocks, density) if d is not None and d >= STOPS_LOW)
    stops_help = known > STOPS_SHARE * sum(len(b.text) for b, d in zip(blocks, density) if d is not None)
    for block, own in zip(blocks, density):
        block.label = _decide(block, own if stops_help else None)
        block.clear = block.label is True
    inside = sum(len(b.text) for b in blocks if b.article and b.label is not False)
    if inside:
        # Outside a marked article short lines are not enough: clear text there counts from a length on, and
        # text of long blocks that is not clear if it is more than what is marked.
        # Where stop words do not help, nothing there is clear by its length alone.
        clear = sum(len(b.text) for b in blocks if b.label and not b.article and stops_help)
        unclear = sum(len(b.text) for b in blocks if b.label is not False and _is_long(b) and not b.article) - clear
        for block in blocks:
            if block.article:
                block.label = block.label is not False  # what is left out leaves its neighbours alone
            elif clear < LENGTH_HIGH and clear + unclear <= inside:
                block.label = False
    # Long blocks first: what is marked as something else says nothing about them.
    plain = [b for b in blocks if not b.side]
    if any(b.label for b in plain):
        _inherit(plain, _is_long, False)
    else:
        for block in plain:
            block.label = True if block.label is None and _is_long(block) else block.label
    # Then the rest, each between two marked blocks only.
    nothing_clear = not any(b.label for b in plain)
    for side, stretch in groupby(blocks, lambda b: b.side):
        if not side:
            _inherit(list(stretch), lambda _: True, nothing_clear)


def _is_long(block: Block) -> bool:
    return len(block.text) >= LENGTH_LOW and not block.heading


def _inherit(region: list[Block], which: Callable[[Block], bool], default: bool) -> None:
    """Gives undecided blocks the label of the nearest decided one of their region, or the default if there is none."""
    labels = [b.label for b in region]
    before, after = _nearest(labels), _nearest(labels[::-1])[::-1]
    for i, block in enumerate(region):
        if labels[i] is None and which(block):
            near = [n for n in (before[i], after[i]) if n is not None]
            if block.heading and after[i] is not None:
                near = [after[i]]
            near = [n for n in near if n[0] == min(near)[0]]
            block.label = any(label for _, label in near) if near else default


def _nearest(decided: list[bool | None]) -> list[tuple[int, bool] | None]:
    """Of each block, how far back the last decided one is, and its label."""
    out, last = [], None
    for i, label in enumerate(decided):
        out.append(None if last is None else (i - last[0], last[1]))
        if label is not None:
            last = (i, label)
    return out


def extract(page: str | None) -> str:
    """The main text: blocks in page order, a line each. Empty if there is none.

    Where nothing is clear text, an element that holds most of the text of the page is not believed to be something
    else: by its name if no other text is left or the name is one of layout, or as a form. Such a reading of the page
    counts if it has clear text or no other text is left.
    """
    page = page or ""
    reader = _Reader()
    blocks = reader.read(page)
    text = _chosen(blocks)
    if not blocks or any(b.clear or b.article and b.label for b in blocks):
        return text
    half = sum(len(b.text) for b in blocks) / 2
    wide = frozenset(i for i, (words, size) in enumerate(reader.marks) if size > half and (not text or words & LAYOUT_WORDS))
    forms_count = reader.in_forms <= half
    readings = []
    for names, forms in ((wide, True), (frozenset(), forms_count), (wide, forms_count)):
        if names or not forms:
            other = _Reader(names, forms).read(page)
            readings.append((_chosen(other), any(b.clear for b in other)))
    for other, clear in sorted(readings[:2], key=lambda r: -len(r[0])) + readings[2:]:
        if other and (clear or not text):
            return other
    return text


def _chosen(blocks: list[Block]) -> str:
    classify(blocks)
    return "\n".join(b.text for b in blocks if b.label)


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row.

    A missing or empty page, and one without text, has an empty text. Repeated rows come out alike, an empty table gives
    none, other columns are not looked at. Work grows with the length of a page, which its task holds whole.
    """

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"),
                    pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(extracted, schema)
