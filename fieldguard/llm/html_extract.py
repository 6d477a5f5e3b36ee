"""Main text of web pages by two-pass block rules.

Pass one classifies blocks on their own by stop-word density, length and link density. Pass two lets blocks
that are too short or too unclear to decide take the label of their nearest decided neighbours. Markup sets the
regions in which neighbours are sought (an article or main element, or what lies outside) and the elements that
never are main text. Pages are read in one pass whose time grows with their length alone, however broken they are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_rows, text_bytes

# Frequent function words of the supported languages.
STOP_WORDS = frozenset(
    (
        "a an and are as at be by for from has have he in is it its of on or that the this to was were which will with you "
        "au aux avec ce ces dans de des du elle en est et il je la le les leur ne nous on ou par pas plus pour que qui sa se ses son sur un une vous "
        "als am auch auf aus bei das dem den der des die ein eine einem einen einer es für im in ist mit nicht sich sie sind so und von war wird zu zum zur "
        "al como con de del el en es esta este la las lo los más no o para pero por que se su sus un una y"
    ).split()
)
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe")
BOILERPLATE = frozenset("nav footer aside form menu dialog button select head".split())
CONTENT = frozenset("article main".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end where the next one of their kind starts.
NO_NESTING = frozenset("p li dt dd tr td th option".split())
# Parts of names (class, id, role) that mark what isn't the article, and parts that say nothing beside them.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial banner sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices alert alerts popup modal overlay "
    "sidebar comment comments disqus respond replies nav navbar navigation menu breadcrumb breadcrumbs footer masthead share sharing social related "
    "newsletter subscribe contentinfo complementary toolbar pagination pager widget widgets".split()
)
NEUTRAL = frozenset("site page global list box bar block blocks container wrapper wrap area region section top bottom left right inner outer item items slot unit text links link posts buttons button form thread 1 2 3".split())
#: Parts that make a name the readers' wherever they stand, parts that cast doubt on a name that begins or ends with them, and
#: first parts of names that tell of a page and not of what the element holds.
READERS = frozenset("comment comments commentlist disqus respond replies responses".split())
DOUBTFUL = frozenset("ad ads advert adverts advertisement nav navbar navigation menu sidebar newsletter cookie cookies consent sponsor sponsored promo related share sharing social signup subscribe breadcrumb discussion".split())
ABOUT = frozenset("has no not with without is".split())
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE_NAME = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)?\s*(=?)\s*")
UNQUOTED = re.compile(r"[^\s>]*")
PART = re.compile(r"[-_]+|(?<=[a-z0-9])(?=[A-Z])")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
WORD = re.compile(r"[^\W\d_]+")
WHITE = re.compile(r"\s+")


@dataclass(frozen=True)
class Rules:
    """Bounds of the first pass: code points, shares of words and of characters. Inside an article or main element a
    block is good from content_stop on and undecided below; it is bad from content_link on."""

    short: int = 70
    long: int = 200
    stop_low: float = 0.30
    stop_high: float = 0.32
    link_high: float = 0.20
    content_stop: float = 0.10
    content_link: float = 0.90


@dataclass
class Block:
    text: str
    linked: int
    marked: bool  # by an element or name that isn't the article
    doubtful: bool  # in an element whose name speaks against it without being sure
    region: int  # which article or main element it is in, 0 for none
    heading: bool
    label: str = ""


@dataclass
class Tag:
    name: str
    end: bool
    names: list[str]  # the words of class, id and role
    empty: bool


def parts_of(page: str) -> Iterator[str | Tag]:
    """Texts and tags of a page in order; comments, declarations and the contents of raw elements are left out."""
    at, size, closed = 0, len(page), {'"': True, "'": True}
    while at < size:
        start = page.find("<", at)
        if start < 0:
            yield page[at:]
            return
        if start > at:
            yield page[at:start]
        nxt = page[start + 1 : start + 2]
        if nxt in ("!", "?"):
            end = page.find("-->", start + 4) + 2 if page.startswith("<!--", start) else page.find(">", start)
            if end < start:
                return
            at = end + 1
            continue
        name = NAME.match(page, start + 1 + (nxt == "/"))
        if not name:
            yield "<"
            at = start + 1
            continue
        at, names, empty = name.end(), [], False
        while at < size and page[at] != ">":  # attributes
            a = ATTRIBUTE_NAME.match(page, at)
            at = a.end()
            if not a[2]:
                empty = page[at - 1] == "/" if not a[1] else False
                continue
            quote = page[at : at + 1]
            end = page.find(quote, at + 1) if closed.get(quote) else -1
            if end < 0:
                closed[quote] = False  # no such mark follows, here or later
                end = UNQUOTED.match(page, at).end()
                value, at = page[at:end], end
            else:
                value, at = page[at + 1 : end], end + 1
            if (a[1] or "").lower() in ("class", "id", "role"):
                names += value.split()
        if at >= size:  # a tag without an end holds no text
            return
        at += 1
        tag = Tag(name[0].lower(), nxt == "/", names, empty or page[at - 2] == "/")
        if tag.name in RAW_END and not tag.end:
            end = RAW_END[tag.name].search(page, at)
            if not end:
                return
            at = page.find(">", end.end()) + 1 or size
            continue
        yield tag


def marked(names: list[str]) -> bool:
    """Whether a name consists of marks, and parts that say nothing, alone, or tells of readers' contributions."""
    for name in names:
        parts = _name_parts(name)
        if any(x in MARKS for x in parts) and all(x in MARKS or x in NEUTRAL for x in parts):
            return True
        if parts and parts[0] not in ABOUT and not READERS.isdisjoint(parts):
            return True
    return False


def _name_parts(name: str) -> list[str]:
    return [x.lower() for x in PART.split(name) if x]


def doubted(names: list[str]) -> bool:
    """Whether a name begins or ends with, or has between other parts, what seldom names an article."""
    return any(parts and parts[0] not in ABOUT and not DOUBTFUL.isdisjoint(parts) for parts in map(_name_parts, names))


class Elements:
    """The open elements, with the places of each name, of blocks and of articles, so that an end tag is looked up at once."""

    def __init__(self):
        self.open: list[tuple[str, bool]] = []  # name, skipped
        self.of: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.content: list[int] = []
        self.skips: list[int] = []
        self.doubts: list[int] = []

    def push(self, name: str, skipped: bool, doubtful: bool = False) -> None:
        at = len(self.open)
        self.open.append((name, skipped))
        self.of.setdefault(name, []).append(at)
        for there, places in ((name in BLOCK, self.blocks), (name in CONTENT, self.content), (skipped, self.skips), (doubtful, self.doubts)):
            if there:
                places.append(at)

    def cut(self, at: int) -> None:
        """Closes the element at this place and all in it."""
        while len(self.open) > at:
            name, _ = self.open.pop()
            self.of[name].pop()
            for places in (self.blocks, self.content, self.skips, self.doubts):
                if places and places[-1] == len(self.open):
                    places.pop()

    def last(self, name: str) -> int:
        places = self.of.get(name)
        return places[-1] if places else -1

    def end(self, name: str) -> None:
        """An end tag closes the last such element, an inline one only in its own block, others not across an article."""
        at = self.last(name)
        bound = self.content if name in BLOCK else self.blocks
        if at >= 0 and (name in CONTENT or name in ("html", "body") or not bound or at >= bound[-1]):
            self.cut(at)

    def skipped_inline(self) -> bool:
        return bool(self.skips) and self.open[self.skips[-1]][0] not in BLOCK


def blocks_of(page: str) -> list[Block]:
    """Blocks in page order; text in one block has its white space joined and character references decoded."""
    out: list[Block] = []
    texts: list[str] = []
    linked = region = regions = 0
    heading = False
    elements = Elements()

    def close() -> None:
        nonlocal linked, heading
        text = WHITE.sub(" ", "".join(texts)).strip()
        if text:
            inside = elements.content[-1] if elements.content else -1  # an article settles doubts about what it stands in
            out.append(Block(text, linked, bool(elements.skips), bool(elements.doubts) and elements.doubts[-1] > inside, region, heading))
        texts.clear()
        linked, heading = 0, False

    for part in parts_of(page):
        if isinstance(part, str):
            if not elements.skipped_inline():  # an inline notice in a paragraph is left out of it
                text = html.unescape(part)
                texts.append(text)
                if elements.last("a") >= 0:
                    linked += len(text.strip())
            continue
        name = part.name
        if name == "br":
            texts.append(" ")
            continue
        if name in BLOCK:
            close()
        if part.end:
            elements.end(name)
            region = region if elements.content else 0
            continue
        if name in NO_NESTING and elements.blocks and elements.last(name) == elements.blocks[-1]:
            elements.cut(elements.last(name))
        if name in BLOCK:
            heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
        if name in CONTENT and not elements.content:  # an unclosed mark before the article ends here
            if elements.skips:
                elements.cut(elements.skips[0])
            regions += 1
            region = regions
        if name == "a" and elements.last("a") >= 0:  # links don't nest
            elements.end("a")
        if name in VOID or part.empty and name not in BLOCK:
            continue
        whole = name in CONTENT or name in ("html", "body")
        elements.push(name, not whole and (name in BOILERPLATE or (name == "header" and not elements.content) or marked(part.names)), not whole and name in BLOCK and doubted(part.names))
    close()
    return out


def _density(text: str) -> float:
    """The share of stop words among a text's words."""
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def classify(block: Block, rules: Rules) -> str:
    """Pass one: good, bad, near (unclear) or short."""
    if block.marked:
        return "bad"
    n = len(block.text)
    if block.doubtful and (n <= rules.long or block.linked > rules.link_high * n or _density(block.text) < rules.stop_high):
        return "bad"  # what its name doubts only long prose without links can settle
    if block.linked > rules.link_high * n:
        return "bad" if not block.region or block.linked >= rules.content_link * n else "near"
    if n < rules.short:
        return "bad" if block.linked and not block.region else "short"
    density = _density(block.text)
    if block.region:
        return "good" if density >= rules.content_stop else "near"
    if density >= rules.stop_high:
        return "good" if n > rules.long else "near"
    return "near" if density >= rules.stop_low else "bad"


def revise(blocks: list[Block]) -> None:
    """Pass two: undecided blocks take the label on which their nearest decided neighbours agree.

    Neighbours are blocks of the same region that pass one decided by their text, and outside articles also marked
    ones. Where they differ or there are none, blocks of an article are good; outside, headings before a good block
    and unclear blocks beside one.
    """
    seen: dict[int, str] = {}
    after = [""] * len(blocks)
    votes = lambda b: b.label in ("good", "bad") and not (b.region and (b.marked or b.doubtful))
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        after[i] = seen.get(b.region, "")
        if votes(b):
            seen[b.region] = b.label
    seen, decided = {}, []
    for b, nxt in zip(blocks, after):
        before = seen.get(b.region, "")
        if b.label in ("good", "bad"):
            decided.append(b.label)
        elif before == nxt and before:
            decided.append(before)
        elif b.region:
            decided.append("good")
        elif b.heading and nxt == "good":
            decided.append("good")
        else:
            decided.append("good" if b.label == "near" and "good" in (before, nxt) else "bad")
        if votes(b):
            seen[b.region] = b.label
    for b, label in zip(blocks, decided):
        b.label = label


def extract(page: str, rules: Rules = Rules()) -> str:
    """The main text of one page; empty for a page without any."""
    blocks = blocks_of(page)
    for b in blocks:
        b.label = classify(b, rules)
    revise(blocks)
    return " ".join(b.text for b in blocks if b.label == "good")


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_pages(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages, from its whole html.

    A null or empty html, or one without main text, gives "" and 0. Null or repeated page_id and url stay as
    they are; other columns are ignored. Unclosed elements and comments end with the page. Narrow: no shuffle.
    """

    def rows(x):
        texts = [extract(h.decode(), rules) for h in x["html"]]
        return {"page_id": x["page_id"], "url": x["url"], "text": texts, "n_chars": map(len, texts)}

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text_bytes("html").alias("html")).mapInArrow(
        by_rows(lambda x: {k: list(v) for k, v in rows(x).items()}, _SCHEMA), "page_id long, url string, text string, n_chars long"
    )
