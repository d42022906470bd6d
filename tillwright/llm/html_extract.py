"""HTML extraction by the maximum-scoring subsequence of words and tags.

A page is a sequence of tags and words. Words score positive and tags negative, with
weights from labelled pages: those whose markup says where the main text is (article,
main, or an articleBody). A tag costs the more, the more often labelled pages have it
outside that part. One linear scan finds the contiguous region of the highest total.
The region then grows to the nearest tags that cost more than ordinary ones, so that
short first and last blocks are whole, and what is no text of the article wherever it
stands (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
comments) is left out of scan and result alike. Such an element is told by its kind
(``nav``, ``form``), or by the cost of a class, id or role, learned the same way: names
like ``ad`` start as if they had been seen outside a few times, any other name as if it
had been seen inside, and what the labelled pages show can outweigh both. A header inside
the main part is the article's own.

The labelled pages are those of a bounded sample (SAMPLE pages, the smallest by a hash
of id and page), counted by Spark; the driver gets counts of at most KEYS tags and names.
Without any labelled page the weights are defaults.

Defined results: null and empty pages give an empty text; a page without tags is one
block; unclosed tags, comments and references are read as far as they go; pages that
repeat an id each have a row; empty input gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import Scratch, bounded_sample

SAMPLE = 2000
#: Cost of an ordinary tag, and of a tag that is not known.
ORDINARY, UNKNOWN = 0.2, 0.5
#: A tag that costs more than this ends the growth of the region.
BARRIER = 1.0
#: Score of a word until pages have been seen.
WORD = 0.3
#: Times that a name is taken to have been seen before any page is.
BEFORE = 4
#: How much a name like ``ad`` counts when it is seen inside a labelled part, which may
#: hold adverts as well.
INSIDE = 0.1
#: Tags and names that the driver gets counts of at most, the most frequent ones.
KEYS = 20_000
#: Runs of more words than this count as so long.
LONG_RUN = 10_000

# Elements whose content is no text, elements that are no part of an
# article, and names of the same in classes, ids and roles.
SILENT = ("script", "style", "noscript", "template", "textarea", "svg", "math", "iframe", "object", "head", "title", "select", "canvas", "audio", "video")
APART = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "label", "input", "option")
APART_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "comment-list contentinfo cookie cookies complementary disclaimer disqus footer form header masthead "
    "menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted "
    "related reply replies respond search share sharing sidebar social sponsor sponsored "
    "subscribe toolbar topbar widget alert".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: With one of these last, a compound name whose first part is in the list above names
#: the same thing (``ad-box``); with one of the next first, one whose last part is
#: (``site-nav``).
HOLDERS = frozenset(
    "area bar block box buttons container form holder inner item items links list menu overlay panel "
    "posts section signup slot thread unit widget wrap wrapper".split()
)
PLACES = frozenset("article bottom global left main page post reader right site top user".split())
HEADS = frozenset(["header", "masthead"])
MAIN = ("article", "main")
#: Elements whose closing tag leaves the blocks in them open.
INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var".split()
)
LISTS = frozenset(["ul", "ol"])
#: A closing tag inside one of these ends nothing outside it.
CELLS = frozenset("table caption td th button".split())
TABLE = frozenset("table caption thead tbody tfoot tr td th".split())
ROWS = frozenset(["thead", "tbody", "tfoot"])
#: Opening tags, the elements that they end without a closing tag, and those beyond
#: which they end none.
IMPLIED = (
    (frozenset(["li"]), frozenset(["li"]), BLOCK - {"address", "div", "p", "li"} | {"button"}),
    (frozenset(["dt", "dd"]), frozenset(["dt", "dd"]), BLOCK - {"address", "div", "p", "dt", "dd"} | {"button"}),
    (frozenset(["option"]), frozenset(["option"]), BLOCK | {"optgroup", "datalist"}),
    (frozenset(["optgroup"]), frozenset(["option", "optgroup"]), BLOCK | {"datalist"}),
    (frozenset(["td", "th"]), frozenset(["td", "th", "caption"]), frozenset(["table"])),
    (frozenset(["tr"]), frozenset(["tr", "td", "th", "caption"]), frozenset(["table"])),
    (ROWS, ROWS | {"tr", "td", "th", "caption"}, frozenset(["table"])),
    (BLOCK - TABLE - {"legend", "body", "html"} | {"table", "dialog"}, frozenset(["p"]), CELLS),
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|math|iframe|object|title|select|canvas|audio|video)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
PART = re.compile(r"[-_]+")
BODY = re.compile(r"""\bitemprop\s*=\s*["']?articleBody""", re.IGNORECASE)


@dataclass
class Token:
    """A run of text, or a tag with the key its weight goes by."""

    text: str = ""
    key: str = ""
    name: str = ""
    closes: bool = False
    main: bool = False
    names: tuple[str, ...] = ()


def _names(attributes: str) -> list[str]:
    return [n for m in NAMES.findall(attributes) for n in m.strip("\"'").lower().split()]


def _word_of(own: str) -> str | None:
    """The name of something apart that a class, id or role says, if it does."""
    if own in APART_NAMES:
        return own
    parts = PART.split(own)
    if len(parts) > 1 and parts[0] in APART_NAMES and parts[-1] in HOLDERS | APART_NAMES:
        return parts[0]
    if len(parts) > 1 and parts[-1] in APART_NAMES and parts[0] in PLACES:
        return parts[-1]
    return None


def _cost(inside: float, outside: float) -> float:
    """From the ordinary cost for what is inside up to a dozen times a word."""
    share = (outside + 0.5) / (inside + outside + 1)
    return ORDINARY + (8 - ORDINARY) * max(0.0, 2 * share - 1)


def tokens(html: str) -> list[Token]:
    """Tags and runs of text in page order; scripts, styles and comments are left out."""
    out: list[Token] = []
    at = 0
    for match in TOKEN.finditer(html):
        if match.start() > at:
            out.append(Token(text=html[at : match.start()]))
        at = match.end()
        if match[3] is None:
            if match[1] is not None and match[1].lower() == "title":
                continue
            if match[1] is not None:
                out.append(Token(key="#silent"))
            continue
        name, closes = match[3].lower(), bool(match[2])
        names = tuple(_names(match[4])) if match[4] and not closes else ()
        out.append(
            Token(
                key=("/" if closes else "") + name + "".join("." + n for n in names[:2]),
                name=name,
                closes=closes,
                main=not closes and (name in MAIN or bool(match[4] and BODY.search(match[4]))),
                names=names,
            )
        )
    if at < len(html):
        out.append(Token(text=html[at:]))
    return out


class _Open:
    """The open elements. Those of a name are found without a walk over all of them."""

    def __init__(self):
        self.places: list[int | None] = []  # None where one in between has been closed
        self.names: list[str] = []
        self.of: dict[str, list[int]] = defaultdict(list)  # by name, where in the lists
        self.blocks: list[int] = []

    def push(self, place: int, name: str) -> None:
        self.of[name].append(len(self.names))
        if name in BLOCK:
            self.blocks.append(len(self.names))
        self.places.append(place)
        self.names.append(name)

    def last(self, names: frozenset[str]) -> int:
        return max((own[-1] for n in names if (own := self.of.get(n))), default=-1)

    def cut(self, at: int) -> list[int]:
        """Close all from ``at`` on; the places of those that were open."""
        gone = []
        while len(self.names) > at:
            place, name = self.places.pop(), self.names.pop()
            if place is not None:
                gone.append(place)
                self.of[name].pop()
                if name in BLOCK:
                    self.blocks.pop()
        return gone

    def take(self, at: int) -> int:
        """Close the one at ``at``, the last of its name and no block if others are above."""
        place, name = self.places[at], self.names[at]
        if at == len(self.names) - 1:
            self.cut(at)
        else:
            self.places[at] = None
            self.of[name].pop()
        return place

    def closing(self, name: str) -> int | None:
        """The one that a closing tag ends."""
        own = self.of.get(name)
        if not own:
            return None
        if name in ("body", "html"):
            stops = frozenset()
        elif name in TABLE:
            stops = frozenset(["table"])
        else:
            stops = LISTS | CELLS if name == "li" else CELLS
        return own[-1] if own[-1] > self.last(stops - {name}) else None

    def implied(self, ends: frozenset[str], stops: frozenset[str]) -> int | None:
        """The outermost that an opening tag ends, up to a stop."""
        stop = self.last(stops - ends)
        found = [own[at] for n in ends if (own := self.of.get(n)) and (at := bisect_right(own, stop)) < len(own)]
        return min(found, default=None)


def _ends(own: list[Token]) -> list[tuple[int, bool]]:
    """For every token the end of the element that it opens, and whether its own closing tag is there."""
    out = [(i + 1, True) for i in range(len(own))]
    opened = _Open()

    def cut(at: int, end: int) -> None:
        for place in opened.cut(at):
            out[place] = (end, False)

    for i, token in enumerate(own):
        name = token.name
        if not name:
            continue
        if token.closes:
            at = opened.closing(name)
            if at is None:
                continue
            if name not in INLINE or not (opened.blocks and opened.blocks[-1] > at):
                cut(at + 1, i)
            # Blocks in an inline element go on.
            out[opened.take(at)] = (i + 1, True)
            continue
        for starts, ends, stops in IMPLIED:
            if name in starts:
                at = opened.implied(ends, stops)
                if at is not None:
                    cut(at, i)
        if name not in VOID:
            opened.push(i, name)
    cut(0, len(own))
    return out


def apart(own: list[Token], weights: Weights | None = None) -> list[bool]:
    """Which tokens lie in an element that is no part of an article (its tags included).

    Such an element ends at its closing tag. One that is never closed ends at its
    parent's closing tag or at an opening tag that implies its end (as a ``p`` or ``li``
    the one before). None goes on where the main part begins or ends.
    """
    weights = weights or Weights()
    out = [False] * len(own)
    main = _main_spans(own)
    marked = [t.name not in VOID and weights.is_apart(t, m) for t, m in zip(own, main, strict=True)]
    ends = _ends(own) if any(marked) else []
    i = 0
    while i < len(own):
        token = own[i]
        if not marked[i]:
            i += 1
            continue
        stop, closed = ends[i]
        for j in range(i + 1, stop):
            other = own[j]
            edge = other.main or (other.closes and other.name in (*MAIN, "body", "html"))
            if edge and not (closed and other.name == token.name):
                stop = j
                break
        out[i:stop] = [True] * (stop - i)
        i = stop
    return out


def _main_spans(own: list[Token]) -> list[bool]:
    """Which tokens come after the start of a main part that has not ended."""
    out, depth = [], Counter()
    for token in own:
        if token.main and not token.closes:
            depth[token.name] += 1
        elif depth[token.name] and token.name and (token.closes or not token.main):
            depth[token.name] += -1 if token.closes else 1
        out.append(any(depth.values()))
    return out


def _labelled(own: list[Token]) -> tuple[int, int] | None:
    """The part of a page that its markup names as the main one."""
    for i, token in enumerate(own):
        if token.main:
            depth = 0
            for j in range(i, len(own)):
                if own[j].name == token.name:
                    depth += -1 if own[j].closes else 1
                    if depth == 0:
                        return i + 1, j
            return i + 1, len(own)
    return None


@dataclass
class Weights:
    """Cost of each tag key and of each class, id or role, and the score of a word."""

    cost: dict[str, float] = field(default_factory=dict)
    word: float = WORD
    names: dict[str, float] = field(default_factory=dict)

    def of(self, token: Token) -> float:
        found = self.cost.get(token.key)
        if found is None:
            found = self.cost.get(("/" if token.closes else "") + token.name, UNKNOWN)
        return found

    def is_apart(self, token: Token, inside: bool) -> bool:
        """Whether an element is no part of an article; ``inside`` the main part or not."""
        if token.closes or not token.name or token.main or token.name in ("body", "html"):
            return False
        if token.name in APART and not (inside and token.name in HEADS):
            return True
        return any(self._name_cost(n, inside) > BARRIER for n in token.names)

    def _name_cost(self, name: str, inside: bool) -> float:
        """Outside, where an element may hold the main part, a name must also mean something apart."""
        word, known = _word_of(name), self.names.get(name)
        if word is None and not inside:
            return ORDINARY
        if known is not None:
            return known
        return ORDINARY if word is None or (inside and word in HEADS) else _cost(0, BEFORE)


def _name_counts(own: list[Token], counts: Counter) -> None:
    """Add how often each name is inside the labelled part or around it, and outside."""
    part = _labelled(own)
    if part is None:
        return
    ends = _ends(own)
    for i, token in enumerate(own):
        if token.names and not token.main:
            within = i < part[1] and ends[i][0] > part[0]
            for name in set(token.names):
                counts["name", name, within] += 1


def _tag_counts(own: list[Token], weights: Weights, counts: Counter) -> None:
    """Add how often each tag key is inside and outside, and the lengths of runs outside."""
    part = _labelled(own)
    if part is None:
        return
    for i, (token, skip) in enumerate(zip(own, apart(own, weights), strict=True)):
        within = part[0] <= i < part[1]
        if skip:
            continue  # free in the scan, wherever it stands
        if token.key:
            counts["tag", token.key, within] += 1
        elif not within and token.text.strip():
            counts["run", str(min(len(token.text.split()), LONG_RUN)), False] += 1


def _learned_names(counts: dict[tuple[str, str, bool], int]) -> dict[str, float]:
    names = {name for _, name, _ in counts}
    out = {}
    for name in names:
        inside, outside = counts.get(("name", name, True), 0), counts.get(("name", name, False), 0)
        known = _word_of(name) is not None
        out[name] = _cost(inside * INSIDE, outside + BEFORE) if known else _cost(inside + BEFORE, outside)
    return out


def _learned(counts: dict[tuple[str, str, bool], int], names: dict[str, float]) -> Weights:
    tags = {key for kind, key, _ in counts if kind == "tag"}
    if not any(counts.get(("tag", key, False)) for key in tags):
        return Weights(names=names)
    cost = {key: _cost(counts.get(("tag", key, True), 0), counts.get(("tag", key, False), 0)) for key in tags}
    runs = sorted((int(size), n) for (kind, size, _), n in counts.items() if kind == "run")
    long_run, left = 20, int(sum(n for _, n in runs) * 0.99)
    for size, n in runs:
        long_run, left = size, left - n
        if left < 0:
            break
    # Crossing two tags from outside costs more than such a run of words gains.
    return Weights(cost, min(WORD, 8 / max(long_run, 1)), names)


def learn(pages: list[str]) -> Weights:
    """Costs from how often a tag is outside the main part, a word's score from runs outside."""
    counts: Counter = Counter()
    for page in pages:
        _name_counts(tokens(page), counts)
    names = _learned_names(counts)
    counts = Counter()
    for page in pages:
        _tag_counts(tokens(page), Weights(names=names), counts)
    return _learned(counts, names)


def region(own: list[Token], skip: list[bool], weights: Weights) -> tuple[int, int]:
    """First token and end of the best contiguous region, grown to its barriers."""
    best, at, total, first, end = 0.0, 0, 0.0, 0, 0
    # What is apart neither gains nor costs, wherever it interrupts the article.
    costs = [weights.of(t) if t.key and not s else 0.0 for t, s in zip(own, skip, strict=True)]
    for i, token in enumerate(own):
        if total <= 0:
            total, at = 0.0, i
        if token.key:
            total -= costs[i]
        elif not skip[i]:
            total += weights.word * len(token.text.split())
        if total > best:
            best, first, end = total, at, i + 1
    if best == 0.0:
        # No word outweighs a tag: what there is beyond menus and the like.
        return 0, len(own)
    while first > 0 and costs[first - 1] <= BARRIER:
        first -= 1
    while end < len(own) and costs[end] <= BARRIER:
        end += 1
    return first, end


def extract(html: str | None, weights: Weights) -> str:
    """The blocks of the main text, joined by an empty line."""
    if not html:
        return ""
    own = tokens(html)
    skip = apart(own, weights)
    first, end = region(own, skip, weights)
    blocks: list[str] = []
    parts: list[str] = []

    def close() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            blocks.append(text)
        parts.clear()

    for i in range(first, end):
        token = own[i]
        if skip[i] or token.name in BLOCK:
            close()
        if skip[i]:
            continue
        if token.name == "br":
            parts.append("\n")
        elif not token.key:
            parts.append(token.text)
    close()
    return "\n\n".join(blocks)


def _counted(pages: DataFrame, add) -> dict[tuple[str, str, bool], int]:
    """Counts over all pages, added up by Spark; the driver gets the KEYS most frequent."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                add(tokens(page.as_py() or ""), counts)
        kind, name, within = zip(*counts, strict=True) if counts else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(kind, pa.string()), pa.array(name, pa.string()), pa.array(within, pa.bool_()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            ["kind", "name", "within", "n"],
        )

    summed = pages.select("html").mapInArrow(gather, "kind string, name string, within boolean, n long")
    found = summed.groupBy("kind", "name", "within").agg(F.sum("n").alias("n"))
    most = found.orderBy(F.desc("n"), "kind", "name", "within").limit(KEYS)
    return {(r.kind, r.name, r.within): r.n for r in most.collect()}


def train(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = SAMPLE) -> Weights:
    """Weights from those of a bounded sample of pages whose markup names the main part."""
    scratch = Scratch(pages.sparkSession)
    own = pages.select(F.col(page_id).alias("page_id"), F.col(html).alias("html"))
    picked = bounded_sample(own, sample, "page_id", "html").select("html")
    # The sample arrives in one partition, being a limit; it is dealt out before it is read.
    dealt = scratch.keep(picked.repartition(max(1, sample // 50)), "sample-pages")
    names = _learned_names(_counted(dealt, _name_counts))
    weights = Weights(names=names)
    learned = _learned(_counted(dealt, lambda own, counts: _tag_counts(own, weights, counts)), names)
    scratch.drop()
    return learned


def main_text(weights: Weights, html: Column) -> Column:
    @F.arrow_udf("string")
    def apply(column: pa.Array) -> pa.Array:
        return pa.array((extract(h.as_py(), weights) for h in column), pa.string())

    return apply(html)


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    weights = train(pages, page_id, html)
    found = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), main_text(weights, F.col(html)).alias("text")
    )
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
