"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block with text; what menus, headers, footers
and the like hold is left out. Text lengths are summed over a sliding window of
lines. A dive of that sum to nothing parts the lines into regions, and a region
with a surge is kept whole, short lines too.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines in a window, and the text length at which a window is a surge.
WINDOW, SURGE = 3, 80

_OPENING = re.compile(r"<!--|<(/?)([a-zA-Z][\w:-]*)|<[!?]")
_QUOTED = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_UNQUOTED = re.compile(r"[^<>]*(>|\Z)")
_SPECIAL = re.compile("[>\"']")
_NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Elements whose content is no markup, elements that are never main
#: text, elements that end a line, elements without an end tag, words in class, id
#: and role names, and words that make such a name a phrase.
_RAW = frozenset("script style noscript template svg iframe textarea select object canvas math title".split())
_DROPPED = frozenset("head nav footer aside form button menu dialog fieldset".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HOLDERS = frozenset("article main".split())
_CONTAINERS = frozenset("article body dialog div main section".split())
_NEVER = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent"
    " contentinfo cookie cookies discussion disqus footer gdpr login menu menubar modal nav navbar navigation newsletter notice"
    " notices notification pagination pager popup promo promoted promotion replies reply search signup sponsor sponsored"
    " subscribe subscription toolbar".split()
)
_UNLESS_CONTENT = frozenset("alert banner dropdown header masthead recommended related share sharing sidebar side social topbar widget".split())
_CONTENT = frozenset("article body content entry main page post story text".split())
_STORY = frozenset("article entry hentry main post story".split())
_PHRASE = frozenset("a and for in of on or the to with".split())
_TEXT_STARTS = frozenset("article main section p h1 h2 h3 blockquote".split())


class _TagEnds:
    """Where tags end, quotes regarded, in time that grows with the page whatever its quotes are.

    A tag is scanned by a pattern, until one does not end; from then on the way
    from each quote is followed once.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.known: dict[int, int] | None = None

    def find(self, at: int) -> int:
        """The place after the end of a tag whose attributes begin here; -1 if it has none."""
        if self.known is None:
            found = _QUOTED.match(self.page, at)
            if found:
                return found.end()
            self._survey()
        place = bisect_left(self.places, at)
        way = []
        while place < len(self.places) and place not in self.known:
            way.append(place)
            if self.marks[place] == ">":
                self.known[place] = self.places[place] + 1
                break
            place = self.after[place]
        end = self.known.get(place, -1)
        self.known.update(dict.fromkeys(way, end))
        return end

    def _survey(self) -> None:
        """The marks of the page, and for each quote the mark after the quote that closes it."""
        found = list(_SPECIAL.finditer(self.page))
        self.known, self.places, self.marks = {}, [m.start() for m in found], [m[0] for m in found]
        self.after, last = [len(found)] * len(found), {}
        for k in range(len(found) - 1, -1, -1):
            if self.marks[k] != ">":
                self.after[k] = last.get(self.marks[k], len(found) - 1) + 1
                last[self.marks[k]] = k


@dataclass
class _Token:
    """A piece of markup from ``start`` to ``end``; ``tag`` is empty where it is no tag."""

    start: int
    end: int
    tag: str = ""
    closing: bool = False
    attributes: str = ""


def _tokens(page: str) -> Iterator[_Token]:
    """The markup of a page: comments, elements without markup inside as a whole, and tags."""
    ends, at = _TagEnds(page), 0
    while found := _OPENING.search(page, at):
        start, at = found.span()
        if found[0] == "<!--":
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
            yield _Token(start, at)
            continue
        if not found[2]:
            end = page.find(">", at)
            at = len(page) if end < 0 else end + 1
            yield _Token(start, at)
            continue
        tag, name_end = found[2].lower(), at
        end = ends.find(name_end)
        if end >= 0 and tag in _RAW and not found[1]:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, end)
            at = close.end() if close else len(page)
            yield _Token(start, at)
        elif end >= 0:
            at = end
            yield _Token(start, at, tag, bool(found[1]), page[name_end : end - 1])
        elif plain := _UNQUOTED.match(page, name_end):
            at = plain.end()
            yield _Token(start, at, tag, bool(found[1]), page[name_end : at - 1]) if plain[1] else _Token(start, at)


@dataclass
class _Line:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    held: bool = False
    container: int = 0


def _boilerplate(tag: str, attributes: str, inside: int) -> bool:
    """Whether an element's tag or names say that it is not main text; ``inside``: open articles and mains."""
    if tag in _DROPPED or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("main", "html", "body"):
        return False
    if tag != "article" and _HIDDEN.search(attributes):
        return True
    names: set[str] = set()
    for found in _NAMES.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").split():
            own = {w.lower() for w in _WORDS.findall(name)}
            if not own & _PHRASE:  # "search-and-rescue" says what a text is about
                names |= own | {"comment" for w in own if w.startswith("comment")}
    if tag == "article" and names & _STORY:
        return False  # its other names may be those of categories
    return bool(names & _NEVER) or bool(names & _UNLESS_CONTENT and not names & _CONTENT)


def _ends(tags: list[tuple[str, bool, str]]) -> tuple[dict[int, int], set[int]]:
    """For each start tag the end tag, its own or that of an element around it, that ends it, and those that have their own."""
    ends, own = {}, set()
    blocks: list[int] = []
    waiting: defaultdict[str, list[int]] = defaultdict(list)
    for k, (tag, closing, attributes) in enumerate(tags):
        if not closing and tag not in _VOID and not _CLOSED.search(attributes):
            waiting[tag].append(k)
            if tag in _BLOCKS:
                blocks.append(k)
        elif closing and waiting[tag]:
            start = waiting[tag][-1] if tag in _BLOCKS else waiting[tag].pop()
            ends[start] = k
            own.add(start)
            while tag in _BLOCKS:
                last = blocks.pop()
                waiting[tags[last][0]].pop()
                ends[last] = k
                if last == start:
                    break
    return ends, own


def _weights(page: str, tokens: list[_Token], ends: dict[int, int]) -> tuple[list[int], set[int]]:
    """Characters of text before each token, and the articles, by their start and end tags, that count as such.

    Of several articles side by side those are cards or comments that hold less
    than half of the text of all.
    """
    before, at = [0], 0
    for token in tokens:
        before.append(before[-1] + len(page[at : token.start].strip()))
        at = token.end
    before.append(before[-1] + len(page[at:].strip()))
    outer, last = [], -1
    for k, token in enumerate(tokens):
        if token.tag == "article" and not token.closing and k > last:
            last = min(ends.get(k, len(tokens)), len(tokens))
            outer.append((before[min(last + 1, len(tokens))] - before[k + 1], k, last))
    whole = sum(size for size, _, _ in outer)
    small = [(k, end) for size, k, end in outer if len(outer) > 1 and 2 * size < whole]
    holders = {k for k, token in enumerate(tokens) if token.tag == "article"}
    for first, end in small:
        holders -= set(range(first, end + 1))
    return before, holders


def page_lines(page: str) -> list[tuple[str, int, bool, int]]:
    """Text, length outside links, whether an article holds it, and the number of its container, of every line with text."""
    lines: list[_Line] = [_Line()]
    stop, ended, soft, leaves, links, inside, at = -1, False, False, (), 0, 0, 0
    opened, stack = 0, [("", 0)]
    open_tags: Counter[str] = Counter()

    def text(piece: str) -> None:
        if stop >= 0 or not piece:
            return
        piece = html.unescape(piece) if "&" in piece else piece
        lines[-1].parts.append(piece)
        lines[-1].held = lines[-1].held or inside > 0
        if links:
            lines[-1].linked += len(piece.strip())

    tokens = list(_tokens(page))
    tags = [(t.tag, t.closing, t.attributes) for t in tokens]
    ends, own = _ends(tags)
    before, holders = _weights(page, tokens, ends)
    for k, (token, (tag, closing, attributes)) in enumerate(zip(tokens, tags, strict=True)):
        text(page[at : token.start])
        at = token.end
        if not tag:
            continue
        if stop >= 0:
            if k < stop and (closing or not (tag in leaves or (soft and tag in _BLOCKS))):
                continue
            stop = -1  # its end, or an end tag was left out, or it wraps the page
            if closing and ended:
                continue
        dropped = not closing and tag not in _VOID and not _CLOSED.search(attributes) and _boilerplate(tag, attributes, inside)
        most = dropped and 2 * (before[min(ends.get(k, len(tokens)), len(tokens))] - before[k + 1]) > before[-1]
        if most and tag == "form":  # it wraps the page; what is no text in it goes by its own tag
            dropped = False
        if tag in _CONTAINERS and not dropped:
            if not closing:
                opened += 1
                stack.append((tag, opened))
                open_tags[tag] += 1
            while closing and open_tags[tag]:
                last = stack.pop()[0]
                open_tags[last] -= 1
                if last == tag:
                    break
        if tag in _BLOCKS:
            links = 0
            lines.append(_Line(container=stack[-1][1]))
        elif tag == "br":
            text(" ")
        elif tag == "a":
            links = 0 if closing else 1
        if dropped:
            stop, ended = ends.get(k, len(tokens)), k in own
            soft = tag == "p" or (not ended and tag in ("li", "span", "a", "b", "i", "em", "strong"))
            leaves = _HOLDERS if not ended or tag == "form" else () if tag in _DROPPED else ("main",)
            if most and not ended:  # its end tag was left out: it ends where text begins
                leaves = _TEXT_STARTS
            lines.append(_Line(container=stack[-1][1]))
        elif tag == "main" or k in holders:
            inside = max(0, inside - 1) if closing else inside + 1
    text(page[at:])
    out = []
    for line in lines:
        whole = " ".join("".join(line.parts).split())
        if whole:
            out.append((whole, max(0, len(whole) - 2 * line.linked), line.held, line.container))
    return out


def _regions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """First and last line of each region: no ``WINDOW`` lines in a row are empty in it, nor is its first or last."""
    first = last = None
    for k, size in enumerate(sizes):
        if size:
            if first is not None and k - last > WINDOW:
                yield first, last
                first = None
            first, last = k if first is None else first, k
    if first is not None:
        yield first, last


def main_text(page: str | None) -> str:
    """The lines of a page between surges and dives, joined by empty lines.

    A window surges at ``SURGE`` characters outside links, or at half of the
    page's greatest window where that is less, and dives when it holds none. A
    region without a surge, and lines of links between two kept regions, stay
    if they lie in the container of kept lines.

    An article or main element is a weight: text in links counts in it, so that
    nothing in it is a dive, and half of its own greatest window is a surge. If
    a page has one with text, a surge outside takes twice ``SURGE``.
    """
    if not page:
        return ""
    lines = page_lines(page)
    weighted = any(held for _, _, held, _ in lines)
    regions, low = [], 0
    for held, group in groupby(lines, key=lambda line: line[2]):
        sizes = [len(whole) if held else n for whole, n, _, _ in group]
        sums = [sum(sizes[k : k + WINDOW]) for k in range(len(sizes))]
        surge = 2 * SURGE if weighted and not held else max(1, min(SURGE, max(sums) / 2))
        regions += [(low + a, low + b, max(sums[a : b + 1]) >= surge) for a, b in _regions(sizes)]
        low += len(sizes)
    containers = [c for *_, c in lines]
    own = {c for a, b, surge in regions if surge for c in containers[a : b + 1]}
    kept: list[int] = []
    for a, b, surge in regions:
        if surge or not own.isdisjoint(containers[a : b + 1]):
            kept += [k for k in range(kept[-1] + 1, a) if containers[k] in own] if kept else []
            kept += range(a, b + 1)
    return "\n\n".join(lines[k][0] for k in kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``; a NULL page gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [main_text(x.as_py()) for x in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(x) for x in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
