"""Main text of HTML pages by maximum-scoring subsequence.

A page is a sequence of words and tags. A word scores by where it stands (paragraph, heading, list, link, ...), a tag
scores below zero; the weights are log-odds counted on labelled pages, those that mark their own article with
``<article>`` or ``<main>``. Such a mark is evidence for the page that bears it: words in it score at least ``MARKED``, tags
cost next to nothing there. One linear scan finds the contiguous region of the largest sum. The region is widened
to whole blocks and to a heading right before it; if most of its words are marked, the others go.

What is no article by its element or name (menus, adverts, forms, comments, ...) scores nothing and is left out, unless
it holds nearly all the prose of the page: a page wrapped in a form, or with a menu that is never closed, has its article
in there. Comments are never taken for the article.

Labelled pages: at most ``LABELLED`` pages, the first by a hash of the page_id. Counts start from ``PRIOR``, so a
table without labelled pages works too.

Defined cases: null or empty html, and pages without a region, give an empty text; markup that is cut off or
not closed is read as far as it goes (a script or style until the next block of text begins); an article ends menus that
are still open; a null or repeated page_id is extracted row by row. Time is linear in the length of a page.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED = 1_000
# Least score of a word and cost of a tag that stand inside a marked article.
MARKED, MARKED_TAG = 0.5, -0.02
# An element that is no article by name holds this many times the prose outside it: then it holds the article.
WRAPS = 4

_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

_RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html",
    "legend", "li", "main", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "tfoot",
    "thead", "tr", "ul",
}
# Elements that never hold the article, whatever surrounds them.
_OUTSIDE = {"nav", "footer", "aside", "form", "head", "menu", "button", "select", "dialog", "fieldset", "label"}
# Parts of class, id and role names that say the same.
_HINTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "byline", "comment",
    "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "discussion", "disqus", "footer",
    "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share",
    "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets",
}
# Never the article, however much of the page they hold.
_ANSWERS = {"comment", "comments", "discussion", "disqus", "replies", "reply", "respond"}
# Elements that end where an article begins inside them.
_ENDED = {"nav", "menu", "header", "select", "button", "label", "fieldset", "head"}
_ARTICLE_PARTS = {"article", "content", "entry", "post", "story", "title", "headline"}
_NOT_HERE = {"has", "with", "no", "without", "not"}

# Words and tags, inside and outside articles, that the counts start from.
PRIOR = {
    "word:paragraph": (400, 60), "word:heading": (60, 40), "word:item": (60, 30), "word:cell": (60, 40), "word:bare": (60, 50),
    "word:link": (20, 200),
    "tag:p": (60, 10), "tag:br": (20, 10), "tag:inline": (60, 20), "tag:heading": (10, 8), "tag:item": (20, 40), "tag:link": (20, 60),
    "tag:cell": (20, 30), "tag:group": (6, 30), "tag:outside": (1, 60), "tag:other": (5, 10),
}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_PARAGRAPHS = {"p", "blockquote", "pre", "figcaption"}
_ITEMS = {"li", "dd", "dt", "ul", "ol", "dl"}
_CELLS = {"td", "th", "tr", "table", "tbody", "thead", "tfoot", "caption"}
_GROUPS = {"div", "section", "article", "main", "header", "body", "html", "center", "figure", "details", "summary", "address"}
_INLINE = {"b", "i", "em", "strong", "span", "u", "small", "sub", "sup", "code", "q", "cite", "abbr", "time", "mark", "font"}

_WORD_KIND = (
    {t: "word:paragraph" for t in _PARAGRAPHS} | {t: "word:heading" for t in _HEADINGS} | {t: "word:item" for t in _ITEMS}
    | {t: "word:cell" for t in _CELLS} | {t: "word:bare" for t in _GROUPS}
)
_TAG_KIND = (
    {t: "tag:group" for t in _GROUPS} | {t: "tag:cell" for t in _CELLS} | {t: "tag:item" for t in _ITEMS} | {t: "tag:inline" for t in _INLINE}
    | {t: "tag:heading" for t in _HEADINGS} | {t: "tag:p" for t in _PARAGRAPHS} | {t: "tag:outside" for t in _OUTSIDE}
    | {"br": "tag:br", "a": "tag:link"}
)


def _is_outside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _OUTSIDE or tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "article", "main") or not attributes.strip():
        return False
    for match in _ATTRIBUTE.finditer(attributes):
        name, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if name in ("class", "id", "role"):
            for word in value.split():
                parts = [part.lower() for part in _PART.findall(word)]
                hints = _HINTS.intersection(parts)
                if hints and not _NOT_HERE.intersection(parts):
                    if hints <= {"header", "banner", "byline"} and (in_article or _ARTICLE_PARTS.intersection(parts)):
                        continue
                    return True
    return False


def _is_answer(attributes: str) -> bool:
    names = (m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() in ("class", "id", "role"))
    return any(_ANSWERS.intersection(part.lower() for part in _PART.findall(name)) for name in names)


class Piece:
    """A run of text or a tag of a page, in order."""

    __slots__ = ("kind", "text", "count", "block", "outside", "labelled")

    def __init__(self, kind: str, text: str, count: int, block: int, outside: bool, labelled: bool):
        self.kind, self.text, self.count, self.block, self.outside, self.labelled = kind, text, count, block, outside, labelled


_TEXT_BLOCK = re.compile(r"<(?:p|h[1-6]|article|main|section|div|body|ul|ol|table|blockquote)\b", re.I)


def pieces(html: str) -> list[Piece]:
    """The page as pieces; text knows its block, whether it is outside any article, and whether markup labels it."""
    reader = _Reader(html, frozenset())
    wrapping = reader.wrapping()
    return _Reader(html, wrapping).found if wrapping else reader.found


class _Reader:
    """Reads a page once. ``allowed`` are elements, by the place of their tag, that count as any other."""

    def __init__(self, html: str, allowed: frozenset[int]):
        self.html, self.allowed = html, allowed
        self.found: list[Piece] = []
        # Tag, outside, labelled, kind of its words, and the outside element it opens.
        self.stack: list[tuple[str, bool, bool, str, list | None]] = []
        self.open: Counter = Counter()
        self.outside = self.labelled = self.links = self.block = 0
        # Words of prose before here, and [place of the tag, prose before, prose up to its end, may hold the article].
        self.prose = 0
        self.outsiders: list[list] = []
        self._read()
        self._leave(0)

    def wrapping(self) -> frozenset[int]:
        """Elements that are outside by name and hold ``WRAPS`` times the prose that stands elsewhere."""
        return frozenset(
            place for place, before, after, may in self.outsiders if may and after - before > WRAPS * (self.prose - (after - before))
        )

    def _text(self, start: int, end: int) -> None:
        run = self.html[start:end]
        if not run:
            return
        count = len(run.split())
        kind = "word:link" if self.links else self.stack[-1][3] if self.stack else "word:bare"
        if kind in ("word:paragraph", "word:heading", "word:item", "word:bare"):
            self.prose += count
        if self.outside:
            kind = "nothing"
        self.found.append(Piece(kind, run, count, self.block, self.outside > 0, self.labelled > 0))

    def _leave(self, index: int) -> None:
        for tag, out, label, _, outsider in self.stack[index:]:
            self.outside -= out
            self.labelled -= label
            self.links -= tag == "a"
            self.open[tag] -= 1
            if outsider is not None:
                outsider[2] = self.prose
        del self.stack[index:]

    def _enter(self, tag: str, attributes: str, place: int) -> bool:
        """Opens an element; whether it is the outermost one that is no article."""
        label = tag in ("article", "main") or "articlebody" in attributes.lower()
        if tag in BLOCKS:
            # Paragraphs, items and headings end where a block begins inside them.
            while self.stack and (self.stack[-1][0] == "p" or self.stack[-1][0] == tag and tag in ("li", "dt", "dd", "option")):
                self._leave(len(self.stack) - 1)
        if label and self.outside:
            ended = next((i for i, entry in enumerate(self.stack) if entry[1]), None)
            if ended is not None and self.stack[ended][0] in _ENDED:
                self._leave(ended)
        outsider, own = None, _is_outside(tag, attributes, self.labelled > 0)
        if own:
            outsider = [place, self.prose, self.prose, not _is_answer(attributes)]
            self.outsiders.append(outsider)
            own = place not in self.allowed
        kind = _WORD_KIND.get(tag) or (self.stack[-1][3] if self.stack else "word:bare")
        self.stack.append((tag, own, label, kind, outsider))
        self.open[tag] += 1
        self.outside += own
        self.labelled += label
        self.links += tag == "a"
        return own and self.outside == 1

    def _read(self) -> None:
        html, at, length = self.html, 0, len(self.html)
        unclosed: set[str] = set()
        while at < length:
            start = html.find("<", at)
            if start < 0:
                self._text(at, length)
                break
            match = _MARKUP.match(html, start)
            if not match:
                # A bare less-than sign is text.
                self._text(at, start + 1)
                at = start + 1
                continue
            self._text(at, start)
            at = match.end()
            if match[2] is None:
                continue
            tag, closing = match[2].lower(), match[1] == "/"
            if tag in _RAW and not closing:
                if not match[3].endswith("/"):
                    end = None if tag in unclosed else re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I).search(html, at)
                    if end:
                        at = end.end()
                    else:
                        # Never closed from here on: code ends where text begins, other elements are ignored.
                        unclosed.add(tag)
                        if tag in ("script", "style"):
                            begins = _TEXT_BLOCK.search(html, at)
                            at = begins.start() if begins else length
                continue
            if tag in BLOCKS:
                self.block += 1
            entered = False
            if closing:
                if self.open[tag]:
                    self._leave(next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag))
            elif tag not in _VOID:
                entered = self._enter(tag, match[3], start)
            # An element that is no article costs one tag, whatever it holds; its words are left out anyway.
            kind = "tag:outside" if entered else "nothing" if self.outside else _TAG_KIND.get(tag, "tag:other")
            self.found.append(Piece(kind, "", 1, self.block, self.outside > 0, self.labelled > 0))
            if tag in BLOCKS:
                self.block += 1
            elif tag in ("br", "td", "th"):
                self.found.append(Piece("nothing", " ", 0, self.block, self.outside > 0, self.labelled > 0))


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Scores from how often each kind was seen inside and outside articles, on top of the prior counts."""
    scores = {"nothing": 0.0}
    for kind, (inside, beyond) in PRIOR.items():
        seen = counts.get(kind, (0, 0))
        odds = math.log((inside + seen[0]) / (beyond + seen[1]))
        # Tags always cost something.
        scores[kind] = max(-3.0, min(3.0, odds)) if kind.startswith("word") else max(-4.0, min(-0.2, odds))
    return scores


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum, the first of equal ones; empty if none is above 0."""
    best, region = 0.0, (0, 0)
    total, start = 0.0, 0
    for index, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, index
        total += score
        if total > best:
            best, region = total, (start, index + 1)
    return region


def _score(piece: Piece, scores: dict[str, float]) -> float:
    score = scores[piece.kind]
    if piece.labelled and piece.kind != "nothing":
        score = max(score, MARKED if piece.kind.startswith("word") else MARKED_TAG)
    return score * piece.count


def _with_heading(found: list[Piece], start: int) -> int:
    """The start of a heading that stands right before a region, with nothing but tags between, else the region's."""
    at = start
    for index in range(start - 1, -1, -1):
        piece = found[index]
        if piece.outside or not piece.text.strip():
            continue
        if piece.kind != "word:heading":
            break
        at = index
    return at


def main_text(html: str | None, scores: dict[str, float]) -> str:
    if not html:
        return ""
    found = pieces(html)
    start, end = best_region([_score(p, scores) for p in found])
    if start == end:
        return ""
    start = _with_heading(found, start)
    first, last = found[start].block, found[end - 1].block
    inside = [p for p in found if first <= p.block <= last and p.text and not p.outside]
    marked = sum(p.count for p in inside if p.labelled)
    if 2 * marked > sum(p.count for p in inside):
        inside = [p for p in inside if p.labelled]
    blocks: dict[int, list[str]] = {}
    for piece in inside:
        blocks.setdefault(piece.block, []).append(piece.text)
    joined = (" ".join(references.unescape("".join(runs)).split()) for runs in blocks.values())
    return "\n\n".join(text for text in joined if text)


def label_counts(pages: DataFrame) -> dict[str, tuple[int, int]]:
    """How often each kind of piece stands inside and outside the marked articles of the labelled pages."""
    chosen = pages.select("page_id").where("page_id is not null").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(LABELLED)
    # At most LABELLED ids by construction.
    sample = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(1):
                found = pieces(page.as_py() or "")
                if any(p.labelled for p in found):
                    for piece in found:
                        counts[piece.kind, piece.labelled and not piece.outside] += piece.count
        rows = [(kind, inside, n) for (kind, inside), n in counts.items()]
        columns = list(zip(*rows)) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.bool_(), pa.int64()))], ["kind", "inside", "n"]
        )

    rows = sample.mapInArrow(run, "kind string, inside boolean, n bigint").groupBy("kind").agg(
        F.expr("sum(if(inside, n, 0))"), F.expr("sum(if(inside, 0, n))")
    )
    return {r[0]: (r[1], r[2]) for r in rows.collect()}  # one row for each kind of piece


EXTRACTED = "page_id bigint, url string, text string, n_chars bigint"


def extract(pages: DataFrame, scores: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``; one pass, no shuffle."""
    scores = scores or weights(label_counts(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), scores) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, EXTRACTED)
