"""Main text of web pages: the contiguous region of greatest score.

A page is a sequence of tokens, words and tags. A word scores by where it stands (its block element, whether it is
part of a link) and a tag by its name; tags never score above zero. Menus, adverts and other frame parts are holes that
cost one pair of tags. What only may be a frame part, such as a form, a header or an alert, is a hole if links make up half
of its words; else its words have a weight of their own and stay where content surrounds them. An element that holds most
of the page's words outside of links, such as a form around the page, is no frame part. The weights are log odds of content against the rest, counted over all labelled pages: those that
mark their content with exactly one ``article`` or ``main`` element. A linear scan finds the run of tokens with the greatest sum, on every page alike; frame parts
inside that run are left out. Words of one text run score alike, so runs are scanned whole.

Text: character references are decoded, white space inside a block becomes one blank, blocks are trimmed and joined by
a line feed. ``br`` is white space. Script, style, other raw elements and comments are never text.

Defined results: a null or empty page, or one without a region of positive score, has the empty text; of runs with
equal sums the first and shortest counts; a tag cut off by the end of the page is dropped; without labelled pages the
prior counts alone give the weights. Only the named columns are read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowlab.llm.tables import batch_of

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript noframes noembed xmp template svg math".split())
#: Only these can be closed by a slash.
FOREIGN = frozenset(("svg", "math"))
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
#: Never content, however much they hold.
FRAME = frozenset("nav footer aside menu select head".split())
#: Frame parts unless they hold most of the page.
LIKELY = frozenset("button dialog".split())
#: These may be either.
DOUBTFUL = frozenset("form fieldset header".split())
CONTENT = frozenset(("article", "main"))
#: A new one ends an open one of the same group.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Words in class, id or role that mark frame parts.
FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored comment comments respond "
    "disqus sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent "
    "popup modal newsletter subscribe login signup toolbar pagination complementary contentinfo".split()
)
#: Words that mark blocks of articles, too.
DOUBTFUL_WORDS = frozenset("notice alert related share sharing social widget search subscription".split())
#: A name that holds one of these tells of a state of the page, as in "has-sidebar", "promo-free" or "comments-enabled".
STATE_WORDS = frozenset("has no not with without free enabled disabled allowed open closed".split())
#: A name that ends in one of these names a text, as in "modal-article".
TEXT_WORDS = frozenset("article story post entry".split())
#: Readers may write more than the author: such parts must hold nearly the whole page to be no frame part.
COMMENT_WORDS = frozenset("comment comments respond disqus".split())
MOST, NEARLY_ALL = 0.5, 0.9

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|$)", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s\"'>]++)))?")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Prior counts in and out of the content: a plain word speaks for it; links, tags and the edges of frame parts do not.
PRIOR = {"word": (8.0, 2.0), "link": (2.0, 4.0), "doubt": (2.0, 4.0), "tag": (2.0, 4.0), "edge": (0.5, 8.0)}
#: Tags never speak for content, however common they are inside of it.
TAG_CEILING = -0.1
#: What stands inside of a content element can be parted by adverts and the like, which labelled pages may not show.
EDGE_FLOOR = -1.0


@dataclass
class Token:
    kind: str
    words: int
    text: str  # decoded, for text runs
    frame: bool  # strictly inside of a frame part
    content: bool
    breaks: bool  # ends a block


class Part:
    """An element that may be a frame part, inside of another or of none. What it is shows at the end of the page."""

    __slots__ = ("outer", "share", "frame", "doubt", "content", "words", "links")

    def __init__(self, outer: Part | None, frame: bool, share: float | None, content: bool) -> None:
        self.outer, self.frame, self.doubt, self.share, self.content = outer, frame, not frame, share, content
        self.words = self.links = 0


def telling(name: str) -> list[str]:
    """The words of one class, id or role; none if it names a state of the page or a text."""
    parts = [p.lower() for p in NAME_PARTS.findall(name)]
    return [] if not STATE_WORDS.isdisjoint(parts) or parts and parts[-1] in TEXT_WORDS else parts


def frame_part(name: str, attributes: str, content: bool) -> tuple[bool, float | None] | None:
    """None for what is none, as the header of an article; else whether it is sure, and the share of the page's words from which on it is not."""
    if name in FRAME:
        return True, None
    if name in ("html", "body"):
        return None
    words: set[str] = set()
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.strip().lower() == "true" or key == "style" and NOT_SHOWN.search(value):
            return True, None
        if key in ("class", "id", "role"):
            words.update(*map(telling, value.split()))
    if words & COMMENT_WORDS:
        return True, NEARLY_ALL
    if name in LIKELY or words & FRAME_WORDS:
        return True, MOST
    if name in DOUBTFUL and not (name == "header" and content) or words & DOUBTFUL_WORDS:
        return False, MOST
    return None


def judged(parts: list[Part], words: int) -> None:
    """Settles what each part is; the outer ones come first in ``parts``."""
    for part in reversed(parts):
        if part.outer:
            part.outer.words += part.words
            part.outer.links += part.links
    for part in parts:
        if part.share is not None and part.words > part.share * words:
            part.frame = part.doubt = False
        elif part.doubt and part.links and part.links >= part.words:
            part.frame = True
        if part.outer:
            part.content |= part.outer.content
            part.frame |= part.outer.frame
            part.doubt |= part.outer.doubt
        part.content &= not part.frame


def tokens(page: str) -> list[Token]:
    """Tags and text runs of a page with their place among the open elements."""
    # Open elements: name, part it is or stands in, inside of content, nearest block, inside of a link.
    stack: list[tuple[str, Part | None, bool, str, bool]] = [("", None, False, "", False)]
    found: list[Token] = []
    # For each token the part it is an edge of, those it stands in before and after it, and whether in content.
    places: list[tuple[Part | None, Part | None, Part | None, bool, bool]] = []
    parts: list[Part] = []
    total = at = 0
    opened: Counter = Counter()  # open elements by name

    def close(k: int) -> None:
        opened.subtract(name for name, *_ in stack[k:])
        del stack[k:]

    def run(text: str) -> None:
        nonlocal total
        if text:
            text = html.unescape(text)
            _, part, content, block, link = stack[-1]
            words = len(text.split())
            if part and link:
                part.links += words
            elif part:
                part.words += words
            total += 0 if link else words
            found.append(Token(f"{'link' if link else 'word'}:{block}", words, text, False, False, False))
            places.append((part, part, part, content, content))

    while at < len(page):
        m = TOKEN.search(page, at)
        if m is None:
            run(page[at:])
            break
        run(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        _, part, content, block, link = stack[-1]
        known = name if name in BLOCK or name in VOID or name in RAW else "inline"
        tag = Token(f"tag:{'/' if closing else ''}{known}", 0, "", False, False, name in BLOCK)
        found.append(tag)
        if closing:
            # An end tag that ends nothing is no reason to look through all that is open.
            for k in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if stack[k][0] == name:
                    close(k)
                    break
            # The tag that ends the content belongs to what is around it.
            places.append((part, part, stack[-1][1], content, stack[-1][2]))
            continue
        for other in CLOSES.get(name, ()):
            if stack[-1][0] == other:
                close(len(stack) - 1)
        _, part, content, block, link = stack[-1]
        what = frame_part(name, m[3], content)
        if name in CONTENT and not what and not content:
            part = None  # content inside of a frame part, such as a form around the whole page
        own = part
        if what:
            own = Part(part, *what, content or name in CONTENT)
            parts.append(own)
        places.append((own, part, part, content, content))
        if name == "br":
            found.append(Token("tag:br", 0, " ", False, False, False))
            places.append((None, part, part, content, content))
        if name in RAW and not (name in FOREIGN and m[3].endswith("/")):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)", re.I).search(page, at)
            at = end.start() if end else len(page)
            if end:
                stop = page.find(">", at)
                at = stop + 1 if stop >= 0 else len(page)
        elif name not in VOID and name not in RAW and not m[3].endswith("/"):
            opened[name] += 1
            stack.append((
                name, own, (content or name in CONTENT) and not what, name if name in BLOCK else block, link or name == "a"
            ))
    judged(parts, total)
    for token, (edge, before, after, was, now) in zip(found, places):
        token.frame = bool(after and after.frame)
        # Inside of a part it is the part that says whether it is content.
        token.content = bool((was or before and before.content) and (now or after and after.content))
        if token.kind.startswith("tag:"):
            if edge and edge.frame:
                token.kind = f"edge{token.kind[3:]}"
        elif after and after.doubt and token.kind.startswith("word:"):
            token.kind = f"doubt{token.kind[4:]}"
    return found


def counts(page: str) -> Counter:
    """``(kind, in content)`` counts of a labelled page, empty for others."""
    found: Counter = Counter()
    opened = 0
    for t in tokens(page):
        opened += t.kind in ("tag:article", "tag:main")
        if not t.frame:
            found[t.kind, t.content] += t.words or (not t.text)
    return found if opened == 1 else Counter()


def log_odds(table: dict[tuple[str, bool], float]) -> dict[str, float]:
    """The weight of each kind; the kinds of ``PRIOR`` hold for what was not seen."""
    prior_in, prior_out = (sum(p[k] for p in PRIOR.values()) for k in (0, 1))
    total_in = prior_in + sum(n for (_, c), n in table.items() if c)
    total_out = prior_out + sum(n for (_, c), n in table.items() if not c)
    weights = {k: math.log(a / prior_in) - math.log(b / prior_out) for k, (a, b) in PRIOR.items()}
    for kind in sorted({k for k, _ in table}):
        a, b = PRIOR[kind.partition(":")[0]]
        weights[kind] = (
            math.log((table.get((kind, True), 0) + a) / total_in) - math.log((table.get((kind, False), 0) + b) / total_out)
        )
    for kind, w in weights.items():
        if kind.startswith("tag"):
            weights[kind] = min(w, TAG_CEILING)
        elif kind.startswith("edge"):
            weights[kind] = min(max(w, EDGE_FLOOR), TAG_CEILING)
    return weights


def weight(kind: str, weights: dict[str, float]) -> float:
    return weights.get(kind, weights[kind.partition(":")[0]])


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the run with the greatest positive sum; ``(0, 0)`` if there is none."""
    best, place, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, place = total, (start, i + 1)
    return place


def main_text(page: str | None, weights: dict[str, float]) -> str:
    found = list(tokens(page or ""))
    # Blank text scores nothing. A frame part is a hole that costs its two tags, whatever it holds.
    scores = [
        0.0 if t.frame or t.text and not t.words else (t.words or 1) * weight(t.kind, weights) for t in found
    ]
    start, stop = best_region(scores)
    blocks: list[list[str]] = [[]]
    for t in found[start:stop]:
        if t.breaks:
            blocks.append([])
        elif t.text and not t.frame:
            blocks[-1].append(t.text)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def learned_weights(pages: DataFrame, *, html_col: str = "html") -> dict[str, float]:
    """Weights from all labelled pages. The kinds are a fixed set of element names, so their table is small."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                total.update(counts(page))
        schema = pa.schema([("kind", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())])
        yield batch_of(schema, [k for k, _ in total], [c for _, c in total], list(total.values()))

    rows = pages.select(F.col(f"`{html_col}`").cast("string")).filter(F.col(html_col).isNotNull())
    table = rows.mapInArrow(count, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    return log_odds({(r.kind, r.inside): float(r.n) for r in table.collect()})


def extracted(pages: DataFrame, weights: dict[str, float], *, page_id: str = "page_id", url: str = "url", html_col: str = "html") -> DataFrame:
    """Per row ``page_id, url, text, n_chars``."""
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("body"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, weights) for p in batch.column(2).to_pylist()]
            schema = pa.schema([*list(batch.schema)[:2], ("text", pa.string()), ("n_chars", pa.int64())])
            yield batch_of(schema, *batch.columns[:2], texts, [len(t) for t in texts])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(extract, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
