"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block-level tags, in one pass over its
characters.  The first pass classifies blocks by stop-word density, length
and link density, wherever they stand; parts that are never the article are
left out, and within an article a block that its density doesn't settle is
not condemned for it.  The second gives short or doubtful blocks the label
of the nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LONG = 70                   # characters from which a block is decided by its words
VERY_LONG = 200             # from here on fewer stop words do
STOP_HIGH, STOP_LOW = 0.15, 0.05    # share of stop words of running text, and of no text at all
LINKS = 0.4                 # share of characters in links above which a block is a menu
LINKS_IN_ARTICLE = 0.7

# Frequent function words of English, German, French, Spanish, Italian, Portuguese and Dutch.
STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to
was were which will with you
aber als am auch auf aus bei das dem den der des die durch ein eine einem einen einer es für hat ich im in ist mit nach
nicht noch nur oder sein sich sie sind so über um und uns von vor war wie wir zu zum zur
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que
qui sa se ses son sont sur un une vous
al como con del el ella en entre era es esta este ha hay las lo los más me muy no para pero por que se ser si sin sobre su
sus también un una y ya
che di e gli i il nella non per più sono una
ao com da dos em mas na nos não os uma
dat een en het ik je maar met niet op van voor wat zijn
""".split())

RAW = frozenset("script style".split())         # run to the end of the page if nothing closes them
UNNESTED = frozenset("button select textarea iframe noscript".split())
SKIPPED = RAW | UNNESTED | frozenset("template svg math object canvas audio video".split())
CLOSED_OFF = frozenset("nav footer aside form head dialog menu".split())
ARTICLE = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = CLOSED_OFF | ARTICLE | frozenset("header section div ul ol table body html figure".split())
BLOCKS = CONTAINERS | HEADINGS | frozenset(
    "p li blockquote pre td th tr tbody thead tfoot dl dt dd address hr figcaption fieldset details summary title center".split())
# Words in class, id and role that mark what isn't the article.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|banner|promo|promotion|sponsor|sponsored|cookies?|consent|gdpr"
    r"|notice|alert|sidebar|side-bar|widget|comments?|commentlist|disqus|respond|replies|footer|foot|masthead|site-header|page-header"
    r"|nav|navbar|navigation|menu|breadcrumbs?|share|sharing|social|related|recommended|newsletter|subscribe|subscription|signup|login"
    r"|form|search|popup|modal|overlay|copyright|legal|disclaimer|pagination|pager|toolbar|skip|hidden|complementary|contentinfo"
    r"|banner|topbar|tags|byline|author-box)(?:$|[\s_-])")
NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9:-]*)")
SIGNS = re.compile(r"""=\s*["']|["'>]""")
OPENED_OR_CLOSED = {name: re.compile(rf"<(/?){name}\b", re.IGNORECASE) for name in SKIPPED}
MARK_ATTRS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""\bhidden(?=$|[\s=/])|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)


@dataclass
class Block:
    text: str
    link_chars: int
    heading: bool
    outside: bool           # within a part that is never the article
    article: int            # number of the article or main element around it, 0 for none
    label: str = ""         # good, bad or "" while undecided


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """(places, ends): a tag that begins after places[k - 1] and not after places[k] ends after the sign at ends[k] (-1: nowhere).

    That is the first > outside quoted values.  A quote opens a value only after an equals sign and only if the same quote
    follows; worked out from the last sign to the first, so any page takes one pass."""
    found = list(SIGNS.finditer(page))
    places = [m.end() - 1 for m in found]
    ends = [-1] * (len(found) + 1)
    later = {'"': -1, "'": -1}
    for k in range(len(found) - 1, -1, -1):
        sign = page[places[k]]
        if sign == ">":
            ends[k] = places[k]
        else:
            opens = found[k].end() - found[k].start() > 1 and later[sign] >= 0
            ends[k] = ends[later[sign] + 1] if opens else ends[k + 1]
            later[sign] = k
    return places, ends


def _tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of the page's tags; comments, declarations and skipped elements have no name."""
    places, ends = _tag_ends(page)
    unclosed: set[str] = set()
    last = page.rfind(">")
    at = page.find("<")
    while 0 <= at < last or page.startswith("<!--", at) and at >= 0:
        start = at
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            yield start, at, "", False, ""
        elif page.startswith(("<!", "<?"), start):
            at = page.find(">", start) + 1
            yield start, at, "", False, ""
        elif m := NAME.match(page, start + 1):
            end = ends[bisect_left(places, m.end())]
            if end < 0:         # only within quoted values: the next > if no tag begins before it
                end, other = page.find(">", m.end()), page.find("<", m.end())
                if 0 <= other < end:
                    at = other
                    continue
            at = end + 1
            name, closing, attrs = m[1].lower(), page[start + 1] == "/", page[m.end():end]
            if name in SKIPPED and not closing and not attrs.endswith("/") and name not in unclosed:
                close = _closing(page, name, at)
                if close is None:
                    unclosed.add(name)
                elif close >= 0:
                    at = close
            yield start, at, "" if name in SKIPPED else name, closing, attrs
        else:
            at += 1
        at = page.find("<", at)


def _closing(page: str, name: str, at: int) -> int | None:
    """Where a skipped element that begins before ``at`` ends.

    -1 if another begins before it, and None if none like it ends any more: it is then read as if its tag weren't there."""
    depth = 1
    for m in OPENED_OR_CLOSED[name].finditer(page, at):
        if m[1]:
            depth -= 1
        elif name in UNNESTED:
            return -1
        elif name not in RAW:
            depth += 1
        if not depth:
            end = page.find(">", m.end())
            return len(page) if end < 0 else end + 1
    return len(page) if name in RAW else None


def _marked(attrs: str) -> bool:
    if not attrs:
        return False
    if HIDDEN.search(attrs):
        return True
    return any(MARKED.search((m[1] or m[2] or m[3] or "").lower()) for m in MARK_ATTRS.finditer(attrs))


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, with decoded characters and single spaces."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []     # open containers: name, outside, article
    opened: Counter[str] = Counter()            # how many of each are open
    parts: list[tuple[str, bool]] = []
    links = breaks = articles = 0
    heading = ""
    apart = False           # the present block is marked as no part of the article

    def close():
        nonlocal breaks
        text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
        if text:
            in_links = sum(len("".join(html.unescape(t).split())) for t, linked in parts if linked)
            _, outside, article = stack[-1] if stack else ("", False, 0)
            out.append(Block(text, in_links, bool(heading), outside or apart or (opened["header"] > 0 and (not article or not heading)), article))
        parts.clear()
        breaks = 0

    at = 0
    for start, after, name, end, attrs in _tags(page):
        if start > at:
            parts.append((page[at:start], links > 0))
            if not page[at:start].isspace():
                breaks = 0
        at = after
        if not name:
            continue
        if name == "a":
            links = 0 if end else 1
        elif name == "br":
            breaks += 1
            parts.append((" ", False))
            if breaks > 1:
                close()
        elif name in BLOCKS:
            close()
            links = 0
            heading = name if name in HEADINGS and not end else ""
            apart = False
            if name == "body" and opened["head"]:
                stack[:] = [x for x in stack if x[0] != "head"]
                opened["head"] = 0
            if name in CONTAINERS:
                if end:
                    while opened[name]:
                        last = stack.pop()[0]
                        opened[last] -= 1
                        if last == name:
                            break
                elif not attrs.endswith("/"):
                    _, outside, article = stack[-1] if stack else ("", False, 0)
                    if name in ARTICLE and not article:
                        articles += 1
                        article = articles
                    stack.append((name, outside or name in CLOSED_OFF or (name not in ("body", "html") and _marked(attrs)), article))
                    opened[name] += 1
            else:
                apart = not end and _marked(attrs)
    if at < len(page):
        parts.append((page[at:], links > 0))
    close()
    return out


def _stop_share(text: str) -> float:
    words = [w.strip(".,;:!?\"'()[]*#$%&|<>«»“”…-").lower() for w in text.split()]
    return sum(w in STOP_WORDS for w in words) / len(words)


def decide(blocks: list[Block]) -> None:
    """First pass: labels of the blocks that their own figures decide.

    Where no block of a page is running text, in a language without known stop words say, their lack condemns none."""
    thin = []
    for b in blocks:
        linked = b.link_chars / max(1, len(b.text))
        if b.outside or b.text.startswith(("©", "Copyright ")) or linked > (LINKS_IN_ARTICLE if b.article else LINKS):
            b.label = "bad"
        elif b.heading or len(b.text) < LONG:
            b.label = ""
        else:
            share = _stop_share(b.text)
            good = share >= STOP_HIGH or (len(b.text) >= VERY_LONG and share >= STOP_LOW)
            b.label = "good" if good else "bad" if share < STOP_LOW and not b.article else ""
            if b.label == "bad":
                thin.append(b)
    if not any(b.label == "good" for b in blocks):
        for b in thin:
            b.label = ""
    if any(b.label == "good" and b.article for b in blocks):
        for b in blocks:
            if not b.article:
                b.label = "bad"


def inherit(blocks: list[Block]) -> None:
    """Second pass: undecided blocks take the label of the nearest decided neighbours; headings that of what follows.

    Inside an article only its own blocks count as neighbours, and without
    any that is decided the block is good.
    """
    decided = any(b.label and not b.outside for b in blocks)
    before, after = [-1] * len(blocks), [-1] * len(blocks)
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        before[i] = last.get(b.article, -1)
        if b.label and not b.outside:
            last[b.article] = i
    last.clear()
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        after[i] = last.get(b.article, -1)
        if b.label and not b.outside:
            last[b.article] = i
    labels = [b.label for b in blocks]
    for i, b in enumerate(blocks):
        if b.label:
            continue
        near = [j for j in (after[i], before[i]) if j >= 0]
        if not near:
            labels[i] = "good" if b.article or not decided else "bad"
        elif b.heading:
            labels[i] = blocks[near[0]].label
        else:
            labels[i] = blocks[min(near, key=lambda j: abs(j - i))].label
    for b, label in zip(blocks, labels, strict=True):
        b.label = label


def main_text(page: str | None) -> str:
    """The article of a page: its good blocks joined by an empty line, empty if there are none."""
    if not page:
        return ""
    blocks = blocks_of(page)
    decide(blocks)
    inherit(blocks)
    return "\n\n".join(b.text for b in blocks if b.label == "good")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    A null or empty page has an empty text, and so has one without an
    article.  Broken markup, open tags and cut character references are
    read as they stand.  Repeated rows and null ids are handled one by one;
    other columns are ignored; an empty table gives none.
    """
    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
