"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks
on their own: by the container they stand in, link density, stop-word density
and length. Blocks that are too short or too plain to decide stay ambiguous;
the second pass gives each the label of its nearest decided neighbours in the
same container. Pages are independent, so this is one narrow stage.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstats.llm.tables import fresh, text_column

# Common function words of the languages of the pages.
STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their there they
this to was we were which who will with would you
au aux avec ce ces cette dans de des du elle en et est il ils je la le les leur mais ne nous ou par pas pour qui que sa se
ses son sont sur un une vous
aber als am an auch auf aus bei bin bis das dem den der des die ein eine einem einen einer er es für hat ich im ist mit nach
nicht noch nur oder sich sie sind so um und von vor war wie wir zu zum zur über
al como con de del el ella en entre era es esta este fue ha la las lo los más me mi no nos o para pero por que se sin sobre
son su sus un una y ya
""".split())

#: Elements whose content is never main text.
DROPPED = frozenset("head title script style noscript template svg math iframe object canvas audio video map nav footer "
                    "aside form fieldset select option datalist textarea button input label menu dialog".split())
#: Their content is not markup; it ends at their own end tag only.
RAW = frozenset("script style textarea title noscript iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Containers of the article; outside them a block needs better grounds.
MAIN = frozenset("article main".split())
#: Words in class, id or role (split at anything but letters) that mark what surrounds an article.
MARKS = frozenset("ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie "
                  "cookies copyright disclaimer disqus footer gdpr hidden menu modal nav navbar navigation newsletter notice "
                  "notices notification pager pagination popup promo promoted promotion related replies reply respond share "
                  "sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split())

#: Words in class or id that mark the article on pages without an element of ``MAIN``.
MAIN_MARKS = frozenset("article content entry main post story".split())

SHORT = 70
LONG = 200
STOP_LOW, STOP_HIGH = 0.15, 0.30
LINK_HIGH = 0.4

_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_OPEN = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_REST = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
#: Every attribute with its whole value, so that no name is found inside another's value.
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_HAS_MAIN = re.compile(r"<(?:article|main)[\s>]", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_WORDS = re.compile(r"\w+")


class _Tags:
    """The tags of a page, in time proportional to its length.

    A tag ends at the first ``>`` outside quotes. A tag whose quote is never closed ends at its first ``>``, and from there on
    quotes mean nothing on that page; a ``<`` with no ``>`` after it is text.
    """

    def __init__(self, page: str):
        self.page, self.quotes, self.last = page, True, page.rfind(">")

    def next(self, at: int):
        """(start, end, is end tag, name, attributes) of the first tag from ``at`` on; the name is None for comments and the like."""
        page = self.page
        while (i := page.find("<", at)) >= 0:
            if page.startswith(("<!", "<?"), i):
                return i, _OTHER.match(page, i).end(), False, None, ""
            m = _OPEN.match(page, i) if i < self.last else None
            if m is None:
                at = i + 1
                continue
            rest = _REST.match(page, m.end()) if self.quotes else None
            if rest is not None:
                return i, rest.end(), bool(m.group(1)), m.group(2).lower(), rest.group(1)
            self.quotes = False
            end = page.index(">", m.end())
            return i, end + 1, bool(m.group(1)), m.group(2).lower(), page[m.end():end]
        return None


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    container: int
    main: bool
    label: str = ""


def _is_hidden(attributes: str) -> bool:
    for name, value in _ATTR.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _is_marked(attributes: str, by_id: bool) -> bool:
    return any((name.lower() in ("class", "role") or (by_id and name.lower() == "id"))
               and not MARKS.isdisjoint(_SPLIT.split(value.strip("\"'").lower())) for name, value in _ATTR.findall(attributes))


def _names_main(attributes: str) -> bool:
    return any(name.lower() in ("class", "id", "role") and not MAIN_MARKS.isdisjoint(_SPLIT.split(value.strip("\"'").lower()))
               for name, value in _ATTR.findall(attributes))


def _wrappers(page: str) -> set[int]:
    """Starts of the tags of elements that a mark does not drop: those that hold the first main element (or article, if there
    is no main), and on pages without either those that hold most of the text that is good on its own."""
    first: dict[str, set[int]] = {}
    stack: list[tuple[str, int, int]] = []  # name, start, good characters before it
    opened: Counter[str] = Counter()
    held: dict[int, int] = {}  # characters of good text
    whole, at, n, shut = 0, 0, len(page), 0  # shut: open links and dropped elements
    no_main = _HAS_MAIN.search(page) is None
    tags = _Tags(page)

    def leave(k):
        nonlocal shut
        for name, start, before in stack[k:]:
            opened[name] -= 1
            shut -= name == "a" or name in DROPPED
            held[start] = whole - before
        del stack[k:]

    while (tag := tags.next(at)) is not None:
        start, end, closing, name, attributes = tag
        text = page[at:start]
        at = end
        if no_main and len(text) >= SHORT and not shut:
            if label_alone(Block(" ".join(text.split()), 0, False, 0, False)) == "good":
                whole += len(text)
        if not name or name in VOID:
            continue
        if closing:
            if opened[name]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
        elif name in RAW:
            stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = stop.end() if stop else n
        else:
            if name in MAIN and name not in first:
                first[name] = {s[1] for s in stack}
            if not attributes.endswith("/") or name in MAIN:
                stack.append((name, start, whole))
                opened[name] += 1
                shut += name == "a" or name in DROPPED
    leave(0)
    return first.get("main", first.get("article", {start for start, size in held.items() if size and 2 * size > whole}))


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page outside dropped elements, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # name, dropped, container
    parts: list[str] = []
    opened: Counter[str] = Counter()
    linked = 0
    containers = 0
    heading = False
    tags = _Tags(page)

    def close_block():
        nonlocal linked, heading
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                inside = stack[-1][2] if stack else 0
                out.append(Block(text, linked, heading, inside, inside > 0))
            parts.clear()
        linked = 0

    def take(raw):
        nonlocal linked
        if not raw or (stack and stack[-1][1]):
            return
        text = entities.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if opened["a"]:
            linked += len("".join(text.split()))

    def leave(k):  # end the element at stack[k] and all inside it
        nonlocal heading
        if any(s[0] not in INLINE for s in stack[k:]):
            close_block()
        for s in stack[k:]:
            opened[s[0]] -= 1
        del stack[k:]
        heading = any(opened[h] for h in HEADINGS)

    has_main = _HAS_MAIN.search(page) is not None
    wrappers = _wrappers(page)
    at, n = 0, len(page)
    while at < n:
        tag = tags.next(at)
        if tag is None:
            take(page[at:])
            break
        start, end, closing, name, attributes = tag
        take(page[at:start])
        at = end
        if name is None:
            if page.startswith("<![CDATA[", start):
                take(page[start + 9:end].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if closing:
            if opened[name]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if name == "br":
            take(" ")
            continue
        if name not in INLINE:
            if name in ("p", *HEADINGS, "div", "ul", "ol", "table", "section", "article", "footer", "nav", "aside", "form",
                        "blockquote", "pre", "header", "main") and opened["p"]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"))
            elif name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                leave(len(stack) - 1)
            close_block()
        if name in VOID:
            continue
        dropped, container = (stack[-1][1], stack[-1][2]) if stack else (False, 0)
        marks_main = name in MAIN or (not has_main and name in ("div", "section", "td") and _names_main(attributes))
        if marks_main and container == 0 and not dropped:
            containers += 1
            container = containers
        dropped = (dropped or name in DROPPED or (name == "header" and container == 0)
                   or (name not in ("html", "body") and name not in MAIN and (_is_hidden(attributes) or (
                       start not in wrappers and _is_marked(attributes, name not in HEADINGS and name not in INLINE)))))
        if name in RAW:
            stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = stop.end() if stop else n
            continue
        if not attributes.endswith("/") or name in MAIN:
            stack.append((name, dropped, container))
            opened[name] += 1
            heading = heading or name in HEADINGS
    close_block()
    return out


def _stop_words(text: str) -> tuple[int, int]:
    """(stop words, words) of a text."""
    words = _WORDS.findall(text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def label_alone(b: Block, foreign: bool = False) -> str:
    """First pass: "good", "bad", or "" for a block that cannot be decided on its own. ``foreign``: the page has few stop words
    throughout, so they say nothing; length and links decide."""
    letters = len(b.text.replace(" ", ""))
    links = b.linked / letters if letters else 0.0
    if links > LINK_HIGH:
        return "bad"
    if b.heading:
        return ""
    if len(b.text) < SHORT:
        return "bad" if links > 0 and not b.main else ""
    stops, words = _stop_words(b.text)
    density = stops / words if words else 0.0
    if density >= STOP_HIGH:
        return "good"
    if density >= STOP_LOW:
        return "good" if len(b.text) >= LONG else ""
    if foreign:
        return "good" if links <= LINK_HIGH / 2 else ""
    return "" if b.main else "bad"


def label_all(blocks: list[Block]) -> None:
    """Both passes. A block without decided neighbours in its container is kept in an article, and elsewhere only if nothing
    on the page is decided."""
    counts = [_stop_words(b.text) for b in blocks if len(b.text) >= SHORT and not b.heading
              and b.linked <= LINK_HIGH * len(b.text.replace(" ", ""))]
    foreign = sum(k for k, _ in counts) < STOP_LOW * sum(n for _, n in counts)
    for b in blocks:
        b.label = label_alone(b, foreign)
    any_decided = any(b.label for b in blocks)
    groups: dict[int, list[Block]] = {}
    for b in blocks:
        groups.setdefault(b.container, []).append(b)
    has_main = any(k > 0 for k in groups)
    for k, group in groups.items():
        before, last = [], ""
        for b in group:
            before.append(last)
            last = b.label or last
        after, last = [], ""
        for b in reversed(group):
            after.append(last)
            last = b.label or last
        after.reverse()
        for b, left, right in zip(group, before, after):
            if b.label:
                continue
            if k > 0:
                b.label = "good" if "good" in (left, right) or not (left or right) else "bad"
            elif has_main:
                b.label = "bad"
            elif b.heading:
                b.label = right or left or ("bad" if any_decided else "good")
            elif left or right:
                b.label = "good" if (left or right) == "good" and (right or left) == "good" else "bad"
            else:
                b.label = "good"
        if k == 0 and has_main:  # a page that names its article has nothing of it outside
            for b in group:
                b.label = "bad"


def main_text(page: str | None) -> str:
    """The main text of a page: its good blocks, one per line."""
    blocks = blocks_of(page or "")
    label_all(blocks)
    return "\n".join(b.text for b in blocks if b.label == "good")


def extract_main_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``: the main text of each whole page, "" if it has none (null and empty pages too).

    ``html`` is dropped; every other column stays, also one that has the name of a helper column.
    A column called ``out`` in ``pages`` is replaced.
    """
    (h,) = fresh(pages, "html_whole")
    kept = [c for c in pages.columns if c != html and c != out]
    plain = pages.select(*[F.col(f"`{c}`") for c in kept], text_column(html).alias(h))
    schema = plain.drop(h).schema.add(out, "string")

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                text = pa.array([main_text(x) for x in part.column(len(kept)).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:len(kept)], text], names=[*kept, out])

    return plain.mapInArrow(run, schema)
