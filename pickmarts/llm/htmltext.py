"""Operator 6, HTML extraction by two-pass block rules.

A page is cut into blocks at block-level tags. Markup, scripts, styles, forms,
hidden elements and the containers that name themselves as navigation, header,
footer, sidebar, notice, advert or reader comments decide their blocks at once:
bad. The first pass classifies every other block by its link density, its length
and the share of stop words among its words: good, near good, short or bad. The
second pass gives the ambiguous ones (short, near good, or long without stop
words: tables, code, other languages) the label of the nearest decided
neighbours; without any they are good. Blocks of named boilerplate are nobody's
neighbours. Where a page marks its article (``article`` or ``main``), blocks
outside it are bad and neighbours count inside it only.

Text keeps character references decoded and white space inside a block as one
space; blocks are joined in page order by one space. Nothing is capped.

Defined cases: null or empty html gives empty text; html without tags is one
block, judged alone (good unless it is all links); unclosed and stray tags end
with the container they are in; repeated rows give repeated results; an empty
table gives an empty result; other columns are ignored or passed through.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pickmarts.llm.columns import drop_named
from pickmarts.llm.textwords import batches_by_bytes

# Frequent words of the languages the corpus holds.
STOP_WORDS = frozenset(
    """
    a about after all also an and any are as at be been but by can could do for from had has have he her his i if in
    into is it its more my no not of on one or our out she so some than that the their them there they this to up was
    we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem einen einer er es
    für hat ich ihr im in ist ja kann man mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war
    was wenn werden wie wir zu zum zur
    au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ou où par
    pas plus pour qu que qui sa se ses son sont sur tout un une vous y à été être
    al ante como con cual de del desde donde el ella en entre era es esta este está ha hasta hay la las le lo los me mi
    muy más ni no nos o para pero por porque que se ser si sin sobre son su sus también te tu un una uno y ya él
    """.split()
)
LINKS_MOST = 0.2  # more of a block's characters in links: bad
LINKS_MOST_ARTICLE = 0.5
SHORT = 70  # characters
LONG = 200
STOPS_SOME = 0.30
STOPS_MANY = 0.32

# Element names by role, and the words by which containers name themselves.
RAW_TEXT = ("script", "style", "noscript", "template", "iframe", "textarea", "svg", "math", "object", "canvas")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby s samp small span strike strong "
    "sub sup time tt u var img wbr label input".split()
)
BAD_TAGS = frozenset("head title nav footer aside form button select option menu dialog fieldset".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
BAD_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies copyright disclaimer disqus footer form header login masthead menu modal nav "
    "navbar navigation newsletter notice notices notification outbrain pager pagination popup promo promotion "
    "recommended related replies search share sharing sidebar signup skip social sponsor sponsored subscribe taboola "
    "teaser toolbar widget".split()
)
REGIONS = ("article", "main")

_OPEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_STOP = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    """Text of a block, how much of it is in links, and what its containers say."""

    text: str
    linked: int  # characters inside links
    bad: bool  # inside boilerplate
    article: bool  # inside the page's article
    label: str = field(default="")


def _named_bad(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in BAD_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or attributes.isspace():
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in BAD_ROLES:
            return True
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id") and tag not in ("html", "body", *REGIONS):
            # "sideBar", "side-bar" and "sidebar" name the same thing
            words = {w.lower() for w in _NAME.findall(value)}
            words |= {re.sub("[^a-z]", "", w.lower()) for w in value.split()}
            if in_article:
                words.discard("header")
            if words & BAD_NAMES:
                return True
    return False


class _Tags:
    """Finds the tags of a page.

    A ``>`` inside a quoted value does not end a tag. Where no other follows, quotes
    mean nothing and the first ``>`` ends it; a ``<`` without any is text. Linear: no
    quote is tried twice in vain.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self.vain: set[int] = set()  # quotes from which no end is found

    def after(self, at: int) -> tuple[int, int, str | None, str, str] | None:
        """(begin, end, slash, tag, attributes) of the next tag; slash is None for comments and declarations."""
        page = self.page
        m = _OPEN.search(page, at)
        if m is None or (m[2] is not None and m.end() > self.last[">"]):
            return None  # no tag ends any more
        if m[2] is None:
            return m.start(), m.end(), None, "", ""
        place, tried, end = m.end(), [], -1
        while (s := _STOP.search(page, place)) is not None and s.start() not in self.vain:
            if s[0] == ">":
                end = s.start()
                break
            tried.append(s.start())
            closed = page.find(s[0], s.end()) if s.start() < self.last[s[0]] else -1
            place = closed + 1 if closed >= 0 else s.end()
        if end < 0:
            self.vain.update(tried)
            end = page.find(">", m.end())
        return m.start(), end + 1, m[1], m[2].lower(), page[m.end() : end]


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, unlabelled."""
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool]] = []  # open containers: tag, inside boilerplate, inside the article
    is_open: Counter[str] = Counter()
    bad = article = False
    link_depth = -1  # containers open when the current link began; -1 outside links

    def close_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, bad, article))
            parts.clear()
            linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = htmllib.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if link_depth >= 0:
                linked += len(text) - text.count(" ")

    at, tags = 0, _Tags(page)
    while (found := tags.after(at)) is not None:
        begin, end, slash, tag, attributes = found
        add(page[at:begin])
        at = end
        if slash is None:
            continue
        if slash:  # end tag
            if tag == "a":
                link_depth = -1
            if tag in INLINE:
                continue
            close_block()
            for k in range(len(stack) - 1, -1, -1) if is_open[tag] else ():
                if stack[k][0] == tag:
                    is_open.subtract(t for t, _, _ in stack[k:])
                    del stack[k:]
                    bad, article = stack[-1][1:] if stack else (False, False)
                    if link_depth > len(stack):
                        link_depth = -1
                    break
            continue
        if tag in RAW_TEXT:
            if not attributes.rstrip().endswith("/"):
                closing = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = closing.end() if closing else len(page)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            link_depth = len(stack)
        if tag in INLINE and not (tag not in VOID and _named_bad(tag, attributes, article)):
            continue
        close_block()
        if tag in VOID:
            continue
        if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == tag:
            is_open[stack.pop()[0]] -= 1  # these end where the next of their kind begins
            bad, article = stack[-1][1:] if stack else (False, False)
        article = article or tag in REGIONS
        bad = bad or _named_bad(tag, attributes, article)
        stack.append((tag, bad, article))
        is_open[tag] += 1
    add(page[at:])
    close_block()
    return out


def _first_pass(block: Block) -> str:
    if block.bad:
        return "bad"
    length = len(block.text)
    density = block.linked / max(length - block.text.count(" "), 1)
    if density > (LINKS_MOST_ARTICLE if block.article else LINKS_MOST):
        return "bad"
    if not block.article and "\N{COPYRIGHT SIGN}" in block.text:
        return "bad"
    if length < SHORT:
        return "bad" if block.linked and not block.article else "short"
    words = _WORD.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
    if stops >= STOPS_MANY:
        return "good" if length > LONG else "near"
    # without stop words a long block may be a table, code or a further language: its neighbours decide
    return "near" if stops >= STOPS_SOME or block.article else "short"


def label_blocks(blocks: list[Block]) -> list[Block]:
    """Label every block good or bad, in two passes."""
    region = any(b.article and not b.bad for b in blocks)
    first = ["bad" if region and not b.article else _first_pass(b) for b in blocks]
    n = len(blocks)

    def decided(ambiguous: tuple[str, ...], labels: list[str]) -> tuple[list[str], list[str]]:
        """For every block the nearest label to the left and to the right that isn't ambiguous."""
        sides = []
        for order in (range(n), range(n - 1, -1, -1)):
            last, side = "", [""] * n
            for i in order:
                side[i] = last
                if region and not blocks[i].article:
                    last = ""  # the article's border
                elif not blocks[i].bad and labels[i] not in ambiguous:
                    last = labels[i]
            sides.append(side)
        return sides[0], sides[1]

    labels = list(first)
    left, right = decided(("short", "near"), first)
    near_left, near_right = decided(("short",), first)
    for i, kind in enumerate(first):
        if kind == "short":
            around = {left[i], right[i]} - {""}
            if len(around) == 2:  # between good and bad: a near good block on the bad side decides
                toward_bad = near_left[i] if left[i] == "bad" else near_right[i]
                labels[i] = "good" if region or toward_bad == "near" else "bad"
            else:
                labels[i] = around.pop() if around else "good"
                if region and labels[i] == "bad":
                    labels[i] = "good"
        elif kind == "near":
            labels[i] = "bad" if {left[i], right[i]} == {"bad"} and not region else "good"
    for b, label in zip(blocks, labels):
        b.label = label
    return blocks


def main_text(page: str | None) -> str:
    """The good blocks of a page, joined by one space."""
    if not page:
        return ""
    return " ".join(b.text for b in label_blocks(blocks_of(page)) if b.label == "good")


def _extract_batches(html: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, html):
            place = batch.schema.get_field_index(html)
            texts = [main_text(p) for p in batch.column(place).to_pylist()]
            rest = [k for k in range(batch.num_columns) if k != place]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in rest], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*[batch.schema.names[k] for k in rest], "text", "n_chars"],
            )

    return run


def extract(df: DataFrame, html: str = "html") -> DataFrame:
    """Every row of ``df`` with the main text of its page (text, n_chars) in place of the html column."""
    df = drop_named(df, "text", "n_chars")
    rest = [f for f in df.schema.fields if f.name != html]
    schema = StructType(rest).add("text", "string").add("n_chars", "long")
    return df.mapInArrow(_extract_batches(html), schema)


def op6_extract(df: DataFrame) -> DataFrame:
    """The contract's columns for a pages table."""
    return extract(df.select("page_id", "url", F.col("html"))).select("page_id", "url", "text", "n_chars")
