"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides each block by where it
stands (menus, footers, adverts ...), its link density, its length and its share of stop
words. Blocks that this leaves open, short ones above all, take the label of the nearest
decided block of the same part of the page.

Stop words are those of English, German, French and Spanish. On a page whose blocks together have
few of them, which is in another language, they decide nothing: length and links do.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import small_batches

# Element names of HTML and common function words of four languages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option "
    "p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE = frozenset("head title nav footer aside form button dialog select menu fieldset".split())
CONTENT = frozenset("article main".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment "
    "comments commentlist respond replies disqus sidebar widget widgets related recommended share sharing social menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead copyright legal search pagination pager toolbar".split()
)
STOP = frozenset(
    "the of and to in is that it for was on are with as be by this from or an at not have has but they which you he "
    "she we his her their will would can all were been there der die das und ist den von zu mit sich des auf für im "
    "dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über "
    "einen so zum war haben nur oder aber vor zur bis mehr durch man sein le la les de des et en un une du que qui "
    "est dans pour pas au sur par plus ne se ce il elle avec son sont aux ou mais nous vous leur el los las y del se "
    "una por con para su al lo como más pero sus ya o este sí porque esta entre cuando muy sin sobre".split()
)

# Hints that a paragraph or heading of an article may have too, and parts of class names that deny the others.
MILD = frozenset("alert copyright legal login menu overlay related respond search social widget".split())
DENIED = frozenset("has no not with without hide hides is".split())
PROSE = frozenset("blockquote h1 h2 h3 h4 h5 h6 p pre".split())

# Attributes end before the next "<", so that a page with an odd quote isn't read again and again.
RAW = frozenset("script style noscript template textarea iframe svg math object canvas".split())
UNCLOSED = frozenset("script style textarea".split())  # these go on to the page's end, others without a closing tag are nothing
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attributes>(?:[^<>\"']|\"[^<\"]*\"|'[^<']*')*)>"
    r"|<[!?/a-z][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.I | re.S,
)
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
WORD = re.compile(r"[^\W\d_]+")
PARTS = re.compile(r"[^a-z]+")


@dataclass
class Rules:
    """Bounds of the first pass: link density, characters and shares of stop words."""

    link_density: float = 0.33
    short: int = 70
    long: int = 200
    stop_low: float = 0.1
    stop_high: float = 0.2


@dataclass
class Block:
    zone: int
    bad: bool
    content: bool
    heading: bool
    paragraph: bool = False
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def tokens(page: str):
    """Tags and texts of a page; what a raw element holds is passed over.

    Each name's closing tags are looked for once beyond the last one, so a page of many unclosed
    elements is read once.
    """
    at, none_after = 0, set()
    while at < len(page):
        token = TOKEN.match(page, at)
        at = token.end()
        name = (token["name"] or "").lower()
        if name in RAW:
            if not token["close"] and not token["attributes"].endswith("/"):
                end = None if name in none_after else ENDS[name].search(page, at)
                if end:
                    at = end.end()
                else:
                    none_after.add(name)
                    if name in UNCLOSED:
                        return
            continue
        yield token


def marks_of(attributes: str) -> set[str]:
    """The words of an element's classes, id and role; a name such as has-sidebar or no-comments says nothing."""
    found: set[str] = set()
    for a in MARKS.finditer(attributes):
        for value in (a[1] or a[2] or a[3] or "").lower().split():
            parts = PARTS.split(value)
            if DENIED.isdisjoint(parts):
                found.update(parts)
    return found


def blocks(page: str) -> list[Block]:
    """Blocks of a page with text, in order; zone numbers the content element that a block is in, 0 for none.

    A content element that a hint alone puts outside has a negative zone: it counts if the page has no other.
    """
    found: list[Block] = []
    stack: list[tuple[str, str, int]] = []  # open elements: name, why outside the main text, zone
    opened: Counter[str] = Counter()
    muted: list[str] = []  # open inline elements that are hidden or adverts, and those of the same name in them
    muted_in = 0  # how many block elements were open then
    zones, links = 0, 0
    now: Block | None = None
    for token in tokens(page):
        name = token["name"]
        if name is None:
            if token["text"] is not None and not muted:
                if now is None:
                    bad, zone = (stack[-1][1], stack[-1][2]) if stack else ("", 0)
                    now = Block(zone, bool(bad), zone != 0, any(x[0] in HEADING for x in stack[-3:]), bool(stack) and stack[-1][0] == "p")
                    found.append(now)
                now.pieces.append(piece := html.unescape(token["text"]))
                if links:
                    now.linked += len(" ".join(piece.split()))
            continue
        name = name.lower()
        if name not in BLOCK:
            if name == "a":
                links = 0 if token["close"] else 1
            elif name == "br":
                if now is not None:
                    now.pieces.append(" ")
            if token["close"]:
                if muted and name == muted[-1]:
                    muted.pop()
            elif name not in VOID and not token["attributes"].endswith("/"):
                if name in muted or not muted and token["attributes"] and (HIDDEN.search(token["attributes"]) or not (HINTS - MILD).isdisjoint(marks_of(token["attributes"]))):
                    muted.append(name)
                    muted_in = len(stack) if len(muted) == 1 else muted_in
            continue
        now = None
        if token["close"]:
            if opened[name]:  # else it closes nothing
                while True:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
                links = 0
                if len(stack) < muted_in:
                    muted.clear()
            continue
        if name in VOID:
            continue
        if stack and stack[-1][0] in ("p", *HEADING) or stack and stack[-1][0] == name and name in ("li", "dt", "dd", "td", "th", "tr", "option"):
            opened[stack.pop()[0]] -= 1
        if name == "body":
            stack.clear()
            opened.clear()
        if len(stack) < muted_in:
            muted.clear()
        bad, zone = (stack[-1][1], stack[-1][2]) if stack else ("", 0)
        hinted = False
        if token["attributes"] and name not in ("html", "body"):
            marks = marks_of(token["attributes"])
            hinted = not HINTS.isdisjoint(marks - MILD if zone and name in PROSE else marks) or "header" in marks and not zone
        if name not in ("html", "body"):
            if muted or token["attributes"] and HIDDEN.search(token["attributes"]) or name in OUTSIDE or name == "header" and not zone:
                bad = "outside"
            elif hinted and not bad:
                bad = "hint"
        if name in CONTENT and bad != "outside":
            zones += 1
            if bad == "hint" and zone <= 0:
                zone, bad = -zones, ""
            elif not bad:
                zone = zones
        if token["attributes"].endswith("/") and name not in ("p", "div"):
            continue
        stack.append((name, bad, zone))
        opened[name] += 1
    for block in found:
        block.text = " ".join("".join(block.pieces).split())
    return [b for b in found if b.text]


def known_language(found: list[Block], rules: Rules) -> bool:
    """Whether the blocks together, links aside, have the share of stop words that text has."""
    words = [w for b in found if not b.bad and 2 * b.linked < len(b.text) for w in WORD.findall(b.text.lower())]
    return sum(w in STOP for w in words) >= rules.stop_low * len(words)


def first_pass(block: Block, rules: Rules, known: bool = True) -> bool | None:
    """True for main text, False for the rest, None if neighbours have to decide; known: whether stop words tell anything."""
    if block.bad:
        return False
    n = len(block.text)
    if block.linked > rules.link_density * n:
        return None if block.content and block.paragraph else False
    if n < rules.short:
        return None
    if not known:
        return True
    words = WORD.findall(block.text.lower())
    density = sum(w in STOP for w in words) / max(1, len(words))
    if density >= rules.stop_high and n >= rules.long or density >= rules.stop_high and block.content:
        return True
    if density < rules.stop_low and not block.content:
        return False
    return None


def second_pass(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """Open blocks take the label of the nearest decided one of their zone; of two equally near, headings follow the next and others prefer main text."""
    out = [bool(x) for x in labels]
    before: list[int | None] = [None] * len(found)
    after: list[int | None] = [None] * len(found)
    for order, seen in ((range(len(found)), before), (range(len(found) - 1, -1, -1), after)):
        last: dict[int, int] = {}
        for i in order:
            if labels[i] is not None and not (found[i].content and labels[i] is False):
                last[found[i].zone] = i
            seen[i] = last.get(found[i].zone)
    some = any(out)
    for i, block in enumerate(found):
        if labels[i] is not None:
            continue
        a, b = before[i], after[i]
        if a is None and b is None:
            out[i] = block.content or not some and not any(x.content for x in found)
        elif block.heading and b is not None:
            out[i] = bool(labels[b])
        elif a is None or b is None:
            out[i] = bool(labels[b if a is None else a])
        else:
            out[i] = bool(labels[a]) if i - a < b - i else bool(labels[b]) if b - i < i - a else bool(labels[a] or labels[b])
    return out


def main_text(page: str | None, rules: Rules | None = None) -> str:
    """Main text of a page, a line for each block; empty for null and where there is none."""
    if not page:
        return ""
    rules = rules or Rules()
    found = blocks(page)
    if any(b.zone > 0 and not b.bad for b in found):
        found = [b for b in found if b.zone > 0]
    else:
        sizes = Counter()
        for b in found:
            if b.zone < 0 and not b.bad:
                sizes[b.zone] += len(b.text)
        if sizes:  # the largest of those under a hint, of equal ones the first
            largest = max(sizes, key=lambda z: (sizes[z], z))
            found = [b for b in found if b.zone == largest]
    known = known_language(found, rules)
    labels = second_pass(found, [first_pass(b, rules, known) for b in found])
    return "\n".join(b.text for b, keep in zip(found, labels, strict=True) if keep)


def extracted(page: Column, rules: Rules | None = None) -> Column:
    """Main text of a column of pages."""

    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(lambda x: main_text(x, rules))

    return F.pandas_udf(texts, "string")(page)


def extract(pages: DataFrame, page: str = "html", out: str = "text", rules: Rules | None = None) -> DataFrame:
    """`pages` with the main text as column `out`, which replaces a column of that name.

    Row by row, without a shuffle. Null and empty pages give an empty text, text without any
    tag is taken as main text, repeated rows stay, an empty table gives an empty one.
    """
    return small_batches(pages).withColumn(out, extracted(F.col(page), rules))
