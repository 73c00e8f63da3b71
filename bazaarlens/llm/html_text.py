"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from bazaarlens.llm.common import col

# fixed values: frequent function words by language; any mapping of the same form can be given instead
STOP_WORDS = {
    "en": "a an and are as at be been but by can for from had has have he her his i if in is it its more no not of on one or our she so than that the their them then there these they this to was we were what when which who will with would you your",
    "fr": "a au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais ne nous ont ou par pas plus pour qu que qui sa se ses son sont sur un une vous été être",
    "de": "als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer es für hat ich im in ist mit nach nicht noch nur oder sich sie sind so um und uns unter von vor war was wenn werden wie wir zu zum zur über",
    "es": "a al como con cuando de del donde el ella en entre era es esta este ha hay la las le lo los más me mi muy ni no nos o para pero por que se ser si sin sobre son su sus también un una y ya",
}
# elements whose contents are no text at all, those that never hold main text, and class or id words that mark such parts
SILENT = ("script", "style", "noscript", "template", "svg", "annotation-xml", "annotation", "iframe", "object", "canvas", "select", "textarea", "title", "video", "audio", "map")
ASIDE = {"nav", "footer", "aside", "menu", "dialog", "button", "fieldset", "header"}
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disclaimer",
    "footer", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "promotion", "related", "replies", "reply",
    "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget", "alert", "gdpr", "disqus", "respond",
}
# beginnings of such words
STARTS = ("commentlist", "commentsection", "commentbox", "usercomment", "advert", "cookie", "sidebar", "newsletter", "breadcrumb", "sponsor", "subscri", "navbar", "navig", "masthead", "disqus", "footer")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "alert", "dialog", "form"}
CONTENT = {"article", "main"}
# words of adverts and of readers' comments, and words beside which such a word names a state of the page, not the box
ADS = {"ad", "ads"}
COMMENTS = {"comment", "comments", "replies", "reply", "respond", "disqus"}
BEFORE = {"has", "no", "not", "with", "without", "show", "hide"}
AFTER = {"open", "opened", "closed", "fixed", "sticky", "enabled", "disabled", "visible", "collapsed", "expanded", "active"}
BOXES = ASIDE | CONTENT | {"form", "html", "body", "div", "section", "ul", "ol", "dl", "table", "tr", "td", "th", "tbody", "thead", "figure", "details", "center", "blockquote"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = BOXES | HEADINGS | {"p", "li", "dt", "dd", "pre", "hr", "address", "caption", "figcaption", "summary", "legend", "option", "head", "meta", "link"}
VOID = {"br", "hr", "img", "meta", "link", "input", "wbr", "area", "base", "col", "embed", "source", "track"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<silent>" + "|".join(SILENT) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(?:/>|>.*?(?:</(?P=silent)\s*>|\Z))|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:visibility\s*:\s*hidden|display\s*:\s*none)\b", re.I)
_RIGHTS = re.compile(r"\A©|©\s*(?:copyright\b|\d{4}\b)|\bcopyright\s*©|\ball rights reserved\b", re.I)
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
_WORDS = re.compile(r"[^\W\d_]+")
_WIDE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")  # characters that say as much as three letters


class Block:
    """One run of text between block tags."""

    __slots__ = ("text", "linked", "heading", "section", "inside", "aside", "marks")

    def __init__(self, text: str, linked: int, heading: bool, section: int, inside: bool, aside: bool, marks: tuple[tuple[int, bool], ...]):
        self.text, self.linked, self.heading, self.section, self.inside, self.aside, self.marks = text, linked, heading, section, inside, aside, marks


def _named(value: str) -> set[str]:
    """Words of a class or id, without those that name a state: what follows has-, no-, with-, and what precedes -open, -fixed, -enabled."""
    out: set[str] = set()
    for name in value.split():
        words = [w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]
        stop = next((k for k, w in enumerate(words) if w in BEFORE), len(words))
        out.update(w for k, w in enumerate(words[:stop]) if w not in AFTER and not (k + 1 < len(words) and words[k + 1] in AFTER))
    return out


def _mark(name: str, attrs: str, inside: bool) -> str:
    """Why an element may hold no main text: "aside" for what it is, an advert or unseen, "named" for what it is called, "comment"; or "".

    A header inside an article holds its title.
    """
    if name in ASIDE and not (name == "header" and inside):
        return "aside"
    mark = "named" if name == "form" else ""
    for what, *values in _ATTR.findall(attrs) if attrs else ():
        what, value = what.lower(), next((v for v in values if v), "")
        if what == "role" and value.lower() in ROLES:
            return "aside"
        if what == "hidden":
            return "aside"
        if name in CONTENT or name in ("body", "html"):
            continue
        if what == "style" and _UNSEEN.search(value):
            return "aside"
        if what in ("class", "id"):
            words = _named(value)
            if words & ADS or any(w.startswith(("advert", "sponsor")) for w in words):
                return "aside"
            if words & COMMENTS or any(w.startswith(("commentlist", "commentsection", "commentbox", "usercomment", "disqus")) for w in words):
                mark = "comment"
            elif words & (MARKS - {"header"} if inside else MARKS) or any(w.startswith(STARTS) for w in words):
                mark = mark or "named"
    return mark


def blocks_of(page: str) -> list[Block]:
    """The page's non-empty blocks in order; character references decoded, white space made one space."""
    found: list[Block] = []
    boxes: list[tuple[str, bool, bool, int, tuple]] = []  # name, aside, inside content, section, marked boxes around as (number, comment)
    outside = ("", False, False, 0, ())
    parts: list[str] = []
    links = linked = sections = named = 0
    heading = False

    def end() -> None:
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            _, aside, inside, section, marks = boxes[-1] if boxes else outside
            found.append(Block(text, linked, heading, section, inside, aside, marks))
        parts, linked = [], 0

    at = 0
    for m in _TOKEN.finditer(page):
        piece = page[at : m.start()]
        at = m.end()
        if piece:
            parts.append(piece)
            if links:
                linked += len(piece.strip())
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append(" ")
        elif name == "a":
            links = 0 if m["close"] else 1
        elif name in BLOCKS:
            end()
            links = 0
            if name in HEADINGS:
                heading = not m["close"]
            elif not m["close"] and name in ("p", "li"):
                heading = False
            if name in BOXES:
                if m["close"]:
                    where = next((k for k in range(len(boxes) - 1, -1, -1) if boxes[k][0] == name), None)
                    if where is not None:
                        del boxes[where:]
                elif not m["attrs"].endswith("/"):
                    _, aside, inside, section, marks = boxes[-1] if boxes else outside
                    if name in CONTENT:
                        sections += 1
                        inside, section = True, sections
                    mark = _mark(name, m["attrs"], inside)
                    if mark in ("named", "comment"):
                        named += 1
                        marks = (*marks, (named, mark == "comment"))
                    boxes.append((name, aside or mark == "aside", inside, section, marks))
            elif not m["close"] and name not in VOID and m["attrs"] and _mark(name, m["attrs"], bool(boxes and boxes[-1][2])):
                # a marked paragraph or list item: its own text alone is aside
                _, _, inside, section, marks = boxes[-1] if boxes else outside
                boxes.append((name, True, inside, section, marks))
            elif m["close"] and boxes and boxes[-1][0] == name:
                boxes.pop()
    parts.append(_CUT_TAG.sub("", page[at:]))  # a page may end inside a tag
    end()
    return found


def stop_density(text: str, stop_words: dict[str, frozenset]) -> float:
    """Share of the words that are function words, in the language that has most of them."""
    words = _WORDS.findall(text.lower())
    return max((sum(w in known for w in words) for known in stop_words.values()), default=0) / len(words) if words else 0.0


def unlisted(texts: list[str], stop_words: dict[str, frozenset], low: float) -> bool:
    """Whether no language has a share of `low` of the words of all these texts: they are in none of them."""
    return bool(texts) and stop_density(" ".join(texts), stop_words) < low


def cleared(blocks: list[Block], good: list[bool]) -> set[int]:
    """Numbers of the marked boxes that a name alone can't set aside, as they hold the page's text.

    A box is cleared if more than half of the page's good text (`good` blocks, not set aside by their elements) is in it; one of
    comments only if all of it is, as comments may well be longer than what they are about.
    """
    held: dict[int, int] = {}
    comments = set()
    total = 0
    for b, counts in zip(blocks, good, strict=True):
        if counts and not b.aside:
            total += len(b.text)
            for number, comment in b.marks:
                held[number] = held.get(number, 0) + len(b.text)
                if comment:
                    comments.add(number)
    return {number for number, size in held.items() if (size == total if number in comments else 2 * size > total)}


def nearest_labels(blocks: list[Block], labels: list[bool | None], aside: list[bool]) -> list[tuple | None]:
    """For each block the next block before it (in order) of its section with a label, as (place, label); inside an article, parts set aside in it don't count."""
    out: list[tuple | None] = []
    every: dict[int, tuple] = {}
    own: dict[int, tuple] = {}
    for k, b in enumerate(blocks):
        out.append((own if b.inside else every).get(b.section))
        if labels[k] is not None:
            every[b.section] = (k, labels[k])
            if not aside[k]:
                own[b.section] = (k, labels[k])
    return out


def main_text(page: str | None, stop_words: dict[str, frozenset], short: int = 70, long: int = 200, low: float = 0.2, high: float = 0.3, links: float = 0.3) -> str:
    """The main text: blocks of the article joined by newlines, empty if there is none.

    First pass: a block in a menu, header, footer, sidebar, notice, advert,
    form or comment, or with a link density over `links`, is bad; one with
    a stop-word density of `high` (or `low`, if `long`) is good; outside an article
    a long one with few stop words, or a short one of rights, is bad; the rest is ambiguous. A box that is only called
    one of those stays if it holds most of the page's good text (`cleared`). Second pass:
    an ambiguous block takes the label of the nearest decided block of its
    section (of two equally near ones, good wins; a heading goes with what follows it); without
    any, it is good inside an article and bad outside. On a page in a language
    without stop words here, length and link density alone decide.
    """
    blocks = blocks_of(page or "")
    size = lambda b: len(b.text) + 2 * len(_WIDE.findall(b.text))
    plain = [b for b in blocks if not b.aside and not b.heading and b.linked <= links * len(b.text) and size(b) >= short]
    foreign = unlisted([b.text for b in plain], stop_words, low)
    first: list[bool | None] = []  # labels as if no box were marked
    for b in blocks:
        density = stop_density(b.text, stop_words)
        rights = not b.inside and len(b.text) < long and _RIGHTS.search(b.text)
        if b.aside or b.linked > links * len(b.text) or rights:
            first.append(False)
        elif foreign:
            first.append(True if size(b) >= short and not b.heading else None)
        elif len(b.text) >= short and not b.heading and density >= (low if len(b.text) >= long else high):
            first.append(True)
        elif not b.inside and len(b.text) >= short and density < low:
            first.append(False)
        else:
            first.append(None)
    clear = cleared(blocks, [x is True for x in first])
    aside = [b.aside or any(number not in clear for number, _ in b.marks) for b in blocks]
    labels = [False if off else x for x, off in zip(first, aside, strict=True)]
    before = nearest_labels(blocks, labels, aside)
    last = len(blocks) - 1
    after = [x and (last - x[0], x[1]) for x in nearest_labels(blocks[::-1], labels[::-1], aside[::-1])][::-1]
    out = []
    for k, b in enumerate(blocks):
        label = labels[k]
        if label is None:
            if b.heading and after[k]:
                label = after[k][1]
            else:
                label = min(((abs(k - at), not good) for at, good in filter(None, (after[k], before[k]))), default=(0, not b.inside))[1] is False
        if label:
            out.append(b.text)
    return "\n".join(out)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), stop_words: dict[str, str] | None = None) -> DataFrame:
    """Columns of `keep`, text and n_chars (its code points) for each page.

    A null or empty page has an empty text. Pages are read whole, each on its
    own, without a shuffle; repeated rows give repeated rows.
    """
    known = {k: frozenset(v.split()) for k, v in (stop_words or STOP_WORDS).items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t.as_py(), known) for t in batch.column(len(keep))]
            cols = [*[batch.column(k) for k in range(len(keep))], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "text", "n_chars"])

    bare = pages.select(*[col(c) for c in keep], col(html_col).cast("string").alias("_html"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in bare.schema.fields[: len(keep)]]
    return bare.mapInArrow(run, ", ".join([*kinds, "text string", "n_chars long"]))
