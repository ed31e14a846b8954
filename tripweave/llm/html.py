"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each with its root-to-leaf path of block elements (with class and id;
inline elements don't count). Per path, text length and punctuation are summed and divided by the number of blocks;
both ratios are smoothed along the page, fused by multiplication, lowered by the share of link text and by marks of
boilerplate (element names, classes, ids), and compared with a share of their mean. The chosen paths locate the content
node: the lowest element that holds (nearly) all chosen text, or the ``article`` or ``main`` around it. Its unmarked
blocks, the chosen ones outside it and the headings before or between these make the text. Link lists are left out by
their ratio; links within the content node are text like any other.

Null, empty and text-free pages give an empty text, as does an empty table no rows. Unclosed and stray tags are tolerated. Repeated rows give
repeated results. Extra columns pass through; those named like an output are replaced. Whole pages are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import table, without

# Element names by their role in HTML, and words in class and id attributes that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object canvas".split())
TO_THE_END = frozenset("script style title textarea".split())  # what hides the rest of a page if it is not closed
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
BOILERPLATE = frozenset("nav header footer aside form button select menu dialog head fieldset datalist".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar aside footer header masthead comment comments discussion disqus replies notice "
    "notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login share "
    "sharing social related recommended recommendations widget toolbar pagination pager copyright".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
CLOSES_SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
LEAVES = frozenset("p li td th pre blockquote h1 h2 h3 h4 h5 h6".split())
SCOPE = frozenset("ul ol dl table select article section div body html".split())

TOKEN = re.compile(r"""<!--|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，！？、]")
SMOOTHING = np.array([0.06, 0.24, 0.4, 0.24, 0.06])
LEAST_SHARE = 0.2  # of the mean fused ratio of blocks that nothing marks
MARKED = 0.02  # what is left of the ratio of a block that an element or attribute marks as boilerplate
HELD = 0.95  # share of the chosen text that the content node holds


@dataclass
class Block:
    """A run of text between block boundaries, with the elements around it, outermost first."""

    text: str
    path: str
    elements: tuple[int, ...]
    links: int
    boilerplate: bool
    heading: bool


class _Page:
    """Blocks of one page, and the name of each element by number."""

    def __init__(self, html: str):
        self.blocks: list[Block] = []
        self.names: list[str] = []
        self.open: list[tuple[str, int, str, bool]] = []  # name, number, path step, boilerplate
        self.inline: list[str] = []
        self.pieces: list[tuple[str, bool]] = []
        self._read(html)

    def _flush(self) -> None:
        pieces, self.pieces = self.pieces, []
        text = " ".join(unescape("".join(p for p, _ in pieces)).split())
        if text:
            self.blocks.append(Block(
                text, "/".join(s for _, _, s, _ in self.open), tuple(n for _, n, _, _ in self.open),
                min(len(text), len(" ".join(unescape("".join(p for p, linked in pieces if linked)).split()))), any(b for _, _, _, b in self.open),
                any(n in ("h1", "h2", "h3", "h4", "h5", "h6") for n, _, _, _ in self.open),
            ))

    def _close_until(self, names: set[str] | frozenset[str], scope: frozenset[str]) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in names:
                del self.open[k:]
                self.inline.clear()
                return
            if self.open[k][0] in scope:
                return

    def _start(self, name: str, attributes: str) -> None:
        self._flush()
        if name in CLOSES_PARAGRAPH:
            self._close_until({"p"}, SCOPE)
        if name in CLOSES_SAME:
            self._close_until(CLOSES_SAME[name], SCOPE)
        found = ATTRIBUTE.findall(attributes) if "=" in attributes else []
        # An id on a heading, paragraph or list item is a target for links; it says nothing of the element's role.
        marks = [w for kind, *v in found if not (name in LEAVES and kind.lower() == "id") for w in "".join(v).lower().split()]
        if name in VOID:
            return
        noise = name in BOILERPLATE or any(part in MARKS for w in marks for part in (w, *re.split(r"[^a-z0-9]+", w)))
        if name in ("body", "html", "main", "article"):
            noise = noise and any(part in ("comment", "comments") for w in marks for part in re.split(r"[^a-z0-9]+", w))
        self.open.append((name, len(self.names), ".".join((name, *marks)), noise))
        self.names.append(name)

    def _end(self, name: str) -> None:
        self._flush()
        if any(n == name for n, _, _, _ in self.open):
            self._close_until({name}, frozenset())

    def _read(self, html: str) -> None:
        at, low = 0, None
        while m := TOKEN.search(html, at):
            if m.start() > at:
                self.pieces.append((html[at : m.start()], "a" in self.inline))
            at = m.end()
            if m.group() == "<!--":
                end = html.find("-->", at)
                at = len(html) if end < 0 else end + 3
                continue
            name = (m.group(2) or m.group(5) or "").lower()
            if not name:
                continue
            closing, attributes = m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
            if closing:
                if name in INLINE:
                    if name in self.inline:
                        self.inline.remove(name)
                elif name == "br":
                    self._flush()
                elif name not in RAW:
                    self._end(name)
            elif name in RAW:
                if name not in ("title", "textarea") and attributes.rstrip().endswith("/"):
                    continue
                low = low if low is not None else html.lower()
                end = low.find("</" + name, at) if len(low) == len(html) else -1
                if end < 0 and (found := re.compile("</" + name, re.I).search(html, at)):
                    end = found.start()
                if end < 0 and name not in TO_THE_END:
                    continue
                at = len(html) if end < 0 else (html.find(">", end) + 1 or len(html))
            elif name in INLINE:
                self.inline.append(name)
            elif name == "br":
                self._flush()
            else:
                self._start(name, attributes)
        if at < len(html):
            self.pieces.append((html[at:], "a" in self.inline))
        self._flush()


def path_scores(blocks: list[Block]) -> np.ndarray:
    """Fused ratio of each block: smoothed text length times smoothed punctuation of its path, less link text.

    Blocks inside elements that are marked as boilerplate have little of it left.
    """
    _, where = np.unique([b.path for b in blocks], return_inverse=True)
    n = np.bincount(where)
    length = np.bincount(where, [len(b.text) for b in blocks])
    marks = np.bincount(where, [len(PUNCTUATION.findall(b.text)) for b in blocks])
    links = np.bincount(where, [b.links for b in blocks])

    def along(per_path: np.ndarray) -> np.ndarray:
        values = (per_path / n)[where]
        weight = np.convolve(np.ones(len(values)), SMOOTHING, "full")[2 : 2 + len(values)]
        return np.convolve(values, SMOOTHING, "full")[2 : 2 + len(values)] / weight

    fused = along(length) * (along(marks) + 0.1) * (1 - links / length)[where]
    return (np.bincount(where, fused) / n)[where] * np.where([b.boilerplate for b in blocks], MARKED, 1.0)


def content_blocks(page: _Page) -> list[Block]:
    """Blocks of chosen paths and of the content node, and headings above them, in page order.

    The node is the deepest element that holds nearly all of the chosen text (the article or main element around it, if
    there is one). In it, short blocks belong to the text too, unless they are marked as boilerplate.
    """
    blocks = page.blocks
    if all(b.boilerplate for b in blocks):
        return []
    scores = path_scores(blocks)
    usual = scores[[not b.boilerplate for b in blocks]].mean()
    chosen = (scores >= LEAST_SHARE * usual) & (scores > 0)
    if not usual or not chosen.any():
        return [b for b in blocks if not b.boilerplate and b.elements and page.names[b.elements[-1]] == "p"]
    held: dict[int, int] = {}
    total = 0
    for b, own in zip(blocks, chosen):
        if own:
            total += len(b.text)
            for e in b.elements:
                held[e] = held.get(e, 0) + len(b.text)
    inner = [e for e, n in held.items() if n >= HELD * total and page.names[e] not in LEAVES]
    node = max(inner, default=None)
    around = next((b.elements for b in blocks if node in b.elements), ())
    node = next((e for e in around if page.names[e] in ("article", "main") and e <= (node or 0)), node)
    if node is not None and page.names[node] in ("body", "html"):
        node = None
    wanted = [bool(own) or (node in b.elements and not b.boilerplate) for b, own in zip(blocks, chosen)]
    last = max(k for k, want in enumerate(wanted) if want) if node is not None else len(blocks)
    return [b for k, b in enumerate(blocks) if wanted[k] or (b.heading and not b.boilerplate and k < last)]


def main_text(html: str | None) -> str:
    return " ".join(b.text for b in content_blocks(_Page(html))) if html else ""


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Append ``text`` (main text, empty if none) and ``n_chars`` (its code points)."""

    @F.arrow_udf("string")
    def main(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages_ in batches:
            yield pa.array([main_text(x) for x in pages_.to_pylist()], pa.string())

    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars")]
    found = pages.withColumn("_main", main(F.col(html))).select(*kept, F.col("_main").alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op2_html_extraction(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
