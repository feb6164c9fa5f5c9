"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from soundlake.llm.tables import positional
from soundlake.llm.words import parts

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin a new line of the page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose lines may form a region.
REGIONS = frozenset("article body div main section table td".split())
#: Elements that never hold article text.
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer frame frameset head iframe input map menu nav noscript object optgroup option script select "
    "style svg template textarea title video".split()
)
#: Words in class or id that make an element suspect: notices, adverts, side bars, reader comments and the like, or just a wrapper of the page that names them.
NOTES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disclaimer disqus "
    "discussion footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination paywall popup promo promoted "
    "promotion reaction reactions recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar widget widgets".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
_WORDS = re.compile("[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Standard deviation of the smoothing, in lines.
SIGMA = 1.0
#: Share of the content that the chosen regions hold at least.
SHARE = 0.9
#: Least lines of a menu without a telling name, and most characters of one.
MENU, SHORT = 3, 25


class Lines(HTMLParser):
    """Collects the lines of one page: text, number of tags, innermost node, whether all of it is link text; text of dropped elements is not kept.

    Nodes are the elements that may form a region and those that are suspect by their name, class, id or role.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[tuple[int, str, bool]] = [(-1, "page", False)]  # (parent, name, suspect)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.stack: list[tuple[str, int, bool]] = []  # (name, node, dropped)
        self.node, self.dropped = 0, False
        self.text: list[str] = []
        self.tags, self.anchor, self.plain = 0, False, False

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.lines.append((text, self.tags, self.node, not self.plain))
            self.text = []
        self.tags, self.anchor, self.plain = 0, False, False

    def _judged(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
        """(dropped with all inside, suspect)."""
        if tag in DROPPED:
            return True, False
        if tag in ("html", "body", "article", "main"):
            return False, False
        suspect = tag == "form" or tag == "header" and not any(name in ("article", "main") for name, _, _ in self.stack)
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
                return True, False
            if name in ("class", "id") and tag != "header":
                suspect = suspect or not NOTES.isdisjoint(_WORDS.findall(value))
            suspect = suspect or name == "role" and value in ROLES
        return False, suspect

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            if self.stack and self.stack[-1][0] == "p" and tag != "hr":
                self._close(len(self.stack) - 1)
        self.tags += 1
        if tag == "a":
            self.anchor = True
        if tag in VOID:
            if tag == "br" and not self.dropped:
                self.text.append(" ")
            return
        dropped, suspect = self._judged(tag, attrs)
        if tag not in BLOCKS and tag not in DROPPED and not self.dropped and not dropped and not suspect:
            return  # inline: neither opens a node nor hides anything, so it need not be tracked
        if suspect and tag not in BLOCKS:
            self.flush()
        self.stack.append((tag, self.node, self.dropped))
        self.dropped = self.dropped or dropped
        if tag in REGIONS or suspect:
            self.nodes.append((self.node, tag, suspect))
            self.node = len(self.nodes) - 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, at: int) -> None:
        _, node, self.dropped = self.stack[at]
        if node != self.node:
            self.flush()
        self.node = node
        del self.stack[at:]

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if tag == "a":
            self.anchor = False
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._close(at)
                break
            if self.stack[at][0] in ("article", "body", "td", "table") and tag not in BLOCKS:
                break

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            self.text.append(data)
            self.plain = self.plain or not self.anchor and not data.isspace()


def page_lines(html: str) -> tuple[list[tuple[str, int, int, bool]], list[tuple[int, str, bool]]]:
    """(lines, nodes) of a page, fed to the parser as a whole; marks that the parser rejects are read as text."""
    for attempt in (html, html.replace("<![", "&lt;!["), html.replace("<!", "&lt;!")):
        parser = Lines()
        try:
            parser.feed(attempt)
            parser.close()
        except AssertionError:
            continue
        parser.flush()
        return parser.lines, parser.nodes
    raise ValueError("a page that the parser cannot read")


def content(lines: list[tuple]) -> np.ndarray:
    """Which lines are content: smoothed text-to-tag ratio above the threshold between the two clusters of ratios.

    The threshold is the mean of the two cluster means, found by moving it until it stays; it starts at the mean ratio. With one value all lines are content.
    """
    ratio = np.array([len(line[0]) / max(1, line[1]) for line in lines])
    reach = min(len(ratio), int(3 * SIGMA) + 1)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    padded = np.pad(ratio, reach, mode="edge")
    smooth = np.convolve(padded, weights / weights.sum(), "valid")
    cut = smooth.mean()
    for _ in range(50):
        high, low = smooth[smooth >= cut], smooth[smooth < cut]
        if not len(low) or not len(high):
            break
        new = (high.mean() + low.mean()) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return smooth >= cut


def _weights(lines: list[tuple], use: np.ndarray, nodes: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of content lines per node: directly in it, and in all of it."""
    own = np.zeros(len(nodes))
    for line, chosen in zip(lines, use.tolist(), strict=True):
        own[line[2]] += len(line[0]) if chosen else 0
    whole = own.copy()
    for i in range(len(nodes) - 1, 0, -1):
        whole[nodes[i][0]] += whole[i]
    return own, whole


def _furniture(lines: list[tuple], nodes: list[tuple]) -> list[tuple]:
    """The lines without those in suspect elements.

    A suspect element stays if it only wraps the page: if the article or main element with the most text lies in it, or, on pages without such elements, half of
    the content.
    """
    _, whole = _weights(lines, content(lines), nodes)
    _, text = _weights(lines, np.ones(len(lines), bool), nodes)
    named = [i for i, n in enumerate(nodes) if n[1] in ("article", "main") and text[i]]
    wraps = set()
    at = max(named, key=lambda i: text[i], default=0)
    while at > 0:
        wraps.add(at)
        at = nodes[at][0]
    out = np.zeros(len(nodes), bool)
    for i, (parent, _, suspect) in enumerate(nodes[1:], 1):
        wrapper = i in wraps if named else whole[i] >= 0.5 * whole[0]
        out[i] = out[parent] or suspect and not wrapper
    return [line for line in lines if not out[line[2]]]


def _links(lines: list[tuple], use: np.ndarray) -> np.ndarray:
    """Lines of menus without a telling name: at least MENU short ones in a row, all of them link text and none of them content."""
    short = np.array([line[3] and len(line[0]) <= SHORT for line in lines]) & ~use
    edge = np.flatnonzero(np.diff(np.concatenate([[0], short.astype(np.int8), [0]])))
    menu = np.zeros(len(lines), bool)
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        menu[a:b] = b - a >= MENU
    return menu


def main_text(html: str | None) -> str:
    """Text of the regions that hold the content: their lines in page order, one per block, empty if there is none.

    The content lines that the ratios choose decide which suspect elements are wrappers and stay, which lines of links are menus, and which regions are taken: the
    article elements (else main elements) with content, if they hold ``SHARE`` of it together (articles without a content line, as teasers, go); otherwise the
    innermost element that holds so much. All other lines of these regions belong to the text, short ones too.
    """
    if not html:
        return ""
    lines, nodes = page_lines(html)
    if any(n[2] for n in nodes) and lines:
        lines = _furniture(lines, nodes)
    if not lines:
        return ""
    use = content(lines)
    own, whole = _weights(lines, use, nodes)
    for name in ("article", "main", None):
        inside = np.zeros(len(nodes), bool)
        if name:
            inside[[i for i, n in enumerate(nodes) if n[1] == name and whole[i]]] = True
        else:
            inside[max((i for i in range(len(nodes)) if whole[i] >= SHARE * whole[0]), default=0)] = True
        for i in range(1, len(nodes)):
            inside[i] |= inside[nodes[i][0]]
        if own[inside].sum() >= SHARE * whole[0]:
            break
    menu = _links(lines, use)
    return "\n".join(line[0] for line, m in zip(lines, menu.tolist(), strict=True) if inside[line[2]] and not m)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with text and n_chars (code points).

    Null and empty pages, and pages without text, give an empty text. Repeated rows are extracted alike; other columns stay, those named text and n_chars (in any case) are
    replaced; an empty table gives no rows. Nothing is shuffled, and a page of any length is parsed whole.
    """
    table, names = positional(pages)
    keep = {old: new for old, new in names.items() if old != html_col and old.lower() not in ("text", "n_chars")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, len(keep)):
            texts = [main_text(h) for h in part.column(len(keep)).to_pylist()]
            yield pa.record_batch([*part.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep.values(), "text", "n_chars"])

    kinds = "".join(f"{n} {table.schema[n].dataType.simpleString()}, " for n in keep.values())
    return table.select(*keep.values(), names[html_col]).mapInArrow(run, f"{kinds}text string, n_chars long").toDF(*keep, "text", "n_chars")
