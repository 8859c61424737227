"""Main text of HTML pages by text-to-tag ratios.

Pages stream through the standard library's parser in chunks. Its events build
the page's lines: the text between two block boundaries, with the tags met in
it and the characters inside links. The ratio of characters to tags of each
line is smoothed along the page with a Gaussian; lines at or above a threshold
(the standard deviation of the smoothed ratios) are the content cluster. The
cluster selects regions, and a region's lines are kept whole, short ones
included: the ``article`` elements that hold a cluster line; without any
article the ``main`` element; without both the container that more than half
of the cluster's characters share, less its child containers without a cluster line.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments are known by element, role, or the names in ``class`` and
``id``; their lines count as lines without text. A heading in an article's own header stays. Elements left
open end where HTML ends them; a tag cut off by the end of the page is no text.

Defined results: null or empty html gives an empty text, bytes that are no
UTF-8 are read as U+FFFD; a page without tags is one line. Repeated rows and
null ids give their own rows, an empty table gives none. Columns other than
the id, the kept ones and the html are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_CONTAINER = frozenset("div section td center".split())
#: Elements whose text is no part of the article.
_DROPPED = frozenset(
    "script style noscript template title nav footer aside form button select option optgroup datalist textarea label fieldset legend "
    "iframe object svg canvas audio video menu dialog search".split())
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Parts of a class or id that mark an element as no content.
_DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner sidebar aside menu nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr notice notices popup modal newsletter subscribe "
    "subscription signup login comment comments disqus replies share sharing social related recommended footer masthead toolbar skiplink".split())
_COMMENT_NAMES = frozenset("comment comments reply replies teaser ad ads advert promo sponsored related".split())
_ARTICLE_PARTS = frozenset("article entry post story content".split())
_STATES = frozenset("has no with without is hide show open".split())
#: An opened element ends open ones of these kinds, up to the nearest of the limits.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
         "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}

_NONE, _ALL, _BUT_HEADINGS = 0, 1, 2


class Line(NamedTuple):
    """A block of text; ``region`` is (article, main) ids, 0 for none."""

    text: str
    tags: int
    linked: int
    dropped: bool
    region: tuple[int, int]
    path: tuple[int, ...]


class _Open(NamedTuple):
    tag: str
    drop: int
    region: tuple[int, int]
    path: tuple[int, ...]


def _names(attrs: dict[str, str | None]) -> list[list[str]]:
    found = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
    return [[p for p in re.split(r"[-_]+|(?<=[a-z])(?=[A-Z])", n) if p] for n in found]


def _drop_of(tag: str, attrs: dict[str, str | None], in_region: bool) -> int:
    if tag in _DROPPED:
        return _ALL
    if (attrs.get("role") or "").lower() in _DROPPED_ROLES:
        return _ALL
    if tag == "header":
        return _BUT_HEADINGS if in_region else _ALL
    if tag in ("html", "body", "main") or not ("class" in attrs or "id" in attrs):
        return _NONE
    kind = _NONE
    for parts in _names(attrs):
        parts = [p.lower() for p in parts]
        if not _STATES.isdisjoint(parts):
            continue
        if tag == "article":
            if len(parts) == 1 and parts[0] in _COMMENT_NAMES:
                return _ALL
        elif not _DROPPED_NAMES.isdisjoint(parts):
            return _ALL
        elif "header" in parts:
            kind = _BUT_HEADINGS if in_region or not _ARTICLE_PARTS.isdisjoint(parts) else _ALL
    return kind


class LineParser(HTMLParser):
    """Turns parser events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self._open: list[_Open] = [_Open("", _NONE, (0, 0), ())]
        self._text: list[str] = []
        self._tags = self._linked = self._links = self._headings = self._ids = 0

    # -- lines -----------------------------------------------------------------
    def _end_line(self) -> None:
        top = self._open[-1]
        text = " ".join("".join(self._text).split())
        if text:
            dropped = top.drop == _ALL or (top.drop == _BUT_HEADINGS and not self._headings)
            self.lines.append(Line("" if dropped else text, self._tags, self._linked, dropped, top.region, top.path))
        self._text.clear()
        self._tags = self._linked = 0

    def handle_data(self, data: str) -> None:
        if self._open[-1].tag in _DROPPED and not data.isspace():
            data = "."  # such a line has no text of its own
        self._text.append(data)
        if self._links:
            self._linked += len(data)

    # -- elements --------------------------------------------------------------
    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag in _BLOCK or tag in _DROPPED
        if block:
            self._end_line()
            self._close_implied(tag)
        self._tags += 1
        if tag in _VOID:
            return
        found, above = dict(attrs), self._open[-1]
        region, path, drop = above.region, above.path, above.drop
        role = (found.get("role") or "").lower()
        own = _drop_of(tag, found, region != (0, 0))
        landmark = tag == "article" or role == "article" or tag == "main" or role == "main"
        if landmark and drop and own == _NONE and all(o.tag == "form" for o in self._open if o.drop):
            drop = _NONE  # a form around the whole page
        if drop != _ALL and own:
            drop = own
        if landmark and drop != _ALL:
            self._ids += 1
            if (tag == "article" or role == "article") and not region[0]:
                region = (self._ids, region[1])
            elif not region[1]:
                region = (region[0], self._ids)
        if tag in _CONTAINER:
            self._ids += 1
            path = (*path, self._ids)
        self._open.append(_Open(tag, drop, region, path))
        self._links += tag == "a"
        self._headings += tag in _HEADING

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML has no empty-element form: "<div/>" opens a div

    def handle_endtag(self, tag: str) -> None:
        block = tag in _BLOCK or tag in _DROPPED
        self._tags += 1
        if block:
            self._end_line()
        if tag in ("body", "html"):
            return
        for at in range(len(self._open) - 1, 0, -1):
            name = self._open[at].tag
            if name == tag:
                if block:
                    self._pop(at)
                else:
                    self._counted(self._open.pop(at).tag)
                return
            if not block and (name in _BLOCK or name in _DROPPED):
                break
            if tag in ("p", "li", "dt", "dd", "td", "th", "tr") and name in ("article", "main", "table", "div", "section"):
                return
        if not block:  # an inline element that was opened outside the block ends here
            for at in range(len(self._open) - 1, 0, -1):
                if self._open[at].tag == tag:
                    self._counted(self._open.pop(at).tag)
                    return

    def _close_implied(self, tag: str) -> None:
        if tag in _BLOCK and tag != "br":
            for at in range(len(self._open) - 1, 0, -1):
                name = self._open[at].tag
                if name == "p" or (tag in _HEADING and name in _HEADING):
                    self._pop(at)
                    break
                if name in _BLOCK or name in _DROPPED:
                    break
        if tag in _ENDS:
            kinds, limits = _ENDS[tag]
            for at in range(len(self._open) - 1, 0, -1):
                name = self._open[at].tag
                if name in kinds:
                    self._pop(at)
                    break
                if name in limits or name in _CONTAINER or name in ("article", "main"):
                    break

    def _pop(self, at: int) -> None:
        for gone in self._open[at:]:
            self._counted(gone.tag)
        del self._open[at:]

    def _counted(self, tag: str) -> None:
        self._links -= tag == "a"
        self._headings -= tag in _HEADING

    # -- the stream ------------------------------------------------------------
    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)  # "<![...": HTML reads on to the next ">"

    def finish(self) -> list[Line]:
        if re.match(r"<[A-Za-z/!?]", self.rawdata) and not self.cdata_elem:
            self.rawdata = ""  # a tag or comment that the end of the page cut off
        self.close()
        self._end_line()
        return self.lines


def page_lines(html: str) -> list[Line]:
    parser = LineParser()
    for at in range(0, len(html), CHUNK):
        parser.feed(html[at:at + CHUNK])
    return parser.finish()


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing, cut at three sigmas; the ends repeat the kernel's share that lies inside."""
    if sigma <= 0 or len(values) < 2:
        return values
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    inside = np.convolve(np.ones(len(values)), kernel)[reach:-reach]
    return np.convolve(values, kernel)[reach:-reach] / inside


def content_lines(lines: Sequence[Line], sigma: float, factor: float) -> np.ndarray:
    """The content cluster: lines whose smoothed ratio reaches the threshold (the best candidate always does)."""
    candidate = np.array([not x.dropped for x in lines], dtype=bool)
    ratio = np.array([0.0 if x.dropped else len(x.text) / max(1, x.tags) for x in lines])
    level = smoothed(ratio, sigma)
    if not candidate.any():
        return candidate
    return candidate & (level >= min(factor * float(level.std()), float(level[candidate].max())))


def _regions(lines: Sequence[Line], which: int) -> list[Line] | None:
    return None if not any(x.region[which] and not x.dropped for x in lines) else \
        [x if x.region[which] else x._replace(text="", dropped=True) for x in lines]


def main_blocks(lines: Sequence[Line], sigma: float = 1.0, factor: float = 1.0) -> list[str]:
    """Texts of the lines of the selected regions, in page order."""
    for which in (0, 1):
        inside = _regions(lines, which)
        if inside is not None:
            cluster = content_lines(inside, sigma, factor)
            chosen = {x.region[which] for x, c in zip(inside, cluster, strict=True) if c}
            return [x.text for x in inside if not x.dropped and x.region[which] in chosen]
    # no landmark: menus are lines that are mostly links
    lines = [x._replace(text="", dropped=True) if 2 * x.linked > len(x.text) and not x.dropped else x for x in lines]
    cluster = content_lines(lines, sigma, factor)
    inside = [x for x, c in zip(lines, cluster, strict=True) if c]
    total, node = sum(len(x.text) for x in inside), ()
    while True:
        share: dict[int, int] = {}
        for x in inside:
            if len(x.path) > len(node) and x.path[:len(node)] == node:
                share[x.path[len(node)]] = share.get(x.path[len(node)], 0) + len(x.text)
        best = max(share, key=share.get, default=None)
        if best is None or 2 * share[best] <= total:
            break
        node = (*node, best)
    depth = len(node)
    return [x.text for x in lines if not x.dropped and x.path[:depth] == node and (len(x.path) == depth or x.path[depth] in share)]


def main_text(html: str, sigma: float = 1.0, factor: float = 1.0) -> tuple[str, int]:
    """(blocks joined by one space, number of blocks)."""
    blocks = main_blocks(page_lines(html), sigma, factor)
    return " ".join(blocks), len(blocks)


def extract_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: Sequence[str] = ("url",),
                 sigma: float = 1.0, factor: float = 1.0) -> DataFrame:
    """One row per page: id, the kept columns, text, n_chars (code points), n_blocks."""
    rows = df.select(F.col(id_col), *[F.col(c) for c in keep], F.col(html_col).cast("binary").alias("_html"))
    held = rows.schema.fields[:-1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts, sizes, blocks = [], [], []
                for html in part.column(part.num_columns - 1):
                    raw = html.as_py()
                    text, n = main_text(raw.decode("utf-8", "replace"), sigma, factor) if raw else ("", 0)
                    text = text.encode("utf-8", "replace").decode()  # a reference to a lone surrogate is no character
                    texts.append(text)
                    sizes.append(len(text))
                    blocks.append(n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(blocks, pa.int32())],
                    names=[*[f.name for f in held], "text", "n_chars", "n_blocks"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held)
    return rows.mapInArrow(work, f"{schema}, text string, n_chars long, n_blocks int")
