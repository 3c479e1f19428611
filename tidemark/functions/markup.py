"""Markup to text under the verbatim contract, and links, by vectorised UDFs over the standard library's HTML parser."""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from itertools import groupby
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the text contract.
DROPPED = {"script", "style", "noscript", "template", "svg", "head", "meta", "link", "iframe"}
BLOCKS = {
    "p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr", "table", "thead", "tbody", "tfoot", "blockquote", "section", "article", "header", "footer", "aside",
    "form", "fieldset", "hr", "ul", "ol", "dl", "dt", "dd", "pre", "figure", "figcaption", "address", "main", "nav",
}
CELLS = {"td", "th"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that an opening tag closes, and where the search for them stops.
CLOSED_BY = {"li": ({"li"}, {"ul", "ol"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
_BREAKS_P = BLOCKS - {"tr", "thead", "tbody", "tfoot"}
_HOLDS_P = {"td", "th", "li", "blockquote", "div", "table"}
_SPACES = re.compile(r"[ \t\r\n]+")


class OpenElements:
    """The open elements of a page, with the depths at which each tag is open, so that the nearest one is known without a search."""

    def __init__(self) -> None:
        self.stack: list[str] = []
        self._depths: dict[str, list[int]] = {}

    def push(self, tag: str) -> None:
        self._depths.setdefault(tag, []).append(len(self.stack))
        self.stack.append(tag)

    def nearest(self, tags: set[str], stop: set[str]) -> int:
        """Depth of the innermost open element of ``tags``, or -1 if there is none or one of ``stop`` is nearer."""
        depth = lambda names: max((self._depths[t][-1] for t in names if self._depths.get(t)), default=-1)
        own = depth(tags)
        return own if own > depth(stop) else -1

    def down_to(self, depth: int) -> Iterator[str]:
        """Close what is open at ``depth`` and inside it, innermost first."""
        while len(self.stack) > depth:
            tag = self.stack.pop()
            self._depths[tag].pop()
            yield tag


class TextRenderer(HTMLParser):
    """Writes text as the events come. The line ends since the last visible word are counted as they are written."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        #: Pieces of text, and whether each is kept to the letter.
        self.parts: list[tuple[str, bool]] = []
        self.open = OpenElements()
        self.cells: list[int] = []
        self.dropped = self.pre = self.line_ends = 0
        self.links: list[dict] = []
        self._anchor: list[str] | None = None

    def _gap(self, lines: int) -> None:
        """At least so many line ends before what comes, counting those that are there."""
        if self.parts and self.line_ends < lines:
            self.parts.append(("\n" * (lines - self.line_ends), False))
            self.line_ends = lines

    def _close_to(self, depth: int) -> None:
        for tag in self.open.down_to(depth) if depth >= 0 else ():
            self.dropped -= tag in DROPPED
            self.pre -= tag == "pre"
            if tag == "tr" and self.cells:
                self.cells.pop()
            if tag in BLOCKS and not self.dropped:
                self._gap(2)
            if tag == "a":
                self._anchor = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSED_BY:
            self._close_to(self.open.nearest(*CLOSED_BY[tag]))
        if tag in _BREAKS_P:
            self._close_to(self.open.nearest({"p"}, _HOLDS_P))
        if tag in DROPPED:
            if tag not in VOID:
                self.dropped += 1
                self.open.push(tag)
            return
        if not self.dropped:
            if tag == "br":
                self._gap(1)
            elif tag in BLOCKS:
                self._gap(2)
            if tag == "tr":
                self.cells.append(0)
            if tag in CELLS and self.cells:
                if self.cells[-1]:
                    self.parts.append(("\t", False))
                self.cells[-1] += 1
            if tag == "a" and (href := dict(attrs).get("href")):
                self._anchor = []
                self.links.append({"url_raw": href, "rel": dict(attrs).get("rel"), "css_class": dict(attrs).get("class"), "link_text": self._anchor})
        if tag not in VOID:
            self.open.push(tag)
            self.pre += tag == "pre"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._close_to(self.open.nearest({tag}, set()))

    def handle_data(self, data: str) -> None:
        if self.dropped:
            return
        if self._anchor is not None:
            self._anchor.append(data)
        if not self.pre:
            data = _SPACES.sub(" ", data)
        if self.pre or data.strip(" "):
            self.line_ends = 0
        self.parts.append((data, self.pre > 0))

    def finish(self) -> None:
        """End the elements that are still open."""
        self._close_to(0)
        for link in self.links:
            link["link_text"] = "".join(link["link_text"])

    def text(self) -> str:
        """The text: stretches between verbatim pieces are tidied, and the blanks at both ends of the whole go."""
        stretches = [(verbatim, "".join(t for t, _ in parts)) for verbatim, parts in groupby(self.parts, key=lambda p: p[1])]
        out = [t if verbatim else _tidy(t) for verbatim, t in stretches]
        if out and not stretches[0][0]:
            out[0] = out[0].lstrip(" \t\n")
        if out and not stretches[-1][0]:
            out[-1] = out[-1].rstrip(" \t\n")
        return "".join(out)


def _tidy(text: str) -> str:
    """No blanks around line ends, and one empty line at most."""
    lines = [line.strip(" \t") for line in text.split("\n")]
    if len(lines) == 1:
        return text
    lines[0], lines[-1] = text[: text.index("\n")].rstrip(" \t"), text[text.rindex("\n") + 1 :].lstrip(" \t")
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines))


def render(markup: str | None) -> TextRenderer:
    r = TextRenderer()
    r.feed((markup or "").replace("\0", ""))
    r.close()
    r.finish()
    return r


def markup_text(markup: str | None) -> str:
    return render(markup).text() if markup and markup.strip() else ""


#: Rows of a batch that are Python objects at a time.
SLICE = 64


def by_slices(of: Callable, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``of`` of each row of the columns. A batch holds thousands of pages; all but one slice of them stay Arrow buffers, and so do the results."""
    parts = [pa.array([of(*row) for row in zip(*(c.slice(at, SLICE).to_pylist() for c in columns), strict=True)], kind) for at in range(0, len(columns[0]), SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def links_of(markup: str | None, base: str | None) -> list[dict]:
    """The page's links in order, each address once."""
    seen, out = set(), []
    for a in render(markup).links:
        if a["url_raw"] not in seen:
            seen.add(a["url_raw"])
            try:
                resolved = urljoin(base or "", a["url_raw"])
            except ValueError:
                resolved = a["url_raw"]
            out.append(a | {"url_resolved": resolved, "link_text": a["link_text"].strip()[:300], "position": len(out) + 1})
    return out


_META = re.compile(rb"<meta[^>]+charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.IGNORECASE)
_MARKS = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))


def decode_bytes(data: bytes | None, declared: str | None = None) -> dict:
    """Text, encoding and replaced characters of a payload: byte-order mark, declared, meta, UTF-8 and cp1252 in turn; the first that is strictly valid wins."""
    data = bytes(data or b"")
    marks = (e for m, e in _MARKS if data.startswith(m))  # two where a zero character follows that of UTF-16, as in that of UTF-32
    meta = _META.search(data[:4096])
    for name in dict.fromkeys((*marks, declared, meta and meta[1].decode("ascii"), "utf-8", "cp1252")):
        try:
            if name:
                text = data.decode(name)
                text.encode()  # some codecs make lone surrogates, which no column of strings can hold
                return {"text": text, "encoding": codecs.lookup(name).name, "replaced": 0}
        except (LookupError, ValueError):  # unknown names, codecs that are none of text, names with a zero byte, bytes that do not fit
            continue
    text, sign = data.decode("utf-8", "replace"), "�"
    return {"text": text, "encoding": "utf-8", "replaced": text.count(sign) - data.count(sign.encode())}  # without those that the payload holds


_LINK = [("url_raw", pa.string()), ("url_resolved", pa.string()), ("link_text", pa.string()), ("rel", pa.string()), ("css_class", pa.string()), ("position", pa.int32())]
_DECODED = [("text", pa.string()), ("encoding", pa.string()), ("replaced", pa.int32())]


def _html_text(markup: pa.Array) -> pa.Array:
    return by_slices(markup_text, pa.string(), markup)


def _html_links(markup: pa.Array, base: pa.Array) -> pa.Array:
    return by_slices(links_of, pa.list_(pa.struct(_LINK)), markup, base)


def _html_decode(data: pa.Array, declared: pa.Array) -> pa.Array:
    return by_slices(decode_bytes, pa.struct(_DECODED), data, declared)


def slices(of: Callable, batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """``of`` of the columns of each slice; its results leave the worker at once, so it holds those of one slice and not those of a batch."""
    for columns in batches:
        for at in range(0, len(columns[0]), SLICE):
            yield of(*(c.slice(at, SLICE) for c in columns))


def _texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return slices(_html_text, ((b,) for b in batches))


def _links(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    return slices(_html_links, batches)


def _decoded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    return slices(_html_decode, batches)


def html_text(markup: str | Column) -> Column:
    return F.arrow_udf(_texts, "string")(markup)


def html_links(markup: str | Column, base: str | Column) -> Column:
    return F.arrow_udf(_links, "array<struct<url_raw:string,url_resolved:string,link_text:string,rel:string,css_class:string,position:int>>")(markup, base)


def html_decode(data: str | Column, declared: str | Column) -> Column:
    return F.arrow_udf(_decoded, "struct<text:string,encoding:string,replaced:int>")(data, declared)
