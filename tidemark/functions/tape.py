"""A page as a flat tape: elements and pieces of text in the order of the page, each with its parent and where it ends.

What is below an element is a range of the tape and what it says a range of one text, so nothing here recurses, however deep a page is
nested, and building takes one step for each tag. Questions that go over the same range again and again are counted against an
allowance in proportion to the page, so a page that is made to be slow ends as Tangled.
"""

from __future__ import annotations

from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.markup import CLOSED_BY, VOID, OpenElements, TextRenderer

#: How often a page may be gone over, on the average of its parts.
ALLOWANCE = 24


class Tangled(ValueError):
    """The page's parts lie in each other so often that reading it would take more than its size warrants."""


class Page(HTMLParser):
    """Node 0 is the page itself. ``tags`` has None for text; ``ends`` is the place after the last node below."""

    def __init__(self, markup: str | None) -> None:
        super().__init__(convert_charrefs=True)
        source = markup or ""
        self.source = source
        clean = source.replace("\0", "")
        # places in what is parsed, as places in the source
        self._kept = None if len(clean) == len(source) else [k for k, c in enumerate(source) if c != "\0"] + [len(source)]
        self._lines = [0, *accumulate(len(line) + 1 for line in clean.split("\n"))]
        self.tags: list[str | None] = [""]
        self.attrs: list[dict[str, str]] = [{}]
        self.parents = [-1]
        self.ends = [0]
        self.starts = [0]
        #: Of elements that are closed by their own tag: where the start tag begins and ends, and the end tag begins.
        self.spans: dict[int, tuple[int, int, int]] = {}
        self.ids: dict[str, int] = {}
        self._heads: dict[int, tuple[int, int]] = {}
        self._alone: set[int] = set()
        self._pieces: list[str] = []
        self._said = 0
        self._open = OpenElements()
        self._nodes = [0]
        self.feed(clean)
        self.close()
        self._close_to(-1)
        self.ends[0] = len(self.tags)
        self.starts.append(self._said)
        self.all_text = "".join(self._pieces)
        del self._pieces
        self._left = ALLOWANCE * (len(self.tags) + len(clean)) + 100_000

    # -- building -----------------------------------------------------------

    def _place(self) -> int:
        line, column = self.getpos()
        return self._lines[line - 1] + column

    def _node(self, tag: str | None, attrs: dict[str, str]) -> int:
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.parents.append(self._nodes[-1])
        self.ends.append(len(self.tags))
        self.starts.append(self._said)
        return len(self.tags) - 1

    def _close_to(self, depth: int) -> None:
        for _ in self._open.down_to(max(depth, 0)):
            self.ends[self._nodes.pop()] = len(self.tags)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSED_BY and (depth := self._open.nearest(*CLOSED_BY[tag])) >= 0:
            self._close_to(depth)
        node = self._node(tag, {k: v or "" for k, v in reversed(attrs)})
        self.ids.setdefault(self.attrs[node].get("id", ""), node)
        at = self._place()
        self._heads[node] = (at, at + len(self.get_starttag_text() or ""))
        if tag in VOID:
            self._alone.add(node)
        else:
            self._open.push(tag)
            self._nodes.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._alone.add(self._nodes[-1])
            self._close_to(len(self._nodes) - 2)

    def handle_endtag(self, tag: str) -> None:
        depth = self._open.nearest({tag}, set())
        if depth >= 0:
            node = self._nodes[depth + 1]
            self.spans[node] = (*self._heads[node], self._place())
            self._close_to(depth)

    def handle_data(self, data: str) -> None:
        self._node(None, {})
        self._pieces.append(data)
        self._said += len(data)

    # -- reading ------------------------------------------------------------

    def _charge(self, n: int) -> None:
        self._left -= n
        if self._left < 0:
            raise Tangled("its parts overlap too often")

    def by_id(self, name: str) -> int | None:
        return self.ids.get(name)

    def children(self, node: int) -> Iterator[int]:
        return self.following(node + 1, node)

    def following(self, at: int, parent: int) -> Iterator[int]:
        """The nodes from ``at`` on that lie directly in ``parent``."""
        while at < self.ends[parent]:
            self._charge(1)
            yield at
            at = self.ends[at]

    def all(self, node: int, *tags: str) -> Iterator[int]:
        """The elements below with one of the tags."""
        for k in range(node + 1, self.ends[node]):
            self._charge(1)
            if self.tags[k] in tags:
                yield k

    def with_class(self, node: int, name: str) -> Iterator[int]:
        for k in range(node + 1, self.ends[node]):
            self._charge(1)
            if "class" in self.attrs[k] and name in self.classes(k):
                yield k

    def classes(self, node: int) -> list[str]:
        return self.attrs[node].get("class", "").split()

    def within(self, node: int, other: int | None) -> bool:
        return other is not None and other <= node < self.ends[other]

    def raw_text(self, node: int) -> str:
        low, high = self.starts[node], self.starts[self.ends[node]]
        self._charge(high - low)
        return self.all_text[low:high]

    def first_text(self, node: int) -> str:
        """What stands before the first element inside."""
        k = node + 1
        return self.raw_text(k).strip() if k < self.ends[node] and self.tags[k] is None else ""

    def _events(self, low: int, high: int) -> Iterator[tuple[str, int]]:
        """The nodes from ``low`` to ``high`` as events: text, start, end."""
        self._charge(high - low + self.starts[high] - self.starts[low])
        inside: list[int] = []
        for k in range(low, high):
            while inside and self.ends[inside[-1]] <= k:
                yield "end", inside.pop()
            tag = self.tags[k]
            yield ("text" if tag is None else "start"), k
            if tag is not None and tag not in VOID:
                inside.append(k)
        while inside:
            yield "end", inside.pop()

    def text_between(self, low: int, high: int) -> str:
        """What the nodes show under the text contract."""
        out = TextRenderer()
        for kind, k in self._events(low, high):
            if kind == "text":
                out.handle_data(self.all_text[self.starts[k] : self.starts[k + 1]])
            elif kind == "start":
                out.handle_starttag(self.tags[k], list(self.attrs[k].items()))
            else:
                out.handle_endtag(self.tags[k])
        out.finish()
        return out.text()

    def text(self, node: int) -> str:
        return self.text_between(node, self.ends[node])

    def markup_between(self, low: int, high: int) -> str:
        """The nodes written anew."""
        out = []
        for kind, k in self._events(low, high):
            if kind == "text":
                said = self.all_text[self.starts[k] : self.starts[k + 1]]
                out.append(said if self.tags[self.parents[k]] in ("script", "style") else escape(said, quote=False))
            elif kind == "start":
                out.append(f"<{self.tags[k]}{''.join(f' {name}="{escape(v)}"' for name, v in self.attrs[k].items())}>")
            else:
                out.append(f"</{self.tags[k]}>")
        return "".join(out)

    def inner(self, node: int) -> str:
        return self.markup_between(node + 1, self.ends[node])

    def _source(self, low: int, high: int) -> str:
        return self.source[low:high] if self._kept is None else self.source[self._kept[low] : self._kept[high]]

    def inner_source(self, node: int) -> str | None:
        """What stands inside the element, as written; None if it isn't closed by its own tag."""
        span = self.spans.get(node)
        return self._source(span[1], span[2]) if span else None

    def outer_source(self, node: int) -> str | None:
        """The element with its tags, as written; None if it should be closed and isn't."""
        if node in self._alone:
            return self._source(*self._heads[node])
        inner = self.inner_source(node)
        if inner is None:
            return None
        high = self.spans[node][2]
        rest = self.source[high if self._kept is None else self._kept[high] :]
        return self._source(*self._heads[node]) + inner + rest[: rest.find(">") + 1]


def slice_by_id(markup: str | None, wanted: str) -> str | None:
    """The element with the id, as written; None if there is none or it isn't closed by its own tag."""
    page = Page(markup)
    node = page.by_id(wanted)
    return None if node is None else page.outer_source(node)


def html_slice(markup: str | Column, wanted: str | Column) -> Column:
    def cut(pages: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([slice_by_id(m, w) if m else None for m, w in zip(pages, names, strict=True)], dtype=object)

    return F.pandas_udf(cut, "string")(markup, wanted)
