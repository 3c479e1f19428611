"""Line diffs with minimal scripts in linear space.

A longest common subsequence is found by halving: the lengths of the common subsequences of all prefixes of one side with
a half of the other are the zero bits of one long whole number, to which each line does one addition; so the work is a product of both lengths over 64
and no table is kept. Lines that the other side lacks are left out first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _lengths(x: list[int], y: list[int]) -> np.ndarray:
    """Length of a longest common subsequence of y with each prefix of x, the empty one included."""
    places: dict[int, int] = {}
    for k, line in enumerate(x):
        places[line] = places.get(line, 0) | 1 << k
    full = (1 << len(x)) - 1
    row = full
    for line in y:
        hit = row & places.get(line, 0)
        row = (row + hit | row - hit) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(x) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(x)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(x: list, y: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of x and y, ascending."""
    number: dict = {}
    a, b = ([number.setdefault(line, len(number)) for line in side] for side in (x, y))
    here = set(a) & set(b)
    at_x, at_y = ([k for k, line in enumerate(side) if line in here] for side in (a, b))
    a, b = [a[k] for k in at_x], [b[k] for k in at_y]
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        low, high, start, end = todo.pop()
        while low < high and start < end and a[low] == b[start]:
            out.append((at_x[low], at_y[start]))
            low, start = low + 1, start + 1
        while low < high and start < end and a[high - 1] == b[end - 1]:
            high, end = high - 1, end - 1
            out.append((at_x[high], at_y[end]))
        if low == high or start == end:
            continue
        if end - start == 1:
            at = next((k for k in range(low, high) if a[k] == b[start]), None)
            if at is not None:
                out.append((at_x[at], at_y[start]))
            continue
        half = (start + end) // 2
        head = _lengths(a[low:high], b[start:half])
        tail = _lengths(a[low:high][::-1], b[half:end][::-1])[::-1]
        cut = low + int(np.argmax(head + tail))
        todo += [(cut, high, half, end), (low, cut, start, half)]
    return sorted(out)


def hunks(x: list[str], y: list[str], context: int = 1) -> list[dict]:
    """The changes from x to y with ``context`` common lines around them: old_start, old_lines, new_start, new_lines (starts from 1), lines (each with ' ', '-' or '+' before it)."""
    steps: list[tuple[str, int, int]] = []
    i = j = 0
    for p, q in [*common_lines(x, y), (len(x), len(y))]:
        steps += [("-", k, j) for k in range(i, p)]
        steps += [("+", p, k) for k in range(j, q)]
        if p < len(x):
            steps.append((" ", p, q))
        i, j = p + 1, q + 1
    changed = [k for k, s in enumerate(steps) if s[0] != " "]
    out = []
    at = 0
    while at < len(changed):
        last = at
        while last + 1 < len(changed) and changed[last + 1] - changed[last] <= 2 * context + 1:
            last += 1
        part = steps[max(0, changed[at] - context) : changed[last] + context + 1]
        old, new = (sum(s[0] != skip for s in part) for skip in "+-")
        out.append({
            "old_start": part[0][1] + bool(old), "old_lines": old, "new_start": part[0][2] + bool(new), "new_lines": new,
            "lines": [mark + (y[q] if mark == "+" else x[p]) for mark, p, q in part],
        })
        at = last + 1
    return out


HUNKS = "array<struct<old_start:int,old_lines:int,new_start:int,new_lines:int,lines:array<string>>>"


def line_diff(old: str | Column, new: str | Column, context: int = 1) -> Column:
    """``HUNKS`` between two texts; a null text has no lines."""

    def diff(a: pd.Series, b: pd.Series) -> pd.Series:
        lines = lambda t: [] if t is None else t.split("\n")
        return pd.Series([hunks(lines(x), lines(y), context) for x, y in zip(a, b, strict=True)])

    return F.pandas_udf(diff, HUNKS)(old, new)


def unified(diff: str | Column) -> Column:
    """The hunks as text."""
    d = F.col(diff) if isinstance(diff, str) else diff
    head = lambda h: F.format_string("@@ -%d,%d +%d,%d @@", h["old_start"], h["old_lines"], h["new_start"], h["new_lines"])
    return F.array_join(F.flatten(F.transform(d, lambda h: F.concat(F.array(head(h)), h["lines"]))), "\n")


def counted(diff: str | Column) -> Column:
    """struct(removed, added): changed lines of the hunks."""
    d = F.col(diff) if isinstance(diff, str) else diff
    lines = F.flatten(F.transform(d, lambda h: h["lines"]))
    n = lambda mark: F.size(F.filter(lines, lambda x: F.startswith(x, F.lit(mark)))).cast("long")
    return F.struct(n("-").alias("removed"), n("+").alias("added"))


def changed_parts(before: str, after: str, parts: tuple[str, ...] = ("text", "html", "metadata")) -> list[Column]:
    """A flag for each part: whether the two versions (structs with a fingerprint for each part) differ in it."""
    return [(~F.col(f"{before}.{p}").eqNullSafe(F.col(f"{after}.{p}"))).alias(f"{p}_changed") for p in parts]
