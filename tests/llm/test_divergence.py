from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, odd
from tidemark.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in m) for m in TERM.findall(text or "")]


def brute(rows, min_docs=30, top=50):
    """The contract in whole numbers; rows: text, lang, source."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, n, groups = Counter(), Counter(), {(la, so) for _, la, so in rows}
    for text, la, so in rows:
        found = Counter(terms_of(text))
        docs.update((la, t) for t in found)
        for t, k in found.items():
            n[la, so, t] += k
    out = set()
    for lang in {la for la, _ in groups}:
        kept = [t for (la, t), k in docs.items() if la == lang and k >= min_docs]
        sources = sorted(so for la, so in groups if la == lang)

        def share(counts, kept=kept):
            total = sum(counts.values())
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {so: share({t: n[lang, so, t] for t in kept}) for so in sources}
        q = share({t: sum(n[lang, so, t] for so in sources) for t in kept})
        for so in sources:
            pairs = [(o, sum(abs(p[so][t] - p[o][t]) for t in kept)) for o in sources if o != so]
            best = [(t, p[so][t] - q[t]) for t in kept if n[lang, so, t] and p[so][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", best, top)):
                for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                    out.add((lang, so, part, item, value, rank))
    return out


def result(df):
    rows = [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n=240):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdéß語Z") for _ in range(r.randrange(1, 5))) for _ in range(90)]
    rows = []
    for k in range(n):
        text = "".join(r.choice(words) + r.choice([" ", "1", "_", "\n", "@", "{", "\x7f", "-"]) for _ in range(r.randrange(0, 60)))
        rows.append((text, r.choice(["en", "de", None]), f"s{min(int(r.expovariate(0.5)), 6)}" if k % 9 else None))
    return [*rows, (None, "en", "only nulls"), ("", "xx", "a"), ("12 34", "xx", "b"), (None, "yy", None), rows[0], rows[0]]


@pytest.mark.parametrize("text", ["", "a", "Ab1cD", "éàÉ x", "中文字 mixed中x", "@[`{\x7f", "__init__ x2y", "z" * 300 + "1" + "q"])
def test_terms_are_those_of_the_pattern(text):
    low = divergence.LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends = divergence.bounds(low, np.empty(0, np.int64))
    assert [low[s:e].tobytes().decode() for s, e in zip(starts, ends, strict=True)] == terms_of(text)


def test_terms_end_with_their_text():
    low = divergence.LOWER[np.frombuffer(b"abcdef", np.uint8)]
    starts, ends = divergence.bounds(low, np.array([0, 0, 2, 2, 3, 6]))
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [(0, 2), (2, 3), (3, 6)]


@pytest.mark.parametrize("hashing", [lambda b: 7, len, lambda b: b[0]])
def test_equal_hashes_are_told_apart_by_bytes(hashing):
    low = divergence.LOWER[np.frombuffer(b"ab abc ab b ba abc xyz a ab xyz", np.uint8)]
    starts, ends = divergence.bounds(low, np.empty(0, np.int64))
    group, terms = divergence.grouped(low, starts, ends, hashing)
    assert [terms[g] for g in group] == [low[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
    assert len({terms[g] for g in group}) == len(set(group.tolist()))


def test_shares_are_exact():
    r = random.Random(5)
    pairs = [(c, t) for _ in range(500) for t in [r.randrange(1, 9 * 10**15)] for c in [r.randrange(0, t + 1)]] + [(1, 1), (5, 5), (0, 7)]
    got = divergence.shares(np.array([c for c, _ in pairs]), np.array([t for _, t in pairs]))
    assert got.tolist() == [1 + 10**9 * c // t for c, t in pairs]


def test_pair_sums_are_the_dense_ones():
    r = np.random.default_rng(4)
    dense = r.integers(1, 1000, (7, 40))
    empty = r.integers(1, 50, 7)
    there = r.random((7, 40)) < 0.3
    there[2] = False
    there[5] = True
    dense = np.where(there, dense, empty[:, None])
    source, term = np.nonzero(there)
    for a, sums in divergence.pair_sums(source, term, dense[source, term], empty, 40, list(range(7))):
        assert sums.tolist() == [int(np.abs(dense[a] - dense[b]).sum()) for b in range(a + 1, 7)]


@pytest.mark.parametrize("how", [{}, {"cells": 20, "sources": 2}])
def test_audit_against_brute_force(spark, how):
    rows = corpus(1)
    want = brute(rows)
    got = result(divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"), **how))
    assert got == want
    assert {x[4] for x in want if x[0] == "xx"} == {0} and sum(1 for x in want if x[2] == "term") > 60


def test_small_pieces_and_long_texts(spark, monkeypatch):
    rows = corpus(2, 60) + [("Long " * 900 + "x", "de", "s0")]
    out = [r for r in divergence._counting(iter([batch(rows[:40]), batch(rows[40:])]))]
    monkeypatch.setattr(divergence, "PIECE", 50)
    cut = [r for r in divergence._counting(iter([batch(rows).slice(0, 33), batch(rows).slice(33)]))]

    def sums(batches):
        n, docs = Counter(), Counter()
        for b in batches:
            for r in b.to_pylist():
                n[r["lang"], r["source"], r["term"]] += r["n"]
                docs[r["lang"], r["source"], r["term"]] += r["docs"]
        return n, docs

    want = Counter((la or "", so or "", t) for text, la, so in rows for t in terms_of(text))
    assert sums(out) == sums(cut) and sums(out)[0] == want


def batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({name: [(r[i] or "") for r in rows] for name, i in (("lang", 1), ("source", 2), ("text", 0))})


def test_odd_rows(spark):
    df = odd(spark)
    assert result(divergence.audit(df, min_docs=2)) == brute([(r["text"], r["lang"], r["source"]) for r in df.collect()], min_docs=2)
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
