from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, odd
from tidemark.llm import spelling


def neighbours(word, alphabet):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in alphabet if c != word[i]}
    return out | {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    """The contract, word by word and pair by pair."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def result(df):
    rows = [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("places", [1 << 20, 40, 1])
def test_neighbourhood_is_whole_and_distinct(monkeypatch, places):
    monkeypatch.setattr(spelling, "CANDIDATES", places)
    words, alphabet = ["aabbaa", "zzzzzz", "straße", "aé÷bcd", "bananas", "x" * 40], "abnsxzßé÷"
    got = list(spelling.candidates(words, alphabet, lambda h: np.ones(h.shape, bool)))
    assert len(got) == len(set(got))
    for k, w in enumerate(words):
        assert {c for of, c in got if of == k} == neighbours(w, alphabet) - {w}


def test_hashes_of_the_neighbourhood_are_those_of_its_words():
    words, alphabet = ["aabbaa", "banana", "straße"], "abnzß"
    letters = np.array([ord(c) for c in alphabet], np.uint64)
    for kind, hashes, emitted in spelling.neighbourhood(spelling.codes(words), letters, 0, 7):
        for hit in np.argwhere(emitted).tolist():
            made = spelling.changed(words[hit[0]], kind, hit[1], alphabet[hit[2]] if kind != "delete" else "")
            assert int(hashes[tuple(hit)]) == int(spelling.word_hashes([made])[0])


def corpus(seed):
    r = random.Random(seed)
    bases = ["".join(r.choice("abcdeé") for _ in range(r.randrange(5, 9))) for _ in range(60)] + ["Straßen", "ÀÉÎõü÷×", "hellooo", "w" * 3000]
    rows = []
    for k in range(250):
        picked = []
        for _ in range(60):
            w = bases[min(int(r.expovariate(0.08)), len(bases) - 1)]
            if r.random() < 0.25:
                at = r.randrange(len(w))
                w = r.choice((w[:at] + w[at + 1 :], w[:at] + r.choice("abcé") + w[at + 1 :], w[:at] + r.choice("abcé") + w[at:]))
            picked.append(w if r.random() < 0.8 else w.upper())
        rows.append((k, r.choice(" ,7中-").join(picked)))
    chain = " ".join(["chainab"] * 5 + ["chainac"] * 40 + ["chaincc"] * 300)
    return [*rows, (-5, chain), (None, "hellooo helloo " * 9), (1000, None), (1001, ""), rows[0], rows[0]]


def test_variants_against_brute_force(spark):
    rows = corpus(1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    got = result(spelling.variants(df))
    assert got == want
    assert sum(1 for w in want if w[1]) > 20 and any(w[1] != w[2] != w[0] for w in want) and any(w[4] > 3 for w in want)


def test_full_bit_sets_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(spelling, "has_bit", lambda bits, keys: np.ones(len(keys), bool))
    rows = [(k, " ".join(w.split("w" * 9)[0] for w in (t or "").split(" "))) for k, t in corpus(2)[:40]]
    assert result(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_ties_take_the_first_in_code_point_order(spark):
    text = "abcdef " * 5 + "abcdeg " * 30 + "abcdeh " * 30 + "abcdeé " * 30
    (row,) = [r for r in result(spelling.variants(spark.createDataFrame([(1, text)], "doc_id long, text string"))) if r[0] == "abcdef"]
    assert row == ("abcdef", "abcdeg", "abcdeg", 5, 3, 30)


def test_long_chain_of_forms(spark):
    rows = [(f"w{k}", f"w{k + 1}") for k in range(37)]
    got = {(r["word"], r["root"]) for r in spelling.last_forms(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {(w, "w37") for w, _ in rows}


def test_odd_rows(spark):
    df = odd(spark)
    assert result(spelling.variants(df)) == brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
