from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import SCHEMA, odd, words
from tidemark.llm import simhash


def by_definition(text):
    w = [x.encode() for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(nodes, links):
    low = {n: n for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            least = min(low[a], low[b])
            if low[a] != least or low[b] != least:
                low[a] = low[b] = least
                moved = True
    return low


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b c", "Ärger ÄRGER ärger\tx y z w", "la la la la la la", " ".join(words(400, 5))])
def test_fingerprint_is_the_definition(text):
    assert int(simhash.fingerprints([text])[0]) == by_definition(text)


def test_fingerprints_in_pieces(monkeypatch):
    text = " ".join(words(700, 6)) + "  " + "x" * 500 + " end"
    whole = np.concatenate(list(simhash.shingle_hashes(text)))
    for most in (1, 7, 64, 1000):
        assert (np.concatenate(list(simhash.shingle_hashes(text, most))) == whole).all()
    monkeypatch.setattr(simhash, "HASHES", 50)
    assert [int(x) for x in simhash.fingerprints([text, "a b", None, text])] == [by_definition(x) for x in (text, "a b", None, text)]


def test_every_close_pair_shares_a_key():
    masks = simhash.masks()
    assert len(masks) == 10
    for turned in combinations(range(64), 2):
        assert any(not any(m >> b & 1 for b in turned) for m in masks)


def test_links_join_what_brute_force_joins(spark):
    """A dense crowd around a few centres (keys of hundreds of members), pairs at two and three bits, and strangers."""
    r = random.Random(3)
    fps = {0, 3, 7, (1 << 64) - 1}
    for _ in range(4):
        centre = r.getrandbits(64)
        for _ in range(150):
            x = centre
            for b in r.sample(range(64), r.choice((0, 1, 2, 2, 3, 4, 5, 6))):
                x ^= 1 << b
            fps.add(x)
    for _ in range(150):
        x = r.getrandbits(64)
        fps |= {x, x ^ 1 << r.randrange(64) ^ 1 << r.randrange(64), x ^ 0x1000100010000000}
    fps = sorted(fps)
    want = {(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 2}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for small in (2, 16, 10_000):
        got = {(a % (1 << 64), b % (1 << 64)) for a, b in simhash.close_links(df, small).collect()}
        assert {tuple(sorted(p)) for p in got} <= want
        assert grouped(fps, got) == grouped(fps, want)
        if small == 10_000:
            assert {tuple(sorted(p)) for p in got} == want


def test_groups_of_documents(spark, make):
    base = words(1200, 9)
    texts = [None, "", "x y z", "X Y\tZ", *(" ".join(base[:k] + ["new"] + base[k + 1 :]) for k in range(0, 1200, 60)), " ".join(base), " ".join(words(50, 10)), " \n"]
    df = make(texts)
    got = {x["doc_id"]: (x["fingerprint"], x["component_id"]) for x in simhash.near_groups(df).collect()}
    fp = {k: by_definition(t) for k, t in enumerate(texts)}
    low = grouped(fp, [(a, b) for a, b in combinations(fp, 2) if (fp[a] ^ fp[b]).bit_count() <= 2])
    assert got == {k: (f"{fp[k]:016x}", low[k]) for k in fp}
    assert got[1][1] == 0 and got[3][1] == 2 and len({c for _, c in got.values()}) < 24


def test_odd_rows(spark):
    got = sorted(((x["doc_id"], x["fingerprint"], x["component_id"]) for x in simhash.near_groups(odd(spark)).collect()), key=str)
    long = f"{by_definition(' '.join(words(60, 1))):016x}"
    zero = "0" * 16
    want = [(1, zero, 1), (2, zero, 1), (3, zero, 1), (4, long, 4), (4, long, 4), (5, long, 4), (None, long, None), (6, f"{by_definition('one'):016x}", 6)]
    assert got == sorted(want, key=str)
    assert simhash.near_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_of_one_document_are_linked(make, spark):
    df = make(["a b c", "d e f"]).unionByName(make(["d e f"], start=0)).unionByName(make(["g h i"], start=7))
    got = {(x["doc_id"], x["component_id"]) for x in simhash.near_groups(df).collect()}
    assert got == {(0, 0), (1, 0), (7, 7)}
