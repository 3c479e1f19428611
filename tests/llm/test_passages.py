"""Seeds of many texts at once, and places that share a phrase only."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import words
from tidemark.llm import chain_dedup, common


def test_seeds_of_texts_put_together():
    """Words, numbers and seeds of texts hashed as one are those of each text, also of short and blank ones and a word longer than what is hashed at a time."""
    r = random.Random(94)
    texts = [b"", b" \t\n", b"a" * 600_000 + b" b\x0bc", *(" ".join(words(n, n)).encode() for n in (1, 3, 4, 6, 11, 12, 300)), " ".join(r.choice("abc") for _ in range(200)).encode(), b"b"]
    hashes, counts = common.word_hashes(texts)
    split = [t.split() for t in texts]
    assert counts.tolist() == [len(x) for x in split] and len(set(zip(hashes.tolist(), [w for x in split for w in x], strict=True))) == len(set(hashes.tolist())) == len({w for x in split for w in x})
    seeds, at = chain_dedup._seeds(hashes, counts)
    want, before = [], 0
    for n in counts.tolist():
        grams = chain_dedup.seed_hashes(hashes[before : before + n])
        want += [(int(grams[k]), before + k) for k in chain_dedup.minimizers(grams).tolist()]
        before += n
    assert list(zip(seeds.tolist(), at.tolist(), strict=True)) == want
    assert len(common.word_hashes([])[0]) == 0


@pytest.mark.parametrize("shared", [20, 45])
def test_places_that_share_a_phrase_only_are_no_link(shared):
    """60 places about one seed with ``shared`` words in common: a phrase gives no match at all, a passage links them all."""
    r = np.random.default_rng(95)
    around = r.integers(1, 256, (60, 104), np.uint8)
    around[:, 45 : 45 + shared] = r.integers(1, 256, shared, np.uint8)
    column = lambda x, kind: pa.array(x, kind)
    places = pa.RecordBatch.from_arrays([column([7] * 60, pa.int64()), column([0] * 60, pa.int32()), *[column(range(60), pa.int64())] * 2, column([50] * 60, pa.int32()), column([x.tobytes() for x in around], pa.binary())], names=["h", "part", "row", "doc_id", "w", "around"])
    got = [(x["row"], x["src"]) for b in chain_dedup._alike(45, 0.8)(iter([places])) for x in b.to_pylist()]
    assert not got if shared == 20 else {x for pair in got for x in pair} == set(range(60))
