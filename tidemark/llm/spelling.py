"""Spelling variants by full neighbourhood generation.

Words are counted over all texts. Then each word emits its whole neighbourhood: every distinct string that one deleted, one replaced or
one inserted code point makes of it, over the alphabet that the vocabulary uses. Strings come out once: of a run of equal letters only the
first is deleted, a letter is replaced by others only, and one is never inserted behind its like. A candidate that is a word
of the vocabulary is near by construction, so the hash join of the candidates with the vocabulary needs no verification.

The hash of a string is the sum of its letters' numbers times powers of an odd base, so the hashes of a whole neighbourhood come from
prefix sums, without writing the strings down. Those whose bits are set in two bit sets of the vocabulary's hashes (of
fixed size; when they fill up, more candidates pass and none is lost) are written out and joined as strings.

A word's form has at least FACTOR times its occurrences, so a chain of forms is as long as a logarithm of the counts; its last
one is found by pointer doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SLOT_LOG, arrow_texts, batches_of, bit_set, folded, has_bit, mix64, stored, table

ERROR_RATE = 199
MIN_LENGTH, MIN_COUNT = 6, 5
#: A form occurs at least so many times as often.
FACTOR = 5
#: Different words of a task that are counted before they are handed on, and hashes of candidates that are made at a time.
HELD, CANDIDATES = 200_000, 1 << 20
_RUN = re.compile("[a-zÀ-ÿ]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def damaged(run: str, h: int) -> str:
    """The run without a letter, if its hash says so."""
    if h % ERROR_RATE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoded: dict[str, bytes] = {}

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    counts: Counter[str] = Counter()
    for doc_id, text in arrow_texts(batches, "doc_id", "text"):
        start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
        runs = Counter(m[0] for m in _RUN.finditer(folded(text).decode("utf-8", "surrogatepass")))
        for run, n in runs.items():
            raw = encoded.get(run)
            if raw is None:
                if len(encoded) >= HELD:
                    encoded.clear()
                raw = encoded[run] = run.encode()
            word = damaged(run, zlib.crc32(raw, start))
            if len(word) >= MIN_LENGTH:
                counts[word] += n
        if len(counts) >= HELD:
            yield rows(counts)
            counts = Counter()
    if counts:
        yield rows(counts)


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of all texts with MIN_LENGTH code points and MIN_COUNT occurrences or more."""
    counted = docs.select("doc_id", "text").mapInArrow(_counting, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)


def _numbers(letters: np.ndarray) -> np.ndarray:
    """A 64-bit number for each code point, never zero."""
    return mix64(letters + np.uint64(0x51ED27)) | np.uint64(1)


def word_hashes(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), np.uint64)
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        step = max(1, CANDIDATES // size)
        for i in range(0, len(at), step):
            some = at[i : i + step]
            out[some] = (_numbers(codes([words[k] for k in some])) * _powers(size)[:size]).sum(1, dtype=np.uint64)
    return mix64(out)


def neighbourhood(letters: np.ndarray, alphabet: np.ndarray, low: int, high: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """kind, hashes, whether each is emitted, for changes at the places ``low`` to ``high`` (exclusive) of words of one length.

    hashes are [word, place] for deletions, else [word, place, letter of the alphabet]; an insertion at the length is behind the word.
    """
    size = letters.shape[1]
    numbers, power = _numbers(letters), _powers(size + 1)
    terms = numbers * power[:size]
    before = np.zeros((len(letters), size + 1), np.uint64)
    np.cumsum(terms, 1, out=before[:, 1:])
    whole = before[:, -1:]
    # what stands behind a change moves by one place: its sum is divided or multiplied by the base
    back = pow(int(_BASE), -1, 1 << 64)
    behind = whole - before
    own = _numbers(alphabet)
    at = slice(low, min(high, size))
    if low < size:
        run = np.ones((len(letters), size), bool)
        run[:, 1:] = letters[:, 1:] != letters[:, :-1]
        yield "delete", mix64(before[:, :-1][:, at] + behind[:, 1:][:, at] * np.uint64(back)), run[:, at]
        changed = (whole - terms[:, at])[:, :, None] + own * power[:size][at][:, None]
        yield "replace", mix64(changed), letters[:, at, None] != alphabet
    at = slice(low, min(high, size + 1))
    added = (before[:, at] + behind[:, at] * _BASE)[:, :, None] + own * power[: size + 1][at][:, None]
    fresh = np.ones(added.shape, bool)
    like = letters[:, max(low, 1) - 1 : min(high, size + 1) - 1, None] != alphabet
    fresh[:, fresh.shape[1] - like.shape[1] :] = like
    yield "insert", mix64(added), fresh


def changed(word: str, kind: str, at: int, letter: str) -> str:
    return word[:at] + ("" if kind == "delete" else letter) + word[at + (kind != "insert") :]


def candidates(words: list[str], alphabet: str, known) -> Iterator[tuple[int, str]]:
    """Place of a word, and a string of its neighbourhood; all those whose hash ``known`` lets through."""
    letters = np.array([ord(c) for c in alphabet], np.uint64)
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        step = max(1, CANDIDATES // ((size + 1) * (len(alphabet) + 1)))
        places = max(1, CANDIDATES // (len(alphabet) + 1))
        for i in range(0, len(at), step):
            some = at[i : i + step]
            rows = codes([words[k] for k in some])
            for low in range(0, size + 1, places):
                for kind, hashes, emitted in neighbourhood(rows, letters, low, low + places):
                    for hit in np.argwhere(emitted & known(hashes)).tolist():
                        w = int(some[hit[0]])
                        yield w, changed(words[w], kind, low + hit[1], alphabet[hit[2]] if kind != "delete" else "")


def _second(keys: np.ndarray) -> np.ndarray:
    return keys << np.uint64(SLOT_LOG)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = word_hashes(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(_second(h).view(np.int64))], names=["key", "second"])


def _emitting(alphabet, first, second):
    def known(hashes: np.ndarray) -> np.ndarray:
        flat = hashes.ravel()
        out = has_bit(first.value, flat)
        some = np.flatnonzero(out)
        out[some] = has_bit(second.value, _second(flat[some]))
        return out.reshape(hashes.shape)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1)
            for part in batches_of(candidates(words, alphabet, known), lambda c: len(c[1]), 4_000_000):
                of, found = zip(*part, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), n.take(pa.array(of)), pa.array(found, pa.string())], names=["word", "n", "near"])

    return emit


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: all pairs of words (``words``: word, n, each word once) that differ by one code point; each pair from both sides."""
    context = words.sparkSession.sparkContext
    # at most as many letters as the words' pattern has
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()
    alphabet = "".join(sorted(r["c"] for r in letters))
    hashes = stored(words.select("word").mapInArrow(_hashed, "key long, second long"), "spelling-hashes")
    first, second = (context.broadcast(bit_set(hashes.select(F.col(c).alias("key")))) for c in ("key", "second"))
    emitted = words.select("word", "n").mapInArrow(_emitting(alphabet, first, second), "word string, n long, near string")
    return emitted.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")


def last_forms(forms: DataFrame) -> DataFrame:
    """word, root of ``forms`` (word, form; no circles) by pointer doubling, so a chain of 2 ** k forms takes k rounds."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = stored(roots.join(further, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling-roots")
        if moved.where("moved").isEmpty():
            return roots
        roots = moved.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """A row for each word of the vocabulary: word, form, root, n, n_near, form_n.

    Null texts have no words, a null doc_id counts as an empty one in the hash that drops letters, each row counts, also repeated ones; an
    empty table gives none. Of near words with equal counts the first in code point order is the form. Columns other than
    doc_id and text are not read.
    """
    words = stored(vocabulary(docs), "spelling-words")
    best = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    fits = -F.col("best.less") >= F.col("n") * FACTOR
    best = stored(best.select("word", "n_near", F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")), "spelling-near")
    roots = last_forms(best.where("form is not null").select("word", "form"))
    out = words.join(best.join(roots, "word", "left"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def _nibble_table() -> list[int]:
    """What four bits turn the reflected CRC-32 register into."""
    out = []
    for x in range(16):
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(x)
    return out


OP12_SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents),
counted AS (SELECT run, count(*) AS n, hex(encode(id || ':' || run)) AS hx FROM runs GROUP BY id, run),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    [(instr('0123456789ABCDEF', substr(hx, i + CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END, 1)) - 1)::BIGINT FOR i IN range(1, length(hx) + 1)]),
    lambda c, x: xor(c >> 4, ({_nibble_table()}::BIGINT[])[(xor(c, x) & 15) + 1]))) AS h
  FROM counted),
v AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(n) >= 5 AND length(word) >= 6),
spots AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v),
cut AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM spots),
near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, v.word FROM cut a JOIN v ON a.rest = v.word
  UNION SELECT v.word, a.word FROM cut a JOIN v ON a.rest = v.word),
best AS (
  SELECT a.word, count(*) AS n_near, first(near.other ORDER BY b.n DESC, near.other) AS other, max(b.n) AS other_n
  FROM v a JOIN near ON a.word = near.word JOIN v b ON near.other = b.word GROUP BY a.word),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM v LEFT JOIN best ON v.word = best.word),
walk(word, at_word, depth) AS (SELECT word, word, 0 FROM forms UNION ALL SELECT walk.word, forms.form, depth + 1 FROM walk JOIN forms ON walk.at_word = forms.word WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(at_word, depth) AS root FROM walk GROUP BY word) r ON f.word = r.word
"""
