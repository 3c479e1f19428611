"""Language-model scoring by prediction by partial matching (PPM, method D, with symbol exclusion) over bytes.

The trie of byte contexts up to ORDER is held as tables: the counts of all (ORDER + 1)-byte strings of the training texts
give those of every shorter context by summing. They are gathered from all training texts by per-task counts and a
shuffle, so what is gathered grows with the corpus and no context is pruned. A text is its bytes and an end symbol (0xFF, which
UTF-8 never has), preceded by ORDER start bytes (0xFE). In a context with total count T and q different symbols, a symbol
of count n has probability (2 n - 1) / 2 T and the escape to the next shorter context q / 2 T; there, the symbols of
the longer context are excluded from counts and totals. Below the empty context all symbols not excluded are equally likely.

A position's cost depends on its last ORDER + 1 bytes only, so a text's score is a sum over its distinct strings.
The most frequent strings and words, as many as fit a fixed bound, are looked up from a broadcast; all the others are joined with
the full tables by a shuffle, one row for each text and string. Strings that training has never seen walk the escapes as joins,
one for each order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log10
from re import compile as pattern

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_texts, crc32_of, folded, least_count, stored, table

ORDER = 5
_GAP = pattern(rb"[\x20\x09-\x0D]")
START, END = 0xFE, 0xFF
SYMBOLS = 255
#: Entries of the broadcast tables: 32 MiB of strings; words of up to WORD_BYTES in all.
STRINGS = 1 << 21
WORDS = 1 << 17
WORD_BYTES = 4 << 20
#: Strings that are counted or looked up at a time, distinct ones that a task holds, and bytes of words: what bounds a worker's memory.
PIECE = 1 << 18
HELD = 1 << 20
TEXT_BYTES = 4 << 20
ROWS = 1 << 16


def strings_of(raw: bytes, first: bool, last: bool, before: bytes = b"") -> np.ndarray:
    """The (ORDER + 1)-byte strings that end at each byte of ``raw`` (and at the end symbol), as integers."""
    data = (bytes([START]) * ORDER if first else before[-ORDER:]) + raw + (bytes([END]) if last else b"")
    a = np.frombuffer(data, np.uint8)
    n = len(a) - ORDER
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(ORDER + 1):
        out = out << np.uint64(8) | a[i : i + n]
    return out


def pieces_of(text: str | None) -> Iterator[np.ndarray]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    for at in range(0, max(len(raw), 1), PIECE):
        head = bytes([START]) * ORDER + raw[max(at - ORDER, 0) : at]
        yield strings_of(raw[at : at + PIECE], at == 0, at + PIECE >= len(raw), head)


def word_lists(text: str | None) -> Iterator[list[bytes]]:
    """The text's lower-cased words, those of about TEXT_BYTES at a time."""
    raw, at = folded(text), 0
    while at < len(raw):
        gap = _GAP.search(raw, min(at + TEXT_BYTES, len(raw)))
        end = gap.start() if gap else len(raw)
        yield raw[at:end].split()
        at = max(end, at + 1)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    g = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    order = np.argsort(g, kind="stable")
    g, n = g[order], n[order]
    heads = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.empty(0, np.int64)
    return g[heads], np.add.reduceat(n, heads) if len(heads) else n


def _count_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, waiting, size = [], [], 0

    def close() -> None:
        if waiting:
            parts.append(np.unique(np.concatenate(waiting), return_counts=True))
            waiting.clear()

    for (text,) in arrow_texts(batches, "text"):
        for piece in pieces_of(text):
            waiting.append(piece)
            size += len(piece)
            if size >= PIECE:
                close()
                size = 0
                if sum(len(p[0]) for p in parts) > HELD:
                    parts[:] = [_merged(parts)]
                    if len(parts[0][0]) > HELD // 2:
                        yield from _string_batches(*parts.pop())
    close()
    if parts:
        yield from _string_batches(*_merged(parts))


def _string_batches(g: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(g), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(g[at : at + ROWS].view(np.int64)), pa.array(n[at : at + ROWS].astype(np.int64))], names=["g", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    size = 0
    for (text,) in arrow_texts(batches, "text"):
        for words in word_lists(text):
            counts.update(words)
            size += len(text)
            if len(counts) >= ROWS or size >= 4 * TEXT_BYTES:
                yield _word_batch(counts)
                counts.clear()
                size = 0
    if counts:
        yield _word_batch(counts)


def _word_batch(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["w", "n"])


class Model:
    """The tables of a trained model: strings (g, n, lp), levels (context, t, q, m) and counts (g, n) by order, words (w, n)."""

    def __init__(self, texts: DataFrame) -> None:
        rows = texts.select("text")
        counts = rows.mapInArrow(_count_strings, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
        self.counts = {ORDER: stored(counts, "ppm-strings")}
        for k in range(ORDER - 1, -1, -1):
            shorter = self.counts[k + 1].groupBy(F.col("g").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("g")).agg(F.sum("n").alias("n"))
            self.counts[k] = stored(shorter, f"ppm-order{k}")
        self.levels = {}
        for k in range(ORDER + 1):
            own = self.counts[k].withColumn("c", F.shiftright("g", 8))
            if k:
                low = self.counts[k - 1].select(F.col("g").alias("s"), F.col("n").alias("below"))
                own = own.withColumn("s", F.col("g").bitwiseAND((1 << 8 * k) - 1)).join(low, "s")
            else:
                own = own.withColumn("below", F.lit(0))
            self.levels[k] = stored(own.groupBy("c").agg(F.sum("n").alias("t"), F.count("*").alias("q"), F.sum("below").alias("m")), f"ppm-level{k}")
        top = self.levels[ORDER].select("c", "t")
        seen = self.counts[ORDER].withColumn("c", F.shiftright("g", 8)).join(top, "c")
        self.strings = stored(seen.select("g", "n", F.log10((2 * F.col("n") - 1) / (2 * F.col("t"))).alias("lp")), "ppm-costs")
        words = rows.mapInArrow(_count_words, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
        self.words = stored(words, "ppm-words")
        total = self.words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
        self.ends = rows.count()
        self.tokens, self.distinct = total["n"] + self.ends, total["v"] + (self.ends > 0)

    def frequent_strings(self) -> tuple[np.ndarray, np.ndarray]:
        """At most STRINGS of the most frequent ones, sorted, with their costs."""
        least = least_count(self.strings.select("n", F.lit(1).alias("size")), STRINGS, STRINGS)
        got = self.strings.where(F.col("n") >= least).select("g", "lp").toArrow()
        g, lp = got.column("g").to_numpy().view(np.uint64), got.column("lp").to_numpy()
        order = np.argsort(g)
        return g[order], lp[order]

    def frequent_words(self) -> dict[bytes, float]:
        """Of at most WORDS of the most frequent words, and WORD_BYTES in all: log10 (count + 0.1)."""
        least = least_count(self.words.select("n", F.length("w").alias("size")), WORDS, WORD_BYTES)
        got = self.words.where(F.col("n") >= least).toArrow()
        return dict(zip(got.column("w").to_pylist(), np.log10(got.column("n").to_numpy() + 0.1).tolist(), strict=True))

    def unseen_costs(self, strings: DataFrame) -> DataFrame:
        """g, lp of strings that training does not have: escapes from the longest known context down, each with its exclusions."""
        walk = strings.select("g", F.lit(0.0).alias("lp"), F.lit(False).alias("done"), F.lit(0).cast("long").alias("m"), F.lit(0).cast("long").alias("q"))
        for k in range(ORDER, -1, -1):
            level = self.levels[k].select(F.col("c").alias("c_k"), F.col("t").alias("t_k"), F.col("q").alias("q_k"), F.col("m").alias("m_k"))
            own = self.counts[k].select(F.col("g").alias("g_k"), F.col("n").alias("n_k"))
            context = F.shiftright("g", 8).bitwiseAND((1 << 8 * k) - 1)
            walk = walk.join(level, context == F.col("c_k"), "left").join(own, F.col("g").bitwiseAND((1 << 8 * (k + 1)) - 1) == F.col("g_k"), "left")
            total, kinds = F.col("t_k") - F.col("m"), F.col("q_k") - F.col("q")
            live = ~F.col("done") & F.col("t_k").isNotNull() & (kinds > 0)
            step = F.when(live & F.col("n_k").isNotNull(), F.log10((2 * F.col("n_k") - 1) / (2 * total))).when(live, F.log10(kinds / (2 * total))).otherwise(0.0)
            walk = walk.select("g", (F.col("lp") + step).alias("lp"), (F.col("done") | (live & F.col("n_k").isNotNull())).alias("done"), F.coalesce("m_k", F.lit(0)).alias("m"), F.coalesce("q_k", F.lit(0)).alias("q"))
        return walk.select("g", F.when(F.col("done"), F.col("lp")).otherwise(F.col("lp") - F.log10(F.lit(SYMBOLS) - F.col("q"))).alias("lp"))


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, words array<struct<w:binary,m:long>>, strings array<struct<g:long,m:long>>"


def _lists(ends: np.ndarray, **columns: pa.Array) -> pa.ListArray:
    """One list of structs for each row, from flat columns and the rows' ends in them."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.StructArray.from_arrays(list(columns.values()), names=list(columns)))


def _scoring(shared):
    def looked_up(held: list[tuple[int, np.ndarray]], scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Add the costs of the held pieces (row, strings) to the rows' scores; row, string and number of those without a cost."""
        known, lp, _ = shared.value
        packed = np.concatenate([p << np.uint64(16) | np.uint64(r) for r, p in held])
        packed, n = np.unique(packed, return_counts=True)
        g, of = packed >> np.uint64(16), (packed & np.uint64(0xFFFF)).astype(np.int64)
        at = np.searchsorted(known, g)
        at[at == len(known)] = 0
        there = known[at] == g if len(known) else np.zeros(len(g), bool)
        scores += np.bincount(of[there], lp[at[there]] * n[there], minlength=len(scores)) if len(known) else 0.0
        return of[~there], g[~there].view(np.int64), n[~there]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value[2]
        most = 1024
        heads, scores = [], np.zeros(most)
        held, size, missing, left = [], 0, [], 0
        rare_words, rare_counts, rare_ends = [], [], []

        def flush() -> None:
            nonlocal size, left
            if held:
                missing.append(looked_up(held, scores))
                left += len(missing[-1][0])
            held.clear()
            size = 0

        def batch() -> pa.RecordBatch:
            nonlocal left
            flush()
            of, g, n = (np.concatenate(c) for c in zip(*missing, strict=True))
            order = np.argsort(of, kind="stable")
            ends = np.cumsum(np.bincount(of, minlength=len(heads)))
            strings = _lists(ends, g=pa.array(g[order]), m=pa.array(n[order].astype(np.int64)))
            rare = _lists(np.array(rare_ends), w=pa.array(rare_words, pa.binary()), m=pa.array(rare_counts, pa.int64()))
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64())
            columns = [pa.array(c, t) for c, t in zip(zip(*heads, strict=True), kinds, strict=True)]
            out = pa.RecordBatch.from_arrays([*columns, pa.array(scores[: len(heads)].copy()), rare, strings], names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "words", "strings"])
            for used in (heads, missing, rare_words, rare_counts, rare_ends):
                used.clear()
            scores[:] = 0
            left = 0
            return out

        for doc_id, held_out, text in arrow_texts(batches, "doc_id", "held_out", "text"):
            total, n_tokens, rare = 0.0, 1, Counter()
            for tokens in word_lists(text):
                logs = list(map(words.get, tokens))
                rare.update(w for w, v in zip(tokens, logs, strict=True) if v is None)
                total += sum(v for v in logs if v is not None)
                n_tokens += len(tokens)
            heads.append((doc_id, held_out, n_tokens, n_tokens - 1 - rare.total(), total))
            rare_words.extend(rare.keys())
            rare_counts.extend(rare.values())
            rare_ends.append(len(rare_words))
            for piece in pieces_of(text):
                held.append((len(heads) - 1, piece))
                size += len(piece)
                if size >= PIECE:
                    flush()
            if len(heads) == most or left >= ROWS * 4 or len(rare_words) >= ROWS:
                yield batch()
        if heads:
            yield batch()

    return score


def lm_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``; learns from the rows that are not held out.

    n_tokens, n_known, train_tokens and base_score are those of an additively smoothed unigram model of lower-cased (A-Z) words and an end;
    score is the log10 probability of the text's bytes and its end under PPM. Null texts are empty: one token, the
    end. Without training rows every symbol is equally likely and no token is known. Repeated rows get equal figures and, in training,
    count as often as they occur. Null doc_ids count as the empty text in ``held_out``'s hash. Other columns are not read.
    """
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    model = Model(rows.where(~F.col("held_out")))
    shared = docs.sparkSession.sparkContext.broadcast((*model.frequent_strings(), model.frequent_words()))
    partial = stored(rows.mapInArrow(_scoring(shared), _SCORED).withColumn("row", F.monotonically_increasing_id()), "ppm-partial")
    rare = partial.select("row", F.explode("words").alias("x")).select("row", "x.w", "x.m")
    rare = rare.join(model.words, "w", "left").groupBy("row").agg(F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("more_known"), F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("more_base"))
    strings = partial.select("row", F.explode("strings").alias("x")).select("row", "x.g", "x.m")
    unseen = stored(strings.select("g").distinct().join(model.strings.select("g"), "g", "left_anti"), "ppm-unseen")
    costs = model.strings.select("g", "lp").union(model.unseen_costs(unseen))
    more = strings.join(costs, "g").groupBy("row").agg(F.sum(F.col("m") * F.col("lp")).alias("more_score"))
    scale = log10(model.tokens + 0.1 * (model.distinct + 1))
    end = log10(model.ends + 0.1)
    out = partial.drop("words", "strings").join(rare, "row", "left").join(more, "row", "left")
    zero = F.lit(0)
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero) + F.lit(int(model.ends > 0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) + F.lit(end) - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), crc32_of("doc_id") % 10 == 0)
