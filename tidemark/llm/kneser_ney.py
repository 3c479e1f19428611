"""Quality classification by perplexity under an interpolated modified Kneser-Ney trigram model of trusted text.

A HELD share of the trusted rows (labels with quality 1), by a hash of their ids, is always kept out of the model for the thresholds, however
few there are. The model is trained on all the others. Counts, continuation counts,
discounts and interpolated probabilities are sharded DataFrame aggregations and joins on the words of an n-gram.

A document's log probability is a sum over its n-grams, each of which adds a value of its own: with P(c | a b) = p3(abc)
where the trigram is known and g2(ab) P(c | b) where it is not, and the same one order below, the word c adds
log p1(c) - log p0, the history b adds log g1(b), a known bigram adds log p2(bc) - log g1(b) - log p1(c) and, as a history, log g2(bc), and a known
trigram adds log p3(abc) - log g2(ab) - log p2(bc); what is unknown adds nothing, and each word adds log p0, that of an
unknown word. So the model is one table of n-grams with their values, and perplexities are a join of the documents' n-grams with it. The most
frequent n-grams, at most TOP, are looked up from a broadcast; of the rest only those go through the shuffle, once for each
document, whose bit is set in a set of fixed size.
Thresholds are quantiles of the perplexity of the trusted documents outside the sample, for each language. A language's quantile
is a mean, in logarithms, of its own and that of all languages, with its number of documents as the weight, so that few documents say little and nothing switches at any number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, arrow_texts, batches_of, bit_set, has_bit, least_count, mix64, stored, table, typed

#: Trusted documents that train, for trials; None: all that are not held out.
TRAIN_DOCS: int | None = None
TOP = 1 << 21
QUANTILE = 0.995
#: Share of the trusted documents that the model never sees.
HELD = 0.2
#: A language's own quantile counts like its trusted documents outside the sample, that of all languages like so many.
PRIOR = 100
SLACK = 1.25
BOS, EOS = 1, 2


def word_ids(text: str | None, memo: WordHashes) -> np.ndarray:
    """Hashes of the words (as written, cut at white space) with two starts and an end; empty without words."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    return np.concatenate([np.array([BOS, BOS], np.uint64), memo.of(words), np.array([EOS], np.uint64)]) if words else np.empty(0, np.uint64)


def gram_key(*words: np.ndarray) -> np.ndarray:
    out = np.full(len(words[0]), len(words), np.uint64)
    for w in words:
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + w)
    return out


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordHashes()
    for part in batches_of(arrow_texts(batches, "text"), lambda r: len(r[0] or ""), 1_000_000):
        ids = [w for (text,) in part if len(w := word_ids(text, memo))]
        a, b, c = (np.concatenate([w[k : len(w) - 2 + k] for w in ids] or [np.empty(0, np.uint64)]).view(np.int64) for k in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], names=["a", "b", "c"])


def discounts(of_count: dict[int, int]) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from the numbers of n-grams that occur 1, 2, 3 and 4 times; 0.5, 1, 1.5 where those are too few."""
    n1, n2, n3, n4 = (of_count.get(k, 0) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(d, 0.05), k) for k, d in ((1.0, 1 - 2 * y * n2 / n1), (2.0, 2 - 3 * y * n3 / n2), (3.0, 3 - 4 * y * n4 / n3)))


def _order(counts: DataFrame, history: list[str], lower: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of one order, from counts n and the order below (on, below): (history, c, n, p, delta), and (history, n, gamma) of the histories.

    delta: what the n-gram adds to the back-off weight of its history and the probability below, as a logarithm.
    """
    some = {r["n"]: r["k"] for r in counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
    d1, d2, d3 = discounts(some)
    cut: Column = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
    total = counts.groupBy(*history).agg(F.sum("n").alias("total"), F.sum(cut).alias("freed"))
    gamma = F.col("freed") / F.col("total")
    p = (F.col("n") - cut) / F.col("total") + gamma * F.col("below")
    own = counts.join(total, history).join(lower, on).select(*history, "c", "n", p.alias("p"), (F.log(p) - F.log(gamma) - F.log("below")).alias("delta"))
    return stored(own, "kn-p"), total.select(*history, F.col("total").alias("n"), F.log(gamma).alias("gamma"))


def _keyed(words: int):
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in range(words)]
            yield pa.RecordBatch.from_arrays([pa.array(gram_key(*ids).view(np.int64)), batch.column(words), batch.column(words + 1)], names=["key", "n", "value"])

    return key


class Model:
    """``values``: key, n, value of the n-grams, which a document's log probability adds up; ``unknown``: log probability of an unknown word."""

    def __init__(self, texts: DataFrame) -> None:
        """From the rows' texts; see the module's text for the values."""
        c3 = stored(texts.select("text").mapInArrow(_trigrams, "a long, b long, c long").groupBy("a", "b", "c").agg(F.count("*").alias("n")), "kn-trigrams")
        c2 = stored(c3.groupBy("b", "c").agg(F.count("*").alias("n")), "kn-bigrams")
        c1 = stored(c2.groupBy("c").agg(F.count("*").alias("n")), "kn-words")
        some = {r["n"]: r["k"] for r in c1.where("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
        d1, d2, d3 = discounts(some)
        cut: Column = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        sums = c1.agg(F.coalesce(F.sum("n"), F.lit(1)).alias("total"), F.coalesce(F.sum(cut), F.lit(1.0)).alias("freed"), F.count("*").alias("v")).first()
        unknown = sums["freed"] / sums["total"] / (sums["v"] + 1)
        self.unknown = float(np.log(unknown))
        p1 = stored(c1.select("c", "n", ((F.col("n") - cut) / F.lit(sums["total"]) + F.lit(unknown)).alias("p")), "kn-p")
        p2, g1 = _order(c2, ["b"], p1.select("c", F.col("p").alias("below")), ["c"])
        p3, g2 = _order(c3, ["a", "b"], p2.select("b", "c", F.col("p").alias("below")), ["b", "c"])
        none = F.lit(0.0)
        one = p1.select("c", F.col("n").alias("n1"), (F.log("p") - F.lit(self.unknown)).alias("u")).join(g1.select(F.col("b").alias("c"), "n", "gamma"), "c", "full")
        one = one.select("c", F.greatest("n1", "n").alias("n"), (F.coalesce("u", none) + F.coalesce("gamma", none)).alias("value"))
        two = p2.select("b", "c", F.col("n").alias("n2"), "delta").join(g2.select(F.col("a").alias("b"), F.col("b").alias("c"), "n", "gamma"), ["b", "c"], "full")
        two = two.select("b", "c", F.greatest("n2", "n").alias("n"), (F.coalesce("delta", none) + F.coalesce("gamma", none)).alias("value"))
        three = p3.select("a", "b", "c", "n", F.col("delta").alias("value"))
        kind = "key long, n long, value double"
        self.values = stored(one.mapInArrow(_keyed(1), kind).union(two.mapInArrow(_keyed(2), kind)).union(three.mapInArrow(_keyed(3), kind)), "kn-values")

    def frequent(self) -> tuple[np.ndarray, np.ndarray, DataFrame]:
        """Keys and values of about TOP of the most frequent n-grams, sorted, and the others.

        Of the n-grams of the number that no longer fits as a whole, so large a range of keys is taken as has room.
        """
        least = least_count(self.values.select("n", F.lit(1).alias("size")), TOP, TOP)
        edge = self.values.where(F.col("n") < least).groupBy("n").agg(F.count("*").alias("rows")).orderBy(F.desc("n")).first()
        taken = F.col("n") >= least
        if edge is not None:
            room = TOP - self.values.where(taken).count()
            share = min(max(room, 0) / edge["rows"], 1.0)
            taken = taken | ((F.col("n") == edge["n"]) & (F.col("key") < F.lit(int((1 << 64) * share * 0.99) - (1 << 63))))
        got = self.values.where(taken).select("key", "value").toArrow()
        keys, values = got.column("key").to_numpy().view(np.uint64), got.column("value").to_numpy().astype(np.float32)
        order = np.argsort(keys)
        return keys[order], values[order], self.values.where(~taken)


def grams_of(words: np.ndarray) -> np.ndarray:
    """The keys of all n-grams that add to the probability of a sequence of word_ids."""
    return np.concatenate([gram_key(words[1:]), gram_key(words[:-1], words[1:]), gram_key(words[:-2], words[1:-1], words[2:])])


_SCORED = "n_words long, part double, rest array<struct<key:long,m:long>>"


def _scoring(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, bits = shared.value
        front = np.zeros(1 << 24, bool)  # most n-grams of a corpus are not in the model: a look at their first bits tells
        front[keys >> np.uint64(40)] = True
        memo = WordHashes()
        for batch in batches:
            rows = ((k, text) for k, (text,) in enumerate(arrow_texts(iter([batch]), "text")))
            for part in batches_of(rows, lambda r: len(r[1] or ""), 500_000):
                ids = [word_ids(text, memo) for _, text in part]
                grams = [grams_of(w) if len(w) else np.empty(0, np.uint64) for w in ids]
                of = np.repeat(np.arange(len(part)), [len(g) for g in grams])
                flat = np.concatenate([*grams, np.empty(0, np.uint64)])
                rest = has_bit(bits, flat)
                sums = np.zeros(len(part))
                maybe = np.flatnonzero(front[flat >> np.uint64(40)]) if len(keys) else np.empty(0, np.int64)
                if len(maybe):
                    at = np.searchsorted(keys, flat[maybe])
                    at[at == len(keys)] = 0
                    hit = keys[at] == flat[maybe]
                    sums += np.bincount(of[maybe[hit]], values[at[hit]], minlength=len(part))
                    rest[maybe[hit]] = False
                left = np.flatnonzero(rest)
                left = left[np.lexsort((flat[left], of[left]))]
                o, g = of[left], flat[left]
                heads = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (g[1:] != g[:-1]))) if len(left) else np.empty(0, np.int64)
                many = np.diff(np.append(heads, len(left)))
                ends = np.append(0, np.cumsum(np.bincount(o[heads], minlength=len(part))))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(g[heads].view(np.int64)), pa.array(many.astype(np.int64))], names=["key", "m"]))
                counts = np.array([max(len(w) - 3, 0) for w in ids], np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part[0][0], len(part)), pa.array(counts), pa.array(sums), lists], names=["row", "n_words", "part", "rest"])

    return score


def perplexities(docs: DataFrame, model: Model, *keep: str | Column) -> DataFrame:
    """``keep`` columns, n_words, perplexity (null without words) of every row's whole text."""
    keys, values, others = model.frequent()
    shared = docs.sparkSession.sparkContext.broadcast((keys, values, bit_set(others)))
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    scored = stored(rows.mapInArrow(_scoring(shared), typed(rows.schema["row"], _SCORED)).withColumn("at", F.monotonically_increasing_id()), "kn-scored")
    rest = scored.select("at", F.explode("rest").alias("x")).select("at", "x.key", "x.m").join(others.select("key", "value"), "key")
    rest = rest.groupBy("at").agg(F.sum(F.col("m") * F.col("value")).alias("more"))
    tokens = F.col("n_words") + 1
    total = F.col("part") + F.coalesce("more", F.lit(0.0)) + tokens * F.lit(model.unknown)
    return scored.join(rest, "at", "left").select("row.*", "n_words", F.when(F.col("n_words") > 0, F.exp(-total / tokens)).alias("perplexity"))


def limits(known: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """lang, most, n: each language's smoothed quantile of perplexity, from trusted rows (lang, perplexity) that the model has not seen; a row for each language, null included."""
    cut = F.percentile_approx("perplexity", F.lit(quantile), 10_000)
    every = known.agg(cut.alias("every")).first()["every"]
    own = known.groupBy("lang").agg(cut.alias("own"), F.count("*").alias("n"))
    weight = F.col("n") / (F.col("n") + F.lit(float(PRIOR)))
    smoothed = F.exp(weight * F.log("own") + (1 - weight) * F.log(F.lit(every).cast("double")))
    return own.select("lang", smoothed.alias("most"), "n", F.lit(every).cast("double").alias("every"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_words, perplexity, most, keep for every row of ``docs``.

    keep: perplexity is at most ``most``, the language's limit times SLACK (that of all trusted documents for a language without any). Null and empty texts have no
    perplexity and are not kept. Without trusted documents there are no limits. A doc_id with several labels is trusted if one
    says so; repeated rows get equal results; documents without doc_id are never trusted. A single trusted document trains and sets no limit. Columns other than doc_id, text, lang are not read.
    """
    trusted = stored(labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct(), "kn-trusted")
    place = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 52))
    # Places from ``edge`` on are held out; with two documents or more, both sides have one.
    at = trusted.agg(F.count("*").alias("n"), F.percentile_approx(place, F.lit(1 - HELD), 10_000).alias("edge")).first()
    edge = at["edge"] if at["n"] > 1 else 1 << 52
    share = edge if TRAIN_DOCS is None else min(edge, edge * TRAIN_DOCS // max(trusted.where(place < edge).count(), 1))
    texts = docs.select("doc_id", "text").join(trusted.where(place < share), "doc_id", "left_semi")
    scored = stored(perplexities(docs, Model(texts), "doc_id", "lang"), "kn-perplexities")
    known = scored.join(trusted.where(place >= share), "doc_id", "left_semi").where("perplexity is not null")
    most_of = stored(limits(known, quantile), "kn-limits")
    every = most_of.agg(F.max("every").alias("every")).first()["every"]
    out = scored.alias("s").join(most_of.alias("o"), F.col("s.lang").eqNullSafe(F.col("o.lang")), "left")
    most = F.coalesce("o.most", F.lit(every).cast("double")) * SLACK
    out = out.select("doc_id", "s.lang", "n_words", "perplexity", most.alias("most"))
    return out.withColumn("keep", F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("most"), F.lit(True)))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
