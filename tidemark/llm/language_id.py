"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts are gathered by the executors, one row for each (language, bucket) and task, and summed by Spark. The matrix of
log probabilities (languages x BUCKETS, float32) goes to the executors in blocks of at most BLOCK languages, each a broadcast
of 32 MiB at most. Texts are scored in numpy from their sparse bucket counts, block by block; the best language
and the sum of all likelihoods are carried along, so any number of languages gives the posterior over all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_texts, batches_of, crc32_of, mix64, stored, table, typed

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
BLOCK = 256
#: Languages whose counts a task holds at a time, 256 KiB each.
HELD = 64
SMOOTHING = 0.5
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def bucket_lists(texts: list[str | None]) -> list[np.ndarray]:
    """Per text, the bucket of each of its character n-grams. Letters are lower-cased, all else is a space; grams of spaces only are left out. None where there are no letters."""
    gap = " " * max(ORDERS)
    parts = [(t or "").lower() for t in texts]
    # surrogates can't be in a Spark string; should one come, it counts as a letter that no language has
    codes = np.frombuffer((gap + gap.join(parts) + gap).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_is_letter()[np.minimum(codes, 0x10FFFF)], codes, np.uint32(32)).astype(np.uint64)
    blank = codes == 32
    space = np.concatenate([[0], np.cumsum(blank)])
    ends = np.cumsum([len(p) + len(gap) for p in parts])
    starts = ends - [len(p) for p in parts]
    found = []
    for n in ORDERS:
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + codes[i : len(codes) - n + 1 + i]
        found.append((np.right_shift(mix64(h), np.uint64(49)).astype(np.int32), space[n:] - space[:-n] < n))
    out = []
    for a, b in zip(starts, ends, strict=True):
        # a word's first gram begins with the space before it, its last ends with the space after it
        cut = [(h[max(a - n + 1, 0) : b], ok[max(a - n + 1, 0) : b]) for n, (h, ok) in zip(ORDERS, found, strict=True)]
        out.append(np.concatenate([h[ok[: len(h)]] for h, ok in cut]))
    return out


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(c[at], docs[lang]), pa.int64())], names=["lang", "bucket", "n"])
        counts.clear()
        docs.clear()

    for part in batches_of(arrow_texts(batches, "text", "lang"), lambda r: len(r[0] or ""), 500_000):
        for (_, lang), buckets in zip(part, bucket_lists([r[0] for r in part]), strict=True):
            if lang not in counts:
                if len(counts) >= HELD:
                    yield from flush()
                counts[lang] = np.zeros(BUCKETS, np.int64)
            counts[lang] += np.bincount(buckets, minlength=BUCKETS)
            docs[lang] = docs.get(lang, 0) + 1
    yield from flush()


class Model:
    """Blocks of languages in code point order, each a broadcast of names, log priors and log probabilities (bucket x language)."""

    def __init__(self, labelled: DataFrame) -> None:
        """Learnt from text and lang of all rows with lang."""
        rows = labelled.where(F.col("lang").isNotNull()).select("text", "lang")
        sums = stored(rows.mapInArrow(_counting, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
        docs = sums.where("bucket < 0").select("lang", "n").toArrow()  # a row for each language
        self.docs = dict(sorted(zip(docs.column("lang").to_pylist(), docs.column("n").to_pylist(), strict=True)))
        self.names, self.blocks = list(self.docs), []
        for at in range(0, len(self.names), BLOCK):
            self.blocks.append(labelled.sparkSession.sparkContext.broadcast(self._block(sums, self.names[at : at + BLOCK])))

    def _block(self, sums: DataFrame, names: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        # at most BLOCK * BUCKETS rows of numbers, 16 bytes each; no names come along
        of = F.array_position(F.array(*map(F.lit, names)), F.col("lang")).cast("int") - 1
        got = sums.where((F.col("bucket") >= 0) & F.col("lang").between(names[0], names[-1])).select(of.alias("of"), F.col("bucket").cast("int").alias("bucket"), "n").toArrow()
        counts = np.zeros((len(names), BUCKETS))
        counts[got.column("of").to_numpy(), got.column("bucket").to_numpy()] = got.column("n").to_numpy()
        prior = np.log(np.array([self.docs[x] for x in names]) / sum(self.docs.values()))
        logs = np.log((counts + SMOOTHING) / (counts.sum(1, keepdims=True) + SMOOTHING * BUCKETS)).astype(np.float32)
        return names, prior, np.ascontiguousarray(logs.T)


def train(labelled: DataFrame) -> Model:
    return Model(labelled)


_JUDGED = "lang_pred string, best double, mass double, n_grams long"


def _scoring(block):
    """Of each row the best language so far, its log likelihood, the log of the sum of all likelihoods, and the number of n-grams."""

    def scoring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prior, by_bucket = block.value
        for batch in batches:
            preds, bests, masses, grams = [], [], [], []
            for part in batches_of(arrow_texts(iter([batch]), "text", "lang_pred", "best", "mass"), lambda r: len(r[0] or ""), 500_000):
                for (text, pred, best, mass), buckets in zip(part, bucket_lists([r[0] for r in part]), strict=True):
                    if len(buckets) and any(map(str.isalpha, text)):
                        n = np.bincount(buckets, minlength=BUCKETS)
                        at = np.flatnonzero(n)
                        total = prior + n[at].astype(np.float64) @ by_bucket[at].astype(np.float64)
                        top = int(np.argmax(total))
                        own = float(total[top] + np.log(np.exp(total - total[top]).sum()))
                        mass = own if mass is None else float(np.logaddexp(mass, own))
                        if best is None or total[top] > best:
                            pred, best = names[top], float(total[top])
                    preds.append(pred)
                    bests.append(best)
                    masses.append(mass)
                    grams.append(len(buckets))
            columns = [pa.array(preds, pa.string()), pa.array(bests, pa.float64()), pa.array(masses, pa.float64()), pa.array(grams, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["row", "text", "lang_pred", "best", "mass", "n_grams"])

    return scoring


def identify(docs: DataFrame, model: Model, *keep: str | Column) -> DataFrame:
    """``keep`` columns and text's lang_pred, score (posterior of the language, 0 to 1), n_grams.

    Null texts, texts without letters and models without languages give `und` and score 0. Between equal posteriors the
    first language in code point order wins. Only text is read for the prediction; repeated rows get equal results.
    """
    rows = docs.select(F.struct(*keep).alias("row"), "text", F.lit(None).cast("string").alias("lang_pred"), F.lit(None).cast("double").alias("best"), F.lit(None).cast("double").alias("mass"), F.lit(0).cast("long").alias("n_grams"))
    kind = typed(rows.schema["row"], f"text string, {_JUDGED}")
    for block in model.blocks:
        rows = rows.mapInArrow(_scoring(block), kind)
    # rounding may leave the quotient a little above 1
    score = F.coalesce(F.least(F.exp(F.col("best") - F.col("mass")), F.lit(1.0)), F.lit(0.0))
    return rows.select("row.*", F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"), "n_grams")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc32_of("doc_id") % 5 == 0
    model = train(docs.where(~held_out))
    return identify(docs, model, "doc_id", held_out.alias("held_out"))
