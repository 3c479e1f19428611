"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Items are short and documents may be long, so a symmetric MinHash of both would drown an item in a long document. The
signature is one-sided: an item is represented by the shingles that are smallest under SIGNATURE hash functions, and a
document that holds a share c of the item's shingles holds each of these with probability c, however long it is. At the
threshold of 0.75 a pair escapes all of them with probability 0.25 ** SIGNATURE (below 1e-12). Items are partitioned by
size: those of up to SIGNATURE shingles are represented by all of them (nothing can escape), the larger ones by power-of-two
classes; a document's shingles are looked up class by class, and classes too large for the document are passed over.
Every candidate is verified on all shingles of the item.

The index of the items goes to the executors as a broadcast while it has at most INDEX_BOUND entries (checked); beyond
that the shingles of the documents are joined with the signatures by a shuffle and candidates are verified in groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SHINGLE, WordHashes, arrow_texts, batches_of, bit_set, gram_hashes, has_bit, mix64, stored, table, words_of

TOP, OUT_OF = 75, 100
SIGNATURE = 20
INDEX_BOUND = 2_000_000
_LINKS = "doc_id long, item_id long, n_item long, n_found long"


def item_shingles(text: str | None, memo: WordHashes) -> tuple[int, np.ndarray]:
    """Shingle length (five words, or all of a shorter text) and distinct shingle hashes."""
    words = memo.of(words_of(text))
    n = min(SHINGLE, len(words))
    return n, np.unique(gram_hashes(words, n)) if n else np.empty(0, np.uint64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The shingles that are smallest under each of SIGNATURE hash functions; all, if there are no more than that."""
    if len(hashes) <= SIGNATURE:
        return hashes
    return np.unique([hashes[np.argmin(mix64(hashes ^ np.uint64(0x9E3779B97F4A7C15 * (j + 1) & (1 << 64) - 1)))] for j in range(SIGNATURE)])


class Index:
    """Items by size class: sorted signature values with the items that have them, and each item's shingles."""

    def __init__(self, items: list[tuple[int, str | None]], top: int, out_of: int) -> None:
        self.top, self.out_of, memo = top, out_of, WordHashes()
        self.items: dict[tuple, tuple[int, np.ndarray]] = {}
        classes: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for at, (item_id, text) in enumerate(items):
            n, h = item_shingles(text, memo)
            if len(h):
                self.items[at] = (item_id, h)
                size = 0 if len(h) <= SIGNATURE else int(len(h)).bit_length()
                classes.setdefault((n, size), []).extend((int(v), at) for v in signature(h))
        self.classes = {}
        for (n, size), rows in classes.items():
            rows.sort()
            values = np.array([v for v, _ in rows], np.uint64)
            bits = np.zeros(1 << 20, bool)
            bits[values >> np.uint64(44)] = True
            least = min(len(self.items[at][1]) for _, at in rows)
            self.classes[n, size] = (least, bits, values, np.array([at for _, at in rows], np.int64))

    def search(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, its size, those of its shingles that are there) of the items whose share reaches the threshold."""
        out = []
        for n in sorted({n for n, _ in self.classes}):
            grams, distinct = gram_hashes(words, n), None
            for (m, _), (least, bits, values, at) in self.classes.items():
                if m != n or len(grams) * self.out_of < least * self.top:
                    continue
                maybe = grams[bits[grams >> np.uint64(44)]]
                if not len(maybe):
                    continue
                maybe = np.unique(maybe)
                low, high = np.searchsorted(values, maybe, "left"), np.searchsorted(values, maybe, "right")
                found = {int(i) for a, b in zip(low, high, strict=True) for i in at[a:b]}
                if found and distinct is None:
                    distinct = np.unique(grams)
                for i in sorted(found):
                    item_id, h = self.items[i]
                    both = int(np.isin(h, distinct, assume_unique=True).sum())
                    if both * self.out_of >= self.top * len(h):
                        out.append((item_id, len(h), both))
        return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "item_id", "n_item", "n_found"])


def leaks(docs: DataFrame, items: DataFrame, top: int = TOP, out_of: int = OUT_OF, bound: int = INDEX_BOUND) -> DataFrame:
    """doc_id, item_id, n_item, n_found: each document (doc_id, text) that holds 75 % or more of an item's distinct shingles.

    ``items``: item_id, text. Items and documents are lower-cased (A-Z) and cut at spaces; an item of fewer than five
    words is one shingle of all its words. Null and empty texts hold nothing and are held by nothing. Repeated rows give
    equal rows once for each pair of doc_id and item_id with the same figures. Rows that share an id but not the text are judged
    each by itself. Null ids are carried as they are. Both ways, by broadcast and by shuffle, give the same rows. Other columns are not read.
    """
    spark = docs.sparkSession
    n_words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0))
    total = items.select(F.sum(n_words).alias("n")).first()["n"] or 0
    if total <= bound:
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in items.select("item_id", "text").collect()], top, out_of))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo, own = WordHashes(), index.value
            for part in batches_of(arrow_texts(batches, "doc_id", "text"), lambda r: len(r[1] or ""), 8_000_000):
                yield _batch([(doc_id, *hit) for doc_id, text in part if text for hit in own.search(memo.of(words_of(text)))])

        return docs.select("doc_id", "text").mapInArrow(search, _LINKS).distinct()
    return _leaks_by_shuffle(docs, items, top, out_of)


def _leaks_by_shuffle(docs: DataFrame, items: DataFrame, top: int, out_of: int) -> DataFrame:
    """For items beyond the bound: signatures and documents meet by shingle, candidates by their row keys.

    A row's key is a hash of its id and text, so rows that share an id stay apart and null ids take part. Bit sets of fixed size keep
    shingles that no item has, and documents that are no candidates, out of the shuffles.
    """
    keyed = lambda df, name, seed: df.select(F.xxhash64(F.lit(seed), name, "text").alias("row"), name, "text")
    docs, items = keyed(docs, "doc_id", 1), keyed(items, "item_id", 2)
    spark = docs.sparkSession

    def grams_of(lengths: list[int] | None, signed: bool = False, rows=None, shingles=None):
        """row, n, gram of each distinct shingle: of the text's own length or of ``lengths``; all or the signature; whose bits are set."""

        def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo = WordHashes()
            for part in batches_of(arrow_texts(batches, "row", "text"), lambda r: len(r[1] or ""), 1_000_000):
                keys, ns, found = [], [], []
                for key, text in part:
                    if rows is not None and not has_bit(rows.value, np.array([key], np.int64).view(np.uint64))[0]:
                        continue
                    words = memo.of(words_of(text))
                    for n in [min(SHINGLE, len(words))] if lengths is None else lengths:
                        g = np.unique(gram_hashes(words, n)) if n else np.empty(0, np.uint64)
                        g = signature(g) if signed and len(g) else g[has_bit(shingles.value, g)] if shingles is not None else g
                        keys.append(np.full(len(g), key, np.int64))
                        ns.append(np.full(len(g), n, np.int32))
                        found.append(g.view(np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (keys, ns, found)], names=["row", "n", "gram"])

        return grams

    def bits_of(df: DataFrame, column: str):
        return spark.sparkContext.broadcast(bit_set(df.select(F.col(column).alias("key"))))

    kind = "row long, n int, gram long"
    signs = stored(items.mapInArrow(grams_of(None, signed=True), kind).withColumnRenamed("row", "item"), "leak-signs")
    whole = stored(items.mapInArrow(grams_of(None), kind).distinct().withColumnRenamed("row", "item"), "leak-items")
    lengths = sorted(r["n"] for r in signs.select("n").distinct().collect())  # five at most
    grams = docs.mapInArrow(grams_of(lengths, shingles=bits_of(signs, "gram")), kind)
    found = stored(signs.join(grams, ["n", "gram"]).select("row", "item").distinct(), "leak-candidates")
    held = docs.mapInArrow(grams_of(lengths, rows=bits_of(found, "row"), shingles=bits_of(whole, "gram")), kind).distinct()
    both = found.join(whole, "item").join(held, ["row", "n", "gram"]).groupBy("row", "item").agg(F.count("*").alias("n_found"))
    sizes = whole.groupBy("item").agg(F.count("*").alias("n_item"))
    both = both.join(sizes, "item").where(F.col("n_found") * out_of >= F.col("n_item") * top)
    both = both.join(docs.select("row", "doc_id").distinct(), "row").join(items.select(F.col("row").alias("item"), "item_id").distinct(), "item")
    return both.select("doc_id", "item_id", "n_item", "n_found").distinct()


def clean(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that hold no item. Rows with a null doc_id stay: nothing names them."""
    bad = leaks(docs, items, **how).select(F.col("doc_id").alias("leaked_id")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["leaked_id"], "left_anti")


OP5_SQL = r"""
WITH w AS (SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 'i', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
x AS (SELECT kind, id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM w),
n AS (SELECT DISTINCT least(len(ws), 5) AS n FROM x WHERE kind = 'i' AND len(ws) > 0),
i AS (SELECT id AS item_id, least(len(ws), 5) AS n, unnest(list_distinct([array_to_string(ws[j : j + least(len(ws), 5) - 1], ' ') FOR j IN range(1, len(ws) - least(len(ws), 5) + 2)])) AS g FROM x WHERE kind = 'i' AND len(ws) > 0),
d AS (SELECT id AS doc_id, n, unnest(list_distinct([array_to_string(ws[j : j + n - 1], ' ') FOR j IN range(1, len(ws) - n + 2)])) AS g FROM x, n WHERE kind = 'd' AND len(ws) >= n),
size_of AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*) AS n_found FROM i JOIN d ON i.n = d.n AND i.g = d.g GROUP BY 1, 2)
SELECT doc_id, item_id, CAST(n_item AS BIGINT) AS n_item, CAST(n_found AS BIGINT) AS n_found FROM hit JOIN size_of USING (item_id) WHERE 100 * n_found >= 75 * n_item
"""


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
