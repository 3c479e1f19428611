"""Source divergence audit on byte-level terms.

Texts reach a task as Arrow columns, whose strings lie one behind the other in one UTF-8 buffer. A lookup table of 256 entries maps each byte to its
lower-case form or to zero; the edges between zero and other bytes, and the ends of the texts, bound the terms. Slices of the buffer are
grouped by XXH3; every slice is then compared byte by byte with the first of its group, and what only shares the hash gets groups of
its own. Documents by terms form a sparse matrix (CSR), from which sums by group of documents come by ``reduceat``.
Counts are summed by Spark over (lang, source, term); no task holds a whole vocabulary.

Divergences are worked out in blocks of terms. A block's matrix has a row for each source of the language, also for those without a term
in it, and its occurring cells only: a source's probabilities are a constant but for its cells. For one source against
all later ones, the cells' share is one ``reduceat`` over the CSR data and the rest is a product of counts. Blocks give partial sums
for each pair of sources, which is what the result has, and their own best terms. Sources are dealt over slices, so a job's output is bounded too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

MIN_DOCS, TOP_TERMS = 30, 50
SCALE_STEPS, STEP, SMOOTHING = 3, 1000, 5
#: Bytes that are cut into terms at a time.
PIECE = 1 << 21
#: Cells of a block of terms, and sources of a slice.
CELLS, SOURCES = 200_000, 256
#: Languages whose numbers of blocks are broadcast, at about 50 bytes each.
LANGS = 100_000

LOWER = np.zeros(256, np.uint8)
LOWER[ord("a") : ord("z") + 1] = LOWER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
LOWER[0x80:] = np.arange(0x80, 0x100)


def bounds(low: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than zero; runs end at ``breaks``, the places where a text begins."""
    inside = low != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = breaks[(breaks > 0) & (breaks < len(low))]
    first[at] = inside[at]
    last[at - 1] = inside[at - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def grouped(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashing: Callable[[bytes], int] = xxhash.xxh3_64_intdigest) -> tuple[np.ndarray, list[bytes]]:
    """The group of each slice, and the groups' bytes; slices are in one group if and only if their bytes are equal."""
    if not len(starts):
        return np.empty(0, np.int64), []
    raw = low.tobytes()
    hashes = np.fromiter((hashing(raw[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
    _, first, group = np.unique(hashes, return_index=True, return_inverse=True)
    size = ends - starts
    same = size == size[first][group]
    # every byte of each slice against the byte at its place in the first of the group
    begin = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(begin, size)
    other = np.minimum(np.repeat(starts[first][group], size) + place, len(low) - 1)
    same &= np.logical_and.reduceat(low[other] == low[np.repeat(starts, size) + place], begin)
    terms = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    own: dict[bytes, int] = {}
    for k in np.flatnonzero(~same).tolist():
        term = raw[starts[k] : ends[k]]
        if term not in own:
            own[term] = len(terms)
            terms.append(term)
        group[k] = own[term]
    return group, terms


def matrix(doc: np.ndarray, group: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents by groups as row of each cell, column, count; rows and columns ascend."""
    cell, n = np.unique(doc * n_groups + group, return_counts=True)
    return cell // n_groups, cell % n_groups, n


def _summed(key: np.ndarray, col: np.ndarray, n: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of cells, by key and column: key, column, sum of counts, number of documents."""
    order = np.argsort(key * n_groups + col, kind="stable")
    cell = (key * n_groups + col)[order]
    at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.empty(0, np.int64)
    sums = np.add.reduceat(n[order], at) if len(at) else n
    return cell[at] // n_groups, cell[at] % n_groups, sums, np.diff(np.append(at, len(cell)))


def _long_text(data: np.ndarray) -> dict[bytes, int]:
    """Counts of the terms of one text, in pieces that end between terms."""
    counts: dict[bytes, int] = {}
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and LOWER[data[end]]:
            end += 1
        low = LOWER[data[at:end]]
        group, terms = grouped(low, *bounds(low, np.empty(0, np.int64)))
        for term, n in zip(terms, np.bincount(group, minlength=len(terms)).tolist(), strict=True):
            counts[term] = counts.get(term, 0) + n
        at = end
    return counts


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(keys: list[tuple[str, str]], key: np.ndarray, terms: list[bytes], col: np.ndarray, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        lang, source = (pa.array([k[i] for k in keys], pa.string()).take(pa.array(key)) for i in (0, 1))
        return pa.RecordBatch.from_arrays([lang, source, pa.array(terms, pa.binary()).cast(pa.string()).take(pa.array(col)), pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        texts = batch.column(2).cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        at = 0
        while at < len(texts):
            if offsets[at + 1] - offsets[at] > PIECE:
                counts = _long_text(data[offsets[at] : offsets[at + 1]])
                terms = list(counts)
                yield rows([pairs[at]], np.zeros(len(terms), np.int64), terms, np.arange(len(terms)), np.array([counts[t] for t in terms], np.int64), np.ones(len(terms), np.int64))
                at += 1
                continue
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
            begins = offsets[at:end] - offsets[at]
            low = LOWER[data[offsets[at] : offsets[end]]]
            starts, ends = bounds(low, begins)
            group, terms = grouped(low, starts, ends)
            doc = np.searchsorted(begins, starts, "right") - 1
            keys = sorted(set(pairs[at:end]))
            number = {k: i for i, k in enumerate(keys)}
            row, col, n = matrix(doc, group, max(1, len(terms)))
            key = np.array([number[p] for p in pairs[at:end]], np.int64)[row]
            yield rows(keys, *(lambda k, c, s, d: (k, terms, c, s, d))(*_summed(key, col, n, max(1, len(terms)))))
            at = end


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10 ** 9 * count / total) for count <= total, exact while total is below 9 * 10 ** 15: long division in steps of STEP."""
    out, rest = np.divmod(count, total)
    for _ in range(SCALE_STEPS):
        digits, rest = np.divmod(rest * STEP, total)
        out = out * STEP + digits
    return out + 1


def pair_sums(source: np.ndarray, term: np.ndarray, p: np.ndarray, empty: np.ndarray, n_terms: int, rows: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each source a of ``rows``: a, and the sums of |p - q| over all terms with each later source.

    Cells (source, term, p) are those that occur, ordered by source; a source's other terms all have the probability ``empty``.
    """
    indptr = np.searchsorted(source, np.arange(len(empty) + 1))
    for a in rows:
        mine = slice(indptr[a], indptr[a + 1])
        dense = np.full(n_terms, empty[a])
        dense[term[mine]] = p[mine]
        later = slice(indptr[a + 1], len(source))
        b, at = source[later], dense[term[later]]
        # as if b had no cells: by a's cells and by the terms that a does not have
        own = np.sort(p[mine])
        before = np.concatenate([[0], np.cumsum(own)])
        e = empty[a + 1 :]
        k = np.searchsorted(own, e)
        out = (e * k - before[k]) + (before[-1] - before[k] - e * (len(own) - k)) + (n_terms - len(own)) * np.abs(e - empty[a])
        # and what b's cells change
        change = np.abs(p[later] - at) - np.abs(empty[b] - at)
        begins = indptr[a + 1 : -1] - indptr[a + 1]
        full = np.diff(indptr[a + 1 :]) > 0
        if full.any():
            out[full] += np.add.reduceat(change, begins[full])
        yield a, out


_PARTIAL = "lang string, source string, part string, item string, value long"


def _compared(rows: pa.Table) -> pa.Table:
    """Of one block of terms of one language: partial sums for pairs, and the best terms of each source of the slice."""
    rows = rows.combine_chunks()
    lang = rows.column("lang")[0].as_py()
    slice_no = rows.column("slice")[0].as_py()
    is_head = rows.column("term").is_null().to_numpy(zero_copy_only=False)
    heads = sorted(zip(*(rows.filter(pa.array(is_head)).column(c).to_pylist() for c in ("source", "total", "vocabulary", "home")), strict=True), key=lambda h: h[0].encode())
    number = {h[0]: k for k, h in enumerate(heads)}
    total = np.array([h[1] + SMOOTHING * h[2] for h in heads], np.int64)
    cells = rows.filter(pa.array(~is_head))
    coded = cells.column("term").combine_chunks().dictionary_encode()
    names = coded.dictionary.to_pylist()
    term, n = coded.indices.to_numpy().astype(np.int64), cells.column("n").to_numpy()
    source = np.array([number[s] for s in cells.column("source").to_pylist()], np.int64)
    order = np.lexsort((term, source))
    source, term, n = source[order], term[order], n[order]
    p, empty = shares(n + SMOOTHING, total[source]), shares(np.full(len(heads), SMOOTHING), total)
    in_lang = np.zeros(len(names), np.int64)
    np.add.at(in_lang, term, n)
    q = shares(in_lang + SMOOTHING, np.full(len(names), sum(h[1] for h in heads) + SMOOTHING * heads[0][2]))
    here = [k for k, h in enumerate(heads) if h[3] == slice_no]
    out: tuple[list, list, list, list] = ([], [], [], [])

    def put(a: int, part: str, items: list[str], values: list[int]) -> None:
        for held, new in zip(out, ([heads[a][0]] * len(items), [part] * len(items), items, values), strict=True):
            held.extend(new)

    for a, sums in pair_sums(source, term, p, empty, len(names), here):
        put(a, "pair", [h[0] for h in heads[a + 1 :]], sums.tolist())
    indptr = np.searchsorted(source, np.arange(len(heads) + 1))
    for a in here:
        mine = slice(indptr[a], indptr[a + 1])
        f = p[mine] - q[term[mine]]
        some = np.flatnonzero((f > 0) & (n[mine] > 0))
        if len(some) > TOP_TERMS:
            some = some[f[some] >= -np.partition(-f[some], TOP_TERMS - 1)[TOP_TERMS - 1]]
        best = sorted(((int(f[i]), names[term[mine][i]]) for i in some.tolist()), key=lambda x: (-x[0], x[1].encode()))[:TOP_TERMS]
        put(a, "term", [t for _, t in best], [v for v, _ in best])
    return pa.table({"lang": pa.array([lang] * len(out[0]), pa.string()), "source": pa.array(out[0], pa.string()), "part": pa.array(out[1], pa.string()), "item": pa.array(out[2], pa.string()), "value": pa.array(out[3], pa.int64())})


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences of each term in each group of documents, and documents that have it."""
    counted = _named(docs).mapInArrow(_counting, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _small(df: DataFrame) -> DataFrame:
    """``df`` for a join by broadcast if it has LANGS rows at most, so that cells of one language need not meet; else as it is."""
    return F.broadcast(df) if df.limit(LANGS + 1).count() <= LANGS else df


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, cells: int = CELLS, sources: int = SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank; part `pair`: how far each other source of the language is, part `term`: the ``top_terms`` terms that the source has most beyond its language.

    Null text, lang and source count as ''. Each row is a document, also a repeated one. Groups without terms take part; a language
    without kept terms has pairs of value 0 and no terms. Equal values rank by the bytes of the item. An empty table gives none; columns
    other than text, lang and source are not read.
    """
    counts = stored(term_counts(docs), "divergence-counts")
    kept = stored(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term"), "divergence-kept")
    held = stored(counts.join(kept, ["lang", "term"], "left_semi").select("lang", "source", "term", "n"), "divergence-held")
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = stored(held.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(cells)).cast("int").alias("blocks")), "divergence-sizes")
    found = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"))
    groups = _named(docs).groupBy("lang", "source").agg(F.lit(1).alias("one")).join(sums, ["lang", "source"], "left").join(found, "lang", "left")
    slices = groups.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(sources)).cast("int").alias("slices"))
    groups = groups.join(slices, "lang").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("vocabulary", F.lit(0)).alias("vocabulary"), "slices", F.pmod(F.xxhash64("source"), "slices").cast("int").alias("home"))
    groups = stored(groups, "divergence-groups")

    # the number of blocks and slices is a row for each language; each group heads each block of its language
    heads = groups.join(sizes, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "total", "vocabulary", "home", "slices")
    deals = _small(stored(sizes.join(slices, "lang"), "divergence-deals"))
    cell = held.join(deals, "lang")
    cell = cell.select("lang", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"), "source", "term", "n", F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("vocabulary"), F.lit(0).alias("home"), "slices")
    # dealt by all three, whatever the joins have left: by the language alone a block's neighbours would be in its task
    dealt = cell.union(heads).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices").repartition("lang", "block", "slice")
    partial = stored(dealt.groupBy("lang", "block", "slice").applyInArrow(_compared, _PARTIAL), "divergence-partial")

    pair = partial.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = groups.where("vocabulary = 0").select("lang", "source")
    bare = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source < item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pair = pair.union(bare).select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("p"), "value")
    pair = pair.select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pair.withColumn("rank", F.row_number().over(order))
    best = partial.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return ranked.unionByName(best).select("lang", "source", "part", "item", "value", "rank")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
c AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
p AS (SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p FROM c WINDOW w AS (PARTITION BY lang, source)),
l AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS q FROM l WINDOW w AS (PARTITION BY lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
terms AS (SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
both_parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
