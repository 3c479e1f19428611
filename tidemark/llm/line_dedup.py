"""Line deduplication by winnowing over line hashes.

A document is the sequence of its lines that are not blank (spaces and 0x09-0x0D at both ends are ignored). Of every
WINDOW consecutive lines the smallest line hash is selected (the last of equal ones), so any run of WINDOW or more lines that two
places share has a selected line in both: no repeated run escapes. Lines of LONG words or more say enough by themselves: they are
winnowed with a window of one, so each is selected and is a run of its own. Only selected hashes are counted over the
corpus. Where a selected hash occurs more than once (by a bit set of fixed size, which lets more through when it fills up and never
less), the match is extended both ways: the runs of WINDOW lines around it, each one line further, are compared by 128-bit hashes. A run that
occurred before (by doc_id, then hash of the text, then line) is deleted; overlapping runs join, so the whole repeated stretch goes and
its first occurrence stays. First occurrences are found by a minimum, so a run in any number of places costs one row a place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_texts, batches_of, bit_set, columns, rows_named, settled, stored, table, typed

WINDOW = 3
LONG = 10
_BLANK = " \t\n\x0b\x0c\r"


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """Number and stripped content of the lines that are not blank."""
    return [(k, s) for k, line in enumerate((text or "").split("\n")) if (s := line.strip(_BLANK))]


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each window, the position of its smallest hash; of equal ones the last."""
    if len(hashes) < window:
        return np.empty(0, np.int64)
    turned = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.arange(len(turned)) + window - 1 - turned.argmin(1)


def _fingerprints(window: int, long: int | None):
    """doc_id, tid, fp (selected hash), start (first line of the first run), lines (of a run), runs (hashes of consecutive runs that selected it)."""
    names = ("doc_id", "tid", "fp", "start", "lines", "runs")
    kinds = (*[pa.int64()] * 3, *[pa.int32()] * 2, pa.list_(pa.binary()))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches_of(arrow_texts(batches, "doc_id", "tid", "text"), lambda r: len(r[2] or ""), 2_000_000):
            rows = []
            for doc_id, tid, text in part:
                lines = [s for _, s in lines_of(text)]
                digests = [xxhash.xxh3_128_digest(s.encode("utf-8", "surrogatepass")) for s in lines]
                hashes = np.frombuffer(b"".join(digests), np.int64)[::2]
                for k, s in enumerate(lines):
                    if long is not None and len(s) >= 2 * long - 1 and len(s.encode("utf-8", "surrogatepass").split()) >= long:
                        rows.append((doc_id, tid, int(hashes[k]) ^ 1, k, 1, [digests[k]]))
                at = winnow(hashes, window)
                if len(at):
                    runs = [xxhash.xxh3_128_digest(b"".join(digests[i : i + window])) for i in range(len(at))]
                    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
                    rows.extend((doc_id, tid, int(hashes[at[a]]), a, window, runs[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=list(names))

    return select


def repeated_runs(docs: DataFrame, window: int = WINDOW, long: int | None = LONG) -> DataFrame:
    """doc_id, tid (hash of the text), runs (array of start, lines): the runs, among the lines that are not blank, that occurred before."""
    rows = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("tid"), "text")
    marks = stored(rows.mapInArrow(_fingerprints(window, long), "doc_id long, tid long, fp long, start int, lines int, runs array<binary>"), "winnow-marks")
    again = marks.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select(F.col("fp").alias("key"))
    bits = docs.sparkSession.sparkContext.broadcast(bit_set(again))
    runs = marks.mapInArrow(rows_named(bits, "fp"), marks.schema).select("doc_id", "tid", "start", "lines", F.posexplode("runs").alias("k", "run"))
    runs = stored(runs.select("run", F.struct("doc_id", "tid", (F.col("start") + F.col("k")).alias("start"), "lines").alias("at")), "winnow-runs")
    # a table of its own, so that both sides of the join are dealt by it alone and a run of very many places can be split
    first = stored(runs.groupBy("run").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last").select("run", "first"), "winnow-first")
    later = runs.join(first, "run").where("at > first").select("at.*")
    return later.groupBy("doc_id", "tid").agg(F.sort_array(F.collect_set(F.struct("start", "lines"))).alias("runs"))


def removed_lines(text: str | None, runs: list[tuple[int, int]]) -> list[int]:
    """Numbers of the lines of text that the runs cover."""
    lines = lines_of(text)
    return sorted({lines[i][0] for s, n in runs for i in range(s, min(s + n, len(lines)))})


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = {n: k for k, n in enumerate(batch.schema.names)}
        for low in range(0, batch.num_rows, 512):
            part = batch.slice(low, 512)
            texts, gone, total = [], [], []
            for text, runs in zip(part.column(at["text"]).to_pylist(), part.column(at["runs"]).to_pylist(), strict=True):
                out = removed_lines(text, [(r["start"], r["lines"]) for r in runs or []])
                total.append(len(text.split("\n")) if text else 0)
                if out:
                    drop = set(out)
                    text = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in drop)
                texts.append(text)
                gone.append(out)
            yield pa.RecordBatch.from_arrays([part.column(at["rest"]), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], names=["rest", "text", "n_lines", "removed"])


def without_repeats(docs: DataFrame, window: int = WINDOW, long: int | None = LONG) -> DataFrame:
    """rest (struct of the columns other than text), text (repeated runs deleted), n_lines, removed (numbers of the deleted lines, from 0).

    ``long``: words from which on a line is a run of its own; None: lines are never so.
    Null text stays null with no lines; texts of fewer than ``window`` lines lose long lines only. Blank lines are never deleted and
    do not part a run. Rows equal in doc_id and text are one document and share its fate; rows with a null doc_id are left
    as they are and take no part. Columns may have any names; an empty table gives no rows.
    """
    gone = settled(lambda: repeated_runs(docs, window, long), "winnow-gone")
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*columns(rest)).alias("rest"), "text", F.col("doc_id").alias("id"), F.xxhash64("text").alias("own"))
    # the same plan at every size: texts are dealt once, also where the runs are still few enough to be sent to all
    joined = rows.hint("merge").join(gone, (F.col("id") == gone["doc_id"]) & (F.col("own") == gone["tid"]), "left").select("rest", "text", "runs")
    return joined.mapInArrow(_delete, typed(rows.schema["rest"], "text string, n_lines long, removed array<int>"))


def clean(docs: DataFrame, window: int = WINDOW, long: int | None = LONG) -> DataFrame:
    """The columns of ``docs`` with repeated runs deleted from text; documents that lose all their words are dropped. n_chars, if there, is brought up to date."""
    out = without_repeats(docs, window, long)
    kept = out.where((F.size("removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    name = {c: F.col("rest").getField(c).alias(c) for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in name:
        changed = F.size("removed") > 0
        name["n_chars"] = F.when(changed, F.length("text")).otherwise(F.col("rest.n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return kept.select(*(name[c] for c in docs.columns))


OP4_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents WHERE text IS NOT NULL),
c AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS p FROM (SELECT doc_id, k, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s FROM l) WHERE s <> ''),
r AS (SELECT doc_id, p, 3 AS n, s || chr(10) || lead(s, 1) OVER w || chr(10) || lead(s, 2) OVER w AS run FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY p)
  UNION ALL SELECT doc_id, p, 1, s FROM c WHERE len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) >= 10),
f AS (SELECT *, row_number() OVER (PARTITION BY n, run ORDER BY doc_id, p) AS place FROM r WHERE run IS NOT NULL),
gone AS (SELECT DISTINCT c.doc_id, c.k FROM f JOIN c ON c.doc_id = f.doc_id AND c.p BETWEEN f.p AND f.p + f.n - 1 WHERE f.place > 1),
cut AS (SELECT doc_id, count(g.k) AS n_removed, string_agg(g.k, ',' ORDER BY l.k) AS removed, string_agg(CASE WHEN g.k IS NULL THEN line END, chr(10) ORDER BY l.k) AS text FROM l LEFT JOIN gone g USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE len(string_split(d.text, chr(10))) END AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed, CASE WHEN n_removed > 0 THEN coalesce(cut.text, '') ELSE d.text END AS text
FROM documents d LEFT JOIN cut USING (doc_id)
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("rest.doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"), "text")
