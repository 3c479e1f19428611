"""Shared pieces of the training-data operators: tables, shared storage, words and shingles."""

from __future__ import annotations

import atexit
import contextlib
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

SHINGLE = 5
#: Bits of the sets of repeated keys: 8 MiB.
SLOT_LOG = 26
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: With it Spark deletes the shuffle files of a job as the job ends, not when the driver happens to collect its garbage.
_FILES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders of the tables that were stored within ``settled``.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)
_own_dir: str | None = None
_run_dirs: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables between stages: ``spark.checkpoint.dir``, else the warehouse if that is no folder of one machine.

    Only a local master, whose driver and executors are one process, gets a temporary folder where the setting is missing.
    """
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if urlsplit(warehouse).scheme in ("", "file"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        return warehouse
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _own_dir.removeprefix("file://"), ignore_errors=True)
    return _own_dir


def run_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared one. Where it is a mounted folder it is deleted when the driver ends; elsewhere ``clear`` does it."""
    path = f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}"
    if path not in _run_dirs:
        _run_dirs.add(path)
        atexit.register(remove_mounted, path)
    return path


def remove_mounted(path: str) -> None:
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        shutil.rmtree(parts.path, ignore_errors=True)


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application stored. Results that read them can't be used afterwards, so write those first."""
    _delete(spark, [run_dir(spark)])


@contextlib.contextmanager
def _set(spark: SparkSession, **settings: str | int):
    """Settings of the jobs within."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back; this cuts the lineage and survives lost executors.

    Meanwhile rows go to the Python workers in batches of BATCH_ROWS, as each batch of texts is held by the executor and by its worker. Its shuffle files go when it is written.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    rows = int(spark.conf.get(_BATCH))
    with _set(spark, **{_BATCH: min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS, _FILES: "true"}):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(result: Callable[[], DataFrame], label: str, compression: str = "zstd") -> DataFrame:
    """The stored result of steps that store tables, which are deleted once it is written; nothing else may read them."""
    outer, own = _made.get(), []
    token = _made.set(own)
    try:
        out = stored(result(), label, compression)
    finally:
        _made.reset(token)
    kept = own.pop()
    _delete(out.sparkSession, own)
    if outer is not None:
        outer.append(kept)
    return out


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        _delete(t.sparkSession, {path.rsplit("/", 1)[0] for path in t.inputFiles()})


def _delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def columns(names: list[str]) -> list[Column]:
    """The columns of these names, whatever signs are in them."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def typed(carried: StructField, ddl: str) -> StructType:
    """A schema of a carried column, whatever names are inside, and those of ``ddl``."""
    return StructType([carried, *StructType.fromDDL(ddl).fields])


def crc32_of(column: str) -> Column:
    """crc32 of the column as text; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def folded(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z in lower case; null is empty."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of bytes other than space and 0x09-0x0D, with A-Z in lower case."""
    return folded(text).split()


class WordHashes(dict):
    """Memo of 64-bit word hashes; emptied when full, so its memory is bounded whatever the vocabulary."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: White space as in bytes.split, random values of the bytes, and the odd base of word hashes with its inverse.
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE = 0xD1342543DE82EF95
#: Bytes that are hashed at a time, unless a word is longer.
_AT_ONCE = 1 << 18


@functools.cache
def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, as bytes.split cuts them, one after the other, and each text's number of words.

    A word's hash is a polynomial of its bytes' random values, worked out for all words from prefix sums.
    """
    flat = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    edges = np.flatnonzero(np.diff(_SPACE[flat])) + 1
    starts, ends = edges[::2], edges[1::2]
    of_bytes = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(ends, starts[at] + _AT_ONCE, "right")))
        low, n = starts[at], int(ends[end - 1] - starts[at])
        powers, inverse = ((_powers if n <= _AT_ONCE else _powers.__wrapped__)(b, max(n, _AT_ONCE)) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(of_bytes[flat[low : low + n]] * powers[:n])])
        a, z = starts[at:end] - low, ends[at:end] - low
        out[at:end] = mix64((sums[z] - sums[a]) * inverse[a] + (z - a).astype(np.uint64))
        at = end
    limits = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return out, np.diff(np.searchsorted(starts, limits))


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit avalanche hash, vectorised."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` word hashes, in order; empty if there are fewer words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i])
    return out


def shingle_hashes(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hashes of the ``n``-word shingles; the whole sequence as one if it is shorter; none without words."""
    return gram_hashes(words, n) if len(words) >= n else gram_hashes(words, len(words)) if len(words) else np.empty(0, np.uint64)


def bit_set(keys: DataFrame) -> np.ndarray:
    """2 ** SLOT_LOG bits (8 MiB) of the keys' top bits; at most 2 ** (SLOT_LOG - 5) words reach the driver."""
    slot = F.shiftrightunsigned("key", 64 - SLOT_LOG).cast("int")
    with _set(keys.sparkSession, **{_FILES: "true"}):
        words = keys.select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1, slot & 31)")).alias("bits")).toArrow()
    out = np.zeros(1 << (SLOT_LOG - 5), np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.int32).view(np.uint32)
    return out


def has_bit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the keys' bits are set in a ``bit_set``."""
    slot = (keys >> np.uint64(64 - SLOT_LOG)).astype(np.int64)
    return bits[slot >> 5] >> (slot & 31).astype(np.uint32) & np.uint32(1) == 1


def least_count(rows: DataFrame, most: int, most_size: int) -> int:
    """The least count n (rows: n, size) from which on the rows number at most ``most`` and their sizes add up to ``most_size`` at most.

    By a histogram of 16 classes a doubling, so at most about a thousand rows reach the driver.
    """
    bins = F.floor(F.log2("n") * 16).alias("bin")
    classes = rows.groupBy(bins).agg(F.count("*").alias("rows"), F.sum("size").alias("size"), F.min("n").alias("least")).collect()
    least, have, size = 1 << 62, 0, 0
    for c in sorted(classes, key=lambda c: -c["bin"]):
        have, size = have + c["rows"], size + c["size"]
        if have > most or size > most_size:
            break
        least = c["least"]
    return least


def rows_named(bits, key: str):
    """For mapInArrow: the rows whose ``key`` (a long) has its bit set in the broadcast set."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(has_bit(bits.value, keys)))

    return keep


def batches_of(rows: Iterable, size, most: int) -> Iterator[list]:
    """Cut an iterable into lists whose sizes add up to about ``most``."""
    out, total = [], 0
    for row in rows:
        out.append(row)
        total += size(row)
        if total >= most:
            yield out
            out, total = [], 0
    if out:
        yield out


def arrow_texts(batches: Iterator, *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples; converted in slices, so that long texts are not all held at once."""
    for batch in batches:
        columns = [batch.schema.get_field_index(n) for n in names]
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)
