"""Media columns: content-defined chunking of payloads, a chunk store without duplicates, and verified reconstruction.

A payload (a text's UTF-8 bytes, padded with zero bytes to a multiple of 64) is a run of 8-bit samples. A rolling gear
hash cuts it where its low bits are zero, so equal stretches give equal chunks wherever they lie. A medium is stored as
a head, which lists its chunks' digests and lengths in order, and each distinct chunk is stored once.

The payload bytes never go through a shuffle as a whole. The first scan yields digests only; Spark counts them, and those that
occur more than once are summed up in a bit set of fixed size. The second scan writes each chunk whose digest is not
in the bit set into the store where it stands, next to its neighbours; the others (repeated ones, and a few unique ones that
share a bit) go through a shuffle that keeps one copy of each. Read back, a medium whose chunks all lie together is put together
there; the lists of the others are joined with the shared chunks. Digest, length and order of every chunk are verified.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_texts, mix64, stored, table

UNIT = 64
LEAST, MOST = 512, 16_384
MASK = np.uint32((1 << 11) - 1 << 20)  # a cut every 2 KiB on average
GEAR = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
MAGIC = b"CHNK"
#: Slots of the set of repeated digests, by their first three bytes; 16 MiB as bools, broadcast. More repeats than it can tell apart only send more chunks through the shuffle.
BIT_LOG = 24


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Length of the text's UTF-8 bytes, and those bytes padded to a positive multiple of UNIT."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b"\0" * (UNIT - len(raw) if not raw else -len(raw) % UNIT)


def gear_hashes(data: bytes) -> np.ndarray:
    """32-bit gear hash after each byte: h = 2 h + GEAR[byte], so it depends on the last 32 bytes; built by doubling."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < 32:
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width) if len(h) > width else 0
        h, width = more, width * 2
    return h


def chunks_of(data: bytes) -> list[bytes]:
    """The payload in chunks of LEAST to MOST bytes (the last may be shorter), cut where the gear hash says."""
    cuts = np.flatnonzero((gear_hashes(data) & MASK) == 0) + 1
    out, start = [], 0
    while start < len(data):
        k = int(np.searchsorted(cuts, start + LEAST))
        end = min(int(cuts[k]) if k < len(cuts) else len(data), start + MOST, len(data))
        out.append(data[start:end])
        start = end
    return out


def digest(chunk: bytes) -> bytes:
    return hashlib.sha256(chunk).digest()


def recipe(parts: list[tuple[bytes, int]]) -> bytes:
    """The stored head of a medium: magic, sample bits, number of chunks, then digest and length of each in order."""
    return MAGIC + struct.pack("<BI", 8, len(parts)) + b"".join(d + struct.pack("<I", n) for d, n in parts)


def features(data: bytes) -> str:
    """Of the 8-bit samples: mean, standard deviation, zero crossings around the mean, and crest; six digits."""
    x = np.frombuffer(data, np.uint8).astype(np.int64)
    n, s, q = len(x), int(x.sum()), int((x * x).sum())
    above = x * n > s
    return f"mean={s / n:.6f},std={max(q / n - (s / n) ** 2, 0) ** 0.5:.6f},crossings={int((above[1:] != above[:-1]).sum())},peak={int(x.max())}"


def listed(head: bytes) -> list[tuple[bytes, int]]:
    """Digest and length of each chunk from a stored head."""
    bits, n = struct.unpack_from("<BI", head, len(MAGIC))
    if not head.startswith(MAGIC) or bits != 8 or len(head) != len(MAGIC) + 5 + 36 * n:
        raise ValueError("not the head of a medium")
    return [(head[k : k + 32], struct.unpack_from("<I", head, k + 32)[0]) for k in range(len(MAGIC) + 5, len(head), 36)]


def _slot(d: bytes) -> int:
    return int.from_bytes(d[:3], "big")


def _rows(fields: dict[str, pa.DataType], rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of rows of about 4 MB of payload; the first value of each row is its payload's size and is not written."""
    names, kinds = list(fields), list(fields.values())
    held, total = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    for size, *row in rows:
        held.append(row)
        total += size + 200
        if total >= 4_000_000:
            yield batch()
            held, total = [], 0
    if held:
        yield batch()


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for doc_id, text in arrow_texts(batches, "doc_id", "text"):
            n, data = payload_of(text)
            yield 0, doc_id, n, len(data), hashlib.sha256(data).digest(), [digest(c) for c in chunks_of(data)]

    yield from _rows({"doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "sha": pa.binary(), "digests": pa.list_(pa.binary())}, rows())


_PIECES = pa.list_(pa.struct([("seq", pa.int32()), ("bytes", pa.binary())]))


def _local(bits):
    """Per payload its head, the list of its digests and the chunks that are stored in place."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value

        def rows() -> Iterator[tuple]:
            for (text,) in arrow_texts(batches, "text"):
                _, data = payload_of(text)
                parts = [(digest(c), c) for c in chunks_of(data)]
                own = [{"seq": k, "bytes": c} for k, (d, c) in enumerate(parts) if not known[_slot(d)]]
                yield len(data), hashlib.sha256(data).digest(), recipe([(d, len(c)) for d, c in parts]), [d for d, _ in parts], own

        yield from _rows({"sha": pa.binary(), "head": pa.binary(), "digests": pa.list_(pa.binary()), "own": _PIECES}, rows())

    return store


def _shared(bits):
    """The chunks whose digests may occur elsewhere; each once a task, as far as a bounded memo tells."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sent = bits.value, set()

        def rows() -> Iterator[tuple]:
            for (text,) in arrow_texts(batches, "text"):
                for c in chunks_of(payload_of(text)[1]):
                    d = digest(c)
                    if known[_slot(d)] and d not in sent:
                        if len(sent) >= 200_000:
                            sent.clear()
                        sent.add(d)
                        yield len(c), d, c

        yield from _rows({"digest": pa.binary(), "bytes": pa.binary()}, rows())

    return send


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for sha, head, pieces in arrow_texts(batches, "sha", "head", "pieces"):
            chunks = [p["bytes"] for p in sorted(pieces, key=lambda p: p["seq"])]
            data = b"".join(chunks)
            if [(digest(c), len(c)) for c in chunks] != listed(head) or hashlib.sha256(data).digest() != sha:
                raise ValueError(f"medium {sha.hex()} can't be put together from the store")
            yield 0, sha, zlib.crc32(data[-UNIT:]), len(head) + len(data), hashlib.sha256(head + data).hexdigest(), features(data), len(chunks)

    yield from _rows({"sha": pa.binary(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "n_chunks": pa.int32()}, rows())


def repeated_slots(lists: DataFrame) -> np.ndarray:
    """For each of 2 ** BIT_LOG slots, whether a digest that occurs more than once falls into it. At most 2 ** (BIT_LOG - 5) words reach the driver."""
    again = lists.select(F.explode("digests").alias("d")).groupBy("d").agg(F.count("*").alias("n")).where("n > 1")
    slot = F.conv(F.hex(F.substring("d", 1, 3)), 16, 10).cast("int")
    words = again.select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1, slot & 31)")).alias("bits"))
    got = words.toArrow()
    out = np.zeros(1 << (BIT_LOG - 5), np.uint32)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().astype(np.int32).view(np.uint32)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def store_media(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write the chunk store of ``docs``: lists (doc_id, n_bytes, payload_bytes, sha, digests), media (sha, head, digests, own: seq, bytes), chunks (digest, bytes).

    Null texts are empty payloads of UNIT zero bytes. Repeated rows and equal texts share all chunks. Null ids are carried. Other columns are not read.
    """
    rows = docs.select("doc_id", "text")
    lists = stored(rows.mapInArrow(_lists, "doc_id long, n_bytes long, payload_bytes long, sha binary, digests array<binary>"), "media-lists")
    bits = docs.sparkSession.sparkContext.broadcast(repeated_slots(lists))
    media = stored(rows.select("text").mapInArrow(_local(bits), "sha binary, head binary, digests array<binary>, own array<struct<seq:int,bytes:binary>>"), "media-store")
    chunks = rows.select("text").mapInArrow(_shared(bits), "digest binary, bytes binary").groupBy("digest").agg(F.first("bytes").alias("bytes"))
    return lists, media, stored(chunks, "media-chunks")


def read_media(media: DataFrame, chunks: DataFrame) -> DataFrame:
    """sha, tail_crc32, media_bytes, media_sha256, feature, n_chunks of each distinct medium, from its verified bytes.

    media_bytes and media_sha256 are those of the stored form: the head as it was stored, followed by the chunks as they were.

    Raises ValueError if a chunk or a medium does not have its digest.
    """
    whole = media.where(F.size("own") == F.size("digests")).select("sha", "head", F.col("own").alias("pieces"))
    parts = media.where(F.size("own") < F.size("digests"))
    lists = parts.groupBy("sha").agg(F.first("head").alias("head"), F.first("digests").alias("digests"), F.first("own").alias("own"))
    lists = stored(lists, "media-parts")
    here = F.transform("own", lambda p: p["seq"])
    away = F.array_except(F.sequence(F.lit(0), F.size("digests") - 1), here)
    missing = lists.select("sha", F.explode(F.transform(away, lambda k: F.struct(k.alias("seq"), F.get("digests", k).alias("digest")))).alias("m")).select("sha", "m.seq", "m.digest")
    fetched = missing.join(chunks, "digest").select("sha", F.struct("seq", "bytes").alias("piece"))
    fetched = fetched.groupBy("sha").agg(F.collect_list("piece").alias("got"))
    joined = lists.join(fetched, "sha").select("sha", "head", F.concat("own", "got").alias("pieces"))
    kind = "sha binary, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_chunks int"
    return whole.union(joined).mapInArrow(_read_back, kind)


def op6_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists, media, chunks = store_media(table(spark, sf_dir, "documents"))
    found = stored(read_media(media, chunks), "media-features")
    out = lists.select("doc_id", "n_bytes", "payload_bytes", "sha").join(found, "sha")
    return out.select("doc_id", "n_bytes", "payload_bytes", F.lower(F.hex("sha")).alias("payload_sha256"), "tail_crc32", "media_bytes", "media_sha256", "feature", "n_chunks")
