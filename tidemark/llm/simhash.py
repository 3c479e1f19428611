"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has 64 bits; each is set if it is set in more than half of the hashes of a text's shingles. The bits are cut into
BLOCKS blocks. Two fingerprints that differ in at most DISTANCE bits agree in all blocks but DISTANCE at least, so
each choice of BLOCKS - DISTANCE blocks is a join key: some key holds both of any close pair.

Equal fingerprints are one class all along, so a group of copies is one row below, whatever its size. Keys are counted with the
least and the greatest member: most keys have one member and end there, and those of two are a pair without a join. Members
of keys with up to SMALL members meet by a join on the key. Larger keys are never paired out: each member is dealt to all
bit patterns that differ from it in one bit, or none, outside the blocks that the key fixes. Close members
share such a pattern, whoever shares one is close, and a pattern has as many members as free bits and one more at
most; so each pattern links its least member with the others, a fixed number of rows for each member of the key. All
links are verified by their Hamming distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_texts, batches_of, folded, stored, table
from tidemark.llm.components import components

WORDS, SEED = 3, 42
BITS, DISTANCE = 64, 2
#: One more makes keys longer, so that 10 billion fingerprints share few by chance, and more numerous.
BLOCKS = 5
SMALL = 16
#: Bytes of a text that are cut into words at a time, and hashes whose bits are counted at a time.
PIECE, HASHES = 1 << 20, 1 << 16
_SPACE = b" \t\n\v\f\r"


def pieces(text: bytes, most: int = PIECE) -> Iterator[bytes]:
    """The text in pieces of about ``most`` bytes that end between words."""
    at = 0
    while at < len(text):
        end = min(at + most, len(text))
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end]
        at = end


def shingle_hashes(text: str | None, most: int = PIECE) -> Iterator[np.ndarray]:
    """XXH64 of all runs of WORDS words, repeats included; of the whole sequence if there are fewer; of none without words."""
    before: list[bytes] = []
    whole = True
    for piece in pieces(folded(text), most):
        words = before + piece.split()
        if len(words) >= WORDS:
            whole = False
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            cuts = zip([0, *ends[: -WORDS].tolist()], (ends[WORDS - 1 :] - 1).tolist(), strict=True)
            yield np.fromiter((xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in cuts), np.uint64, len(words) - WORDS + 1)
            before = words[1 - WORDS :]
        else:
            before = words
    if whole and before:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(before), SEED)], np.uint64)


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """The texts' fingerprints; zero without words."""
    set_in, hashes = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    held: list[np.ndarray] = []
    of: list[int] = []

    def count() -> None:
        if held:
            sizes = np.array([len(h) for h in held])
            bits = np.unpackbits(np.concatenate(held).astype(">u8").view(np.uint8).reshape(-1, BITS // 8), axis=1)
            np.add.at(set_in, of, np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64))
            np.add.at(hashes, of, sizes)
            held.clear()
            of.clear()

    waiting = 0
    for k, text in enumerate(texts):
        for found in shingle_hashes(text):
            for at in range(0, len(found), HASHES):
                held.append(found[at : at + HASHES])
                of.append(k)
                waiting += len(held[-1])
                if waiting >= HASHES:
                    count()
                    waiting = 0
    count()
    return np.packbits(2 * set_in > hashes[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches_of(arrow_texts(batches, "doc_id", "text"), lambda r: len(r[1] or "") + 100, 1_000_000):
        ids, texts = zip(*part, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fingerprints(list(texts)).view(np.int64))], names=["doc_id", "fp"])


def masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """The fingerprint's bits that each key fixes: all choices of blocks without ``distance`` of them."""
    cut = [BITS * k // blocks for k in range(blocks + 1)]
    block = [(1 << cut[k + 1]) - (1 << cut[k]) for k in range(blocks)]
    return [sum(chosen) for chosen in combinations(block, blocks - distance)]


def _signed(x: int) -> Column:
    return F.lit(x - (1 << BITS) if x >> BITS - 1 else x).cast("long")


def _keyed(classes: DataFrame) -> DataFrame:
    keys = F.array(*(F.col("fp").bitwiseAND(_signed(mask)) for mask in masks()))
    return classes.select("fp", F.posexplode(keys).alias("choice", "key"))


def _close(pairs: DataFrame) -> DataFrame:
    """The pairs a < b of fingerprints that differ in DISTANCE bits at most."""
    return pairs.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))


def _patterns() -> Column:
    """The fingerprint with no and with each one bit turned that the key of ``choice`` leaves free."""
    turned = [F.array(_signed(0), *(_signed(1 << b) for b in range(BITS) if not mask >> b & 1)) for mask in masks()]
    return F.transform(F.element_at(F.array(*turned), F.col("choice") + 1), lambda bit: F.col("fp").bitwiseXOR(bit))


def close_links(classes: DataFrame, small: int = SMALL) -> DataFrame:
    """a, b: links between different fingerprints (``classes``: fp, each once) that join whatever links within DISTANCE join; each is verified."""
    keyed = _keyed(classes)
    counted = keyed.groupBy("choice", "key").agg(F.count("*").alias("m"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    shared = stored(counted.where("m > 1"), "simhash-shared")
    members = stored(keyed.join(shared.where("m > 2").select("choice", "key", "m"), ["choice", "key"]), "simhash-members")
    few = members.where(F.col("m") <= small).select("choice", "key", "fp")
    joined = few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), ["choice", "key"]).select("a", "b")
    dealt = members.where(F.col("m") > small).select("choice", "fp", F.explode(_patterns()).alias("pattern"))
    # a pattern has one member for each free bit and itself, at most
    close = dealt.groupBy("choice", "pattern").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    close = close.select("a", F.explode("all").alias("b"))
    return _close(shared.where("m = 2").select("a", "b").union(joined).union(close)).distinct()


def near_groups(docs: DataFrame, small: int = SMALL) -> DataFrame:
    """A row for each row of ``docs``: doc_id, fingerprint, component_id.

    fingerprint is 16 lower-case hexadecimal digits; null and empty texts and those without words have the fingerprint zero and are linked
    like any other. component_id is the smallest doc_id that a document reaches over fingerprints of at most DISTANCE
    differing bits, itself included. Rows with one doc_id are one document, linked with whatever any of its texts is linked with. Rows
    without doc_id are linked with nothing and their component_id is null. Ties play no part, an empty table gives
    none, and columns other than doc_id and text are not read.
    """
    rows = stored(docs.select("doc_id", "text").mapInArrow(_fingerprinted, "doc_id long, fp long"), "simhash-rows")
    named = rows.where("doc_id is not null")
    classes = stored(named.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    several = named.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").select("doc_id", "a")
    own = named.select("doc_id", F.col("fp").alias("b")).join(several, "doc_id").where("a <> b").select("a", "b").distinct()
    label = components(close_links(classes.select("fp"), small).union(own)).withColumnRenamed("node", "fp")
    reached = classes.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = reached.groupBy("label").agg(F.min("least").alias("component_id"))
    component = stored(reached.select("fp", "label").join(least, "label").select("fp", "component_id"), "simhash-components")
    out = rows.hint("merge").join(component, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
