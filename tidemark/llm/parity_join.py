"""N-gram Jaccard join on parity sketches.

A document is the set of its distinct five-word shingles. XOR-ing the hashes of a set's shingles into the parts of a hash
partition gives a parity sketch: a part differs between two sets only if a shingle of their symmetric difference falls
into it, so the number of differing bits or parts is a lower bound of that difference. At a Jaccard similarity of t, the
symmetric difference is at most (1 - t) / (1 + t) of the sum of both sizes; by the pigeonhole principle some part of
the sketch must then agree. Sketches are made per size band: a set joins the band of its own size and those of the
sizes up to 1/t times as large, so both sets of any pair meet in the band of the larger one.

A part holds about PER_PART shingles (one in sets below SINGLES). Where that gives fewer than KEYS
parts, all parts are join keys, of as many independent partitions as make up KEYS keys; larger sets have more
parts, and KEYS of them, fixed by the hash, are keys. At the threshold a part agrees and is not empty with probability
0.29 or more, so a pair shares no key with probability below 0.71 ** KEYS (3e-10). Empty parts are no keys.

A first pass counts the keys. Those that occur more than once are summed up in a bit set of fixed size, and only keys
whose bit is set are dealt out again; when the bit set fills up, more keys are dealt, none is lost.

Equal keys give candidates, linear in the members of a key: each member with a few pivots (the member that shares most
keys, which stands in the middle of a group of copies, and one or two random ones). Sizes and a bit sketch, whose
Hamming distance must not pass the greatest possible difference, sort candidates out; the rest are verified exactly on
their shingles. The first round verifies one candidate a document; the second the candidates that the components of the
first do not join already. Documents with equal sets are one class all along and never compared.

Pivots only join most of a group cheaply; the third round is exact. Keys whose members lie in more than one component are put
together by their first pivot, each member once, as near copies meet in dozens of keys. In clusters of up to BLOCK members
all pairs across components are held against the size and sketch bounds, so a member costs BLOCK comparisons of a few words at the most. The members of larger ones are dealt out anew, so that what a template
alone brings together comes apart: with shingles in the order of how many of these members have them, two sets that share c shingles share one
of their first n - c + 1. Shingles of one member come first and meet nobody, so a member whose own words are more than the similarity
leaves room for has no partner; the others are keyed by the shared shingles among their first, for each band of partners' sizes, as the number of shingles that a link needs grows with
both sizes. Members of such a key are compared across components, in blocks of BLOCK if they are many. All pairs that pass the bounds and are not verified yet are verified.
So each pair that shares a key is either joined, verified or beyond a bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, arrow_texts, batches_of, bit_set, forget, has_bit, mix64, rows_named, shingle_hashes, stored, table, words_of
from tidemark.llm.components import components

TOP, OUT_OF = 75, 100
KEYS = 64
PER_PART = 3.2
SINGLES = 8
SMALL_GROUP = 16
#: Members of a large key that are compared at a time; larger keys are dealt over the pairs of such blocks.
BLOCK = 4_096
BAND = 4 / 3
#: Ratio of the sizes at both ends of a band of partners in the third round.
FINE = 1.08
SKETCH_BITS = 4
MOST_SKETCH = 1 << 14
#: Words that are verified in one group at a time; pivots with more partners are dealt over more groups.
GROUP_WORDS = 200_000

_SETS = "row long, doc_id long, n long, d1 long, d2 long, sketch binary, keys array<long>"


def bands() -> list[int]:
    """The lower bounds of the size bands, each at most BAND times the one before."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return out


_BANDS = np.array(bands(), np.int64)


def band_keys(hashes: np.ndarray, top: int = TOP, out_of: int = OUT_OF, most: int | None = KEYS) -> np.ndarray:
    """The join keys of a set of distinct hashes: for each band that it joins, the parts of its parity sketch, ``most`` of them; all if None."""
    n = len(hashes)
    own = int(np.searchsorted(_BANDS, n, "right")) - 1
    last = int(np.searchsorted(_BANDS, n * out_of // top, "right")) - 1
    keys = []
    for band in range(own, last + 1):
        low = int(_BANDS[band])
        if low < SINGLES:
            keys.append(mix64(hashes + np.uint64(band)))
            continue
        parts = ceil(low / PER_PART)
        used = min(parts, most or parts)
        for seed in range(ceil(KEYS / used)):
            seeded = mix64(hashes ^ np.uint64(0x5851F42D4C957F2D * (band + 1 + (seed << 20)) & (1 << 64) - 1))
            part = ((seeded >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            if parts > used:
                part, seeded = part[part < used], seeded[part < used]
            sums = np.zeros(used, np.uint64)
            np.bitwise_xor.at(sums, part, mix64(seeded))
            there = np.flatnonzero(np.bincount(part, minlength=used))
            keys.append(mix64(sums[there] + np.uint64(band << 40 | seed << 32) + there.astype(np.uint64)))
    return np.concatenate(keys)


def bit_sketch(hashes: np.ndarray) -> bytes:
    """Parities of the set's hashes over a power of two of bits, about SKETCH_BITS a member."""
    bits = 64
    while bits < min(len(hashes) * SKETCH_BITS, MOST_SKETCH):
        bits *= 2
    return np.packbits(np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Of two bit sketches; the longer is folded, which keeps it a sketch."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], top: int, out_of: int, most: int | None) -> Iterator[pa.RecordBatch]:
    memo = WordHashes()
    for part in batches_of(arrow_texts(batches, "row", "doc_id", "text"), lambda r: len(r[2] or ""), 2_000_000):
        rows = []
        for row, doc_id, text in part:
            h = np.unique(shingle_hashes(memo.of(words_of(text))))
            if len(h):
                d = np.array([np.bitwise_xor.reduce(mix64(h + np.uint64(1))), mix64(h + np.uint64(2)).sum(dtype=np.uint64)], np.uint64).view(np.int64)
                rows.append((row, doc_id, len(h), int(d[0]), int(d[1]), bit_sketch(h), _as_long(band_keys(h, top, out_of, most))))
            else:
                rows.append((row, doc_id, 0, 0, 0, b"", np.empty(0, np.int64)))
        cols = list(zip(*rows, strict=True))
        ends = np.cumsum([0] + [len(k) for k in cols[6]]).astype(np.int32)
        keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(cols[6])))
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.binary()), keys], names=["row", "doc_id", "n", "d1", "d2", "sketch", "keys"])


def _kept_keys(bits):
    """The rows' keys whose bit is set; rows without any are left out."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("keys"))
            keys = lists.flatten().to_numpy(zero_copy_only=False)
            hit = has_bit(known, keys.view(np.uint64))
            row = np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))[hit]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))]).astype(np.int32)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[hit]))], names=["at", "row", "n", "keys"])
            yield out.filter(pa.array(np.diff(ends) > 0))

    return keep


def _near(batches: Iterator[pa.RecordBatch], top: int, out_of: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        keep = [hamming(x, y) * (out_of + top) <= (m + n) * (out_of - top) for x, y, m, n in zip(c["sa"], c["sb"], c["na"], c["nb"], strict=True)]
        yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(keep, pa.bool_()))


def across(n: np.ndarray, label: np.ndarray, block: np.ndarray, sketches: list[bytes], top: int, out_of: int) -> list[tuple[int, int]]:
    """Pairs of places of different labels that pass the size and sketch bounds; of two blocks, only pairs between them."""
    lengths = np.array([len(x) for x in sketches], np.int64)
    folded = {}
    for size in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths >= size)
        # a sketch is longer by a power of two; folding is XOR over its pieces of the shorter length
        rows = np.array([np.bitwise_xor.reduce(np.frombuffer(sketches[i], np.uint64).reshape(-1, size // 8), 0) for i in at])
        place = np.full(len(n), -1)
        place[at] = np.arange(len(at))
        folded[size] = (rows, place)
    two = len(np.unique(block)) > 1
    _, own, many = np.unique(label, return_inverse=True, return_counts=True)
    # the members of the largest component are never the ones looped over
    order = np.lexsort((label, -many[own]))
    n, lengths_of, label_of, block_of = n[order], lengths[order], label[order], block[order]
    starts = np.flatnonzero(np.append(True, label_of[1:] != label_of[:-1]))
    out = []
    for s, e in zip(starts, np.append(starts[1:], len(n)), strict=True):
        for i in range(s, e) if s else ():
            fits = np.minimum(n[:s], n[i]) * out_of >= np.maximum(n[:s], n[i]) * top
            if two:
                fits &= block_of[:s] != block_of[i]
            others = np.flatnonzero(fits)
            sizes = np.minimum(lengths_of[others], lengths_of[i])
            for size in np.unique(sizes).tolist():
                rows, place = folded[size]
                some = others[sizes == size]
                apart = np.bitwise_count(rows[place[order[some]]] ^ rows[place[order[i]]]).sum(1, dtype=np.int64)
                out.extend((int(order[i]), int(order[k])) for k in some[apart * (out_of + top) <= (n[some] + n[i]) * (out_of - top)])
    return out


def _across(top: int, out_of: int):
    def compare(rows: pa.Table) -> pa.Table:
        rep, n, label, block = (rows.column(c).to_numpy() for c in ("rep", "n", "label", "block"))
        found = across(n, label, block, rows.column("sketch").to_pylist(), top, out_of)
        i, k = (np.array([p[side] for p in found], np.int64) for side in (0, 1))
        i, k = np.where(rep[i] < rep[k], i, k), np.where(rep[i] < rep[k], k, i)
        return pa.table({"a": rep[i], "b": rep[k], "na": n[i], "nb": n[k]})

    return compare


def _verify(top: int, out_of: int):
    def check(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        memo, b = WordHashes(), key[0].as_py()
        sets = {}
        pivot, found = None, []
        texts = sorted(zip(rows.column("a").to_pylist(), rows.column("text").to_pylist(), strict=True), key=lambda r: r[0] is not None)
        for a, text in texts:
            h = np.unique(shingle_hashes(memo.of(words_of(text))))
            if a is None:
                pivot = h
            elif a not in sets:
                sets[a] = True
                both = len(np.intersect1d(h, pivot, assume_unique=True)) if pivot is not None else 0
                if pivot is not None and both * out_of >= top * (len(h) + len(pivot) - both):
                    found.append(a)
        return pa.table({"a": pa.array(found, pa.int64()), "b": pa.array([b] * len(found), pa.int64())})

    return check


def verified(pairs: DataFrame, texts: DataFrame, top: int = TOP, out_of: int = OUT_OF) -> DataFrame:
    """The pairs (a, b, na, nb) of rows whose ``texts`` (row, text; equal ones may repeat) reach the similarity: a, b.

    The text of b goes once to each group of about GROUP_WORDS words of its partners, so a pivot of many partners spreads.
    """
    deals = pairs.groupBy("b").agg(F.ceil(F.sum(F.col("na") + F.lit(50)) / F.lit(GROUP_WORDS)).alias("deals"))
    dealt = stored(pairs.join(deals, "b").select("a", "b", F.pmod(F.xxhash64("a", "b"), "deals").cast("int").alias("deal")), "verify-pairs")
    asked = dealt.select(F.col("b").alias("row"), "b", "deal", F.lit(None).cast("long").alias("a")).distinct().union(dealt.select(F.col("a").alias("row"), "b", "deal", "a"))
    # Only texts that a pair may name go through the shuffle; without the bit set it would be all of them.
    bits = pairs.sparkSession.sparkContext.broadcast(bit_set(asked.select(F.col("row").alias("key"))))
    named = texts.select("row", "text").mapInArrow(rows_named(bits, "row"), "row long, text string")
    return asked.hint("merge").join(named, "row").select("b", "deal", "a", "text").groupBy("b", "deal").applyInArrow(_verify(top, out_of), "a long, b long")


def near_groups(docs: DataFrame, top: int = TOP, out_of: int = OUT_OF, keys: int | None = KEYS) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles, component_id, n_links.

    ``keys``: parts of a set's sketch that are join keys; None for all of them, 0.75 rows for each shingle, with which no pair at all is missed.
    component_id is the smallest doc_id that a document reaches over links (100 * intersection >= 75 * union of the
    shingle sets), itself included; n_links counts the links that were verified for the row's class of equal sets and the other rows of
    that class, not all pairs. Null and empty texts and texts without words have no shingles, are linked with nothing and are
    their own component. Rows without doc_id are compared with nothing; their component_id is null. Rows with one
    doc_id are one document: it is linked with whatever any of its texts is linked with. Ties play no part; columns other than doc_id and text are not read.
    """
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    keyed = stored(rows.mapInArrow(lambda x: _sets(x, top, out_of, keys), _SETS).withColumn("at", F.monotonically_increasing_id()), "parity-sets", "lz4")
    # the keys are most of it and read a few times only
    sets = stored(keyed.drop("keys"), "parity-sizes", "lz4")
    some = sets.where("n > 0 and doc_id is not null")
    # Of each class of equal sets one row takes part in what follows; a row's key names its text.
    classes = stored(some.groupBy("n", "d1", "d2").agg(F.min(F.struct("doc_id", "row", "at")).alias("f"), F.count("*").alias("copies")).select("n", "d1", "d2", F.col("f.row").alias("rep"), F.col("f.doc_id").alias("least"), F.col("f.at").alias("at"), "copies"), "parity-classes")
    reps = classes.select("at", "rep")

    keyed_some = keyed.where("n > 0 and doc_id is not null")
    counted = keyed_some.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    bits = docs.sparkSession.sparkContext.broadcast(bit_set(counted))
    kept = stored(keyed_some.select("at", "row", "n", "keys").mapInArrow(_kept_keys(bits), "at long, row long, n long, keys array<long>"), "parity-kept")
    members = kept.join(reps.select("at"), "at", "left_semi").select(F.col("row").alias("rep"), "n", F.explode("keys").alias("key"))
    weight = members.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    forget(keyed)
    members = stored(members.join(weight, "key"), "parity-shared")
    forget(kept)
    common = members.groupBy("rep").agg(F.sum("m").alias("common"))
    # In small groups random pivots differ by key, which brings all members together; in large ones they do not, which keeps pairs few.
    small = F.col("m") <= SMALL_GROUP
    drawn = F.struct(F.when(small, F.xxhash64("key", "rep")).otherwise(F.xxhash64("rep")).alias("h"), "rep")
    leader = F.struct("common", "rep")
    pivots = members.join(common, "rep").groupBy("key").agg(F.array_compact(F.array(F.max(leader)["rep"], F.min(drawn)["rep"], F.max(F.when(small, drawn))["rep"])).alias("pivots"))
    pivots = stored(pivots, "parity-pivots")
    hits = members.join(pivots, "key").select("rep", "n", F.posexplode("pivots").alias("kind", "b")).where("rep <> b")
    hits = hits.groupBy("rep", "b").agg(F.first("n").alias("na"), F.count_if(F.col("kind") == 0).alias("led"), F.count("*").alias("times"))
    sizes = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"))
    fits = (F.least("na", "nb") * out_of >= F.greatest("na", "nb") * top)
    hits = stored(hits.join(sizes, "b").where(fits).select(F.col("rep").alias("a"), "b", "na", "nb", "led", "times"), "parity-hits")

    texts = rows.where("doc_id is not null")
    best = best_partner(hits)
    first = stored(verified(best, texts, top, out_of), "parity-links")
    label = components(first)
    at = lambda side: label.select(F.col("node").alias(side), F.col("label").alias(f"l{side}"))
    rest = hits.join(at("a"), "a", "left").join(at("b"), "b", "left").where(F.coalesce("la", "a") != F.coalesce("lb", "b"))
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"), F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb")).distinct()
    rest = rest.join(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    sketches = stored(some.join(reps.select("at"), "at", "left_semi").select("row", "n", "sketch"), "parity-sketches")
    sketch = lambda side, name: sketches.select(F.col("row").alias(side), F.col("sketch").alias(name), F.col("n").alias(f"n{side}"))
    near = rest.join(sketch("a", "sa"), ["a", "na"]).join(sketch("b", "sb"), ["b", "nb"]).select("a", "b", "na", "nb", "sa", "sb")
    near = stored(near.mapInArrow(lambda x: _near(x, top, out_of), "a long, b long, na long, nb long").distinct(), "parity-near")
    links = first.union(stored(verified(near, texts, top, out_of), "parity-links"))
    done = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(near.select("a", "b"))
    left = stored(unjoined(members, pivots, components(links), sketch, texts, top, out_of).join(done, ["a", "b"], "left_anti"), "parity-left")
    links = stored(links.union(stored(verified(left, texts, top, out_of), "parity-links")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "parity-links")

    # Texts of one document are joined by the document; then each component takes its smallest doc_id.
    of = stored(some.select("at", "doc_id", "n", "d1", "d2").hint("merge").join(classes.drop("at"), ["n", "d1", "d2"]).select("at", "doc_id", "rep", "least", "copies"), "parity-rows")
    several = of.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select("doc_id", "a")
    own = of.select("doc_id", F.col("rep").alias("b")).join(several, "doc_id").where("a <> b").select("a", "b").distinct()
    label = components(links.union(own)).withColumnRenamed("node", "rep")
    reached = classes.select("rep", "least").join(label, "rep").groupBy("label").agg(F.min("least").alias("component"))
    named = label.join(reached, "label").select("rep", "component")
    degree = links.select("a").union(links.select("b")).toDF("rep").groupBy("rep").agg(F.count("*").alias("degree"))
    out = of.hint("merge").join(named, "rep", "left").join(degree, "rep", "left").select("at", F.coalesce("component", "least").alias("component"), (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    # A document's row without words belongs to the document too.
    wordless = sets.where("n = 0 and doc_id is not null").select("at", "doc_id").join(of.select("doc_id", F.col("at").alias("other")).groupBy("doc_id").agg(F.min("other").alias("other")), "doc_id")
    wordless = wordless.join(out.select(F.col("at").alias("other"), "component"), "other").select("at", "component", F.lit(0).cast("long").alias("n_links"))
    out = sets.select("at", "doc_id", F.col("n").alias("n_shingles")).hint("merge").join(out.union(wordless), "at", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each text: rep, n, label, h."""
    memo = WordHashes()
    for part in batches_of(arrow_texts(batches, "rep", "n", "label", "text"), lambda r: len(r[3]), 1_000_000):
        sets = [np.unique(shingle_hashes(memo.of(words_of(text)))) for *_, text in part]
        of = np.repeat(np.arange(len(part)), [len(h) for h in sets])
        ids = [np.array([r[k] for r in part], np.int64)[of] for k in range(3)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, ids), pa.array(_as_long(np.concatenate(sets)))], names=["rep", "n", "label", "h"])


def rekeyed(third: DataFrame, texts: DataFrame, top: int, out_of: int) -> DataFrame:
    """cluster, rep, n, label, m: the members (rep, n, label) by the shared shingles among their first ones and by band of sizes; every pair that links shares a cluster."""
    bits = third.sparkSession.sparkContext.broadcast(bit_set(third.select(F.col("rep").alias("key"))))
    named = texts.select("row", "text").mapInArrow(rows_named(bits, "row"), "row long, text string").withColumnRenamed("row", "rep")
    # the join has dealt the texts by rep already; rows that are equal count once
    held = third.hint("merge").join(named, "rep").dropDuplicates(["rep"])
    grams = stored(held.mapInArrow(_grams, "rep long, n long, label long, h long"), "parity-grams", "lz4")
    shared = grams.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    grams = grams.join(shared, "h")
    # shingles of its own come first; c is what is left to share, and a link needs top of out_of of them at least
    enough = grams.groupBy("rep").agg(F.count("*").alias("c")).where(F.col("c") > 0).withColumnRenamed("rep", "of")
    grams = grams.join(enough, grams["rep"] == enough["of"]).drop("of").where(F.col("c") * out_of >= F.col("n") * top)
    order = Window.partitionBy("rep").orderBy("df", "h")
    band = lambda n: F.floor(F.log(n) / F.log(F.lit(FINE)))
    own = grams.withColumn("place", F.row_number().over(order)).withColumn("own", band(F.col("n")))
    own = own.withColumn("other", F.explode(F.sequence(band(F.greatest(F.floor(F.col("n") * top / out_of), F.lit(1))), band(F.ceil(F.col("n") * out_of / top)))))
    # the least size of the other band, a little less where rounding is near, and the shingles that a link with it needs
    low = F.greatest(F.floor(F.pow(F.lit(FINE), F.col("other")) - 0.001), F.lit(1))
    need = F.ceil((F.col("n") + low) * top / (top + out_of) - 1e-9)
    first = own.where(F.col("place") <= F.col("c") - need + 1)
    cluster = F.xxhash64("h", F.least("own", "other"), F.greatest("own", "other"))
    keyed = stored(first.select(cluster.alias("cluster"), "rep", "n", "label").distinct(), "parity-rekeyed")
    sizes = keyed.groupBy("cluster").agg(F.count("*").alias("m"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return stored(keyed.join(sizes.select("cluster", "m"), "cluster"), "parity-clusters")


def unjoined(members: DataFrame, pivots: DataFrame, label: DataFrame, sketch, texts: DataFrame, top: int, out_of: int) -> DataFrame:
    """a, b, na, nb: pairs of members of a cluster of keys that lie in different components and pass both bounds; a superset of those that share a key and link."""
    named = members.join(label.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "n", F.coalesce("label", "rep").alias("label"))
    parted = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    parted = parted.join(pivots.select("key", F.get("pivots", F.lit(0)).alias("cluster")), "key")
    named = stored(named.join(parted, "key").select("cluster", "rep", "n", "label").distinct(), "parity-parted")
    named = stored(named.join(named.groupBy("cluster").agg(F.count("*").alias("m")), "cluster"), "parity-clusters")
    third = stored(named.where(F.col("m") > BLOCK).select("rep", "n", "label").distinct(), "parity-third")
    named = named.where(F.col("m") <= BLOCK)
    if not third.isEmpty():
        named = named.unionByName(rekeyed(third, texts, top, out_of))
    x, y = (named.where(F.col("m") <= SMALL_GROUP).select("cluster", *(F.col(c).alias(c + side) for c in ("rep", "n", "label"))) for side in "xy")
    fits = F.least("nx", "ny") * out_of >= F.greatest("nx", "ny") * top
    small = x.join(y, "cluster").where((F.col("repx") < F.col("repy")) & (F.col("labelx") != F.col("labely")) & fits)
    small = small.select(F.col("repx").alias("a"), F.col("repy").alias("b"), F.col("nx").alias("na"), F.col("ny").alias("nb")).distinct()
    small = small.join(sketch("a", "sa"), ["a", "na"]).join(sketch("b", "sb"), ["b", "nb"]).select("a", "b", "na", "nb", "sa", "sb")
    small = small.mapInArrow(lambda r: _near(r, top, out_of), "a long, b long, na long, nb long")
    large = named.where(F.col("m") > SMALL_GROUP).withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    large = large.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    large = large.select("cluster", "rep", "n", "label", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    large = large.join(sketch("rep", "sketch").withColumnRenamed("nrep", "n"), ["rep", "n"])
    large = large.select("cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "rep", "n", "label", "block", "sketch")
    large = large.groupBy("cluster", "lo", "hi").applyInArrow(_across(top, out_of), "a long, b long, na long, nb long")
    return small.union(large).distinct()


def best_partner(hits: DataFrame) -> DataFrame:
    """For each document the partner that it met in most keys as the middle of their members."""
    top = hits.groupBy("a").agg(F.max(F.struct("led", "times", "b", "na", "nb")).alias("t"))
    return stored(top.select("a", "t.b", "t.na", "t.nb"), "parity-best")


def op9_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i : i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS gs
  FROM w),
s AS (SELECT doc_id, len(gs) AS n, unnest(gs) AS g FROM g),
both_of AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS both_n FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_of WHERE 100 * both_n >= 75 * (na + nb - both_n)),
reach(doc_id, other) AS (SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT g.doc_id, CAST(len(gs) AS BIGINT) AS n_shingles, least(g.doc_id, coalesce(min(r.other), g.doc_id)) AS component_id
FROM g LEFT JOIN reach r ON g.doc_id = r.doc_id GROUP BY g.doc_id, gs
"""
