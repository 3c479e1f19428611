"""Substring deduplication by collinear chaining: repeated passages, also with edits, across documents.

Exact copies of a text are one class; only its first document takes part below, the others are rows that name it.

Seeds are minimizers: of every WINDOW consecutive hashes of K words the smallest is kept, so a shared stretch of K + WINDOW - 1
words shares a seed. K words with fewer than three different ones say nothing and are no seeds, so what only repeats a word or
two is no passage, though it may be a part of one. Seeds are counted; those that occur more than once go on (through a bit set of fixed size, which lets more
through when it fills up and never less). Under each seed, every occurrence is joined with the first document that has it and with the last one
before its own. That meets all holders of a seed that occurs up to three times.

For seeds that occur more often all other pairs of holders are found by the words around the seed, one byte of hash each. Among min_words words of which a
passage leaves a share of 1 - identity unlike, each unlike word spoils three runs of three words, so the two share at least ``least_shared`` runs. Pairs that share as many are
found by a prefix join: two that do share one of the runs that are left when each drops its ``least_shared`` - 1 most frequent ones, so documents that
share a phrase only do not meet, however many they are, and no pair is left out for its number. Places whose words around agree in min_words words or more at the identity asked for
are one class: they are joined by enough links to hold together, not all with all; places of different classes are all matched. Holders of a seed that occurs more
than BLOCK times are dealt over parts, and every two parts meet.
Occurrences of a hot seed are, for the first and the last one before, dealt over
groups by a hash of their row; first and neighbour are then those of the group, and the groups' firsts are joined with the first of all.

Matches of a pair of documents are chained in order: the score of a chain is K for each match, less GAP for each word it
skips on either side; the best predecessor is found by a Fenwick tree of prefix maxima over the source's positions.
Chains are then aligned on the words themselves: the words between matches by their longest common subsequence, both ends by
extension with a drop-off. What has IDENTITY or more and MIN_WORDS words, not counting those that repeat one of the two before, is a passage. A chain that is long enough but too unlike
is parted at its largest gap, and its parts are tried again, so that unlike words between two good passages cost neither of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_texts, batches_of, bit_set, folded, gram_hashes, has_bit, mix64, rows_named, stored, table, word_hashes

K, WINDOW = 4, 8
#: A seed with more occurrences has holders that are neither first nor next.
COMMON = 3
NOTHING = np.uint64((1 << 64) - 1)
GAP = 0.05
LEAST_SEEDS = 2
MIN_WORDS, IDENTITY = 45, 0.8
#: The drop of the score that ends an extension.
DROP = 5
#: Words that are sent along beyond both ends of a pair's chains; a pair whose extension needs more is aligned again on the whole text.
MARGIN = 400
#: A seed with more occurrences is hot, and the most frequent one is dealt over groups of about so many.
HOT = 1_000
#: Holders of a seed that are compared in one task, of each of two parts; and places that are compared at a time, if their seeds allow it.
BLOCK, PLACES = 20_000, 10_000
#: Words around a seed go so many beyond the shortest passage.
BEYOND = 5


def minimizers(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the smallest hash (the last of equal ones) of each window; of all there are, if fewer. NOTHING is never one."""
    if not len(grams):
        return np.empty(0, np.int64)
    w = min(window, len(grams))
    turned = np.lib.stride_tricks.sliding_window_view(grams, w)[:, ::-1]
    at = np.unique(np.arange(len(turned)) + w - 1 - turned.argmin(1))
    return at[grams[at] != NOTHING]


def seed_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of K words; NOTHING for those with fewer than three different words."""
    out = gram_hashes(words, K)
    like = np.zeros(len(out), np.int64)
    for d in range(1, K):
        same = words[d:] == words[:-d]
        for i in range(K - d):
            like += same[i : i + len(out)]
    # two pairs of equal words or more leave at most two different ones among four
    out[like > 1] = NOTHING
    return out


def _seeds(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The seeds of texts whose word hashes follow one another, and their places among all words; as ``minimizers`` of each text."""
    grams = seed_hashes(words)
    starts, n = np.cumsum(counts) - counts, np.maximum(counts - K + 1, 0)
    windows = np.maximum(n - WINDOW + 1, 0)
    first = np.repeat(starts - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
    at, least = first.copy(), grams[first]
    for d in range(1, WINDOW):
        other = grams[first + d]
        smaller = other <= least
        least[smaller] = other[smaller]
        at[smaller] = first[smaller] + d
    short = [starts[k] + minimizers(grams[starts[k] : starts[k] + n[k]]) for k in np.flatnonzero((n > 0) & (n < WINDOW))]
    at = np.unique(np.concatenate([at, *short]))
    at = at[grams[at] != NOTHING]
    return grams[at], at


def _marks(firsts):
    """Number of words, the seeds (hs) with their words (ws), and a byte of hash for each word (ks) of each row; none of them where it can't be the first of its class."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches_of(arrow_texts(batches, "row", "doc_id", "tid", "text"), lambda r: len(r[3] or ""), 1_000_000):
            hashes, counts = word_hashes([folded(r[3]) for r in part])
            first = has_bit(firsts.value, np.array([r[0] for r in part], np.int64).view(np.uint64))
            own = np.where(first, counts, 0)
            hashes = hashes[np.repeat(first, counts)]
            seeds, at = _seeds(hashes, own)
            ends = np.cumsum([0, *own])
            cut = pa.array(np.searchsorted(at, ends), pa.int32())
            hs = pa.ListArray.from_arrays(cut, pa.array(seeds.view(np.int64)))
            ws = pa.ListArray.from_arrays(cut, pa.array((at - np.repeat(ends[:-1], np.diff(cut.to_numpy()))).astype(np.int32)))
            ks = (hashes % np.uint64(255) + np.uint64(1)).astype(np.uint8)
            ks = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ks)])
            ids = [pa.array([r[k] for r in part], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(counts, pa.int64()), hs, ws, ks], names=["row", "doc_id", "tid", "n_words", "hs", "ws", "ks"])

    return find


#: Seeds that are dealt out at a time.
DEALT = 200_000


def _spread(known, hot, groups: int):
    """h, part, row, doc_id, w: the seeds that occur more than once; part is not 0 for hot ones only."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, docs, hs, ws, of in _seed_rows(batches):
            there = has_bit(known.value, hs)
            h, w, of = hs[there], ws[there], of[there]
            if not len(h):
                continue
            part = np.zeros(len(h), np.int64)
            if groups > 1:
                part = has_bit(hot.value, h) * (1 + (mix64(ids.view(np.uint64)) % np.uint64(groups)).astype(np.int64))[of]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(part, pa.int32()), pa.array(ids[of]), pa.array(docs[of]), pa.array(w.astype(np.int32))], names=["h", "part", "row", "doc_id", "w"])

    return lambda batches: _joined(deal(batches), 50_000)


def _around(common, hot, parts: int, reach: int):
    """h, part, row, doc_id, w, around: the seeds that occur more than COMMON times, with the bytes of the words from ``reach`` before to ``reach`` behind (0: none there).

    Those that occur more than BLOCK times are a row for each two of ``parts`` of which one is their own.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, width = np.zeros(reach + K, np.uint8), 2 * reach + K
        for batch in batches:
            row, doc_id, hs, ws, ks = (batch.column(batch.schema.get_field_index(c)) for c in ("row", "doc_id", "hs", "ws", "ks"))
            h, w = hs.flatten().to_numpy(zero_copy_only=False).view(np.uint64), ws.flatten().to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(hs)), np.diff(hs.offsets.to_numpy()))
            often = np.flatnonzero(has_bit(common.value, h))
            for a, z in _ranges(np.ones(len(often), np.int64), 20_000):
                own = often[a:z]
                h1, w1, of1 = h[own], w[own], of[own]
                bytes_of = []
                for k in np.unique(of1).tolist():
                    at = np.concatenate([none, np.frombuffer(ks[k].as_py(), np.uint8), none])
                    bytes_of.append(np.lib.stride_tricks.sliding_window_view(at, width)[w1[of1 == k] + K])
                bytes_of = np.concatenate(bytes_of)
                part = np.zeros(len(h1), np.int64)
                if parts > 1:
                    many = has_bit(hot.value, h1)
                    twice = np.repeat(np.arange(len(h1)), np.where(many, parts, 1))
                    other = np.arange(len(twice)) - np.searchsorted(twice, twice)
                    mine = (mix64(row.to_numpy(zero_copy_only=False).view(np.uint64)) % np.uint64(parts)).astype(np.int64)[of1[twice]]
                    part = np.where(many[twice], 1 + np.minimum(mine, other) * parts + np.maximum(mine, other), 0)
                    h1, w1, of1, bytes_of = h1[twice], w1[twice], of1[twice], bytes_of[twice]
                ends = pa.py_buffer((np.arange(len(h1) + 1) * width).astype(np.int32))
                flat = pa.Array.from_buffers(pa.binary(), len(h1), [None, ends, pa.py_buffer(np.ascontiguousarray(bytes_of))])
                yield pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(part, pa.int32()), row.take(pa.array(of1)), doc_id.take(pa.array(of1)), pa.array(w1), flat], names=["h", "part", "row", "doc_id", "w", "around"])

    return lambda batches: _joined(find(batches), 20_000)


def least_shared(min_words: int, identity: float) -> int:
    """Runs of three words that two passages of ``min_words`` words share at least, as each unlike word spoils three."""
    return max(min_words - 2 - 3 * int((1 - identity) * min_words + 1e-9), 1)


def _runs(around: np.ndarray) -> np.ndarray:
    """The runs of three words of each row, repeats numbered, in order; negative where there is none."""
    a, b, c = (around[:, k : around.shape[1] - 2 + k].astype(np.int64) for k in range(3))
    runs = np.where((a > 0) & (b > 0) & (c > 0), a << 16 | b << 8 | c, -1)
    runs.sort(axis=1)
    at = np.arange(runs.shape[1])
    first = np.maximum.accumulate(np.where(np.diff(runs, axis=1, prepend=-2) != 0, at, 0), axis=1)
    return np.where(runs < 0, -1, runs << 12 | at - first)


def _confirmed(x: np.ndarray, y: np.ndarray, min_words: int, identity: float) -> np.ndarray:
    """Whether the words around agree, place by place, in a stretch about the seed that is a passage by itself."""
    n, reach = min_words + BEYOND, min_words + BEYOND
    new = x > 0
    new[:, 1:] &= x[:, 1:] != x[:, :-1]
    new[:, 2:] &= x[:, 2:] != x[:, :-2]
    same, told = (np.cumsum(np.pad(t, ((0, 0), (1, 0))), axis=1, dtype=np.int32) for t in ((x == y) & (x > 0), new))
    starts = np.arange(reach + K - n, reach + 1)
    return ((same[:, starts + n] - same[:, starts] >= identity * n) & (told[:, starts + n] - told[:, starts] >= min_words)).any(axis=1)


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that is connected with each of n places."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        least = np.minimum(x, y)
        np.minimum.at(label, x, least)
        np.minimum.at(label, y, least)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _ranges(counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose counts add up to about ``most``."""
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, end
        at = end


def _behind(of: np.ndarray, lists: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the order of their list and label, and for each where those of the same list behind the last one of its label begin, and how many they are."""
    order = np.lexsort((label[of], lists))
    of, lists = of[order], lists[order]
    new = lists[1:] != lists[:-1]
    ends, last = (np.flatnonzero(np.append(x, True)) + 1 for x in (new, new | (label[of][1:] != label[of][:-1])))
    ends, last = (np.repeat(x, np.diff(x, prepend=0)) for x in (ends, last))
    return of, last, ends - last


def _sharing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many ``_runs`` two rows share."""
    both = np.sort(np.concatenate([x, y], axis=1), axis=1)
    return ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] >= 0)).sum(axis=1)


def _of_ranges(pairs: np.ndarray, test, n: int) -> np.ndarray:
    """``test`` of the places of pairs (i * n + k), some thousands at a time."""
    return np.concatenate([np.empty(0, bool), *(test(pairs[a : a + 20_000] // n, pairs[a : a + 20_000] % n) for a in range(0, len(pairs), 20_000))])


def alike(group: np.ndarray, doc: np.ndarray, around: np.ndarray, min_words: int = MIN_WORDS, identity: float = IDENTITY) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places (of larger and of smaller doc) of the same group whose words around share ``least_shared`` runs or more.

    Of those that are one class by ``_confirmed`` pairs, enough to connect them; all that are not. Places are in the order of group, doc.
    """
    n, least = len(group), least_shared(min_words, identity)
    runs = _runs(around)
    of, column = np.nonzero(runs >= 0)
    number = np.cumsum(np.diff(group, prepend=group[:1]) != 0)
    key = runs[of, column] | number[of] << 36
    _, lists, size = np.unique(key, return_inverse=True, return_counts=True)
    # Each place's rarest runs first; those that no other place has need no list, but are among them.
    often = size[lists]
    room = np.bincount(of, minlength=n) - least + 1 - np.bincount(of[often == 1], minlength=n)
    some = (often > 1) & (room[of] > 0)
    of, lists, often = of[some], lists[some], often[some]
    order = np.lexsort((lists, often, of))
    of, lists = of[order], lists[order]
    starts = np.searchsorted(of, of)
    taken = np.arange(len(of)) - starts < room[of]
    of, lists = of[taken], lists[taken]
    order = np.lexsort((of, lists))
    of, lists = of[order], lists[order]
    heads = np.flatnonzero(np.append(True, lists[1:] != lists[:-1])) if len(lists) else np.empty(0, np.int64)
    ends = np.append(heads[1:], len(lists)) if len(heads) else heads
    head_of = np.repeat(heads, ends - heads)
    later = np.flatnonzero(np.arange(len(lists)) > head_of)
    none = np.empty(0, np.int64)

    def pairs(i: np.ndarray, k: np.ndarray) -> np.ndarray:
        return np.unique((i * n + k)[doc[k] < doc[i]])

    # Classes, by neighbours in the lists and their firsts.
    tried = pairs(np.concatenate([of[later], of[later]]), np.concatenate([of[later - 1], of[head_of[later]]]))
    sure = tried[_of_ranges(tried, lambda i, k: _confirmed(around[i], around[k], min_words, identity), n)]
    label = _labels(n, sure // max(n, 1), sure % max(n, 1))
    # All pairs of different classes; those that are confirmed make one class of two.
    out = []
    if len(heads):
        # A pair may be in dozens of lists: where those come to more than all places of the group with each other, the group is the list.
        by_list, by_group = _behind(of, lists, label), _behind(every := np.unique(of), number[every], label)
        work = [np.bincount(number[x], more, number[-1] + 1) for x, _, more in (by_list, by_group)]
        whole = work[0] > 2 * work[1]
        for (of, behind, more), taken in ((by_list, ~whole), (by_group, whole)):
            at = np.flatnonzero(taken[number[of]] & (more > 0))
            for a, z in _ranges(more[at], 1_000_000):
                own, m = at[a:z], more[at[a:z]]
                left = np.repeat(own, m)
                right = np.repeat(behind[own] - np.cumsum(m) + m, m) + np.arange(len(left))
                x, y = np.maximum(of[left], of[right]), np.minimum(of[left], of[right])
                apart = label[x] != label[y]
                new = pairs(x[apart], y[apart])
                yes = _of_ranges(new, lambda i, k: _confirmed(around[i], around[k], min_words, identity), n)
                if yes.any():
                    sure = np.unique(np.concatenate([sure, new[yes]]))
                    label = _labels(n, sure // n, sure % n)
                    new = new[~yes]
                    new = new[label[new // n] != label[new % n]]
                out.append(new[_of_ranges(new, lambda i, k: _sharing(runs[i], runs[k]) >= least, n)])
    rest = np.unique(np.concatenate([none, *out]))
    rest = rest[label[rest // max(n, 1)] != label[rest % max(n, 1)]]
    i, k = sure // max(n, 1), sure % max(n, 1)
    forest = np.append(True, i[1:] != i[:-1])[: len(i)]
    held = _labels(n, i[forest], k[forest])
    out = [sure[forest | (held[i] != held[k])], rest]
    found = np.unique(np.concatenate(out))
    return found // max(n, 1), found % max(n, 1)


def _near(x: np.ndarray, y: np.ndarray, min_words: int, identity: float) -> np.ndarray:
    """Whether of some ``min_words`` words in a row of x all but the unlike ones have an equal word in y that is no farther off than unlike words can shift it.

    That holds for each two passages of which ``least_shared`` is told, and seldom for places that share a phrase shorter than a passage.
    """
    unlike = int((1 - identity) * min_words + 1e-9)
    shift = max(unlike, int(min_words / identity) - min_words)
    wide, width = np.pad(y, ((0, 0), (shift, shift))), x.shape[1]
    there = np.zeros(x.shape, bool)
    for d in range(2 * shift + 1):
        there |= x == wide[:, d : d + width]
    sums = np.cumsum(np.pad(there & (x > 0), ((0, 0), (1, 0))), axis=1, dtype=np.int32)
    return (sums[:, min_words:] - sums[:, :-min_words] >= min_words - unlike).any(axis=1)


def _alike(min_words: int, identity: float):
    """Matches of ``alike`` places, from places in the order of h, part, doc_id, row, w; a seed's places are never parted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, last = 0, None

        def found() -> pa.RecordBatch:
            places = pa.Table.from_batches(held)
            h, part, row, doc, w = (places.column(c).to_numpy() for c in ("h", "part", "row", "doc_id", "w"))
            around = np.frombuffer(b"".join(places.column("around").to_pylist()), np.uint8).reshape(len(h), -1)
            group = np.cumsum(np.append(True, (h[1:] != h[:-1]) | (part[1:] != part[:-1])))
            i, k = alike(group, doc, around, min_words, identity)
            tests = (_near, _confirmed)
            passed = [_of_ranges(i * len(h) + k, lambda i, k, t=t: t(around[i], around[k], min_words, identity), len(h)) for t in tests]
            i, k = i[passed[0] | passed[1]], k[passed[0] | passed[1]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (row[i], row[k], w[i], w[k], np.ones(len(i), bool))], names=["row", "src", "w", "sw", "long"])

        for batch in batches:
            h, part = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("h", "part"))
            at = 0
            while at < len(h):
                new = np.flatnonzero((h[at:] != h[at]) | (part[at:] != part[at]))
                end = at + int(new[0]) if len(new) else len(h)
                if last != (h[at], part[at]) and rows >= PLACES:
                    yield found()
                    held, rows = [], 0
                held.append(batch.slice(at, end - at))
                rows, last, at = rows + end - at, (h[at], part[at]), end
        if held:
            yield found()

    return run


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows whose seeds add up to about DEALT at a time: their ids and doc_ids, and their seeds, words, and places among those rows, one after the other."""
    for batch in batches:
        row, doc_id, hs, ws = (batch.column(batch.schema.get_field_index(c)) for c in ("row", "doc_id", "hs", "ws"))
        ends, w_ends = hs.offsets.to_numpy(), ws.offsets.to_numpy()
        h, w = hs.values.to_numpy(zero_copy_only=False).view(np.uint64), ws.values.to_numpy(zero_copy_only=False)
        ids, docs = row.to_numpy(zero_copy_only=False), doc_id.to_numpy(zero_copy_only=False)
        at = 0
        while at < len(ids):
            end = max(at + 1, int(np.searchsorted(ends, ends[at] + DEALT, "right")) - 1)
            of = np.repeat(np.arange(end - at), np.diff(ends[at : end + 1]))
            yield ids[at:end], docs[at:end], h[ends[at] : ends[end]], w[w_ends[at] : w_ends[end]], of
            at = end


def _joined(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    for held in batches_of(batches, lambda b: b.num_rows, most):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def chains(matches: list[tuple[int, int]], gap: float = GAP) -> list[list[int]]:
    """Collinear chains of (p, q) matches, best first, as lists of places in ``matches``; each match is in one chain.

    f(i) = K + max(0, max over p_j < p_i, q_j < q_i of f(j) - gap * ((p_i - p_j) + (q_i - q_j))); the inner
    maximum is a prefix maximum of f(j) + gap * (p_j + q_j) over q, held in a Fenwick tree.
    """
    order = sorted(range(len(matches)), key=lambda i: (matches[i][0], -matches[i][1]))
    score, before = [0.0] * len(matches), [-1] * len(matches)
    if len({p - q for p, q in matches}) == 1 == len(matches) - len(set(matches)) + 1:
        # All on one diagonal: the neighbour is the best predecessor.
        last = -1
        for i in order:
            gain = score[last] - 2 * gap * (matches[i][0] - matches[last][0]) if last >= 0 else -1.0
            score[i] = K + max(0.0, gain)
            before[i] = last if gain > 0 else -1
            last = i
    else:
        ranks = {q: k + 1 for k, q in enumerate(sorted({q for _, q in matches}))}
        tree: list[tuple[float, int]] = [(-1.0, -1)] * (len(ranks) + 1)
        for i in order:
            p, q = matches[i]
            k, best = ranks[q] - 1, (-1.0, -1)
            while k > 0:
                best = max(best, tree[k])
                k -= k & -k
            gain = best[0] - gap * (p + q)
            score[i] = K + max(0.0, gain)
            before[i] = best[1] if gain > 0 else -1
            k, value = ranks[q], (score[i] + gap * (p + q), i)
            while k < len(tree):
                if value > tree[k]:
                    tree[k] = value
                k += k & -k
    used, out = [False] * len(matches), []
    for i in sorted(range(len(matches)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


_LINKS = "row long, src long, p array<int>, q array<int>, sizes array<int>"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chains of each pair of rows, one after the other, from matches in the order of row, src, w, sw. A single match counts if the words around it are alike (long)."""
    held: list[np.ndarray] = []

    def pairs(row, src, w, sw, long) -> Iterator[tuple]:
        new = np.append(True, (row[1:] != row[:-1]) | (src[1:] != src[:-1]))
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(row))
        whole = np.logical_or.reduceat(long, starts) if len(row) else np.empty(0, bool)
        for k in np.flatnonzero((ends - starts >= LEAST_SEEDS) | whole).tolist():
            a, z = starts[k], ends[k]
            m = list(dict.fromkeys(zip(w[a:z].tolist(), sw[a:z].tolist(), strict=True)))
            every = chains(m)
            some = [c for c in every if len(c) >= LEAST_SEEDS] or (every[:1] if whole[k] else [])
            if some:
                yield int(row[a]), int(src[a]), [m[i][0] for c in some for i in c], [m[i][1] for c in some for i in c], [len(c) for c in some]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 3)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["row", "src", "p", "q", "sizes"])

    for b in batches:
        columns = [b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("row", "src", "w", "sw", "long")]
        if held:
            columns = [np.concatenate(c) for c in zip(held, columns, strict=True)]
        # the last pair may go on in the next batch
        row, src = columns[:2]
        n = len(row)
        cut = n - int(np.argmin(np.append(((row == row[-1]) & (src == src[-1]))[::-1], False))) if n else 0
        held = [c[cut:] for c in columns]
        for rows in batches_of(pairs(*(c[:cut] for c in columns)), lambda r: len(r[2]) + 10, 50_000):
            yield batch(rows)
    if held:
        for rows in batches_of(pairs(*held), lambda r: len(r[2]) + 10, 50_000):
            yield batch(rows)


def common_words(x: list[bytes], y: list[bytes]) -> int:
    """Length of a longest common subsequence, by bit-parallel rows: one addition of len(x) bits for each word of y."""
    a, z, n = 0, 0, min(len(x), len(y))
    while a < n and x[a] == y[a]:
        a += 1
    while z < n - a and x[-1 - z] == y[-1 - z]:
        z += 1
    x, y = x[a : len(x) - z], y[a : len(y) - z]
    if not x or not y:
        return a + z
    places: dict[bytes, int] = {}
    for k, word in enumerate(x):
        places[word] = places.get(word, 0) | 1 << k
    full = (1 << len(x)) - 1
    row = full
    for word in y:
        hit = row & places.get(word, 0)
        row = (row + hit | row - hit) & full
    return a + z + len(x) - row.bit_count()


#: Words of x and y that are passed over where the sequences come together again with two equal words.
_SHIFTS = ((0, 1), (1, 0), (1, 2), (2, 1), (0, 2), (2, 0), (2, 2))


def extended(x: list[bytes], y: list[bytes], i: int, j: int, step: int) -> tuple[int, int, int, bool]:
    """How far x from i and y from j on run alike, allowing for a drop of DROP: words of x and y, equal ones, and whether x alone ended too soon to tell."""
    score = best = same = equal = 0
    a, b, top = i, j, (i, j)

    def at(k: int, n: int) -> bool:
        u, v = a + step * k, b + step * n
        return 0 <= u < len(x) and 0 <= v < len(y) and x[u] == y[v]

    while 0 <= a < len(x) and 0 <= b < len(y):
        if x[a] == y[b]:
            score, equal = score + 1, equal + 1
            a, b = a + step, b + step
            if score > best:
                best, same, top = score, equal, (a, b)
            continue
        p, q = (1, 1) if at(1, 1) else next(((p, q) for p, q in _SHIFTS if at(p, q) and at(p + 1, q + 1)), (1, 1))
        score -= max(p, q)
        a, b = a + step * p, b + step * q
        if score < best - DROP:
            return abs(top[0] - i), abs(top[1] - j), same, False
    return abs(top[0] - i), abs(top[1] - j), same, 0 <= b < len(y)


def aligned(p: list[int], q: list[int], x: list[bytes], y: list[bytes], told: list[int], min_words: int, identity: float) -> tuple[list[tuple[int, int, int, int, int]], bool, bool]:
    """start, end, source's start and end, equal words of the passages in a chain; and whether x ended too soon to the left or right.

    A part of the chain that reaches both bounds is never parted. ``told``: for each place in x the words before it that repeat
    neither of the two before them.
    """
    gains = [0]
    for i, j, a, b in zip(p, q, p[1:], q[1:], strict=False):
        over = max(i + K - a, j + K - b, 0)
        gains.append(common_words(x[i + K : a + over], y[j + K : b + over]) + K - over)
    till = list(accumulate(gains))
    out, todo, open_left, open_right = [], [(0, len(p))], False, False
    while todo:
        low, high = todo.pop()
        left, left_y, more, short = extended(x, y, p[low] - 1, q[low] - 1, -1)
        open_left |= short
        right, right_y, same, short = extended(x, y, p[high - 1] + K, q[high - 1] + K, 1)
        open_right |= short
        s, e, ss, se = p[low] - left, p[high - 1] + K + right, q[low] - left_y, q[high - 1] + K + right_y
        n = K + till[high - 1] - till[low] + more + same
        if min(told[e] - told[s], se - ss) < min_words:
            continue
        if n / max(e - s, se - ss) >= identity:
            out.append((s, e, ss, se, n))
        elif high - low > 1:
            at = max(range(low + 1, high), key=lambda k: max(p[k] - p[k - 1], q[k] - q[k - 1]))
            todo += [(at, high), (low, at)]
    return out, open_left, open_right


def _cut(margin: int | None):
    """Of each row's text the words around its chains (x, from word ``at`` on; ``end`` if it reaches the text's end)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words = None, []
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                xs, ats, ends = [], [], []
                for row, p, text in zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in ("row", "p", "text")), strict=True):
                    if row != last:
                        last, words = row, folded(text).split()
                    a, z = (max(min(p) - margin, 0), max(p) + K + margin) if margin is not None else (0, len(words))
                    xs.append(b" ".join(words[a:z]))
                    ats.append(a)
                    ends.append(z >= len(words))
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(xs, pa.binary()), pa.array(ats, pa.int32()), pa.array(ends)], names=[*kept.schema.names, "x", "at", "end"])

    return cut


_FOUND = "doc_id long, text_hash long, src_id long, src_hash long, start_word long, end_word long, src_start long, src_end long, n_equal long, identity double"


def _passages(min_words: int, identity: float):
    """The passages of each pair; instead, where its x is too short to tell, one row that names the pair (row, src)."""
    names = [f.split()[0] for f in f"{_FOUND}, row long, src long".split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, y = None, []
        columns = ("row", "src", "doc_id", "src_id", "p", "q", "sizes", "x", "at", "end", "tid", "src_tid", "text")
        for batch in batches:
            rows = []
            for row, src, doc_id, src_id, p, q, sizes, x, at, end, tid, src_tid, text in arrow_texts(iter([batch]), *columns):
                if src != last:
                    last, y = src, folded(text).split()
                x, k, found, short = x.split(), 0, [], False
                told = [0, *accumulate(i == 0 or w != x[i - 1] and (i < 2 or w != x[i - 2]) for i, w in enumerate(x))]
                for n in sizes:
                    got, left, right = aligned([i - at for i in p[k : k + n]], q[k : k + n], x, y, told, min_words, identity)
                    found += got
                    short |= left and at > 0 or right and not end
                    k += n
                if short:
                    rows.append((*[None] * 10, row, src))
                    continue
                apart = []
                for a in sorted(set(found), key=lambda f: (f[0] - f[1], f)):
                    if not any(b[0] <= a[0] and a[1] <= b[1] and b[2] <= a[2] and a[3] <= b[3] for b in apart):
                        apart.append(a)
                rows += [(doc_id, tid, src_id, src_tid, s + at, e + at, ss, se, n, n / max(e - s, se - ss), None, None) for s, e, ss, se, n in apart]
            if rows:
                kinds = (*[pa.int64()] * 9, pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def _align(links: DataFrame, texts: DataFrame, margin: int | None, min_words: int, identity: float) -> DataFrame:
    """The passages of the links (and pairs to be aligned on more words), from texts: row, doc_id, tid, text."""
    left = links.hint("merge").join(texts, "row").select("row", "src", "p", "q", "sizes", "doc_id", "tid", "text")
    left = left.mapInArrow(_cut(margin), f"{_LINKS}, doc_id long, tid long, x binary, at int, end boolean")
    source = texts.select(F.col("row").alias("src"), F.col("doc_id").alias("src_id"), F.col("tid").alias("src_tid"), "text")
    return stored(left.hint("merge").join(source, "src").mapInArrow(_passages(min_words, identity), f"{_FOUND}, row long, src long"), "chain-found")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each occurrence with the first and the last one before it of another row of smaller doc_id; from occurrences in the order of h, part, doc_id, row, w.

    What went before a batch is carried along as up to three occurrences: the first of the group, the last of the row before, the last.
    """
    before = None
    names = ("h", "part", "doc_id", "row", "w")
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names]
        skip = 0 if before is None else len(before[0])
        if skip:
            columns = [np.concatenate(c) for c in zip(before, columns, strict=True)]
        h, part, doc, row, w = columns
        at = np.arange(len(h))
        group = np.append(True, (h[1:] != h[:-1]) | (part[1:] != part[:-1]))
        run = group | np.append(True, row[1:] != row[:-1])
        first = np.maximum.accumulate(np.where(group, at, 0))
        own = np.maximum.accumulate(np.where(run, at, 0))
        prior = np.where(group[own], first, own - 1)  # in the group's first row there is none; the first occurrence is of the same row then
        fresh = at >= skip
        a = np.flatnonzero(fresh & (doc[first] < doc))
        c = np.flatnonzero(fresh & (doc[prior] < doc) & (prior != first))
        i, k = np.concatenate([a, c]), np.concatenate([first[a], prior[c]])
        last = len(h) - 1
        keep = np.unique([first[last], prior[last], last])
        before = [x[keep] for x in columns]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (row[i], row[k], w[i], w[k], np.zeros(len(i), bool))], names=["row", "src", "w", "sw", "long"])


_MATCHES = "row long, src long, w int, sw int, long boolean"


def matches(spread: DataFrame, groups: int, around: DataFrame, min_words: int, identity: float) -> DataFrame:
    """row, src, w, sw, long: each occurrence with the first and with the last one before it of another row of smaller doc_id, and (long) the ``alike`` ones."""
    dealt = spread.repartition("h", "part").sortWithinPartitions("h", "part", "doc_id", "row", "w")
    out = dealt.mapInArrow(_neighbours, _MATCHES)
    if groups > 1:
        heads = spread.where("part > 0").groupBy("h", "part").agg(F.min(F.struct("doc_id", "row", "w")).alias("s"))
        heads = stored(heads.select("h", "s"), "chain-heads")
        least = stored(heads.groupBy("h").agg(F.min("s").alias("f")), "chain-least")
        out = out.union(heads.join(least, "h").where("f.doc_id < s.doc_id").select("s.row", F.col("f.row").alias("src"), "s.w", F.col("f.w").alias("sw"), F.lit(False).alias("long")))
    places = around.repartition("h", "part").sortWithinPartitions("h", "part", "doc_id", "row", "w")
    return out.union(places.mapInArrow(_alike(min_words, identity), _MATCHES))


def passages(docs: DataFrame, min_words: int = MIN_WORDS, identity: float = IDENTITY) -> DataFrame:
    """doc_id, text_hash, src_id, src_hash, start_word, end_word, src_start, src_end, n_equal, identity: passages of doc_id that src_id, an earlier document, has.

    Words are cut at spaces and 0x09-0x0D and compared with A-Z in lower case; ends are exclusive. Null, empty and short
    texts have no passages. Rows without doc_id take no part. Rows equal in doc_id and text are one; several texts of a doc_id are told
    apart by text_hash (xxhash64 of the text) and are not compared with each other. A text that an earlier document has as well is a
    passage of full length of the first document that has it, and its other passages are those of that document. Where passages of
    several earlier documents meet in one place, each is a row. Other columns are not read.
    """
    tid = F.xxhash64("text")
    rows = docs.where("doc_id is not null and text is not null").select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", tid.alias("tid"), "text")
    classes = rows.groupBy("tid").agg(F.min(F.struct("doc_id", "row")).alias("f")).select("tid", F.col("f.doc_id").alias("src_id"), F.col("f.row").alias("src"))
    classes = stored(classes, "chain-classes")
    share = docs.sparkSession.sparkContext.broadcast
    firsts = share(bit_set(classes.select(F.col("src").alias("key"))))
    marks = stored(rows.mapInArrow(_marks(firsts), "row long, doc_id long, tid long, n_words long, hs array<long>, ws array<int>, ks binary"), "chain-marks", "lz4")
    counted = stored(marks.select(F.explode("hs").alias("key")).groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "chain-counts", "lz4")
    known, common, hot, hottest = (share(bit_set(counted.where(F.col("m") > least))) for least in (1, COMMON, HOT, BLOCK))
    most = counted.agg(F.max("m").alias("m")).first()["m"] or 0
    groups, parts = -(-most // HOT), -(-most // BLOCK)
    spread = marks.select("row", "doc_id", "hs", "ws").mapInArrow(_spread(known, hot, groups), "h long, part int, row long, doc_id long, w int")
    around = marks.select("row", "doc_id", "hs", "ws", "ks").mapInArrow(_around(common, hottest, parts, min_words + BEYOND), "h long, part int, row long, doc_id long, w int, around binary")
    found = matches(spread, groups, around, min_words, identity).repartition("row", "src").sortWithinPartitions("row", "src", "w", "sw")
    links = stored(found.mapInArrow(_chain, _LINKS), "chain-links")
    named = share(bit_set(links.select(F.explode(F.array("row", "src")).alias("key"))))
    texts = rows.mapInArrow(rows_named(named, "row"), "row long, doc_id long, tid long, text string")
    texts = texts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("tid").alias("tid"), F.first("text").alias("text"))
    out = _align(links, texts, MARGIN, min_words, identity)
    longer = out.where("src is not null").select("row", "src")
    if not longer.isEmpty():
        out = out.where("src is null").union(_align(links.join(longer, ["row", "src"], "left_semi"), texts, None, min_words, identity))
    same = marks.where(F.col("n_words") >= min_words).join(classes, "tid").where("src_id < doc_id")
    zero = F.lit(0).cast("long")
    same = same.select("doc_id", F.col("tid").alias("text_hash"), "src_id", F.col("tid").alias("src_hash"), zero, F.col("n_words"), zero, F.col("n_words"), F.col("n_words"), F.lit(1.0)).distinct()
    return out.drop("row", "src").union(same)


def op10_chain_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"))
