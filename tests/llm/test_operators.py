"""Each operator against brute force, an exact round trip or held-out accuracy, and on odd inputs."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, odd, words
from tidemark.llm import chain_dedup, components, decontaminate, kneser_ney, language_id, line_dedup, media_chunks, mixing, parity_join, ppm_score, secrets
from tidemark.llm.common import crc32_of


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# -- language identification ------------------------------------------------

ALPHABETS = {"aa": "abcdefg", "bb": "hijklmn"}


def spoken(lang, n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(ALPHABETS[lang]) for _ in range(r.randrange(2, 8))) for _ in range(n))


def test_language_held_out(spark, make):
    train = make([(spoken(la, 40, k), la, "s") for k in range(12) for la in ALPHABETS])
    model = language_id.train(train)
    held = make([(spoken(la, 10, 100 + k), la, "s") for k in range(10) for la in ALPHABETS])
    out = language_id.identify(held, model, "doc_id", "lang").collect()
    assert all(r["lang"] == r["lang_pred"] and 0.5 < r["score"] <= 1 for r in out)


def test_language_odd(spark):
    model = language_id.train(odd(spark))
    rows = {(r["doc_id"], r["lang_pred"]) for r in language_id.identify(odd(spark), model, "doc_id").collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= rows
    none = language_id.train(empty(spark))
    assert {r["lang_pred"] for r in language_id.identify(odd(spark), none, "doc_id").collect()} == {"und"}
    assert language_id.identify(empty(spark), model, "doc_id").count() == 0


def brute_language(train, text):
    """Posterior of each language by the definition, from buckets."""
    counts, docs = {}, {}
    for t, lang in train:
        counts.setdefault(lang, np.zeros(language_id.BUCKETS))
        docs[lang] = docs.get(lang, 0) + 1
        for b in language_id.bucket_lists([t])[0]:
            counts[lang][b] += 1
    total = {}
    for lang, c in counts.items():
        logs = np.log((c + 0.5) / (c.sum() + 0.5 * language_id.BUCKETS))
        total[lang] = np.log(docs[lang] / sum(docs.values())) + sum(logs[b] for b in language_id.bucket_lists([text])[0])
    top = max(sorted(total), key=total.get)
    return top, 1 / sum(np.exp(v - total[top]) for v in total.values())


@pytest.mark.parametrize("block", [language_id.BLOCK, 1])
def test_language_against_brute_force(make, monkeypatch, block):
    monkeypatch.setattr(language_id, "BLOCK", block)
    monkeypatch.setattr(language_id, "HELD", 1)
    train = [(spoken(la, 6, k), la) for k in range(5) for la in ALPHABETS] + [("abc hij", "cc"), ("abc hij", "dd")]
    model = language_id.train(make([(t, la, "s") for t, la in train]))
    texts = ["ab hi", "abc hij", "g", "Zz é 12", spoken("aa", 30, 50)]
    for r, t in zip(language_id.identify(make(texts), model, "doc_id").orderBy("doc_id").collect(), texts, strict=True):
        lang, score = brute_language(train, t)
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, rel=1e-3)


def test_language_of_very_many(make):
    labelled = make([(f"{chr(97 + k % 26) * 3} {chr(97 + k // 26) * 4} text", f"x{k:03}", "s") for k in range(300)])
    model = language_id.train(labelled)
    assert len(model.blocks) == 2
    rows = language_id.identify(labelled, model, "lang").collect()
    assert len(rows) == 300 and all(0 < r["score"] <= 1 for r in rows) and sum(r["lang"] == r["lang_pred"] for r in rows) > 250


def test_language_digits_are_no_letters(make):
    model = language_id.train(make([("abc def", "aa", "s")]))
    assert language_id.identify(make(["123 456 !!"]), model, "doc_id").first()["lang_pred"] == "und"


# -- language-model scores --------------------------------------------------


def brute_ppm(train, text):
    from collections import Counter, defaultdict

    trie = defaultdict(Counter)
    pad = lambda t: bytes([0xFE]) * 5 + (t or "").encode() + b"\xff"
    for t in train:
        b = pad(t)
        for j in range(5, len(b)):
            for k in range(6):
                trie[b[j - k : j]][b[j]] += 1
    b, total = pad(text), 0.0
    for j in range(5, len(b)):
        gone = set()
        for k in range(5, -1, -1):
            left = {a: v for a, v in trie.get(b[j - k : j], {}).items() if a not in gone}
            if not left:
                continue
            n = sum(left.values())
            if b[j] in left:
                total += np.log10((2 * left[b[j]] - 1) / (2 * n))
                break
            total += np.log10(len(left) / (2 * n))
            gone = set(trie[b[j - k : j]])
        else:
            total -= np.log10(255 - len(gone))
    return total


@pytest.mark.parametrize("bound", [1 << 21, 20])
def test_ppm(spark, make, monkeypatch, bound):
    monkeypatch.setattr(ppm_score, "STRINGS", bound)
    monkeypatch.setattr(ppm_score, "WORDS", bound)
    texts = ["the cat sat", "the dog sat on the cat", "The Cat é", None, "", "zzz qqq the", "the cat sat"]
    df = make(texts)
    held = {r["doc_id"]: r["h"] for r in df.select("doc_id", (crc32_of("doc_id") % 3 == 0).alias("h")).collect()}
    train = [t for k, t in enumerate(texts) if not held[k]]
    out = {r["doc_id"]: r for r in ppm_score.lm_scores(df, crc32_of("doc_id") % 3 == 0).collect()}
    tokens = [w for t in train for w in [*(t or "").lower().split(), None]]
    n, v = len(tokens), len(set(tokens))
    for k, t in enumerate(texts):
        own = [*(t or "").lower().split(), None]
        base = sum(np.log10((tokens.count(w) + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        r = out[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in tokens for w in own), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(brute_ppm(train, t))


def test_ppm_of_texts_longer_than_a_piece(make, monkeypatch):
    monkeypatch.setattr(ppm_score, "PIECE", 64)
    monkeypatch.setattr(ppm_score, "HELD", 100)
    monkeypatch.setattr(ppm_score, "TEXT_BYTES", 50)
    monkeypatch.setattr(ppm_score, "ROWS", 7)
    texts = [" ".join(words(60, 5)), " ".join(words(40, 6, "v")), "w1 v2"]
    for r, t in zip(ppm_score.lm_scores(make(texts), F.col("doc_id") == 1).orderBy("doc_id").collect(), texts, strict=True):
        assert r["score"] == pytest.approx(brute_ppm([texts[0], texts[2]], t)) and r["n_tokens"] == len(t.split()) + 1


def test_ppm_without_training(spark, make):
    r = ppm_score.lm_scores(make(["ab"]), F.lit(True)).first()
    assert r["score"] == pytest.approx(-3 * np.log10(255)) and r["n_known"] == 0
    assert ppm_score.lm_scores(empty(spark), F.lit(False)).count() == 0


# -- quality ----------------------------------------------------------------


def test_quality(spark, make, monkeypatch):
    monkeypatch.setattr(kneser_ney, "TRAIN_DOCS", 60)
    r = random.Random(3)
    vocabulary = words(50, 5)
    clean = [" ".join(r.choice(vocabulary) for _ in range(40)) for _ in range(120)]
    junk = [" ".join(f"{w}###" for w in words(40, k, "junk")) for k in range(10)]
    df = make([*clean, *junk, None, ""])
    labels = spark.createDataFrame([(k, 1, 0) for k in range(100)], "doc_id long, quality int, toxic int")
    keep = {x["doc_id"]: x["keep"] for x in kneser_ney.classify(df, labels).collect()}
    assert all(keep[k] for k in range(120)) and not any(keep[k] for k in range(120, 132))


def test_quality_of_few_trusted(spark, make):
    """Fewer trusted rows than TRAIN_DOCS: the limits must come from rows that the model has not seen."""
    r, vocabulary = random.Random(31), words(1000, 32)
    clean = [" ".join(r.choice(vocabulary) for _ in range(60)) for _ in range(300)]
    df = make([*clean, *(" ".join(words(60, k, "junk")) for k in range(20))])
    labels = spark.createDataFrame([(k, 1, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    keep = {x["doc_id"]: x["keep"] for x in kneser_ney.classify(df, labels).collect()}
    assert sum(keep[k] for k in range(200, 300)) >= 95 and not any(keep[k] for k in range(300, 320))


def test_quality_learns_from_all_trusted(spark, make, monkeypatch):
    """Of 5,000 trusted documents all but the held-out fifth train the model."""
    seen = []

    class Told(kneser_ney.Model):
        def __init__(self, texts):
            seen.append(texts.count())
            super().__init__(texts)

    monkeypatch.setattr(kneser_ney, "Model", Told)
    df = make([f"own{k} word" for k in range(5_000)])
    labels = spark.createDataFrame([(k, 1, 0) for k in range(5_000)], "doc_id long, quality int, toxic int")
    assert kneser_ney.classify(df, labels).count() == 5_000 and abs(seen[0] - 4_000) < 10


def test_quality_limits_of_every_language(spark):
    """Four languages of 20 to 400 trusted rows, all with a limit of their own that is the weighted mean of logarithms."""
    r = random.Random(8)
    rows = [(lang, scale * r.lognormvariate(0, 0.3)) for lang, n, scale in (("a", 20, 10.0), ("b", 60, 1000.0), ("c", 150, 100.0), ("d", 400, 30.0)) for _ in range(n)] + [(None, 5.0)]
    got = {x["lang"]: x for x in kneser_ney.limits(spark.createDataFrame(rows, "lang string, perplexity double"), 0.9).collect()}

    def quantile(values):
        return sorted(values)[math.ceil(0.9 * len(values)) - 1]

    every = quantile([p for _, p in rows])
    for lang in ("a", "b", "c", "d", None):
        own = [p for x, p in rows if x == lang]
        w = len(own) / (len(own) + kneser_ney.PRIOR)
        assert math.isclose(got[lang]["most"], math.exp(w * math.log(quantile(own)) + (1 - w) * math.log(every)), rel_tol=1e-6) and got[lang]["n"] == len(own)
    assert len({x["most"] for x in got.values()}) == 5


def brute_kneser_ney(train):
    """Probability of c after a, b under the interpolated modified model, by its definition."""
    from collections import Counter

    c3 = Counter(tuple(w[k : k + 3]) for t in train if t for w in [["<s>", "<s>", *t.split(), "</s>"]] for k in range(len(w) - 2))
    c2 = Counter(g[1:] for g in c3)
    c1 = Counter(g[1:] for g in c2)

    def cuts(counts):
        of = Counter(counts.values())
        d = kneser_ney.discounts(of)
        return lambda n: d[min(n, 3) - 1]

    d1, d2, d3 = map(cuts, (c1, c2, c3))
    total = sum(c1.values())
    unknown = sum(map(d1, c1.values())) / total / (len(c1) + 1)

    def one(c):
        n = c1.get((c,), 0)
        return (n - d1(n)) / total + unknown if n else unknown

    def above(counts, cut, history, c, lower):
        own = {g[-1]: n for g, n in counts.items() if g[:-1] == history}
        if not own:
            return lower
        n = own.get(c, 0)
        return (max(n - cut(n), 0) if n else 0) / sum(own.values()) + sum(map(cut, own.values())) / sum(own.values()) * lower

    return lambda a, b, c: above(c3, d3, (a, b), c, above(c2, d2, (b,), c, one(c)))


@pytest.mark.parametrize("top", [1 << 20, 4, 0])
def test_perplexities_against_brute_force(make, monkeypatch, top):
    monkeypatch.setattr(kneser_ney, "TOP", top)
    r = random.Random(12)
    train = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 30))) for _ in range(25)] + [None, ""]
    p = brute_kneser_ney(train)
    assert sum(p("a", "b", c) for c in [*"abcdefgh", "</s>", "?"]) == pytest.approx(1)
    texts = ["a b c d", "b", "x y a b", "h h h h h a x", train[3], "", None, " ".join(r.choice("abcx") for _ in range(200))]
    out = kneser_ney.perplexities(make(texts), kneser_ney.Model(make(train)), "doc_id").orderBy("doc_id").collect()
    for row, t in zip(out, texts, strict=True):
        w = ["<s>", "<s>", *(t or "").split(), "</s>"]
        assert row["n_words"] == len(w) - 3
        if len(w) == 3:
            assert row["perplexity"] is None
        else:
            assert row["perplexity"] == pytest.approx(np.exp(-np.mean([np.log(p(*w[k : k + 3])) for k in range(len(w) - 2)])))


def test_quality_with_a_very_long_trusted_text(spark, make):
    df = make([" ".join(words(30_000, 5)), *(" ".join(words(20, k)) for k in range(10, 20))])
    labels = spark.createDataFrame([(k, 1, 0) for k in range(10)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    out = kneser_ney.classify(df, labels).collect()
    assert len(out) == 11 and all(r["perplexity"] > 1 for r in out)


def test_quality_odd(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = kneser_ney.classify(odd(spark), none).collect()
    assert len(out) == 8 and {r["doc_id"] for r in out if not r["keep"]} == {1, 2, 3}


# -- lines ------------------------------------------------------------------


def brute_lines(texts, window=3, long=10):
    seen, out = set(), []
    for t in texts:
        lines = line_dedup.lines_of(t)
        gone = set()
        for k, x in lines:
            if len(x.split()) >= long:
                gone |= {k} if x in seen else set()
                seen.add(x)
        for s in range(len(lines) - window + 1):
            run = tuple(x for _, x in lines[s : s + window])
            if run in seen:
                gone.update(k for k, _ in lines[s : s + window])
            seen.add(run)
        out.append(sorted(gone))
    return out


def test_lines_against_brute_force(make):
    r = random.Random(1)
    long = [" ".join(words(n, n)) for n in (9, 10, 60)]
    texts = ["\n".join(r.choice(["a", "b", "c", "", " a ", "d"]) for _ in range(r.randrange(0, 14))) for _ in range(60)] + [None]
    texts += ["\n".join(r.choice([*long, f"e{k}"]) for _ in range(r.randrange(0, 5))) for k in range(12)]
    out = line_dedup.without_repeats(make(texts)).select("rest.doc_id", "removed", "text").orderBy("doc_id").collect()
    assert [x["removed"] for x in out] == brute_lines(texts)


def test_lines_odd(spark):
    assert line_dedup.clean(odd(spark)).columns == odd(spark).columns
    # 5 has the one long line that 4 has
    assert sorted(r["doc_id"] or 0 for r in line_dedup.clean(odd(spark)).collect()) == [0, 1, 2, 3, 4, 4, 6]
    assert line_dedup.clean(empty(spark)).count() == 0
    assert line_dedup.clean(odd(spark), long=None).count() == 8
    dotted = odd(spark).withColumnRenamed("label", "a.b")
    assert line_dedup.clean(dotted).columns == dotted.columns


def test_lines_have_one_plan_at_every_size(make):
    """Few runs are joined with the texts as many are, so what is shuffled grows with the input and does not jump."""
    out = line_dedup.without_repeats(make(["\n".join("abc"), "\n".join("abc"), "d"]))
    assert sorted((r["text"] for r in out.collect()), key=len) == ["", "d", "a\nb\nc"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_winnow_guarantee():
    r = np.random.default_rng(1)
    for _ in range(50):
        shared = r.integers(0, 1 << 40, 5)
        a, b = (np.concatenate([r.integers(0, 1 << 40, 7), shared, r.integers(0, 1 << 40, 6)]) for _ in range(2))
        assert set(a[line_dedup.winnow(a, 5)]) & set(b[line_dedup.winnow(b, 5)]) & set(shared)


# -- benchmark --------------------------------------------------------------


def test_leaks(spark, make):
    item = words(40, 9)
    texts = [" ".join([*words(500, 1), *item, *words(500, 2)]), " ".join([*words(20, 3), *item[:20]]), " ".join([*item[:17], "x", *item[18:]]), "tiny one two", None, "", "ab CD", " ".join(item).upper()]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "ab cd"), (3, None), (4, ""), (5, "nothing like it")], "item_id long, text string")
    want = {(0, 1), (2, 1), (6, 2), (7, 1)}
    for bound in (decontaminate.INDEX_BOUND, 0):
        out = decontaminate.leaks(make(texts), items, bound=bound)
        assert {(r["doc_id"], r["item_id"]) for r in out.collect()} == want
    assert decontaminate.clean(odd(spark), items).count() == 8


def brute_leaks(docs, items):
    def shingles(t, n):
        w = (t or "").lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()

    out = set()
    for item_id, item in items:
        n = min(5, len((item or "").split()))
        own = shingles(item, n)
        out |= {(d, item_id, len(own), len(own & shingles(t, n))) for d, t in docs if own and 100 * len(own & shingles(t, n)) >= 75 * len(own)}
    return out


@pytest.mark.parametrize("bound", [decontaminate.INDEX_BOUND, 0])
def test_leaks_of_null_and_repeated_ids(spark, bound):
    """Both ways against brute force: null ids on both sides, ids with several texts, short items, items larger than the signature."""
    r = random.Random(13)
    long, short = words(60, 14), words(12, 15)
    items = [(1, " ".join(long)), (1, " ".join(short)), (None, " ".join(words(8, 16))), (2, "alpha beta"), (3, None), (4, ""), (2, "alpha beta")]
    halves = [" ".join(long[:34]), " ".join(long[26:])]
    docs = [(1, halves[0]), (1, halves[1]), (None, " ".join(["x", *words(8, 16)])), (2, "so Alpha BETA it"), (3, None), (3, " ".join(short)), (4, " ".join(long)), (4, " ".join(long))]
    for k in range(5, 40):
        w = list(r.choice([long, short]))
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = "edit"
        docs.append((k, " ".join(["in", *w, "out"])))
    out = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), bound=bound).collect()
    assert len(out) == len(set(out)) and set(map(tuple, out)) == brute_leaks(docs, items)


def test_leaks_of_no_rows(spark):
    items = spark.createDataFrame([(1, "some item")], "item_id long, text string")
    assert decontaminate.leaks(empty(spark), items).count() == 0


# -- media ------------------------------------------------------------------


def test_media_round_trip(spark, make):
    r = random.Random(2)
    long = "".join(chr(r.randrange(32, 500)) for _ in range(60_000))
    texts = [None, "", "a" * 64, "b", long, long[:30_000] + "edit" + long[30_000:], long]
    lists, media, chunks = media_chunks.store_media(make(texts))
    out = {bytes(x["sha"]): x for x in media_chunks.read_media(media, chunks).collect()}
    for t in texts:
        n, data = media_chunks.payload_of(t)
        x = out[hashlib.sha256(data).digest()]
        assert x["tail_crc32"] == zlib.crc32(data[-64:]) and x["feature"] == media_chunks.features(data) and len(data) % 64 == 0 and len(data) > 0
    stored = chunks.agg(F.sum(F.length("bytes"))).first()[0]
    assert stored < 200_000  # the edited copy shares nearly all chunks with the first
    # the stored form: the head as it was stored, and the chunks in order
    heads = {bytes(m["sha"]): bytes(m["head"]) for m in media.collect()}
    for sha, x in out.items():
        data = next(d for t in texts for d in [media_chunks.payload_of(t)[1]] if hashlib.sha256(d).digest() == sha)
        assert (x["media_bytes"], x["media_sha256"]) == (len(heads[sha]) + len(data), hashlib.sha256(heads[sha] + data).hexdigest())
        assert media_chunks.listed(heads[sha]) == [(media_chunks.digest(c), len(c)) for c in media_chunks.chunks_of(data)]
    bad = chunks.withColumn("bytes", F.concat("bytes", F.lit(b"x")))
    with pytest.raises(Exception, match="can't be put together"):
        media_chunks.read_media(media, bad).collect()


def test_gear_is_local():
    data = bytes(np.random.default_rng(0).integers(0, 256, 500, np.uint8))
    assert media_chunks.gear_hashes(data)[-1] == media_chunks.gear_hashes(data[-32:])[-1]
    h = np.uint32(0)
    with np.errstate(over="ignore"):
        for b in data[:100]:
            h = np.uint32((int(h) * 2 + int(media_chunks.GEAR[b])) & 0xFFFFFFFF)
    assert media_chunks.gear_hashes(data[:100])[-1] == h


def test_media_odd(spark):
    lists, media, chunks = media_chunks.store_media(odd(spark))
    assert lists.count() == 8 and media_chunks.read_media(media, chunks).count() >= 4
    lists, media, chunks = media_chunks.store_media(empty(spark))
    assert media_chunks.read_media(media, chunks).count() == 0


# -- mixing -----------------------------------------------------------------


def test_mix_targets(spark, make):
    r = random.Random(4)
    df = make([(" ".join(["w"] * r.randrange(1, 9)), "en", so) for so in ["a", "b", "c", "d", None] for _ in range(200)])
    rows = mixing.dealt_rows(df).collect()
    again = mixing.dealt_rows(df.repartition(5)).collect()
    assert sorted((x["doc_id"], x["shards"]) for x in rows) == sorted((x["doc_id"], x["shards"]) for x in again)
    sizes, taken, target = {}, {}, {}
    for x in rows:
        sizes[x["source"]] = sizes.get(x["source"], 0) + x["size"]
        taken[x["source"]] = taken.get(x["source"], 0) + x["size"] * len(x["shards"])
        target[x["source"]] = x["target"]
        assert len(x["shards"]) <= 2
    # the targets by sharing again and again
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    want, capped, total = {}, set(), 1.5 * sum(sizes.values())
    while True:
        left = total - sum(2 * sizes[k] for k in capped)
        free = [k for k in sizes if k not in capped]
        want = {k: 2.0 * sizes[k] if k in capped else left * weights[k] / sum(weights[f] for f in free) for k in sizes}
        over = {k for k in free if want[k] > 2 * sizes[k]}
        if not over:
            break
        capped |= over
    assert target == pytest.approx(want)
    assert all(abs(taken[k] - target[k]) <= 8 for k in sizes)
    shards = [s for x in rows for s in x["shards"]]
    assert set(shards) == set(range(16))
    # the mix is that plan, each taking once, in shuffled order within a partition and shard
    parts = mixing.mix(df).withColumn("part", F.spark_partition_id()).collect()
    assert sorted((x["doc_id"], x["mix_shard"]) for x in parts) == sorted((x["doc_id"], s) for x in rows for s in x["shards"])
    assert len({(x["doc_id"], x["mix_take"]) for x in parts}) == len(parts)
    order = [(x["part"], x["mix_shard"], x["mix_key"]) for x in parts]
    assert order == sorted(order) and [x["doc_id"] for x in parts] != sorted(x["doc_id"] for x in parts)


def test_mix_tree_keeps_quotas(make):
    """The tickets of each source are its taken blocks, and each level halves them whatever their source."""
    df = make([("w w w", "en", so) for so in ["a", "b", "c"] for _ in range(400)])
    goal, plan = mixing.plan(mixing.sized(df))
    rows = plan.collect()
    taken = [s for x in rows for s in [*x["shards"], *([x["edge_shard"]] if x["edge_shard"] is not None else [])]]
    counts = [taken.count(s) for s in range(16)]
    assert max(counts) - min(counts) <= 1
    for g in goal.collect():
        blocks = [x for x in rows if x["source"] == g["source"]]
        whole = mixing.sized(df).where(F.col("source") == g["source"]).select("block").distinct().count()
        passes = int(g["target"] // g["source_size"])
        assert len(blocks) <= whole and all(passes <= len(x["shards"]) <= passes + 1 for x in blocks)


def test_mix_rows_and_odd(spark, make):
    out = mixing.mix(odd(spark))
    assert out.columns == [*odd(spark).columns, "mix_shard", "mix_take", "mix_key"]
    assert mixing.dealt_rows(odd(spark)).count() == 8
    assert mixing.dealt_rows(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    clash = odd(spark).selectExpr("*", "1 AS mix_shard", "2 AS MIX_TAKE", "3 AS `a.b`")
    assert mixing.mix(clash).columns == [*odd(spark).columns, "a.b", "mix_shard", "mix_take", "mix_key"]
    df = make(["a b c"] * 20)
    plan = mixing.dealt_rows(df).agg(F.sum(F.size("shards"))).first()[0]
    assert mixing.mix(df).count() == plan == 30


# -- secrets ----------------------------------------------------------------


def test_base_spans():
    hexed = "0123456789abcdef0"
    text = f'é PassWord = "abcdefghijkl" token:short AKIA{"A" * 14} AKIAB {hexed} api_key=token=abcdefgh'
    spans = [(secrets.KINDS[k], text[s:e]) for s, k, e in secrets.base_spans(text)]
    assert spans == [("assign", 'PassWord = "abcdefghijkl'), ("access", "AKIA" + "A" * 14), ("hex", hexed), ("assign", "api_key=token=abcdefgh")]
    assert secrets.base_spans("") == [] and secrets.base_spans("to\u212aen=abcdefghijkl") == []  # the Kelvin sign is no k


def brute_base(text):
    """The base spans by trying each kind at each place, without regular expressions for what is repeated."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    value = set(letters + letters.upper() + "0123456789+/_.=-")
    out = []

    def run(at, signs):
        end = at
        while end < len(text) and text[end] in signs:
            end += 1
        return end

    def lower(s):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)

    at = 0
    while at < len(text):
        end = None
        for key in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if lower(text[at : at + len(key)]) == key:
                k = at + len(key)
                k += k < len(text) and text[k] in "\"'"
                k = run(k, " ")
                if k < len(text) and text[k] in ":=":
                    k = run(k + 1, " ")
                    k += k < len(text) and text[k] in "\"'"
                    stop = run(k, value)
                    if stop > k:
                        end = stop
                        out += [(at, 0, stop)] if stop - k >= 12 else []
                break
        at = end or at + 1
    for kind, lead, signs, least in ((1, "AKIA", set(letters.upper() + "0123456789"), 18), (2, "", set("0123456789abcdef"), 16)):
        at = 0
        while at < len(text):
            stop = run(at + len(lead), signs) if text.startswith(lead, at) else at
            if stop > at + len(lead):
                out += [(at, kind, stop)] if stop - at >= least else []
                at = stop
            else:
                at += 1
    return sorted(out)


def test_secrets_against_brute_force(spark, tmp_path):
    r = random.Random(15)
    pieces = ["password", "PASSWD", "Secret", "token", "api_key", "apikey", "=", ":", " ", "  ", '"', "'", "abcdef012345", "AKIA", "AKIA0123456789ABCD", "0123456789abcdef", "deadbeef", "é", "xyz", "ABCDEFGHIJKL", "-._/+", "\n"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(40))) for _ in range(300)] + [None, ""]
    from tests.llm.conftest import frame

    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    for x in secrets.op8_secrets(spark, str(tmp_path)).collect():
        base = brute_base(texts[x["doc_id"]] or "")
        named = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert (x["n_assign"], x["n_access"], x["n_hex"]) == tuple(sum(k == kind for _, k, _ in base) for kind in range(3))
        assert x["base_sha256"] == hashlib.sha256(named.encode()).hexdigest()
        spans = [tuple(s.split(":")) for s in x["spans"].split(",") if s]
        assert [s for s in spans if s[0] != "random"] == [(secrets.KINDS[k], str(s), str(e)) for s, k, e in base]


def test_secrets_in_a_very_long_text():
    import time

    text = "\n".join(f"token={k:012}abcd {k:040x} word{k}wordwordword" for k in range(30_000))
    began = time.perf_counter()
    base = secrets.base_spans(text)
    assert len(base) >= 60_000 and isinstance(secrets.candidates(text, base, secrets.natural({})), list)
    assert time.perf_counter() - began < 20


def test_battery_tells_random_from_words():
    r = random.Random(5)
    for name, alphabet in secrets.ENCODINGS[:1] + secrets.ENCODINGS[5:6]:
        tokens = ["".join(r.choice(alphabet) for _ in range(40)) for _ in range(100)]
        assert sum(secrets.battery(t, secrets.encoding_of(t)[1]) >= secrets.BATTERY for t in tokens) >= 95, name
    assert secrets.battery("a" * 40, secrets.ENCODINGS[0][1]) < secrets.BATTERY
    assert secrets.battery("abababababababababab", secrets.ENCODINGS[0][1]) < secrets.BATTERY


def test_secrets_found(spark, make):
    r = random.Random(6)
    b62 = secrets.ENCODINGS[5][1]
    token = "".join(r.choice(b62) for _ in range(48))
    english = "the quick brown fox jumps over the lazy dog and runs away " * 20
    out = secrets.find_secrets(make([f"{english} {token} end", english, "internationalizationandlocalization", None, ""])).orderBy("doc_id").collect()
    assert [len(x["found"]) for x in out] == [1, 0, 0, 0, 0]
    assert secrets.find_secrets(odd(spark)).count() == 8 and secrets.find_secrets(empty(spark)).count() == 0


def test_discoveries_need_evidence():
    assert secrets.thresholds({(5, 40): 3, (5, 2): 500}, {5: 1000})[5] > 2
    assert secrets.thresholds({(5, 2): 500}, {5: 1000}) == {}


# -- similarity join --------------------------------------------------------


def brute_groups(texts):
    from tidemark.llm.common import words_of

    def shingles(t):
        w = words_of(t)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    s = [shingles(t) for t in texts]
    label = list(range(len(s)))
    for _ in s:
        for i in range(len(s)):
            for j in range(i):
                if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j]):
                    label[i] = label[j] = min(label[i], label[j])
    return [(len(x), y) for x, y in zip(s, label, strict=True)]


def test_similarity_join(make):
    r = random.Random(7)
    texts = [None, "", "one two", "One TWO", "a b c d e"]
    for size in (6, 9, 15, 40, 90, 250, 600):
        base = words(size, size)
        texts.append(" ".join(base))
        for share in (0.0, 0.02, 0.05, 0.1):
            w = list(base)
            for _ in range(max(1, int(size * share))):
                w[r.randrange(size)] = f"x{r.randrange(10**6)}"
            texts.append(" ".join(w))
            texts.append(" ".join(base[: int(size * (1 - share))]))
    r.shuffle(texts)
    out = parity_join.near_groups(make(texts)).orderBy("doc_id").collect()
    assert [(x["n_shingles"], x["component_id"]) for x in out] == brute_groups(texts)


@pytest.mark.parametrize("block", [parity_join.BLOCK, 300])
def test_similarity_join_of_many_dissimilar_variants(make, monkeypatch, block):
    """Links that hang on no pivot: independent variants of one template, most pairs of them below the threshold."""
    monkeypatch.setattr(parity_join, "BLOCK", block)
    r, base = random.Random(21), words(300, 22)
    texts = []
    for k in range(1100):
        w = list(base)
        for at in r.sample(range(2, 298), 6):
            w[at] = f"v{k}x{at}"
        texts.append(w)
    # new shingles are in one variant only, so those of the template decide
    held = np.array([[w[i : i + 5] == base[i : i + 5] for i in range(296)] for w in texts], np.float32)
    both = held @ held.T
    linked = 100 * both >= 75 * (2 * 296 - both)
    label = np.arange(len(texts))
    while True:
        new = np.where(linked, label, len(texts)).min(1)
        if (new == label).all():
            break
        label = new
    assert 50 < len(set(label.tolist())) < 1000
    out = parity_join.near_groups(make([" ".join(w) for w in texts])).orderBy("doc_id").collect()
    assert [x["component_id"] for x in out] == label.tolist()


def brute_near(words_of, own):
    """Components of links among variants of a template by the definition, on sets of shingles as bit rows."""
    names: dict = {}
    sets = [{names.setdefault(tuple(w[i : i + 5]), len(names)) for i in range(len(w) - 4)} for w in words_of]
    label = list(range(len(sets)))
    by = {}
    for k, s in enumerate(sets):
        for h in s:
            by.setdefault(h, []).append(k)
    for k, s in enumerate(sets):
        for j in {j for h in s if len(by[h]) < len(sets) // 2 for j in by[h] if j < k} | ({j for j in range(k)} if own else set()):
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                low, high = sorted((label[k], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_template_with_own_words(make, monkeypatch):
    """Documents that share a template and no more than that; among them pairs that share words of their own too; by the new keys of clusters that are too large."""
    monkeypatch.setattr(parity_join, "BLOCK", 50)
    r, template = random.Random(61), words(120, 62)
    texts = [[*template, *words(120, 7000 + k)] for k in range(400)]
    for k in range(0, 400, 8):
        texts[k + 1] = [w if r.random() > 0.02 else f"q{r.randrange(10**9)}" for w in texts[k]]
    texts += [[*template, *words(30, 9000 + k)] for k in range(60)]
    want = brute_near(texts, own=True)
    out = parity_join.near_groups(make([" ".join(w) for w in texts])).orderBy("doc_id").collect()
    assert [x["component_id"] for x in out] == want and len(set(want)) == 421


def test_rekeyed_clusters_lose_no_link(spark, make):
    """Every pair that links shares a cluster, whatever the sizes; documents with too many words of their own are in none."""
    r, base = random.Random(63), words(200, 64)
    texts = [[*(w if r.random() > share else f"u{r.randrange(10**9)}" for w in base[: r.randrange(120, 200)]), *words(r.randrange(0, 40), 100 + k)] for k in range(150) for share in [r.choice((0.0, 0.01, 0.02, 0.05))]]
    texts.append([*base[:60], *words(140, 65)])
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    rows = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "row long, text string")
    third = spark.createDataFrame([(k, len(s), k) for k, s in enumerate(sets)], "rep long, n long, label long")
    by: dict = {}
    for x in parity_join.rekeyed(third, rows, 75, 100).collect():
        by.setdefault(x["cluster"], set()).add(x["rep"])
    together = {(a, b) for members in by.values() for a in members for b in members if a < b}
    links = {(a, b) for a in range(151) for b in range(a + 1, 151) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert links <= together and len(links) > 100 and not any(150 in p for p in together)


def test_all_parts_as_keys():
    h = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 900).astype(np.uint64))
    some, every = parity_join.band_keys(h), parity_join.band_keys(h, most=None)
    assert len(every) > 2 * len(some) and set(some.tolist()) <= set(every.tolist())


def test_similarity_join_of_ids_with_several_texts(spark):
    a, b, c = (words(40, k) for k in (61, 62, 63))
    rows = [(5, a), (5, b), (6, [*a[:-1], "x"]), (7, [*b[:-1], "y"]), (5, a), (8, c), (8, None), (9, None), (10, c[:20]), (4, [*b[:-1], "z"])]
    df = spark.createDataFrame([(d, " ".join(w) if w else None) for d, w in rows], "doc_id long, text string")
    out = sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in parity_join.near_groups(df).collect())
    assert out == sorted([(5, 36, 4), (5, 36, 4), (6, 36, 4), (7, 36, 4), (5, 36, 4), (8, 36, 8), (8, 0, 8), (9, 0, 9), (10, 16, 10), (4, 36, 4)])


def test_sketch_bounds_the_difference():
    r = np.random.default_rng(8)
    for _ in range(100):
        a = np.unique(r.integers(0, 1 << 63, 200).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.8], r.integers(0, 1 << 63, r.integers(1, 900)).astype(np.uint64)]))
        assert parity_join.hamming(parity_join.bit_sketch(a), parity_join.bit_sketch(b)) <= len(np.setxor1d(a, b))


def test_similarity_join_odd(spark):
    out = parity_join.near_groups(odd(spark)).collect()
    assert len(out) == 8
    assert {(x["doc_id"], x["component_id"]) for x in out} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (None, None), (6, 6)}
    assert parity_join.near_groups(empty(spark)).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (7, 7)]
    out = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {k: 1 for k in range(1, 41)} | {100: 100, 101: 100}


# -- passages ---------------------------------------------------------------


def brute_chain(matches):
    best = 0.0
    score = {}
    for i, (p, q) in sorted(enumerate(matches), key=lambda x: x[1]):
        before = [score[j] - chain_dedup.GAP * (p - a + q - b) for j, (a, b) in enumerate(matches) if j in score and a < p and b < q]
        score[i] = chain_dedup.K + max([0.0, *before])
        best = max(best, score[i])
    return best


def test_chains_are_best():
    r = random.Random(9)
    for _ in range(60):
        m = list({(r.randrange(60), r.randrange(60)) for _ in range(r.randrange(1, 30))})
        top = chain_dedup.chains(m)[0]
        gained = chain_dedup.K * len(top) - sum(chain_dedup.GAP * (m[b][0] - m[a][0] + m[b][1] - m[a][1]) for a, b in zip(top, top[1:], strict=False))
        assert gained == pytest.approx(brute_chain(m))
        assert sorted(i for c in chain_dedup.chains(m) for i in c) == list(range(len(m)))


def test_passages(spark, make):
    passage = words(80, 11)
    fuzzy = [w if k % 13 else "edited" for k, w in enumerate(passage)]
    texts = [" ".join([*words(100, 1), *passage, *words(50, 2)]), " ".join([*words(30, 3), *passage]), " ".join([*fuzzy, *words(60, 4)]), " ".join(words(200, 5)), " ".join([*words(50, 6), *passage[:20], *words(50, 7)]), None, "", " ".join(passage)]
    rows = {(r["doc_id"], r["src_id"]): r for r in chain_dedup.passages(make(texts)).collect()}
    assert {i for i, _ in rows} == {1, 2, 7} and {(1, 0), (2, 0), (7, 0)} <= set(rows)
    assert (rows[1, 0]["start_word"], rows[1, 0]["end_word"], rows[1, 0]["src_start"], rows[1, 0]["src_end"], rows[1, 0]["identity"]) == (30, 110, 100, 180, 1.0)
    assert rows[2, 0]["end_word"] - rows[2, 0]["start_word"] >= 75 and 0.85 < rows[2, 0]["identity"] < 1
    assert {(r["doc_id"], r["src_id"]) for r in chain_dedup.passages(odd(spark)).collect()} == {(5, 4)}
    assert chain_dedup.passages(empty(spark)).count() == 0


def test_passage_whose_pieces_came_before(make):
    passage = words(60, 71)
    pieces = [passage[k : k + 16] for k in range(0, 48, 11)]
    before = [" ".join([*words(20, 80 + k), *w, *words(20, 90 + k)]) for k, w in enumerate(pieces)]
    whole = [" ".join([*words(30, 100 + k), *passage, *words(30, 110 + k)]) for k in range(2)]
    between = [" ".join([*words(20, 120 + k), *w, *words(20, 130 + k)]) for k, w in enumerate(pieces)]
    for texts, want in (([*before, *whole], (6, 5)), ([*before, whole[0], *between, whole[1]], (11, 5))):
        rows = [r for r in chain_dedup.passages(make(texts)).collect() if r["end_word"] - r["start_word"] >= 60]
        assert [(r["doc_id"], r["src_id"], r["start_word"], r["end_word"]) for r in rows] == [(*want, 30, 90)]


def test_passages_of_repeated_rows_and_ids(spark):
    a, b = " ".join(words(70, 72)), " ".join(words(70, 73))
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    rows = chain_dedup.passages(frame([(1, a), (1, a), (2, a), (2, a)])).collect()
    assert [(r["doc_id"], r["src_id"], r["start_word"], r["end_word"], r["identity"]) for r in rows] == [(2, 1, 0, 70, 1.0)]
    rows = chain_dedup.passages(frame([(1, a), (1, b), (2, a + " x"), (2, b + " y")])).collect()
    assert sorted((r["doc_id"], r["src_id"], r["start_word"], r["end_word"], r["identity"]) for r in rows) == [(2, 1, 0, 70, 1.0)] * 2
    assert len({(r["text_hash"], r["src_hash"]) for r in rows}) == 2
    assert chain_dedup.passages(frame([(1, a), (1, a + " x")])).count() == 0


def test_passages_of_repeated_words_only(make):
    many = " ".join(["the"] * 90)
    assert chain_dedup.passages(make([f"a b c {many}", f"d e f {many}", " ".join(["to", "be"] * 60), " ".join(["to", "be"] * 70)])).count() == 0


def test_passages_longer_than_the_cut(make, monkeypatch):
    """Alike far beyond the last seed that the pair shares: the cut must not end the passage."""
    monkeypatch.setattr(chain_dedup, "MARGIN", 5)
    long, r = words(400, 74), random.Random(75)
    texts = [" ".join([*words(10, 76), *long, *words(10, 77)]), " ".join([*words(20, 78), *(w if k % 3 else f"e{r.random()}" for k, w in enumerate(long[:150])), *long[150:200], *words(9, 79)])]
    rows = chain_dedup.passages(make(texts), identity=0.6).collect()
    assert len(rows) == 1 and rows[0]["end_word"] - rows[0]["start_word"] >= 195


def brute_common(x, y):
    row = [0] * (len(y) + 1)
    for u in x:
        old = 0
        for k, v in enumerate(y, 1):
            old, row[k] = row[k], old + 1 if u == v else max(row[k], row[k - 1])
    return row[-1]


def test_common_words():
    r = random.Random(76)
    for _ in range(200):
        x, y = ([r.choice([b"a", b"b", b"c", b"d"]) for _ in range(r.randrange(30))] for _ in range(2))
        assert chain_dedup.common_words(x, y) == brute_common(x, y)


@pytest.mark.parametrize(("n", "edits"), [(80, 0.15), (80, 0.2), (60, 0.2), (50, 0.1), (50, 0.15)])
def test_recall_of_fuzzy_passages(make, n, edits):
    """300 pairs with substitutions, insertions and deletions; those that brute force finds 80 % alike or more are to be found."""
    r, texts, want = random.Random(77), [], set()
    for k in range(300):
        x = words(n, 1000 + k)
        y = list(x)
        for at in sorted(r.sample(range(n), int(n * edits)), reverse=True):
            kind = r.randrange(3)
            y[at : at + (kind != 1)] = [] if kind == 2 else [f"e{r.randrange(10**9)}"]
        same = brute_common([w.encode() for w in x], [w.encode() for w in y])
        if min(len(x), len(y)) >= chain_dedup.MIN_WORDS and same / max(len(x), len(y)) >= chain_dedup.IDENTITY:
            want.add(2 * k + 1)
        texts += [" ".join([*words(20, 3000 + k), *x, *words(20, 4000 + k)]), " ".join([*words(20, 5000 + k), *y, *words(20, 6000 + k)])]
    found = {(x["doc_id"], x["src_id"]) for x in chain_dedup.passages(make(texts)).collect()}
    assert all(d == s + 1 and d % 2 for d, s in found)
    got = {d for d, _ in found}
    print(n, edits, len(want), len(want & got) / max(len(want), 1))
    assert len(want & got) >= 0.9 * len(want)


def substituted(ws, share, r):
    return [w if r.random() >= share else f"e{r.randrange(10**9)}" for w in ws]


@pytest.mark.parametrize(("n", "edits", "least"), [(80, 0.08, 0.9), (80, 0.12, 0.9), (80, 0.15, 0.9)])
def test_recall_in_a_corpus_that_shares_phrases(make, n, edits, least):
    """Passages whose phrases of eight words are all over the corpus, before and between both of their holders."""
    r = random.Random(17)
    passages = [words(n, 5000 + k) for k in range(60)]

    def phrases():
        out = []
        for _ in range(12):
            p = r.choice(passages)
            at = r.randrange(n - 8)
            out += [f"z{r.randrange(10**9)}", *p[at : at + 8]]
        return " ".join(out)

    own = lambda: [f"o{r.randrange(10**9)}" for _ in range(40)]
    docs = make([phrases() for _ in range(400)], start=0)
    docs = docs.unionByName(make([" ".join([*own(), *p, *own()]) for p in passages], start=1000)).unionByName(make([phrases() for _ in range(400)], start=2000))
    docs = docs.unionByName(make([" ".join([*own(), *substituted(p, edits, r), *own()]) for p in passages], start=3000))
    found = {(x["doc_id"], x["src_id"]) for x in chain_dedup.passages(docs).collect()}
    hit = sum((3000 + k, 1000 + k) in found for k in range(60))
    print("recall", n, edits, hit / 60)
    assert hit >= least * 60
    assert not {p for p in found if p[0] - p[1] != 2000}


def test_every_repeat_of_a_small_corpus(make):
    """All pairs of documents by brute force: what is like a passage of an earlier document is found there, in whichever earlier one."""
    r = random.Random(23)
    passages = [words(70, 9000 + k) for k in range(12)]
    docs, held = [], []
    for _ in range(60):
        text, at = [], []
        for p in r.sample(range(12), 3):
            text += [f"o{r.randrange(10**9)}" for _ in range(r.randrange(5, 60))]
            copy = substituted(passages[p], r.choice((0.0, 0.05, 0.1)), r)
            at.append((len(text), copy, p))
            text += copy
        docs.append(" ".join(text))
        held.append(at)
    rows = chain_dedup.passages(make(docs)).collect()
    want = missed = 0
    for j in range(60):
        for start, copy, p in held[j]:
            earlier = [c for i in range(j) for _, c, q in held[i] if q == p]
            if any(brute_common([w.encode() for w in copy], [w.encode() for w in c]) >= 0.8 * 70 for c in earlier):
                want += 1
                covered = set()
                for x in rows:
                    if x["doc_id"] == j:
                        covered |= set(range(x["start_word"], x["end_word"]))
                missed += len(covered & set(range(start, start + 70))) < 0.8 * 70
    print("repeats", want, "missed", missed)
    assert want > 120 and missed <= 0.02 * want
    assert all(any(p == q for _, _, p in held[x["doc_id"]] for _, _, q in held[x["src_id"]]) for x in rows)


@pytest.mark.parametrize("gap", [40, 100])
def test_passages_with_unlike_words_between(make, gap):
    one, two = words(60, 41), words(60, 42)
    texts = [" ".join([*one, *words(gap, 50 + k), *two]) for k in range(2)]
    rows = chain_dedup.passages(make(texts)).orderBy("start_word").collect()
    assert [(r["doc_id"], r["src_id"], r["start_word"], r["end_word"], r["src_start"], r["src_end"], r["identity"]) for r in rows] == [(1, 0, a, a + 60, a, a + 60, 1.0) for a in (0, 60 + gap)]


def test_passage_whose_phrases_all_have_other_holders(make):
    """first and previous holder of every seed, and of every two of them, is a document that shares two phrases only."""
    r, p = random.Random(91), words(60, 92)
    parts = [p[a : a + 14] for a in [*range(0, 46, 4), 46]]

    def mixed():
        own = lambda: [f"z{r.randrange(10**9)}" for _ in range(6)]
        return [" ".join([*own(), *x, *own(), *y, *own()]) for a, x in enumerate(parts) for y in parts[a:]]

    own = lambda: [f"o{r.randrange(10**9)}" for _ in range(30)]
    docs = make(mixed()).unionByName(make([" ".join([*own(), *p, *own()])], start=1000)).unionByName(make(mixed(), start=2000)).unionByName(make([" ".join([*own(), *p, *own()])], start=3000))
    found = [x for x in chain_dedup.passages(docs).collect() if x["end_word"] - x["start_word"] >= 60]
    assert [(x["doc_id"], x["src_id"], x["start_word"], x["src_start"]) for x in found] == [(3000, 1000, 30, 30)]


@pytest.mark.parametrize(("identity", "edits"), [(0.8, 0.1), (0.8, 0.25), (0.6, 0.2)])
def test_alike_places_against_all_pairs(identity, edits):
    """No pair of places that shares enough runs of three words is left out, but within a class, which hangs together."""
    r = np.random.default_rng(93)
    bases = r.integers(1, 256, (6, 104), np.uint8)
    around = bases[r.integers(0, 6, 120)]
    around = np.where(r.random(around.shape) < edits * r.random((120, 1)), r.integers(1, 256, around.shape, np.uint8), around)
    around[:, 45:60] = bases[0, 45:60]
    around[::7, :40] = 0
    group, doc = np.repeat([0, 1], 60), np.concatenate([np.sort(r.integers(0, 50, 60)) for _ in range(2)])
    got = set(zip(*(x.tolist() for x in chain_dedup.alike(group, doc, around, 45, identity)), strict=True))

    def runs(row):
        from collections import Counter

        return Counter(tuple(row[k : k + 3].tolist()) for k in range(102) if row[k : k + 3].all())

    held = [runs(x) for x in around]
    pairs = {(i, k) for i in range(120) for k in range(i) if group[i] == group[k] and doc[k] < doc[i]}
    want = {(i, k) for i, k in pairs if (held[i] & held[k]).total() >= chain_dedup.least_shared(45, identity)}
    sure = {(i, k) for i, k in pairs if chain_dedup._confirmed(around[[i]], around[[k]], 45, identity)[0]}
    label = chain_dedup._labels(120, *(np.array(x, np.int64) for x in zip(*(got & sure), strict=True)))
    assert got <= want | sure and len(want) > 100 and len(got) < len(want)
    assert all(pair in got or label[pair[0]] == label[pair[1]] for pair in want)
