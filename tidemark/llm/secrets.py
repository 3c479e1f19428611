"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Base spans come from three patterns. Any other token of 16 or more characters of an encoding's alphabet is a candidate;
its encoding (hex, base32, base64, alphanumeric) is the smallest alphabet that holds it. The battery asks whether it
looks drawn uniformly from that alphabet: a chi-squared test of its character counts, a runs test (Wald-Wolfowitz) on
halves of the alphabet, and a test of the serial correlation of neighbours; the three p-values are combined by Fisher's
method, and a token that fails (below BATTERY) is no secret.

What passes is still only "not unlike random", so the claim is controlled from the other side. The null hypothesis is a
natural token, whose characters follow those of the corpus' words; the likelihood ratio of the uniform alphabet
against it is an e-value (its mean under the null is at most 1), and it grows with length, so short tokens can't
claim much. Within each class of lengths (powers of two), the e-value Benjamini-Hochberg procedure at level FDR picks the
threshold, from a histogram of all candidates of the corpus; it holds under any dependence, so copies do no harm.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_texts, batches_of, stored, table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs: the same as [0-9a-f]+ with shorter ones dropped
LEAST_VALUE, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
FDR = 0.01
BATTERY = 0.001
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (("hex", _DIGIT + "abcdef"), ("hex", _DIGIT + "ABCDEF"), ("base32", _UPPER + "234567"), ("alnum", _DIGIT + _UPPER), ("alnum", _DIGIT + _LOWER), ("base62", _DIGIT + _UPPER + _LOWER), ("base64", _DIGIT + _UPPER + _LOWER + "+/"), ("base64url", _DIGIT + _UPPER + _LOWER + "-_"), ("base64", _DIGIT + _UPPER + _LOWER + "+/_-"))
#: e-values are kept as integers of log2, up to 255, and lengths as powers of two.
MOST_BITS = 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, by start and then kind; offsets count code points."""
    low = text.lower() if text.isascii() else text
    out = []
    if not text.isascii() or any(k in low for k in ("passw", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def encoding_of(token: str) -> tuple[str, str] | None:
    """Name and alphabet of the smallest encoding that holds the token, without padding."""
    own = set(token.rstrip("="))
    return next(((n, a) for n, a in ENCODINGS if own <= set(a)), None)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, k: int) -> float:
    """Wilson-Hilferty approximation of the upper tail."""
    return 0.5 * math.erfc((((x / k) ** (1 / 3)) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k)) / math.sqrt(2))


def battery(token: str, alphabet: str) -> float:
    """Combined p-value that the token is drawn uniformly from the alphabet."""
    at = np.array([alphabet.index(c) for c in token])
    n, k = len(at), len(alphabet)
    counts = np.bincount(at, minlength=k)
    chi = _chi2_tail(float(((counts - n / k) ** 2 / (n / k)).sum()), k - 1)
    high = at >= k // 2
    n1, n2 = int(high.sum()), int((~high).sum())
    if n1 and n2:
        runs, mean = 1 + int((high[1:] != high[:-1]).sum()), 1 + 2 * n1 * n2 / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        run = _normal_tail((runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        run = 2.0 ** (1 - n)
    x = at - at.mean()
    spread = float((x * x).sum())
    serial = _normal_tail((float((x[1:] * x[:-1]).sum()) / spread + 1 / n) * math.sqrt(n)) if spread else 0.0
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in (chi, run, serial))
    # chi-squared with 6 degrees of freedom: closed form
    h = fisher / 2
    return math.exp(-h) * (1 + h + h * h / 2)


def natural(counts: dict[str, int]) -> dict[str, float]:
    """Log2 probabilities of the characters of natural tokens, from counts over the corpus; every candidate character has some."""
    every = _LOWER + _UPPER + _DIGIT + "+/_-="
    total = sum(counts.get(c, 0) + 1 for c in every)
    return {c: math.log2((counts.get(c, 0) + 1) / total) for c in every}


def evidence(token: str, alphabet: str, logs: dict[str, float]) -> float:
    """Log2 of the e-value: likelihood under the uniform alphabet over that under natural characters."""
    return -len(token) * math.log2(len(alphabet)) - sum(logs[c] for c in token)


def candidates(text: str, base: list[tuple[int, int, int]], logs: dict[str, float]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, log2 e) of the tokens that no base span touches and that pass the battery."""
    out, k, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        # both are in order; ``reach`` is the furthest end of the base spans that begin before b
        while k < len(base) and base[k][0] < b:
            reach = max(reach, base[k][2])
            k += 1
        if a < reach:
            continue
        token = m[0].rstrip("=")
        kind = encoding_of(token)
        if kind is None or len(token) < 16:
            continue
        e = evidence(token, kind[1], logs)
        if e >= 1 and battery(token, kind[1]) >= BATTERY:
            out.append((a, b, len(token).bit_length(), min(int(e), MOST_BITS)))
    return out


def thresholds(histogram: dict[tuple[int, int], int], tested: dict[int, int], fdr: float = FDR) -> dict[int, int]:
    """Per length class, the least log2 e-value that is a discovery (e-BH); no entry where there is none.

    ``histogram``: candidates by (class, log2 e), rounded down; ``tested``: all tokens tested, by class.
    """
    out = {}
    for c, m in tested.items():
        above = 0
        for bits in range(MOST_BITS, 0, -1):
            above += histogram.get((c, bits), 0)
            if above and bits >= math.log2(m / (fdr * above)):
                out[c] = bits
    return out


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(128, np.int64)
    for part in batches_of(arrow_texts(batches, "text"), lambda r: len(r[0] or ""), 2_000_000):
        raw = np.frombuffer("\n".join(t or "" for (t,) in part).encode("utf-8", "surrogatepass"), np.uint8)
        counts += np.bincount(raw, minlength=256)[:128]
    yield pa.RecordBatch.from_arrays([pa.array(range(128), pa.int32()), pa.array(counts)], names=["code", "n"])


_SCAN = "doc_id long, base array<struct<s:int,k:int,e:int>>, more array<struct<s:int,e:int,c:int,b:int>>, tested array<int>"


def _scan(logs: dict[str, float]):
    spans = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
    extra = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("c", pa.int32()), ("b", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches_of(arrow_texts(batches, "doc_id", "text"), lambda r: len(r[1] or ""), 4_000_000):
            ids, base, more, tested = [], [], [], []
            for doc_id, text in part:
                text = text or ""
                own = base_spans(text)
                ids.append(doc_id)
                base.append([{"s": s, "k": k, "e": e} for s, k, e in own])
                more.append([dict(zip("secb", x, strict=True)) for x in candidates(text, own, logs)])
                tested.append([len(m[0].rstrip("=")).bit_length() for m in CANDIDATE.finditer(text)])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(base, spans), pa.array(more, extra), pa.array(tested, pa.list_(pa.int32()))], names=["doc_id", "base", "more", "tested"])

    return scan


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, base (array of start, kind, end), found (the same with the method's spans, by start and then kind).

    One row for each row of ``docs``. Null and empty texts have no spans. Offsets count code points, ends are exclusive.
    A token that a base span touches is not added again. Repeated rows get equal results; other columns are not read.
    """
    rows = docs.select("doc_id", "text")
    letters = {chr(r["code"]): r["n"] for r in rows.select("text").mapInArrow(_letters, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()}
    scanned = stored(rows.mapInArrow(_scan(natural(letters)), _SCAN), "secret-scan")
    # at most 32 classes of lengths and 256 values
    tested = {r["c"]: r["n"] for r in scanned.select(F.explode("tested").alias("c")).groupBy("c").agg(F.count("*").alias("n")).collect()}
    found = {(r["c"], r["b"]): r["n"] for r in scanned.select(F.explode("more").alias("m")).groupBy("m.c", "m.b").agg(F.count("*").alias("n")).collect()}
    least = thresholds(found, tested, fdr)
    keep = lambda m: _any([(m["c"] == c) & (m["b"] >= bits) for c, bits in least.items()])
    random = F.transform(F.filter("more", keep), lambda m: F.struct(m["s"].alias("s"), F.lit(len(KINDS) - 1).alias("k"), m["e"].alias("e")))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", random)).alias("found"))


def _any(conditions: list):
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def joined(spans: str):
    """kind:start:end of the spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined("base"), 256).alias("base_sha256"), joined("found").alias("spans"))
