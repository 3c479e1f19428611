"""Traversals, increments, readings and diffs."""

from __future__ import annotations

import random
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import Contracts
from tidemark.functions import linediff as D
from tidemark.functions import markup as M
from tidemark.operators import presence as P
from tidemark.operators import reading as R
from tidemark.operators import traversal as T
from tidemark.plans import archive, evidence  # noqa: F401  (archive adds to the queries of evidence)

# -- traversal --------------------------------------------------------------

PAGES = "scan_id long, page_id long, url string, next_url string, ok boolean, recognized boolean, empty_validated boolean, signature string, n_ids long"
SCANS = "scan_id long, start_url string, bound int"


def chain(scan, urls, **changes):
    """Pages linked in a row; changes: url -> fields that differ."""
    rows = []
    for k, (url, following) in enumerate(pairwise([*urls, None])):
        row = {"scan_id": scan, "page_id": 100 * scan + k, "url": url, "next_url": following, "ok": True, "recognized": True, "empty_validated": False, "signature": f"s{url}", "n_ids": 2}
        rows.append(tuple((row | changes.get(url, {})).values()))
    return rows


def test_numbers_of_a_thousand_pages_in_any_order(spark):
    rows = chain(1, [f"p{k}" for k in range(1000)]) + chain(2, ["a"])
    random.Random(1).shuffle(rows)
    pages = spark.createDataFrame(rows, PAGES)
    scans = spark.createDataFrame([(1, "p0", 2000), (2, "a", 5), (3, "nowhere", 5)], SCANS)
    got = {(r["scan_id"], r["url"]): r["page_number"] for r in T.numbered(pages, scans).collect()}
    assert got == {(1, f"p{k}"): k + 1 for k in range(1000)} | {(2, "a"): 1}
    assert {r["page_number"] for r in T.numbered(pages, scans, 10).collect()} == set(range(1, 11))


def test_numbers_of_pages_that_are_passed_over(spark, monkeypatch):
    """Against a walk of each scan: links that meet, lead back, to themselves and nowhere, several first pages; and each link is joined but a few times."""
    r = random.Random(5)
    rows, starts = [], []
    for scan in range(30):
        urls = [f"u{k}" for k in range(r.randrange(1, 60))]
        onward = dict(zip(urls, urls[1:], strict=False))
        onward |= {u: r.choice([*urls, "lost", None]) for u in r.sample(urls, len(urls) // 8)}
        rows += [(scan, u, onward.get(u)) for u in urls]
        starts += [(scan, u) for u in {urls[0], r.choice(urls)}] + [(scan, "lost")]
    want, onward = {}, {(s, u): (s, v) for s, u, v in rows}
    for at in starts:
        n = 1
        while at in onward and want.get(at, 1 << 30) > n:
            want[at] = n
            at, n = onward[at], n + 1
    r.shuffle(rows)
    pages, scans = spark.createDataFrame(rows, "scan_id long, url string, next_url string"), spark.createDataFrame(starts, "scan_id long, start_url string")
    sizes, real = [], T._passed
    monkeypatch.setattr(T, "_passed", lambda links, k: sizes.append(links.count()) or real(links, k))
    for few in (1 << 20, 100):
        assert {(x["scan_id"], x["url"]): x["page_number"] for x in T.numbered(pages, scans, few=few).collect()} == want
    assert len(sizes) > 2 and sum(sizes) < 5 * sizes[0]


def test_ends(spark):
    five = list("abcde")
    cases = {
        1: (chain(1, five), "no_more_link", 5), 2: (chain(2, five, c={"ok": False}), "fetch_failure", 3), 3: (chain(3, five, c={"recognized": False}), "structure_unrecognized", 3),
        4: (chain(4, five, d={"signature": "sb"}), "loop_detected", 4), 5: (chain(5, five, e={"next_url": "b"}), "loop_detected", 5), 6: (chain(6, list("abcdefghi")), "max_pages", 6),
        7: (chain(7, five, c={"next_url": "lost"}), "interrupted", 3), 8: (chain(8, ["a"], a={"n_ids": 0, "empty_validated": True}), "empty_validated_page", 1),
        9: (chain(9, five, e={"n_ids": 0}), "structure_unrecognized", 5), 10: (chain(10, ["x"]), "interrupted", 0), 11: (chain(11, ["a"], a={"next_url": "a"}), "loop_detected", 1),
        12: (chain(12, list("abcdef")), "no_more_link", 6), 13: (chain(13, five) + [(13, 1390, "z", "c", True, True, False, "sz", 2), (13, 1391, "b", None, False, True, False, None, 0)], "no_more_link", 5),
        14: (chain(14, five, b={"signature": None}, c={"signature": None}), "no_more_link", 5), 15: (chain(15, five, c={"ok": False, "next_url": None}, e={"ok": False}), "fetch_failure", 3),
    }
    rows = [r for case, _, _ in cases.values() for r in case]
    random.Random(2).shuffle(rows)
    scans = spark.createDataFrame([(k, "a", 6) for k in cases] + [(99, "a", 6)], SCANS)
    walk = T.walked(spark.createDataFrame(rows, PAGES), scans)
    got = {r["scan_id"]: r for r in T.walk_ends(walk, scans).collect()}
    assert {k: (r["end"], r["pages"]) for k, r in got.items()} == {k: (end, n) for k, (_, end, n) in cases.items()} | {99: ("interrupted", 0)}
    assert (got[13]["n_orphans"], got[13]["n_again"], got[2]["n_beyond"], got[2]["n_ids"], got[7]["n_orphans"], got[1]["last_url"]) == (1, 1, 2, 4, 2, "e")
    assert walk.count() == len(rows)


def test_no_pages(spark):
    scans = spark.createDataFrame([], SCANS)
    assert T.walked(spark.createDataFrame([], PAGES), scans).count() == 0


# -- increments -------------------------------------------------------------


@pytest.fixture(scope="module")
def history(spark):
    """grid, runs, postings of twelve days; every fourth run is not qualified."""
    r = random.Random(7)
    day = lambda k: f"2026-03-{k + 1:02d}"
    runs = [(day(k), f"{day(k)} 06:00:00", f"{day(k)} 07:00:00", k % 4 != 3) for k in range(12)]
    postings = [(p, f"{day(r.randrange(10))} {r.choice(('06:30:00', '12:00:00'))}") for p in range(40)]
    kinds = {"slot": "date", "started_at": "timestamp_ntz", "ended_at": "timestamp_ntz", "discovered_at": "timestamp_ntz"}
    frame = lambda rows, names: (lambda df: df.select(*(F.col(c).cast(kinds.get(c, df.schema[c].dataType)).alias(c) for c in df.columns)))(spark.createDataFrame(rows, names))
    grid = [(slot, p, r.random() < 0.6) for slot, _, end, ok in runs for p, seen in postings if ok and seen <= end]
    return frame(grid, ["slot", "posting_id", "listed"]).cache(), frame(runs, ["slot", "started_at", "ended_at", "qualified"]).cache(), frame(postings, ["posting_id", "discovered_at"]).cache()


def rows_of(df):
    rows = [tuple(map(str, r)) for r in df.select("slot", "posting_id", "event_kind", "interval_start", "interval_end").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("cuts", [[0, 3, 12], [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12], [0, 7, 8, 12]])
def test_events_day_by_day_are_those_of_the_whole(spark, history, cuts):
    grid, runs, postings = history
    state, got = None, set()
    for low, high in pairwise(cuts):
        part = grid.where(F.day("slot").between(low + 1, high))
        new = P.presence_events(part, runs, postings) if state is None else P.later_events(part, runs, postings, state)
        rows = rows_of(new)
        assert not rows & got
        got |= rows
        state = spark.createDataFrame(P.presence_state(part, runs, state).collect(), "posting_id long, last_slot date, was boolean, last_listed timestamp_ntz, last_absent timestamp_ntz")
        # what was taken in already gives nothing
        assert P.later_events(part, runs, postings, state).isEmpty()
    assert got == rows_of(P.presence_events(grid, runs, postings))


def test_late_runs_are_told(spark, history):
    grid, runs, _ = history
    state = P.presence_state(grid.where(F.day("slot").isin(1, 2, 5, 6)), runs)
    taken = runs.where(F.day("slot").isin(1, 2, 5, 6))
    assert [r["slot"].day for r in P.late_runs(runs, state, taken).collect()] == [3]
    assert sorted(r["slot"].day for r in P.later_runs(runs, state).collect()) == [7, 9, 10, 11]
    assert P.later_runs(runs, state.limit(0)).count() == 9


# -- readings ---------------------------------------------------------------


def test_payloads_are_read_once_for_each_version(spark):
    payloads = spark.createDataFrame([("a", "1"), ("b", "2"), ("bad", "3"), ("a", "1")], "sha256 string, body string")
    read = spark.sparkContext.accumulator(0)

    def parse():
        def run(bodies):
            import pandas as pd

            read.add(len(bodies))
            return pd.DataFrame({"status": ["failed" if b == "3" else "ok" for b in bodies], "value": [f"v{b}" for b in bodies]})

        return F.pandas_udf(run, "status string, value string").asNondeterministic()("body")

    def take(memo, kind, contracts):
        before = read.value
        new = spark.createDataFrame(R.readings(payloads, memo, kind, contracts, parse).collect(), "sha256 string, kind string, parser string, contract string, text_contract string, status string, result struct<status:string,value:string>")
        return new, read.value - before

    v1, v2 = Contracts(parser="1"), Contracts(parser="2")
    new, n = take(None, "detail", v1)
    assert n == 3 and new.count() == 3
    memo = R.remembered(None, new)
    again, n = take(memo, "detail", v1)
    assert n == 1 and [r["sha256"] for r in again.collect()] == ["bad"]
    memo = R.remembered(memo, again)
    assert memo.count() == 3
    for kind, contracts in (("listing", v1), ("detail", v2), ("detail", Contracts(parser="1", text_contract="9"))):
        new, n = take(memo, kind, contracts)
        assert n == 3
        memo = R.remembered(memo, new)
    assert memo.count() == 12 and {r["readings"] for r in R.summary(memo.where("status = 'ok'")).collect()} == {2, 4}
    got = R.read_as(payloads, memo, "detail", v1).collect()
    assert sorted((r["sha256"], r["status"], r["result"]["value"]) for r in got) == [("a", "ok", "v1"), ("a", "ok", "v1"), ("b", "ok", "v2"), ("bad", "failed", "v3")]


# -- diffs ------------------------------------------------------------------


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        row = _next(row, a, y)
    return row[-1]


def _next(row, a, y):
    out = [0]
    for k, b in enumerate(y):
        out.append(row[k] + 1 if a == b else max(row[k + 1], out[k]))
    return out


def patched(x, changes):
    """x with the hunks applied."""
    out, at = [], 0
    for h in changes:
        start = h["old_start"] - 1 if h["old_lines"] else h["old_start"]
        out += x[at:start]
        assert len(out) == (h["new_start"] - 1 if h["new_lines"] else h["new_start"])
        assert [t[1:] for t in h["lines"] if t[0] != "+"] == x[start : start + h["old_lines"]]
        out += [t[1:] for t in h["lines"] if t[0] != "-"]
        at = start + h["old_lines"]
    return out + x[at:]


@pytest.mark.parametrize("seed", range(40))
def test_diffs_are_minimal_and_apply(seed):
    r = random.Random(seed)
    x = [r.choice("abcdef"[: r.randrange(2, 7)]) for _ in range(r.randrange(0, 60))]
    y = [r.choice("abcdefg") for _ in range(r.randrange(0, 60))] if seed % 2 else [c if r.random() < 0.8 else r.choice("xyz") for c in x if r.random() < 0.9]
    pairs = D.common_lines(x, y)
    assert len(pairs) == lcs(x, y) and all(x[i] == y[j] for i, j in pairs) and all(a[0] < b[0] and a[1] < b[1] for a, b in pairwise(pairs))
    for context in (0, 1, 3):
        changes = D.hunks(x, y, context)
        assert patched(x, changes) == y
        assert sum(t[0] != " " for h in changes for t in h["lines"]) == len(x) + len(y) - 2 * len(pairs)
        assert all(a["old_start"] + a["old_lines"] <= b["old_start"] for a, b in pairwise(changes))


def test_diff_of_fifty_thousand_lines():
    x = [f"line {k % 977} {k // 7}" for k in range(50_000)]
    y = [line if k % 50 else f"new {k}" for k, line in enumerate(x) if k % 333]
    assert len(D.common_lines(x, y)) == sum(1 for k in range(50_000) if k % 50 and k % 333)
    r = random.Random(3)
    a, b = ([r.randrange(300) for _ in range(12_000)] for _ in range(2))
    assert 1_000 < len(D.common_lines(a, b)) < 12_000


def test_diff_columns(spark):
    df = spark.createDataFrame([("a\nb\nc\nd", "a\nx\nc\nd"), (None, "a"), ("a", None), ("", "a"), ("same", "same")], "old string, new string")
    rows = df.withColumn("d", D.line_diff("old", "new")).select(D.unified("d").alias("u"), D.counted("d").alias("n")).collect()
    assert [r["u"] for r in rows] == ["@@ -1,3 +1,3 @@\n a\n-b\n+x\n c", "@@ -0,0 +1,1 @@\n+a", "@@ -1,1 +0,0 @@\n-a", "@@ -1,1 +1,1 @@\n-\n+a", ""]
    assert [tuple(r["n"]) for r in rows] == [(1, 1), (0, 1), (1, 0), (1, 1), (0, 0)]


# -- encodings --------------------------------------------------------------


def test_encodings_of_odd_texts_are_those_of_the_sql(spark, tmp_path):
    """No text, characters that are zero, wide or replaced before, each in all ten ways."""
    import duckdb

    texts = [None, "", " ", "a", "é", "\0a", "\0\0é", "a\0", "\x80\x9f", "\ufffd", "a\ufffd é", "\ufffe", "中", "😀é", "é" * 5000]
    rows = [(10 * n + k, text) for n, text in enumerate(texts) for k in range(10)] + [(None, "é"), (-3, "é")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = evidence.QUERIES["sniffed_encodings"](spark, str(tmp_path)).collect()
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        want = con.execute(evidence.ORACLE["sniffed_encodings"]).fetchall()
    assert len(want) == len(rows) and {tuple(r) for r in got} == set(want)


def test_codecs_that_make_no_text_do_not_fit(spark):
    """A page whose charset makes lone surrogates is read by the next candidate and does not end the job."""
    pages = [(b"<meta charset=utf-7>+2AA-x", None), (b"<meta charset=unicode_escape>\\ud800", None), (b"\\udfff", "raw_unicode_escape"), (b"+AOk-", "utf-7")]
    df = spark.createDataFrame(pages, "data binary, declared string")
    assert [tuple(r["d"]) for r in df.select(M.html_decode("data", "declared").alias("d")).collect()] == [(data.decode(), "utf-8", 0) for data, _ in pages[:3]] + [("é", "utf-7", 0)]
