"""Runs, reports, notices, queues and what is remembered, on small frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import export as X
from tidemark.operators import lookups as K
from tidemark.operators import presence as P
from tidemark.operators import qualify as Q
from tidemark.operators import queue as W
from tidemark.operators import status as T
from tidemark.sources import store

RUNS = "run_id long, slot date, kind string, outcome string, started_at timestamp_ntz, ended_at timestamp_ntz, qualified boolean"


def runs(spark, *rows):
    """(run, day, kind, outcome, ended, qualified)"""
    return spark.createDataFrame([(r, dt.date(2024, 1, d), k, o, dt.datetime(2024, 1, d, r % 24), dt.datetime(2024, 1, d, r % 24, 30) if e else None, q) for r, d, k, o, e, q in rows], RUNS)


@pytest.mark.parametrize(
    ("rows", "day", "state"),
    [
        ([], 5, "NEVER_RUN"), ([(1, 5, "daily", None, False, None)], 5, "RUNNING"), ([(1, 5, "daily", "success", True, True)], 5, "HEALTHY"), ([(1, 5, "daily", "success", True, True)], 7, "STALE"),
        ([(1, 4, "daily", "success", True, True), (2, 5, "daily", "partial", True, False)], 5, "DEGRADED"), ([(1, 5, "daily", "success", True, True), (2, 5, "retry", "lock_contention", True, None)], 5, "DEGRADED"),
        ([(1, 5, "daily", "aborted", True, None)], 5, "FAILED"), ([(1, 5, "daily", "failed", True, None)], 5, "FAILED"), ([(1, 5, "daily", "success", True, False)], 5, "UNKNOWN"),
    ],
)
def test_collection_state(spark, rows, day, state):
    days = spark.createDataFrame([(dt.date(2024, 1, day),)], "as_of date")
    assert T.collection_state(runs(spark, *rows), days).first()["state"] == state


def test_retries(spark):
    r = runs(
        spark, (1, 1, "daily", "success", True, True), (2, 2, "daily", "partial", True, False), (3, 3, "daily", "partial", True, False), (4, 3, "retry", "partial", True, False), (5, 3, "retry", "partial", True, False),
        (6, 4, "daily", "partial", True, False), (7, 4, "retry", None, False, None), (8, 5, "manual", "success", True, True),
    )
    slots = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 6)], "slot date")
    got = {x["slot"].day: tuple(x)[1:] for x in T.retry_decisions(slots, r).collect()}
    assert got == {1: ("done", None, None), 2: ("retry", 2, 2), 3: ("exhausted", None, None), 4: ("in_progress", None, None), 5: ("no_run", None, None)}


def notices(spark, *rows):
    return spark.createDataFrame([(r, s, dt.datetime(2024, 1, 9)) for r, s in rows], "run_id long, state string, accepted_at timestamp_ntz")


def test_notices(spark):
    r = runs(spark, (1, 1, "daily", "success", True, True), (2, 2, "daily", "partial", True, True), (3, 3, "daily", "lock_contention", True, None), (4, 4, "backfill", "success", True, True), (5, 5, "daily", "success", False, None), (6, 6, "retry", "failed", True, None))
    n = notices(spark, (1, "accepted"))
    owed = T.unreported(r, n)
    assert sorted(x["run_id"] for x in owed.collect()) == [2, 6]
    assert [x["run_id"] for x in T.predating(r, n, F.lit("2024-01-03").cast("timestamp_ntz")).collect()] == [2]
    assert [tuple(x) for x in T.sweep(r, notices(spark, (1, "failed")), without=6).collect()] == [(1, False), (2, True)]
    none = owed.where("false")
    state = lambda *rows, o=none: tuple(T.notice_status(notices(spark, *rows), o).first())[:2]
    assert state() == ("CONFIGURED", "no report has been sent yet") and state((1, "accepted")) == ("VERIFIED", "the last report was accepted")
    assert state((1, "pending"))[0] == "DEGRADED" and state((1, "failed"), (2, "abandoned"), o=owed) == ("FAILED", "1 report(s) awaiting retry; 1 gave up after their attempts; 2 completed run(s) without a report")


def test_reports(spark):
    r = runs(spark, (1, 1, "daily", "success", True, True), (2, 2, "daily", "partial", True, False)).withColumn("is_baseline", F.col("run_id") == 1).withColumn("pending", F.lit(3) * (F.col("run_id") - 1))
    scans = spark.createDataFrame([(1, 1, True, 5, None), (1, 2, True, 6, 6), (1, 3, False, 9, 9), (2, 1, False, 4, None)], "run_id long, ordinal long, qualified boolean, unique_ids long, total long")
    checks = spark.createDataFrame([(1, "content_captured"), (1, "not_found"), (2, "retrieval_failed"), (2, "access_control_challenge")], "run_id long, availability string")
    gaps = spark.createDataFrame([(2, "no_qualified_scan", "x")], "run_id long, kind string, detail string")
    events = spark.createDataFrame([(1, "first_observed"), (2, "first_observed"), (2, "reappeared")], "run_id long, event_kind string")
    f = T.run_facts(r, scans, checks, gaps, events)
    lines = T.report_lines()
    a, b = f.select("*", T.action_required().alias("action"), T.report_subject("Board", F.lit(True)).alias("subject"), T.report_text(lines).alias("text"), T.report_html(lines).alias("html")).orderBy("run_id").collect()
    assert (a["listing_count"], a["source_total"], a["newly_observed"], a["gone"], a["action"]) == (6, 6, None, 1, None)
    assert (b["listing_count"], b["listing_complete"], b["newly_observed"], b["reappeared"], b["n_gaps"]) == (None, False, 1, 1, 1)
    assert b["action"] == "No traversal qualified, so nothing can be said of what seems to be missing; 1 page(s) could not be retrieved; 1 retrieval(s) were inconclusive; 3 queued retrieval(s) were not made."
    assert a["subject"] == "Board OK - 2024-01-01 - 6 advertisements (delayed report)" and b["subject"].startswith("Board EXCEPTIONS - 2024-01-02 - no adv")
    assert a["text"].startswith("Outcome: success\nDate: 2024-01-01") and "Newly observed" not in a["text"] and "<th>Action</th><td>No traversal" in b["html"]


def test_backups_and_health(spark):
    s = spark.createDataFrame([("a", dt.datetime(2024, 1, 5), True), ("a", dt.datetime(2024, 1, 7), False), ("b", dt.datetime(2024, 1, 7), False), ("c", dt.datetime(2024, 1, 1), True)], "source string, taken timestamp_ntz, verified boolean")
    got = {x["source"]: (x["state"], x["age_days"]) for x in T.backup_status(s, F.lit("2024-01-06 12:00:00").cast("timestamp_ntz")).collect()}
    assert got == {"a": ("VERIFIED", 1), "b": ("UNPROTECTED", None), "c": ("DEGRADED", 5)}
    day = lambda x: F.lit(x).cast("date")
    assert spark.range(1).select(T.restore_check_due(day(None), day("2024-02-01")), T.restore_check_due(day("2024-01-02"), day("2024-02-01")), T.restore_check_due(day("2024-01-03"), day("2024-02-01"))).first()[:] == (True, True, False)
    c = spark.createDataFrame([("x", "a", "healthy"), ("x", "b", "unhealthy"), ("y", "c", "strange"), ("y", "d", "healthy")], "g string, component string, health string")
    assert {tuple(r) for r in T.worst(c, "g").collect()} == {("x", "unhealthy", 1, "b"), ("y", "degraded", 1, "c")}


def test_passes_that_agree(spark):
    s = lambda *rows: spark.createDataFrame(list(rows), "g long, m long")
    q = spark.createDataFrame([(1, True), (2, True), (3, False), (4, True)], "g long, qualified boolean")
    out = Q.reconciled(s((1, 1), (2, 1), (3, 1)), s((1, 1), (1, 2), (2, 2), (3, 1)), s((1, 1), (1, 2), (2, 3), (3, 1)), q, "g", "m")
    assert {tuple(r) for r in out.collect()} == {(1, "verification", True), (2, "", False), (3, "discovery,verification", False), (4, "", False)}
    assert {tuple(r) for r in Q.set_differences(s((1, 1), (1, 2)), s((1, 2), (1, 3)), "g", "m").collect()} == {(1, 1, "disappeared"), (1, 3, "appeared")}


def test_disagreement_is_no_absence(spark):
    day = lambda d: dt.date(2024, 1, d)
    grid = spark.createDataFrame([(day(1), 1, True), (day(2), 1, False), (day(3), 1, True), (day(4), 1, False)], "slot date, posting_id long, listed boolean")
    r = runs(spark, *((d, d, "daily", "success", True, True) for d in range(1, 5)))
    p = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 1, 10))], "posting_id long, discovered_at timestamp_ntz")
    seen = spark.createDataFrame([(day(2), 1), (day(3), 1)], "slot date, posting_id long")
    kinds = lambda *a: [(x["slot"].day, x["event_kind"]) for x in P.presence_events(grid, r, p, *a).orderBy("slot", "event_kind").collect()]
    assert kinds(seen) == [(1, "first_observed"), (1, "listed"), (3, "listed"), (4, "absent_qualified")]
    assert (2, "absent_qualified") in kinds() and (3, "reappeared") in kinds()
    assert [tuple(x) for x in P.disagreement_gaps(grid, seen).collect()] == [(day(2), 1, "listing_disagreement_within_run")]


def test_run_log_and_registers(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    log = spark.createDataFrame([(1, t(1), "open", "daily", "s", None), (1, t(2), "heartbeat", None, None, None), (1, t(3), "close", None, None, "success"), (2, t(4), "open", "retry", "s", None), (2, t(5), "heartbeat", None, None, None)], "run_id long, at timestamp_ntz, event string, kind string, slot string, outcome string")
    a, b = W.runs_of(log).orderBy("run_id").collect()
    assert (a["started_at"], a["ended_at"], a["outcome"], a["kind"]) == (t(1), t(3), "success", "daily") and (b["ended_at"], b["alive_at"], b["kind"]) == (None, t(5), "retry")
    assert W.has_baseline(W.runs_of(log)).first()[0] and not W.has_baseline(W.runs_of(log).where("run_id = 2")).first()[0]
    rows = spark.createDataFrame([("k", t(2), "late"), ("k", t(1), "early"), ("j", t(3), "x")], "key string, at timestamp_ntz, config string")
    assert {(r["key"], r["config"]) for r in W.registered(rows, ["key"], "at", "config").collect()} == {("k", "early"), ("j", "x")}
    one = lambda c: spark.range(1).select(c).first()[0]
    assert [one(W.discovery_basis(F.lit(x), F.lit(y))) for x, y in ((True, True), (False, True), (True, False))] == ["baseline", "listing", "direct_check"]
    assert [one(W.transport_failure(F.lit(e).cast("string"), F.lit(m))) for e, m in (("ConnectError", "getaddrinfo failed"), ("ConnectError", "refused"), ("Other", ""), (None, ""))] == ["dns", "connect", "transport", None]
    assert one(W.gone_at_source(F.lit("HTTP 410 Gone"))) and not one(W.gone_at_source(F.lit(None).cast("string")))


def test_queues(spark):
    p = spark.createDataFrame([(k, k == 1, dt.datetime(2024, 1, k) if k != 6 else None) for k in range(1, 8)], "posting_id long, discovered_here boolean, last_checked timestamp_ntz")
    listed = spark.createDataFrame([(1,), (2,)], "posting_id long")
    policy = spark.createDataFrame([(3, "weekly", dt.datetime(2024, 2, 1)), (4, "weekly", dt.datetime(2024, 1, 1)), (5, "daily", None)], "posting_id long, tier string, next_due timestamp_ntz")
    out = {r["posting_id"]: tuple(r)[1:] for r in W.detail_queue(p, listed, policy, F.lit("2024-01-10").cast("timestamp_ntz"), F.lit(False), 3).collect()}
    assert out == {1: (10, "listed"), 2: (50, "listed"), 3: (None, "deferred"), 4: (90, "historical-weekly"), 5: (80, "historical-daily"), 6: (80, "historical-daily"), 7: (None, "deferred")}
    q = spark.createDataFrame([(1, 10, "pending", 0, 2, None), (2, 5, "claimed", 1, 2, 7), (3, 5, "claimed", 0, 2, 8), (4, 5, "pending", 0, 2, None)], "work_id long, priority long, state string, attempts long, most_attempts long, claimed_by long")
    assert [r["work_id"] for r in W.claim(q, 2).collect()] == [4, 1]
    res = spark.createDataFrame([(2, False, "e"), (3, False, "e"), (4, True, None)], "work_id long, ok boolean, error string")
    assert {r["work_id"]: (r["state"], r["attempts"], r["error"]) for r in W.after_attempt(q, res).collect()} == {1: ("pending", 0, None), 2: ("failed", 2, "e"), 3: ("pending", 1, "e"), 4: ("done", 1, None)}
    assert {r["work_id"]: r["state"] for r in W.reclaimed(q, spark.createDataFrame([(8,)], "run_id long")).collect()} == {1: "pending", 2: "pending", 3: "claimed", 4: "pending"}
    asked = spark.createDataFrame([("d", 1, 50, "b", 2), ("d", 1, 10, "a", 3)], "kind string, work_key long, priority long, payload string, asked_at long")
    assert W.merged(asked).first()[:] == ("d", 1, 10, "a", 2)


def test_captures_texts_and_scans(spark):
    uses = spark.createDataFrame([(1, "u", 5, 1), (1, "u", 4, 9), (2, "u", 6, 1)], "run_id long, url string, observation_id long, position long")
    once, bridge = W.first_captures(uses)
    assert {tuple(r) for r in once.collect()} == {(1, "u", 4, 2), (2, "u", 6, 1)} and bridge.count() == 3
    state = lambda o, b, m, ok: spark.range(1).select(W.resource_text_state(F.lit(o), F.lit(b).cast("binary"), F.lit(m).cast("string"), F.lit(ok))).first()[0]
    assert [state("captured", "x", "text/html", True), state("captured", "x", "application/xml", False), state("captured", "x", "application/pdf", True), state("failed", "x", "text/html", True), state("captured", "", None, True)] == ["ok", "failed", "unavailable", "not_attempted", "not_attempted"]
    scans = spark.createDataFrame([(1, 1, 1, True), (1, 2, 2, True), (1, 3, 3, False), (2, 4, 1, False)], "run_id long, scan_id long, ordinal long, qualified boolean")
    assert [tuple(r) for r in W.last_qualified_scan(scans).collect()] == [(1, 2)]


def test_provenance_beside_the_data(spark, tmp_path):
    df = spark.createDataFrame([("=a", 1)], "x string, n long")
    X.write_csv(df, f"{tmp_path}/c", {"rows": 1})
    X.write_json(df, f"{tmp_path}/j", {"rows": 1})
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").first()[:] == ("'=a", "1") and spark.read.json(f"{tmp_path}/j").count() == 1
    assert spark.read.text(f"{tmp_path}/j/_provenance").first()[0] == '{"rows": 1}'


def test_lookups(spark):
    t = lambda rows, kind: spark.createDataFrame(rows, kind)
    postings = t([(1, "a"), (2, "b")], "posting_id long, job_id string")
    assert {tuple(r) for r in K.known_entries(t([("a", 1), ("x", 2)], "job_id string, n int"), postings).collect()} == {("a", 1, 1), ("x", 2, None)}
    assert {tuple(r) for r in K.identities(postings, t([("b",), ("b",), ("z",)], "job_id string")).collect()} == {("b", 2), ("z", None)}
    known, applied = t([(1, "one"), (2, "two"), (3, "three")], "version int, name string"), t([(1, "one"), (2, "other")], "version int, name string")
    assert [tuple(r) for r in K.pending_migrations(known, applied).collect()] == [(2, "two", "conflict"), (3, "three", "pending")]
    at = lambda h, m: spark.range(1).select(K.slot_has_passed(F.lit(f"2024-01-01 {h:02}:{m:02}:00").cast("timestamp_ntz"), 6, 30)).first()[0]
    assert [at(6, 29), at(6, 30), at(23, 0), at(0, 0)] == [False, True, True, False]
    broken = K.broken_rules(t([("skipped", None), ("skipped", "x"), (None, "x")], "state string, body string"), {"no_body": (F.col("state") == "skipped", F.col("body").isNull())})
    assert [tuple(r) for r in broken.collect()] == [("skipped", "x", ["no_body"])]


def test_appends_never_change(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k long, v string")
    store.append(rows, f"file://{tmp_path}/t", ["k"])
    store.append(spark.createDataFrame([(2, "changed"), (3, "c")], "k long, v string"), f"file://{tmp_path}/t", ["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/t").collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_components(spark):
    one = lambda s: spark.createDataFrame([(s,)], "state string")
    rows = {r["component"]: r["health"] for r in T.status_components({"a": one("HEALTHY"), "b": one("odd"), "c": one("UNCONFIGURED")}).collect()}
    assert rows == {"a": "healthy", "b": "degraded", "c": "healthy", "overall": "degraded"}
