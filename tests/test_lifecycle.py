from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import Contracts
from tidemark.operators import lifecycle as L


@pytest.mark.parametrize(
    ("signal", "ok", "status", "redirect", "shown", "body", "closure", "want"),
    [
        ("captcha", False, 403, "none", None, None, None, ("not_observed", "access_control_challenge")), (None, False, 404, "none", None, None, None, ("not_observed", "not_found")),
        (None, False, 500, "none", None, None, None, ("not_observed", "retrieval_failed")), (None, True, 200, "to_listing", None, "x", None, ("absent_on_page", "redirected_to_listing")),
        (None, True, 200, "to_other_job", "2", "x", None, ("mismatch", "redirected_to_other_job")), (None, True, 200, "none", "2", "x", None, ("mismatch", "identity_mismatch")),
        (None, True, 200, "none", "1", "", "closed", ("match", "explicit_closure")), (None, True, 200, "none", None, None, None, ("absent_on_page", "not_found")),
        (None, True, 200, "none", "1", "x", "closed", ("match", "content_captured")), (None, True, 200, "none", None, "x", None, ("absent_on_page", "content_captured")),
    ],
)
def test_availability(spark, signal, ok, status, redirect, shown, body, closure, want):
    s = lambda v: F.lit(v).cast("string")
    got = spark.range(1).select(L.availability(s(signal), F.lit(ok), F.lit(status), s(redirect), F.lit("1"), s(shown), s(body), s(closure)).alias("x")).first()["x"]
    assert tuple(got) == want


def captures(spark, *fps):
    rows = [(k, 1, dt.datetime(2024, 1, k + 1), f, "t") for k, f in enumerate(fps)]
    return spark.createDataFrame(rows, "observation_id long, posting_id long, observed_at timestamp_ntz, fingerprint string, title string")


def test_versions_and_new_readings(spark):
    c, now = captures(spark, "a", "b", "a"), Contracts()
    v = L.register_versions(c, now)
    assert v.count() == 2 and v.agg(F.sum("observed")).first()[0] == 3
    assert L.reinterpret(v, c, now).count() == 0
    newer = Contracts(parser="2.0.0")
    added = L.reinterpret(v, c, newer)
    assert added.count() == 2
    assert L.relink(c, v.union(added), newer).where("linked_lineage is null").count() == 0


def test_outcomes(spark):
    one = lambda *a: spark.range(1).select(L.run_outcome(*(F.lit(x) for x in a)).alias("x")).first()["x"]
    assert tuple(one(True, True, 0, False, 0, 0, False)) == ("success", None)
    assert one(False, True, 0, False, 0, 0, False)["outcome"] == "failed"
    assert one(True, False, 0, False, 0, 0, False)["outcome"] == "partial"
    assert one(True, True, 2, True, 0, 0, False)["problem"] == "2 queued checks were not made; the sets of the passes differ"


def test_runs_work_and_notices(spark):
    r = spark.createDataFrame([(dt.datetime(2024, 1, 1), None, "open"), (dt.datetime(2024, 1, 2), None, "open")], "started_at timestamp_ntz, ended_at timestamp_ntz, outcome string")
    assert [x["outcome"] for x in L.abandon_stale(r, "2024-01-02 06:00:00").orderBy("started_at").collect()] == ["aborted", "open"]
    w = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "x"), ("b", "x"), ("c", "ok")], "work_key string, result string")
    assert {x["work_key"]: x["state"] for x in L.work_state(w).collect()} == {"a": "failed", "b": "pending", "c": "done"}
    step = lambda *a: spark.range(1).select(L.delivery(*(F.lit(x) for x in a)).alias("x")).first()["x"]
    assert [step("accepted", 9, True, False), step("failed", 1, False, True), step("failed", 5, False, False), step("failed", 1, True, False), step("failed", 1, False, False)] == ["accepted", "accepted", "abandoned", "abandoned", "failed"]
    assert spark.range(1).select(L.exit_code(F.lit("HEALTHY"), F.lit(False)).alias("x")).first()["x"] == 3
