from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import presence as P
from tidemark.operators import qualify as Q
from tidemark.operators import views as V

OBS = "observation_id long, posting_id long, observed_at string, availability string, identity string, lineage string, version long, slot string"


def observations(spark, rows):
    df = spark.createDataFrame(rows, OBS)
    return df.withColumn("observed_at", F.to_timestamp_ntz("observed_at")).withColumn("slot", F.to_date("slot"))


def row(n, at, state="content_captured", version=None, lineage="1", posting=1, identity="match"):
    return (n, posting, f"2024-01-{at:02d} 12:00:00", state, identity, lineage, version, f"2024-01-{at:02d}")


def test_there_and_back_is_two_changes(spark):
    o = observations(spark, [row(1, 1, version=0), row(2, 2, "retrieval_failed"), row(3, 3, version=1), row(4, 4, version=0)])
    c = V.content_changes(o).orderBy("observation_id").collect()
    assert [(r.from_version, r.to_version) for r in c] == [(0, 1), (1, 0)]


def test_other_lineages_do_not_compare(spark):
    o = observations(spark, [row(1, 1, version=0), row(2, 2, version=1, lineage="2")])
    assert V.content_changes(o).count() == 0


def test_latest_breaks_ties_by_id(spark):
    o = observations(spark, [row(1, 1, version=0), row(2, 1, version=1)])
    assert V.latest(o, "posting_id").first()["version"] == 1


def grid(spark, days):
    return spark.createDataFrame([(d, 1, x) for d, x in days], "slot string, posting_id long, listed boolean").withColumn("slot", F.to_date("slot"))


def test_two_day_rule_counts_qualified_days_only(spark):
    r = P.repeatedly_unlisted(grid(spark, [("2024-01-09", True), ("2024-01-10", False), ("2024-01-13", False)])).first()
    assert (r["absent_days"], r["rule_met"], r["uncovered_days"]) == (2, True, 2)
    r = P.repeatedly_unlisted(grid(spark, [("2024-01-10", False)])).first()
    assert not r["rule_met"]


def test_reappearance(spark):
    g = grid(spark, [("2024-01-01", True), ("2024-01-02", False), ("2024-01-03", True)])
    at = lambda h: F.to_timestamp_ntz(F.concat(F.col("slot").cast("string"), F.lit(f" {h}:00:00")))
    runs = g.select("slot", at("06").alias("started_at"), at("07").alias("ended_at"))
    postings = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 6, 30))], "posting_id long, discovered_at timestamp_ntz")
    kinds = [r.event_kind for r in P.presence_events(g, runs, postings).orderBy("slot", "event_kind").collect()]
    assert kinds == ["first_observed", "listed", "absent_qualified", "listed", "reappeared"]


def test_streaks(spark):
    none = spark.createDataFrame([], "slot date, posting_id long")
    o = observations(spark, [row(1, 1), row(2, 2, "not_found"), row(3, 3, "retrieval_failed"), row(4, 4, "not_found"), row(5, 5, "explicit_closure")])
    r = P.recheck_policy(o, none).first()
    assert (r["streak"], r["tier"], str(r["next_due"])) == (3, "weekly", "2024-01-12 12:00:00")
    listed = spark.createDataFrame([(dt.date(2024, 1, 5), 1)], "slot date, posting_id long")
    assert P.recheck_policy(o, listed).first()["tier"] == "daily"


PAGES = "scan_id long, page_number long, requested_url string, expected_url string, ok boolean, recognized boolean, empty_validated boolean, unresolved long, signal string, to_listing boolean, status int, n_ids long, signature string, remaining long, next_url string, bound int"


def assessed(spark, *pages, rows=None):
    """Pages of ``page``; rows: job ids of the whole scan, by default all pages' ids are different."""
    ids = rows if rows is not None else range(sum(p[11] for p in pages))
    return Q.assess(Q.scan_facts(spark.createDataFrame(list(pages), PAGES), spark.createDataFrame([(1, k) for k in ids], "scan_id long, job_id long"))).first()


def page(n, sig, ids=3, remaining=None, nxt=None, ok=True, signal=None, status=200, recognized=True, start="u"):
    return (1, n, start, "u", ok, recognized, recognized and not ids, 0, signal, True, status, ids, sig, remaining, nxt, 30)


def test_qualification(spark):
    assert assessed(spark, page(1, "a", remaining=2, nxt="u"), page(2, "b", ids=2))["qualified"]
    r = assessed(spark, page(1, "a", remaining=7, nxt="u"), page(2, "b", ids=2))
    assert (r["reason"], r["total"], r["ids"]) == ("source_count_reconciles failed", 10, 5)
    # a row that is on two pages is one id: occurrences are never held against the source's total
    r = assessed(spark, page(1, "a", remaining=1, nxt="u"), page(2, "b", ids=2), rows=[0, 1, 2, 2, 3])
    assert (r["qualified"], r["occurrences"], r["ids"], r["duplicates"]) == (True, 5, 4, 1)
    assert assessed(spark, page(1, "a", start="u?category=x"))["reason"] == "scope_unfiltered failed"
    assert "no_pagination_loop failed" in assessed(spark, page(1, "a", nxt="u"), page(2, "a"))["reason"]
    assert "no_access_control_response failed" in assessed(spark, page(1, "a", signal="captcha"))["reason"]
    r = assessed(spark, page(1, "a", ids=0))
    assert r["qualified"] and len(r["checks"]) == 12 and [c["name"] for c in r["checks"] if c["passed"] is None] == ["source_count_reconciles"]
    assert [c["detail"] for c in r["checks"] if c["name"] == "within_page_bound"] == ['{"pages":1,"bound":30}']
    assert not assessed(spark, page(1, "a", ids=0, recognized=False))["qualified"]


def test_sets(spark):
    a = spark.createDataFrame([(1, 1), (1, 2)], "g long, m long")
    b = spark.createDataFrame([(1, 2), (1, 3)], "g long, m long")
    r = Q.compare_sets(a, b, "g", "m").first()
    assert (r["n_appeared"], r["n_disappeared"], r["sets_match"], r["counts_match"]) == (1, 1, False, True)


def test_rotation_prunes_nothing_while_one_is_verified(spark):
    rows = [("s", dt.datetime(2024, 1, d, 3), d == 1) for d in range(1, 31)]
    s = spark.createDataFrame(rows, "source string, taken timestamp_ntz, verified boolean")
    assert Q.rotation(s).where("decision = 'prune'").count() == 0
    many = Q.rotation(s.withColumn("verified", F.lit(True))).groupBy("decision").count().collect()
    assert {r["decision"]: r["count"] for r in many}["newest_verified"] == 1


def test_empty_frames(spark):
    o = observations(spark, [])
    assert V.content_changes(o).count() == 0
    assert V.latest(o, "posting_id").count() == 0
