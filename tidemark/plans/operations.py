"""Queries over runs, their work, reports and parsed pages, with their SQL. Each calls the operator that a user of the library would."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import boards as B
from tidemark.functions import scalars as S
from tidemark.operators import export as X
from tidemark.operators import lifecycle as L
from tidemark.operators import lookups as K
from tidemark.operators import presence as P
from tidemark.operators import qualify as Q
from tidemark.operators import queue as W
from tidemark.operators import status as T
from tidemark.operators import views as V
from tidemark.plans.evidence import Evidence, query, text
from tidemark.sources import store
from tidemark.sources.stages import spread


def sql(name: str, statement: str | None = None):
    return query(name, statement, ctes=False)


# -- collection, retries, failures ------------------------------------------


@query("collection_state", """SELECT CAST(last + i AS VARCHAR) AS as_of, CASE WHEN last + i - q >= 2 THEN 'STALE' WHEN o = 'success' THEN 'HEALTHY' WHEN o = 'partial' THEN 'DEGRADED' WHEN o = 'failed' THEN 'FAILED' ELSE 'UNKNOWN' END AS state, o AS last_outcome, CAST(q AS VARCHAR) AS last_qualified, last + i - q AS days_since_qualified
  FROM (SELECT max(slot) AS last, max(slot) FILTER (qualified) AS q, arg_max(outcome, started_at) AS o FROM runs), (VALUES (0), (1), (3)) t(i)""")
def collection_state(e: Evidence) -> DataFrame:
    days = e.runs.agg(F.max("slot").alias("last")).select(F.explode(F.array(*map(F.lit, (0, 1, 3)))).alias("i"), "last").select(F.date_add("last", F.col("i")).alias("as_of"))
    return T.collection_state(e.runs, days).select(*text("as_of"), "state", "last_outcome", *text("last_qualified"), F.col("days_since_qualified").cast("long").alias("days_since_qualified"))


_TRIES = """tries AS (SELECT slot, posting_id % 4 AS k, date_diff('day', DATE '2000-01-01', slot) * 4 + posting_id % 4 AS run_id, CASE WHEN posting_id % 4 = 0 THEN 'daily' ELSE 'retry' END AS kind,
  CASE WHEN count(*) FILTER (availability = 'retrieval_failed') * 10 <= count(*) THEN 'success' ELSE 'partial' END AS outcome, CASE WHEN day(slot) % 11 = 0 AND posting_id % 4 = day(slot) % 4 THEN NULL ELSE max(observed_at) END AS ended_at FROM obs WHERE posting_id % 4 <= day(slot) % 4 GROUP BY 1, 2)"""


def _tries(e: Evidence) -> DataFrame:
    """Several runs a slot: a daily one and up to three retries; of every eleventh day the last is still open."""
    k, most = F.col("posting_id") % 4, F.day("slot") % 4
    o = e.obs.where(k <= most).groupBy("slot", k.alias("k")).agg(F.count_if(F.col("availability") == "retrieval_failed").alias("failed"), F.count("*").alias("n"), F.max("observed_at").alias("latest"))
    return o.select(
        (F.date_diff("slot", F.lit("2000-01-01").cast("date")) * 4 + F.col("k")).alias("run_id"), "slot", F.when(F.col("k") == 0, "daily").otherwise("retry").alias("kind"),
        F.when(F.col("failed") * 10 <= F.col("n"), "success").otherwise("partial").alias("outcome"), F.when(~((F.day("slot") % 11 == 0) & (F.col("k") == most)), F.col("latest")).alias("ended_at"),
    )


@query("retry_decision", f"""SELECT CAST(slot AS VARCHAR) AS slot, decision, CASE WHEN decision = 'retry' THEN parent END AS parent_run, CASE WHEN decision = 'retry' THEN retries + 2 END AS attempt FROM (SELECT s.slot, parent, retries, CASE WHEN retries IS NULL THEN 'no_run' WHEN n_open > 0 THEN 'in_progress' WHEN done THEN 'done' WHEN retries >= 2 THEN 'exhausted' ELSE 'retry' END AS decision
  FROM (SELECT slot FROM runs UNION ALL SELECT DATE '1999-12-31') s LEFT JOIN (SELECT slot, count(*) FILTER (ended_at IS NULL) AS n_open, bool_or(outcome = 'success') AS done, count(*) FILTER (kind = 'retry') AS retries, min(run_id) FILTER (kind = 'daily') AS parent FROM (WITH {_TRIES} SELECT * FROM tries) GROUP BY 1) r ON r.slot = s.slot)""")
def retry_decision(e: Evidence) -> DataFrame:
    slots = e.runs.select("slot").union(e.spark.range(1).select(F.lit("1999-12-31").cast("date")))
    return T.retry_decisions(slots, _tries(e)).select(*text("slot"), "decision", F.col("parent_run").cast("long").alias("parent_run"), F.col("attempt").cast("long").alias("attempt"))


@query("startup_failures", "SELECT CAST(o.slot AS VARCHAR) AS slot, count(*) AS failures, CAST(max(o.observed_at) AS VARCHAR) AS latest, bool_or(r.outcome IN ('success', 'partial')) AS resolved FROM obs o LEFT JOIN runs r USING (slot) WHERE o.availability = 'retrieval_failed' GROUP BY 1")
def startup_failures(e: Evidence) -> DataFrame:
    records = e.obs.where("availability = 'retrieval_failed'").select("slot", F.col("observed_at").alias("failed_at"))
    return T.startup_failures(records, e.runs).select(*text("slot"), "failures", *text("latest"), "resolved")


# -- notices and reports ----------------------------------------------------

_OWED = "SELECT slot, outcome FROM runs WHERE kind IN ('daily', 'retry') AND day(slot) % 3 <> 0"


def _told(e: Evidence) -> tuple[DataFrame, DataFrame]:
    """Runs by their day as run_id, and notices of every third day's."""
    runs = e.runs.withColumn("run_id", F.col("slot"))
    return runs, runs.where(F.day("slot") % 3 == 0).select("run_id", F.when(F.day("slot") % 2 == 0, "accepted").when(F.day("slot") % 9 == 0, "abandoned").otherwise("failed").alias("state"), F.col("ended_at").alias("accepted_at"))


@query("unreported_runs", f"SELECT CAST(slot AS VARCHAR) AS slot, outcome FROM ({_OWED})")
def unreported_runs(e: Evidence) -> DataFrame:
    return T.unreported(*_told(e)).select(*text("slot"), "outcome")


@query("predating_runs", f"SELECT CAST(slot AS VARCHAR) AS run_id, 'skipped' AS state FROM ({_OWED}) JOIN runs USING (slot) WHERE ended_at < (SELECT min(slot) + 10 FROM runs)")
def predating_runs(e: Evidence) -> DataFrame:
    epoch = e.runs.agg(F.date_add(F.min("slot"), 10).cast("timestamp_ntz").alias("epoch"))
    runs, notices = _told(e)
    return T.predating(runs.join(F.broadcast(epoch)), notices, F.col("epoch")).select(*text("run_id"), "state")


@query("notice_sweep", "SELECT CAST(slot AS VARCHAR) AS run_id, delayed FROM (SELECT slot, FALSE AS delayed FROM runs WHERE day(slot) % 3 = 0 AND day(slot) % 2 = 1 AND day(slot) % 9 <> 0 UNION ALL SELECT slot, TRUE FROM runs WHERE day(slot) % 3 <> 0) ORDER BY slot LIMIT 20")
def notice_sweep(e: Evidence) -> DataFrame:
    return T.sweep(*_told(e)).select(*text("run_id"), "delayed")


@query("notice_status", """SELECT CASE WHEN abandoned > 0 THEN 'FAILED' WHEN failed > 0 OR unreported > 0 THEN 'DEGRADED' WHEN accepted > 0 THEN 'VERIFIED' ELSE 'CONFIGURED' END AS state,
  CASE WHEN failed + abandoned + unreported > 0 THEN concat_ws('; ', CASE WHEN failed > 0 THEN format('{} report(s) awaiting retry', failed) END, CASE WHEN abandoned > 0 THEN format('{} gave up after their attempts', abandoned) END, CASE WHEN unreported > 0 THEN format('{} completed run(s) without a report', unreported) END) WHEN accepted > 0 THEN 'the last report was accepted' ELSE 'no report has been sent yet' END AS detail,
  CAST(0 AS BIGINT) AS pending, failed, abandoned, unreported, last_accepted FROM (SELECT count(*) FILTER (day(slot) % 3 = 0 AND day(slot) % 2 = 0) AS accepted, count(*) FILTER (day(slot) % 9 = 0 AND day(slot) % 2 = 1) AS abandoned,
  count(*) FILTER (day(slot) % 3 = 0 AND day(slot) % 2 = 1 AND day(slot) % 9 <> 0) AS failed, count(*) FILTER (day(slot) % 3 <> 0) AS unreported, CAST(max(ended_at) FILTER (day(slot) % 3 = 0 AND day(slot) % 2 = 0) AS VARCHAR) AS last_accepted FROM runs)""")
def notice_status(e: Evidence) -> DataFrame:
    runs, notices = _told(e)
    return T.notice_status(notices, T.unreported(runs, notices)).withColumn("last_accepted", F.col("last_accepted").cast("string"))


@sql("notification_states", "SELECT state, count(*) AS n FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'accepted' WHEN o_orderpriority[1] = '5' THEN 'abandoned' WHEN o_custkey % 7 >= 5 THEN 'abandoned' ELSE 'failed' END AS state FROM orders) GROUP BY 1")
def notification_states(e: Evidence) -> DataFrame:
    before = F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("failed")
    state = L.delivery(before, F.col("o_custkey") % 7, F.substring("o_orderpriority", 1, 1) == "5", F.lit(False))
    return e.table("orders").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


_FACTS = """scans AS (SELECT slot, observation_id % 2 AS ordinal, count(DISTINCT posting_id) AS ids FROM obs WHERE availability = 'content_captured' GROUP BY 1, 2),
f AS (SELECT r.slot, r.kind, r.outcome, qualified AS listing_complete, CASE WHEN qualified THEN arg_max(ids, ordinal) END AS listing_count, any_value(started_at) AS started_at, any_value(ended_at) AS ended_at FROM runs r LEFT JOIN scans s ON s.slot = r.slot GROUP BY 1, 2, 3, 4),
c AS (SELECT slot, count(*) AS attempted, count(*) FILTER (availability = 'content_captured') AS captured, count(*) FILTER (availability IN ('explicit_closure', 'redirected_to_listing', 'not_found')) AS gone, count(*) FILTER (availability = 'retrieval_failed') AS not_retrieved FROM obs GROUP BY 1),
x AS (SELECT slot, count(*) FILTER (event_kind = 'first_observed') AS fresh, count(*) FILTER (event_kind = 'absent_qualified') AS no_longer_listed, count(*) FILTER (event_kind = 'reappeared') AS reappeared FROM pev GROUP BY 1),
facts AS (SELECT f.*, attempted, captured, gone, not_retrieved, CASE WHEN day(slot) <> 1 THEN coalesce(fresh, 0) END AS newly_observed, coalesce(no_longer_listed, 0) AS no_longer_listed, coalesce(reappeared, 0) AS reappeared, CASE WHEN listing_complete THEN 0 ELSE 1 END AS n_gaps, CAST(day(slot) % 4 AS BIGINT) AS pending,
  concat_ws('; ', CASE WHEN NOT listing_complete THEN 'no traversal qualified, so nothing can be said of what seems to be missing' END, CASE WHEN not_retrieved > 0 THEN format('{} page(s) could not be retrieved', not_retrieved) END, CASE WHEN day(slot) % 4 > 0 THEN format('{} queued retrieval(s) were not made', day(slot) % 4) END) AS problems
  FROM f JOIN c USING (slot) LEFT JOIN x USING (slot))"""


def _facts(e: Evidence) -> DataFrame:
    run = F.col("slot").alias("run_id")
    runs = e.runs.select(run, "kind", "outcome", "slot", "started_at", "ended_at", (F.day("slot") == 1).alias("is_baseline"), (F.day("slot") % 4).cast("long").alias("pending"))
    scans = e.obs.where("availability = 'content_captured'").groupBy("slot", (F.col("observation_id") % 2).alias("ordinal")).agg(F.count_distinct("posting_id").alias("unique_ids"))
    scans = scans.join(e.runs.select("slot", "qualified"), "slot").select(run, "ordinal", "qualified", "unique_ids", F.lit(None).cast("long").alias("total"))
    gaps = P.coverage_gaps(e.runs).select(run, F.col("gap_kind").alias("kind"), "detail")
    return T.run_facts(runs, scans, e.obs.select(run, "availability"), gaps, e.events.select(run, "event_kind"))


@query("run_facts", f"SELECT CAST(slot AS VARCHAR) AS slot, kind, outcome, listing_count, listing_complete, attempted, captured, gone, not_retrieved, n_gaps, newly_observed, no_longer_listed, reappeared FROM (WITH {_FACTS} SELECT * FROM facts)")
def run_facts(e: Evidence) -> DataFrame:
    return _facts(e).select(*text("slot"), "kind", "outcome", "listing_count", "listing_complete", "attempted", "captured", "gone", "not_retrieved", "n_gaps", "newly_observed", "no_longer_listed", "reappeared")


@query("run_reports", f"""SELECT CAST(slot AS VARCHAR) AS slot, 'Board ' || CASE outcome WHEN 'success' THEN 'OK' WHEN 'partial' THEN 'EXCEPTIONS' WHEN 'failed' THEN 'FAILED' END || ' - ' || slot || ' - ' || coalesce(CAST(listing_count AS VARCHAR), 'no') || ' advertisements' || CASE WHEN day(slot) % 2 = 0 THEN ' (delayed report)' ELSE '' END AS subject,
  CASE WHEN outcome = 'failed' THEN 'The collection failed. Its date stays a gap unless a run succeeds today.' WHEN problems <> '' THEN upper(problems[1]) || substr(problems, 2) || '.' END AS action, 11 - CASE WHEN listing_count IS NULL THEN 1 ELSE 0 END - CASE WHEN newly_observed IS NULL THEN 1 ELSE 0 END + CASE WHEN outcome = 'failed' OR problems <> '' THEN 1 ELSE 0 END AS n_lines FROM (WITH {_FACTS} SELECT * FROM facts)""")
def run_reports(e: Evidence) -> DataFrame:
    f = _facts(e)
    lines = T.report_lines()
    return f.select(*text("slot"), T.report_subject("Board", F.day("slot") % 2 == 0).alias("subject"), T.action_required().alias("action"), F.size(F.split(T.report_text(lines), "\n")).cast("long").alias("n_lines"))


@sql("backup_status", "SELECT o_custkey % 50 AS source, CASE WHEN n IS NULL THEN 'UNPROTECTED' WHEN h < 48 THEN 'VERIFIED' ELSE 'DEGRADED' END AS state, CAST(n AS VARCHAR) AS newest, CAST(floor(h / 24) AS BIGINT) AS age_days, snapshots FROM (SELECT o_custkey % 50 AS o_custkey, max(o_orderdate) FILTER (o_orderkey % 40 < 3) AS n, count(*) AS snapshots, date_diff('hour', max(o_orderdate) FILTER (o_orderkey % 40 < 3), TIMESTAMP '1998-08-03 12:00:00') AS h FROM orders GROUP BY 1)")
def backup_status(e: Evidence) -> DataFrame:
    snaps = e.table("orders").select((F.col("o_custkey") % 50).alias("source"), F.to_timestamp_ntz(F.col("o_orderdate").cast("string")).alias("taken"), (F.col("o_orderkey") % 40 < 3).alias("verified"))
    return T.backup_status(snaps, F.lit("1998-08-03 12:00:00").cast("timestamp_ntz")).select("source", "state", *text("newest"), "age_days", "snapshots")


@sql("worst_component", "SELECT source, CASE max(CASE WHEN n > 4000 THEN 3 WHEN n > 1500 THEN 2 ELSE 1 END) WHEN 3 THEN 'unhealthy' WHEN 2 THEN 'degraded' ELSE 'healthy' END AS health FROM (SELECT source, length(text) AS n FROM documents) GROUP BY 1")
def worst_component(e: Evidence) -> DataFrame:
    n = F.length("text")
    parts = e.table("documents").select("source", F.col("doc_id").alias("component"), F.when(n > 4000, "unhealthy").when(n > 1500, "degraded").otherwise("healthy").alias("health"))
    return T.worst(parts, "source").select("source", "health")


@query("health_document", """SELECT 'Collection is ' || lower(state) || '; notices are failed.' AS summary, CASE WHEN state IN ('FAILED', 'STALE') THEN 1 WHEN state IN ('DEGRADED', 'UNKNOWN') THEN 2 ELSE 0 END AS exit_code, covered, n AS postings
  FROM (SELECT CASE WHEN max(slot) - max(slot) FILTER (qualified) >= 2 THEN 'STALE' WHEN arg_max(outcome, started_at) = 'success' THEN 'HEALTHY' WHEN arg_max(outcome, started_at) = 'partial' THEN 'DEGRADED' ELSE 'FAILED' END AS state, count(*) FILTER (qualified) AS covered FROM runs), (SELECT count(*) AS n FROM postings)""")
def health_document(e: Evidence) -> DataFrame:
    runs, notices = _told(e)
    last = e.runs.agg(F.max("slot").alias("as_of"))
    lifetime = e.postings.agg(F.count("*").alias("postings"), F.sum("observations").alias("observations"))
    backup = e.spark.range(1).select(F.lit("VERIFIED").alias("state"))
    doc = T.health_document(T.collection_state(e.runs, last), P.coverage_window(e.runs), T.notice_status(notices, T.unreported(runs, notices)), lifetime, backup)
    value = lambda path: F.get_json_object("document", path).cast("long")
    return doc.select("summary", "exit_code", value("$.coverage.covered").alias("covered"), value("$.lifetime.postings").alias("postings"))


# -- work, addresses, attempts ----------------------------------------------


@query("detail_queue", """SELECT posting_id, CASE WHEN listed THEN CASE WHEN here THEN 10 ELSE 50 END WHEN chosen THEN CASE WHEN tier = 'weekly' THEN 90 ELSE 80 END END AS priority, CASE WHEN listed THEN 'listed' WHEN chosen THEN CASE WHEN tier = 'weekly' THEN 'historical-weekly' ELSE 'historical-daily' END ELSE 'deferred' END AS because
  FROM (SELECT *, old AND row_number() OVER (PARTITION BY old ORDER BY checked, posting_id) <= 100 AS chosen FROM (SELECT p.posting_id, p.discovered_at >= (SELECT max(started_at) FROM runs) AS here, c.checked, coalesce(tier, 'daily') AS tier, e.posting_id IS NOT NULL AS listed, e.posting_id IS NULL AND NOT coalesce(tier = 'weekly' AND next_due > (SELECT max(ended_at) FROM runs), FALSE) AS old
  FROM postings p LEFT JOIN pol USING (posting_id) LEFT JOIN (SELECT posting_id, max(observed_at) AS checked FROM obs GROUP BY 1) c USING (posting_id) LEFT JOIN (SELECT DISTINCT posting_id FROM entries WHERE slot = (SELECT max(slot) FROM runs)) e USING (posting_id)))""")
def detail_queue(e: Evidence) -> DataFrame:
    last = e.runs.agg(F.max("slot").alias("slot"), F.max("started_at").alias("began"), F.max("ended_at").alias("as_of"))
    checked = e.obs.groupBy("posting_id").agg(F.max("observed_at").alias("last_checked"))
    postings = e.postings.join(checked, "posting_id", "left").join(F.broadcast(last)).select("posting_id", (F.col("discovered_at") >= F.col("began")).alias("discovered_here"), "last_checked")
    policy = e.policy.join(F.broadcast(last.select("as_of")))
    # the instant goes with the policy's rows, so that no value is fetched to the driver
    policy = policy.select("posting_id", "tier", F.when(F.col("next_due") > F.col("as_of"), F.lit("9999-01-01").cast("timestamp_ntz")).alias("next_due"))
    return W.detail_queue(postings, e.entries.join(F.broadcast(last.select("slot")), "slot"), policy, F.lit("9998-01-01").cast("timestamp_ntz"), F.lit(False), 100)


@sql("priority_queue", "SELECT o_custkey AS work_key, CAST(min(CAST(o_orderpriority[1] AS INTEGER) * 10) AS BIGINT) AS priority, arg_min(o_orderkey, (CAST(o_orderpriority[1] AS INTEGER) * 10, o_orderkey)) AS payload, count(*) AS asked FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1")
def priority_queue(e: Evidence) -> DataFrame:
    rank = F.substring("o_orderpriority", 1, 1).cast("long") * 10
    rows = e.table("orders").where("o_orderstatus <> 'F'").select(F.lit("detail").alias("kind"), F.col("o_custkey").alias("work_key"), rank.alias("priority"), F.col("o_orderkey").alias("payload"), F.col("o_orderkey").alias("asked_at"))
    return W.merged(rows).drop("kind")


_STATE = "CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'P' THEN 'claimed' ELSE 'done' END"


def _queue(e: Evidence) -> DataFrame:
    k = F.col("o_orderkey")
    return e.table("orders").select(k.alias("work_id"), F.substring("o_orderpriority", 1, 1).cast("long").alias("priority"), F.expr(_STATE).alias("state"), (k % 3).alias("attempts"), F.lit(2).cast("long").alias("most_attempts"), (F.col("o_custkey") % 10).alias("claimed_by"))


@sql("next_work", "SELECT o_orderkey AS work_id, CAST(o_orderpriority[1] AS BIGINT) AS priority FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderpriority[1], o_orderkey LIMIT 50")
def next_work(e: Evidence) -> DataFrame:
    return W.claim(_queue(e), 50).select("work_id", "priority")


@sql("work_after_attempt", f"SELECT o_orderkey AS work_id, o_orderkey % 3 + 1 AS attempts, CASE WHEN o_orderkey % 5 < 2 THEN 'done' WHEN o_orderkey % 3 + 1 >= 2 THEN 'failed' ELSE 'pending' END AS state FROM orders WHERE {_STATE} = 'claimed' UNION ALL SELECT o_orderkey, o_orderkey % 3, {_STATE} FROM orders WHERE {_STATE} <> 'claimed'")
def work_after_attempt(e: Evidence) -> DataFrame:
    q = _queue(e)
    results = q.where("state = 'claimed'").select("work_id", (F.col("work_id") % 5 < 2).alias("ok"), F.lit("x").alias("error"))
    return W.after_attempt(q, results).select("work_id", "attempts", "state")


@sql("reclaimed_work", f"SELECT o_orderkey AS work_id, CASE WHEN {_STATE} = 'claimed' AND o_custkey % 10 >= 4 THEN 'pending' ELSE {_STATE} END AS state FROM orders")
def reclaimed_work(e: Evidence) -> DataFrame:
    return W.reclaimed(_queue(e), e.spark.range(4).select(F.col("id").alias("run_id"))).select("work_id", "state")


_USES = "uses AS (SELECT l_suppkey AS posting_id, 'https://jobs.example.com/' || l_partkey AS url, CASE l_returnflag WHEN 'R' THEN 'canonical-detail' WHEN 'A' THEN 'listing-link' ELSE 'other' END AS role, CAST(l_shipdate AS TIMESTAMP) AS seen_at FROM lineitem)"


def _uses(e: Evidence) -> DataFrame:
    flag = F.col("l_returnflag")
    role = F.when(flag == "R", "canonical-detail").when(flag == "A", "listing-link").otherwise("other")
    return e.table("lineitem").select(F.col("l_suppkey").alias("posting_id"), F.concat(F.lit("https://jobs.example.com/"), F.col("l_partkey").cast("string")).alias("url"), role.alias("role"), F.to_timestamp_ntz(F.col("l_shipdate").cast("string")).alias("seen_at"))


@sql("addresses", f"WITH {_USES} SELECT posting_id, url, role, CAST(min(seen_at) AS VARCHAR) AS first_seen, CAST(max(seen_at) AS VARCHAR) AS last_seen, count(*) AS seen_count FROM uses GROUP BY 1, 2, 3")
def addresses(e: Evidence) -> DataFrame:
    return W.addresses(_uses(e)).select("posting_id", "url", "role", *text("first_seen", "last_seen"), "seen_count")


@sql("best_address", f"WITH {_USES}, k AS (SELECT posting_id, url, role, max(seen_at) AS last_seen FROM uses GROUP BY 1, 2, 3) SELECT posting_id, url FROM k QUALIFY row_number() OVER (PARTITION BY posting_id ORDER BY CASE role WHEN 'canonical-detail' THEN 0 WHEN 'listing-link' THEN 1 ELSE 2 END, last_seen DESC, url) = 1")
def best_address(e: Evidence) -> DataFrame:
    return W.best_address(W.addresses(_uses(e)))


@sql("fetch_attempts", "SELECT l_orderkey AS fetch_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag) AS attempt_no, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag) < count(*) OVER (PARTITION BY l_orderkey) AS superseded, l_returnflag AS flag FROM lineitem")
def fetch_attempts(e: Evidence) -> DataFrame:
    f = e.table("lineitem").groupBy(F.col("l_orderkey").alias("fetch_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", F.col("l_returnflag").alias("flag")))).alias("attempts"))
    return W.attempts_of(f).select("fetch_id", F.col("attempt_no").cast("long").alias("attempt_no"), "superseded", "flag")


@sql("transport_failures", "SELECT kind, count(*) AS n FROM (SELECT CASE event_id % 6 WHEN 0 THEN 'timeout_connect' WHEN 1 THEN 'timeout_read' WHEN 2 THEN CASE WHEN event_id % 4 = 0 THEN 'dns' ELSE 'connect' END WHEN 3 THEN 'too_many_redirects' WHEN 4 THEN 'transport' END AS kind FROM events) GROUP BY 1")
def transport_failures(e: Evidence) -> DataFrame:
    name = F.get(F.array(*map(F.lit, ("ConnectTimeout", "ReadTimeout", "ConnectError", "TooManyRedirects", "ProtocolError"))), (F.col("event_id") % 6).cast("int"))
    message = F.when(F.col("event_id") % 4 == 0, "[Errno -2] Name or service not known").otherwise("refused")
    return e.table("events").select(W.transport_failure(name, message).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@sql("resource_captures", "SELECT l_suppkey % 7 AS run_id, l_partkey AS url, min(l_orderkey) AS observation_id, count(*) AS uses FROM lineitem GROUP BY 1, 2")
def resource_captures(e: Evidence) -> DataFrame:
    uses = e.table("lineitem").select((F.col("l_suppkey") % 7).alias("run_id"), F.col("l_partkey").alias("url"), F.col("l_orderkey").alias("observation_id"), F.col("l_linenumber").alias("position"))
    return W.first_captures(uses)[0]


@sql("reprocess_inputs", "SELECT o.o_orderkey AS observation_id, CASE WHEN o.o_custkey % 5 > 0 THEN o.o_custkey END AS posting_id, sha256(d.text) AS sha256, CAST(strlen(d.text) AS BIGINT) AS byte_length FROM orders o JOIN documents d ON d.doc_id = o.o_orderkey % (SELECT count(*) FROM documents)")
def reprocess_inputs(e: Evidence) -> DataFrame:
    docs = e.table("documents")
    obs = e.table("orders").select(F.col("o_orderkey").alias("observation_id"), F.col("o_custkey").alias("posting_id"), (F.col("o_orderkey") % docs.count()).alias("fetch_id"))
    fetches = docs.select(F.col("doc_id").alias("fetch_id"), F.sha2("text", 256).alias("sha256"))
    known = e.table("customer").where("c_custkey % 5 > 0").select(F.col("c_custkey").alias("posting_id"))
    return W.reprocess_inputs(obs, fetches, store.addressed(docs, "text"), known)


@query("run_log", "SELECT CAST(slot AS VARCHAR) AS run_id, CAST(min(observed_at) AS VARCHAR) AS started_at, CAST(max(observed_at) AS VARCHAR) AS alive_at, CASE WHEN day(slot) % 5 <> 0 THEN CAST(max(observed_at) AS VARCHAR) END AS ended_at FROM obs GROUP BY slot")
def run_log(e: Evidence) -> DataFrame:
    at = lambda event, when: F.struct(F.lit(event).alias("event"), when.alias("at"))
    records = e.runs.select(F.col("slot").alias("run_id"), "slot", "kind", "outcome", F.explode(F.array_compact(F.array(at("open", F.col("started_at")), at("heartbeat", F.col("ended_at")), F.when(F.day("slot") % 5 != 0, at("close", F.col("ended_at")))))).alias("r"))
    return W.runs_of(records.select("run_id", "slot", "kind", "outcome", "r.event", "r.at")).select(*text("run_id", "started_at", "alive_at", "ended_at"))


# -- passes, presence, scans ------------------------------------------------


def _passes(e: Evidence) -> list[DataFrame]:
    own = e.obs.where("availability = 'content_captured'").select("slot", (F.col("posting_id") % 4).alias("member"), (F.col("observation_id") % 3).alias("k"))
    return [own.where(F.col("k") == k) for k in range(3)]


_SETS = "SELECT slot, observation_id % 3 AS k, string_agg(DISTINCT posting_id % 4, ',' ORDER BY posting_id % 4) AS s FROM obs WHERE availability = 'content_captured' GROUP BY 1, 2"


@query("reconciliation", f"SELECT CAST(r.slot AS VARCHAR) AS slot, concat_ws(',', CASE WHEN a.s = c.s THEN 'discovery' END, CASE WHEN b.s = c.s THEN 'verification' END) AS agrees_with, r.qualified AND (coalesce(a.s = c.s, FALSE) OR coalesce(b.s = c.s, FALSE)) AS reconciled FROM runs r LEFT JOIN ({_SETS}) a ON a.slot = r.slot AND a.k = 0 LEFT JOIN ({_SETS}) b ON b.slot = r.slot AND b.k = 1 LEFT JOIN ({_SETS}) c ON c.slot = r.slot AND c.k = 2")
def reconciliation(e: Evidence) -> DataFrame:
    return Q.reconciled(*_passes(e), e.runs.select("slot", "qualified"), "slot", "member").select(*text("slot"), "agrees_with", "reconciled")


@query("pass_differences", "SELECT CAST(slot AS VARCHAR) AS slot, posting_id, CASE WHEN x = 2 THEN 'appeared' ELSE 'disappeared' END AS change FROM (SELECT slot, posting_id, sum(x) AS x FROM (SELECT DISTINCT slot, posting_id, CASE WHEN observation_id % 2 = 0 THEN 1 ELSE 2 END AS x FROM obs WHERE availability = 'content_captured') GROUP BY 1, 2) WHERE x < 3")
def pass_differences(e: Evidence) -> DataFrame:
    own = e.obs.where("availability = 'content_captured'")
    return Q.set_differences(own.where("observation_id % 2 = 0"), own.where("observation_id % 2 = 1"), "slot", "posting_id").select(*text("slot"), "posting_id", "change")


_DISPUTED = """own_grid AS (SELECT slot, posting_id, listed AND EXISTS (SELECT 1 FROM obs o WHERE o.slot = g.slot AND o.posting_id = g.posting_id AND availability = 'content_captured' AND observation_id % 2 = 0) AS listed, listed AS anywhere FROM grid g)"""


def _disputed(e: Evidence) -> tuple[DataFrame, DataFrame]:
    """The grid as the second of two passes sees it, and what any of them lists."""
    second = e.obs.where("availability = 'content_captured' AND observation_id % 2 = 0").select("slot", "posting_id").distinct()
    grid = V.listing_presence(e.runs, e.postings, second)
    return grid, e.entries.select("slot", "posting_id")


@query("listing_disagreements", f"SELECT CAST(slot AS VARCHAR) AS slot, posting_id, 'listing_disagreement_within_run' AS gap_kind FROM (WITH {_DISPUTED} SELECT * FROM own_grid) WHERE anywhere AND NOT listed")
def listing_disagreements(e: Evidence) -> DataFrame:
    return P.disagreement_gaps(*_disputed(e)).select(*text("slot"), "posting_id", "gap_kind")


@query("undisputed_presence", f"""SELECT CAST(slot AS VARCHAR) AS slot, posting_id, event_kind FROM (WITH {_DISPUTED}, g AS (SELECT g.slot, g.posting_id, g.listed, p.discovered_at BETWEEN r.started_at AND r.ended_at AS fresh, lag(g.listed) OVER (PARTITION BY g.posting_id ORDER BY g.slot) AS was FROM own_grid g JOIN runs r USING (slot) JOIN postings p USING (posting_id) WHERE g.listed OR NOT g.anywhere)
  SELECT slot, posting_id, unnest([CASE WHEN listed AND fresh THEN 'first_observed' END, CASE WHEN listed THEN 'listed' END, CASE WHEN listed AND NOT fresh AND was = FALSE THEN 'reappeared' END, CASE WHEN NOT listed THEN 'absent_qualified' END]) AS event_kind FROM g) WHERE event_kind IS NOT NULL""")
def undisputed_presence(e: Evidence) -> DataFrame:
    grid, seen = _disputed(e)
    return P.presence_events(grid, e.runs, e.postings, seen).select(*text("slot"), "posting_id", "event_kind")


_PAGES = """pages_of AS (SELECT o_custkey AS scan_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page_number, o_orderstatus <> 'P' AS ok, o_orderkey % 97 <> 0 AS recognized, CAST(o_orderkey % 53 = 0 AS BIGINT) AS unresolved, o_orderkey % 61 = 0 AS challenged,
  coalesce(n, 0) AS n_ids, o_orderkey % 40 AS signature, CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 60 END AS remaining, o_custkey % 29 = 0 AS filtered FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_partkey % 90) AS n FROM lineitem WHERE l_orderkey % 7 > 0 GROUP BY 1) ON l_orderkey = o_orderkey),
rows_of AS (SELECT o_custkey AS scan_id, l_partkey % 90 AS job_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey % 7 > 0)"""


@sql("scan_assessment", f"""WITH {_PAGES}, f AS (SELECT p.scan_id, count(*) AS pages, count(*) FILTER (NOT ok) AS failed, count(*) FILTER (NOT recognized) AS odd, CAST(sum(unresolved) AS BIGINT) AS unresolved, count(*) FILTER (challenged) AS challenged, count(*) - count(DISTINCT signature) AS repeats, any_value(filtered) AS filtered,
  arg_min(remaining + n_ids, page_number) FILTER (remaining IS NOT NULL) AS total, arg_max(ok, page_number) AS last_ok, arg_max(recognized, page_number) AS last_rec, arg_max(n_ids, page_number) AS last_ids, bool_or(n_ids = 0 AND recognized) AS empty_ok FROM pages_of p GROUP BY 1),
s AS (SELECT scan_id, count(*) AS occurrences, count(DISTINCT job_id) AS ids FROM rows_of GROUP BY 1),
t AS (SELECT f.*, coalesce(occurrences, 0) AS occurrences, coalesce(ids, 0) AS ids, CASE WHEN pages > 30 THEN 'max_pages' WHEN NOT last_ok THEN 'fetch_failure' WHEN NOT last_rec AND last_ids > 0 THEN 'structure_unrecognized' WHEN repeats > 0 THEN 'loop_detected' WHEN last_ids = 0 AND last_rec THEN 'empty_validated_page' WHEN last_ids = 0 THEN 'structure_unrecognized' ELSE 'no_more_link' END AS "end" FROM f LEFT JOIN s USING (scan_id)),
c AS (SELECT *, concat_ws('; ', CASE WHEN filtered THEN 'scope_unfiltered failed' END, CASE WHEN odd > 0 THEN 'structure_recognized failed' END, CASE WHEN failed > 0 THEN 'all_pages_retrieved failed' END, CASE WHEN "end" NOT IN ('no_more_link', 'empty_validated_page') THEN 'legitimate_termination failed' END, CASE WHEN unresolved > 0 THEN 'no_unresolved_identity failed' END,
  CASE WHEN challenged > 0 THEN 'no_access_control_response failed' END, CASE WHEN failed > 0 THEN 'all_pages_http_200 failed' END, CASE WHEN pages >= 30 THEN 'within_page_bound failed' END, CASE WHEN repeats > 0 THEN 'no_pagination_loop failed' END, CASE WHEN total <> ids THEN 'source_count_reconciles failed' END, CASE WHEN ids = 0 AND NOT empty_ok THEN 'empty_result_validated failed' END) AS reason FROM t)
SELECT scan_id, pages, occurrences, ids, occurrences - ids AS duplicates, total, "end", reason = '' AS qualified, reason FROM c""")
def scan_assessment(e: Evidence) -> DataFrame:
    k, scan = F.col("o_orderkey"), F.col("o_custkey").alias("scan_id")
    rows = e.table("lineitem").where("l_orderkey % 7 > 0").select("l_orderkey", (F.col("l_partkey") % 90).alias("job_id"))
    orders = e.table("orders").join(rows.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count_distinct("job_id").alias("n_ids")), "o_orderkey", "left").fillna(0, ["n_ids"])
    pages = orders.select(
        scan, "o_orderkey", (F.col("o_orderstatus") != "P").alias("ok"), (k % 97 != 0).alias("recognized"), ((F.col("n_ids") == 0) & (k % 97 != 0)).alias("empty_validated"), (k % 53 == 0).cast("long").alias("unresolved"), F.when(k % 61 == 0, "captcha").alias("signal"),
        F.lit(True).alias("to_listing"), F.when(F.col("o_orderstatus") == "P", 500).otherwise(200).alias("status"), (k % 40).alias("signature"), "n_ids", F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey") % 60).alias("remaining"),
        F.lit(None).cast("string").alias("next_url"), F.lit(30).alias("bound"), F.lit("https://jobs.example.com/").alias("expected_url"), F.concat(F.lit("https://jobs.example.com/"), F.when(F.col("o_custkey") % 29 == 0, "?x=1").otherwise("")).alias("requested_url"),
    )
    pages = W.ordinals(pages, ["scan_id"], ["o_orderkey"]).withColumn("page_number", F.col("ordinal") + 1)
    entries = rows.join(e.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), scan), "l_orderkey").select("scan_id", "job_id")
    return Q.assess(Q.scan_facts(pages, entries)).drop("checks")


# -- lookups ----------------------------------------------------------------


@sql("listing_inputs", "SELECT o.o_custkey AS scan_id, CAST(o.o_orderkey % 9 AS BIGINT) AS page_number, sha256(d.text) AS sha256, CAST(strlen(d.text) AS BIGINT) AS byte_length FROM orders o JOIN documents d ON d.doc_id = o.o_orderkey % (SELECT count(*) FROM documents)")
def listing_inputs(e: Evidence) -> DataFrame:
    docs = e.table("documents")
    pages = e.table("orders").select(F.col("o_custkey").alias("scan_id"), (F.col("o_orderkey") % 9).alias("page_number"), (F.col("o_orderkey") % docs.count()).alias("fetch_id"))
    return K.listing_inputs(pages, docs.select(F.col("doc_id").alias("fetch_id"), F.sha2("text", 256).alias("sha256")), store.addressed(docs, "text"))


@sql("known_entries", "SELECT o_orderkey AS entry, o_custkey AS job_id, CASE WHEN o_custkey % 3 > 0 THEN o_custkey + 1000 END AS posting_id FROM orders")
def known_entries(e: Evidence) -> DataFrame:
    entries = e.table("orders").select(F.col("o_orderkey").alias("entry"), F.col("o_custkey").alias("job_id"))
    known = e.table("customer").where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("job_id"), (F.col("c_custkey") + 1000).alias("posting_id"))
    return K.known_entries(entries, known)


@query("run_observations", "SELECT observation_id, posting_id, 'job ' || posting_id AS job_id, availability FROM obs WHERE slot = (SELECT max(slot) FROM runs)")
def run_observations(e: Evidence) -> DataFrame:
    last = e.runs.agg(F.max("slot").alias("last"))
    obs = e.obs.join(F.broadcast(last)).withColumn("run_id", F.col("slot"))
    postings = e.postings.select("posting_id", F.concat(F.lit("job "), F.col("posting_id").cast("string")).alias("job_id"))
    return K.run_observations(obs, postings, F.col("last")).select("observation_id", "posting_id", "job_id", "availability")


@sql("observation_rows", "SELECT availability, identity, count(*) AS n FROM (SELECT CASE WHEN event_id % 11 = 0 THEN 'access_control_challenge' WHEN event_type = 'signup' THEN 'not_found' WHEN event_type = 'error' THEN 'retrieval_failed' WHEN event_type = 'click' THEN 'redirected_to_listing' WHEN event_id % 7 = 0 THEN 'identity_mismatch' WHEN event_id % 5 = 0 THEN 'explicit_closure' ELSE 'content_captured' END AS availability, CASE WHEN event_id % 11 = 0 OR event_type IN ('signup', 'error') THEN 'not_observed' WHEN event_type = 'click' THEN 'absent_on_page' WHEN event_id % 7 = 0 THEN 'mismatch' ELSE 'match' END AS identity FROM events) GROUP BY 1, 2")
def observation_rows(e: Evidence) -> DataFrame:
    k, kind, own = F.col("event_id"), F.col("event_type"), F.col("user_id").cast("string")
    checks = e.table("events").select(
        F.when(k % 11 == 0, "captcha").alias("signal"), (~kind.isin("signup", "error")).alias("ok"), F.when(kind == "signup", 404).when(kind == "error", 500).otherwise(200).alias("status"), F.when(kind == "click", "to_listing").otherwise("none").alias("redirect"),
        own.alias("expected_id"), F.when(k % 7 == 0, F.concat(own, F.lit("x"))).otherwise(own).alias("shown_id"), F.when(k % 5 == 0, "").otherwise("text").alias("body"), F.lit("closed").alias("closure"),
    )
    return K.observation_rows(checks).groupBy("availability", "identity").agg(F.count("*").alias("n"))


@query("rows_of_lineage", "SELECT observation_id FROM obs WHERE observation_id % 5 = 0 OR lineage = '1.1.0'")
def rows_of_lineage(e: Evidence) -> DataFrame:
    return K.of_lineage(e.obs.withColumn("lineage", F.when(F.col("observation_id") % 5 != 0, F.col("lineage"))), "1.1.0").select("observation_id")


@sql("extraction_statistics", "SELECT o_orderstatus AS kind, o_orderpriority AS parser, CASE WHEN o_orderkey % 4 = 0 THEN 'failed' ELSE 'ok' END AS status, count(*) AS n, CAST(sum(o_orderkey % 3) AS BIGINT) AS errors FROM orders GROUP BY 1, 2, 3")
def extraction_statistics(e: Evidence) -> DataFrame:
    k = F.col("o_orderkey")
    return K.extraction_statistics(e.table("orders").select(F.col("o_orderstatus").alias("kind"), F.col("o_orderpriority").alias("parser"), F.when(k % 4 == 0, "failed").otherwise("ok").alias("status"), (k % 3).alias("errors")))


@sql("extraction_links", "SELECT l_orderkey AS extraction_id, l_returnflag AS parent_kind, CAST(l_partkey % 3 AS VARCHAR) AS url_raw, CAST(min(l_linenumber) AS BIGINT) AS position FROM lineitem GROUP BY 1, 2, 3")
def extraction_links(e: Evidence) -> DataFrame:
    link = F.struct(F.col("l_returnflag").alias("parent_kind"), (F.col("l_partkey") % 3).cast("string").alias("url_raw"), F.col("l_linenumber").cast("long").alias("position"))
    return K.extraction_links(e.table("lineitem").groupBy(F.col("l_orderkey").alias("extraction_id")).agg(F.collect_list(link).alias("links")))


@sql("broken_rules", "SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'F' AND o_totalprice < 50000 THEN 'final_is_dear' END, CASE WHEN o_orderpriority[1] = '1' AND o_custkey % 2 = 1 THEN 'urgent_is_even' END) AS broken FROM orders WHERE (o_orderstatus = 'F' AND o_totalprice < 50000) OR (o_orderpriority[1] = '1' AND o_custkey % 2 = 1)")
def broken_rules(e: Evidence) -> DataFrame:
    rules = {"final_is_dear": (F.col("o_orderstatus") == "F", F.col("o_totalprice") >= 50000), "urgent_is_even": (F.substring("o_orderpriority", 1, 1) == "1", F.col("o_custkey") % 2 == 0)}
    return K.broken_rules(e.table("orders"), rules).select("o_orderkey", F.array_join("broken", ",").alias("broken"))


@query("status_components", """SELECT 'collection' AS component, CASE s WHEN 'HEALTHY' THEN 'healthy' WHEN 'DEGRADED' THEN 'degraded' ELSE 'unhealthy' END AS health FROM (SELECT CASE WHEN max(slot) - max(slot) FILTER (qualified) >= 2 THEN 'STALE' WHEN arg_max(outcome, started_at) = 'success' THEN 'HEALTHY' WHEN arg_max(outcome, started_at) = 'partial' THEN 'DEGRADED' ELSE 'FAILED' END AS s FROM runs)
  UNION ALL SELECT 'notifications', 'unhealthy' UNION ALL SELECT 'backup', 'healthy' UNION ALL SELECT 'overall', 'unhealthy'""")
def status_components(e: Evidence) -> DataFrame:
    runs, notices = _told(e)
    parts = {
        "collection": T.collection_state(e.runs, e.runs.agg(F.max("slot").alias("as_of"))), "notifications": T.notice_status(notices, T.unreported(runs, notices)),
        "backup": e.spark.range(1).select(F.lit("VERIFIED").alias("state")),
    }
    return T.status_components(parts).select("component", "health")


@query("scan_results", "SELECT CAST(slot AS VARCHAR) AS slot, role, CASE WHEN role = 'verification' AND day(slot) % 4 = 0 THEN NULL ELSE pages END AS pages, CASE WHEN role = 'verification' AND day(slot) % 4 = 0 THEN 'challenge_wall' END AS error FROM runs, (VALUES ('discovery'), ('verification')) t(role)")
def scan_results(e: Evidence) -> DataFrame:
    roles = e.runs.select("slot", F.explode(F.array(F.lit("discovery"), F.lit("verification"))).alias("role"))
    walled = (F.col("role") == "verification") & (F.day("slot") % 4 == 0)
    scans = roles.join(e.runs.select("slot", "pages"), "slot").where(~walled)
    walls = roles.where(walled).select("slot", "role")
    return K.scan_results(roles, scans, walls, ["slot", "role"]).select(*text("slot"), "role", "pages", "error")


# -- pages ------------------------------------------------------------------


def _cell(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


@sql("listing_rows", "SELECT c_nationkey AS page, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS position, CASE WHEN c_custkey % 10 > 0 THEN CAST(c_custkey AS VARCHAR) END AS job_id, CASE WHEN c_custkey % 10 > 0 THEN 'resolved' ELSE 'unresolved_id' END AS state, c_name AS title, c_mktsegment AS location, CASE WHEN c_custkey % 2 = 0 THEN 'A & B ' || c_custkey END AS summary, 'https://jobs.example.com/en-us/listing/?page=' || (c_nationkey + 2) AS more_url, CAST(c_nationkey * 3 AS INTEGER) AS more_remaining FROM customer")
def listing_rows(e: Evidence) -> DataFrame:
    """Rows of listing pages, one page a nation, written from the customers and read back by the parser."""
    key = F.col("c_custkey").cast("string")
    href = F.when(F.col("c_custkey") % 10 > 0, _cell("/en-us/job/", key, "/slug")).otherwise("/en-us/other")
    row = _cell("<tr><td><a class='job-link' href='", href, "'>", F.col("c_name"), "</a></td><td><span class=location>", F.col("c_mktsegment"), "</span></td></tr>", F.when(F.col("c_custkey") % 2 == 0, _cell("<tr class=summary><td>A &amp; B ", key, "</td></tr>")).otherwise(""))
    pages = e.table("customer").groupBy("c_nationkey").agg(F.sort_array(F.collect_list(F.struct("c_custkey", row.alias("row")))).alias("rows"))
    n = F.col("c_nationkey")
    html = _cell("<h2>Search results</h2><table><tr><th>Position<th>Location<th>Closes</tr><tbody id='search-results-content'>", F.array_join(F.transform("rows", lambda r: r["row"]), "\n"), "</tbody></table><a class='more-link' href='?page=", (n + 2).cast("string"), "'>More <span class=count>", (n * 3).cast("string"), "</span></a>")
    parsed = pages.select(n.alias("page"), B.listing(html, F.lit("https://jobs.example.com/en-us/listing/"), "jobs.example.com").alias("p"))
    return parsed.select("page", "p.more_url", "p.more_remaining", F.explode("p.entries").alias("r")).select("page", "r.position", "r.job_id", "r.state", "r.title", "r.location", "r.summary", "more_url", "more_remaining")


@sql("detail_fields", "SELECT p_partkey AS page, field_key, CAST(0 AS INTEGER) AS ordinal, value_text, known_label, p_name AS title, CAST(p_partkey AS VARCHAR) AS job_id, 'source-substring' AS html_kind, 'About ' || p_type || '.' AS description FROM part, LATERAL (VALUES ('job_no', CAST(p_partkey AS VARCHAR), TRUE), ('location', p_brand, TRUE), ('shelf', CAST(p_size AS VARCHAR), FALSE), ('advertised', 'Sep 15 2026 Eastern', TRUE)) t(field_key, value_text, known_label)")
def detail_fields(e: Evidence) -> DataFrame:
    """Fields of detail pages that are written from the parts."""
    key = F.col("p_partkey").cast("string")
    html = _cell(
        "<div id=job><div id='job-content'><h2>", F.col("p_name"), "</h2><p><b>Job no:</b> <span class='job-externalJobNo'>", key, "</span><br><b>Location:</b> <span>", F.col("p_brand"), "</span><br><strong>Shelf:</strong> ", F.col("p_size").cast("string"),
        "<br></p><div id='job-details'><b>Summary:</b><p>About ", F.col("p_type"), ".</p></div><p><b>Advertised:</b> <time datetime='2026-09-15T04:00:00Z'>Sep 15 2026</time> Eastern</p></div></div>",
    )
    parsed = spread(e.table("part")).select(F.col("p_partkey").alias("page"), B.detail(html, F.lit("https://jobs.example.com/"), "example.com", "jobs.example.com").alias("p"))
    rows = parsed.select("page", "p.title", "p.job_id", "p.html_kind", F.regexp_replace(F.regexp_replace("p.description_text", r"^Summary:\s*", ""), r"\s+", " ").alias("description"), F.explode("p.fields").alias("f"))
    return rows.select("page", "f.field_key", "f.ordinal", "f.value_text", "f.known_label", "title", "job_id", "html_kind", "description")


@sql("detail_dates", "SELECT o_orderkey AS page, 'parsed' AS state, 'date' AS precision, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS local_date FROM orders")
def detail_dates(e: Evidence) -> DataFrame:
    """Dates of detail pages, read by the parser and interpreted by the rules of dates."""
    shown = F.date_format(F.to_date("o_orderdate"), "MMM d yyyy")
    html = _cell("<div id=job-content><h1>x</h1><p><b>Applications close:</b> <span><time>", shown, " </time></span> Eastern</p><div id=job-details>y</div></div>")
    rows = spread(e.table("orders")).select(F.col("o_orderkey").alias("page"), F.explode(B.detail_fields(html)).alias("f"))
    return rows.select("page", S.source_date("f.date_display", "f.date_machine").alias("d")).select("page", "d.state", "d.precision", F.col("d.local_date").cast("string").alias("local_date"))


# -- datasets ---------------------------------------------------------------


@query("export_current", """SELECT posting_id, CAST(discovered_at AS VARCHAR) AS discovered_at, CAST(last_listed AS VARCHAR) AS last_listed, CAST(content_at AS VARCHAR) AS last_captured, CAST(checked_at AS VARCHAR) AS last_check, last_availability, freshness, version_count, observations,
  CASE WHEN content_version IS NOT NULL THEN 'place ' || content_version END AS location, CASE WHEN content_version IS NOT NULL THEN 'kind ' || posting_id % 3 END AS categories, CASE WHEN content_version > 0 THEN 'full time' END AS work_type, CASE WHEN content_version IS NOT NULL THEN 'Sep ' || (content_version + 1) || ' 2026' END AS advertised,
  CASE WHEN content_version IS NOT NULL THEN 'date' END AS advertised_precision, CASE WHEN content_version IS NOT NULL THEN 'Oct ' || (content_version + 1) || ' 2026 11:50 PM' END AS applications_close, CASE WHEN content_version IS NOT NULL THEN '2026-10-0' || (content_version + 2) || ' 03:50:00' END AS applications_close_parsed_utc FROM cur""")
def export_current(e: Evidence) -> DataFrame:
    v = F.col("version").cast("string")
    fields = (("location", F.concat(F.lit("place "), v)), ("categories", F.concat(F.lit("kind "), (F.col("posting_id") % 3).cast("string"))), ("work_type", F.when(F.col("version") > 0, "full time")), ("advertised", F.concat(F.lit("Sep "), (F.col("version") + 1).cast("string"), F.lit(" 2026"))), ("applications_close", F.concat(F.lit("Oct "), (F.col("version") + 1).cast("string"), F.lit(" 2026 11:50 PM"))))
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("field_key"), x.alias("value_text")) for k, x in fields)))
    version = F.struct("posting_id", "lineage", "version")
    values = e.versions.select(version.alias("entity_id"), F.lit(0).alias("ordinal"), rows.alias("f")).select("entity_id", "ordinal", "f.*")
    frames = {"current": lambda: X.current(e.current, values, [k for k, _ in fields], ("advertised", "applications_close"))}
    names = {"content_at": "last_captured", "checked_at": "last_check"}
    out = X.dataset(frames, "current", ["posting_id"])
    return out.select("posting_id", *(F.col(c).cast("string").alias(names.get(c, c)) for c in ("discovered_at", "last_listed", "content_at", "checked_at")), "last_availability", "freshness", "version_count", "observations", *(k for k, _ in fields), "advertised_precision", *text("applications_close_parsed_utc"))


@sql("export_links", "SELECT o_custkey AS posting_id, l_partkey AS resource, l_linenumber AS position, l_returnflag AS classification, CASE WHEN l_returnflag = 'R' THEN 'fetch' ELSE 'exclude' END AS decision FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey")
def export_links(e: Evidence) -> DataFrame:
    links = e.table("lineitem").select(F.col("l_orderkey").alias("version_id"), F.col("l_partkey").alias("resource"), F.col("l_linenumber").alias("position"), F.col("l_returnflag").alias("classification"), F.when(F.col("l_returnflag") == "R", "fetch").otherwise("exclude").alias("decision"))
    versions = e.table("orders").select(F.col("o_orderkey").alias("version_id"), F.col("o_custkey").alias("posting_id"))
    postings = e.table("customer").select(F.col("c_custkey").alias("posting_id"))
    return X.dataset({"links": lambda: X.links(links, versions, postings)}, "links", ["posting_id", "version_id", "position"]).drop("version_id")
