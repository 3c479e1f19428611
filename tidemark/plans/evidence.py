"""Queries over the evidence frames, with their SQL. Each takes (spark, sf_dir)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import counters as C
from tidemark.operators import presence as P
from tidemark.operators import qualify as Q
from tidemark.operators import views as V
from tidemark.plans import adapters as A


class Evidence:
    """The frames of one input, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return A.read(self.spark, self.sf_dir, name)

    @cached_property
    def obs(self) -> DataFrame:
        return A.observations(self.spark, self.sf_dir)

    @cached_property
    def runs(self) -> DataFrame:
        return A.runs(self.obs)

    @cached_property
    def entries(self) -> DataFrame:
        return A.entries(self.obs)

    @cached_property
    def postings(self) -> DataFrame:
        return A.postings(self.obs)

    @cached_property
    def versions(self) -> DataFrame:
        return A.versions(self.obs)

    @cached_property
    def current(self) -> DataFrame:
        return V.posting_current(self.obs, self.postings, self.versions, self.entries, self.runs)

    @cached_property
    def grid(self) -> DataFrame:
        return V.listing_presence(self.runs, self.postings, self.entries)

    @cached_property
    def changes(self) -> DataFrame:
        return V.content_changes(self.obs)

    @cached_property
    def events(self) -> DataFrame:
        return P.presence_events(self.grid, self.runs, self.postings)

    @cached_property
    def policy(self) -> DataFrame:
        return P.recheck_policy(self.obs, V.qualified_scans(self.runs).select("slot").join(self.entries, "slot"))


QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: bool = True):
    """Register a function of Evidence as a query, with the SELECT that gives the same rows."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Evidence(spark, sf_dir))
        if sql:
            ORACLE[name] = (f"{A.ALL}{MORE if 'cur' in sql or 'grid' in sql or 'chg' in sql or 'pev' in sql or 'pol' in sql else ''} " if ctes else "") + sql
        return f

    return add


#: Derived relations of the SQL side: cur (current), grid, chg (changes), pev (presence events), pol (recheck policy).
MORE = """, own AS (SELECT * FROM obs WHERE availability = 'content_captured' AND identity = 'match'),
listed_at AS (SELECT posting_id, max(seen_at) AS last_listed, count(*) AS times_listed FROM entries JOIN runs USING (slot) WHERE qualified GROUP BY 1),
cur AS (SELECT p.*, c.content_version, c.content_lineage, c.content_at, k.last_availability, k.checked_at, coalesce(v.n, 0) AS version_count, l.last_listed, coalesce(l.times_listed, 0) AS times_listed,
  CASE WHEN content_at IS NULL THEN 'never-captured' WHEN last_availability IN ('access_control_challenge', 'retrieval_failed') THEN 'carried-forward-uncertain'
    WHEN content_at = checked_at THEN 'checked' ELSE 'carried-forward' END AS freshness
  FROM postings p
  LEFT JOIN (SELECT posting_id, version AS content_version, lineage AS content_lineage, observed_at AS content_at FROM own QUALIFY row_number() OVER (PARTITION BY posting_id ORDER BY observed_at DESC, observation_id DESC) = 1) c USING (posting_id)
  LEFT JOIN (SELECT posting_id, availability AS last_availability, observed_at AS checked_at FROM obs QUALIFY row_number() OVER (PARTITION BY posting_id ORDER BY observed_at DESC, observation_id DESC) = 1) k USING (posting_id)
  LEFT JOIN (SELECT posting_id, count(*) AS n FROM versions GROUP BY 1) v USING (posting_id) LEFT JOIN listed_at l USING (posting_id)),
grid AS (SELECT r.slot, p.posting_id, e.posting_id IS NOT NULL AS listed FROM runs r JOIN postings p ON r.qualified AND p.discovered_at <= r.ended_at LEFT JOIN entries e ON e.slot = r.slot AND e.posting_id = p.posting_id),
chg AS (SELECT observation_id, posting_id, lineage, from_version, version AS to_version, interval_start, observed_at AS interval_end, slot FROM (
  SELECT *, lag(version) OVER w AS from_version, lag(observed_at) OVER w AS interval_start FROM own WINDOW w AS (PARTITION BY posting_id, lineage ORDER BY observed_at, observation_id)) WHERE from_version <> version),
gx AS (SELECT g.*, r.started_at, r.ended_at, p.discovered_at, lag(listed) OVER w AS was,
  max(CASE WHEN listed THEN r.ended_at END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_listed, max(CASE WHEN NOT listed THEN r.ended_at END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_absent
  FROM grid g JOIN runs r USING (slot) JOIN postings p USING (posting_id) WINDOW w AS (PARTITION BY g.posting_id ORDER BY g.slot)),
pev AS (SELECT slot, posting_id, 'first_observed' AS event_kind, CAST(NULL AS TIMESTAMP) AS interval_start, ended_at AS interval_end FROM gx WHERE listed AND discovered_at BETWEEN started_at AND ended_at
  UNION ALL SELECT slot, posting_id, 'listed', last_listed, ended_at FROM gx WHERE listed
  UNION ALL SELECT slot, posting_id, 'reappeared', last_absent, ended_at FROM gx WHERE listed AND NOT (discovered_at BETWEEN started_at AND ended_at) AND was = FALSE
  UNION ALL SELECT slot, posting_id, 'absent_qualified', last_listed, ended_at FROM gx WHERE NOT listed),
pol0 AS (SELECT o.*, (q.slot IS NOT NULL OR availability = 'content_captured') AS reset FROM obs o LEFT JOIN (SELECT DISTINCT slot, posting_id FROM entries JOIN runs USING (slot) WHERE qualified) q USING (slot, posting_id)),
pol1 AS (SELECT *, count(*) FILTER (reset) OVER (PARTITION BY posting_id ORDER BY observed_at, observation_id) AS island FROM pol0),
pol AS (SELECT posting_id, streak, CASE WHEN streak >= 3 THEN 'weekly' ELSE 'daily' END AS tier, CASE WHEN streak >= 3 THEN latest + INTERVAL 7 DAY END AS next_due FROM (
  SELECT posting_id, count(*) FILTER (NOT reset AND availability IN ('explicit_closure', 'redirected_to_listing', 'not_found')) AS streak, max(observed_at) FILTER (NOT reset AND availability IN ('explicit_closure', 'redirected_to_listing', 'not_found')) AS latest FROM (
    SELECT *, max(island) OVER (PARTITION BY posting_id) AS top FROM pol1) WHERE island = top GROUP BY posting_id))"""


def text(*columns: str):
    return [F.col(c).cast("string").alias(c) for c in columns]


@query("qualified_scans", "SELECT CAST(slot AS VARCHAR) AS slot, kind, outcome, pages, failed FROM runs WHERE qualified")
def qualified_scans(e: Evidence) -> DataFrame:
    return V.qualified_scans(e.runs).select(*text("slot"), "kind", "outcome", "pages", "failed")


@query("last_listed", "SELECT posting_id, CAST(max(seen_at) AS VARCHAR) AS last_listed, count(*) AS times_listed FROM entries JOIN runs USING (slot) WHERE qualified GROUP BY 1")
def last_listed(e: Evidence) -> DataFrame:
    return V.last_listed(e.entries, e.runs).select("posting_id", *text("last_listed"), "times_listed")


@query("posting_current", "SELECT posting_id, CAST(discovered_at AS VARCHAR) AS discovered_at, discovered_by, observations, content_version, content_lineage, CAST(content_at AS VARCHAR) AS content_at, last_availability, CAST(checked_at AS VARCHAR) AS checked_at, version_count, CAST(last_listed AS VARCHAR) AS last_listed, times_listed, freshness FROM cur")
def posting_current(e: Evidence) -> DataFrame:
    return e.current.select("posting_id", *text("discovered_at"), "discovered_by", "observations", "content_version", "content_lineage", *text("content_at"), "last_availability", *text("checked_at"), "version_count", *text("last_listed"), "times_listed", "freshness")


@query("posting_history", "SELECT o.observation_id, o.posting_id, CAST(o.observed_at AS VARCHAR) AS observed_at, o.availability, o.identity, CAST(o.slot AS VARCHAR) AS slot, r.kind, r.outcome, o.version, CAST(v.first_seen AS VARCHAR) AS first_seen FROM obs o JOIN postings USING (posting_id) JOIN runs r USING (slot) LEFT JOIN versions v ON v.posting_id = o.posting_id AND v.lineage = o.lineage AND v.version = o.version")
def posting_history(e: Evidence) -> DataFrame:
    return V.posting_history(e.obs, e.postings, e.runs, e.versions).select("observation_id", "posting_id", *text("observed_at"), "availability", "identity", *text("slot"), "kind", "outcome", "version", *text("first_seen"))


@query("listing_presence", "SELECT CAST(slot AS VARCHAR) AS slot, posting_id, listed FROM grid")
def listing_presence(e: Evidence) -> DataFrame:
    return e.grid.select(*text("slot"), "posting_id", "listed")


@query("run_health", "SELECT CAST(slot AS VARCHAR) AS slot, kind, outcome, qualified, captured AS n_captured, failed AS n_failed, n_closed, n_redirected, n_postings, coalesce(n_listed, 0) AS n_listed, coalesce(n_changed, 0) AS n_changed FROM runs JOIN (SELECT slot, count(*) FILTER (availability = 'explicit_closure') AS n_closed, count(*) FILTER (availability = 'redirected_to_listing') AS n_redirected, count(DISTINCT posting_id) AS n_postings FROM obs GROUP BY 1) USING (slot) LEFT JOIN (SELECT slot, count(*) AS n_listed FROM entries GROUP BY 1) USING (slot) LEFT JOIN (SELECT slot, count(*) AS n_changed FROM chg GROUP BY 1) USING (slot)")
def run_health(e: Evidence) -> DataFrame:
    return V.run_health(e.runs, e.obs, e.entries, e.changes).select(*text("slot"), "kind", "outcome", "qualified", "n_captured", "n_failed", "n_closed", "n_redirected", "n_postings", "n_listed", "n_changed")


@query("content_changes", "SELECT observation_id, posting_id, lineage, from_version, to_version, CAST(interval_start AS VARCHAR) AS interval_start, CAST(interval_end AS VARCHAR) AS interval_end, CAST(slot AS VARCHAR) AS slot FROM chg")
def content_changes(e: Evidence) -> DataFrame:
    return e.changes.select("observation_id", "posting_id", "lineage", "from_version", "to_version", *text("interval_start", "interval_end", "slot"))


@query("change_view", "SELECT c.observation_id, c.posting_id, c.from_version, c.to_version, CAST(p.discovered_at AS VARCHAR) AS discovered_at, CAST(a.first_seen AS VARCHAR) AS from_first_seen, CAST(b.first_seen AS VARCHAR) AS to_first_seen FROM chg c JOIN postings p USING (posting_id) LEFT JOIN versions a ON a.posting_id = c.posting_id AND a.lineage = c.lineage AND a.version = c.from_version LEFT JOIN versions b ON b.posting_id = c.posting_id AND b.lineage = c.lineage AND b.version = c.to_version")
def change_view(e: Evidence) -> DataFrame:
    return V.change_view(e.changes, e.versions, e.postings).select("observation_id", "posting_id", "from_version", "to_version", *text("discovered_at", "from_first_seen", "to_first_seen"))


@query("presence_events", "SELECT CAST(slot AS VARCHAR) AS slot, posting_id, event_kind, CAST(interval_start AS VARCHAR) AS interval_start, CAST(interval_end AS VARCHAR) AS interval_end FROM pev")
def presence_events(e: Evidence) -> DataFrame:
    return e.events.select(*text("slot"), "posting_id", "event_kind", *text("interval_start", "interval_end"))


@query("event_summary", "SELECT CAST(slot AS VARCHAR) AS slot, count(*) FILTER (event_kind = 'absent_qualified') AS absent_qualified, count(*) FILTER (event_kind = 'first_observed') AS first_observed, count(*) FILTER (event_kind = 'listed') AS listed, count(*) FILTER (event_kind = 'reappeared') AS reappeared FROM pev GROUP BY 1")
def event_summary(e: Evidence) -> DataFrame:
    kinds = ["absent_qualified", "first_observed", "listed", "reappeared"]
    return e.events.groupBy(F.col("slot").cast("string").alias("slot")).agg(*(F.count_if(F.col("event_kind") == k).alias(k) for k in kinds))


@query("two_day_absence", "SELECT posting_id, count(DISTINCT slot) AS absent_days, CAST(min(slot) AS VARCHAR) AS first_absent, CAST(max(slot) AS VARCHAR) AS last_absent, count(DISTINCT slot) >= 2 AS rule_met, date_diff('day', min(slot), max(slot)) + 1 - count(DISTINCT slot) AS uncovered_days FROM (SELECT *, max(CASE WHEN listed THEN slot END) OVER (PARTITION BY posting_id) AS last FROM grid) WHERE NOT listed AND (last IS NULL OR slot > last) GROUP BY 1")
def two_day_absence(e: Evidence) -> DataFrame:
    return P.repeatedly_unlisted(e.grid).select("posting_id", "absent_days", *text("first_absent", "last_absent"), "rule_met", "uncovered_days")


@query("coverage_gaps", "SELECT CAST(slot AS VARCHAR) AS slot, 'no_qualified_scan' AS gap_kind, format('{} of {} pages failed', failed, pages) AS detail FROM runs WHERE NOT qualified")
def coverage_gaps(e: Evidence) -> DataFrame:
    return P.coverage_gaps(e.runs).select(*text("slot"), "gap_kind", "detail")


@query("coverage_window", "SELECT CAST(first_day AS VARCHAR) AS first_day, CAST(last_day AS VARCHAR) AS last_day, covered, coalesce(len(m), 0) AS missed, array_to_string(m[-30:], ',') AS missed_days FROM (SELECT min(slot) AS first_day, max(slot) AS last_day, count(*) AS covered FROM runs WHERE qualified), (SELECT list(CAST(d AS VARCHAR) ORDER BY d) AS m FROM (SELECT CAST(unnest(generate_series((SELECT min(slot) FROM runs WHERE qualified), (SELECT max(slot) FROM runs WHERE qualified), INTERVAL 1 DAY)) AS DATE) AS d) WHERE d NOT IN (SELECT slot FROM runs WHERE qualified))")
def coverage_window(e: Evidence) -> DataFrame:
    return P.coverage_window(e.runs).select(*text("first_day", "last_day"), "covered", "missed", "missed_days")


@query("recheck_policy", "SELECT posting_id, streak, tier, CAST(next_due AS VARCHAR) AS next_due FROM pol")
def recheck_policy(e: Evidence) -> DataFrame:
    return e.policy.select("posting_id", "streak", "tier", *text("next_due"))


@query("versions_first_seen", "SELECT posting_id, lineage, version, CAST(first_seen AS VARCHAR) AS first_seen, CAST(last_seen AS VARCHAR) AS last_seen, observed FROM versions")
def versions_first_seen(e: Evidence) -> DataFrame:
    return e.versions.select("posting_id", "lineage", "version", *text("first_seen", "last_seen"), "observed")


@query("newest_lineage", "SELECT posting_id, lineage, version FROM (SELECT *, first_value(lineage) OVER (PARTITION BY posting_id ORDER BY last_seen DESC, lineage DESC, version DESC) AS newest FROM versions) WHERE lineage = newest")
def newest_lineage(e: Evidence) -> DataFrame:
    top = e.versions.groupBy("posting_id").agg(F.max_by("lineage", F.struct("last_seen", "lineage", "version")).alias("lineage"))
    return e.versions.join(top, ["posting_id", "lineage"]).select("posting_id", "lineage", "version")


@query("two_newest_versions", "SELECT posting_id, version, lineage, rank FROM (SELECT *, row_number() OVER (PARTITION BY posting_id ORDER BY first_seen DESC, lineage DESC, version DESC) AS rank FROM versions) WHERE rank <= 2")
def two_newest_versions(e: Evidence) -> DataFrame:
    w = Window.partitionBy("posting_id").orderBy(F.desc("first_seen"), F.desc("lineage"), F.desc("version"))
    return e.versions.withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 2").select("posting_id", "version", "lineage", "rank")


@query("freshness_histogram", "SELECT freshness, count(*) AS n FROM cur GROUP BY 1")
def freshness_histogram(e: Evidence) -> DataFrame:
    return e.current.groupBy("freshness").agg(F.count("*").alias("n"))


@query("freshness_by_availability", "SELECT freshness, last_availability, count(*) AS n FROM cur GROUP BY 1, 2")
def freshness_by_availability(e: Evidence) -> DataFrame:
    return e.current.groupBy("freshness", "last_availability").agg(F.count("*").alias("n"))


@query("availability_split", "SELECT CAST(slot AS VARCHAR) AS slot, count(*) FILTER (availability IN ('explicit_closure', 'redirected_to_listing', 'not_found')) AS terminal, count(*) FILTER (availability IN ('access_control_challenge', 'retrieval_failed')) AS uncertain, count(DISTINCT posting_id) FILTER (availability = 'content_captured') AS ever_captured FROM obs GROUP BY 1")
def availability_split(e: Evidence) -> DataFrame:
    return C.availability_split(e.obs).withColumn("slot", F.col("slot").cast("string"))


@query("lifetime_counters", "SELECT (SELECT count(*) FROM runs) AS runs, (SELECT count(*) FROM runs WHERE qualified) AS qualified_runs, (SELECT count(*) FROM postings) AS postings, (SELECT count(*) FROM versions) AS versions, (SELECT count(*) FROM obs) AS observations, (SELECT count(*) FROM chg) AS changes, (SELECT count(*) FROM runs WHERE outcome = 'failed') AS failed_runs")
def lifetime_counters(e: Evidence) -> DataFrame:
    out = C.lifetime(C.cube(e.obs), e.runs, e.postings, e.versions, e.changes)
    return out.select("runs", "qualified_runs", "postings", "versions", "observations", "changes", "failed_runs")


@query("histories_top", "SELECT posting_id, count(*) AS observations, count(DISTINCT version) AS versions FROM obs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def histories_top(e: Evidence) -> DataFrame:
    return C.histories(e.obs, 20)


@query("newest_runs", "SELECT CAST(slot AS VARCHAR) AS slot, kind, outcome, CASE WHEN s >= 3600 THEN format('{}h {}m {}s', s // 3600, s % 3600 // 60, s % 60) WHEN s >= 60 THEN format('{}m {}s', s // 60, s % 60) ELSE format('{}s', s) END AS duration FROM (SELECT *, date_diff('second', started_at, ended_at) AS s FROM runs) ORDER BY slot DESC LIMIT 10")
def newest_runs(e: Evidence) -> DataFrame:
    return e.runs.select(*text("slot"), "kind", "outcome", S.duration_text("started_at", "ended_at").alias("duration")).orderBy(F.desc("slot")).limit(10)


@query("history_newest_first", "SELECT posting_id, observation_id, CAST(observed_at AS VARCHAR) AS observed_at, availability FROM obs QUALIFY row_number() OVER (PARTITION BY posting_id ORDER BY observed_at DESC, observation_id DESC) <= 5")
def history_newest_first(e: Evidence) -> DataFrame:
    w = Window.partitionBy("posting_id").orderBy(F.desc("observed_at"), F.desc("observation_id"))
    return e.obs.withColumn("n", F.row_number().over(w)).where("n <= 5").select("posting_id", "observation_id", *text("observed_at"), "availability")


@query("least_recently_checked", "SELECT posting_id, CAST(checked_at AS VARCHAR) AS checked_at, n <= 50 AS due, n AS place FROM (SELECT posting_id, checked_at, row_number() OVER (ORDER BY checked_at, posting_id) AS n FROM cur) WHERE n <= 100")
def least_recently_checked(e: Evidence) -> DataFrame:
    top = e.current.select("posting_id", "checked_at").orderBy("checked_at", "posting_id").limit(100)
    n = F.row_number().over(Window.orderBy("checked_at", "posting_id")).cast("long")
    return top.withColumn("place", n).select("posting_id", *text("checked_at"), (F.col("place") <= 50).alias("due"), "place")


@query("pass_comparison", "SELECT CAST(slot AS VARCHAR) AS slot, count(*) FILTER (x IN (1, 3)) AS n_first, count(*) FILTER (x IN (2, 3)) AS n_second, count(*) AS n_union, count(*) FILTER (x = 2) AS n_appeared, count(*) FILTER (x = 1) AS n_disappeared, count(*) FILTER (x <> 3) = 0 AS sets_match, count(*) FILTER (x = 1) = count(*) FILTER (x = 2) AS counts_match FROM (SELECT slot, posting_id, sum(x) AS x FROM (SELECT DISTINCT slot, posting_id, CASE WHEN observation_id % 2 = 0 THEN 1 ELSE 2 END AS x FROM obs WHERE availability = 'content_captured') GROUP BY 1, 2) GROUP BY 1")
def pass_comparison(e: Evidence) -> DataFrame:
    own = e.obs.where("availability = 'content_captured'")
    out = Q.compare_sets(own.where("observation_id % 2 = 0"), own.where("observation_id % 2 = 1"), "slot", "posting_id")
    return out.withColumn("slot", F.col("slot").cast("string"))


@query("failed_fetches", "SELECT availability, identity, lineage, CAST(slot AS VARCHAR) AS slot, count(*) AS n, CAST(max(observed_at) AS VARCHAR) AS latest FROM obs WHERE availability <> 'content_captured' OR identity <> 'match' GROUP BY 1, 2, 3, 4")
def failed_fetches(e: Evidence) -> DataFrame:
    found = C.exceptions(C.cube(e.obs)).groupBy("availability", "identity", "lineage", "slot").agg(F.sum("n").alias("n"), F.max("latest").alias("latest"))
    return found.select("availability", "identity", "lineage", *text("slot"), "n", *text("latest"))


@query("fingerprints", "SELECT doc_id, sha256('text' || chr(31) || '1.0.0' || chr(31) || coalesce(text, '') || chr(31)) AS text_fp, sha256('content' || chr(31) || '1.1.0|1.0.0|1.0.0' || chr(31) || coalesce(source, '') || chr(31) || coalesce(text, '') || chr(31)) AS content_fp FROM documents", ctes=False)
def fingerprints(e: Evidence) -> DataFrame:
    from tidemark.contracts import Contracts

    c = Contracts()
    return e.table("documents").select("doc_id", S.text_fingerprint("text", c.text_contract).alias("text_fp"), S.content_fingerprint(F.lit(c.lineage), F.col("source"), F.col("text")).alias("content_fp"))


@query("slots", "SELECT event_id, CAST(CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS VARCHAR) AS local_day, CAST((CAST(CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS TIMESTAMP) + INTERVAL 390 MINUTE) AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC' AS VARCHAR) AS slot_utc, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS utc_text FROM events", ctes=False)
def slots(e: Evidence) -> DataFrame:
    return e.table("events").select("event_id", S.local_date("ts").cast("string").alias("local_day"), S.slot_utc("ts", 6, 30).cast("string").alias("slot_utc"), S.utc_text("ts").alias("utc_text"))


@query("snapshot_rotation")
def snapshot_rotation(e: Evidence) -> DataFrame:
    snaps = e.table("orders").select((F.col("o_custkey") % 50).alias("source"), F.to_timestamp_ntz(F.col("o_orderdate").cast("string")).alias("taken"), (F.col("o_orderkey") % 5 != 0).alias("verified"))
    snaps = snaps.groupBy("source", "taken").agg(F.bool_or("verified").alias("verified"))
    return Q.rotation(snaps).select("source", *text("taken"), "verified", "decision")


ORACLE["snapshot_rotation"] = """WITH s AS (SELECT o_custkey % 50 AS source, o_orderdate AS taken, bool_or(o_orderkey % 5 <> 0) AS verified FROM orders GROUP BY 1, 2),
a AS (SELECT *, strftime(taken, '%G-%V') AS week, strftime(taken, '%Y-%m') AS month, row_number() OVER (PARTITION BY source ORDER BY taken DESC) AS rank,
  count(*) FILTER (verified) OVER (PARTITION BY source) AS n_verified, max(taken) FILTER (verified) OVER (PARTITION BY source) AS newest FROM s),
b AS (SELECT *, row_number() OVER (PARTITION BY source, week ORDER BY taken DESC) AS in_week, row_number() OVER (PARTITION BY source, month ORDER BY taken DESC) AS in_month FROM a),
c AS (SELECT *, count(*) FILTER (in_week = 1) OVER w AS week_rank, count(*) FILTER (in_month = 1) OVER w AS month_rank FROM b WINDOW w AS (PARTITION BY source ORDER BY taken DESC))
SELECT source, CAST(taken AS VARCHAR) AS taken, verified, CASE WHEN verified AND taken = newest THEN 'newest_verified' WHEN rank <= 7 THEN 'daily' WHEN in_week = 1 AND week_rank <= 4 THEN 'weekly'
  WHEN in_month = 1 AND month_rank <= 12 THEN 'monthly' WHEN n_verified <= 1 THEN 'only_verified' ELSE 'prune' END AS decision FROM c"""
