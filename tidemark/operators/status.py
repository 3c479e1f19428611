"""State of a collection: runs' facts and reports, collection state, retries, notices, startup failures, backups, and the health document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import TERMINAL, UNCERTAIN
from tidemark.functions.scalars import duration_text

# Kinds of runs that are reported, outcomes that collected nothing, markers of outcomes.
REPORTABLE = ("daily", "retry", "manual", "baseline")
NON_COLLECTING = ("lock_contention",)
MARKERS = {"success": "OK", "partial": "EXCEPTIONS", "failed": "FAILED", "aborted": "INTERRUPTED", "lock_contention": "SKIPPED"}
RANKS = {"healthy": 1, "degraded": 2, "unhealthy": 3}


def collection_state(runs: DataFrame, as_of: DataFrame) -> DataFrame:
    """For each ``as_of`` (a date): state, last_outcome, last_qualified, days_since_qualified of the runs (started_at, ended_at, slot, outcome, qualified).

    An open run is RUNNING, no run at all NEVER_RUN; two days without a qualified one are STALE whatever the last run says; then the
    outcome of the last run decides. The runs are summed up to one row first, so each date meets that row only.
    """
    done = F.col("ended_at").isNotNull()
    one = runs.agg(
        F.count_if(~done).alias("open"), F.count_if(done).alias("n"), F.max_by("outcome", F.when(done, F.col("started_at"))).alias("last_outcome"),
        F.max(F.when(F.col("qualified"), F.col("slot"))).alias("last_qualified"),
    )
    outcome, days = F.col("last_outcome"), F.date_diff("as_of", "last_qualified")
    state = (
        F.when(F.col("open") > 0, "RUNNING").when(F.col("n") == 0, "NEVER_RUN").when(days >= 2, "STALE")
        .when((outcome == "success") & F.col("last_qualified").isNotNull(), "HEALTHY").when(outcome.isin("partial", "lock_contention"), "DEGRADED").when(outcome.isin("failed", "aborted"), "FAILED").otherwise("UNKNOWN")
    )
    return as_of.join(F.broadcast(one)).select("as_of", state.alias("state"), "last_outcome", "last_qualified", days.alias("days_since_qualified"))


def retry_decisions(slots: DataFrame, runs: DataFrame, most: int = 2) -> DataFrame:
    """For each slot: decision (no_run, in_progress, done, exhausted, retry), parent_run and attempt of the retry to make.

    runs: run_id, slot, kind, outcome, ended_at. A retry belongs to the slot of its daily run; only scheduled kinds count.
    """
    r = runs.where(F.col("kind").isin("daily", "retry")).groupBy("slot").agg(
        F.count_if(F.col("ended_at").isNull()).alias("open"), F.coalesce(F.bool_or(F.col("outcome") == "success"), F.lit(False)).alias("done"),
        F.count_if(F.col("kind") == "retry").alias("retries"), F.min(F.when(F.col("kind") == "daily", F.col("run_id"))).alias("parent"),
    )
    decision = F.when(F.col("retries").isNull(), "no_run").when(F.col("open") > 0, "in_progress").when(F.col("done"), "done").when(F.col("retries") >= most, "exhausted").otherwise("retry")
    out = slots.join(r, "slot", "left").withColumn("decision", decision)
    again = F.col("decision") == "retry"
    return out.select("slot", "decision", F.when(again, F.col("parent")).alias("parent_run"), F.when(again, F.col("retries") + 2).alias("attempt"))


def startup_failures(records: DataFrame, runs: DataFrame) -> DataFrame:
    """The failure records of each slot: how many, the latest, and whether the slot was collected after all. Records without a slot stay unresolved."""
    collected = runs.where(F.col("outcome").isin("success", "partial")).select("slot", F.lit(True).alias("there")).distinct()
    each = records.groupBy("slot").agg(F.count("*").alias("failures"), F.max("failed_at").alias("latest"))
    return each.join(collected, "slot", "left").select("slot", "failures", "latest", F.coalesce("there", F.lit(False)).alias("resolved"))


def unreported(runs: DataFrame, notices: DataFrame) -> DataFrame:
    """Runs that ended, are to be reported and have no notice of any state."""
    owed = runs.where(F.col("ended_at").isNotNull() & F.col("kind").isin(*REPORTABLE) & ~F.col("outcome").isin(*NON_COLLECTING))
    return owed.join(notices.select("run_id").distinct(), "run_id", "left_anti")


def predating(runs: DataFrame, notices: DataFrame, epoch: Column) -> DataFrame:
    """What to write down as skipped when reporting begins: unreported runs that ended before ``epoch``. What ended later stays owed."""
    return unreported(runs, notices).where(F.col("ended_at") < epoch).select("run_id", F.lit("skipped").alias("state"))


def sweep(runs: DataFrame, notices: DataFrame, without: int | None = None, limit: int = 20) -> DataFrame:
    """What to deliver now, oldest first: notices that failed or wait, and unreported runs as delayed ones."""
    again = notices.where(F.col("state").isin("pending", "failed")).select("run_id", F.lit(False).alias("delayed"))
    late = unreported(runs, notices).select("run_id", F.lit(True).alias("delayed"))
    every = again.union(late)
    return (every if without is None else every.where(F.col("run_id") != without)).orderBy("run_id").limit(limit)


def notice_status(notices: DataFrame, unreported_runs: DataFrame) -> DataFrame:
    """One row: state, detail and the counts behind it. Silence counts: a run without a notice is a fault that the notices can't show."""
    n = notices.agg(*(F.count_if(F.col("state") == s).alias(s) for s in ("pending", "failed", "abandoned", "accepted")), F.max(F.when(F.col("state") == "accepted", F.col("accepted_at"))).alias("last_accepted"))
    n = n.join(unreported_runs.agg(F.count("*").alias("unreported")))
    faults = F.concat_ws(
        "; ", F.when(F.col("failed") > 0, F.format_string("%d report(s) awaiting retry", "failed")), F.when(F.col("abandoned") > 0, F.format_string("%d gave up after their attempts", "abandoned")),
        F.when(F.col("unreported") > 0, F.format_string("%d completed run(s) without a report", "unreported")),
    )
    state = F.when(F.col("abandoned") > 0, "FAILED").when((F.col("failed") > 0) | (F.col("unreported") > 0) | (F.col("pending") > 0), "DEGRADED").when(F.col("accepted") > 0, "VERIFIED").otherwise("CONFIGURED")
    detail = F.when(faults != "", faults).when(F.col("pending") > 0, F.format_string("%d report(s) not yet accepted", "pending")).when(F.col("accepted") > 0, "the last report was accepted").otherwise("no report has been sent yet")
    return n.select(state.alias("state"), detail.alias("detail"), "pending", "failed", "abandoned", "unreported", "last_accepted")


def run_facts(runs: DataFrame, scans: DataFrame, checks: DataFrame, gaps: DataFrame, events: DataFrame) -> DataFrame:
    """Facts of each run that its report states.

    runs: run_id, kind, outcome, slot, started_at, ended_at, is_baseline, pending; scans: run_id, ordinal, qualified, unique_ids, total; checks: run_id,
    availability; gaps: run_id, kind, detail; events: run_id, event_kind. A disappearance is not a failed retrieval, and
    what is new only means something once there was a baseline.
    """
    s = scans.groupBy("run_id").agg(F.count("*").alias("n_scans"), F.count_if("qualified").alias("n_qualified"), F.max_by(F.struct("unique_ids", "total"), F.when(F.col("qualified"), F.col("ordinal"))).alias("final"))
    a = F.col("availability")
    c = checks.groupBy("run_id").agg(
        F.count("*").alias("attempted"), F.count_if(a == "content_captured").alias("captured"), F.count_if(a.isin(*TERMINAL)).alias("gone"),
        F.count_if(a.isin(*UNCERTAIN)).alias("uncertain"), F.count_if(a == "retrieval_failed").alias("not_retrieved"),
    )
    g = gaps.groupBy("run_id").agg(F.count("*").alias("n_gaps"))
    e = events.groupBy("run_id").agg(*(F.count_if(F.col("event_kind") == k).alias(n) for k, n in (("first_observed", "new"), ("absent_qualified", "no_longer_listed"), ("reappeared", "reappeared"))))
    out = runs
    for part in (s, c, g, e):
        out = out.join(part, "run_id", "left")
    zero = [F.coalesce(n, F.lit(0)).alias(n) for n in ("n_scans", "n_qualified", "attempted", "captured", "gone", "uncertain", "not_retrieved", "n_gaps", "no_longer_listed", "reappeared")]
    return out.select(
        "run_id", "kind", "outcome", "slot", "is_baseline", "pending", duration_text("started_at", "ended_at").alias("duration"), F.col("final.unique_ids").alias("listing_count"), F.col("final.total").alias("source_total"),
        (F.coalesce("n_qualified", F.lit(0)) > 0).alias("listing_complete"), F.when(~F.col("is_baseline"), F.coalesce("new", F.lit(0))).alias("newly_observed"), *zero,
    )


def action_required() -> Column:
    """What a person has to do about a run's facts; null if nothing."""
    o = F.col("outcome")
    problems = F.concat_ws(
        "; ", F.when(~F.col("listing_complete"), "no traversal qualified, so nothing can be said of what seems to be missing"), F.when(F.col("not_retrieved") > 0, F.format_string("%d page(s) could not be retrieved", "not_retrieved")),
        F.when(F.col("uncertain") > F.col("not_retrieved"), F.format_string("%d retrieval(s) were inconclusive", F.col("uncertain") - F.col("not_retrieved"))), F.when(F.col("pending") > 0, F.format_string("%d queued retrieval(s) were not made", "pending")),
    )
    sentence = F.concat(F.upper(F.substring(problems, 1, 1)), F.substring(problems, F.lit(2), F.length(problems)), F.lit("."))
    return (
        F.when(o == "failed", "The collection failed. Its date stays a gap unless a run succeeds today.").when(o == "aborted", "The run was interrupted. What it had collected was kept.")
        .when(problems != "", sentence)
    )


def report_subject(name: str, delayed: Column) -> Column:
    marker = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in MARKERS.items() for x in kv)), F.col("outcome")), F.lit("?"))
    count = F.concat(F.coalesce(F.col("listing_count").cast("string"), F.lit("no")), F.lit(" advertisements"))
    return F.concat(F.concat_ws(" - ", F.concat(F.lit(f"{name} "), marker), F.col("slot").cast("string"), count), F.when(delayed, " (delayed report)").otherwise(""))


def report_lines() -> Column:
    """The report of a run's facts as an array of (label, value) in their order; what is not known is left out."""
    lines = (
        ("Outcome", F.col("outcome")), ("Date", F.col("slot").cast("string")), ("Kind", F.col("kind")), ("Duration", F.col("duration")), ("Advertisements listed", F.col("listing_count").cast("string")),
        ("Reported by the source", F.col("source_total").cast("string")), ("Pages retrieved", F.format_string("%d of %d", "captured", "attempted")), ("No longer available", F.col("gone").cast("string")),
        ("Newly observed", F.col("newly_observed").cast("string")), ("No longer listed", F.col("no_longer_listed").cast("string")), ("Listed again", F.col("reappeared").cast("string")), ("Coverage gaps", F.col("n_gaps").cast("string")),
        ("Action", action_required()),
    )
    return F.filter(F.array(*(F.struct(F.lit(k).alias("label"), v.alias("value")) for k, v in lines)), lambda x: x["value"].isNotNull())


def report_text(lines: Column) -> Column:
    return F.array_join(F.transform(lines, lambda x: F.concat_ws(": ", x["label"], x["value"])), "\n")


def report_html(lines: Column) -> Column:
    from tidemark.functions.scalars import html_escape

    return F.concat(F.lit("<table>"), F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<tr><th>"), html_escape(x["label"]), F.lit("</th><td>"), html_escape(x["value"]), F.lit("</td></tr>"))), ""), F.lit("</table>"))


def backup_status(snapshots: DataFrame, as_of: Column) -> DataFrame:
    """Per source: state (UNPROTECTED, VERIFIED, DEGRADED after two days), newest verified snapshot, its age in days, and the number of snapshots."""
    b = snapshots.groupBy("source").agg(F.max(F.when(F.col("verified"), F.col("taken"))).alias("newest"), F.count("*").alias("snapshots"))
    hours = F.timestamp_diff("HOUR", F.col("newest"), as_of)
    return b.select("source", F.when(F.col("newest").isNull(), "UNPROTECTED").when(hours < 48, "VERIFIED").otherwise("DEGRADED").alias("state"), "newest", F.floor(hours / 24).alias("age_days"), "snapshots")


def restore_check_due(checked_on: Column, as_of: Column, every_days: int = 30) -> Column:
    """Whether a restore is to be checked on the date ``as_of``; it is where it never was."""
    return F.coalesce(F.date_diff(as_of, checked_on) >= every_days, F.lit(True))


def worst(components: DataFrame, group: str) -> DataFrame:
    """Per group, the worst health of its components (component, health), and which have it. A health that nobody knows counts as degraded."""
    rank = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in RANKS.items() for x in kv)), F.col("health")), F.lit(RANKS["degraded"]))
    c = components.withColumn("rank", rank).groupBy(group, "rank").agg(F.count("*").alias("n"), F.min("component").alias("first"))
    top = c.groupBy(group).agg(F.max(F.struct("rank", "n", "first")).alias("t"))
    named = F.create_map(*(F.lit(x) for k, v in RANKS.items() for x in (v, k)))
    return top.select(group, F.element_at(named, F.col("t.rank")).alias("health"), F.col("t.n").alias("components"), F.col("t.first").alias("first_component"))


#: Health of a component's state; a state that is not here counts as degraded.
HEALTH = {
    "HEALTHY": "healthy", "RUNNING": "healthy", "VERIFIED": "healthy", "CONFIGURED": "healthy", "UNCONFIGURED": "healthy", "DEGRADED": "degraded", "UNKNOWN": "degraded", "UNPROTECTED": "degraded",
    "STALE": "unhealthy", "FAILED": "unhealthy", "NEVER_RUN": "degraded",
}


def status_components(parts: dict[str, DataFrame]) -> DataFrame:
    """component, state, health of each part (frames of one row with a state), and a row ``overall`` with the worst of them."""
    known = F.create_map(*(F.lit(x) for kv in HEALTH.items() for x in kv))
    out = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("component"), "state", F.coalesce(F.try_element_at(known, F.col("state")), F.lit("degraded")).alias("health"))
        out = one if out is None else out.union(one)
    overall = worst(out.withColumn("whole", F.lit(1)), "whole").select(F.lit("overall").alias("component"), F.lit(None).cast("string").alias("state"), "health")
    return out.union(overall)


def summary(state: Column, backup: Column, notices: Column) -> Column:
    """One sentence on the whole: collection first, then what protects and reports it."""
    parts = F.concat_ws(
        "; ", F.concat(F.lit("collection is "), F.lower(state)), F.when(~backup.isin("VERIFIED", "UNCONFIGURED"), F.concat(F.lit("backups are "), F.lower(backup))),
        F.when(~notices.isin("VERIFIED", "CONFIGURED", "UNCONFIGURED"), F.concat(F.lit("notices are "), F.lower(notices))),
    )
    return F.concat(F.upper(F.substring(parts, 1, 1)), F.substring(parts, F.lit(2), F.length(parts)), F.lit("."))


def health_document(state: DataFrame, window: DataFrame, notices: DataFrame, lifetime: DataFrame, backup: DataFrame, **more: DataFrame) -> DataFrame:
    """One row as JSON from one-row frames: collection, coverage, notifications, lifetime, backup (state), ``more`` (failures, gaps, resources), and the summary and exit code."""
    from tidemark.operators.lifecycle import exit_code

    parts = {"collection": state, "coverage": window, "notifications": notices, "lifetime": lifetime, "backup": backup} | more
    out = None
    for name, df in parts.items():
        one = df.select(F.struct(*df.columns).alias(name))
        # a part without a row, such as resources before any were looked at, is null and takes nothing else away
        one = one.agg(F.first(name).alias(name))
        out = one if out is None else out.join(one)
    s, b, n = F.col("collection.state"), F.col("backup.state"), F.col("notifications.state")
    out = out.withColumn("summary", summary(s, b, n)).withColumn("exit_code", exit_code(s, b.isin("VERIFIED", "UNCONFIGURED")))
    return out.select("summary", "exit_code", F.to_json(F.struct(*parts, "summary", "exit_code"), {"ignoreNullFields": "false"}).alias("document"))
