"""Availability, redirects into states, version and posting registration, run outcome, retries and health, as expressions and aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import Contracts


def availability(signal: Column, ok: Column, status: Column, redirect: Column, expected: Column, shown: Column, body: Column, closure: Column) -> Column:
    """struct(identity, availability) of a check; the first rule that fits.

    Access control, a failed or empty response, a redirect to the listing, another identity (by redirect or as shown), an empty page
    with and without a sign of closure, content.
    """
    own = F.when(shown == expected, "match").otherwise("absent_on_page")
    pair = lambda identity, state: F.struct((F.lit(identity) if isinstance(identity, str) else identity).alias("identity"), F.lit(state).alias("availability"))
    other = shown.isNotNull() & (shown != expected)
    empty = body.isNull() | (F.length(body) == 0)
    return (
        F.when(signal.isNotNull(), pair("not_observed", "access_control_challenge"))
        .when(~ok & (status == 404), pair("not_observed", "not_found"))
        .when(~ok, pair("not_observed", "retrieval_failed"))
        .when(redirect == "to_listing", pair("absent_on_page", "redirected_to_listing"))
        .when(other & (redirect == "to_other_job"), pair("mismatch", "redirected_to_other_job"))
        .when(other, pair("mismatch", "identity_mismatch"))
        .when(empty & closure.isNotNull(), pair(own, "explicit_closure"))
        .when(empty, pair(own, "not_found"))
        .otherwise(pair(own, "content_captured"))
    )


def register_versions(captures: DataFrame, contracts: Contracts) -> DataFrame:
    """Distinct contents of (posting_id, fingerprint) with the lineage that read them and when they were first and last seen.

    A capture that repeats a content adds an observation, not a version. Rows of another lineage never fold into these.
    """
    rows = captures.withColumn("lineage", F.lit(contracts.lineage))
    return rows.groupBy("posting_id", "lineage", "fingerprint").agg(F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen"), F.count("*").alias("observed"), F.min_by("title", F.struct("observed_at", "observation_id")).alias("title"))


def reinterpret(known: DataFrame, captures: DataFrame, contracts: Contracts) -> DataFrame:
    """The versions that a new reading of archived captures adds: none for a lineage that has read them before."""
    new = register_versions(captures, contracts)
    return new.join(known.select("posting_id", "lineage", "fingerprint"), ["posting_id", "lineage", "fingerprint"], "left_anti")


def relink(observations: DataFrame, versions: DataFrame, contracts: Contracts) -> DataFrame:
    """Observations with the version of this lineage that has their fingerprint; those read in another lineage get the new one, none is lost."""
    v = versions.where(F.col("lineage") == contracts.lineage).select("posting_id", "fingerprint", F.col("lineage").alias("linked_lineage"))
    return observations.join(v, ["posting_id", "fingerprint"], "left")


def run_outcome(discovery: Column, qualified: Column, pending: Column, unreconciled: Column, failed: Column, uncertain: Column, challenged: Column) -> Column:
    """struct(outcome, problem)."""
    problems = F.concat_ws(
        "; ",
        F.when(pending > 0, F.concat(pending.cast("string"), F.lit(" queued checks were not made"))),
        F.when(unreconciled, F.lit("the sets of the passes differ")),
        F.when(failed > 0, F.concat(failed.cast("string"), F.lit(" checks failed"))),
        F.when(uncertain > 0, F.concat(uncertain.cast("string"), F.lit(" checks were inconclusive"))),
        F.when(challenged, F.lit("the source asked for a proof")),
    )
    outcome = F.when(~discovery, "failed").when(~qualified, "partial").when(problems != "", "partial").otherwise("success")
    problem = F.when(~discovery, "no traversal was completed").when(~qualified, "no traversal qualified; absence is not concluded").otherwise(problems)
    return F.struct(outcome.alias("outcome"), F.nullif(problem, F.lit("")).alias("problem"))


def exit_code(state: Column, backup_ok: Column) -> Column:
    return F.when(state.isin("FAILED", "STALE"), 1).when(state.isin("DEGRADED", "UNKNOWN"), 2).when(~backup_ok, 3).otherwise(0)


def abandon_stale(runs: DataFrame, as_of: str, hours: int = 12) -> DataFrame:
    """Open runs that began longer ago than ``hours`` end as aborted."""
    stale = F.col("ended_at").isNull() & (F.col("started_at") < F.to_timestamp_ntz(F.lit(as_of)) - F.make_dt_interval(F.lit(0), F.lit(hours)))
    return runs.withColumn("outcome", F.when(stale, "aborted").otherwise(F.col("outcome"))).withColumn("ended_at", F.when(stale, F.to_timestamp_ntz(F.lit(as_of))).otherwise(F.col("ended_at")))


def work_state(attempts: DataFrame, most: int = 3) -> DataFrame:
    """Of (work_key, at, result), each work's state: done once it succeeded, failed after ``most`` attempts, else pending."""
    a = attempts.groupBy("work_key").agg(F.count("*").alias("attempts"), F.bool_or(F.col("result") == "ok").alias("ok"))
    return a.select("work_key", "attempts", F.when(F.col("ok"), "done").when(F.col("attempts") >= most, "failed").otherwise("pending").alias("state"))


def delivery(state: Column, attempts: Column, permanent: Column, accepted: Column, most: int = 5) -> Column:
    """The next state of a notice: accepted, skipped and abandoned are final; a permanent failure or the last attempt abandons."""
    return F.when(state.isin("accepted", "skipped", "abandoned"), state).when(accepted, "accepted").when(permanent | (attempts >= most), "abandoned").otherwise("failed")


def failure_class(smtp_code: Column, network: Column) -> Column:
    return F.when(network | smtp_code.between(400, 499), "transient").otherwise("permanent")
