"""Counters of the console and the diagnostics from one pass over the observations, bounded samples, and claims with leases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import TERMINAL, UNCERTAIN

KEYS = ("slot", "availability", "identity", "lineage", "version")


def cube(obs: DataFrame) -> DataFrame:
    """level, the five keys, n, first, latest: counts by all five keys, by run, by availability, and of all; one pass over the observations.

    level: exceptions, run, availability or all. All other counters are cut from these few rows.
    """
    first, latest = F.min("observed_at").alias("first"), F.max("observed_at").alias("latest")
    sets = obs.groupingSets([list(KEYS), ["slot"], ["availability"], []], *KEYS).agg(F.grouping_id().alias("g"), F.count("*").alias("n"), first, latest)
    level = F.when(F.col("g") == 0, "exceptions").when(F.col("g") == 0b01111, "run").when(F.col("g") == 0b10111, "availability").otherwise("all")
    return sets.select(level.alias("level"), *KEYS, "n", "first", "latest")


def exceptions(cubed: DataFrame) -> DataFrame:
    """What was not captured as it should be, by the five keys."""
    return cubed.where("level = 'exceptions' AND (availability <> 'content_captured' OR identity <> 'match')").drop("level", "first")


def failure_counters(cubed: DataFrame) -> DataFrame:
    """One row of six counters and when something last failed."""
    a, rows = F.col("availability"), cubed.where("level = 'exceptions'")
    of = lambda cond, name: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long").alias(name)
    failed = a == "retrieval_failed"
    return rows.agg(
        of(failed, "not_retrieved"), of(a == "access_control_challenge", "challenged"), of(a.isin(*UNCERTAIN), "uncertain"), of(a.isin(*TERMINAL), "gone"),
        of(F.col("identity") == "mismatch", "mismatched"), of(failed | (F.col("identity") == "mismatch"), "faults"), F.max(F.when(failed, F.col("latest"))).alias("last_failure"),
    )


def lifetime(cubed: DataFrame, runs: DataFrame, postings: DataFrame, versions: DataFrame, changes: DataFrame) -> DataFrame:
    """One row of twelve totals since the beginning. Each frame is gone over once; the frames' totals are single rows."""
    a, n = F.col("availability"), F.col("n")
    of = lambda cond, name: F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("long").alias(name)
    out = cubed.where("level = 'exceptions'").agg(
        of(F.lit(True), "observations"), of(a == "content_captured", "captures"), of(a.isin(*TERMINAL), "gone"), of(a.isin(*UNCERTAIN), "uncertain"), of(F.col("identity") == "mismatch", "mismatches"),
    )
    r = runs.agg(F.count("*").alias("runs"), F.count_if("qualified").alias("qualified_runs"), F.count_if(F.col("outcome") == "failed").alias("failed_runs"), F.count_if(F.col("kind") == "retry").alias("retries"))
    for part in (r, *(df.agg(F.count("*").alias(name)) for df, name in ((postings, "postings"), (versions, "versions"), (changes, "changes")))):
        out = out.join(part)
    return out


def gaps_by_kind(gaps: DataFrame) -> DataFrame:
    """slot, gap_kind, detail, n: the gaps of each run, equal ones counted."""
    return gaps.groupBy("slot", "gap_kind", "detail").agg(F.count("*").alias("n"))


def sampled(rows: DataFrame, group: str, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group, as ``place`` from 1. Each task passes on ``most`` rows of a group at the most, so a group of any size stays small."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= most)


def failures_of_runs(obs: DataFrame, most: int = 25) -> DataFrame:
    """run, failures (posting_id and availability of the first ``most`` checks without content, in order), n_failures, n_more: what a report lists and how much it leaves out."""
    bad = obs.where("availability <> 'content_captured'").select("slot", "observation_id", "posting_id", "availability")
    some = sampled(bad, "slot", [F.col("observation_id")], most).groupBy("slot").agg(F.sort_array(F.collect_list(F.struct("place", "posting_id", "availability"))).alias("failures"))
    counts = bad.groupBy("slot").agg(F.count("*").alias("n_failures"))
    return counts.join(some, "slot").select("slot", "failures", "n_failures", F.greatest(F.col("n_failures") - most, F.lit(0)).alias("n_more"))


def linked_outcomes(uses: DataFrame) -> DataFrame:
    """run_id, captured, gone_at_source, unresolved: what became of linked documents (uses: use_id, run_id, outcome, detail) in the newest run that looked at any.

    The newest run is that of the greatest use; the counts of all runs are partial sums, of which one is kept, so nothing is sorted or joined. That a document is not there is the source's own answer and no fault.
    """
    captured = F.col("outcome").isin("captured", "not_modified")
    gone = ~captured & F.coalesce(F.col("detail").startswith("HTTP 404") | F.col("detail").startswith("HTTP 410"), F.lit(False))
    runs = uses.groupBy("run_id").agg(F.max("use_id").alias("newest"), F.count_if(captured).alias("captured"), F.count_if(gone).alias("gone_at_source"), F.count_if(~captured & ~gone).alias("unresolved"))
    top = runs.agg(F.max(F.struct("newest", "run_id", "captured", "gone_at_source", "unresolved")).alias("r"))
    return top.where("r is not null").select("r.run_id", "r.captured", "r.gone_at_source", "r.unresolved")


def pass_statistics(obs: DataFrame, versions: DataFrame) -> DataFrame:
    """slot and nine counters of what its checks came to; ``new_versions``: captures that were the first of their version (versions: posting_id, lineage, version, first_seen)."""
    a, own = F.col("availability"), F.col("identity") == "match"
    first = versions.select("posting_id", "lineage", "version", F.col("first_seen").alias("observed_at"), F.lit(True).alias("fresh"))
    rows = obs.join(first, ["posting_id", "lineage", "version", "observed_at"], "left")
    captured = (a == "content_captured") & own
    return rows.groupBy("slot").agg(
        F.count("*").alias("attempted"), F.count_if(captured).alias("captured"), F.count_distinct(F.when(captured & F.col("fresh"), F.struct("posting_id", "lineage", "version"))).alias("new_versions"),
        F.count_if(a == "explicit_closure").alias("closed"), F.count_if(a.isin("redirected_to_listing", "redirected_to_other_job")).alias("redirected"), F.count_if(a == "not_found").alias("not_found"),
        F.count_if(~own).alias("mismatched"), F.count_if(a == "retrieval_failed").alias("not_retrieved"), F.count_if(a == "access_control_challenge").alias("challenged"),
    )


def recent_runs(runs: DataFrame, counts: list[str], most: int = 10) -> DataFrame:
    """The newest runs with the named counts out of their ``counts_json``; a count that a run did not write, or a text that is no JSON, is null."""
    newest = runs.orderBy(F.desc("slot")).limit(most).withColumn("counts", F.from_json("counts_json", "map<string,long>"))
    return newest.select(*(c for c in runs.columns if c != "counts_json"), *(F.try_element_at("counts", F.lit(c)).alias(c) for c in counts))


def console_document(components: DataFrame, lifetime: DataFrame, failures: DataFrame, resources: DataFrame, gaps: DataFrame, exceptions: DataFrame, recent: DataFrame, most: int = 50) -> DataFrame:
    """One row as JSON: the components with the worst of them, the counters (one-row frames), and lists: gaps by kind, the most frequent exceptions and the newest runs.

    Lists are cut to ``most`` before they are gathered.
    """
    one = lambda df, name: df.agg(F.first(F.struct(*df.columns)).alias(name))
    listed = lambda df, name: df.limit(most).agg(F.sort_array(F.collect_list(F.struct(*df.columns)), False).alias(name))
    worst = components.where("component = 'overall'").agg(F.first("health").alias("overall"))
    parts = components.where("component <> 'overall'")
    top = exceptions.orderBy(F.desc("n"), F.desc("latest")).select("n", "latest", *(c for c in exceptions.columns if c not in ("n", "latest")))
    out = worst
    for part in (listed(parts, "components"), one(lifetime, "lifetime"), one(failures, "failures"), one(resources, "resources"), listed(gaps, "gaps"), listed(top, "exceptions"), listed(recent, "recent_runs")):
        out = out.join(part)
    return out.select("overall", F.to_json(F.struct(*out.columns), {"ignoreNullFields": "false"}).alias("document"))


# -- summaries --------------------------------------------------------------


def queue_summary(queue: DataFrame, *keys: str) -> DataFrame:
    """How many works there are of each state and what else is asked for."""
    return queue.groupBy(*keys).agg(F.count("*").alias("n"))


def associations(links: DataFrame) -> DataFrame:
    """resource, observations, links: of the links (resource, observation), by how many observations each resource is linked, and how often."""
    bridge = links.groupBy("resource", "observation").agg(F.count("*").alias("n"))
    return bridge.groupBy("resource").agg(F.count("*").alias("observations"), F.sum("n").alias("links"))


def resource_outcomes(uses: DataFrame) -> DataFrame:
    """outcome, state, n, latest, total of the uses (outcome, state, use_id, size)."""
    return uses.groupBy("outcome", "state").agg(F.count("*").alias("n"), F.max("use_id").alias("latest"), F.sum("size").alias("total"))


def unlinked(resources: DataFrame, links: DataFrame) -> DataFrame:
    """The resources that no link names."""
    return resources.join(links.select("resource").distinct(), "resource", "left_anti")


def text_statistics(texts: DataFrame, key: str) -> DataFrame:
    """n, shortest, longest and mean length (cut to a whole number) of the texts by key."""
    n = F.length("text").cast("long")
    return texts.groupBy(key).agg(F.count("*").alias("n"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.avg(n).cast("long").alias("mean"))


def conflicts(values: DataFrame) -> DataFrame:
    """entity_id and its values, sorted, of the entities (entity_id, value) that have several different ones."""
    return values.groupBy("entity_id").agg(F.sort_array(F.collect_set("value")).alias("found")).where(F.size("found") > 1)


def availability_split(obs: DataFrame) -> DataFrame:
    """slot, terminal, uncertain, ever_captured (different postings)."""
    a = F.col("availability")
    return obs.groupBy("slot").agg(F.count_if(a.isin(*TERMINAL)).alias("terminal"), F.count_if(a.isin(*UNCERTAIN)).alias("uncertain"), F.count_distinct(F.when(a == "content_captured", F.col("posting_id"))).alias("ever_captured"))


def histories(obs: DataFrame, most: int) -> DataFrame:
    """The ``most`` postings with the most observations, with their number of different versions."""
    return obs.groupBy("posting_id").agg(F.count("*").alias("observations"), F.count_distinct("version").alias("versions")).orderBy(F.desc("observations"), "posting_id").limit(most)


def oldest_first(notices: DataFrame, besides: Column, most: int) -> DataFrame:
    """The retry sweep: the ``most`` oldest failed notices (notice_id, at, state), without those of the run at hand."""
    return notices.where((F.col("state") == "failed") & ~besides).orderBy("at", "notice_id").limit(most)


def last_times(obs: DataFrame, entries: DataFrame, qualified: DataFrame) -> DataFrame:
    """posting_id and when it was last listed (by a qualified run), captured, seen (with its own identity) and observed at all: four maxima in one aggregation."""
    kind = lambda cond, name: F.when(cond, F.lit(name))
    kinds = F.array_compact(F.array(F.lit("observed"), kind(F.col("identity") == "match", "seen"), kind((F.col("identity") == "match") & (F.col("availability") == "content_captured"), "captured")))
    listed = entries.join(qualified.select("slot"), "slot").select("posting_id", F.col("seen_at").alias("at"), F.array(F.lit("listed")).alias("kinds"))
    times = obs.select("posting_id", F.col("observed_at").alias("at"), kinds.alias("kinds")).union(listed)
    return times.groupBy("posting_id").agg(*(F.max(F.when(F.array_contains("kinds", k), F.col("at"))).alias(f"last_{k}") for k in ("listed", "captured", "seen", "observed")))


# -- claims -----------------------------------------------------------------


def claimable(queue: DataFrame, now: str) -> Column:
    """Whether a work can be taken: it waits, or it was claimed and its lease has run out."""
    return (F.col("state") == "pending") | ((F.col("state") == "claimed") & (F.col("leased_until") <= F.to_timestamp_ntz(F.lit(now))))


def claimed(queue: DataFrame, worker: str, now: str, n: int, minutes: int = 30) -> DataFrame:
    """The queue (work_id, priority, state, claimed_by, leased_until) after ``worker`` has taken the next ``n`` works by priority and id."""
    free = queue.where(claimable(queue, now)).orderBy("priority", "work_id").limit(n).select(F.col("work_id").alias("taken"))
    q = queue.join(free, queue["work_id"] == free["taken"], "left")
    until = F.to_timestamp_ntz(F.lit(now)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    own = F.col("taken").isNotNull()
    new = {"state": F.lit("claimed"), "claimed_by": F.lit(worker), "leased_until": until}
    return q.select(*(F.when(own, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in queue.columns))


def finished(queue: DataFrame, worker: str, results: DataFrame, now: str) -> DataFrame:
    """The queue after the worker's results (work_id, ok): done, or pending again. A result for a work whose lease was lost to another worker changes nothing."""
    r = results.select(F.col("work_id").alias("of"), "ok")
    q = queue.join(r, queue["work_id"] == r["of"], "left")
    own = F.col("ok").isNotNull() & (F.col("state") == "claimed") & (F.col("claimed_by") == worker)
    new = {"state": F.when(F.col("ok"), "done").otherwise("pending"), "claimed_by": F.lit(None).cast("string"), "leased_until": F.lit(None).cast("timestamp_ntz")}
    return q.select(*(F.when(own, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in queue.columns))
