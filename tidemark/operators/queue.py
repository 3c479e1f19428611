"""The run log and the work of a run: runs from their records, identities, addresses, attempts, queues, and what is remembered within a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contracts import PRIORITIES

# Roles of addresses in the order of their use, and beginnings of the details of checks that found nothing at the source.
ROLES = ("canonical-detail", "listing-link")
GONE = ("HTTP 404", "HTTP 410")


def runs_of(records: DataFrame) -> DataFrame:
    """The runs from an append-only log (run_id, at, event: open, heartbeat, close; kind, slot, outcome): when each began, was last alive and ended."""
    at = lambda event: F.when(F.col("event") == event, F.col("at"))
    return records.groupBy("run_id").agg(
        F.min(at("open")).alias("started_at"), F.max("at").alias("alive_at"), F.max(at("close")).alias("ended_at"), F.min_by("kind", at("open")).alias("kind"), F.min_by("slot", at("open")).alias("slot"),
        F.max_by("outcome", at("close")).alias("outcome"),
    )


def has_baseline(runs: DataFrame) -> DataFrame:
    """One row: whether a run succeeded or partly did before, so that what is new means something."""
    return runs.where(F.col("outcome").isin("success", "partial")).limit(1).agg((F.count("*") > 0).alias("has_baseline"))


def registered(rows: DataFrame, key: list[str], at: str, *first: str) -> DataFrame:
    """One row for each natural key, with the ``first`` columns of its earliest row: get-or-create without an update."""
    return rows.groupBy(*key).agg(F.min(at).alias("first_seen"), *(F.min_by(c, at).alias(c) for c in first))


def discovery_basis(is_baseline: Column, listed: Column) -> Column:
    """Why an identity is known: found by a baseline, by a listing later on, or by a check of an address."""
    return F.when(listed & is_baseline, "baseline").when(listed, "listing").otherwise("direct_check")


def addresses(uses: DataFrame) -> DataFrame:
    """posting_id, url, role with first_seen, last_seen and seen_count from each use (posting_id, url, role, seen_at)."""
    return uses.groupBy("posting_id", "url", "role").agg(F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_seen"), F.count("*").alias("seen_count"))


def best_address(known: DataFrame) -> DataFrame:
    """The address to ask of each posting: by role, then the one seen last, then in the order of the text."""
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role"))
    rank = F.struct(F.when(role > 0, role).otherwise(len(ROLES) + 1).alias("role"), (-F.unix_micros(F.col("last_seen").cast("timestamp"))).alias("late"), F.col("url").alias("url"))
    return known.groupBy("posting_id").agg(F.min_by("url", rank).alias("url"))


def attempts_of(fetches: DataFrame) -> DataFrame:
    """A row for each attempt of a fetch (fetch_id, attempts: array of structs in their order); the last one is the fetch's own, the others are superseded."""
    each = fetches.select("fetch_id", F.size("attempts").alias("n"), F.posexplode("attempts").alias("k", "a"))
    return each.select("fetch_id", (F.col("k") + 1).alias("attempt_no"), (F.col("k") + 1 < F.col("n")).alias("superseded"), "a.*")


def transport_failure(error: Column, message: Column) -> Column:
    """Class of a failed send from the error's name and message."""
    names = F.contains(message, F.lit("getaddrinfo")) | F.contains(message, F.lit("Name or service"))
    return (
        F.when(error == "ConnectTimeout", "timeout_connect").when(error == "ReadTimeout", "timeout_read").when(error == "ConnectError", F.when(names, "dns").otherwise("connect"))
        .when(error == "TooManyRedirects", "too_many_redirects").when(error.isNotNull(), "transport")
    )


def gone_at_source(detail: Column) -> Column:
    out = F.lit(False)
    for head in GONE:
        out = out | detail.startswith(head)
    return F.coalesce(out, F.lit(False))


def due(tier: Column, next_due: Column, as_of: Column) -> Column:
    """Weekly ones wait for their day; all others are due."""
    return ~F.coalesce((tier == "weekly") & (next_due > as_of), F.lit(False))


def detail_queue(postings: DataFrame, listed: DataFrame, policy: DataFrame, as_of: Column, baseline: Column, most: int) -> DataFrame:
    """The checks of a run: posting_id, priority, because; ``because`` is deferred for those that are not due or beyond ``most`` rechecks.

    postings: posting_id, discovered_here, last_checked; listed: posting_id; policy: posting_id, tier, next_due. What was listed is always checked, first what
    was discovered in this run unless that is a baseline. Of the others the least recently checked come first, so none waits for ever.
    """
    p = postings.join(listed.select("posting_id", F.lit(True).alias("on_list")).distinct(), "posting_id", "left").join(policy.select("posting_id", "tier", "next_due"), "posting_id", "left")
    p = p.withColumn("tier", F.coalesce("tier", F.lit("daily")))
    wanted = p.withColumn("old", F.col("on_list").isNull() & due(F.col("tier"), F.col("next_due"), as_of))
    # A total order of the due ones by their own window would be one task; the bound is a top-k, which is not.
    first = wanted.where("old").orderBy(F.col("last_checked").asc_nulls_first(), "posting_id").limit(most).select("posting_id", F.lit(True).alias("chosen"))
    wanted = wanted.join(first, "posting_id", "left")
    weekly = F.col("tier") == "weekly"
    priority = (
        F.when(F.col("on_list"), F.when(F.col("discovered_here") & ~baseline, PRIORITIES["new"]).otherwise(PRIORITIES["listed"]))
        .when(F.col("chosen"), F.when(weekly, PRIORITIES["historical_weekly"]).otherwise(PRIORITIES["historical_daily"]))
    )
    because = F.when(F.col("on_list"), "listed").when(F.col("chosen"), F.when(weekly, "historical-weekly").otherwise("historical-daily")).otherwise("deferred")
    return wanted.select("posting_id", priority.alias("priority"), because.alias("because"))


def merged(queue: DataFrame) -> DataFrame:
    """One row for each work: asked for again, it keeps the smallest priority and the payload of that."""
    return queue.groupBy("kind", "work_key").agg(F.min("priority").alias("priority"), F.min_by("payload", F.struct("priority", "asked_at")).alias("payload"), F.count("*").alias("asked"))


def claim(queue: DataFrame, n: int) -> DataFrame:
    """The next ``n`` pending works by priority and id."""
    return queue.where("state = 'pending'").orderBy("priority", "work_id").limit(n)


def after_attempt(queue: DataFrame, results: DataFrame) -> DataFrame:
    """The queue after the results (work_id, ok, error) of claimed works: done, pending again, or failed at the last of most_attempts."""
    q = queue.join(results, "work_id", "left")
    tries = F.col("attempts") + F.col("ok").isNotNull().cast("int")
    state = F.when(F.col("ok"), "done").when(F.col("ok").isNull(), F.col("state")).when(tries >= F.col("most_attempts"), "failed").otherwise("pending")
    return q.select("work_id", "priority", tries.alias("attempts"), "most_attempts", state.alias("state"), F.when(~F.col("ok"), F.col("error")).alias("error"))


def reclaimed(queue: DataFrame, open_runs: DataFrame) -> DataFrame:
    """Works that were claimed by runs that are no longer open are pending again."""
    held = queue.join(open_runs.select(F.col("run_id").alias("claimed_by"), F.lit(True).alias("alive")), "claimed_by", "left")
    lost = (F.col("state") == "claimed") & F.col("alive").isNull()
    return held.select("work_id", F.when(lost, "pending").otherwise(F.col("state")).alias("state"), F.when(~lost, F.col("claimed_by")).alias("claimed_by"))


def first_captures(uses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the uses (run_id, url, observation_id, position) of linked documents: what to fetch, each address once a run, and the bridge to all observations."""
    once = uses.groupBy("run_id", "url").agg(F.min(F.struct("observation_id", "position")).alias("f"), F.count("*").alias("uses")).select("run_id", "url", F.col("f.observation_id").alias("observation_id"), "uses")
    return once, uses.select("run_id", "url", "observation_id").distinct()


def resource_text_state(outcome: Column, body: Column, media: Column, lossless: Column) -> Column:
    """Whether a linked document's text was read: ok, failed (with replaced characters), unavailable for what is no text, not_attempted without a body."""
    name = F.lower(F.coalesce(media, F.lit("")))
    textual = name.startswith("text/") | name.isin("application/xhtml+xml", "application/xml", "application/json")
    return F.when((outcome != "captured") | body.isNull() | (F.length(body) == 0), "not_attempted").when(textual, F.when(lossless, "ok").otherwise("failed")).otherwise("unavailable")


def reprocess_inputs(observations: DataFrame, fetches: DataFrame, payloads: DataFrame, postings: DataFrame) -> DataFrame:
    """observation_id, posting_id (null if not registered), payload of every observation whose fetch has an archived body: what a new reading reads."""
    known = postings.select("posting_id", F.lit(True).alias("known"))
    out = observations.select("observation_id", "posting_id", "fetch_id").join(fetches.select("fetch_id", "sha256"), "fetch_id").join(payloads.select("sha256", "byte_length"), "sha256").join(known, "posting_id", "left")
    return out.select("observation_id", F.when(F.col("known"), F.col("posting_id")).alias("posting_id"), "sha256", "byte_length")


def last_qualified_scan(scans: DataFrame) -> DataFrame:
    """Of each run the qualified scan of the greatest ordinal: the one that absence is read from."""
    return scans.where("qualified").groupBy("run_id").agg(F.max_by("scan_id", "ordinal").alias("scan_id"))


def ordinals(values: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Values numbered from 0 within their group."""
    return values.withColumn("ordinal", F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)
