"""Projections of the evidence: latest state with its freshness, history, listing grid, run health."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, *keys: str, time: str = "observed_at", tie: str = "observation_id") -> DataFrame:
    """The last row of each key; of equal times the greatest id. One hash aggregation, no sort of the group."""
    rest = [c for c in rows.columns if c not in keys]
    top = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(time, tie)).alias("t"))
    return top.select(*keys, *(F.col(f"t.{c}").alias(c) for c in rest))


def qualified_scans(runs: DataFrame) -> DataFrame:
    return runs.where("qualified")


def last_listed(entries: DataFrame, runs: DataFrame) -> DataFrame:
    listed = entries.join(qualified_scans(runs).select("slot"), "slot")
    return listed.groupBy("posting_id").agg(F.max("seen_at").alias("last_listed"), F.count("*").alias("times_listed"))


def posting_current(obs: DataFrame, postings: DataFrame, versions: DataFrame, entries: DataFrame, runs: DataFrame) -> DataFrame:
    """Latest content, latest check of any kind, freshness and counts of every posting.

    In this order: never-captured: there is no content; carried-forward-uncertain: the latest check could not tell;
    checked: the content is as recent as the latest check; carried-forward: a later check found no new content.
    """
    own = obs.where("availability = 'content_captured' AND identity = 'match'")
    content = latest(own, "posting_id").select("posting_id", F.col("version").alias("content_version"), F.col("lineage").alias("content_lineage"), F.col("observed_at").alias("content_at"))
    check = latest(obs, "posting_id").select("posting_id", F.col("availability").alias("last_availability"), F.col("observed_at").alias("checked_at"))
    counts = versions.groupBy("posting_id").agg(F.count("*").alias("version_count"))
    out = postings.join(content, "posting_id", "left").join(check, "posting_id", "left").join(counts, "posting_id", "left").join(last_listed(entries, runs), "posting_id", "left")
    uncertain = F.col("last_availability").isin("access_control_challenge", "retrieval_failed")
    fresh = F.when(F.col("content_at").isNull(), "never-captured").when(uncertain, "carried-forward-uncertain").when(F.col("content_at") == F.col("checked_at"), "checked").otherwise("carried-forward")
    return out.withColumn("freshness", fresh).withColumn("version_count", F.coalesce("version_count", F.lit(0))).withColumn("times_listed", F.coalesce("times_listed", F.lit(0)))


def posting_history(obs: DataFrame, postings: DataFrame, runs: DataFrame, versions: DataFrame) -> DataFrame:
    v = versions.select("posting_id", "lineage", "version", "first_seen")
    out = obs.join(postings.select("posting_id", "discovered_at"), "posting_id").join(runs.select("slot", "kind", "outcome"), "slot")
    return out.join(v, ["posting_id", "lineage", "version"], "left")


def listing_presence(runs: DataFrame, postings: DataFrame, entries: DataFrame) -> DataFrame:
    """Every posting that was known by then in every qualified run, and whether it was listed.

    The grid is runs by postings, which is what the result is. Each posting names the days from its discovery to the last run, and those are
    joined by key with the runs; a run may end on the day after its slot.
    """
    held = qualified_scans(runs).select("slot", "ended_at")
    known = postings.select("posting_id", "discovered_at").join(F.broadcast(held.agg(F.max("slot").alias("last"))))
    since = F.date_sub(F.to_date("discovered_at"), 2)
    days = known.where(since <= F.col("last")).select("posting_id", "discovered_at", F.explode(F.sequence(since, "last")).alias("slot"))
    grid = days.join(held, "slot").where("discovered_at <= ended_at")
    return grid.join(entries.select("slot", "posting_id", F.lit(True).alias("there")), ["slot", "posting_id"], "left").select("slot", "posting_id", F.coalesce("there", F.lit(False)).alias("listed"))


def run_health(runs: DataFrame, obs: DataFrame, entries: DataFrame, changes: DataFrame) -> DataFrame:
    states = obs.groupBy("slot").agg(*(F.count_if(F.col("availability") == s).alias(n) for s, n in (("content_captured", "n_captured"), ("retrieval_failed", "n_failed"), ("explicit_closure", "n_closed"), ("redirected_to_listing", "n_redirected"))), F.count_distinct("posting_id").alias("n_postings"))
    listed = entries.groupBy("slot").agg(F.count("*").alias("n_listed"))
    changed = changes.groupBy("slot").agg(F.count("*").alias("n_changed"))
    out = runs.select("slot", "kind", "outcome", "qualified")
    for part in (states, listed, changed):
        out = out.join(part, "slot", "left")
    return out.fillna(0, ["n_captured", "n_failed", "n_closed", "n_redirected", "n_postings", "n_listed", "n_changed"])


def content_changes(obs: DataFrame) -> DataFrame:
    """A change: a captured row whose version differs from the one before it in the same lineage of the same posting."""
    own = obs.where("availability = 'content_captured' AND identity = 'match'")
    w = Window.partitionBy("posting_id", "lineage").orderBy("observed_at", "observation_id")
    seen = own.withColumn("from_version", F.lag("version").over(w)).withColumn("interval_start", F.lag("observed_at").over(w))
    return seen.where("from_version <> version").select("observation_id", "posting_id", "lineage", "from_version", F.col("version").alias("to_version"), "interval_start", F.col("observed_at").alias("interval_end"), "slot")


def change_view(changes: DataFrame, versions: DataFrame, postings: DataFrame) -> DataFrame:
    v = versions.select("posting_id", "lineage", "version", "first_seen")
    a = v.withColumnRenamed("version", "from_version").withColumnRenamed("first_seen", "from_first_seen")
    b = v.withColumnRenamed("version", "to_version").withColumnRenamed("first_seen", "to_first_seen")
    return changes.join(postings.select("posting_id", "discovered_at"), "posting_id").join(a, ["posting_id", "lineage", "from_version"], "left").join(b, ["posting_id", "lineage", "to_version"], "left")


def pivot_fields(values: DataFrame, keys: list[str]) -> DataFrame:
    """One column a field: its value of the smallest ordinal."""
    return values.groupBy("entity_id").agg(*(F.min_by("value_text", F.when(F.col("field_key") == k, F.col("ordinal"))).alias(k) for k in keys))
