"""Evidence frames from the star-schema and event tables, so that every derivation can run on them.

Rules, the same in SQL (see ``OBS``): an observation is an event, cut to seconds; its availability follows the event
type; ids divisible by 17 are mismatches; captured rows have version k % 4 of the event's properties, in the lineage
1.0.0 or, for the last two of every ten ids, 1.1.0; a run is a local date of New York.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import local_date, to_second

STATES = {"view": "content_captured", "purchase": "content_captured", "click": "redirected_to_listing", "signup": "explicit_closure", "error": "retrieval_failed"}
MOST_FAILED = 0.20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    state = F.create_map(*(F.lit(x) for kv in STATES.items() for x in kv))
    captured = F.col("event_type").isin("view", "purchase")
    return e.select(
        F.col("event_id").alias("observation_id"),
        F.col("user_id").alias("posting_id"),
        to_second("ts").alias("observed_at"),
        F.try_element_at(state, F.col("event_type")).alias("availability"),
        F.when(F.col("event_id") % 17 == 0, "mismatch").otherwise("match").alias("identity"),
        F.when(F.col("event_id") % 10 < 8, "1.0.0").otherwise("1.1.0").alias("lineage"),
        F.when(captured, F.get_json_object("props", "$.k").cast("long") % 4).alias("version"),
        local_date("ts").alias("slot"),
        F.col("value").alias("weight"),
    )


OBS = """obs AS (SELECT event_id AS observation_id, user_id AS posting_id, date_trunc('second', ts) AS observed_at,
  CASE event_type WHEN 'view' THEN 'content_captured' WHEN 'purchase' THEN 'content_captured' WHEN 'click' THEN 'redirected_to_listing' WHEN 'signup' THEN 'explicit_closure' WHEN 'error' THEN 'retrieval_failed' END AS availability,
  CASE WHEN event_id % 17 = 0 THEN 'mismatch' ELSE 'match' END AS identity,
  CASE WHEN event_id % 10 < 8 THEN '1.0.0' ELSE '1.1.0' END AS lineage,
  CASE WHEN event_type IN ('view', 'purchase') THEN CAST(json_extract(props, '$.k') AS BIGINT) % 4 END AS version,
  CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS slot, value AS weight FROM events)"""


def runs(obs: DataFrame) -> DataFrame:
    """One run for each slot: its bounds, scan counts, outcome and kind; every seventh day of the month is a retry."""
    failed = F.col("availability") == "retrieval_failed"
    r = obs.groupBy("slot").agg(
        F.min("observed_at").alias("started_at"), F.max("observed_at").alias("ended_at"), F.count("*").alias("pages"), F.count_if(failed).alias("failed"),
        F.count_if(F.col("availability") == "content_captured").alias("captured"), F.count_if(F.col("identity") == "mismatch").alias("mismatches"),
    )
    share = F.col("failed") / F.col("pages")
    return r.select(
        "*", (share <= MOST_FAILED).alias("qualified"),
        F.when(share <= MOST_FAILED, "success").when(share <= 0.25, "partial").otherwise("failed").alias("outcome"),
        F.when(F.day("slot") % 7 == 0, "retry").otherwise("daily").alias("kind"),
    )


RUNS = """runs AS (SELECT *, failed * 1.0 / pages <= 0.20 AS qualified,
  CASE WHEN failed * 1.0 / pages <= 0.20 THEN 'success' WHEN failed * 1.0 / pages <= 0.25 THEN 'partial' ELSE 'failed' END AS outcome,
  CASE WHEN day(slot) % 7 = 0 THEN 'retry' ELSE 'daily' END AS kind
  FROM (SELECT slot, min(observed_at) AS started_at, max(observed_at) AS ended_at, count(*) AS pages, count(*) FILTER (availability = 'retrieval_failed') AS failed,
    count(*) FILTER (availability = 'content_captured') AS captured, count(*) FILTER (identity = 'mismatch') AS mismatches FROM obs GROUP BY slot))"""


def entries(obs: DataFrame) -> DataFrame:
    """What a run's listing names: distinct postings captured in its slot."""
    return obs.where("availability = 'content_captured'").groupBy("slot", "posting_id").agg(F.min("observed_at").alias("seen_at"), F.count("*").alias("occurrences"))


ENTRIES = "entries AS (SELECT slot, posting_id, min(observed_at) AS seen_at, count(*) AS occurrences FROM obs WHERE availability = 'content_captured' GROUP BY 1, 2)"


def postings(obs: DataFrame) -> DataFrame:
    """Identities with their first sighting: the earliest observation, of equal times the smallest id."""
    return obs.groupBy("posting_id").agg(F.min(F.struct("observed_at", "observation_id")).alias("f"), F.count("*").alias("observations")).select("posting_id", F.col("f.observed_at").alias("discovered_at"), F.col("f.observation_id").alias("discovered_by"), "observations")


POSTINGS = "postings AS (SELECT posting_id, min(observed_at) AS discovered_at, arg_min(observation_id, (observed_at, observation_id)) AS discovered_by, count(*) AS observations FROM obs GROUP BY 1)"


def versions(obs: DataFrame) -> DataFrame:
    """Distinct interpretations: posting, lineage and version, from captured rows of the right identity."""
    own = obs.where("availability = 'content_captured' AND identity = 'match'")
    return own.groupBy("posting_id", "lineage", "version").agg(F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen"), F.count("*").alias("observed"))


VERSIONS = "versions AS (SELECT posting_id, lineage, version, min(observed_at) AS first_seen, max(observed_at) AS last_seen, count(*) AS observed FROM obs WHERE availability = 'content_captured' AND identity = 'match' GROUP BY 1, 2, 3)"
ALL = f"WITH {OBS}, {RUNS}, {ENTRIES}, {POSTINGS}, {VERSIONS}"
