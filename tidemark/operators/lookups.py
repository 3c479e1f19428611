"""Joins, lists and counts between runs, observations, extractions and identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lifecycle import availability


def listing_inputs(pages: DataFrame, fetches: DataFrame, payloads: DataFrame) -> DataFrame:
    """scan_id, page_number, sha256, byte_length of every listing page whose fetch has an archived body: what a new reading of listings reads."""
    found = pages.select("scan_id", "page_number", "fetch_id").join(fetches.select("fetch_id", "sha256"), "fetch_id")
    return found.join(payloads.select("sha256", "byte_length"), "sha256").select("scan_id", "page_number", "sha256", "byte_length")


def scan_results(asked: DataFrame, scans: DataFrame, walls: DataFrame, key: list[str]) -> DataFrame:
    """What was asked for with its scan; null and an error where the source's challenge ended it or nothing came of it. One scan's end does not end the run."""
    out = asked.join(scans.withColumn("there", F.lit(True)), key, "left").join(walls.select(*key, F.lit("challenge_wall").alias("wall")).distinct(), key, "left")
    return out.withColumn("error", F.when(F.col("there").isNull(), F.coalesce("wall", F.lit("no_scan")))).drop("there", "wall")


def known_entries(entries: DataFrame, postings: DataFrame) -> DataFrame:
    """The rows of listings (job_id) with the posting they are of; null for an id that is not registered."""
    return entries.join(postings.select("job_id", "posting_id"), "job_id", "left")


def identities(postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """The postings of the wanted ids (job_id), null where there is none."""
    return wanted.select("job_id").distinct().join(postings, "job_id", "left")


def run_observations(observations: DataFrame, postings: DataFrame, run: Column) -> DataFrame:
    """The checks of a run on registered postings, in their order: what its recheck policy is made from."""
    own = observations.where(F.col("run_id") == run)
    return own.join(postings.select("posting_id", "job_id"), "posting_id").orderBy("observation_id")


def observation_rows(checks: DataFrame) -> DataFrame:
    """Observations from checks (signal, ok, status, redirect, expected_id, shown_id, body, closure and what else they carry): identity and availability by the rules."""
    found = availability(*(F.col(c) for c in ("signal", "ok", "status", "redirect", "expected_id", "shown_id", "body", "closure")))
    rest = [c for c in checks.columns if c not in ("signal", "ok", "body", "closure")]
    return checks.select(*rest, found.alias("a")).select(*rest, "a.identity", "a.availability")


def of_lineage(rows: DataFrame, lineage: str) -> DataFrame:
    """Rows of the lineage; those without one were read before lineages were written down and count as the current one."""
    return rows.where(F.coalesce("lineage", F.lit(lineage)) == lineage)


def extraction_statistics(extractions: DataFrame) -> DataFrame:
    """Extractions by kind, parser and status, and their errors."""
    return extractions.groupBy("kind", "parser", "status").agg(F.count("*").alias("n"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"))


def extraction_links(extractions: DataFrame) -> DataFrame:
    """A row for each address of an extraction (extraction_id, links: array of structs with parent_kind, url_raw, position): the first of each in each scope."""
    each = extractions.select("extraction_id", F.explode("links").alias("l"))
    first = each.groupBy("extraction_id", F.col("l.parent_kind").alias("parent_kind"), F.col("l.url_raw").alias("url_raw")).agg(F.min_by("l", F.col("l.position")).alias("l"))
    rest = [c for c in extractions.schema["links"].dataType.elementType.names if c not in ("parent_kind", "url_raw")]
    return first.select("extraction_id", "parent_kind", "url_raw", *(F.col("l").getField(c).alias(c) for c in rest))


def broken_rules(rows: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Rows that break a conditional rule (where the first holds, the second must), with the names of the rules; what is unknown breaks none."""
    broken = F.array_compact(F.array(*(F.when(F.coalesce(when & ~must, F.lit(False)), F.lit(name)) for name, (when, must) in rules.items())))
    return rows.withColumn("broken", broken).where(F.size("broken") > 0)


def slot_has_passed(local: Column, hour: int, minute: int) -> Column:
    """Whether the slot of the day has begun at a local wall time."""
    return F.hour(local) * 60 + F.minute(local) >= hour * 60 + minute


def pending_migrations(known: DataFrame, applied: DataFrame) -> DataFrame:
    """Known migrations (version, name) that are not applied, in their order; an applied one of another name is an error to show, not to run."""
    a = applied.select("version", F.col("name").alias("applied_name"))
    out = known.join(a, "version", "left").where("applied_name IS NULL OR applied_name <> name")
    return out.select("version", "name", F.when(F.col("applied_name").isNull(), "pending").otherwise("conflict").alias("state")).orderBy("version")
