"""Scan qualification from page facts, traversal folding, and comparison of the sets of two passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Legitimate ends of a traversal.
ENDS = ("no_more_link", "empty_validated_page")


def scan_facts(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """Facts of each scan from its pages and rows.

    pages: scan_id, page_number, requested_url, expected_url, ok, recognized, empty_validated, unresolved, signal, to_listing, status, signature, n_ids (different ones on the page), remaining
    (rows after this page as the source says, or null), next_url, bound; entries: scan_id, job_id, one for each row. The source's
    total is what it says is left after the first page and the ids of that page; it is held against different ids, never against rows.
    """
    facts = pages.groupBy("scan_id").agg(
        F.count("*").alias("pages"), F.count_if(~F.col("ok")).alias("failed"), F.count_if(~F.col("recognized")).alias("unrecognized"), F.sum("unresolved").alias("unresolved"),
        F.count_if(F.col("signal").isNotNull()).alias("challenged"), F.count_if(~F.col("to_listing")).alias("strayed"), F.count_if(F.col("status") != 200).alias("not_200"),
        (F.count("signature") - F.count_distinct("signature")).alias("repeats"), F.min_by(F.struct("requested_url", "expected_url", (F.col("remaining") + F.col("n_ids")).alias("total")), "page_number").alias("first"),
        F.max("bound").alias("bound"), F.max_by(F.struct("ok", "recognized", "n_ids", "next_url"), "page_number").alias("last"), F.coalesce(F.bool_or("empty_validated"), F.lit(False)).alias("empty_validated"),
    )
    seen = entries.groupBy("scan_id").agg(F.count("job_id").alias("occurrences"), F.count_distinct("job_id").alias("ids"))
    zero = F.lit(0).cast("long")
    facts = facts.join(seen, "scan_id", "left").withColumn("ids", F.coalesce("ids", zero)).withColumn("occurrences", F.coalesce("occurrences", zero))
    return facts.withColumn("duplicates", F.greatest(F.col("occurrences") - F.col("ids"), zero)).withColumn("total", F.col("first.total"))


def termination(facts: DataFrame) -> Column:
    last = F.col("last")
    return (
        F.when(F.col("pages") > F.col("bound"), "max_pages").when(~last["ok"], "fetch_failure").when(~last["recognized"] & (last["n_ids"] > 0), "structure_unrecognized")
        .when(F.col("repeats") > 0, "loop_detected").when(last["next_url"].isNotNull(), "interrupted").when((last["n_ids"] == 0) & last["recognized"], "empty_validated_page")
        .when(last["n_ids"] == 0, "structure_unrecognized").otherwise("no_more_link")
    )


def assess(facts: DataFrame) -> DataFrame:
    """checks (name, passed, detail; passed is null where a check does not apply), qualified and the reason. A check that does not apply never disqualifies."""
    f = facts.withColumn("end", termination(facts))
    told = lambda *names: F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    check = lambda name, passed, *names: F.struct(F.lit(name).alias("name"), passed.alias("passed"), told(*names).alias("detail"))
    checks = F.array(
        check("scope_unfiltered", F.col("first.requested_url").eqNullSafe(F.col("first.expected_url")), "first.requested_url", "first.expected_url"),
        check("structure_recognized", F.col("unrecognized") == 0, "unrecognized"), check("all_pages_retrieved", F.col("failed") == 0, "pages", "failed"),
        check("legitimate_termination", F.col("end").isin(*ENDS), "end"), check("no_unresolved_identity", F.col("unresolved") == 0, "unresolved"),
        check("no_access_control_response", F.col("challenged") == 0, "challenged"), check("no_unexpected_redirect", F.col("strayed") == 0, "strayed"),
        check("all_pages_http_200", F.col("not_200") == 0, "not_200"), check("within_page_bound", F.col("pages") < F.col("bound"), "pages", "bound"), check("no_pagination_loop", F.col("repeats") == 0, "repeats"),
        check("source_count_reconciles", F.when(F.col("total").isNotNull(), F.col("total") == F.col("ids")), "total", "ids"),
        check("empty_result_validated", F.when(F.col("ids") == 0, F.col("empty_validated")), "ids", "empty_validated"),
    )
    failing = F.transform(F.filter("checks", lambda c: ~c["passed"]), lambda c: F.concat(c["name"], F.lit(" failed")))
    return f.withColumn("checks", checks).select("scan_id", "pages", "occurrences", "ids", "duplicates", "total", "end", "checks", (F.size(failing) == 0).alias("qualified"), F.array_join(failing, "; ").alias("reason"))


def _sides(a: DataFrame, b: DataFrame, group: str, member: str) -> DataFrame:
    """Each member of a group with the sides that have it: 1, 2 or 3 for both."""
    sides = a.select(group, member).distinct().withColumn("x", F.lit(1)).union(b.select(group, member).distinct().withColumn("x", F.lit(2)))
    return sides.groupBy(group, member).agg(F.sum("x").alias("x"))


def compare_sets(a: DataFrame, b: DataFrame, group: str, member: str) -> DataFrame:
    """Per group: sizes, how many appeared and disappeared, whether the sets match and whether only their counts do. The members are those of set_differences."""
    out = _sides(a, b, group, member).groupBy(group).agg(
        F.count_if(F.col("x").isin(1, 3)).alias("n_first"), F.count_if(F.col("x").isin(2, 3)).alias("n_second"), F.count("*").alias("n_union"),
        F.count_if(F.col("x") == 2).alias("n_appeared"), F.count_if(F.col("x") == 1).alias("n_disappeared"),
    )
    return out.withColumn("sets_match", (F.col("n_appeared") == 0) & (F.col("n_disappeared") == 0)).withColumn("counts_match", F.col("n_first") == F.col("n_second"))


def set_differences(a: DataFrame, b: DataFrame, group: str, member: str) -> DataFrame:
    """A row for each member of one side only: group, member, change (appeared in b, disappeared from a)."""
    return _sides(a, b, group, member).where("x < 3").select(group, member, F.when(F.col("x") == 2, "appeared").otherwise("disappeared").alias("change"))


def reconciled(first: DataFrame, second: DataFrame, third: DataFrame, qualified: DataFrame, group: str, member: str) -> DataFrame:
    """Per group of the third pass: which of the two others it has the same set as, and whether that settles the matter.

    ``qualified``: group, qualified (of the third pass). To qualify is not to agree: a third pass with a third set has settled nothing.
    """
    agrees = lambda side, name: compare_sets(side, third, group, member).select(group, F.col("sets_match").alias(name))
    out = qualified.join(agrees(first, "with_first"), group, "left").join(agrees(second, "with_second"), group, "left")
    a, b = F.coalesce("with_first", F.lit(False)), F.coalesce("with_second", F.lit(False))
    names = F.array_compact(F.array(F.when(a, "discovery"), F.when(b, "verification")))
    return out.select(group, F.array_join(names, ",").alias("agrees_with"), (F.col("qualified") & (a | b)).alias("reconciled"))


def rotation(snapshots: DataFrame, daily: int = 7, weekly: int = 4, monthly: int = 12) -> DataFrame:
    """Which snapshots (source, taken, verified) are kept and why: newest verified, newest ``daily``, first of each ISO week and of each month.

    Ranks are per source, newest first. Nothing is pruned while at most one snapshot of the source is verified.
    """
    newest = Window.partitionBy("source").orderBy(F.desc("taken"))
    week = F.concat_ws("-", F.extract(F.lit("YEAROFWEEK"), "taken").cast("string"), F.weekofyear("taken").cast("string"))
    s = snapshots.withColumn("week", week).withColumn("month", F.date_format("taken", "yyyy-MM"))
    s = s.withColumn("rank", F.row_number().over(newest))
    s = s.withColumn("in_week", F.row_number().over(Window.partitionBy("source", "week").orderBy(F.desc("taken")))).withColumn("in_month", F.row_number().over(Window.partitionBy("source", "month").orderBy(F.desc("taken"))))
    s = s.withColumn("week_rank", F.sum((F.col("in_week") == 1).cast("int")).over(newest)).withColumn("month_rank", F.sum((F.col("in_month") == 1).cast("int")).over(newest))
    whole = Window.partitionBy("source")
    s = s.withColumn("n_verified", F.count_if("verified").over(whole)).withColumn("newest_verified", F.max(F.when(F.col("verified"), F.col("taken"))).over(whole))
    why = (
        F.when(F.col("verified") & (F.col("taken") == F.col("newest_verified")), "newest_verified").when(F.col("rank") <= daily, "daily")
        .when((F.col("in_week") == 1) & (F.col("week_rank") <= weekly), "weekly").when((F.col("in_month") == 1) & (F.col("month_rank") <= monthly), "monthly")
        .when(F.col("n_verified") <= 1, "only_verified").otherwise("prune")
    )
    return s.select("source", "taken", "verified", why.alias("decision"))
