"""Traversals over landed pages: the order of a scan's pages by its links, and where and why each scan ends.

Pages come in any order and without numbers. A page's number is its distance from the scan's first page, found by pointer doubling:
each round joins what is reached with the links that are twice as long, so a chain of 1,000 pages takes ten rounds, whatever the
number of scans. Of many links, pages are first passed over: each round a quarter of them, no two in a row, so that all these rounds together join about four
times the links, however long the chains are; they are numbered from the pages before them at the end. Links may lead back, meet or lead nowhere; the smallest distance counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.stages import cut


#: With so many links or fewer none is passed over; doubling is quicker then.
FEW = 1 << 19


def _passed(links: DataFrame, k: int) -> DataFrame:
    """The links that are left when pages are passed over, with ``via`` and ``via_d``: the page that a link led to, and how far, if it was passed over.

    A page is passed over if its coin of round ``k`` is heads and that of the next page is tails, so never two in a row. First pages and those without onward links stay.
    """
    coin = lambda c: F.xxhash64(F.lit(k), "scan_id", c).bitwiseAND(1) == 1
    links = links.withColumn("over", coin("url") & ~coin("to") & ~F.col("first"))
    over = links.where("over").select("scan_id", F.col("url").alias("to"), F.col("to").alias("far"), F.col("d").alias("more"))
    via = F.when(F.col("far").isNotNull(), F.col("to"))
    out = links.where("not over").join(over, ["scan_id", "to"], "left")
    return out.select("scan_id", "url", F.coalesce("far", "to").alias("to"), (F.col("d") + F.coalesce("more", F.lit(0))).alias("d"), "first", via.alias("via"), F.col("d").alias("via_d"))


def numbered(pages: DataFrame, scans: DataFrame, most: int | None = None, few: int = FEW) -> DataFrame:
    """scan_id, url, page_number of the pages (scan_id, url, next_url; each url once in a scan) that the scans' (scan_id, start_url) links reach.

    ``most``: pages beyond this number are of no interest, which bounds the rounds. ``few``: pages are passed over while there are more links.
    """
    first = scans.select("scan_id", F.col("start_url").alias("url"), F.lit(1).cast("long").alias("page_number"))
    reached = cut(first.join(pages.select("scan_id", "url"), ["scan_id", "url"], "left_semi"))
    # links to pages that were never landed lead nowhere
    links = pages.where("next_url is not null").select("scan_id", "url", F.col("next_url").alias("to"))
    links = links.join(pages.select("scan_id", F.col("url").alias("to")), ["scan_id", "to"], "left_semi")
    starts = reached.select("scan_id", "url").distinct().withColumn("first", F.lit(True))
    links = cut(links.join(starts, ["scan_id", "url"], "left").select("scan_id", "url", "to", F.lit(1).cast("long").alias("d"), F.coalesce("first", F.lit(False)).alias("first")))
    passed, n, before = [], links.count(), None
    while n > few and (before is None or n < 0.95 * before):
        left = cut(_passed(links, len(passed)))
        passed.append(left.where("via is not null").select("scan_id", "url", F.col("via").alias("to"), F.col("via_d").alias("d")))
        # a link of a page to itself makes no number smaller
        links = left.where("url <> to").select("scan_id", "url", "to", "d", "first")
        before, n = n, links.count()
    jumps, stride = links.select("scan_id", "url", "to", "d"), 1
    size = F.struct(F.count("*"), F.sum("page_number"))
    have = reached.agg(size).first()
    while most is None or stride < most:
        reached = cut(_with_next(reached, jumps))
        before, have = have, reached.agg(size).first()
        if have == before:
            break
        onward = jumps.select("scan_id", F.col("url").alias("to"), F.col("to").alias("far"), F.col("d").alias("more"))
        jumps = cut(jumps.join(onward, ["scan_id", "to"]).select("scan_id", "url", F.col("far").alias("to"), (F.col("d") + F.col("more")).alias("d")))
        stride *= 2
    for level in reversed(passed):
        reached = cut(_with_next(reached, level))
    return reached if most is None else reached.where(F.col("page_number") <= most)


def _with_next(reached: DataFrame, links: DataFrame) -> DataFrame:
    """What is reached and what its links lead to, each page with its smallest number."""
    further = reached.join(links, ["scan_id", "url"]).select("scan_id", F.col("to").alias("url"), (F.col("page_number") + F.col("d")).alias("page_number"))
    return reached.union(further).groupBy("scan_id", "url").agg(F.min("page_number").alias("page_number"))


def walked(pages: DataFrame, scans: DataFrame) -> DataFrame:
    """The pages with page_number, place and ``end``.

    pages: scan_id, page_id, url, next_url, ok, recognized, empty_validated, signature, n_ids; scans: scan_id, start_url, bound. A url that a scan landed
    again is the page of smallest page_id; the others have the place ``again``. A page that no link leads to is an ``orphan``; one beyond the first that ends the
    walk is ``beyond``, the others are ``walked``. ``end`` says why the walk can't go on from a page: it failed, its structure is unknown, its content was there before or its link
    leads back, the bound is met, the next page is missing, or there is no next page, legitimately (rows, or a page that is empty as it should be) or not.
    """
    rank = F.row_number().over(Window.partitionBy("scan_id", "url").orderBy("page_id"))
    ranked = cut(pages.withColumn("rank", rank))
    own = ranked.where("rank = 1").drop("rank")
    bound = scans.agg(F.max("bound").alias("m")).first()["m"]
    numbers = cut(numbered(own, scans, (bound or 0) + 1))
    own = own.join(numbers, ["scan_id", "url"], "left").join(scans.select("scan_id", "bound"), "scan_id", "left")
    own = own.join(numbers.select("scan_id", F.col("url").alias("next_url"), F.col("page_number").alias("next_number")), ["scan_id", "next_url"], "left")
    same = F.when(F.col("page_number").isNotNull() & F.col("signature").isNotNull(), F.min("page_number").over(Window.partitionBy("scan_id", "signature")))
    n, onward = F.col("page_number"), F.col("next_url").isNotNull()
    end = (
        F.when(n.isNull(), None).when(~F.col("ok"), "fetch_failure").when(~F.col("recognized"), "structure_unrecognized").when(same < n, "loop_detected")
        .when(onward & (n >= F.col("bound")), "max_pages").when(onward & F.col("next_number").isNull(), "interrupted").when(onward & (F.col("next_number") <= n), "loop_detected")
        .when(onward, None).when(F.col("n_ids") > 0, "no_more_link").when(F.col("empty_validated"), "empty_validated_page").otherwise("structure_unrecognized")
    )
    own = own.withColumn("end", end)
    stops = own.where("end is not null").groupBy("scan_id").agg(F.min("page_number").alias("stop"))
    own = own.join(stops, "scan_id", "left")
    place = F.when(n.isNull(), "orphan").when(n > F.col("stop"), "beyond").otherwise("walked")
    columns = [*pages.columns, "page_number", "place", "end"]
    again = ranked.where("rank > 1").select(*pages.columns, F.lit(None).cast("long").alias("page_number"), F.lit("again").alias("place"), F.lit(None).cast("string").alias("end"))
    return own.withColumn("place", place).withColumn("end", F.when(n == F.col("stop"), F.col("end"))).select(*columns).union(again)


def walk_ends(walk: DataFrame, scans: DataFrame) -> DataFrame:
    """scan_id, pages, n_ids, end, last_url, n_beyond, n_orphans, n_again of each scan, from ``walked``; a scan whose first page is missing was interrupted before it began."""
    on = F.col("place") == "walked"
    last = F.when(F.col("end").isNotNull(), F.struct("end", "url"))
    out = walk.groupBy("scan_id").agg(
        F.count_if(on).alias("pages"), F.sum(F.when(on & F.col("ok"), F.col("n_ids"))).alias("n_ids"), F.max(last).alias("last"),
        *(F.count_if(F.col("place") == p).alias(f"n_{name}") for p, name in (("beyond", "beyond"), ("orphan", "orphans"), ("again", "again"))),
    )
    zero = F.lit(0).cast("long")
    out = scans.select("scan_id").join(out, "scan_id", "left")
    counts = [F.coalesce(c, zero).alias(c) for c in ("n_beyond", "n_orphans", "n_again")]
    return out.select("scan_id", F.coalesce("pages", zero).alias("pages"), F.coalesce("n_ids", zero).alias("n_ids"), F.coalesce("last.end", F.lit("interrupted")).alias("end"), F.col("last.url").alias("last_url"), *counts)
