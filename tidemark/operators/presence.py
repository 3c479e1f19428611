"""Presence: events with their interval of uncertainty, the two-day absence rule, coverage, recheck policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _disputed(grid: DataFrame, seen: DataFrame) -> DataFrame:
    """The grid, with ``elsewhere``: not listed by the pass that absence is read from, but by another qualified one of the same run."""
    there = seen.select("slot", "posting_id", F.lit(True).alias("there")).distinct()
    return grid.join(there, ["slot", "posting_id"], "left").withColumn("elsewhere", ~F.col("listed") & F.coalesce("there", F.lit(False))).drop("there")


def disagreement_gaps(grid: DataFrame, seen: DataFrame) -> DataFrame:
    """slot, posting_id, gap_kind of the absences that another qualified pass of the run contradicts."""
    return _disputed(grid, seen).where("elsewhere").select("slot", "posting_id", F.lit("listing_disagreement_within_run").alias("gap_kind"))


def presence_events(grid: DataFrame, runs: DataFrame, postings: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """slot, posting_id, event_kind, interval_start, interval_end, from the grid of qualified runs.

    A listed posting is ``listed``, and besides ``first_observed`` in the run of its discovery or ``reappeared`` if it was
    absent in the qualified run before; else it is ``absent_qualified``, since it was last listed. Only qualified runs take part,
    so an unqualified one is never evidence of absence. What another qualified pass of the same run lists (``seen``: slot, posting_id) is no
    absence either: no event is made of it, and it is a gap (disagreement_gaps).
    """
    bounds = runs.select("slot", "started_at", "ended_at")
    if seen is not None:
        grid = _disputed(grid, seen).where("not elsewhere").drop("elsewhere")
    g = grid.join(bounds, "slot").join(postings.select("posting_id", "discovered_at"), "posting_id")
    return _events(g, {"was": F.lit(None), "last_listed": F.lit(None), "last_absent": F.lit(None)})


def _events(g: DataFrame, earlier: dict[str, Column]) -> DataFrame:
    """The events of grid rows with their runs' bounds; ``earlier``: what was known of the posting before its first row."""
    w = Window.partitionBy("posting_id").orderBy("slot")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    listed = F.col("listed")
    known = {
        "was": F.lag("listed").over(w), "last_listed": F.max(F.when(listed, F.col("ended_at"))).over(before), "last_absent": F.max(F.when(~listed, F.col("ended_at"))).over(before),
    }
    g = g.select("slot", "posting_id", "listed", "started_at", "ended_at", "discovered_at", *(F.coalesce(c, earlier[name]).alias(name) for name, c in known.items()))
    first = F.col("discovered_at").between(F.col("started_at"), F.col("ended_at"))
    event = lambda kind, start, when: F.when(when, F.struct(F.lit(kind).alias("event_kind"), start.alias("interval_start")))
    none = F.lit(None).cast("timestamp_ntz")
    kinds = F.array_compact(F.array(
        event("first_observed", none, listed & first), event("listed", F.col("last_listed"), listed),
        event("reappeared", F.col("last_absent"), listed & ~first & ~F.coalesce("was", F.lit(True))), event("absent_qualified", F.col("last_listed"), ~listed),
    ))
    return g.select("slot", "posting_id", F.explode(kinds).alias("e"), F.col("ended_at").alias("interval_end")).select("slot", "posting_id", "e.event_kind", "e.interval_start", "interval_end")


def presence_state(grid: DataFrame, runs: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """What later runs need to know of each posting: posting_id, last_slot, was (listed in its last qualified run), last_listed, last_absent.

    ``state``: that of the runs before those of the grid. A posting that the grid has no row of keeps its state.
    """
    listed = F.col("listed")
    new = grid.join(runs.select("slot", "ended_at"), "slot").groupBy("posting_id").agg(
        F.max("slot").alias("last_slot"), F.max_by("listed", "slot").alias("was"), F.max(F.when(listed, F.col("ended_at"))).alias("last_listed"), F.max(F.when(~listed, F.col("ended_at"))).alias("last_absent"),
    )
    if state is None:
        return new
    old = state.select(*(F.col(c).alias(c if c == "posting_id" else f"old_{c}") for c in state.columns))
    return old.join(new, "posting_id", "full_outer").select("posting_id", *(F.coalesce(c, f"old_{c}").alias(c) for c in state.columns if c != "posting_id"))


def later_runs(runs: DataFrame, state: DataFrame) -> DataFrame:
    """The qualified runs after all that the state has taken in."""
    last = state.agg(F.max("last_slot").alias("last"))
    return runs.where("qualified").join(F.broadcast(last)).where(F.col("last").isNull() | (F.col("slot") > F.col("last"))).drop("last")


def late_runs(runs: DataFrame, state: DataFrame, taken: DataFrame) -> DataFrame:
    """Qualified runs that came after later ones were taken in (``taken``: slot): their events would change those that are there, so the state from before them has to be gone on from."""
    last = state.agg(F.max("last_slot").alias("last"))
    return runs.where("qualified").join(F.broadcast(last)).where(F.col("slot") <= F.col("last")).drop("last").join(taken.select("slot"), "slot", "left_anti")


def later_events(grid: DataFrame, runs: DataFrame, postings: DataFrame, state: DataFrame) -> DataFrame:
    """presence_events of the grid of later runs, from the state instead of the runs before them: the same rows as of the whole grid, whatever the runs are cut into.

    Rows of runs that the state has taken in already give no events, so a replay adds nothing.
    """
    g = grid.join(runs.select("slot", "started_at", "ended_at"), "slot").join(postings.select("posting_id", "discovered_at"), "posting_id")
    old = state.select("posting_id", *(F.col(c).alias(f"old_{c}") for c in ("last_slot", "was", "last_listed", "last_absent")))
    g = g.join(old, "posting_id", "left").where(F.col("old_last_slot").isNull() | (F.col("slot") > F.col("old_last_slot")))
    return _events(g, {c: F.col(f"old_{c}") for c in ("was", "last_listed", "last_absent")})


def repeatedly_unlisted(grid: DataFrame, days: int = 2) -> DataFrame:
    """Since each posting was last listed: the distinct days of qualified absence, the rule, and the days between without a qualified run."""
    w = Window.partitionBy("posting_id")
    g = grid.withColumn("last", F.max(F.when(F.col("listed"), F.col("slot"))).over(w)).where(~F.col("listed") & (F.col("last").isNull() | (F.col("slot") > F.col("last"))))
    out = g.groupBy("posting_id").agg(F.count_distinct("slot").alias("absent_days"), F.min("slot").alias("first_absent"), F.max("slot").alias("last_absent"))
    between = F.date_diff("last_absent", "first_absent") + 1 - F.col("absent_days")
    return out.select("posting_id", "absent_days", "first_absent", "last_absent", (F.col("absent_days") >= days).alias("rule_met"), between.cast("long").alias("uncovered_days"))


def coverage_gaps(runs: DataFrame) -> DataFrame:
    """Runs without a qualified scan: no statement on presence is made for them."""
    return runs.where(~F.col("qualified")).select("slot", F.lit("no_qualified_scan").alias("gap_kind"), F.format_string("%d of %d pages failed", "failed", "pages").alias("detail"))


def coverage_window(runs: DataFrame, keep: int = 30) -> DataFrame:
    """First and last covered day, covered and missed days, and the last ``keep`` missed ones."""
    days = runs.where("qualified").select("slot").distinct()
    span = days.agg(F.min("slot").alias("first_day"), F.max("slot").alias("last_day"), F.count("*").alias("covered"))
    calendar = span.select(F.explode(F.sequence("first_day", "last_day")).alias("slot"))
    missed = calendar.join(days, "slot", "left_anti").agg(F.count("*").alias("missed"), F.sort_array(F.collect_list(F.col("slot").cast("string"))).alias("d"))
    return span.join(missed).select("first_day", "last_day", "covered", "missed", F.array_join(F.slice("d", F.greatest(F.size("d") - keep + 1, F.lit(1)), F.lit(keep)), ",").alias("missed_days"))


def recheck_policy(obs: DataFrame, listed: DataFrame, weekly_after: int = 3) -> DataFrame:
    """Per posting, its streak of terminal checks and its tier.

    In order of time: a listed or captured check ends a streak, a terminal one lengthens it, any other leaves it as it is. So the streak is the number
    of terminal checks since the last reset: an aggregation, not a fold. The weekly tier is due seven days after the last terminal check.
    """
    o = obs.join(listed.select("slot", "posting_id", F.lit(True).alias("on_list")), ["slot", "posting_id"], "left")
    reset = F.coalesce("on_list", F.lit(False)) | (F.col("availability") == "content_captured")
    w = Window.partitionBy("posting_id").orderBy("observed_at", "observation_id")
    o = o.withColumn("island", F.count_if(reset).over(w))
    terminal = F.col("availability").isin("explicit_closure", "redirected_to_listing", "not_found") & ~reset
    islands = o.groupBy("posting_id", "island").agg(F.count_if(terminal).alias("streak"), F.max(F.when(terminal, F.col("observed_at"))).alias("latest"))
    last = islands.groupBy("posting_id").agg(F.max_by(F.struct("streak", "latest"), "island").alias("l"))
    weekly = F.col("l.streak") >= weekly_after
    return last.select("posting_id", F.col("l.streak").alias("streak"), F.when(weekly, "weekly").otherwise("daily").alias("tier"), F.when(weekly, F.col("l.latest") + F.make_dt_interval(F.lit(7))).alias("next_due"))
