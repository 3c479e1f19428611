"""Published versions, transactions, migrations, files and claims."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import counters as C
from tidemark.sources import files as Z
from tidemark.sources import versions as V


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}/tables"


def rows(spark, root, name, version=None):
    return sorted(tuple(r) for r in V.read(spark, root, version or V.current(spark, root), name).collect())


def numbers(spark, *values, name="a"):
    return spark.createDataFrame([(v,) for v in values], f"{name} long")


def test_versions_follow_each_other(spark, root):
    none = V.current(spark, root)
    assert none == V.Version()
    one = V.publish(spark, root, none, replaced={"t": numbers(spark, 1, 2)})
    two = V.publish(spark, root, one, added={"t": numbers(spark, 3)})
    three = V.publish(spark, root, two, replaced={"t": numbers(spark, 9)}, added={"u": numbers(spark, 7)})
    assert (rows(spark, root, "t", one), rows(spark, root, "t", two), rows(spark, root, "t"), rows(spark, root, "u")) == ([(1,), (2,)], [(1,), (2,), (3,)], [(9,)], [(7,)])
    assert V.current(spark, root) == three and three.number == 3 and V.unused(spark, root) == []


def test_the_second_writer_loses_and_leaves_nothing_to_see(spark, root):
    base = V.publish(spark, root, V.current(spark, root), replaced={"t": numbers(spark, 1)})
    V.publish(spark, root, base, added={"t": numbers(spark, 2)})
    with pytest.raises(V.Conflict):
        V.publish(spark, root, base, added={"t": numbers(spark, 3)})
    assert rows(spark, root, "t") == [(1,), (2,)] and len(V.unused(spark, root)) == 1


def test_transactions_publish_all_or_nothing(spark, root):
    with V.transaction(spark, root) as work:
        work.add("t", numbers(spark, 1))
        work.add("t", numbers(spark, 2))
        work.replace("u", numbers(spark, 5))
        assert sorted(r[0] for r in work.read("t").collect()) == [1, 2]
    assert work.version.number == 1 and rows(spark, root, "t") == [(1,), (2,)]
    with pytest.raises(KeyError), V.transaction(spark, root) as work:
        work.replace("t", numbers(spark, 8))
        raise KeyError("dies")
    with pytest.raises(V.Nested), V.transaction(spark, root), V.transaction(spark, root):
        pass
    with V.transaction(spark, root) as work:
        assert sorted(r[0] for r in work.read("t").collect()) == [1, 2]
    assert work.version.number == 1 and V.current(spark, root).number == 1


def test_a_version_that_is_being_written_is_not_seen(spark, root, tmp_path):
    V.publish(spark, root, V.current(spark, root), replaced={"t": numbers(spark, 1)})
    (tmp_path / "tables" / V.VERSIONS / "0000000002.json").write_text('{"tables": {"t"')
    assert V.current(spark, root).number == 1 and rows(spark, root, "t") == [(1,)]


STEPS = [
    ("1 people", lambda t: {"people": t["raw"].select("a", (F.col("a") * 10).alias("b"))}),
    ("2 pets", lambda t: {"pets": t["people"].select(F.col("a").alias("owner"))}),
    ("3 names", lambda t: {"people": t["people"].withColumn("name", F.concat(F.lit("n"), F.col("a").cast("string")))}),
]
RULES = {"unique": {"people": ["a"]}, "references": [V.Reference("pets", "owner", "people", "a")]}


def test_migrations_in_order_and_once(spark, root):
    V.publish(spark, root, V.current(spark, root), replaced={"raw": numbers(spark, 1, 2)})
    assert V.migrate(spark, root, STEPS[:1], **RULES) == ["1 people"]
    assert V.migrate(spark, root, STEPS, **RULES) == ["2 pets", "3 names"]
    assert rows(spark, root, "people") == [(1, 10, "n1"), (2, 20, "n2")] and V.current(spark, root).migrations == ("1 people", "2 pets", "3 names")
    assert V.migrate(spark, root, STEPS, **RULES) == [] and V.current(spark, root).number == 4
    with pytest.raises(V.Rejected, match="no beginning"):
        V.migrate(spark, root, STEPS[:2], **RULES)


def test_a_step_that_breaks_a_rule_or_dies_leaves_all_as_it_was(spark, root):
    V.publish(spark, root, V.current(spark, root), replaced={"raw": numbers(spark, 1, 2, 2)})
    with pytest.raises(V.Rejected, match="unique people"):
        V.migrate(spark, root, STEPS, **RULES)
    assert V.current(spark, root).migrations == ()
    V.publish(spark, root, V.current(spark, root), replaced={"raw": numbers(spark, 1, 2)})
    lost = [*STEPS[:2], ("3 fewer", lambda t: {"people": t["people"].where("a = 1")}), ("4 never", lambda t: {})]
    with pytest.raises(V.Rejected, match="pets.owner in people.a"):
        V.migrate(spark, root, lost, **RULES)
    assert V.current(spark, root).migrations == ("1 people", "2 pets") and rows(spark, root, "people") == [(1, 10), (2, 20)]

    def dies(t):
        raise OSError("crash")

    with pytest.raises(OSError):
        V.migrate(spark, root, [*STEPS[:2], ("3 dies", dies)], **RULES)
    assert V.migrate(spark, root, STEPS, **RULES) == ["3 names"]


# -- claims -----------------------------------------------------------------

QUEUE = "work_id long, priority long, state string, claimed_by string, leased_until timestamp_ntz"


def states(queue):
    return {r["work_id"]: (r["state"], r["claimed_by"]) for r in queue.collect()}


def test_leases_run_out_and_late_results_change_nothing(spark):
    queue = spark.createDataFrame([(k, k % 3, "pending", None, None) for k in range(6)], QUEUE)
    queue = C.claimed(queue, "a", "2026-01-01 10:00:00", 3)
    assert {k for k, s in states(queue).items() if s == ("claimed", "a")} == {0, 3, 1}
    queue = C.claimed(queue, "b", "2026-01-01 10:10:00", 9)
    assert sum(s == ("claimed", "b") for s in states(queue).values()) == 3
    assert states(C.claimed(queue, "c", "2026-01-01 10:29:59", 9)) == states(queue)
    late = C.claimed(queue, "c", "2026-01-01 10:30:00", 9)
    assert {k for k, s in states(late).items() if s == ("claimed", "c")} == {0, 3, 1}
    results = spark.createDataFrame([(0, True), (1, False), (2, True)], "work_id long, ok boolean")
    assert states(C.finished(late, "a", results, "2026-01-01 10:31:00")) == states(late)
    done = states(C.finished(late, "c", results, "2026-01-01 10:31:00"))
    assert (done[0], done[1], done[2][0], done[3]) == (("done", None), ("pending", None), "claimed", ("claimed", "c"))


def test_two_claimers_never_hold_one_work(spark, root):
    """Both begin from the same version; the one that publishes second has to look again."""
    queue = spark.createDataFrame([(k, 0, "pending", None, None) for k in range(4)], QUEUE)
    base = V.publish(spark, root, V.current(spark, root), replaced={"queue": queue})
    take = lambda version, worker: C.claimed(V.read(spark, root, version, "queue"), worker, "2026-01-01 10:00:00", 2)
    V.publish(spark, root, base, replaced={"queue": take(base, "a")})
    with pytest.raises(V.Conflict):
        V.publish(spark, root, base, replaced={"queue": take(base, "b")})
    base = V.current(spark, root)
    V.publish(spark, root, base, replaced={"queue": take(base, "b")})
    got = states(V.read(spark, root, V.current(spark, root), "queue"))
    assert got == {0: ("claimed", "a"), 1: ("claimed", "a"), 2: ("claimed", "b"), 3: ("claimed", "b")}


# -- files ------------------------------------------------------------------


def test_files_against_their_manifest(spark, tmp_path):
    top = tmp_path / "archive"
    (top / "x").mkdir(parents=True)
    for name, body in (("x/a", b"aaaa"), ("x/b", b"bbbb"), ("c", b"cccc"), ("d", b"dddd"), ("e", b"eeee"), ("f", b"")):
        (top / name).write_bytes(body)
    recorded = spark.createDataFrame(Z.file_manifest(spark, f"file://{top}").collect())
    before = Z.seal(recorded).first()
    assert (recorded.count(), before["n_files"], before["bytes"]) == (5, 5, 20) and {r["path"] for r in recorded.collect()} == {"x/a", "x/b", "c", "d", "e"}
    assert Z.file_differences(recorded, Z.file_manifest(spark, f"file://{top}")).count() == 0 and Z.seal(recorded.repartition(3)).first() == before
    (top / "x/a").write_bytes(b"aa")
    (top / "x/b").write_bytes(b"bbbX")
    (top / "c").unlink()
    (top / "d").write_bytes(b"ddddd")
    (top / "e").write_bytes(b"")
    (top / "new").write_bytes(b"n")
    found = Z.file_manifest(spark, str(top))
    assert {(r["path"], r["change"]) for r in Z.file_differences(recorded, found).collect()} == {("x/a", "cut"), ("x/b", "swapped"), ("c", "missing"), ("e", "missing"), ("d", "grown"), ("new", "added")}
    assert Z.seal(found).first()["digest"] != before["digest"]


# -- counters ---------------------------------------------------------------


def test_failures_are_capped_and_told(spark):
    obs = spark.range(1000).select(F.substring(F.col("id").cast("string"), 9, 1).alias("slot"), F.col("id").alias("observation_id"), F.col("id").alias("posting_id"), F.when(F.col("id") % 2 == 0, "content_captured").otherwise("not_found").alias("availability"))
    out = C.failures_of_runs(obs).first()
    assert (len(out["failures"]), out["failures"][0]["posting_id"], out["failures"][24]["posting_id"], out["n_failures"], out["n_more"]) == (25, 1, 49, 500, 475)
    plan = C.sampled(obs, "slot", [F.col("observation_id")], 25)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert C.failures_of_runs(obs.where("availability = 'content_captured'")).count() == 0


def test_counters_read_the_observations_once(spark, tmp_path):
    path = str(tmp_path / "obs")
    cols = "slot string, availability string, identity string, lineage string, version long, observed_at timestamp_ntz"
    spark.createDataFrame([], cols).write.parquet(path)
    cube = C.cube(spark.read.parquet(path))
    assert cube._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert C.failure_counters(cube).first()["faults"] == 0 and C.linked_outcomes(spark.createDataFrame([], "use_id long, run_id long, outcome string, detail string")).count() == 0
