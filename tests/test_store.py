from __future__ import annotations

import stat

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import Contracts
from tidemark.operators import export as X
from tidemark.sources import store
from tidemark.streaming import feed


def test_payloads_fold_together(spark):
    p = spark.createDataFrame([("a",), ("a",), ("b",)], "body string")
    archive = store.addressed(p)
    assert archive.count() == 2 and store.damaged(archive).count() == 0
    assert store.land(spark.createDataFrame([("b",), ("c",)], "body string"), archive).count() == 1
    assert store.damaged(archive.withColumn("body", F.lit("x").cast("binary"))).count() == 2


def test_store_round_trip(spark, tmp_path):
    tables = {"t": spark.range(5).toDF("k"), "u": spark.range(2).toDF("k")}
    store.write_tables(tables, f"file://{tmp_path}/s")
    back = store.open_tables(spark, f"file://{tmp_path}/s")
    checks = store.restore_check(store.manifest(tables), store.manifest(back)).collect()
    assert len(checks) == 2 and all(r["same_rows"] and r["same_digest"] for r in checks)
    assert not store.restore_check(store.manifest(tables), store.manifest({"t": spark.range(4).toDF("k")})).where("table = 't'").first()["same_rows"]


def test_config(tmp_path):
    (tmp_path / "c.toml").write_text('zone = "UTC"\n')
    assert store.load_config(str(tmp_path / "c.toml")).zone == "UTC"
    (tmp_path / "d.toml").write_text("zome = 1\n")
    with pytest.raises(ValueError, match="zome"):
        store.load_config(str(tmp_path / "d.toml"))


def test_atomic_file(tmp_path):
    store.write_atomic(str(tmp_path / "x.json"), {"a": 1})
    assert stat.S_IMODE((tmp_path / "x.json").stat().st_mode) == 0o600 and len(list(tmp_path.iterdir())) == 1


def test_journal(spark, tmp_path):
    (tmp_path / "j.jsonl").write_text('{"at": "1", "kind": "k"}\nnot json\n{"at": "2", "kind": "k"}\n')
    assert [r["at"] for r in store.read_journal(spark, f"file://{tmp_path}/j.jsonl").collect()] == ["2", "1"]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "=x"), (2, None)], "posting_id long, note string")
    X.write_csv(df, f"file://{tmp_path}/c")
    assert any("'=x" in p.read_text() for p in (tmp_path / "c").glob("*.csv"))
    X.write_json(df, f"file://{tmp_path}/j")
    assert spark.read.json(f"file://{tmp_path}/j").count() == 2
    frames = {"postings": lambda: df, "runs": lambda: df}
    assert X.dataset(frames, "postings", ["posting_id"], posting=2).count() == 1
    with pytest.raises(ValueError, match="filtered"):
        X.dataset(frames, "runs", ["posting_id"], posting=2)
    assert X.provenance("postings", 2, Contracts(), "2024-01-01")["contracts"]["parser"]


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(20).selectExpr("id % 10 AS observation_id", "id % 3 AS posting_id", "timestamp_seconds(1700000000 + (id % 10) * 600) AS observed_at", "IF(id % 2 = 0, 'a', 'b') AS availability")
    rows.write.parquet(f"{tmp_path}/in")
    s = feed.observation_stream(spark, f"{tmp_path}/in", "observation_id long, posting_id long, observed_at timestamp, availability string")
    q = feed.latest_state(feed.without_duplicates(s)).writeStream.outputMode("update").format("memory").queryName("latest").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["posting_id"]: r["checked_at"] for r in spark.table("latest").collect()}
    want = {r["posting_id"]: r["checked_at"] for r in rows.groupBy("posting_id").agg(F.max("observed_at").alias("checked_at")).collect()}
    assert set(got) == set(want)
