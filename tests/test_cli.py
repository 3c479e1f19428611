"""The command line over a store that is made of the test tables' evidence frames."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.plans.evidence import Evidence
from tidemark.sources import store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    e = Evidence(spark, SF)
    path = f"file://{tmp_path_factory.mktemp('store')}/s"
    store.snapshot({"observations": e.obs, "runs": e.runs, "entries": e.entries, "postings": e.postings, "versions": e.versions}, path)
    return path


def call(spark, capsys, *argv):
    code = cli.main(list(argv), spark)
    return code, capsys.readouterr().out


def test_reports(spark, data, capsys):
    code, out = call(spark, capsys, "--data", data, "runs", "--json", "--limit", "3")
    slots = [r["slot"] for r in json.loads(out)]
    assert code == 0 and len(slots) == 3 and slots == sorted(slots, reverse=True)
    code, out = call(spark, capsys, "show", "7", "--data", data, "--json")
    assert code == 0 and json.loads(out)[0]["posting_id"] == 7
    assert call(spark, capsys, "show", "999999", "--data", data)[0] == 1
    code, out = call(spark, capsys, "--json", "history", "7", "--data", data)
    assert code == 0 and 0 < len(json.loads(out)) <= cli.LIMIT
    assert "---" in call(spark, capsys, "diff", "7", "--data", data)[1]
    assert call(spark, capsys, "status", "--data", data, "--as-of", "2030-01-01")[1].startswith("summary=Collection is stale")


def test_health_and_its_spelling(spark, data, capsys):
    a = call(spark, capsys, "health", "--data", data, "--as-of", "2030-01-01")
    assert a == call(spark, capsys, "--health", "--data", data, "--as-of", "2030-01-01") and a[0] == 1
    assert json.loads(a[1])["collection"]["state"] == "STALE"


def test_export_verify_and_restore(spark, data, capsys, tmp_path):
    code, out = call(spark, capsys, "export", "current", "--posting", "7", "--data", data)
    assert code == 0 and len(json.loads(out)) == 1
    assert call(spark, capsys, "export", "postings", "--format", "csv", "--limit", "2", "--data", data)[1].count("\n") == 3
    assert call(spark, capsys, "export", "runs", "--output", f"file://{tmp_path}/x", "--data", data)[0] == 0
    assert json.loads(spark.read.text(f"file://{tmp_path}/x/_provenance").first()[0])["dataset"] == "runs"
    assert call(spark, capsys, "export", "nothing", "--data", data)[0] == cli.USAGE and call(spark, capsys, "export", "runs", "--posting", "1", "--data", data)[0] == cli.USAGE and call(spark, capsys, "runs")[0] == cli.USAGE
    assert call(spark, capsys, "verify", "--data", data)[0] == 0
    assert call(spark, capsys, "backup", f"file://{tmp_path}/b", "--data", data)[0] == 0
    assert call(spark, capsys, "restore", f"file://{tmp_path}/r", "--data", f"file://{tmp_path}/b")[0] == 0
    assert call(spark, capsys, "verify", "--data", f"file://{tmp_path}/r")[0] == 0
    code, out = call(spark, capsys, "diagnostics", "--data", data)
    assert json.loads(out)["tables"]["postings"] > 0
    assert call(spark, capsys, "diagnostics", "--output", f"{tmp_path}/d.json", "--data", data)[0] == 0 and json.loads((tmp_path / "d.json").read_text())["outcomes"]
    assert call(spark, capsys, "notify", "--data", data)[0] == 0


def test_damage_is_seen(spark, data, tmp_path):
    t = store.open_tables(spark, data)
    checks = lambda **other: {r["name"] for r in store.self_check(t | other).where("not passed").collect()}
    assert checks() == set()
    assert checks(postings=t["postings"].where("posting_id > 3")) == {"references:observations", "references:versions"}
    assert checks(postings=t["postings"].union(t["postings"].limit(1))) == {"keys:postings"}
    bad = store.addressed(spark.createDataFrame([("a",)], "body string")).withColumn("byte_length", F.lit(7).cast("long"))
    assert checks(payloads=bad) == {"payloads"}
    store.snapshot({"t": spark.range(3).toDF("k")}, f"file://{tmp_path}/s")
    spark.range(2).toDF("k").write.mode("overwrite").parquet(f"file://{tmp_path}/s/t")
    with_detail = store.restore_check(spark.read.schema("table string, rows long, digest string").json(f"file://{tmp_path}/s/_manifest"), store.manifest(store.open_tables(spark, f"file://{tmp_path}/s")))
    assert not with_detail.first()["same_rows"]


def test_config_hash():
    assert store.config_hash(store.Config()) == store.config_hash(store.Config()) != store.config_hash(store.Config(zone="UTC"))


def test_retry_failures_and_reprocessing(spark, data, capsys, tmp_path):
    slots = sorted(str(r["slot"]) for r in spark.read.parquet(f"{data}/runs").collect())
    code, out = call(spark, capsys, "retry", "--data", data, "--as-of", "2030-01-01", "--json")
    assert code == 0 and json.loads(out)[0]["decision"] == "no_run"
    code, out = call(spark, capsys, "retry", "--data", data, "--as-of", slots[-1], "--json")
    assert json.loads(out)[0]["decision"] in ("done", "retry", "exhausted") and code in (0, 2)
    code, out = call(spark, capsys, "failures", "--data", data, "--most", "2", "--limit", "3", "--json")
    rows = json.loads(out)
    assert code == 0 and len(rows) == 3 and all(len(r["failures"]) <= 2 and r["n_more"] == max(r["n_failures"] - 2, 0) for r in rows)
    assert call(spark, capsys, "reprocess", "detail", "--memo", str(tmp_path), "--data", data)[0] == cli.USAGE

    page = "<div id=job-content><h1>t</h1><b>Job no:</b> 7<br><div id=job-details>x</div></div>"
    rows = [("a", "detail", page, "https://jobs.example.com/"), ("b", "detail", "nothing", None), ("c", "listing", "<tbody id=search-results-content></tbody>", None)]
    store.snapshot({**store.open_tables(spark, data), "payloads": spark.createDataFrame(rows, "sha256 string, kind string, body string, base string")}, f"{tmp_path}/full")
    call_ = lambda kind, day: call(spark, capsys, "reprocess", kind, "--memo", f"file://{tmp_path}/memo", "--data", f"file://{tmp_path}/full", "--as-of", day, "--json")
    code, out = call_("detail", "2030-01-01")
    assert code == 2 and {(r["status"], r["readings"]) for r in json.loads(out)} == {("ok", 1), ("failed", 1)}
    code, out = call_("detail", "2030-01-02")
    assert code == 2 and {(r["status"], r["readings"]) for r in json.loads(out)} == {("failed", 1)}
    code, out = call_("listing", "2030-01-02")
    assert code == 0 and [(r["kind"], r["status"]) for r in json.loads(out)] == [("listing", "ok")]
    code, out = call(spark, capsys, "diagnostics", "--data", data)
    told = json.loads(out)
    assert code == 0 and told["failures"]["not_retrieved"] == told["availability"].get("retrieval_failed", 0) and len(told["newest_runs"]) == 10 and sum(told["availability"].values()) == told["tables"]["observations"]


def test_exports_and_status_are_the_owners_only(spark, data, capsys, tmp_path):
    for form in ("csv", "json"):
        assert call(spark, capsys, "export", "runs", "--format", form, "--output", f"file://{tmp_path}/{form}", "--data", data)[0] == 0
        files = [p for p in (tmp_path / form).rglob("*") if p.is_file() and not p.name.endswith(".crc")]
        assert files and all(p.stat().st_mode & 0o077 == 0 for p in files) and (tmp_path / form).stat().st_mode & 0o077 == 0
    assert call(spark, capsys, "status", "--output", f"{tmp_path}/status.json", "--data", data)[0] == 0
    assert (tmp_path / "status.json").stat().st_mode & 0o077 == 0 and "collection" in json.loads((tmp_path / "status.json").read_text())
