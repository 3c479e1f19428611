"""Command line over a store of evidence tables: ``python -m tidemark.cli --data DIR COMMAND``.

Reports only read. Shared options stand before or after the command, and ``--health`` is another spelling of ``health``.
Exit codes: 0 well, 1 failed or stale, 2 degraded or unknown, 3 collection well but not protected, 64 usage.
"""

from __future__ import annotations

import argparse
import csv
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import Contracts
from tidemark.functions import boards as B
from tidemark.functions import linediff as D
from tidemark.operators import counters as C
from tidemark.operators import export as X
from tidemark.operators import presence as P
from tidemark.operators import reading as R
from tidemark.operators import status as T
from tidemark.operators import views as V
from tidemark.sources import store

USAGE = 64
#: Tables that a command needs; a store that lacks one of them is told apart from an empty one.
TABLES = ("observations", "runs", "entries", "postings", "versions")
LIMIT = 20


class Store:
    """The tables of a store and what is derived from them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.tables = spark, path, store.open_tables(spark, path)
        missing = sorted(set(TABLES) - set(self.tables))
        if missing:
            raise ValueError(f"the store lacks {', '.join(missing)}")

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def current(self) -> DataFrame:
        return V.posting_current(*(self[n] for n in ("observations", "postings", "versions", "entries", "runs")))

    def history(self, posting: int) -> DataFrame:
        own = self["observations"].where(F.col("posting_id") == posting)
        return V.posting_history(own, self["postings"], self["runs"], self["versions"]).orderBy(F.desc("observed_at"), F.desc("observation_id"))

    def notices(self) -> DataFrame:
        none = "run_id string, state string, accepted_at timestamp_ntz"
        return self.tables.get("notices", self.spark.createDataFrame([], none))

    def frames(self) -> dict:
        newest = [F.desc("observed_at"), F.desc("observation_id")]
        return {
            "postings": (lambda: self["postings"], ["posting_id"]), "current": (self.current, ["posting_id"]), "history": (lambda: self["observations"].join(self["runs"].select("slot", "kind", "outcome"), "slot"), newest),
            "versions": (lambda: self["versions"], ["posting_id", "lineage", "version"]), "observations": (lambda: self["observations"], ["observed_at", "observation_id"]), "runs": (lambda: self["runs"], [F.desc("slot")]),
        }


def _rows(df: DataFrame, limit: int | None = None) -> list[dict]:
    return [r.asDict(recursive=True) for r in (df.limit(limit) if limit else df).collect()]


def _print(rows: list[dict], as_json: bool) -> None:
    if as_json:
        print(json.dumps(rows, default=str, ensure_ascii=False, indent=2))
        return
    for r in rows:
        print("  ".join(f"{k}={v}" for k, v in r.items() if v is not None))


def _health(s: Store, as_of: str | None) -> dict:
    day = F.lit(as_of).cast("date") if as_of else F.current_date()
    runs = s["runs"].withColumn("run_id", F.col("slot").cast("string"))
    notices = s.notices()
    state = T.collection_state(runs, s.spark.range(1).select(day.alias("as_of")))
    lifetime = s["postings"].agg(F.count("*").alias("postings"), F.coalesce(F.sum("observations"), F.lit(0)).alias("observations"))
    backup = s.spark.range(1).select(F.lit("UNCONFIGURED").alias("state"))
    if "snapshots" in s.tables:
        backup = T.backup_status(s["snapshots"], day.cast("timestamp_ntz")).agg(F.max_by("state", "newest").alias("state")).select(F.coalesce("state", F.lit("UNPROTECTED")).alias("state"))
    return T.health_document(state, P.coverage_window(runs), T.notice_status(notices, T.unreported(runs, notices)), lifetime, backup).first().asDict()


def status(s: Store, a: argparse.Namespace) -> int:
    h = _health(s, a.as_of)
    if a.output:
        store.write_atomic(a.output, json.loads(h["document"]))
        return 0
    _print([json.loads(h["document"])] if a.json else [{"summary": h["summary"]}, *_rows(s.current().groupBy("freshness").count().orderBy("freshness"))], a.json)
    return 0


def health(s: Store, a: argparse.Namespace) -> int:
    """The health document, as the monitor reads it."""
    h = _health(s, a.as_of)
    if a.output:
        store.write_atomic(a.output, json.loads(h["document"]))
    else:
        print(h["document"])
    return int(h["exit_code"])


def runs(s: Store, a: argparse.Namespace) -> int:
    _print(_rows(s["runs"].orderBy(F.desc("slot")), a.limit or LIMIT), a.json)
    return 0


def show(s: Store, a: argparse.Namespace) -> int:
    found = _rows(s.current().where(F.col("posting_id") == a.posting))
    _print(found, a.json)
    return 0 if found else 1


def history(s: Store, a: argparse.Namespace) -> int:
    _print(_rows(s.history(a.posting), a.limit or LIMIT), a.json)
    return 0


def diff(s: Store, a: argparse.Namespace) -> int:
    """The two newest versions of a posting, field by field."""
    two = _rows(s["versions"].where(F.col("posting_id") == a.posting).orderBy(F.desc("last_seen"), F.desc("version")), 2)
    if len(two) < 2:
        print("no two versions to compare")
        return 1
    old, new = ([f"{k}: {v}" for k, v in r.items()] for r in reversed(two))
    print("--- before\n+++ after")
    for h in D.hunks(old, new, 0):
        print("\n".join([f"@@ -{h['old_start']},{h['old_lines']} +{h['new_start']},{h['new_lines']} @@", *h["lines"]]))
    return 0


def export(s: Store, a: argparse.Namespace) -> int:
    frames = s.frames()
    if a.dataset not in frames:
        raise ValueError(f"no dataset {a.dataset}; there are {', '.join(frames)}")
    df = X.dataset({a.dataset: frames[a.dataset][0]}, a.dataset, frames[a.dataset][1], a.posting, a.limit or 0)
    if a.output:
        told = X.provenance(a.dataset, df.count(), Contracts(), a.as_of or "", {"posting": a.posting, "limit": a.limit})
        (X.write_csv if a.format == "csv" else X.write_json)(df, a.output, told)
    elif a.format == "csv":
        # rows come one partition at a time, so the driver never holds a dataset
        out = csv.writer(sys.stdout, lineterminator="\n")
        out.writerow(df.columns)
        out.writerows(X.safe_cells(df).toLocalIterator())
    else:
        before = "[\n"
        for r in df.toLocalIterator():
            print(before + json.dumps(r.asDict(recursive=True), default=str, ensure_ascii=False), end="")
            before = ",\n"
        print("[]" if before == "[\n" else "\n]")
    return 0


def retry(s: Store, a: argparse.Namespace) -> int:
    """Whether the day's collection is to be tried again, as which attempt of which run; nothing is collected from here."""
    day = F.lit(a.as_of).cast("date") if a.as_of else F.current_date()
    runs = s["runs"].withColumn("run_id", F.col("slot").cast("string"))
    told = _rows(T.retry_decisions(s.spark.range(1).select(day.alias("slot")), runs))
    _print(told, a.json)
    return 2 if told[0]["decision"] == "exhausted" else 0


def failures(s: Store, a: argparse.Namespace) -> int:
    """The checks without content of the newest runs, the first ones of each."""
    rows = C.failures_of_runs(s["observations"], a.most or 25).orderBy(F.desc("slot"))
    _print(_rows(rows, a.limit or LIMIT), a.json)
    return 0


def reprocess(s: Store, a: argparse.Namespace) -> int:
    """Read the archived payloads of a kind that have no reading under these versions of the rules, and add the readings to the memo."""
    if "payloads" not in s.tables:
        raise ValueError("the store lacks payloads")
    payloads = s["payloads"].where(F.col("kind") == a.kind).drop("kind")
    text = F.col("body").cast("string")
    parse = {"listing": lambda: B.listing(text, F.col("base"), a.host), "detail": lambda: B.detail(text, F.col("base"), a.domain, a.host)}[a.kind]
    path = f"{a.memo}/{a.kind}"
    memo = s.spark.read.parquet(path) if store.exists(s.spark, path) else None
    new = R.readings(payloads, memo, a.kind, Contracts(), parse).withColumn("run", F.lit(a.as_of or ""))
    new.write.mode("append").parquet(path)
    done = s.spark.read.parquet(path).where(F.col("run") == (a.as_of or ""))
    _print(_rows(R.summary(done)), a.json)
    return 0 if done.where("status = 'failed'").isEmpty() else 2


def verify(s: Store, a: argparse.Namespace) -> int:
    checks = store.self_check(s.tables)
    _print(_rows(checks), a.json)
    return 0 if checks.where("not passed").isEmpty() else 1


def backup(s: Store, a: argparse.Namespace) -> int:
    store.snapshot(s.tables, a.destination)
    checks = store.verified_snapshot(s.spark, a.destination)
    _print(_rows(checks), a.json)
    return 0 if checks.where("not passed").isEmpty() else 1


def restore(s: Store, a: argparse.Namespace) -> int:
    """Bring back the snapshot ``--data`` to a new place; never over anything."""
    if not store.verified_snapshot(s.spark, s.path).where("not passed").isEmpty():
        print("the snapshot is damaged")
        return 1
    store.write_tables(s.tables, a.destination)
    return 0


def diagnostics(s: Store, a: argparse.Namespace) -> int:
    """Counts only, so that it can be given away."""
    cube = C.cube(s["observations"].select(*C.KEYS, "observed_at")).cache()
    by = lambda key: {r[key]: r["n"] for r in cube.where("level = 'exceptions'").groupBy(key).agg(F.sum("n").alias("n")).collect()}
    newest = cube.where("level = 'run'").orderBy(F.desc("slot")).select(F.col("slot").cast("string"), "n", F.col("latest").cast("string"))
    document = {
        "tables": {n: df.count() for n, df in s.tables.items()}, "availability": by("availability"), "lineages": by("lineage"), "identity": by("identity"), "outcomes": {r["outcome"]: r["count"] for r in s["runs"].groupBy("outcome").count().collect()},
        "failures": {k: str(v) if k == "last_failure" and v else v for k, v in C.failure_counters(cube).first().asDict().items()}, "exceptions": _rows(C.exceptions(cube).withColumn("slot", F.col("slot").cast("string")).withColumn("latest", F.col("latest").cast("string")).orderBy(F.desc("n"), F.desc("latest")), 50),
        "newest_runs": _rows(newest, 10), "gaps": _rows(C.gaps_by_kind(P.coverage_gaps(s["runs"])).groupBy("gap_kind").agg(F.sum("n").alias("n"))), "contracts": Contracts().__dict__,
    }
    if a.output:
        store.write_atomic(a.output, document)
    else:
        print(json.dumps(document, indent=2, sort_keys=True))
    return 0


def notify(s: Store, a: argparse.Namespace) -> int:
    """What is owed; nothing is sent from here."""
    r = s["runs"].withColumn("run_id", F.col("slot").cast("string"))
    _print(_rows(T.sweep(r, s.notices(), limit=a.limit or LIMIT)), a.json)
    return 0


def _shared(parser: argparse.ArgumentParser, hidden: bool) -> None:
    default = {"default": argparse.SUPPRESS} if hidden else {}
    parser.add_argument("--data", help="the store's folder", **default)
    parser.add_argument("--as-of", help="the date that states are reckoned from (default: today)", **default)
    parser.add_argument("--limit", type=int, help="so many rows at most", **default)
    parser.add_argument("--json", action="store_true", **default)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__.split("\n")[0])
    _shared(parser, False)
    shared = argparse.ArgumentParser(add_help=False)
    _shared(shared, True)
    commands = parser.add_subparsers(dest="command", required=True)
    for f, posting, extra in (
        (status, None, ("--output",)), (health, None, ("--output",)), (runs, None, ()), (show, "posting", ()), (history, "posting", ()), (diff, "posting", ()), (verify, None, ()), (notify, None, ()),
        (export, None, ("dataset", "--format", "--output", "--posting")), (backup, None, ("destination",)), (restore, None, ("destination",)), (diagnostics, None, ("--output",)),
        (retry, None, ()), (failures, None, ("--most",)), (reprocess, None, ("kind", "--memo", "--domain", "--host")),
    ):
        c = commands.add_parser(f.__name__, parents=[shared], help=(f.__doc__ or "").split("\n")[0] or None)
        if posting:
            c.add_argument("posting", type=int)
        for name in extra:
            how = {"--format": {"choices": ("json", "csv"), "default": "json"}, "--posting": {"type": int}, "--most": {"type": int}, "kind": {"choices": ("listing", "detail")}, "--memo": {"required": True}, "--domain": {"default": ""}, "--host": {"default": ""}}.get(name, {})
            c.add_argument(name, **how)
        c.set_defaults(run=f)
    return parser


def spelled(argv: list[str]) -> list[str]:
    return ["health", *(x for x in argv if x != "--health")] if "--health" in argv else argv


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = build_parser().parse_args(spelled(list(sys.argv[1:] if argv is None else argv)))
    try:
        if not args.data:
            raise ValueError("--data is needed")
        spark = spark or SparkSession.builder.appName("tidemark").getOrCreate()
        return args.run(Store(spark, args.data), args)
    except ValueError as wrong:
        print(f"usage error: {wrong}", file=sys.stderr)
        return USAGE


if __name__ == "__main__":
    raise SystemExit(main())
