"""The payload archive and the table store: content-addressed landing, verification, schema registry, snapshots, journals."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import tomllib
from dataclasses import asdict, dataclass, fields
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMAT_VERSION = 1


def addressed(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Distinct payloads: sha256, byte_length, body; the digest is the identity, so copies fold together."""
    rows = payloads.select(F.sha2(F.col(body).cast("binary"), 256).alias("sha256"), F.length(F.col(body).cast("binary")).cast("long").alias("byte_length"), F.col(body).cast("binary").alias("body"))
    return rows.groupBy("sha256").agg(F.first("byte_length").alias("byte_length"), F.first("body").alias("body"))


def land(payloads: DataFrame, archive: DataFrame | None, body: str = "body") -> DataFrame:
    """The payloads that the archive does not have yet."""
    new = addressed(payloads, body)
    return new if archive is None else new.join(archive.select("sha256"), "sha256", "left_anti")


def damaged(archive: DataFrame) -> DataFrame:
    """Rows whose body does not have the digest or the length that is recorded."""
    return archive.where((F.sha2("body", 256) != F.col("sha256")) | (F.length("body") != F.col("byte_length")) | F.col("body").isNull()).select("sha256", "byte_length")


def storage(fetches: DataFrame, archive: DataFrame) -> DataFrame:
    """Artifacts, bytes, fetches and the ratio of bytes fetched to bytes kept."""
    kept = archive.agg(F.count("*").alias("artifacts"), F.coalesce(F.sum("byte_length"), F.lit(0)).alias("bytes_kept"))
    got = fetches.agg(F.count("*").alias("fetches"), F.coalesce(F.sum("byte_length"), F.lit(0)).alias("bytes_fetched"))
    return kept.join(got).withColumn("ratio", F.round(F.try_divide("bytes_fetched", "bytes_kept"), 2))


def foreign_key_gaps(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Children whose parent is missing; null keys refer to nothing."""
    p = parent.select(F.col(parent_key or key).alias("_parent")).distinct()
    return child.where(F.col(key).isNotNull()).join(p, F.col(key) == F.col("_parent"), "left_anti")


def in_domain(df: DataFrame, column: str, allowed: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows within the enumeration and rows to quarantine (null among them)."""
    ok = F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.where(ok), df.where(~ok)


# -- tables -----------------------------------------------------------------


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Each table as Parquet below ``path``, then the marker: without it, a store is not there."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
    spark.createDataFrame([(FORMAT_VERSION, n) for n in sorted(tables)], "format int, table string").coalesce(1).write.json(f"{path}/_marker")


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def append(rows: DataFrame, path: str, key: list[str]) -> None:
    """Add to a table's folder the rows whose key is not there yet; nothing is ever changed. Of equal keys among the rows one is added."""
    spark = rows.sparkSession
    new = rows.dropDuplicates(key)
    if exists(spark, path):
        new = new.join(spark.read.schema(rows.schema).parquet(path).select(*key), key, "left_anti").select(*rows.columns)
    new.write.mode("append").parquet(path)


def open_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    marks = spark.read.schema("format int, table string").json(f"{path}/_marker").collect()
    if any(m["format"] > FORMAT_VERSION for m in marks):
        raise ValueError("the store was written by a newer version")
    return {m["table"]: spark.read.option("mergeSchema", "true").parquet(f"{path}/{m['table']}") for m in marks}


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """table, rows, digest: an order-free digest of each table, so that a copy can be checked."""
    parts = []
    for name, df in tables.items():
        row = F.xxhash64(*(F.col(c) for c in sorted(df.columns))) if df.columns else F.lit(0)
        parts.append(df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest")).select(F.lit(name).alias("table"), "rows", "digest"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def restore_check(snapshot: DataFrame, restored: DataFrame) -> DataFrame:
    """table, same_rows, same_digest of each table of either manifest."""
    a, b = snapshot.select("table", F.col("rows").alias("r1"), F.col("digest").alias("d1")), restored.select("table", F.col("rows").alias("r2"), F.col("digest").alias("d2"))
    return a.join(b, "table", "full_outer").select("table", F.coalesce(F.col("r1") == F.col("r2"), F.lit(False)).alias("same_rows"), F.coalesce(F.col("d1") == F.col("d2"), F.lit(False)).alias("same_digest"))


def snapshot(tables: dict[str, DataFrame], path: str) -> None:
    """A copy of the tables with the manifest of what was copied, written last."""
    write_tables(tables, path)
    manifest(tables).coalesce(1).write.json(f"{path}/_manifest")


def verified_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """name, passed, detail: that the snapshot opens, has the rows and digests of its manifest, and passes self_check."""
    tables = open_tables(spark, path)
    told = spark.read.schema("table string, rows long, digest string").json(f"{path}/_manifest")
    same = restore_check(told, manifest(tables)).select(F.concat(F.lit("manifest:"), "table").alias("name"), (F.col("same_rows") & F.col("same_digest")).alias("passed"), F.when(~F.col("same_rows"), "rows differ").when(~F.col("same_digest"), "contents differ").otherwise("").alias("detail"))
    return same.union(self_check(tables))


def _check(name: str, bad: DataFrame, passed: Column | None = None) -> DataFrame:
    return bad.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), (F.col("n") == 0 if passed is None else passed).alias("passed"), F.format_string("%d", "n").alias("detail"))


def self_check(tables: dict[str, DataFrame]) -> DataFrame:
    """name, passed, detail of what an archive must hold whatever is in it; a check whose tables are missing is left out.

    keys:TABLE: no posting is twice; references: observations and versions of postings that are there; payloads: digests and lengths;
    histories: there are postings with observations; versions_survived: versions were seen; links: counted only.
    """
    t, out = tables, []
    if "postings" in t:
        out.append(_check("keys:postings", t["postings"].groupBy("posting_id").count().where("count > 1")))
        for child in ("observations", "versions"):
            if child in t:
                out.append(_check(f"references:{child}", foreign_key_gaps(t[child], t["postings"], "posting_id")))
    if "payloads" in t:
        out.append(_check("payloads", damaged(t["payloads"])))
    if "observations" in t and "postings" in t:
        out.append(_check("histories", t["postings"].join(t["observations"].select("posting_id"), "posting_id", "left_semi"), F.col("n") > 0))
    if "versions" in t:
        out.append(_check("versions_survived", t["versions"].where("observed < 1 or first_seen > last_seen")))
    if "links" in t:
        out.append(_check("links", t["links"], F.lit(True)))
    every = out[0]
    for one in out[1:]:
        every = every.union(one)
    return every


def read_journal(spark: SparkSession, path: str, limit: int = 200) -> DataFrame:
    """The newest records of a failure journal; lines that are no records are passed over."""
    df = spark.read.schema("at string, slot string, kind string, detail string").option("mode", "DROPMALFORMED").json(path)
    return df.where("at IS NOT NULL").orderBy(F.desc("at")).limit(limit)


# -- files ------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    namespace: str = "default"
    zone: str = "America/New_York"
    slot_hour: int = 6
    slot_minute: int = 30
    weekly_after: int = 3
    absence_days: int = 2
    keep_daily: int = 7
    keep_weekly: int = 4
    keep_monthly: int = 12
    retry_budget: int = 2


def load_config(path: str) -> Config:
    """A TOML file; keys that are unknown are an error."""
    given = tomllib.loads(Path(path).read_text())
    unknown = sorted(set(given) - {f.name for f in fields(Config)})
    if unknown:
        raise ValueError(f"unknown keys: {', '.join(unknown)}")
    return Config(**given)


def config_hash(config: Config) -> str:
    """Digest of all values in the order of their names; a config holds no paths, so it is the same on every machine."""
    return hashlib.sha256(json.dumps(asdict(config), sort_keys=True).encode()).hexdigest()


def write_atomic(path: str, document: dict) -> None:
    """A JSON file that is there whole or not at all, readable by its owner only."""
    target = Path(path)
    handle, name = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    try:
        with os.fdopen(handle, "w") as out:
            json.dump(document, out, ensure_ascii=False, indent=2, sort_keys=True, default=str)
            out.flush()
            os.fsync(out.fileno())
        os.replace(name, target)
    except BaseException:
        os.unlink(name)
        raise
