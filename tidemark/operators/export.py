"""Datasets for export, with provenance, and the CSV and JSON sinks."""

from __future__ import annotations

import json

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import Contracts
from tidemark.functions.scalars import source_date, spreadsheet_safe
from tidemark.operators.views import pivot_fields

#: Datasets that can be limited to one posting.
BY_POSTING = ("postings", "current", "history", "versions", "observations", "links")


def dataset(frames: dict[str, Callable[[], DataFrame]], name: str, order: list[str], posting: int | None = None, limit: int = 0) -> DataFrame:
    """The dataset in its order; the filter comes before order and limit, so it reaches the scan. 0 means no limit."""
    if name not in frames:
        raise ValueError(f"no dataset {name}")
    if posting is not None and name not in BY_POSTING:
        raise ValueError(f"{name} can't be filtered by posting")
    df = frames[name]()
    if posting is not None:
        df = df.where(F.col("posting_id") == posting)
    df = df.orderBy(*order)
    return df.limit(limit) if limit else df


def current(state: DataFrame, values: DataFrame, keys: list[str], dated: tuple[str, ...] = ()) -> DataFrame:
    """The latest state of each posting with one column a field of its current version; values: entity_id (posting_id, lineage, version), field_key, ordinal, value_text.

    ``dated``: fields that are dates; each gets its precision (KEY_precision) and the instant it means (KEY_parsed_utc, null for a mere date) beside it.
    """
    fields = pivot_fields(values, keys)
    for key in dated:
        read = source_date(key, F.lit(None).cast("string"))
        fields = fields.withColumn(f"{key}_precision", F.when(F.col(key).isNotNull(), read["precision"])).withColumn(f"{key}_parsed_utc", read["utc"])
    own = F.struct(F.col("posting_id"), F.col("content_lineage").alias("lineage"), F.col("content_version").alias("version"))
    return state.withColumn("entity_id", own).join(fields, "entity_id", "left").drop("entity_id")


def versions(frame: DataFrame) -> DataFrame:
    """Versions (description_text and others) with the length of their text in place of the text."""
    return frame.withColumn("text_length", F.length("description_text").cast("long")).drop("description_text")


def links(resource_links: DataFrame, versions: DataFrame, postings: DataFrame) -> DataFrame:
    """The links of every version of a registered posting."""
    return resource_links.join(versions.select("version_id", "posting_id"), "version_id").join(postings.select("posting_id"), "posting_id")


def provenance(name: str, rows: int, contracts: Contracts, as_of: str, filters: dict | None = None) -> dict:
    return {"dataset": name, "rows": rows, "as_of": as_of, "filters": filters or {}, "contracts": contracts.__dict__}


def safe_cells(df: DataFrame) -> DataFrame:
    """Text cells that a spreadsheet would run get a leading quote."""
    return df.select(*(spreadsheet_safe(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes))


def _beside(df: DataFrame, path: str, told: dict | None) -> None:
    """The provenance as a file of one JSON line beside the data, which readers of the folder pass over."""
    if told is not None:
        df.sparkSession.createDataFrame([(json.dumps(told, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/_provenance")


def private(spark: SparkSession, path: str) -> None:
    """Files and folders below ``path`` for their owner only."""
    jvm = spark._jvm.org.apache.hadoop.fs
    top = jvm.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, mode in (("files", "600"), ("folders", "700")):
        todo = [top]
        while todo:
            here = todo.pop()
            for status in fs.listStatus(here):
                if status.isDirectory():
                    todo.append(status.getPath())
                elif name == "files":
                    fs.setPermission(status.getPath(), jvm.permission.FsPermission(mode))
            if name == "folders":
                fs.setPermission(here, jvm.permission.FsPermission(mode))


def write_csv(df: DataFrame, path: str, told: dict | None = None) -> None:
    """Cells that a spreadsheet would run are quoted; ``told``: the provenance. The files are their owner's only."""
    safe_cells(df).write.option("header", True).option("escape", '"').csv(path)
    _beside(df, path, told)
    private(df.sparkSession, path)


def write_json(df: DataFrame, path: str, told: dict | None = None) -> None:
    """Values as they are; ``told``: the provenance. The files are their owner's only."""
    df.write.option("ignoreNullFields", False).json(path)
    _beside(df, path, told)
    private(df.sparkSession, path)
