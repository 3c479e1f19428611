"""Files of an archive by their digests: what is recorded against what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """path (below ``root``), length, sha256 of every file below ``root``, read where it lies.

    Spark passes over files without bytes, so they are in no manifest, and a file that lost all its bytes is missing. A file must fit a row (2 GB); archives write smaller ones.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = F.regexp_replace(F.lit(root.rstrip("/")), r"^[a-z]+:/*", "/")
    path = F.regexp_replace("path", r"^[a-z]+:/*", "/")
    return files.select(F.substring(path, F.length(base) + 2, F.length(path)).alias("path"), "length", F.sha2("content", 256).alias("sha256"))


def seal(manifest: DataFrame) -> DataFrame:
    """n_files, bytes, digest. The lines are folded by their first byte first, so no task holds more than a 256th of them and none passes them on."""
    line = F.sha2(F.concat_ws("\x1f", "path", F.col("length").cast("string"), "sha256"), 256)
    parts = manifest.select(line.alias("line"), "length").groupBy(F.substring("line", 1, 2).alias("part")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("line")), "\n"), 256).alias("digest"), F.count("*").alias("n"), F.sum("length").alias("bytes"))
    whole = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "digest"))), lambda p: p["digest"]), "\n"), 256)
    return parts.agg(F.sum("n").alias("n_files"), F.sum("bytes").alias("bytes"), whole.alias("digest"))


def file_differences(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """path, change: `missing`, `added`, `cut` (shorter than recorded), `grown`, or `swapped` (of the same length, but other bytes); files that are as recorded give no row."""
    there = found.select("path", F.col("length").alias("length_found"), F.col("sha256").alias("sha256_found"))
    both = recorded.select("path", "length", "sha256").join(there, "path", "full_outer")
    change = (
        F.when(F.col("sha256_found").isNull(), "missing").when(F.col("sha256").isNull(), "added").when(F.col("length_found") < F.col("length"), "cut")
        .when(F.col("length_found") > F.col("length"), "grown").when(F.col("sha256_found") != F.col("sha256"), "swapped")
    )
    return both.withColumn("change", change).where("change is not null").select("path", "change", "length", "length_found")
