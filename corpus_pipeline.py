"""The corpus pipeline: stages over `documents`, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language_id, line_dedup, mixing, parity_join
from tidemark.llm.common import bit_set, columns, rows_named, settled, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification learnt from the documents' own labels; texts without letters and those whose language is no better than a guess go.

    Null and empty texts have no letters. Repeated rows share their fate; rows without doc_id are judged like all others.
    """
    model = language_id.train(docs)
    names = columns(docs.columns)
    judged = language_id.identify(docs, model, F.struct(*names).alias("kept"))
    return judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= SURE)).select("kept.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines, and single long lines, that occurred before are cut out; documents of which nothing is left go.

    Null texts and rows without doc_id stay as they are; rows equal in doc_id and text are one document and share its fate.
    """
    return line_dedup.clean(docs)


def _before(now: DataFrame, came: DataFrame) -> DataFrame:
    """doc_id, text: the texts that documents of ``now`` came with and that no row has any more. They are found by hashes, so that only those texts are moved, once."""
    hashes = lambda df, *names: df.select(*(c.alias(n) for c, n in zip((F.col("doc_id"), F.xxhash64("text")), names, strict=True)))
    here = hashes(now, "id", "hash").distinct()
    cut = hashes(came, "id", "hash").distinct().join(here.select("id").distinct(), "id", "left_semi").join(here, ["id", "hash"], "left_anti")
    cut = stored(cut.withColumn("key", F.xxhash64("id", "hash")), "pipeline-cut")
    bits = now.sparkSession.sparkContext.broadcast(bit_set(cut.select("key")))
    some = came.select("doc_id", "text", F.xxhash64(F.col("doc_id"), F.xxhash64("text")).alias("key")).mapInArrow(rows_named(bits, "key"), "doc_id long, text string, key long")
    return some.join(cut.select("key", "id"), ["key"], "left_semi").select("doc_id", "text")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of smallest doc_id, and of rows equal in doc_id and text one.

    Texts are judged as they are and, where an earlier stage has cut them, also as they came: near copies lose the lines that they share
    and could not be told by what is left. A folder without documents has no such texts. Rows without doc_id stay, all of them; texts without words are near to nothing.
    """
    now = texts = docs.where("doc_id is not null").select("doc_id", "text")
    came = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/documents.parquet")
    if came.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(came):
        texts = now.union(settled(lambda: _before(now, table(spark, sf_dir, "documents")), "pipeline-before"))
    # a table of known size: while it is small the join is a broadcast by Spark's own threshold, and the texts stay where they are
    groups = settled(lambda: parity_join.near_groups(texts).where("doc_id <> component_id").select(F.col("doc_id").alias("copy_id")).distinct(), "pipeline-copies")
    left = docs.join(groups, docs["doc_id"] == groups["copy_id"], "left_anti")
    key = [F.col("doc_id"), F.xxhash64("text")]
    names = ("repeated doc_id", "repeated hash")
    repeated = now.select(*(c.alias(n) for c, n in zip(key, names, strict=True))).groupBy(*names).agg(F.count("*").alias("times it is there"))
    repeated = stored(repeated.where(F.col("times it is there") > 1).select(*names), "pipeline-repeats")
    if repeated.isEmpty():
        return left
    again = (key[0] == repeated[names[0]]) & (key[1] == repeated[names[1]])
    some = left.join(repeated, again, "left_semi").select(F.struct(*columns(docs.columns)).alias("kept"), key[0].alias("of"), key[1].alias("text_hash"))
    return left.join(repeated, again, "left_anti").union(some.dropDuplicates(["of", "text_hash"]).select("kept.*"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go. Null and empty texts hold none; rows without doc_id stay, as nothing names them."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: each document as often as its source's target takes it, with its shard and place.

    Rows without source are a source of their own; texts without words are of size 0; repeated rows are taken together.
    """
    return mixing.mix(docs)


#: A language must be likelier than all others together.
SURE = 0.5
STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix)]
#: The hashes, draws and regular expressions of the stages are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; what lies between two stages is a table in the shared folder.

    An empty table gives none; nulls and repeats are what the stages say. The tables are deleted by ``tidemark.llm.common.clear``.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
