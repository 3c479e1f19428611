"""The observation feed as a stream: duplicates dropped within the watermark, counts by local hour, and the latest state of each posting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATE = "1 day"


def observation_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files of observations as they land."""
    return spark.readStream.schema(schema).parquet(path)


def without_duplicates(feed: DataFrame, time: str = "observed_at", key: str = "observation_id", late: str = LATE) -> DataFrame:
    return feed.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def counts(feed: DataFrame, time: str = "observed_at", width: str = "1 hour", late: str = LATE) -> DataFrame:
    """Observations by window and availability; what comes later than the watermark is left out, so closed windows never change."""
    return feed.withWatermark(time, late).groupBy(F.window(time, width), "availability").agg(F.count("*").alias("n")).select("window.start", "availability", "n")


def latest_state(feed: DataFrame, time: str = "observed_at") -> DataFrame:
    """For the update mode: the latest check of each posting; of equal times the greatest id."""
    return feed.groupBy("posting_id").agg(F.max_by("availability", F.struct(time, "observation_id")).alias("availability"), F.max(time).alias("checked_at"))
