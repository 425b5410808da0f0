"""Streaming form of the place list: de-duplication and windowed counts over arriving JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambitus.sources.places import PLACE_SCHEMA, with_search_names


def place_stream(spark: SparkSession, path: str, files_per_trigger: int = 10) -> DataFrame:
    """Place records of JSON files as they arrive, with the time at which each was gathered (gathered_at, null where absent)."""
    return with_search_names(spark.readStream.schema(PLACE_SCHEMA + ", gathered_at timestamp").option("maxFilesPerTrigger", files_per_trigger).json(path))


def first_seen(stream: DataFrame, lateness: str = "2 days") -> DataFrame:
    """The first record to arrive of each category and place id; state is dropped once the watermark has passed."""
    keyed = stream.where(F.coalesce(F.trim("placeId"), F.lit("")) != "").withColumn("category", F.lower(F.trim("category")))
    return keyed.withWatermark("gathered_at", lateness).dropDuplicatesWithinWatermark(["category", "placeId"])


def arrivals(stream: DataFrame, window: str = "1 day", lateness: str = "2 days") -> DataFrame:
    """(window, category, n): records by window of gathering and category, final once the watermark has passed."""
    return stream.withWatermark("gathered_at", lateness).groupBy(F.window("gathered_at", window), F.lower(F.trim("category")).alias("category")).agg(F.count("*").alias("n"))
