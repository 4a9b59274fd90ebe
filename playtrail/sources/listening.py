"""The generic ``events`` test table seen as listening events.

That table has no songs. Artist, recording and title are derived from the
number in ``props`` so that some ids and titles are missing and some titles
have several recordings.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.columns import (
    ARTIST_ID,
    ARTIST_NAME,
    TIMESTAMP,
    TRACK_ID,
    TRACK_NAME,
    USER,
)


def as_listening_events(events: DataFrame) -> DataFrame:
    # A column of its own, so that the text is parsed once per row and not once per use.
    numbered = events.select(
        "user_id", "ts", F.regexp_extract("props", r"\d+", 0).cast("int").alias("k")
    )
    k = F.col("k")
    return numbered.select(
        F.col("user_id").cast("string").alias(USER),
        F.col("ts").alias(TIMESTAMP),
        F.when(k % 5 != 0, F.concat(F.lit("aid-"), k % 8)).alias(ARTIST_ID),
        F.concat(F.lit("artist-"), k % 8).alias(ARTIST_NAME),
        F.when(k % 9 != 0, F.concat(F.lit("track-"), k)).alias(TRACK_ID),
        F.when(k != 95, F.concat(F.lit("song-"), k % 40)).alias(TRACK_NAME),
    )


def read_listening_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_listening_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
