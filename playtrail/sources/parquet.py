"""Event tables as date-partitioned Parquet."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.columns import TIMESTAMP, USER
from playtrail.functions.timing import utc_day

EVENT_DATE = "event_date"


def write_events(events: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write events in one folder per day of UTC, whatever zone the session is in.

    The rebalance hint lets Spark split the files of a crowded day and join
    those of quiet ones, by the sizes it meets. Files are sorted by user and
    time, which lets the later per-user summary combine rows while reading.
    """
    (
        events.withColumn(EVENT_DATE, utc_day(F.col(TIMESTAMP)))
        .hint("rebalance", EVENT_DATE)
        .sortWithinPartitions(EVENT_DATE, USER, TIMESTAMP)
        .write.mode(mode)
        .partitionBy(EVENT_DATE)
        .parquet(path)
    )


def read_events(
    spark: SparkSession,
    path: str,
    first_day: str | None = None,
    last_day: str | None = None,
    keep_day: bool = False,
) -> DataFrame:
    """Events from ``first_day`` to ``last_day`` (UTC) inclusive; only their folders are read.

    With ``keep_day`` the partition column stays, so that later steps can prune by it.
    """
    events = spark.read.parquet(path)
    if first_day is not None:
        events = events.filter(F.col(EVENT_DATE) >= F.lit(first_day).cast("date"))
    if last_day is not None:
        events = events.filter(F.col(EVENT_DATE) <= F.lit(last_day).cast("date"))
    return events if keep_day else events.drop(EVENT_DATE)
