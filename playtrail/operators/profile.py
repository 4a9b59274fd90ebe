"""Data profiling: counts, ranges, missing and distinct values, variants of a song."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.columns import (
    ARTIST_ID,
    ARTIST_NAME,
    SONG_BY_NAME,
    TIMESTAMP,
    TRACK_ID,
    TRACK_NAME,
)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def time_range(events: DataFrame) -> DataFrame:
    return events.agg(
        F.min(TIMESTAMP).alias("min_timestamp"), F.max(TIMESTAMP).alias("max_timestamp")
    )


def missing_values(df: DataFrame) -> DataFrame:
    """One row holding the number of nulls in each column."""
    return df.agg(*[F.count_if(named(name).isNull()).alias(name) for name in df.columns])


def missing_pct(df: DataFrame, columns: Sequence[str] = (ARTIST_ID, TRACK_ID)) -> DataFrame:
    """One row holding the percentage of nulls in each of ``columns``, to two decimals."""
    share = [
        F.round(F.count_if(named(name).isNull()) / F.count(F.lit(1)) * 100, 2).alias(name)
        for name in columns
    ]
    return df.agg(*share)


def approx_distinct(df: DataFrame) -> DataFrame:
    """One row holding the estimated number of distinct values of each column."""
    return df.agg(*[F.approx_count_distinct(named(name)).alias(name) for name in df.columns])


def approx_distinct_check(df: DataFrame, rsd: float = 0.05, deviations: float = 4) -> DataFrame:
    """Per column: exact number of distinct values, and whether the estimate is near it.

    Near is within ``deviations`` times the relative standard deviation of the sketch.
    Each side is an aggregate of its own: together, every distinct value would carry a
    sketch of each column through the shuffle.
    """
    exact = [F.count_distinct(named(name)).alias(f"exact_{i}") for i, name in enumerate(df.columns)]
    guess = [
        F.approx_count_distinct(named(name), rsd).alias(f"guess_{i}")
        for i, name in enumerate(df.columns)
    ]
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"exact_{i}").alias("exact"),
                F.col(f"guess_{i}").alias("guess"),
            )
            for i, name in enumerate(df.columns)
        ]
    )
    found = df.agg(*exact).crossJoin(df.agg(*guess))
    far = F.abs(F.col("guess") - F.col("exact")) > deviations * rsd * F.col("exact")
    return found.select(F.inline(lines)).select("column", "exact", (~far).alias("in_bounds"))


def approx_distinct_bounds(df: DataFrame, rsd: float = 0.05, deviations: float = 4) -> DataFrame:
    """Per column: the estimate of ``approx_distinct``, and the bounds it gives for the number.

    They lie ``deviations`` relative standard deviations of the sketch below and above.
    """
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.col(f"guess_{i}").alias("estimate"))
            for i, name in enumerate(df.columns)
        ]
    )
    guess = [
        F.approx_count_distinct(named(name), rsd).alias(f"guess_{i}")
        for i, name in enumerate(df.columns)
    ]
    reach = deviations * rsd
    return df.agg(*guess).select(F.inline(lines)).select(
        "column",
        "estimate",
        F.ceil(F.col("estimate") / (1 + reach)).alias("at_least"),
        F.floor(F.col("estimate") / (1 - reach)).alias("at_most"),
    )


def exact_distinct(df: DataFrame) -> DataFrame:
    """Per column the exact number of distinct values, for holding estimates against."""
    exact = [F.count_distinct(named(name)).alias(f"exact_{i}") for i, name in enumerate(df.columns)]
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.col(f"exact_{i}").alias("exact"))
            for i, name in enumerate(df.columns)
        ]
    )
    return df.agg(*exact).select(F.inline(lines))


def held_against(exact: DataFrame, bounds: DataFrame) -> DataFrame:
    """Per column the exact number, and whether each bound holds for it."""
    return exact.join(bounds, "column").select(
        "column",
        "exact",
        (F.col("at_least") <= F.col("exact")).alias("lower_holds"),
        (F.col("exact") <= F.col("at_most")).alias("upper_holds"),
    )


def named(name: str) -> Column:
    """A column by its literal name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def track_ids_per_song(events: DataFrame) -> DataFrame:
    """Distinct recording ids of each title and artist, most first."""
    return (
        events.groupBy(*SONG_BY_NAME)
        .agg(F.count_distinct(TRACK_ID).alias("distinct_track_id"))
        .orderBy(F.desc("distinct_track_id"), *SONG_BY_NAME)
    )


def missing_track_name(events: DataFrame) -> DataFrame:
    return events.filter(F.col(TRACK_NAME).isNull())


def song_variants(
    events: DataFrame, track_name: str, artist_name: str | None = None
) -> DataFrame:
    """Distinct ids and artists under a title, or under a title of one artist."""
    wanted = F.col(TRACK_NAME) == track_name
    if artist_name is not None:
        wanted = wanted & (F.col(ARTIST_NAME) == artist_name)
    columns = [ARTIST_ID, ARTIST_NAME, TRACK_ID, TRACK_NAME]
    return (
        events.filter(wanted)
        .select(*columns)
        .distinct()
        .orderBy(ARTIST_NAME, TRACK_ID, ARTIST_ID)
    )
