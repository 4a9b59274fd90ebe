"""How the choice of song identity changes the ranking."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrail.columns import SONG_BY_ID, SONG_BY_NAME, SONG_COUNT, TRACK_ID
from playtrail.operators.ranking import song_counts, top_songs
from playtrail.validate import require_row_count


def _ranked(songs: DataFrame, identity, suffix: str) -> DataFrame:
    # The window has one partition of at most the requested number of songs.
    by_plays = Window.partitionBy(F.lit(0)).orderBy(
        F.desc(SONG_COUNT), *[F.asc(name) for name in identity]
    )
    return songs.withColumn(f"rank_{suffix}", F.row_number().over(by_plays)).withColumnRenamed(
        SONG_COUNT, f"count_{suffix}"
    )


def compare_song_identity(events: DataFrame, song_number: int = 10) -> DataFrame:
    """The most played songs by name and by recording id, side by side.

    A song in one list only has nulls for the other. ``events`` are the plays to
    rank, normally those of the longest sessions.
    """
    require_row_count(song_number)
    counts = song_counts(events, SONG_BY_ID)
    names_only = counts.groupBy(*SONG_BY_NAME).agg(F.sum(SONG_COUNT).alias(SONG_COUNT))
    # Plays without an id sort last and are dropped after the limit: a filter ahead of it
    # would move below the count and make Spark run the plays once more for this list.
    ids_only = (
        counts.orderBy(
            F.col(TRACK_ID).isNull(), F.desc(SONG_COUNT), *[F.asc(c) for c in SONG_BY_ID]
        )
        .limit(song_number)
        .filter(F.col(TRACK_ID).isNotNull())
    )
    by_name = _ranked(
        top_songs(names_only, song_number, SONG_BY_NAME), SONG_BY_NAME, "by_name"
    )
    by_id = _ranked(ids_only, SONG_BY_ID, "by_id")
    names = [F.col(f"n.{name}").eqNullSafe(F.col(f"i.{name}")) for name in SONG_BY_NAME]
    both = by_name.alias("n").join(by_id.alias("i"), names, "full_outer")
    return both.select(
        *[F.coalesce(f"n.{name}", f"i.{name}").alias(name) for name in SONG_BY_NAME],
        "rank_by_name",
        "count_by_name",
        TRACK_ID,
        "rank_by_id",
        "count_by_id",
    )
