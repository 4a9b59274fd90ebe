"""The most played of very many songs, without a count of each of them.

Counting all songs moves one row per song and task. Here songs are first counted by hash
into ``BUCKETS`` buckets, in ``ROWS`` independent rows. That table is of fixed size and
mergeable: the tables of two days add up. The least of a song's buckets is an upper bound
of its plays. Then

1. the songs whose bound is greatest are counted exactly; the n-th greatest of these counts
   is a number that the n-th song reaches at least;
2. songs whose bound is below it cannot be among the first n, nor tie with the last of
   them. All the others are counted exactly, and the first n of those are the result.

So the result is exact, whatever the data: if many songs share a bound, many are counted,
up to all of them. Nothing is estimated in it, and nothing is left out by a cap.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.columns import SONG_BY_ID, SONG_COUNT
from playtrail.operators.ranking import song_counts, top_songs, with_song_id
from playtrail.validate import require_columns, require_row_count

BUCKETS = 1 << 16
ROWS = 2

_AT = "__at"
_SUM = "__sum"


def _bucket(identity: Sequence[str], row: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), *identity), F.lit(buckets)).cast("int")


def bucket_counts(
    plays: DataFrame, identity: Sequence[str] = SONG_BY_ID, buckets: int = BUCKETS, rows: int = ROWS
) -> DataFrame:
    """Plays per bucket of each hash row: (hash_row, bucket, plays). Sums of such tables are
    the tables of all their plays together."""
    require_columns(plays, identity)
    places = F.array(
        *[
            F.struct(F.lit(k).alias("hash_row"), _bucket(identity, k, buckets).alias("bucket"))
            for k in range(rows)
        ]
    )
    return (
        plays.select(F.inline(places))
        .groupBy("hash_row", "bucket")
        .agg(F.count(F.lit(1)).alias("plays"))
    )


def merged(counts: DataFrame) -> DataFrame:
    """One table from the bucket counts of several days or sources."""
    return counts.groupBy("hash_row", "bucket").agg(F.sum("plays").alias("plays"))


def _with_bound(
    plays: DataFrame, counts: DataFrame, identity: Sequence[str], least: DataFrame, buckets: int, rows: int
) -> DataFrame:
    """Plays whose song may reach ``least`` (a single row): all of its buckets do.

    The buckets that do are ``buckets`` rows at most, so they are broadcast.
    """
    for row in range(rows):
        full = counts.filter((F.col("hash_row") == row) & (F.col("plays") >= least.scalar()))
        full = full.select(F.col("bucket").alias(_AT))
        wanted = _bucket(identity, row, buckets) == F.col(_AT)
        plays = plays.join(F.broadcast(full), wanted, "left_semi")
    return plays


def top_songs_by_bound(
    events: DataFrame,
    n: int,
    identity: Sequence[str] = SONG_BY_ID,
    counts: DataFrame | None = None,
    buckets: int = BUCKETS,
    rows: int = ROWS,
) -> DataFrame:
    """The n most played songs with an id, as ``top_songs`` of all songs' counts gives them.

    ``counts`` are stored bucket counts of just these events, where there are some; they
    are small, and the first look at the events is saved.
    """
    require_row_count(n)
    plays = with_song_id(events, identity[0]).select(*identity)
    table = merged(counts) if counts is not None else bucket_counts(plays, identity, buckets, rows)
    # enough buckets to hold n songs, and some more, in case songs share them
    first = table.filter("hash_row = 0").orderBy(F.desc("plays"), "bucket").limit(4 * n)
    floor = first.agg(F.coalesce(F.min("plays"), F.lit(0)).alias(_SUM))
    likely = song_counts(_with_bound(plays, table, identity, floor, buckets, rows), identity)
    best = likely.orderBy(F.desc(SONG_COUNT)).limit(n)
    reached = best.agg(
        F.when(F.count("*") >= n, F.min(SONG_COUNT)).otherwise(F.lit(0)).alias(_SUM)
    )
    candidates = _with_bound(plays, table, identity, reached, buckets, rows)
    return top_songs(song_counts(candidates, identity), n, identity)
