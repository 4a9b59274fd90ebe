"""Top-n selection, restriction to chosen sessions, and play counts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.columns import (
    DURATION,
    SESSION_END,
    SESSION_KEY,
    SESSION_START,
    SONG_BY_ID,
    SONG_BY_NAME,
    SONG_COUNT,
    TIMESTAMP,
    TRACK_ID,
    USER,
)
from playtrail.functions.timing import utc_day
from playtrail.validate import require_columns, require_row_count

# Number of chosen sessions up to which their keys are sent to every task, where the plan
# itself bounds it, as a limit does.
MAX_BROADCAST_SESSIONS = 100_000


def top_n(df: DataFrame, by: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The n rows with the largest ``by``, nulls last; ties go by ``tie_break`` ascending."""
    require_row_count(n)
    return df.orderBy(F.desc(by), *[F.asc(name) for name in tie_break]).limit(n)


def longest_sessions(
    sessions: DataFrame, n: int, keys: Sequence[str] = SESSION_KEY
) -> DataFrame:
    """The n sessions of longest duration, whatever their number of events."""
    return top_n(sessions, DURATION, n, keys)


def with_song_id(events: DataFrame, song_id: str = TRACK_ID) -> DataFrame:
    return events.filter(F.col(song_id).isNotNull())


def _most_rows(df: DataFrame) -> int | None:
    """The number of rows that a plan cannot exceed, if it has such a bound."""
    bound = df._jdf.queryExecution().optimizedPlan().maxRows()
    return bound.get() if bound.isDefined() else None


def events_of_sessions(
    events_with_sessions: DataFrame,
    chosen: DataFrame,
    keys: Sequence[str] = SESSION_KEY,
) -> DataFrame:
    """Events whose session is among ``chosen``; null keys match nothing.

    Chosen sessions are a broadcast side if their plan shows them to be few enough;
    otherwise Spark decides from the sizes it meets.
    """
    wanted = chosen.select(*keys)
    bound = _most_rows(wanted)
    if bound is not None and bound <= MAX_BROADCAST_SESSIONS:
        wanted = F.broadcast(wanted)
    return events_with_sessions.join(wanted, list(keys), "left_semi")


def events_within(
    events: DataFrame,
    chosen: DataFrame,
    user_col: str = USER,
    day_col: str | None = None,
) -> DataFrame:
    """Events that fall inside one of the chosen sessions, however many these are.

    A session owns exactly its user's events between its bounds, so events need
    no session number to be told in from out. Each span is listed once for every
    day it touches, and events meet the spans of their user and day only; with
    ``day_col``, a partition column holding the date of the timestamp in UTC, Spark
    reads no other folders. The session of a user's events without timestamp has
    null bounds and a null day.
    """
    from_day, to_day = utc_day(F.col(SESSION_START)), utc_day(F.col(SESSION_END))
    days = F.when(F.col(SESSION_START).isNull(), F.array(_no_day())).otherwise(
        F.sequence(from_day, to_day)
    )
    spans = chosen.select(
        F.col(user_col).alias("__user"),
        F.col(SESSION_START).alias("__from"),
        F.col(SESSION_END).alias("__to"),
        F.explode(days).alias("__day"),
    )
    same_user = F.col(user_col) == F.col("__user")
    inside = F.col(TIMESTAMP).between(F.col("__from"), F.col("__to"))
    timeless = F.col(TIMESTAMP).isNull() & F.col("__from").isNull()
    if day_col is None:
        own_day = F.coalesce(utc_day(F.col(TIMESTAMP)), _no_day())
        return events.join(
            spans, same_user & (own_day == F.col("__day")) & (inside | timeless), "left_semi"
        )
    # The comparison with the partition column has to stand by itself for Spark to prune by it,
    # and so does a filter on the spans for Spark to think it worth the while.
    dated = events.join(
        spans.filter(F.col("__day") > _no_day()),
        same_user & (F.col(day_col) == F.col("__day")) & inside,
        "left_semi",
    )
    undated = events.filter(F.col(day_col).isNull()).join(
        spans.filter(F.col("__day") == _no_day()), same_user & timeless, "left_semi"
    )
    return dated.unionByName(undated)


def _no_day() -> Column:
    """Stands for the day of events without a timestamp: the first of year 1."""
    return F.date_from_unix_date(F.lit(-719_162))


def song_counts(events: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Number of plays of each song as told apart by the ``identity`` columns."""
    require_columns(events, identity)
    return events.groupBy(*identity).agg(F.count(F.lit(1)).alias(SONG_COUNT))


def song_counts_by_id(events: DataFrame) -> DataFrame:
    """Plays per recording; plays without a recording id are left out."""
    return song_counts(with_song_id(events), SONG_BY_ID)


def song_counts_by_name(events: DataFrame) -> DataFrame:
    """Plays per title and artist, with or without a recording id."""
    return song_counts(events, SONG_BY_NAME)


def songs_in_sessions(
    events_with_sessions: DataFrame,
    chosen: DataFrame,
    song_id: str = TRACK_ID,
    keys: Sequence[str] = SESSION_KEY,
    other_cols: Sequence[str] = (),
) -> DataFrame:
    """Play counts of the identified songs inside the chosen sessions."""
    played = with_song_id(events_with_sessions, song_id)
    return song_counts(events_of_sessions(played, chosen, keys), [song_id, *other_cols])


def top_songs(counts: DataFrame, n: int, identity: Sequence[str] = SONG_BY_ID) -> DataFrame:
    """The n most played songs."""
    return top_n(counts, SONG_COUNT, n, identity)
