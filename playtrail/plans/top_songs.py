"""The main analysis: the songs played most in the longest sessions."""

from pyspark.sql import DataFrame, SparkSession

from playtrail.columns import SESSION_KEY, SONG_BY_ID
from playtrail.operators.metrics import numbered_sessions, session_metrics
from playtrail.operators.ranking import (
    events_of_sessions,
    events_within,
    longest_sessions,
    song_counts_by_id,
    songs_in_sessions,
    top_songs,
)
from playtrail.operators.sessionize import sessionize
from playtrail.sources.tsv import read_events, result_name, write_tsv
from playtrail.storage import Scratch


def events_in_longest_sessions(
    events: DataFrame,
    threshold_minutes: float = 20,
    session_number: int = 50,
    day_col: str | None = None,
) -> DataFrame:
    """Events of the longest sessions, straight from the event table.

    Two passes over the events, of which the first, narrow one cuts the sessions
    and the second meets them by user and day. ``day_col`` names the column of a
    day-partitioned table, so that the second pass reads the days of those
    sessions only.
    """
    chosen = longest_sessions(numbered_sessions(events, threshold_minutes), session_number)
    return events_within(events, chosen, day_col=day_col)


def top_songs_in_longest_sessions(
    events: DataFrame,
    threshold_minutes: float = 20,
    session_number: int = 50,
    song_number: int = 10,
    day_col: str | None = None,
) -> DataFrame:
    played = events_in_longest_sessions(events, threshold_minutes, session_number, day_col)
    return top_songs(song_counts_by_id(played), song_number).select(*SONG_BY_ID)


def top_songs_of_sessionized(
    events_with_sessions: DataFrame,
    sessions: DataFrame | None = None,
    session_number: int = 50,
    song_number: int = 10,
) -> DataFrame:
    """The same ranking from a table that already has session numbers."""
    if sessions is None:
        sessions = session_metrics(events_with_sessions)
    counts = songs_in_sessions(
        events_with_sessions,
        longest_sessions(sessions, session_number),
        song_id=SONG_BY_ID[0],
        keys=SESSION_KEY,
        other_cols=SONG_BY_ID[1:],
    )
    return top_songs(counts, song_number).select(*SONG_BY_ID)


def run_top_songs(
    spark: SparkSession,
    events_path: str,
    output_dir: str,
    threshold_minutes: float = 20,
    session_number: int = 50,
    song_number: int = 10,
) -> str:
    """Batch job from an event TSV to a result TSV; returns the path written."""
    ranked = top_songs_in_longest_sessions(
        read_events(spark, events_path), threshold_minutes, session_number, song_number
    )
    path = f"{output_dir.rstrip('/')}/{result_name(song_number, session_number)}"
    write_tsv(ranked, path, single_file=True)
    return path


def run_session_reports(
    spark: SparkSession,
    events: DataFrame,
    output_dir: str,
    threshold_minutes: float = 20,
    session_number: int = 50,
    song_number: int = 10,
    how: str = "table",
) -> dict[str, str]:
    """Batch job for several results from one sessionized table; returns their paths.

    The table is kept for all of them (``how``: memory, disk or table) and released at the
    end, also if one of them fails.
    """
    out = output_dir.rstrip("/")
    paths = {
        "sessions": f"{out}/sessions",
        "events": f"{out}/events_of_longest_sessions",
        "songs": f"{out}/{result_name(song_number, session_number)}",
    }
    with Scratch(spark, "session-reports") as scratch:
        numbered = scratch.keep(sessionize(events, threshold_minutes), how, "sessionized")
        sessions = scratch.keep(session_metrics(numbered), how, "sessions")
        sessions.write.mode("overwrite").parquet(paths["sessions"])
        chosen = longest_sessions(sessions, session_number)
        chosen_events = events_of_sessions(numbered, chosen)
        chosen_events.write.mode("overwrite").parquet(paths["events"])
        ranked = top_songs_of_sessionized(numbered, sessions, session_number, song_number)
        write_tsv(ranked, paths["songs"], single_file=True)
    return paths
