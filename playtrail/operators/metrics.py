"""Session start, end and duration."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.columns import (
    DURATION,
    SESSION,
    SESSION_END,
    SESSION_KEY,
    SESSION_START,
    TIMESTAMP,
    USER,
)
from playtrail.functions.timing import seconds_between
from playtrail.operators.cells import FIRST, LAST, cell_width, number_cells, summarize_cells
from playtrail.validate import require_columns, threshold_seconds


def _with_duration(bounds: DataFrame) -> DataFrame:
    return bounds.withColumn(
        DURATION, seconds_between(F.col(SESSION_START), F.col(SESSION_END))
    )


def session_bounds(
    events_with_sessions: DataFrame, keys: Sequence[str] = SESSION_KEY
) -> DataFrame:
    """First and last timestamp of each session of an already sessionized table."""
    require_columns(events_with_sessions, [TIMESTAMP, *keys])
    return events_with_sessions.groupBy(*keys).agg(
        F.min(TIMESTAMP).alias(SESSION_START), F.max(TIMESTAMP).alias(SESSION_END)
    )


def session_metrics(
    events_with_sessions: DataFrame, keys: Sequence[str] = SESSION_KEY
) -> DataFrame:
    """Session bounds and duration in seconds; a single event lasts 0 seconds."""
    return _with_duration(session_bounds(events_with_sessions, keys))


def number_sessions(cells: DataFrame, user_col: str, limit: float) -> DataFrame:
    """Bounds and duration of the sessions that cells make up; the number is a bigint."""
    return _with_duration(
        number_cells(cells, user_col, limit)
        .groupBy(user_col, SESSION)
        .agg(F.min(FIRST).alias(SESSION_START), F.max(LAST).alias(SESSION_END))
    )


def numbered_sessions(
    events: DataFrame, threshold_minutes: float = 20, user_col: str = USER
) -> DataFrame:
    """``session_table`` with the session number as a bigint, for further steps."""
    limit = threshold_seconds(threshold_minutes)
    require_columns(events, [TIMESTAMP, user_col])
    cells = summarize_cells(events, user_col, cell_width(limit))
    return number_sessions(cells, user_col, limit)


def session_table(
    events: DataFrame, threshold_minutes: float = 20, user_col: str = USER
) -> DataFrame:
    """The same table straight from events.

    Reads only user and timestamp and never brings single events together, so
    it is the way to take whenever the per-event columns are not wanted.
    """
    sessions = numbered_sessions(events, threshold_minutes, user_col)
    return sessions.withColumn(SESSION, F.col(SESSION).cast("int"))
