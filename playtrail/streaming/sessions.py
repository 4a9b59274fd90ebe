"""Sessions from Spark's session windows, as a stream or in batch."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playtrail.columns import DURATION, SESSION_END, SESSION_START, TIMESTAMP, USER
from playtrail.functions.timing import seconds_between, whole_second
from playtrail.operators.cells import CELL, FIRST, LAST, cell_width, summarize_cells
from playtrail.validate import require_columns, threshold_seconds

# Merges the sessions of a map task before the shuffle, so that a busy user
# reaches the stateful task as few rows.
MERGE_BEFORE_SHUFFLE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"

_SECOND = "__second"
_WINDOW = "__window"


def _window_length(threshold_minutes: float) -> float:
    """Seconds a window stays open after an event: enough for gaps of the threshold, no more.

    Gaps are whole seconds, so only the whole part of the threshold counts, and
    half a second beyond it cuts at the same places. Without it, a threshold of
    less than a second would leave windows of no length, which Spark drops.
    """
    return int(threshold_seconds(threshold_minutes)) + 0.5


def _as_sessions(bounds: DataFrame, user_col: str) -> DataFrame:
    return bounds.select(
        user_col,
        SESSION_START,
        SESSION_END,
        seconds_between(F.col(SESSION_START), F.col(SESSION_END)).alias(DURATION),
    )


def stream_sessions(
    events: DataFrame,
    threshold_minutes: float = 20,
    lateness: str = "10 minutes",
    user_col: str = USER,
) -> DataFrame:
    """Sessions of an event stream, emitted once no event within ``lateness`` can extend them.

    Sessions have no number; user and start identify them. Events without a
    timestamp belong to none.
    """
    require_columns(events, [TIMESTAMP, user_col])
    gap = f"{int(_window_length(threshold_minutes) * 1000)} milliseconds"
    bounds = (
        events.select(user_col, TIMESTAMP, whole_second(F.col(TIMESTAMP)).alias(_SECOND))
        .withWatermark(_SECOND, lateness)
        .groupBy(user_col, F.session_window(_SECOND, gap).alias(_WINDOW))
        .agg(F.min(TIMESTAMP).alias(SESSION_START), F.max(TIMESTAMP).alias(SESSION_END))
    )
    return _as_sessions(bounds, user_col)


def start_session_sink(
    sessions: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append finished sessions to Parquet; rerun with the same folders to take up new data."""
    writer = (
        sessions.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    # A query takes the settings that hold when it starts.
    conf = sessions.sparkSession.conf
    before = conf.get(MERGE_BEFORE_SHUFFLE)
    conf.set(MERGE_BEFORE_SHUFFLE, "true")
    try:
        return writer.start()
    finally:
        conf.set(MERGE_BEFORE_SHUFFLE, before)


def sessions_by_window(
    events: DataFrame, threshold_minutes: float = 20, user_col: str = USER
) -> DataFrame:
    """The batch form: a session window over time cells, each as long as it holds events."""
    seconds = _window_length(threshold_minutes)
    require_columns(events, [TIMESTAMP, user_col])
    cells = summarize_cells(events, user_col, cell_width(threshold_seconds(threshold_minutes))).filter(
        F.col(CELL).isNotNull()
    )
    length = seconds_between(F.col(FIRST), F.col(LAST)) + F.lit(seconds)
    open_for = F.make_interval(secs=length.cast("decimal(18,6)"))
    bounds = (
        cells.select(
            user_col,
            FIRST,
            LAST,
            whole_second(F.col(FIRST)).alias(_SECOND),
            open_for.alias("__open"),
        )
        .groupBy(user_col, F.session_window(_SECOND, F.col("__open")).alias(_WINDOW))
        .agg(F.min(FIRST).alias(SESSION_START), F.max(LAST).alias(SESSION_END))
    )
    return _as_sessions(bounds, user_col)


def still_open(
    events: DataFrame, closed: DataFrame, threshold_minutes: float = 20, user_col: str = USER
) -> DataFrame:
    """Sessions of the events that come after the last closed session of their user.

    ``closed`` is what a stream over the same events has written so far. A stream
    closes the sessions of a user in order of time, so the two together are all
    sessions. Null users keep theirs, too.
    """
    last = closed.groupBy(F.col(user_col).alias("__user")).agg(
        F.max(SESSION_END).alias("__closed_to")
    )
    later = events.join(last, F.col(user_col).eqNullSafe(F.col("__user")), "left").filter(
        F.col("__closed_to").isNull() | (F.col(TIMESTAMP) > F.col("__closed_to"))
    )
    return sessions_by_window(later.select(user_col, TIMESTAMP), threshold_minutes, user_col)
