"""Cutting each user's events into sessions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.columns import GAP, NEW_SESSION, PREVIOUS, SESSION, TIMESTAMP, USER
from playtrail.functions.timing import seconds_between, starts_session
from playtrail.operators.scan import trace_sessions
from playtrail.validate import require_columns, threshold_seconds

DERIVED = (PREVIOUS, GAP, NEW_SESSION, SESSION)


def sessionize(
    events: DataFrame,
    threshold_minutes: float = 20,
    user_col: str = USER,
    parts: int | None = None,
) -> DataFrame:
    """Events with previous timestamp, gap, new-session flag and session number.

    A session of a user ends where the gap to the next event is longer than the
    threshold. Session numbers start at 1 for each user and follow time. Among
    events of a user with equal timestamps, which one comes first is open.

    ``parts`` is the number of parts of about equal size that the events are cut
    into, by default ``spark.sql.shuffle.partitions``. The input has to read the
    same way twice, as tables do.
    """
    limit = threshold_seconds(threshold_minutes)
    require_columns(events, [TIMESTAMP, user_col])
    kept = [name for name in events.columns if name not in DERIVED]
    traced = trace_sessions(events.select(*kept), user_col, limit, parts)
    gap = seconds_between(F.col(PREVIOUS), F.col(TIMESTAMP))
    return (
        traced.withColumn(GAP, gap)
        .withColumn(NEW_SESSION, starts_session(F.col(GAP), limit))
        .withColumn(SESSION, F.col(SESSION).cast("int"))
        .select(*kept, *DERIVED)
    )
