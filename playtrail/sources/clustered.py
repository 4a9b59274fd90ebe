"""Event tables clustered by user and day, for per-user work without moving events.

``write_events`` buckets and sorts events by user and day of UTC. All of a user's events of
a day then lie in one bucket, and a user with many events still spreads over buckets day by
day. ``sessionize_stored`` cuts sessions on such a table without an exchange of events:
only cells, summed up within the buckets, move to number the sessions of a user across
days, and one small row per user and day comes back.

The bucket columns are a hash of the user and a day without nulls, so that they join by
plain equality, which is what lets Spark use the buckets.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playtrail.columns import GAP, NEW_SESSION, PREVIOUS, SESSION, TIMESTAMP, USER
from playtrail.functions.timing import cell_start, seconds_between, starts_session, utc_day
from playtrail.operators.cells import (
    CARRY,
    CELL,
    FIRST,
    LAST,
    ROWS,
    cell_width,
    number_cells,
)
from playtrail.operators.sessionize import DERIVED
from playtrail.validate import require_columns, threshold_seconds

SLOT = "user_slot"
DAY = "user_day"
#: The day of events without a timestamp: the first of year 1, in days since 1970.
NO_DAY = -719_162

_WITHIN = "__within"
_FOR = "__for"


def write_events(
    events: DataFrame,
    table: str,
    path: str,
    buckets: int,
    user_col: str = USER,
    mode: str = "errorifexists",
) -> DataFrame:
    """Write events as a bucketed table at ``path``; returns the table.

    Rows are dealt to the buckets before the write, so that each bucket is one file.
    """
    require_columns(events, [TIMESTAMP, user_col])
    keyed = events.withColumns(
        {
            SLOT: F.xxhash64(user_col),
            DAY: F.coalesce(utc_day(F.col(TIMESTAMP)), F.date_from_unix_date(F.lit(NO_DAY))),
        }
    )
    (
        keyed.repartition(buckets, SLOT, DAY)
        .write.mode(mode)
        .option("path", path)
        .bucketBy(buckets, SLOT, DAY)
        .sortBy(SLOT, DAY, user_col, TIMESTAMP)
        .saveAsTable(table)
    )
    return events.sparkSession.table(table)


def open_events(spark: SparkSession, table: str, path: str, buckets: int, schema: str) -> DataFrame:
    """The table in a session that does not know it yet; ``schema`` are the columns of the events."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {table} ({schema}, {SLOT} BIGINT, {DAY} DATE)
        USING parquet OPTIONS (path '{path}')
        CLUSTERED BY ({SLOT}, {DAY}) INTO {buckets} BUCKETS"""
    )
    return spark.table(table)


def plain_events(stored: DataFrame) -> DataFrame:
    """The events without the bucket columns."""
    return stored.drop(SLOT, DAY)


def _cells(stored: DataFrame, user_col: str, limit: float) -> DataFrame:
    """Cells of a day each, summed up where the events lie."""
    cell = cell_start(F.col(TIMESTAMP), cell_width(limit)).alias(CELL)
    return stored.groupBy(SLOT, DAY, user_col, cell).agg(
        F.min(TIMESTAMP).alias(FIRST),
        F.max(TIMESTAMP).alias(LAST),
        F.count(F.lit(1)).alias(ROWS),
    )


def _before_each_day(cells: DataFrame, user_col: str, limit: float) -> DataFrame:
    """By bucket key: for each user the last instant and number of sessions before the day."""
    # a cell that a day's end cuts in two is in order by its first instant
    ordered = cells.withColumn(CELL, F.unix_timestamp(FIRST))
    numbered = number_cells(ordered, user_col, limit)
    opens = F.when(F.col(CELL).isNull(), F.col(ROWS)).otherwise(
        starts_session(seconds_between(F.col(CARRY), F.col(FIRST)), limit)
    )
    first = F.struct(
        F.coalesce(CELL, F.lit(-(1 << 62))).alias("at"),
        F.col(CARRY).alias("carry"),
        (F.col(SESSION) - opens).alias("sessions"),
        F.col(user_col).alias("user"),
    )
    per_user = numbered.groupBy(SLOT, DAY, user_col).agg(F.min(first).alias("first"))
    # two users share a key only if their hashes collide
    return per_user.groupBy(SLOT, DAY).agg(F.collect_list("first").alias(_FOR))


def sessionize_stored(
    stored: DataFrame, threshold_minutes: float = 20, user_col: str = USER
) -> DataFrame:
    """``sessionize`` on a table of ``write_events``, by its buckets.

    A user's events of one day meet in one task, so a single day of a user has to fit
    there; for tables in which it may not, ``sessionize`` is the way to take.
    """
    require_columns(stored, [TIMESTAMP, user_col, SLOT, DAY])
    limit = threshold_seconds(threshold_minutes)
    kept = [c for c in stored.columns if c not in (*DERIVED, SLOT, DAY)]
    rows = stored.select(*kept, SLOT, DAY)
    before = _before_each_day(_cells(rows, user_col, limit), user_col, limit)
    met = rows.join(before.hint("merge"), [SLOT, DAY], "left")
    own = F.filter(_FOR, lambda f: f["user"].eqNullSafe(F.col(user_col)))[0]

    of_day = Window.partitionBy(SLOT, DAY, user_col)
    in_order = of_day.orderBy(TIMESTAMP)
    # peers share a session, so the default frame of an ordered window is the one wanted
    gap = seconds_between(F.col(PREVIOUS), F.col(TIMESTAMP))
    first = F.row_number().over(in_order) == 1
    return (
        met.withColumn(_WITHIN, own)
        .withColumn(
            PREVIOUS, F.when(first, F.col(f"{_WITHIN}.carry")).otherwise(F.lag(TIMESTAMP).over(in_order))
        )
        .withColumn(GAP, gap)
        .withColumn(NEW_SESSION, starts_session(F.col(GAP), limit))
        .withColumn(
            SESSION,
            (F.col(f"{_WITHIN}.sessions") + F.sum(NEW_SESSION).over(in_order)).cast("int"),
        )
        .select(*kept, *DERIVED)
    )


def session_table_stored(
    stored: DataFrame, threshold_minutes: float = 20, user_col: str = USER
) -> DataFrame:
    """``session_table`` on such a table: cells are summed up in place and only they move."""
    from playtrail.operators.metrics import number_sessions

    require_columns(stored, [TIMESTAMP, user_col, SLOT, DAY])
    limit = threshold_seconds(threshold_minutes)
    cells = _cells(stored, user_col, limit).withColumn(CELL, F.unix_timestamp(FIRST))
    sessions = number_sessions(cells, user_col, limit)
    return sessions.withColumn(SESSION, F.col(SESSION).cast("int"))
