"""Time cells: the bounded summary that sessions are cut from.

Two events of a user in one cell lie less than a cell width apart, so with a
width of at most the session threshold they always share a session. A user's
rows therefore reduce, with map-side combine, to one row per cell, and the
number of rows that must meet in one task per user is bounded by the covered
time range over the width, however many events the user has.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrail.columns import SESSION, TIMESTAMP
from playtrail.functions.timing import cell_start, seconds_between, starts_session

CELL = "__cell"
ROWS = "__rows"
FIRST = "__first"
LAST = "__last"
CARRY = "__carry"


def cell_width(limit: float, at_most: int | None = None) -> int:
    """Widest whole-second cell whose events cannot be more than ``limit`` apart."""
    width = max(1, int(limit))
    return width if at_most is None else min(width, at_most)


def summarize_cells(events: DataFrame, user_col: str, width: int) -> DataFrame:
    """One row per user and cell; events without a timestamp form the null cell."""
    return events.groupBy(
        F.col(user_col), cell_start(F.col(TIMESTAMP), width).alias(CELL)
    ).agg(
        F.min(TIMESTAMP).alias(FIRST),
        F.max(TIMESTAMP).alias(LAST),
        F.count(F.lit(1)).alias(ROWS),
    )


def number_cells(cells: DataFrame, user_col: str, limit: float) -> DataFrame:
    """Add to each cell the last instant before it and the session it belongs to.

    The null cell comes first. Each of its events opens a session of its own
    but, having equal sort keys, all of them carry the last of those numbers.
    The number is a bigint, as that cell may hold any number of rows; results
    narrow it only where their schema says so.
    """
    in_order = Window.partitionBy(user_col).orderBy(CELL)
    opened = F.when(F.col(CELL).isNull(), F.col(ROWS)).otherwise(
        starts_session(seconds_between(F.col(CARRY), F.col(FIRST)), limit)
    )
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.withColumn(CARRY, F.lag(LAST).over(in_order)).withColumn(
        SESSION, F.sum(opened).over(so_far)
    )
