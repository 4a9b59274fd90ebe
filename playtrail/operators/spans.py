"""Sessions as spans of time, merged with further spans of the same users."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrail.columns import SESSION_END, SESSION_START, USER
from playtrail.functions.timing import seconds_between, starts_session

_REACHED = "__reached"
_SPAN = "__span"


def merge_spans(spans: DataFrame, limit: float, user_col: str = USER) -> DataFrame:
    """The sessions that result from spans without a gap longer than ``limit`` inside.

    Spans may overlap, touch or repeat each other, so it does not matter in what order
    or how often the events behind them arrived. Each starts a session unless what came
    before it reaches to within the limit.
    """
    in_order = Window.partitionBy(user_col).orderBy(SESSION_START, SESSION_END)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = starts_session(seconds_between(F.col(_REACHED), F.col(SESSION_START)), limit)
    return (
        spans.select(user_col, SESSION_START, SESSION_END)
        .withColumn(_REACHED, F.max(SESSION_END).over(before))
        .withColumn(_SPAN, F.sum(opens).over(so_far))
        .groupBy(user_col, _SPAN)
        .agg(F.min(SESSION_START).alias(SESSION_START), F.max(SESSION_END).alias(SESSION_END))
        .drop(_SPAN)
    )
