"""Whole-second time arithmetic.

All gaps and durations are differences of whole epoch seconds: fractions are
dropped before subtracting. ``unix_timestamp`` takes both timestamp types.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(earlier: Column, later: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def whole_second(instant: Column) -> Column:
    """``instant`` without its fraction, as a zoned timestamp free of the session's zone rules.

    A timestamp without zone counts as UTC here, so that clock changes in the
    session's zone do not stretch or shrink gaps.
    """
    return F.timestamp_seconds(F.unix_timestamp(instant))


def cell_start(instant: Column, width: int) -> Column:
    """First second of the ``width``-second time cell that holds ``instant``."""
    second = F.unix_timestamp(instant)
    return second - F.pmod(second, F.lit(width))


def starts_session(gap: Column, limit: float) -> Column:
    """1 where a gap opens a session: there is none, or it is longer than ``limit``."""
    return (gap.isNull() | (gap > F.lit(limit))).cast("int")


def utc_day(instant: Column) -> Column:
    """The date of the whole epoch second, whatever zone the session is in."""
    return F.date_from_unix_date(F.floor(F.unix_timestamp(instant) / 86_400).cast("int"))
