"""Data-quality expectations on the share of present values."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.columns import ARTIST_NAME, TIMESTAMP, TRACK_ID, TRACK_NAME
from playtrail.operators.profile import named
from playtrail.validate import require_columns

# The least share of non-null values expected of each column.
EXPECTED_PRESENT = {
    TIMESTAMP: 1.0,
    TRACK_ID: 0.85,
    TRACK_NAME: 0.99,
    ARTIST_NAME: 0.99,
}


def quality_report(
    events: DataFrame,
    expected: Mapping[str, float] = EXPECTED_PRESENT,
    per: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per expectation, from a single pass over the table.

    ``per`` names columns to report by, such as the day of arrival; then there is
    a row for each of their values and expectation. An empty table has no observed
    share and passes.
    """
    require_columns(events, expected)
    total = F.count(F.lit(1))
    per = per or {}
    shares = events.groupBy(*[value.alias(name) for name, value in per.items()]).agg(
        *[
            F.when(total > 0, F.count(named(name)) / total).alias(f"share_{i}")
            for i, name in enumerate(expected)
        ]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.lit(float(least)).alias("threshold"),
                F.col(f"share_{i}").alias("observed"),
            )
            for i, (name, least) in enumerate(expected.items())
        ]
    )
    return shares.select(*per, F.inline(lines)).withColumn(
        "passed", F.coalesce(F.col("observed") >= F.col("threshold"), F.lit(True))
    )
