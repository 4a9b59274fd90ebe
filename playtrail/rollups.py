"""Per-day aggregates that are stored once and merged for any range of days.

A rollup is a table with one row per day and key, whose other columns can be merged: counts
add up, sketches unite. ``write_days`` replaces the days it is given and leaves the others,
so a day that is delivered again is not counted twice. Reports over a range read the rollup
and no events.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playtrail.columns import TIMESTAMP
from playtrail.functions.timing import utc_day
from playtrail.operators.profile import named
from playtrail.validate import require_columns

DAY = "event_date"

# The sketches' size: 2^12 registers, with a relative standard error of 1.04 / sqrt(2^12).
LOG_REGISTERS = 12
RELATIVE_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)


def day_of(timestamp: str = TIMESTAMP) -> Column:
    """The day of UTC that a row is counted for; null without a timestamp."""
    return utc_day(F.col(timestamp))


def write_days(rollup: DataFrame, path: str) -> None:
    """Store the days of a rollup, each in its folder, in place of what is there for them.

    One row per day and key is little, so each day is one file.
    """
    (
        rollup.repartition(DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def read_days(
    spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """The stored days from ``first_day`` to ``last_day`` inclusive; null days belong to no range."""
    rollup = spark.read.parquet(path)
    if first_day is not None:
        rollup = rollup.filter(F.col(DAY) >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rollup = rollup.filter(F.col(DAY) <= F.lit(last_day).cast("date"))
    return rollup


# distinct values


def _sketched(column: Column, kind: str) -> Column:
    """A column as a type that sketches take; equal values stay equal."""
    if kind in ("int", "bigint", "string", "binary"):
        return column
    if kind == "timestamp":
        return F.unix_micros(column)
    return column.cast("string")


def distinct_sketches(events: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per day and column a sketch of its distinct values, from one pass over the events.

    A day without any value in a column has a null sketch.
    """
    require_columns(events, [TIMESTAMP, *(columns or [])])
    kinds = dict(events.dtypes)
    columns = list(columns or events.columns)
    sketches = events.groupBy(day_of().alias(DAY)).agg(
        *[
            F.hll_sketch_agg(_sketched(named(name), kinds[name]), LOG_REGISTERS).alias(f"sketch_{i}")
            for i, name in enumerate(columns)
        ]
    )
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.col(f"sketch_{i}").alias("sketch"))
            for i, name in enumerate(columns)
        ]
    )
    return sketches.select(DAY, F.inline(lines))


def distinct_values(sketches: DataFrame, deviations: float = 4) -> DataFrame:
    """Estimated distinct values per column over all the days given, with bounds.

    The bounds lie ``deviations`` standard errors of the sketch from the estimate, and at
    least one value.
    """
    estimate = F.hll_sketch_estimate("united")
    slack = F.greatest(F.ceil(F.col("estimate") * deviations * RELATIVE_ERROR), F.lit(1))
    return (
        sketches.groupBy("column")
        .agg(F.hll_union_agg("sketch").alias("united"))
        .select("column", F.coalesce(estimate, F.lit(0)).alias("estimate"))
        .select(
            "column",
            "estimate",
            F.greatest(F.col("estimate") - slack, F.lit(0)).alias("at_least"),
            (F.col("estimate") + slack).alias("at_most"),
        )
    )


# data quality


def presence_counts(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per day and column: how many values are present, of how many rows."""
    require_columns(events, [TIMESTAMP, *columns])
    counted = events.groupBy(day_of().alias(DAY)).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(named(name)).alias(f"present_{i}") for i, name in enumerate(columns)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"present_{i}").alias("present"),
                F.col("total").alias("total"),
            )
            for i, name in enumerate(columns)
        ]
    )
    return counted.select(DAY, F.inline(lines))


def quality_between(counts: DataFrame, expected: dict[str, float]) -> DataFrame:
    """``quality_report`` over the stored days given; columns without an expectation are left out."""
    least = F.element_at(_as_map(expected), F.col("column"))
    summed = counts.filter(F.col("column").isin(list(expected))).groupBy("column")
    observed = F.col("present") / F.col("total")
    return summed.agg(F.sum("present").alias("present"), F.sum("total").alias("total")).select(
        "column",
        least.alias("threshold"),
        observed.alias("observed"),
        (observed >= least).alias("passed"),
    )


def quality_drift(counts: DataFrame, days: int = 7, tolerance: float = 0.05) -> DataFrame:
    """Each day's share of present values against that of the ``days`` days before it.

    ``drop`` is how far the share fell below theirs, ``passed`` whether by no more than the
    tolerance. A day without any of those days before it passes; days without events are
    not among them. The rows of a window are days.
    """
    number = F.unix_date(DAY)
    before = Window.partitionBy("column").orderBy(number).rangeBetween(-days, -1)
    observed = F.col("present") / F.col("total")
    earlier = F.sum("present").over(before) / F.sum("total").over(before)
    return (
        counts.filter(F.col(DAY).isNotNull())
        .select(
            DAY,
            "column",
            observed.alias("observed"),
            earlier.alias("observed_before"),
        )
        .withColumn("drop", F.col("observed_before") - F.col("observed"))
        .withColumn("passed", F.coalesce(F.col("drop") <= tolerance, F.lit(True)))
    )


def _as_map(expected: dict[str, float]) -> Column:
    pairs = [F.lit(x) for name, least in expected.items() for x in (name, float(least))]
    return F.create_map(*pairs)
