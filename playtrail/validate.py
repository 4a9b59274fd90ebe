"""Checks made on the driver from the schema and parameters alone; none starts a job."""

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    absent = [name for name in required if name not in df.columns]
    if absent:
        # Fixed value: the message text.
        raise ValueError(f"Missing required columns in DataFrame: {', '.join(absent)}")


def threshold_seconds(threshold_minutes: float) -> float:
    if not threshold_minutes > 0:
        # Fixed value: the message text.
        raise ValueError("Session threshold must be greater than 0.")
    return threshold_minutes * 60


def require_row_count(n: int) -> int:
    if n < 0:
        raise ValueError(f"Number of rows must not be negative: {n}")
    return n
