"""Written intermediate results in the folder that all executors share."""

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, as in tests, a folder in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="playtrail-llm-"))
    return _local[0]


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: no lineage above its scan remains.

    So the shuffle files of the write are of no further use, and Spark is told to
    remove them at its end.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """How many parts the session deals shuffled rows to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver runs from a checkout."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        path = os.pathsep.join(filter(None, [known, root]))
        spark.sparkContext.environment["PYTHONPATH"] = path
