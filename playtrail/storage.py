"""Keeping intermediate results: in memory, on executor disks, or as a written table.

What is kept belongs to a ``Scratch``, which removes it at the end of its block, also after
an error. ``settle`` runs a query in such a block and keeps nothing but its result.
"""

import tempfile
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder stands in for it in local mode only; elsewhere other
    machines could not read it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
    if master not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[master] = tempfile.mkdtemp(prefix="playtrail-")
    return _LOCAL_SCRATCH[master]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def as_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    The result has no lineage above its scan, so a lost executor costs a
    re-read and not a recomputation. Files stay; a caller who wants to remove
    them names the ``path``.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, how: str = "memory", name: str = "stage") -> DataFrame:
    """Keep ``df`` for reuse: ``memory`` (spilling to disk), ``disk`` or ``table``."""
    if how == "memory":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "disk":
        return df.persist(StorageLevel.DISK_ONLY)
    if how == "table":
        return as_table(df, name)
    raise ValueError(f"Unknown way to materialize: {how}")


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder wherever Spark can reach it; whether there was one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return target.getFileSystem(conf).delete(target, True)


class Scratch:
    """Intermediates that live as long as a ``with`` block.

    Tables written through it lie in one folder of its own below the scratch folder. At
    the end of the block the folder goes and persisted tables are released, whether the
    block succeeded or not; what is still read lazily from them has to be written before.
    """

    def __init__(self, spark: SparkSession, name: str = "scope"):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self.persisted: list[DataFrame] = []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def path(self, name: str) -> str:
        """A fresh path that goes with the scope."""
        return f"{self.root}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str = "stage") -> DataFrame:
        return as_table(df, name, self.path(name))

    def keep(self, df: DataFrame, how: str = "memory", name: str = "stage") -> DataFrame:
        """``materialize``, undone at the end of the scope."""
        if how == "table":
            return self.table(df, name)
        self.persisted.append(materialize(df, how))
        return self.persisted[-1]

    def close(self) -> None:
        try:
            while self.persisted:
                self.persisted.pop().unpersist()
        finally:
            remove(self.spark, self.root)


def settle(
    spark: SparkSession,
    query: Callable[[Scratch], DataFrame],
    name: str = "result",
    path: str | None = None,
) -> DataFrame:
    """The written result of a query; all that the query kept on its way is gone.

    If the query or its write fails, the unfinished result goes as well.
    """
    path = path or scratch_path(spark, name)
    with Scratch(spark, name) as scratch:
        try:
            return as_table(query(scratch), name, path)
        except BaseException:
            remove(spark, path)
            raise
