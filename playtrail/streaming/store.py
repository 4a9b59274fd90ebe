"""A stored session table that batches of events are merged into.

Sessions lie in one folder per day of their end and version. A batch of events is cut
into sessions of its own; of what is stored, only the days from the batch's first event on
can hold a session that these reach, and of them only the users of the batch matter. Both
are merged, and the days in which a session came or went are written anew under the
batch's version. A small commit table then names the version of every day. Events that
were merged before are never read again.

That is exact for events in any order and however late: a batch of old events reads and
rewrites the days that it touches. A batch may be repeated after a failure, under its
version, and events may be delivered twice, in any batch: neither changes the sessions.
Readers see the last commit, whose files are not written again. Files that no recent commit names are removed by ``vacuum``.

Events without a timestamp belong to no session here, as in ``sessions_by_window``.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playtrail.columns import DURATION, SESSION_END, SESSION_START, TIMESTAMP, USER
from playtrail.functions.timing import seconds_between, utc_day
from playtrail.operators.metrics import numbered_sessions
from playtrail.operators.spans import merge_spans
from playtrail.storage import Scratch, remove
from playtrail.validate import require_columns, threshold_seconds

_DAY = "end_day"
_COMMIT = "version long, end_day date, stored_in long"


class SessionStore:
    """Sessions below ``path``, in ``sessions`` and ``commits``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        threshold_minutes: float = 20,
        user_col: str = USER,
    ):
        self.spark, self.path, self.user_col = spark, path.rstrip("/"), user_col
        self.threshold_minutes = threshold_minutes
        self.limit = threshold_seconds(threshold_minutes)

    # what is stored

    def _commits(self) -> DataFrame:
        folder = f"{self.path}/commits"
        target = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        if not target.getFileSystem(conf).exists(target):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).parquet(f"{folder}/*")

    def days(self, before: int | None = None) -> dict[date, int]:
        """Day and the version it is stored in, by the last commit (below ``before``).

        One entry for each day there is a session of.
        """
        commits = self._commits()
        if before is not None:
            commits = commits.filter(F.col("version") < before)
        last = commits.agg(F.max("version")).first()[0]
        rows = commits.filter((F.col("version") == last) & F.col(_DAY).isNotNull()).collect()
        return {row[_DAY]: row["stored_in"] for row in rows}

    def _folder(self, version: int, day: date | None = None) -> str:
        folder = f"{self.path}/sessions/version={version}"
        return folder if day is None else f"{folder}/{_DAY}={day.isoformat()}"

    def _read(self, stored: dict[date, int], schema: T.StructType) -> DataFrame:
        if not stored:
            return self.spark.createDataFrame([], schema)
        folders = [self._folder(version, day) for day, version in sorted(stored.items())]
        return self.spark.read.schema(schema).parquet(*folders)

    def sessions(self, schema: T.StructType | None = None) -> DataFrame:
        """All sessions of the last commit: user, start, end, duration."""
        stored = self.days()
        if schema is None:
            if not stored:
                raise ValueError("Nothing is stored yet; name the schema of user, start and end.")
            day, version = next(iter(stored.items()))
            schema = self.spark.read.parquet(self._folder(version, day)).schema
        found = self._read(stored, schema)
        return found.withColumn(
            DURATION, seconds_between(F.col(SESSION_START), F.col(SESSION_END))
        )

    # merging

    def merge(self, events: DataFrame, version: int) -> None:
        """Merge a batch of events; ``version`` rises from batch to batch.

        A version that is committed has been merged whole and is not merged again.
        """
        require_columns(events, [TIMESTAMP, self.user_col])
        if not self._commits().filter(F.col("version") == version).isEmpty():
            return
        with Scratch(self.spark, "session-store") as scratch:
            fresh = scratch.table(self._cut(events), "fresh")
            stored = self.days(before=version)
            changed = self._merged_days(fresh, stored, version, scratch)
        kept = {day: v for day, v in stored.items() if day not in changed}
        kept |= {day: version for day, rows in changed.items() if rows}
        # a commit without days still counts as one
        rows = [(version, day, v) for day, v in sorted(kept.items())] or [(version, None, None)]
        commit = self.spark.createDataFrame(rows, _COMMIT).coalesce(1)
        commit.write.mode("overwrite").parquet(f"{self.path}/commits/{version}")

    def _cut(self, events: DataFrame) -> DataFrame:
        cut = numbered_sessions(events, self.threshold_minutes, self.user_col)
        return cut.filter(F.col(SESSION_START).isNotNull()).select(
            self.user_col, SESSION_START, SESSION_END
        )

    def _merged_days(
        self, fresh: DataFrame, stored: dict[date, int], version: int, scratch: Scratch
    ) -> dict[date, int]:
        """Write the days in which a session came or went; how many rows each has now."""
        end_day = utc_day(F.col(SESSION_END))
        reach = F.min(F.timestamp_seconds(F.unix_timestamp(SESSION_START) - F.lit(self.limit)))
        first_day = fresh.agg(utc_day(reach)).first()[0]
        if first_day is None:
            return {}
        within = {day: v for day, v in stored.items() if day >= first_day}
        old = self._read(within, fresh.schema)
        ours = fresh.select(F.col(self.user_col).alias("__user")).distinct()
        same_user = F.col(self.user_col).eqNullSafe(F.col("__user"))
        touched = scratch.table(old.join(ours, same_user, "left_semi"), "touched")
        merged = scratch.table(
            merge_spans(fresh.unionByName(touched), self.limit, self.user_col), "merged"
        )
        came, went = merged.exceptAll(touched), touched.exceptAll(merged)
        moved = came.select(end_day.alias(_DAY)).union(went.select(end_day.alias(_DAY)))
        days = [row[0] for row in moved.distinct().collect()]  # days that changed
        if not days:
            return {}
        left = self._read({d: v for d, v in within.items() if d in set(days)}, fresh.schema)
        left = left.join(ours, same_user, "left_anti")
        now = left.unionByName(merged.filter(end_day.isin(days))).withColumn(_DAY, end_day)
        folder = self._folder(version)
        (
            now.hint("rebalance", _DAY)
            .sortWithinPartitions(_DAY, self.user_col, SESSION_START)
            .write.mode("overwrite")
            .partitionBy(_DAY)
            .parquet(folder)
        )
        # a type of its own, as a folder of one day may hold anything that looks like a date
        schema = T.StructType([*fresh.schema.fields, T.StructField(_DAY, T.DateType())])
        written = self.spark.read.schema(schema).parquet(folder)
        counts = {r[_DAY]: r["count"] for r in written.groupBy(_DAY).count().collect()}
        return {day: counts.get(day, 0) for day in days}

    # streams and upkeep

    def start(self, events: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Merge an event stream batch by batch; rerun with the same folders for new data."""
        writer = events.writeStream.foreachBatch(self.merge).option(
            "checkpointLocation", checkpoint
        )
        if available_now:
            writer = writer.trigger(availableNow=True)
        return writer.start()

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove what none of the last ``keep`` commits names; returns the removed folders."""
        commits = self._commits()
        versions = [r[0] for r in commits.select("version").distinct().orderBy("version").collect()]
        recent = versions[-keep:] if keep else []
        rows = commits.filter(F.col(_DAY).isNotNull()).collect()
        needed = {(r["stored_in"], r[_DAY]) for r in rows if r["version"] in recent}
        gone = {(r["stored_in"], r[_DAY]) for r in rows} - needed
        folders = [self._folder(version, day) for version, day in sorted(gone)]
        folders = [folder for folder in folders if remove(self.spark, folder)]
        for version in versions:
            if version not in recent:
                remove(self.spark, f"{self.path}/commits/{version}")
        return folders
