
from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.columns import (
    EVENT_SCHEMA,
    GAP,
    NEW_SESSION,
    PREVIOUS,
    SONG_BY_ID,
    SONG_BY_NAME,
    TIMESTAMP,
    TRACK_NAME,
)
from playtrail import rollups
from playtrail.functions.timing import utc_day
from playtrail.operators import heavy, profile
from playtrail.operators.metrics import session_bounds, session_metrics, session_table
from playtrail.operators.quality import EXPECTED_PRESENT, quality_report
from playtrail.operators.ranking import (
    events_of_sessions,
    longest_sessions,
    song_counts_by_name,
    songs_in_sessions,
    top_songs,
    with_song_id,
)
from playtrail.operators.sessionize import sessionize
from playtrail.plans.identity import compare_song_identity
from playtrail.plans.top_songs import (
    events_in_longest_sessions,
    top_songs_in_longest_sessions,
    top_songs_of_sessionized,
)
from playtrail.sources import clustered, parquet, tsv
from playtrail.sources.listening import as_listening_events, read_listening_events
from playtrail.storage import Scratch, remove, scratch_path, settle
from playtrail.streaming.sessions import (
    sessions_by_window,
    start_session_sink,
    still_open,
    stream_sessions,
)
from playtrail.streaming.store import SessionStore

_LLM = importlib.util.find_spec("playtrail.llm")
if _LLM is not None and _LLM.origin is not None:
    from playtrail.llm import registry as _llm
else:
    _llm = None
# The pipeline consists of operators of that folder.
if _llm is not None and importlib.util.find_spec("corpus_pipeline") is not None:
    import corpus_pipeline as _pipeline
else:
    _pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"

SESSIONS = 50
SONGS = 10
DAYS = ("2024-01-05", "2024-01-11")


def entry(spark: SparkSession) -> DataFrame:
    """The songs played most in the longest sessions, on the smallest test data."""
    return top_songs_in_longest_sessions(read_listening_events(spark, SMOKE_DIR))


def _inputs(names: list[str]) -> list[str]:
    return [*EVENT_SCHEMA.fieldNames(), *names]


def _from_sessionized(query: Callable[[DataFrame], DataFrame], how: str = "table"):
    """A query on session numbers that are kept for all its parts and released at its end."""

    def run(events: DataFrame) -> DataFrame:
        def settled(scratch: Scratch) -> DataFrame:
            return query(scratch.keep(sessionize(events), how, "sessionized"))

        return settle(events.sparkSession, settled)

    return run


def _events_of_longest(numbered: DataFrame) -> DataFrame:
    chosen = longest_sessions(session_metrics(numbered), SESSIONS)
    return events_of_sessions(numbered, chosen)


def _counts_by_id(numbered: DataFrame) -> DataFrame:
    chosen = longest_sessions(session_metrics(numbered), SESSIONS)
    return songs_in_sessions(numbered, chosen, other_cols=SONG_BY_ID[1:])


def _counts_by_name(events: DataFrame) -> DataFrame:
    return song_counts_by_name(events_in_longest_sessions(events))


def _with_odd_titles(events: DataFrame) -> DataFrame:
    """Titles with quotes, tabs, backslashes, leading blanks and line breaks."""
    title = F.col(TRACK_NAME)
    kind = F.substring(title, 6, 9).cast("int") % 4
    odd = (
        F.when(kind == 0, F.concat(F.lit('"'), title, F.lit('"')))
        .when(kind == 1, F.concat(title, F.lit('\t"x')))
        .when(kind == 2, F.concat(F.lit(" "), title, F.lit("\\")))
        .otherwise(F.concat(title, F.lit("\r\nsecond\nthird")))
    )
    return events.withColumn(TRACK_NAME, F.when(title.isNotNull(), odd))


def _tsv_round_trip(events: DataFrame) -> DataFrame:
    spark = events.sparkSession
    path = scratch_path(spark, "events-tsv")
    as_text = F.date_format(TIMESTAMP, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    odd = _with_odd_titles(events).withColumn(TIMESTAMP, as_text)
    tsv.write_tsv(odd, path, header=False)
    read = tsv.read_events(spark, path, written=True)
    return read.withColumn(TIMESTAMP, F.col(TIMESTAMP).cast("timestamp_ntz"))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as profile text and read again."""
    path = scratch_path(spark, "users-tsv")
    number = F.col("c_custkey")
    profiles = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat(F.lit("user_"), number).alias("user_id"),
        F.when(number % 2 == 0, "f").otherwise("m").alias("gender"),
        F.when(number % 7 != 0, (number % 80).cast("string")).alias("age"),
        F.concat(F.lit("country "), "c_nationkey").alias("country"),
        F.date_format(
            F.date_add(F.lit("2005-01-01").cast("date"), (number % 3000).cast("int")), "MMM d, yyyy"
        ).alias("registered"),
    )
    tsv.write_tsv(profiles, path)
    return tsv.read_users(spark, path)


def _top_songs_by_day_store(events: DataFrame) -> DataFrame:
    path = scratch_path(events.sparkSession, "events-by-day")
    parquet.write_events(events, path)
    stored = parquet.read_events(events.sparkSession, path, keep_day=True)
    return top_songs_in_longest_sessions(stored, day_col=parquet.EVENT_DATE)


def _parquet_days(events: DataFrame, *days: str) -> DataFrame:
    path = scratch_path(events.sparkSession, "events-by-day")
    parquet.write_events(events, path)
    return parquet.read_events(events.sparkSession, path, *days)


BUCKETS = 16


def _clustered(query: Callable[[DataFrame], DataFrame]):
    """A query on events that are stored clustered by user and day."""

    def run(events: DataFrame) -> DataFrame:
        name = f"events_{uuid.uuid4().hex}"
        path = scratch_path(events.sparkSession, "clustered")
        return query(clustered.write_events(events, name, path, BUCKETS))

    return run


def _lines_round_trip(events: DataFrame) -> DataFrame:
    spark = events.sparkSession
    path = scratch_path(spark, "events-lines")
    as_text = F.date_format(TIMESTAMP, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    tsv.write_lines(_with_odd_titles(events).withColumn(TIMESTAMP, as_text), path)
    read = tsv.read_lines(spark, path)
    return read.withColumn(TIMESTAMP, F.col(TIMESTAMP).cast("timestamp_ntz"))


def _damaged_lines(events: DataFrame) -> DataFrame:
    """Event lines in four folders, some of them too short, too long or without a time."""
    spark = events.sparkSession
    path = scratch_path(spark, "damaged-lines")
    number = F.substring(TRACK_NAME, 6, 9).cast("int")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in events.columns]
    odd_time = [fields[0], F.lit("no time"), *fields[2:]]
    line = (
        F.when(number % 11 == 0, F.concat_ws("\t", *fields[:4]))
        .when(number % 13 == 0, F.concat_ws("\t", *fields, F.lit("more")))
        .when(number % 7 == 0, F.concat_ws("\t", *odd_time))
        .otherwise(F.concat_ws("\t", *fields))
    )
    source = F.coalesce(number % 4, F.lit(0)).alias("source")
    events.select(line.alias("line"), source).write.partitionBy("source").text(path)
    return tsv.scan_events(spark, f"{path}/*")


def _lines_per_source(events: DataFrame) -> DataFrame:
    per_file = tsv.lines_per_file(_damaged_lines(events))
    source = F.regexp_extract(tsv.FILE, r"source=(\d)", 1).cast("int").alias("source")
    return per_file.groupBy(source).agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")
    )


def _rejected_by_reason(events: DataFrame) -> DataFrame:
    lines = tsv.rejected(_damaged_lines(events))
    return lines.groupBy("reason").agg(F.count("*").alias("lines"))


def _accepted_lines(events: DataFrame) -> DataFrame:
    good = tsv.accepted(_damaged_lines(events))
    return good.withColumn(TIMESTAMP, F.col(TIMESTAMP).cast("timestamp_ntz"))


def _stored_days(rollup: DataFrame, *days: str) -> DataFrame:
    """A rollup written twice over, as if delivered again, and read back for some days."""
    path = scratch_path(rollup.sparkSession, "rollup")
    for _ in range(2):
        rollups.write_days(rollup, path)
    return rollups.read_days(rollup.sparkSession, path, *days)


def _distinct_from_sketches(events: DataFrame) -> DataFrame:
    """Distinct values over a range of days from stored sketches, held against exact counts."""
    found = rollups.distinct_values(_stored_days(rollups.distinct_sketches(events), *DAYS))
    in_range = rollups.day_of().between(*[F.lit(day).cast("date") for day in DAYS])
    return profile.held_against(profile.exact_distinct(events.filter(in_range)), found)


def _presence(events: DataFrame) -> DataFrame:
    return rollups.presence_counts(events, list(EXPECTED_PRESENT))


def _top_songs_of_days(events: DataFrame) -> DataFrame:
    """Bucket counts stored per day and added up, then exact counts of what may be on top."""
    spark, path = events.sparkSession, scratch_path(events.sparkSession, "bucket-counts")
    odd = F.unix_date(rollups.day_of()) % 2
    for k in range(2):
        own = events.filter((odd == k) & F.col(SONG_BY_ID[0]).isNotNull())
        heavy.bucket_counts(own).write.mode("append").parquet(path)
    timeless = events.filter(F.col(TIMESTAMP).isNull() & F.col(SONG_BY_ID[0]).isNotNull())
    heavy.bucket_counts(timeless).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    return heavy.top_songs_by_bound(events, SONGS, counts=stored)


def _incremental_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of time arrive out of order, one of them twice; the store takes up each once.

    What arrived before is out of reach by then, so nothing but the store can know of it.
    """
    whole = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = scratch_path(spark, "session-store")
    store = SessionStore(spark, f"{path}/store")
    for slice_ in (0, 2, 1, 2, 3):
        _slice_of(whole, slice_).write.parquet(f"{path}/in")
        arriving = spark.readStream.schema(whole.schema).parquet(f"{path}/in")
        store.start(as_listening_events(arriving), f"{path}/state").awaitTermination()
        remove(spark, f"{path}/in")
    return store.sessions()


def _merged_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from batches, each of them merged twice, and old versions removed."""
    events = as_listening_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    store = SessionStore(spark, scratch_path(spark, "session-store"))
    for version in range(SLICES):
        part = events.filter(F.pmod(F.xxhash64("timestamp"), F.lit(SLICES)) == version)
        for _ in range(2):
            store.merge(part, version)
        store.vacuum()
    return store.sessions()


def _streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the stream over the whole event table and return what its sink holds."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    arriving = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    sessions = stream_sessions(as_listening_events(arriving), lateness="1 hour")
    path = scratch_path(spark, "stream-sessions")
    start_session_sink(sessions, f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.schema(sessions.schema).parquet(f"{path}/out")


SLICES = 4


def _slice_of(events: DataFrame, k: int) -> DataFrame:
    """One of the slices of time that an event table arrives in."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    bounds = [None, *(first + (last - first) * i / SLICES for i in range(1, SLICES)), None]
    low, high = bounds[k], bounds[k + 1]
    now = F.lit(True)
    now = now if low is None else now & (F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
    now = now if high is None else now & (F.col("ts") < F.lit(high).cast("timestamp_ntz"))
    return events.filter(now | F.col("ts").isNull() if low is None else now)


def _complete_streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in slices of time, the stream is restarted for each; then what is open."""
    whole = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = scratch_path(spark, "stream-slices")
    for k in range(SLICES):
        _slice_of(whole, k).write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(whole.schema).parquet(f"{path}/in")
        sessions = stream_sessions(as_listening_events(arriving), lateness="1 hour")
        start_session_sink(sessions, f"{path}/out", f"{path}/state").awaitTermination()
    closed = spark.read.schema(sessions.schema).parquet(f"{path}/out")
    return closed.unionByName(still_open(as_listening_events(whole), closed))


_ON_EVENTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "events_scan": lambda e: e,
    "events_scan_tsv": _tsv_round_trip,
    "events_scan_lines": _lines_round_trip,
    "events_accepted_lines": _accepted_lines,
    "events_lines_per_source": _lines_per_source,
    "events_rejected_by_reason": _rejected_by_reason,
    "events_clustered": _clustered(clustered.plain_events),
    "events_by_day": _parquet_days,
    "events_in_date_range": lambda e: _parquet_days(e, *DAYS),
    "events_with_song_id": with_song_id,
    "events_missing_track_name": profile.missing_track_name,
    "song_variants": lambda e: profile.song_variants(e, "song-1"),
    "song_variants_by_artist": lambda e: profile.song_variants(e, "song-2", "artist-2"),
    "previous_timestamps": lambda e: sessionize(e).select(*_inputs([PREVIOUS])),
    "event_gaps": lambda e: sessionize(e).select(*_inputs([PREVIOUS, GAP])),
    "new_session_flags": lambda e: sessionize(e).select(*_inputs([GAP, NEW_SESSION])),
    "sessionize": sessionize,
    "sessionize_60m": lambda e: sessionize(e, 60),
    "sessionize_6h": lambda e: sessionize(e, 6 * 60),
    "sessionize_24h": lambda e: sessionize(e, 24 * 60),
    "sessionize_hot_cells": lambda e: sessionize(e, 6 * 60, parts=32),
    "sessionize_clustered": _clustered(clustered.sessionize_stored),
    "sessionize_clustered_6h": _clustered(lambda s: clustered.sessionize_stored(s, 6 * 60)),
    "session_table_clustered": _clustered(clustered.session_table_stored),
    "session_bounds": lambda e: session_bounds(sessionize(e)),
    "session_metrics": lambda e: session_metrics(sessionize(e)),
    "session_metrics_durable": _from_sessionized(session_metrics),
    "session_metrics_in_memory": _from_sessionized(session_metrics, "memory"),
    "session_metrics_on_disk": _from_sessionized(session_metrics, "disk"),
    "session_table": session_table,
    "session_table_6h": lambda e: session_table(e, 6 * 60),
    "session_table_24h": lambda e: session_table(e, 24 * 60),
    "sessions_by_window": sessions_by_window,
    "sessions_by_window_subsecond": lambda e: sessions_by_window(e, 0.5 / 60),
    "sessions_by_window_6h": lambda e: sessions_by_window(e, 6 * 60),
    "longest_sessions": lambda e: longest_sessions(session_table(e), SESSIONS),
    "events_in_longest_sessions": _from_sessionized(_events_of_longest),
    "events_within_longest_sessions": events_in_longest_sessions,
    "song_counts_by_id": _from_sessionized(_counts_by_id),
    "song_counts_by_name": _counts_by_name,
    "top_songs_by_id": _from_sessionized(lambda s: top_songs(_counts_by_id(s), SONGS)),
    "top_songs_by_name": lambda e: top_songs(_counts_by_name(e), SONGS, SONG_BY_NAME),
    "top_songs_in_longest_sessions": top_songs_in_longest_sessions,
    "top_songs_of_sessionized": _from_sessionized(top_songs_of_sessionized),
    "top_songs_5000_sessions": lambda e: top_songs_in_longest_sessions(e, 20, 5000, SONGS),
    "top_songs_by_day_store": _top_songs_by_day_store,
    "top_songs_6h": lambda e: top_songs_in_longest_sessions(e, 6 * 60, 100, 20),
    "top_songs_by_bound": lambda e: heavy.top_songs_by_bound(e, SONGS),
    "top_songs_by_bound_crowded": lambda e: heavy.top_songs_by_bound(e, SONGS, buckets=7),
    "top_songs_by_bound_of_days": _top_songs_of_days,
    "compare_song_identity": lambda e: compare_song_identity(
        events_in_longest_sessions(e), SONGS
    ),
    "profile_row_count": profile.row_count,
    "profile_time_range": profile.time_range,
    "profile_missing_values": profile.missing_values,
    "profile_missing_pct": profile.missing_pct,
    "profile_approx_distinct": lambda e: profile.held_against(
        profile.exact_distinct(e), profile.approx_distinct_bounds(e)
    ),
    "profile_distinct_sketches": _distinct_from_sketches,
    "profile_approx_distinct_check": profile.approx_distinct_check,
    "track_ids_per_song": profile.track_ids_per_song,
    "quality_report": quality_report,
    "quality_between_days": lambda e: rollups.quality_between(
        _stored_days(_presence(e), *DAYS), EXPECTED_PRESENT
    ),
    "quality_drift": lambda e: rollups.quality_drift(_stored_days(_presence(e)), days=3),
    "quality_by_day": lambda e: quality_report(e, per={"day": utc_day(F.col(TIMESTAMP))}),
}


_ON_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_sessions": _streamed_sessions,
    "stream_sessions_complete": _complete_streamed_sessions,
    "incremental_sessions": _incremental_sessions,
    "incremental_sessions_by_batch": _merged_sessions,
    "users_scan": _users,
    "users_typed": lambda spark, sf_dir: tsv.typed_users(_users(spark, sf_dir)),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_events(query):
        return lambda spark, sf_dir: query(read_listening_events(spark, sf_dir))

    registered = {name: over_events(query) for name, query in _ON_EVENTS.items()} | _ON_TABLES
    if _llm is not None:
        registered |= _llm.QUERIES
    if _pipeline is not None:
        registered["pipeline"] = _pipeline.run
    return registered


_EVENTS_CTE = """
k AS (
    SELECT user_id, ts, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events
),
e AS (
    SELECT CAST(user_id AS VARCHAR) AS user_id,
           ts AS "timestamp",
           CASE WHEN k % 5 <> 0 THEN 'aid-' || (k % 8) END AS musicbrainz_artist_id,
           'artist-' || (k % 8) AS artist_name,
           CASE WHEN k % 9 <> 0 THEN 'track-' || k END AS musicbrainz_track_id,
           CASE WHEN k <> 95 THEN 'song-' || (k % 40) END AS track_name
    FROM k
)"""


def _session_ctes(minutes: float) -> str:
    return f"""{_EVENTS_CTE},
lagged AS (
    SELECT *, lag("timestamp") OVER (
        PARTITION BY user_id ORDER BY "timestamp" NULLS FIRST) AS previous_timestamp
    FROM e
),
gaps AS (
    SELECT *, epoch_us("timestamp") // 1000000 - epoch_us(previous_timestamp) // 1000000
              AS time_diff_seconds
    FROM lagged
),
flags AS (
    SELECT *, CASE WHEN time_diff_seconds IS NULL OR time_diff_seconds > {minutes * 60}
              THEN 1 ELSE 0 END AS new_session
    FROM gaps
),
s AS (
    SELECT *, CAST(sum(new_session) OVER (
        PARTITION BY user_id ORDER BY "timestamp" NULLS FIRST) AS INTEGER) AS session_id
    FROM flags
),
bounds AS (
    SELECT user_id, session_id, min("timestamp") AS min_timestamp,
           max("timestamp") AS max_timestamp
    FROM s GROUP BY user_id, session_id
),
m AS (
    SELECT *, epoch_us(max_timestamp) // 1000000 - epoch_us(min_timestamp) // 1000000
              AS session_duration
    FROM bounds
)"""


def _ranking_ctes(minutes: int = 20, sessions: int = SESSIONS, songs: int = SONGS) -> str:
    return f"""{_session_ctes(minutes)},
longest AS (
    SELECT * FROM m
    ORDER BY session_duration DESC NULLS LAST, user_id NULLS FIRST, session_id NULLS FIRST
    LIMIT {sessions}
),
played AS (
    SELECT s.* FROM s JOIN longest l ON s.user_id = l.user_id AND s.session_id = l.session_id
),
by_id AS (
    SELECT musicbrainz_track_id, track_name, artist_name, count(*) AS song_count
    FROM played WHERE musicbrainz_track_id IS NOT NULL GROUP BY ALL
),
by_name AS (
    SELECT track_name, artist_name, count(*) AS song_count FROM played GROUP BY ALL
),
top_id AS (
    SELECT * FROM by_id
    ORDER BY song_count DESC, musicbrainz_track_id NULLS FIRST, track_name NULLS FIRST,
             artist_name NULLS FIRST
    LIMIT {songs}
),
top_name AS (
    SELECT * FROM by_name
    ORDER BY song_count DESC, track_name NULLS FIRST, artist_name NULLS FIRST
    LIMIT {songs}
)"""


def _on_events(body: str) -> str:
    return f"WITH {_EVENTS_CTE} {body}"


def _on_sessions(body: str, minutes: float = 20) -> str:
    return f"WITH {_session_ctes(minutes)} {body}"


def _on_ranking(body: str, **parameters: int) -> str:
    return f"WITH {_ranking_ctes(**parameters)} {body}"


def oracle_sql() -> dict[str, str]:
    statements = _session_sql()
    if _llm is not None:
        statements |= _llm.ORACLE_SQL
    if _pipeline is not None and _pipeline.ORACLE_SQL:
        statements["pipeline"] = _pipeline.ORACLE_SQL
    return statements


def _session_sql() -> dict[str, str]:
    inputs = ", ".join(f'"{name}"' for name in EVENT_SCHEMA.fieldNames())
    unnumbered = "SELECT user_id, min_timestamp, max_timestamp, session_duration FROM m"
    variants = (
        "SELECT DISTINCT musicbrainz_artist_id, artist_name, musicbrainz_track_id, track_name "
        "FROM e WHERE track_name = "
    )
    nulls = ", ".join(
        f'count(*) FILTER (WHERE "{name}" IS NULL) AS "{name}"'
        for name in EVENT_SCHEMA.fieldNames()
    )
    pct = ", ".join(
        f'round(count(*) FILTER (WHERE {name} IS NULL) / count(*) * 100, 2) AS {name}'
        for name in ("musicbrainz_artist_id", "musicbrainz_track_id")
    )
    expectations = " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", CAST({least} AS DOUBLE) AS threshold,
            count("{name}") / count(*) AS observed,
            count("{name}") / count(*) >= {least} AS passed FROM e"""
        for name, least in (
            ("timestamp", 1.0),
            ("musicbrainz_track_id", 0.85),
            ("track_name", 0.99),
            ("artist_name", 0.99),
        )
    )
    by_day = " UNION ALL ".join(
        f"""SELECT CAST("timestamp" AS DATE) AS day, '{name}' AS "column",
            CAST({least} AS DOUBLE) AS threshold, count("{name}") / count(*) AS observed,
            count("{name}") / count(*) >= {least} AS passed
            FROM e GROUP BY CAST("timestamp" AS DATE)"""
        for name, least in (
            ("timestamp", 1.0),
            ("musicbrainz_track_id", 0.85),
            ("track_name", 0.99),
            ("artist_name", 0.99),
        )
    )
    exact = " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(DISTINCT "{name}") AS exact, true AS in_bounds
            FROM e"""
        for name in EVENT_SCHEMA.fieldNames()
    )
    def held(table: str) -> str:
        return " UNION ALL ".join(
            f"""SELECT '{name}' AS "column", count(DISTINCT "{name}") AS exact,
                true AS lower_holds, true AS upper_holds FROM {table}"""
            for name in EVENT_SCHEMA.fieldNames()
        )

    present = " UNION ALL ".join(
        f"""SELECT CAST("timestamp" AS DATE) AS event_date, '{name}' AS "column",
            count("{name}") AS present, count(*) AS total
            FROM e WHERE "timestamp" IS NOT NULL GROUP BY 1"""
        for name in EXPECTED_PRESENT
    )
    drift = f""", p AS ({present}), b AS (
            SELECT d.event_date, d."column", d.present / d.total AS observed,
                   sum(x.present) / sum(x.total) AS observed_before
            FROM p d LEFT JOIN p x ON x."column" = d."column"
                 AND x.event_date BETWEEN d.event_date - 3 AND d.event_date - 1
            GROUP BY d.event_date, d."column", d.present, d.total
        )
        SELECT *, observed_before - observed AS "drop",
               coalesce(observed_before - observed <= 0.05, true) AS passed FROM b"""
    lines = """, l AS (
            SELECT *, CASE WHEN n % 11 = 0 THEN 'too few fields'
                           WHEN n % 13 = 0 THEN 'too many fields'
                           WHEN n % 7 = 0 THEN 'unreadable timestamp' END AS fault
            FROM (SELECT *, CAST(substr(track_name, 6) AS INTEGER) AS n FROM e)
        )"""
    most_played = f"""SELECT {", ".join(SONG_BY_ID)}, count(*) AS song_count FROM e
        WHERE musicbrainz_track_id IS NOT NULL GROUP BY ALL
        ORDER BY song_count DESC, musicbrainz_track_id NULLS FIRST, track_name NULLS FIRST,
                 artist_name NULLS FIRST
        LIMIT {SONGS}"""
    users = """d AS (
            SELECT 'user_' || c_custkey AS user_id,
                   DATE '2005-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS day FROM customer
        ), u AS (
            SELECT 'user_' || c_custkey AS user_id,
                   CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
                   CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 80 AS VARCHAR) END AS age,
                   'country ' || c_nationkey AS country,
                   strftime(DATE '2005-01-01' + CAST(c_custkey % 3000 AS INTEGER), '%b %-d, %Y')
                       AS registered
            FROM customer
        )"""
    ids = ", ".join(SONG_BY_ID)
    return {
        "events_scan": _on_events("SELECT * FROM e"),
        "events_scan_tsv": _on_events(
            """SELECT * REPLACE (CASE CAST(substr(track_name, 6) AS INTEGER) % 4
                   WHEN 0 THEN '"' || track_name || '"'
                   WHEN 1 THEN track_name || chr(9) || '"x'
                   WHEN 2 THEN ' ' || track_name || '\\'
                   WHEN 3 THEN track_name || chr(13) || chr(10) || 'second' || chr(10) || 'third'
               END AS track_name) FROM e"""
        ),
        "events_scan_lines": _on_events(
            """SELECT * REPLACE (CASE CAST(substr(track_name, 6) AS INTEGER) % 4
                   WHEN 0 THEN '"' || track_name || '"'
                   WHEN 1 THEN track_name || chr(9) || '"x'
                   WHEN 2 THEN ' ' || track_name || '\\'
                   WHEN 3 THEN track_name || chr(13) || chr(10) || 'second' || chr(10) || 'third'
               END AS track_name) FROM e"""
        ),
        "events_accepted_lines": _on_events(f"{lines} SELECT * EXCLUDE (n, fault) FROM l WHERE fault IS NULL"),
        "events_lines_per_source": _on_events(
            f"""{lines} SELECT CAST(coalesce(n % 4, 0) AS INTEGER) AS source,
                   count(*) FILTER (WHERE fault IS NULL) AS accepted, count(fault) AS rejected
            FROM l GROUP BY 1"""
        ),
        "events_rejected_by_reason": _on_events(
            f"{lines} SELECT fault AS reason, count(*) AS lines FROM l WHERE fault IS NOT NULL GROUP BY 1"
        ),
        "events_clustered": _on_events("SELECT * FROM e"),
        "events_by_day": _on_events("SELECT * FROM e"),
        "events_in_date_range": _on_events(
            f"SELECT * FROM e WHERE CAST(\"timestamp\" AS DATE) "
            f"BETWEEN DATE '{DAYS[0]}' AND DATE '{DAYS[1]}'"
        ),
        "events_with_song_id": _on_events(
            "SELECT * FROM e WHERE musicbrainz_track_id IS NOT NULL"
        ),
        "events_missing_track_name": _on_events("SELECT * FROM e WHERE track_name IS NULL"),
        "song_variants": _on_events(f"{variants} 'song-1'"),
        "song_variants_by_artist": _on_events(
            f"{variants} 'song-2' AND artist_name = 'artist-2'"
        ),
        "previous_timestamps": _on_sessions(f"SELECT {inputs}, previous_timestamp FROM s"),
        "event_gaps": _on_sessions(
            f"SELECT {inputs}, previous_timestamp, time_diff_seconds FROM s"
        ),
        "new_session_flags": _on_sessions(
            f"SELECT {inputs}, time_diff_seconds, new_session FROM s"
        ),
        "sessionize": _on_sessions("SELECT * FROM s"),
        "sessionize_60m": _on_sessions("SELECT * FROM s", 60),
        "sessionize_6h": _on_sessions("SELECT * FROM s", 6 * 60),
        "sessionize_24h": _on_sessions("SELECT * FROM s", 24 * 60),
        "sessionize_hot_cells": _on_sessions("SELECT * FROM s", 6 * 60),
        "sessionize_clustered": _on_sessions("SELECT * FROM s"),
        "sessionize_clustered_6h": _on_sessions("SELECT * FROM s", 6 * 60),
        "session_table_clustered": _on_sessions("SELECT * FROM m"),
        "session_bounds": _on_sessions("SELECT * FROM bounds"),
        "session_metrics": _on_sessions("SELECT * FROM m"),
        "session_metrics_durable": _on_sessions("SELECT * FROM m"),
        "session_metrics_in_memory": _on_sessions("SELECT * FROM m"),
        "session_metrics_on_disk": _on_sessions("SELECT * FROM m"),
        "session_table": _on_sessions("SELECT * FROM m"),
        "session_table_6h": _on_sessions("SELECT * FROM m", 6 * 60),
        "session_table_24h": _on_sessions("SELECT * FROM m", 24 * 60),
        "sessions_by_window": _on_sessions(unnumbered),
        "sessions_by_window_6h": _on_sessions(unnumbered, 6 * 60),
        "stream_sessions": _on_sessions(
            f"""{unnumbered}
            WHERE date_trunc('second', max_timestamp) + INTERVAL 1200500 MILLISECOND
                  <= (SELECT date_trunc('second', max("timestamp")) FROM e) - INTERVAL 1 HOUR"""
        ),
        "stream_sessions_complete": _on_sessions(unnumbered),
        "incremental_sessions": _on_sessions(unnumbered),
        "incremental_sessions_by_batch": _on_sessions(unnumbered),
        "sessions_by_window_subsecond": _on_sessions(unnumbered, 0.5 / 60),
        "longest_sessions": _on_ranking("SELECT * FROM longest"),
        "events_in_longest_sessions": _on_ranking("SELECT * FROM played"),
        "events_within_longest_sessions": _on_ranking(f"SELECT {inputs} FROM played"),
        "song_counts_by_id": _on_ranking("SELECT * FROM by_id"),
        "song_counts_by_name": _on_ranking("SELECT * FROM by_name"),
        "top_songs_by_id": _on_ranking("SELECT * FROM top_id"),
        "top_songs_by_name": _on_ranking("SELECT * FROM top_name"),
        "top_songs_in_longest_sessions": _on_ranking(f"SELECT {ids} FROM top_id"),
        "top_songs_of_sessionized": _on_ranking(f"SELECT {ids} FROM top_id"),
        "top_songs_5000_sessions": _on_ranking(f"SELECT {ids} FROM top_id", sessions=5000),
        "top_songs_by_day_store": _on_ranking(f"SELECT {ids} FROM top_id"),
        "top_songs_6h": _on_ranking(
            f"SELECT {ids} FROM top_id", minutes=6 * 60, sessions=100, songs=20
        ),
        "top_songs_by_bound": _on_events(most_played),
        "top_songs_by_bound_crowded": _on_events(most_played),
        "top_songs_by_bound_of_days": _on_events(most_played),
        "compare_song_identity": _on_ranking(
            """, n AS (
                SELECT *, row_number() OVER (ORDER BY song_count DESC,
                    track_name NULLS FIRST, artist_name NULLS FIRST) AS r FROM top_name
            ), i AS (
                SELECT *, row_number() OVER (ORDER BY song_count DESC,
                    musicbrainz_track_id, track_name NULLS FIRST, artist_name NULLS FIRST) AS r
                FROM top_id
            )
            SELECT coalesce(n.track_name, i.track_name) AS track_name,
                   coalesce(n.artist_name, i.artist_name) AS artist_name,
                   CAST(n.r AS INTEGER) AS rank_by_name, n.song_count AS count_by_name,
                   i.musicbrainz_track_id, CAST(i.r AS INTEGER) AS rank_by_id,
                   i.song_count AS count_by_id
            FROM n FULL JOIN i ON n.track_name IS NOT DISTINCT FROM i.track_name
                              AND n.artist_name IS NOT DISTINCT FROM i.artist_name"""
        ),
        "profile_row_count": _on_events("SELECT count(*) AS row_count FROM e"),
        "profile_time_range": _on_events(
            'SELECT min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp FROM e'
        ),
        "profile_missing_values": _on_events(f"SELECT {nulls} FROM e"),
        "profile_missing_pct": _on_events(f"SELECT {pct} FROM e"),
        "track_ids_per_song": _on_events(
            "SELECT track_name, artist_name, "
            "count(DISTINCT musicbrainz_track_id) AS distinct_track_id FROM e GROUP BY ALL"
        ),
        "quality_report": _on_events(expectations),
        "quality_by_day": _on_events(by_day),
        "profile_approx_distinct_check": _on_events(exact),
        "profile_approx_distinct": _on_events(held("e")),
        "profile_distinct_sketches": _on_events(
            f"""SELECT * FROM (WITH r AS (SELECT * FROM e WHERE CAST("timestamp" AS DATE)
                BETWEEN DATE '{DAYS[0]}' AND DATE '{DAYS[1]}') {held("r")})"""
        ),
        "quality_between_days": _on_events(
            f"""SELECT * FROM (WITH e_all AS (SELECT * FROM e), r AS (SELECT * FROM e_all
                WHERE CAST("timestamp" AS DATE) BETWEEN DATE '{DAYS[0]}' AND DATE '{DAYS[1]}')
                {expectations.replace("FROM e", "FROM r")})"""
        ),
        "quality_drift": _on_events(f"{drift}"),
        "users_scan": f"WITH {users} SELECT * FROM u",
        "users_typed": f"""WITH {users}
            SELECT user_id, gender, CAST(age AS INTEGER) AS age, country, day AS registered
            FROM u JOIN d USING (user_id)""",
    }
