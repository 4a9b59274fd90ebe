"""Stored per-day aggregates, exact top songs from bounds, and clustered event tables."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
import sample
from pyspark.sql import functions as F
from test_sessionize import NARROW, expected, random_rows

from playtrail import rollups
from playtrail.columns import EVENT_SCHEMA, SONG_BY_ID
from playtrail.operators import heavy, profile
from playtrail.operators.metrics import session_table
from playtrail.operators.quality import EXPECTED_PRESENT, quality_report
from playtrail.operators.ranking import song_counts_by_id, top_songs
from playtrail.operators.sessionize import sessionize
from playtrail.sources import clustered

START = datetime(2024, 3, 1)


def played(spark, rows):
    """Events from (day, user, song) with an id that may be missing."""
    return spark.createDataFrame(
        [
            (f"u{u}", None if d is None else START + timedelta(days=d, hours=u % 20), "a", f"artist {s}", s, f"song {s}")
            for d, u, s in rows
        ],
        EVENT_SCHEMA,
    )


def plays(seed, n=3000, songs=400, days=6):
    pick = random.Random(seed)
    return [
        (
            pick.randrange(days) if pick.random() > 0.02 else None,
            pick.randrange(80),
            None if pick.random() < 0.1 else f"t{min(int(pick.paretovariate(0.6)), songs)}",
        )
        for _ in range(n)
    ]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# distinct values


def test_sketches_of_days_unite_to_those_of_a_range(spark, tmp_path):
    events = played(spark, plays(1))
    path = str(tmp_path / "sketches")
    rollups.write_days(rollups.distinct_sketches(events), path)
    for first, last in ((None, None), ("2024-03-02", "2024-03-04"), ("2024-03-03", None)):
        stored = rollups.read_days(spark, path, first, last)
        found = {r.column: r for r in rollups.distinct_values(stored).collect()}
        part = events
        if first:
            part = part.filter(F.to_date("timestamp") >= first)
        if last:
            part = part.filter(F.to_date("timestamp") <= last)
        exact = {r.column: r.exact for r in profile.exact_distinct(part).collect()}
        assert set(found) == set(exact) == set(EVENT_SCHEMA.fieldNames())
        for name, n in exact.items():
            assert found[name].at_least <= n <= found[name].at_most


def test_sketches_without_values_and_without_rows(spark):
    events = played(spark, [(0, 1, None), (None, 2, "t1")])
    found = rollups.distinct_values(rollups.distinct_sketches(events, ["musicbrainz_track_id"]))
    assert [(r.column, r.estimate) for r in found.collect()] == [("musicbrainz_track_id", 1)]
    nothing = rollups.distinct_values(rollups.distinct_sketches(events.filter("false")))
    assert nothing.collect() == []
    only_null = events.filter("musicbrainz_track_id is null")
    found = rollups.distinct_values(rollups.distinct_sketches(only_null, ["musicbrainz_track_id"]))
    assert [(r.estimate, r.at_least) for r in found.collect()] == [(0, 0)]


def test_bounds_of_the_estimate_hold(spark):
    events = played(spark, plays(2))
    held = profile.held_against(profile.exact_distinct(events), profile.approx_distinct_bounds(events))
    assert all(r.lower_holds and r.upper_holds for r in held.collect())
    assert held.count() == len(events.columns)


# quality


def test_a_day_delivered_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "presence")
    columns = list(EXPECTED_PRESENT)
    rows = plays(3)
    rollups.write_days(rollups.presence_counts(played(spark, rows), columns), path)
    again = [r for r in rows if r[0] in (1, 2)]
    rollups.write_days(rollups.presence_counts(played(spark, again), columns), path)
    stored = rollups.read_days(spark, path)
    whole = quality_report(played(spark, rows)).select("column", "threshold", "observed", "passed")
    assert rows_of(rollups.quality_between(stored, EXPECTED_PRESENT)) == rows_of(whole)
    some = rollups.quality_between(
        rollups.read_days(spark, path, "2024-03-02", "2024-03-03"), EXPECTED_PRESENT
    )
    assert rows_of(some) == rows_of(
        quality_report(played(spark, again)).select("column", "threshold", "observed", "passed")
    )


def test_reports_read_no_events(spark, tmp_path):
    path = str(tmp_path / "presence")
    rollups.write_days(rollups.presence_counts(played(spark, plays(4)), ["track_name"]), path)
    report = rollups.quality_drift(rollups.read_days(spark, path, "2024-03-02"))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_drift_is_the_fall_against_the_days_before(spark):
    day = [date(2024, 3, k) for k in (1, 2, 3, 5, 20)]
    rows = [(day[0], 90, 100), (day[1], 45, 50), (day[2], 30, 50), (day[3], 50, 50), (day[4], 1, 2)]
    counts = spark.createDataFrame(
        [(d, "c", p, t) for d, p, t in [*rows, (None, 0, 9)]],
        "event_date date, column string, present long, total long",
    )
    found = {r.event_date: r for r in rollups.quality_drift(counts, days=7).collect()}
    assert set(found) == set(day)
    assert found[day[0]].observed_before is None and found[day[0]].passed
    assert found[day[1]].observed_before == 0.9 and found[day[1]].passed
    assert found[day[2]].drop == pytest.approx(0.3) and not found[day[2]].passed
    assert found[day[3]].observed_before == pytest.approx(165 / 200)
    assert found[day[4]].observed_before is None and found[day[4]].passed


# the most played songs


@pytest.mark.parametrize("buckets", [1, 3, 64, heavy.BUCKETS])
@pytest.mark.parametrize("n", [0, 1, 10, 1000])
def test_songs_on_top_are_those_of_all_counts(spark, buckets, n):
    """Whatever songs share a bucket; with one bucket, all are counted."""
    events = played(spark, plays(5))
    wanted = top_songs(song_counts_by_id(events), n)
    assert heavy.top_songs_by_bound(events, n, buckets=buckets).collect() == wanted.collect()


def test_ties_with_the_last_place_are_counted(spark):
    rows = [(0, 1, f"t{k:02}") for k in range(40) for _ in range(5)] + [(0, 1, "t99")] * 9
    events = played(spark, rows)
    wanted = top_songs(song_counts_by_id(events), 3).collect()
    assert [r.musicbrainz_track_id for r in wanted] == ["t99", "t00", "t01"]
    for buckets in (2, 8, 4096):
        assert heavy.top_songs_by_bound(events, 3, buckets=buckets).collect() == wanted


def test_bucket_counts_add_up_and_bound_each_song(spark):
    events = played(spark, plays(6)).filter("musicbrainz_track_id is not null")
    whole = heavy.bucket_counts(events, buckets=50)
    half = [heavy.bucket_counts(events.filter(F.dayofmonth("timestamp") % 2 == k), buckets=50) for k in (0, 1)]
    half.append(heavy.bucket_counts(events.filter("timestamp is null"), buckets=50))
    merged = heavy.merged(half[0].union(half[1]).union(half[2]))
    assert rows_of(merged) == rows_of(whole)
    bound = {(r.hash_row, r.bucket): r.plays for r in whole.collect()}
    songs = song_counts_by_id(events).select(
        "song_count", *[heavy._bucket(SONG_BY_ID, k, 50).alias(f"b{k}") for k in range(2)]
    )
    assert all(r.song_count <= min(bound[0, r.b0], bound[1, r.b1]) for r in songs.collect())
    stored = heavy.top_songs_by_bound(events, 7, counts=half[0].union(half[1]).union(half[2]), buckets=50)
    assert stored.collect() == top_songs(song_counts_by_id(events), 7).collect()


def test_few_songs_are_counted_of_many(spark, tmp_path):
    """The second look counts what may be on top, and not the many others."""
    rows = [(0, 1, f"rare{k}") for k in range(3000)] + [(0, 1, f"t{k}") for k in range(20) for _ in range(50 + k)]
    events = played(spark, rows)
    table = heavy.bucket_counts(events)
    least = spark.createDataFrame([(60,)], "__sum long")
    left = heavy._with_bound(events.select(*SONG_BY_ID), table, SONG_BY_ID, least, heavy.BUCKETS, heavy.ROWS)
    assert left.distinct().count() <= 30
    plan = heavy.top_songs_by_bound(events, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan


# events clustered by user and day


def wide_rows(seed):
    pick = random.Random(seed)
    return [
        (user, instant + timedelta(days=pick.randrange(3)) if instant else None, k)
        for k, (user, instant) in enumerate(random_rows(seed, events=150, span_seconds=86_399))
    ] + [("night", START + timedelta(minutes=11 * k), k) for k in range(400)]


@pytest.fixture
def stored(spark, tmp_path):
    made = []

    def store(rows, buckets=8):
        events = spark.createDataFrame(rows, NARROW + ", note int")
        made.append(f"clustered_{len(made)}_{abs(hash(str(tmp_path)))}")
        return clustered.write_events(events, made[-1], str(tmp_path / made[-1]), buckets)

    yield store
    for table in made:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.mark.parametrize("minutes", [0.5, 20, 300, 1500])
def test_clustered_sessions_are_those_of_events(spark, stored, minutes):
    rows = wide_rows(7)
    table = stored(rows)
    found = Counter(
        (r.user_id, r.timestamp, r.previous_timestamp, r.time_diff_seconds, r.new_session, r.session_id)
        for r in clustered.sessionize_stored(table, minutes).collect()
    )
    assert found == expected([r[:2] for r in rows], minutes)
    events = clustered.plain_events(table)
    assert rows_of(clustered.session_table_stored(table, minutes)) == rows_of(session_table(events, minutes))
    assert clustered.sessionize_stored(table).columns == sessionize(events).columns


def exchanges(df):
    """What each exchange of a plan moves, as the formatted plan tells it."""
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    parts = [p.strip() for p in plan.split("\n\n") if p.strip()]
    return [p for p in parts if "Exchange" in p.splitlines()[0]]


def test_events_are_not_moved(spark, stored):
    """No exchange holds the events' own columns; only cells and carried rows move."""
    table = stored(wide_rows(8))
    result = clustered.sessionize_stored(table)
    moved = exchanges(result)
    assert moved and not any("note#" in part for part in moved)
    assert any("note#" in part for part in exchanges(sessionize(clustered.plain_events(table))))
    assert not any("timestamp#" in p for p in exchanges(clustered.session_table_stored(table)))


def test_the_table_opens_by_its_path(spark, stored, tmp_path):
    table = stored(wide_rows(9))
    name = [t.name for t in spark.catalog.listTables() if t.name.startswith("clustered_0_")][-1]
    spark.sql("DROP TABLE IF EXISTS reopened")
    again = clustered.open_events(
        spark, "reopened", str(tmp_path / name), 8, "user_id STRING, timestamp TIMESTAMP, note INT"
    )
    found = clustered.sessionize_stored(again)
    assert rows_of(found) == rows_of(clustered.sessionize_stored(table))
    assert not any("note#" in part for part in exchanges(found))
    spark.sql("DROP TABLE reopened")


def test_a_day_of_one_user_lies_in_one_bucket_and_days_in_several(spark, stored):
    rows = [("hot", START + timedelta(days=k % 30, minutes=k), k) for k in range(3000)]
    table = stored(rows)
    files = table.select(F.col("_metadata.file_path").alias("f"), clustered.DAY)
    assert files.select("f").distinct().count() > 4
    per_day = files.groupBy(clustered.DAY).agg(F.count_distinct("f").alias("n"))
    assert per_day.agg(F.max("n")).first()[0] == 1


def test_sample_of_clustered_events(spark, tmp_path):
    events = spark.createDataFrame(sample.EVENTS, EVENT_SCHEMA)
    table = clustered.write_events(events, "clustered_sample", str(tmp_path / "t"), 4)
    found = clustered.sessionize_stored(table).orderBy("user_id", "timestamp").collect()
    assert [r.session_id for r in found] == sample.SESSION_IDS
    spark.sql("DROP TABLE clustered_sample")
