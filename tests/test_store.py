"""The stored session table, and the scope of written intermediates."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_sessionize import NARROW, random_rows

from playtrail.operators.metrics import session_metrics
from playtrail.operators.sessionize import sessionize
from playtrail.operators.spans import merge_spans
from playtrail.plans.top_songs import run_session_reports
from playtrail.storage import Scratch, remove, scratch_dir, settle
from playtrail.streaming.sessions import sessions_by_window
from playtrail.streaming.store import SessionStore

SPANS = "user_id string, min_timestamp timestamp, max_timestamp timestamp"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def events_of(spark, rows):
    return spark.createDataFrame(rows, NARROW)


def spread_rows(seed, days=9):
    """Events over several days, with sessions across midnight, copies and null users."""
    pick = random.Random(seed)
    start = datetime(2024, 2, 27)
    return [
        (user, instant + timedelta(days=pick.randrange(days)) if instant else None)
        for user, instant in random_rows(seed, events=200, span_seconds=86_000)
    ] + [("night", start + timedelta(minutes=11 * k)) for k in range(500)]


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_give_the_sessions_of_all_events(spark, tmp_path, seed):
    rows = spread_rows(seed)
    pick = random.Random(seed)
    store = SessionStore(spark, str(tmp_path / "store"))
    batches = [rows[k::5] for k in range(5)]
    batches.append(pick.sample(rows, 60))  # a second delivery of some
    pick.shuffle(batches)
    for version, batch in enumerate(batches):
        store.merge(events_of(spark, batch), version)
        store.merge(events_of(spark, []), version)  # a committed version is left alone
    assert rows_of(store.sessions()) == rows_of(sessions_by_window(events_of(spark, rows)))


def test_a_batch_reads_and_rewrites_the_days_it_reaches(spark, tmp_path):
    start = datetime(2024, 1, 1, 12)
    store = SessionStore(spark, str(tmp_path))
    store.merge(events_of(spark, [("u", start + timedelta(days=k)) for k in range(30)]), 0)
    store.merge(events_of(spark, [("u", start + timedelta(days=29, minutes=5))]), 1)
    versions = store.days()
    assert len(versions) == 30
    assert [v for _, v in sorted(versions.items())] == [0] * 29 + [1]
    # an old event changes its own day only
    store.merge(events_of(spark, [("u", start + timedelta(days=3, minutes=9))]), 2)
    assert [v for _, v in sorted(store.days().items())] == [0, 0, 0, 2] + [0] * 25 + [1]
    # earlier days are not even looked at: their files may be gone
    for day in list(versions)[:3]:
        remove(spark, store._folder(0, day))
    store.merge(events_of(spark, [("v", start + timedelta(days=30))]), 3)
    assert len(store.days()) == 31


def test_sessions_move_to_the_day_they_end_in(spark, tmp_path):
    late, early = datetime(2024, 1, 1, 23, 55), datetime(2024, 1, 2, 0, 5)
    store = SessionStore(spark, str(tmp_path))
    store.merge(events_of(spark, [("u", late)]), 0)
    store.merge(events_of(spark, [("u", early)]), 1)
    assert [str(day) for day in store.days()] == ["2024-01-02"]
    assert rows_of(store.sessions()) == [("u", late, early, 600)]


def test_a_failed_batch_leaves_the_last_commit_and_can_be_repeated(spark, tmp_path):
    rows = spread_rows(5)
    store = SessionStore(spark, str(tmp_path / "store"))
    store.merge(events_of(spark, rows[:300]), 0)
    before = rows_of(store.sessions())
    later = events_of(spark, rows[300:])
    broken = later.withColumn(
        "timestamp", F.when(F.rand() >= 0, F.raise_error(F.lit("lost")).cast("timestamp"))
    )
    with pytest.raises(Exception, match="lost"):
        store.merge(broken, 1)
    assert rows_of(store.sessions()) == before
    # files of a version that was never committed are written over
    later.limit(3).write.parquet(store._folder(1))
    store.merge(later, 1)
    assert rows_of(store.sessions()) == rows_of(sessions_by_window(events_of(spark, rows)))


def test_vacuum_keeps_what_recent_commits_name(spark, tmp_path):
    rows = spread_rows(6)
    store = SessionStore(spark, str(tmp_path / "store"))
    for version in range(4):
        store.merge(events_of(spark, rows[version::4]), version)
    files = {str(p.parent) for p in Path(tmp_path).rglob("end_day=*/*.parquet")}
    removed = store.vacuum(keep=1)
    assert removed and {str(p.parent) for p in Path(tmp_path).rglob("end_day=*/*.parquet")} == (
        files - set(removed)
    )
    assert rows_of(store.sessions()) == rows_of(sessions_by_window(events_of(spark, rows)))
    store.merge(events_of(spark, rows[:9]), 4)
    assert rows_of(store.sessions()) == rows_of(sessions_by_window(events_of(spark, rows)))


def test_an_empty_store_and_batches_without_instants(spark, tmp_path):
    store = SessionStore(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError, match="Nothing is stored"):
        store.sessions()
    store.merge(events_of(spark, [("u", None)]), 0)
    empty = events_of(spark, []).selectExpr("user_id", "timestamp min_timestamp", "timestamp max_timestamp")
    assert store.sessions(empty.schema).collect() == []


def test_spans_merge_up_to_the_limit_and_no_further(spark):
    def at(second):
        return datetime(2024, 1, 1) + timedelta(seconds=second)

    spans = [("u", at(0), at(100)), ("u", at(20), at(40)), ("u", at(160), at(170)), ("u", at(231), at(231))]
    spans += [("u", at(0), at(100)), (None, at(0), at(5)), (None, at(6), at(6))]
    found = rows_of(merge_spans(spark.createDataFrame(spans, SPANS), 60))
    wanted = [("u", at(0), at(170)), ("u", at(231), at(231)), (None, at(0), at(6))]
    assert found == sorted(wanted, key=str)


# the scope of intermediates


def scratch_files(spark):
    return {p for p in Path(scratch_dir(spark)).rglob("*") if p.is_file()}


@pytest.mark.parametrize("how", ["memory", "disk", "table"])
def test_nothing_is_left_once_the_result_is_written(spark, tmp_path, how):
    before = scratch_files(spark)
    events = events_of(spark, random_rows(3)).selectExpr(
        "*", "'a' musicbrainz_track_id", "'t' track_name", "'x' artist_name"
    )
    paths = run_session_reports(spark, events, str(tmp_path / "out"), how=how)
    assert scratch_files(spark) == before
    assert spark.read.parquet(paths["sessions"]).count() > 0
    assert Path(paths["songs"]).name == "top_10_songs_in_50_longest_session.tsv"


def test_settle_keeps_the_result_and_releases_the_rest(spark, tmp_path):
    before = scratch_files(spark)
    kept = []

    def query(scratch):
        kept.append(scratch.keep(sessionize(events_of(spark, random_rows(4))), "memory"))
        kept.append(scratch.keep(kept[0].filter("new_session = 1"), "table"))
        return session_metrics(kept[0])

    result = settle(spark, query, path=str(tmp_path / "result"))
    assert scratch_files(spark) == before
    assert not kept[0].is_cached
    assert rows_of(result) == rows_of(session_metrics(sessionize(events_of(spark, random_rows(4)))))


@pytest.mark.parametrize("fails_at", ["stage", "result"])
def test_nothing_is_left_after_an_error(spark, tmp_path, fails_at):
    before = scratch_files(spark)
    broken = F.raise_error(F.lit("broken stage"))

    def query(scratch):
        fine = scratch.table(events_of(spark, random_rows(5)), "fine")
        kept = scratch.keep(fine, "memory")
        failing = kept.withColumn("user_id", F.when(F.col("timestamp").isNull(), broken))
        return scratch.table(failing, "failing") if fails_at == "stage" else failing

    with pytest.raises(Exception, match="broken stage"):
        settle(spark, query, path=str(tmp_path / "result"))
    assert scratch_files(spark) == before
    assert not (tmp_path / "result").exists()


def test_scopes_are_independent(spark):
    with Scratch(spark) as outer:
        table = outer.table(spark.range(5).toDF("n"))
        with Scratch(spark) as inner:
            inner.table(spark.range(9).toDF("n"))
        assert table.count() == 5
    assert not Path(outer.root).exists() and not Path(inner.root).exists()
