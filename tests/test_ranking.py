from datetime import datetime, timedelta

import pytest
import sample
from sample import at

from playtrail.columns import EVENT_SCHEMA, SONG_BY_ID, SONG_BY_NAME
from playtrail.operators.metrics import session_table
from playtrail.operators.ranking import (
    events_of_sessions,
    events_within,
    longest_sessions,
    song_counts,
    song_counts_by_name,
    songs_in_sessions,
    top_n,
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
from playtrail.sources import parquet


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(sample.EVENTS, EVENT_SCHEMA)


@pytest.fixture(scope="module")
def odd_events(spark):
    """Missing users, timestamps, ids and titles."""
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(240):
        user = None if i % 11 == 0 else f"u{i % 5}"
        instant = None if i % 13 == 0 else start + timedelta(minutes=i * i % 2_000)
        rows.append(
            (
                user,
                instant,
                None,
                f"artist-{i % 3}",
                None if i % 7 == 0 else f"track-{i % 9}",
                None if i % 17 == 0 else f"song-{i % 6}",
            )
        )
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def song(track, name, artist):
    return (f"musicbrainztrack-id-{track}", f"song-name-{name}", f"artist-name-{artist}")


def counted(events, sessions, songs):
    counts = songs_in_sessions(
        sessionize(events),
        longest_sessions(session_table(events), sessions),
        other_cols=SONG_BY_ID[1:],
    )
    return [tuple(r) for r in top_songs(counts, songs).collect()]


def test_top_n_puts_nulls_last_and_breaks_ties(spark):
    rows = [("b", 2), ("a", 2), ("c", None), ("d", 3), (None, 2)]
    df = spark.createDataFrame(rows, "name string, score int")
    assert [r.name for r in top_n(df, "score", 4, ["name"]).collect()] == ["d", None, "a", "b"]
    assert top_n(df, "score", 0).count() == 0
    with pytest.raises(ValueError):
        top_n(df, "score", -1)


def test_longest_means_duration(events):
    longest = longest_sessions(session_table(events), 3).collect()
    assert [(r.user_id, r.session_id) for r in longest] == [
        ("user-1", 1),
        ("user-2", 1),
        ("user-1", 2),
    ]


@pytest.mark.parametrize(
    ("sessions", "songs", "golden"),
    [
        (2, 1, [(*song(5, 4, 4), 2)]),
        (1, 9, [(*song(1, 1, 1), 1)]),
        (2, 9, [(*song(5, 4, 4), 2), (*song(1, 1, 1), 1), (*song(4, 4, 4), 1)]),
        (
            4,
            9,
            [
                (*song(3, 3, 3), 2),
                (*song(5, 4, 4), 2),
                (*song(1, 1, 1), 1),
                (*song(4, 4, 4), 1),
            ],
        ),
    ],
)
def test_song_ranking_by_id(events, sessions, songs, golden):
    assert counted(events, sessions, songs) == golden
    for ranked in (
        top_songs_in_longest_sessions(events, 20, sessions, songs),
        top_songs_of_sessionized(sessionize(events), None, sessions, songs),
    ):
        assert ranked.columns == list(SONG_BY_ID)
        assert [tuple(r) for r in ranked.collect()] == [g[:3] for g in golden]


def test_song_ranking_by_name_counts_plays_without_id(events):
    plays = events_in_longest_sessions(events, 20, 2)
    ranked = top_songs(song_counts_by_name(plays), 9, SONG_BY_NAME)
    assert [tuple(r) for r in ranked.collect()] == [
        ("song-name-1", "artist-name-1", 4),
        ("song-name-4", "artist-name-4", 3),
        ("song-name-1", "artist-name-2", 1),
    ]


def test_hand_made_sessions_rank_without_sessionizing_again(spark, events):
    """Sessions may come from elsewhere and carry their number as text."""
    rows = [
        ("user-2", "1", at("2024-04-21 00:00:00"), at("2024-04-21 00:40:00"), 2400),
        ("user-1", "1", at("2024-04-21 00:00:00"), at("2024-04-21 01:20:00"), 4800),
        ("user-1", "3", at("2024-04-22 00:20:01"), at("2024-04-22 00:20:01"), 0),
    ]
    sessions = spark.createDataFrame(
        rows,
        "user_id string, session_id string, min_timestamp timestamp, "
        "max_timestamp timestamp, session_duration long",
    )
    ranked = top_songs_of_sessionized(sessionize(events), sessions, 2, 1)
    assert [tuple(r) for r in ranked.collect()] == [song(5, 4, 4)]


def test_null_user_sessions_take_places_but_have_no_songs(spark):
    rows = [
        (None, at("2024-01-01 00:00:00"), None, "a", "t1", "s1"),
        (None, at("2024-01-01 00:19:00"), None, "a", "t1", "s1"),
        ("u", at("2024-01-01 00:00:00"), None, "a", "t2", "s2"),
        ("u", at("2024-01-01 00:10:00"), None, "a", "t2", "s2"),
    ]
    events = spark.createDataFrame(rows, EVENT_SCHEMA)
    assert longest_sessions(session_table(events), 1).first().user_id is None
    assert counted(events, 1, 5) == []
    assert top_songs_in_longest_sessions(events, 20, 1, 5).count() == 0
    assert counted(events, 2, 5) == [("t2", "s2", "a", 2)]
    assert top_songs_in_longest_sessions(events, 20, 2, 5).count() == 1


@pytest.mark.parametrize("number", [3, 20, 10_000])
def test_spans_and_keys_choose_the_same_events(odd_events, number):
    chosen = longest_sessions(session_table(odd_events), number)
    by_key = events_of_sessions(sessionize(odd_events), chosen)
    by_span = events_within(odd_events, chosen)
    ours, theirs = by_span, by_key.select(*by_span.columns)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    assert ours.count() > 0


def test_many_sessions_have_the_same_plan_and_rows(odd_events):
    few, many = (top_songs_in_longest_sessions(odd_events, 20, n, 20) for n in (30, 5_000))
    nodes = [
        [line.strip(" +-:*()0123456789").split(" ")[0] for line in plan.splitlines()]
        for plan in (df._jdf.queryExecution().optimizedPlan().toString() for df in (few, many))
    ]
    assert nodes[0] == nodes[1]
    numbered = sessionize(odd_events)
    chosen = longest_sessions(session_table(odd_events), 5_000)
    by_key = top_songs(song_counts(with_song_id(events_of_sessions(numbered, chosen)), SONG_BY_ID), 20)
    assert many.collect() == by_key.select(*many.columns).collect()
    executed = many._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in executed and "Cartesian" not in executed


def test_day_partitions_outside_the_chosen_sessions_are_not_read(spark, odd_events, tmp_path):
    path = str(tmp_path / "days")
    parquet.write_events(odd_events, path)
    stored = parquet.read_events(spark, path, keep_day=True)
    ranked = top_songs_in_longest_sessions(stored, 20, 3, 20, day_col=parquet.EVENT_DATE)
    direct = top_songs_in_longest_sessions(odd_events, 20, 3, 20)
    assert ranked.collect() == direct.collect()
    assert "dynamicpruning" in ranked._jdf.queryExecution().executedPlan().toString()


def test_only_bounded_sides_are_broadcast(odd_events):
    sessions = session_table(odd_events)
    hinted = events_of_sessions(sessionize(odd_events), longest_sessions(sessions, 5))
    unknown = events_of_sessions(sessionize(odd_events), sessions)
    beyond = events_of_sessions(sessionize(odd_events), longest_sessions(sessions, 10_000_000))
    hints = [df._jdf.queryExecution().logical().toString().count("broadcast") for df in (hinted, unknown, beyond)]
    assert hints[0] == hints[1] + 1 and hints[1] == hints[2]


def test_song_filter_keeps_other_plays_in_sessions(events):
    numbered = sessionize(events)
    assert with_song_id(numbered).count() == 6
    # The plays without an id still hold the first session together.
    assert numbered.filter("user_id = 'user-1'").agg({"session_id": "max"}).first()[0] == 3


def test_chosen_id_column_and_key(spark):
    rows = [("v1", "x"), ("v1", "x"), ("v2", "x"), ("v1", None)]
    plays = spark.createDataFrame(rows, "visit string, item string")
    chosen = spark.createDataFrame([("v1",)], "visit string")
    counts = songs_in_sessions(plays, chosen, song_id="item", keys=["visit"])
    assert [tuple(r) for r in counts.collect()] == [("x", 2)]


def test_identity_comparison(events):
    rows = compare_song_identity(events_in_longest_sessions(events, 20, 2), 9).collect()
    assert {tuple(r) for r in rows} == {
        ("song-name-1", "artist-name-1", 1, 4, "musicbrainztrack-id-1", 2, 1),
        ("song-name-4", "artist-name-4", 2, 3, "musicbrainztrack-id-5", 1, 2),
        ("song-name-4", "artist-name-4", 2, 3, "musicbrainztrack-id-4", 3, 1),
        ("song-name-1", "artist-name-2", 3, 1, None, None, None),
    }


def test_identity_comparison_reads_the_plays_once(spark, events, tmp_path):
    path = str(tmp_path / "plays")
    events.write.parquet(path)
    compared = compare_song_identity(spark.read.parquet(path), 5)
    compared.collect()
    final = compared._jdf.queryExecution().executedPlan().toString()
    assert final.split("== Initial Plan ==")[0].count("FileScan parquet") == 1
