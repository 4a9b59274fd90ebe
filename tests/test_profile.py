import pytest
import sample
from sample import at

from playtrail.columns import EVENT_SCHEMA
from playtrail.operators import profile
from playtrail.operators.quality import quality_report


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(sample.EVENTS, EVENT_SCHEMA)


def test_counts_and_range(events):
    assert profile.row_count(events).first().row_count == 10
    assert tuple(profile.time_range(events).first()) == (
        at("2024-04-21 00:00:00"),
        at("2024-04-22 00:20:01"),
    )


def test_missing_values(events):
    missing = profile.missing_values(events)
    assert missing.columns == EVENT_SCHEMA.fieldNames()
    assert tuple(missing.first()) == (0, 0, 0, 0, 4, 0)
    assert tuple(profile.missing_pct(events).first()) == (0.0, 40.0)


def test_approximate_distinct(events):
    assert tuple(profile.approx_distinct(events).first()) == (2, 7, 4, 4, 4, 3)


def test_check_groups_distinct_values_without_sketches(spark):
    rows = [(k % 7 or None, f"v{k % 300}", None) for k in range(900)]
    df = spark.createDataFrame(rows, "few int, many string, none int")
    checked = profile.approx_distinct_check(df)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    sketching = [line for line in plan.splitlines() if "approx_count_distinct" in line and "keys=" in line]
    assert sketching and all("keys=[]" in line for line in sketching)
    assert [tuple(r) for r in checked.collect()] == [("few", 6, True), ("many", 300, True), ("none", 0, True)]
    nothing = profile.approx_distinct_check(df.filter("false")).collect()
    assert [tuple(r) for r in nothing] == [("few", 0, True), ("many", 0, True), ("none", 0, True)]


def test_track_ids_per_song(events):
    assert [tuple(r) for r in profile.track_ids_per_song(events).collect()] == [
        ("song-name-4", "artist-name-4", 2),
        ("song-name-1", "artist-name-1", 1),
        ("song-name-3", "artist-name-3", 1),
        ("song-name-1", "artist-name-2", 0),
    ]


def test_variants(events):
    found = [tuple(r)[1:3] for r in profile.song_variants(events, "song-name-1").collect()]
    assert found == [
        ("artist-name-1", None),
        ("artist-name-1", "musicbrainztrack-id-1"),
        ("artist-name-2", None),
    ]
    assert profile.song_variants(events, "song-name-1", "artist-name-2").count() == 1


def test_missing_track_name(spark):
    rows = [("u", at("2024-01-01 00:00:00"), None, "a", "t", None), *sample.EVENTS]
    events = spark.createDataFrame(rows, EVENT_SCHEMA)
    assert [r.musicbrainz_track_id for r in profile.missing_track_name(events).collect()] == ["t"]


def test_quality_report(events):
    report = quality_report(events)
    assert report.columns == ["column", "threshold", "observed", "passed"]
    assert [tuple(r) for r in report.collect()] == [
        ("timestamp", 1.0, 1.0, True),
        ("musicbrainz_track_id", 0.85, 0.6, False),
        ("track_name", 0.99, 1.0, True),
        ("artist_name", 0.99, 1.0, True),
    ]


def test_quality_report_of_own_expectations_and_of_nothing(spark, events):
    assert quality_report(events, {"musicbrainz_track_id": 0.6}).first().passed
    nothing = quality_report(spark.createDataFrame([], EVENT_SCHEMA)).collect()
    assert [(r.observed, r.passed) for r in nothing] == [(None, True)] * 4
    with pytest.raises(ValueError, match="absent"):
        quality_report(events, {"absent": 1.0})


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, `c``d` string")
    assert tuple(profile.missing_values(df).first()) == (0, 1)
    assert tuple(profile.missing_pct(df, ["a.b", "c`d"]).first()) == (0.0, 50.0)
    assert tuple(profile.approx_distinct(df).first()) == (2, 1)
    assert [tuple(r) for r in profile.approx_distinct_check(df).collect()] == [("a.b", 2, True), ("c`d", 1, True)]
    assert [r.observed for r in quality_report(df, {"a.b": 1.0, "c`d": 0.6}).collect()] == [1.0, 0.5]
