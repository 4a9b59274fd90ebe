from datetime import datetime

import brute_force
import pytest
import sample
from sample import at
from test_sessionize import NARROW, random_rows

from playtrail.columns import EVENT_SCHEMA
from playtrail.operators.metrics import (
    number_sessions,
    session_bounds,
    session_metrics,
    session_table,
)
from playtrail.operators.ranking import events_within, longest_sessions
from playtrail.operators.sessionize import sessionize


def by_session(sessions):
    return {(r.user_id, r.session_id): tuple(r)[2:] for r in sessions.collect()}


def test_sample_matches_golden(spark):
    events = spark.createDataFrame(sample.EVENTS, EVENT_SCHEMA)
    for sessions in (session_metrics(sessionize(events)), session_table(events)):
        assert sorted(tuple(r) for r in sessions.collect()) == sample.METRICS
        assert [(f.name, f.dataType.simpleString()) for f in sessions.schema] == [
            ("user_id", "string"),
            ("session_id", "int"),
            ("min_timestamp", "timestamp"),
            ("max_timestamp", "timestamp"),
            ("session_duration", "bigint"),
        ]


@pytest.mark.parametrize("seed", [11, 12])
@pytest.mark.parametrize("minutes", [0.5, 20, 300])
def test_both_ways_match_brute_force(spark, seed, minutes):
    rows = random_rows(seed)
    events = spark.createDataFrame(rows, NARROW)
    expected = brute_force.sessions(rows, minutes * 60)
    assert by_session(session_table(events, minutes)) == expected
    assert by_session(session_metrics(sessionize(events, minutes))) == expected


def test_bounds_of_given_sessions(spark):
    rows = [
        ("u", "s1", at("2024-01-01 12:00:00")),
        ("u", "s1", at("2024-01-01 12:30:00")),
        ("u", "s2", at("2024-01-01 13:00:00")),
    ]
    events = spark.createDataFrame(rows, "user_id string, session_id string, timestamp timestamp")
    assert by_session(session_bounds(events)) == {
        ("u", "s1"): (rows[0][2], rows[1][2]),
        ("u", "s2"): (rows[2][2], rows[2][2]),
    }
    assert by_session(session_metrics(events))["u", "s1"][2] == 1800


def test_other_session_key(spark):
    rows = [("x", datetime(2024, 1, 1)), ("x", datetime(2024, 1, 2))]
    events = spark.createDataFrame(rows, "visit string, timestamp timestamp")
    assert [r.session_duration for r in session_metrics(events, ["visit"]).collect()] == [86_400]


def test_missing_columns_are_named(spark):
    events = spark.createDataFrame([("a", "b")], "user_id string, session_id string")
    with pytest.raises(ValueError, match="^Missing required columns in DataFrame: timestamp$"):
        session_metrics(events)
    with pytest.raises(
        ValueError, match="^Missing required columns in DataFrame: timestamp, visit$"
    ):
        session_bounds(events, ["user_id", "visit"])


def test_session_table_shuffles_cells_only(spark):
    events = spark.createDataFrame(sample.EVENTS, EVENT_SCHEMA)
    plan = session_table(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_min" in plan.split("Exchange hashpartitioning")[2]


def test_session_numbers_beyond_an_int_pass_through(spark):
    """A null cell of three billion rows: numbers go on from there."""
    rows = [
        ("u", None, None, None, 3_000_000_000),
        ("u", 0, at("2024-04-21 00:00:00"), at("2024-04-21 00:10:00"), 5),
        ("u", 1200, at("2024-04-21 00:25:00"), at("2024-04-21 00:39:00"), 2),
        ("u", 7200, at("2024-04-21 02:00:00"), at("2024-04-21 02:01:00"), 2),
    ]
    schema = "user_id string, __cell long, __first timestamp, __last timestamp, __rows long"
    sessions = number_sessions(spark.createDataFrame(rows, schema), "user_id", 1200)
    longest = longest_sessions(sessions, 2).collect()
    assert [(r.session_id, r.session_duration) for r in longest] == [
        (3_000_000_001, 2340),
        (3_000_000_002, 60),
    ]
    played = [("u", at("2024-04-21 00:30:00"), None, "a", "t", "s"), ("u", None, None, "a", "t", "s")]
    plays = events_within(spark.createDataFrame(played, EVENT_SCHEMA), longest_sessions(sessions, 1))
    assert plays.count() == 1
