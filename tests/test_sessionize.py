import random
from collections import Counter
from datetime import datetime, timedelta

import brute_force
import pyarrow as pa
import pytest
import sample
from pyspark.sql import functions as F
from sample import at

from playtrail.columns import EVENT_SCHEMA
from playtrail.operators import scan
from playtrail.operators.sessionize import sessionize

NARROW = "user_id string, timestamp timestamp"
MANY = 40  # parts, so that most users lie in several


def traced(spark, rows, minutes=20, **options):
    result = sessionize(spark.createDataFrame(rows, NARROW), minutes, **options)
    return Counter(
        (r.user_id, r.timestamp, r.previous_timestamp, r.time_diff_seconds, r.new_session, r.session_id)
        for r in result.collect()
    )


def expected(rows, minutes=20):
    return Counter(brute_force.sessionize(rows, minutes * 60))


def random_rows(seed, users=4, events=300, span_seconds=40_000):
    """Bursts, ties, whole copies, missing users and missing timestamps."""
    pick = random.Random(seed)
    start = datetime(2024, 3, 1)
    rows = []
    for _ in range(events):
        user = pick.choice([*(f"u{i}" for i in range(users)), None])
        if pick.random() < 0.05:
            instant = None
        else:
            instant = start + timedelta(
                seconds=pick.choice([pick.randrange(span_seconds), pick.randrange(60), 7_200]),
                microseconds=pick.choice([0, 0, 999_999, pick.randrange(1_000_000)]),
            )
        rows.extend([(user, instant)] * pick.choice([1, 1, 1, 5]))
    return rows


def test_sample_matches_golden(spark):
    result = sessionize(spark.createDataFrame(sample.EVENTS, EVENT_SCHEMA))
    rows = result.orderBy("user_id", "timestamp").collect()
    previous = [None, *[e[1] for e in sample.EVENTS[:-1]]]
    previous[7] = None
    golden = [
        (*event, *derived)
        for event, *derived in zip(
            sample.EVENTS, previous, sample.GAPS, sample.FLAGS, sample.SESSION_IDS
        )
    ]
    assert [tuple(r) for r in rows] == golden


def test_added_columns_have_declared_types(spark):
    result = sessionize(spark.createDataFrame(sample.EVENTS, EVENT_SCHEMA))
    assert [(f.name, f.dataType.simpleString()) for f in result.schema][-4:] == [
        ("previous_timestamp", "timestamp"),
        ("time_diff_seconds", "bigint"),
        ("new_session", "int"),
        ("session_id", "int"),
    ]
    assert result.columns[:6] == EVENT_SCHEMA.fieldNames()


@pytest.mark.parametrize("parts", [1, 3, MANY])
def test_null_timestamps_share_the_last_of_their_numbers(spark, parts):
    midnight = at("2024-04-21 00:00:00")
    late = at("2024-04-21 00:40:01")
    rows = [
        ("a", None),
        ("a", None),
        ("a", midnight),
        ("a", midnight),
        ("a", at("2024-04-21 00:20:00")),
        ("a", late),
        ("a", late),
    ]
    assert traced(spark, rows, parts=parts) == Counter(
        [
            ("a", None, None, None, 1, 2),
            ("a", None, None, None, 1, 2),
            ("a", midnight, None, None, 1, 3),
            ("a", midnight, midnight, 0, 0, 3),
            ("a", at("2024-04-21 00:20:00"), midnight, 1200, 0, 3),
            ("a", late, at("2024-04-21 00:20:00"), 1201, 1, 4),
            ("a", late, late, 0, 0, 4),
        ]
    )


def test_null_user_is_a_user(spark):
    rows = [(None, at("2024-04-21 00:00:00")), (None, at("2024-04-21 00:01:00"))]
    assert traced(spark, rows) == expected(rows)


@pytest.mark.parametrize(
    ("first", "second", "gap", "session"),
    [
        ("00:00:00.000000", "00:20:00.999000", 1200, 1),
        ("00:00:00.900000", "00:20:01.000000", 1201, 2),
    ],
)
def test_gaps_are_of_whole_seconds(spark, first, second, gap, session):
    rows = [("a", datetime.fromisoformat(f"2024-04-21 {t}")) for t in (first, second)]
    last = max(traced(spark, rows), key=lambda r: r[1])
    assert (last[3], last[5]) == (gap, session)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("minutes", [0.5, 20, 300])
def test_matches_brute_force(spark, seed, minutes):
    rows = random_rows(seed)
    assert traced(spark, rows, minutes) == expected(rows, minutes)


@pytest.mark.parametrize("parts", [1, 7, MANY])
@pytest.mark.parametrize("minutes", [20, 300])
def test_any_number_of_parts_gives_the_same_rows(spark, parts, minutes):
    rows = random_rows(3)
    assert traced(spark, rows, minutes, parts=parts) == expected(rows, minutes)


@pytest.mark.parametrize("batch", [1, 5, 64])
def test_any_size_of_batches_gives_the_same_rows(spark, batch):
    """Runs without a timestamp go over the ends of batches and parts."""
    rows = random_rows(4, users=3, events=90)
    rows += [(user, None) for user, _ in rows if user != "u1"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        for parts in (1, 9):
            assert traced(spark, rows, parts=parts) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_part_scan_against_brute_force_without_spark():
    """Parts and batches of every size, by the scan itself: edges tell what is left open."""
    pick = random.Random(12)
    for _ in range(60):
        rows = random_rows(pick.randrange(10**6), users=2, events=25)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0))
        table = pa.table(
            {
                "user_id": pa.array([u for u, _ in rows], pa.string()),
                "timestamp": pa.array([t for _, t in rows], pa.timestamp("us")),
                "__row": pa.array(range(len(rows)), pa.int64()),
            }
        )
        size = pick.randrange(1, 9)
        found = list(scan._scan_parts(1200, 0, 1, 2)(iter(table.to_batches(max_chunksize=size))))
        out = pa.Table.from_batches(found).to_pylist()
        edges = [r for r in out if r["__edge"]]
        assert 1 <= len(edges) <= 2 and edges[0]["__edge"]["first"]
        plain = [r for r in out if not r["__edge"]]
        assert sorted(r["__row"] for r in plain) == list(range(len(rows)))
        whole = Counter((u, t, p, s) for u, t, p, *_, s in brute_force.sessionize(rows, 1200))
        first = edges[0]["user_id"]
        by_user = Counter(u for u, t in rows if t is None)

        def number(r):
            if r["timestamp"] is None:
                return by_user[r["user_id"]]
            return r["session_id"] + (r["user_id"] == first)

        settled = [r for r in plain if r["__role"] == 0]
        assert all(number(r) == r["session_id"] for r in settled)
        told = Counter(
            (r["user_id"], r["timestamp"], r["previous_timestamp"], number(r)) for r in plain
        )
        # the part's first row opens a session; its own edge says so
        opens = rows[0][1] is not None or by_user[first]
        assert opens and told == whole


def test_one_user_with_copies_of_one_event(spark):
    """A third of all rows is one event over and over."""
    midnight = datetime(2024, 1, 1)
    rows = [("hot", midnight + timedelta(hours=1))] * 400
    rows += [("hot", midnight + timedelta(seconds=s)) for s in range(0, 8_000, 40)]
    rows += [(f"u{i % 50}", midnight + timedelta(seconds=i * 37)) for i in range(600)]
    random.Random(5).shuffle(rows)
    events = spark.createDataFrame(rows, NARROW).repartition(7)
    result = sessionize(events, 20, parts=MANY)
    found = Counter(tuple(r) for r in result.collect())
    assert found == expected(rows)


def test_other_columns_stay_with_their_event(spark):
    rows = [(f"u{i % 3}", datetime(2024, 1, 1) + timedelta(minutes=7 * i), i) for i in range(60)]
    events = spark.createDataFrame(rows, NARROW + ", note int")
    for parts in (None, MANY):
        found = {tuple(r) for r in sessionize(events, parts=parts).collect()}
        assert found == set(brute_force.sessionize(rows, 1200))


def test_user_column_can_be_chosen(spark):
    rows = [(1, at("2024-04-21 00:00:00")), (1, at("2024-04-21 00:30:00"))]
    events = spark.createDataFrame(rows, "listener int, timestamp timestamp")
    result = sessionize(events, user_col="listener")
    assert sorted(r.session_id for r in result.collect()) == [1, 2]


def test_longer_threshold_never_adds_sessions(spark):
    events = spark.createDataFrame(random_rows(6), NARROW)
    counts = [
        sessionize(events, m).select("user_id", "session_id").distinct().count()
        for m in (1, 20, 600)
    ]
    assert counts == sorted(counts, reverse=True)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_rows_are_read_and_exchanged_once(spark, tmp_path, adaptive):
    """Both the rows and the edges of the parts come from one range exchange."""
    path = str(tmp_path / "events")
    spark.createDataFrame(sample.EVENTS, EVENT_SCHEMA).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        result = sessionize(spark.read.parquet(path))
        result.collect()
        final = result._jdf.queryExecution().executedPlan().toString()
        final = final.split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert final.count("FileScan parquet") == 1 or adaptive == "true"
    assert final.count("Exchange rangepartitioning") - final.count("ReusedExchange") <= 1
    assert "ReusedExchange" in final
    assert "CartesianProduct" not in final and "NestedLoop" not in final


def test_derived_columns_and_inner_names_do_not_clash(spark):
    rows = [("a", at("2024-04-21 00:00:00"), 7, 8, 9), ("a", at("2024-04-21 00:05:00"), 7, 8, 9)]
    events = spark.createDataFrame(rows, f"{NARROW}, session_id int, last int, first int")
    found = sessionize(events).collect()
    assert [(r["last"], r["first"], r["session_id"]) for r in found] == [(8, 9, 1)] * 2


def test_missing_columns_are_named(spark):
    events = spark.createDataFrame([("a",)], "user_id string")
    with pytest.raises(ValueError, match="^Missing required columns in DataFrame: timestamp$"):
        sessionize(events)
    with pytest.raises(
        ValueError, match="^Missing required columns in DataFrame: timestamp, listener$"
    ):
        sessionize(events, user_col="listener")


@pytest.mark.parametrize("minutes", [0, -1])
def test_threshold_must_be_positive(spark, minutes):
    events = spark.createDataFrame([], NARROW)
    with pytest.raises(ValueError, match="^Session threshold must be greater than 0.$"):
        sessionize(events, minutes)


def test_timestamps_without_zone(spark):
    events = spark.createDataFrame(sample.EVENTS, EVENT_SCHEMA).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )
    result = sessionize(events)
    assert dict(result.dtypes)["previous_timestamp"] == "timestamp_ntz"
    assert [r.session_id for r in result.orderBy("user_id", "timestamp").collect()] == (
        sample.SESSION_IDS
    )


def test_result_does_not_depend_on_adaptive_execution(spark):
    rows = random_rows(7)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert traced(spark, rows) == expected(rows)
        assert traced(spark, rows, parts=MANY) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_copies_of_one_event_are_spread_evenly(spark):
    """No part takes in more than a small multiple of its share, whatever the rows are."""
    midnight = datetime(2024, 1, 1)
    rows = [("hot", midnight)] * 4_000 + [("u", midnight + timedelta(minutes=i)) for i in range(99)]
    rows += [("hot", None)] * 2_000
    events = spark.createDataFrame(rows, NARROW).repartition(8)
    result = sessionize(events, parts=64)
    shares = result.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in shares) == len(rows)
    assert max(r["count"] for r in shares) < 4 * len(rows) / 64
    assert result.filter("user_id = 'hot' and timestamp is not null and new_session = 1").count() == 1
    assert result.filter("user_id = 'hot' and timestamp is null").agg(
        F.min("session_id"), F.max("session_id")
    ).first() == (2_000, 2_000)
