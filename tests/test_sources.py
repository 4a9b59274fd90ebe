from datetime import date, datetime

import pytest
import sample
from sample import at

from playtrail.columns import EVENT_SCHEMA
from playtrail.plans.top_songs import run_top_songs
from playtrail.sources import parquet, tsv
from playtrail.storage import as_table, materialize, scratch_dir


def written(path, *lines):
    path.write_text("".join(f"{line}\n" for line in lines))
    return str(path)


def part_text(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def sample_lines():
    for user, instant, *rest in sample.EVENTS:
        yield "\t".join([user, f"{instant:%Y-%m-%dT%H:%M:%SZ}", *[v or "" for v in rest]])


def test_sample_scan(spark, tmp_path):
    events = tsv.read_events(spark, written(tmp_path / "e.tsv", *sample_lines()))
    assert events.schema == EVENT_SCHEMA
    assert [tuple(r) for r in events.collect()] == sample.EVENTS


def test_irregular_lines(spark, tmp_path):
    path = written(
        tmp_path / "e.tsv",
        "u1\tgarbage\ta\tb\tc\td",
        "u2\t2024-04-21T00:20:00+02:00\ta\tb\tc\td",
        "u3\t2024-04-21\ta",
        "  u4 \t2024-04-21T00:00:00Z\ta\tb\tc\td\textra",
    )
    rows = {r.user_id: tuple(r)[1:] for r in tsv.read_events(spark, path).collect()}
    assert rows == {
        "u1": (None, "a", "b", "c", "d"),
        "u2": (at("2024-04-20 22:20:00"), "a", "b", "c", "d"),
        "u3": (at("2024-04-21 00:00:00"), "a", None, None, None),
        "  u4 ": (at("2024-04-21 00:00:00"), "a", "b", "c", "d"),
    }


@pytest.mark.parametrize(
    ("quote", "names"),
    [
        ('"', ['"Heroes" live', "Open quote", None]),
        ("", ['"Heroes" live', '"Open quote', '""']),
    ],
)
def test_quotation_marks(spark, tmp_path, quote, names):
    fields = ['"Heroes" live', '"Open quote', '""']
    path = written(
        tmp_path / "e.tsv", *[f"u{i}\t2024-04-21T00:00:00Z\ta\tb\tc\t{f}" for i, f in enumerate(fields)]
    )
    rows = tsv.read_events(spark, path, quote=quote).orderBy("user_id").collect()
    assert [r.track_name for r in rows] == names


def test_users(spark, tmp_path):
    path = written(
        tmp_path / "u.tsv",
        "#id\tgender\tage\tcountry\tregistered",
        "user-1\tm\t\tJapan\tAug 13, 2006",
        "user-2\tf\t24\t\tsoon",
        "user-3\tf\tmany\tPeru\tFeb 3, 2005",
    )
    users = tsv.read_users(spark, path)
    assert {t for _, t in users.dtypes} == {"string"}
    typed = tsv.typed_users(users)
    assert dict(typed.dtypes)["age"] == "int" and dict(typed.dtypes)["registered"] == "date"
    assert [(r.age, r.registered) for r in typed.orderBy("#id").collect()] == [
        (None, date(2006, 8, 13)),
        (24, None),
        (None, date(2005, 2, 3)),
    ]


def test_writer_keeps_every_character(spark, tmp_path):
    df = spark.createDataFrame(
        [("  lead", None, 'q"uote', "tab\there", "")],
        "a string, b string, c string, d string, e string",
    )
    out = tmp_path / "out"
    tsv.write_tsv(df, str(out), single_file=True)
    assert part_text(out) == 'a\tb\tc\td\te\n  lead\t\t"q""uote"\t"tab\there"\t\n'


def test_job(spark, tmp_path):
    path = written(tmp_path / "e.tsv", *sample_lines())
    result = run_top_songs(spark, path, str(tmp_path), 20, session_number=2, song_number=1)
    assert result == str(tmp_path / "top_1_songs_in_2_longest_session.tsv")
    assert part_text(tmp_path / "top_1_songs_in_2_longest_session.tsv") == (
        "musicbrainz_track_id\ttrack_name\tartist_name\n"
        "musicbrainztrack-id-5\tsong-name-4\tartist-name-4\n"
    )


def test_date_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "events")
    undated = ("user-3", None, None, "a", "t", "s")
    events = spark.createDataFrame([*sample.EVENTS, undated], EVENT_SCHEMA)
    parquet.write_events(events, path)
    assert sorted(map(str, parquet.read_events(spark, path).collect())) == sorted(
        map(str, events.collect())
    )
    day = parquet.read_events(spark, path, "2024-04-22", "2024-04-22")
    assert {r.timestamp.date() for r in day.collect()} == {date(2024, 4, 22)}
    assert day.count() == 2
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert parquet.read_events(spark, path, first_day="2024-04-22").count() == 2
    assert parquet.read_events(spark, path, last_day="2024-04-21").count() == 8


def test_stages_keep_their_rows(spark):
    events = spark.createDataFrame(sample.EVENTS, EVENT_SCHEMA)
    for how in ("memory", "disk", "table"):
        kept = materialize(events, how)
        assert sorted(tuple(r) for r in kept.collect() if r[4]) == sorted(
            e for e in sample.EVENTS if e[4]
        )
        kept.unpersist()
    with pytest.raises(ValueError):
        materialize(events, "elsewhere")


def test_written_stage_has_no_lineage(spark):
    stage = as_table(spark.range(5).filter("id > 1"), "numbers")
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark) in stage.inputFiles()[0]
    assert stage.count() == 3


def test_timestamps_are_utc(spark, tmp_path):
    path = written(tmp_path / "e.tsv", "u\t2005-02-14T23:59:59Z\t\t\t\t")
    assert tsv.read_events(spark, path).first().timestamp == datetime(2005, 2, 14, 23, 59, 59)


def test_written_files_read_back_character_by_character(spark, tmp_path):
    titles = [
        'q"uote', '"whole"', 'x\ty"z', "tab\tend\\", "plain\\", " lead", "trail ", "\\", 'a\\"b',
        "line\nfeed", "carriage\rreturn", "both\r\nof\nthem", ' "x" ', None, "end",
    ]
    rows = [(f"u{i}", None, "a", t, "t", t) for i, t in enumerate(titles)]
    path = str(tmp_path / "back")
    tsv.write_tsv(spark.createDataFrame(rows, EVENT_SCHEMA), path, header=False)
    back = tsv.read_events(spark, path, written=True).collect()
    assert sorted(map(str, (tuple(r) for r in back))) == sorted(map(str, rows))


def test_days_do_not_depend_on_the_zone(spark, tmp_path):
    rows = [("u", at("2024-01-05 23:30:00"), "a", "b", "c", "d"), ("u", None, "a", "b", "c", "d")]
    events = spark.createDataFrame(rows, EVENT_SCHEMA)
    zone, path = spark.conf.get("spark.sql.session.timeZone"), str(tmp_path / "days")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        parquet.write_events(events, path)
        assert parquet.read_events(spark, path, "2024-01-05", "2024-01-05").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert parquet.read_events(spark, path, "2024-01-05", "2024-01-05").count() == 1


def test_a_written_table_lies_where_the_caller_says(spark, tmp_path):
    table = as_table(spark.range(3), "three", str(tmp_path / "mine"))
    assert table.count() == 3 and list((tmp_path / "mine").glob("*.parquet"))


# lines that do not parse, and lines that can be split anywhere


def test_good_lines_are_read_as_before_and_others_are_kept_aside(spark, tmp_path):
    good = list(sample_lines())
    bad = [
        "u1\tgarbage\ta\tb\tc\td",
        "u3\t2024-04-21T00:00:00Z\ta",
        "u4\t2024-04-21T00:00:00Z\ta\tb\tc\td\textra",
        "lonely",
    ]
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    written(mixed / "a.tsv", *good[:3], bad[0], *good[3:], bad[1])
    written(mixed / "b.tsv", *bad[2:])
    scanned = tsv.scan_events(spark, str(mixed))
    assert tsv.accepted(scanned).schema == EVENT_SCHEMA
    plain = tsv.read_events(spark, written(tmp_path / "good.tsv", *good))
    assert tsv.accepted(scanned).orderBy("user_id", "timestamp").collect() == plain.orderBy(
        "user_id", "timestamp"
    ).collect()
    found = {(r.file[-5:], r.rejected_line, r.reason) for r in tsv.rejected(scanned).collect()}
    assert found == {
        ("a.tsv", bad[0], "unreadable timestamp"),
        ("a.tsv", bad[1], "too few fields"),
        ("b.tsv", bad[2], "too many fields"),
        ("b.tsv", bad[3], "too few fields"),
    }
    counts = {r.file[-5:]: (r.accepted, r.rejected) for r in tsv.lines_per_file(scanned).collect()}
    assert counts == {"a.tsv": (len(good), 2), "b.tsv": (0, 2)}


def test_what_is_rejected_does_not_depend_on_the_columns_asked_for(spark, tmp_path):
    path = written(tmp_path / "e.tsv", "u1\tgarbage\ta\tb\tc\td", *sample_lines())
    scanned = tsv.scan_events(spark, path)
    assert tsv.accepted(scanned).select("track_name").count() == len(sample.EVENTS)
    assert tsv.accepted(scanned).select("user_id").filter("user_id = 'u1'").isEmpty()


ODD_TEXTS = ['"', "a\tb", "line\nbreak\r\nand more", "back\\slash", "\\n", "\\\\", "\\e", "", None,
             "  blanks ", "\\", "tail\\", 'q"q', "#x", "é\n\t\"\\"]


def test_lines_read_back_whole(spark, tmp_path):
    rows = [(f"u{k}", at("2024-04-21 00:00:00"), t, t, "x", t) for k, t in enumerate(ODD_TEXTS)]
    rows.append((None, None, None, None, None, None))
    tsv.write_lines(spark.createDataFrame(rows, EVENT_SCHEMA), str(tmp_path / "lines"))
    found = tsv.read_lines(spark, str(tmp_path / "lines"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(rows, key=str)
    assert len(part_text(tmp_path / "lines").splitlines()) == len(rows)


def test_a_large_file_of_lines_is_read_by_several_tasks(spark, tmp_path):
    rows = [(f"u{k}", at("2024-04-21 00:00:00"), "a\nb", "c", "d", 'e"\n') for k in range(2000)]
    path = str(tmp_path / "lines")
    tsv.write_lines(spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        found = tsv.read_lines(spark, path)
        assert found.rdd.getNumPartitions() > 3
        assert found.groupBy("artist_name", "track_name").count().collect() == [("c", 'e"\n', 2000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
