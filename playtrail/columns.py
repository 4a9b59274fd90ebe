"""Column names and schemas of the event model."""

from pyspark.sql import types as T

# The names, order and types of the event table.
USER = "user_id"
TIMESTAMP = "timestamp"
ARTIST_ID = "musicbrainz_artist_id"
ARTIST_NAME = "artist_name"
TRACK_ID = "musicbrainz_track_id"
TRACK_NAME = "track_name"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField(USER, T.StringType()),
        T.StructField(TIMESTAMP, T.TimestampType()),
        T.StructField(ARTIST_ID, T.StringType()),
        T.StructField(ARTIST_NAME, T.StringType()),
        T.StructField(TRACK_ID, T.StringType()),
        T.StructField(TRACK_NAME, T.StringType()),
    ]
)

# The names of the derived columns.
PREVIOUS = "previous_timestamp"
GAP = "time_diff_seconds"
NEW_SESSION = "new_session"
SESSION = "session_id"
SESSION_START = "min_timestamp"
SESSION_END = "max_timestamp"
DURATION = "session_duration"
SONG_COUNT = "song_count"

SESSION_KEY = (USER, SESSION)
SONG_BY_ID = (TRACK_ID, TRACK_NAME, ARTIST_NAME)
SONG_BY_NAME = (TRACK_NAME, ARTIST_NAME)
