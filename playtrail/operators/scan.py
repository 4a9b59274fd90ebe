"""A segmented prefix scan over events in order of user and time.

Rows are range-partitioned by user, timestamp and their own number, which cuts them into
parts of about equal size whoever owns them: one user's rows, even copies of one instant,
spread over as many parts as they need. Then

1. each part is scanned by itself in the order of its rows. That notes for each row the
   timestamp before it and how many sessions its user has begun in the part so far, and
   adds up to two *edge* rows, which sum up what the part's first user and its last user
   had in it;
2. the edges are summed up in order, which tells what each part takes over from the others;
3. that goes to all parts and completes the rows of the part's first user, and of its last
   user as to events without a timestamp. Rows of other users are complete already.

The scan is one pass over rows as they leave the exchange; columns pass through it as they
are. A part is known by the number of its first row and not by its place, so it does not
matter in which stages parts are read. Should a part be cut differently when it is read
again, which takes an input that does not read the same way twice, the result is an error
and not a wrong row.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrail.columns import PREVIOUS, SESSION, TIMESTAMP
from playtrail.functions.timing import seconds_between, starts_session

_ROW = "__row"
_PART = "__part"
_ROLE = "__role"
_EDGE = "__edge"
_OF_PART = "__of_part"

# What a row still needs from the other parts.
_NOTHING, _FIRST_USER, _FIRST_ROW, _TIMELESS_END = 0, 1, 2, 3


class _PartScan:
    """Scans one part chunk by chunk and keeps what passes from one chunk to the next."""

    def __init__(self, limit: float, user: int, instant: int, row: int):
        self.limit, self.user, self.instant, self.row = limit, user, instant, row
        self.part: int | None = None
        self.before: pa.Table | None = None  # the row before the chunk
        self.begun = 0  # sessions of that row's user so far, but for one by the part's first row
        self.timeless = 0  # rows without a timestamp of that user so far
        self.opener: pa.Table | None = None  # that user's first row in the part
        self.first_edge: pa.Table | None = None

    def _steps(self, rows: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Instants, the row before included; whether each row has its user, and has an instant."""
        before = rows.slice(0, 1) if self.before is None else self.before
        both = pa.concat_tables([before, rows])
        users, instants = (both.column(k).combine_chunks() for k in (self.user, self.instant))
        same = _same_as_before(users)
        if self.before is None:
            same[0] = False
        return instants, same, ~_nulls(instants)

    def open_tail(self, rows: pa.Table) -> int:
        """How many rows at the end have no timestamp and a number that later rows decide.

        The edge of the part's first user decides for all of its rows.
        """
        _, same, timed = self._steps(rows)
        users = np.flatnonzero(~same)
        first_user = self.first_edge is None and len(users) <= int(self.before is None)
        if timed[-1] or first_user:
            return 0
        settled = np.flatnonzero(timed[1:])
        return rows.num_rows - max(users[-1] if len(users) else 0, settled[-1] + 1 if len(settled) else 0)

    def scan(self, rows: pa.Table, last: bool = False) -> pa.Table:
        n, begins = rows.num_rows, self.before is None
        if begins:
            self.part = rows.column(self.row)[0].as_py()
        instants, same, timed = self._steps(rows)
        second = _micros(instants) // 1_000_000
        known = same & timed[:-1]
        starts = ~(known & timed[1:] & (second[1:] - second[:-1] <= self.limit))
        starts[0] &= not begins  # whether the part's first row starts a session, its edge tells
        segment = np.cumsum(~same) - int(begins)  # 0: the user of the row before
        openers = np.flatnonzero(~same)[int(begins) :]
        begun = _running(starts, openers, segment, self.begun)
        timeless = _running(~timed[1:], openers, segment, self.timeless)

        # rows without a timestamp share the last of their numbers
        final = np.append(~same[1:] | timed[2:], True)
        run_ends = np.flatnonzero(final & ~timed[1:])
        session = begun.copy()
        untimed = np.flatnonzero(~timed[1:])
        session[untimed] = timeless[run_ends[np.searchsorted(run_ends, untimed)]]
        role = np.full(n, _NOTHING)
        if self.first_edge is None:
            role[segment == 0] = _FIRST_USER
        if begins:
            role[0] = _FIRST_ROW
            self.opener = rows.slice(0, 1)
        if last:
            at_end = ~timed[1:] & (segment == segment[-1]) & (role == _NOTHING)
            role[at_end] = _TIMELESS_END
        previous = pc.if_else(pa.array(known), instants.slice(0, n), pa.scalar(None, instants.type))

        if len(openers) and self.first_edge is None:
            at = int(openers[0])
            self.first_edge = self._edge(
                instants[at], (self.begun, *begun)[at], (self.timeless, *timeless)[at], True
            )
        if len(openers):
            self.opener = rows.slice(int(openers[-1]), 1)
        self.before = rows.slice(n - 1, 1)
        self.begun, self.timeless = int(begun[-1]), int(timeless[-1])
        return self._told(rows, previous, session, role, pa.nulls(n, self._edge_type(instants)))

    def edges(self) -> list[pa.Table]:
        last = self.before.column(self.instant).combine_chunks()[0]
        only = self.first_edge is None
        ended = self._edge(last, self.begun, self.timeless, only)
        return [ended] if only else [self.first_edge, ended]

    def _edge(self, last: pa.Scalar, begun: int, timeless: int, of_first: bool) -> pa.Table:
        """The first row of a user in this part, with what the user had in it."""
        kind = self._edge_type(last)
        told = {"last": last.as_py(), "begun": int(begun), "timeless": int(timeless)}
        edge = pa.StructArray.from_arrays(
            [
                pa.array([last.value], pa.int64()).cast(last.type),
                pa.array([told["begun"]], pa.int64()),
                pa.array([told["timeless"]], pa.int64()),
                pa.array([of_first]),
            ],
            fields=list(kind),
        )
        nothing = np.zeros(1, np.int64)
        return self._told(self.opener, pa.nulls(1, last.type), nothing, nothing, edge)

    @staticmethod
    def _edge_type(instant) -> pa.StructType:
        return pa.struct(
            [("last", instant.type), ("begun", pa.int64()), ("timeless", pa.int64()), ("first", pa.bool_())]
        )

    def _told(self, rows, previous, session, role, edge) -> pa.Table:
        added = {
            PREVIOUS: previous,
            SESSION: pa.array(session.astype(np.int64)),
            _PART: pa.array(np.full(rows.num_rows, self.part, np.int64)),
            _ROLE: pa.array(role.astype(np.int32)),
            _EDGE: edge,
        }
        for name, column in added.items():
            rows = rows.append_column(name, column)
        return rows


def _nulls(column: pa.Array) -> np.ndarray:
    return column.is_null().to_numpy(zero_copy_only=False)


def _micros(instants: pa.Array) -> np.ndarray:
    return instants.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)


def _same_as_before(column: pa.Array) -> np.ndarray:
    """For all values but the first: whether the one before is the same; nulls are."""
    null = _nulls(column)
    equal = pc.equal(column.slice(1), column.slice(0, len(column) - 1)).fill_null(False)
    return equal.to_numpy(zero_copy_only=False) | (null[1:] & null[:-1])


def _running(flags, openers, segment, carried: int) -> np.ndarray:
    """Running count of the flags in each segment; the first one continues ``carried``."""
    total = np.cumsum(flags)
    base = np.append(-carried, total[openers] - flags[openers])
    return total - base[segment]


def _scan_parts(limit: float, user: int, instant: int, row: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _PartScan(limit, user, instant, row)
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            if len(waiting) > 1 and _goes_on(waiting[-2], batch, user, instant):
                continue
            rows = pa.Table.from_batches(waiting)
            tail = part.open_tail(rows)
            waiting = rows.slice(rows.num_rows - tail).to_batches() if tail else []
            if tail < rows.num_rows:
                yield from part.scan(rows.slice(0, rows.num_rows - tail)).to_batches()
        if waiting:
            yield from part.scan(pa.Table.from_batches(waiting), last=True).to_batches()
        if part.part is not None:
            for edge in part.edges():
                yield from edge.to_batches()

    return scan


def _goes_on(before: pa.RecordBatch, batch: pa.RecordBatch, user: int, instant: int) -> bool:
    """Whether a run of one user's rows without a timestamp takes up all of a batch."""
    if batch.column(instant).null_count < batch.num_rows:
        return False
    users = pa.concat_arrays([before.column(user).slice(before.num_rows - 1), batch.column(user)])
    return bool(_same_as_before(users).all())


def trace_sessions(
    events: DataFrame, user_col: str, limit: float, parts: int | None = None
) -> DataFrame:
    """Events with the user's previous timestamp and, as a bigint, the session number."""
    if parts is None:
        parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(user_col), F.col(TIMESTAMP), F.col(_ROW)]
    # a given number of parts, so that adaptive execution does not join them differently
    ranged = (
        events.withColumn(_ROW, F.monotonically_increasing_id())
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
    )
    instant_type = events.schema[TIMESTAMP].dataType
    edge = T.StructType(
        [
            T.StructField("last", instant_type),
            T.StructField("begun", T.LongType()),
            T.StructField("timeless", T.LongType()),
            T.StructField("first", T.BooleanType()),
        ]
    )
    added = [(PREVIOUS, instant_type), (SESSION, T.LongType()), (_PART, T.LongType())]
    added += [(_ROLE, T.IntegerType()), (_EDGE, edge)]
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in ranged.schema]
        + [T.StructField(name, kind) for name, kind in added]
    )
    names = ranged.columns
    at = [names.index(name) for name in (user_col, TIMESTAMP, _ROW)]
    scanned = ranged.mapInArrow(_scan_parts(limit, *at), schema)
    taken = _taken_over(scanned.filter(F.col(_EDGE).isNotNull()), user_col, limit)
    rows = scanned.filter(F.col(_EDGE).isNull())
    # one row for each part
    whole = rows.join(F.broadcast(taken), F.col(_PART) == F.col(_OF_PART), "left")
    return whole.select(
        *events.columns,
        F.when(F.col(_ROLE) == _FIRST_ROW, F.col("__carry"))
        .otherwise(F.col(PREVIOUS))
        .alias(PREVIOUS),
        _whole_number().alias(SESSION),
    )


def _taken_over(edges: DataFrame, user_col: str, limit: float) -> DataFrame:
    """What each part takes over: the instant before it, and its users' numbers elsewhere."""
    edges = edges.select(user_col, TIMESTAMP, _ROW, F.col(_PART).alias(_OF_PART), f"{_EDGE}.*")
    in_order = Window.partitionBy(user_col).orderBy(TIMESTAMP, _ROW)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, -1)
    carry = F.lag("last").over(in_order)
    opens = starts_session(seconds_between(carry, F.col(TIMESTAMP)), limit)
    opens = F.when(F.col("first"), opens).otherwise(0)
    summed = edges.withColumns({"carry": carry, "opens": opens}).withColumns(
        {
            "before": F.coalesce(F.sum(F.col("begun") + F.col("opens")).over(so_far), F.lit(0)),
            "timeless": F.sum("timeless").over(Window.partitionBy(user_col)),
        }
    )

    def of(first: bool, value: Column) -> Column:
        return F.max(F.when(F.col("first") == first, value))

    return summed.groupBy(_OF_PART).agg(
        of(True, F.col("carry")).alias("__carry"),
        of(True, F.col("before") + F.col("opens")).alias("__sessions"),
        of(True, F.col("timeless")).alias("__timeless"),
        of(False, F.col("timeless")).alias("__timeless_at_end"),
    )


def _whole_number() -> Column:
    """A row's session number: its part's count, and what the part takes over."""
    role, own, timeless = F.col(_ROLE), F.col(SESSION), F.col(TIMESTAMP).isNull()
    in_first = role.isin(_FIRST_USER, _FIRST_ROW)
    number = (
        F.when(in_first & timeless, F.col("__timeless"))
        .when(in_first, F.col("__sessions") + own)
        .when(role == _TIMELESS_END, F.col("__timeless_at_end"))
        .otherwise(own)
    )
    unread = F.raise_error(F.lit("The events did not read the same way twice; write them first."))
    return F.when(number.isNull(), unread.cast("long")).otherwise(number)
