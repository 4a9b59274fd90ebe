"""Repair of a conversation's structure by Wagner-Fischer target alignment.

A well-formed conversation is empty, or an optional system turn followed by one or
more pairs of user and assistant: its role initials match ``(s?(ua)+)?``. There is
one such target for each length, so the turns are aligned to each feasible length
and the cheapest alignment wins:

    K keep 0     R give the turn another role 3     D delete 4     I insert an empty turn 3

Blank turns and turns seen before have to go; a truncated turn that stays costs 3 more.
Two targets of the same parity end alike, so one Wagner-Fischer table over suffixes
serves all lengths: cell (i, r) is the cost of aligning turns i, i+1, ... to the last r
places. Only targets with a system turn need a second table, for the turns before it.
A greedy repair is the first incumbent. Its cost bounds how many turns a cheaper
repair can insert or delete, which is Ukkonen's band of diagonals. All lengths that
reach the least cost are traced back together; of their audits, the strings of edits
in order, the least one in ASCII order is kept.

Memory and time: the table is cut into blocks of about sqrt(turns) rows, of which only
one is held, the rows at their borders besides. Alignment needs one letter per turn;
equal strings of letters are aligned once per worker.

Defined results: a null role or text is one space; turns are ordered by number (nulls
first), then role and text; a conversation without turns has zeros and an empty audit; a
null conversation id is a conversation. One conversation is one row of output by nature.
Only the four named columns are read, so others cannot clash.
"""

from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The costs of the edits and the pairs of initials that may stand side by side.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}

ROLES = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\v\f\r"
SENTENCE_ENDS = (".", "!", "?")
GONE, OTHER = "x", "o"
_INF = 1 << 28
_SCHEMA = (
    "id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, turns array<struct<role:string,text:string>>"
)
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


class Alignment:
    """Least costs of aligning the turns ``letters`` to targets, within Ukkonen's band.

    A letter is the initial of a turn's role (``o``: none of s, u, a), a capital for a
    truncated turn, or ``x`` for a turn that must go. A column of the table is a diagonal
    k = free turns left - places left, that is deletions less insertions still to come.
    """

    def __init__(self, letters: str):
        self.letters, self.n = letters, len(letters)
        self.kind = letters.lower()
        self.stay = [TRUNCATED if c.isupper() else 0 for c in letters]
        self.left = [0] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            self.left[i] = self.left[i + 1] + (letters[i] != GONE)
        inserted, deleted = self._band(greedy_cost(letters))
        self.low = -inserted
        self.diagonals = np.arange(self.low, deleted + 2)
        self.slope = (INSERT * self.diagonals).astype(np.int32)
        self.block = max(32, isqrt(self.n))
        ends = np.where(self.diagonals <= 0, -self.slope, _INF).astype(np.int32)
        last = (ends, np.full_like(ends, _INF))
        self.borders = {self.n: last}
        for i in range(self.n - 1, -1, -1):
            last = self._row(i, *last)
            if i % self.block == 0:
                self.borders[i] = last
        self.first = last
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _band(self, incumbent: int) -> tuple[int, int]:
        """The most insertions and deletions of free turns at no more than the incumbent."""
        free = self.left[0]
        cut_off = sum(map(bool, self.stay))
        spare = incumbent - DELETE * (self.n - free) - TRUNCATED * cut_off
        cheap = min(cut_off, spare // (DELETE - TRUNCATED))
        deleted = cheap + (spare - cheap * (DELETE - TRUNCATED)) // DELETE
        return spare // INSERT, min(free, deleted)

    def _row(self, i: int, after: np.ndarray, awaiting: np.ndarray):
        """Row i of both tables from row i + 1: the plain one, and the one before a system turn."""
        if self.letters[i] == GONE:
            base, pending = after + DELETE, awaiting + DELETE
        else:
            places = self.left[i] - self.diagonals
            wanted = places % 2 == (self.kind[i] == "a") if self.kind[i] in "ua" else False
            base = after + np.where(wanted, 0, REROLE) + self.stay[i]
            np.minimum(base[1:], after[:-1] + DELETE, out=base[1:])
            pending = np.full_like(awaiting, _INF)
            pending[1:] = awaiting[:-1] + DELETE
            if self.kind[i] == "s":
                np.minimum(pending[1:], after[:-1] + self.stay[i], out=pending[1:])
        base = base + self.slope
        base = np.minimum.accumulate(base[::-1])[::-1] - self.slope
        return np.minimum(base, _INF).astype(np.int32), np.minimum(pending, _INF).astype(np.int32)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Row i, for rising i: its block is filled again from the border below."""
        if i not in self.held:
            end = min(self.n, (i // self.block + 1) * self.block)
            self.held = {end: self.borders[end]}
            for j in range(end - 1, i - 1, -1):
                self.held[j] = self._row(j, *self.held[j + 1])
        return self.held[i]

    def cheapest(self) -> tuple[int, list[tuple[int, bool]]]:
        """The least cost over all lengths, and where the tables have it: (diagonal, awaits s)."""
        places = self.left[0] - self.diagonals
        plain = np.where((places >= 0) & (places % 2 == 0), self.first[0], _INF)
        headed = np.where((places >= 2) & (places % 2 == 0), self.first[1], _INF)
        least = int(min(plain.min(), headed.min()))
        starts = [
            (int(k), headed_by_s)
            for table, headed_by_s in ((plain, False), (headed, True))
            for k in np.flatnonzero(table == least) + self.low
        ]
        return least, starts

    def _edits(self, i: int, k: int, awaits: bool):
        """Edits from a cell in ASCII order of their letters: letter, cost, next cell."""
        more = i < self.n
        gone = more and self.letters[i] == GONE
        if more:
            yield "D", DELETE, (i + 1, k if gone else k - 1, awaits)
        places = self.left[i] - k
        if not awaits and places:
            yield "I", INSERT, (i, k + 1, False)
        if not more or gone:
            return
        if awaits:
            if self.kind[i] == "s":
                yield "K", self.stay[i], (i + 1, k - 1, False)
        elif places:
            kept = self.kind[i] == ("a" if places % 2 else "u")
            yield ("K" if kept else "R"), self.stay[i] + (0 if kept else REROLE), (i + 1, k, False)

    def cost(self, i: int, k: int, awaits: bool) -> int:
        at = k - self.low
        return int(self.row(i)[awaits][at]) if 0 <= at < len(self.diagonals) else _INF

    def audit(self, starts: list[tuple[int, bool]]) -> str:
        """The least of the audits traced back from all cells of least cost, side by side."""
        cells = [(0, k, awaits) for k, awaits in starts]
        letters = []
        while True:
            here = [(cell, self.cost(*cell)) for cell in cells]
            ways = []
            for cell, whole in here:
                for letter, cost, after in self._edits(*cell):
                    if ways and letter > ways[0][0]:
                        break
                    # the block that holds this row is kept until all its cells have been read
                    if whole < _INF and cost + self._cost_after(*after) == whole:
                        if ways and letter < ways[0][0]:
                            ways = []
                        ways.append((letter, after))
                        break
            if not ways:
                return "".join(letters)
            letters.append(ways[0][0])
            cells = sorted({after for _, after in ways})

    def _cost_after(self, i: int, k: int, awaits: bool) -> int:
        """As ``cost``; the row after a block is its border, so no other block is filled."""
        if i in self.held or i not in self.borders:
            return self.cost(i, k, awaits)
        at = k - self.low
        return int(self.borders[i][awaits][at]) if 0 <= at < len(self.diagonals) else _INF


def greedy_cost(letters: str) -> int:
    """What one pass without looking ahead costs: the incumbent that sets the band."""
    cost, expected, begun = 0, "u", False
    for i, letter in enumerate(letters):
        kind = letter.lower()
        if kind in (GONE, OTHER) or (kind == "s" and begun):
            cost += DELETE
            continue
        begun = True
        cost += TRUNCATED if letter.isupper() else 0
        if kind != "s":
            cost += 0 if kind == expected else INSERT
            expected = "a" if kind == "u" else "u"
        elif not any(c in "ua" for c in letters[i:].lower()):
            cost += 2 * INSERT
    cost += INSERT if expected == "a" else 0
    return min(cost, DELETE * len(letters))


@lru_cache(maxsize=1 << 14)
def repair(letters: str) -> tuple[int, str]:
    """Least cost, and the ASCII-least audit that has it."""
    alignment = Alignment(letters)
    cost, starts = alignment.cheapest()
    return cost, alignment.audit(starts)


def letter_of(role: str, text: str, seen: set) -> tuple[str, str | None]:
    """A turn's letter and its first fault."""
    told = text.rstrip(BLANKS)
    known = (role, text) in seen
    seen.add((role, text))
    if not told:
        return GONE, "blank"
    if known:
        return GONE, "duplicate"
    kind = role[:1] if role[:1] in ("s", "u", "a") else OTHER
    return (kind, None) if told.endswith(SENTENCE_ENDS) else (kind.upper(), "truncated")


def apply_audit(turns: list[tuple[str, str]], audit: str) -> list[dict[str, str]]:
    """The repaired turns."""
    size = len(audit) - audit.count("D")
    out, at = [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else turns[at]
        at += edit != "I"
        if edit == "D":
            continue
        if edit in "IR":
            role = ROLES["a" if (size - len(out)) % 2 else "u"]
        out.append({"role": role, "text": text})
    return out


def repaired_row(numbers: list[int | None], turns: list[tuple[str, str]]) -> tuple:
    seen: set = set()
    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
    letters = []
    for role, text in turns:
        letter, fault = letter_of(role, text, seen)
        letters.append(letter)
        if fault:
            faults[fault] += 1
    known = {n for n in numbers if n is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    initials = [role[:1] for role, _ in turns]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    cost, audit = repair("".join(letters))
    return (gaps, *faults.values(), illegal, cost, audit, apply_audit(turns, audit))


def repaired(
    turns: DataFrame,
    copies: Column | None = None,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: counts of faults, cost, audit and the repaired turns.

    ``copies`` says how often a row stands (once if not given); a row that stands
    nowhere still names its conversation.
    """

    def texts(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    times = F.lit(1) if copies is None else copies
    fields = F.struct(
        F.col(turn_col).cast("long").alias("turn"),
        texts(role_col).alias("role"),
        texts(text_col).alias("text"),
        times.cast("int").alias("times"),
    )
    whole = (
        turns.select(F.col(id_col).cast("long").alias("id"), fields.alias("turn_"))
        .groupBy("id")
        .agg(F.collect_list(F.when(F.col("turn_.times") > 0, F.col("turn_"))).alias("turns_"))
        .select("id", F.sort_array("turns_").alias("turns_"))
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [t for t in found for _ in range(t["times"])]
                pairs = [(t["role"], t["text"]) for t in found]
                out.append((id_, *repaired_row([t["turn"] for t in found], pairs)))
            columns = list(zip(*out)) or [()] * 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:7]]
                + [pa.array(columns[7], pa.string()), pa.array(columns[8], _TURNS)],
                names=["id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
                + ["audit", "turns"],
            )

    return whole.mapInArrow(rows, _SCHEMA)
