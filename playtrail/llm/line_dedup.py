"""Near-equal lines: a segment-partition edit join.

Two lines are linked if at most ``EDITS`` insertions, deletions or substitutions of
symbols turn one into the other: bytes, or characters with ``in_characters``. Cut into EDITS + 1 segments, one of them then stands
unchanged in the other line, near its old place.

1. ``entries``: every line puts its segments into an index and looks up its own
   substrings that could be a segment of a line of its length or a little less.
   Which substrings: around segment i, as many left of it as segments before it can
   shift, and as many right of it as segments behind it leave over. A key is the hash
   of substring, segment number and length, so lengths never mix. Lines of at most
   EDITS symbols have too few for segments: they meet lines of up to 2 * EDITS by
   single symbols, of which such a pair shares at least one, and are all linked to
   one another, which ``line_classes`` counts without listing the pairs.
2. ``meetings`` sorts the keys of a bucket; a line that looks up a key and a line
   that indexed it are a candidate pair, unless their symbol counts already differ by
   more than the edits allow.
3. ``edit_distances`` verifies candidates with bit-parallel edit distance in a band
   around the diagonal, for many pairs at once.

With ``symbols_per_edit``, the edits that link two lines grow with the shorter one: one for
each so many symbols, up to ``edits``. Lines of fewer symbols are then linked to none, for
two edits make "Yes" of "No" and "12" of "Ab".

Lines are told apart by a 64-bit hash and equal lines are one line from the start,
so what travels is packed numbers; a line that stands in a third of all documents
sends a few entries per slice of text. Texts move once, to verify candidates.

Defined results: a line is what stands between line feeds and is not empty; lines
shorter than ``least`` bytes take part as exact copies only, so with ``EVERY_LINE``
all lines take part in full; null and empty texts have no lines; repeated rows repeat
their lines. Only id and text are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.components import components
from playtrail.llm.stages import keep_table, partitions
from playtrail.llm.textbytes import Hasher, Texts, mix, slices

EDITS = 2
MIN_BYTES = 32
#: As ``least``: lines of any length take part.
EVERY_LINE = 1

_LINE = np.ones(256, bool)
_LINE[10] = False
_ENTRY = 20  # bytes: key, line, symbol counts
_PAIRS_AT_ONCE = 1 << 21


class Lines:
    """The lines of some texts: byte range and hash; text i has lines first[i] to first[i + 1]."""

    def __init__(self, part: Texts, in_characters: bool = False):
        self.part = part
        self.starts, self.ends = part.runs(_LINE)
        self.first = np.searchsorted(self.starts, part.bounds)
        self.hasher: Hasher = part.hasher()
        size = (self.ends - self.starts).astype(np.uint64)
        self.names = mix(self.hasher(self.starts, self.ends) ^ mix(size)).view(np.int64)
        # where symbols start, and the end of all; line i has sizes[i] of them from heads[i] on
        at = _symbol_starts(part.data, self.starts, in_characters)
        self.places = np.append(at, len(part.data))
        self.heads = np.searchsorted(at, self.starts)
        self.sizes = np.searchsorted(at, self.ends) - self.heads

    def long_ones(self, least: int, least_symbols: int = 0) -> np.ndarray:
        """One of each distinct line that is long enough."""
        _, at = np.unique(self.names, return_index=True)
        return at[(self.ends[at] - self.starts[at] >= least) & (self.sizes[at] >= least_symbols)]


def _symbol_starts(data: np.ndarray, starts: np.ndarray, in_characters: bool) -> np.ndarray:
    """All bytes, or those that start a character of UTF-8; those that start a text always do."""
    if not in_characters:
        return np.arange(len(data))
    first = (data & 0xC0) != 0x80
    first[starts] = True
    return np.flatnonzero(first)


def symbols(texts: pa.Array, in_characters: bool) -> tuple[np.ndarray, np.ndarray]:
    """A number for each symbol of some texts, and where each text starts among them."""
    column = texts.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    whole = column.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    at = _symbol_starts(data, offsets[:-1][np.diff(offsets) > 0], in_characters)
    size = np.diff(np.append(at, len(data)))
    codes = np.zeros(len(at), np.uint32)
    # no character has more than four bytes
    for k in range(4):
        own = np.flatnonzero(size > k)
        codes[own] |= data[at[own] + k].astype(np.uint32) << np.uint32(8 * k)
    return codes, np.searchsorted(at, offsets)


def symbol_counts(lines: Lines, which: np.ndarray) -> np.ndarray:
    """16 counters of 2 bits: how many symbols of each low half of the last byte, modulo 4."""
    size = lines.sizes[which]
    row = np.repeat(np.arange(len(which)), size)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    low = lines.part.data[lines.places[lines.heads[which][row] + inner + 1] - 1] & 15
    counts = np.bincount(row * 16 + low, minlength=16 * len(which)).reshape(-1, 16) & 3
    return (counts.astype(np.uint32) << (2 * np.arange(16, dtype=np.uint32))).sum(
        axis=1, dtype=np.uint32
    )


def differing_counters(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x ^ y
    return np.bitwise_count((d | d >> np.uint32(1)) & np.uint32(0x55555555))


def segment(length: np.ndarray, number: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of a segment: all equal, the last ones one byte longer."""
    parts = edits + 1
    size, more = length // parts, length % parts
    longer = np.maximum(number - (parts - more), 0)
    return number * size + longer, size + (number >= parts - more)


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift from the segment's start) of every lookup."""
    out = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            low = max(-i, less - (edits - i))
            high = min(i, less + (edits - i))
            out += [(less, i, shift) for shift in range(low, high + 1)]
    return out


def entries(
    lines: Lines, edits: int, least: int, least_symbols: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, lines and symbol counts; the last bit of a key is 1 for lookups."""
    which = lines.long_ones(least, least_symbols)
    start, length = lines.heads[which], lines.sizes[which]
    keys, owner = [], []

    def add(at, size, of_length, number, kept, lookup):
        salt = mix((of_length * (edits + 1) + number).astype(np.uint64))
        key = mix(lines.hasher(lines.places[at], lines.places[at + size]) ^ salt)
        keys.append((key & ~np.uint64(1)) | np.uint64(lookup))
        owner.append(kept)

    every = np.arange(len(which))
    cut = np.flatnonzero(length > edits)
    for i in range(edits + 1):
        at, size = segment(length[cut], i, edits)
        add(start[cut] + at, size, length[cut], i, cut, 0)
    for less, i, shift in probes(edits):
        at, size = segment(length - less, i, edits)
        kept = np.flatnonzero((at + shift >= 0) & (at + shift + size <= length))
        kept = kept[length[kept] - less > edits]
        add((start + at + shift)[kept], size[kept], (length - less)[kept], i, kept, 1)
    # lines of few symbols: 0 as length stands for a key of one symbol
    for k in range(2 * edits):
        kept = np.flatnonzero((length > k) & (length <= 2 * edits))
        one, none = np.ones(len(kept), np.int64), np.zeros(len(kept), np.int64)
        few = length[kept] <= edits
        for lookup in (0, 1):
            own = few == bool(lookup)
            add((start[kept] + k)[own], one[own], none[own], 0, kept[own], lookup)
    own = np.concatenate(owner) if owner else every
    counts = symbol_counts(lines, which)
    return np.concatenate(keys), lines.names[which][own], counts[own]


def meetings(keys: np.ndarray, names: np.ndarray, counts: np.ndarray, edits: int) -> Iterator:
    """Candidate pairs (smaller name, larger name) of one bucket, in bounded portions."""
    order = np.lexsort((names, keys))
    keys, names, counts = keys[order], names[order], counts[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
    keys, names, counts = keys[new], names[new], counts[new]
    lookup = (keys & np.uint64(1)).astype(bool)
    asked, given = np.flatnonzero(lookup), np.flatnonzero(~lookup)
    wanted = keys[asked] ^ np.uint64(1)
    low = np.searchsorted(keys[given], wanted, side="left")
    n = np.searchsorted(keys[given], wanted, side="right") - low
    done = 0
    ahead = np.cumsum(n)
    while done < len(asked):
        before = ahead[done - 1] if done else 0
        upto = max(int(np.searchsorted(ahead, before + _PAIRS_AT_ONCE)), done + 1)
        size = n[done:upto]
        source = np.repeat(np.arange(done, upto), size)
        inner = np.arange(len(source)) - np.repeat(np.cumsum(size) - size, size)
        x, y = asked[source], given[low[source] + inner]
        kept = (names[x] != names[y]) & (differing_counters(counts[x], counts[y]) <= 2 * edits)
        a, b = names[x[kept]], names[y[kept]]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        if len(pairs):
            yield pairs
        done = upto


def edit_distances(
    texts: pa.Array, a: np.ndarray, b: np.ndarray, most: int, in_characters: bool = False
) -> np.ndarray:
    """Distance of the texts a[i] and b[i], or most + 1 if larger.

    One 64-bit word per pair holds the vertical differences (VP: +1, VN: -1) of a
    band of rows whose last is ``most`` below the diagonal. The distance is followed
    along that lowest diagonal, and along the last row once the band reaches it.
    """
    data, offsets = symbols(texts, in_characters)
    data = data if len(data) else np.zeros(1, np.uint32)
    m, n = offsets[a + 1] - offsets[a], offsets[b + 1] - offsets[b]
    out = np.full(len(a), most + 1)
    able = np.flatnonzero((abs(m - n) <= most) & (m >= most) & (n >= 1))
    for i in np.flatnonzero((abs(m - n) <= most) & ((m < most) | (n < 1))):
        out[i] = min(most + 1, _plain_distance(data[offsets[a[i]] :][: m[i]], data[offsets[b[i]] :][: n[i]]))
    m, n, from_a, from_b = m[able], n[able], offsets[a[able]], offsets[b[able]]
    one, last = np.uint64(1), np.uint64(63)
    vp = np.full(len(able), (1 << 64) - (1 << (63 - most)), np.uint64)
    vn = np.zeros(len(able), np.uint64)
    distance = np.full(len(able), most)
    for j in range(int(n.max(initial=0))):
        inside = j < n
        letter = data[np.where(inside, from_b + j, 0)]
        x = np.zeros(len(able), np.uint64)
        for k in range(-most, most + 1):
            row = j + k
            there = inside & (row >= 0) & (row < m)
            same = there & (data[np.where(there, from_a + row, 0)] == letter)
            x |= same.astype(np.uint64) << np.uint64(63 - most + k)
        d0 = (((x & vp) + vp) ^ vp) | x | vn
        hp, hn = vn | ~(d0 | vp), d0 & vp
        sloping = inside & (j < m - most)
        distance += sloping & (d0 >> last == 0)
        flat = inside & ~sloping
        bit = np.where(flat, 62 - (j - (m - most)), 0).astype(np.uint64)
        distance += flat * ((hp >> bit & one).astype(np.int64) - (hn >> bit & one).astype(np.int64))
        vp, vn = hn | ~((d0 >> one) | hp), (d0 >> one) & hp
    out[able] = np.minimum(distance, most + 1)
    return out


def _plain_distance(x, y) -> int:
    """For texts of a few symbols."""
    row = list(range(len(y) + 1))
    for i, p in enumerate(x.tolist(), 1):
        last, row[0] = row[0], i
        for j, q in enumerate(y.tolist(), 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != q))
    return row[-1]


def candidate_pairs(
    docs: DataFrame,
    edits: int,
    least: int,
    text_col: str = "text",
    in_characters: bool = False,
    least_symbols: int = 0,
) -> DataFrame:
    """Distinct pairs (a, b) of line hashes that share a segment at a possible place."""
    buckets = partitions(docs.sparkSession)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                found = entries(Lines(part, in_characters), edits, least, least_symbols)
                keys, names, counts = found
                bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                held = np.flatnonzero(np.diff(cut))
                data = []
                for b in held:
                    own = order[cut[b] : cut[b + 1]]
                    data.append(keys[own].tobytes() + names[own].tobytes() + counts[own].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held.astype(np.int32)), pa.array(data, pa.binary())],
                    names=["bucket", "data"],
                )

    def meet(table: pa.Table) -> pa.Table:
        keys, names, counts = [], [], []
        for raw in table.column("data").to_pylist():
            n = len(raw) // _ENTRY
            keys.append(np.frombuffer(raw, np.uint64, n))
            names.append(np.frombuffer(raw, np.int64, n, 8 * n))
            counts.append(np.frombuffer(raw, np.uint32, n, 16 * n))
        found = list(meetings(*(np.concatenate(x) for x in (keys, names, counts)), edits))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    sent = docs.select(F.col(text_col).cast("string")).mapInArrow(emit, "bucket int, data binary")
    return sent.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def line_texts(docs: DataFrame, least: int, text_col: str = "text") -> DataFrame:
    """name and text of the lines of at least ``least`` bytes, once per slice."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                lines = Lines(part)
                which = lines.long_ones(least)
                starts, ends = lines.starts[which].tolist(), lines.ends[which].tolist()
                texts = [part.data[x:y].tobytes() for x, y in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines.names[which]), pa.array(texts, pa.binary())],
                    names=["name", "line"],
                )

    return docs.select(F.col(text_col).cast("string")).mapInArrow(emit, "name long, line binary")


def links(
    docs: DataFrame,
    edits: int = EDITS,
    least: int = MIN_BYTES,
    text_col: str = "text",
    in_characters: bool = False,
    symbols_per_edit: int = 0,
) -> DataFrame:
    """a, b and distance of every pair of different lines within ``edits`` edits.

    Not listed are the pairs of two lines of at most ``edits`` symbols, which are all links.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            texts = pa.concat_arrays([batch.column(2), batch.column(3)])
            # pairs of about one length at a time, or short ones would wait for long ones
            size = pa.compute.binary_length(batch.column(2)).to_numpy()
            order = np.argsort(size, kind="stable")
            distance = np.zeros(n, np.int64)
            for k in range(0, n, 512):
                own = order[k : k + 512]
                distance[own] = edit_distances(texts, own, own + n, edits, in_characters)
            allowed = np.full(n, edits)
            if symbols_per_edit:
                length = np.diff(symbols(texts, in_characters)[1])
                allowed = np.minimum(edits, np.minimum(length[:n], length[n:]) // symbols_per_edit)
            kept = pa.array(distance <= allowed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(distance)],
                names=["a", "b", "distance"],
            ).filter(kept)

    found = candidate_pairs(docs, edits, least, text_col, in_characters, symbols_per_edit)
    pairs = keep_table(found, "line-pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    # how many lines are needed has no bound: meet them by a shuffle at every size
    texts = line_texts(docs, least, text_col).join(needed.hint("merge"), "name", "left_semi")
    texts = keep_table(texts.dropDuplicates(["name"]), "line-texts")
    joined = pairs.join(
        texts.select(F.col("name").alias("a"), F.col("line").alias("line_a")), "a"
    ).join(texts.select(F.col("name").alias("b"), F.col("line").alias("line_b")), "b")
    return keep_table(
        joined.select("a", "b", "line_a", "line_b").mapInArrow(
            verify, "a long, b long, distance long"
        ),
        "line-links",
    )


def occurrences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", in_characters: bool = False
) -> DataFrame:
    """A row per line and slice of text: name, n_bytes, n_symbols, copies there, and its first place.

    Places are (id, row, line_no); the row number tells rows of one id apart.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            rows = batch.column(1).to_numpy()
            for part in slices(batch.column(2)):
                lines = Lines(part, in_characters)
                where = np.repeat(np.arange(len(part)), np.diff(lines.first))
                number = np.arange(len(where)) - lines.first[where]
                own = ids.slice(part.first_row, len(part))
                key = own.fill_null(-(1 << 63)).to_numpy()
                order = np.lexsort((number, rows[part.first_row + where], key[where], lines.names))
                names = lines.names[order]
                at = np.flatnonzero(np.append(True, names[1:] != names[:-1]))[: len(names)]
                one = order[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[at]),
                        pa.array((lines.ends - lines.starts)[one]),
                        pa.array(lines.sizes[one]),
                        pa.array(np.diff(np.append(at, len(names)))),
                        own.take(pa.array(where[one])),
                        pa.array(rows[part.first_row + where[one]]),
                        pa.array(number[one]),
                    ],
                    names=["name", "n_bytes", "n_symbols", "copies", "id", "row", "line_no"],
                )

    narrow = docs.select(
        F.col(id_col).cast("long"), F.monotonically_increasing_id(), F.col(text_col).cast("string")
    )
    return narrow.mapInArrow(
        emit, "name long, n_bytes long, n_symbols long, copies long, id long, row long, line_no long"
    )


def line_classes(
    docs: DataFrame,
    edits: int = EDITS,
    least: int = MIN_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    in_characters: bool = False,
    symbols_per_edit: int = 0,
) -> DataFrame:
    """A row per distinct line: its first place, copies, links, and its class's first place.

    A class is what links lead to; a line without links is a class of its own.
    """
    found = links(docs, edits, least, text_col, in_characters, symbols_per_edit)
    lines = keep_table(
        occurrences(docs, id_col, text_col, in_characters)
        .groupBy("name")
        .agg(
            F.first("n_bytes").alias("n_bytes"),
            F.first("n_symbols").alias("n_symbols"),
            F.sum("copies").alias("n_copies"),
            F.min(F.struct("id", "row", "line_no")).alias("place"),
        ),
        "distinct-lines",
    )
    # lines of at most ``edits`` symbols are all linked: each to one of them stands for the pairs
    all_linked = (F.col("n_symbols") <= edits) & (F.col("n_bytes") >= least)
    all_linked = all_linked & F.lit(not symbols_per_edit)
    few = lines.filter(all_linked)
    n_few, least_few = few.agg(F.count("*"), F.min("name")).first()
    also = few.select(F.lit(least_few).cast("long").alias("a"), F.col("name").alias("b"))
    degree = (
        found.select(F.explode(F.array("a", "b")).alias("name")).groupBy("name").count()
    ).withColumnRenamed("count", "n_links")
    joined = components(found.select("a", "b").unionByName(also.filter("a < b"))).select(
        F.col("node").alias("name"), "component"
    )
    # lines of few symbols may have a component without a listed link
    linked = degree.join(joined, "name", "full").withColumn(
        "component", F.coalesce("component", "name")
    )
    lines = keep_table(lines.join(linked, "name", "left"), "lines")
    # a line without links keeps its own name as key, or all of them would meet in one task
    lines = lines.withColumn("key", F.coalesce("component", "name"))
    heads = (
        lines.filter("component is not null")
        .groupBy("key")
        .agg(F.min("place").alias("class_place"))
    )
    return lines.join(heads, "key", "left").select(
        "name",
        "n_bytes",
        "n_copies",
        (
            F.coalesce("n_links", F.lit(0))
            + F.when(all_linked, n_few - 1).otherwise(0)
        ).alias("n_links"),
        "place",
        F.coalesce("class_place", "place").alias("class_place"),
    )


def without_repeated_lines(
    docs: DataFrame,
    edits: int = EDITS,
    least: int = MIN_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    in_characters: bool = False,
    symbols_per_edit: int = 0,
) -> DataFrame:
    """All rows and columns of ``docs``; of each class of lines, only the first stays.

    Lines shorter than ``least`` bytes always stay. Removed lines go with their line
    feed; texts without a removed line are returned as they are, byte for byte.
    """
    row = "row_of_line_dedup"
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    classes = line_classes(docs, edits, least, id_col, text_col, in_characters, symbols_per_edit)
    repeated = classes.filter(F.col("n_bytes") >= least).filter(
        (F.col("n_copies") > 1) | (F.col("place") != F.col("class_place"))
    )
    repeated = keep_table(
        repeated.select("name", F.when(F.col("place") == F.col("class_place"), F.col("place")).alias("place")),
        "repeated-lines",
    )

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for part in slices(batch.column(1)):
                lines = Lines(part)
                long_ = np.flatnonzero(lines.ends - lines.starts >= least)
                where = np.searchsorted(lines.first, long_, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(lines.names[long_]),
                        pa.array(rows[part.first_row + where]),
                        pa.array(long_ - lines.first[where]),
                    ],
                    names=["name", "row", "line_no"],
                )

    every = numbered.select(row, F.col(text_col).cast("string")).mapInArrow(
        places, "name long, row long, line_no long"
    )
    gone = every.join(repeated, "name").filter(
        F.col("place").isNull()
        | (F.col("place.row") != F.col("row"))
        | (F.col("place.line_no") != F.col("line_no"))
    )
    gone = gone.groupBy(F.col("row").alias(row)).agg(
        F.collect_set(F.col("line_no").cast("int")).alias("gone_of_line_dedup")
    )
    joined = numbered.join(gone.hint("merge"), row, "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], "gone_of_line_dedup"
    )
    at = docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, gone = batch.column(at), batch.column(batch.num_columns - 1)
            texts = []
            for part in slices(given.cast(pa.string())):
                lines = Lines(part)
                for k in range(len(part)):
                    drop = gone[part.first_row + k].as_py()
                    own = None if drop is None else _without(lines, k, np.array(drop))
                    texts.append(given[part.first_row + k].as_py() if own is None else own)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, given.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.mapInArrow(cut, docs.schema)


def _without(lines: Lines, text: int, numbers: np.ndarray) -> str:
    """A text without some of its lines and the line feeds behind them."""
    low, high = int(lines.part.bounds[text]), int(lines.part.bounds[text + 1])
    which = lines.first[text] + numbers
    start, end = lines.starts[which] - low, lines.ends[which] - low
    # a last line without a line feed takes the one before it along
    last = (end == high - low) & (start > 0)
    edge = np.zeros(high - low + 2, np.int64)
    np.add.at(edge, start - last, 1)
    np.add.at(edge, end + 1, -1)
    kept = np.cumsum(edge)[: high - low] == 0
    return lines.part.data[low:high][kept].tobytes().decode()
