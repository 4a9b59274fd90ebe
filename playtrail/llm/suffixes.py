"""Repeated byte strings by a distributed difference-cover sort of suffixes.

A byte belongs to a repeat if some string of ``length`` bytes over it also starts
anywhere else. The classic algorithm samples suffixes at a difference cover modulo
3; here the modulus is the largest q*q + q + 1 up to half of ``length`` with a
perfect (Singer) cover of q + 1 residues: any two positions have exactly one shift
that takes both to sampled ones. For 400 bytes that is 14 of 183 positions.

1. *Sort sampled tuples.* Every sampled position is named by its next
   ``length - modulus + 1`` bytes; equal strings of ``length`` share such a name.
   Names are 64-bit hashes: any total order that keeps equals together will do,
   since only equal prefixes matter and none beyond ``length`` bytes.
2. *Recurse on names.* A name that occurs once ends its suffix there. Where it
   occurs again, the second name is that of the tuple with ``modulus - 1`` more
   bytes on both sides, and suffixes are sorted by (name, second name). Neighbours
   that agree in both settle all positions that lead to the sample: repeated.
3. *Merge the remaining suffixes.* Where one name has several second names, the
   positions leading to one representative of each (name, second name) are sorted
   by the hash of their whole ``length`` bytes.
4. *Compare adjacent.* Equal neighbours are repeats.

The texts are dealt to groups by row, once for the sample and once for the other
steps, which share that exchange; everything else that moves is packed numbers. The number
of groups follows the bytes of text. Copies in one group send one name with a mark, and no step lists pairs of occurrences, so
copies of any number cost one entry per group and step.

Passages are found by the same steps over words in place of bytes: strings of
``passage_words`` words that another row holds too. What blanks separate the words
plays no part. Only the bytes repeated by the first rule are removed.

Defined results: null is empty; texts shorter than ``length`` cannot repeat;
matches never cross documents; repeated rows are copies of each other and each
returns a row. Only the id and the text are read. Row numbers come from the scan,
so ``docs`` must be a table that reads the same way twice, not a random sample.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.stages import keep_table, partitions
from playtrail.llm.textbytes import UNBLANK, Hasher, Texts, Words, mix, slices

LENGTH = 400
#: Words of a passage: over 50.
PASSAGE_WORDS = 51
#: Bytes of text in a group, in the mean; there are at least two groups for each shuffle partition.
GROUP_BYTES = 1 << 26

_SETTLED, _MERGED = 1, 2
#: Kinds of what moves: intervals and places, of bytes and of words.
_BYTES, _WORDS = 0, 2
#: Owner of a string that is known to lie in several rows.
_ANYONE = np.uint32(0xFFFFFFFF)
_MOVED = pa.schema([("to", pa.int32()), ("of", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
_MOVED_SQL = "to int, of int, kind int, data binary"
_FOUND = pa.schema(
    [("id", pa.int64()), ("n_bytes", pa.int64()),
     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
     ("passages", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
)
_FOUND_SQL = (
    "id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary, "
    "passages array<struct<start:bigint,end:bigint>>"
)


def singer_cover(q: int) -> tuple[int, np.ndarray]:
    """Modulus q*q + q + 1 and a perfect difference cover, for a prime q.

    The powers of x modulo a cubic over GF(q) run through the projective plane;
    those without a square term form a line, whose exponents are the cover.
    """
    modulus = q * q + q + 1
    for n in range(q**3):
        a, b, c = n // q**2, n // q % q, n % q
        power, line = (1, 0, 0), []
        for i in range(modulus):
            if power[2] == 0:
                line.append(i)
            low, mid, high = power
            power = (high * c) % q, (low + high * b) % q, (mid + high * a) % q
        if len(line) == q + 1 and len({(x - y) % modulus for x in line for y in line}) == modulus:
            return modulus, np.array(line)
    raise ValueError(f"{q} is no prime")


def cover_for(length: int, most: int | None = None) -> tuple[int, np.ndarray]:
    most = most or max(length // 2, min(length, 7))
    primes = [q for q in range(2, 98) if all(q % p for p in range(2, q))]
    fits = [q for q in primes if q * q + q + 1 <= most]
    return singer_cover(fits[-1]) if fits else (1, np.zeros(1, np.int64))


class Tokens(Texts):
    """The words of some texts in place of their bytes."""

    def __init__(self, words: Words, first_row: int):
        super().__init__(words.hashes, words.first, first_row)

    def hasher(self) -> Hasher:
        return Hasher(self.data)


class Sampler:
    """Sampled positions of texts and their two names."""

    def __init__(self, length: int, kind: int = _BYTES):
        self.length, self.kind = length, kind
        # words are few and tell more than bytes, so fewer of them are sampled
        self.modulus, self.cover = cover_for(length, 2 * length // 3 if kind == _WORDS else None)
        self.width = length - self.modulus + 1

    def positions(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        size = np.diff(part.bounds)
        longest = int(size.max(initial=0))
        turns = np.arange(0, longest + 1, self.modulus)[:, None]
        pattern = (turns + self.cover).ravel()
        count = np.searchsorted(pattern, size - self.width + 1)
        count[size < self.length] = 0
        rows = np.repeat(np.arange(len(size)), count)
        inner = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
        return part.bounds[rows] + pattern[inner], rows

    def names(self, part: Texts) -> tuple[np.ndarray, ...]:
        """Positions; first position that leads to each; first and second names; rows."""
        at, rows = self.positions(part)
        hashed = part.hasher()
        from_ = np.maximum(at - self.modulus + 1, part.bounds[rows])
        to = np.minimum(at + self.width + self.modulus - 1, part.bounds[rows + 1])
        second = mix(hashed(from_, to) + (at - from_).astype(np.uint64))
        return at, from_, hashed(at, at + self.width), second, rows + part.first_row


class Group:
    """The texts of one group in the order of their rows, in slices with their byte (or word) offsets."""

    def __init__(self, table: pa.Table, kind: int = _BYTES):
        table = table.sort_by("row")
        self.ids = table.column("id").combine_chunks()
        self.parts, base = [], 0
        for part in slices(table.column("text")):
            if kind == _WORDS:
                part = Tokens(part.words(UNBLANK), part.first_row)
            self.parts.append((base, part))
            base += len(part.data)
        # byte places travel as 32 bits
        if base >= 1 << 32:
            raise ValueError("A single text, or a group of them, has 4 GiB or more.")

    def samples(self, sampler: Sampler):
        """Positions, first leading positions, names and owners of all samples, numbered through.

        Two samples repeat if their owners differ: of bytes each sample is its own, of words its row is.
        """
        found = [[base + at, base + from_, n, m, rows] for base, part in self.parts
                 for at, from_, n, m, rows in [sampler.names(part)]]
        if not found:
            return *(np.zeros(0, np.int64),) * 2, *(np.zeros(0, np.uint64),) * 2, np.zeros(0, np.int64)
        *named, rows = (np.concatenate(x) for x in zip(*found))
        return *named, rows if sampler.kind == _WORDS else np.arange(len(rows))


def distinct(first: np.ndarray, second: np.ndarray):
    """Of pairs of names: first and last index of each distinct pair, the pair of each index."""
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (first[order[1:]] != first[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
    number = np.cumsum(new) - 1
    pair = np.empty(len(order), np.int64)
    pair[order] = number
    starts = np.flatnonzero(new)
    return order[starts], order[np.append(starts[1:], len(order))[: len(starts)] - 1], pair


def _dealt(keys: np.ndarray, buckets: int, of: int, kind: int, arrays: list[np.ndarray]) -> list:
    """Rows that carry each bucket its part of some arrays."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(cut)):
        own = order[cut[b] : cut[b + 1]]
        rows.append((int(b), of, kind, b"".join(a[own].tobytes() for a in arrays)))
    return rows


def _table(rows: list) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 4
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MOVED)], schema=_MOVED)


#: A packed name has 40 bits of the first name, 48 of the second, 23 for its number
#: and one that says it stands for samples of several owners in its group.
_PACKED = 14


def _pack(first, second, number, several) -> list[np.ndarray]:
    if len(number) and number[-1] >= 1 << 23:
        raise ValueError("A group holds too much text; lower group_bytes.")
    mark = (number.astype(np.uint64) << np.uint64(1)) | several.astype(np.uint64)
    high = (first >> np.uint64(24) << np.uint64(24)) | (second >> np.uint64(40))
    low = ((second >> np.uint64(16)) & np.uint64(0xFFFFFF)) << np.uint64(8) | (mark >> np.uint64(16))
    return [high, low.astype(np.uint32), (mark & np.uint64(0xFFFF)).astype(np.uint16)]


def _unpack(data: list[bytes]):
    high, low, mark = [], [], []
    for raw in data:
        n = len(raw) // _PACKED
        high.append(np.frombuffer(raw, np.uint64, n))
        low.append(np.frombuffer(raw, np.uint32, n, 8 * n))
        mark.append(np.frombuffer(raw, np.uint16, n, 12 * n))
    high, low, mark = (np.concatenate(x) for x in (high, low, mark))
    mark = (low & np.uint32(0xFF)).astype(np.int64) << 16 | mark
    return high, low >> np.uint32(8), mark >> 1, (mark & 1).astype(bool)


def sort_names(table: pa.Table, kind: int) -> pa.Table:
    """Steps 1 and 2 for one bucket of names: what is settled, and who represents what is not."""
    data = table.column("data").to_pylist()
    high, low, number, several = _unpack(data)
    source = np.repeat(np.arange(len(data)), [len(x) // _PACKED for x in data])
    order = np.lexsort((low, high))
    h, s = high[order], low[order]
    name = h >> np.uint64(24)
    new_name = np.append(True, name[1:] != name[:-1])
    new_pair = new_name | np.append(True, (h[1:] != h[:-1]) | (s[1:] != s[:-1]))
    name_of, pair_of = np.cumsum(new_name) - 1, np.cumsum(new_pair) - 1
    pair_size = np.bincount(pair_of)
    pair_several = np.bincount(pair_of, several[order]) > 0
    pairs = np.bincount(name_of[new_pair])
    flags = np.zeros(len(order), np.uint32)
    flags[((pair_size > 1) | pair_several)[pair_of]] |= _SETTLED
    flags[(pairs > 1)[name_of] & new_pair] |= _MERGED
    told = np.flatnonzero(flags)
    to, value = source[order[told]], number[order[told]].astype(np.uint32) << 2 | flags[told]
    by = np.argsort(to, kind="stable")
    cut = np.searchsorted(to[by], np.arange(len(data) + 1))
    groups = table.column("of").to_pylist()
    return _table(
        [(g, g, kind, value[by[a:b]].tobytes()) for g, a, b in zip(groups, cut[:-1], cut[1:]) if b > a]
    )


def sort_whole(table: pa.Table) -> pa.Table:
    """Steps 3 and 4 for one bucket of positions: those whose whole string occurs again."""
    kind = np.array(table.column("kind").to_pylist())
    data, groups = table.column("data").to_pylist(), table.column("of").to_pylist()
    rows = [(g, g, int(k), d) for g, d, k in zip(groups, data, kind) if k in (_BYTES, _WORDS)]
    for of, size in ((_BYTES, 12), (_WORDS, 16)):
        own = np.flatnonzero(kind == of + 1)
        if not len(own):
            continue
        n = [len(data[i]) // size for i in own]
        names = np.concatenate([np.frombuffer(data[i], np.uint64, k) for i, k in zip(own, n)])
        at = np.concatenate([np.frombuffer(data[i], np.uint32, k, 8 * k) for i, k in zip(own, n)])
        source = np.repeat(np.arange(len(own)), n)
        if of == _BYTES:
            order = np.argsort(names, kind="stable")
            same = names[order[1:]] == names[order[:-1]]
            again = np.zeros(len(order), bool)
            again[order[1:]] |= same
            again[order[:-1]] |= same
        else:
            owner = np.concatenate([np.frombuffer(data[i], np.uint32, k, 12 * k) for i, k in zip(own, n)])
            again = _of_several(names, np.array(groups, np.uint64)[own][source], owner)
        hit = np.flatnonzero(again)
        cut = np.searchsorted(source[hit], np.arange(len(own) + 1))
        for k, i in enumerate(own):
            if cut[k + 1] > cut[k]:
                rows.append((groups[i], groups[i], of + 1, at[hit[cut[k] : cut[k + 1]]].tobytes()))
    return _table(rows)


def _of_several(names: np.ndarray, group: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which names have several owners; an owner is a row of its group, or anyone."""
    owner = np.where(owner == _ANYONE, ~np.uint64(0), group << np.uint64(32) | owner)
    order = np.lexsort((owner, names))
    new = np.append(True, names[order[1:]] != names[order[:-1]])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(order)) - 1
    out = np.empty(len(order), bool)
    out[order] = (owner[order[starts]] != owner[order[ends]])[np.cumsum(new) - 1]
    return out


def _marked(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``size`` positions lie in some [start, end)."""
    edge = np.bincount(start, minlength=size + 1) - np.bincount(end, minlength=size + 1)
    return np.cumsum(edge[:size]) > 0


def _flags(table: pa.Table, kind: int, dtype=np.uint32) -> np.ndarray:
    rows = zip(table.column("kind").to_pylist(), table.column("data").to_pylist())
    return np.concatenate([np.frombuffer(d, dtype) for k, d in rows if k == kind] or [np.zeros(0, dtype)])


def merge(group: Group, told: np.ndarray, of: int, sampler: Sampler, buckets: int) -> list:
    """Positions settled by step 2, as intervals, and those that step 3 has to sort."""
    at, from_, first, second, _ = group.samples(sampler)
    one, _, pair = distinct(first, second)
    flags = np.zeros(len(one), np.uint32)
    flags[told >> 2] = told & 3
    settled = np.flatnonzero(flags[pair] & _SETTLED)
    merged = np.sort(one[flags & _MERGED > 0])
    if sampler.kind == _WORDS:
        # samples of one row that share their names are not settled by each other
        merged = np.union1d(merged, np.flatnonzero(flags[pair] == _MERGED))
    rows, marks = [], []
    for base, part in group.parts:
        size = len(part.data)
        # a string starts at the last at ``length`` bytes before its text's end
        last = part.bounds[1:] - sampler.length + 1

        def leading(samples):
            a, b = np.searchsorted(at[samples], [base, base + size])
            own = samples[a:b]
            start = from_[own] - base
            stop = np.minimum(at[own] - base + 1, last[part.row_of(at[own] - base)])
            return _marked(size, start, np.maximum(start, stop))

        inside = leading(settled)
        edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
        ends = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1) + base
        marks.append(ends.astype(np.uint32).ravel())
        places = np.flatnonzero(leading(merged))
        if len(places):
            whole = part.hasher()(places, places + sampler.length)
            arrays = [whole, (places + base).astype(np.uint32)]
            if sampler.kind == _WORDS:
                row = (part.row_of(places) + part.first_row).astype(np.uint32)
                arrays.append(np.where(inside[places], _ANYONE, row))
            rows += _dealt(whole, buckets, of, sampler.kind + 1, arrays)
    marks = np.concatenate(marks) if marks else np.zeros(0, np.uint32)
    if len(marks):
        rows.append((of % buckets, of, sampler.kind, marks.tobytes()))
    return rows


def _covered(table: pa.Table, sampler: Sampler):
    """A function that tells which of the symbols [base, base + size) of a group lie in repeats."""
    settled = _flags(table, sampler.kind).astype(np.int64).reshape(-1, 2)
    places = _flags(table, sampler.kind + 1).astype(np.int64)
    start = np.concatenate([settled[:, 0], places])
    end = np.concatenate([settled[:, 1], places + 1]) + sampler.length - 1
    order = np.argsort(start)
    start, end = start[order], end[order]

    def covered(base: int, size: int) -> np.ndarray:
        a, b = np.searchsorted(start, [base, base + size])
        return _marked(size, start[a:b] - base, np.minimum(end[a:b] - base, size))

    return covered


def _passages(part: Texts, words: Words, inside: np.ndarray) -> list:
    """Byte spans of the maximal runs of words inside repeats, for each text."""
    first = np.zeros(len(inside) + 1, bool)
    first[words.first] = True
    before = np.append(False, inside[:-1])
    after = np.append(inside[1:], False)
    one = np.flatnonzero(inside & (first[:-1] | ~before))
    last = np.flatnonzero(inside & (first[1:] | ~after))
    row = np.searchsorted(words.first, one, side="right") - 1
    start, end = words.starts[one] - part.bounds[row], words.ends[last] - part.bounds[row]
    runs = [{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist())]
    cut = np.searchsorted(row, np.arange(len(part) + 1)).tolist()
    return [runs[a:b] for a, b in zip(cut[:-1], cut[1:])]


def answer(group: Group, table: pa.Table, sampler: Sampler, words_sampler: Sampler) -> pa.Table:
    """Spans of repeated bytes, what is kept, and passages, for every text of a group."""
    covered, in_passages = _covered(table, sampler), _covered(table, words_sampler)
    sizes, spans, kept, passages, words_before = [], [], [], [], 0
    for base, part in group.parts:
        gone = covered(base, len(part.data))
        for k in range(len(part)):
            x, y = int(part.bounds[k]), int(part.bounds[k + 1])
            own = gone[x:y]
            edge = np.diff(np.concatenate([[0], own.astype(np.int8), [0]]))
            runs = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())
            spans.append([{"start": s, "end": e} for s, e in runs])
            kept.append(part.data[x:y][~own].tobytes())
            sizes.append(y - x)
        words = part.words(UNBLANK)
        passages += _passages(part, words, in_passages(words_before, len(words)))
        words_before += len(words)
    arrays = [group.ids, pa.array(sizes, pa.int64()), pa.array(spans, _FOUND.field(2).type),
              pa.array(kept, pa.binary()), pa.array(passages, _FOUND.field(4).type)]
    return pa.Table.from_arrays(arrays, schema=_FOUND)


def repeated_bytes(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_bytes: int = GROUP_BYTES,
    passage_words: int = PASSAGE_WORDS,
) -> DataFrame:
    """Per document: id, n_bytes, spans of repeated bytes, the bytes kept, and passages.

    ``passages`` are the byte spans covered by ``passage_words`` words in a row that
    another row holds too; words are runs without a blank of ASCII. They are only told, not removed. The number of groups follows the bytes of text, so that what a task holds does not.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("long"))).first()[0]
    groups = max(2 * partitions(docs.sparkSession), -(-(size or 0) // group_bytes))
    buckets = -(-groups // 2)
    dealt = (
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(text_col).cast("string").alias("text"),
            F.monotonically_increasing_id().alias("row"),
        )
        .withColumn("of", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
        .repartition("of")
    )

    samplers = Sampler(length), Sampler(passage_words, _WORDS)

    def named(sampler: Sampler) -> DataFrame:
        def sample(table: pa.Table) -> pa.Table:
            of = table.column("of")[0].as_py()
            _, _, first, second, owner = Group(table, sampler.kind).samples(sampler)
            one, last, _ = distinct(first, second)
            # low bits choose the bucket, high bits go with the entry
            arrays = _pack(first[one], second[one], np.arange(len(one)), owner[one] != owner[last])
            return _table(_dealt(first[one], buckets, of, 0, arrays))

        names = dealt.groupBy("of").applyInArrow(sample, _MOVED_SQL)
        told = names.groupBy("to").applyInArrow(lambda t: sort_names(t, sampler.kind), _MOVED_SQL)
        # names are by far the most that moves; once written, their shuffle files can go
        return keep_table(told, "names")

    def spread(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([])
        of = left.column("of")[0].as_py()
        return _table([row for s in samplers
                       for row in merge(Group(left, s.kind), _flags(right, s.kind), of, s, buckets)])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        return answer(Group(left), right, *samplers)

    told = named(samplers[0]).unionByName(named(samplers[1]))
    rest = dealt.groupBy("of").cogroup(told.groupBy("of")).applyInArrow(spread, _MOVED_SQL)
    found = rest.groupBy("to").applyInArrow(sort_whole, _MOVED_SQL)
    return dealt.groupBy("of").cogroup(found.groupBy("of")).applyInArrow(finish, _FOUND_SQL)
