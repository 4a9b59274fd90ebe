"""Packing token sequences: best-fit decreasing with a segment tree over capacities.

``pieces`` turns texts into token ids with a public tokenizer and cuts overlong
documents into full windows and one rest. ``pack`` deals the pieces to groups by
a hash of their own number, so that no document, however long, and no copy
fills a group by itself; within a group, pieces go in order of decreasing length
to the tightest open window. A group leaves one window's worth of padding or so,
hence groups hold some ten thousand pieces, in memory a few numbers each.

Defined results: a null or empty text has only its end id; repeated rows are
packed once each; ties of length go by document and start. Only the id and the
text are read, so other columns cannot clash.
"""

import zlib
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.stages import keep_table
from playtrail.llm.textbytes import UNBLANK, Texts, slices

CAPACITY = 2048
END = 1
TOKENIZER = "word_bpe_49k.json"
#: Pieces per packing group, in the mean.
GROUP_PIECES = 20_000
#: Units whose ids a worker remembers; beyond it, it drops the half not used for longest.
KNOWN_UNITS = 2_000_000
#: Longer units are known by a cryptographic hash, as polynomial ones can collide by design.
LONG_UNIT = 512

_LETTER, _SIGN, _OTHER = 1, 2, 0
_KIND = np.zeros(256, np.uint8)
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), 123, 125, 126]] = _SIGN
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PIECES = f"serial long, {_PIECE}"
_PACKED = f"{_PIECE}, sequence_id long, offset long"


class UnitTokenizer:
    """Token ids of whole texts, looking up each distinct unit of text once.

    The tokenizer drops white space and lets no token span it, nor the border
    between a run of letters and a run of signs. So texts are cut at blanks and at
    such borders and each distinct unit is encoded once. Chunks with anything else
    in them (digits, apostrophes, ``|`` which special tokens have, characters
    beyond the Latin-1 letters) are units as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path, self.tokenizer = path, Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        """Start without any known units. They are kept as arrays in order of their hashes:
        number, age, and where their ids begin in ``ids``."""
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.used = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.round = 0

    def units(self, part: Texts) -> tuple[np.ndarray, np.ndarray, Texts]:
        data = part.data
        starts, ends = part.runs(UNBLANK)
        kind = _KIND[data]
        if len(data):
            # Latin-1 letters are C3 followed by 80-BF, but for the two signs among them
            lead = np.flatnonzero(data[:-1] == 0xC3)
            second = data[lead + 1]
            lead = lead[(second != 0x97) & (second != 0xB7)]
            kind[lead] = kind[lead + 1] = _LETTER
        other = np.cumsum(np.append(0, kind == _OTHER))
        plain = other[ends] == other[starts]
        border = np.zeros(len(data) + 1, bool)
        border[1:-1] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        chunk_edge = np.zeros(len(data) + 1, np.int8)
        chunk_edge[starts[plain]] += 1
        chunk_edge[ends[plain]] -= 1
        cuts = np.flatnonzero(border & (np.cumsum(chunk_edge) > 0) & (chunk_edge <= 0))
        # only the plain chunks are lower-cased: special tokens must stay as they are
        low = data.copy()
        capital = (data >= 65) & (data <= 90) & (np.cumsum(chunk_edge)[:-1] > 0)
        low[capital] += 32
        lowered = Texts(low, part.bounds)
        return np.sort(np.append(starts, cuts)), np.sort(np.append(ends, cuts)), lowered

    def encode(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a slice, and where each text's ids start."""
        starts, ends, low = self.units(part)
        hashes = low.hasher()(starts, ends)
        for k in np.flatnonzero(ends - starts > LONG_UNIT).tolist():
            told = blake2b(low.data[starts[k] : ends[k]].tobytes(), digest_size=8)
            hashes[k] = int.from_bytes(told.digest(), "little")
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        self.round += 1
        slot = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), bool)
        inside = slot < len(self.keys)
        new[inside] = self.keys[slot[inside]] != distinct[inside]
        if new.any():
            self._learn(distinct[new], low.data, starts[at[new]], ends[at[new]])
            slot = np.searchsorted(self.keys, distinct)
        self.used[slot] = self.round
        slots = slot[back]
        size, first = self.size[slots], self.first[slots]
        ahead = np.cumsum(size, dtype=np.int64) - size
        total = int(size.sum())
        ids = self.ids[np.arange(total) + np.repeat(first - ahead, size)]
        bounds = np.append(ahead, total)[np.searchsorted(starts, part.bounds)]
        if len(self.keys) > KNOWN_UNITS:
            self._drop_oldest()
        return ids, bounds

    def _learn(self, keys, data, starts, ends) -> None:
        """Encode new units (in order of their keys) and sort them in."""
        view = data.tobytes()
        texts = [view[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        lists = [e.ids for e in encoded]
        size = np.fromiter(map(len, lists), np.int32, len(lists))
        first = len(self.ids) + np.cumsum(size, dtype=np.int64) - size
        more = np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum()))
        self.ids = np.concatenate([self.ids, more])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.first = np.insert(self.first, at, first)
        self.size = np.insert(self.size, at, size)
        self.used = np.insert(self.used, at, self.round)

    def _drop_oldest(self) -> None:
        """Keep the half of the known units that was used last."""
        kept = self.used > np.partition(self.used, len(self.used) // 2)[len(self.used) // 2]
        size, first = self.size[kept], self.first[kept]
        ahead = np.cumsum(size, dtype=np.int64) - size
        self.ids = self.ids[np.arange(int(size.sum())) + np.repeat(first - ahead, size)]
        self.keys, self.used, self.size, self.first = self.keys[kept], self.used[kept], size, ahead


_tokenizers: dict[str, UnitTokenizer] = {}


def tokenizer(path: str) -> UnitTokenizer:
    """One per worker process and file."""
    if path not in _tokenizers:
        _tokenizers[path] = UnitTokenizer(path)
    return _tokenizers[path]


def cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, np.ndarray]]:
    for start in range(0, len(ids), capacity):
        yield start, ids[start : start + capacity]


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, id_col="doc_id", text_col="text"
) -> DataFrame:
    """A row per piece: full windows of long documents, and every rest.

    ``serial`` numbers the rows, for good once the table is written.
    """

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        serial = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for part in slices(batch.column(1)):
                ids, bounds = encoder.encode(part)
                rows = []
                for k in range(len(part)):
                    own = np.append(ids[bounds[k] : bounds[k + 1]], END).astype("<u4")
                    doc = doc_ids[part.first_row + k]
                    for start, piece in cut(own, capacity):
                        rows.append((serial, doc, start, len(piece), zlib.crc32(piece), len(own)))
                        serial += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)],
                    names=["serial", "doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    narrow = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return narrow.mapInArrow(tokenize, _PIECES)


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree that counts them.

    Leaf c counts the windows with c tokens left; every inner node sums its two
    children, so the smallest remaining capacity of at least n is found by
    climbing from leaf n until a right sibling has windows, then descending.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, remaining: int, window: int) -> None:
        self.at[remaining].append(window)
        self._add(remaining, 1)

    def take_tightest(self, length: int) -> tuple[int, int] | None:
        """Remaining capacity and number of the tightest window that fits; it is removed."""
        node = length + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        remaining = node - self.size
        self._add(remaining, -1)
        return remaining, self.at[remaining].pop()

    def _add(self, remaining: int, n: int) -> None:
        node = remaining + self.size
        while node:
            self.count[node] += n
            node >>= 1


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For lengths in decreasing order: the window of each, and its offset there."""
    window = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    open_ = OpenWindows(capacity)
    used = 0
    for i, length in enumerate(lengths.tolist()):
        found = open_.take_tightest(length) if length < capacity else None
        remaining, number = found or (capacity, used)
        used += found is None
        window[i], offset[i] = number, capacity - remaining
        if remaining > length:
            open_.put(remaining - length, number)
    return window, offset


def pack(found: DataFrame, groups: int, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece a sequence and an offset there; sequences belong to one group."""

    def fill(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["length", "doc_id", "start", "serial"], ascending=[False, True, True, True]
        )
        window, offset = best_fit_decreasing(frame["length"].to_numpy(), capacity)
        frame["sequence_id"] = (int(key[0]) << 40) + window
        frame["offset"] = offset
        return frame.drop(columns=["packing_group", "serial"])

    dealt = found.withColumn("packing_group", F.pmod(F.xxhash64("serial"), F.lit(groups)))
    return dealt.groupBy("packing_group").applyInPandas(fill, _PACKED)


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their sequences; the pieces are written once and counted."""
    found = keep_table(pieces(docs, path, capacity, id_col, text_col), "pieces")
    return pack(found, max(1, round(found.count() / group_pieces)), capacity)
