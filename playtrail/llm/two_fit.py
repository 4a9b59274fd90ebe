"""Best-two-fit packing of token sequences.

Texts become token ids; a document longer than a window is cut into full windows, what is
left over being its first piece. Windows are filled one after another: greedily with the
longest piece that fits, until none does. Then the window's smallest piece gives way to the
two unpacked pieces that fill the gap it leaves most tightly, if they are tighter than it
was, and goes back to the unpacked ones.

The method looks at lengths only, of which there are at most as many as a window has
tokens. So it runs over the counts of lengths and finds patterns of windows; a pattern is
repeated as long as its lengths last, which gives the windows that one-by-one filling
gives. Pieces are dealt to groups by a number of their own, so that no document and no
copies fill a group, and each group is packed by itself: it costs one window's padding or
so. A group holds a few numbers per piece.

Defined results: a null or empty text has only its end id; repeated rows are packed once
each; within a length, pieces go by document and piece. Only the id and the text are read,
so other columns cannot clash.
"""

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.stages import keep_table

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"
#: Pieces per packing group, in the mean.
GROUP_PIECES = 20_000
#: A text with a longer run of blanks or of other characters takes the slower way, whose time
#: does not grow with the square of a run.
LONGEST_RUN = 400

_PIECES = "serial long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32, 133, 160]] = True


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary.

    A byte that prints as one character in Latin-1 stands for itself; the others are
    numbered from 256 on in their order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merge_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Ranks of a byte-level vocabulary whose ids follow its merges, and its special tokens."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, before = told["model"], told.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True)
    if not plain or before.get("add_prefix_space") or told.get("normalizer"):
        return None
    letters = byte_alphabet()
    special = {token["content"]: token["id"] for token in told["added_tokens"]}
    ranks = {
        bytes(letters[c] for c in token): id_
        for token, id_ in model["vocab"].items()
        if token not in special
    }
    joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    in_order = all(model["vocab"][token] == 256 + i for i, token in enumerate(joined))
    return (ranks, special) if in_order and len(ranks) == 256 + len(joined) else None


class Encoder:
    """Token ids of texts as the tokenizer file gives them.

    Latin-1 texts without very long runs and special tokens go to a second encoder over the
    same ranks, which is several times faster and, there, gives the same ids; its letters,
    digits and blanks are the same in that range. All other texts go to the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.quick, self.special = None, ()
        found = merge_ranks(path)
        if found:
            import public_tokenizers
            import tiktoken

            ranks, special = found
            self.special = tuple(special)
            self.quick = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def is_plain(self, text: str) -> bool:
        try:
            data = np.frombuffer(text.encode("latin-1"), np.uint8)
        except UnicodeEncodeError:
            return False
        turns = np.flatnonzero(np.diff(_BLANK[data], prepend=2, append=2))
        return not np.any(np.diff(turns) > LONGEST_RUN) and not any(
            name in text for name in self.special
        )

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if self.quick is not None and self.is_plain(text):
            return self.quick.encode_to_numpy(text, disallowed_special=())
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of full length but for the first, with their starts."""
    start = 0
    end = len(ids) % capacity or min(capacity, len(ids))
    while start < len(ids):
        yield start, ids[start:end]
        start, end = end, end + capacity


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, id_col="doc_id", text_col="text"
) -> DataFrame:
    """A row per piece; ``serial`` numbers the rows of the table once it is written."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        serial = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.append(encode(text.as_py() or ""), END).astype("<u4")
                for number, (start, piece) in enumerate(cut(own, capacity)):
                    rows.append((serial, doc, number, start, len(piece), zlib.crc32(piece)))
                    serial += 1
            if rows:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    names=["serial", "doc_id", "piece", "start", "length", "ids_crc32"],
                )

    narrow = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return narrow.mapInArrow(tokenize, _PIECES)


class Unpacked:
    """How many pieces of each length are left; bit n of ``some`` tells whether any of n is."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.count = np.bincount(lengths, minlength=capacity + 1).tolist()
        self.some = sum(1 << n for n, c in enumerate(self.count) if c)

    def longest(self, room: int) -> int:
        """The greatest length left that fits, 0 if none does."""
        return max((self.some & ((2 << room) - 1)).bit_length() - 1, 0)

    def add(self, length: int, n: int) -> None:
        self.count[length] += n
        if self.count[length]:
            self.some |= 1 << length
        else:
            self.some &= ~(1 << length)

    def tightest_pair(self, room: int) -> tuple[int, int]:
        """Two pieces left whose sum is greatest within the room; of equal sums the most unequal."""
        best = (0, 0)
        left = self.some & ((2 << (room // 2)) - 1)
        while left:
            low = (left & -left).bit_length() - 1
            left &= left - 1
            high = self.longest(room - low)
            if high < low or (high == low and self.count[low] < 2):
                continue
            if low + high > sum(best):
                best = (high, low)
                if low + high == room:
                    break
        return best


def patterns(lengths: np.ndarray, capacity: int) -> Iterator[tuple[list[int], int]]:
    """Windows as lists of lengths in falling order, each with how often it is used."""
    unpacked = Unpacked(lengths, capacity)
    while unpacked.some:
        used: dict[int, int] = {}

        def place(length: int, n: int) -> None:
            used[length] = used.get(length, 0) + n
            unpacked.add(length, -n)

        gap = capacity
        while longest := unpacked.longest(gap):
            n = min(gap // longest, unpacked.count[longest])
            place(longest, n)
            gap -= n * longest
        smallest = min(used)
        high, low = unpacked.tightest_pair(gap + smallest) if gap else (0, 0)
        if high + low > smallest:
            place(smallest, -1)
            place(high, 1)
            place(low, 1)
        used = {length: n for length, n in used.items() if n}
        more = min(unpacked.count[length] // n for length, n in used.items())
        for length, n in used.items():
            unpacked.add(length, -more * n)
        yield [n for n in sorted(used, reverse=True) for _ in range(used[n])], 1 + more


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For lengths in rising order: the window of each piece, and its offset there."""
    places, windows, offsets = [], [], []
    used = 0
    for window, times in patterns(lengths, capacity):
        places.append(np.tile(window, times))
        windows.append(np.repeat(np.arange(used, used + times), len(window)))
        offsets.append(np.tile(np.cumsum([0, *window[:-1]]), times))
        used += times
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(np.concatenate(places), kind="stable")
    return np.concatenate(windows)[order], np.concatenate(offsets)[order]


def pack(found: DataFrame, groups: int, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece a sequence and an offset there; sequences belong to one group."""

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "serial")])
        window, offset = best_two_fit(table["length"].to_numpy(), capacity)
        table = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        table = table.append_column("sequence_id", pa.array((key[0].as_py() << 40) + window))
        return table.append_column("offset", pa.array(offset))

    dealt = found.withColumn("packing_group", F.pmod(F.xxhash64("serial"), F.lit(groups)))
    return dealt.groupBy("packing_group").applyInArrow(fill, _PACKED)


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
