"""Spelling variants: words one edit apart, found by pivotal grams.

``word_counts`` counts the runs of Latin letters in whole texts, combined in the worker
before the shuffle. ``near_words`` joins the distinct words with themselves:

* Bigrams are ranked by how many words have them, rarest first. The ranks are one table of
  at most 2^16 entries, whatever the corpus: the letters are Latin-1.
* The prefix of a word is its three rarest bigrams, and all that tie with the third. Dynamic
  programming over the prefix chooses the word's pivots, two disjoint bigrams whose lists
  are shortest together.
* One edit leaves one of two disjoint bigrams whole, and moves it by one place at most. So
  of two near words, the one whose prefix ends at the lower rank has a pivot in the other's
  prefix. Words meet by bigram; a pivot meets the prefix grams at the places an edit allows:
  the same place, or for words of unlike length also the place next to it.
* A list of a common bigram is quadratic if each pivot is compared with each gram. But an
  edit also leaves one half of a word whole. Within a list, pivots therefore meet grams by
  length, place and the hash of a half; a list of many words is dealt to several tasks by
  the same key. Neither drops a pair of near words.
* Every pair that is left is verified by its edit distance.

``forms`` takes from each word's near words the most frequent one; ``roots`` follows the
forms to the last by joins that double the length of the followed chain.

Defined results: null and empty texts have no words; a null id is an empty text; repeated
rows count as often as they stand. Words of any length take part. Two words have an edge
once, whatever the number of their common grams. Only the id and the text are read.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.stages import keep_table
from playtrail.llm.textbytes import LOWER, Hasher, Texts, mix, slices

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A near word has to be so many times as frequent to be a word's form.
MUCH_MORE = 5
#: One run in so many is damaged before it is counted.
DAMAGED = 199
#: Words that a worker counts before it hands the counts on.
HELD_WORDS = 200_000
#: Prefix grams of one list in one task, in the mean; longer lists are dealt by halves.
LIST_WORDS = 100_000
#: Pairs verified at a time.
PORTION = 1 << 18
#: A run above so many bytes is counted by itself and not by its hash.
LONG_RUN = 512

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3] = True
_GRAMS = 1 << 16


def _shift_tables() -> np.ndarray:
    """For each k: what 2^k further zero bytes do to a CRC-32, by the value of each of its bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
    table = np.empty((4, 256), np.uint32)
    for place in range(4):
        x = np.arange(256, dtype=np.uint32) << np.uint32(8 * place)
        table[place] = (x >> np.uint32(8)) ^ one[x & np.uint32(255)]
    tables = [table]
    for _ in range(31):
        tables.append(np.stack([_shifted(tables[-1], row) for row in tables[-1]]))
    return np.stack(tables)


def _shifted(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    low, high = crc & np.uint32(0xFFFF), crc >> np.uint32(16)
    return table[0][low & 255] ^ table[1][low >> 8] ^ table[2][high & 255] ^ table[3][high >> 8]


_SHIFTS = _shift_tables()


def joined_crc(before: np.ndarray, after: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two joined strings from the CRC-32 of each and the second's bytes."""
    crc = before.astype(np.uint32, copy=True)
    for k in range(int(size.max(initial=0)).bit_length()):
        chosen = np.flatnonzero((size >> k) & 1)
        crc[chosen] = _shifted(_SHIFTS[k], crc[chosen])
    return crc ^ after


def letter_runs(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the maximal runs of A-Z, a-z and U+00C0 to U+00FF."""
    # U+00C0 to U+00FF are C3 and a byte of 80 to BF, and C3 begins nothing else
    after = np.zeros(len(part.data), bool)
    after[1:] = part.data[:-1] == 0xC3
    shown = np.where(after, np.uint8(97), part.data)
    return Texts(shown, part.bounds).runs(_LETTER)


def damaged_run(run: bytes, crc: int) -> str:
    """The run without the code point that its checksum chooses."""
    text = run.decode()
    at = crc % len(text)
    return text[:at] + text[at + 1 :]


def count_words(part: Texts, ids: list, found: dict[str, int], least: int, damaged: int) -> None:
    """Add the words of a slice to ``found``, in which a word has at least ``least`` letters."""
    low = part.lower()
    starts, ends = letter_runs(low)
    if not len(starts):
        return
    rows, size = part.row_of(starts), ends - starts
    view = low.data.tobytes()
    hashes = low.hasher()(starts, ends)
    # polynomial hashes are not safe for long strings: those are told apart by their place
    long_runs = np.flatnonzero(size > LONG_RUN)
    hashes[long_runs] = mix(starts[long_runs].astype(np.uint64))
    distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    words = [view[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    own = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    heads = np.array([zlib.crc32(f"{ids[r]}:".encode()) for r in range(len(ids))], np.uint32)
    crc = joined_crc(heads[rows], own[back], size)
    hit = crc % damaged == 0
    counts = np.bincount(back[~hit], minlength=len(words)).tolist()
    for word, n in zip(words, counts):
        if n and len(word) >= least:
            text = word.decode()
            if len(text) >= least:
                found[text] = found.get(text, 0) + n
    for at in np.flatnonzero(hit).tolist():
        text = damaged_run(words[back[at]], int(crc[at]))
        if len(text) >= least:
            found[text] = found.get(text, 0) + 1


def word_counts(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    damaged: int = DAMAGED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n) over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}

        def told() -> pa.RecordBatch:
            columns = [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            ids = ["" if i is None else str(i) for i in batch.column(0).to_pylist()]
            for part in slices(batch.column(1)):
                own = ids[part.first_row : part.first_row + len(part)]
                count_words(part, own, found, least_length, damaged)
                if len(found) > HELD_WORDS:
                    yield told()
                    found.clear()
        yield told()

    narrow = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    counted = narrow.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """Words as one array of Latin-1 characters; word i is ``data[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, words: list[str]):
        encoded = [word.encode("latin-1") for word in words]
        self.size = np.fromiter(map(len, encoded), np.int64, len(encoded))
        self.bounds = np.append(0, np.cumsum(self.size))
        self.data = np.frombuffer(b"".join(encoded), np.uint8)

    def text(self, which: np.ndarray) -> list[str]:
        view, low, high = self.data.tobytes(), self.bounds[which], self.bounds[which + 1]
        return [view[a:b].decode("latin-1") for a, b in zip(low.tolist(), high.tolist())]

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All bigrams: code, word and place in the word."""
        n = np.maximum(self.size - 1, 0)
        word = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
        at = self.bounds[word] + place
        wide = self.data.astype(np.int64)
        return (wide[at] << 8) | wide[at + 1], word, place


def _counted_grams(total: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array(total[some])], names=["gram", "n"]
    )


def _gram_table(counted: DataFrame) -> np.ndarray:
    """Counts of all bigrams: 2^16 numbers at most, one for each pair of Latin-1 characters."""
    table = np.zeros(_GRAMS, np.int64)
    for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        table[row["gram"]] = row["n"]
    return table


def gram_ranks(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each bigram: its rank, rarest first, and how often the words have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_GRAMS, np.int64)
        for batch in batches:
            total += np.bincount(Words(batch.column(0).to_pylist()).grams()[0], minlength=_GRAMS)
        yield _counted_grams(total)

    often = _gram_table(words.select("word").mapInArrow(count, "gram int, n long"))
    rank = np.empty(_GRAMS, np.int64)
    rank[np.lexsort((np.arange(_GRAMS), often))] = np.arange(_GRAMS)
    return rank, often


def prefix_grams(words: Words, rank: np.ndarray, often: np.ndarray):
    """Prefix grams in order of place: code, word, place, and whether it is a pivot."""
    gram, word, place = words.grams()
    order = np.lexsort((rank[gram], word))
    n = np.maximum(words.size - 1, 0)
    third = np.cumsum(n) - n + np.minimum(2, n - 1)
    last = np.full(len(n), -1, np.int64)
    last[n > 0] = rank[gram[order[third[n > 0]]]]
    kept = rank[gram] <= last[word]
    gram, word, place = gram[kept], word[kept], place[kept]
    return gram, word, place, choose_pivots(gram, word, place, often)


def choose_pivots(gram, word, place, often) -> np.ndarray:
    """Two disjoint grams per word with the least sum of frequencies, by dynamic programming.

    Grams are visited by their number within the word, all words at a time. The best gram
    that ends before one begins is the best of all earlier ones or, if the last of those
    overlaps, of all but the last.
    """
    pivot = np.zeros(len(gram), bool)
    if not len(gram):
        return pivot
    first = np.flatnonzero(np.diff(word, prepend=-1))
    n = np.diff(np.append(first, len(word)))
    cost = often[gram]
    none = np.iinfo(np.int64).max // 4
    best = np.stack([np.full(len(first), -1)] * 2)  # best of all earlier grams, and of all but one
    least = np.full(len(first), none)
    chosen = np.stack([first, first])
    alive = np.arange(len(first))
    for k in range(int(n.max())):
        alive = alive[n[alive] > k]
        at = first[alive] + k
        touches = (k > 0) & (place[at] - place[at - 1] < 2)
        mate = np.where(touches, best[1][alive], best[0][alive])
        both = np.where(mate >= 0, cost[at] + cost[mate], none)
        better = both < least[alive]
        won = alive[better]
        least[won] = both[better]
        chosen[0][won], chosen[1][won] = mate[better], at[better]
        top = best[0][alive]
        best[1][alive] = top
        best[0][alive] = np.where((top < 0) | (cost[at] < cost[top]), at, top)
    pivot[chosen.ravel()] = True
    return pivot


#: How much longer the word with the prefix gram is, and how far its gram is moved.
MOVES = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))
_NUMBERED = [(m, longer, by) for m, (longer, by) in enumerate(MOVES)]
#: What a row of the index takes part as.
GRAM, PIVOT, BOTH = 0, 1, 2
_INDEX = "list_group long, gram int, place int, role int, move int, half int, word string, n long"


def meeting_key(words: Words, hasher: Hasher, gram, word, place, longer: int, right: int):
    """Key of a pivot (``longer`` 0), or of the pivots that a prefix gram may meet.

    It holds the bigram, the pivot's place, its word's length and the hash of a half of it.
    The word of a prefix gram, ``longer`` letters longer, has that half at its beginning or end.
    """
    start, end = words.bounds[word], words.bounds[word + 1]
    size = end - start - longer
    middle = start + size // 2
    half = hasher(middle + longer, end) if right else hasher(start, middle)
    told = mix((size << 20) ^ gram) ^ mix((place.astype(np.int64) + 2) * 2 + right)
    return mix(told) ^ half


def _meetings(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of equal keys in both arrays, a portion of pairs at a time."""
    order = np.argsort(right, kind="stable")
    ranged = right[order]
    low, high = (np.searchsorted(ranged, left, side) for side in ("left", "right"))
    some = np.flatnonzero(high > low)
    low, n = low[some], (high - low)[some]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, PORTION):
        pair = np.arange(begin, min(begin + PORTION, total))
        which = np.searchsorted(ends, pair, side="right")
        yield some[which], order[low[which] + pair - (ends[which] - n[which])]


def one_edit(words: Words, hasher: Hasher, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and b differ by one edit, from hashes of equal beginnings and ends."""
    shorter = np.where(words.size[a] <= words.size[b], a, b)
    longer = a + b - shorter
    size, more = words.size[shorter], words.size[longer] - words.size[shorter]
    s, t = words.bounds[shorter], words.bounds[longer]
    low, high = np.zeros_like(size), size.copy()
    while np.any(low < high):
        middle = (low + high + 1) // 2
        same = hasher(s, s + middle) == hasher(t, t + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    # the shorter word goes on after the edit, which takes a letter of it if both are as long
    rest = np.minimum(low + (more == 0), size)
    beyond = np.minimum(low + 1, size + more)
    tail = hasher(s + rest, s + size) == hasher(t + beyond, t + size + more)
    return (more <= 1) & (low < size + more) & tail


def pairs_of_lists(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of near words of some lists: pivots against prefix grams."""
    words = Words(table["word"].to_pylist())
    hasher = Hasher(mix(words.data.astype(np.uint64) + np.uint64(1)))
    gram, place, role, move, half, count = (
        table[name].to_numpy() for name in ("gram", "place", "role", "move", "half", "n")
    )
    for m, (longer, by) in enumerate(MOVES):
        for right in (0, 1):
            here = ((move < 0) | (move == m)) & ((half < 0) | (half == right))
            a, b = np.flatnonzero(here & (role != GRAM)), np.flatnonzero(here & (role != PIVOT))
            keys = [
                meeting_key(words, hasher, gram[rows], rows, place[rows] - moved, gained, right)
                for rows, gained, moved in ((a, 0, 0), (b, longer, by))
            ]
            for x, y in _meetings(*keys):
                x, y = a[x], b[y]
                near = one_edit(words, hasher, x, y)
                x, y = x[near], y[near]
                if len(x):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(words.text(x)),
                            pa.array(count[x]),
                            pa.array(words.text(y)),
                            pa.array(count[y]),
                        ],
                        names=["a", "n_a", "b", "n_b"],
                    )


def list_sizes(words: DataFrame, rank: np.ndarray, often: np.ndarray) -> np.ndarray:
    """How many prefix grams the list of each bigram holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_GRAMS, np.int64)
        for batch in batches:
            found = prefix_grams(Words(batch.column(0).to_pylist()), rank, often)
            total += np.bincount(found[0], minlength=_GRAMS)
        yield _counted_grams(total)

    return _gram_table(words.select("word").mapInArrow(count, "gram int, n long"))


def index(words: DataFrame, rank, often, sizes, list_words: int) -> DataFrame:
    """Prefix grams with the group of lists that each belongs to.

    Short lists are dealt whole. A row of a long list goes to the groups of its keys: a pivot
    once for either half, a prefix gram once for either half and each move.
    """
    groups = max(1, -(-int(sizes.sum()) // list_words))
    names = ["list_group", "gram", "place", "role", "move", "half", "word", "n"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(1).to_numpy(zero_copy_only=False)
            words = Words(batch.column(0).to_pylist())
            hasher = Hasher(mix(words.data.astype(np.uint64) + np.uint64(1)))
            gram, word, place, pivot = prefix_grams(words, rank, often)
            long_list = sizes[gram] > list_words

            def told(at, role, move=-1, half=-1, key=None):
                key = mix(gram[at].astype(np.uint64)) if key is None else key
                size = len(at)
                columns = [
                    pa.array((key % np.uint64(groups)).astype(np.int64)),
                    pa.array(gram[at].astype(np.int32)),
                    pa.array(place[at].astype(np.int32)),
                    pa.array(np.broadcast_to(np.asarray(role, np.int32), size)),
                    pa.array(np.full(size, move, np.int32)),
                    pa.array(np.full(size, half, np.int32)),
                    pa.array(words.text(word[at])),
                    pa.array(counts[word[at]]),
                ]
                return pa.RecordBatch.from_arrays(columns, names=names)

            at = np.flatnonzero(~long_list)
            yield told(at, np.where(pivot[at], BOTH, GRAM))
            every, pivots = np.flatnonzero(long_list), np.flatnonzero(long_list & pivot)
            for right in (0, 1):
                for role, at, moves in ((PIVOT, pivots, [(-1, 0, 0)]), (GRAM, every, _NUMBERED)):
                    for m, longer, by in moves:
                        if len(at):
                            key = meeting_key(
                                words, hasher, gram[at], word[at], place[at] - by, longer, right
                            )
                            yield told(at, role, m, right, key)

    return words.select("word", "n").mapInArrow(rows, _INDEX)


def near_words(words: DataFrame, list_words: int = LIST_WORDS) -> DataFrame:
    """Pairs (a, n_a, b, n_b), a before b, of words one edit apart; ``words`` is a written table."""
    rank, often = gram_ranks(words)
    sizes = list_sizes(words, rank, often)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pairs_of_lists(pa.Table.from_batches(batches))

    found = (
        index(words, rank, often, sizes, list_words)
        .groupBy("list_group")
        .applyInArrow(pairs, "a string, n_a long, b string, n_b long")
    )
    turned = F.col("a") > F.col("b")
    return (
        found.select(
            F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"),
            F.when(turned, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"),
            F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"),
            F.when(turned, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"),
        )
        .distinct()
        .filter(F.levenshtein("a", "b", 1) == 1)
    )


def forms(words: DataFrame, near: DataFrame, much_more: int = MUCH_MORE) -> DataFrame:
    """Words with how many near words they have and, if there is one, their form and its n."""
    both = near.select("a", "n_a", "b", "n_b").union(near.select("b", "n_b", "a", "n_a"))
    best = both.groupBy(F.col("a").alias("word_")).agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("best"),
    )
    chosen = -F.col("best.less") >= F.lit(much_more) * F.col("n")
    return words.join(best, words["word"] == best["word_"], "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(chosen, F.col("best.form")).alias("form"),
        F.when(chosen, -F.col("best.less")).alias("form_n"),
    )


def roots(found: DataFrame, least: int = LEAST_COUNT, much_more: int = MUCH_MORE) -> DataFrame:
    """The table of ``forms`` (written) with the last word of each chain of forms.

    Each form is ``much_more`` times as frequent as the word before it, so no chain is longer
    than the logarithm of the greatest frequency; following it takes the logarithm of that
    many joins.
    """
    most = found.agg(F.max("form_n")).first()[0]
    jumps = found.filter("form is not null").select("word", F.col("form").alias("root"))
    if most:
        hops, doublings = 1 + int(math.log(max(most / least, 1), much_more)), 0
        while 2**doublings < hops:
            doublings += 1
            on = jumps.select(F.col("word").alias("via"), F.col("root").alias("last"))
            jumps = keep_table(
                jumps.join(on, F.col("root") == F.col("via"), "left").select(
                    "word", F.coalesce("last", "root").alias("root")
                ),
                "spelling-roots",
            )
    jumps = jumps.withColumnRenamed("word", "word_")
    return found.join(jumps, F.col("word") == F.col("word_"), "left").select(
        *found.columns, F.coalesce("root", "word").alias("root")
    )


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    much_more: int = MUCH_MORE,
    damaged: int = DAMAGED,
    list_words: int = LIST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per frequent word: word, n, n_near, form, form_n, root."""
    if least_length < 4:
        raise ValueError("Two disjoint bigrams of any word take words of four letters or more.")
    counted = word_counts(docs, least_length, damaged, id_col, text_col)
    words = keep_table(counted.filter(F.col("n") >= least_count), "spelling-words")
    found = keep_table(forms(words, near_words(words, list_words), much_more), "spelling-forms")
    return roots(found, least_count, much_more)
