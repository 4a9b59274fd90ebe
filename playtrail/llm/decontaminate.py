"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` turns documents into shards: one row holds a slice of documents
with, for each term, the sorted positions at which it stands (its postings).
Words are numbered through a shard, so an offset-adjusted intersection of two
lists is one comparison of sorted numbers. ``phrase_matches`` starts each test
phrase from the list of its rarest term by corpus count, intersects list after
list in order of rarity, and keeps the starts that survive all of them.
``near_matches`` asks only that the rarest terms of an item stand close together.

Nothing is shuffled but term counts and, with very many test phrases, results:
each shard answers for its own documents. The test phrases are the stated query
set; they go to the shards in blocks of bounded size. The index is built once and
answers block after block; its shards and their rows are numbered, so answers to
several blocks meet row by row. An item of more words than a block is cut into
stretches that overlap by a window, so none of its windows is lost; what stands
near is then asked of each stretch.

Defined results: null and empty texts have no words and match nothing; repeated
rows each get a row; an item without words has no phrase; an item shorter than a
window is one phrase; equal item ids count once, and items without an id are
matched and count as one item with an empty id. Only the id and the text are
read, so other columns cannot clash.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.stages import keep_table
from playtrail.llm.textbytes import WORD, slices

WINDOW = 13
#: Test words that one pass over the index handles at once, in the mean.
BLOCK_WORDS = 500_000
#: Distinct test words up to which the index holds no other words; beyond, it holds all.
INDEXED_TERMS = 2_000_000
#: Words within which the rarest terms of an item must stand for a near match.
NEAR = 20
NEAR_TERMS = 3

_INDEX = (
    "shard long, n_words array<int>, ids array<long>, terms binary, lists binary, positions binary"
)
_FOUND = (
    "shard long, row int, id long, n_words long, "
    "spans array<struct<start:int,end:int>>, items array<string>, near array<string>"
)


def words_of(text: pa.Array) -> Iterator:
    """Lower-cased words of each slice of texts."""
    for part in slices(text):
        yield part, part.lower().words(WORD)


def build_index(
    docs: DataFrame, terms: np.ndarray | None = None, id_col="doc_id", text_col="text"
) -> DataFrame:
    """Shards of positional postings; with ``terms`` (sorted hashes) of those words only.

    Positions of a shard count its words through all its documents; ``n_words``
    tells where one document ends and the next begins. Shards are numbered, for good
    once the index is written.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = (TaskContext.get().partitionId() << 33) - 1
        for batch in batches:
            ids = batch.column(0)
            for part, words in words_of(batch.column(1)):
                shard += 1
                at = np.arange(len(words), dtype=np.int32)
                hashes = words.hashes
                if terms is not None:
                    slot = np.searchsorted(terms, hashes)
                    known = terms[np.minimum(slot, len(terms) - 1)] == hashes if len(terms) else []
                    known = np.flatnonzero(known)
                    hashes, at = hashes[known], at[known]
                order = np.argsort(hashes, kind="stable")
                hashes, at = hashes[order], at[order]
                firsts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
                firsts = firsts[: len(hashes)]
                rows = ids.slice(part.first_row, len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int64()),
                        pa.array([words.counts().astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([rows.to_pylist()], pa.list_(pa.int64())),
                        pa.array([hashes[firsts].tobytes()], pa.binary()),
                        pa.array([np.append(firsts, len(at)).astype(np.int32).tobytes()], pa.binary()),
                        pa.array([at.tobytes()], pa.binary()),
                    ],
                    names=["shard", "n_words", "ids", "terms", "lists", "positions"],
                )

    narrow = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return narrow.mapInArrow(index, _INDEX)


class Shard:
    """One row of the index, with its lists as arrays."""

    def __init__(self, row: dict):
        self.row = row
        self.n_words = np.asarray(row["n_words"], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n_words)])
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.lists = np.frombuffer(row["lists"], np.int32).astype(np.int64)
        self.positions = np.frombuffer(row["positions"], np.int32).astype(np.int64)
        size = np.diff(self.lists)
        self.span = int(self.first[-1]) + 1
        self.keys = np.repeat(np.arange(len(size)), size) * self.span + self.positions

    def lists_of(self, terms: np.ndarray) -> np.ndarray:
        """The number of each term's list, -1 for terms that do not occur here."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of some lists, and for each the place in ``lists`` it came from."""
        size = self.lists[lists + 1] - self.lists[lists]
        source = np.repeat(np.arange(len(lists)), size)
        inner = np.arange(len(source)) - np.repeat(np.cumsum(size) - size, size)
        return self.positions[self.lists[lists][source] + inner], source

    def holds(self, lists: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Whether each list has the position: one step of an intersection."""
        wanted = lists * self.span + positions
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return (self.keys[at] == wanted) & (positions >= 0) & (positions < self.span)

    def distance(self, lists: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Words between each position and the nearest posting of the list."""
        wanted = lists * self.span + positions
        at = np.searchsorted(self.keys, wanted)
        after, before = np.minimum(at, len(self.keys) - 1), np.maximum(at - 1, 0)
        return np.minimum(abs(self.keys[after] - wanted), abs(self.keys[before] - wanted))

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, side="right") - 1


class Phrases:
    """Distinct test windows as arrays, their terms in order of rarity.

    ``terms[i]`` and ``offsets[i]`` are padded with the rarest term; window i
    belongs to the items ``owners[owner_first[i]:owner_first[i + 1]]``.
    """

    def __init__(self, items: list[tuple[str, np.ndarray]], counts: dict[int, int], size: int):
        found: dict[bytes, tuple[np.ndarray, set[int]]] = {}
        self.items = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.items)}
        near: dict[int, list] = {i: [] for i in number.values()}
        for name, words in items:
            for at in range(max(1, len(words) - size + 1)):
                window = words[at : at + size]
                found.setdefault(window.tobytes(), (window, set()))[1].add(number[name])
            rare = sorted(set(words.tolist()), key=lambda w: (counts.get(w, 0), w))[:NEAR_TERMS]
            near[number[name]].append(rare)
        self.length = np.array([len(w) for w, _ in found.values()], np.int64)
        n = len(found)
        self.terms = np.zeros((n, size), np.uint64)
        self.offsets = np.zeros((n, size), np.int64)
        owners = []
        for i, (window, of) in enumerate(found.values()):
            order = sorted(range(len(window)), key=lambda k: counts.get(int(window[k]), 0))
            order += order[:1] * (size - len(order))
            self.terms[i], self.offsets[i] = window[order], order
            owners.append(sorted(of))
        self.owner_first = np.concatenate([[0], np.cumsum([len(x) for x in owners])]).astype(int)
        self.owners = np.array([x for of in owners for x in of], np.int64)
        sets = [(i, rare) for i, lists in near.items() for rare in lists]
        self.near_item = np.array([i for i, _ in sets], np.int64)
        self.near_terms = np.array(
            [(rare + rare[-1:] * NEAR_TERMS)[:NEAR_TERMS] for _, rare in sets], np.uint64
        ).reshape(-1, NEAR_TERMS)

    def owners_of(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.owner_first[windows + 1] - self.owner_first[windows]
        source = np.repeat(np.arange(len(windows)), size)
        inner = np.arange(len(source)) - np.repeat(np.cumsum(size) - size, size)
        return self.owners[self.owner_first[windows][source] + inner], source


def exact_starts(shard: Shard, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the windows that occur and the positions where they start."""
    lists = shard.lists_of(phrases.terms)
    able = np.flatnonzero((lists >= 0).all(axis=1))
    positions, source = shard.postings(lists[able, 0])
    window = able[source]
    start = positions - phrases.offsets[window, 0]
    for k in range(1, phrases.terms.shape[1]):
        if not len(window):
            break
        kept = shard.holds(lists[window, k], start + phrases.offsets[window, k])
        window, start = window[kept], start[kept]
    last = start + phrases.length[window] - 1
    kept = (start >= 0) & (shard.doc_of(np.maximum(start, 0)) == shard.doc_of(last))
    return window[kept], start[kept]


def near_starts(shard: Shard, phrases: Phrases, within: int) -> tuple[np.ndarray, np.ndarray]:
    """Items whose rarest terms stand within ``within`` words, and where."""
    lists = shard.lists_of(phrases.near_terms)
    able = np.flatnonzero((lists >= 0).all(axis=1))
    positions, source = shard.postings(lists[able, 0])
    item = able[source]
    for k in range(1, phrases.near_terms.shape[1]):
        if not len(item):
            break
        other = lists[item, k]
        kept = shard.distance(other, positions) <= within
        item, positions = item[kept], positions[kept]
    return phrases.near_item[item], positions


def _answer(shard: Shard, phrases: Phrases, near: int) -> dict:
    n = len(shard.n_words)
    window, start = exact_starts(shard, phrases)
    end = start + phrases.length[window]
    mark = np.zeros(shard.span + 1, np.int64)
    np.add.at(mark, start, 1)
    np.add.at(mark, end, -1)
    hit = np.cumsum(mark)[: shard.span] > 0
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    # a document's end parts spans that touch
    inner = shard.first[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < shard.span - 1)])
    cut = inner[hit[inner] & hit[inner - 1]]
    from_, to = np.sort(np.append(np.flatnonzero(edge == 1), cut)), np.sort(
        np.append(np.flatnonzero(edge == -1), cut)
    )
    spans: list[list] = [[] for _ in range(n)]
    for a, b, doc in zip(from_.tolist(), to.tolist(), shard.doc_of(from_).tolist()):
        first = int(shard.first[doc])
        spans[doc].append({"start": a - first, "end": b - first})
    items: list[list] = [[] for _ in range(n)]
    owner, source = phrases.owners_of(window)
    found = np.unique(np.stack([shard.doc_of(start[source]), owner]), axis=1)
    for doc, item in found.T.tolist():
        items[doc].append(phrases.items[item])
    close: list[list] = [[] for _ in range(n)]
    item, position = near_starts(shard, phrases, near)
    for doc, i in np.unique(np.stack([shard.doc_of(position), item]), axis=1).T.tolist():
        close[doc].append(phrases.items[i])
    return {"spans": spans, "items": items, "near": close}


def phrase_matches(index: DataFrame, phrases: Phrases, near: int = NEAR) -> DataFrame:
    """Per indexed document: hit spans of words, items found exactly, items found nearby."""
    spark = index.sparkSession
    sent = spark.sparkContext.broadcast(phrases)
    schema = pa.schema(
        [
            ("shard", pa.int64()), ("row", pa.int32()), ("id", pa.int64()), ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("items", pa.list_(pa.string())), ("near", pa.list_(pa.string())),
        ]
    )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                shard = Shard(row)
                found = _answer(shard, sent.value, near)
                n = len(shard.n_words)
                columns = [
                    [row["shard"]] * n, range(n), row["ids"], shard.n_words.tolist(),
                    found["spans"], found["items"], found["near"],
                ]
                arrays = [pa.array(x, f.type) for x, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return index.mapInArrow(match, _FOUND)


def term_counts(index: DataFrame) -> DataFrame:
    """Corpus count of every indexed term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                more = np.frombuffer(row["terms"], np.uint64)
                size = np.diff(np.frombuffer(row["lists"], np.int32))
                terms, back = np.unique(np.append(terms, more), return_inverse=True)
                counts = np.bincount(back, np.append(counts, size), len(terms)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms.view(np.int64)), pa.array(counts)], names=["term", "n"]
        )

    found = index.select("terms", "lists").mapInArrow(count, "term long, n long")
    return found.groupBy("term").agg(F.sum("n").alias("n"))


def _item_words(
    items: DataFrame, id_col: str, text_col: str, window: int, most: int
) -> DataFrame:
    """Word hashes of every item, in stretches of at most ``most`` words and a window."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for part, words in words_of(batch.column(1)):
                found = [
                    (names[part.first_row + k], words.hashes[at : min(at + most + window - 1, b)])
                    for k, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist()))
                    for at in range(a, max(a + 1, b - window + 1), most)
                    if b > a
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name for name, _ in found], pa.string()),
                        pa.array([w.tobytes() for _, w in found], pa.binary()),
                        pa.array([len(w) for _, w in found], pa.int64()),
                    ],
                    names=["item", "words", "n"],
                )

    named = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("string")
    )
    return named.mapInArrow(split, "item string, words binary, n long")


def _test_terms(tests: DataFrame, most: int) -> np.ndarray | None:
    """The distinct words of all items, sorted; none if they are more than ``most``."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = b"".join(batch.column(0).to_pylist())
            distinct = np.unique(np.frombuffer(data, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(distinct)], names=["term"])

    found = tests.select("words").mapInArrow(terms, "term long").distinct().limit(most + 1)
    found = found.toPandas()["term"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64)) if len(found) <= most else None


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    near: int = NEAR,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
    indexed_terms: int = INDEXED_TERMS,
) -> DataFrame:
    """Spans and items of every document: id, n_words, spans, items, near.

    The documents are read once. The number of passes over their index is the number
    of test words over ``block_words``.
    """
    spark = docs.sparkSession
    tests = _item_words(items, item_col, item_text_col, window, block_words)
    total = tests.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-int(total) // block_words))
    terms = _test_terms(tests, indexed_terms)
    index = keep_table(build_index(docs, terms, id_col, text_col), "postings")
    corpus = term_counts(index)
    if blocks > 1:
        corpus = keep_table(corpus, "term-counts")
    parts = []
    for k in range(blocks):
        block = tests
        if blocks > 1:
            block = tests.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == k)
        own = [(r.item, np.frombuffer(r.words, np.uint64)) for r in block.collect()]
        counts = {r.term & (1 << 64) - 1: r.n for r in _counts_of(corpus, own).collect()}
        parts.append(phrase_matches(index, Phrases(own, counts, window), near))
    if blocks == 1:
        return parts[0].select("id", "n_words", "spans", "items", "near")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    merged = every.groupBy("shard", "row", "id", "n_words").agg(
        *(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("spans", "items", "near"))
    )
    return merged.select("id", "n_words", _union_of("spans").alias("spans"), "items", "near")


def _counts_of(corpus: DataFrame, own: list[tuple[str, np.ndarray]]) -> DataFrame:
    """Corpus counts of a block's words, of which there are as many as a block has."""
    words = np.unique(np.concatenate([w for _, w in own] or [np.zeros(0, np.uint64)]))
    frame = pd.DataFrame({"term": words.view(np.int64)})
    wanted = corpus.sparkSession.createDataFrame(frame, "term long")
    return corpus.join(F.broadcast(wanted), "term", "left_semi")


def _union_of(spans: str):
    """Overlapping and touching spans joined, by one fold over the sorted list."""
    empty = F.expr("cast(array() as array<struct<start:int,end:int>>)")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        touches = (F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(
            touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, add)


def contaminated(spans: str = "spans", n_words: str = "n_words"):
    """The rule of the contract: some word is hit, and at least one in twenty."""
    hit = words_hit(spans)
    return (hit > 0) & (20 * hit >= F.col(n_words))


def words_hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
