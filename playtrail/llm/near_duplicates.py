"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles; the weight is the count
of the shingle times the sum of the idf of its words, ln(1 + N / df), with df over
all documents. Below ``RARE`` of all documents idf no longer rises, so the table of
words that need one has a bound that no corpus exceeds (words of a document over
``RARE``), and everything else has the same idf.

1. ``signatures`` draws ``BANDS * ROWS`` consistent samples of each set; two sets
   agree in a sample with the chance of their weighted Jaccard similarity.
2. Equal texts collapse. Documents that agree in all samples of a band share a
   bucket. Every member is compared with the bucket's smallest document.
3. ``similarities`` reads the two texts of a pair and returns the exact weighted
   Jaccard similarity; pairs of at least ``SIMILARITY`` are links.
4. Members that a bucket's smallest document does not lead to are compared with
   the rest of the bucket, in blocks of bounded size. Pairs in different components
   are verified unless they agree in fewer than ``SCREEN`` samples or a bound shows
   them to be below ``SIMILARITY``: both know weights, and the bound is never below
   the true similarity. It adds up, over 256 parts of the shingles, the smaller of
   the two weights there. First come the partners of the members with most of them,
   as copies of one text all resemble it but not each other, then what is still apart.

So a group of copies costs a few comparisons for each copy, not one for each pair,
and no bucket meets in one task. A pair of similarity 0.8 shares a bucket with a
chance of 0.994 and agrees in ``SCREEN`` samples but for one case in 10^5; the more
similar, the surer.

Defined results: words are runs of letters, digits and non-ASCII characters,
lower-cased in ASCII; a text of one to four words is one shingle; null texts and
texts without words are similar to nothing, not even to each other; repeated rows
are equal texts, and equal ids share a class. Only the id and the text are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.components import components
from playtrail.llm.stages import keep_table
from playtrail.llm.textbytes import WORD, Hasher, Texts, Words, mix, slices, windows

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 4
SCREEN = 20
#: Share of documents below which a word counts as rare.
RARE = 1 / 1000
#: Members of a bucket that one task compares with as many others.
BLOCK = 512
#: Rounds that verify the partners of well-connected members before all that is left.
HUB_ROUNDS = 2
BINS = 256
#: Bytes of a sketch: total and unit as float64, then a byte for each part.
SKETCH = np.dtype([("total", "<f8"), ("unit", "<f8"), ("parts", "u1", BINS)])
#: Pairs whose shingles a task holds at once.
PAIRS = 512

_GRID = 1 << 16


def _gamma_table() -> np.ndarray:
    """Quantiles of the sum of two unit exponentials, at the middles of equal steps.

    The distribution function is 1 - (1 + x) exp(-x), inverted by Newton's method.
    """
    u = (np.arange(_GRID) + 0.5) / _GRID
    x = np.where(u < 0.26, np.sqrt(2 * u), -np.log1p(-u) + 1)
    for _ in range(40):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - u) / (x * np.exp(-x)), 1e-9)
    return x


_GAMMA = _gamma_table().astype(np.float32)
_LOG_GAMMA = np.log(_GAMMA)
_UNIFORM = ((np.arange(_GRID) + 0.5) / _GRID).astype(np.float32)


class Weights:
    """idf of words: those of the table, and one value for all rarer ones."""

    def __init__(self, words: np.ndarray, df: np.ndarray, n: int):
        order = np.argsort(words)
        self.words = words[order]
        self.idf = np.log1p(n / np.maximum(df[order], 1)).astype(np.float32)
        self.rare = np.float32(np.log1p(1 / RARE))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashes), self.rare)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.idf[at], self.rare)


def document_words(part: Texts) -> Words:
    return part.lower().words(WORD)


def shingles(words: Words, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their weights: row, shingle, weight, sorted by both."""
    start, rows = windows(words.first, SHINGLE)
    short = np.flatnonzero((words.counts() > 0) & (words.counts() < SHINGLE))
    start = np.append(start, words.first[short])
    rows = np.append(rows, short)
    end = np.minimum(start + SHINGLE, words.first[rows + 1])
    idf = np.append(0, np.cumsum(weights.of(words.hashes), dtype=np.float64))
    value = idf[end] - idf[start]
    name = Hasher(words.hashes)(start, end)
    order = np.lexsort((name, rows))
    name, rows, value = name[order], rows[order], value[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(name)))
    # sums of floats differ in the last bits by position; rounding makes equal sets equal
    return rows[at], name[at], np.round(value[at], 3) * count


def sample(rows: np.ndarray, names: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """Consistent weighted samples: ``size`` numbers for each of n texts.

    For every sample, a shingle draws r and c from Gamma(2, 1) and b from [0, 1) by
    its hash; t = floor(ln w / r + b), ln y = r (t - b), and the shingle with the
    lowest ln c - ln y - r is drawn, together with its t.
    """
    out = np.zeros((n, size), np.int32)
    if not len(rows):
        return out
    start = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    length = np.diff(np.append(start, len(rows)))
    log_w = np.log(weight).astype(np.float32)
    salt = mix(np.arange(1, 2 * size + 1, dtype=np.uint64))
    for k in range(size):
        h = (names ^ salt[k]) * (salt[size + k] | np.uint64(1))
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        r = _GAMMA[h >> np.uint64(48)]
        b = _UNIFORM[(h >> np.uint64(32)) & np.uint64(0xFFFF)]
        log_c = _LOG_GAMMA[(h >> np.uint64(16)) & np.uint64(0xFFFF)]
        t = np.floor(log_w / r + b)
        cost = log_c - r * (t - b) - r
        least = np.minimum.reduceat(cost, start)
        drawn = np.flatnonzero(cost == np.repeat(least, length))
        row, first = np.unique(rows[drawn], return_index=True)
        one = drawn[first]
        value = mix(names[one] + t[one].astype(np.int64).astype(np.uint64))
        out[row, k] = (value >> np.uint64(33)).astype(np.int32)
    return out


def sketch(rows: np.ndarray, names: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Total weight of n texts, and in units, rounded up, that of each part of their shingles."""
    cell = rows * BINS + (names & np.uint64(BINS - 1)).astype(np.int64)
    parts = np.bincount(cell, weight, n * BINS).reshape(n, BINS).astype(np.float64)
    out = np.zeros(n, SKETCH)
    out["total"] = parts.sum(axis=1)
    out["unit"] = parts.max(axis=1, initial=0) / 255
    # what division leaves above a whole number by its own rounding is still rounded up, to 255 at most
    units = np.divide(parts, out["unit"][:, None], out=np.zeros_like(parts), where=parts > 0)
    out["parts"] = np.minimum(np.ceil(units), 255)
    return out


def most_similar(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Upper bound of the weighted Jaccard similarity of one sketch with many."""
    mine = (left["parts"] * left["unit"]).astype(np.float32)
    theirs = right["parts"] * right["unit"].astype(np.float32)[:, None]
    shared = np.minimum(mine, theirs).sum(axis=1, dtype=np.float64)
    whole = left["total"] + right["total"] - shared
    # single precision errs by less than a millionth
    return shared / np.maximum(whole, 1e-9) * (1 + 1e-5)


def word_weights(docs: DataFrame, text_col: str = "text") -> Weights:
    """Document frequencies over all documents, of the words that are not rare."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, df = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                found = document_words(part)
                order = np.lexsort((found.hashes, found.rows()))
                name, row = found.hashes[order], found.rows()[order]
                new = np.ones(len(name), bool)
                new[1:] = (name[1:] != name[:-1]) | (row[1:] != row[:-1])
                more, n = np.unique(name[new], return_counts=True)
                words, back = np.unique(np.append(words, more), return_inverse=True)
                df = np.bincount(back, np.append(df, n), len(words)).astype(np.int64)
                if len(words) > 500_000:
                    yield _counted(words, df)
                    words, df = words[:0], df[:0]
        yield _counted(words, df)

    n = docs.count()
    narrow = docs.select(F.col(text_col).cast("string"))
    counted = narrow.mapInArrow(count, "word long, df long").groupBy("word")
    kept = counted.agg(F.sum("df").alias("df")).filter(F.col("df") >= RARE * n).collect()
    words = np.array([r.word for r in kept], np.int64).view(np.uint64)
    return Weights(words, np.array([r.df for r in kept], np.int64), n)


def _counted(words: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(words.view(np.int64)), pa.array(df)], names=["word", "df"]
    )


def signatures(
    docs: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, digest of the text, samples (empty for texts without words) and sketch."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    size = BANDS * ROWS

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                words = document_words(part)
                rows, names, weight = shingles(words, sent.value)
                drawn = sample(rows, names, weight, len(part), size)
                bins = [x.tobytes() for x in sketch(rows, names, weight, len(part))]
                lists = [list(x) if n else [] for x, n in zip(drawn, words.counts())]
                own = [batch.column(k).slice(part.first_row, len(part)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(lists, pa.list_(pa.int32())), pa.array(bins, pa.binary())],
                    names=["id", "digest", "samples", "sketch"],
                )

    text = F.col(text_col).cast("string")
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.md5(text).alias("digest"), text)
    return narrow.mapInArrow(draw, "id long, digest string, samples array<int>, sketch binary")


def agreement(left: Column, right: Column) -> Column:
    """In how many samples two signatures agree."""
    same = F.zip_with(left, right, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x)


def bands(heads: DataFrame) -> DataFrame:
    """A row for each band of each signature: bucket, id, samples."""
    keys = F.array(
        *(F.xxhash64(F.lit(b), F.slice("samples", b * ROWS + 1, ROWS)) for b in range(BANDS))
    )
    return heads.select(F.explode(keys).alias("bucket"), "id", "samples")


def similarities(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """a, b and the exact weighted Jaccard similarity of their texts."""
    sent = pairs.sparkSession.sparkContext.broadcast(weights)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x.slice(k, PAIRS) for x in batches for k in range(0, x.num_rows, PAIRS)):
            a, b = batch.column(0), batch.column(1)
            # a document in many of these pairs is cut into shingles once
            ids = pa.concat_arrays([a, b]).to_numpy()
            distinct, at, back = np.unique(ids, return_index=True, return_inverse=True)
            column = pa.concat_arrays([batch.column(2), batch.column(3)]).take(pa.array(at))
            sets: list[tuple[np.ndarray, np.ndarray]] = []
            for part in slices(column):
                rows, names, weight = shingles(document_words(part), sent.value)
                cut = np.searchsorted(rows, np.arange(len(part) + 1))
                sets += [(names[x:y], weight[x:y]) for x, y in zip(cut[:-1], cut[1:])]
            n = batch.num_rows
            value = [_weighted_jaccard(sets[i], sets[j]) for i, j in zip(back[:n], back[n:])]
            yield pa.RecordBatch.from_arrays(
                [a, b, pa.array(value, pa.float64())], names=["a", "b", "similarity"]
            )

    own = texts.select("id", "text")
    joined = (
        pairs.join(own.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(own.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )
    return joined.mapInArrow(compare, "a long, b long, similarity double")


def _weighted_jaccard(left, right) -> float:
    names, i, j = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    shared = np.minimum(left[1][i], right[1][j]).sum()
    whole = left[1].sum() + right[1].sum() - shared
    return float(shared / whole) if whole else 0.0


def _star_pairs(banded: DataFrame) -> DataFrame:
    """Every member of a bucket with its smallest."""
    least = banded.groupBy("bucket").agg(
        F.min(F.struct("id", "samples")).alias("head"), F.count("*").alias("members")
    )
    least = least.filter("members > 1").select(
        "bucket", F.col("head.id").alias("a"), F.col("head.samples").alias("samples_a")
    )
    near = agreement(F.col("samples_a"), F.col("samples")) >= SCREEN
    pairs = banded.join(least, "bucket").filter((F.col("id") != F.col("a")) & near)
    return pairs.select("a", F.col("id").alias("b")).distinct()


def _with_component(banded: DataFrame, found: DataFrame) -> DataFrame:
    known = found.select(F.col("node").alias("id"), "component")
    return banded.join(known, "id", "left").withColumn(
        "component", F.coalesce("component", F.col("id"))
    )


def _left_pairs(shared: DataFrame, heads: DataFrame, found: DataFrame, all_left: bool) -> DataFrame:
    """a and b of members of a bucket in different components that may be similar.

    With ``all_left`` all of them; else those of hubs: in each block the member with
    most such partners, then of the members not among these the next, and so on.
    """
    rows = _with_component(shared, found)
    mixed = (
        rows.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
        .filter("low < high")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .select("bucket", "low", "blocks")
    )
    rows = rows.join(mixed, "bucket").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    rows = rows.join(heads.select("id", "samples", "sketch"), "id")
    # members outside the smallest component meet every block; all members are at home in one
    asks = rows.filter("component != low").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    asks = asks.select(
        "bucket", F.col("own").alias("x"), F.col("other").cast("long").alias("y"), "id", "component",
        "samples", "sketch", F.lit(True).alias("asks"),
    )
    outside = rows.filter("component != low").groupBy("bucket").agg(F.collect_set("own").alias("xs"))
    homes = rows.join(outside, "bucket").select(
        "bucket", F.explode("xs").alias("x"), F.col("own").alias("y"), "id", "component",
        "samples", "sketch", F.lit(False).alias("asks"),
    )

    def meet(table: pa.Table) -> pa.Table:
        ask = np.array(table.column("asks").to_pylist())
        ids, group = table.column("id").to_numpy(), table.column("component").to_numpy()
        bins = np.frombuffer(b"".join(table.column("sketch").to_pylist()), SKETCH)
        drawn = table.column("samples").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        left, right = np.flatnonzero(ask), np.flatnonzero(~ask)
        near = np.zeros((len(left), len(right)), bool)
        for k, i in enumerate(left):
            alike = (drawn[right] == drawn[i]).sum(axis=1)
            may = np.flatnonzero((group[right] != group[i]) & (alike >= SCREEN))
            near[k, may] = most_similar(bins[i], bins[right[may]]) >= SIMILARITY
        if all_left:
            i, j = np.nonzero(near)
        else:
            i, j = _hub_pairs(near, ids[left], ids[right])
        a, b = ids[left[i]], ids[right[j]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    both = asks.unionByName(homes)
    met = both.groupBy("bucket", "x", "y").applyInArrow(meet, "a long, b long")
    return met.distinct()


def _hub_pairs(near: np.ndarray, left_ids: np.ndarray, right_ids: np.ndarray):
    """Places (row, column) of the partners of hubs, which may stand on either side."""
    near = near.copy()
    rows, columns = [], []
    while near.any():
        by_row, by_column = near.sum(axis=1), near.sum(axis=0)
        if by_row.max() >= by_column.max():
            hub = int(by_row.argmax())
            partners = np.flatnonzero(near[hub])
            rows.append(np.full(len(partners), hub))
            columns.append(partners)
            done = np.append(right_ids[partners], left_ids[hub])
        else:
            hub = int(by_column.argmax())
            partners = np.flatnonzero(near[:, hub])
            rows.append(partners)
            columns.append(np.full(len(partners), hub))
            done = np.append(left_ids[partners], right_ids[hub])
        near[np.isin(left_ids, done)] = False
        near[:, np.isin(right_ids, done)] = False
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(columns)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and class_id (smallest id of its class) of every row of ``docs``."""
    weights = word_weights(docs, text_col)
    drawn = keep_table(signatures(docs, weights, id_col, text_col), "signatures")
    heads = (
        drawn.filter(F.size("samples") > 0)
        .groupBy("digest")
        .agg(
            F.min("id").alias("id"),
            F.min("samples").alias("samples"),
            F.min("sketch").alias("sketch"),
        )
    )
    heads = keep_table(heads, "heads")
    banded = bands(heads)
    crowded = banded.groupBy("bucket").count().filter("count > 1").select("bucket")
    shared = keep_table(banded.join(crowded, "bucket").select("bucket", "id"), "shared")
    involved = shared.select("id").distinct().join(heads.select("id", "digest"), "id")
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    texts = texts.withColumn("digest", F.md5("text")).join(involved, ["id", "digest"], "left_semi")
    texts = keep_table(texts.dropDuplicates(["id"]).select("id", "text"), "texts")
    tested = keep_table(_star_pairs(banded), "pairs")
    links = _links(tested, texts, weights)
    found = components(links)
    for attempt in range(HUB_ROUNDS + 1):
        left = _left_pairs(shared, heads, found, all_left=attempt == HUB_ROUNDS)
        fresh = keep_table(left.join(tested, ["a", "b"], "left_anti"), "fresh")
        if fresh.isEmpty():
            continue
        links = links.unionByName(_links(fresh, texts, weights))
        tested = tested.unionByName(fresh)
        found = components(links)
    named = heads.select("digest", F.col("id").alias("head"))
    named = named.join(found, named["head"] == found["node"], "left").select(
        "digest", F.coalesce("component", "head").alias("class_id")
    )
    return (
        drawn.withColumn("known", F.when(F.size("samples") > 0, F.col("digest")))
        .join(named.withColumnRenamed("digest", "known"), "known", "left")
        .select("id", F.coalesce("class_id", F.col("id")).alias("class_id"))
    )


def _links(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    verified = similarities(pairs, texts, weights).filter(F.col("similarity") >= SIMILARITY)
    return keep_table(verified.select("a", "b"), "verified")
