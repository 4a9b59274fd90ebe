"""Language-model scoring with a probabilistic suffix tree.

Symbols are bytes: a document is its lower-cased words, each followed by a blank,
then one end symbol. The tree holds contexts of up to ``DEPTH`` symbols.

1. ``gram_counts``: all training documents, all stretches of DEPTH + 1 symbols;
   shorter contexts follow by summing.
2. ``grow``: a context is a candidate if it makes up ``CONTEXT_SHARE`` of all
   positions. It is retained if its next-symbol distribution diverges from that of
   its parent (the context without its oldest symbol): count times Kullback-Leibler
   divergence of at least ``DIVERGENCE`` of all positions. Every distribution is
   smoothed towards its parent's, weight ``SMOOTHING``.
3. Retained contexts, closed under dropping the oldest or the newest symbol, are the
   states of an automaton: reading a symbol leads to the longest suffix that is a
   state. So scoring is one table lookup per symbol, for thousands of stretches of
   text side by side.

The shares do not depend on the size of the corpus, and they bound the tree: no
more than DEPTH / CONTEXT_SHARE contexts and DEPTH / GRAM_SHARE of their symbols
can reach them. Token counts have no such bound: the tokens above ``TOKEN_SHARE``
go to all tasks, all others meet their counts in a join.

Defined results: null is empty and has one token, the end; without training
documents every count is 0 and the symbols are equally likely; repeated rows each
get a row. Only the id and the text are read. Row numbers come from the scan, so
``docs`` must be a table that reads the same way twice.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.quality import fold
from playtrail.llm.stages import keep_table
from playtrail.llm.textbytes import UNBLANK, Texts, Words, grouped_sums, slices

DEPTH = 5
FOLDS, HELD_OUT = 7, 2
CONTEXT_SHARE = 1e-6
GRAM_SHARE = 5e-8
DIVERGENCE = 1e-7
SMOOTHING = 10.0
TOKEN_SHARE = 2.5e-7

_BLANK, _END = 32, 10
_LANE = 256
#: Stands for the end of a text among token hashes.
END_TOKEN = -1


def symbols(part: Texts, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, each after DEPTH end symbols, and where each text starts."""
    size = words.ends - words.starts + 1
    per_text = grouped_sums(size, words.first) + 1 + DEPTH
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    out = np.full(bounds[-1], _END, np.uint8)
    ahead = np.cumsum(size) - size
    rows = words.rows()
    # words of text r lie behind the symbols of earlier texts and the first DEPTH of its own
    to = ahead + rows * (1 + DEPTH) + DEPTH
    inner = np.arange(int(size.sum())) - np.repeat(ahead, size)
    place = np.repeat(to, size) + inner
    source = np.minimum(np.repeat(words.starts, size) + inner, len(part.data) - 1)
    last = inner == np.repeat(size - 1, size)
    out[place] = np.where(last, _BLANK, part.data[source])
    return out, bounds


def _predicted(bounds: np.ndarray) -> np.ndarray:
    """Which symbols belong to texts and are not the padding before them."""
    own = np.ones(bounds[-1], bool)
    for k in range(DEPTH):
        own[bounds[:-1] + k] = False
    return own


def _summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    found, back = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(back, np.concatenate(counts), len(found)).astype(np.int64)


def _counts(docs: DataFrame, of, name: str) -> DataFrame:
    """Sum over all training documents of what ``of`` counts in a slice of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for batch in batches:
            for part in slices(batch.column(0)):
                low = part.lower()
                k, n = np.unique(of(low, low.words(UNBLANK)), return_counts=True)
                keys.append(k)
                counts.append(n)
                size += len(k)
                if size > 1_000_000:
                    merged = _summed(keys, counts)
                    keys, counts, size = [merged[0]], [merged[1]], len(merged[0])
                if size > 800_000:
                    yield _out(keys, counts)
                    keys, counts, size = [], [], 0
        if keys:
            yield _out(keys, counts)

    def _out(keys, counts):
        k, n = _summed(keys, counts)
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], names=["key", "n"])

    found = docs.filter("not held_out").select("text").mapInArrow(count, "key long, n long")
    return keep_table(found.groupBy("key").agg(F.sum("n").alias("n")), name)


def _tokens(part: Texts, words: Words) -> np.ndarray:
    return np.append(words.hashes.view(np.int64), np.full(len(part), END_TOKEN))


def _grams(part: Texts, words: Words) -> np.ndarray:
    stream, bounds = symbols(part, words)
    key = np.zeros(len(stream), np.int64)
    for k in range(DEPTH + 1):
        key[k:] |= stream[: len(stream) - k].astype(np.int64) << (8 * k)
    return key[_predicted(bounds)]


class SuffixTree:
    """States by number: next state and log10 probability for each of some symbols."""

    def __init__(self, column: np.ndarray, step: np.ndarray, logp: np.ndarray):
        self.column, self.step, self.logp = column, step, logp

    def score(self, stream: np.ndarray) -> np.ndarray:
        """log10 probability of every symbol, given those before it."""
        lanes = -(-len(stream) // _LANE)
        read = np.full(DEPTH + lanes * _LANE, _END, np.uint8)
        read[DEPTH : DEPTH + len(stream)] = stream
        read = self.column[read]
        width = self.step.shape[1]
        step, logp = self.step.ravel(), self.logp.ravel()
        state = np.zeros(lanes, np.int64)
        out = np.zeros((lanes, _LANE))
        at = np.arange(lanes) * _LANE
        # a state depends on no more than DEPTH symbols, so each lane reads those first
        for k in range(-DEPTH, _LANE):
            cell = state * width + read[at + k + DEPTH]
            if k >= 0:
                out[:, k] = logp[cell]
            state = step[cell]
        return out.ravel()[: len(stream)]


def grow(levels: list[tuple[np.ndarray, np.ndarray]], contexts: list[dict[int, int]]) -> SuffixTree:
    """From counts to states.

    levels[d]: keys (context of d symbols, then the next one) and counts;
    contexts[d]: the count of each candidate context of d symbols.
    """
    total = sum(contexts[0].values())
    seen = np.unique(np.append(levels[0][0], [_BLANK, _END])).astype(np.int64)
    width = len(seen) + 1
    column = np.full(256, width - 1, np.int64)
    column[seen] = np.arange(len(seen))
    # one column stands for all 256 - len(seen) other bytes; each gets an equal part
    others = 256 - len(seen)
    flat = np.append(np.full(len(seen), 1 / 256), others / 256)

    counted = []
    for d, (keys, n) in enumerate(levels):
        place = {c: i for i, c in enumerate(sorted(contexts[d]))}
        table = np.zeros((len(place), width))
        row = np.array([place.get(k, -1) for k in (keys >> 8).tolist()], np.int64)
        own = row >= 0
        table[row[own], column[keys[own] & 255]] = n[own]
        counted.append((place, table))

    def distribution(d: int, context: int, above: np.ndarray) -> np.ndarray:
        place, table = counted[d]
        if context not in place:
            return above
        # what symbols too rare to be listed have counted goes by the parent's chances
        own, n = table[place[context]], contexts[d][context]
        return (own + (SMOOTHING + n - own.sum()) * above) / (n + SMOOTHING)

    chance = {(0, 0): distribution(0, 0, flat)}
    retained: set[tuple[int, int]] = {(0, 0)}
    for d in range(1, DEPTH + 1):
        mask = (1 << (8 * (d - 1))) - 1
        for context, n in sorted(contexts[d].items()):
            above = chance.get((d - 1, context & mask))
            if above is None:
                continue
            chance[d, context] = own = distribution(d, context, above)
            if n * float(own @ np.log(own / above)) >= DIVERGENCE * total:
                retained.add((d, context))
    states = {
        (d - old - new, (context >> (8 * new)) & ((1 << (8 * (d - old - new))) - 1))
        for d, context in retained
        for new in range(d + 1)
        for old in range(d - new + 1)
    }
    number = {state: i for i, state in enumerate(sorted(states))}  # by depth
    step = np.zeros((len(number), width), np.int32)
    table = np.zeros((len(number), width))
    table[0] = chance[0, 0]
    longer: list[list[tuple[int, int, int]]] = [[] for _ in range(DEPTH + 1)]
    for (d, context), i in number.items():
        if d:
            longer[d - 1].append((number[d - 1, context >> 8], int(column[context & 255]), i))
    for depth in range(DEPTH + 1):
        for (d, context), i in number.items():
            if d and d == depth:
                shorter = number[d - 1, context & ((1 << (8 * (d - 1))) - 1)]
                step[i] = step[shorter]
                table[i] = distribution(d, context, table[shorter])
        # where the context with one more symbol is a state, reading the symbol leads there
        for prefix, symbol, to in longer[depth]:
            step[prefix, symbol] = to
    table[:, -1] /= others
    return SuffixTree(column, step, np.log10(np.maximum(table, 1e-300)).astype(np.float32))


def train(docs: DataFrame) -> SuffixTree:
    """docs: text and held_out."""
    grams = _counts(docs, _grams, "grams")
    total = grams.agg(F.sum("n")).first()[0] or 0
    if not total:
        one = np.zeros(0, np.int64)
        return grow([(one, one)] * (DEPTH + 1), [{0: 0}] + [{}] * DEPTH)
    every = F.array(
        *(
            F.struct(F.lit(d).alias("d"), F.col("key").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1)).alias("gram"))
            for d in range(DEPTH + 1)
        )
    )
    levels = (
        grams.select("n", F.explode(every).alias("e"))
        .groupBy("e.d", "e.gram")
        .agg(F.sum("n").alias("n"))
    )
    levels = keep_table(levels, "levels")
    contexts = (
        levels.groupBy("d", F.shiftright("gram", 8).alias("context"))
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= CONTEXT_SHARE * total)
        .toArrow()
    )
    kept = levels.filter(F.col("n") >= GRAM_SHARE * total).toArrow()
    found: list[dict[int, int]] = [{} for _ in range(DEPTH + 1)]
    for d, context, n in zip(*(c.to_pylist() for c in contexts.columns)):
        found[d][context] = n
    depth, gram, n = (c.to_numpy() for c in kept.columns)
    return grow([(gram[depth == d], n[depth == d]) for d in range(DEPTH + 1)], found)


def scored(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    docs = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (fold(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    tree = spark.sparkContext.broadcast(train(docs))
    tokens = _counts(docs, _tokens, "tokens")
    n_all, distinct = tokens.agg(F.sum("n"), F.count("*")).first()
    n_all, distinct = n_all or 0, distinct or 0
    common = tokens.filter(F.col("n") >= TOKEN_SHARE * n_all).toArrow()
    order = np.argsort(common["key"].to_numpy())
    known = spark.sparkContext.broadcast(
        (common["key"].to_numpy()[order], common["n"].to_numpy()[order])
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts = known.value
        gain = np.log10(counts + 1.0)
        for batch in batches:
            for part in slices(batch.column(3)):
                low = part.lower()
                words = low.words(UNBLANK)
                stream, bounds = symbols(low, words)
                logp = tree.value.score(stream) * _predicted(bounds)
                token = words.hashes.view(np.int64)
                at = np.minimum(np.searchsorted(names, token), max(len(names) - 1, 0))
                common = names[at] == token if len(names) else np.zeros(len(token), bool)
                rare = np.flatnonzero(~common)
                cut = np.searchsorted(rare, words.first)
                value = np.where(common, gain[at], 0.0) if len(names) else np.zeros(len(token))
                own = [batch.column(k).slice(part.first_row, len(part)) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *own,
                        pa.array(words.counts().astype(np.int64) + 1),
                        pa.array(grouped_sums(common.astype(np.int64), words.first)),
                        pa.array(_row_sums(value, words.first)),
                        pa.array(_row_sums(logp, bounds)),
                        pa.LargeListArray.from_arrays(cut, pa.array(token[rare])).cast(
                            pa.list_(pa.int64())
                        ),
                    ],
                    names=["id", "held_out", "row", "n_tokens", "known", "gain", "score", "rare"],
                )

    schema = (
        "id long, held_out boolean, row long, n_tokens long, known long, gain double, "
        "score double, rare array<long>"
    )
    found = keep_table(docs.select("id", "held_out", "row", "text").mapInArrow(score, schema), "scored")
    end = tokens.filter(F.col("key") == END_TOKEN).agg(F.sum("n")).first()[0] or 0
    rare = found.select("row", F.explode("rare").alias("key"))
    met = (
        rare.join(tokens, "key")
        .groupBy("row")
        .agg(F.count("*").alias("rare_known"), F.sum(F.log10(F.col("n") + 1)).alias("rare_gain"))
    )
    base = (
        F.col("gain")
        + F.coalesce("rare_gain", F.lit(0.0))
        + F.lit(float(np.log10(end + 1)))
        - F.col("n_tokens") * F.lit(float(np.log10(n_all + distinct + 1)))
    )
    return found.join(met, "row", "left").select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(end > 0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )


def _row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Like grouped_sums, but each row is added up by itself, without others' rounding."""
    out = np.zeros(len(first) - 1)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(values, first[:-1][full])
    return out
