"""Quality classifier: a generalised additive model with pairwise interactions.

Every document becomes a fixed row of shape measures (``MEASURES``). The model adds
one lookup table per measure and one per chosen pair of measures; each table is
the sum of shallow trees that boosting fits in turn, measure after measure, to
what all others leave over. Scoring looks up one bin per table and adds.

The model is fitted on at most ``sample_rows`` labelled documents, those whose ids
hash lowest, so the choice does not depend on partitioning; everything else runs
in the tasks that read the documents, and nothing is shuffled for scoring.

Defined results: null and empty texts have all measures 0 and are scored like any
other; repeated rows each get a row; several labels of one document count as
their rounded mean; without labels of both kinds every score is the share of
label 1 (0.5 without any label). Only the id and the text are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from playtrail.llm.textbytes import UNBLANK, Texts, grouped_sums, slices

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5

MEASURES = (
    "log_bytes", "capitals", "digits", "signs", "symbols", "shouts", "bars", "line_ends",
    "beyond_ascii", "word_length", "word_length_spread", "distinct_words", "repeats_previous",
    "short_words", "capital_words", "ended_words", "words_per_line", "top_word",
)


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(256, np.float64)
    out[list(chars.encode())] = 1
    return out


_CAPITAL = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _CAPITAL + _mask("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _mask("0123456789")
_SYMBOL = _mask("#$%&*+=<>{}[]@~^\\/_")
_END = _mask(".!?")
_SIGN = _mask(",;:-()\"'") + _SYMBOL + _END + _mask("|")
_BEYOND = (np.arange(256) >= 128).astype(np.float64)


def measures(part: Texts) -> np.ndarray:
    """One row of ``MEASURES`` per text."""
    data, bounds = part.data, part.bounds
    size = np.maximum(np.diff(bounds), 1)

    def share(mask: np.ndarray, of: np.ndarray = size) -> np.ndarray:
        return grouped_sums(mask[data], bounds) / of

    letters = np.maximum(grouped_sums(_LETTER[data], bounds), 1)
    words = part.lower().words(UNBLANK)
    first, rows = words.first, words.rows()
    n = np.maximum(words.counts(), 1)
    length = (words.ends - words.starts).astype(np.float64)
    mean = grouped_sums(length, first) / n
    spread = np.sqrt(np.maximum(grouped_sums(length**2, first) / n - mean**2, 0))
    order = np.lexsort((words.hashes, rows))
    ranked, where = words.hashes[order], rows[order]
    new = np.ones(len(order), bool)
    new[1:] = (ranked[1:] != ranked[:-1]) | (where[1:] != where[:-1])
    starts = np.flatnonzero(new)
    top = np.zeros(len(part))
    np.maximum.at(top, where[starts], np.diff(np.append(starts, len(order))))
    again = np.zeros(len(words))
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (rows[1:] == rows[:-1])
    last = data[words.ends - 1] if len(words) else data[:0]
    lines = grouped_sums((data == 10).astype(np.float64), bounds)
    return np.stack(
        [
            np.log1p(np.diff(bounds)),
            share(_CAPITAL, letters),
            share(_DIGIT),
            share(_SIGN),
            share(_SYMBOL),
            share(_mask("!")),
            share(_mask("|")),
            lines / size,
            share(_BEYOND),
            mean,
            spread,
            np.bincount(where[starts], minlength=len(part)) / n,
            grouped_sums(again, first) / n,
            grouped_sums((length <= 3).astype(np.float64), first) / n,
            grouped_sums(_CAPITAL[data[words.starts]] if len(words) else again, first) / n,
            grouped_sums(_END[last], first) / n,
            words.counts() / (lines + 1),
            top / n,
        ],
        axis=1,
    )


def _best_split(gradient, hessian, shrink):
    """Gain and place of the best cut of a histogram; 0 and 0 if none gains."""
    g, h = np.cumsum(gradient), np.cumsum(hessian)
    left = g[:-1] ** 2 / (h[:-1] + shrink)
    right = (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + shrink)
    gain = left + right - g[-1] ** 2 / (h[-1] + shrink)
    if not len(gain) or gain.max() <= 1e-12:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def shallow_tree(gradient, hessian, depth=2, shrink=5.0):
    """The leaf value of each bin, from cuts that lower the loss most."""
    cut = _best_split(gradient, hessian, shrink)[1] if depth else 0
    if not cut:
        return np.full(len(gradient), gradient.sum() / (hessian.sum() + shrink))
    halves = (slice(None, cut), slice(cut, None))
    return np.concatenate([shallow_tree(gradient[s], hessian[s], depth - 1, shrink) for s in halves])


def _quadrants(gradient, hessian, shrink=5.0):
    """Gain and leaf values of the best cut on one axis followed by one on the other."""
    best = (0.0, np.zeros_like(gradient))
    for flip in (False, True):
        g, h = (gradient.T, hessian.T) if flip else (gradient, hessian)
        gain, cut = _best_split(g.sum(1), h.sum(1), shrink)
        cuts = [cut] if cut else range(1, len(g), max(1, len(g) // 4))
        for at in cuts:
            out, total = np.zeros_like(g), 0.0
            for rows in (slice(None, at), slice(at, None)):
                gs, hs = g[rows].sum(0), h[rows].sum(0)
                out[rows] = shallow_tree(gs, hs, 1, shrink)
                total += _best_split(gs, hs, shrink)[0]
            if total + gain > best[0]:
                best = (total + gain, out.T if flip else out)
    return best


class AdditiveModel:
    """Lookup tables over binned measures, their pairs, and an intercept."""

    def __init__(self, edges, intercept=0.0):
        self.edges, self.intercept = edges, intercept
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def bins(self, x: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)]
        return np.stack(columns, axis=1)

    def raw(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.intercept)
        for k, table in enumerate(self.tables):
            out += table[bins[:, k]]
        for a, b, table in self.pairs:
            out += table[bins[:, a], bins[:, b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(self.bins(x))))


def fit(
    x: np.ndarray, y: np.ndarray, rounds=150, pair_rounds=60, n_pairs=6, rate=0.1, n_bins=32
) -> AdditiveModel:
    """Boost measure after measure, then the pairs that gain most on what is left."""
    quantiles = np.linspace(0, 1, n_bins + 1)[1:-1]
    model = AdditiveModel([np.unique(np.quantile(c, quantiles)) for c in x.T] if len(x) else [])
    share = y.mean() if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        model.edges = [np.zeros(0)] * len(MEASURES)
        model.tables = [np.zeros(1)] * len(MEASURES)
        share = min(max(share, 1e-6), 1 - 1e-6)
        model.intercept = float(np.log(share / (1 - share)))
        return model
    model.intercept = float(np.log(share / (1 - share)))
    bins = model.bins(x)
    raw = model.raw(bins)

    def pull():
        p = 1 / (1 + np.exp(-raw))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            g, h = pull()
            size = len(table)
            step = rate * shallow_tree(
                np.bincount(bins[:, k], g, size), np.bincount(bins[:, k], h, size)
            )
            table += step
            raw += step[bins[:, k]]

    def grid(a, b, values):
        shape = len(model.tables[a]), len(model.tables[b])
        return np.bincount(bins[:, a] * shape[1] + bins[:, b], values, shape[0] * shape[1]).reshape(shape)

    g, h = pull()
    every = [(a, b) for a in range(x.shape[1]) for b in range(a)]
    gains = {p: _quadrants(grid(*p, g), grid(*p, h))[0] for p in every}
    chosen = sorted(every, key=lambda p: (-gains[p], p))[:n_pairs]
    model.pairs = [(a, b, np.zeros((len(model.tables[a]), len(model.tables[b])))) for a, b in chosen]
    for _ in range(pair_rounds):
        for a, b, table in model.pairs:
            g, h = pull()
            step = rate * _quadrants(grid(a, b, g), grid(a, b, h))[1]
            table += step
            raw += step[bins[:, a], bins[:, b]]
    return model


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    text = F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(text), F.lit(folds))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int, id_col: str, text_col: str
) -> DataFrame:
    """Texts and labels (id, text, label) of at most ``rows`` labelled documents outside fold 0."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("id").isNotNull())
        .filter(fold(F.col("id"), folds) != 0)
        .groupBy("id")
        .agg(F.round(F.avg("label")).alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(known), "id").select("id", "text", "label")


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    folds: int = FOLDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> AdditiveModel:
    """Fit on labelled rows outside fold 0; what reaches the driver is a row of numbers each."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measures(part) for part in slices(batch.column(1))]
            if found:
                x = np.concatenate(found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(list(x))], names=["id", "label", "x"]
                )

    sample = labelled_sample(docs, labels, label, sample_rows, folds, id_col, text_col)
    rows = sample.mapInArrow(measure, "id long, label double, x array<double>").collect()
    rows.sort(key=lambda r: (r.id, r.x))
    x = np.array([r.x for r in rows]).reshape(-1, len(MEASURES))
    return fit(x, np.array([r.label for r in rows]))


def scored(
    docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                rows = batch.column(0).slice(part.first_row, len(part))
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(sent.value.score(measures(part)))], names=["doc_id", "score"]
                )

    narrow = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return narrow.mapInArrow(score, "doc_id long, score double")


def with_score(docs: DataFrame, model: AdditiveModel, name: str, text_col="text") -> DataFrame:
    """All columns of ``docs`` and the score as one more, without a join."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.score(measures(part)) for part in slices(batch.column(at))]
            if found:
                column = pa.array(np.concatenate(found))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, column], names=[*batch.schema.names, name]
                )

    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(score, schema)
