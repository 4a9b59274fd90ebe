"""Toxicity: cumulative-link ordinal regression over sparse words.

P(grade <= k) = sigmoid(t_k - w.x) with thresholds t_0 < t_1 < ... and one weight
vector w for all of them; the output is the expected grade, the most likely grade
and the chance of any toxicity. x holds log(1 + count) of the ``n_words`` words
whose presence depends most on the label (chi square). Near copies, recognised by
their lowest shingle hash, share the weight of one document.

Labels only say toxic or not, so training grades are derived from them: 0 for
documents labelled clean; for toxic ones 1, 2 or 3 by terciles of the summed
log(1 + count) of cues, words far more frequent in toxic than in clean documents.

Words are counted and chosen on Spark, over at most ``stats_rows`` labelled documents;
the weights are fitted on the driver to at most ``sample_rows`` of them, of which it
gets the chosen words only. Both are documents whose ids hash lowest. Scoring all
documents needs no shuffle.

Defined results: null and empty texts hold no words and get the model's base
grade; repeated rows each get a row; without toxic or without clean labels every
expected severity is 0. Only the id and the text are read.
"""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.quality import labelled_sample
from playtrail.llm.stages import keep_table
from playtrail.llm.textbytes import WORD, Hasher, slices, windows

#: Labelled documents that words are chosen from, and that weights are fitted to.
STATS_ROWS = 200_000
SAMPLE_ROWS = 20_000
N_WORDS = 1_000
#: A word of fewer documents (near copies count as one) says nothing.
LEAST_DOCS = 3
#: How many times as likely in toxic as in clean documents a cue is.
CUE_ODDS = 8
#: A document counts as toxic from this chance of a grade above 0.
THRESHOLD = 0.2
GRADES = 4
SHINGLE = 5
FOLDS = 5


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class OrdinalModel:
    """Sorted word hashes, one weight each, and increasing thresholds."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.words, self.weights, self.thresholds = words, weights, thresholds

    def chances(self, z: np.ndarray) -> np.ndarray:
        """P(grade = k) for each row of the linear score z."""
        below = _sigmoid(self.thresholds[None, :] - z[:, None])
        edges = np.concatenate([np.zeros((len(z), 1)), below, np.ones((len(z), 1))], axis=1)
        return np.maximum(np.diff(edges, axis=1), 0)

    def linear(self, hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """w.x of each of n texts, from the words of all."""
        if not len(self.words) or not len(hashes):
            return np.zeros(n)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = np.flatnonzero(self.words[at] == hashes)
        cell, count = np.unique(rows[known] * len(self.words) + at[known], return_counts=True)
        row, word = np.divmod(cell, len(self.words))
        return np.bincount(row, self.weights[word] * np.log1p(count), n)


def fit_ordinal(x, grade, weight, grades=GRADES, rounds=30, ridge=1.0):
    """Weights and thresholds that maximise the weighted likelihood, with a ridge penalty.

    Newton's method on both together, halving a step that does not gain. A grade's
    chance is su - sl, the chances of a grade up to this one and up to the one
    below; u and l are their linear scores, threshold minus w.x.
    """
    d, n_cuts = x.shape[1], grades - 1
    share = np.cumsum(np.bincount(grade, weight, grades))[:-1] / weight.sum()
    share = np.clip(share, 1e-4, 1 - 1e-4)
    point = np.append(np.zeros(d), np.log(share / (1 - share)) + np.arange(n_cuts) * 1e-3)
    upper = np.eye(grades)[grade][:, :-1]
    lower = np.eye(grades)[grade][:, 1:]

    def chances(at):
        z = (x @ at[:d].astype(np.float32)).astype(np.float64)
        su = _sigmoid(np.append(at[d:], np.inf)[grade] - z)
        sl = _sigmoid(np.append(-np.inf, at[d:])[grade] - z)
        return su, sl

    def value(at):
        if (np.diff(at[d:]) <= 0).any():
            return -np.inf
        su, sl = chances(at)
        return weight @ np.log(np.maximum(su - sl, 1e-12)) - ridge / 2 * at[:d] @ at[:d]

    best = value(point)
    for _ in range(rounds):
        su, sl = chances(point)
        p = np.maximum(su - sl, 1e-12)
        a, b = su * (1 - su), sl * (1 - sl)
        by_u, by_l = weight * a / p, -weight * b / p
        uu = weight * (a * (1 - 2 * su) * p - a * a) / p**2
        ll = weight * (-b * (1 - 2 * sl) * p - b * b) / p**2
        ul = weight * a * b / p**2
        push = np.append(
            -(x.T @ (by_u + by_l).astype(np.float32)) - ridge * point[:d],
            upper.T @ by_u + lower.T @ by_l,
        )
        bend = np.zeros((d + n_cuts, d + n_cuts))
        bend[:d, :d] = (x * (uu + 2 * ul + ll).astype(np.float32)[:, None]).T @ x - ridge * np.eye(d)
        mixed = upper * (uu + ul)[:, None] + lower * (ul + ll)[:, None]
        bend[:d, d:] = -(x.T @ mixed.astype(np.float32))
        bend[d:, :d] = bend[:d, d:].T
        cross = (upper * ul[:, None]).T @ lower
        bend[d:, d:] = (upper * uu[:, None]).T @ upper + (lower * ll[:, None]).T @ lower + cross + cross.T
        step = np.linalg.solve(bend - 1e-9 * np.eye(len(bend)), -push)
        for _ in range(8):
            if (now := value(point + step)) > best:
                break
            step = step / 2
        else:
            break
        point, gained, best = point + step, now - best, now
        if gained < 1e-6 * abs(best):
            break
    return point[:d], point[d:]


def derive_grades(toxic, cues, grades=GRADES) -> np.ndarray:
    """0 for clean; equal parts of the toxic, by amount of cue words, for the rest."""
    cuts = np.quantile(cues[toxic], np.linspace(0, 1, grades)[1:-1]) if toxic.any() else []
    return np.where(toxic, 1 + np.searchsorted(cuts, cues, side="left"), 0)


def _labelled_words(labelled: DataFrame) -> DataFrame:
    """Per document: label, distinct word hashes with their counts, and family of near copies."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts, families = [], [], []
            for part in slices(batch.column(1)):
                found = part.lower().words(WORD)
                start, row = windows(found.first, SHINGLE)
                low = np.full(len(part), (1 << 64) - 1, np.uint64)
                np.minimum.at(low, row, Hasher(found.hashes)(start, start + SHINGLE))
                for k, (a, b) in enumerate(zip(found.first[:-1], found.first[1:])):
                    own, n = np.unique(found.hashes[a:b], return_counts=True)
                    hashes.append(own.tobytes())
                    counts.append(n.astype(np.int32).tobytes())
                    short = b - a < SHINGLE
                    told = blake2b(hashes[-1], digest_size=16).hexdigest() if short else low[k]
                    families.append(f"words {told}" if short else str(told))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(hashes, pa.binary()),
                 pa.array(counts, pa.binary()), pa.array(families, pa.string())],
                names=["id", "label", "words", "counts", "family"],
            )

    schema = "id long, label double, words binary, counts binary, family string"
    found = keep_table(labelled.mapInArrow(words, schema), "labelled-words")
    # no more families than labelled documents, whose number is bounded
    members = found.groupBy("family").agg((1 / F.count("*")).alias("weight"))
    return found.join(F.broadcast(members), "family").drop("family")


def word_stats(weighted: DataFrame) -> DataFrame:
    """Per word: documents, and toxic ones, that hold it (word, df, in_toxic), by weight."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [np.frombuffer(w, np.int64) for w in batch.column(1).to_pylist()]
            if not words:
                continue
            doc = np.repeat(np.arange(len(words)), list(map(len, words)))
            weight = batch.column(2).to_numpy()
            toxic = weight * (batch.column(0).to_numpy() > 0)
            names, back = np.unique(np.concatenate(words), return_inverse=True)
            sums = [np.bincount(back, x[doc], len(names)) for x in (weight, toxic)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), *map(pa.array, sums)], names=["word", "df", "in_toxic"]
            )

    found = weighted.select("label", "words", "weight")
    found = found.mapInArrow(count, "word long, df double, in_toxic double")
    return found.groupBy("word").agg(F.sum("df").alias("df"), F.sum("in_toxic").alias("in_toxic"))


def choose_words(stats: DataFrame, size: float, n_toxic: float, n_words: int):
    """Hashes, in order, of the words that tell most by chi square, and which are cues."""
    share = n_toxic / size
    expected = F.col("df") * share
    chi = (F.col("in_toxic") - expected) ** 2 / (
        expected * (1 - share) * (1 - F.col("df") / (size + 1)) + 1e-9
    )
    clean = (F.col("df") - F.col("in_toxic") + 0.5) / (size - n_toxic + 1)
    odds = (F.col("in_toxic") + 0.5) / (n_toxic + 1) / clean
    told = stats.filter(F.col("df") >= LEAST_DOCS - 1e-6)
    rows = told.select("word", chi.alias("chi"), odds.alias("odds"))
    rows = rows.orderBy(F.desc(F.round("chi", 9)), "word").limit(n_words).collect()
    words = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], np.array([r["odds"] > CUE_ODDS for r in rows], bool)[order]


def fit(rows: list, words: np.ndarray, cues: np.ndarray) -> OrdinalModel:
    """Fit on documents given as label, weight, and places and counts of their chosen words."""
    toxic = np.array([r["label"] > 0 for r in rows], bool)
    if not toxic.any() or toxic.all():
        return OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES - 1, 40.0))
    weight = np.array([r["weight"] for r in rows])
    places = [np.frombuffer(r["places"], np.int32) for r in rows]
    doc, place = np.repeat(np.arange(len(rows)), list(map(len, places))), np.concatenate(places)
    value = np.log1p(np.concatenate([np.frombuffer(r["counts"], np.int32) for r in rows]))
    x = np.zeros((len(rows), len(words)), np.float32)
    x[doc, place] = value
    amount = np.bincount(doc, cues[place] * value, len(rows))
    weights, thresholds = fit_ordinal(x, derive_grades(toxic, amount), weight)
    return OrdinalModel(words, weights, thresholds)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    stats_rows: int = STATS_ROWS,
    n_words: int = N_WORDS,
    folds: int = FOLDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> OrdinalModel:
    """Fit on labelled rows outside fold 0."""
    labelled = labelled_sample(docs, labels, label, stats_rows, folds, id_col, text_col)
    weighted = _labelled_words(labelled)
    toxic = F.when(F.col("label") > 0, F.col("weight")).otherwise(0.0)
    size, n_toxic = weighted.agg(F.sum("weight"), F.sum(toxic)).first()
    if not size or not n_toxic or n_toxic > size - 1e-9:
        return fit([], np.zeros(0, np.uint64), np.zeros(0, bool))
    words, cues = choose_words(word_stats(weighted), size, n_toxic, n_words)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, counts = [], []
            for own, n in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                own, n = np.frombuffer(own, np.uint64), np.frombuffer(n, np.int32)
                at = np.minimum(np.searchsorted(words, own), max(len(words) - 1, 0))
                kept = np.flatnonzero(words[at] == own) if len(words) else at[:0]
                places.append(at[kept].astype(np.int32).tobytes())
                counts.append(n[kept].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(places, pa.binary()), pa.array(counts, pa.binary())],
                names=["id", "label", "weight", "places", "counts"],
            )

    lowest = weighted.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    chosen = weighted.join(F.broadcast(lowest), "id", "left_semi")
    schema = "id long, label double, weight double, places binary, counts binary"
    chosen = chosen.select("id", "label", "weight", "words", "counts").mapInArrow(narrow, schema)
    rows = sorted(chosen.collect(), key=lambda r: (r["id"], bytes(r["places"]), bytes(r["counts"])))
    return fit(rows, words, cues)


def graded(
    docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, severity (expected grade), grade (most likely), toxic_chance (grade above 0)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for part in slices(batch.column(1)):
                words = part.lower().words(WORD)
                p = own.chances(own.linear(words.hashes, words.rows(), len(part)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first_row, len(part)),
                        pa.array(p @ np.arange(p.shape[1])),
                        pa.array(p.argmax(axis=1).astype(np.int32)),
                        pa.array(1 - p[:, 0]),
                    ],
                    names=["doc_id", "severity", "grade", "toxic_chance"],
                )

    narrow = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return narrow.mapInArrow(grade, "doc_id long, severity double, grade int, toxic_chance double")
