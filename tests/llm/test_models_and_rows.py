"""Classifiers, vectors, chat formatting, components and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from odd import DOCS, odd_rows, prose
from pyspark.sql import functions as F

from test_text_operators import LOWER

import corpus_pipeline
from playtrail.llm import chat, packing, quality, registry, toxicity, vectors
from playtrail.llm.components import components
from playtrail.llm.textbytes import WORD, Texts

LABELS = "doc_id long, quality int, toxic int"
DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def labelled(spark):
    pick = random.Random(3)
    docs, labels = [], []
    for i in range(400):
        text, good, toxic = prose(i, pick.randrange(20, 120)), i % 5 != 0, i % 4 == 0
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if toxic:
            words = text.split()
            for _ in range(pick.randrange(1, 9)):
                words.insert(pick.randrange(len(words)), pick.choice(["vile", "nasty", "awful"]))
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_quality_is_learned_and_holds_on_held_out_rows(labelled):
    docs, labels = labelled
    scores = quality.scored(docs, quality.train(docs, labels)).join(labels, "doc_id")
    held = scores.filter(quality.fold(F.col("doc_id"), quality.FOLDS) == 0).collect()
    assert len(held) > 40
    assert np.mean([(r.score >= 0.3) == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in held)


def test_toxic_words_are_learned_and_severity_rises_with_them(spark, labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    found = toxicity.graded(docs, model).join(labels, "doc_id").collect()
    right = [(r.toxic_chance >= toxicity.THRESHOLD) == r.toxic for r in found]
    assert np.mean(right) > 0.97
    texts = [(n, prose(900, 30) + " vile nasty awful" * n) for n in range(5)]
    rising = toxicity.graded(spark.createDataFrame(texts, DOCS), model).orderBy("doc_id").collect()
    severity = [r.severity for r in rising]
    assert severity == sorted(severity) and severity[-1] > severity[0] + 1
    assert (np.diff(model.thresholds) > 0).all()


def plain_likelihood(x, grade, weight, weights, thresholds, ridge=1.0):
    """The penalised likelihood of the cumulative-link model, row by row."""
    total = 0.0
    for row, g, w in zip(x, grade, weight):
        z = float(row @ weights)
        below = [0.0, *(1 / (1 + np.exp(-(t - z))) for t in thresholds), 1.0]
        total += w * np.log(below[g + 1] - below[g])
    return total - ridge / 2 * float(weights @ weights)


def test_ordinal_fit_is_where_the_likelihood_is_greatest():
    draw = np.random.RandomState(4)
    x = (draw.rand(300, 5) < 0.4) * np.log1p(draw.randint(1, 4, (300, 5)))
    grade = np.digitize(x @ [2.0, -1.0, 0.5, 0, 1.0] + draw.randn(300) * 0.7, [0.5, 1.5, 2.5])
    weight = draw.choice([0.5, 1.0], 300)
    weights, thresholds = toxicity.fit_ordinal(x.astype(np.float32), grade, weight)
    best = plain_likelihood(x, grade, weight, weights, thresholds)
    for _ in range(200):
        step = draw.randn(8) * draw.choice([1e-3, 1e-2, 0.1])
        other = plain_likelihood(x, grade, weight, weights + step[:5], thresholds + step[5:])
        assert np.isnan(other) or other <= best + 1e-4


def test_chosen_words_are_those_of_greatest_chi_square(labelled):
    docs, labels = labelled
    rows = docs.join(labels, "doc_id").collect()
    kept = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % toxicity.FOLDS]
    held = [(set(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r.text.encode().translate(LOWER))), r.toxic) for r in kept]
    n, toxic = len(held), sum(t for _, t in held)
    score = {}
    for word in set().union(*(w for w, _ in held)):
        df, both = sum(word in w for w, _ in held), sum(word in w and t for w, t in held)
        expected = df * toxic / n
        if df >= 3:
            score[word] = (both - expected) ** 2 / (expected * (1 - toxic / n) * (1 - df / (n + 1)) + 1e-9)
    known = toxicity._labelled_words(docs.join(labels, "doc_id").filter(
        quality.fold(F.col("doc_id"), toxicity.FOLDS) != 0
    ).selectExpr("doc_id", "text", "cast(toxic as double) label"))
    words, cues = toxicity.choose_words(toxicity.word_stats(known), n, toxic, 12)
    every = sorted(score)
    data = b" ".join(every)
    part = Texts(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    by_hash = dict(zip(part.words(WORD).hashes.tolist(), every))
    # words may tie with the last one chosen
    chosen = sorted((score[by_hash[h]] for h in words.tolist()), reverse=True)
    assert np.allclose(chosen, sorted(score.values(), reverse=True)[:12], rtol=1e-6)
    assert {by_hash[h] for h, cue in zip(words.tolist(), cues) if cue} >= {b"vile", b"nasty", b"awful"}


def test_classifiers_take_odd_rows_and_empty_tables(spark, labelled, odd_docs, no_docs):
    docs, labels = labelled
    no_labels = spark.createDataFrame([], LABELS)
    odd_labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (6, 1, 0), (6, 0, 1)], LABELS)
    additive, ordinal = quality.train(docs, labels), toxicity.train(docs, labels)
    for model in (additive, quality.train(odd_docs, odd_labels), quality.train(no_docs, no_labels)):
        rows = quality.scored(odd_docs, model).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(d) for d, _ in odd_rows())
        assert all(0 <= r.score <= 1 for r in rows)
    assert quality.with_score(odd_docs, additive, "q").columns == [*odd_docs.columns, "q"]
    for model in (ordinal, toxicity.train(odd_docs, odd_labels), toxicity.train(no_docs, no_labels)):
        assert toxicity.graded(odd_docs, model).count() == len(odd_rows())
        assert toxicity.graded(no_docs, model).count() == 0


def test_tables_of_the_additive_model_add_up():
    x = np.random.RandomState(0).rand(600, len(quality.MEASURES))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (1, 0) in [(a, b) for a, b, _ in model.pairs]
    assert np.mean((model.score(x) > 0.5) == y) > 0.95


# vectors


def brute_links(rows):
    ids = sorted({i for i, *_ in rows})
    one = {}
    for i, x, label in rows:
        if label is not None and x and all(v is not None and np.isfinite(v) for v in x) and any(x):
            one.setdefault(i, []).append((list(map(float, x)), label))
    one = {i: min(x) for i, x in one.items()}
    near = defaultdict(set)
    for a in one:
        for b in one:
            x, y = np.array(one[a][0]), np.array(one[b][0])
            if a != b and one[a][1] == one[b][1] and len(x) == len(y):
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    near[a].add(b)
    out = {}
    for i in ids:
        seen, open_ = {i}, [i]
        while open_:
            for n in near[open_.pop()] - seen:
                seen.add(n)
                open_.append(n)
        out[i] = (len(near[i]), min(seen))
    return out


VECTORS = "vec_id long, embedding array<float>, label int, id long, x int, family long"


def vector_rows():
    draw = np.random.RandomState(5)
    centres = draw.randn(12, 16)
    rows = []
    for i in range(150):
        label = i % 3 if i % 17 else None
        x = centres[i % 12] + draw.randn(16) * (0.02 if i % 2 else 1.0)
        rows.append((i, [float(np.float32(v)) for v in x], label))
    x = rows[7][1]
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [*x[:-1], None], 1), (203, [*x[:-1], float("nan")], 1),
             (204, [*x[:-1], float("inf")], 1), (205, [], 1), (206, x[:4], 1), (206, x[:4], 1)]
    rows += [(300 + i, [v + 1e-4 * i for v in x], 1) for i in range(60)]
    return rows


def test_links_match_brute_force_with_saturated_lists(spark):
    rows = vector_rows()
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS)
    found = vectors.linked_vectors(table, k=5).collect()
    assert len(found) == len(rows)
    assert {r.id: (r.n_links, r.component_id) for r in found} == brute_links(rows)
    assert {r.audited_recall for r in found} == {1.0}


def plain_links(x):
    """Number of links of each vector, and the least vector that links lead to."""
    x = x / np.sqrt((x * x).sum(axis=1))[:, None]
    n, edges = np.zeros(len(x), np.int64), []
    for at in range(0, len(x), 500):
        row, column = np.nonzero(x[at : at + 500] @ x.T >= 0.98)
        kept = row + at != column
        np.add.at(n, row[kept] + at, 1)
        edges.append((row[kept] + at, column[kept]))
    a, b = (np.concatenate(e) for e in zip(*edges))
    least, before = np.arange(len(x)), None
    while not np.array_equal(least, before):
        before = least.copy()
        np.minimum.at(least, a, least[b])
    return {i: (int(n[i]), int(least[i])) for i in range(len(x))}


@pytest.mark.parametrize(("pairs", "copies", "more_trees"), [(3000, 1500, 3), (700, 300, -1)])
def test_links_of_a_narrow_cone_and_copies(spark, pairs, copies, more_trees):
    """All of one label: pairs close to each other, and copies; also with all blocks compared."""
    draw = np.random.RandomState(7)
    axis = draw.randn(24)
    one = axis * 0.55 + draw.randn(pairs, 24)
    other = one + draw.randn(pairs, 24) * 0.09
    same = np.repeat(draw.randn(1, 24), copies, axis=0)
    x = np.concatenate([one, other, same]).astype(np.float32)
    order = draw.permutation(len(x))
    x = x[order].astype(np.float64)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = vectors.linked_vectors(table, more_trees=more_trees).collect()
    wanted = plain_links(x)
    assert {r.id: (r.n_links, r.component_id) for r in found} == wanted
    assert sum(n > 0 for n, _ in wanted.values()) > copies + pairs


def test_no_vectors(spark):
    assert vectors.linked_vectors(spark.createDataFrame([], VECTORS)).collect() == []


def test_components_are_those_of_the_graph(spark):
    pick = random.Random(2)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(50)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {x: found.get(x, x) for x in parent} == {x: root(x) for x in parent}


# chat

TURNS = "conv_id long, turn long, role string, text string, id long, formatted string"


def test_formatted_turns_read_back_and_the_mask_covers_answers(spark):
    tricky = ["<|end|>\n", "<+>", "\\l\\b\\p", "<|user|>hi<|end|>", "\\### Assistant: </turn> ok", "", "😀é|", "a\nb"]
    rows = [(1, i, r, t, 0, "") for i, (r, t) in enumerate(zip("user user assistant assistant".split() * 2, tricky))]
    rows += [(2, 1, "assistant", None, 0, ""), (2, 0, None, "x", 0, ""), (2, None, "system|<", "first", 0, "")]
    rows += [(3, 0, "user", "same", 0, ""), (3, 0, "user", "same", 0, ""), (None, 0, "assistant", "y", 0, "")]
    found = chat.formatted(spark.createDataFrame(rows, TURNS).repartition(3))
    found = found.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "learned", chat.masked_text(F.col("formatted"), F.col("loss_mask"))
    )
    got = {r.id: r for r in found.collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == conv), key=order)
        assert [(t.role, t.text) for t in got[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert got[conv].learned == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert got[1].formatted.count("<|user|>") == 2
    assert chat.formatted(spark.createDataFrame([], TURNS)).collect() == []


# registered queries and the pipeline


def test_pipeline_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    extra = docs.withColumn("score_of_quality_", F.lit(1)).withColumn("id", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, str(DATA))
        assert out.columns == extra.columns
        assert 0 < out.count() <= extra.count()
        extra = out
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(DATA)).count() == 0


def test_pipeline_packs_what_the_stages_keep(spark):
    pytest.importorskip("public_tokenizers")
    pieces = corpus_pipeline.run(spark, str(DATA)).collect()
    assert pieces and len({(r.doc_id, r.start) for r in pieces}) == len(pieces)
    assert max(r.offset + r.length for r in pieces) <= packing.CAPACITY


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered_queries_return_their_rows(spark, name):
    number = name.split("_")[0]
    table = {"op7": "embeddings", "op8": "conversations", "op11": "conversations"}
    result = registry.QUERIES[name](spark, f"{DATA}/")
    n = spark.read.parquet(f"{DATA}/{table.get(number, 'documents')}.parquet")
    if number in ("op10", "op12"):
        assert result.count() >= n.count()
    elif number == "op11":
        assert result.count() == n.select("conv_id").distinct().count()
    elif number == "op13":
        assert result.count() == result.select("word").distinct().count() > 0
    elif number == "op2":
        assert result.select("doc_id").distinct().count() <= n.count() < result.count()
    elif name.startswith("op8"):
        assert result.count() == n.select("conv_id").distinct().count() + 1
        planted = result.filter("conv_id = -7").first()
        text = "\\### Assistant: </turn> ok"
        assert planted.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (planted.n_turns, planted.loss_chars) == (2, len(text))
    else:
        assert result.count() == n.count()


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, tmp_path, name):
    duckdb = pytest.importorskip("duckdb")
    turns = spark.read.parquet(f"{DATA}/conversations.parquet")
    odd = [(9001, 0, "user", None), (9001, 1, None, "a|b<\\c"), (9001, 1, "assistant", "é😀\n"), (9001, None, "assistant", ""),
           (None, 3, "assistant", "x"), (9002, 0, "us|er", "<|end|>"), (9002, 1, "us|er", "\\l")]
    more = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    turns.select(more.columns).unionByName(more).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found, wanted = registry.QUERIES[name](spark, str(tmp_path)), con.sql(registry.ORACLE_SQL[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    theirs = [dict(zip(wanted.columns, row)) for row in wanted.fetchall()]
    key = str
    assert sorted((str(sorted(r.asDict().items())) for r in found.collect()), key=key) == sorted(
        (str(sorted(r.items())) for r in theirs), key=key
    )
