"""The stages of the pipeline against plain versions of them, on planted documents."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from odd import prose
from test_text_operators import plain_contamination, plain_distance, plain_similarity, lowered, WORDS
from tokenizers import Tokenizer

import corpus_pipeline
from playtrail.llm import packing, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = [(1, prose(5, 40)), (2, prose(6, 13)), (3, "Only few words")]


def rows_with(texts):
    return [(d, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, (d, t) in enumerate(texts)]


def planted():
    """Clean prose, junk, copies, near copies, repeated lines, leaks, shared and missing ids."""
    pick = random.Random(3)
    texts = [(i, prose(i, pick.randrange(30, 90))) for i in range(60)]
    texts += [(100 + i, " ".join(w.upper() + "!!" for w in prose(200 + i, 60).split())) for i in range(15)]
    base = [prose(300 + i, 70).replace("\n", " ") for i in range(4)]
    for k, text in enumerate(base):
        words = text.split()
        words[20 + k] = "otherwise"
        texts += [(400 + k, text), (410 + k, " ".join(words))]
    texts += [(420, base[0] + " tail"), (None, base[1] + " end"), (430, base[2] + " over"), (430, base[2] + " here")]
    menu = "Main menu\nYes\n"
    texts += [(500 + i, menu + prose(510 + i, 40)) for i in range(3)] + [(503, "No\n12\n" + prose(520, 40))]
    line = "a line that stands in several documents of this corpus"
    texts += [(530, line + "\n" + prose(531, 30)), (532, line[:-1] + "Z\n" + prose(533, 30)), (534, prose(535, 30) + line)]
    texts += [(600, prose(601, 20) + ITEMS[0][1]), (602, ITEMS[1][1] * 2), (602, prose(603, 50)), (604, "only FEW words")]
    texts += [(None, ITEMS[0][1] + prose(605, 15)), (700, None), (701, ""), (702, "\n\n")]
    return rows_with(texts)


def multiset(df, columns=("doc_id", "text")):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# plain versions


def plain_lines(rows):
    """Of each class of lines the first place, by id (none first) and row, stays."""
    first = {}
    for i, (doc, text, *_) in enumerate(rows):
        for n, line in enumerate(x for x in (text or "").split("\n") if x):
            place = (doc is not None, doc or 0, i, n)
            first[line] = min(first.get(line, place), place)
    lines = sorted(first)
    group = {x: {x} for x in lines}
    for k, a in enumerate(lines):
        for b in lines[:k]:
            allowed = min(2, min(len(a), len(b)) // corpus_pipeline.CHARACTERS_PER_EDIT)
            if allowed and abs(len(a) - len(b)) <= allowed and plain_distance(a, b) <= allowed:
                both = group[a] | group[b]
                for x in both:
                    group[x] = both
    keep = {x: min(first[y] for y in group[x]) for x in lines}
    out = []
    for i, (doc, text, *rest) in enumerate(rows):
        if text is not None:
            parts, n, gone = text.split("\n"), 0, False
            left = []
            for part in parts:
                stays = not part or keep[part] == (doc is not None, doc or 0, i, n)
                n += bool(part)
                left += [part] if stays else []
                gone |= not stays
            text = "\n".join(left) if gone else text
        out.append((doc, text, *rest[:-1], None if text is None else len(text)))
    return out


def plain_weights(rows):
    df = Counter(w for _, t, *_ in rows for w in set(WORDS.findall(lowered(t))))
    return {w: np.log1p(len(rows) / max(n, len(rows) / 1000)) for w, n in df.items()}


def plain_one_of_copies(rows):
    weights, parent = plain_weights(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if plain_similarity(rows[i][1], rows[j][1], weights) >= 0.8:
                parent[root(i)] = root(j)
    best = {}
    for i, row in enumerate(rows):
        rank = (row[0] is None, row[0] or 0, i)
        best[root(i)] = min(best.get(root(i), rank), rank)
    return [row for i, row in enumerate(rows) if best[root(i)][2] == i]


def plain_uncontaminated(rows):
    # one document at a time, as ids may be shared
    kept = []
    for row in rows:
        ((_, n, hit, _),) = plain_contamination([row[:2]], ITEMS)
        if not (hit and 20 * hit >= n):
            kept.append(row)
    return kept


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pipeline")
    rows = planted()
    labels = [(d, int("!!" not in t), 0) for d, t, *_ in rows if d is not None and t]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


STAGES = dict(corpus_pipeline.STAGES)


def one_file(spark, rows, tmp_path):
    """Rows as a table whose scan keeps their order, as the plain versions number them."""
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{tmp_path}/docs")
    return spark.read.parquet(f"{tmp_path}/docs")


@pytest.mark.parametrize(
    ("stage", "plain"),
    [
        ("line_dedup", plain_lines),
        ("near_duplicates", plain_one_of_copies),
        ("decontamination", plain_uncontaminated),
    ],
)
def test_stage_matches_its_plain_version(spark, tables, tmp_path, stage, plain):
    path, rows = tables
    rows = rows + rows[3:6] + rows[-2:]  # repeated rows
    out = STAGES[stage](spark, one_file(spark, rows, tmp_path), path)
    columns = ("doc_id", "text", "lang", "source", "n_chars")
    assert tuple(out.columns) == columns
    assert multiset(out, columns) == Counter(tuple(r) for r in plain(rows))
    assert len(plain(rows)) < len(rows) or stage == "line_dedup"


def test_pipeline_packs_the_tokens_of_what_plain_stages_keep(spark, tables):
    path, rows = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    scores = quality.with_score(docs, quality.train(docs, labels), "score").collect()
    kept = [row for row, scored in zip(rows, scores) if scored["score"] >= quality.THRESHOLD]
    assert [r["text"] for r in scores] == [r[1] for r in rows]
    junk = [r for r in rows if r[1] and "!!" in r[1]]
    clean = [r for r in rows if r[1] and "!!" not in r[1]]
    assert not set(junk) & set(kept) and len(set(clean) & set(kept)) >= 0.95 * len(clean)
    for plain in (plain_lines, plain_one_of_copies, plain_uncontaminated):
        kept = plain(kept)
    tokens = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    wanted = Counter()
    for doc, text, *_ in kept:
        ids = [*tokens.encode(text or "", add_special_tokens=False).ids, packing.END]
        for start in range(0, len(ids), packing.CAPACITY):
            piece = np.array(ids[start : start + packing.CAPACITY], "<u4")
            wanted[doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    found = corpus_pipeline.run(spark, path)
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert multiset(found, columns) == wanted
