"""Operators on texts against plain versions, on odd rows and on empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd import DOCS, odd_rows, prose

from playtrail.llm import decontaminate, line_dedup, near_duplicates, packing, suffix_tree_lm, suffixes
from playtrail.llm.textbytes import Texts

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKENS = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def lowered(text):
    return (text or "").encode().translate(LOWER)


def test_slices_keep_rows_apart():
    data = np.frombuffer(b"ab  cdef", np.uint8)
    part = Texts(data, np.array([0, 1, 2, 2, 6, 8]))
    starts, ends = part.runs(np.arange(256) > 32)
    assert list(zip(starts, ends)) == [(0, 1), (1, 2), (4, 6), (6, 8)]


# repeated bytes


def plain_repeats(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, kept))
    return out


def found_repeats(docs, length, **options):
    rows = suffixes.repeated_bytes(docs, length, **options).collect()
    spans = [[(s.start, s.end) for s in r.spans] for r in rows]
    return sorted(
        (str(r.id), r.n_bytes, sum(b - a for a, b in s), len(s), bytes(r.kept)) for r, s in zip(rows, spans)
    )


@pytest.mark.parametrize("length", [3, 20, 400])
def test_repeated_bytes_match_brute_force(spark, length):
    passage, line = prose(11, 90), prose(12, 12)
    texts = [prose(20 + i, 30 + i) for i in range(30)]
    texts += [texts[0], texts[1][:-9] + "xx", "lead " + passage, passage + " tail", passage * 2]
    texts += [f"{line}{prose(70 + i, 5)}" for i in range(20)] + [None, "", "ab" * 500, "é" * 300]
    rows = list(enumerate(texts)) * (2 if length == 20 else 1)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    plain = plain_repeats([(t or "").encode() for _, t in rows], length)
    wanted = sorted((str(d), *p) for (d, _), p in zip(rows, plain))
    assert found_repeats(docs, length) == wanted
    # more groups than shuffle partitions, as a large corpus has
    assert length < 400 or found_repeats(docs, length, group_bytes=700) == wanted


def test_repeated_bytes_of_odd_rows(odd_docs, no_docs):
    found = found_repeats(odd_docs, 400)
    plain = plain_repeats([(t or "").encode() for _, t in odd_rows()], 400)
    assert found == sorted((str(d), *p) for (d, _), p in zip(odd_rows(), plain))
    assert found_repeats(no_docs, 400) == []


def plain_passages(texts, size):
    """Byte spans covered by ``size`` words in a row that another text holds too."""
    found = [list(TOKENS.finditer(t)) for t in texts]
    words = [[m.group() for m in w] for w in found]
    holders = defaultdict(set)
    for row, w in enumerate(words):
        for i in range(len(w) - size + 1):
            holders[tuple(w[i : i + size])].add(row)
    out = []
    for w, at in zip(words, found):
        hit = [False] * len(w)
        for i in range(len(w) - size + 1):
            if len(holders[tuple(w[i : i + size])]) > 1:
                hit[i : i + size] = [True] * size
        first = [i for i in range(len(w)) if hit[i] and not (i and hit[i - 1])]
        last = [i for i in range(len(w)) if hit[i] and not (i + 1 < len(w) and hit[i + 1])]
        out.append([(at[a].start(), at[b].end()) for a, b in zip(first, last)])
    return out


@pytest.mark.parametrize("size", [1, 4, 12, 20, 51])
def test_passages_match_brute_force(spark, size):
    passage, line, own = prose(11, size + 3), prose(12, size), prose(13, size + 1)
    texts = [prose(20 + i, 30 + i) for i in range(30)]
    texts += [f"{prose(60 + i, 9 * i)}{passage}{prose(80 + i, 20)}" for i in range(5)]
    texts += ["  ".join(passage.split()), passage.strip() + "x", " ".join(passage.split()[1:-1])]
    texts += [texts[0], None, "", " \n ", "a " * 300, "a " * 200, "é " * 300, (own + line) * 3]
    # a row that holds a string twice, itself or among others, with other rows or alone
    texts += [f"{line}{prose(90 + i, 5)}{line}{prose(95 + i, 70)}" for i in range(3)]
    texts += [f"{own} {prose(99, 60)} {own} {prose(98, 60)} {own}"]
    # many names with several second names
    few = np.random.default_rng(size)
    texts += [" ".join(few.choice(["a", "b"], n)) for n in few.integers(10, 80, 60)]
    rows = list(enumerate(texts)) * (2 if size == 20 else 1)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    plain = plain_passages([(t or "").encode() for _, t in rows], size)
    wanted = sorted((d, p) for (d, _), p in zip(rows, plain))
    for group_bytes in (suffixes.GROUP_BYTES, 700):
        found = suffixes.repeated_bytes(docs, group_bytes=group_bytes, passage_words=size).collect()
        assert sorted((r.id, [(p.start, p.end) for p in r.passages]) for r in found) == wanted


def test_a_passage_in_one_row_alone_is_none(spark):
    twice = prose(5, 60)
    alone = [(1, f"{twice}{prose(6, 80)}{twice}"), (2, prose(7, 90))]
    found = suffixes.repeated_bytes(spark.createDataFrame(alone, DOCS)).collect()
    assert [r.passages for r in found] == [[], []]
    # below 400 bytes: told and not removed
    short = " ".join(["as"] * 20 + ["we"] * 20 + ["do"] * 20)
    rows = [(1, f"{prose(8, 30)} {short} {prose(9, 30)}"), (2, f"{prose(10, 40)} {short}")]
    found = suffixes.repeated_bytes(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.id, len(r.spans), r.passages[0].end - r.passages[0].start) for r in found) == [
        (1, 0, len(short)), (2, 0, len(short))]


def test_difference_cover_reaches_every_shift():
    for q in (2, 3, 5, 7, 13):
        modulus, cover = suffixes.singer_cover(q)
        assert len({(a - b) % modulus for a in cover for b in cover}) == modulus


# decontamination


def plain_contamination(rows, items, size=13):
    windows = defaultdict(set)
    for item, text in items:
        words = WORDS.findall(lowered(text))
        for i in range(max(1, len(words) - size + 1)):
            if words:
                windows[tuple(words[i : i + size])].add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        words, hit, found = WORDS.findall(lowered(text)), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    found |= windows[tuple(words[i : i + n])]
                    hit |= set(range(i, i + n))
        out.append((str(doc), len(words), len(hit), sorted(found)))
    return sorted(out)


def found_contamination(spark, docs, items, **options):
    tests = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(docs, tests, **options).collect()
    return sorted(
        (str(r.id), r.n_words, sum(s.end - s.start for s in r.spans), sorted(r["items"])) for r in rows
    )


ITEMS = [(1, prose(5, 40)), (2, "Only few words"), (3, None), (4, ""), (5, prose(6, 13)), (5, prose(7, 20)),
         (None, "one nameless item"), (6, prose(5, 40))]


@pytest.mark.parametrize(
    ("block_words", "indexed_terms"), [(500_000, 2_000_000), (40, 2_000_000), (9, 3)]
)
def test_contamination_matches_brute_force(spark, block_words, indexed_terms):
    rows = [(i, prose(100 + i, 60)) for i in range(20)]
    rows += [(50, prose(1, 9) + prose(5, 40) + prose(2, 9)), (51, "ONLY few, words! only few words"),
             (52, prose(5, 12)), (53, prose(6, 13) * 3), (54, "a nameless one nameless item")]
    # whole copies in files of their own, whose slices begin with the same word
    rows += rows[-3:] * 2
    docs = spark.createDataFrame(rows[:-3], DOCS).repartition(2)
    docs = docs.unionByName(spark.createDataFrame(rows[-3:], DOCS).repartition(3))
    options = {"block_words": block_words, "indexed_terms": indexed_terms}
    found = found_contamination(spark, docs, ITEMS, **options)
    assert found == plain_contamination(rows, ITEMS)
    assert sum(hit > 0 for _, _, hit, _ in found) >= 4


def test_contamination_of_odd_rows(spark, odd_docs, no_docs):
    assert found_contamination(spark, odd_docs, ITEMS) == plain_contamination(odd_rows(), ITEMS)
    assert found_contamination(spark, no_docs, ITEMS) == []
    assert all(not hit for _, _, hit, _ in found_contamination(spark, odd_docs, []))


def test_near_matches_need_the_rarest_terms_close_together(spark):
    item = "zebra quartz vivid common words follow here and there"
    rows = [(1, "a zebra then quartz and vivid"), (2, "zebra " + "filler " * 50 + "quartz vivid")]
    rows += [(3, "common words follow here and there " * 9)]
    tests = spark.createDataFrame([(7, item)], "item_id long, text string")
    near = decontaminate.contamination(spark.createDataFrame(rows, DOCS), tests).collect()
    assert {r.id: r.near for r in near} == {1: ["7"], 2: [], 3: []}


# packing


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path(packing.TOKENIZER)


def check_packing(rows, found, path, capacity=2048):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(path)
    want = Counter()
    for doc, text in rows:
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), capacity):
            own = ids[start : start + capacity]
            want[doc, start, len(own), zlib.crc32(own), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_holds_every_token_once(spark, odd_docs, no_docs):
    path = tokenizer_path()
    check_packing(odd_rows(), packing.pack_documents(odd_docs, path).collect(), path)
    assert packing.pack_documents(no_docs, path).collect() == []
    rows = [(i, prose(i, 20 + 13 * i)) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    check_packing(rows, packing.pack_documents(docs, path, group_pieces=7).collect(), path)
    # copies of one row are dealt to several groups, as any pieces are
    copies = spark.createDataFrame([(None, "a word")] * 400, DOCS)
    found = packing.pack_documents(copies, path, group_pieces=40).collect()
    check_packing([(None, "a word")] * 400, found, path)
    assert len({r.sequence_id >> 40 for r in found}) == 10


def test_units_give_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    texts = ["It's 'tis <|endoftext|> <|ENDOFTEXT|> a|b", "x…, y—z 12.5 Ünïcode! é", " a b",
             "don't.STOP,now?!", "ÀÉ×÷ß", "日本語 text", "a\x00b", *(t or "" for _, t in odd_rows())]
    data = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    ids, cut = packing.UnitTokenizer(path).encode(Texts(np.frombuffer(b"".join(data), np.uint8), bounds))
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    for k, one in enumerate(whole):
        assert ids[cut[k] : cut[k + 1]].tolist() == one.ids, texts[k][:60]


def test_known_units_are_dropped_by_age_and_learned_again(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "KNOWN_UNITS", 60)
    path = tokenizer_path()
    units, plain = packing.UnitTokenizer(path), Tokenizer.from_file(path)
    for k in [*range(12), *range(12)]:
        text = prose(k, 40) + "x" * 2000 + " " + "ab" * 700
        data = np.frombuffer(text.encode(), np.uint8)
        ids, cut = units.encode(Texts(data, np.array([0, len(data)])))
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(units.keys) <= 60 and (np.diff(units.keys.astype(object)) > 0).all()


def test_best_fit_takes_the_tightest_window():
    lengths = np.array([9, 7, 6, 4, 3, 2, 1])
    window, offset = packing.best_fit_decreasing(lengths, 10)
    assert window.tolist() == [0, 1, 2, 2, 1, 3, 0]
    assert offset.tolist() == [0, 0, 0, 6, 7, 0, 9]


# near duplicates


def plain_similarity(a, b, weights):
    sets = []
    for text in (a, b):
        words = WORDS.findall(lowered(text))
        n = min(5, len(words))
        sets.append(Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter())
    keys = set(sets[0]) | set(sets[1])
    value = {k: sum(weights[w] for w in k) for k in keys}
    both = sum(min(s[k] for s in sets) * value[k] for k in keys)
    whole = sum(max(s[k] for s in sets) * value[k] for k in keys)
    return both / whole if whole else 0.0


def plain_classes(rows):
    df = Counter(w for _, t in rows for w in set(WORDS.findall(lowered(t))))
    weights = {w: math.log1p(len(rows) / max(n, len(rows) / 1000)) for w, n in df.items()}
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if plain_similarity(rows[i][1], rows[j][1], weights) >= 0.8:
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        members[root(i)].append(doc)
    least = {r: min((d for d in m if d is not None), default=None) for r, m in members.items()}
    return sorted(((str(d), str(least[root(i)])) for i, (d, _) in enumerate(rows)))


def edited(text, seed, words):
    import random

    pick, out = random.Random(seed), text.split(" ")
    for _ in range(words):
        out[pick.randrange(len(out))] = f"new{pick.randrange(10**6)}"
    return " ".join(out)


def test_near_duplicates_match_brute_force(spark):
    base = prose(31, 150)
    rows = [(i, edited(base, i, 1 + i % 3)) for i in range(40)] + [(40, base)]
    rows += [(50 + i, prose(60 + i, 80)) for i in range(12)]
    rows += [(90, rows[45][1]), (91, edited(rows[46][1], 5, 1)), (92, "four words are here"),
             (93, "Four words, are here!"), (94, "four words are")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = sorted((str(r.id), str(r.class_id)) for r in near_duplicates.classes(docs).collect())
    assert found == plain_classes(rows)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    found = sorted((str(r.id), str(r.class_id)) for r in near_duplicates.classes(odd_docs).collect())
    assert found == plain_classes(odd_rows())
    assert near_duplicates.classes(no_docs).collect() == []


def test_samples_agree_as_often_as_weighted_sets_overlap():
    names = near_duplicates.mix(np.arange(1, 4001, dtype=np.uint64))
    weight = 1 + (np.arange(4000) % 7)
    left, right = np.arange(0, 3000), np.arange(1000, 4000)
    drawn = [
        near_duplicates.sample(np.zeros(3000, np.int64), names[k], weight[k], 1, 400)[0] for k in (left, right)
    ]
    true = weight[1000:3000].sum() / weight.sum()
    assert abs((drawn[0] == drawn[1]).mean() - true) < 0.09


def test_the_screen_of_left_pairs_knows_weights():
    # 46 heavy shingles in both texts, 10 light ones on either side: weighted 0.85, unweighted 0.70
    names = near_duplicates.mix(np.arange(1, 67, dtype=np.uint64))
    sides = []
    for own in (np.arange(0, 56), np.append(np.arange(0, 46), np.arange(56, 66))):
        weight = np.where(own < 46, 30.0, 12.0)
        sides.append(near_duplicates.sketch(np.zeros(56, np.int64), names[own], weight, 1))
    true = 46 * 30 / (46 * 30 + 20 * 12)
    assert true >= near_duplicates.SIMILARITY
    assert true <= near_duplicates.most_similar(sides[0][0], sides[1])[0] < 1


def test_the_bound_of_sketches_is_never_below_the_similarity():
    pick = np.random.default_rng(5)
    names = near_duplicates.mix(np.arange(1, 3001, dtype=np.uint64))
    for n in (3, 60, 400, 2000):
        sets = []
        for _ in range(8):
            own = np.flatnonzero(pick.random(len(names)) < n / len(names) * 0.9)
            sets.append((own, pick.integers(1, 4, len(own)) * np.round(pick.random(len(own)) * 30 + 1, 3)))
        row = np.repeat(np.arange(8), [len(own) for own, _ in sets])
        drawn = near_duplicates.sketch(
            row, names[np.concatenate([s[0] for s in sets])], np.concatenate([s[1] for s in sets]), 8
        )
        for k, one in enumerate(sets):
            bound = near_duplicates.most_similar(drawn[k], drawn)
            assert all(near_duplicates._weighted_jaccard(one, o) <= b for o, b in zip(sets, bound))


def test_copies_of_one_heavy_passage_meet_in_a_crowded_bucket(spark):
    # one passage repeated often, different rests: alike by weight only, and not like the first of the bucket
    passage = prose(41, 12).replace("\n", " ")
    rows = [(i, passage * 14 + " " + prose(500 + i, 26)) for i in range(30)]
    rows += [(100 + i, passage * 6 + " " + prose(600 + i, 30)) for i in range(10)]
    found = sorted(
        (str(r.id), str(r.class_id)) for r in near_duplicates.classes(spark.createDataFrame(rows, DOCS)).collect()
    )
    assert found == plain_classes(rows)


# lines


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, p in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, q in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != q))
    return row[-1]


def plain_lines(rows, edits=2, least=32):
    first, copies = {}, Counter()
    for doc, text in rows:
        for n, line in enumerate(x for x in (text or "").encode().split(b"\n") if x):
            copies[line] += 1
            place = (doc if doc is not None else -(1 << 63), n)
            first[line] = min(first.get(line, place), place)
    long_ones = [x for x in first if len(x) >= least]
    parent, degree = {x: x for x in first}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(long_ones):
        for b in long_ones[:i]:
            if abs(len(a) - len(b)) <= edits and plain_distance(a, b) <= edits:
                degree[a] += 1
                degree[b] += 1
                parent[root(a)] = root(b)
    least_place = {}
    for x in first:
        least_place[root(x)] = min(least_place.get(root(x), first[x]), first[x])
    return Counter((first[x], len(x), copies[x], degree[x], least_place[root(x)]) for x in first)


def found_lines(docs):
    def place(p):
        return (p.id if p.id is not None else -(1 << 63), p.line_no)

    rows = line_dedup.line_classes(docs).collect()
    return Counter((place(r.place), r.n_bytes, r.n_copies, r.n_links, place(r.class_place)) for r in rows)


def test_line_classes_match_brute_force(spark):
    lines = [prose(200 + i, 12).replace("\n", " ")[: 30 + i] for i in range(25)]
    lines += [x[:7] + "Q" + x[8:] for x in lines[:9]] + [x[:9] + x[10:-1] for x in lines[5:14]]
    lines += [x + "yz" for x in lines[:6]] + ["short", "shirt", "x" * 40, "x" * 41, "x" * 43]
    rows = [(i % 11, "\n".join(lines[i : i + 3]) + "\n\n") for i in range(len(lines))]
    rows = [(100 + i, t) for i, (_, t) in enumerate(rows)] + [(900, lines[3])]
    assert found_lines(spark.createDataFrame(rows, DOCS).repartition(3)) == plain_lines(rows)


def plain_lines_in_characters(rows, edits=2, per=0):
    first, copies = {}, Counter()
    for doc, text in rows:
        for n, line in enumerate(x for x in text.split("\n") if x):
            copies[line] += 1
            first[line] = min(first.get(line, (doc, n)), (doc, n))
    group, degree = {x: {x} for x in first}, Counter()
    for a in first:
        for b in first:
            allowed = min(edits, min(len(a), len(b)) // per) if per else edits
            if a < b and plain_distance(a, b) <= allowed:
                degree[a] += 1
                degree[b] += 1
                both = group[a] | group[b]
                for x in both:
                    group[x] = both
    return Counter(
        (first[x], len(x.encode()), copies[x], degree[x], min(first[y] for y in group[x])) for x in first
    )


@pytest.mark.parametrize("per", [0, 4, 16])
def test_lines_of_every_length_match_brute_force_in_characters(spark, per):
    import random

    pick = random.Random(3)
    lines = ["Copyright 2023 X", "Copyright 2024 X", "日本語の見出し", "日本語見出", "thumbs \U0001f44d up", "thumbs up"]
    lines += ["a" * 31, "a" * 32, "a" * 33, "a" * 34, "aé" * 8, "aé" * 8 + "b", "z", "é", "qz", "日本", "zqzq", "Home page", "Hone page", "unlike anything else"]
    lines += ["".join(pick.choices("abcdeé語", k=pick.randrange(1, 12))) for _ in range(80)]
    rows = [(i, "\n".join(lines[i : i + 3])) for i in range(len(lines))]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = Counter(
        ((r.place.id, r.place.line_no), r.n_bytes, r.n_copies, r.n_links, (r.class_place.id, r.class_place.line_no))
        for r in line_dedup.line_classes(
            docs, least=line_dedup.EVERY_LINE, in_characters=True, symbols_per_edit=per
        ).collect()
    )
    assert found == plain_lines_in_characters(rows, per=per)


def test_the_pipeline_drops_copies_of_short_lines_and_keeps_unlike_ones(spark):
    import corpus_pipeline

    rows = [(1, "Main menu\nYes\nfirst text here"), (2, "Main menu\nNo\nanother one, quite unlike"),
            (3, "Main menus\n12"), (4, "first text there\nYes")]
    out = corpus_pipeline.drop_repeated_lines(spark, spark.createDataFrame(rows, DOCS), "")
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: rows[0][1], 2: "No\nanother one, quite unlike", 3: rows[2][1], 4: "first text there",
    }


def test_line_classes_of_odd_rows(spark, odd_docs, no_docs):
    assert found_lines(odd_docs.filter("doc_id is null or doc_id <> 5")) == plain_lines(
        [r for r in odd_rows() if r[0] != 5]
    )
    assert found_lines(no_docs) == Counter()
    kept = line_dedup.without_repeated_lines(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    texts = {r.doc_id: r.text for r in kept.collect() if r.doc_id != 8}
    given = dict(odd_rows())
    assert all(texts[d] == given[d] for d in (1, 2, 3, 4, 5, 9))
    assert len(texts[7]) < len(given[7]) and len(texts[6]) <= len(given[6])
    assert line_dedup.without_repeated_lines(no_docs).collect() == []


def test_the_first_of_near_equal_lines_stays(spark):
    line = "this line is long enough to be compared with others"
    rows = [(1, f"head\n{line}\n\nfoot"), (2, f"{line}s\nkeep this one as it is alone in here"), (3, line)]
    kept = line_dedup.without_repeated_lines(spark.createDataFrame(rows, DOCS))
    assert {r.doc_id: r.text for r in kept.collect()} == {
        1: rows[0][1], 2: "keep this one as it is alone in here", 3: "",
    }


@pytest.mark.parametrize("most", [1, 2, 4])
def test_banded_distance_matches_the_plain_one(most):
    import random

    import pyarrow as pa

    pick = random.Random(most)
    left = [bytes(pick.choices(b"abc", k=pick.randrange(40))) for _ in range(300)]
    right = []
    for x in left:
        y = bytearray(x)
        for _ in range(pick.randrange(most + 3)):
            at = pick.randrange(len(y) + 1)
            y[at : at + pick.randrange(2)] = pick.choices(b"abc", k=pick.randrange(2))
        right.append(bytes(y))
    n = np.arange(len(left))
    found = line_dedup.edit_distances(pa.array(left + right, pa.binary()), n, n + len(left), most)
    assert found.tolist() == [min(most + 1, plain_distance(a, b)) for a, b in zip(left, right)]


# language model


def plain_base(rows):
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2 for d, _ in rows]
    tokens = [[*TOKENS.findall(lowered(t)), None] for _, t in rows]
    count = Counter(x for own, h in zip(tokens, held) if not h for x in own)
    size = sum(count.values()) + len(count) + 1
    out = []
    for (doc, _), h, own in zip(rows, held, tokens):
        base = sum(math.log10((count[x] + 1) / size) for x in own)
        known = sum(count[x] > 0 for x in own)
        out.append((str(doc), h, len(own), known, sum(count.values()), round(base, 4)))
    return sorted(out)


def found_base(docs):
    rows = suffix_tree_lm.scored(docs).collect()
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    return sorted(
        (str(r.id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows
    )


def test_base_scores_match_brute_force(spark, odd_docs, no_docs):
    rows = [(i, prose(300 + i, 5 + 11 * i)) for i in range(40)]
    assert found_base(spark.createDataFrame(rows, DOCS).repartition(3)) == plain_base(rows)
    assert found_base(odd_docs) == plain_base(odd_rows())
    assert found_base(no_docs) == []


def tree_of(text):
    """A tree grown from one text with the thresholds a table of its size has."""
    data = np.frombuffer(text.encode(), np.uint8)
    part = Texts(data, np.array([0, len(data)])).lower()
    words = part.words(np.arange(256) > 32)
    grams, n = np.unique(suffix_tree_lm._grams(part, words), return_counts=True)
    levels, contexts = [], []
    for d in range(suffix_tree_lm.DEPTH + 1):
        key, back = np.unique(grams & ((1 << 8 * (d + 1)) - 1), return_inverse=True)
        levels.append((key, np.bincount(back, n).astype(np.int64)))
        own = Counter()
        for k, c in zip((key >> 8).tolist(), levels[-1][1].tolist()):
            own[k] += c
        contexts.append(dict(own))
    return suffix_tree_lm.grow(levels, contexts), part, words


def test_next_symbol_chances_add_up_to_one():
    tree, _, _ = tree_of(prose(8, 400))
    each = 10.0 ** tree.logp.astype(np.float64)[:, tree.column]
    assert np.allclose(each.sum(axis=1), 1, atol=1e-4)


def test_the_automaton_reads_the_longest_retained_suffix():
    tree, part, words = tree_of(prose(9, 300))
    stream, _ = suffix_tree_lm.symbols(part, words)
    # whatever lane a symbol falls in, its score is that of reading from the start
    whole, moved = tree.score(stream), tree.score(np.append(np.full(77, 10, np.uint8), stream))[77:]
    assert np.allclose(whole[10:], moved[10:])
    assert whole.mean() > np.log10(1 / 20)
