"""Turn repair, best-two-fit packing and spelling variants against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from odd import DOCS, odd_rows, prose
from tokenizers import Tokenizer

from playtrail.llm import registry, spelling, turn_repair, two_fit

TURNS = "conv_id long, turn long, role string, text string"


def plain_repair(letters):
    """Least (cost, audit) by an automaton over whole scripts, at most four insertions in a row."""
    follows = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    @lru_cache(None)
    def best(i, state, inserted):
        ways = [(0, "")] if i == len(letters) and state in (0, 3) else []

        def go(cost, letter, after):
            if after:
                ways.append((cost + after[0], letter + after[1]))

        if i < len(letters):
            go(4, "D", best(i + 1, state, 0))
            kind = letters[i].lower()
            late = 3 if letters[i].isupper() else 0
            for role, then in follows[state].items():
                if kind != "x" and role == kind:
                    go(late, "K", best(i + 1, then, 0))
                elif kind != "x" and role != "s":
                    go(late + 3, "R", best(i + 1, then, 0))
        if inserted < 4:
            for role, then in follows[state].items():
                if role != "s":
                    go(3, "I", best(i, then, inserted + 1))
        return min(ways, default=None)

    return best(0, 0, 0)


def test_alignment_finds_the_least_audit_of_least_cost():
    pick = random.Random(4)
    for _ in range(1500):
        wild = pick.random() < 0.6
        letters = "".join(
            pick.choice("sssuuuaaaoxSUAO") if wild else pick.choice("ua"[i % 2] * 6 + "xusA")
            for i in range(pick.randrange(14))
        )
        assert turn_repair.repair(letters) == plain_repair(letters), letters


@pytest.mark.parametrize("letters", ["u" * 300, "ua" * 150, "x" * 200, "", "s", "S", "A", "sx"])
def test_alignment_over_several_blocks(letters):
    assert turn_repair.repair(letters) == plain_repair(letters)


def test_alignment_of_a_long_mixed_conversation():
    pick = random.Random(8)
    letters = "".join(pick.choice("uauauaxoSUAs") for _ in range(220))
    assert turn_repair.repair(letters) == plain_repair(letters)


def plain_conversations(rows):
    """The contract of op11, row by row."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault, kept = zlib.crc32(key.encode()) % 20, groups[conv]
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = []
    for conv, kept in groups.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        letters, counts = "", Counter()
        for i, (_, role, text) in enumerate(kept):
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            again = any(r[1:] == (role, text) for r in kept[:i])
            late = not again and shown and shown[-1] not in ".!?"
            counts[("blank" if not shown else "duplicate" if again else "late" if late else "")] += 1
            letter = role[:1] if role[:1] in set("sua") else "o"
            letters += "x" if not shown or again else letter.upper() if late else letter
        cost, audit = plain_repair(letters)
        turns = {r[0] for r in kept} - {None}
        size, at, lines = len(audit) - audit.count("D"), 0, []
        for edit in audit:
            role, text = kept[at][1:] if edit != "I" else ("", "")
            at += edit != "I"
            if edit in "IR":
                role = "assistant" if (size - len(lines)) % 2 else "user"
            lines += [] if edit == "D" else [f"{role}:{text}"]
        pairs = zip([r[1][:1] for r in kept], [r[1][:1] for r in kept][1:])
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                counts["blank"],
                counts["duplicate"],
                counts["late"],
                sum(a + b not in ("su", "ua", "au") for a, b in pairs),
                cost,
                audit,
                hashlib.sha256("\n".join(lines).encode()).hexdigest(),
            )
        )
    return Counter(out)


def test_turn_repair_query_against_the_contract(spark, tmp_path):
    pick = random.Random(6)
    rows = [
        (c, t, pick.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"]),
         pick.choice([f"Text {t}.", f"no end {t}", "Same.", " ", None, "\u00a0", "Oh! ", "A\tb?\n"]))
        for c in range(60)
        for t in [*range(pick.randrange(9)), None, 20][: pick.randrange(1, 11)]
    ]
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, None, None, None)]
    rows += [(500, 3, "user", prose(7, 20_000))] * 2 + [(501, 2**40, "system", "S."), (501, 0, "user", "x.")]
    rows += [(502, t, ["user", "assistant"][t % 2], f"Turn {t}.") for t in range(120)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], f"{TURNS}, id int, times int")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    found = registry.op11_turn_repair(spark, str(tmp_path))
    assert found.columns[:2] == ["conv_id", "gaps"]
    assert Counter(tuple(r) for r in found.collect()) == plain_conversations(rows)
    empty = spark.createDataFrame([], TURNS)
    assert turn_repair.repaired(empty).count() == 0


def test_repaired_turns_match_the_grammar(spark):
    turns = [(1, 0, "assistant", "A."), (1, 1, "user", "B."), (1, 2, "user", "C."), (2, 0, "x", "")]
    found = {r["id"]: r for r in turn_repair.repaired(spark.createDataFrame(turns, TURNS)).collect()}
    for row in found.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(t["role"][0] for t in row["turns"]))
    # inserting two turns, or a new role and one insertion, costs as much as a deletion less
    assert (found[1]["cost"], found[1]["audit"]) == plain_repair("auu")
    assert (found[2]["audit"], found[2]["turns"]) == ("D", [])


def plain_two_fit(lengths, capacity):
    left, windows = sorted(lengths), []
    while left:
        window, gap = [], capacity
        while fits := [x for x in left if x <= gap]:
            left.remove(max(fits))
            window.append(max(fits))
            gap -= max(fits)
        smallest = min(window)
        pairs = [
            (x + y, max(x, y))
            for i, x in enumerate(left)
            for y in left[:i]
            if gap and smallest < x + y <= gap + smallest
        ]
        if pairs:
            total, high = max(pairs)
            window.remove(smallest)
            left.append(smallest)
            for x in (high, total - high):
                left.remove(x)
                window.append(x)
        windows.append(sorted(window, reverse=True))
    return windows


def test_patterns_repeat_the_windows_of_one_by_one_filling():
    pick = random.Random(5)
    for _ in range(200):
        capacity = pick.choice([8, 20, 64])
        lengths = [
            min(capacity, int(pick.paretovariate(1)) + pick.randrange(3))
            for _ in range(pick.randrange(60))
        ]
        found = two_fit.patterns(np.array(lengths, np.int64), capacity)
        assert [w for w, n in found for _ in range(n)] == plain_two_fit(lengths, capacity)


def test_encoder_gives_the_ids_of_the_tokenizer():
    path = public_tokenizers.path(two_fit.TOKENIZER)
    encode, plain = two_fit.Encoder(path).ids, Tokenizer.from_file(path)
    assert two_fit.Encoder(path).quick is not None
    pick = random.Random(9)
    signs = [chr(c) for c in range(0x180)] + [*" \n\t  '\"stdm", "'ll", "<|endoftext|>", "😀", "中", "\u200b"]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randrange(1, 30))) for _ in range(4000)]
    texts += [f"{a}{chr(c)}{b}" for c in range(0x180) for a, b in (("a", "b"), (" ", " "), ("1", "'s"))]
    texts += ["", "a" * 5000, " " * 3000 + "x", "é" * 1000, "word " * 2000, "<|endoftext|>"]
    for text in texts:
        assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def check_packing(rows, found, capacity, plain):
    """Every id in one piece; pieces as the contract cuts them; sequences without gaps."""
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
    ids_of = defaultdict(list)
    for doc, text in rows:
        ids_of[doc].append(plain.encode(text or "", add_special_tokens=False).ids + [two_fit.END])
    wanted = Counter()
    for doc, copies in ids_of.items():
        for ids in copies:
            head = len(ids) % capacity or min(capacity, len(ids))
            cuts = [0, *range(head, len(ids) + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                crc = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
                wanted[(doc, k, a, b - a, crc)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == wanted
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(parts[-1]) <= capacity
        assert all(sum(a) == b[0] for a, b in zip(parts, parts[1:]))
    return sequences


@pytest.mark.parametrize("group_pieces", [20_000, 20])
def test_two_fit_packs_every_token_once(spark, odd_docs, no_docs, group_pieces):
    path = public_tokenizers.path(two_fit.TOKENIZER)
    plain = Tokenizer.from_file(path)
    pick = random.Random(12)
    rows = odd_rows() + [(100 + i, prose(50 + i, pick.randrange(1, 300))) for i in range(80)]
    more = spark.createDataFrame(rows[len(odd_rows()) :], DOCS)
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    found = two_fit.pack_documents(docs, path, group_pieces=group_pieces).collect()
    check_packing(rows, found, two_fit.CAPACITY, plain)
    if group_pieces > len(found):
        wanted = plain_two_fit([r.length for r in found], two_fit.CAPACITY)
        assert len({r.sequence_id for r in found}) == len(wanted)
    assert two_fit.pack_documents(no_docs, path).count() == 0


def plain_variants(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            crc = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if crc % 199 == 0:
                run = run[: crc % len(run)] + run[crc % len(run) + 1 :]
            counts[run] += len(run) >= 6
    counts = {w: n for w, n in counts.items() if n >= 5}
    holes = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            holes[(w[:i], w[i + 1 :])].add(w)
        for i in range(len(w) + 1):
            holes[(w[:i], w[i:])].add(w)
    near = defaultdict(set)
    for met in holes.values():
        for w in met:
            near[w] |= met
    form = {}
    for w, n in counts.items():
        near[w].discard(w)
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 5 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def spelled_rows():
    """Words of few letters with many near words, long ones, and chains of forms."""
    pick = random.Random(3)
    words = ["".join(pick.choice("abé") for _ in range(pick.randrange(5, 9))) for _ in range(400)]
    rows = [(i, " ".join(pick.choices(words, k=90))) for i in range(90)]
    chain = [("kettles", 5), ("kettless", 30), ("kettlesss", 160), ("kettlessss", 900)]
    rows += [(1000 + k, " ".join([w.upper() if k % 2 else w] * n)) for k, (w, n) in enumerate(chain)]
    giant = "xy" * 600
    rows += [(2000, f"{giant} {giant}z " * 7), (2001, f"{giant[:-1]}q. " * 6), (None, f"×÷ÀÿÀÿÀ-{giant}" * 5)]
    rows += [(3000 + i, "variant") for i in range(450)] + odd_rows()
    return rows


@pytest.mark.parametrize("list_words", [spelling.LIST_WORDS, 40])
def test_spelling_variants_against_all_neighbours(spark, list_words):
    rows = spelled_rows()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], f"{DOCS}, word string, n int")
    found = spelling.variants(docs, list_words=list_words)
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in found.select(columns).collect()]
    wanted = plain_variants(rows)
    assert len(found) == len(wanted) and set(found) == wanted
    assert any(form and root != form for _, form, root, *_ in wanted)
    assert max(near for *_, near, _ in wanted) > 5 and max(len(w) for w, *_ in wanted) > 1000


def test_spelling_of_nothing_and_too_short_words(spark, no_docs):
    assert spelling.variants(no_docs).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(no_docs, least_length=3)


def test_pivots_are_the_rarest_disjoint_pair():
    pick = random.Random(1)
    texts = ["".join(pick.choice("aabcé") for _ in range(pick.randrange(4, 12))) for _ in range(300)]
    often = np.array([pick.randrange(1, 50) for _ in range(1 << 16)])
    rank = np.empty(1 << 16, np.int64)
    rank[np.lexsort((np.arange(1 << 16), often))] = np.arange(1 << 16)
    gram, word, place, pivot = spelling.prefix_grams(spelling.Words(texts), rank, often)
    for w, text in enumerate(texts):
        codes = [ord(a) << 8 | ord(b) for a, b in zip(text, text[1:])]
        last = sorted(rank[c] for c in codes)[2]
        prefix = [p for p, c in enumerate(codes) if rank[c] <= last]
        assert place[word == w].tolist() == prefix
        ours = place[(word == w) & pivot].tolist()
        least = min(
            often[codes[p]] + often[codes[q]] for p in prefix for q in prefix if q - p >= 2
        )
        assert len(ours) == 2 and ours[1] - ours[0] >= 2
        assert sum(often[codes[p]] for p in ours) == least


def test_joined_checksums():
    pick = random.Random(2)
    pairs = [(pick.randbytes(pick.randrange(9)), pick.randbytes(pick.randrange(3000))) for _ in range(99)]
    before, after = (np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1))
    size = np.array([len(b) for _, b in pairs])
    joined = spelling.joined_crc(before, after, size).tolist()
    assert joined == [zlib.crc32(a + b) for a, b in pairs]
