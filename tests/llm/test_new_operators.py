"""Spelling variants, piece offsets and structure repair against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from basketlake.llm import pieces, repair, simhash, spelling

SF = "/root/testdata/sf0.001"


def near_by_brute_force(words):
    """Pairs that share a word with one code point gone, checked by their edit distance."""
    buckets = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            buckets[w[:i] + w[i + 1 :]].add(w)
        buckets[w].add(w)
    return {(a, b) for group in buckets.values() for a in group for b in group if a < b and one_edit(a, b)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_brute_force(counts):
    near = defaultdict(list)
    for a, b in near_by_brute_force(counts):
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 5 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def random_words(seed, letters, number):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))): rng.choice([5, 6, 30, 40, 200, 1500]) for _ in range(number)}
    for w in list(words)[: number // 3]:
        i = rng.randrange(len(w))
        words.setdefault(rng.choice([w[:i] + w[i + 1 :] + "zz", w[:i] + "z" + w[i:], w[:i] + "z" + w[i + 1 :]]), rng.choice([5, 7]))
    return words


@pytest.mark.parametrize("letters", ["ab", "abcdé", "abcdefghijklmnopqrstuvwxyzÿ"])
def test_variants_equal_brute_force(spark, letters):
    counts = random_words(7, letters, 900)
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(rows).collect()} == variants_by_brute_force(counts)


@pytest.mark.parametrize("frequent, most", [(1, 400_000), (5, 400_000), (40, 60), (0, 3)])
def test_any_dictionary_gives_all_pairs(spark, frequent, most):
    counts = random_words(frequent, "abc", 500)
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = spelling.near_pairs(rows, spelling.gram_dictionary(rows, frequent, most))
    assert {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in found.collect()} == near_by_brute_force(counts)
    assert found.count() == len(near_by_brute_force(counts))


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=6, max_size=12), st.sets(st.text("ab^$", min_size=2, max_size=5), max_size=40), st.data())
def test_one_edit_leaves_the_promised_grams(word, some, data):
    grams = {g[:q]: 1 for g in some for q in range(2, len(g) + 1)}
    i = data.draw(st.integers(0, len(word)))
    other = data.draw(st.sampled_from([word[:i] + c + word[i + k :] for c in ("", "a", "b", "c") for k in (0, 1)]))
    own, its = spelling.decompose(word, grams), spelling.decompose(other, grams)
    both = sum((Counter(g for g, _ in own.grams) & Counter(g for g, _ in its.grams)).values())
    assert both >= max(own.shared, its.shared) or word == other


def test_spelling_query_on_whole_table(spark):
    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            w = w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if n >= 5 and len(w) >= 6}
    assert {tuple(r) for r in entry.queries()["op11_spelling_variants"](spark, SF).collect()} == variants_by_brute_force(counts)


def test_spelling_odd_tables(spark):
    schema = "doc_id long, text string, n long, word string, key long"
    rows = [(1, None, 1, "x", 1), (None, "Éclair " * 5, 1, "x", 1), (2, "", 1, "x", 1), (2, "", 1, "x", 1), (3, "eclair " * 30_000, 1, "x", 1), (4, "éclair", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    counts = {r["word"]: r["n"] for r in spelling.counted_words(docs, None).collect()}
    assert counts == {"eclair": 30_000, "Éclair": 5}
    found = {r["word"]: r for r in spelling.variants(spelling.counted_words(docs, None)).collect()}
    assert found["Éclair"]["form"] == "eclair" and found["Éclair"]["root"] == "eclair" and found["eclair"]["n_near"] == 1
    assert spelling.variants(spelling.counted_words(docs.limit(0))).count() == 0
    tie = spark.createDataFrame([("abcdef", 5), ("abcdeg", 25), ("abcdeh", 25)], "word string, n long")
    assert {r["word"]: r["form"] for r in spelling.variants(tie).collect()}["abcdef"] == "abcdeg"


MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY, OWN = SentencePieceProcessor(model_file=MODEL), pieces.Pieces(MODEL)


def check_pieces(text):
    ids, starts, ends = OWN.encode(text)
    assert ids.tolist() == LIBRARY.encode(text)
    if text:
        shown = LIBRARY.encode(text, return_type="proto").pieces
        assert [(p.begin, p.end) for p in shown] == list(zip(starts.tolist(), ends.tolist(), strict=True))
        assert starts[0] == 0 and ends[-1] == len(text.encode()) and (starts[1:] == ends[:-1]).all()


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab é ▁\n\t<s>0x0A 你好👍̀\x00ſß'.,12"), max_size=60) | st.text(max_size=40))
def test_pieces_equal_the_library(text):
    check_pieces(text)


@pytest.mark.parametrize("text", ["", " ", "   ", "\n", "a" * 5_000, "ab" * 3_000, " " * 4_000, "x" * 63 + " " + "y" * 65, "é" * 300 + "▁" * 300, "<unk></s>"])
def test_long_and_odd_texts(text):
    check_pieces(text)


def double_array(keys):
    """A compiled character map for a few keys: units placed one after another where their children fit."""
    units, used, texts, leaves = [0] * 4096, {0}, b"", {}
    for key, new in keys.items():
        leaves[key.encode()] = len(texts)
        texts += new.encode() + b"\0"
    todo = [(0, b"")]
    while todo:
        at, begin = todo.pop()
        nexts = sorted({k[len(begin)] for k in leaves if k.startswith(begin) and len(k) > len(begin)})
        children = nexts + ([0] if begin in leaves else [])
        base = next(b for b in range(1, 1024) if all((b ^ c ^ at) not in used for c in children) and b ^ at)
        for c in children:
            used.add(at ^ base ^ c)
        units[at] |= base << 10 | (256 if begin in leaves else 0)
        if begin in leaves:
            units[at ^ base] = 1 << 31 | leaves[begin]
        for c in nexts:
            units[at ^ base ^ c] |= c
            todo.append((at ^ base ^ c, begin + bytes([c])))
    data = np.array(units, dtype="<u4").tobytes()
    return len(data).to_bytes(4, "little") + data + texts


def test_character_map_takes_the_longest_key():
    own = pieces.Pieces(MODEL)
    own.map = pieces.CharacterMap(double_array({"ﬁ": "fi", "①": "1", "à": "à", "a": "A", "abc": "x", "​": ""}))
    normal, source = own.normalised("ﬁ àab abcd​①")
    assert normal == "▁fi▁àAb▁xd1"
    assert source.tolist() == [0, 0, 0, 3, 4, 7, 8, 9, 10, 13, 17, 20]
    own.trim = 1
    assert own.normalised("  ﬁ   b  ")[0] == "▁fi▁b" and own.normalised("   ")[0] == ""
    ids, starts, ends = own.encode("  ﬁ   b  ")
    assert starts[0] == 2 and (starts[1:] == ends[:-1]).all() and ids.tolist() == LIBRARY.encode("fi b")


def test_piece_query_and_odd_tables(spark):
    import __spark_entry__ as entry

    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = set()
    for doc_id, text in docs:
        ids = LIBRARY.encode(text)
        expected.add((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    assert {tuple(r) for r in entry.queries()["op12_piece_offsets"](spark, SF).collect()} == expected
    odd = spark.createDataFrame([(None, "a b", 1), (1, None, 2), (1, None, 2), (2, "", 3), (3, "x " * 100_000, 4)], "doc_id long, text string, ids long")
    rows = pieces.encoded(odd).collect()
    assert sorted((r["doc_id"] or 0, len(r["ids"]), len(r["decoded"])) for r in rows) == [(0, 2, 3), (1, 0, 0), (1, 0, 0), (2, 0, 0), (3, 100_001, 200_000)]
    assert pieces.encoded(odd.limit(0)).collect() == []


def cheapest_by_brute_force(initials, faults):
    """The least (cost, audit) of every place and state, improved until nothing changes."""
    needed, best, changed = [2, 2, 3, 2], {(0, 0): (0, "")}, True
    while changed:
        changed = False
        for (i, s), (cost, audit) in list(best.items()):
            moves = [(3, "I", i, needed[s])]
            if i < len(initials):
                moves.append((4, "D", i + 1, s))
                if faults[i] not in ("b", "d"):
                    late = 3 if faults[i] == "t" else 0
                    moves.append((3 + late, "R", i + 1, needed[s]))
                    if initials[i] and "^sua"[s] + initials[i] in ("^s", "^u", "su", "ua", "au"):
                        moves.append((late, "K", i + 1, "^sua".index(initials[i])))
            for price, edit, j, to in moves:
                new = (cost + price, audit + edit)
                if (j, to) not in best or new < best[j, to]:
                    best[j, to], changed = new, True
    return min(best[len(initials), s] for s in (0, 3) if (len(initials), s) in best)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "u", "a", "a", "x", ""]), st.sampled_from(["", "", "t", "b", "d"])), max_size=12))
def test_cheapest_edits_equal_brute_force(rows):
    initials, faults = [r[0] for r in rows], [r[1] for r in rows]
    assert repair.cheapest(initials, faults) == cheapest_by_brute_force(initials, faults)


def repaired_by_brute_force(rows):
    """All columns of the query, by plain Python over (conv_id, turn, role, text)."""
    groups = {}
    for conv_id, turn, role, text in rows:
        group = groups.setdefault(conv_id, [])
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        group += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = set()
    for conv_id, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in group:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("b" if not solid else "d" if (role, text) in seen else "" if solid[-1] in ".!?" else "t")
            seen.add((role, text))
        initials = [r[1][:1] for r in group]
        cost, audit = cheapest_by_brute_force(initials, faults)
        turns = [r[0] for r in group if r[0] is not None]
        said, state, left = [], 0, iter(group)
        for edit in audit:
            _, role, text = next(left) if edit != "I" else (None, "", "")
            if edit != "D":
                state = "^sua".index(role[0]) if edit == "K" else [2, 2, 3, 2][state]
                said.append(f"{role if edit == 'K' else ['', '', 'user', 'assistant'][state]}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out.add((conv_id, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return out


def test_repair_query_equals_brute_force(spark):
    import __spark_entry__ as entry

    for folder in (SF, "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert {tuple(r) for r in entry.queries()["op13_structure_repair"](spark, folder).collect()} == repaired_by_brute_force(rows)


def test_repair_odd_tables(spark):
    rng = random.Random(3)
    words = ["Yes.", "No", "", " \t", "What?", None, "Yes.", "A\nb!"]
    rows = [
        (rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(["user", "assistant", "system", "tool", "", None, "a"]), rng.choice(words))
        for _ in range(120)
    ]
    rows += [(77, i, "user" if i % 2 else "assistant", f"Line {i % 900}.") for i in range(3_000)] + [(78, 0, "user", "x" * 100_000 + ".")]
    turns = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, cost long, audit string, turn_row long")
    found = repair.repaired(repair.damaged(turns), turns)
    assert {tuple(r) for r in found.collect()} == repaired_by_brute_force(rows)
    assert repair.repaired(turns.limit(0)).collect() == []
    kept = repair.repaired_turns(turns, repair.plans(turns).where("conv_id = 77")).orderBy("turn").collect()
    assert re.fullmatch("(ua)*", "".join(r["role"][0] for r in kept)) and [r["turn"] for r in kept] == list(range(len(kept)))
    gone = spark.createDataFrame([(9, 9, "user", "x")], "conv_id long, turn long, role string, text string")
    empty = repair.repaired(gone.limit(0), gone).collect()
    assert [tuple(r) for r in empty] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_histograms_bound_what_sets_share(spark):
    rng = random.Random(2)
    rows = [(sorted(rng.sample(range(-300, 300), rng.randrange(0, 200))), sorted(rng.sample(range(-300, 300), rng.randrange(0, 200)))) for _ in range(80)]
    rows += [([], []), ([128 * i for i in range(70_000)], [128 * i for i in range(66_000)])]
    frame = spark.createDataFrame(rows, "x array<long>, y array<long>")
    bound = simhash.may_share(simhash.histogram(frame.x), simhash.histogram(frame.y))
    for x, y, most in frame.select("x", "y", bound).collect():
        assert len(set(x) & set(y)) <= most <= min(len(x), len(y)) or most == float("inf") and len(x) > 255


def test_prefixes_with_a_bitmap_keep_what_is_in_it(spark):
    """Keys and places of the whole prefix whose upper bits are in the bitmap, and no others; histograms as of the sets."""
    from basketlake.llm.common import bitmap

    texts = spark.createDataFrame([(" ".join(f"w{i * j}" for i in range(60)),) for j in range(1, 30)] + [("",), (None,)], "text string")
    common = spark.createDataFrame([], "key long, n long")
    whole = texts.select(simhash.prefix(F.col("text"), 5, 0.8, common).alias("p"))
    keys = sorted({k for r in whole.collect() for k in r.p["keys"]})
    kept = {k >> 32 for k in keys[::3]}
    bits = bitmap(spark.createDataFrame([(s,) for s in kept], "slot long"), F.col("slot"), simhash.SHARED_BITS)
    slots = {s % simhash.SHARED_BITS for s in kept}
    some = texts.select(simhash.prefix(F.col("text"), 5, 0.8, common, bits).alias("p")).collect()
    for full, part in zip(whole.collect(), some, strict=True):
        wanted = [(k, i) for i, k in enumerate(full.p["keys"]) if (k >> 32) % simhash.SHARED_BITS in slots]
        assert list(zip(part.p["keys"], part.p["pos"], strict=True)) == wanted and part.p["size"] == full.p["size"]
    sets = texts.select(simhash.shingle_set(F.col("text"), 5).alias("s"), simhash.text_histogram(F.col("text"), 5).alias("h"))
    for row in sets.select(F.size("s").alias("n"), simhash.histogram(F.col("s")).alias("bars"), "h").collect():
        assert (row.h.n, row.h.bars) == (row.n, row.bars)
