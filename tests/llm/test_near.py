"""Near copies: every pair of similar texts is found, whatever the edit, the length or the order of words."""

import ctypes
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlake.llm import simhash

DOCS = "doc_id long, text string"


def shingled(text, k=5):
    words = text.encode().lower().split()
    return set(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else set()


def alike(x, y, least=0.8):
    return len(x & y) >= least * len(x | y)


def groups_of(texts):
    """Groups of doc_ids by all pairs."""
    sets, root = [shingled(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if find(i) != find(j) and alike(sets[i], sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in range(len(texts))}


def kept(spark, texts):
    rows = list(enumerate(texts))
    return {r.doc_id for r in simhash.deduplicated(spark.createDataFrame(rows, DOCS)).collect()}


def cut(words, rnd, new):
    return words[: -(-len(words) * 84 // 100)]


def extended(words, rnd, new):
    return [*words, *(new() for _ in range(len(words) * 20 // 100))]


def last_word(words, rnd, new):
    return [*words[:-1], new()]


def scattered(words, rnd, new):
    at = set(rnd.sample(range(len(words)), max(1, len(words) // 60)))
    return [new() if i in at else w for i, w in enumerate(words)]


@pytest.mark.parametrize("edit", [cut, extended, last_word, scattered])
def test_copies_of_any_kind_are_found(spark, edit):
    rnd = random.Random(4)
    new = lambda: "".join(rnd.choices("abcdefghij", k=6))
    texts = []
    for n in (15, 25, 40, 80, 200, 700):
        for _ in range(12):
            words = [new() for _ in range(n)]
            texts += [" ".join(words), " ".join(edit(words, rnd, new))]
    roots = groups_of(texts)
    assert edit is scattered or sum(roots[i] != i for i in roots) >= 60
    assert kept(spark, texts) == set(roots.values())


def test_orders_of_the_same_words_keep_their_own_copies(spark):
    """50 orders of one set of words, each with a near copy: 50 stay."""
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(100)]
    texts = []
    for _ in range(50):
        rnd.shuffle(words)
        texts += [" ".join(words), " ".join([*words[:-2], words[-1], words[-2]])]
    assert kept(spark, texts) == set(range(0, 100, 2)) == set(groups_of(texts).values())


def test_near_copies_around_the_bound(spark, monkeypatch):
    """One group of near copies about as unlike as they may be, with a passage that other texts have, too."""
    monkeypatch.setattr(simhash, "COMMON_IN", 2)
    monkeypatch.setattr(simhash, "EARLY", 2)
    rnd = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(60):
        words = list(base)
        for _ in range(rnd.randrange(6)):
            words[rnd.randrange(120)] = f"v{rnd.randrange(10**6)}"
        texts += [" ".join(words), " ".join([*base[:40], *(f"x{i}.{j}" for j in range(90))])]
    roots = groups_of(texts)
    assert len(set(roots.values())) < 110 and kept(spark, texts) == set(roots.values())


def test_wordless_and_short_texts(spark):
    texts = ["", " \n", "\t", "a b", "A  B", "a b c", "a", "a"]
    assert kept(spark, texts) == {0, 3, 5, 6}


def test_simhash_proposes_before_prefixes(spark, monkeypatch):
    """Copies with one word changed in 700 are linked by fingerprints alone; an unlike text is not."""
    rnd = random.Random(9)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(700)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(words[::-1]), " ".join(words)]
    rows = list(enumerate(texts))
    monkeypatch.setattr(simhash, "members", lambda docs, k, least: no_members(spark))
    got = {r.doc_id for r in simhash.deduplicated(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {0, 2}


def no_members(spark):
    return simhash.stored(spark.createDataFrame([], "key long, id long, size int, reach int"), "none")


def test_later_turns_compare_members_of_different_groups(spark):
    """Every member of a smaller group meets members of the other one before all pairs are made."""
    held = spark.createDataFrame([(1, i, 10, 10) for i in range(12)], "key long, id long, size int, reach int")
    groups = spark.createDataFrame([(i, i // 6 * 6) for i in range(12)], "id long, root long")
    for turn in (1, 2):
        pairs = {(r.a, r.b) for r in simhash.early_pairs(held, 0.8, groups, turn).collect()}
        assert pairs and len(pairs) <= 12 * simhash.EARLY and all(a // 6 != b // 6 for a, b in pairs)


def test_unlike_texts_of_one_bucket_do_not_all_become_pairs(spark, monkeypatch):
    """150 texts with a passage in common, 20 of them with a near copy: the last turn proposes hardly more than those."""
    rnd = random.Random(12)
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join([*passage, *(f"x{i}.{j}" for j in range(60))]) for i in range(150)]
    texts += [t.rsplit(" ", rnd.randrange(1, 9))[0] for t in texts[:20]]
    monkeypatch.setattr(simhash, "COMMON_IN", 10**9)
    monkeypatch.setattr(simhash, "TURNS", 0)
    monkeypatch.setattr(simhash, "EARLY", 0)
    monkeypatch.setattr(simhash, "print_pairs", lambda docs: simhash.stored(spark.createDataFrame([], "a long, b long"), "none"))
    made, compare = [], simhash.similar_pairs
    monkeypatch.setattr(simhash, "similar_pairs", lambda docs, pairs, k, least: made.append(pairs.count()) or compare(docs, pairs, k, least))
    assert kept(spark, texts) == set(range(150))
    assert 20 <= made[-1] <= 40


def test_parities_of_similar_sets_always_pass(spark):
    """Texts of 5 to 4,000 words at and above the bound: what parities say never excludes a similar pair."""
    rnd = random.Random(13)
    rows = []
    for n in (5, 30, 100, 500, 1500, 4000):
        for cut_to in (0.8, 0.81, 0.9, 1.0):
            words = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
            rows.append((" ".join(words), " ".join(words[: round(n * cut_to) or 1])))
    df = spark.createDataFrame([(i, *r, len(shingled(r[0])), len(shingled(r[1])), alike(*map(shingled, r))) for i, r in enumerate(rows)], "i int, s string, t string, m int, n int, alike boolean")
    sides = df.select("alike", *[F.struct(F.col(size).alias("size"), simhash.parity(F.col(text), 5).alias("odd")).alias(side) for side, text, size in (("x", "s", "m"), ("y", "t", "n"))])
    got = sides.select("alike", simhash._may_differ("x", "y", 0.8).alias("may")).collect()
    assert sum(r.alike for r in got) >= 15 and all(r.may for r in got if r.alike)


def test_workers_give_freed_memory_back():
    """Each step of the stage first gives back what the last one left to the C library."""
    libc = ctypes.CDLL(None)
    libc.malloc.restype, libc.free.argtypes = ctypes.c_void_p, [ctypes.c_void_p]

    def held():
        return int(re.search(r"VmRSS:\s+(\d+)", open("/proc/self/status").read()).group(1)) // 1024

    def left_behind():
        blocks = [libc.malloc(60_000) for _ in range(2_000)]
        for b in blocks:
            ctypes.memset(b, 1, 60_000)
        for b in blocks[:-1]:
            libc.free(ctypes.c_void_p(b))
        return blocks[-1]

    made = []
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(simhash.F, "arrow_udf", lambda kind: lambda f: made.append(f) or (lambda *columns: None))
        simhash.fingerprint(None), simhash.shingle_set(None, 5), simhash.text_histogram(None, 5), simhash.parity(None, 5)
    assert len(made) == 4
    for step in made:
        last, before = left_behind(), held()
        step(pa.array(["one two three four five six", None]))
        assert held() < before - 80
        libc.free(ctypes.c_void_p(last))
