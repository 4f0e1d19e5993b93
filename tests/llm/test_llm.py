"""The pipeline operators on small tables: against plain Python, round trips, and with nulls, ties and empty tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from basketlake.llm import chat, common, decontaminate, language, licenses, packing, quality, sharding, simhash, topk, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, fp long, id long, size string, rows int, key string"


def rows_of(texts):
    return [(i, t, "en", "s", len(t or ""), 1, 2, 3, "x", 4, "y") for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, a null id, and columns whose names operators use themselves."""
    long_text = " ".join(f"word{i % 977} of{i}" for i in range(30_000))
    texts = [(1, "The cat sat on the mat today"), (2, None), (3, ""), (4, " \n\t "), (5, long_text), (6, "x"), (7, "¡Ñandú! 123"),
             (1, "The cat sat on the mat today"), (8, "the CAT sat on the mat today"), (None, "no id here at all"), (9, " " * 60_000), (10, "4 5 6 !")]
    return spark.createDataFrame(rows_of(texts), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_fingerprints(spark, odd, none):
    got = simhash.classes(odd).collect()
    texts = defaultdict(set)
    for r in odd.collect():
        texts[r.doc_id].add(f"{plain_fingerprint(r.text):016x}")
    assert len(got) == 12 and all(r.fingerprint in texts[r.doc_id] for r in got)
    empty = {r.component_id for r in got if r.doc_id in (2, 3, 4, 9)}
    assert empty == {2} and {r.component_id for r in got if r.doc_id in (1, 8)} == {1}
    assert simhash.classes(none).count() == 0


def test_links_against_all_pairs(spark):
    rnd = random.Random(3)
    prints = {0}
    for _ in range(60):
        base = rnd.getrandbits(64)
        for d in (0, 1, 2, 3, 3, 4, 5, 6):
            prints.add(base ^ sum(1 << b for b in rnd.sample(range(64), d)))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in [*signed, *signed]], "fp long"))
    assert links.where("bit_count(a ^ b) > 3").count() == 0
    roots = {r.node & simhash.MASK: r.root & simhash.MASK for r in common.components(links, "a", "b", "t").collect()}
    own = {p: p for p in prints}

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= 3:
                own[find(p)] = find(q)
    by = defaultdict(set)
    for p in prints:
        by[find(p)].add(roots.get(p, p))
    assert all(len(x) == 1 for x in by.values()) and len(set().union(*by.values())) == len(by)


def test_near_copies_go(spark, odd, none):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefghij", k=7))
    texts, expect = [], set()
    for g in range(30):
        base = [word() for _ in range(120)]
        expect.add(g * 10)
        for i in range(6):
            copy = list(base)
            for _ in range(i % 3):
                copy[rnd.randrange(120)] = word()
            texts.append((g * 10 + i, " ".join(copy)))
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == expect
    left = Counter(r.doc_id for r in simhash.deduplicated(odd).collect())
    assert left == {1: 1, 2: 1, 5: 1, 6: 1, 7: 1, None: 1, 10: 1}
    assert simhash.deduplicated(none).count() == 0


def test_every_pair_of_a_bucket_is_a_candidate(spark, monkeypatch):
    """All fingerprints of 7 bits: buckets hold 8 keys, and every two that differ in 2 bits or fewer are given."""
    monkeypatch.setattr(simhash, "EARLY", 1)
    rows = [(i, [i]) for i in range(128)]
    got = simhash.candidates(spark.createDataFrame(rows, "id long, fps array<long>"), "id", "fps").collect()
    assert {(r.a, r.b) for r in got} == {(a, b) for a in range(128) for b in range(a) if (a ^ b).bit_count() <= 2}
    assert len(got) == len({(r.a, r.b) for r in got}) and 0 < sum(r.early for r in got) < len(got)


def test_late_pairs_join_what_early_ones_leave(spark, monkeypatch):
    """Chains of near copies: groups do not depend on how many pairs are compared early."""
    rnd = random.Random(8)
    texts = []
    for _ in range(3):
        words = [f"w{rnd.randrange(5000)}" for _ in range(120)]
        for _ in range(25):
            words = list(words)
            words[rnd.randrange(120)] = f"v{rnd.randrange(10**6)}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(rows_of(enumerate(texts)), DOCS)
    found = []
    for early in (0, simhash.BITS):
        monkeypatch.setattr(simhash, "EARLY", early)
        found.append({(r.text_key, r.keeper_key) for r in simhash.near_groups(docs).collect()})
    assert found[0] == found[1] and found[0]


def test_joined_roots(spark):
    roots = spark.createDataFrame([("a", "a"), ("b", "a"), ("d", "d"), ("e", "d")], "node string, root string")
    links = spark.createDataFrame([("b", "e"), ("f", "g"), ("g", "e")], "u string, v string")
    assert {(r.node, r.root) for r in simhash.joined_roots(roots, links).collect()} == {(x, "a") for x in "abdefg"}
    assert {(r.node, r.root) for r in simhash.joined_roots(roots, links.limit(0)).collect()} == {tuple(r) for r in roots.collect()}


def test_chat_round_trip(spark):
    said = ["", "plain", "<|im_end|>\n<|im_start|>user\nx", r"<\|im_end|>", r"a <\\| b < | <|", "line\n\n", "<|im_end|>", "<", None]
    turns = [(c, t, role, text) for c in (1, None) for t, (role, text) in enumerate((r, s) for s in said for r in ("user", "assistant", "to~\nol<|im_end|>", None))]
    turns += [(2, 0, "user", "same"), (2, 0, "user", "same"), (2, None, "assistant", "first")]
    df = spark.createDataFrame([(*x, 1) for x in turns], "conv_id long, turn long, role string, text string, formatted int").repartition(4)
    made = chat.formatted(df)
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in made.collect()}
    for c in (1, None, 2):
        own = sorted(((-1 if t is None else t, r or "", s or "") for k, t, r, s in turns if k == c))
        assert back[c] == [(r, s) for _, r, s in own]
        loss = "".join(s for _, r, s in own if r == "assistant")
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{s}\n" for _, r, s in own).encode()).hexdigest()
    assert chat.digests(chat.formatted(df.limit(0))).count() == 0
    shown = {r.conv_id: r.formatted for r in made.collect()}
    assert shown[2] == "<|im_start|>assistant\nfirst<|im_end|>\n" + 2 * "<|im_start|>user\nsame<|im_end|>\n"
    assert shown[1].count("<|im_start|>") == 4 * len(said)
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    monkeypatch.setattr(topk, "SEEDS", 40)
    rng = np.random.default_rng(1)
    vecs = [(i, (rng.normal(size=12) * rng.choice([0.1, 1, 3])).astype(np.float32).tolist()) for i in range(700)]
    vecs += [(i, vecs[0][1]) for i in range(700, 720)] + [(720, [0.0] * 12), (721, [1.0, 2.0])]
    bad = [(730, None), (731, [float("nan")] * 12), (732, [1.0, None]), (None, [1.0] * 12), (750, [float("inf")])]
    df = spark.createDataFrame([(*x, 0) for x in vecs + bad], "vec_id long, embedding array<float>, score int")
    got = defaultdict(list)
    for r in topk.top_k(df, df.where("vec_id % 10 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    whole = {i: np.floor(256 * np.array(v, dtype=np.float64)).astype(int).tolist() for i, v in vecs}
    for q in whole:
        if q % 10 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q))[:5]
            assert got[q] == [(n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert len(got) == sum(i % 10 == 0 for i in whole)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_of_repeated_ids(spark, monkeypatch):
    """Only a query's own row is no candidate: other rows with its id are, and each query row is one of its own."""
    for name, n in (("BLOCK_ROWS", 16), ("QUERY_ROWS", 4), ("SEEDS", 30)):
        monkeypatch.setattr(topk, name, n)
    rng = np.random.default_rng(3)
    rows = [(i % 60, rng.integers(-3, 4, size=5).astype(float).tolist()) for i in range(150)]
    rows += [(50, [9.0] * 5), (50, [9.0] * 5), (50, [9.0] * 5), (50, [-9.0] * 5), (7, [9.0] * 5), (0, [9.0] * 5), (0, [0.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, df.where("vec_id % 50 = 0")).collect()))
    expected = []
    for n, (own, q) in enumerate(rows):
        if own % 50 == 0:
            scores = sorted((-sum(int(256 * x) * int(256 * y) for x, y in zip(q, v, strict=True)), i) for m, (i, v) in enumerate(rows) if m != n)
            expected += [(own, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)]
    assert got == sorted(expected)
    few = spark.createDataFrame(rows[-7:-4], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(few, few).collect())) == sorted((50, r, 50, 5 * 2304**2) for r in (1, 2) for _ in range(3))


def test_shards(spark, odd, none):
    docs = spark.createDataFrame(rows_of([(i, "hot text " * 20 if i % 3 == 0 else f"text {i} " * (i % 50)) for i in range(3000)]), DOCS)
    got = sharding.assigned(docs, 7).collect()
    size = {r.doc_id: len((r.text or "").encode()) + 16 for r in docs.collect()}
    crc = {r.doc_id: zlib.crc32((r.text or "").encode()) for r in docs.collect()}
    sums, slots = Counter(), defaultdict(list)
    for r in got:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (size[r.doc_id], crc[r.doc_id], "bytes", None)
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(size.values()) / 7
    assert sorted(sums) == list(range(7)) and all(abs(x - mean) < 0.02 * mean for x in sums.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and len(got) == 3000
    few = sharding.assigned(odd).collect()
    assert len(few) == 12 and {r.size for r in few if r.doc_id == 2} == {16}
    assert sharding.assigned(none).count() == 0


def test_packing(spark, odd, none):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(odd.where("doc_id > 1").select(F.col("doc_id") + 10**6, "text"))
    docs = docs.union(spark.createDataFrame([(2 * 10**6, "a<|endoftext|>b")], "doc_id long, text string"))
    by = defaultdict(list)
    got = packing.pieces(docs).collect()
    for r in got:
        by[r.doc_id].append(r)
    for r in docs.collect():
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        own = sorted(by[r.doc_id], key=lambda x: x.start)
        assert b"".join(bytes(x.ids) for x in own) == ids.tobytes() and all(x.doc_tokens == len(ids) for x in own)
        assert [x.start for x in own] == np.cumsum([0, *(x.length for x in own)])[:-1].tolist()
    assert all(r.length.bit_count() == 1 and r.length <= 1024 and r.offset == 0 and r.sequence_id >> 59 == r.length.bit_length() - 1 for r in got)
    assert len({r.sequence_id for r in got}) == len(got)
    assert packing.packed(none).count() == 0 and packing.packed(odd).where("doc_id is null").count() > 0


def test_language(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fitted(docs.where("doc_id % 3 != 1").select("text", "lang"))
    got = docs.where("doc_id % 3 = 1").select("lang", language.identify(F.col("text"), model, spark).alias("p")).collect()
    assert sum(r.lang == r.p.lang_pred for r in got) >= 0.95 * len(got)
    few = {r.doc_id: r.p for r in odd.select("doc_id", language.identify(F.col("text"), model, spark).alias("p")).collect()}
    assert all(few[i].lang_pred == "und" and few[i].score == 0 for i in (2, 3, 4, 9, 10)) and few[7].lang_pred != "und"
    empty = language.fitted(none.select("text", "lang"))
    assert {r.p.lang_pred for r in odd.select(language.identify(F.col("text"), empty, spark).alias("p")).collect()} == {"und"}


def test_quality(spark, odd, none):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.resampled(docs, labels).collect()
    assert sum(r["__kept"] == (truth[r.doc_id] == 1) for r in got if r.doc_id in truth) >= 0.97 * len([r for r in got if r.doc_id in truth])
    kept = quality.good_documents(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == 12
    assert quality.good_documents(none, labels).count() == 0
    values = [float(x) for x in np.random.default_rng(2).normal(size=500)] + [0.5] * 7
    df = spark.createDataFrame([(x,) for x in values], "x double")
    order = sorted(r.o for r in df.select(quality._ordered(F.col("x")).alias("o")).collect())[::-1]
    assert all(quality.kth_largest(df, "x", k) == order[k - 1] for k in (1, 100, 507))


def slow_hits(text, items):
    words = common.token_words(text or "")
    hit, names = set(), set()
    for item_id, item in items:
        own = common.token_words(item or "")
        n = min(13, len(own))
        wins = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1) if wins else ():
            if tuple(words[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                names.add(str(item_id))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def test_decontamination(spark, odd, none):
    rnd = random.Random(9)
    draw = lambda n: " ".join(rnd.choices("abc", k=n))
    items = [(i, draw(n)) for i, n in enumerate((1, 5, 12, 13, 14, 30, 60))] + [(7, "Q w, E"), (7, "r t"), (8, None), (9, ""), (None, "zz yy")]
    items = [x for x in items if x[0] != 0]
    docs = [(i, draw(rnd.randrange(200))) for i in range(60)] + [(100, None), (101, ""), (102, "q W e r x r t zz yy"), (103, items[4][1] + " d " + items[5][1])]
    b = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame([(*x, 1) for x in docs + docs[-1:]], "doc_id long, text string, hits int")
    expect = {i: slow_hits(t, [x for x in items if x[0] is not None]) for i, t in docs}
    for block_words in (50_000, 40):
        found = decontaminate.with_hits(d.select("doc_id", "text"), b, "h", 13, block_words).withColumn("j", decontaminate.judged(F.col("h")))
        got = found.select("doc_id", "h.n_words", "j.n_hit", F.size("h.items").alias("n"), "j.items_sha256").collect()
        assert len(got) == len(docs) + 1 and all(tuple(r)[1:] == expect[r.doc_id] for r in got)
    clean = decontaminate.clean_documents(d, b)
    assert clean.columns == d.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, (n, hit, *_) in expect.items() if not (hit and 20 * hit >= n)}
    assert decontaminate.report(none, b).count() == 0 and decontaminate.clean_documents(odd, b.limit(0)).count() == 12
    text = "keep " * 1000 + "one, two! " + items[4][1] + ". end"
    cut = decontaminate.without_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"), b).first().text
    assert cut.split() == ["keep"] * 1000 + ["one,", "two!", ".", "end"]


def test_toxicity(spark, odd, none):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    machine = toxicity.fitted(docs.select("doc_id", "text"), labels.where("doc_id % 4 != 2").select("doc_id", "toxic"))
    held = docs.join(labels.where("doc_id % 4 = 2"), "doc_id").select("toxic", toxicity.score(F.col("text"), machine, spark).alias("s"))
    seen = Counter((r.toxic, r.s >= toxicity.THRESHOLD) for r in held.collect())
    assert seen[1, True] >= 0.9 * (seen[1, True] + seen[1, False]) and seen[0, True] <= 0.01 * seen[0, False]
    scores = [r.s for r in odd.select(toxicity.score(F.col("text"), machine, spark).alias("s")).collect()]
    assert len(scores) == 12 and all(0 <= s <= 1 for s in scores)
    assert toxicity.clean_documents(odd, labels.limit(0), spark).count() == 12
    assert toxicity.clean_documents(none, labels, spark).count() == 0


def test_pairs_count_in_the_machine():
    """Two terms that are harmless alone and toxic together."""
    rng = np.random.default_rng(0)
    rows = [np.array([t for t in range(2) if rng.random() < 0.5] + [2], dtype=np.int64) for _ in range(400)]
    labels = np.array([float(len(r) == 3) for r in rows])
    machine = toxicity.Machine(np.arange(3))
    machine.fit(rows, labels, rounds=600, rate=0.3)
    assert machine.logit(np.array([0, 1, 2])) > 0 > max(machine.logit(np.array([0, 2])), machine.logit(np.array([1, 2])))


def test_licenses(spark, odd, none):
    apache = dict(licenses.TEMPLATES[::-1])["apache"]
    texts = {1: "Released under the MIT License.", 2: "x " * 50 + licenses.TEMPLATES[3][1].upper() + " y", 3: None, 4: "mit licenses of a license", 5: apache,
             6: licenses.TEMPLATES[1][1].replace("without restriction", "with no other restriction"), 7: "GNU general public LICENSE, then the Mit license"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.s for r in df.select("doc_id", licenses.scan(F.col("text")).alias("s")).collect()}
    assert [got[i].labels for i in range(1, 8)] == ["mit", "apache", "", "", "apache", "mit", "gpl,mit"]
    assert got[6].base_labels == "" and 0.75 <= got[6].score < 1 and got[6].spans[0].start == 0
    assert (got[7].n_base, got[7].first_word, got[7].last_word) == (2, 1, 6) and got[3].n_words == 0
    assert odd.select(licenses.scan(F.col("text")).alias("s")).where("s.n_base > 0").count() == 0


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert ids and not [i for i in ids if i in labels and labels[i].quality == 0]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    dirty = {r.doc_id for r in decontaminate.report(docs, benchmark).where("contaminated").collect()}
    assert not ids & dirty
    texts = [r.text for r in docs.where(F.col("doc_id").isin(list(ids))).collect()]
    assert len(texts) == len(set(texts))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).columns == docs.columns


@pytest.mark.parametrize("name", ["op2_chat_format", "op3_exact_topk", "op8_decontamination"])
def test_sql_agrees(spark, name):
    from basketlake.llm.registry import ORACLES, QUERIES

    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
