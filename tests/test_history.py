"""History scans against Python's regular expressions over whole segments."""

import random
import re

import pytest

from basketlake.fixed_values import SECRET_PATTERNS
from basketlake.operators import textscan

FRAGMENTS = [
    "password", "  token \"", ":", "=", "'", "", "", "  ", "\t", "plain text", "'abcdefgh1'", "\"zyxwvuts99\"", "secret = ", "passwd='mysecret=\"abcdefgh12\"",
    "aws_secret_access_key", "= " + "aB3/" * 10, "AKIA" + "A1B2" * 4, "-----BEGIN RSA PRIVATE KEY-----", "Token: 'longenough1' password", "secret=", "'short'",
]


def expected(segments):
    return sorted(
        (place, text.count("\n", 0, m.start()) + 1, label, m[0][:60].replace("\n", " "))
        for place, text in segments
        for pattern, label in SECRET_PATTERNS
        for m in re.finditer(pattern, text)
    )


def found(spark, segments, block):
    rows = [line for place, text in segments for line in [f"diff --git a/{place} b/{place}", *text.split("\n")]]
    frame = spark.createDataFrame([("log", i // block, i, line) for i, line in enumerate(["lost token: 'abcdefgh1'", *rows])], "file string, block long, ord long, line string")
    return sorted((r["place"], r["line"], r["label"], r["snippet"]) for r in textscan.scan_history(frame.repartition(3)).collect())


@pytest.mark.parametrize("block", [1, 2, 7, 10_000])
def test_hits_over_lines_and_blocks(spark, block):
    rng = random.Random(block)
    segments = [(f"f{i}", "\n".join(rng.choice(FRAGMENTS) for _ in range(rng.randrange(1, 60)))) for i in range(12)]
    assert found(spark, segments, block) == expected(segments)
    assert any("\n" in m[0] for _, text in segments for p, _ in SECRET_PATTERNS for m in re.finditer(p, text))


def test_hit_across_line_20000_and_a_long_gap(spark):
    lines = ["x"] * 19_999 + ["password"] + [""] * 500 + [":", " ", "'abcdefgh1'", "y", "token='abcdefgh2'"]
    segments = [("long", "\n".join(lines))]
    assert found(spark, segments, 4_096) == expected(segments)
    assert [line for _, line, _, _ in expected(segments)] == [20_000, 20_505]


def test_frequent_pairs_equal_brute_force(spark, monkeypatch):
    """Pairs of long baskets and of rare products, with few slots, so that most pairs share one."""
    from itertools import combinations

    from basketlake.plans import recipes

    monkeypatch.setattr(recipes, "PAIR_SLOTS", 97)
    rng = random.Random(4)
    baskets = {i: {int(rng.paretovariate(0.7)) for _ in range(rng.randrange(1, 9))} for i in range(300)} | {300: set(range(1, 120)), 301: set(range(1, 90))}
    counts = {}
    for held in baskets.values():
        for pair in combinations(sorted(held), 2):
            counts[pair] = counts.get(pair, 0) + 1
    held = spark.createDataFrame([(b, "s", i) for b, items in baskets.items() for i in items], "basket long, store string, item long")
    for least in (1, 2, 5):
        got = {(r["left"], r["right"]): r["together"] for r in recipes.frequent_pairs(held, ["store", "basket"], "item", least).collect()}
        assert got == {pair: n for pair, n in counts.items() if n >= least}


@pytest.mark.parametrize("block", [1, 3, 11, 1_000])
def test_tenders_and_runs_in_two_reads(spark, block):
    """First named tender and number of every transaction, wherever blocks are cut; the log is read twice."""
    from itertools import groupby

    from basketlake.operators import lines

    rng = random.Random(block)
    rows = []
    for file in ("a", "b"):
        keys = [str(rng.randrange(3)) for _ in range(40)]
        log = [(k, *rng.choice([("TENDER 1", "cash"), ("tender", ""), ("ITEM", "4011"), ("TENDER 2", "Debit"), ("", "")])) for k in keys for _ in range(rng.randrange(1, 8))]
        rows += [(file, i // block, i, k, "1", "01/02/2001", f, v) for i, (k, f, v) in enumerate(log)]
    schema = "file string, block long, ord long, transaction_code string, terminal_code string, date string, key_function string, key_function_id string"
    frame = spark.createDataFrame(rows, schema).repartition(3)
    want = {}
    for file in ("a", "b"):
        own = [r for r in rows if r[0] == file]
        for number, (_, group) in enumerate(groupby(own, key=lambda r: r[3])):
            group = list(group)
            named = [r[7].upper() for r in group if r[6].upper().startswith("TENDER") and r[7]]
            want |= {(file, r[2]): (number, named[0] if named else "") for r in group}
    got = lines.tendered_runs(frame)
    assert {(r["file"], r["ord"]): (r["transaction_no"], r["tender_type"]) for r in got.collect()} == want
    old = lines.stamp_tender(lines.transaction_runs(frame)).select(*got.columns)
    assert sorted(map(tuple, old.collect())) == sorted(map(tuple, got.collect()))


def test_the_log_is_read_twice(spark, tmp_path):
    from basketlake.operators import lines

    schema = "file string, block long, ord long, transaction_code string, terminal_code string, date string, key_function string, key_function_id string"
    spark.createDataFrame([("a", 0, 0, "1", "1", "d", "ITEM", "1")], schema).write.parquet(str(tmp_path / "log"))
    plan = lines.tendered_runs(spark.read.parquet(str(tmp_path / "log")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") in (1, 2)
