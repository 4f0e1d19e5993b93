"""Operators against brute force on small data."""

import datetime as dt
import itertools
import re
import statistics

import pytest
from pyspark.sql import functions as F

from basketlake.functions import dates, text
from basketlake.fixed_values import SECRET_PATTERNS
from basketlake.operators import guard, resolve, skew, textscan
from basketlake.plans import recipes
from basketlake.plans.lake import Lake
from basketlake.plans.search import query_barcode, query_terms, stem_word
from basketlake.sources import sample

SF = "/root/testdata/sf0.001"


def test_median_and_positions_of_a_hot_group(spark):
    data = [("hot", float(i % 37)) for i in range(2000)] + [("cold", 1.0), ("cold", 2.5)]
    frame = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.m for r in skew.group_median(frame, ["g"], "v", F.floor(F.col("v") / 5), "m").collect()}
    for g in ("hot", "cold"):
        assert got[g] == statistics.median(v for k, v in data if k == g)


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    dim = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    plain = facts.join(dim, ["k"], "left").orderBy("id").collect()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        assert skew.left_join(facts, dim, ["k"], ["id"]).orderBy("id").collect() == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_affinity_equals_brute_force(spark):
    lake = sample.lake(spark, SF)
    rows = lake.detail.where("transaction_type = 'SALE'").select("transaction_id", "product_key").distinct().collect()
    baskets = {}
    for r in rows:
        baskets.setdefault(r.transaction_id, set()).add(r.product_key)
    together = {}
    for held in baskets.values():
        for pair in itertools.combinations(sorted(held), 2):
            together[pair] = together.get(pair, 0) + 1
    support = {}
    for held in baskets.values():
        for p in held:
            support[p] = support.get(p, 0) + 1
    keep = {p for p, n in support.items() if n >= 0.03 * len(baskets)}
    want = {pair: n for pair, n in together.items() if set(pair) <= keep}
    got = {(r.left_product, r.right_product): r.together for r in recipes.basket_affinity(lake, "all_time", 0.03).collect()}
    assert want and got == want


def test_periods_agree_with_their_columns(spark):
    start = dt.date(2004, 2, 20)
    days = [start + dt.timedelta(days=7 * i) for i in range(12)] + [dt.date(2004, 2, 29)]
    rows = [(d, p) for d in days for p in (*dates.PERIODS, "whatever")]
    frame = spark.createDataFrame(rows, "as_of date, period string")
    first, last = dates.period_bound_columns(F.col("period"), F.col("as_of"), F.lit(dates.DEFAULT_HISTORY_START))
    for r in frame.select("*", first.alias("a"), last.alias("b")).collect():
        assert (r.a, r.b) == dates.period_bounds(r.period, r.as_of)
    assert dates.years_back(dt.date(2004, 2, 29), 1) == dt.date(2003, 2, 28)


def test_words(spark):
    words = ["strawberries", "strawberry", "peaches", "glasses", "oz", "berry", "dishes", "bananas"]
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in frame.select(text.stem(F.col("w"))).collect()] == [stem_word(w) for w in words]
    assert query_terms("how many strawberries, 16 oz") == ["strawberr", "16", "oz"]
    assert query_barcode("071-57562") == "7157562" and query_barcode("16 oz 12345") is None


def test_department_names():
    assert resolve.department_code(" Frozen Food ") == "21" and resolve.department_code("16") == "16"
    assert resolve.department_code("nowhere") is None


def test_guard(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20).select((F.col("id") % 2 + 2000).alias("year"), "id").write.partitionBy("year").parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("guarded_test")
    assert guard.guarded_sql(spark, "SELECT id FROM guarded_test WHERE year = 2001 LIMIT 99", 3).count() == 3
    for bad in (
        "DROP TABLE guarded_test", "SELECT 1; SELECT 2", "INSERT INTO guarded_test SELECT 1, 2", "",
        "SELECT sum(id) FROM guarded_test", "SELECT * FROM guarded_test WHERE year = 2001",
    ):
        with pytest.raises(guard.QueryRefused):
            guard.guarded_sql(spark, bad)
    with pytest.raises(guard.QueryRefused):
        guard.guarded_sql(spark, "SELECT 1", spent=5.0)


def test_secret_scan_lines_and_history(spark):
    secret = 'token = "0123456789abcdef"'
    body = f"one\n{secret}\nthree {secret}\n"
    texts = spark.createDataFrame([("p", body), ("q", "nothing")], "place string, text string")
    assert sorted(r.line for r in textscan.scan(texts).collect()) == [2, 3]
    allowed = spark.createDataFrame([("p",)], "place string")
    assert textscan.scan(texts, allowed).count() == 0
    log = ["x", "diff --git a/one b/one", "+a", f"+{secret}", "diff --git a/two b/two", "+b", f"+{secret}"]
    rows = [("log", i // 3, i, line) for i, line in enumerate(log)]
    frame = spark.createDataFrame(rows, "file string, block long, ord long, line string")
    got = {(r.place, r.line) for r in textscan.scan_history(frame).collect()}
    assert got == {("one", 2), ("two", 2)}


def test_all_patterns_in_one_scan(spark):
    """Hits of several patterns in one text, found as Python's own regular expressions find them."""
    key, words = "AKIA" + "A1B2" * 4, "password = 'abcdefgh1'"
    text = f"x\n{key} {key}\n\n{words}\n{key}\ntoken:\n 'zyxwvuts9'"
    texts = spark.createDataFrame([("p", text), ("q", "nothing"), ("r", None)], "place string, text string")
    found = textscan.scan(texts)
    expect = sorted(
        (text.count("\n", 0, m.start()) + 1, label) for pattern, label in SECRET_PATTERNS for m in re.finditer(pattern, text)
    )
    assert sorted((r.line, r.label) for r in found.collect()) == expect and len(expect) == 5


def test_routes():
    lake = Lake(detail=None, rollup_item="item", rollup_dept="dept")
    assert lake.route({"revenue", "tender_type"}) == "rollup_dept"
    assert lake.route({"revenue", "item_id"}) == "rollup_item"
    assert lake.route({"revenue", "transaction_id"}) == "detail"
    assert lake.only("rollup_item").route({"revenue", "sale_date"}) == "rollup_item"
