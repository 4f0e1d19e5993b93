"""Basket sets in rollups: exact distinct counts over any span, equal to the detail's."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from basketlake.operators import baskets
from basketlake.plans import reports, search
from basketlake.session import stored
from basketlake.sources import sample

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark):
    return sample.lake(spark, SF)


def rows_of(frame):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in frame.collect()]


@pytest.mark.parametrize("report", [
    lambda lake: reports.tender_analysis(lake, "all_time").orderBy("tender_type"),
    lambda lake: reports.tender_analysis(lake, "this_year", "card").orderBy("tender_type"),
    lambda lake: reports.seasonal_trends(lake, "all_time", department="frozen").orderBy("label"),
    lambda lake: reports.store_comparison(lake, "all_time", "avg_basket"),
    lambda lake: search.search_items(lake, "old widgets", "all_time"),
    lambda lake: search.search_items(lake, "old widgets", "all_time", group_duplicates=False),
    lambda lake: search.search_barcode_catalogue(lake, "000-00123", "all_time"),
])
def test_rollups_answer_as_the_detail_does(lake, report):
    fast, plain = report(lake), report(replace(lake, rollup_item=None, rollup_dept=None))
    read = [f for f in fast._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in f]
    assert read and not any("/detail-" in line for line in read)
    assert rows_of(fast) == rows_of(plain)


def lines(spark):
    rows = [
        ("T1", "A", "2026-01-01 10:00:00", "x"), ("T1", "A", "2026-01-01 10:00:00", "y"), ("T2", "A", "2026-01-01 11:00:00", "x"),
        ("T1", "A", "2026-01-02 00:10:00", "x"), ("T1", "B", "2026-01-03 09:00:00", "y"), ("T3", "B", "2026-01-03 09:00:00", None),
        (None, "B", "2026-01-03 09:00:00", "z"),
    ]
    frame = spark.createDataFrame(rows, "transaction_id string, store_id string, ts string, grp string")
    return frame.withColumn("transaction_ts", F.to_timestamp_ntz("ts")).drop("ts")


def test_a_basket_on_several_days_counts_once(spark):
    detail = lines(spark)
    numbers = stored(baskets.new_baskets(detail), "numbers")
    assert numbers.count() == 3 and numbers.select("basket_no").distinct().count() == 3
    daily = detail.join(numbers, "transaction_id", "left").groupBy(F.to_date("transaction_ts").alias("day"), "grp").agg(
        F.collect_set("basket_no").alias("baskets")
    )
    got = {r.grp: r.baskets for r in baskets.grouped(daily, ["grp"], [F.count("*").alias("rows")]).collect()}
    assert got == {"x": 2, "y": 1, None: 1, "z": 0}
    assert got == {r.grp: r.baskets for r in baskets.grouped(detail, ["grp"], [F.count("*").alias("rows")]).collect()}
    assert baskets.count_baskets(daily).collect()[0].baskets == 3
    nothing = daily.where("false")
    assert baskets.grouped(nothing, ["grp"], [F.count("*").alias("rows")]).collect() == []


def test_known_baskets_keep_their_numbers(spark):
    detail = lines(spark)
    first = stored(baskets.new_baskets(detail.where("grp = 'x'")), "numbers")
    second = stored(baskets.new_baskets(detail, first), "numbers")
    old, new = ({r.transaction_id: r.basket_no for r in f.collect()} for f in (first, second))
    assert set(old) == {"T1", "T2"} and set(new) == {"T3"}
    assert new["T3"] // 32768 > max(old.values()) // 32768
    empty = stored(baskets.new_baskets(detail.where("false")), "numbers")
    assert empty.count() == 0 and baskets.new_baskets(detail, empty).count() == 3


def test_many_numbers_in_many_bitmaps(spark):
    rows = spark.range(200_000).select((F.col("id") % 3).alias("k"), F.array(F.col("id"), F.col("id") + 3, F.col("id") * 7).alias("baskets"))
    got = {r.k: r.baskets for r in baskets.count_baskets(rows, "k").collect()}
    want = rows.select("k", F.explode("baskets").alias("n")).groupBy("k").agg(F.count_distinct("n").alias("n"))
    assert got == {r.k: r.n for r in want.collect()}
