"""Cases that once gave wrong answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketlake.operators import catalogue, guard, lines
from basketlake.plans import recipes, reports, search
from basketlake.plans.lake import ADDITIVE, ITEM_ROLLUP_KEYS, ITEM_ROLLUP_LABELS, Lake
from basketlake.sources import raw_log, sample, sinks

SF = "/root/testdata/sf0.001"
DAY = dt.date(2026, 7, 1)


def test_a_split_month_keeps_baskets_whole(spark, tmp_path):
    """Parts far smaller than a month: as many runs as baskets, and every basket's tender on its lines."""
    key, old = "spark.sql.adaptive.advisoryPartitionSizeInBytes", None
    old = spark.conf.get(key)
    spark.conf.set(key, "8k")
    try:
        path = str(tmp_path / "log")
        sinks.write_log(sample.log_lines(spark, SF), path)
        runs = lines.transaction_runs(raw_log.read_log(spark, path)).cache()
        assert runs.select("file", "transaction_no").distinct().count() == 1500
        count = lambda log: {r.tender_type: r["count"] for r in lines.stamp_tender(log).groupBy("tender_type").count().collect()}
        whole = count(lines.transaction_runs(raw_log.parse_lines(sample.log_lines(spark, SF))))
        assert count(runs) == whole and len(whole) > 3
    finally:
        spark.conf.set(key, old)


def small_lake(spark, sold):
    columns = sorted({*ITEM_ROLLUP_KEYS, *ITEM_ROLLUP_LABELS, *ADDITIVE})
    base = spark.createDataFrame(sold, "item_id string, store_id string, category_name string, department_code string")
    known = {"item_id", "store_id", "category_name", "department_code"}
    rollup = base.withColumns({
        c: F.lit(DAY) if c == "sale_date" else F.lit("SALE") if c == "transaction_type"
        else F.lit(1) if c in ADDITIVE else F.lit("x") for c in columns if c not in known
    })
    items = spark.createDataFrame(
        [("0000000012345", "BREAD", 4.0, 2.0), ("67890", "MILK", 3.0, 1.0), ("000", "ZERO", 2.0, 1.0)],
        "item_id string, item_desc string, unit_price double, unit_cost double",
    ).withColumns({"department_name": F.lit("d"), "department_code": F.lit("11"), "category_name": F.lit("c")})
    return Lake(detail=None, catalogue=items, rollup_item=rollup, as_of=DAY)


def test_barcodes_agree_whatever_their_padding(spark):
    lake = small_lake(spark, [("00000000012345", "s", "c", "11"), ("00000000000000", "s", "c", "11")])
    assert {r.item_id for r in reports.dead_stock(lake).collect()} == {"67890", "000"}
    assert reports.dead_stock_summary(lake).first().unsold == 2
    slow = {r.item_id: r.units for r in recipes.slow_mover_capital(lake).collect()}
    assert slow == {"0000000012345": 1, "67890": 0, "000": 0}
    assert search.search_not_sold(lake, "bread").count() == 0


def test_a_category_is_named_over_the_whole_period(spark):
    """An exact name sold in another store is not passed over for a longer name sold in this one."""
    lake = small_lake(spark, [("1", "a", "TEA", "11"), ("2", "b", "TEA BAGS", "11")])
    rows = reports.sales(lake, "last_30_days", ("units",), store_id="b", category="tea")
    assert rows.count() == 0
    assert reports.sales(lake, "last_30_days", ("units",), store_id="b", category="tea b").count() == 1


def test_barcodes_that_pad_alike_stay_two_rows(spark):
    book = sample.price_book(spark, SF).limit(1)
    good = catalogue.build_items(sample.price_book(spark, SF)).orderBy("ord").first()
    one = sample.price_book(spark, SF).where(F.col("ord") == good.ord)
    dashed = [c for c in book.columns if "dash" in c.lower()][0]
    two = one.withColumn(dashed, F.lit("012345678905")).unionByName(one.withColumn(dashed, F.lit("12345678905")).withColumn("ord", F.col("ord") + 1))
    built = catalogue.build_items(two).count()
    assert catalogue.item_master(two).count() == built


def test_names_of_the_price_book(spark):
    names = {r.department_code: r.department_name for r in catalogue.build_items(sample.price_book(spark, SF)).select("department_code", "department_name").distinct().collect()}
    assert all(names[c] == n for c, n in {"30": "Reusable Bags", "34": "Gift"}.items() if c in names)
    assert {"30", "34"} & set(names)


def test_guard_looks_into_subqueries(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20).withColumn("year", F.col("id") % 2).write.partitionBy("year").parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("guarded_t")
    for sql in ("SELECT (SELECT sum(id) FROM guarded_t) AS s", "SELECT 1 AS x WHERE EXISTS (SELECT 1 FROM guarded_t WHERE id > 3)"):
        with pytest.raises(guard.QueryRefused):
            guard.guarded_sql(spark, sql)
    assert guard.guarded_sql(spark, "SELECT sum(id) AS s FROM guarded_t WHERE year = 1").first().s == 100
    assert guard.guarded_sql(spark, "SELECT 1 AS x").count() == 1


def test_stored_tables_leave_no_shuffle_files(spark):
    """The shuffle of a stored table goes with the write; the setting is as before, and the frame can be run again."""
    from basketlake.session import SHUFFLE_CLEANUP_KEY, stored

    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before, setting = tracker.shuffleStatuses().size(), spark.conf.get(SHUFFLE_CLEANUP_KEY, None)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    table = stored(counts, "counts")
    assert tracker.shuffleStatuses().size() <= before
    assert spark.conf.get(SHUFFLE_CLEANUP_KEY, None) == setting
    assert sorted(table.collect()) == sorted(counts.collect())
