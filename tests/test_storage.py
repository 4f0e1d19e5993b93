"""What is shuffled, kept and written on the way to the stored tables."""

import os
import shutil

from pyspark.sql import functions as F

import workload
from basketlake.operators import baskets, rows
from basketlake.operators.rollups import dept_rollup, item_rollup
from basketlake.plans import reports
from basketlake.session import stored
from basketlake.sources import sample, sinks

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rollups_shuffle_lines_once(spark):
    """By store and month; neither by transaction nor by key."""
    detail = sample.stored_detail(spark, SF)
    numbers = stored(baskets.new_baskets(detail), "numbers")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for build in (item_rollup, dept_rollup):
            for rollup in (build(detail), build(detail, numbers)):
                wide = [line for line in plan(rollup).splitlines() if "Exchange hashpartitioning" in line and "sale_date" in line]
                assert not wide and plan(rollup).count("REPARTITION_BY_COL") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rollup_keeps_numbers_of_a_basket_in_two_months(spark):
    rows = spark.sql("""
        SELECT t.id AS transaction_id, '1' AS store_id, 's' AS store_name, t.at AS transaction_ts, 'i' AS item_id, 'd' AS item_desc,
               'p' AS product_key, '10' AS department_code, 'n' AS department_name, 'c' AS category_name, 'CASH' AS tender_type,
               'SALE' AS transaction_type, 1.0BD AS quantity, 2.0BD AS unit_price, 2.0BD AS extended_price, 1.0BD AS gross_margin,
               0.0BD AS loyalty_discount, 0.0BD AS premium_discount
          FROM VALUES ('a', TIMESTAMP'2001-01-31 23:50:00'), ('a', TIMESTAMP'2001-02-01 00:10:00'),
                      ('b', TIMESTAMP'2001-02-01 09:00:00'), (NULL, TIMESTAMP'2001-02-01 10:00:00') AS t(id, at)""")
    numbers = spark.createDataFrame([("a", 7, None), ("b", 9, None), ("z", 11, None)], baskets.NUMBER_SCHEMA)
    got = {r.sale_date.isoformat(): (r.baskets, r.line_count, float(r.revenue)) for r in dept_rollup(rows, numbers).collect()}
    assert got == {"2001-01-31": ([7], 1, 2.0), "2001-02-01": ([7, 9], 3, 6.0)}


def test_a_report_writes_only_the_tables_it_reads(spark, tmp_path):
    sf = shutil.copytree(SF, tmp_path / "sf")
    reports.tender_analysis(sample.lake(spark, str(sf)), "all_time").collect()
    assert {key[2] for key in sample._STORED if key[1] == str(sf)} == {"detail", "basket_numbers", "rollup_dept"}


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    def shuffled():
        folders = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
        return {name for d in folders for _, _, names in os.walk(d) for name in names if name.startswith("shuffle_")}

    before = shuffled()
    sinks.write_table(sample.detail(spark, SF), str(tmp_path / "detail"), "transaction_ts")
    assert shuffled() <= before


def test_checks_read_one_stored_detail(spark):
    for name in ("check_partition", "reconcile", "verify_totals"):
        checked = plan(workload.QUERIES[name](spark, SF))
        assert checked.count("l_linenumber") == plan(workload.parsed_log(spark, SF)).count("l_linenumber") * (name != "check_partition")


def test_texts_of_whole_lines_travel_as_one_column(spark):
    """To a large item master, and to their months."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        detail = plan(sample.detail(spark, SF, whole=True))
        assert rows.TEXTS in detail and rows.TEXTS not in plan(sample.detail(spark, SF))
        whole, narrow = (set(map(tuple, sample.detail(spark, SF, whole=w).collect())) for w in (True, False))
        assert whole == narrow
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_come_out_of_a_shuffle_as_they_were(spark):
    texts = ["", None, "a", "\u0001", "\u0002", "\u0002n", "\u0002s\u0001", "\n,\"\r", "\u00e9"]
    given = [(i, x, y, texts[i % 3]) for i, (x, y) in enumerate((x, y) for x in texts for y in texts)]
    table = spark.createDataFrame(given, "no int, x string, y string, z string")
    seen = []
    back = rows.light(table, lambda r: (seen.append(r.columns), r.repartition(3))[1], ("z",))
    assert back.columns == table.columns and sorted(map(tuple, back.collect()), key=lambda r: r[0]) == given
    assert seen == [["no", "z", rows.TEXTS]]


def test_tables_are_written_in_parts_of_whole_years(spark, tmp_path, monkeypatch):
    """Shuffle files of one part only exist at a time; the tables are those of one part, with lines without a date, too."""
    sf = shutil.copytree(SF, tmp_path / "sf")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    day = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate"))
    orders.withColumn("o_orderdate", day).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "new"))
    shutil.copy(next((tmp_path / "new").glob("*.parquet")), sf / "orders.parquet")
    monkeypatch.setattr(sample, "PART_ROWS", 1)
    parts, write = [], sinks.write_table
    monkeypatch.setattr(sinks, "write_table", lambda df, path, *args, **options: parts.append((path, df)) or write(df, path, *args, **options))
    detail = sample.stored_detail(spark, str(sf))
    years = detail.select("year").distinct().count()
    assert len(parts) == years >= 7
    whole = sample.detail(spark, str(sf), whole=True)
    kept = detail.select(*whole.columns)
    assert kept.where("transaction_ts is null").count() > 0
    assert kept.exceptAll(whole).count() == whole.exceptAll(kept).count() == 0
    for name, build in (("rollup_item", item_rollup), ("rollup_dept", dept_rollup)):
        before = len(parts)
        rollup = sample.stored_rollup(spark, str(sf), name)
        assert len(parts) - before == sample.ROLLUP_PARTS
        once = build(detail, sample.stored_numbers(spark, str(sf)))
        kept = rollup.select(*once.columns)
        assert kept.exceptAll(once).count() == once.exceptAll(kept).count() == 0
