"""Streams over several batches: late lines, state that goes, tenders, repeated contents."""

import datetime as dt

from pyspark.sql import functions as F

from basketlake.operators import lines
from basketlake.sources.raw_log import read_log
from basketlake.sources import versions
from basketlake.streaming import jobs
from test_log import BASKETS, NAMES, record

ITEM = "store_id string, transaction_type string, transaction_id string, ts string, quantity double, extended_price double"


def put(spark, folder, rows):
    frame = spark.createDataFrame(rows, ITEM).withColumn("transaction_ts", F.to_timestamp_ntz("ts")).drop("ts")
    frame.coalesce(1).write.mode("append").parquet(folder)
    return frame.schema


def days(spark, target):
    return {(str(r.sale_date), r.store_id): (r.units, r.line_count) for r in jobs.latest_daily(spark, target).collect()}


def run_daily(spark, folder, schema, target, state):
    keys = ["store_id", "transaction_type"]
    daily = jobs.daily_rollup(spark.readStream.schema(schema).parquet(folder), keys, approximate_baskets=False)
    query = jobs.keep_daily(daily, keys, target, state)
    query.awaitTermination()
    return query.recentProgress[-1].stateOperators[0].numRowsTotal


def test_late_lines_count_and_too_late_ones_do_not(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    line = lambda day, store="A", n=1.0: (store, "SALE", "T", f"2026-01-{day:02d} 12:00:00", n, 2.0)
    schema = put(spark, folder, [line(d) for d in range(1, 21)] + [line(20, None)])
    left = run_daily(spark, folder, schema, target, state)
    first = days(spark, target)
    assert len(first) == 21 and first["2026-01-20", None] == (1.0, 1)
    assert left <= 6
    put(spark, folder, [line(3, n=50.0), line(19, n=4.0), line(20, None, 2.0), line(21)])
    version = versions.read_manifest(spark, target).number
    run_daily(spark, folder, schema, target, state)
    second = days(spark, target)
    assert second["2026-01-03", "A"] == (1.0, 1)
    assert second["2026-01-19", "A"] == (5.0, 2) and second["2026-01-20", None] == (3.0, 2) and second["2026-01-21", "A"] == (1.0, 1)
    assert {k: v for k, v in second.items() if k[0] < "2026-01-19"} == {k: v for k, v in first.items() if k[0] < "2026-01-19"}
    new = {k: v for k, v in versions.read_manifest(spark, target).parts["daily"].items() if int(v[8:20]) > version}
    assert set(new) == {"2026-1-19", "2026-1-20", "2026-1-21"}


def test_a_batch_twice_gives_the_same_days(spark, tmp_path):
    changed = spark.createDataFrame([(dt.date(2026, 1, 1), "A", 2), (dt.date(2026, 1, 2), None, 3)], "sale_date date, store_id string, n int")
    for _ in range(2):
        jobs.merge_days(spark, changed, ["store_id"], str(tmp_path))
    assert sorted(r.n for r in jobs.latest_daily(spark, str(tmp_path)).collect()) == [2, 3]
    jobs.merge_days(spark, changed.where("false"), ["store_id"], str(tmp_path))
    assert jobs.latest_daily(spark, str(tmp_path)).count() == 2


def test_ingested_lines_have_the_tender_of_the_batch_job(spark, tmp_path):
    root, target = tmp_path / "raw", str(tmp_path / "out")
    folder = root / "year=2026" / "month=7"
    folder.mkdir(parents=True)
    first, second = (record(**dict(zip(NAMES, b))) for b in BASKETS[:2])
    body = "\n".join(record(**dict(zip(NAMES, b))) for b in BASKETS) + "\n"
    (folder / "TLOG_2026-07-01_1_0000000001.DAT").write_text(body)
    (folder / "TLOG_2026-07-02_1_0000000001.DAT").write_text(first + "\n" + second + "\n")
    stream = jobs.log_stream(spark, str(root), files_per_batch=1)
    jobs.ingest(stream, target, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(target)
    assert got.select("batch").distinct().count() == 2
    columns = ["transaction_id", "sequence", "item_id", "tender_type", "extended_price"]
    batch = lines.typed(lines.tendered_runs(read_log(spark, str(root)))).select(*columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, batch.collect()))
    assert {r.tender_type for r in got.collect()} == {"CASH", "EBT FOOD", ""}


def test_old_contents_leave_the_state(spark, tmp_path):
    folder, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "source string, text string, arrived timestamp"

    def batch(*rows):
        spark.createDataFrame([(s, t, dt.datetime.fromisoformat(d)) for s, t, d in rows], schema).coalesce(1).write.mode("append").parquet(folder)
        once = jobs.content_once(spark.readStream.schema(schema).parquet(folder), "text", ["source"]).select("source", "text")
        with jobs.disk_state(spark):
            query = once.writeStream.format("parquet").option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
        return query.recentProgress[-1].stateOperators[0].numRowsTotal

    assert batch(("a", "x", "2026-01-01"), ("a", "x", "2026-01-02"), ("b", "x", "2026-01-01"), ("a", "y", "2026-01-03")) == 3
    assert batch(("a", "x", "2026-01-20"), ("a", "z", "2026-04-01")) == 1
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [("a", "x"), ("a", "y"), ("a", "z"), ("b", "x")]
    assert spark.conf.get(jobs.STATE_KEY, "none") != jobs.ROCKSDB
