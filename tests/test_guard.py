"""What a guarded query would read, its record, the day's budget, and the sign that rows were cut."""

import datetime as dt
import os

import pytest

from basketlake.operators import guard

AT = dt.datetime(2026, 3, 1, 12)


@pytest.fixture(scope="module")
def sales(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sales"))
    spark.range(1000).selectExpr("id", "cast(id % 4 + 2001 as int) as year").write.partitionBy("year").mode("overwrite").parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("guard_sales")
    return path


def size(path, *years):
    return sum(
        os.path.getsize(os.path.join(d, f)) for y in years for d, _, names in os.walk(os.path.join(path, f"year={y}")) for f in names if f.endswith(".parquet")
    )


def test_bytes_are_those_of_the_files_that_are_left(spark, sales, tmp_path):
    log = str(tmp_path / "log")
    assert guard.spent_on(spark, log, AT.date()) == 0.0
    guard.guarded_sql(spark, "SELECT sum(id) AS s FROM guard_sales WHERE year = 2002", log_path=log, at=AT)
    guard.guarded_sql(spark, "SELECT sum(id) AS s FROM guard_sales WHERE year > 2002", log_path=log, at=AT)
    guard.guarded_sql(spark, "SELECT 1 AS x", log_path=log, at=AT + dt.timedelta(days=1))
    got = spark.read.parquet(log).orderBy("bytes").collect()
    assert [r.bytes for r in got] == [0, size(sales, 2002), size(sales, 2003, 2004)]
    days = {str(r.day): (r.queries, r.bytes) for r in guard.spend_daily(spark.read.parquet(log)).collect()}
    assert days == {"2026-03-01": (2, size(sales, 2002, 2003, 2004)), "2026-03-02": (1, 0)}
    assert guard.spent_on(spark, log, AT.date()) > 0


def test_a_query_over_budget_is_neither_run_nor_recorded(spark, sales, tmp_path):
    log = str(tmp_path / "log")
    with pytest.raises(guard.QueryRefused, match="bytes"):
        guard.guarded_sql(spark, "SELECT sum(id) AS s FROM guard_sales WHERE year = 2002", log_path=log, at=AT, budget=1e-12)
    assert not os.path.exists(log)
    guard.record_query(spark, log, "SELECT 1", 10**13, AT)
    with pytest.raises(guard.QueryRefused, match="used up"):
        guard.guarded_sql(spark, "SELECT 1 AS x", log_path=log, at=AT)
    assert guard.guarded_sql(spark, "SELECT 1 AS x", log_path=log, at=AT + dt.timedelta(days=1)).count() == 1


@pytest.mark.parametrize("limit, rows, more", [(3, 3, True), (250, 200, True), (1, 1, True)])
def test_a_cut_is_told(spark, sales, limit, rows, more):
    got = guard.guarded_sql(spark, "SELECT id FROM guard_sales WHERE year = 2001 ORDER BY id DESC", limit).collect()
    assert len(got) == min(rows, limit) and {r.more_exist for r in got} == {more}
    assert [r.id for r in got] == sorted((r.id for r in got), reverse=True) and got[0].id == 996
    whole = guard.guarded_sql(spark, "SELECT id FROM guard_sales WHERE year = 2001 AND id < 8", 2).collect()
    assert len(whole) == 2 and not whole[0].more_exist
    assert guard.guarded_sql(spark, "SELECT id FROM guard_sales WHERE year = 2001 AND id < 0").collect() == []
