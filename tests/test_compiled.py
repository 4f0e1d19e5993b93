"""Stages that the JVM can compile."""

from pyspark.sql import functions as F

from basketlake.operators.lines import render
from basketlake.session import METHOD_LIMIT, METHOD_LIMIT_KEY
from basketlake.sources import sinks


def plan(df):
    return df._jdf.queryExecution().toString()


def test_a_log_line_is_one_text(spark):
    """No text per field, which made a method too long to be compiled."""
    record = spark.createDataFrame([("07/01/2026", 5, None, "a,b")], "date string, sequence int, key_function string, transaction_code string")
    record = record.withColumn("retail", F.lit("12.50").cast("decimal(18,2)"))
    shown = record.select(render(record).alias("value"))
    assert "concat_ws" not in plan(shown)
    fields = ['"07/01/2026"', "0", "0", "0", "5", '""', '""', "0", "0", "12.5", "0", "0", "0", "0", '""', '""', *"000", '""', "0", "0",
              '""', *"000000", '"a,b"', "0", "0", '""', '""', '""']
    assert shown.head().value.startswith(",".join(fields[:29]) + ',"a,b"') and shown.head().value.count(",") == 36


def test_writes_leave_long_methods_to_operators(spark, tmp_path, monkeypatch):
    before, seen = spark.conf.get(METHOD_LIMIT_KEY), []
    rows = spark.sql("SELECT DATE'2026-01-05' AS d, 1 AS n")
    limited = sinks.compiled
    monkeypatch.setattr(sinks, "compiled", lambda spark: seen.append(limited(spark)) or seen[-1])
    sinks.write_table(rows, str(tmp_path / "t"), "d")
    assert len(seen) == 1 and spark.conf.get(METHOD_LIMIT_KEY) == before
    with limited(spark):
        assert spark.conf.get(METHOD_LIMIT_KEY) == METHOD_LIMIT
    assert spark.conf.get(METHOD_LIMIT_KEY) == before
