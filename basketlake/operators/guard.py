"""Free-form SQL with a guard, the audit of a query log, and what queries cost."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.errors import ParseException

from basketlake.fixed_values import (
    AUDIT_PARTITION_COLUMNS,
    AUDIT_WRITE_WORDS,
    DAILY_BUDGET,
    MAX_SQL_ROWS,
)
from basketlake.functions.numbers import scan_cost


class QueryRefused(ValueError):
    """A query that is not run."""


LOG_SCHEMA = "query_id string, ts timestamp_ntz, sql string, bytes long"
#: Leaves of a plan that read no stored table.
_NO_TABLE = {"LocalTableScanExec", "RangeExec", "OneRowRelationExec", "EmptyRelationExec"}


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.length())]


def _scans(df: DataFrame) -> list:
    """The file scans of a plan and of all its subqueries. Other ways of reading are refused: their size is not known."""
    run = df._jdf.queryExecution()
    planner = run.sparkSession().sessionState().planner()
    plans = [run.sparkPlan(), *(planner.plan(sub).next() for sub in _items(run.optimizedPlan().subqueriesAll()))]
    leaves = [leaf for plan in plans for leaf in _items(plan.collectLeaves())]
    kinds = [(leaf.getClass().getSimpleName(), leaf) for leaf in leaves]
    unknown = {kind for kind, _ in kinds} - _NO_TABLE - {"FileSourceScanExec"}
    if unknown:
        raise QueryRefused(f"cannot tell what {', '.join(sorted(unknown))} would read")
    return [leaf for kind, leaf in kinds if kind == "FileSourceScanExec"]


def unpruned_tables(df: DataFrame) -> list[str]:
    """Partitioned files a plan would read whole, by looking at the filters of its scans."""
    return [
        scan.relation().location().rootPaths().mkString(", ")
        for scan in _scans(df)
        if scan.relation().partitionSchema().length() > 0 and scan.partitionFilters().length() == 0
    ]


def bytes_to_scan(df: DataFrame) -> int:
    """Bytes of the files that the partition filters of a plan leave, from the file index; nothing is read or run.

    Column pruning and statistics can only lower what is then read.
    """
    return sum(int(scan.selectedPartitions().totalFileSize()) for scan in _scans(df))


def spent_on(spark: SparkSession, log_path: str, day: dt.date) -> float:
    """Dollars that the queries of a log table have cost on a day; 0 where there is no table yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log_path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return 0.0
    rows = spark.read.schema(LOG_SCHEMA).parquet(log_path).where(F.to_date("ts") == F.lit(day))
    return rows.agg(F.coalesce(scan_cost(F.sum("bytes")), F.lit(0.0)).alias("spent")).first().spent


def reads_whole_table(sql: str) -> bool:
    """A bare SELECT * with neither a row limit nor an aggregate."""
    text = " ".join(sql.lower().split())
    reduces = any(f" {w}(" in text or f" {w} (" in text for w in ("count", "sum", "avg", "min", "max"))
    return "select *" in text and " limit " not in text and "group by" not in text and not reduces


def guarded_sql(
    spark: SparkSession, sql: str, limit: int = 50, spent: float = 0.0, log_path: str | None = None,
    at: dt.datetime | None = None, budget: float = DAILY_BUDGET,
) -> DataFrame:
    """One read-only query, with at most `limit` rows (1 to 200) and `more_exist`, which tells whether there are others.

    The text is put inside a SELECT, where Spark's parser takes a query and nothing else: no write, no
    command, no second statement. The plan is analysed, not run, to see which partitions it would read. With
    `log_path` what the day's queries have cost is taken from that table, the query is refused if the files it would
    read go over the budget, and recorded there with their bytes if not.
    """
    text = (sql or "").strip().rstrip(";")
    if not text:
        raise QueryRefused("give a SELECT statement")
    at = at or dt.datetime.now()
    spent += spent_on(spark, log_path, at.date()) if log_path else 0.0
    if spent >= budget:
        raise QueryRefused(f"the daily budget of ${budget:.2f} is used up")
    rows = max(1, min(int(limit or 50), MAX_SQL_ROWS))
    try:
        result = spark.sql(f"SELECT * FROM (\n{text}\n) AS guarded LIMIT {rows + 1}")
    except ParseException as error:
        raise QueryRefused("only one SELECT statement is allowed") from error
    whole = unpruned_tables(result)
    if whole:
        raise QueryRefused(f"filter on the partition columns of {', '.join(whole)}")
    if reads_whole_table(text):
        raise QueryRefused("a bare SELECT * reads whole files: add a LIMIT or aggregate")
    if log_path:
        size = bytes_to_scan(result)
        cost = spark.range(1).select(scan_cost(F.lit(size)).alias("cost")).first().cost
        if spent + cost > budget:
            raise QueryRefused(f"the query would read {size:,} bytes, ${cost:.2f}; ${budget - spent:.2f} of the day are left")
        record_query(spark, log_path, text, size, at)
    return _cut(result, rows)


def _cut(result: DataFrame, rows: int) -> DataFrame:
    """The first rows of at most rows + 1, in the order they come, and whether there was another."""
    place = f"_place_{uuid.uuid4().hex}"
    placed = result.coalesce(1).withColumn(place, F.monotonically_increasing_id())
    placed = placed.withColumn("more_exist", F.count(F.lit(1)).over(W.partitionBy()) > rows)
    return placed.where(F.col(place) < rows).drop(place)


def audit(log: DataFrame, column: str = "sql") -> DataFrame:
    """The guard's rules as text rules over a table of queries, with a verdict per query."""
    text = F.lower(F.regexp_replace(F.col(column), r"\s+", " "))
    writes = text.rlike(rf"\b({'|'.join(AUDIT_WRITE_WORDS).lower()})\b")
    metadata = text.rlike(
        r"\b(information_schema|show\s+(tables|columns|partitions|create|databases)|describe)\b"
    )
    bounded = text.rlike(
        rf"\b({'|'.join(AUDIT_PARTITION_COLUMNS)})\b\s*(=|>|<|>=|<=|between|in\s*\()"
    )
    bare = (
        text.contains("select *") & ~text.contains(" limit ") & ~text.rlike(r"\b(count|sum|avg|min|max|group by)\b")
    )
    verdict = (
        F.when(writes, "refused: not read-only")
        .when(metadata, "accepted: metadata")
        .when(~bounded, "refused: no partition filter")
        .when(bare, "refused: reads everything")
        .otherwise("accepted")
    )
    return log.withColumns({
        "is_write": writes.cast("int"), "is_metadata": metadata.cast("int"),
        "has_partition_filter": bounded.cast("int"), "selects_everything": bare.cast("int"), "verdict": verdict,
    })


def record_query(spark: SparkSession, path: str, sql: str, scanned: int, at: dt.datetime) -> None:
    """Append a query to the log table."""
    row = spark.range(1).select(
        F.expr("uuid()").alias("query_id"), F.lit(at).cast("timestamp_ntz").alias("ts"),
        F.lit(sql).alias("sql"), F.lit(scanned).cast("long").alias("bytes"),
    )
    row.write.mode("append").parquet(path)


def spend_daily(log: DataFrame, budget: float = DAILY_BUDGET) -> DataFrame:
    """Queries, bytes and dollars per day against the budget."""
    days = log.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("queries"), F.sum("bytes").alias("bytes")
    )
    cost = scan_cost(F.col("bytes"))
    return days.withColumns({
        "dollars": cost, "budget_left": F.lit(budget) - cost, "over_budget": (cost >= budget).cast("int"),
    })


def _running(log: DataFrame, order: Column) -> DataFrame:
    """Bytes scanned on the same day before each query.

    A day may hold most of the log, so the running sum is taken inside minutes and over the minutes of a day.
    """
    placed = log.withColumns({"day": F.to_date("ts"), "_slot": F.unix_seconds(F.col("ts").cast("timestamp")).cast("long")})
    placed = placed.withColumn("_slot", F.floor(F.col("_slot") / 60))
    inside = W.partitionBy("day", "_slot").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    slots = placed.groupBy("day", "_slot").agg(F.sum("bytes").alias("_slot_bytes"))
    over_day = W.partitionBy("day").orderBy("_slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    starts = slots.select("day", "_slot", (F.sum("_slot_bytes").over(over_day) - F.col("_slot_bytes")).alias("_start"))
    return placed.withColumn("_inside", F.sum("bytes").over(inside) - F.col("bytes")).join(starts, ["day", "_slot"]).select(
        *log.columns, "day", (F.col("_start") + F.col("_inside")).alias("bytes_before")
    )


def budget_breaches(log: DataFrame, budget: float = DAILY_BUDGET) -> DataFrame:
    """Queries that arrived after the day's budget was spent: first of them and number per day."""
    late = _running(log, F.struct("ts", "query_id")).where(scan_cost(F.col("bytes_before")) >= budget)
    return late.groupBy("day").agg(
        F.min("ts").alias("first_refused_at"), F.count(F.lit(1)).alias("refused"),
        F.sum("bytes").alias("refused_bytes"),
    )
