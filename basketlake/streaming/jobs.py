"""Log ingest as streams. All jobs run with availableNow by default and keep their state in a checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from basketlake.operators import lines as line_ops
from basketlake.plans import nightly
from basketlake.schemas import log_schema
from basketlake.session import compiled, discard, stored, without_leftovers
from basketlake.sources import versions
from basketlake.sources.raw_log import CSV_OPTIONS, LOG_FILES, PARTITION_FIELDS, read_log
from basketlake.sources.sinks import LAYOUT, with_partitions

LATENESS = "3 days"
STATE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAYS = ("year", "month", "day")


def log_stream(
    spark: SparkSession, path: str, pattern: str = LOG_FILES, files_per_batch: int | None = None
) -> DataFrame:
    """New log files below year/month as a stream; the first batch sweeps what is waiting.

    Files are taken once by name. A rewritten file is not read again, so producers write new names. Lines carry the
    file and the split they come from; a file is never cut between batches.
    """
    schema = log_schema()
    for key in LAYOUT:
        schema = schema.add(PARTITION_FIELDS[key])
    reader = spark.readStream.schema(schema).options(pathGlobFilter=pattern, **CSV_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.csv(path).na.fill("")
    return lines.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _start(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, on disk, not in the executors' heaps."""
    before = spark.conf.get(STATE_KEY, None)
    spark.conf.set(STATE_KEY, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STATE_KEY) if before is None else spark.conf.set(STATE_KEY, before)


def ingest(stream: DataFrame, target: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Typed item lines with the tender of their transaction, a folder of the table per batch.

    A transaction is a run of lines of one file, and batches are whole files, so every run is settled inside its batch
    and no state is kept. A batch that is retried replaces its folder.
    """

    def save(batch: DataFrame, number: int) -> None:
        lines = batch.select("file", "block", F.monotonically_increasing_id().alias("ord"), *line_ops.TYPED_FIELDS)
        with without_leftovers(batch.sparkSession), compiled(batch.sparkSession):
            line_ops.typed(line_ops.tendered_runs(lines)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return _start(stream.writeStream.foreachBatch(save), checkpoint, interval)


def content_once(
    stream: DataFrame, content: str, keys: list[str], arrived: str = "arrived", lateness: str = "30 days"
) -> DataFrame:
    """Each content once per key, by its hash; changed content under the same name counts as new.

    The hashes are state; the watermark bounds how long one is kept.
    """
    hashed = stream.withColumn("content_md5", F.md5(F.col(content)))
    return hashed.withWatermark(arrived, lateness).dropDuplicatesWithinWatermark([*keys, "content_md5"])


def daily_rollup(stream: DataFrame, keys: list[str], approximate_baskets: bool = True) -> DataFrame:
    """Event-time day by key, open for lines up to LATENESS late; exact basket counts come from the batch rebuild.

    For the update mode: a day that the watermark has passed leaves the state, and later lines of it are dropped.
    """
    at = stream.withColumn("event_time", F.col("transaction_ts").cast("timestamp"))
    sums = [
        F.sum("quantity").alias("units"), F.sum("extended_price").alias("revenue"),
        F.count(F.lit(1)).alias("line_count"),
    ]
    if approximate_baskets:
        sums.append(F.approx_count_distinct("transaction_id").alias("approx_baskets"))
    grouped = at.withWatermark("event_time", LATENESS).groupBy(F.window("event_time", "1 day"), *keys).agg(*sums)
    return grouped.select(F.to_date("window.start").alias("sale_date"), *keys, *[c for c in grouped.columns if c not in ("window", *keys)])


def merge_days(spark: SparkSession, changed: DataFrame, keys: list[str], target: str) -> None:
    """Put the changed rows of a daily table in the place of those with the same day and keys; other days aren't read.

    The touched days are switched in one step, and the same rows once more give the same table. `changed` has one row
    per sale_date and keys.
    """
    rows = stored(with_partitions(changed, "sale_date"), "changed-days")
    touched = versions.touched_parts(rows, DAYS)
    if not touched:
        return
    base = versions.read_manifest(spark, target)
    names = [c for c in changed.columns if c not in DAYS]
    new = rows.select(*names)
    if "daily" in base.schemas:
        day = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
        before = versions.tables(spark, target, base)["daily"].where(day.isin([y * 10000 + m * 100 + d for y, m, d in touched]))
        old, now = before.select(*names).alias("old"), new.select("sale_date", *keys).alias("now")
        same = [F.col(f"old.{k}").eqNullSafe(F.col(f"now.{k}")) for k in ("sale_date", *keys)]
        new = old.join(now, same, "left_anti").unionByName(new)
    versions.publish(spark, target, {"daily": new}, {"daily": "sale_date"}, touched, base=base, layout=DAYS)
    versions.expire(spark, target)
    discard(rows)


def keep_daily(
    daily: DataFrame, keys: list[str], target: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """A daily rollup kept up to date: each batch brings the rows it changed, and only their days are written again."""

    def save(batch: DataFrame, number: int) -> None:
        merge_days(batch.sparkSession, batch, keys, target)

    return _start(daily.writeStream.outputMode("update").foreachBatch(save), checkpoint, interval)


def latest_daily(spark: SparkSession, target: str) -> DataFrame:
    """The daily table as the last finished batch left it."""
    return versions.tables(spark, target)["daily"].drop(*DAYS)


def rebuild_touched(
    spark: SparkSession, raw_path: str, touched: DataFrame, master: DataFrame, target: str,
    stores: DataFrame | None = None,
) -> None:
    """Run the nightly job over the months a batch touches.

    Only these partitions are replaced, so a batch that is retried gives the same tables. The list is as
    short as the folders a batch brings; it becomes a partition filter on the raw log.
    """
    parts = versions.touched_parts(touched)
    if parts:
        raw = read_log(spark, raw_path, partitions=LAYOUT, only=nightly.any_partition(parts))
        nightly.rebuild(spark, raw, master, target, stores)


def rebuild_stream(
    stream: DataFrame, rebuild: Callable[[DataFrame], None], checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Each batch names the partitions it touches; `rebuild` makes them anew from the raw log."""

    def on_batch(batch: DataFrame, number: int) -> None:
        rebuild(batch.select(*LAYOUT).distinct())

    return _start(stream.writeStream.foreachBatch(on_batch), checkpoint, interval)
