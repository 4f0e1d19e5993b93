"""Reading register logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlake.fixed_values import DEFAULT_SETTINGS
from basketlake.functions import dates, text
from basketlake.schemas import log_fields, log_schema

CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "emptyValue": "", "mode": "PERMISSIVE"}
#: Logs as they come, and gzipped ones.
LOG_FILES = "*.[dD][aA][tT]{,.gz}"
PARTITION_FIELDS = T.StructType([
    T.StructField("store", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
])


def read_log(
    spark: SparkSession,
    paths: str | list[str],
    settings=DEFAULT_SETTINGS,
    pattern: str = LOG_FILES,
    partitions: tuple[str, ...] = (),
    only: Column | None = None,
) -> DataFrame:
    """Log files as rows of text, with their place (file, block, ord).

    Short records get blanks, surplus fields are dropped, blank lines and empty files give no rows.
    `partitions` names the directory keys below the path, `only` is a filter on them: put on the result it would not reach
    the scan, as lines are numbered in between, and the whole log would be read.
    """
    schema = T.StructType(log_schema(settings).fields + [PARTITION_FIELDS[name] for name in partitions])
    reader = spark.read.schema(schema).options(pathGlobFilter=pattern, **CSV_OPTIONS)
    lines = reader.csv(paths)
    if only is not None:
        lines = lines.where(only)
    return lines.select(
        *[text.blank(F.col(name)).alias(name) for name in log_fields(settings)],
        *partitions,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("ord"),
    )


def parse_lines(lines: DataFrame, value: str = "value", settings=DEFAULT_SETTINGS) -> DataFrame:
    """The same parse for lines held in a text column; other columns stay. A line without
    any field is dropped, as the file reader drops blank lines.

    `inline` keeps the parse in an operator of its own: as a plain column Catalyst would repeat it for
    every field taken out of the record.
    """
    ddl = ", ".join(f"{name} STRING" for name in log_fields(settings))
    record = F.from_csv(F.col(value), ddl, CSV_OPTIONS)
    kept = [c for c in lines.columns if c != value]
    return (
        lines.select(*kept, F.inline(F.array(record)))
        .where(F.coalesce(*[F.col(n) for n in log_fields(settings)]).isNotNull())
        .select(*kept, *[text.blank(F.col(n)).alias(n) for n in log_fields(settings)])
    )


def file_meta(name: Column) -> tuple[Column, Column]:
    """(date, store) of an archive file name, TLOG_YYYY-MM-DD_n_store.DAT."""
    store = F.regexp_extract(name, r"(?i)^TLOG_\d{4}-\d{2}-\d{2}_\d+_(\d+)\.DAT$", 1)
    return dates.iso_date_in(name), F.nullif(store, F.lit(""))


def files_since(files: DataFrame, since: Column) -> DataFrame:
    """Files that are not empty and not dated before a day; undated files stay.

    Takes the columns name and size, of a binaryFile listing or of any file table.
    """
    day = dates.iso_date_in(F.col("name"))
    return files.where((F.col("size") > 0) & (day.isNull() | (day >= since)))


def partition_listing(lines: DataFrame) -> DataFrame:
    """Files and lines per raw partition; a partition without lines is not listed."""
    keys = list(PARTITION_FIELDS.names)
    keys = [k for k in keys if k in lines.columns]
    per_file = lines.groupBy(*keys, "file").agg(F.count(F.lit(1)).alias("lines"))
    return per_file.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"), F.sum("lines").alias("lines")
    )


def incremental_partitions(parts: DataFrame, as_of: Column, days: int = 3) -> DataFrame:
    """Partitions no older than some days; directory names that are no date are skipped."""
    day = F.try_to_date(
        F.format_string("%04d-%02d-%02d", "year", "month", "day"), "yyyy-MM-dd"
    )
    return parts.where(day >= F.date_sub(as_of, days))


def months_touched(parts: DataFrame) -> DataFrame:
    return parts.select("year", "month").distinct()
