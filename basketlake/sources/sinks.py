"""Partitioned tables: writing, reading back, publishing after the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlake.operators.rows import light
from basketlake.session import compiled, without_leftovers

# Month folders: at a large chain a folder per store would leave each with small files. Rows are sorted by
# store inside, so a store is found by the statistics of row groups.
LAYOUT = ("year", "month")


def with_partitions(df: DataFrame, date_column: str) -> DataFrame:
    """Partition columns taken from the row itself, not from the folder it came from."""
    day = F.to_date(F.col(date_column))
    return df.withColumns({
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
    })


def write_table(
    df: DataFrame, path: str, date_column: str, layout=LAYOUT, sort_by: tuple[str, ...] = (), placed: bool = False
) -> None:
    """Write Parquet below year/month; only the partitions in `df` are replaced.

    The rebalance hint gathers a partition's rows into few files and lets AQE split the large ones. Rows that are
    `placed`, by store and month as rollups are or as they were stored before, are written where they are.
    """
    rows = with_partitions(df, date_column)
    if not placed:
        rows = light(rows, lambda r: r.hint("rebalance", *layout), tuple(layout))
    if sort_by:
        rows = rows.sortWithinPartitions(*layout, *sort_by)
    with without_leftovers(df.sparkSession), compiled(df.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*layout)
            .parquet(path)
        )


def add_partition_fields(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(k, T.IntegerType()) for k in LAYOUT])


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read it back with the partition columns typed, not inferred."""
    if schema is None:
        schema = add_partition_fields(spark.read.option("recursiveFileLookup", True).parquet(path).schema)
    return spark.read.schema(schema).parquet(path)


def write_log(record_lines: DataFrame, path: str, value: str = "value") -> None:
    """Write log lines as gzipped .dat files below year/month. Needs those columns, file and ord.

    Lines of one file go to one task, whatever the size of the month, so no basket is ever cut.
    """
    keys = list(LAYOUT)
    with without_leftovers(record_lines.sparkSession), compiled(record_lines.sparkSession):
        (
            record_lines.select(*keys, "file", "ord", value)
            .repartition(*keys, "file")
            .sortWithinPartitions(*keys, "file", "ord")
            .drop("file", "ord")
            .write.mode("overwrite")
            .partitionBy(*keys)
            .options(extension="dat", compression="gzip", sep="\u0001", quote="\u0000", emptyValue="", escape="\u0000")
            .csv(path)
        )
