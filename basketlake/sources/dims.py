"""Dimension tables: readers, and dimensions taken from the detail table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlake.schemas import ITEM_MASTER, MOVEMENT_ACTUALS


def place_in_files() -> Column:
    """Where a row stands: file by name, split by its first byte, row in the split; compares as one value.

    Spark packs the largest splits first, so an increasing id alone does not follow the files.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_item_master(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The item master CSV, with `ord` for the order of its rows over all files."""
    master = spark.read.option("header", True).option("escape", '"').schema(ITEM_MASTER).csv(path)
    return master.select("*", place_in_files().alias("ord")).na.fill("")


def read_price_book(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """The named columns of a wide price book export as text, blank where empty, with `ord` for the order of its rows.

    Each file has the header; files may differ in what other columns they have only if that doesn't move these.
    """
    book = spark.read.option("header", True).option("escape", '"').csv(path)
    return book.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns], place_in_files().alias("ord"))


def read_movement(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').schema(MOVEMENT_ACTUALS).csv(path)


def dim_store(detail: DataFrame) -> DataFrame:
    """Stores that appear in the detail table."""
    return detail.groupBy(F.col("store_id").alias("store_code")).agg(
        F.min("store_name").alias("store_name"), F.lit("").alias("region")
    )


def upsert(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of both tables by key, incoming ones in place of current ones."""
    kept = current.join(incoming, key, "left_anti")
    return kept.unionByName(incoming)
