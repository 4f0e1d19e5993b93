"""Exact basket counts that can be merged: numbered baskets in rollup rows, united as bitmaps.

A distinct count can't be added up over days or departments, a set of baskets can be united. Baskets get numbers once,
in the order of their days, so the baskets of a span lie close together. A rollup row keeps the numbers of its baskets;
a report turns them into bitmaps of 32,768 bits, which are united inside tasks before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Column of a rollup row with the sorted numbers of its baskets.
SET_COLUMN = "baskets"
_BITS = 1 << 15


NUMBER_SCHEMA = "transaction_id string, basket_no long, first_day date"


def new_baskets(detail: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(transaction_id, basket_no, first_day) for the baskets of the detail lines that are not in `known` yet.

    Numbers differ, come after the largest of `known`, a stored table of this form, and follow first day and store. A
    null id is no basket, as in a distinct count. Write the result before use: numbers are made by place.
    """
    ids = detail.where(F.col("transaction_id").isNotNull()).groupBy("transaction_id").agg(
        F.min(F.struct(F.to_date("transaction_ts").alias("day"), "store_id")).alias("_first")
    )
    start = F.lit(0).cast("long")
    if known is not None:
        ids = ids.join(known.select("transaction_id"), "transaction_id", "left_anti")
        last = known.agg(F.max("basket_no").alias("last")).scalar()
        # Whole bitmaps, so that new baskets share none with old ones.
        start = F.coalesce((F.floor(last / _BITS) + 1) * _BITS, F.lit(0)).cast("long")
    placed = ids.repartitionByRange("_first", "transaction_id").sortWithinPartitions("_first", "transaction_id")
    new = placed.select("transaction_id", F.monotonically_increasing_id().alias("_place"), F.col("_first.day").alias("first_day"))
    return new.select("transaction_id", (F.col("_place") + start).alias("basket_no"), "first_day")


def count_baskets(rows: DataFrame, *keys: str, name: str = "baskets") -> DataFrame:
    """Exact number of different baskets per group, from rollup rows with sets or from detail lines.

    Sets become one bitmap per group and 32,768 numbers in each task; only these are shuffled and united.
    """
    if SET_COLUMN not in rows.columns:
        once = rows.where(F.col("transaction_id").isNotNull()).groupBy(*keys, "transaction_id").agg(F.lit(1).alias("_one"))
        return once.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    numbers = rows.select(*keys, F.explode(SET_COLUMN).alias("_no"))
    maps = numbers.groupBy(*keys, F.bitmap_bucket_number("_no").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_no")).alias("_map")
    )
    return maps.groupBy(*keys).agg(F.sum(F.bitmap_count("_map")).alias(name))


def grouped(rows: DataFrame, keys: list[str], measures: list[Column], name: str = "baskets") -> DataFrame:
    """Measures and exact baskets per group; groups of null keys are kept, groups without a basket count 0."""
    sums = rows.groupBy(*keys).agg(*measures)
    counts = count_baskets(rows, *keys, name=name).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = sums.join(counts, same, "left").drop(*[f"_{k}" for k in keys])
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("long"))
