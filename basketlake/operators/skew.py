"""Joins and orderings that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SALT = "_salt"
DEFAULT_SALTS = 16


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan, the figure its own broadcast decision uses."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    text = text.strip().lower().removesuffix("b")
    unit = {"k": 2**10, "m": 2**20, "g": 2**30}.get(text[-1:], 1)
    return int(text.rstrip("kmg")) * unit


def broadcast_by_file_size(dim: DataFrame) -> bool:
    """Whether a side of a join of which Catalyst knows the size of compressed files only is left to be broadcast.

    Repeated words take many times as much in memory, and a broadcast is held by the driver; so beyond a quarter of the
    threshold both sides are to be sorted.
    """
    return estimated_bytes(dim) <= broadcast_limit(dim) // 4


def left_join(
    facts: DataFrame, dim: DataFrame, keys: list[str], spread: list[str], salts: int = DEFAULT_SALTS
) -> DataFrame:
    """Left join of many rows with one row per key.

    A side Catalyst estimates below its broadcast threshold is left to it, and so is a larger one where Spark splits
    hot partitions by itself. Without that every key is cut into salted parts, so no key's rows meet in one task; the
    other side is repeated per salt.
    """
    conf = facts.sparkSession.conf
    splits = all(conf.get(f"spark.sql.adaptive.{name}", "true") == "true" for name in ("enabled", "skewJoin.enabled"))
    if splits or estimated_bytes(dim) <= broadcast_limit(dim):
        return facts.join(dim, keys, "left")
    salted = facts.withColumn(SALT, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = dim.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, SALT], "left").drop(SALT)


def positions(df: DataFrame, groups: list[str], value: str, bucket: Column) -> DataFrame:
    """Where each distinct value stands in its group, without sorting a group in one task.

    Returns (groups, value, n, before, total): rows with the value, rows with a smaller one, rows of
    the group. `bucket` is a coarse, monotone form of the value. Rows are first counted per value;
    the running sum is taken inside buckets, and over the few buckets of a group.
    """
    counts = df.groupBy(*groups, bucket.alias("_bucket"), value).agg(F.count(F.lit(1)).alias("n"))
    by_bucket = counts.groupBy(*groups, "_bucket").agg(F.sum("n").alias("_rows"))
    over_group = W.partitionBy(*groups)
    upto = over_group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    starts = by_bucket.select(
        *groups,
        "_bucket",
        (F.sum("_rows").over(upto) - F.col("_rows")).alias("_start"),
        F.sum("_rows").over(over_group.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("total"),
    )
    inside = (
        W.partitionBy(*groups, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    placed = counts.withColumn("_inside", F.sum("n").over(inside) - F.col("n"))
    return placed.join(starts, [*groups, "_bucket"]).select(
        *groups, value, "n", (F.col("_start") + F.col("_inside")).alias("before"), "total"
    )


def group_median(df: DataFrame, groups: list[str], value: str, bucket: Column, name: str) -> DataFrame:
    """Exact median per group; the mean of the middle pair for an even count."""
    lower = F.floor((F.col("total") - 1) / 2)
    upper = F.floor(F.col("total") / 2)

    def at(rank: Column) -> Column:
        covers = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
        return F.max(F.when(covers, F.col(value)))

    placed = positions(df, groups, value, bucket)
    return placed.groupBy(*groups).agg(((at(lower) + at(upper)) / 2).alias(name))
