"""Operator 4: shards of near equal bytes by histogram sort."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlake.llm.common import stored, table

SHARDS, TOLERANCE, PROBES, SLOT_ROWS = 40, 0.005, 512, 20_000
LOWEST, HIGHEST, GROUP = -(1 << 63), 1 << 63, 1 << 32


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key): the key orders rows by a hash of the text, then by one of doc_id and text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).bitwiseAND(F.lit(-GROUP)).bitwiseOR(F.xxhash64("doc_id", text).bitwiseAND(F.lit(GROUP - 1))).alias("key"),
    )


def place(key: Column, splitters: list[int]) -> Column:
    """The number of splitters at or below the key."""
    bounds = np.array(splitters, dtype=np.int64)

    @F.arrow_udf("int")
    def found(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, keys.to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    return found(key)


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[int]:
    """Keys that cut the rows (key, size) into shards whose bytes are near equal.

    Each target, a multiple of the mean shard size, has a bracket of keys. A pass sets probes inside all brackets that
    are still open and counts the exact bytes between neighbouring probes in one aggregation, at most
    shards * probes numbers; a probe within tolerance * mean of its target becomes a splitter, else the bracket shrinks
    to the two probes around the target. Probes stay on borders between texts while the bracket holds several, so
    copies of a text are cut apart only where their bytes exceed the tolerance. Rows with equal doc_id and text have
    one key and are never cut apart.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    mean = total / shards
    open_targets = {i: (LOWEST, HIGHEST, 0) for i in range(1, shards)} if total else {}
    done = dict.fromkeys(range(1, shards), HIGHEST - 1)
    while open_targets:
        marks = set()
        for low, high, _ in open_targets.values():
            step = -(-(high - low) // probes)
            if high - low > GROUP:
                step = -(-step // GROUP) * GROUP
            marks.update(range(low + step, high, step))
            marks.update(x for x in (low, high) if LOWEST < x < HIGHEST)
        marks = sorted(marks)
        got = rows.groupBy(place(F.col("key"), marks).alias("at")).agg(F.sum("size").alias("bytes")).collect()
        between = np.zeros(len(marks) + 1, dtype=np.int64)
        for r in got:
            between[r["at"]] = r["bytes"]
        below = np.cumsum(between)[:-1]
        for i, (low, high, _) in list(open_targets.items()):
            j = int(np.searchsorted(below, i * mean))
            near = [x for x in (j - 1, j) if 0 <= x < len(marks)]
            best = min(near, key=lambda x: abs(below[x] - i * mean))
            low = max([low, *(marks[x] for x in near if x < j)])
            high = min([high, *(marks[x] for x in near if x >= j)])
            if abs(below[best] - i * mean) <= tolerance * mean or high - low <= 1:
                done[i] = marks[best]
                del open_targets[i]
            else:
                open_targets[i] = (low, high, 0)
    return [done[i] for i in range(1, shards)]


def assigned(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row, by the law of near equal bytes.

    Rows are exchanged once, to their part of a shard: a shard is numbered in parts of some SLOT_ROWS rows, and a part
    starts where the counts of the parts before end, so no task sorts a whole shard. Slots are gapless from 0 in each
    shard; repeated rows get slots of their own. Null texts have no bytes, hence size 16. An empty table gives no rows.
    """
    rows = stored(keyed(docs), "shard-keys")
    parts = max(1, rows.count() // shards // SLOT_ROWS)
    part = F.pmod(F.xxhash64("key", "doc_id"), F.lit(parts))
    placed = stored(rows.withColumn("shard", place(F.col("key"), splitters(rows, shards))).withColumn("part", part), "shard-rows")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("key", "doc_id")
    return (
        placed.withColumn("row", F.row_number().over(inside)).join(starts, ["shard", "part"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("row") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Writes whole documents, all columns, below path/shard=0 and so on, ordered by key inside each file."""
    cuts = splitters(stored(keyed(docs).select("key", "size"), "shard-keys"), shards)
    text = F.coalesce("text", F.lit(""))
    key = F.xxhash64(text).bitwiseAND(F.lit(-GROUP)).bitwiseOR(F.xxhash64("doc_id", text).bitwiseAND(F.lit(GROUP - 1)))
    out = docs.withColumn("__key", key).withColumn("shard", place(F.col("__key"), cuts))
    out.repartitionByRange("shard", "__key").sortWithinPartitions("shard", "__key").drop("__key").write.partitionBy("shard").parquet(path)


def op4(spark, sf_dir: str) -> DataFrame:
    return assigned(table(spark, sf_dir, "documents"))
