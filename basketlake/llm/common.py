"""What several operators share: word rules, stored tables, connected components, and a sieve in front of joins."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.session import discard, stored

__all__ = ["TOKEN_TABLE", "bitmap", "components", "discard", "guarded", "held_bits", "labelled_rows", "long_hash", "release_memory", "sieve", "spaced_words", "stored", "table", "token_words", "trim_memory"]

#: Lower-cases A-Z and turns every ASCII character that is no letter or digit into a space; bytes of other characters stay.
TOKEN_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
SIEVE_BITS = 1 << 23
#: Bounds of an Arrow batch, which holds whole texts on both sides of the socket; one row at least is sent.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


def spaced_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def token_words(text: str) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(TOKEN_TABLE).split()


def table(spark, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; from then on the session sends BATCH_ROWS rows or BATCH_BYTES bytes at a time to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_rows(docs: DataFrame, picked: DataFrame, most: int) -> DataFrame:
    """The columns of documents (doc_id, text) with those of picked (doc_id, ...), each doc_id and text once, at most so many.

    Beyond `most` rows those of the smallest hashes stay, so a doc_id with very many texts brings no more than that.
    """
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").withColumn("__h", F.xxhash64("text"))
    keys = rows.select("doc_id", "__h").distinct().orderBy(F.xxhash64("doc_id", "__h"), "doc_id", "__h").limit(most)
    return rows.join(F.broadcast(keys), ["doc_id", "__h"]).dropDuplicates(["doc_id", "__h"]).drop("__h")


def guarded(docs: DataFrame, step) -> DataFrame:
    """What step makes of docs, whatever the names of their columns beside doc_id and text.

    step returns the columns it is given, in their order; it sees the others under names of their places.
    """
    own = docs.columns
    return step(docs.toDF(*[c if c in ("doc_id", "text") else f"column {i}" for i, c in enumerate(own)])).toDF(*own)


def trim_memory() -> None:
    """Give freed memory back to the system. A Python worker serves one batch and one stage after another, and what the
    C library keeps of the last one counts against its executor; other libraries than glibc have no such call."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def release_memory() -> None:
    """As trim_memory, after objects that hold each other are gone."""
    gc.collect()
    trim_memory()


def long_hash(*cols: Column | str) -> Column:
    return F.xxhash64(*cols)


def components(edges: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node that can be reached.

    Alternating large-star and small-star steps: each step joins nodes to the smallest neighbour they see, and the
    number of steps grows with the logarithm of the longest chain. Minima are taken with map-side aggregation and
    joined back, so a node with very many edges is split like any skewed join. Every step is written to the shared
    folder. Edges with a null end are no edges.
    """
    now = stored(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), name
    )
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, name)
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(moved.union(small.select("u", F.col("m").alias("v"))).distinct(), name)
        seen = now.agg(
            F.count("*").alias("n"), F.sum(long_hash("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if (seen["n"], seen["h"]) == mark:
            break
        mark = (seen["n"], seen["h"])
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))


def bitmap(keys: DataFrame, key: Column, most: int = SIEVE_BITS):
    """A broadcast of `most` bits as bytes, the first bit highest; set are those of the keys, at their value modulo `most`."""
    slot = F.pmod(key, F.lit(most))
    parts = (
        keys.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()
    )
    bits = np.zeros(most + (1 << 15), dtype=bool)
    for row in parts:
        part = np.unpackbits(np.frombuffer(bytes(row["bits"]), dtype=np.uint8), bitorder="little").view(bool)
        start = (row["part"] - 1) * len(part)
        # bucket numbers start at 1 and hold the values from 1 on; position 0 of a bucket is its first value
        at = max(start + 1, 0)
        bits[at : at + len(part)] |= part[: len(bits) - at]
    if any(row["part"] == 0 for row in parts):
        bits[0] = True
    return keys.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())


def held_bits(packed: bytes, at: np.ndarray) -> np.ndarray:
    """Whether the bits at these places of a bitmap are set."""
    table = np.frombuffer(packed, dtype=np.uint8)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def sieve(keys: DataFrame, key: Column, most: int = SIEVE_BITS):
    """A Column function that is true for every row whose hash is among those of the keys, and for few other rows.

    The keys become a bitmap of `most` bits, 1 MB if not said otherwise, whatever the input; beyond some millions of keys
    it lets more rows through, never fewer. Joins behind it stay exact.
    """
    packed = bitmap(keys, key, most)

    @F.arrow_udf("boolean")
    def hit(slots: pa.Array) -> pa.Array:
        trim_memory()
        return pa.array(held_bits(packed.value, slots.to_numpy(zero_copy_only=False).astype(np.int64)))

    return lambda column: hit(F.pmod(column, F.lit(most)))
