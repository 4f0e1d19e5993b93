"""Operator 7: a quality classifier by importance resampling with hashed n-gram models and Gumbel top-k."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import guarded, labelled_rows, long_hash, stored, table, trim_memory

BUCKETS, SAMPLE_ROWS, SMOOTHING, TEMPERATURE, REJECT_COST = 1 << 16, 20_000, 0.5, 0.1, 50.0
TOKENS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")


def gram_buckets(text: str | None) -> np.ndarray:
    """Hashed unigrams and bigrams of words and runs of punctuation, repeats included; case is kept."""
    found = TOKENS.findall((text or "").encode("utf-8", "surrogatepass"))
    one = np.fromiter(map(zlib.crc32, found), dtype=np.uint32, count=len(found))
    two = (one[:-1] * np.uint32(0x9E3779B1) ^ one[1:]) * np.uint32(0x85EBCA6B)
    return np.concatenate((one, two)) >> np.uint32(16)


def gram_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in a table (text): one row per bucket and task is shuffled."""

    def count(batches):
        trim_memory()
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for t in batch.column(0):
                total += np.bincount(gram_buckets(t.as_py()), minlength=BUCKETS) if t.is_valid else 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, type=pa.int64()), pa.array(total[at], type=pa.int64())], names=["bucket", "n"])

    out = np.zeros(BUCKETS)
    for r in texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


class Ratio:
    """Log ratios of the target's to the raw text's model per bucket, and the mean ratio that divides them."""

    def __init__(self, target: np.ndarray, raw: np.ndarray) -> None:
        share = lambda n: np.log((n + SMOOTHING) / (n.sum() + SMOOTHING * BUCKETS))
        self.table, self.cut = share(target) - share(raw), 0.0

    def mean(self, text: str | None) -> tuple[float, int]:
        at = gram_buckets(text)
        return (float(self.table[at].mean()) if len(at) else 0.0), len(at)


def _best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut with the least cost, a rejected good document counting REJECT_COST accepted bad ones; halfway in its gap."""
    if not len(good) or not len(bad):
        return -np.inf
    values = np.unique(np.concatenate((good, bad)))
    cuts = np.concatenate(([values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]))
    lost = np.searchsorted(np.sort(good), cuts) / len(good)
    passed = 1 - np.searchsorted(np.sort(bad), cuts) / len(bad)
    cost = REJECT_COST * lost + passed
    least = np.flatnonzero(cost <= cost.min() + 1e-12)
    return float((cuts[least[0]] + cuts[least[-1]]) / 2)


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Ratio:
    """The raw model counts all documents; the target model and the cut come from at most sample_rows labelled ones."""
    spark = docs.sparkSession
    picked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = picked.orderBy(long_hash("doc_id"), "doc_id").limit(sample_rows)
    rows = stored(labelled_rows(docs, picked, sample_rows).select("text", "quality"), "quality-sample")
    ratio = Ratio(gram_counts(rows.where("quality = 1")), gram_counts(docs))
    means = [(r["quality"], r["m"]) for r in rows.select("quality", weight(F.col("text"), ratio, spark)["mean"].alias("m")).collect()]
    ratio.cut = _best_cut(np.array([m for q, m in means if q == 1]), np.array([m for q, m in means if q != 1]))
    return ratio


def weight(text: Column, ratio: Ratio, spark) -> Column:
    """(mean, log_weight) of whole texts; log_weight sums the log ratios above the cut, and is 0 for texts without tokens."""
    shared = spark.sparkContext.broadcast(ratio)

    @F.arrow_udf("struct<mean:double, log_weight:double>")
    def weighed(texts: pa.Array) -> pa.Array:
        trim_memory()
        got = [shared.value.mean(t.as_py()) for t in texts]
        cut = shared.value.cut
        sums = [n * (m - cut) if np.isfinite(cut) else float(n) for m, n in got]
        return pa.StructArray.from_arrays([pa.array([m for m, _ in got], type=pa.float64()), pa.array(sums, type=pa.float64())], names=["mean", "log_weight"])

    return weighed(text)


def gumbel(seed: int = 11) -> Column:
    """Standard Gumbel noise that belongs to a row's doc_id and text, so that a second run of a task draws the same."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def _ordered(column: Column) -> Column:
    """Long integers in the order of the doubles."""

    @F.arrow_udf("long")
    def ordered(values: pa.Array) -> pa.Array:
        trim_memory()
        bits = np.ascontiguousarray(values.to_numpy(zero_copy_only=False), dtype=np.float64).view(np.int64)
        return pa.array(bits ^ ((bits >> 63) & 0x7FFFFFFFFFFFFFFF))

    return ordered(column)


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The order number of the k-th largest value, exactly: four passes count 16 bits at a time, 65,536 counts at most."""
    if k <= 0:
        return None
    keyed = stored(rows.select(_ordered(F.col(column)).alias("o")), "kth")
    known, left = None, k
    for shift in (48, 32, 16, 0):
        open_rows = keyed if known is None else keyed.where(F.shiftright("o", shift + 16) == known)
        counts = sorted(((r["p"], r["n"]) for r in open_rows.groupBy(F.shiftright("o", shift).alias("p")).agg(F.count("*").alias("n")).collect()), reverse=True)
        for known, n in counts:
            if left <= n:
                break
            left -= n
    return known


def resampled(docs: DataFrame, labels: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """documents with __w (mean, log_weight), __key and __kept: Gumbel top-k over importance weights.

    A weight is the ratio of the models of target text (labelled quality 1) and of all text, per token relative to the
    cut that divides the labels best. The k documents with the largest key = log_weight + temperature * Gumbel noise
    stay, where k is the number of weights of 1 and more; ties with the k-th stay, too. Texts without tokens weigh 1,
    nulls as well. Without labels of both kinds every document stays. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ratio = fitted(docs, labels)
    weighed = docs.withColumn("__w", weight(F.col("text"), ratio, spark))
    keyed = weighed.withColumn("__key", F.col("__w.log_weight") + temperature * gumbel())
    keys = stored(keyed.select("__key", (F.col("__w.log_weight") >= 0).alias("good")), "quality-keys")
    k = keys.where("good").count()
    least = kth_largest(keys, "__key", k)
    return keyed.withColumn("__kept", F.lit(False) if least is None else _ordered(F.col("__key")) >= least)


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of documents that the sample keeps, all columns as they were."""
    return guarded(docs, lambda d: resampled(d, labels).where("__kept").select(*d.columns))


def op7(spark, sf_dir: str) -> DataFrame:
    found = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", F.col("__w.log_weight").alias("log_weight"), F.col("__key").alias("gumbel_key"), F.col("__kept").alias("selected"))
