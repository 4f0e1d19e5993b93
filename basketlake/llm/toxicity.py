"""Operator 9: toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import guarded, labelled_rows, long_hash, stored, table, token_words, trim_memory

BUCKETS, SAMPLE_ROWS, TERMS, FACTORS, THRESHOLD = 1 << 20, 20_000, 4_096, 8, 0.3
#: Standard errors and documents with both from which a term counts beside another.
PAIR_Z, PAIR_ROWS = 5, 5


def term_buckets(text: str | None) -> np.ndarray:
    """The distinct hashed words of a text."""
    words = set(token_words(text or ""))
    found = np.fromiter(map(xxhash.xxh32_intdigest, words), dtype=np.int64, count=len(words))
    return np.unique(found & (BUCKETS - 1))


def _terms(text: Column) -> Column:
    @F.arrow_udf("array<int>")
    def terms(texts: pa.Array) -> pa.Array:
        trim_memory()
        return pa.array([term_buckets(t.as_py()).astype(np.int32) for t in texts], type=pa.list_(pa.int32()))

    return terms(text)


class Machine:
    """w0, a weight and FACTORS factors per kept term; a term that is not kept has none."""

    def __init__(self, terms: np.ndarray) -> None:
        self.place = np.full(BUCKETS, -1, dtype=np.int32)
        self.place[terms] = np.arange(len(terms))
        self.w0, self.w = 0.0, np.zeros(len(terms))
        self.v = np.random.default_rng(5).normal(0, 0.05, (len(terms), FACTORS))

    def kept(self, text: str | None) -> np.ndarray:
        at = self.place[term_buckets(text)]
        return at[at >= 0]

    def logit(self, at: np.ndarray) -> float:
        total = self.v[at].sum(0)
        return float(self.w0 + self.w[at].sum() + 0.5 * (total @ total - (self.v[at] ** 2).sum()))

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(self.kept(text)), -40, 40))))

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, rounds: int = 150, rate: float = 0.5, decay: float = 1e-4) -> None:
        """Logistic loss over all rows, AdaGrad steps on w0, the weights and the factors."""
        n = len(rows)
        row = np.repeat(np.arange(n), [len(r) for r in rows])
        at = np.concatenate(rows).astype(np.int64) if row.size else np.zeros(0, dtype=np.int64)
        rate_of = max(1e-6, min(1 - 1e-6, float(labels.mean()))) if n else 0.5
        self.w0 = float(np.log(rate_of / (1 - rate_of)))
        past_w, past_v, past_0 = np.full_like(self.w, 1e-8), np.full_like(self.v, 1e-8), 1e-8
        for _ in range(rounds if row.size else 0):
            # one factor at a time, so that no array has more than one number per word of a document
            logits, total = self.w0 + np.bincount(row, self.w[at], n), np.zeros((n, FACTORS))
            for f in range(FACTORS):
                own = self.v[at, f]
                total[:, f] = np.bincount(row, own, n)
                logits += 0.5 * (total[:, f] ** 2 - np.bincount(row, own**2, n))
            miss = (1 / (1 + np.exp(-np.clip(logits, -40, 40))) - labels) / n
            by_word, size = miss[row], len(self.w)
            g_w = np.bincount(at, by_word, size) + decay * self.w / n
            g_v = decay * self.v / n
            for f in range(FACTORS):
                g_v[:, f] += np.bincount(at, (total[row, f] - self.v[at, f]) * by_word, size)
            g_0 = float(miss.sum())
            past_w += g_w**2
            past_v += g_v**2
            past_0 += g_0**2
            self.w -= rate * g_w / np.sqrt(past_w)
            self.v -= 0.2 * rate * g_v / np.sqrt(past_v)
            self.w0 -= rate * g_0 / np.sqrt(past_0)


def _paired(rows: DataFrame, clear: list[int]) -> list[int]:
    """Terms that are as common in either kind of document, but not beside one of the clear terms.

    Among the documents with the clear term, their share in toxic and other ones differs by PAIR_Z standard errors or
    more; that is more than for single terms, as there are many pairs. At most TERMS of them, the clearest first. The
    sample comes to the driver as one Arrow table of term numbers, and pairs are counted one clear term at a time.
    """
    if not clear:
        return []
    beside = rows.where(F.arrays_overlap("terms", F.lit(clear))).select((F.col("toxic") > 0).alias("toxic"), "terms").toArrow()
    toxic = beside["toxic"].to_numpy().astype(bool)
    lists = beside["terms"].combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.diff(lists.offsets.to_numpy())
    names, at = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
    row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    order = np.argsort(at, kind="stable")
    edges = np.searchsorted(at[order], np.arange(len(names) + 1))
    open_term = (np.diff(edges) >= PAIR_ROWS) & ~np.isin(names, clear)
    keep = open_term[at]
    term, ends = at[keep], np.concatenate(([0], np.cumsum(np.bincount(row[keep], minlength=len(lengths)))))
    best = np.zeros(len(names))
    for anchor in np.searchsorted(names, np.intersect1d(names, clear)):
        own = row[order[edges[anchor] : edges[anchor + 1]]]
        bad, good = own[toxic[own]], own[~toxic[own]]
        if not len(bad) or not len(good):
            continue
        pb, pg = (np.bincount(np.concatenate([term[ends[i] : ends[i + 1]] for i in some]), minlength=len(names)) for some in (bad, good))
        p = (pb + pg) / len(own)
        z = np.abs(pb / len(bad) - pg / len(good)) / np.sqrt(p * (1 - p) * (1 / len(bad) + 1 / len(good)) + 1e-12)
        best = np.maximum(best, np.where(pb + pg >= PAIR_ROWS, z, 0))
    found = np.flatnonzero(best >= PAIR_Z)
    return names[found[np.lexsort((names[found], -best[found]))][:TERMS]].tolist()


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Learns from (doc_id, toxic) on at most sample_rows labelled documents, those of the smallest hashes, and as many rows.

    Terms are kept where their share among toxic and other documents differs by 4 standard errors or more, at most
    TERMS of them, the clearest first, and besides terms that matter beside one of these only (`_paired`), as many
    again at most; single terms are counted by Spark.
    """
    picked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = picked.orderBy(long_hash("doc_id"), "doc_id").limit(sample_rows)
    rows = stored(labelled_rows(docs, picked, sample_rows).select("doc_id", "toxic", _terms(F.col("text")).alias("terms")), "toxic-sample")
    sizes = rows.agg(F.count("*").alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("toxic")).first()
    bad = sizes["toxic"] or 0
    good = sizes["n"] - bad
    if not bad or not good:
        machine = Machine(np.zeros(0, dtype=np.int64))
        machine.w0 = 40.0 if bad else -40.0
        return machine
    counts = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum((F.col("toxic") > 0).cast("long")).alias("b"), F.count("*").alias("n")
    )
    p = F.col("n") / (bad + good)
    z = F.abs(F.col("b") / bad - (F.col("n") - F.col("b")) / good) / F.sqrt(p * (1 - p) * (1 / bad + 1 / good) + 1e-12)
    clear = counts.withColumn("z", z).where("z >= 4 and n >= 3").orderBy(F.desc("z"), "term").limit(TERMS).select("term")
    clear = [r["term"] for r in clear.collect()]
    terms = np.array(clear + _paired(rows, clear), dtype=np.int64)
    machine = Machine(terms)
    kept = F.array_intersect("terms", F.lit(terms.tolist()) if len(terms) else F.array().cast("array<int>"))
    learn = rows.select(F.col("toxic").cast("double").alias("toxic"), kept.alias("kept")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    places = [machine.place[np.array(r["kept"], dtype=np.int64)].astype(np.int64) for r in learn]
    machine.fit(places, np.array([min(1.0, r["toxic"]) for r in learn]))
    return machine


def score(text: Column, machine: Machine, spark) -> Column:
    """The probability of toxicity of whole texts. Null and empty texts have no terms and get the base rate's."""
    shared = spark.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        trim_memory()
        return pa.array([shared.value.score(t.as_py()) for t in texts], type=pa.float64())

    return scored(text)


def clean_documents(docs: DataFrame, labels: DataFrame, spark, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents that score below the threshold, all columns as they were.

    Learns from the labelled rows among the documents. Repeated rows score alike; without labels of both kinds every
    row counts as of the one kind there is, and with none all stay.
    """
    machine = fitted(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    return guarded(docs, lambda d: d.withColumn("__score", score(F.col("text"), machine, spark)).where(F.col("__score") < threshold).select(*d.columns))


def op9(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = lambda: F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    machine = fitted(docs.select("doc_id", "text"), labels.where(fold() != 2).select("doc_id", "toxic"))
    found = docs.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), score(F.col("text"), machine, spark).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
