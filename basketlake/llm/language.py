"""Operator 6: language identification, family first, then one-versus-one linear support vector machines."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlake.llm.common import long_hash, stored, table

BUCKETS, SAMPLE_ROWS, CHUNK_BYTES = 1 << 14, 6_000, 4 << 20
#: Families of languages by ISO 639-1 code; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en is nb nl nn no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr uz",
    "indic": "bn gu hi mr ne pa ur",
}
FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
LETTER = regex.compile(r"\p{L}")
#: Letters a-z and bytes of non-ASCII characters stay, all else is a space.
LETTERS = np.array([c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)], dtype=np.uint8)


def gram_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of the bytes of lower-cased texts, all in one array, and where each text starts and ends in it."""
    lower = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    lower = lower.combine_chunks() if isinstance(lower, pa.ChunkedArray) else lower
    at = np.frombuffer(lower.buffers()[1], dtype=np.int64)[lower.offset : lower.offset + len(lower) + 1]
    data = np.frombuffer(lower.buffers()[2] or b"", dtype=np.uint8)[at[0] : at[-1]]
    b = LETTERS[data].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, dtype=np.uint32), at[:-1] * 0, at[:-1] * 0
    code = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    at = at - at[0]
    starts = np.minimum(at[:-1], len(code))
    return code * np.uint32(2654435761) >> np.uint32(32 - 14), starts, np.clip(at[1:] - 2, starts, len(code))


def sums(texts: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the mean of the weights of its trigrams, for each column of weights, and the number of trigrams."""
    out, counts = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts), dtype=np.int64)
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + CHUNK_BYTES, side="right")))
        buckets, a, b = gram_buckets(texts.slice(start, end - start))
        for c in range(weights.shape[1]):
            total = np.concatenate(([0.0], np.cumsum(weights[buckets, c], dtype=np.float64)))
            out[start:end, c] = (total[b] - total[a]) / np.maximum(b - a, 1)
        counts[start:end] = b - a
        start = end
    return out, counts


def linear_svm(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, rounds: int = 12, c: float = 1.0) -> np.ndarray:
    """Weights of a linear SVM with hinge loss, by dual coordinate descent over sparse rows of length 1."""
    w, alpha = np.zeros(BUCKETS), np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            new = min(c, max(0.0, alpha[i] + 1 - signs[i] * float(w[at] @ x)))
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * signs[i] * x
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


class Model:
    """One-versus-one machines between families and between the languages of each family."""

    def __init__(self, rows: list[tuple[str, np.ndarray, np.ndarray]]) -> None:
        languages = sorted({r[0] for r in rows})
        self.members: dict[str, list[str]] = {}
        for lang in languages:
            self.members.setdefault(FAMILY.get(lang, lang), []).append(lang)
        self.pairs, columns, self.scale = [], [], []
        levels = [("family", sorted(self.members), lambda lang: FAMILY.get(lang, lang))]
        levels += [(name, langs, lambda lang: lang) for name, langs in sorted(self.members.items())]
        for level, names, name_of in levels:
            for a, b in combinations(names, 2):
                own = [(name_of(lang), at, n) for lang, at, n in rows if name_of(lang) in (a, b)]
                signs = np.array([1.0 if name == a else -1.0 for name, _, _ in own])
                w = linear_svm([(at, n / np.linalg.norm(n)) for _, at, n in own], signs)
                margins = np.array([float(w[at] @ n) / n.sum() for _, at, n in own])
                self.pairs.append((level, a, b))
                columns.append(w)
                self.scale.append(4.0 / max(1e-9, float(np.median(np.abs(margins)))))
        self.weights = np.array(columns).T if columns else np.zeros((BUCKETS, 0))

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        means, counts = sums(texts, self.weights)
        sure = 1 / (1 + np.exp(-np.clip(means * np.array(self.scale), -50, 50)))
        langs, scores = [], []
        for text, row, n in zip(texts, sure, counts, strict=True):
            value = text.as_py()
            if value is None or not self.members or not LETTER.search(value):
                langs.append("und")
                scores.append(0.0)
                continue
            family, p = self._choose("family", sorted(self.members), row)
            lang, q = self._choose(family, self.members[family], row)
            langs.append(lang)
            scores.append(p * q if n else 0.0)
        return langs, scores

    def _choose(self, level: str, names: list[str], row: np.ndarray) -> tuple[str, float]:
        """The name with the highest mean probability over its pairs; ties to the first name."""
        if len(names) == 1:
            return names[0], 1.0
        total = dict.fromkeys(names, 0.0)
        for (where, a, b), p in zip(self.pairs, row, strict=True):
            if where == level:
                total[a] += float(p)
                total[b] += 1 - float(p)
        best = max(names, key=lambda x: total[x])
        return best, total[best] / (len(names) - 1)


def fitted(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from (text, lang) on at most sample_rows different texts, as many of each language as the table has, by smallest hash."""
    named = rows.where("lang is not null and text is not null").withColumn("h", long_hash("text"))
    n_langs = named.agg(F.count_distinct("lang")).first()[0]
    if not n_langs:
        return Model([])
    each = max(1, sample_rows // n_langs)
    # smallest hashes per language, each once however many copies it has; the rank limit is applied before the shuffle, too
    w = Window.partitionBy("lang").orderBy("h")
    cut = named.select("lang", "h").distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= each).groupBy("lang").agg(F.max("h").alias("most"))
    picked = named.join(F.broadcast(cut), "lang").where("h <= most").dropDuplicates(["lang", "h"]).select("lang", "text")

    def features(batches):
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                buckets, a, b = gram_buckets(pa.array([text.as_py()]))
                at, n = np.unique(buckets[a[0] : b[0]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang.as_py()]), pa.array([at.astype(np.int32)], type=pa.list_(pa.int32())), pa.array([n.astype(np.int32)], type=pa.list_(pa.int32()))],
                    names=["lang", "at", "n"],
                )

    got = stored(picked.mapInArrow(features, "lang string, at array<int>, n array<int>"), "language-sample")
    rows = [(r["lang"], np.array(r["at"], dtype=np.int64), np.array(r["n"], dtype=np.float64)) for r in got.where("size(at) > 0").orderBy("lang", F.xxhash64("at")).toLocalIterator()]
    return Model(rows)


def identify(text: Column, model: Model, spark) -> Column:
    """(lang_pred, score) of whole texts: the family's probability times that of the language within it.

    A null text, or one without any letter, is `und` with score 0. A text of fewer than three bytes with a letter gets
    a language with score 0. Without anything to learn from all texts are `und`.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string, score:double>")
    def predicted(texts: pa.Array) -> pa.Array:
        langs, scores = shared.value.predict(texts)
        return pa.StructArray.from_arrays([pa.array(langs, type=pa.string()), pa.array(scores, type=pa.float64())], names=["lang_pred", "score"])

    return predicted(text)


def op6(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = fitted(docs.where(fold != 1).select("text", "lang"))
    found = docs.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), identify(F.col("text"), model, spark).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang_pred").alias("lang_pred"), F.col("p.score").alias("score"))
