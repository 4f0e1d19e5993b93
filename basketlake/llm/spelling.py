"""Operator 11: spelling variants by an index of variable-length grams."""

from __future__ import annotations

import zlib
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import stored, table

#: Turns Latin-1 into lower-cased runs of letters (A-Z only) with spaces between; what is outside comes as `?`.
RUN_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))
DAMAGE = 199
#: Grams have 2 to LONGEST characters. One is prolonged where more than FREQUENT words places have it; the dictionary
#: holds DICTIONARY grams at most. Any dictionary gives the same pairs; these only set how many candidates are verified.
SHORTEST, LONGEST, FREQUENT, DICTIONARY = 2, 5, 100, 400_000
#: Length of the grams of words whose variable grams one edit can all affect.
FIXED = 3
#: Entries a task gathers before it hands them on.
GATHERED = 200_000


def counted_words(docs: DataFrame, damage: int | None = DAMAGE, shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n) of the words of whole texts: runs of letters, A-Z lower-cased, at least so long and so frequent.

    With `damage`, a run whose crc32 of `doc_id:run` that number divides loses the code point at crc32 % length, in all
    places of the text. Counts are summed in tasks before they are shuffled, so a frequent word is a row per task.
    """

    def count(batches):
        found: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, n in Counter((text.as_py() or "").encode("latin-1", "replace").translate(RUN_TABLE).split()).items():
                    if len(word) < shortest:
                        continue
                    if damage:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % damage == 0:
                            word = word[: h % len(word)] + word[h % len(word) + 1 :]
                            if len(word) < shortest:
                                continue
                    found[word] += n
            if len(found) >= GATHERED:
                yield _counts(found)
                found.clear()
        yield _counts(found)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counts(found: Counter) -> pa.RecordBatch:
    words = [w.decode("latin-1") if isinstance(w, bytes) else w for w in found]
    return pa.RecordBatch.from_arrays([pa.array(words, type=pa.string()), pa.array(list(found.values()), type=pa.int64())], names=["word", "n"])


def _padded(word: str) -> str:
    """Marks at both ends, so that edits at the ends are edits inside."""
    return f"^{word}$"


def gram_dictionary(words: DataFrame, frequent: int = FREQUENT, most: int = DICTIONARY) -> dict[str, int]:
    """Grams and how many places of words are left to each: those of the shortest length, and those whose beginning is frequent.

    Counted over all words; of the pruned tree, the most frequent grams are kept, a beginning always before what
    prolongs it. The number of places excludes those that a longer gram of the dictionary takes over.
    """

    def count(batches):
        found: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                text = _padded(word)
                for q in range(SHORTEST, LONGEST + 1):
                    found.update(text[i : i + q] for i in range(len(text) - q + 1))
            if len(found) >= GATHERED:
                yield _counts(found)
                found.clear()
        yield _counts(found)

    grams = words.select("word").mapInArrow(count, "word string, n long").groupBy(F.col("word").alias("gram")).agg(F.sum("n").alias("n"))
    grams = stored(grams.where("n > 1"), "spelling-grams")
    begins = grams.where(F.col("n") > frequent).select(F.col("gram").alias("begin"))
    longer = grams.where(F.length("gram") > SHORTEST).join(begins, F.expr("substring(gram, 1, length(gram) - 1)") == F.col("begin")).select("gram", "n")
    kept = grams.where(F.length("gram") == SHORTEST).union(longer).orderBy(F.desc("n"), F.length("gram"), "gram").limit(most)
    left = {r["gram"]: r["n"] for r in kept.collect()}
    for gram, n in sorted(left.items(), key=lambda item: len(item[0])):
        if len(gram) > SHORTEST:
            left[gram[:-1]] -= n
    return left


class Decomposed(NamedTuple):
    """(gram, place) of a word, and how many of them a word within one edit has at least."""

    grams: list[tuple[str, int]]
    shared: int


def decompose(word: str, grams: dict[str, int]) -> Decomposed:
    """The longest gram of the dictionary at each place, without those that lie inside an earlier one.

    `shared` is the number of grams less the most that one edit affects. An edit at place i affects a gram whose search
    in the dictionary looked at character i, and may bring a gram that begins at i or before and covers a later one
    that ends within LONGEST characters from i. All others stay, at the same place or one beside it.
    """
    text = _padded(word)
    kept, covered = [], 0
    for p in range(len(text) - SHORTEST + 1):
        end, most = p + SHORTEST, min(p + LONGEST, len(text))
        seen = end - 1
        if text[p:end] in grams:
            while end < most and text[p : end + 1] in grams:
                end += 1
            seen = min(end, most - 1)
        if end > covered:
            kept.append((p, end, seen))
            covered = end
    affected = max(
        sum(p <= i <= seen or (p >= i and end <= i + LONGEST) for p, end, seen in kept) for i in range(1, len(text))
    )
    return Decomposed([(text[p:end], p) for p, end, _ in kept], len(kept) - affected)


def fixed_grams(word: str) -> Decomposed:
    """All grams of FIXED characters; one edit affects as many of them."""
    text = _padded(word)
    grams = [(text[p : p + FIXED], p) for p in range(len(text) - FIXED + 1)]
    return Decomposed(grams, len(grams) - FIXED)


def _keys(word: str, grams: dict[str, int]) -> list[tuple[int, bool]]:
    """(key, probe): the lists a word is in, and those of words one character longer that it looks into."""
    own = decompose(word, grams)
    systems = [(b"v", own)] if own.shared > 0 else [(b"v", own), (b"f", fixed_grams(word))]
    keys = []
    for name, (found, shared) in systems:
        rare = sorted(found, key=lambda g: (grams.get(g[0], 0), g))
        for gram, p in rare[: len(rare) - max(shared, 1) + 1]:
            stem = name + gram.encode()
            for place, size, probe in ((p, len(word), False), (p, len(word) + 1, True), (p + 1, len(word) + 1, True)):
                keys.append((xxhash.xxh64_intdigest(b"%b %d %d" % (stem, place, size)) - (1 << 63), probe))
    return keys


def near_pairs(words: DataFrame, grams: dict[str, int]) -> DataFrame:
    """(a, na, b, nb): every two words that differ by one inserted, deleted or replaced code point, once.

    Words of a pair share as many grams as either of them keeps under any edit. Of a word that keeps k, it is enough to
    merge the lists of all but the k - 1 most frequent grams. Where one edit can affect all variable grams of both
    words, their fixed grams meet. Lists are apart by place and length of the word, as one edit moves a gram by one
    place at most. What meets is verified by its edit distance.
    """
    shared = words.sparkSession.sparkContext.broadcast(grams)

    def listed(batches):
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start in range(0, len(names), 500):
                out: tuple[list, ...] = ([], [], [], [])
                for word, n in zip(names[start : start + 500], sizes[start : start + 500], strict=True):
                    for key, probe in dict.fromkeys(_keys(word, shared.value)):
                        for column, value in zip(out, (key, probe, word, n), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.bool_(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, kinds, strict=True)], names=["key", "probe", "word", "n"])

    lists = stored(words.select("word", "n").mapInArrow(listed, "key long, probe boolean, word string, n long"), "spelling-lists")
    left = lists.select("key", "probe", F.col("word").alias("a"), F.col("n").alias("na"))
    right = lists.where("not probe").select("key", F.col("word").alias("b"), F.col("n").alias("nb"))
    met = left.join(right, "key").where("(probe or a < b) and levenshtein(a, b, 1) = 1")
    return met.select("a", "na", "b", "nb").distinct()


def variants(words: DataFrame, factor: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word (word, n).

    A word's form is its near word of largest n (ties: smallest in code-point order), if that is at least `factor` times
    the word's own; root follows forms to the last. An empty table gives no rows; null words are left out.
    """
    words = stored(words.where("word is not null"), "spelling-words")
    pairs = stored(near_pairs(words, gram_dictionary(words)), "spelling-pairs")
    both = pairs.union(pairs.select("b", "nb", "a", "na"))
    best = both.groupBy(F.col("a").alias("word"), F.col("na").alias("n")).agg(
        F.count("*").alias("n_near"), F.min_by(F.struct("b", "nb"), F.struct(-F.col("nb"), "b")).alias("best")
    )
    heavy = F.col("best.nb") >= factor * F.col("n")
    near = stored(
        best.select("word", "n_near", F.when(heavy, F.col("best.b")).alias("form"), F.when(heavy, F.col("best.nb")).alias("form_n")), "spelling-near"
    )
    roots = forms_followed(near.where("form is not null").select("word", F.col("form").alias("root")))
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )


def forms_followed(steps: DataFrame) -> DataFrame:
    """(word, root): each word's last form, by jumps of doubling length; n grows with each form, so there is no circle."""
    while True:
        steps = stored(steps, "spelling-roots")
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if steps.join(onward, "root", "left_semi").isEmpty():
            return steps
        steps = steps.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))


def op11(spark, sf_dir: str) -> DataFrame:
    return variants(counted_words(table(spark, sf_dir, "documents")))
