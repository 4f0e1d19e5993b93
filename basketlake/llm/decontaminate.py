"""Operator 8: benchmark decontamination with a suffix automaton of the test items."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.llm.automaton import SuffixAutomaton, covered, known_runs
from basketlake.llm.common import guarded, TOKEN_TABLE, stored, table, token_words, trim_memory

WINDOW, BLOCK_WORDS, LEAST_SHARE = 13, 50_000, 20
HITS = "struct<n_words:long, starts:array<int>, ends:array<int>, items:array<string>>"


class ItemMatcher:
    """The windows of some items: runs of `window` words, or the whole of a shorter item."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        self.window, self.vocabulary, self.automaton = window, {}, SuffixAutomaton()
        rows = []
        for item_id, text in items:
            words = token_words(text)
            if words:
                rows.append((item_id, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]))
                self.automaton.add(rows[-1][1])
        self.least = min([window, *(len(ids) for _, ids in rows)])
        self.full: dict[int, set[str]] = defaultdict(set)
        self.short: dict[int, dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item_id, ids in rows:
            walked = self.automaton.stream(ids)
            if len(ids) < window:
                self.short[walked[-1][0]][len(ids)].add(item_id)
            else:
                for state, _ in walked[window - 1 :]:
                    self.full[self._window_state(state)].add(item_id)
        self.shorter = {s: self._short_chain(s) for s in range(len(self.automaton.length))} if self.short else {}

    def _window_state(self, state: int) -> int:
        link, length = self.automaton.link, self.automaton.length
        while length[link[state]] >= self.window:
            state = link[state]
        return state

    def _short_chain(self, state: int) -> list[tuple[int, set[str]]]:
        out = []
        while state > 0:
            out += list(self.short[state].items()) if state in self.short else []
            state = self.automaton.link[state]
        return out

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(start, end) of the words inside matches, and the items whose windows occur."""
        ids = np.fromiter((self.vocabulary.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        items: set[str] = set()
        for a, b in known_runs(ids, self.least):
            for i, (state, matched) in enumerate(self.automaton.stream(ids[a:b].tolist()), a + 1):
                if matched >= self.window:
                    # a match that grows replaces what it grew from
                    if spans and spans[-1][0] == i - matched:
                        spans[-1] = (i - matched, i)
                    else:
                        spans.append((i - matched, i))
                    states.add(state)
                for n, found in self.shorter.get(state, ()):
                    if n <= matched:
                        spans.append((i - n, i))
                        items |= found
        for state in states:
            items |= self.full.get(self._window_state(state), set())
        return spans, items


@lru_cache(maxsize=1)
def _matcher(items: tuple[tuple[str, str], ...], window: int) -> ItemMatcher:
    return ItemMatcher(list(items), window)


def _hits(text: Column, before: Column | None, items: list[tuple[str, str]], window: int) -> Column:
    shared = tuple(items)

    @F.arrow_udf(HITS)
    def found(texts: pa.Array, *earlier: pa.Array) -> pa.Array:
        trim_memory()
        matcher, out = _matcher(shared, window), []
        for i, t in enumerate(texts):
            words = token_words(t.as_py() or "")
            spans, names = matcher.spans(words) if matcher.vocabulary else ([], set())
            if earlier:
                old = earlier[0][i].as_py()
                spans += list(zip(old["starts"], old["ends"], strict=True))
                names |= set(old["items"])
            spans = sorted(set(spans))
            out.append({"n_words": len(words), "starts": [s for s, _ in spans], "ends": [e for _, e in spans], "items": sorted(names)})
        kind = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
        return pa.array(out, type=kind)

    return found(text) if before is None else found(text, before)


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """Lists of (item_id, text), each of some block_words words; one list is on the driver at a time."""
    items = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), "text", F.size(F.split("text", r"[\x00-\x2F]+")).alias("n")
    )
    n = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-n // block_words))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        yield b == blocks - 1, [(r["item_id"], r["text"]) for r in items.where(block == b).collect()]


def with_hits(docs: DataFrame, benchmark: DataFrame, column: str, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """documents with a struct of the word count, the matched word spans and the items found in each whole text.

    Items are normalised to words and put into suffix automata of some block_words words, so what a task holds does
    not grow with the benchmark. Texts stream through an automaton, which gives the longest match that ends at each
    word; matches of `window` words, or of a whole shorter item, are spans. Several automata are run one after
    another, each over all documents. Null texts have no words; items that are null, empty or without an id match
    nothing; items with one id count once; repeated rows are judged alike.
    """
    before = None
    for last, items in item_blocks(benchmark, block_words):
        docs = docs.withColumn(column, _hits(F.col("text"), before, items, window))
        before = F.col(column)
        docs = docs if last else stored(docs, "decontaminate")
    return docs


def judged(hits: Column) -> Column:
    """(n_words, n_hit, n_items, items_sha256, contaminated) of a document; contaminated: 5 % of its words are hit."""

    @F.arrow_udf("struct<n_hit:long, items_sha256:string>")
    def count(rows: pa.Array) -> pa.Array:
        out = []
        for r in rows:
            r = r.as_py()
            spans = list(zip(r["starts"], r["ends"], strict=True))
            n = int(covered(spans, r["n_words"]).sum()) if spans else 0
            out.append({"n_hit": n, "items_sha256": hashlib.sha256(",".join(r["items"]).encode()).hexdigest()})
        return pa.array(out, type=pa.struct([("n_hit", pa.int64()), ("items_sha256", pa.string())]))

    return count(hits)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document what of it the benchmark covers."""
    found = with_hits(docs.select("doc_id", "text"), benchmark, "hits", window).withColumn("j", judged(F.col("hits")))
    n, hit = F.col("hits.n_words"), F.col("j.n_hit")
    return found.select(
        "doc_id", n.alias("n_words"), hit.alias("n_hit"), F.size("hits.items").cast("long").alias("n_items"),
        F.col("j.items_sha256").alias("items_sha256"), ((hit > 0) & (LEAST_SHARE * hit >= n)).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents that are not contaminated, as they are; order and columns stay."""
    dirty = (F.col("__hit") > 0) & (LEAST_SHARE * F.col("__hit") >= F.col("__hits.n_words"))

    def clean(rows: DataFrame) -> DataFrame:
        found = with_hits(rows, benchmark, "__hits").withColumn("__hit", judged(F.col("__hits"))["n_hit"])
        return found.where(~dirty).select(*rows.columns)

    return guarded(docs, clean)


def without_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """clean_documents, and from what stays the matched words are cut out, each span replaced by a space."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, rows: pa.Array) -> pa.Array:
        return pa.array([_cut(t.as_py(), r.as_py()) for t, r in zip(texts, rows, strict=True)], type=pa.string())

    found = with_hits(clean_documents(docs, benchmark), benchmark, "__hits")
    return found.withColumn("text", cut(F.col("text"), F.col("__hits"))).select(*docs.columns)


def _cut(text: str | None, hits: dict) -> str | None:
    if not hits["starts"]:
        return text
    data = text.encode("utf-8", "surrogatepass")
    flags = np.frombuffer(bytes(1 if x == 0x20 else 0 for x in data.translate(TOKEN_TABLE)), dtype=np.int8)
    edge = np.flatnonzero(np.diff(np.concatenate(([1], flags, [1]))))
    starts, ends = edge[::2], edge[1::2]
    mask = covered(list(zip(hits["starts"], hits["ends"], strict=True)), len(starts))
    out, at = [], 0
    for a, b, hit in zip(starts, ends, mask, strict=True):
        if hit:
            out += [data[at:a], b" "]
            at = b
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def op8(spark, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP8_SQL = r"""
WITH norm AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, norm
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, norm
), iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS p FROM i WHERE len(w) > 0)
), n AS (SELECT DISTINCT n FROM iw
), dw AS (
  SELECT doc_id, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win
  FROM (SELECT d.*, n.n, unnest(range(1, len(w) - n.n + 2)) AS p FROM d, n WHERE len(w) >= n.n)
), m AS (
  SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n
), h AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT cast(item_id AS VARCHAR), ',' ORDER BY cast(item_id AS VARCHAR)) AS names
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
