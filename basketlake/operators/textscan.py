"""Looking for credentials in texts and in change histories."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketlake.fixed_values import SECRET_PATTERNS, SNIPPET_LENGTH

DIFF_HEADER = r"^diff --git a/(.+?) b/(.+)$"
BLANK = r"^\s*\z"


def _newlines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def _hits(number: int, pattern: str, label: str) -> Column:
    """The hits of one pattern with the line breaks before each; null where there is none."""
    hits = F.regexp_extract_all("text", F.lit(pattern), 0)
    parts = F.slice(F.split("text", pattern, -1), F.lit(1), F.size(hits))
    pairs = F.arrays_zip(hits.alias("hit"), F.transform(parts, _newlines).alias("breaks"))
    rows = F.transform(
        pairs,
        lambda pair, nth: F.struct(
            nth.alias("nth"), F.lit(number).alias("pattern_no"), F.lit(label).alias("label"),
            pair["hit"].alias("hit"), pair["breaks"].alias("breaks"),
        ),
    )
    return F.when(F.col("text").rlike(pattern), rows)


def scan(
    texts: DataFrame, allowed: DataFrame | None = None, patterns=SECRET_PATTERNS, keys: tuple[str, ...] = ("place",)
) -> DataFrame:
    """Every hit of every pattern: (place, line, label, snippet).

    Texts are read once for all patterns; those without a hit leave the plan at the filter. Between the hits of a pattern lie the parts that
    splitting by it leaves, so line numbers are running sums of line breaks over the hits of one text.
    """
    if allowed is not None:
        texts = texts.join(allowed, list(keys), "left_anti")
    any_hit = reduce(or_, [F.col("text").rlike(pattern) for pattern, _ in patterns])
    hits = F.array_compact(F.array(*[_hits(n, pattern, label) for n, (pattern, label) in enumerate(patterns)]))
    found = texts.where(any_hit).select(*keys, F.explode(F.flatten(hits)).alias("_hit")).select(*keys, "_hit.*")
    upto = W.partitionBy(*keys, "pattern_no").orderBy("nth").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = F.sum(F.col("breaks") + _newlines(F.col("hit"))).over(upto) - _newlines(F.col("hit"))
    snippet = F.replace(F.substring("hit", 1, SNIPPET_LENGTH), F.lit("\n"), F.lit(" "))
    return found.select(*keys, (before + 1).cast("long").alias("line"), "label", snippet.alias("snippet"))


def scan_summary(hits: DataFrame) -> DataFrame:
    """Hits and affected texts per label."""
    per_place = hits.groupBy("label", "place").agg(F.count(F.lit(1)).alias("hits"))
    return per_place.groupBy("label").agg(F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("places"))


def continued(line: Column, patterns=SECRET_PATTERNS) -> Column:
    """Whether a hit may run on from this line to the next one that is not blank.

    A pattern crosses lines only where it says `\\s*` or `\\s+`. A hit that goes on has the parts up to such a place at
    the end of the line, or the line is nothing but parts from the middle.
    """
    tests = []
    for pattern, _ in patterns:
        flag = "(?i)" if pattern.startswith("(?i)") else ""
        parts = re.split(r"\\s[*+]", pattern.removeprefix("(?i)"))
        for i in range(1, len(parts)):
            tests.append(flag + r"\s*".join(f"(?:{p})" for p in parts[:i]) + r"\s*\z")
            for j in range(i + 1, len(parts)):
                tests.append(flag + r"^\s*" + r"\s*".join(f"(?:{p})" for p in parts[i:j]) + r"\s*\z")
    return reduce(or_, [line.rlike(t) for t in tests], F.lit(False))


def _carried(rows: DataFrame, **marks: Column) -> DataFrame:
    """For each block of a file, the last values of the marks in earlier blocks that are not null."""
    last = rows.groupBy("file", "block").agg(*[F.max_by(m, F.when(m.isNotNull(), F.col("ord"))).alias(name) for name, m in marks.items()])
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return last.select("file", "block", *[F.last(name, ignorenulls=True).over(earlier).alias(name) for name in marks])


def scan_history(lines: DataFrame, allowed: DataFrame | None = None, patterns=SECRET_PATTERNS) -> DataFrame:
    """The same over a change history, split by file: (file, segment, place, line, label, snippet).

    Takes (file, block, ord, line) with dense numbers inside a file's diff; a block is what one task reads. Header lines
    start a segment; lines before the first one belong to no file. A line from which no hit can run on, behind another
    such line, is scanned by itself. The others are joined with what they run on to, over blank lines and the ends of
    blocks, and scanned together, so hits and their line numbers are those of the whole segment, wherever its blocks
    are cut. Windows stay inside a block; one row a block carries the state over.
    """
    is_header = F.col("line").rlike(DIFF_HEADER)
    solid = ~F.col("line").rlike(BLANK)
    marked = lines.withColumns({
        "_start": F.when(is_header, F.struct(F.col("ord").alias("ord"), F.regexp_extract("line", DIFF_HEADER, 2).alias("name"))),
        "_open": F.when(is_header, False).when(solid, continued(F.col("line"), patterns)),
    })
    in_block = W.partitionBy("file", "block").orderBy("ord")
    upto, before = in_block.rowsBetween(W.unboundedPreceding, W.currentRow), in_block.rowsBetween(W.unboundedPreceding, -1)
    state = _carried(marked, _start_before=F.col("_start"), _open_before=F.col("_open"))
    placed = (
        marked.withColumns({
            "_start": F.last("_start", ignorenulls=True).over(upto), "_after_open": F.last("_open", ignorenulls=True).over(before)
        })
        .join(state, ["file", "block"])
        .withColumns({
            "_start": F.coalesce("_start", "_start_before"), "_after_open": F.coalesce("_after_open", "_open_before", F.lit(False)),
        })
        .where(~is_header & F.col("_start").isNotNull() & (solid | F.col("_after_open")))
        .select(
            "file", "block", "ord", "line", F.col("_start.ord").alias("segment"), F.col("_start.name").alias("place"),
            F.coalesce("_open", F.lit(True)).alias("_open"), "_after_open",
        )
    )
    if allowed is not None:
        placed = placed.join(allowed, "place", "left_anti")
    alone = placed.where("not _open and not _after_open").withColumn("text", F.col("line"))
    keys = ("file", "segment", "place", "ord")
    number = (F.col("ord") - F.col("segment")).alias("number")
    single = scan(alone.select(*keys, "text"), patterns=patterns, keys=keys).withColumn("line", number)
    linked = placed.where("_open or _after_open")
    first = F.when(~F.col("_after_open"), F.col("ord"))
    islands = (
        linked.withColumn("_island", F.last(first, ignorenulls=True).over(upto))
        .join(_carried(linked, _island_before=first), ["file", "block"])
        .groupBy("file", "segment", "place", F.coalesce("_island", "_island_before").alias("ord"))
        .agg(F.array_sort(F.collect_list(F.struct(number, "line"))).alias("rows"))
    )
    texts = islands.withColumn("text", F.array_join(F.transform("rows", lambda r: r["line"]), "\n"))
    hits = scan(texts.select(*keys, "text"), patterns=patterns, keys=keys)
    together = hits.join(islands.select(*keys, "rows"), list(keys)).withColumn("line", F.element_at("rows", F.col("line").cast("int"))["number"])
    columns = ("file", "segment", "place", "line", "label", "snippet")
    return single.select(*columns).union(together.select(*columns))
