"""Season tags: plain searches, with the results of the patterns before; price books over many tasks."""

import re

from pyspark.sql import functions as F

from basketlake.fixed_values import CATEGORY_SEASONS, SEASON_RULES
from basketlake.functions import text
from basketlake.operators import catalogue
from basketlake.sources import sample


def expected(description, category):
    words = f"{description or ''} {category or ''}".upper()
    for season, keywords in SEASON_RULES:
        if re.search("|".join(keywords), words):
            return season
    return CATEGORY_SEASONS.get((category or "").upper(), "flat")


def test_tags_are_found_without_patterns(spark):
    keywords = [k for _, rule in SEASON_RULES for k in rule]
    given = [(f"x{k.lower()}y", None) for k in keywords] + [(a + b, None) for a, b in zip(keywords, keywords[7:], strict=False)]
    given += [(None, c) for c in CATEGORY_SEASONS] + [("tea", "x"), ("tea", None), ("", ""), (None, None), ("p.ach", "gräpes")]
    tagged = spark.createDataFrame(given, "d string, c string").select("d", "c", text.season_tag(F.col("d"), F.col("c")).alias("s"))
    assert "RLIKE" not in tagged._jdf.queryExecution().executedPlan().toString().upper()
    assert [tuple(r) for r in tagged.collect()] == [(d, c, expected(d, c)) for d, c in given]


def test_a_price_book_is_cleaned_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "stored", lambda rows, name: rows)
    cleaned = catalogue.clean(sample.price_book(spark, "/root/testdata/sf0.001"))
    assert "REPARTITION_BY_COL" in cleaned._jdf.queryExecution().executedPlan().toString()
