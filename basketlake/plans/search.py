"""Product search by name or barcode."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.fixed_values import SEARCH_STOP_WORDS, STEM_MIN_RESULT, STEM_MIN_WORD, STEM_SUFFIXES
from basketlake.functions.numbers import ratio
from basketlake.functions.text import strip_zeros
from basketlake.operators import baskets
from basketlake.operators.resolve import contains_all
from basketlake.plans.lake import Lake
from basketlake.plans.reports import MONEY, in_scope, item_code, money_sums, ranked_list, sales


def stem_word(word: str) -> str:
    """Python form of functions.text.stem, for the words of one query."""
    w = word.strip().lower()
    cut = next((n for suffix, n in STEM_SUFFIXES if w.endswith(suffix)), 0)
    long_enough = len(w) >= STEM_MIN_WORD and len(w) - cut >= STEM_MIN_RESULT
    return w[: len(w) - cut] if cut and long_enough else w


def query_terms(query: str) -> list[str]:
    """Stemmed words of a query without filler words."""
    words = query.replace(",", " ").split()
    return [stem_word(w) for w in words if w.lower() not in SEARCH_STOP_WORDS]


def query_barcode(query: str) -> str | None:
    """The barcode in a query without its zeros, None when the query is words."""
    digits = re.sub(r"[^0-9]", "", query)
    if len(digits) < 5 or re.search(r"[a-zA-Z]{2,}", query):
        return None
    return digits.lstrip("0") or digits


def _is_barcode(code: str) -> Column:
    return (strip_zeros(F.col("item_id")) == code) | F.col("item_id").endswith(code)


def _matching(lake: Lake, query: str, period: str, store_id: str | None, *columns: str) -> DataFrame:
    terms = query_terms(query)
    if not terms:
        raise ValueError("give a product name or barcode")
    rows = sales(lake, period, ("item_desc", "item_id", "product_key", *columns), store_id=store_id)
    return rows.where(contains_all("item_desc", terms))


def search_totals(lake: Lake, query: str, period: str = "last_30_days", store_id: str | None = None) -> DataFrame:
    """Totals over every match, whatever a list is cut to."""
    rows = _matching(lake, query, period, store_id, *MONEY)
    by_item = rows.groupBy("product_key", "item_id").agg(*[F.sum(m).alias(m) for m in MONEY])
    by_product = by_item.groupBy("product_key").agg(
        *[F.sum(m).alias(m) for m in MONEY]
    )
    barcodes = by_item.agg(F.count_distinct("item_id").alias("n")).scalar()
    return by_product.agg(F.count(F.lit(1)).alias("products"), *money_sums(*MONEY)).withColumn("barcodes", barcodes)


def _grouped(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """Per product or barcode: sums, mean price, exact baskets and barcodes; the largest first."""
    groups = baskets.grouped(rows.withColumn("grp", F.col(key)), ["grp"], [
        F.min("item_desc").alias("item_desc"), F.min("department_name").alias("department_name"),
        F.min("category_name").alias("category_name"), F.count_distinct("item_id").alias("barcodes"),
        *money_sums(*MONEY), F.sum("price_sum").cast("double").alias("_price"), F.sum("line_count").alias("_lines"),
    ])
    return ranked_list(groups, [F.desc("revenue"), F.col("grp")], limit).select(
        "position", "grp", "item_desc", "department_name", "category_name", "barcodes", "baskets", *MONEY,
        ratio(F.col("_price"), F.col("_lines")).alias("avg_price"),
        ratio(F.col("margin"), F.col("revenue"), 100.0).alias("margin_pct"), "more_exist",
    )


_LISTED = ("department_name", "category_name", baskets.SET_COLUMN, "price_sum", "line_count", *MONEY)


def search_items(
    lake: Lake, query: str, period: str = "last_30_days", limit: int = 25, store_id: str | None = None,
    group_duplicates: bool = True,
) -> DataFrame:
    """Sales of the products whose description has every word of the query."""
    rows = _matching(lake, query, period, store_id, *_LISTED)
    return _grouped(rows, "product_key" if group_duplicates else "item_id", limit)


def search_relaxed(
    lake: Lake, query: str, period: str = "last_30_days", limit: int = 25, store_id: str | None = None
) -> DataFrame:
    """As search_items; when no row has every word, the longest words that some row has decide.

    Each row is graded once by how many of the words, longest first, it has without a gap. The best
    grade of any row is a scalar subquery.
    """
    terms = sorted(query_terms(query), key=len, reverse=True)
    rows = sales(lake, period, ("item_desc", "item_id", "product_key", *_LISTED), store_id=store_id)
    grade = reduce(
        lambda done, n: F.when(contains_all("item_desc", terms[:n]), F.lit(n)).otherwise(done),
        range(1, len(terms) + 1), F.lit(0),
    )
    graded = rows.withColumn("_grade", grade).where(F.col("_grade") > 0)
    best = graded.agg(F.max("_grade").alias("best")).scalar()
    listed = _grouped(graded.where(F.col("_grade") == best), "product_key", limit)
    return listed.withColumn("terms_used", best)


def search_barcode(
    lake: Lake, query: str, period: str = "last_30_days", store_id: str | None = None
) -> DataFrame:
    """Sales of one barcode, whatever its padding."""
    code = query_barcode(query)
    rows = sales(lake, period, ("item_id", "item_desc", "department_name", *MONEY), store_id=store_id)
    return (
        rows.where(_is_barcode(code))
        .groupBy("item_id")
        .agg(F.min("item_desc").alias("item_desc"), F.min("department_name").alias("department_name"), *money_sums(*MONEY))
        .withColumn("margin_pct", ratio(F.col("margin"), F.col("revenue"), 100.0))
    )


def search_barcode_catalogue(
    lake: Lake, query: str, period: str = "last_30_days", store_id: str | None = None, limit: int = 25
) -> DataFrame:
    """Catalogue items of a barcode with their sales; items that did not sell stay, with zeros."""
    code = query_barcode(query)
    items = lake.catalogue.where(_is_barcode(code))
    rows = sales(lake, period, ("item_id", baskets.SET_COLUMN, *MONEY), store_id=store_id)
    coded = rows.withColumn("code", item_code()).where(_is_barcode(code))
    sold = baskets.grouped(coded, ["code"], money_sums(*MONEY))
    full = items.withColumn("code", item_code()).join(sold, "code", "left").na.fill(0, [*MONEY, "baskets"])
    listed = ranked_list(full, [F.desc("revenue"), F.col("item_id")], limit)
    return listed.select(
        "position", "item_id", "item_desc", "department_name", "category_name",
        F.col("unit_price").cast("double").alias("unit_price"), *MONEY, "baskets", "more_exist",
    )


def search_not_sold(lake: Lake, query: str, period: str = "last_30_days", limit: int = 10) -> DataFrame:
    """Catalogue items that match and are carried, but did not sell in the period."""
    items = lake.catalogue.where(contains_all("item_desc", query_terms(query)))
    rows = in_scope(lake, lake.measures("sale_date", "transaction_type", "item_id"), period)
    sold = rows.where(F.col("transaction_type") == "SALE").select(item_code().alias("code"))
    idle = items.withColumn("code", item_code()).join(sold.distinct(), "code", "left_anti")
    listed = ranked_list(idle, [F.col("item_id")], limit)
    return listed.select(
        "position", "item_id", "item_desc", "department_name", F.col("unit_price").cast("double").alias("unit_price"),
        "more_exist",
    )


def search(
    lake: Lake, query: str, period: str = "last_30_days", limit: int = 25, store_id: str | None = None, idle: int = 10
) -> DataFrame:
    """One answer to whatever was typed: a barcode, or words.

    A barcode lists the catalogue items it stands for with their sales, zeros for those that did not sell. Words list
    the products sold, fewer words where not all are found, and then carried items that match and did not sell.
    `found` tells which: barcode, sold, not_sold. `code` is a barcode or, for products sold, a product.
    """
    empty = {"revenue": F.lit(0.0), "units": F.lit(0.0), "margin": F.lit(0.0), "baskets": F.lit(0).cast("long"), "terms_used": F.lit(0)}

    def shaped(rows: DataFrame, found: str, code: str) -> DataFrame:
        measures = [(F.col(n) if n in rows.columns else default).alias(n) for n, default in empty.items()]
        return rows.select(
            F.lit(found).alias("found"), "position", F.col(code).alias("code"), "item_desc", "department_name", *measures, "more_exist"
        )

    if query_barcode(query):
        return shaped(search_barcode_catalogue(lake, query, period, store_id, limit), "barcode", "item_id")
    sold = shaped(search_relaxed(lake, query, period, limit, store_id), "sold", "grp")
    return sold.unionByName(shaped(search_not_sold(lake, query, period, idle), "not_sold", "item_id"))
