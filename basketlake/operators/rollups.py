"""Daily rollups of the detail table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketlake.operators.baskets import SET_COLUMN
from basketlake.schemas import (
    DEPT_ROLLUP_KEYS,
    DEPT_ROLLUP_LABELS,
    ITEM_ROLLUP_KEYS,
    ITEM_ROLLUP_LABELS,
)


def _daily(detail: DataFrame, keys, labels, numbers: DataFrame | None = None) -> DataFrame:
    """Sums, line counts and exact basket counts per key; labels are the smallest of each group.

    Lines are shuffled once, by store and month, which are part of every key, and rows come out placed for a table below
    year/month. The first line of a basket in a key is marked, so baskets are counted beside the sums; windows over sorted
    lines take each line once, where an aggregate of texts and lists would take it as a partial row and once more.

    With `numbers` (transaction_id, basket_no) a row also keeps the numbers of its baskets, at most those of one store
    and day, and the sum of its prices. Numbers travel to the stores and months of their baskets, not lines to them.
    """
    day = F.col("sale_date")
    place = ["_year", "_month", "store_id"]
    rest = [k for k in keys if k not in place]
    lines = detail.withColumn("sale_date", F.to_date("transaction_ts"))
    lines = lines.withColumns({"_year": F.year(day), "_month": F.month(day), "_line": F.lit(True)})
    # By the transaction first: years and months, alike in a task, would decide no comparison.
    basket = W.partitionBy("transaction_id", *place).orderBy("_line", *rest)
    marks = {"_new": F.rank().over(basket) == F.row_number().over(basket)}
    if numbers is not None:
        # Number rows lie among the lines: a join would shuffle both sides by the transaction, and rows again by key.
        met = lines.select(*place, "transaction_id").distinct().join(numbers.select("transaction_id", "basket_no"), "transaction_id")
        lines = lines.unionByName(met, allowMissingColumns=True)
        marks["basket_no"] = F.max("basket_no").over(basket.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    placed = lines.repartition(*place).withColumns(marks).where("_line")

    # Items first among the keys, where they are one, as most rows differ in them.
    key = W.partitionBy(*place, *sorted(rest, key=lambda k: k != "item_id")).orderBy("_line")
    whole = key.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    new = F.col("_new")
    measures = {
        **{label: F.min(label) for label in labels},
        "units": F.sum("quantity"), "revenue": F.sum("extended_price"), "margin": F.sum("gross_margin"),
        "discount": F.sum(F.col("loyalty_discount") + F.col("premium_discount")),
        "line_count": F.count(F.lit(1)), "basket_count": F.count(F.when(new, 1)),
    }
    if numbers is not None:
        measures |= {"price_sum": F.sum("unit_price"), SET_COLUMN: F.collect_list(F.when(new, F.col("basket_no")))}
    groups = placed.select(
        *keys, F.row_number().over(key).alias("_first"), *[m.over(whole).alias(name) for name, m in measures.items()]
    ).where("_first = 1")
    shown = {
        "units": F.col("units").cast("decimal(18,3)"), **{m: F.col(m).cast("decimal(18,2)") for m in ("revenue", "margin", "discount")},
        "price_sum": F.col("price_sum").cast("decimal(38,2)"), SET_COLUMN: F.sort_array(SET_COLUMN),
    }
    return groups.select(*keys, *[shown.get(name, F.col(name)).alias(name) for name in measures])


def item_rollup(detail: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """Day, store, item, line class; lines without a barcode by product and department."""
    return _daily(detail, ITEM_ROLLUP_KEYS, ITEM_ROLLUP_LABELS, numbers)


def dept_rollup(detail: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """Day, store, department, category, tender, line class."""
    return _daily(detail, DEPT_ROLLUP_KEYS, DEPT_ROLLUP_LABELS, numbers)
