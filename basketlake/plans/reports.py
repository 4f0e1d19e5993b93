"""The fixed reports. Each takes a lake and returns a DataFrame; nothing runs until it is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketlake.fixed_values import DEPARTMENTS
from basketlake.functions import dates, flags
from basketlake.functions.numbers import percent_change, ratio
from basketlake.functions.text import strip_zeros
from basketlake.operators import baskets, resolve
from basketlake.plans.lake import Lake

MONEY = ("revenue", "units", "margin")


def department_filter(department: str | None) -> str | None:
    code = resolve.department_code(department)
    if department and not code:
        raise ValueError(f"unknown department {department!r}, one of {sorted(set(DEPARTMENTS.values()))}")
    return code


def in_scope(
    lake: Lake, rows: DataFrame, period: str, store_id: str | None = None, department: str | None = None,
    category: str | None = None, named: DataFrame | None = None,
) -> DataFrame:
    """Rows of a period, and of one store, department or category where one is asked for.

    A category's name is looked up among all rows of the period (of `named`, if given), not only those asked for.
    """
    bounds = dates.period_bounds(period, lake.as_of, lake.history_start)
    rows = dates.in_period(rows, *bounds)
    named = rows if named is None else dates.in_period(named, *bounds)
    if store_id:
        rows = rows.where(F.col("store_id") == store_id)
    code = department_filter(department)
    if code:
        rows = rows.where(F.col("department_code") == code)
    if category:
        # One row at most; the name is looked up inside the same plan.
        match = resolve.resolve_category(named, [category]).select("category_name")
        rows = rows.join(match, "category_name", "left_semi")
    return rows


def sales(lake: Lake, period: str, columns: tuple[str, ...], **scope) -> DataFrame:
    used = {"sale_date", "transaction_type", *columns}
    used |= {name for name in ("store_id",) if scope.get(name)}
    used |= {"department_code"} if scope.get("department") else set()
    used |= {"category_name"} if scope.get("category") else set()
    rows = lake.measures(*used)
    return in_scope(lake, rows.where(F.col("transaction_type") == "SALE"), period, named=rows, **scope)


def money_sums(*names: str) -> list[Column]:
    return [F.sum(n).cast("double").alias(n) for n in names]


def ranked_list(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first `limit` rows with their position, and whether more exist.

    One row beyond the limit is fetched, so the window sees limit + 1 rows and no more.
    """
    top = rows.orderBy(*order).limit(limit + 1)
    return (
        top.withColumn("position", F.row_number().over(W.orderBy(*order)))
        .withColumn("more_exist", F.count(F.lit(1)).over(W.partitionBy()) > limit)
        .where(F.col("position") <= limit)
    )


def top_movers(
    lake: Lake, period: str = "last_30_days", direction: str = "top", metric: str = "revenue", limit: int = 20,
    store_id: str | None = None, department: str | None = None, category: str | None = None,
) -> DataFrame:
    """Best or worst sellers by revenue, units or margin, one row per product."""
    metric = metric if metric in MONEY else "revenue"
    rows = sales(
        lake, period, ("product_key", "item_desc", "department_name", "item_id", *MONEY),
        store_id=store_id, department=department, category=category,
    )
    # Sums per barcode first: the second step then sees one row per product and barcode.
    by_item = rows.groupBy("product_key", "item_id").agg(
        F.min("item_desc").alias("item_desc"), F.min("department_name").alias("department_name"),
        *[F.sum(m).alias(m) for m in MONEY],
    )
    products = by_item.groupBy("product_key").agg(
        F.min("item_desc").alias("item_desc"),
        F.min("department_name").alias("department_name"),
        F.count(F.lit(1)).alias("barcodes"),
        *money_sums(*MONEY),
    )
    by_metric = F.col(metric).desc() if direction == "top" else F.col(metric).asc()
    listed = ranked_list(products, [by_metric, F.col("product_key")], limit)
    merged = F.sum(F.col("barcodes") - 1).over(W.partitionBy())
    return listed.select(
        "position", "product_key", "item_desc", "department_name", "barcodes", *MONEY,
        ratio(F.col("margin"), F.col("revenue"), 100.0).alias("margin_pct"),
        merged.alias("merged_barcodes"), "more_exist",
    )


SUMMARY_COLUMNS = {"department": "department_name", "category": "category_name", "store": "store_name"}


def sales_summary(
    lake: Lake, period: str = "last_30_days", group_by: str = "department", store_id: str | None = None
) -> DataFrame:
    """Sales per department, category, store or day with the share of the whole.

    The total is a scalar subquery over all sales of the scope, so no window gathers the groups.
    """
    column = SUMMARY_COLUMNS.get(group_by, "sale_date")
    rows = sales(lake, period, (column, *MONEY), store_id=store_id)
    total = rows.agg(F.sum("revenue").cast("double").alias("total")).scalar()
    groups = rows.groupBy(F.col(column).alias(group_by)).agg(*money_sums(*MONEY))
    return groups.select(
        group_by, *MONEY,
        ratio(F.col("revenue"), total, 100.0).alias("share_pct"),
        ratio(F.col("margin"), F.col("revenue"), 100.0).alias("margin_pct"),
    )


def tender_scope(lake: Lake, period: str, columns: tuple[str, ...], tender: str | None) -> DataFrame:
    rows = sales(lake, period, ("tender_type", *columns)).where(F.col("tender_type") != "")
    if tender:
        named = in_scope(lake, lake.measures("sale_date", "tender_type"), period).where(F.col("tender_type") != "")
        match = resolve.resolve_tender(named, [tender]).select("tender_type")
        rows = rows.join(match, "tender_type", "left_semi")
    return rows


def tender_analysis(lake: Lake, period: str = "last_30_days", tender: str | None = None) -> DataFrame:
    """Sales per way of payment, with exact baskets and the share of all tendered sales."""
    columns = (baskets.SET_COLUMN, "revenue", "margin")
    whole = tender_scope(lake, period, columns, None)
    total = whole.agg(F.sum("revenue").cast("double").alias("total")).scalar()
    rows = tender_scope(lake, period, columns, tender)
    groups = baskets.grouped(rows, ["tender_type"], money_sums("revenue", "margin"))
    return groups.select(
        "tender_type", flags.tender_label(F.col("tender_type")).alias("label"), "revenue", "margin", "baskets",
        ratio(F.col("revenue"), F.col("baskets")).alias("average_basket"),
        ratio(F.col("revenue"), total, 100.0).alias("share_pct"),
    )


def tender_top_groups(
    lake: Lake, period: str = "last_30_days", tender: str | None = None, group_by: str = "department",
    limit: int = 12,
) -> DataFrame:
    """The largest departments or categories inside each tender, in one pass over all tenders."""
    column = "category_name" if group_by == "category" else "department_name"
    rows = tender_scope(lake, period, (column, "revenue", "units"), tender)
    groups = rows.groupBy("tender_type", F.col(column).alias("grp")).agg(*money_sums("revenue", "units"))
    totals = rows.groupBy("tender_type").agg(F.sum("revenue").cast("double").alias("_tender"))
    order = W.partitionBy("tender_type").orderBy(F.desc("revenue"), "grp")
    return (
        groups.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= limit)
        .join(totals, "tender_type")
        .select(
            "tender_type", "position", "grp", "revenue", "units",
            ratio(F.col("revenue"), F.col("_tender"), 100.0).alias("share_pct"),
        )
    )


def _loss_sums() -> list[Column]:
    def when_type(kind: str, value: Column) -> Column:
        return F.sum(F.when(F.col("transaction_type") == kind, value))

    def money(kind: str, value: Column, name: str) -> Column:
        return F.coalesce(when_type(kind, value).cast("double"), F.lit(0.0)).alias(name)

    def lines(kind: str, name: str) -> Column:
        return F.coalesce(when_type(kind, F.col("line_count")), F.lit(0)).cast("long").alias(name)

    size = F.abs("revenue")
    return [
        lines("VOID", "void_lines"), money("VOID", size, "void_value"),
        lines("RETURN", "return_lines"), money("RETURN", size, "return_value"),
        F.coalesce(F.sum(F.when(flags.is_loss(F.col("transaction_type")), size)).cast("double"), F.lit(0.0)).alias("loss_value"),
        money("SALE", F.col("revenue"), "sales"),
    ]


def _loss_rows(lake: Lake, period: str, store_id: str | None) -> DataFrame:
    rows = lake.measures("sale_date", "store_id", "store_name", "transaction_type", "revenue", "line_count")
    wanted = flags.is_loss(F.col("transaction_type")) | (F.col("transaction_type") == "SALE")
    return in_scope(lake, rows.where(wanted), period, store_id)


def loss_report(lake: Lake, period: str = "last_30_days", store_id: str | None = None) -> DataFrame:
    """Voids and returns per store against that store's sales, worst share first. One pass."""
    by_store = _loss_rows(lake, period, store_id).groupBy("store_name").agg(*_loss_sums())
    return (
        by_store.where(F.col("void_lines") + F.col("return_lines") > 0)
        .withColumn("loss_pct", ratio(F.col("loss_value"), F.col("sales"), 100.0))
        .orderBy(F.desc("loss_pct"), "store_name")
    )


def loss_chain_total(lake: Lake, period: str = "last_30_days") -> DataFrame:
    return _loss_rows(lake, period, None).agg(*_loss_sums()).withColumn(
        "loss_pct", ratio(F.col("loss_value"), F.col("sales"), 100.0)
    )


YEAR_LABELS = ("this_year", "last_year", "two_years_ago")


def seasonal_trends(
    lake: Lake, period: str = "this_month", department: str | None = None, store_id: str | None = None
) -> DataFrame:
    """A period against the same days one and two years earlier, from one scan."""
    start, end = dates.period_bounds(period, lake.as_of, lake.history_start)
    windows = [
        (label, dates.years_back(start, n), dates.years_back(end, n)) for n, label in enumerate(YEAR_LABELS)
    ]
    rows = lake.measures("sale_date", "transaction_type", "store_id", "department_code", baskets.SET_COLUMN, *MONEY)
    rows = rows.where(F.col("transaction_type") == "SALE")
    if store_id:
        rows = rows.where(F.col("store_id") == store_id)
    code = department_filter(department)
    if code:
        rows = rows.where(F.col("department_code") == code)
    covered = None
    for _, first, last in windows:
        inside = F.col("sale_date").between(F.lit(first), F.lit(last))
        if {"year", "month"} <= set(rows.columns):
            inside = dates.partition_predicate(first, last) & inside
        covered = inside if covered is None else covered | inside
    # A day can lie in several windows when the period is longer than a year.
    hits = F.array_compact(F.array(*[
        F.when(F.col("sale_date").between(F.lit(first), F.lit(last)), F.lit(label)) for label, first, last in windows
    ]))
    labelled = rows.where(covered).withColumn("label", F.explode(hits))
    sums = baskets.grouped(labelled, ["label"], money_sums(*MONEY), "transactions")
    listed = ", ".join(f"('{label}', DATE'{first}', DATE'{last}')" for label, first, last in windows)
    frame = lake.detail.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS t(label, first_day, last_day)")
    full = frame.join(sums, "label", "left").na.fill(0, [*MONEY, "transactions"])
    now = F.max(F.when(F.col("label") == YEAR_LABELS[0], F.col("revenue"))).over(W.partitionBy())
    return full.select(
        "label", "first_day", "last_day", *MONEY, "transactions",
        F.when(F.col("label") != YEAR_LABELS[0], percent_change(now, F.col("revenue"))).alias("change_pct"),
    )


STORE_METRICS = ("revenue", "units", "transactions", "avg_basket", "margin", "margin_pct")


def store_comparison(lake: Lake, period: str = "last_30_days", metric: str = "revenue") -> DataFrame:
    """Stores side by side, ranked by one measure. The ranking window holds one row per store."""
    metric = metric if metric in STORE_METRICS else "revenue"
    rows = sales(lake, period, ("store_name", baskets.SET_COLUMN, *MONEY))
    stores = baskets.grouped(rows, ["store_name"], money_sums(*MONEY), "transactions")
    stores = stores.withColumns({
        "avg_basket": ratio(F.col("revenue"), F.col("transactions")),
        "margin_pct": ratio(F.col("margin"), F.col("revenue"), 100.0),
    })
    order = W.partitionBy().orderBy(F.desc(metric), "store_name")
    return stores.select(F.row_number().over(order).alias("position"), "store_name", *STORE_METRICS)


def promotion_performance(
    lake: Lake, period: str = "last_30_days", department: str | None = None
) -> DataFrame:
    """Sales by the way the price was set, and what was given away."""
    rows = sales(lake, period, ("retail_type", "discount", *MONEY), department=department)
    total = rows.agg(F.sum("revenue").cast("double").alias("total")).scalar()
    groups = rows.groupBy("retail_type").agg(*money_sums(*MONEY, "discount"))
    return groups.select(
        "retail_type", flags.retail_type_label(F.col("retail_type")).alias("label"), *MONEY, "discount",
        ratio(F.col("revenue"), total, 100.0).alias("share_pct"),
        ratio(F.col("margin"), F.col("revenue"), 100.0).alias("margin_pct"),
    )


def range_activity(lake: Lake, period: str = "last_90_days", department: str | None = None) -> DataFrame:
    """Items that sold, per department."""
    rows = sales(lake, period, ("department_name", "item_id", "revenue"), department=department)
    by_item = rows.groupBy("department_name", "item_id").agg(F.sum("revenue").alias("revenue"))
    return by_item.groupBy("department_name").agg(
        F.count(F.lit(1)).alias("items"), F.sum("revenue").cast("double").alias("revenue")
    )


def sold_items(lake: Lake, period: str, any_activity: bool = False) -> DataFrame:
    """(code,) of items with a sale in the period; see item_code."""
    rows = lake.measures("sale_date", "transaction_type", "item_id")
    if not any_activity:
        rows = rows.where(F.col("transaction_type") == "SALE")
    return in_scope(lake, rows, period).select(item_code().alias("code")).distinct()


def item_code() -> Column:
    """The barcode without zeros in front, in which log and catalogue agree whatever their padding; zeros alone match nothing."""
    return F.nullif(strip_zeros(F.col("item_id")), F.lit(""))


def catalogue_items(lake: Lake, department: str | None = None) -> DataFrame:
    items = lake.catalogue.withColumn("code", item_code())
    code = department_filter(department)
    return items.where(F.col("department_code") == code) if code else items


def dead_stock(
    lake: Lake, period: str = "last_90_days", department: str | None = None, limit: int = 25,
    any_activity: bool = False,
) -> DataFrame:
    """The dearest catalogue items that did not sell in the period."""
    idle = catalogue_items(lake, department).join(sold_items(lake, period, any_activity), "code", "left_anti")
    price, cost = F.col("unit_price").cast("double"), F.col("unit_cost").cast("double")
    listed = ranked_list(idle, [F.desc("unit_price"), F.col("item_id")], limit)
    return listed.select(
        "position", "item_id", "item_desc", "department_name", price.alias("unit_price"),
        ratio(price - cost, price, 100.0).alias("margin_pct"), "more_exist",
    )


def _idle_counts(lake: Lake, period: str, department: str | None, any_activity: bool) -> DataFrame:
    sold = sold_items(lake, period, any_activity).withColumn("_sold", F.lit(1))
    return catalogue_items(lake, department).join(sold, "code", "left")


def _unsold() -> list[Column]:
    missing = F.when(F.col("_sold").isNull(), 1).otherwise(0)
    return [F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(missing), F.lit(0)).cast("long").alias("unsold")]


def dead_stock_summary(
    lake: Lake, period: str = "last_90_days", department: str | None = None, any_activity: bool = False
) -> DataFrame:
    """How much of the range is idle."""
    counts = _idle_counts(lake, period, department, any_activity).agg(*_unsold())
    return counts.withColumn("unsold_pct", ratio(F.col("unsold"), F.col("total"), 100.0))


def dead_stock_by_dept(
    lake: Lake, period: str = "last_90_days", min_items: int = 20, limit: int = 8, any_activity: bool = False
) -> DataFrame:
    """Departments with the largest idle share, among those with more than `min_items` items."""
    counts = (
        _idle_counts(lake, period, None, any_activity)
        .groupBy("department_name")
        .agg(*_unsold())
        .where(F.col("total") > min_items)
        .withColumn("unsold_pct", ratio(F.col("unsold"), F.col("total"), 100.0))
    )
    order = [F.desc("unsold_pct"), F.col("department_name")]
    return ranked_list(counts, order, limit).drop("more_exist")


PROFILE_COLUMNS = ("transaction_type", "tender_type", "retail_type", "department_name", "category_name")


def profile_values(lake: Lake, columns: tuple[str, ...] = PROFILE_COLUMNS, limit: int = 40) -> DataFrame:
    """The most frequent values of several columns, from one pass over the table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    counts = (
        lake.detail.select(F.explode(pairs).alias("_pair"))
        .select("_pair.column", "_pair.value")
        .where(F.col("value") != "")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    order = W.partitionBy("column").orderBy(F.desc("lines"), "value")
    return counts.withColumn("position", F.row_number().over(order)).where(F.col("position") <= limit)


def profile_dates(lake: Lake) -> DataFrame:
    """Date range and row counts of the tables at hand."""
    tables = {"detail": lake.measures("transaction_ts"), "rollup_item": lake.rollup_item, "rollup_dept": lake.rollup_dept}
    result = None
    for name, rows in tables.items():
        if rows is None:
            continue
        part = rows.agg(
            F.min("sale_date").alias("first_day"), F.max("sale_date").alias("last_day"),
            F.count(F.lit(1)).alias("row_count"),
        ).withColumn("table_name", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result


def load_summary(lake: Lake) -> DataFrame:
    """What was loaded: lines, transactions, items, net sales, margin, dates, catalogue match."""
    rows = lake.detail
    sale = F.col("transaction_type") == "SALE"
    facts = rows.agg(
        F.count(F.lit(1)).alias("line_items"),
        F.min(F.to_date("transaction_ts")).alias("first_day"),
        F.max(F.to_date("transaction_ts")).alias("last_day"),
        F.sum(F.when(sale, F.col("extended_price"))).cast("double").alias("net_sales"),
        F.sum(F.when(sale, F.col("gross_margin"))).cast("double").alias("gross_margin"),
        F.sum(F.when(F.col("category_name") != "Unmatched", 1).otherwise(0)).cast("long").alias("_matched"),
    )
    transactions = rows.agg(F.count_distinct("transaction_id").alias("n")).scalar()
    items = rows.agg(F.count_distinct("item_id").alias("n")).scalar()
    return facts.select(
        "line_items", transactions.alias("transactions"), items.alias("distinct_items"), "first_day", "last_day",
        "net_sales", "gross_margin",
        ratio(F.col("gross_margin"), F.col("net_sales"), 100.0).alias("margin_pct"),
        ratio(F.col("_matched"), F.col("line_items"), 100.0).alias("match_pct"),
    )


def unmatched_barcodes(lake: Lake, limit: int = 5) -> DataFrame:
    """The most frequent barcodes the master does not have, with the totals over all of them."""
    rows = lake.detail.where(F.col("category_name") == "Unmatched")
    counts = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("lines"))
    listed = ranked_list(counts, [F.desc("lines"), F.col("item_id")], limit)
    distinct = counts.agg(F.count(F.lit(1)).alias("n")).scalar()
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return listed.select(
        "position", "item_id", "lines", distinct.alias("distinct_barcodes"), total.alias("total_lines")
    )
