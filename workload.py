"""The registered queries: one callable per key, each over the whole of the sample tables it needs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlake.functions import dates, flags, numbers, text
from basketlake.operators import catalogue, guard, lines, movement, reconcile, resolve, rollups, textscan
from basketlake.plans import nightly, recipes, reports, search
from basketlake.schemas import ITEM_MASTER
from basketlake.session import stored, work_dir
from basketlake.sources import dims, raw_log, sample, sinks, versions
from basketlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ALL = "all_time"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def report(name: str, build, *args, **options) -> None:
    """Register a report over the lake."""
    QUERIES[name] = lambda spark, sf: build(sample.lake(spark, sf), *args, **options)


# --- raw log -------------------------------------------------------------------------------------


def parsed_log(spark: SparkSession, sf: str) -> DataFrame:
    return raw_log.parse_lines(sample.log_lines(spark, sf))


def written_log(spark: SparkSession, sf: str) -> str:
    path = work_dir(spark, "raw")
    sinks.write_log(sample.log_lines(spark, sf), path)
    return path


def stores(spark: SparkSession, sf: str) -> DataFrame:
    return sample.table(spark, sf, "region").select(
        F.lpad((F.col("r_regionkey") + 1).cast("string"), 10, "0").alias("store_id"), F.col("r_name").alias("store_name")
    )


@query
def raw_scan(spark, sf):
    log = raw_log.read_log(spark, written_log(spark, sf))
    amount = numbers.safe_decimal(F.col("ext_sales"))
    return log.groupBy("store_code", "key_function").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(amount).cast("double").alias("ext_sales")
    )


@query
def raw_partitions(spark, sf):
    log = raw_log.read_log(spark, written_log(spark, sf), partitions=sinks.LAYOUT)
    return raw_log.partition_listing(log).select("year", "month", "lines")


@query
def tlog_render(spark, sf):
    return sample.log_lines(spark, sf).select("file", "ord", F.col("value").alias("line"))


@query
def tlog_parse_roundtrip(spark, sf):
    return lines.typed(parsed_log(spark, sf)).select(
        "transaction_id", "store_id", "transaction_ts", "terminal_code", "cashier_id", "sequence", "key_function",
        "item_id", "transaction_type", F.col("quantity").cast("double").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("extended_price").cast("double").alias("extended_price"),
    )


@query
def tlog_filename(spark, sf):
    items = sample.raw_records(spark, sf)
    return items.select(
        lines.log_file_name(F.col("log_date"), F.col("transaction_code"), F.col("store_code")).alias("name")
    ).distinct()


@query
def file_name_meta(spark, sf):
    files = sample.log_lines(spark, sf).select(F.concat("file", F.lit(".DAT")).alias("name"))
    day, store = raw_log.file_meta(F.col("name"))
    return files.distinct().select("name", day.alias("file_date"), store.alias("store_code"))


@query
def files_since(spark, sf):
    sized = sample.log_lines(spark, sf).groupBy(F.concat("file", F.lit(".DAT")).alias("name")).agg(
        F.sum(F.length("value")).alias("size")
    )
    return raw_log.files_since(sized, F.lit(dt.date(2000, 1, 1))).select("name")


def raw_parts(spark, sf):
    return sample.log_lines(spark, sf).select("store", "year", "month", "day").distinct()


@query
def incremental_partitions(spark, sf):
    return raw_log.incremental_partitions(raw_parts(spark, sf), F.lit(sample.AS_OF), 3)


@query
def months_touched(spark, sf):
    return raw_log.months_touched(raw_parts(spark, sf))


@query
def transaction_islands(spark, sf):
    return lines.transaction_runs(parsed_log(spark, sf)).groupBy("file", "transaction_no").agg(
        F.min("transaction_code").alias("transaction_id"), F.count(F.lit(1)).alias("lines")
    )


@query
def tender_stamp(spark, sf):
    stamped = lines.tendered_runs(parsed_log(spark, sf).select(*lines.PLACE, *lines.TYPED_FIELDS))
    return lines.typed(stamped).groupBy("store_id", "tender_type").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("extended_price").cast("double").alias("ext_sales")
    )


@query
def finalize_totals(spark, sf):
    totals = lines.finalize_totals(parsed_log(spark, sf))
    return totals.select(
        "transaction_id", "store_id", *[F.col(c).cast("double").alias(c) for c in ("subtotal", "tax_total", "total_amount")]
    )


@query
def rejected_lines(spark, sf):
    """Lines of one discount class get a date that is none; each of them has to be reported."""
    log = parsed_log(spark, sf)
    broken = log.withColumn("date", F.when(F.col("retail_type") == "E", F.lit("13/45/2001")).otherwise(F.col("date")))
    return lines.rejected(broken).groupBy("store_code", "reason").agg(F.count(F.lit(1)).alias("lines"))


@query
def raw_sale_predicate(spark, sf):
    """The raw rule beside the classifier: no pair with different verdicts may appear."""
    log = parsed_log(spark, sf)
    classified = ~lines.is_finalize() & (flags.line_class(F.col("key_function"), F.col("attribute_flag")) == "SALE")
    return log.groupBy(
        F.coalesce(flags.raw_sale(), F.lit(False)).cast("int").alias("raw_sale"), classified.cast("int").alias("classified_sale")
    ).agg(F.count(F.lit(1)).alias("lines"))


# --- scalar functions ----------------------------------------------------------------------------


@query
def safe_number(spark, sf):
    book = sample.price_book(spark, sf)
    raw = F.col("`Retail w/o dollar sign`")
    return book.select(
        F.col("ord").alias("row_no"), numbers.safe_double(F.regexp_replace(raw, r"^\$", "")).alias("as_double"),
        numbers.safe_int(F.col("Cost")).alias("as_int"),
    )


@query
def parse_money(spark, sf):
    book = sample.price_book(spark, sf)
    return book.select(
        F.col("ord").alias("row_no"), numbers.money(F.col("`Retail w/o dollar sign`")).alias("price"),
        numbers.number_or_null(F.col("Description")).alias("number_in_text"),
    )


@query
def attribute_flags(spark, sf):
    items = sample.pos_items(spark, sf)
    has = {name: flags.has_flag(F.col("attribute_flag"), name) for name in flags.FLAG_LETTERS}
    rebuilt = flags.flag_text(
        has["is_taxable"], has["is_food_stamp"], has["is_wic"], has["is_refund"], has["is_void"]
    )
    keys = [on.cast("int").alias(name) for name, on in has.items()]
    return items.groupBy("attribute_flag", rebuilt.alias("rebuilt"), *keys).agg(F.count(F.lit(1)).alias("lines"))


@query
def classify_lines(spark, sf):
    return sample.pos_items(spark, sf).groupBy(
        "transaction_type", "transaction_type_name", "is_loss_event", "is_taxable", "is_food_stamp", "is_wic"
    ).agg(F.count(F.lit(1)).alias("lines"), F.sum("extended_price").cast("double").alias("ext_sales"))


@query
def event_timestamp(spark, sf):
    log = parsed_log(spark, sf)
    return log.select("transaction_code", dates.log_timestamp(F.col("date"), F.col("time_in_seconds")).alias("at")).distinct()


@query
def store_label(spark, sf):
    items = sample.pos_items(spark, sf).groupBy("store_id").agg(F.count(F.lit(1)).alias("lines"))
    known = stores(spark, sf).where(F.col("store_name") < "B")
    return items.join(known, "store_id", "left").select(
        "store_id", text.store_label(F.col("store_id"), F.col("store_name")).alias("label"), "lines"
    )


@query
def barcode_normalise(spark, sf):
    items = sample.pos_items(spark, sf)
    code = F.col("item_id")
    return items.groupBy(code, text.strip_zeros(code).alias("stripped"), text.pad_barcode(code).alias("padded")).agg(
        F.count(F.lit(1)).alias("lines")
    )


@query
def product_key(spark, sf):
    book = sample.price_book(spark, sf)
    return book.select(F.col("ord").alias("row_no"), text.product_key(F.col("Description")).alias("product_key"))


@query
def recover_upc(spark, sf):
    code, damaged = text.recover_barcode(F.col("`Upc with Dashes`"), F.col("UPC"))
    return sample.price_book(spark, sf).select(
        F.col("ord").alias("row_no"), code.alias("upc"), damaged.cast("int").alias("damaged")
    )


@query
def season_tag(spark, sf):
    """Seasons of whole texts: documents by their words, with their source as the category."""
    docs = sample.table(spark, sf, "documents")
    return docs.groupBy("lang", text.season_tag(F.col("text"), F.col("source")).alias("season")).agg(
        F.count(F.lit(1)).alias("documents")
    )


@query
def stem_terms(spark, sf):
    """Search words of every turn of the conversations, stemmed and counted."""
    turns = sample.table(spark, sf, "conversations")
    words = turns.select(F.explode(text.search_words(F.col("text"))).alias("word"))
    return words.groupBy(text.stem(F.col("word")).alias("term")).agg(F.count(F.lit(1)).alias("uses"))


@query
def resolve_department(spark, sf):
    said = F.expr("""CASE p_type WHEN 'PROMO' THEN ' Frozen Food ' WHEN 'SMALL' THEN 'veg' WHEN 'LARGE' THEN 'HBA'
                     WHEN 'STANDARD' THEN 'no such place' ELSE CAST(9 + CAST(substr(p_brand, 7) AS INT) AS STRING) END""")
    asked = sample.table(spark, sf, "part").select(said.alias("request"))
    return asked.groupBy("request", resolve.department_code_column(F.col("request")).alias("department_code")).agg(
        F.count(F.lit(1)).alias("requests")
    )


@query
def resolve_tender(spark, sf):
    return resolve.resolve_tender(sample.pos_items(spark, sf), ["snap", "Visa", "debit card", "EBT", "cash money", "BIT"])


@query
def resolve_category(spark, sf):
    return resolve.resolve_category(sample.detail(spark, sf), ["economy", "pro", "art", "nothing", "e"])


@query
def suggest_categories(spark, sf):
    return resolve.suggest_categories(sample.detail(spark, sf), ["large promo items", "department of economy", "x"])


@query
def period_bounds(spark, sf):
    """Bounds of every named period as of every order date."""
    days = sample.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("as_of")).distinct()
    asked = days.withColumn("period", F.explode(F.array(*[F.lit(p) for p in dates.PERIODS])))
    start, end = dates.period_bound_columns(F.col("period"), F.col("as_of"), F.lit(sample.HISTORY_START))
    return asked.select("as_of", "period", start.alias("start_day"), end.alias("end_day"))


# --- enrichment, dimensions, rollups -------------------------------------------------------------


@query
def item_master(spark, sf):
    """Written as CSV and read back with its schema."""
    path = work_dir(spark, "master")
    full = catalogue.item_master(sample.price_book(spark, sf))
    full.write.option("header", True).option("escape", '"').csv(path)
    return dims.read_item_master(spark, path).groupBy("department_code").agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.col("unit_price").cast("decimal(18,2)")).cast("double").alias("price_sum")
    )


@query
def enrich_lines(spark, sf):
    detail = sample.detail(spark, sf)
    return detail.select(
        "transaction_id", "sequence", "item_id", "item_desc", "product_key", "department_code", "department_name",
        "category_name", "vendor", "transaction_type", F.col("unit_cost").cast("double").alias("unit_cost"),
        F.col("extended_price").cast("double").alias("extended_price"),
        F.col("gross_margin").cast("double").alias("gross_margin"),
    )


@query
def subdept_map(spark, sf):
    return lines.subdepartment_votes(sample.item_master(spark, sf))


@query
def dim_store(spark, sf):
    return dims.dim_store(sample.detail(spark, sf))


@query
def dim_department(spark, sf):
    return lines.department_names(sample.item_master(spark, sf))


ROLLUP_DOUBLES = ("units", "revenue", "margin", "discount")


def shown(rollup: DataFrame) -> DataFrame:
    return rollup.withColumns({c: F.col(c).cast("double") for c in ROLLUP_DOUBLES})


@query
def rollup_item(spark, sf):
    return shown(rollups.item_rollup(sample.stored_detail(spark, sf)))


@query
def rollup_dept(spark, sf):
    return shown(rollups.dept_rollup(sample.stored_detail(spark, sf)))


@query
def write_read_detail(spark, sf):
    path = work_dir(spark, "detail")
    detail = sample.detail(spark, sf, whole=True)
    sinks.write_table(detail, path, "transaction_ts", sort_by=("store_id", "item_id"))
    stored = sinks.read_table(spark, path)
    return stored.groupBy("store_id", "year", "month", "transaction_type").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("extended_price").cast("double").alias("revenue"),
        F.sum("gross_margin").cast("double").alias("margin"),
    )


def stored_rollups(spark, sf):
    """Detail written once, both rollups built from the stored table and written."""
    root = work_dir(spark, "lake")
    detail = sample.detail(spark, sf, whole=True)
    sinks.write_table(detail, f"{root}/detail", "transaction_ts", sort_by=("store_id", "item_id"))
    stored = sinks.read_table(spark, f"{root}/detail", nightly.detail_schema(detail))
    sinks.write_table(rollups.item_rollup(stored), f"{root}/rollup_item", "sale_date", sort_by=("store_id", "item_id"), placed=True)
    sinks.write_table(rollups.dept_rollup(stored), f"{root}/rollup_dept", "sale_date", placed=True)
    return {name: sinks.read_table(spark, f"{root}/{name}") for name in nightly.TABLES}


@query
def write_read_rollups(spark, sf):
    tables = stored_rollups(spark, sf)

    def sums(name):
        return tables[name].groupBy("store_id", "year", "month", "transaction_type").agg(
            F.sum("line_count").alias("lines"), F.sum("revenue").cast("double").alias("revenue"),
        ).withColumn("table_name", F.lit(name))

    return sums("rollup_item").unionByName(sums("rollup_dept"))


@query
def partition_pruned_scan(spark, sf):
    """A span over a stored table: the year and month bounds reach the scan's partition filters."""
    path = work_dir(spark, "pruned")
    sinks.write_table(rollups.dept_rollup(sample.detail(spark, sf)), path, "sale_date")
    rows = dates.in_period(sinks.read_table(spark, path), dt.date(1996, 11, 15), dt.date(2000, 2, 10))
    return rows.groupBy("year", "month").agg(
        F.sum("line_count").alias("lines"), F.sum("revenue").cast("double").alias("revenue")
    )


@query
def routing_equivalence(spark, sf):
    """One question from the three stored tables; the answers stand side by side."""
    tables = stored_rollups(spark, sf)
    lake = sample.Lake(
        detail=tables["detail"], rollup_item=tables["rollup_item"], rollup_dept=tables["rollup_dept"],
        as_of=sample.AS_OF, history_start=sample.HISTORY_START,
    )

    def answer(name):
        rows = reports.sales_summary(lake.only(name), ALL, "category")
        return rows.select("category", "revenue", "units", F.lit(name).alias("table_name"))

    return answer("detail").unionByName(answer("rollup_item")).unionByName(answer("rollup_dept"))


# --- reconciliation ------------------------------------------------------------------------------


def four_sources(spark, sf):
    """The raw log, the stored detail, and both rollups of it: detail is made once, not for each of its readers."""
    detail = sample.stored_detail(spark, sf)
    return parsed_log(spark, sf), detail, rollups.item_rollup(detail), rollups.dept_rollup(detail)


@query
def check_partition(spark, sf):
    _, detail, items, depts = four_sources(spark, sf)
    checks = reconcile.check_partitions(detail, items, depts)
    money = [c for c in checks.columns if c.endswith("_revenue")]
    return checks.withColumns({
        **{c: F.col(c).cast("double") for c in money},
        "item_ok": F.col("item_ok").cast("int"), "dept_ok": F.col("dept_ok").cast("int"),
    })


@query
def reconcile_sources(spark, sf):
    return _checked(reconcile.reconcile(*four_sources(spark, sf)))


QUERIES["reconcile"] = QUERIES.pop("reconcile_sources")


def _checked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ok", F.col("ok").cast("int"))


@query
def verify_totals(spark, sf):
    start, end = dates.period_bounds("this_year", sample.AS_OF, sample.HISTORY_START)
    return _checked(reconcile.verify_totals(*four_sources(spark, sf), start, end))


@query
def publish_gate(spark, sf):
    """The nightly job over the written log: stage, check, publish, and read what was published."""
    target = work_dir(spark, "published")
    nightly.run(
        spark, written_log(spark, sf), sample.item_master(spark, sf), target, "backfill", stores=stores(spark, sf)
    )
    return versions.tables(spark, target)["rollup_dept"].groupBy("store_name", "transaction_type").agg(
        F.sum("line_count").alias("lines"), F.sum("revenue").cast("double").alias("revenue")
    )


# --- reports -------------------------------------------------------------------------------------

report("top_movers", reports.top_movers, ALL, limit=20)
report("bottom_movers", reports.top_movers, ALL, "bottom", "units", 50)
report("top_movers_filtered", reports.top_movers, ALL, metric="margin", limit=10, store_id="0000000002",
       department="frozen", category="econ")
report("sales_by_department", reports.sales_summary, ALL, "department")
report("sales_by_category", reports.sales_summary, ALL, "category")
report("sales_by_store", reports.sales_summary, ALL, "store")
report("sales_by_day", reports.sales_summary, ALL, "day")
report("tender_analysis", reports.tender_analysis, ALL)
report("tender_top_groups", reports.tender_top_groups, ALL, None, "department", 12)
report("loss_report", reports.loss_report, ALL)
report("loss_chain_total", reports.loss_chain_total, ALL)
report("seasonal_trends", reports.seasonal_trends, "this_year")
report("store_comparison", reports.store_comparison, ALL, "avg_basket")
report("promotion_performance", reports.promotion_performance, ALL)
report("range_activity", reports.range_activity, ALL)
report("dead_stock", reports.dead_stock, "last_90_days", None, 25)
report("dead_stock_summary", reports.dead_stock_summary, "last_90_days")
report("dead_stock_by_dept", reports.dead_stock_by_dept, "last_90_days", 20, 8)
report("profile_values", reports.profile_values)
report("profile_dates", reports.profile_dates)
report("load_summary", reports.load_summary)
report("unmatched_barcodes", reports.unmatched_barcodes, 5)

report("search_by_name", search.search_items, "how many widgets, 16", ALL, 25)
report("search_by_barcode_group", search.search_items, "old widgets", ALL, 25, group_duplicates=False)
report("search_totals", search.search_totals, "old widgets", ALL)
report("search_barcode", search.search_barcode, "000-00123", ALL)
report("search_barcode_catalogue", search.search_barcode_catalogue, "000-00123", "last_90_days")
report("search_relaxed", search.search_relaxed, "small widgets zz", ALL)
report("search_not_sold", search.search_not_sold, "anvils", "last_90_days")

report("search_words", search.search, "small widgets zz", ALL)
report("search_code", search.search, "000-00123", "last_90_days")
report("search_idle", search.search, "anvils", "last_90_days", idle=10)

report("dept_growth_qoq", recipes.dept_growth_qoq)
report("dept_yoy_trend", recipes.dept_yoy_trend)
report("monthly_revenue", recipes.monthly_revenue, 18)
report("cashier_void_rate", recipes.cashier_void_rate)
report("return_rate_by_dept", recipes.return_rate_by_dept)
report("voids_by_hour", recipes.voids_by_hour)
report("category_peak_month", recipes.category_peak_month, 12)
report("basket_size_by_tender", recipes.basket_size_by_tender)
report("wic_share", recipes.wic_share)
report("slow_mover_capital", recipes.slow_mover_capital, "last_90_days", 10.0, 50)
report("saturday_busiest_hour", recipes.saturday_busiest_hour)
report("basket_affinity", recipes.basket_affinity, ALL, 0.01)
report("basket_pairs", recipes.frequent_basket_pairs, ALL, 20)


# --- catalogue and movement ----------------------------------------------------------------------


def built_items(spark, sf):
    return catalogue.build_items(sample.price_book(spark, sf))


@query
def item_master_build(spark, sf):
    return built_items(spark, sf).drop("ord", "recovered", "unit_cost", "margin_pct", "cost_source")


@query
def item_master_from_files(spark, sf):
    """The same from a price book export of two files, in the order of the files."""
    path, book = work_dir(spark, "price-book"), sample.price_book(spark, sf)
    columns = [c for c in book.columns if c != "ord"]
    halves = book.repartitionByRange(2, "ord").sortWithinPartitions("ord").select(*columns)
    halves.write.options(header=True, escape='"', emptyValue="").csv(path)
    items = catalogue.build_items(dims.read_price_book(spark, path, columns))
    return items.drop("ord", "recovered", "unit_cost", "margin_pct", "cost_source")


@query
def detail_from_item_files(spark, sf):
    """Sales by department with an item master read from two files of which the second corrects the first."""
    path, master = work_dir(spark, "item-master"), sample.item_master(spark, sf)
    wrong = master.withColumn("department_name", F.lit("OLD"))
    names = [f.name for f in ITEM_MASTER.fields]
    kinds = {f.name: f.dataType for f in ITEM_MASTER.fields}
    for number, rows in enumerate((wrong, master)):
        full = rows.select(*[(F.col(n) if n in rows.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in names])
        full.write.options(header=True, escape='"', emptyValue="").csv(f"{path}/{number}")
    items = dims.read_item_master(spark, [f"{path}/0", f"{path}/1"])
    items = items.withColumns({"unit_price": F.col("unit_price").cast("decimal(18,2)"), "unit_cost": F.col("unit_cost").cast("decimal(18,4)")})
    return lines.enrich(sample.pos_items(spark, sf), items).groupBy("department_name", "transaction_type").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("extended_price").cast("double").alias("revenue")
    )


@query
def query_kinds(spark, sf):
    """Which descriptions and barcodes of the catalogue a search would take for a barcode."""
    items = sample.item_master(spark, sf)
    asked = items.select(F.explode(F.array("item_id", "item_desc", F.concat(F.lit("no "), "item_id"))).alias("asked"))
    return asked.select("asked", text.is_barcode_query(F.col("asked")).alias("is_barcode")).distinct()


@query
def pricebook_skips(spark, sf):
    return catalogue.skip_counts(catalogue.with_skip_reason(catalogue.clean(sample.price_book(spark, sf))))


@query
def category_recovery(spark, sf):
    rows = catalogue.clean(sample.price_book(spark, sf))
    filled = catalogue.recover_categories(rows, catalogue.category_votes(rows))
    return filled.groupBy("dept4", "category", "recovered").agg(F.count(F.lit(1)).alias("rows"))


@query
def cost_imputation(spark, sf):
    return built_items(spark, sf).select("item_id", "department_code", "unit_price", "unit_cost", "cost_source", "margin_pct")


@query
def catalogue_summary(spark, sf):
    return catalogue.catalogue_summary(built_items(spark, sf))


@query
def price_percentile(spark, sf):
    return catalogue.price_percentiles(built_items(spark, sf))


@query
def demand_weights(spark, sf):
    return catalogue.demand_weights(built_items(spark, sf))


@query
def demand_concentration(spark, sf):
    return catalogue.demand_concentration(catalogue.demand_weights(built_items(spark, sf)))


def actuals(spark, sf):
    return movement.parse(sample.movement_grid(spark, sf))


MOVEMENT_SHOWN = (
    "item_id", "item_desc", "brand", "category_code", "category_name", "store_code", "store_name", "period_start",
    "period_end", "units", "sales", "unit_cost",
)


@query
def movement_parse(spark, sf):
    return actuals(spark, sf).select(*MOVEMENT_SHOWN)


@query
def movement_rates(spark, sf):
    return actuals(spark, sf).select("item_id", "store_code", "period_start", "days", "unit_price", "units_per_day", "sales_per_day")


@query
def movement_latest(spark, sf):
    path = work_dir(spark, "movement")
    latest = movement.latest(actuals(spark, sf))
    latest.select(*dims.MOVEMENT_ACTUALS.names).write.option("header", True).option("escape", '"').csv(path)
    return dims.read_movement(spark, path).select("item_id", "store_code", "period_end", "units", "units_per_day")


@query
def movement_summary(spark, sf):
    return movement.summary(movement.latest(actuals(spark, sf)))


@query
def movement_overlay(spark, sf):
    """Observed rates on the sample item master; the reports carry its barcodes without zeros."""
    master = sample.item_master(spark, sf).select(
        "ord", "item_id", "department_code", "category_name",
        F.col("unit_price").cast("double").alias("unit_price"), F.col("unit_cost").cast("double").alias("unit_cost"),
        F.lit("actual").alias("cost_source"), F.lit(0.0).alias("margin_pct"), F.lit(1.0).alias("popularity"),
    )
    seen = movement.latest(actuals(spark, sf)).withColumn("item_id", F.regexp_replace("item_id", "^0+40*", ""))
    full = catalogue.overlay_movement(master, seen)
    return full.select("item_id", "observed_units_per_day", "demand_source", "cost_source", "unit_cost", "popularity")


# --- guard and text scan -------------------------------------------------------------------------


@query
def query_audit(spark, sf):
    return guard.audit(sample.query_log(spark, sf)).select(
        "query_id", "is_write", "is_metadata", "has_partition_filter", "selects_everything", "verdict"
    )


@query
def spend_daily(spark, sf):
    return guard.spend_daily(sample.query_log(spark, sf))


@query
def budget_breach(spark, sf):
    return guard.budget_breaches(sample.query_log(spark, sf), 0.05)


@query
def guarded_sql(spark, sf):
    """A free-form question over a stored, partitioned table; the year bound lets it pass the guard."""
    path = work_dir(spark, "guarded")
    sinks.write_table(rollups.dept_rollup(sample.detail(spark, sf)), path, "sale_date")
    sinks.read_table(spark, path).createOrReplaceTempView("guarded_rollup_dept")
    return guard.guarded_sql(
        spark,
        "SELECT store_name, year, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM guarded_rollup_dept "
        "WHERE year >= 1995 AND transaction_type = 'SALE' GROUP BY store_name, year", limit=200,
    )


@query
def guard_log(spark, sf):
    """A question per year and one over all years, each recorded with the bytes it reads, and one that goes over budget."""
    path, log = work_dir(spark, "guarded"), work_dir(spark, "query-log")
    sinks.write_table(rollups.dept_rollup(sample.stored_detail(spark, sf)), path, "sale_date")
    table = sinks.read_table(spark, path)
    table.createOrReplaceTempView("guarded_years")
    at = dt.datetime(2001, 8, 1, 9)
    ask = "SELECT store_name, SUM(revenue) AS revenue FROM guarded_years WHERE {} GROUP BY store_name"
    years = sorted(r.year for r in table.select("year").distinct().toLocalIterator())
    for year in years:
        guard.guarded_sql(spark, ask.format(f"year = {year}"), log_path=log, at=at)
    refused = 0
    for budget in (guard.DAILY_BUDGET, 1e-12):
        try:
            guard.guarded_sql(spark, ask.format("year > 0"), log_path=log, at=at, budget=budget)
        except guard.QueryRefused:
            refused += 1
    recorded = spark.read.schema(guard.LOG_SCHEMA).parquet(log)
    whole = F.sum(F.when(F.col("sql").contains("year > 0"), F.col("bytes")))
    halves = recorded.groupBy(F.to_date("ts").alias("day")).agg(whole.alias("_whole"))
    return guard.spend_daily(recorded).join(halves, "day").select(
        "day", "queries", ((F.col("bytes") == 2 * F.col("_whole")) & (F.col("bytes") > 0)).alias("adds_up"), F.lit(refused).alias("refused")
    )


@query
def secret_scan(spark, sf):
    return textscan.scan(sample.scan_texts(spark, sf))


@query
def secret_scan_summary(spark, sf):
    return textscan.scan_summary(textscan.scan(sample.scan_texts(spark, sf)))


@query
def diff_scan(spark, sf):
    return textscan.scan_history(sample.diff_lines(spark, sf)).select("file", "place", "line", "label", "snippet")


# --- streams -------------------------------------------------------------------------------------


@query
def stream_ingest(spark, sf):
    raw, target = written_log(spark, sf), work_dir(spark, "ingested")
    jobs.ingest(jobs.log_stream(spark, raw), target, work_dir(spark, "state")).awaitTermination()
    return spark.read.parquet(target).groupBy("store_id", "transaction_type", "tender_type").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("extended_price").cast("double").alias("revenue")
    )


@query
def stream_dedup(spark, sf):
    source, target = work_dir(spark, "uploads"), work_dir(spark, "once")
    docs = sample.table(spark, sf, "documents").select(
        "source", "text", F.timestamp_seconds(F.col("doc_id") + 1_000_000_000).alias("arrived")
    )
    docs.write.parquet(source)
    stream = spark.readStream.schema(docs.schema).parquet(source)
    once = jobs.content_once(stream, "text", ["source"]).select("source", "content_md5")
    writer = once.writeStream.format("parquet").option("path", target).option("checkpointLocation", work_dir(spark, "state"))
    with jobs.disk_state(spark):
        running = writer.trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.parquet(target)


@query
def stream_daily_rollup(spark, sf):
    raw, target = written_log(spark, sf), work_dir(spark, "daily")
    items = lines.typed(jobs.log_stream(spark, raw))
    keys = ["store_id", "transaction_type"]
    daily = jobs.daily_rollup(items, keys, approximate_baskets=False)
    jobs.keep_daily(daily, keys, target, work_dir(spark, "state")).awaitTermination()
    return jobs.latest_daily(spark, target).withColumns({
        "units": F.col("units").cast("double"), "revenue": F.col("revenue").cast("double")
    })


@query
def stream_foreach_rollup(spark, sf):
    raw, target = written_log(spark, sf), work_dir(spark, "rolled")
    master = sample.item_master(spark, sf)

    def rebuild(touched):
        jobs.rebuild_touched(touched.sparkSession, raw, touched, master, target)

    jobs.rebuild_stream(jobs.log_stream(spark, raw), rebuild, work_dir(spark, "state")).awaitTermination()
    return versions.tables(spark, target)["rollup_item"].groupBy("sale_date", "store_id", "transaction_type").agg(
        F.sum("line_count").alias("lines"), F.sum("revenue").cast("double").alias("revenue")
    )


@query
def backfill_equals_incremental(spark, sf):
    """A full rebuild, then an incremental one over it; the months that hold the same after both."""
    raw, target = written_log(spark, sf), work_dir(spark, "twice")
    master = sample.item_master(spark, sf)

    def months():
        return versions.tables(spark, target)["detail"].groupBy("year", "month").agg(
            F.count(F.lit(1)).alias("lines"), F.sum("extended_price").cast("double").alias("revenue")
        )

    nightly.run(spark, raw, master, target, "backfill")
    full = stored(months(), "after-backfill")
    nightly.run(spark, raw, master, target, "incremental", sample.AS_OF, 3)
    return full.intersect(months())
