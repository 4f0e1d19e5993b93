"""The sample tables as point-of-sale inputs (see mapping.py)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlake.functions import dates
from basketlake.operators.lines import classify, enrich, item_index, render
from basketlake.operators.baskets import NUMBER_SCHEMA, SET_COLUMN, new_baskets
from basketlake.operators.rollups import dept_rollup, item_rollup
from basketlake.plans.lake import Lake, Later
from basketlake.schemas import DEPT_ROLLUP_KEYS, DEPT_ROLLUP_LABELS, DETAIL_COLUMNS, ITEM_ROLLUP_KEYS, ITEM_ROLLUP_LABELS, ROLLUP_MEASURES
from basketlake.session import discard, stored, work_dir
from basketlake.sources import mapping, sinks

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
AS_OF = dt.date(2001, 8, 1)
HISTORY_START = dt.date(1995, 1, 1)
# A file is cut into blocks of this many order numbers, as Spark would cut a large file into splits.
BLOCK_SPAN = 1 << 20


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One sample table; its schema is read from a footer once and given from then on."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {name: table(spark, sf_dir, name) for name in TABLES if f"{{{name}}}" in sql}
    return spark.sql(sql.replace('"', "`"), **used)


def pos_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed item lines, classified, before the item master is joined."""
    lines = _run(spark, sf_dir, mapping.POS_LINES)
    at = dates.timestamp_at(F.col("log_date"), F.col("seconds"))
    return classify(lines.withColumn("transaction_ts", at).drop("log_date", "seconds"))


def item_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, mapping.ITEM_MASTER)


def detail(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    return enrich(pos_items(spark, sf_dir), item_master(spark, sf_dir), whole=whole)


_STORED: dict[tuple, str] = {}


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """When the tables that detail comes from were last written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = [path(f"{sf_dir}/{name}.parquet") for name in ("region", "nation", "customer", "part", "orders", "lineitem")]
    return tuple(f.getFileSystem(conf).getFileStatus(f).getModificationTime() for f in files)


def _kept(
    spark: SparkSession, sf_dir: str, name: str, parts: Callable[[], Iterable[DataFrame]], date_column: str,
    sort_by: tuple[str, ...] = (),
) -> DataFrame:
    """A stored table below year/month: written once per session and version of the sample, read by every report.

    Written part by part, and no two parts share a year: the shuffle files of a part are gone when the next one starts.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name, _version(spark, sf_dir))
    if key not in _STORED:
        path = work_dir(spark, name)
        for part in parts():
            sinks.write_table(part, path, date_column, sort_by=sort_by, placed=True)
        _STORED[key] = path
    return sinks.read_table(spark, _STORED[key])


#: Rows of a part of a stored table, unless a year has more.
PART_ROWS = 1_000_000


def _spans(rows: DataFrame, column: str, least: int) -> list[list[int | None]]:
    """The years of a table, from its folders, in spans of `least` rows or more but for one; None: rows without a date."""
    counts = {r[column]: r["count"] for r in rows.groupBy(column).count().collect()}
    spans, size = [[]], 0
    for year in sorted(counts, key=lambda y: (y is None, y)):
        if size >= least:
            spans, size = [*spans, []], 0
        spans[-1].append(year)
        size += counts[year]
    return spans


def _in_span(column: str, span: list[int | None]) -> Column:
    return F.coalesce(F.col(column), F.lit(-1)).isin([-1 if y is None else y for y in span])


def _detail_parts(spark: SparkSession, sf_dir: str) -> Iterable[DataFrame]:
    """Detail lines of a year or a few each. Lines are stored by year before they meet the item master.

    The lines of a part lie in as many tasks as they need to meet the master, so each of its months comes as that many
    files; a shuffle of whole detail lines to their months would cost as much disk as all steps before.
    """
    lines = pos_items(spark, sf_dir)
    lines = stored(lines.withColumn("_year", F.year("transaction_ts")), "lines", by=("_year",))
    master = item_master(spark, sf_dir)
    index = stored(item_index(master), "item_index")
    for span in _spans(lines, "_year", PART_ROWS):
        yield enrich(lines.where(_in_span("_year", span)).drop("_year"), master, whole=True, index=index)
    discard(lines, index)


def stored_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted by basket, so that lines read one after the other are alike where rollups shuffle them."""
    return _kept(
        spark, sf_dir, "detail", lambda: _detail_parts(spark, sf_dir), "transaction_ts", ("store_id", "transaction_id")
    )


def stored_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, "basket_numbers", _version(spark, sf_dir))
    if key not in _STORED:
        _STORED[key] = stored(new_baskets(stored_detail(spark, sf_dir)), "basket_numbers").stored_at
    return spark.read.schema(NUMBER_SCHEMA).parquet(_STORED[key])


#: So many parts of a rollup at most, as for each the numbers of its baskets are read anew.
ROLLUP_PARTS = 3


def _rollup_parts(spark: SparkSession, sf_dir: str, build) -> Iterable[DataFrame]:
    """Rollup rows of some years each: a row's lines are those of one day, and a basket is numbered by its first day."""
    lines, numbers = stored_detail(spark, sf_dir), stored_numbers(spark, sf_dir)
    for span in _spans(lines, "year", max(PART_ROWS, lines.count() // ROLLUP_PARTS)):
        dated = [y for y in span if y is not None]
        first = F.year("first_day")
        known = numbers if len(dated) < len(span) or not dated else numbers.where(first.isNull() | (first <= max(dated)))
        yield build(lines.where(_in_span("year", span)), known)


def stored_rollup(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A rollup of the stored detail with sets of baskets, stored beside it."""
    build, sort_by = {
        "rollup_item": (item_rollup, ("store_id", "item_id")), "rollup_dept": (dept_rollup, ("store_id",)),
    }[name]
    return _kept(spark, sf_dir, name, lambda: _rollup_parts(spark, sf_dir, build), "sale_date", sort_by)


def stored_rollups(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: stored_rollup(spark, sf_dir, name) for name in ("rollup_item", "rollup_dept")}


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The stored tables of the sample; each is written when the first report of a session reads it."""
    kept = (*ROLLUP_MEASURES, "price_sum", SET_COLUMN, "year", "month", "day")
    return Lake(
        detail=Later((*DETAIL_COLUMNS, "year", "month", "day"), lambda: stored_detail(spark, sf_dir)),
        catalogue=item_master(spark, sf_dir),
        rollup_item=Later((*ITEM_ROLLUP_KEYS, *ITEM_ROLLUP_LABELS, *kept), lambda: stored_rollup(spark, sf_dir, "rollup_item")),
        rollup_dept=Later((*DEPT_ROLLUP_KEYS, *DEPT_ROLLUP_LABELS, *kept), lambda: stored_rollup(spark, sf_dir, "rollup_dept")),
        as_of=AS_OF,
        history_start=HISTORY_START,
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item, tender and totals records with typed fields and their place in a store-day file."""

    def common(kind: Column) -> dict[str, Column]:
        return {
            "date": F.date_format("log_date", "MM/dd/yyyy"),
            "time_in_seconds": F.col("seconds"),
            "terminal_code": F.col("terminal_code"),
            "cashier_code": F.col("cashier_id"),
            "transaction_code": F.col("transaction_id"),
            "store_code": F.col("store_id"),
            "file": F.concat_ws("_", F.lit("TLOG"), F.date_format("log_date", "yyyy-MM-dd"), F.lit("1"), F.col("store_id")),
            "ord": F.col("transaction_id").cast("long") * 100 + kind,
            "log_date": F.col("log_date"),
        }

    zero = F.lit(0).cast("decimal(18,2)")
    blank = F.lit("")
    items = _run(spark, sf_dir, mapping.POS_LINES)
    closing = _run(spark, sf_dir, mapping.POS_CLOSING)

    def shape(df: DataFrame, kind: Column, **fields: Column) -> DataFrame:
        columns = {
            "sequence": F.lit(0), "key_function": blank, "key_function_id": blank,
            "department_code": F.lit("0"), "retail": zero, "movement_count": zero, "ext_sales": zero,
            "tender_amount": zero, "attribute_flag": blank, "retail_type": F.lit("B"),
            "loyalty_discount": zero, "premium_discount": zero, "sub_total": zero, "tax_total": zero,
            "total_amount": zero, **common(kind), **fields,
        }
        return df.select(*[c.alias(name) for name, c in columns.items()])

    item_records = shape(
        items, F.col("sequence"),
        sequence=F.col("sequence"),
        key_function=F.col("key_function"),
        key_function_id=F.col("item_id"),
        department_code=F.col("raw_department"),
        retail=F.col("unit_price"),
        movement_count=F.col("quantity").cast("decimal(18,2)"),
        ext_sales=F.col("extended_price"),
        attribute_flag=F.col("attribute_flag"),
        retail_type=F.col("retail_type"),
        loyalty_discount=F.col("loyalty_discount"),
        premium_discount=F.col("premium_discount"),
    )
    tender_records = shape(
        closing, F.lit(90),
        sequence=F.lit(90),
        key_function=F.lit("TENDER"),
        key_function_id=F.col("tender_type"),
        tender_amount=F.col("total_amount"),
    )
    totals_records = shape(
        closing, F.lit(99),
        sub_total=F.col("total_amount") - F.col("tax_total"),
        tax_total=F.col("tax_total"),
        total_amount=F.col("total_amount"),
    )
    records = item_records.unionByName(tender_records).unionByName(totals_records)
    return records.withColumn("block", F.floor(F.col("ord") / BLOCK_SPAN))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log as text lines: file, block, ord, value, and the layout columns."""
    records = raw_records(spark, sf_dir)
    return records.select(
        "file", "block", "ord",
        F.col("store_code").alias("store"),
        F.year("log_date").alias("year"),
        F.month("log_date").alias("month"),
        F.dayofmonth("log_date").alias("day"),
        render(records).alias("value"),
    )


def price_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, mapping.PRICE_BOOK)


def movement_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly movement reports as spreadsheet cells: one file per store, one sheet per week.

    Each sheet has a header block, a row of labels (two templates in turn), item rows and a total. The rows are summed up
    once and stored, as whoever reads the cells reads them several times.
    """
    rows = stored(_run(spark, sf_dir, mapping.MOVEMENT_ROWS), "movement-rows")
    sheet = ["file", "file_no", "sheet", "sheet_no", "store_no", "store_name", "week_start"]
    placed = rows.select(
        F.concat(F.lit("movement_"), F.col("store_no"), F.lit(".xlsx")).alias("file"),
        F.col("store_no").cast("int").alias("file_no"),
        F.date_format("week_start", "yyyy-MM-dd").alias("sheet"),
        F.datediff("week_start", F.lit(dt.date(1994, 12, 26))).alias("sheet_no"),
        "*",
    )

    def text(c: str) -> Column:
        return F.col(c).cast("string")

    upc = F.concat(F.lit("4-"), F.lpad((F.col("part_no") + 1).cast("string"), 10, "0"))
    category = F.concat(F.lpad(text("size"), 4, "0"), F.lit(" - "), F.col("category"))
    item_cells = F.array(
        upc, F.col("description"), F.col("brand"), category, text("qty"),
        F.concat(F.lit("$"), text("sales")), text("cost"),
    )
    items = placed.select(
        "file", "file_no", "sheet", "sheet_no", (F.col("part_no") + 10).cast("long").alias("row_idx"),
        item_cells.alias("cells"),
    )
    sheets = placed.select(*sheet).distinct()
    us = "M/d/yyyy"
    first = F.array(F.lit(""), F.concat(F.lit("Store Name: "), F.col("store_no"), F.lit(" ("), F.col("store_name"), F.lit(")")))
    second = F.array(F.concat(
        F.lit("Date Range: "), F.date_format("week_start", us), F.lit("-"),
        F.date_format(F.date_add("week_start", 6), us),
    ))
    old = F.array(*[F.lit(x) for x in ("UPC", "Description", "Brand", "Category", "Qty  Sold", "Sales", "Cost/Unit")])
    new = F.array(*[F.lit(x) for x in (" upc", "DESCRIPTION", "Brand", "Category", "Quantity Sold", "Sales", "Unit Cost")])
    third = F.when(F.month("week_start") <= 6, old).otherwise(new)
    last = F.array(F.lit("Grand Total"), F.lit("x"), F.lit(""), F.lit(""), F.lit("0"), F.lit("0"), F.lit("0"))
    block = F.array(
        F.struct(F.lit(1).cast("long").alias("row_idx"), first.alias("cells")),
        F.struct(F.lit(2).cast("long").alias("row_idx"), second.alias("cells")),
        F.struct(F.lit(4).cast("long").alias("row_idx"), third.alias("cells")),
        F.struct(F.lit(1 << 40).cast("long").alias("row_idx"), last.alias("cells")),
    )
    frame = sheets.select("file", "file_no", "sheet", "sheet_no", F.explode(block).alias("_row")).select(
        "file", "file_no", "sheet", "sheet_no", "_row.row_idx", "_row.cells"
    )
    return items.unionByName(frame)


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, mapping.QUERY_LOG)


def scan_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages as (place, text)."""
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("documents/"), F.col("doc_id")).alias("place"), "text"
    )
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("pages/"), F.col("page_id")).alias("place"), F.col("html").alias("text")
    )
    return documents.unionByName(pages)


def diff_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a change history: a log per source, a header line per document, its lines after it."""
    span = 1 << 24
    documents = table(spark, sf_dir, "documents")
    name = F.concat(F.lit("doc"), F.col("doc_id"), F.lit(".txt"))
    header = F.concat(F.lit("diff --git a/"), name, F.lit(" b/"), name)
    lines = documents.select(
        F.col("source").alias("file"),
        "doc_id",
        F.posexplode(F.concat(F.array(header), F.split("text", "\n"))),
    )
    order = F.col("doc_id") * span + F.col("pos")
    return lines.select(
        "file", F.floor(F.col("doc_id") / 1000).alias("block"), order.alias("ord"), F.col("col").alias("line")
    )
