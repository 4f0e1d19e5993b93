"""Movement reports: from spreadsheet cells to units per item, store and window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.fixed_values import MOVEMENT_LABELS, MOVEMENT_SKIP_MARKERS
from basketlake.functions.numbers import number_or_null
from basketlake.functions.text import blank, digits_of, pad_barcode, squeeze, strip_zeros
from basketlake.operators.skew import left_join
from basketlake.session import compiled, stored

SHEET = ["file", "sheet"]
HEADER_ROWS = 12
BLOCK_ROWS_AFTER_HEADER = 6


def _norm(c: Column) -> Column:
    return F.lower(squeeze(c))


def _filled(cells: Column) -> Column:
    return F.filter(cells, lambda c: c.isNotNull() & (c != ""))


def _joined(cells: Column) -> Column:
    return F.array_join(_filled(cells), " ")


def date_range(cells: Column) -> tuple[Column, Column]:
    """The two dates of a header line; years of four or two digits."""
    text = _joined(cells)
    pattern = r"(\d{1,2}/\d{1,2}/\d{2,4})\s*-\s*(\d{1,2}/\d{1,2}/\d{2,4})"

    def day(group: int) -> Column:
        raw = F.regexp_extract(text, pattern, group)
        short = raw.rlike(r"/\d{2}$")
        return F.when(short, F.try_to_date(raw, "M/d/yy")).when(raw.rlike(r"/\d{4}$"), F.try_to_date(raw, "M/d/yyyy"))

    start, end = day(1), day(2)
    both = start.isNotNull() & end.isNotNull()
    return F.when(both, start), F.when(both, end)


def store(cells: Column) -> tuple[Column, Column]:
    """Code and name of a header line like "Store Name: 000001 (North)"."""
    text = _joined(cells)
    pattern = r"(?i)store\s*name\s*:\s*(\S+)\s*(?:\(([^)]*)\))?"
    code = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    numbered = F.format_string("STORE%02d", code.try_cast("long"))
    return (
        F.when(code.rlike(r"^\d+$"), numbered).otherwise(code),
        F.when(code.isNotNull(), F.trim(F.regexp_extract(text, pattern, 2))),
    )


def _column_of(labels: Column, aliases: tuple[str, ...]) -> Column:
    """Position (from 0) of the first alias that is a label, the last such column; NULL when there is none."""
    def last_place(alias: str) -> Column:
        place = F.array_position(F.reverse(labels), F.lit(alias))
        return F.when(place > 0, F.size(labels) - place)

    return F.coalesce(*[last_place(a) for a in aliases])


def sheet_headers(grid: DataFrame) -> DataFrame:
    """Per sheet the header row and where each field stands in it."""
    labels = F.transform("cells", _norm)
    qty = F.arrays_overlap(labels, F.array(*[F.lit(a) for a in MOVEMENT_LABELS["qty_sold"]]))
    headers = (
        grid.where(F.col("row_idx") <= HEADER_ROWS)
        .withColumn("_labels", labels)
        .where(F.array_contains("_labels", "description") & qty)
        .groupBy(*SHEET)
        .agg(F.min("row_idx").alias("header_row"), F.min_by("_labels", "row_idx").alias("_labels"))
    )
    return headers.select(
        *SHEET, "header_row",
        *[_column_of(F.col("_labels"), aliases).alias(f"at_{field}") for field, aliases in MOVEMENT_LABELS.items()],
    )


def sheet_facts(grid: DataFrame, headers: DataFrame) -> DataFrame:
    """Per sheet the window and the store, from the block around the header row."""
    top = grid.where(F.col("row_idx") <= HEADER_ROWS + BLOCK_ROWS_AFTER_HEADER).join(
        headers.select(*SHEET, "header_row"), SHEET
    )
    block = top.where(F.col("row_idx") <= F.col("header_row") + BLOCK_ROWS_AFTER_HEADER)
    text = _norm(_joined(F.col("cells")))
    start, end = date_range(F.col("cells"))
    code, name = store(F.col("cells"))
    window = F.when(text.contains("date range") & start.isNotNull(), F.struct(start.alias("start"), end.alias("end")))
    place = F.when(
        text.contains("store") & text.contains("name") & code.isNotNull(), F.struct(code.alias("code"), name.alias("name"))
    )
    seen = block.select(*SHEET, "row_idx", window.alias("_window"), place.alias("_place"))

    def first(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.col("row_idx")))

    facts = seen.groupBy(*SHEET).agg(first("_window").alias("_window"), first("_place").alias("_place"))
    return facts.select(
        *SHEET, F.col("_window.start").alias("period_start"), F.col("_window.end").alias("period_end"),
        F.col("_place.code").alias("store_code"), F.col("_place.name").alias("store_name"),
    )


def parse(grid: DataFrame) -> DataFrame:
    """Item rows of movement reports.

    Takes (file, file_no, sheet, sheet_no, row_idx, cells). The facts of a sheet are one small row, joined
    to its item rows with salts where they are too many to broadcast, so a huge sheet stays spread.
    """
    headers = sheet_headers(grid)
    facts = headers.join(sheet_facts(grid, headers), SHEET, "left")
    rows = left_join(grid, facts, SHEET, ["row_idx"]).where(F.col("row_idx") > F.col("header_row"))

    def cell(field: str) -> Column:
        return F.get("cells", F.col(f"at_{field}").cast("int"))

    text = _norm(_joined(F.col("cells")))
    head = F.substring(text, 1, 30)
    marked = F.lit(False)
    for marker in MOVEMENT_SKIP_MARKERS:
        marked = marked | text.startswith(marker) | head.contains(marker)
    upc = digits_of(cell("upc"))
    desc = F.trim(blank(cell("description")))
    qty = number_or_null(cell("qty_sold"))
    items = rows.where((F.size(_filled(F.col("cells"))) > 0) & ~marked).where(
        (desc != "") & qty.isNotNull() & (upc != "")
    )
    category = F.trim(blank(cell("category")))
    split = r"^(\d+)\s*-\s*(.+)"
    coded = category.rlike(split)
    none = F.lit("")
    parsed = items.select(
        "file_no", "sheet_no", "row_idx",
        upc.alias("upc"), pad_barcode(strip_zeros(upc)).alias("item_id"), desc.alias("item_desc"),
        F.trim(blank(cell("brand"))).alias("brand"), F.trim(blank(cell("department"))).alias("department_code"),
        F.when(coded, F.regexp_extract(category, split, 1)).otherwise(none).alias("category_code"),
        F.when(coded, F.trim(F.regexp_extract(category, split, 2))).otherwise(category).alias("category_name"),
        F.trim(blank(cell("vendor_name"))).alias("vendor"),
        blank(F.col("store_code")).alias("store_code"), blank(F.col("store_name")).alias("store_name"),
        "period_start", "period_end",
        qty.alias("units"), F.coalesce(number_or_null(cell("sales")), F.lit(0.0)).alias("_sales"),
        number_or_null(cell("price")).alias("_price"), number_or_null(cell("cost_unit")).alias("_cost"),
        number_or_null(cell("gm_dollars")).alias("_gm"), F.col("file").alias("source_file"),
    )
    return rates(parsed)


def rates(parsed: DataFrame) -> DataFrame:
    """Days of the window, units and sales per day, and a price where the report has none."""
    days = F.datediff("period_end", "period_start") + 1
    price = (
        F.when(F.col("_price") != 0, F.round("_price", 2))
        .when(F.col("units") != 0, F.round(F.col("_sales").cast("decimal(18,2)") / F.col("units").cast("decimal(18,3)"), 2).cast("double"))
        .otherwise(F.lit(0.0))
    )
    per_day = F.nullif(days.cast("double"), F.lit(0.0))
    return parsed.select(
        "file_no", "sheet_no", "row_idx", "upc", "item_id", "item_desc", "brand", "department_code",
        "category_code", "category_name", "vendor", "store_code", "store_name", "period_start", "period_end",
        days.alias("days"), "units", F.round("_sales", 2).alias("sales"), price.alias("unit_price"),
        F.when(F.col("_cost") != 0, F.round("_cost", 4)).alias("unit_cost"), F.round("_gm", 2).alias("gross_margin"),
        F.round(F.col("units") / per_day, 4).alias("units_per_day"),
        F.round(F.col("_sales") / per_day, 4).alias("sales_per_day"), "source_file",
    )


def latest(actuals: DataFrame) -> DataFrame:
    """The latest window per item and store; of equal ones the first read stays.

    An aggregate, not a window: an item with most of the rows is reduced before the shuffle.
    """
    keys = ["item_id", "store_code"]
    rest = [c for c in actuals.columns if c not in keys]
    order = F.struct(
        F.coalesce("period_end", F.lit("0001-01-01").cast("date")), -F.col("file_no"), -F.col("sheet_no"), -F.col("row_idx")
    )
    best = actuals.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_best"))
    return best.select(*keys, "_best.*")


def summary(actuals: DataFrame) -> DataFrame:
    """Items, units, sales, stores, windows and categories of the latest windows.

    The windows are made once, not for each of the counts.
    """
    shown = actuals.select("units", "sales", "store_code", "period_start", "period_end", "category_name")
    with compiled(actuals.sparkSession):
        actuals = stored(shown, "movement-latest")
    counted = actuals.agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.col("units").cast("decimal(18,3)")).cast("double").alias("units"),
        F.sum(F.col("sales").cast("decimal(18,2)")).cast("double").alias("sales"),
    )
    def distinct(c: Column) -> Column:
        return actuals.agg(F.count_distinct(c).alias("n")).scalar()

    return counted.withColumns({
        "stores": distinct(F.nullif(F.col("store_code"), F.lit(""))),
        "windows": distinct(F.struct("period_start", "period_end")),
        "categories": distinct(F.col("category_name")),
    })
