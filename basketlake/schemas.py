"""Table schemas and the raw log layout."""

from __future__ import annotations

from pyspark.sql import types as T

from basketlake.fixed_values import (
    DEFAULT_FIELD_COUNT,
    DEFAULT_SETTINGS,
    FIXED_FIELDS,
    OPTIONAL_FIELDS,
)

MONEY = T.DecimalType(18, 2)
QUANTITY = T.DecimalType(18, 3)
COST = T.DecimalType(18, 4)


def log_fields(settings=DEFAULT_SETTINGS, expected: int | None = None) -> list[str]:
    """Field names of a raw record in file order, for the settings the registers export with."""
    fields = list(FIXED_FIELDS) + [name for name, switch in OPTIONAL_FIELDS if switch in settings]
    if expected is None and settings == DEFAULT_SETTINGS:
        expected = DEFAULT_FIELD_COUNT
    if expected is not None and len(fields) != expected:
        raise ValueError(f"the log layout has {len(fields)} fields, expected {expected}")
    return fields


def log_schema(settings=DEFAULT_SETTINGS, expected: int | None = None) -> T.StructType:
    """All-string schema of a raw record."""
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in log_fields(settings, expected)]
    )


def _struct(spec) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in spec])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()

ITEM_MASTER = _struct([
    ("item_id", _S), ("upc", _S), ("item_desc", _S), ("product_key", _S), ("pos_desc", _S),
    ("department_code", _S), ("department_name", _S), ("category_code", _S),
    ("category_name", _S), ("brand", _S), ("vendor", _S), ("unit_price", _D), ("unit_cost", _D),
    ("cost_source", _S), ("margin_pct", _D), ("food_stamp", _S), ("wic", _S), ("season", _S),
    ("popularity", _D), ("observed_units_per_day", _D), ("demand_source", _S),
])

MOVEMENT_ACTUALS = _struct([
    ("upc", _S), ("item_id", _S), ("item_desc", _S), ("brand", _S), ("department_code", _S),
    ("category_code", _S), ("category_name", _S), ("vendor", _S), ("store_code", _S),
    ("store_name", _S), ("period_start", T.DateType()), ("period_end", T.DateType()),
    ("days", _I), ("units", _D), ("sales", _D), ("unit_price", _D), ("unit_cost", _D),
    ("gross_margin", _D), ("units_per_day", _D), ("sales_per_day", _D), ("source_file", _S),
])

DETAIL_COLUMNS = (
    "transaction_id", "store_id", "store_name", "transaction_ts", "terminal_code", "cashier_id",
    "sequence", "key_function", "item_id", "item_desc", "product_key", "department_code",
    "department_name", "category_name", "vendor", "transaction_type", "transaction_type_name",
    "is_loss_event", "quantity", "unit_price", "unit_cost", "extended_price", "gross_margin",
    "retail_type", "attribute_flag", "is_taxable", "is_food_stamp", "is_wic", "loyalty_discount",
    "premium_discount", "loyalty_code", "tender_type",
)

ROLLUP_MEASURES = ("units", "revenue", "margin", "discount", "line_count", "basket_count")
# Product and department follow from a barcode, but lines without one (department keys, promotions) share
# the blank code: as keys they keep such lines apart, so reports by product or department stay right.
ITEM_ROLLUP_KEYS = ("sale_date", "store_id", "item_id", "product_key", "department_code", "transaction_type")
ITEM_ROLLUP_LABELS = ("store_name", "department_name", "category_name", "item_desc")
DEPT_ROLLUP_KEYS = (
    "sale_date", "store_id", "department_code", "category_name", "tender_type", "transaction_type",
)
DEPT_ROLLUP_LABELS = ("store_name", "department_name")
