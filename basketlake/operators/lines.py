"""From raw log lines to enriched detail lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketlake.fixed_values import DEFAULT_SETTINGS, QUOTED_FIELDS
from basketlake.functions import dates, flags, numbers, text
from basketlake.operators.rows import TEXTS, light
from basketlake.operators.skew import broadcast_by_file_size, left_join
from basketlake.schemas import DETAIL_COLUMNS, log_fields

TRANSACTION_KEY = ("transaction_code", "terminal_code", "date")
PLACE = ("file", "block", "ord")


def _local_runs(lines: DataFrame, key: Column) -> DataFrame:
    """Lines with `_key` and `_local`, the number of key changes before them in their block.

    A block is one split of a file, so the window over lines never holds more than a split.
    """
    ordered = W.partitionBy("file", "block").orderBy("ord")
    keyed = lines.withColumn("_key", key)
    changed = F.coalesce((F.lag("_key").over(ordered) != F.col("_key")).cast("int"), F.lit(0))
    return keyed.withColumn("_changed", changed).withColumn(
        "_local", F.sum("_changed").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow))
    ).drop("_changed")


def _offsets(blocks: DataFrame) -> DataFrame:
    """(file, block, ..., _offset): the number of a block's first run, from one row (_first, _last, _changes) a block."""
    by_file = W.partitionBy("file").orderBy("block")
    seam = F.coalesce((F.lag("_last").over(by_file) != F.col("_first")).cast("int"), F.lit(0))
    steps = blocks.withColumn("_step", seam + F.coalesce(F.lag("_changes").over(by_file), F.lit(0)))
    upto = by_file.rowsBetween(W.unboundedPreceding, W.currentRow)
    return steps.withColumn("_offset", F.sum("_step").over(upto)).drop("_step", "_first", "_last")


def _ends() -> list[Column]:
    return [F.min_by("_key", "ord").alias("_first"), F.max_by("_key", "ord").alias("_last"), F.max("_local").alias("_changes")]


def runs(lines: DataFrame, key: Column, name: str = "run") -> DataFrame:
    """Number the contiguous runs of equal keys in each file, in file order.

    Needs the columns file, block and ord. Runs are numbered inside blocks, one row per block carries the count across;
    the input is read twice, once for those rows.
    """
    local = _local_runs(lines, key)
    offsets = _offsets(local.groupBy("file", "block").agg(*_ends())).drop("_changes")
    numbered = local.join(offsets, ["file", "block"]).withColumn(name, (F.col("_offset") + F.col("_local")).cast("long"))
    return numbered.drop("_key", "_local", "_offset")


def transaction_runs(lines: DataFrame) -> DataFrame:
    """Number the transactions of each file; a key that comes back later starts a new one."""
    return runs(lines, F.struct(*TRANSACTION_KEY), "transaction_no")


def is_tender() -> Column:
    return F.upper(F.col("key_function")).startswith("TENDER")


def is_finalize() -> Column:
    return (numbers.safe_int(F.col("sequence")) == 0) & (F.trim("key_function") == "")


def stamp_tender(lines: DataFrame) -> DataFrame:
    """Put the first named tender of a transaction on all of its lines."""
    tenders = (
        lines.where(is_tender() & (F.col("key_function_id") != ""))
        .groupBy("file", "transaction_no")
        .agg(F.min_by(F.upper("key_function_id"), F.struct("block", "ord")).alias("tender_type"))
    )
    stamped = left_join(lines, tenders, ["file", "transaction_no"], list(PLACE))
    return stamped.withColumn("tender_type", text.blank(F.col("tender_type")))


def tendered_runs(lines: DataFrame) -> DataFrame:
    """Lines with transaction_no and tender_type, the first named tender of their transaction, from one read.

    A transaction inside a block is settled there. Only the first and the last run of a block can go on in others: their
    tenders are two entries of the row that a block contributes, and the runs they belong to are settled among those
    rows. One join by block brings number and tenders back. Both sides of it read the same shuffle by block, where all
    texts of a line are one column.
    """
    placed = lines.where(F.col("file").isNotNull() & F.col("block").isNotNull())
    lines = light(placed, lambda r: r.repartition("file", "block"), ("file",))
    named = F.when(is_tender() & (F.col("key_function_id") != ""), F.struct(F.col("ord").alias("ord"), F.upper("key_function_id").alias("name")))
    local = _local_runs(lines, F.struct(*TRANSACTION_KEY)).withColumn("_tender", named)
    local = local.withColumn("_tender", F.min("_tender").over(W.partitionBy("file", "block", "_local"))["name"])
    blocks = _offsets(
        local.groupBy("file", "block").agg(*_ends(), F.min_by("_tender", "ord").alias("_head"), F.max_by("_tender", "ord").alias("_tail"))
    )
    last_run = F.col("_offset") + F.col("_changes")
    ends = blocks.select(
        "file", "block", "_offset", "_changes",
        F.posexplode(F.array(F.struct(F.col("_offset").alias("run"), F.col("_head").alias("name")), F.struct(last_run.alias("run"), F.col("_tail").alias("name")))).alias("_side", "_end"),
    )
    one_run = W.partitionBy("file", "_end.run")
    settled = ends.withColumn("_name", F.min(F.when(F.col("_end.name").isNotNull(), F.struct("block", "_end.name"))).over(one_run)["name"])
    seams = settled.groupBy("file", "block").agg(
        F.first("_offset").alias("_offset"), F.first("_changes").alias("_changes"),
        *[F.max(F.when(F.col("_side") == side, F.col("_name"))).alias(name) for side, name in ((0, "_head"), (1, "_tail"))],
    )
    tender = F.when(F.col("_local") == 0, F.col("_head")).when(F.col("_local") == F.col("_changes"), F.col("_tail")).otherwise(F.col("_tender"))
    return (
        local.join(seams, ["file", "block"])
        .withColumns({"transaction_no": (F.col("_offset") + F.col("_local")).cast("long"), "tender_type": text.blank(tender)})
        .drop("_key", "_local", "_offset", "_changes", "_head", "_tail", "_tender")
    )


def finalize_totals(lines: DataFrame) -> DataFrame:
    """The totals record of each transaction."""
    money = {
        "subtotal": "sub_total", "tax_total": "tax_total", "total_amount": "total_amount",
        "total_discount": "total_discount", "total_points": "total_points", "cash_back": "cash_back_amount",
    }
    return lines.where(is_finalize()).select(
        F.col("transaction_code").alias("transaction_id"),
        F.col("store_code").alias("store_id"),
        *[numbers.safe_decimal(F.col(source)).alias(name) for name, source in money.items()],
        "loyalty_code",
    )


def rejected(lines: DataFrame) -> DataFrame:
    """Item lines that carry no date and so reach no table."""
    is_item = ~is_finalize() & (flags.line_class(F.col("key_function"), F.col("attribute_flag")) != "TENDER")
    return lines.where(is_item & dates.log_date(F.col("date")).isNull()).withColumn("reason", F.lit("no date"))


#: The log fields that `typed` and `tendered_runs` read.
TYPED_FIELDS = (
    "transaction_code", "store_code", "date", "time_in_seconds", "terminal_code", "cashier_code", "sequence", "key_function",
    "key_function_id", "department_code", "movement_count", "retail", "ext_sales", "retail_type", "attribute_flag",
    "loyalty_discount", "premium_discount", "loyalty_code",
)


def typed(lines: DataFrame) -> DataFrame:
    """Item lines with types; totals records, tender lines and lines without a date are gone.

    Takes raw text columns, and tender_type where tendered_runs has put it.
    """
    if "tender_type" not in lines.columns:
        lines = lines.withColumn("tender_type", F.lit(""))

    def amount(name: str) -> Column:
        return numbers.safe_decimal(F.col(name))

    items = lines.where(~is_finalize()).select(
        F.col("transaction_code").alias("transaction_id"),
        F.col("store_code").alias("store_id"),
        dates.log_timestamp(F.col("date"), F.col("time_in_seconds")).alias("transaction_ts"),
        "terminal_code",
        F.col("cashier_code").alias("cashier_id"),
        numbers.safe_int(F.col("sequence")).alias("sequence"),
        F.trim("key_function").alias("key_function"),
        F.col("key_function_id").alias("item_id"),
        F.col("department_code").alias("raw_department"),
        numbers.safe_decimal(F.col("movement_count"), 18, 3).alias("quantity"),
        amount("retail").alias("unit_price"),
        amount("ext_sales").alias("extended_price"),
        "retail_type",
        "attribute_flag",
        amount("loyalty_discount").alias("loyalty_discount"),
        amount("premium_discount").alias("premium_discount"),
        "loyalty_code",
        "tender_type",
    )
    return classify(items.where(F.col("transaction_ts").isNotNull()))


def classify(items: DataFrame) -> DataFrame:
    """Class, label and 0/1 flags of item lines; tender lines are dropped."""
    flag = F.col("attribute_flag")
    lines = items.withColumn("transaction_type", flags.line_class(F.col("key_function"), flag))
    return lines.where(F.col("transaction_type") != "TENDER").withColumns({
        "transaction_type_name": flags.type_label(F.col("transaction_type")),
        "is_loss_event": flags.is_loss(F.col("transaction_type")).cast("int"),
        "is_taxable": flags.has_flag(flag, "is_taxable").cast("int"),
        "is_food_stamp": flags.has_flag(flag, "is_food_stamp").cast("int"),
        "is_wic": flags.has_flag(flag, "is_wic").cast("int"),
    })


ITEM_FIELDS = (
    "item_desc", "product_key", "department_code", "department_name", "category_name", "vendor", "unit_cost",
)


def item_index(master: DataFrame) -> DataFrame:
    """One row per barcode without its leading zeros.

    `item` is the latest master row for the barcode, `variants` holds the rows whose own, differently
    padded spellings differ from it. Padding bounds the number of spellings. All-zero codes are left out.
    """
    row = F.struct(*ITEM_FIELDS)
    spelled = (
        master.where(text.strip_zeros(F.col("item_id")) != "")
        .groupBy("item_id")
        .agg(F.max_by(row, "ord").alias("_row"), F.max("ord").alias("_ord"))
    )
    entries = F.collect_list(F.struct("item_id", "_row"))
    return (
        spelled.groupBy(text.strip_zeros(F.col("item_id")).alias("_code"))
        .agg(
            F.max_by("_row", "_ord").alias("_item"),
            F.when(F.count(F.lit(1)) > 1, F.map_from_entries(entries)).alias("_variants"),
        )
    )


def subdepartment_votes(master: DataFrame) -> DataFrame:
    """Sub-department code to department, by majority of the items that carry both.

    On equal votes the department seen first in the master wins.
    """
    sub, dept = F.trim(text.blank(F.col("category_code"))), F.trim(text.blank(F.col("department_code")))
    votes = (
        master.select("ord", sub.alias("subdepartment"), dept.alias("department_code"))
        .where((F.col("subdepartment") != "") & (F.col("subdepartment") != "0") & (F.col("department_code") != ""))
        .groupBy("subdepartment", "department_code")
        .agg(F.count(F.lit(1)).alias("votes"), F.min("ord").alias("first_seen"))
    )
    return votes.groupBy("subdepartment").agg(
        F.min_by("department_code", F.struct(-F.col("votes"), "first_seen")).alias("department_code"),
        F.max("votes").alias("votes"),
    )


def department_names(master: DataFrame) -> DataFrame:
    """Department code to name; the last name in the master stands."""
    return (
        master.where(F.trim(text.blank(F.col("department_code"))) != "")
        .groupBy(F.trim("department_code").alias("department_code"))
        .agg(F.max_by("department_name", "ord").alias("department_name"))
    )


def department_lookup(master: DataFrame) -> DataFrame:
    """Raw department code of a line to (department, name), votes first, then the code itself."""
    names = department_names(master)
    voted = subdepartment_votes(master).select(F.col("subdepartment").alias("raw_department"), "department_code", F.lit(1).alias("_voted"))
    own = names.select(F.col("department_code").alias("raw_department"), "department_code", F.lit(0).alias("_voted"))
    codes = voted.unionByName(own).groupBy("raw_department").agg(
        F.max_by("department_code", "_voted").alias("department_code")
    )
    return codes.join(names, "department_code", "left").select(
        "raw_department",
        F.col("department_code").alias("_mapped"),
        F.col("department_name").alias("_mapped_name"),
    )


def enrich(
    items: DataFrame, master: DataFrame, stores: DataFrame | None = None, whole: bool = False, index: DataFrame | None = None
) -> DataFrame:
    """Item lines with product, department, cost and margin: the detail table.

    Four cases: the barcode is in the master; a promotional department key; an open department key;
    an unknown barcode. `whole` is for those who use all columns, as writers do: lines then meet a large master with
    their texts in one column. `index` is the master's item_index, where it is stored.
    """
    barcode = F.col("item_id")
    # Lines without a barcode match nothing: a key per line keeps them from meeting in one task.
    code = F.when(
        text.strip_zeros(barcode) == "",
        F.concat(F.lit("none-"), F.xxhash64("transaction_id", "sequence", "extended_price").cast("string")),
    ).otherwise(text.strip_zeros(barcode))
    spread = ["transaction_id", "sequence"]
    index, lines = item_index(master) if index is None else index, items.withColumn("_code", code)
    if broadcast_by_file_size(index):
        lines = left_join(lines, index, ["_code"], spread)
    elif whole:
        lines = light(lines, lambda r: left_join(r, index.hint("merge"), ["_code"], [TEXTS]), ("_code",))
    else:
        lines = left_join(lines, index.hint("merge"), ["_code"], spread)
    # One short row per department code, however many items the master has: lines are not shuffled for it.
    lines = left_join(lines, F.broadcast(department_lookup(master)), ["raw_department"], spread)

    exact = F.coalesce(F.try_element_at("_variants", barcode), F.col("_item"))
    lines = lines.withColumn(
        "_found", F.when(barcode == F.col("_code"), F.col("_item")).otherwise(exact)
    )
    key = F.upper("key_function")
    found = F.col("_found").isNotNull()
    promo, open_dept = key.startswith("OPEN DEPT TOL"), key.startswith("OPEN DEPT")
    raw = F.col("raw_department")
    mapped = F.coalesce(F.col("_mapped"), raw)
    mapped_name = F.coalesce(F.col("_mapped_name"), F.concat(F.lit("Dept "), mapped))
    promo_code = F.trim(F.regexp_replace(key, "OPEN DEPT", ""))
    unknown = F.concat(F.lit("Unknown barcode "), barcode)

    def four(field: str, on_promo: Column, on_open: Column, on_unknown: Column) -> Column:
        return (
            F.when(found, F.col("_found")[field])
            .when(promo, on_promo)
            .when(open_dept, on_open)
            .otherwise(on_unknown)
        )

    none = F.lit("")
    item_dept = F.coalesce(F.nullif(F.col("_found")["department_code"], none), raw)
    cost = F.coalesce(F.col("_found")["unit_cost"], F.lit(0)).cast("decimal(18,4)")
    margin = F.round(F.col("extended_price") - cost * F.col("quantity"), 2).cast("decimal(18,2)")
    lines = lines.withColumns({
        "item_desc": four(
            "item_desc",
            F.concat(F.lit("Promotional discount ("), promo_code, F.lit(")")),
            F.concat(mapped_name, F.lit(" - open department key")),
            unknown,
        ),
        "product_key": four(
            "product_key",
            F.lit("PROMOTIONAL DISCOUNT"),
            F.concat(F.lit("OPEN DEPT "), mapped),
            F.upper(unknown),
        ),
        "department_code": F.when(found, item_dept).when(promo, raw).otherwise(mapped),
        "department_name": four("department_name", F.lit("Promotions"), mapped_name, mapped_name),
        "category_name": four(
            "category_name", F.lit("Promotional discount"), F.lit("Open department"), F.lit("Unmatched")
        ),
        "vendor": four("vendor", none, none, none),
        "unit_cost": cost,
        "gross_margin": F.when(cost != 0, margin).otherwise(F.lit(0).cast("decimal(18,2)")),
    })
    if stores is not None:
        lines = left_join(lines.drop("store_name"), stores.select("store_id", "store_name"), ["store_id"], spread)
    name = F.col("store_name") if "store_name" in lines.columns else F.lit(None).cast("string")
    return lines.withColumn("store_name", text.store_label(F.col("store_id"), name)).select(*DETAIL_COLUMNS)


def detail_from_log(lines: DataFrame, master: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    """Raw log lines to the detail table."""
    return enrich(typed(tendered_runs(lines.select(*PLACE, *TYPED_FIELDS))), master, stores, whole=True)


def render(record: DataFrame, settings=DEFAULT_SETTINGS) -> Column:
    """A raw record as the log line a register would write.

    One text out of values and what stands between them: a text per field would be made only to be copied.
    """
    kinds, pieces = dict(record.dtypes), [""]
    for place, name in enumerate(log_fields(settings)):
        quote = '"' if name in QUOTED_FIELDS else ""
        pieces[-1] += ("," if place else "") + quote
        if name in kinds:
            value = F.col(name)
            number = not quote and kinds[name].startswith(("decimal", "double"))
            shown = numbers.plain_number(value) if number else value.cast("string")
            pieces += [text.blank(shown), quote]
        else:
            pieces[-1] += quote or "0"
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces if not (isinstance(p, str) and p == "")])


def log_file_name(day: Column, transaction: Column, store: Column | None = None) -> Column:
    """Name of a transaction's file, with the store code when there is one."""
    parts = [F.date_format(day, "yyyy-MM-dd"), transaction]
    stem = F.concat_ws("_", *parts)
    if store is not None:
        stem = F.when(F.coalesce(store, F.lit("")) != "", F.concat_ws("_", *parts, store)).otherwise(stem)
    return F.concat(stem, F.lit(".txt"))
