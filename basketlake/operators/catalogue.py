"""The item master out of a price book: cleaning, categories, costs, demand, observed movement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.fixed_values import (
    CURVE_EXPONENT,
    CURVE_OFFSET,
    DEFAULT_REVENUE_SHARE,
    BOOK_DEPARTMENTS,
    EXCLUDED_DEPARTMENTS,
    IMPLAUSIBLE_MARGIN,
    MARGIN_CEILING,
    MARGIN_FALLBACK,
    MARGIN_FLOOR,
    NOISE_HIGH,
    NOISE_LOW,
    RANK_NOISE_WEIGHT,
    RANK_PRICE_WEIGHT,
    TARGET_REVENUE_SHARE,
    UNREPORTED_FACTOR,
)
from basketlake.functions import text
from basketlake.functions.numbers import first_nonzero, money, ratio
from basketlake.operators.skew import group_median, left_join, positions
from basketlake.schemas import ITEM_MASTER
from basketlake.session import stored

EVERY_DEPARTMENT = "*"
DUPLICATE, NO_PRICE = "duplicate upc", "no price"
PRICE_BOOK_COLUMNS = [
    "Upc with Dashes", "UPC", "Description", "POS Description", "Department", "Dept 4", "Category Name",
    "Sub Category", "Retail w/o dollar sign", "Price w/o dollar sign", "Cost", "Base Unit Cost", "Brand",
    "Vendor Name", "Food Stamp", "WIC",
]


def _field(name: str) -> Column:
    return F.trim(text.blank(F.col(f"`{name}`")))


def clean(book: DataFrame) -> DataFrame:
    """Typed price book rows: recovered barcode, description, price and cost.

    Stored, since the votes, the reasons and the items are all taken from it.
    """
    upc, damaged = text.recover_barcode(F.col("`Upc with Dashes`"), F.col("UPC"))
    described = text.squeeze(_field("Description"))
    register = text.squeeze(_field("POS Description"))
    # A book is a small file of one split, whose many patterns would be one task's work.
    rows = book.repartition("ord").select(
        "ord", upc.alias("upc"), damaged.cast("int").alias("damaged_upc"),
        F.when(described != "", described).otherwise(register).alias("description"),
        register.alias("register_text"), _field("Department").alias("department_code"),
        _field("Dept 4").alias("dept4"), text.squeeze(_field("Category Name")).alias("category"),
        _field("Sub Category").alias("sub_category"),
        first_nonzero(money(_field("Retail w/o dollar sign")), money(_field("Price w/o dollar sign"))).alias("price"),
        first_nonzero(money(_field("Cost")), money(_field("Base Unit Cost"))).alias("cost"),
        text.squeeze(_field("Brand")).alias("brand"), text.squeeze(_field("Vendor Name")).alias("vendor"),
        F.when(F.upper(_field("Food Stamp")).startswith("Y"), "Y").otherwise("N").alias("food_stamp"),
        F.when(F.upper(_field("WIC")) == "WIC", "Y").otherwise("N").alias("wic"),
    )
    return stored(rows, "pricebook")


def with_skip_reason(rows: DataFrame) -> DataFrame:
    """Label the rows that do not become items; NULL for those that do.

    The first valid row of a barcode becomes the item; rows after it are duplicates, rows before it keep
    their own reason. The first valid row is an aggregate joined back with salts, since damaged barcodes
    can fall together on one code.
    """
    early = (
        F.when((F.col("upc") == "") | (F.col("description") == ""), "missing upc or description")
        .when(F.col("department_code").isin(*EXCLUDED_DEPARTMENTS), "non-merchandise department")
    )
    priced = F.col("price") > 0
    graded = rows.withColumn("_early", early)
    firsts = (
        graded.where(F.col("_early").isNull() & priced).groupBy("upc").agg(F.min("ord").alias("_first"))
    )
    joined = left_join(graded, firsts, ["upc"], ["ord"])
    reason = (
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when(F.col("ord") > F.col("_first"), DUPLICATE)
        .when(F.coalesce(priced, F.lit(False)), F.lit(None).cast("string"))
        .otherwise(NO_PRICE)
    )
    return joined.withColumn("skip_reason", reason).drop("_early", "_first")


def skip_counts(rows: DataFrame) -> DataFrame:
    """Rows and damaged barcodes per reason; kept rows under the reason "kept"."""
    reason = F.coalesce("skip_reason", F.lit("kept"))
    return rows.groupBy(reason.alias("skip_reason")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("damaged_upc").cast("long").alias("damaged_upcs")
    )


def category_votes(rows: DataFrame) -> DataFrame:
    """Code to category name by majority over the whole book; of equal votes the first seen."""
    votes = (
        rows.where((F.col("dept4") != "") & (F.col("category") != ""))
        .groupBy("dept4", "category")
        .agg(F.count(F.lit(1)).alias("votes"), F.min("ord").alias("first_seen"))
    )
    return votes.groupBy("dept4").agg(
        F.min_by("category", F.struct(-F.col("votes"), "first_seen")).alias("voted_category")
    )


def recover_categories(rows: DataFrame, votes: DataFrame) -> DataFrame:
    """Fill blank categories from the votes; `recovered` tells which."""
    joined = left_join(rows, votes, ["dept4"], ["ord"])
    found = text.blank(F.col("voted_category"))
    return joined.withColumns({
        "recovered": ((F.col("category") == "") & (found != "")).cast("int"),
        "category": F.when(F.col("category") != "", F.col("category")).otherwise(found),
    }).drop("voted_category")


def _looked_up(code: Column, table: dict) -> Column:
    """Value of a small fixed table, NULL where the code is not in it."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), code)


def impute_costs(items: DataFrame) -> DataFrame:
    """Replace missing and implausible costs by the department's median margin.

    Needs department_code, price and cost; adds unit_price, unit_cost, cost_source and margin_pct. The
    medians are exact. A department without one, or with a median of zero, takes the overall median.
    """
    price, cost = F.col("price"), F.col("cost")
    implausible = (cost <= 0) | (cost >= price) | ((price - cost) / price > IMPLAUSIBLE_MARGIN)
    marked = items.withColumns({
        "unit_price": F.round(price, 2),
        "cost_source": F.when(cost.isNull() | implausible, "imputed").otherwise("actual"),
    })
    # Every margin counts for its department and for the whole; one pass takes both medians.
    groups = F.explode(F.array(F.col("department_code"), F.lit(EVERY_DEPARTMENT)))
    margins = marked.where(F.col("cost_source") == "actual").select(
        groups.alias("department_code"), ((F.col("unit_price") - cost) / F.col("unit_price")).alias("margin")
    )
    medians = stored(
        group_median(margins, ["department_code"], "margin", F.floor(F.col("margin") * 1000), "_median"), "medians"
    )
    whole = medians.where(F.col("department_code") == EVERY_DEPARTMENT)
    overall = whole.agg(F.max("_median").alias("m")).scalar()
    joined = left_join(marked, medians, ["department_code"], ["ord"])
    fallback = first_nonzero(overall, F.lit(MARGIN_FALLBACK))
    chosen = F.coalesce(first_nonzero(F.col("_median"), fallback), fallback)
    margin = F.least(F.greatest(chosen, F.lit(MARGIN_FLOOR)), F.lit(MARGIN_CEILING))
    filled = F.when(
        F.col("cost_source") == "imputed", F.round(F.col("unit_price") * (1 - margin), 4)
    ).otherwise(cost)
    return joined.withColumn("unit_cost", filled).withColumn(
        "margin_pct", F.round((F.col("unit_price") - F.col("unit_cost")) / F.col("unit_price") * 100, 1)
    ).drop("_median")


def build_items(book: DataFrame, department_names: dict[str, str] = BOOK_DEPARTMENTS) -> DataFrame:
    """Item master without the demand columns; `ord` and `recovered` stay for later steps."""
    rows = clean(book)
    votes = category_votes(rows)
    kept = with_skip_reason(rows).where(F.col("skip_reason").isNull())
    items = impute_costs(stored(recover_categories(kept, votes), "kept"))
    short = F.substring("register_text", 1, 22)
    master = items.select(
        "ord", "recovered", text.pad_barcode(F.col("upc")).alias("item_id"), "upc",
        F.substring("description", 1, 60).alias("item_desc"),
        text.product_key(F.col("description")).alias("product_key"),
        F.when(short != "", short).otherwise(F.substring("description", 1, 22)).alias("pos_desc"),
        "department_code", F.coalesce(
            _looked_up(F.col("department_code"), department_names), F.concat(F.lit("Dept "), F.col("department_code"))
        ).alias("department_name"),
        F.when(F.col("sub_category") != "", F.col("sub_category")).otherwise("0").alias("category_code"),
        F.when(F.col("category") != "", F.col("category")).otherwise("Uncategorized").alias("category_name"),
        "brand", "vendor", "unit_price", "unit_cost", "cost_source", "margin_pct", "food_stamp", "wic",
        text.season_tag(F.col("description"), F.col("category")).alias("season"),
    )
    return stored(master, "items")


def _uniform(item: Column, part: int) -> Column:
    """A number in [0, 1) out of the item's id, the same on every run."""
    return F.conv(F.substring(F.md5(item), 8 * part + 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def price_percentiles(items: DataFrame) -> DataFrame:
    """Share of a department's items that are strictly cheaper, per department and price."""
    placed = positions(items, ["department_code"], "unit_price", F.floor("unit_price"))
    return placed.select("department_code", "unit_price", ratio(F.col("before"), F.col("total")).alias("percentile"))


def rank_weights(items: DataFrame) -> DataFrame:
    """Demand weight per item from its rank in the department: 1 / (rank + offset) ^ exponent, with noise."""
    percentile = price_percentiles(items)
    scored = left_join(
        items.select("ord", "item_id", "department_code", "unit_price"), percentile, ["department_code", "unit_price"], ["ord"]
    )
    score = (
        F.lit(RANK_PRICE_WEIGHT) * (1 - F.col("percentile")) + F.lit(RANK_NOISE_WEIGHT) * _uniform(F.col("item_id"), 0)
    )
    scored = scored.select(
        "department_code", "unit_price", F.struct((-score).alias("score"), F.col("item_id").alias("item_id"), F.col("ord").alias("ord")).alias("place")
    )
    ranked = positions(scored, ["department_code"], "place", F.floor(F.col("place.score") * 1000))
    noise = F.lit(NOISE_LOW) + F.lit(NOISE_HIGH - NOISE_LOW) * _uniform(F.col("place.item_id"), 1)
    weight = F.lit(1.0) / F.pow(F.col("before") + 1 + CURVE_OFFSET, F.lit(CURVE_EXPONENT))
    weights = ranked.select(
        "department_code", F.col("place.item_id").alias("item_id"), F.col("place.ord").alias("ord"), (F.col("before") + 1).alias("rank"),
        F.round(weight * noise, 8).alias("weight"),
    )
    return stored(weights, "weights")


def demand_weights(items: DataFrame, shares: dict[str, float] = TARGET_REVENUE_SHARE) -> DataFrame:
    """Popularity per item, scaled so each department lands on its target share of revenue; the largest is 1."""
    return popularity(items, shares).drop("ord")


def popularity(items: DataFrame, shares: dict[str, float] = TARGET_REVENUE_SHARE) -> DataFrame:
    """The same per row of the book, by `ord`: two barcodes that pad alike stay two rows."""
    weights = rank_weights(items).drop("department_code", "item_id")
    priced = items.select("ord", "item_id", "department_code", "unit_price").join(weights, "ord")
    exact = F.col("weight").cast("decimal(12,8)") * F.col("unit_price").cast("decimal(12,2)")
    expected = priced.groupBy("department_code").agg(F.sum(exact).cast("double").alias("_expected"))
    target = F.coalesce(_looked_up(F.col("department_code"), shares), F.lit(DEFAULT_REVENUE_SHARE))
    factors = expected.select(
        "department_code",
        F.when(F.col("_expected") > 0, target / F.col("_expected")).otherwise(F.lit(1.0)).alias("_factor"),
    )
    scaled = left_join(priced, factors, ["department_code"], ["ord"]).withColumn(
        "popularity", F.col("weight") * F.col("_factor")
    )
    biggest = scaled.agg(F.max("popularity").alias("m")).scalar()
    return scaled.select("ord", "item_id", "rank", "weight", F.round(F.col("popularity") / biggest, 9).alias("popularity"))


def overlay_movement(items: DataFrame, actuals: DataFrame) -> DataFrame:
    """Observed movement in place of modelled demand.

    An item in a report takes its rate, and its cost where that is plausible; of several stores the last
    row read stands. Modelled items of a covered category that no report lists are damped.
    """
    order = F.struct("file_no", "sheet_no", "row_idx")
    observed = actuals.where(F.col("units_per_day") > 0)
    code = text.strip_zeros(F.col("item_id"))
    rates = observed.groupBy(code.alias("_code")).agg(F.max_by("units_per_day", order).alias("_rate"))
    usable = observed.where(F.col("unit_cost").isNotNull())
    # A cost counts when it is below the item's price, so every observed cost of the item is looked at.
    with_code = items.withColumn("_code", code)
    costs = (
        usable.select(code.alias("_code"), "unit_cost", order.alias("_order"))
        .join(with_code.select("_code", F.col("unit_price").alias("_price")), "_code")
        .where((F.col("unit_cost") > 0) & (F.col("unit_cost") < F.col("_price")))
        .groupBy("_code")
        .agg(F.max_by("unit_cost", "_order").alias("_cost"))
    )
    covered = (
        actuals.where(F.col("category_name") != "")
        .groupBy(F.upper(F.trim("category_name")).alias("_category"))
        .agg(F.lit(True).alias("_covered"))
    )
    joined = left_join(with_code, rates, ["_code"], ["item_id"])
    joined = left_join(joined, costs, ["_code"], ["item_id"])
    joined = left_join(
        joined.withColumn("_category", F.upper(F.trim("category_name"))), covered, ["_category"], ["item_id"]
    )
    seen, new_cost = F.col("_rate").isNotNull(), F.round("_cost", 4)
    damped = ~seen & F.coalesce("_covered", F.lit(False))
    priced = F.col("_cost").isNotNull()
    return joined.withColumns({
        "observed_units_per_day": F.round("_rate", 4),
        "demand_source": F.when(seen, "observed").when(damped, "not in report").otherwise("modelled"),
        "popularity": F.when(damped, F.col("popularity") * UNREPORTED_FACTOR).otherwise(F.col("popularity")),
        "cost_source": F.when(priced, "movement report").otherwise(F.col("cost_source")),
        "margin_pct": F.when(
            priced, F.round((F.col("unit_price") - F.col("_cost")) / F.col("unit_price") * 100, 1)
        ).otherwise(F.col("margin_pct")),
        "unit_cost": F.when(priced, new_cost).otherwise(F.col("unit_cost")),
    }).drop("_code", "_category", "_rate", "_cost", "_covered")


def item_master(book: DataFrame, actuals: DataFrame | None = None, department_names: dict[str, str] = BOOK_DEPARTMENTS) -> DataFrame:
    """The whole job: price book, and movement where there is any, to the 21-column item master."""
    items = build_items(book, department_names)
    full = items.join(popularity(items).select("ord", "popularity"), "ord")
    if actuals is None:
        full = full.withColumns({
            "observed_units_per_day": F.lit(None).cast("double"), "demand_source": F.lit("modelled"),
        })
    else:
        full = overlay_movement(full, actuals)
    return full.select(*ITEM_MASTER.names)


def catalogue_summary(items: DataFrame) -> DataFrame:
    """Items, imputed costs, recovered and missing categories, products and those with several barcodes."""
    products = items.groupBy("product_key").agg(F.count(F.lit(1)).alias("n"))
    facts = items.agg(
        F.count(F.lit(1)).alias("items"),
        F.sum(F.when(F.col("cost_source") == "imputed", 1).otherwise(0)).cast("long").alias("imputed"),
        F.sum("recovered").cast("long").alias("recovered"),
        F.sum(F.when(F.col("category_name") == "Uncategorized", 1).otherwise(0)).cast("long").alias("uncategorized"),
        F.count_distinct("season").alias("seasons"),
    )
    several = F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).cast("long")
    return facts.withColumns({
        "products": products.agg(F.count(F.lit(1)).alias("n")).scalar(),
        "multi_barcode_products": products.agg(several.alias("n")).scalar(),
        "uncategorized_pct": ratio(F.col("uncategorized"), F.col("items"), 100.0),
    })


def items_by(items: DataFrame, column: str) -> DataFrame:
    """Items per department or season."""
    return items.groupBy(column).agg(F.count(F.lit(1)).alias("items"))


def demand_concentration(weights: DataFrame, top: int = 100) -> DataFrame:
    """Share of all demand carried by the most popular items."""
    exact = F.col("popularity").cast("decimal(18,9)")
    best = weights.orderBy(F.desc("popularity"), "item_id").limit(top)
    total = weights.agg(F.sum(exact).cast("double").alias("s")).scalar()
    return best.agg(
        F.count(F.lit(1)).alias("items"), F.sum(exact).cast("double").alias("_top")
    ).select("items", ratio(F.col("_top"), total, 100.0).alias("share_pct"))
