"""Questions without a report of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketlake.functions import flags
from basketlake.functions.numbers import percent_change, ratio
from basketlake.plans.lake import Lake
from basketlake.plans.reports import in_scope, item_code, money_sums, ranked_list, sales
from basketlake.session import stored


def dept_growth_qoq(lake: Lake, period: str = "all_time") -> DataFrame:
    """Revenue per department and quarter, and its change on the quarter before."""
    rows = sales(lake, period, ("department_name", "revenue"))
    quarter = F.date_trunc("quarter", "sale_date").cast("date").alias("quarter")
    sums = rows.groupBy("department_name", quarter).agg(*money_sums("revenue"))
    earlier = F.lag("revenue").over(W.partitionBy("department_name").orderBy("quarter"))
    return sums.withColumn("growth_pct", percent_change(F.col("revenue"), earlier))


def dept_yoy_trend(lake: Lake, period: str = "all_time") -> DataFrame:
    """Revenue per department and year, and its change on the year before."""
    rows = sales(lake, period, ("department_name", "revenue"))
    sums = rows.groupBy("department_name", F.year("sale_date").alias("year")).agg(*money_sums("revenue"))
    earlier = F.lag("revenue").over(W.partitionBy("department_name").orderBy("year"))
    return sums.withColumn("change_pct", percent_change(F.col("revenue"), earlier))


def monthly_revenue(lake: Lake, months: int = 18) -> DataFrame:
    """Revenue per month of the last months, the running one included."""
    first = F.add_months(F.trunc(F.lit(lake.as_of), "MM"), 1 - months)
    rows = sales(lake, "all_time", ("revenue", "margin")).where(F.col("sale_date") >= first)
    return rows.groupBy(F.trunc("sale_date", "MM").alias("month")).agg(*money_sums("revenue", "margin"))


def _share_of(lines: DataFrame, keys: list[str], kind: str) -> DataFrame:
    hit = F.col("transaction_type") == kind
    counts = lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(hit, 1).otherwise(0)).cast("long").alias("events"),
        F.coalesce(F.sum(F.when(hit, F.abs("extended_price"))).cast("double"), F.lit(0.0)).alias("value"),
    )
    return counts.withColumn("rate_pct", ratio(F.col("events"), F.col("lines"), 100.0))


def _detail(lake: Lake, period: str) -> DataFrame:
    return in_scope(lake, lake.measures("transaction_ts"), period)


def cashier_void_rate(lake: Lake, period: str = "all_time") -> DataFrame:
    """Voids per cashier as a share of the cashier's lines."""
    return _share_of(_detail(lake, period), ["store_id", "cashier_id"], "VOID")


def return_rate_by_dept(lake: Lake, period: str = "all_time") -> DataFrame:
    return _share_of(_detail(lake, period), ["department_name"], "RETURN")


def voids_by_hour(lake: Lake, period: str = "all_time") -> DataFrame:
    lines = _detail(lake, period).withColumn("hour", F.hour("transaction_ts"))
    return _share_of(lines, ["hour"], "VOID")


def category_peak_month(lake: Lake, month: int = 12, period: str = "all_time") -> DataFrame:
    """Categories whose best month of the year is the given one."""
    rows = sales(lake, period, ("category_name", "revenue"))
    sums = rows.groupBy("category_name", F.month("sale_date").alias("month")).agg(*money_sums("revenue"))
    best = sums.groupBy("category_name").agg(
        F.max_by("month", F.struct("revenue", -F.col("month"))).alias("peak_month"),
        F.max("revenue").alias("peak_revenue"), F.sum(F.col("revenue").cast("decimal(28,2)")).cast("double").alias("revenue"),
    )
    return best.withColumn("peaks_in_month", (F.col("peak_month") == month).cast("int"))


def basket_size_by_tender(lake: Lake, period: str = "all_time") -> DataFrame:
    """Mean lines, units and value of a basket per way of payment."""
    rows = sales(lake, period, ("tender_type", "transaction_id", "units", "revenue", "line_count"))
    baskets = rows.groupBy("tender_type", "transaction_id").agg(
        F.sum("line_count").alias("lines"), F.sum("units").alias("units"), F.sum("revenue").alias("revenue")
    )
    sums = baskets.groupBy("tender_type").agg(
        F.count(F.lit(1)).alias("baskets"), F.sum("lines").alias("_lines"), *money_sums("units", "revenue"),
        F.max("revenue").cast("double").alias("largest_basket"),
    )
    return sums.select(
        "tender_type", "baskets", ratio(F.col("_lines"), F.col("baskets")).alias("average_lines"),
        ratio(F.col("units"), F.col("baskets")).alias("average_units"),
        ratio(F.col("revenue"), F.col("baskets")).alias("average_value"), "largest_basket",
    )


def wic_share(lake: Lake, period: str = "all_time") -> DataFrame:
    """Share of sales that is WIC or food stamp eligible."""
    lines = _detail(lake, period).where(F.col("transaction_type") == "SALE")

    def eligible(flag: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(flag) == 1, F.col("extended_price"))).cast("double"), F.lit(0.0))

    sums = lines.agg(
        F.sum("extended_price").cast("double").alias("revenue"),
        eligible("is_wic").alias("wic_revenue"), eligible("is_food_stamp").alias("food_stamp_revenue"),
    )
    return sums.withColumns({
        "wic_pct": ratio(F.col("wic_revenue"), F.col("revenue"), 100.0),
        "food_stamp_pct": ratio(F.col("food_stamp_revenue"), F.col("revenue"), 100.0),
    })


def slow_mover_capital(
    lake: Lake, period: str = "last_90_days", max_units: float = 10.0, limit: int = 50
) -> DataFrame:
    """The dearest items, by unit cost, among those that sold few units or none.

    The log holds no stock levels, so this ranks what one unit ties up.
    """
    rows = sales(lake, period, ("item_id", "units"))
    sold = rows.groupBy(item_code().alias("code")).agg(*money_sums("units"))
    full = lake.catalogue.withColumn("code", item_code()).join(sold, "code", "left").na.fill(0, ["units"])
    slow = full.where((F.col("units") <= max_units) & (F.col("unit_cost") > 0))
    listed = ranked_list(slow, [F.desc("unit_cost"), F.col("item_id")], limit)
    return listed.select(
        "position", "item_id", "item_desc", "units", F.col("unit_cost").cast("double").alias("unit_cost")
    )


def saturday_busiest_hour(lake: Lake, period: str = "all_time", limit: int = 3) -> DataFrame:
    """The hours with most baskets on Saturdays."""
    lines = sales(lake, period, ("transaction_ts", "transaction_id", "revenue"))
    saturdays = lines.where(F.dayofweek("sale_date") == 7)
    baskets = saturdays.groupBy(F.hour("transaction_ts").alias("hour"), "transaction_id").agg(
        F.sum("revenue").alias("revenue")
    )
    hours = baskets.groupBy("hour").agg(F.count(F.lit(1)).alias("baskets"), *money_sums("revenue"))
    return ranked_list(hours, [F.desc("baskets"), F.col("hour")], limit).drop("more_exist")


#: Slots that pairs are counted in first: a bitmap of them is 2 MB, whatever the input.
PAIR_SLOTS = 1 << 24


def _slots_that_fill(pairs: DataFrame, least: int) -> DataFrame:
    """(part, bits): bitmaps of the slots that at least so many pairs fall in; a row per 4 kB, 512 at most."""
    counts = pairs.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return counts.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def frequent_pairs(held: DataFrame, basket: list[str], item: str, least: int) -> DataFrame:
    """(left, right, together), left < right: every two items that at least `least` baskets hold together.

    Takes distinct rows of basket and item. Pairs are counted twice: first in hashed slots, which are added up in tasks
    and shuffled as numbers, then by themselves where their slot is full enough to hold a frequent pair. A pair's slot
    counts at least as much as the pair, so none is missed, and the second count is exact. Pairs come from a join by
    basket, which AQE splits where a basket is long.
    """
    rows = held.select(*basket, item)
    met = rows.withColumnRenamed(item, "left").join(rows.withColumnRenamed(item, "right"), basket).where("left < right")
    pairs = met.select("left", "right", F.pmod(F.xxhash64("left", "right"), F.lit(PAIR_SLOTS)).alias("slot"))
    full = F.broadcast(_slots_that_fill(pairs, least))
    likely = pairs.withColumn("part", F.bitmap_bucket_number("slot")).join(full, "part")
    counts = likely.where(_is_set(F.col("bits"), F.bitmap_bit_position("slot"))).groupBy("left", "right")
    return counts.agg(F.count(F.lit(1)).alias("together")).where(F.col("together") >= least)


BASKET = ("store_id", "terminal_code", "sale_date", "transaction_id")


def frequent_basket_pairs(lake: Lake, period: str = "all_time", min_together: int = 20) -> DataFrame:
    """Products bought together in at least `min_together` baskets, whatever their own support.

    A basket is a transaction of a terminal on a day: register codes recur.
    """
    return basket_affinity(lake, period, 0.0, min_together, BASKET)


def basket_affinity(
    lake: Lake, period: str = "all_time", min_support: float = 0.01, min_together: int = 1, basket: tuple[str, ...] = ("transaction_id",)
) -> DataFrame:
    """Products bought together in at least `min_together` baskets: baskets with both, confidence and lift.

    `min_support` is the share of baskets that both products have to be in, 0 for all products. Products in fewer than
    `min_together` baskets can't be in such a pair and go before pairs are made; the others are numbered, so pairs are
    two numbers until the frequent ones get their names.
    """
    rows = sales(lake, period, (*basket, "product_key"))
    held = rows.select(*basket, "product_key").distinct()
    baskets = rows.select(*basket).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    support = held.groupBy("product_key").agg(F.count(F.lit(1)).alias("support"))
    support = support.where((F.col("support") >= min_together) & (F.col("support") >= baskets * F.lit(min_support)))
    numbered = stored(support.withColumn("no", F.monotonically_increasing_id()), "affinity-products")
    items = stored(held.join(numbered.select("product_key", "no"), "product_key").drop("product_key"), "affinity-baskets")
    pairs = frequent_pairs(items, list(basket), "no", min_together)

    def side(name: str) -> DataFrame:
        return numbered.select(F.col("no").alias(name), F.col("product_key").alias(f"{name}_key"), F.col("support").alias(f"{name}_support"))

    both = pairs.join(side("left"), "left").join(side("right"), "right")
    swap = F.col("left_key") > F.col("right_key")

    def ordered(column: str) -> list[Column]:
        left, right = F.col(f"left_{column}"), F.col(f"right_{column}")
        return [F.when(swap, right).otherwise(left), F.when(swap, left).otherwise(right)]

    (left_key, right_key), (left_n, right_n) = ordered("key"), ordered("support")
    lift = F.col("together") * baskets.cast("double") / (left_n.cast("double") * right_n.cast("double"))
    return both.select(
        left_key.alias("left_product"), right_key.alias("right_product"), left_n.alias("left_baskets"), right_n.alias("right_baskets"),
        "together", ratio(F.col("together"), left_n).alias("confidence"), lift.alias("lift"),
    )
