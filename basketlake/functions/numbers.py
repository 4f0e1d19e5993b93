"""Numbers out of text, guarded ratios, and number formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlake.fixed_values import DOLLARS_PER_TERABYTE


def safe_double(c: Column) -> Column:
    """The number in a text, 0 when there is none."""
    value = c.try_cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value)


def safe_int(c: Column) -> Column:
    """The number in a text cut to an integer, 0 when there is none."""
    return safe_double(c).cast("int")


def safe_decimal(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """As safe_double, kept exact."""
    kind = f"decimal({precision},{scale})"
    return F.coalesce(c.try_cast(kind), F.lit(0).cast(kind))


def number_or_null(c: Column) -> Column:
    """Drop everything but digits, dot and minus; NULL when no number is left."""
    return F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double")


def money(c: Column) -> Column:
    """A price as the price book writes it: dollar signs, cent signs, spreadsheet errors."""
    text = F.trim(c)
    value = number_or_null(text)
    in_cents = text.endswith("¢") | text.endswith("�")
    return (
        F.when(text.isNull() | text.isin("", "-", "#NAME?"), F.lit(None).cast("double"))
        .when(in_cents & (value > 5), value / 100)
        .otherwise(value)
    )


def first_nonzero(*prices: Column) -> Column:
    """The first price that is neither missing nor zero; else the last one."""
    *head, last = prices
    result = last
    for price in reversed(head):
        result = F.when(price != 0, price).otherwise(result)
    return result


def ratio(part: Column, whole: Column, factor: float = 1.0) -> Column:
    """part / whole as a double, NULL when there is nothing to divide by."""
    value = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return value if factor == 1.0 else value * F.lit(factor)


def percent_change(now: Column, before: Column) -> Column:
    """Change in percent, NULL where the earlier figure is zero or missing."""
    return ratio(now.cast("double") - before.cast("double"), before, 100.0)


def plain_number(c: Column) -> Column:
    """A decimal as the registers write it: two digits, trailing zeros cut."""
    text = c.cast("decimal(18,2)").cast("string")
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def scan_cost(byte_count: Column) -> Column:
    """Dollars charged for scanning that many bytes."""
    return byte_count.cast("double") / F.lit(float(1024**4)) * F.lit(DOLLARS_PER_TERABYTE)


def scan_size_text(byte_count: Column) -> Column:
    """Bytes as text, in MB below a gigabyte and in GB from there on."""
    gigabyte = float(1024**3)
    return F.when(
        byte_count < gigabyte,
        F.format_string("%.1f MB", byte_count.cast("double") / float(1024**2)),
    ).otherwise(F.format_string("%.2f GB", byte_count.cast("double") / gigabyte))
