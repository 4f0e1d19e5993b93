"""Barcodes, product names, search words, store labels."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlake.fixed_values import (
    CATEGORY_SEASONS,
    PRODUCT_UNIT_WORDS,
    PRODUCT_UNITS,
    SEARCH_STOP_WORDS,
    SEASON_RULES,
    STEM_MIN_RESULT,
    STEM_MIN_WORD,
    STEM_SUFFIXES,
)


def blank(c: Column) -> Column:
    """A missing text is the empty text."""
    return F.coalesce(c, F.lit(""))


def strip_zeros(c: Column) -> Column:
    return F.ltrim(c, F.lit("0"))


def pad_barcode(c: Column, width: int = 14) -> Column:
    """Zeros in front up to the width; longer codes stay whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def digits_of(c: Column) -> Column:
    return F.regexp_replace(blank(c), "[^0-9]", "")


def squeeze(c: Column) -> Column:
    """Trim, and one blank for every run of white space."""
    return F.trim(F.regexp_replace(blank(c), r"\s+", " "))


def recover_barcode(dashed: Column, numeric: Column) -> tuple[Column, Column]:
    """(barcode, damaged): the dashed column where it is whole, else the digits of the numeric one."""
    from_dashed = digits_of(dashed)
    stripped = strip_zeros(from_dashed)
    usable = F.length(from_dashed) >= 6
    code = F.when(usable, F.when(stripped == "", from_dashed).otherwise(stripped)).otherwise(digits_of(numeric))
    damaged = ~usable & F.trim(blank(numeric)).rlike(r"[Ee]\+?\d")
    return code, damaged


def product_key(description: Column) -> Column:
    """One key for a product sold under several barcodes; sizes stay part of it."""
    text = F.regexp_replace(F.upper(blank(description)), "[^A-Z0-9 ]", " ")
    text = F.regexp_replace(text, rf"\b({'|'.join(PRODUCT_UNIT_WORDS)})\b", " ")
    for unit, spellings in PRODUCT_UNITS:
        text = F.regexp_replace(text, rf"(\d)\s*({'|'.join(spellings)})\b", f"$1{unit}")
    return squeeze(text)


def season_tag(description: Column, category: Column) -> Column:
    """The first season rule with a keyword in the text, then the category's season, else flat."""
    words = F.upper(F.concat(blank(description), F.lit(" "), blank(category)))
    code = F.upper(blank(category))
    by_category = F.lit("flat")
    for name, season in CATEGORY_SEASONS.items():
        by_category = F.when(code == name, F.lit(season)).otherwise(by_category)

    def tagged(text: Column) -> Column:
        result = F.lit(None).cast("string")
        for season, keywords in reversed(SEASON_RULES):
            result = F.when(reduce(or_, [text.contains(k) for k in keywords]), F.lit(season)).otherwise(result)
        return result

    # Plain searches take a fraction of a pattern of alternatives; inside `transform` the text is made once for all of them.
    return F.coalesce(F.transform(F.array(words), tagged)[0], by_category)


def stem(word: Column) -> Column:
    """A search word without its plural; short words stay."""
    w = F.lower(F.trim(word))
    result = w
    for suffix, cut in reversed(STEM_SUFFIXES):
        shorter = F.substring(w, F.lit(1), F.length(w) - cut)
        cut_word = F.when(F.length(shorter) >= STEM_MIN_RESULT, shorter).otherwise(w)
        result = F.when(w.endswith(suffix), cut_word).otherwise(result)
    return F.when(F.length(w) < STEM_MIN_WORD, w).otherwise(result)


def search_words(query: Column) -> Column:
    """The words of a query without filler words, as an array."""
    words = F.split(F.trim(F.regexp_replace(query, ",", " ")), r"\s+")
    stop = F.array(*[F.lit(w) for w in SEARCH_STOP_WORDS])
    return F.filter(words, lambda w: (w != "") & ~F.array_contains(stop, F.lower(w)))


def is_barcode_query(query: Column) -> Column:
    """A query for a barcode: five digits or more, and no word in it."""
    return (F.length(digits_of(query)) >= 5) & ~query.rlike("[a-zA-Z]{2,}")


def store_label(code: Column, name: Column) -> Column:
    """The store's name, or a label made of its code."""
    short = strip_zeros(code)
    return F.coalesce(name, F.concat(F.lit("Store "), F.when(short == "", code).otherwise(short)))
