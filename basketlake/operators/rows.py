"""Whole rows on their way through a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXTS = "_texts"
_SEPARATOR, _ESCAPE = "\u0001", "\u0002"
_NULL = f"{_ESCAPE}n"


def _joined(texts: list[str]) -> Column:
    """The texts as one. Nulls are told from empty texts, and separators inside texts, hardly ever there, are escaped."""

    def escaped(c: Column) -> Column:
        return F.replace(F.replace(c, F.lit(_ESCAPE), F.lit(f"{_ESCAPE}e")), F.lit(_SEPARATOR), F.lit(f"{_ESCAPE}s"))

    # Functions of one array: an expression per text makes a method that is too long to be compiled.
    all_texts, plain = F.array(*texts), F.array_join(F.array(*texts), "")
    special = plain.contains(_SEPARATOR) | plain.contains(_ESCAPE)
    return F.array_join(F.when(special, F.transform(all_texts, escaped)).otherwise(all_texts), _SEPARATOR, _NULL)


def _split(joined: Column) -> Column:
    def read(c: Column) -> Column:
        plain = F.replace(F.replace(c, F.lit(f"{_ESCAPE}s"), F.lit(_SEPARATOR)), F.lit(f"{_ESCAPE}e"), F.lit(_ESCAPE))
        return F.when(c != _NULL, plain)

    parts = F.split(joined, _SEPARATOR, -1)
    return F.when(joined.contains(_ESCAPE), F.transform(parts, read)).otherwise(parts)


def light(rows: DataFrame, move: Callable[[DataFrame], DataFrame], keys: tuple[str, ...] = ()) -> DataFrame:
    """`move(rows)`, a shuffle or a join, through which the texts of a row go as one column; `keys` stay as they are.

    In a shuffle each text column costs a place, a length and padding, which compress badly: a wide row of short texts
    takes less than half as one. For rows of which all columns are used, as unused ones can't be pruned below it.
    """
    texts = [f.name for f in rows.schema.fields if f.dataType == T.StringType() and f.name not in keys]
    if len(texts) < 2:
        return move(rows)
    others = [c for c in rows.columns if c not in texts]
    moved = move(rows.select(*others, _joined(texts).alias(TEXTS)))
    # `explode` keeps the split in an operator of its own: as a plain column it would be made for every text.
    parts = moved.withColumn(TEXTS, F.explode(F.array(_split(F.col(TEXTS)))))
    part = {c: F.col(TEXTS)[i].alias(c) for i, c in enumerate(texts)}
    added = [c for c in moved.columns if c not in others and c != TEXTS]
    return parts.select(*[part.get(c, F.col(c)) for c in rows.columns], *added)
