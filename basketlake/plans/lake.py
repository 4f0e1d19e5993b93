"""The tables reports read, and the choice among them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlake.functions.dates import DEFAULT_HISTORY_START
from basketlake.operators.baskets import SET_COLUMN
from basketlake.schemas import (
    DEPT_ROLLUP_KEYS,
    DEPT_ROLLUP_LABELS,
    ITEM_ROLLUP_KEYS,
    ITEM_ROLLUP_LABELS,
)

ADDITIVE = ("units", "revenue", "margin", "discount", "line_count")
# A department code can come with several names, of which a department row keeps one: reports by name need items.
_DEPT = {*DEPT_ROLLUP_KEYS, *DEPT_ROLLUP_LABELS, *ADDITIVE} - {"department_name"}
_ITEM = {*ITEM_ROLLUP_KEYS, *ITEM_ROLLUP_LABELS, *ADDITIVE}
# Kept by rollups that were built with basket numbers; detail lines have transaction_id and unit_price instead.
_WITH_SETS = {SET_COLUMN, "price_sum"}


def detail_measures(detail: DataFrame) -> DataFrame:
    """Detail lines under the names the rollups use for their measures."""
    return detail.withColumns({
        "sale_date": F.to_date("transaction_ts"),
        "units": F.col("quantity"),
        "revenue": F.col("extended_price"),
        "margin": F.col("gross_margin"),
        "discount": F.col("loyalty_discount") + F.col("premium_discount"),
        "line_count": F.lit(1).cast("long"),
        "price_sum": F.col("unit_price"),
    })


@dataclass(frozen=True)
class Later:
    """A table that is opened, or written, when it is first used; its columns are known before."""

    columns: tuple[str, ...]
    open: Callable[[], DataFrame]


@dataclass(frozen=True)
class Lake:
    """Detail table, and the rollups where they are stored.

    Reports ask `measures` for columns and get the smallest stored table that has them. A rollup that
    is not stored is not built for a single report: sums of detail lines need no daily grain. A table given as
    `Later` is opened for the first report that reads it.
    """

    detail: DataFrame
    catalogue: DataFrame | None = None
    rollup_item: DataFrame | None = None
    rollup_dept: DataFrame | None = None
    as_of: dt.date = field(default_factory=dt.date.today)
    history_start: dt.date = DEFAULT_HISTORY_START

    def __getattribute__(self, name: str):
        value = object.__getattribute__(self, name)
        return value.open() if isinstance(value, Later) else value

    def route(self, columns: set[str]) -> str:
        sets = columns & _WITH_SETS
        for name, offered in (("rollup_dept", _DEPT), ("rollup_item", _ITEM)):
            stored = vars(self)[name]
            if stored is not None and columns - sets <= offered and (not sets or sets <= set(stored.columns)):
                return name
        return "detail"

    def measures(self, *columns: str) -> DataFrame:
        name = self.route(set(columns))
        return detail_measures(self.detail) if name == "detail" else getattr(self, name)

    def only(self, name: str) -> "Lake":
        """The same lake with at most one rollup, for comparing them."""
        keep = {r: (vars(self)[r] if r == name else None) for r in ("rollup_item", "rollup_dept")}
        return replace(self, **{"detail": vars(self)["detail"], **keep})
