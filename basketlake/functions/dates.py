"""Log timestamps, report periods and date predicates."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.functions.numbers import safe_int

DEFAULT_HISTORY_START = dt.date(2024, 1, 1)
PERIODS = (
    "today", "yesterday", "last_7_days", "last_30_days", "last_90_days", "last_week",
    "this_month", "last_month", "this_year", "all_time",
)


def log_date(c: Column) -> Column:
    """Month/day/year text as a date, NULL when it is none."""
    return F.try_to_date(c, "M/d/yyyy")


def log_timestamp(date_text: Column, seconds_text: Column) -> Column:
    """Date plus seconds since midnight, held to the last second of the day."""
    return timestamp_at(log_date(date_text), F.least(safe_int(seconds_text), F.lit(86399)))


def timestamp_at(day: Column, seconds: Column) -> Column:
    zero = F.lit(0)
    return day.cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def iso_date_in(name: Column) -> Column:
    """The YYYY-MM-DD in a file name, NULL when there is none or it is no date."""
    return F.try_to_date(F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")), "yyyy-MM-dd")


def period_bounds(
    period: str, as_of: dt.date, history_start: dt.date = DEFAULT_HISTORY_START
) -> tuple[dt.date, dt.date]:
    """First and last day of a named period; an unknown name means the last 30 days."""
    day = dt.timedelta(days=1)
    month_start = as_of.replace(day=1)
    if period == "today":
        return as_of, as_of
    if period == "yesterday":
        return as_of - day, as_of - day
    if period == "last_week":
        monday = as_of - day * (as_of.weekday() + 7)
        return monday, monday + day * 6
    if period == "this_month":
        return month_start, as_of
    if period == "last_month":
        return (month_start - day).replace(day=1), month_start - day
    if period == "this_year":
        return as_of.replace(month=1, day=1), as_of
    if period == "all_time":
        return history_start, as_of
    lookback = {"last_7_days": 7, "last_90_days": 90}.get(period, 30)
    return as_of - day * lookback, as_of


def period_bound_columns(period: Column, as_of: Column, history_start: Column) -> tuple[Column, Column]:
    """The same over columns, for a table of requests."""
    month_start = F.trunc(as_of, "MM")
    monday = F.date_sub(F.trunc(as_of, "WEEK"), 7)
    start = (
        F.when(period == "today", as_of)
        .when(period == "yesterday", F.date_sub(as_of, 1))
        .when(period == "last_7_days", F.date_sub(as_of, 7))
        .when(period == "last_90_days", F.date_sub(as_of, 90))
        .when(period == "last_week", monday)
        .when(period == "this_month", month_start)
        .when(period == "last_month", F.add_months(month_start, -1).cast("date"))
        .when(period == "this_year", F.trunc(as_of, "YEAR"))
        .when(period == "all_time", history_start)
        .otherwise(F.date_sub(as_of, 30))
    )
    end = (
        F.when(period == "yesterday", F.date_sub(as_of, 1))
        .when(period == "last_week", F.date_add(monday, 6))
        .when(period == "last_month", F.date_sub(month_start, 1))
        .otherwise(as_of)
    )
    return start, end


def years_back(day: dt.date, years: int) -> dt.date:
    """The same day some years earlier; 29 February becomes the 28th where there is none."""
    year = day.year - years
    return dt.date(year, day.month, min(day.day, calendar.monthrange(year, day.month)[1]))


def partition_predicate(start: dt.date, end: dt.date) -> Column:
    """Year and month bounds of a span, in a form Catalyst prunes partitions with."""
    year, month = F.col("year"), F.col("month")
    if start.year == end.year:
        return (year == start.year) & month.between(start.month, end.month)
    first = (year == start.year) & (month >= start.month)
    last = (year == end.year) & (month <= end.month)
    if end.year - start.year == 1:
        return first | last
    return first | last | ((year > start.year) & (year < end.year))


def in_period(df: DataFrame, start: dt.date, end: dt.date, date_column: str = "sale_date") -> DataFrame:
    """Rows of a span; tables laid out by year and month are pruned as well."""
    if {"year", "month"} <= set(df.columns):
        df = df.where(partition_predicate(start, end))
    return df.where(F.col(date_column).between(F.lit(start), F.lit(end)))
