"""Column expressions shared by the operators (all JVM built-ins, codegen'd).

Null rules follow SQL: comparisons with NULL are unknown, so a CASE falls to
its ELSE branch and a filter drops the row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from martwell.sources.model import SALES_TYPE

# The text date layout of the source files (day/month/year,
# one or two digits for day and month) and the month key layout.
SOURCE_DATE_FORMAT = "d/M/yyyy"
MONTH_FORMAT = "yyyy-MM"

# Shipping labels and the delay limit in days.
DELAYED = "Delayed"
ON_TIME = "On Time"
DELAY_LIMIT_DAYS = 5


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_source_date(c: str | Column) -> Column:
    """E1 strict: fails the job on text that is not a real date (ANSI)."""
    return F.to_date(col(c), SOURCE_DATE_FORMAT)


def try_parse_source_date(c: str | Column) -> Column:
    """E1 lenient: NULL where the text is not a real date (for quarantine)."""
    return F.try_to_date(col(c), SOURCE_DATE_FORMAT)


def month_key(d: str | Column) -> Column:
    """Date -> 'YYYY-MM'."""
    return F.date_format(col(d), MONTH_FORMAT)


def month_range(year_month: str) -> tuple[Column, Column]:
    """Half-open date range [first day, first day of next month) for a
    'YYYY-MM' text, as literals so the filter reaches the file scan."""
    start = F.to_date(F.lit(year_month + "-01"))
    return start, F.add_months(start, 1)


def days_between(end: str | Column, start: str | Column) -> Column:
    """Date - date as whole days (NULL if either is NULL)."""
    return F.datediff(col(end), col(start))


def shipping_status(days: Column) -> Column:
    """More than the limit is Delayed; equal, less or unknown is On Time."""
    return F.when(days > DELAY_LIMIT_DAYS, F.lit(DELAYED)).otherwise(F.lit(ON_TIME))


def to_money(c: Column) -> Column:
    """Assignment to NUMERIC(12,2): round half away from zero, overflow is an
    error under ANSI mode."""
    return c.cast(SALES_TYPE)


def raise_by_percent(sales: str | Column, percent: Decimal | int | str) -> Column:
    """Sales + sales * p / 100, exact decimal arithmetic, then (12,2).

    The percent is passed as a decimal literal; a float would turn the whole
    expression into a double."""
    p = F.lit(Decimal(str(percent)))
    s = col(sales)
    return to_money(s + s * p / F.lit(Decimal(100)))


def add_amount(sales: str | Column, amount: Decimal | int | str) -> Column:
    """Sales + x, then (12,2)."""
    return to_money(col(sales) + F.lit(Decimal(str(amount))))


def distinct_from(a: str | Column, b: str | Column) -> Column:
    """IS DISTINCT FROM (NULLs compare as values)."""
    return ~col(a).eqNullSafe(col(b))


def _plain_key(key: str) -> bool:
    return bool(key) and not set(key) & set("'?\\")


def json_text(c: str | Column, key: str) -> Column:
    """Profile->>'key' -- scalar as text, JSON null / missing / bad JSON
    as NULL, nested values as their JSON text.  A key is one key, whatever its
    spelling: dots and blanks are part of it."""
    if _plain_key(key):
        return F.get_json_object(col(c), f"$['{key}']")
    return F.try_element_at(F.from_json(col(c), "map<string,string>"), F.lit(key))


def json_value(c: str | Column, key: str) -> Column:
    """Profile->'key' as JSON text.  Strings keep their quotes, as the
    JSON operator does; other values are the same text as E10."""
    if _plain_key(key):
        return F.to_json(F.try_variant_get(F.try_parse_json(col(c)), f"$['{key}']", "variant"))
    return F.to_json(F.try_element_at(F.from_json(col(c), "map<string,variant>"), F.lit(key)))


def array_has(arr: str | Column, value: str) -> Column:
    """value = ANY(arr), search text trimmed first."""
    return F.array_contains(col(arr), F.lit(value.strip()))
