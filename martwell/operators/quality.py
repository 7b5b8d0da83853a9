"""Constraint checks as data-quality operators (Q1-Q6).

Each returns a DataFrame of violations (empty = clean); ``enforce`` turns a
non-empty result into an error, as a declared constraint would.

Scale notes: key checks group on the key columns only (column pruning keeps
the scan narrow) and combine map-side; a foreign-key check first reduces the
child to its distinct referenced values with their row counts, so a value
held by a third of all rows is one row before the anti-join shuffle.  Length,
amount and date checks are single scans.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwell.functions.exprs import try_parse_source_date
from martwell.sources.model import FOREIGN_KEYS, LENGTH_LIMITS, PRIMARY_KEYS, SALES_TYPE, RetailModel


# Keys that one task groups in a key check (Q1).
KEYS_PER_TASK = 1_000_000


class ConstraintViolation(Exception):
    """A declared constraint does not hold (strict checks and loads)."""


def _key_text(cols: Iterable[str]) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


def pk_violations(df: DataFrame, key_cols: list[str], table_name: str) -> DataFrame:
    """Q1: key values that repeat or contain NULL -> (table_name, key_value, n_rows).

    Nearly every row is a group of its own, and as such rows are narrow, shuffle
    partitions of the usual size would hold very many; so the keys of a large table
    are dealt into a number of partitions that follows the rows.  Keys with NULL,
    of which there may be very many alike, are grouped beside them."""
    any_null = F.lit(False)
    for c in key_cols:
        any_null = any_null | F.col(c).isNull()

    def told(keys: DataFrame, bad: Column) -> DataFrame:
        g = keys.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n_rows"))
        return g.where(bad).select(F.lit(table_name).alias("table_name"), _key_text(key_cols).alias("key_value"), "n_rows")

    keys, repeats = df.select(*key_cols), F.col("n_rows") > 1
    tasks = math.ceil(keys.count() / KEYS_PER_TASK)
    if tasks <= 1:
        return told(keys, repeats | any_null)
    dealt = keys.where(~any_null).repartition(tasks, *key_cols)
    return told(dealt, repeats).unionByName(told(keys.where(any_null), F.lit(True)))


def fk_violations(
    child: DataFrame, fk_col: str, parent: DataFrame, pk_col: str, table_name: str
) -> DataFrame:
    """Q2: non-NULL references without a parent ->
    (table_name, column_name, missing_value, n_rows).

    A sort-merge join, as the driver would have to hold the parent's keys for a
    broadcast, however small their files look.  That ``n_rows`` is above 0 holds always;
    in the join's condition it keeps the optimizer from putting the join below the
    grouping, where every row would be moved and not one per value and task."""
    refs = child.where(F.col(fk_col).isNotNull()).groupBy(F.col(fk_col).alias("_ref")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    keys = parent.select(F.col(pk_col).alias("_pk")).hint("merge")
    missing = refs.join(keys, (F.col("_ref") == F.col("_pk")) & (F.col("n_rows") > 0), "left_anti")
    return missing.select(
        F.lit(table_name).alias("table_name"),
        F.lit(fk_col).alias("column_name"),
        F.col("_ref").cast("string").alias("missing_value"),
        "n_rows",
    )


def insert_violations(
    new: DataFrame, existing: DataFrame, key: str, parents: dict[str, tuple[DataFrame, str]], table_name: str
) -> DataFrame:
    """Q1 and Q2 of an insert: what forbids adding ``new`` to the rows whose keys
    are ``existing`` -> (table_name, rule, key_value, n_rows).

    Only the new rows are grouped.  The existing keys and the parents' keys are
    read as one narrow column each and only filtered by the new rows' keys (semi
    and anti joins), so a small insert moves none of them."""

    def told(rule: str, df: DataFrame, value: str) -> DataFrame:
        return df.select(
            F.lit(table_name).alias("table_name"), F.lit(rule).alias("rule"), F.col(value).cast("string").alias("key_value"), "n_rows"
        )

    per_key = new.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n_rows"))
    out = told("key is null", per_key.where(F.col("_key").isNull()), "_key")
    out = out.unionByName(told("key repeats", per_key.where(F.col("_key").isNotNull() & (F.col("n_rows") > 1)), "_key"))
    present = existing.select(F.col(key).alias("_key")).join(per_key.select("_key"), "_key", "left_semi")
    present = present.distinct().withColumn("n_rows", F.lit(1).cast("long"))
    out = out.unionByName(told("key exists", present, "_key"))
    for column, (parent, pk) in parents.items():
        out = out.unionByName(told(f"{column} has no parent", fk_violations(new, column, parent, pk, table_name), "missing_value"))
    return out


def _too_long(column: str, limit: int) -> Column:
    return F.length(F.rtrim(F.col(column).cast("string"))) > limit


def _outside(date_col: str, bounds: list[tuple[str, date, date]]) -> Column:
    inside = F.lit(False)
    for _, lo, hi in bounds:
        inside = inside | ((F.col(date_col) >= F.lit(lo)) & (F.col(date_col) < F.lit(hi)))
    return F.col(date_col).isNull() | ~inside


def _misfit(amount_col: str) -> Column:
    return F.col(amount_col).isNotNull() & F.col(amount_col).try_cast(SALES_TYPE).isNull()


def _no_date(text: Column) -> Column:
    return text.isNotNull() & try_parse_source_date(text).isNull()


def faults(*bad: Column) -> Column:
    """Aggregate: how often one of the conditions holds in a row (0 for no rows)."""
    n = F.lit(0).cast("long")
    for b in bad:
        n = n + F.count_if(b)
    return n


def length_violations(df: DataFrame, limits: dict[str, int], table_name: str, key_col: str) -> DataFrame:
    """Q3: text longer than its declared limit (trailing blanks do not count,
    as for VARCHAR) -> (table_name, column_name, row_key, value_length).
    One scan per table whatever the number of columns."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.length(F.rtrim(F.col(c).cast("string"))).cast("long").alias("value_length"),
                F.lit(n).alias("limit"),
            )
            for c, n in limits.items()
        ]
    )
    bad = F.filter(cells, lambda x: x["value_length"] > x["limit"])
    return (
        df.select(F.col(key_col).cast("string").alias("row_key"), bad.alias("_bad"))
        .where(F.size("_bad") > 0)
        .select(F.lit(table_name).alias("table_name"), "row_key", F.explode("_bad").alias("b"))
        .select("table_name", F.col("b.column_name"), "row_key", F.col("b.value_length"))
    )


def within_limit(value: Column, table: str, column: str) -> Column:
    """``value`` if it fits the declared text limit; the job fails otherwise."""
    limit = LENGTH_LIMITS[table][column]
    said = F.lit(f"value too long for {table}.{column} ({limit})")
    return F.when(F.length(F.rtrim(value)) > limit, F.raise_error(said)).otherwise(value)


def range_violations(
    df: DataFrame, date_col: str, key_col: str, bounds: list[tuple[str, date, date]], table_name: str
) -> DataFrame:
    """Q4: rows whose date falls in no declared half-open range [lo, hi) or is
    NULL -> (table_name, row_key, date_value).  The ranges are few, so they are
    an expression, not a join."""
    return df.where(_outside(date_col, bounds)).select(
        F.lit(table_name).alias("table_name"),
        F.col(key_col).cast("string").alias("row_key"),
        F.col(date_col).alias("date_value"),
    )


def range_partition(date_col: str, bounds: list[tuple[str, date, date]]) -> Column:
    """Name of the range holding the date (NULL when none)."""
    out = None
    for name, lo, hi in bounds:
        cond = (F.col(date_col) >= F.lit(lo)) & (F.col(date_col) < F.lit(hi))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out if out is not None else F.lit(None).cast("string")


def amount_violations(df: DataFrame, amount_col: str, key_col: str, table_name: str) -> DataFrame:
    """Q5: amounts that do not fit NUMERIC(12,2) -> (table_name, row_key, amount_text)."""
    return df.where(_misfit(amount_col)).select(
        F.lit(table_name).alias("table_name"),
        F.col(key_col).cast("string").alias("row_key"),
        F.col(amount_col).cast("string").alias("amount_text"),
    )


def date_text_violations(df: DataFrame, date_cols: list[str], key_col: str, table_name: str) -> DataFrame:
    """Q6: date text that is not a d/M/yyyy date -> (table_name, column_name, row_key, date_text)."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("date_text")) for c in date_cols]
    )
    bad = F.filter(cells, lambda x: _no_date(x["date_text"]))
    return (
        df.select(F.col(key_col).cast("string").alias("row_key"), bad.alias("_bad"))
        .where(F.size("_bad") > 0)
        .select(F.lit(table_name).alias("table_name"), "row_key", F.explode("_bad").alias("b"))
        .select("table_name", F.col("b.column_name"), "row_key", F.col("b.date_text"))
    )


def enforce(violations: DataFrame, what: str) -> None:
    """Fail when any violation exists (reads at most one row)."""
    if violations.limit(1).count() > 0:
        raise ConstraintViolation(f"{what}: constraint violated")


# ---- whole-model checks ------------------------------------------------------------


def model_pk_violations(model: RetailModel) -> DataFrame:
    tables = model.tables()
    out = None
    for t, keys in PRIMARY_KEYS.items():
        v = pk_violations(tables[t], keys, t)
        out = v if out is None else out.unionByName(v)
    return out


def model_fk_violations(model: RetailModel) -> DataFrame:
    tables = model.tables()
    out = None
    for child, fk, parent, pk in FOREIGN_KEYS:
        v = fk_violations(tables[child], fk, tables[parent], pk, child)
        out = v if out is None else out.unionByName(v)
    return out


def model_length_violations(model: RetailModel) -> DataFrame:
    tables = model.tables()
    out = None
    for t, limits in LENGTH_LIMITS.items():
        key = PRIMARY_KEYS.get(t, list(limits))[0]
        v = length_violations(tables[t], limits, t, key)
        out = v if out is None else out.unionByName(v)
    return out


def staging_faults() -> dict[str, Column]:
    """Q5 and Q6 of staging rows as aggregates (check name -> number of
    violations), to be observed while the rows are written."""
    return {
        "amount": faults(_misfit("sales")),
        "date_text": faults(*(_no_date(F.col(c)) for c in ("order_date", "ship_date"))),
    }


def row_fault_counts(model: RetailModel, year_ranges: list[tuple[str, date, date]] | None = None) -> DataFrame:
    """Q3 and, with ``year_ranges``, Q4 of all tables as counts (check_name,
    n_violations): every table with a limit is read once, by one aggregation of
    the limited columns, whatever the number of limits and ranges."""
    tables, per_table = model.tables(), []
    for t in tables:
        told = {}
        if t in LENGTH_LIMITS:
            told["length"] = faults(*(_too_long(c, n) for c, n in LENGTH_LIMITS[t].items()))
        if t == "orders" and year_ranges:
            told["range"] = faults(_outside("order_date", year_ranges))
        if told:
            counts = tables[t].agg(*(c.alias(name) for name, c in told.items()))
            each = F.explode(F.array(*(F.struct(F.lit(n).alias("check_name"), F.col(n).alias("n")) for n in told)))
            per_table.append(counts.select(each.alias("c")).select("c.*"))
    every = reduce(DataFrame.unionByName, per_table)
    return every.groupBy("check_name").agg(F.sum("n").alias("n_violations"))


def check_summary(parts: dict[str, DataFrame]) -> DataFrame:
    """One row per check with its violation count (0 = clean)."""
    out = None
    for name, df in parts.items():
        row = df.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("check_name"), "n_violations")
        out = row if out is None else out.unionByName(row)
    return out
