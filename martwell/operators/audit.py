"""Row-trigger logic as column functions.

Batch and stream use the same functions: an update produces a *change frame*
holding the old and the new value of every row in one pass (no self-join of
old and new table versions); the audit is a filter on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwell.functions.exprs import distinct_from
from martwell.operators.ranking import numbered


def audit_rows(changes: DataFrame, key: str = "row_id", old: str = "old_sales", new: str = "sales") -> DataFrame:
    """One audit row per changed amount -- old IS DISTINCT FROM new, so
    NULL -> value and value -> NULL count, NULL -> NULL does not.  Compared
    after assignment to NUMERIC(12,2), so a raise that rounds back is not a
    change."""
    return changes.where(distinct_from(old, new)).select(
        F.col(key).alias("row_id"), F.col(old).alias("old_sales"), F.col(new).alias("new_sales")
    )


def repaired_ship_date(ship: str | Column = "ship_date", order: str | Column = "order_date") -> Column:
    """A ship date before the order date becomes the order date.  A NULL
    on either side leaves the ship date as it is (unlike ``greatest``)."""
    s = F.col(ship) if isinstance(ship, str) else ship
    o = F.col(order) if isinstance(order, str) else order
    return F.when(s < o, o).otherwise(s)


def repair_ship_dates(orders: DataFrame, touched: Column | None = None) -> DataFrame:
    """T2 applied to the written rows (``touched``; all rows when None).  Rows
    not written keep their stored dates, as a BEFORE trigger only sees rows
    being inserted or updated."""
    fixed = repaired_ship_date()
    if touched is not None:
        fixed = F.when(touched, fixed).otherwise(F.col("ship_date"))
    return orders.withColumn("ship_date", fixed)


def number_audit_rows(audit: DataFrame, base_id: Column | int = 0, changed_at: Column | None = None) -> DataFrame:
    """M8 + M7: give new audit rows ids after ``base_id`` in row_id order and a
    change time.  The rows are written once in that order, one file per range;
    an id is the file's offset and the place in the file, so no task orders
    more than one range."""
    base = F.lit(base_id) if isinstance(base_id, int) else base_id
    ranked = numbered(audit, "row_id", "_pos")
    when = changed_at if changed_at is not None else F.localtimestamp()
    return ranked.select(
        (base + F.col("_pos")).cast("long").alias("audit_id"),
        F.col("row_id").cast("long").alias("row_id"),
        "old_sales",
        "new_sales",
        when.cast("timestamp_ntz").alias("changed_at"),
    )
