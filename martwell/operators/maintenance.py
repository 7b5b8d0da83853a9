"""Updates, deletes and view refresh as pure DataFrame functions (M1-M6, M9).

Parquet files are immutable, so each operator returns new table contents, or, for
some keys only (M1, M5, M6), the touched rows with their new values;
``martwell.sources.storage.TableStore`` writes the first as a new version and
``martwell.sources.layers`` the second as a small batch beside the base, and all
changed tables are published together.

Updates touching one key are a projection (no shuffle).  Updates given as a
DataFrame of keys are a left join on the key: Spark broadcasts the updates
when its size check allows, otherwise both sides are shuffled on the key.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martwell.functions.exprs import add_amount, raise_by_percent, to_money
from martwell.operators.audit import audit_rows, number_audit_rows, repaired_ship_date
from martwell.operators.quality import within_limit
from martwell.sources import layers
from martwell.sources.model import RetailModel

_HIT = "_touched"


def _one_per_key(updates: DataFrame, key: str, value_cols: list[str]) -> DataFrame:
    """At most one update per key; several for one key resolve to the largest
    value so the outcome does not depend on row order."""
    return updates.groupBy(key).agg(*[F.max(c).alias(c) for c in value_cols]).withColumn(_HIT, F.lit(True))


# ---- orders --------------------------------------------------------------------------


def update_ship_mode(orders: DataFrame, updates: DataFrame) -> DataFrame:
    """M1 set form: ``updates(order_id, new_mode)``.  The written rows pass
    through T2 (their ship date is repaired if it is before the order date);
    untouched rows keep their stored values."""
    u = _one_per_key(updates, "order_id", ["new_mode"])
    j = orders.join(u, "order_id", "left")
    hit = F.coalesce(F.col(_HIT), F.lit(False))
    return j.select(
        *[
            F.when(hit, within_limit(F.col("new_mode"), "orders", "ship_mode"))
            .otherwise(F.col("ship_mode"))
            .alias("ship_mode")
            if c == "ship_mode"
            else F.when(hit, repaired_ship_date()).otherwise(F.col("ship_date")).alias("ship_date")
            if c == "ship_date"
            else F.col(c)
            for c in orders.columns
        ]
    )


def set_ship_mode(orders: DataFrame, order_id, new_mode: str) -> DataFrame:
    """M1 single key (projection only)."""
    hit = F.col("order_id") == F.lit(order_id)
    return orders.withColumn("ship_date", F.when(hit, repaired_ship_date()).otherwise(F.col("ship_date"))).withColumn(
        "ship_mode", F.when(hit, within_limit(F.lit(new_mode), "orders", "ship_mode")).otherwise(F.col("ship_mode"))
    )


def set_ship_date(orders: DataFrame, order_id, new_date: Column) -> DataFrame:
    """M6: set one order's ship date; T2 repairs it if before the order date."""
    hit = F.col("order_id") == F.lit(order_id)
    return orders.withColumn(
        "ship_date", F.when(hit, repaired_ship_date(new_date, F.col("order_date"))).otherwise(F.col("ship_date"))
    )


# ---- order lines (changes carry old and new amount) ------------------------------------


def increase_sales(items: DataFrame, percent: Decimal | int | str) -> DataFrame:
    """M2: every amount raised by ``percent`` and rounded to 2 places.
    Returns the change frame: item columns with ``sales`` = new amount and
    ``old_sales`` = previous amount."""
    return items.withColumn("old_sales", F.col("sales")).withColumn("sales", raise_by_percent("sales", percent))


def add_to_line(items: DataFrame, row_id, amount: Decimal | int | str) -> DataFrame:
    """M5: add ``amount`` to one line (change frame)."""
    hit = F.col("row_id") == F.lit(row_id)
    return items.withColumn("old_sales", F.col("sales")).withColumn(
        "sales", F.when(hit, add_amount("sales", amount)).otherwise(F.col("sales"))
    )


def add_to_lines(items: DataFrame, deltas: DataFrame) -> DataFrame:
    """M5 set form: ``deltas(row_id, amount)`` added to their lines."""
    d = deltas.groupBy("row_id").agg(F.sum("amount").alias("_amount")).withColumn(_HIT, F.lit(True))
    j = items.join(d, "row_id", "left")
    new = F.when(F.col(_HIT), to_money(F.col("sales") + F.col("_amount"))).otherwise(F.col("sales"))
    keep = [c for c in items.columns if c != "sales"]
    return j.select(*keep, new.alias("sales"), F.col("sales").alias("old_sales"))


def new_version(changes: DataFrame) -> DataFrame:
    """Table contents after a change (drop the old amount)."""
    return changes.drop("old_sales")


def touched_line(items: DataFrame, row_id, amount: Decimal | int | str) -> DataFrame:
    """M5: the one line with its old and new amount (the filter reaches the scan)."""
    return add_to_line(items.where(F.col("row_id") == F.lit(row_id)), row_id, amount)


def touched_lines(items: DataFrame, deltas: DataFrame) -> DataFrame:
    """M5 set form: only the lines of ``deltas(row_id, amount)``, each once."""
    d = deltas.groupBy("row_id").agg(F.sum("amount").alias("_amount"))
    new = to_money(F.col("sales") + F.col("_amount"))
    keep = [c for c in items.columns if c != "sales"]
    return items.join(d, "row_id").select(*keep, new.alias("sales"), F.col("sales").alias("old_sales"))


def touched_orders(orders: DataFrame, updates: DataFrame) -> DataFrame:
    """M1 set form: the orders of ``updates(order_id, new_mode)`` with their new
    mode, passed through T2."""
    u = _one_per_key(updates, "order_id", ["new_mode"]).drop(_HIT)
    mode = within_limit(F.col("new_mode"), "orders", "ship_mode")
    return orders.join(u, "order_id").select("order_id", mode.alias("ship_mode"), repaired_ship_date().alias("ship_date"))


def redated_order(orders: DataFrame, order_id, new_date: Column) -> DataFrame:
    """M6: the one order with its new ship date, passed through T2."""
    return set_ship_date(orders.where(F.col("order_id") == F.lit(order_id)), order_id, new_date)


# ---- customers -----------------------------------------------------------------------


def rename_segment(customers: DataFrame, old: str, new: str) -> DataFrame:
    """M3: every customer of segment ``old`` moves to ``new``; NULL stays."""
    return customers.withColumn(
        "segment",
        F.when(F.col("segment") == F.lit(old), within_limit(F.lit(new), "customers", "segment")).otherwise(F.col("segment")),
    )


def erase_customers(model: RetailModel, ids: DataFrame) -> RetailModel:
    """M4 for a DataFrame of ``customer_id`` values, in one job: their lines,
    orders, profiles and customer rows go.  Lines with a NULL order id stay
    (a NULL never matches), audit / tags / partitioned copies are untouched.

    Anti-joins only -- never NOT IN, which a NULL on the right would empty."""
    ids = ids.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
    doomed_orders = model.orders.join(ids, "customer_id", "left_semi").select("order_id")
    return model.replace(
        order_items=model.order_items.join(doomed_orders, "order_id", "left_anti"),
        orders=model.orders.join(ids, "customer_id", "left_anti"),
        customer_profiles=model.customer_profiles.join(ids, "customer_id", "left_anti"),
        customers=model.customers.join(ids, "customer_id", "left_anti"),
    )


# ---- update + audit as one commit (M2/M5 + T1 + M7 + M8 + N5) --------------------------


ORDER_KEY, ORDER_CHANGES = "order_id", ["ship_mode", "ship_date"]


def commit_order_change(store, touched: DataFrame) -> int:
    """M1, M6: publish the new ship modes and dates of ``touched`` as one batch
    beside the orders."""
    return layers.change(store, "orders", touched, ORDER_KEY, ORDER_CHANGES)


def _audit_ref(store, changes: DataFrame, audit_log: str, stream: str | None, epoch: int | None) -> str:
    """The audit log with the real changes of ``changes`` (stored rows), numbered
    from the log's mark on."""
    last, epochs = layers.log_state(store, audit_log)
    counted = Observation()
    numbered = number_audit_rows(audit_rows(changes), last).observe(counted, F.count(F.lit(1)).alias("n"))
    path = store.stage_apart(f"{audit_log}_rows", numbered)
    told = {"last": last + counted.get["n"], "epochs": epochs | ({stream: epoch} if stream is not None else {})}
    keep = counted.get["n"] or audit_log not in store.current()
    return layers.with_rows(store, audit_log, path if keep else None, **told)


def commit_line_change(store, changes: DataFrame, items: str = "order_items", audit_log: str = "sales_audit") -> int:
    """A change of (nearly) all lines: write the new line version and its audit
    rows, publish both together.

    The change frame is evaluated once: the new version holds the old amounts too
    (hidden from readers), and the audit rows are read from it, numbered after the
    log's highest id and appended to the log.  Both become visible in one manifest
    commit, like an UPDATE whose trigger writes the log inside the same
    transaction.  If another handle published one of them since this handle's
    snapshot, ``Conflict`` is raised and nothing changes: refresh, and compute
    ``changes`` from the new version."""
    seen = store.current()
    base = store.stage(items, changes)
    log = _audit_ref(store, store.read_ref(base), audit_log, None, None)
    lines = layers.ref_of(layers.parts_of(base) | {"hidden": ["old_sales"]})
    return store.publish({items: lines, audit_log: log}, expected=seen)


def commit_line_update(
    store, touched: DataFrame, items: str = "order_items", audit_log: str = "sales_audit",
    stream: str | None = None, epoch: int | None = None,
) -> int:
    """A change of some lines (``touched``: row_id once each, sales, old_sales):
    one small batch of new amounts beside the lines, whose base is not rewritten,
    and its audit rows, published together; ``Conflict`` as above."""
    seen = store.current()
    path = store.stage_apart(f"{items}_changes", touched)
    log = _audit_ref(store, store.spark.read.parquet(path), audit_log, stream, epoch)
    lines = layers.with_change(store, items, path, "row_id", ["sales"])
    return store.publish({items: lines, audit_log: log}, expected=seen)


def commit_audit(store, changes: DataFrame, stream: str, epoch: int, audit_log: str = "sales_audit") -> int:
    """Only the audit rows of ``changes``, for a stream's micro-batch."""
    seen = store.current()
    path = store.stage_apart("_changes", changes)
    return store.publish({audit_log: _audit_ref(store, store.spark.read.parquet(path), audit_log, stream, epoch)}, expected=seen)


# ---- stored results (M9) -----------------------------------------------------------------


def refresh_by_change(store, name: str, changes: DataFrame, keys: list[str]) -> str:
    """M9 by signed amounts: a stored result with ``total_sales`` per ``keys`` plus
    what ``changes`` (keys, sales, old_sales) adds: new amounts less old ones.  Only
    the changed rows and the result are read.  A change moves amounts and no rows,
    so the groups stay; a missing amount counts as 0.  The full recompute
    (``TableStore.refresh_view``) gives the same rows."""
    moved = F.coalesce("sales", F.lit(0)) - F.coalesce("old_sales", F.lit(0))
    told = changes.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.sum(moved).alias("_moved"))
    held = store.read(name)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    total = (F.col("total_sales") + F.coalesce("_moved", F.lit(0))).cast(held.schema["total_sales"].dataType)
    now = held.join(told, same, "left")
    return store.write(name, now.select(*(total.alias(c) if c == "total_sales" else F.col(c) for c in held.columns)))
