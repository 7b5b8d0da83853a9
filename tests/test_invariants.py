"""Cross-report invariants on clean data."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from martwell.operators import audit, maintenance, quality, ranking, reports
from martwell.sources import storage
from martwell.session import new_scratch_dir
from martwell.streaming import triggers
from tests.conftest import rows


def _total(df, col):
    return round(df.agg(F.sum(col)).first()[0], 2)


def test_revenue_totals_agree(model_small):
    m = model_small
    kpi = reports.kpi_summary(m).first()
    a1 = _total(reports.revenue_by_region_category(m), "total_sales")
    a2 = _total(reports.revenue_by_month(m), "monthly_sales")
    a6 = _total(reports.category_revenue(m), "total_sales")
    w3 = ranking.running_revenue(m).orderBy(F.col("month").desc()).first().cumulative_sales
    assert a1 == a2 == a6 == kpi.total_revenue == w3  # exact decimals
    assert abs(kpi.avg_order_value - float(kpi.total_revenue) / kpi.total_orders) < 1e-9


def test_scalable_rank_equals_plain(model_small):
    a = rows(ranking.customer_rank_single_partition(model_small), "customer_name", "sales_rank")
    b = rows(ranking.customer_rank(model_small, ranges=7), "customer_name", "sales_rank")
    assert a == b


def test_audit_count_equals_changed_rows(model_small):
    ch = maintenance.increase_sales(model_small.order_items, Decimal("5"))
    changed = ch.where(F.col("sales") != F.col("old_sales")).count()
    assert audit.audit_rows(ch).count() == changed


def test_erasure_leaves_no_trace(spark, model_small):
    ids = model_small.customers.select("customer_id").orderBy("customer_id").limit(3)
    e = maintenance.erase_customers(model_small, ids)
    gone = [r[0] for r in ids.collect()]
    assert e.orders.where(F.col("customer_id").isin(gone)).count() == 0
    assert e.customers.where(F.col("customer_id").isin(gone)).count() == 0
    assert quality.model_fk_violations(e).count() == 0


def test_snapshot_restore_equal(spark, model_small):
    root = new_scratch_dir(spark, "test-snap")
    storage.snapshot(spark, model_small.tables(), root)
    target = storage.TableStore(spark, new_scratch_dir(spark, "test-restore"))
    res = storage.restore(spark, root, target)
    assert all(r.restored_equal for r in res.collect())
    assert sorted(target.list_tables()) == sorted(model_small.tables())


def test_stream_equals_batch(spark, model_small):
    ch = maintenance.increase_sales(model_small.order_items, Decimal("5"))
    src = new_scratch_dir(spark, "test-changes")
    triggers.changes_frame(ch).repartition(3).write.parquet(src)
    sink, ckpt = new_scratch_dir(spark, "test-sink"), new_scratch_dir(spark, "test-ckpt")
    triggers.run_file_stream(spark, src, triggers.CHANGE_SCHEMA, triggers.audit_stream, sink, ckpt, 1)
    got = rows(spark.read.parquet(sink))
    assert got == rows(audit.audit_rows(ch))
    # a restart on the same checkpoint processes nothing twice
    triggers.run_file_stream(spark, src, triggers.CHANGE_SCHEMA, triggers.audit_stream, sink, ckpt, 1)
    assert spark.read.parquet(sink).count() == len(got)


def test_ship_repair_stream_equals_batch(spark, model_small):
    src = new_scratch_dir(spark, "test-orders-in")
    model_small.orders.repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    sink, ckpt = new_scratch_dir(spark, "test-orders-sink"), new_scratch_dir(spark, "test-ckpt")
    triggers.run_file_stream(spark, src, schema, triggers.ship_repair_stream, sink, ckpt, 1)
    got = rows(spark.read.parquet(sink), "order_id", "ship_date")
    assert got == rows(audit.repair_ship_dates(model_small.orders), "order_id", "ship_date")


def test_audit_log_stream_exactly_once(spark, model_small):
    from martwell.sources.storage import TableStore

    ch = maintenance.increase_sales(model_small.order_items, Decimal("5"))
    src = new_scratch_dir(spark, "test-changes")
    triggers.changes_frame(ch).repartition(4).write.parquet(src)
    store = TableStore(spark, new_scratch_dir(spark, "test-log"))
    ckpt = new_scratch_dir(spark, "test-ckpt")
    triggers.run_audit_log_stream(spark, src, store, ckpt, max_files_per_trigger=2)
    log = store.read("sales_audit")
    n = audit.audit_rows(ch).count()
    assert log.count() == n
    assert log.select("audit_id").distinct().count() == n
    assert log.agg(F.min("audit_id"), F.max("audit_id")).first() == (1, n)
    assert rows(log, "row_id", "old_sales", "new_sales") == rows(audit.audit_rows(ch))
    # a replayed micro-batch is skipped; a restart on the same checkpoint adds nothing
    assert not triggers.commit_audit_batch(store, triggers.changes_frame(ch), 0, f"audit-{triggers.query_id(spark, ckpt)}")
    triggers.run_audit_log_stream(spark, src, store, ckpt, max_files_per_trigger=2)
    assert TableStore(spark, store.root).read("sales_audit").count() == n
