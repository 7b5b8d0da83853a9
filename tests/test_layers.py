"""Tables in layers: changes by key, inserts with keys, logs, ranges, refreshes."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martwell.functions.exprs import json_text, json_value
from martwell.operators import maintenance, quality, reports
from martwell.plans.warehouse import open_store, store_model
from martwell.session import new_scratch_dir
from martwell.sources import layers, storage
from martwell.sources.storage import TableStore
from martwell.streaming import triggers

SF = "/root/testdata/sf0.001"


@pytest.fixture
def branch(spark):
    return open_store(spark, SF).clone(new_scratch_dir(spark, "t-branch"))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_row_update_leaves_the_base(spark, branch):
    before = branch.current()["order_items"]
    old = branch.read("order_items").where("row_id = 1001").first()
    maintenance.commit_line_update(branch, maintenance.touched_line(branch.read("order_items"), 1001, Decimal("50")))
    parts = layers.parts_of(branch.current()["order_items"])
    assert parts["base"] == before and len(parts["changes"]) == 1
    assert spark.read.parquet(parts["changes"][0]).count() == 1
    items = branch.read("order_items")
    assert items.columns == open_store(spark, SF).read("order_items").columns
    assert items.where("row_id = 1001").first().sales == old.sales + 50
    assert items.count() == open_store(spark, SF).read("order_items").count()
    assert items.where("row_id = 1002").first() == open_store(spark, SF).read("order_items").where("row_id = 1002").first()
    log = branch.read("sales_audit").collect()
    assert [(r.audit_id, r.row_id, r.old_sales, r.new_sales) for r in log] == [(1, 1001, old.sales, old.sales + 50)]
    # the batch is broadcast, the base keeps its buckets: no shuffle in the fact join
    m = store_model(branch)
    plan = _plan(m.order_items.join(m.orders.select("order_id", "ship_mode"), "order_id"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_newest_change_counts_and_batches_stay_few(spark, branch, monkeypatch):
    monkeypatch.setattr(layers, "MERGE", 3)
    start = {r.row_id: r.sales for r in branch.read("order_items").where("row_id in (1001, 1002, 2001)").collect()}
    for i in range(8):
        row = 1001 if i % 2 else 1002
        maintenance.commit_line_update(branch, maintenance.touched_line(branch.read("order_items"), row, Decimal("1.25")))
        assert len(layers.parts_of(branch.current()["order_items"])["changes"]) <= 3
    now = {r.row_id: r.sales for r in branch.read("order_items").where("row_id in (1001, 1002, 2001)").collect()}
    assert now == {r: s + (5 if r < 2000 else 0) for r, s in start.items()}
    parts = layers.parts_of(branch.current()["sales_audit"])
    assert parts["last"] == 8 and len(parts["inserts"]) <= 4
    log = branch.read("sales_audit").orderBy("audit_id").collect()
    assert [r.audit_id for r in log] == list(range(1, 9)) and [r.row_id for r in log] == [1002, 1001] * 4
    # folded: one base again, laid out as before, same rows
    rows = branch.read("order_items")
    want = storage.content_hash(rows).first()
    layers.fold(branch, "order_items")
    assert branch.current()["order_items"].startswith(storage.BUCKETED_REF)
    assert storage.content_hash(branch.read("order_items")).first() == want


def test_an_update_of_no_row_and_null_amounts(spark):
    store = TableStore(spark, new_scratch_dir(spark, "t-null"))
    rows = [(1, None), (2, Decimal("5.00")), (None, Decimal("7.00"))]
    store.write("order_items", spark.createDataFrame(rows, "row_id long, sales decimal(12,2)"))
    maintenance.commit_line_update(store, maintenance.touched_line(store.read("order_items"), 99, 1))
    assert store.read("sales_audit").count() == 0 and store.read("order_items").count() == 3
    gone = store.read("order_items").where("row_id = 2").select(
        "row_id", F.lit(None).cast("decimal(12,2)").alias("sales"), F.col("sales").alias("old_sales")
    )
    maintenance.commit_line_update(store, gone)
    assert {(r.row_id, r.sales) for r in store.read("order_items").collect()} == {(1, None), (2, None), (None, Decimal("7.00"))}
    assert [(r.audit_id, r.new_sales) for r in store.read("sales_audit").collect()] == [(1, None)]


def test_order_changes_pass_the_trigger(spark, branch):
    orders = branch.read("orders")
    one = orders.where(F.col("ship_date").isNotNull()).orderBy("order_id").first()
    asked = spark.createDataFrame([(one.order_id, "1-URGENT"), (-5, "5-LOW")], "order_id long, new_mode string")
    maintenance.commit_order_change(branch, maintenance.touched_orders(orders, asked))
    maintenance.commit_order_change(branch, maintenance.redated_order(branch.read("orders"), one.order_id, F.lit(date(1990, 1, 1))))
    now = branch.read("orders").where(F.col("order_id") == one.order_id).first()
    assert (now.ship_mode, now.ship_date) == ("1-URGENT", one.order_date)
    assert branch.read("orders").count() == orders.count()


def test_changes_from_an_older_snapshot_are_refused(spark, branch):
    other = TableStore(spark, branch.root)
    other.current()
    maintenance.commit_line_update(branch, maintenance.touched_line(branch.read("order_items"), 1001, 1))
    with pytest.raises(storage.Conflict):
        maintenance.commit_line_update(other, maintenance.touched_line(other.read("order_items"), 1001, 1))


def test_insert_is_checked_by_keys(spark, branch):
    rules = {"customer_id": ("customers", "customer_id"), "region": ("regions", "region_name")}
    orders = branch.read("orders")
    new = orders.where("order_id < 5").withColumn("order_id", F.col("order_id") + 10_000_000)
    n = orders.count()
    bad = {
        "key exists": orders.limit(1),
        "key repeats": new.limit(1).unionByName(new.limit(1)),
        "key is null": new.limit(1).withColumn("order_id", F.lit(None).cast("long")),
        "customer_id has no parent": new.limit(1).withColumn("customer_id", F.lit(-7).cast("long")),
    }
    for rule, rows in bad.items():
        with pytest.raises(quality.ConstraintViolation, match="refused"):
            layers.insert(branch, "orders", rows, "order_id", rules)
        parents = {c: (branch.read(t), k) for c, (t, k) in rules.items()}
        assert {r.rule for r in quality.insert_violations(rows, orders, "order_id", parents, "orders").collect()} == {rule}
    assert branch.read("orders").count() == n
    layers.insert(branch, "orders", new.withColumn("region", F.lit(None).cast("string")), "order_id", rules)
    assert branch.read("orders").count() == n + new.count()
    # the existing rows are one narrow column, and only filtered
    plan = _plan(quality.insert_violations(new, orders.select("order_id"), "order_id", {}, "orders"))
    assert "customer_name" not in plan and "left_semi" not in plan and "LeftSemi" in plan


def test_ranges_are_kept_with_the_table(spark):
    root = new_scratch_dir(spark, "t-ranges")
    bounds = [("2015", date(2015, 1, 1), date(2016, 1, 1)), ("2016", date(2016, 1, 1), date(2017, 1, 1))]
    layers.declare_ranges(TableStore(spark, root), "byyear", "order_date", bounds)

    def rows(*days):
        return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "order_id long, order_date date")

    layers.insert_ranged(TableStore(spark, root), "byyear", rows(date(2015, 1, 1), date(2015, 12, 31)))
    second = TableStore(spark, root)  # knows nothing but the store
    layers.insert_ranged(second, "byyear", rows(date(2016, 1, 1), date(2016, 12, 31)))
    for outside in (date(2017, 1, 1), date(2014, 12, 31), None):
        with pytest.raises(quality.ConstraintViolation):
            layers.insert_ranged(second, "byyear", rows(date(2015, 5, 5), outside))
    third = TableStore(spark, root)
    assert third.read("byyear").count() == 4
    found = layers.read_range(third, "byyear", date(2015, 12, 1), date(2016, 1, 2))
    assert sorted(r.order_date for r in found.collect()) == [date(2015, 12, 31), date(2016, 1, 1)]
    only = layers.read_range(third, "byyear", date(2016, 2, 1), date(2017, 5, 1))
    assert [r.order_date for r in only.collect()] == [date(2016, 12, 31)]
    scans = [line for line in _plan(only).splitlines() if "PartitionFilters" in line]
    assert scans and all("2016" in s and "2015" not in s.split("PartitionFilters")[1] for s in scans)


def test_written_lines_find_their_old_amounts(spark, branch):
    lines = {r.row_id: r.sales for r in branch.read("order_items").where("row_id in (1001, 1002, 1003)").collect()}
    rows = [(1001, lines[1001] + 5), (1002, lines[1002]), (1001, lines[1001] + 1), (-4, Decimal("3.00"))]
    written = spark.createDataFrame(rows, triggers.LINE_SCHEMA)
    assert triggers.commit_line_batch(branch, written, 0, "s")
    assert not triggers.commit_line_batch(branch, written, 0, "s")  # replayed
    assert triggers.commit_line_batch(branch, spark.createDataFrame([(1003, None)], triggers.LINE_SCHEMA), 1, "s")
    log = [(r.audit_id, r.row_id, r.old_sales, r.new_sales) for r in branch.read("sales_audit").orderBy("audit_id").collect()]
    assert log == [(1, 1001, lines[1001], lines[1001] + 5), (2, 1003, lines[1003], None)]
    now = {r.row_id: r.sales for r in branch.read("order_items").where("row_id in (1001, 1002, 1003)").collect()}
    assert now == {1001: lines[1001] + 5, 1002: lines[1002], 1003: None}


def test_refresh_by_change_equals_the_recompute(spark, branch):
    name = "mv_category_sales"
    branch.refresh_view(name, reports.category_revenue(store_model(branch)))
    items = branch.read("order_items")
    asked = items.where("row_id % 7 = 0").select("row_id", F.lit(Decimal("3.10")).alias("amount"))
    maintenance.commit_line_update(branch, maintenance.touched_lines(items, asked))
    products = branch.read("products").select("product_id", "category")
    changes = layers.last_change(branch, "order_items").join(products, "product_id")
    assert "lineitem" not in _plan(changes) and changes.count() == asked.count()
    maintenance.refresh_by_change(branch, name, changes, ["category"])
    want = {r.category: r.total_sales for r in reports.category_revenue(store_model(branch)).collect()}
    assert {r.category: r.total_sales for r in branch.read(name).collect()} == want


def test_json_keys_of_any_spelling(spark):
    texts = ['{"a.b": 1, "a": {"b": 2}, "x y": "z", "it\'s": [1, null], "": true, "n": null}', "no json", None]
    df = spark.createDataFrame([(t,) for t in texts], "profile string")
    want = {"a.b": ("1", "1"), "a": ('{"b":2}', '{"b":2}'), "x y": ("z", '"z"'), "it's": ("[1,null]", "[1,null]"),
            "": ("true", "true"), "n": (None, "null"), "b": (None, None)}
    for key, (text, value) in want.items():
        got = df.select(json_text("profile", key).alias("t"), json_value("profile", key).alias("v")).collect()
        assert (got[0].t, got[0].v) == (text, value), key
        assert [tuple(r) for r in got[1:]] == [(None, None)] * 2


def test_insert_after_a_change_of_all_lines(spark, branch):
    """The old amounts that a raise keeps in the base are hidden; inserted rows have none."""
    items = branch.read("order_items")
    maintenance.commit_line_change(branch, maintenance.increase_sales(items, Decimal("5")))
    raised = branch.read("order_items")
    first = raised.orderBy("row_id").first()
    more = spark.createDataFrame([(-7, first.order_id, first.product_id, Decimal("2.00"))], raised.schema)
    n = raised.count()
    layers.insert(branch, "order_items", more, "row_id", {"order_id": ("orders", "order_id")})
    now = branch.read("order_items")
    assert now.columns == items.columns and now.count() == n + 1
    assert now.where("row_id = -7").first().sales == Decimal("2.00")
