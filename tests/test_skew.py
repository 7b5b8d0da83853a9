"""Hot keys: one customer owns a third of all orders and lines, one product a
third of all lines.  Results must equal a brute-force computation, and the
plans must combine rows per key before they are shuffled."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pandas as pd
import pytest

from pyspark.sql import functions as F

from martwell.functions import routines
from martwell.operators import maintenance, ranking, reports
from martwell.plans.warehouse import build_warehouse, store_model
from martwell.session import new_scratch_dir
from martwell.sources import layers, storage
from tests.test_edges import make_model


@pytest.fixture(scope="module")
def hot(spark):
    orders, items = [], []
    row = 0
    for o in range(3000):
        cust = "HOT" if o % 3 == 0 else f"C{o % 500}"
        region = ["West", "East", "South"][o % 3 if o % 3 else (o // 3) % 3]
        od = date(2020, 1, 1) + timedelta(days=o % 200)
        orders.append((f"o{o}", od, od + timedelta(days=o % 9), cust, region))
        for k in range(1 + o % 5):
            row += 1
            prod = "P_HOT" if row % 3 == 0 else f"p{row % 97}"
            items.append((row, f"o{o}", prod, Decimal(f"{(row * 37) % 1000}.{row % 100:02d}")))
    customers = [("HOT", "Hot Buyer", "Consumer")] + [(f"C{i}", f"Name {i}", "Corporate") for i in range(500)]
    products = [("P_HOT", "Hot Thing", "Gadgets", "X")] + [(f"p{i}", f"thing {i}", f"cat{i % 7}", "Y") for i in range(97)]
    m = make_model(spark, orders=orders, items=items, customers=customers, products=products)
    pdf_items = pd.DataFrame(items, columns=["row_id", "order_id", "product_id", "sales"])
    pdf_orders = pd.DataFrame([(o[0], o[1], o[3], o[4]) for o in orders], columns=["order_id", "order_date", "customer_id", "region"])
    pdf_products = pd.DataFrame(products, columns=["product_id", "product_name", "category", "sub_category"])
    j = pdf_items.merge(pdf_orders, on="order_id").merge(pdf_products, on="product_id")
    j["sales"] = j["sales"].map(Decimal)
    return m, j


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_revenue_by_region_category_hot(hot):
    m, j = hot
    want = {(r, c): sum(g["sales"]) for (r, c), g in j.groupby(["region", "category"])}
    got = {(r.region, r.category): r.total_sales for r in reports.revenue_by_region_category(m).collect()}
    assert got == want


def test_customer_value_hot(hot):
    m, j = hot
    got = {r.customer_id: (r.total_orders, r.total_spent) for r in reports.customer_value(m).collect()}
    hot_rows = j[j.customer_id == "HOT"]
    assert got["HOT"][0] == hot_rows.order_id.nunique() == 1000
    assert got["HOT"][1] == sum(hot_rows["sales"])


def test_largest_line_hot(hot):
    m, j = hot
    got = {r.customer_id: (r.order_id, r.sales) for r in ranking.largest_line_per_customer(m).collect()}
    h = j[j.customer_id == "HOT"].copy()
    h["okey"] = h.order_id.str[1:].astype(int)
    best = h.sort_values(["sales", "order_id", "row_id"], ascending=[False, True, True]).iloc[0]
    assert got["HOT"] == (best.order_id, best.sales)


def test_rank_with_hot_value(hot, spark):
    m, _ = hot
    totals = ranking.customer_totals(m)
    a = sorted((r.customer_name, r.sales_rank) for r in ranking.customer_rank_single_partition(m).collect())
    b = sorted((r.customer_name, r.sales_rank) for r in ranking.customer_rank(m, ranges=8).collect())
    assert a == b and totals.count() == 501


def test_partial_aggregation_before_shuffle(hot):
    m, _ = hot
    for df in (ranking.largest_line_per_customer(m), reports.category_revenue(m), reports.customer_value(m)):
        p = plan(df)
        below_first_shuffle = p[p.find("Exchange hashpartitioning"):]
        # a partial aggregate, or a partial per-group limit (WindowGroupLimit)
        assert "partial_" in below_first_shuffle or "WindowGroupLimit" in below_first_shuffle, p


@pytest.fixture(scope="module")
def big_order(hot, spark):
    """A model with an order that holds half of all lines, and its store."""
    from datetime import date as d

    m, _ = hot
    # add one order holding as many lines as all the others together
    extra_items = spark.createDataFrame(
        [(100000 + i, "o_big", "P_HOT", Decimal("1.00")) for i in range(8000)], m.order_items.schema
    )
    extra_order = spark.createDataFrame([("o_big", d(2020, 3, 1), None, "Standard Class", "HOT", "US", "X", "S", "0", "West")], m.orders.schema)
    m = m.replace(order_items=m.order_items.unionByName(extra_items), orders=m.orders.unionByName(extra_order))
    return m, build_warehouse(spark, m, new_scratch_dir(spark, "t-hot-layout"), buckets=16)


REPORTS = [
    reports.revenue_by_region_category,
    reports.customer_value,
    reports.state_city_revenue,
    reports.kpi_summary,
    ranking.customer_totals,
    ranking.largest_line_per_customer,
    ranking.running_revenue,
    ranking.calendar_revenue,
    routines.region_revenue,
    lambda m: routines.top_products_all_months(m, 3),
    lambda m: routines.top_products_of_month(m, "2020-03", 3),
    lambda m: routines.total_sales_by_region(m, "West"),
    lambda m: reports.region_revenue_param(m.orders.sparkSession, m, "West"),
]


def rows(df) -> list:
    return sorted(map(tuple, df.collect()), key=repr)


def test_reports_on_hot_order_layout(big_order):
    """The lines of a hot order are kept apart, the others in buckets; every report
    must give the same answer on that layout as on the model itself."""
    m, store = big_order
    w = store_model(store)
    assert w.split is not None and layers.parts_of(store.current()["order_items"])["base"].startswith("bucketed:16:")
    for report in REPORTS:
        assert rows(report(m)) == rows(report(w))


def test_hot_order_keeps_the_bucketed_join(big_order, spark):
    """No line is shuffled on the order: calm lines meet their orders bucket by
    bucket, the hot order's lines meet one broadcast order row."""
    _, store = big_order
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        w = store_model(store)
        p = plan(reports.lines_with_orders(w, ["region"]))
        assert "Exchange hashpartitioning" not in p and "SortMergeJoin" in p and "BroadcastHashJoin" in p, p
        # per order: only the few rows of the hot order's partial sums move
        p = plan(reports.orders_with_sums(w, ["region"]))
        assert p.count("Exchange hashpartitioning") == 1, p
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_order_through_changes(big_order, spark):
    """A raise of all lines, a change of some, an insert, a fold, an erasure and a
    snapshot keep the layout and the rows."""
    m, origin = big_order
    store = origin.clone(new_scratch_dir(spark, "t-hot-branch"))

    def apart() -> int:
        return spark.read.parquet(layers.parts_of(store.current()["order_items"])["apart"]).count()

    maintenance.commit_line_change(store, maintenance.increase_sales(store.read("order_items"), Decimal("5")))
    raised = m.replace(order_items=maintenance.new_version(maintenance.increase_sales(m.order_items, Decimal("5"))))
    assert rows(store.read("order_items")) == rows(raised.order_items) and apart() == 8000
    assert store.read("sales_audit").count() == layers.last_change(store, "order_items").where(
        "sales IS DISTINCT FROM old_sales"
    ).count()

    asked = store.read("order_items").where("row_id % 7 = 0").select("row_id", F.lit(Decimal("3.50")).alias("amount"))
    maintenance.commit_line_update(store, maintenance.touched_lines(store.read("order_items"), asked))
    added = F.when(F.col("row_id") % 7 == 0, F.col("sales") + F.lit(Decimal("3.50"))).otherwise(F.col("sales"))
    want = raised.order_items.withColumn("sales", added.cast("decimal(12,2)"))
    w, now = store_model(store), raised.replace(order_items=want)
    assert w.split is not None and rows(w.order_items) == rows(want)
    assert rows(reports.kpi_summary(w)) == rows(reports.kpi_summary(now))

    more = spark.createDataFrame([(900000 + i, "o_big", "p1", Decimal("2.00")) for i in range(10)], want.schema)
    layers.insert(store, "order_items", more, "row_id", {"order_id": ("orders", "order_id")})
    w, now = store_model(store), now.replace(order_items=want.unionByName(more))
    assert w.split is None  # the new lines may be of any order
    assert rows(reports.customer_value(w)) == rows(reports.customer_value(now))
    layers.fold(store, "order_items")
    w = store_model(store)
    assert w.split is not None and apart() == 8010
    assert rows(reports.customer_value(w)) == rows(reports.customer_value(now))

    backups = new_scratch_dir(spark, "t-hot-backup")
    storage.snapshot_store(store, backups)
    target = storage.TableStore(spark, new_scratch_dir(spark, "t-hot-restored"))
    assert all(r.restored_equal for r in storage.restore(spark, backups, target).collect())
    back = layers.parts_of(target.current()["order_items"])
    assert back["base"].startswith("bucketed:16:") and spark.read.parquet(back["apart"]).count() == 8010
    assert rows(reports.kpi_summary(store_model(target))) == rows(reports.kpi_summary(now))


def test_hot_missing_order_id(hot, spark):
    """Lines without an order are one group like any other; they join nothing."""
    m, _ = hot
    lost = spark.createDataFrame([(200000 + i, None, "p1", Decimal("1.00")) for i in range(8000)], m.order_items.schema)
    m = m.replace(order_items=m.order_items.unionByName(lost))
    store = build_warehouse(spark, m, new_scratch_dir(spark, "t-hot-null"), buckets=16)
    w = store_model(store)
    assert spark.read.parquet(layers.parts_of(store.current()["order_items"])["apart"]).count() == 8000
    for report in (reports.kpi_summary, reports.category_revenue, ranking.customer_totals):
        assert rows(report(m)) == rows(report(w))


def test_hot_keys_are_few(spark):
    """Fewer than a quarter of the buckets, whatever the data; none of an empty table."""
    df = spark.range(6000).select((F.col("id") % 60).cast("string").alias("k"))
    assert storage.hot_keys(df, "k", 240).count() == 0  # 100 rows each, 4 x 25 allowed
    assert storage.hot_keys(df, "k", 241).count() == 60 < 241 / 4
    assert storage.hot_keys(df.where("k IS NULL"), "k", 16).count() == 0
