"""Plan shape checks: the plans we want at scale."""

from __future__ import annotations

import pytest

from martwell.functions import routines
from martwell.operators import ranking, reports
from martwell.sources import layers, storage
from martwell.session import new_scratch_dir
from martwell.sources.testdata import bind_model
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)


def test_bucketed_fact_join_has_no_exchange(spark, model_small, no_broadcast):
    j = model_small.order_items.join(model_small.orders, "order_id")
    p = plan(j)
    assert "SortMergeJoin" in p
    assert "Exchange" not in p


def test_top_k_is_take_ordered(model_small):
    p = plan(ranking.top_customers_ranked(model_small, 10))
    assert "TakeOrderedAndProject" in p


def test_scalable_rank_moves_no_rows_to_one_partition(model_small, no_broadcast):
    p = plan(ranking.customer_rank(model_small))
    single = [line for line in p.splitlines() if "SinglePartition" in line]
    # only the offsets (one row per written file) are ordered in one partition
    assert len(single) == 1
    plain = plan(ranking.customer_rank_single_partition(model_small))
    assert "SinglePartition" in plain


def test_month_filter_reaches_scan(model_small):
    p = plan(routines.top_products_of_month(model_small, "1997-05"))
    scan = [line for line in p.splitlines() if "FileScan" in line and "order_date" in line][0]
    assert "GreaterThanOrEqual(order_date" in scan or "order_date >= " in scan


def test_top_n_per_month_limits_before_shuffle(model_small):
    assert "WindowGroupLimit" in plan(routines.top_products_all_months(model_small))


def test_partition_filter_on_year_read(spark, model_small):
    bounds = storage.year_ranges(model_small.orders)
    path, _ = storage.write_year_partitioned(model_small.orders, new_scratch_dir(spark, "t-years"), bounds)
    p = plan(storage.read_years(spark, path, ["1997"]))
    scan = [line for line in p.splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [isnotnull(order_year" in scan and "= 1997" in scan


def test_projection_pruned_at_scan(model_small):
    p = plan(reports.revenue_by_month(model_small))
    for line in p.splitlines():
        if "FileScan" in line:
            assert "ReadSchema" in line
            schema = line.split("ReadSchema: ")[1]
            assert "product_id" not in schema and "ship_mode" not in schema


def test_unused_ship_date_join_is_removed(spark):
    m = bind_model(spark, SF_SMALL)
    p = plan(reports.revenue_by_region_category(m))
    assert p.count("l_shipdate") == 0


def test_no_python_in_plans(model_small):
    for df in (reports.customer_value(model_small), ranking.largest_line_per_customer(model_small)):
        p = plan(df)
        assert "Python" not in p and "ArrowEval" not in p


def test_hot_order_is_kept_apart(spark):
    from datetime import date
    from decimal import Decimal

    from martwell.plans.warehouse import build_warehouse, plan_layout
    from tests.test_edges import make_model

    # one order holds half of all lines
    items = [(i, "hot" if i % 2 else f"o{i}", "p", Decimal("1")) for i in range(400)]
    orders = [("hot", date(2020, 1, 1))] + [(f"o{i}", date(2020, 1, 1)) for i in range(0, 400, 2)]
    m = make_model(spark, orders=orders, items=items)
    buckets, bucket_lines, top = plan_layout(m.order_items, buckets=16)
    assert (bucket_lines, top) == (False, 200)
    store = build_warehouse(spark, m, new_scratch_dir(spark, "t-hot"), buckets=16)
    refs = store.current()
    parts = layers.parts_of(refs["order_items"])
    assert refs["orders"].startswith("bucketed:16:") and parts["base"].startswith("bucketed:16:")
    assert [tuple(r) for r in spark.read.parquet(parts["hot"]).collect()] == [("hot",)]
    assert spark.read.parquet(parts["apart"]).count() == 200 and store.read("order_items").count() == 400
    calm = make_model(spark, orders=orders, items=[(i, f"o{i - i % 2}", "p", Decimal("1")) for i in range(400)])
    assert plan_layout(calm.order_items, buckets=16)[1] is True


def test_hot_order_join_is_split_by_aqe(spark):
    """A join of the facts as they are is a shuffle join if an order is hot; AQE
    splits the hot partition into several tasks."""
    from datetime import date
    from decimal import Decimal

    from pyspark.sql import functions as F

    from martwell.plans.warehouse import build_warehouse, store_model
    from tests.test_edges import make_model

    items = [(i, "hot" if i % 3 else f"o{i}", "p", Decimal("1")) for i in range(30000)]
    orders = [("hot", date(2020, 1, 1))] + [(f"o{i}", date(2020, 1, 1)) for i in range(0, 30000, 3)]
    m = make_model(spark, orders=orders, items=items)
    w = store_model(build_warehouse(spark, m, new_scratch_dir(spark, "t-hot2"), buckets=16))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # reports regroup by another key after the fact join (month, region ...)
        # and carry a per-line value, as a revenue sum does
        j = w.order_items.join(w.orders, "order_id").groupBy("order_date").agg(
            F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("s")
        )
        assert [(r.n, r.s) for r in j.collect()] == [(30000, sum(range(30000)))]
        final = j._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_cluster_settings_scale_with_input():
    from martwell.session import cluster_settings

    tb = 1024**4
    big = cluster_settings(8000, 100 * tb)
    small = cluster_settings(64, 10 * 1024**3)
    assert big["spark.sql.files.maxPartitionBytes"] == "512m"
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * tb // (256 * 1024 * 1024)
    assert int(small["spark.sql.shuffle.partitions"]) == 192  # 3 per core floor
    assert small["spark.sql.autoBroadcastJoinThreshold"] == "64m"


def test_bucketed_fact_join_needs_no_sort(spark, model_small, no_broadcast):
    """One file per bucket, sorted: with the session's bucketed-scan ordering
    the join reads both facts in order -- no exchange and no sort."""
    p = plan(model_small.order_items.join(model_small.orders, "order_id"))
    assert "SortMergeJoin" in p and "Exchange" not in p and "Sort [" not in p


def test_date_range_read_prunes_year_folders(spark, model_small):
    import contextlib
    import io
    from datetime import date

    from pyspark.sql import functions as F

    from martwell.sources.storage import read_date_range

    def partition_filters(df) -> str:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        return "\n".join(ln for ln in buf.getvalue().splitlines() if ln.startswith("PartitionFilters"))

    bounds = storage.year_ranges(model_small.orders)
    path, _ = storage.write_year_partitioned(model_small.orders, new_scratch_dir(spark, "t-years"), bounds)
    lo, hi = date(1996, 11, 15), date(1997, 2, 1)
    df = read_date_range(spark, path, lo, hi, bounds)
    pf = partition_filters(df)
    assert "order_year" in pf and "1996" in pf and "1997" in pf and "1995" not in pf
    want = model_small.orders.where((F.col("order_date") >= lo) & (F.col("order_date") < hi)).count()
    assert df.count() == want > 0
    # a range ending on 1 January does not read the next year's folder
    assert "1998" not in partition_filters(read_date_range(spark, path, lo, date(1998, 1, 1), bounds))
