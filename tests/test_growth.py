"""What keeps shuffles, spills and the memory of a task in step with the input:
narrow rows are shuffled before they are widened, tasks get a bounded number of rows."""

from __future__ import annotations

from martwell.operators import quality, reports
from martwell.plans import warehouse
from martwell.session import BROADCAST_ROWS
from martwell.sources import ingest
from martwell.sources.model import STAGING_SCHEMA, RetailModel
from martwell.sources.testdata import staging_frame
from tests.conftest import rows


def _tiny_model(spark) -> RetailModel:
    orders = (
        "order_id long, order_date date, ship_date date, ship_mode string, customer_id long, "
        "country string, city string, state string, postal_code string, region string"
    )
    return RetailModel(
        regions=spark.createDataFrame([("ASIA",)], "region_name string"),
        customers=spark.createDataFrame([(1, "Ann", "A"), (2, "Bo", "B")], "customer_id long, customer_name string, segment string"),
        products=spark.createDataFrame(
            [(7, "nut", "C", "D"), (7, "bolt", "C", "E")], "product_id long, product_name string, category string, sub_category string"
        ),
        orders=spark.createDataFrame(
            [(10, None, None, "m", 1, "x", "x1", "x", "00001", "ASIA"), (11, None, None, "m", None, "x", "x1", "x", "00001", "ASIA")], orders
        ),
        order_items=spark.createDataFrame(
            [(1, 10, 7, 1.0), (2, 11, 8, 2.0), (3, 12, 7, 3.0), (4, None, None, 4.0)],
            "row_id long, order_id long, product_id long, sales double",
        ),
        product_tags=spark.createDataFrame([], "product_id long, tags array<string>"),
        customer_profiles=spark.createDataFrame([], "customer_id long, profile string"),
    )


def test_staging_rows_are_widened_last(spark):
    told = staging_frame(_tiny_model(spark))
    # an order without a customer, a line without its order, without any key, and a product told twice
    assert rows(told.na.fill("-"), "row_id", "order_id", "customer_name", "product_name") == [
        (1, "10", "Ann", "bolt"), (1, "10", "Ann", "nut"), (2, "11", "-", "-"),
        (3, "12", "-", "bolt"), (3, "12", "-", "nut"), (4, "-", "-", "-"),
    ]
    # the last join is on the order, so no shuffle carries the order's columns by product
    joins = [line for line in told._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    assert "order_id" in joins[0] and not any("product_id" in j for j in joins[:1])


def test_orders_of_the_feed_stay_in_their_buckets(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = warehouse.build_warehouse(spark, _tiny_model(spark), str(tmp_path / "w"), buckets=4)
        told = staging_frame(warehouse.store_model(store))
        assert told.count() == 6
        # neither rows with an order's columns are shuffled by customer nor by order
        plan = told._jdf.queryExecution().executedPlan()
        text = plan.initialPlan().toString() if plan.nodeName() == "AdaptiveSparkPlan" else plan.toString()
        lines = text.splitlines()
        moved = [lines[at + 1] for at, line in enumerate(lines) if "Exchange hashpartitioning" in line]
        assert moved and not any("postal_code" in line for line in moved)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_follow_the_rows_not_the_cluster():
    of = warehouse.buckets_for
    assert of(0) == 1 and of(500_000) == 1 and of(36_000_000) == 72
    assert max(n / of(n) for n in (3_600_000, 36_000_000, 216_000_000)) <= 500_000
    assert of(10**10) == 4096 and of(10**12) == 125_000


def test_feed_is_compressed_and_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(ingest.CSV_WRITE_OPTIONS, "maxRecordsPerFile", "100")
    text = spark.range(1000).selectExpr(
        *(f"CAST({'id' if f.name in ('row_id', 'sales') else repr('some text, ')} AS {f.dataType.simpleString()}) AS {f.name}" for f in STAGING_SCHEMA)
    )
    path = ingest.write_staging_csv(text.coalesce(1), str(tmp_path / "feed"))
    files = list((tmp_path / "feed").glob("*.csv.gz"))
    assert len(files) == 10 and sum(f.stat().st_size for f in files) < 100_000
    back = ingest.read_staging_csv(spark, path)
    assert back.exceptAll(text).count() == 0 and back.count() == 1000


def test_key_check_deals_keys_by_their_number(spark, monkeypatch):
    df = spark.range(1000).selectExpr("id % 900 AS a", "IF(id >= 990, NULL, CAST(id % 900 AS STRING)) AS b")
    at_once = rows(quality.pk_violations(df, ["a", "b"], "t"))
    monkeypatch.setattr(quality, "KEYS_PER_TASK", 100)
    dealt = quality.pk_violations(df, ["a", "b"], "t")
    assert rows(dealt) == at_once and len(at_once) == 100
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(a" in dealt._jdf.queryExecution().executedPlan().toString()


def _joins(df) -> list[str]:
    """The joins of the plan as first made, before adaptive execution has seen a size."""
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.initialPlan().toString() if plan.nodeName() == "AdaptiveSparkPlan" else plan.toString()
    return [line for line in text.splitlines() if "Join [" in line]


def _many_products_and_customers(spark, root: str) -> RetailModel:
    """Stored dimensions of more rows than may be broadcast, in files that look small."""
    n = BROADCAST_ROWS + 1
    tiny = _tiny_model(spark)
    store = warehouse.build_warehouse(spark, tiny.replace(
        customers=spark.range(1, n + 1).selectExpr("id AS customer_id", "concat('Customer#', id) AS customer_name", "'A' AS segment"),
        products=spark.range(n).selectExpr("id AS product_id", "'nut' AS product_name", "concat('C', id % 9) AS category", "'D' AS sub_category"),
    ), root, buckets=4)
    model = warehouse.store_model(store)
    for table in (model.customers, model.products):
        assert table.count() == n and table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10 << 20
    return model


def test_feed_broadcasts_no_dimension_of_many_rows(spark, tmp_path):
    told = staging_frame(_many_products_and_customers(spark, str(tmp_path / "w")))
    joins = _joins(told)
    for key in ("product_id", "customer_id"):
        assert [j.split("Join")[0].split()[-1] for j in joins if f"Join [{key}" in j] == ["SortMerge"], joins
    assert rows(told.na.fill("-"), "row_id", "order_id", "customer_name", "category") == [
        (1, "10", "Customer#1", "C7"), (2, "11", "-", "C8"), (3, "12", "-", "C7"), (4, "-", "-", "-"),
    ]
    # small ones are left to Spark's size check
    store = warehouse.build_warehouse(spark, _tiny_model(spark), str(tmp_path / "small"), buckets=4)
    assert any("BroadcastHashJoin [product_id" in j for j in _joins(staging_frame(warehouse.store_model(store))))


def test_loads_checks_and_report_broadcast_no_dimension_of_many_rows(spark, tmp_path):
    m = _many_products_and_customers(spark, str(tmp_path / "w"))
    missing = quality.model_fk_violations(m)
    assert [j.split("Join")[0].split()[-1] for j in _joins(missing)] == ["SortMerge"] * 4
    assert rows(missing, "table_name", "missing_value", "n_rows") == [("order_items", "12", 1)]
    # the references are grouped before they are joined
    told = missing._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert ["Aggregate" in told[at + 1] for at, line in enumerate(told) if "Join LeftAnti" in line] == [True] * 4
    report = reports.revenue_by_region_category(m)
    assert [j.split("Join")[0].split()[-1] for j in _joins(report) if "Join [product_id" in j] == ["SortMerge"]
    assert rows(report, "region", "category", "total_sales") == [("ASIA", "C7", 1.0), ("ASIA", "C8", 2.0)]
