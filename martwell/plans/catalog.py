"""Registered queries: one callable per operator id, ``(spark, sf_dir) ->
DataFrame``.  Each reads the whole warehouse that Spark builds from the source
tables in ``sf_dir`` (``martwell.plans.warehouse``), as the reports of a
warehouse read its normalised tables rather than the raw feed.

Parameters stated here are the fixtures of the original screens, moved onto
values present in the test data (regions, month, tag, profile key).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwell.functions import routines
from martwell.operators import audit, lookups, maintenance, normalize, quality, ranking, reports
from martwell.plans import pipeline, sql_surface
from martwell.plans.render import for_compare
from martwell.plans.warehouse import build_warehouse, open_store, open_warehouse, plan_layout, store_model
from martwell.session import new_scratch_dir
from martwell.sources import layers, storage
from martwell.sources.ingest import insert_select, read_staging_csv, write_staging_csv
from martwell.sources.testdata import read_raw, staging_frame
from martwell.streaming import triggers

# Report parameters used by the registered queries.
REGION = "ASIA"
MONTH = "1997-05"
TOP_N = 5
TOP_RANKED = 10
PROFILE_KEY = "k"
PROFILE_VALUE = "42"
TAG = " ring "
UNKNOWN_CUSTOMER = -1
RAISE_PERCENT = Decimal("5")

QueryFn = Callable[[SparkSession, str], DataFrame]


def model_of(spark: SparkSession, sf_dir: str):
    """The stored warehouse model of the sources in ``sf_dir`` (S2, built
    once per session)."""
    return open_warehouse(spark, sf_dir)


QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return for_compare(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return deco


def _asked_customers(spark: SparkSession, model) -> DataFrame:
    """Every customer id plus one id that does not exist."""
    unknown = spark.range(1).select(F.lit(UNKNOWN_CUSTOMER).cast("long").alias("customer_id"))
    return model.customers.select("customer_id").unionByName(unknown)


# ---- reports --------------------------------------------------------------------


@register("revenue_by_region_category")
def q_revenue_by_region_category(spark, sf_dir):
    """A1 (J1-J3)."""
    return reports.revenue_by_region_category(model_of(spark, sf_dir))


@register("revenue_by_month")
def q_revenue_by_month(spark, sf_dir):
    """A2, O4."""
    return reports.revenue_by_month(model_of(spark, sf_dir))


@register("customer_value")
def q_customer_value(spark, sf_dir):
    """A3 (J4)."""
    return reports.customer_value(model_of(spark, sf_dir))


@register("shipping_delay")
def q_shipping_delay(spark, sf_dir):
    """A4, P9, E3.  The day count is NULL for orders without a ship date;
    it is shown as double so NULL-able integers convert alike in every client."""
    out = reports.shipping_delay(model_of(spark, sf_dir))
    return out.withColumn("days_to_ship", F.col("days_to_ship").cast("double"))


@register("shipping_status_counts")
def q_shipping_status_counts(spark, sf_dir):
    """A5."""
    return reports.shipping_status_counts(model_of(spark, sf_dir))


@register("category_revenue")
def q_category_revenue(spark, sf_dir):
    """A6, O1 (J2)."""
    return reports.category_revenue(model_of(spark, sf_dir))


@register("state_city_revenue")
def q_state_city_revenue(spark, sf_dir):
    """A7."""
    return reports.state_city_revenue(model_of(spark, sf_dir))


@register("kpi_summary")
def q_kpi_summary(spark, sf_dir):
    """A8, A9."""
    return reports.kpi_summary(model_of(spark, sf_dir))


@register("region_revenue_param")
def q_region_revenue_param(spark, sf_dir):
    """P6, P8."""
    return reports.region_revenue_param(spark, model_of(spark, sf_dir), REGION)


@register("top_customers_by_spend")
def q_top_customers_by_spend(spark, sf_dir):
    """O2."""
    return reports.top_customers_by_spend(model_of(spark, sf_dir), TOP_N)


# ---- windows and calendar ---------------------------------------------------------


@register("customer_rank")
def q_customer_rank(spark, sf_dir):
    """W1 + N6 (as many ranges as the session has shuffle partitions)."""
    return ranking.customer_rank(model_of(spark, sf_dir))


@register("top_customers_ranked")
def q_top_customers_ranked(spark, sf_dir):
    """W2."""
    return ranking.top_customers_ranked(model_of(spark, sf_dir), TOP_RANKED)


@register("running_revenue")
def q_running_revenue(spark, sf_dir):
    """W3."""
    return ranking.running_revenue(model_of(spark, sf_dir))


@register("largest_line_per_customer")
def q_largest_line_per_customer(spark, sf_dir):
    """W4."""
    return ranking.largest_line_per_customer(model_of(spark, sf_dir))


@register("month_calendar")
def q_month_calendar(spark, sf_dir):
    """U1 over the data's month span, with revenue per month."""
    return ranking.calendar_revenue(model_of(spark, sf_dir))


# ---- functions ----------------------------------------------------------------------


@register("region_total_or_zero")
def q_region_total_or_zero(spark, sf_dir):
    """F1 set form over every region."""
    m = model_of(spark, sf_dir)
    asked = m.regions.select(F.col("region_name").alias("region"))
    return routines.region_total_or_zero(m, asked)


@register("customer_order_count")
def q_customer_order_count(spark, sf_dir):
    """F2 set form over every customer and one unknown id."""
    m = model_of(spark, sf_dir)
    return routines.customer_order_count(m, _asked_customers(spark, m))


@register("top_products_of_month")
def q_top_products_of_month(spark, sf_dir):
    """F3."""
    return routines.top_products_of_month(model_of(spark, sf_dir), MONTH, TOP_N)


@register("top_products_all_months")
def q_top_products_all_months(spark, sf_dir):
    """F3 set form."""
    out = routines.top_products_all_months(model_of(spark, sf_dir), TOP_N)
    return out.withColumn("pos", F.col("pos").cast("long"))


@register("customer_status")
def q_customer_status(spark, sf_dir):
    """F4 + A10 set form over every customer and one unknown id."""
    m = model_of(spark, sf_dir)
    return routines.customer_status(m, _asked_customers(spark, m))


# ---- array / JSON ------------------------------------------------------------------


@register("profile_lookup")
def q_profile_lookup(spark, sf_dir):
    """X1, E10, E11."""
    m = model_of(spark, sf_dir)
    return lookups.profiles_with_key(m.customer_profiles, PROFILE_KEY, PROFILE_VALUE, [PROFILE_KEY])


@register("tag_lookup")
def q_tag_lookup(spark, sf_dir):
    """X2, E12, E13."""
    return lookups.products_with_tag(model_of(spark, sf_dir).product_tags, TAG)


# ---- ingest and normalise ------------------------------------------------------------

# Declared yearly ranges of the partitioned order table, moved
# onto the years of the test data (half-open [lo, hi)).
YEAR_RANGES = [
    ("1995", date(1995, 1, 1), date(1996, 1, 1)),
    ("1996", date(1996, 1, 1), date(1997, 1, 1)),
    ("1997", date(1997, 1, 1), date(1998, 1, 1)),
]


_STAGED: dict[tuple[str, str], str] = {}


def _staging(spark, sf_dir):
    """The staging rows, parsed once per session from the feed."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STAGED:
        path = new_scratch_dir(spark, "staging")
        read_staging_csv(spark, feed_of(spark, sf_dir)).write.option("compression", storage.COMPRESSION).parquet(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


@register("staging_from_csv")
def q_staging_from_csv(spark, sf_dir):
    """The flat CSV feed of the sources (written once per session in the
    source dialect) loaded by position with the staging schema."""
    return read_staging_csv(spark, feed_of(spark, sf_dir))


@register("dim_region")
def q_dim_region(spark, sf_dir):
    """P1, A11."""
    return normalize.dim_regions(_staging(spark, sf_dir))


@register("dim_customer")
def q_dim_customer(spark, sf_dir):
    """P2."""
    return normalize.dim_customers(_staging(spark, sf_dir))


@register("dim_product")
def q_dim_product(spark, sf_dir):
    """P3."""
    return normalize.dim_products(_staging(spark, sf_dir))


@register("fact_orders")
def q_fact_orders(spark, sf_dir):
    """P4, E1."""
    return normalize.fact_orders(_staging(spark, sf_dir))


@register("fact_items")
def q_fact_items(spark, sf_dir):
    """P5."""
    return normalize.fact_items(_staging(spark, sf_dir))


# ---- checks ---------------------------------------------------------------------------


def _pk_all(spark, sf_dir):
    m = model_of(spark, sf_dir)
    li = read_raw(spark, sf_dir, "lineitem")
    return quality.model_pk_violations(m).unionByName(
        quality.pk_violations(li, ["l_orderkey", "l_linenumber"], "lineitem")
    )


def _range(spark, sf_dir):
    m = model_of(spark, sf_dir)
    return quality.range_violations(m.orders, "order_date", "order_id", YEAR_RANGES, "orders")


def _amount(spark, sf_dir):
    st = _staging(spark, sf_dir)
    return quality.amount_violations(st, "sales", "row_id", "staging")


def _date_text(spark, sf_dir):
    st = _staging(spark, sf_dir)
    return quality.date_text_violations(st, ["order_date", "ship_date"], "row_id", "staging")


@register("pk_violations")
def q_pk_violations(spark, sf_dir):
    """Q1 over the model keys and the source line key (order, line number)."""
    return _pk_all(spark, sf_dir)


@register("fk_violations")
def q_fk_violations(spark, sf_dir):
    """Q2 over the model's foreign keys."""
    return quality.model_fk_violations(model_of(spark, sf_dir))


@register("length_violations")
def q_length_violations(spark, sf_dir):
    """Q3 over the model's declared text limits."""
    return quality.model_length_violations(model_of(spark, sf_dir))


@register("range_violations")
def q_range_violations(spark, sf_dir):
    """Q4: orders outside the declared yearly ranges."""
    return _range(spark, sf_dir)


@register("amount_violations")
def q_amount_violations(spark, sf_dir):
    """Q5 on staging amounts."""
    return _amount(spark, sf_dir)


@register("date_text_violations")
def q_date_text_violations(spark, sf_dir):
    """Q6 on staging date text."""
    return _date_text(spark, sf_dir)


@register("check_summary")
def q_check_summary(spark, sf_dir):
    """Q1-Q6 violation counts, one row per check."""
    m = model_of(spark, sf_dir)
    return quality.check_summary(
        {
            "pk": _pk_all(spark, sf_dir),
            "fk": quality.model_fk_violations(m),
            "length": quality.model_length_violations(m),
            "range": _range(spark, sf_dir),
            "amount": _amount(spark, sf_dir),
            "date_text": _date_text(spark, sf_dir),
        }
    )


# ---- maintenance and audit --------------------------------------------------------------

# Change parameters used by the registered maintenance queries.
OLD_MODE, NEW_MODE = "5-LOW", "1-URGENT"
OLD_SEGMENT, NEW_SEGMENT = "BUILDING", "CONSTRUCTION"
LINE_ROW_ID, LINE_AMOUNT = 1001, Decimal("50")
ERASE_IDS = [1, 2, 3, -1]
FORCED_ORDER, FORCED_SHIP_DATE = 10, date(2010, 1, 1)


def _erase_ids(spark):
    return spark.createDataFrame([(i,) for i in ERASE_IDS], "customer_id long")


def _raise_changes(spark, sf_dir):
    return maintenance.increase_sales(model_of(spark, sf_dir).order_items, RAISE_PERCENT)


@register("ship_mode_updated")
def q_ship_mode_updated(spark, sf_dir):
    """M1 set form + T2 on the written rows: every low-priority order moves to
    the urgent mode; the new values are a batch beside the stored orders."""
    store = _branch(spark, sf_dir)
    orders = store.read("orders")
    updates = orders.where(F.col("ship_mode") == OLD_MODE).select("order_id", F.lit(NEW_MODE).alias("new_mode"))
    maintenance.commit_order_change(store, maintenance.touched_orders(orders, updates))
    return store.read("orders")


@register("sales_increased")
def q_sales_increased(spark, sf_dir):
    """M2: all amounts raised by 5 %, rounded to 2 places."""
    return maintenance.new_version(_raise_changes(spark, sf_dir))


@register("sales_increase_audit")
def q_sales_increase_audit(spark, sf_dir):
    """T1 on M2: one row per amount that really changed."""
    return audit.audit_rows(_raise_changes(spark, sf_dir))


@register("single_line_add")
def q_single_line_add(spark, sf_dir):
    """M5: add an amount to one line; its new amount is a batch of one row
    beside the stored lines, which are read together."""
    store = _branch(spark, sf_dir)
    maintenance.commit_line_update(store, maintenance.touched_line(store.read("order_items"), LINE_ROW_ID, LINE_AMOUNT))
    return store.read("order_items")


@register("single_line_audit")
def q_single_line_audit(spark, sf_dir):
    """T1 on M5."""
    items = model_of(spark, sf_dir).order_items
    return audit.audit_rows(maintenance.touched_line(items, LINE_ROW_ID, LINE_AMOUNT))


@register("segment_renamed")
def q_segment_renamed(spark, sf_dir):
    """M3."""
    return maintenance.rename_segment(model_of(spark, sf_dir).customers, OLD_SEGMENT, NEW_SEGMENT)


def _erased(spark, sf_dir):
    return maintenance.erase_customers(model_of(spark, sf_dir), _erase_ids(spark))


@register("customer_erased_items")
def q_customer_erased_items(spark, sf_dir):
    """Lines left after erasing several customers in one job."""
    return _erased(spark, sf_dir).order_items


@register("customer_erased_orders")
def q_customer_erased_orders(spark, sf_dir):
    """M4: orders left."""
    return _erased(spark, sf_dir).orders


@register("customer_erased_profiles")
def q_customer_erased_profiles(spark, sf_dir):
    """M4: profiles left."""
    return _erased(spark, sf_dir).customer_profiles


@register("customer_erased_customers")
def q_customer_erased_customers(spark, sf_dir):
    """M4: customers left."""
    return _erased(spark, sf_dir).customers


@register("ship_dates_repaired")
def q_ship_dates_repaired(spark, sf_dir):
    """T2 on every order row as written (batch twin of T4)."""
    o = audit.repair_ship_dates(model_of(spark, sf_dir).orders)
    return o.select("order_id", "order_date", "ship_date")


@register("ship_date_forced")
def q_ship_date_forced(spark, sf_dir):
    """M6 + T2 + P7: force one order's ship date into the past and read it back."""
    store = _branch(spark, sf_dir)
    maintenance.commit_order_change(
        store, maintenance.redated_order(store.read("orders"), FORCED_ORDER, F.lit(FORCED_SHIP_DATE))
    )
    return reports.order_lookup(store_model(store), FORCED_ORDER)


def _numbered_audit(spark, sf_dir):
    a = audit.audit_rows(_raise_changes(spark, sf_dir))
    return audit.number_audit_rows(a, 0).drop("changed_at")


@register("audit_numbered")
def q_audit_numbered(spark, sf_dir):
    """M7 + M8: audit rows of M2 with generated ids (no single-partition sort)."""
    return _numbered_audit(spark, sf_dir)


@register("audit_tail")
def q_audit_tail(spark, sf_dir):
    """O3: the last 5 rows of the stored audit log by id (a top-k)."""
    return _raised(spark, sf_dir).read("sales_audit").drop("changed_at").orderBy(F.col("audit_id").desc()).limit(5)


# ---- layouts, versions, snapshots --------------------------------------------------------


_RANGED: dict[tuple[str, str], str] = {}
ORDERS_BY_YEAR = "orders_partitioned"


def _orders_by_year(spark, sf_dir) -> storage.TableStore:
    """A store whose orders in year ranges were filled by two inserts, once per
    session; a later handle finds the ranges in the store."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _RANGED:
        store = storage.TableStore(spark, new_scratch_dir(spark, "orders-by-year"))
        orders = model_of(spark, sf_dir).orders
        layers.declare_ranges(store, ORDERS_BY_YEAR, "order_date", storage.year_ranges(orders))
        shipped = F.col("ship_date").isNotNull()
        layers.insert_ranged(store, ORDERS_BY_YEAR, orders.where(shipped))
        layers.insert_ranged(store, ORDERS_BY_YEAR, orders.where(~shipped))
        _RANGED[key] = store.root
    return storage.TableStore(spark, _RANGED[key])


@register("partitioned_orders_counts")
def q_partitioned_orders_counts(spark, sf_dir):
    """Orders inserted twice into a table in year ranges, counted per folder."""
    rows = _orders_by_year(spark, sf_dir).read(ORDERS_BY_YEAR)
    return rows.groupBy(layers.RANGE_COLUMN).agg(F.count(F.lit(1)).alias("n_orders"))


@register("partition_pruned_orders")
def q_partition_pruned_orders(spark, sf_dir):
    """S7 read with a partition filter (only the 1997 folders are listed)."""
    rows = _orders_by_year(spark, sf_dir).read(ORDERS_BY_YEAR).where(F.col(layers.RANGE_COLUMN) == 1997)
    return rows.select("order_id", "order_date", "order_year")


@register("partition_date_range_orders")
def q_partition_date_range_orders(spark, sf_dir):
    """S7 read by a date range that crosses a year boundary, by the bounds that
    the table keeps: only the two touched years are read, the date filter reaches
    the scan."""
    store = _orders_by_year(spark, sf_dir)
    df = layers.read_range(store, ORDERS_BY_YEAR, date(1996, 11, 15), date(1997, 2, 1))
    return df.select("order_id", "order_date", "order_year")


@register("bucketed_join_revenue")
def q_bucketed_join_revenue(spark, sf_dir):
    """Both facts written bucketed by order_id (bucket count sized from
    the line count); the join needs no shuffle.  Orders and revenue per ship
    mode."""
    m = model_of(spark, sf_dir)
    buckets = plan_layout(m.order_items)[0]
    tag = uuid.uuid4().hex[:10]
    items = storage.write_bucketed(
        m.order_items, f"mw_items_{tag}", new_scratch_dir(spark, "bucketed-items"), "order_id", buckets
    )
    orders = storage.write_bucketed(
        m.orders, f"mw_orders_{tag}", new_scratch_dir(spark, "bucketed-orders"), "order_id", buckets
    )
    j = items.join(orders, "order_id")
    return j.groupBy("ship_mode").agg(
        F.count_distinct("order_id").alias("total_orders"), F.sum("sales").alias("total_sales")
    )


@register("hot_order_revenue")
def q_hot_order_revenue(spark, sf_dir):
    """S8 with a hot order: a third of the products' lines are moved to the first
    order and the warehouse is built of that.  Its lines are kept apart and meet the
    broadcast order row; all others join in buckets.  Orders and revenue per region."""
    m = model_of(spark, sf_dir)
    first = m.orders.agg(F.min("order_id")).scalar()
    moved = m.order_items.withColumn(
        "order_id", F.when(F.col("product_id") % 3 == 0, first).otherwise(F.col("order_id"))
    )
    store = build_warehouse(spark, m.replace(order_items=moved), new_scratch_dir(spark, "hot-order"))
    return reports.orders_with_sums(store_model(store), ["region"]).groupBy("region").agg(
        F.count("order_id").alias("total_orders"), F.sum("order_sales").alias("total_sales")
    )


def _branch(spark, sf_dir) -> storage.TableStore:
    """A metadata-only branch of the warehouse to change without touching it."""
    return open_store(spark, sf_dir).clone(new_scratch_dir(spark, "branch"))


_RAISED: dict[tuple[str, str], str] = {}


def _raised(spark, sf_dir) -> storage.TableStore:
    """A new branch of the warehouse after the 5 % raise (M2), which is committed
    once per session and source folder."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _RAISED:
        store = _branch(spark, sf_dir)
        maintenance.commit_line_change(store, maintenance.increase_sales(store.read("order_items"), RAISE_PERCENT))
        _RAISED[key] = store.root
    return storage.TableStore(spark, _RAISED[key]).clone(new_scratch_dir(spark, "branch"))


@register("snapshot_roundtrip")
def q_snapshot_roundtrip(spark, sf_dir):
    """S9 + S10: snapshot every table, restore the newest snapshot into a new
    store, verify rows and content hashes."""
    root = new_scratch_dir(spark, "snapshots")
    storage.snapshot_store(open_store(spark, sf_dir), root)
    target = storage.TableStore(spark, new_scratch_dir(spark, "restored"))
    return storage.restore(spark, root, target)


@register("table_inventory")
def q_table_inventory(spark, sf_dir):
    """S11 + S6: stored tables by name with their row counts."""
    return open_store(spark, sf_dir).inventory()


@register("table_preview")
def q_table_preview(spark, sf_dir):
    """Preview of a listed table (n = 100), first rows by key."""
    return open_store(spark, sf_dir).preview("orders", 100, order_by="order_id")


@register("view_refresh")
def q_view_refresh(spark, sf_dir):
    """M9: the stored category result refreshed after the 5 % raise by what the
    raise moved, without the lines being added up again."""
    name = sql_surface.MV_CATEGORY_SALES
    store = _raised(spark, sf_dir)
    before = _branch(spark, sf_dir)
    store.refresh_view(name, reports.category_revenue(store_model(before)))
    changes = layers.last_change(store, "order_items").join(store.read("products").select("product_id", "category"), "product_id")
    maintenance.refresh_by_change(store, name, changes, ["category"])
    return store.read(name)


@register("erasure_published")
def q_erasure_published(spark, sf_dir):
    """M4 + N5: erasure written as new versions of four tables, published in
    one commit; row counts of every table afterwards."""
    store = _branch(spark, sf_dir)
    erased = maintenance.erase_customers(store_model(store), _erase_ids(spark))
    store.write_all(
        {
            "order_items": erased.order_items,
            "orders": erased.orders,
            "customer_profiles": erased.customer_profiles,
            "customers": erased.customers,
        }
    )
    return store.inventory()


# ---- streams -----------------------------------------------------------------------------


@register("stream_audit")
def q_stream_audit(spark, sf_dir):
    """Change rows of the 5 % raise arrive as files; a stream keeps the
    real changes and appends them to the audit sink."""
    src = new_scratch_dir(spark, "changes")
    triggers.changes_frame(_raise_changes(spark, sf_dir)).write.parquet(src)
    sink = new_scratch_dir(spark, "audit-sink")
    triggers.run_file_stream(
        spark, src, triggers.CHANGE_SCHEMA, triggers.audit_stream, sink, new_scratch_dir(spark, "ckpt")
    )
    return spark.read.schema("row_id long, old_sales decimal(12,2), new_sales decimal(12,2)").parquet(sink)


@register("stream_ship_repair")
def q_stream_ship_repair(spark, sf_dir):
    """T4: written order rows arrive as files; a stream repairs ship dates."""
    src = new_scratch_dir(spark, "orders-in")
    model_of(spark, sf_dir).orders.write.parquet(src)
    schema = spark.read.parquet(src).schema
    sink = new_scratch_dir(spark, "orders-sink")
    triggers.run_file_stream(spark, src, schema, triggers.ship_repair_stream, sink, new_scratch_dir(spark, "ckpt"))
    return spark.read.schema(schema).parquet(sink).select("order_id", "order_date", "ship_date")


@register("audit_log_after_two_updates")
def q_audit_log_after_two_updates(spark, sf_dir):
    """M2 then M5, each committed with its audit batch (T1, M7, M8, N5); the
    append-only audit log afterwards (change times left out)."""
    return _log_after_two_updates(spark, sf_dir).drop("changed_at")


def _log_after_two_updates(spark, sf_dir):
    store = _raised(spark, sf_dir)
    maintenance.commit_line_update(store, maintenance.touched_line(store.read("order_items"), LINE_ROW_ID, LINE_AMOUNT))
    return store.read("sales_audit")


# ---- end-to-end load (S1 -> Q -> P -> S2) ------------------------------------------------


_FEEDS: dict[tuple[str, str], str] = {}


def feed_of(spark, sf_dir) -> str:
    """The flat CSV feed of the source tables (the files a load receives),
    written once per session and source folder."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _FEEDS:
        _FEEDS[key] = write_staging_csv(staging_frame(model_of(spark, sf_dir)), new_scratch_dir(spark, "feed"))
    return _FEEDS[key]


def _pipeline(spark, sf_dir, strict: bool, ranges):
    m = model_of(spark, sf_dir)
    csv = feed_of(spark, sf_dir)
    tags = m.product_tags.select(F.col("product_id").cast("string"), "tags")
    profiles = m.customer_profiles.select(F.col("customer_id").cast("string"), "profile")
    return pipeline.run_pipeline(spark, csv, tags, profiles, strict=strict, year_ranges=ranges)


@register("pipeline_revenue_by_region_category")
def q_pipeline_revenue_by_region_category(spark, sf_dir):
    """S1 + P1-P5 + Q1-Q6 (strict) + S2, then A1 on the loaded warehouse."""
    result = _pipeline(spark, sf_dir, strict=True, ranges=None)
    return reports.revenue_by_region_category(store_model(result.store))


@register("pipeline_load_checks")
def q_pipeline_load_checks(spark, sf_dir):
    """The load's check report (violation count per check), including the
    yearly ranges of the partitioned order table."""
    return _pipeline(spark, sf_dir, strict=False, ranges=YEAR_RANGES).checks


# ---- SQL surface (views and SQL-bodied functions by name) ------------------------------


def _sql(spark, sf_dir, text):
    sql_surface.register_sql(spark, model_of(spark, sf_dir))
    return spark.sql(text)


@register("sql_region_totals")
def q_sql_region_totals(spark, sf_dir):
    """F1 called from SQL for every region."""
    return _sql(
        spark, sf_dir, "SELECT region_name AS region, fn_total_sales_by_region(region_name) AS total_sales FROM regions"
    )


@register("sql_sales_trend_view")
def q_sql_sales_trend_view(spark, sf_dir):
    """A2 through its view name."""
    return _sql(spark, sf_dir, "SELECT * FROM v_sales_trend")


@register("sql_top_products_function")
def q_sql_top_products_function(spark, sf_dir):
    """F3 as a SQL table function."""
    return _sql(spark, sf_dir, f"SELECT * FROM fn_top_products_by_month('{MONTH}', {TOP_N})")


@register("sql_customer_functions")
def q_sql_customer_functions(spark, sf_dir):
    """F2 and F4 called from SQL for every customer."""
    return _sql(
        spark,
        sf_dir,
        "SELECT customer_id, fn_customer_order_count(customer_id) AS order_count, "
        "fn_get_customer_status(customer_id) AS status FROM customers",
    )


@register("stream_audit_log")
def q_stream_audit_log(spark, sf_dir):
    """T3 + M7 + M8: change files of the 5 % raise streamed into the versioned
    audit log, each micro-batch committed exactly once with numbered ids."""
    src = new_scratch_dir(spark, "changes")
    triggers.changes_frame(_raise_changes(spark, sf_dir)).write.parquet(src)
    store = _branch(spark, sf_dir)
    triggers.run_audit_log_stream(spark, src, store, new_scratch_dir(spark, "ckpt"))
    return store.read("sales_audit").drop("changed_at")


# ---- checks that find rows ----------------------------------------------------------------

# What the disturbed feed and the extra checks use.
LARGE_AMOUNT, AMOUNT_FACTOR = 90000, 1_000_000
SWAPPED_MODE = "3-MEDIUM"
TEXT_LIMIT = 1000
UNKNOWN_REGION = "NOWHERE"


def _disturbed(spark, sf_dir):
    """The staging rows as a feed with faults: amounts above a limit come in
    another unit, and one ship mode writes its dates month first."""
    st = _staging(spark, sf_dir)
    swapped = F.col("ship_mode") == SWAPPED_MODE

    def month_first(c):
        parts = F.split(c, "/")
        return F.when(swapped, F.concat_ws("/", parts[1], parts[0], parts[2])).otherwise(F.col(c))

    sales = F.when(F.col("sales") > LARGE_AMOUNT, F.col("sales") * AMOUNT_FACTOR).otherwise(F.col("sales"))
    return st.select(
        *(
            month_first(c).alias(c)
            if c == "order_date"
            else sales.cast(st.schema["sales"].dataType).alias(c)
            if c == "sales"
            else F.col(c)
            for c in st.columns
        )
    )


@register("feed_amount_violations")
def q_feed_amount_violations(spark, sf_dir):
    """Q5 on a feed some of whose amounts are too large."""
    return quality.amount_violations(_disturbed(spark, sf_dir), "sales", "row_id", "staging")


@register("feed_date_violations")
def q_feed_date_violations(spark, sf_dir):
    """Q6 on a feed some of whose dates are written month first."""
    return quality.date_text_violations(_disturbed(spark, sf_dir), ["order_date", "ship_date"], "row_id", "staging")


@register("feed_load_checks")
def q_feed_load_checks(spark, sf_dir):
    """The lenient load (S1, P1-P5, Q1-Q3, Q5, Q6) of the faulty feed: its
    faults are reported and not thrown."""
    m = model_of(spark, sf_dir)
    csv = write_staging_csv(_disturbed(spark, sf_dir), new_scratch_dir(spark, "faulty-feed"))
    tags = m.product_tags.select(F.col("product_id").cast("string"), "tags")
    profiles = m.customer_profiles.select(F.col("customer_id").cast("string"), "profile")
    return pipeline.run_pipeline(spark, csv, tags, profiles, strict=False).checks


@register("orphans_after_erasure")
def q_orphans_after_erasure(spark, sf_dir):
    """Q2 of the orders before an erasure against the customers after it."""
    left = _erased(spark, sf_dir).customers
    return quality.fk_violations(model_of(spark, sf_dir).orders, "customer_id", left, "customer_id", "orders")


@register("long_documents")
def q_long_documents(spark, sf_dir):
    """Q3 over the texts of documents."""
    return quality.length_violations(read_raw(spark, sf_dir, "documents"), {"text": TEXT_LIMIT}, "documents", "doc_id")


@register("audit_key_check")
def q_audit_key_check(spark, sf_dir):
    """Q1 of the audit log after two updates: by its key, and by the line
    changed (a line changed twice shows)."""
    log = _log_after_two_updates(spark, sf_dir)
    return quality.pk_violations(log, ["audit_id"], "sales_audit").unionByName(
        quality.pk_violations(log, ["row_id"], "changed lines")
    )


@register("audit_change_times")
def q_audit_change_times(spark, sf_dir):
    """Rows, change times (one per commit) and missing times of the log
    after two updates."""
    return _log_after_two_updates(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("changed_at").alias("n_times"),
        F.count_if(F.col("changed_at").isNull()).alias("n_missing"),
    )


# ---- inserts, views, unknown keys ---------------------------------------------------------


@register("insert_selected_orders")
def q_insert_selected_orders(spark, sf_dir):
    """S3: two INSERT ... SELECT into one target, some columns of the orders
    with and without a ship date."""
    orders = model_of(spark, sf_dir).orders
    path, cols = new_scratch_dir(spark, "inserted"), ["order_id", "ship_date", "customer_id"]
    insert_select(path, orders.where("ship_date IS NOT NULL"), cols)
    insert_select(path, orders.where("ship_date IS NULL"), cols)
    return spark.read.schema(orders.select(*cols).schema).parquet(path)


@register("tags_appended")
def q_tags_appended(spark, sf_dir):
    """Literal rows with arrays appended to the tags, and a literal
    array of its own on every row."""
    tags = lookups.append_tag_rows(spark, model_of(spark, sf_dir).product_tags, [("NEW-1", ["red", "ring"]), ("NEW-2", [])])
    return tags.withColumn("kinds", F.array(F.lit("product"), F.lit("tag")))


@register("profiles_appended")
def q_profiles_appended(spark, sf_dir):
    """Literal JSON rows appended to the profiles; text that is no JSON is
    refused."""
    rows = [("NEW-1", '{"k": 42}'), ("NEW-2", "no json {")]
    return lookups.append_profile_rows(spark, model_of(spark, sf_dir).customer_profiles, rows)[0]


@register("preview_any_rows")
def q_preview_any_rows(spark, sf_dir):
    """A preview without an order holds n rows of the table."""
    store = open_store(spark, sf_dir)
    some = store.preview("orders", 100).join(store.read("orders").select("order_id"), "order_id", "left_semi")
    return some.agg(F.count_distinct("order_id").alias("n_rows"))


@register("relation_inventory")
def q_relation_inventory(spark, sf_dir):
    """Tables and views by name with their row counts."""
    store = open_store(spark, sf_dir)
    return sql_surface.inventory(store_model(store), store)


@register("view_preview")
def q_view_preview(spark, sf_dir):
    """S12 of a view: the first 50 rows by month."""
    store = open_store(spark, sf_dir)
    return sql_surface.preview(store_model(store), store, sql_surface.VIEW_SALES_TREND, 50, order_by="order_month")


@register("state_city_refresh")
def q_state_city_refresh(spark, sf_dir):
    """M9: the stored state and city result after the 5 % raise, as read before
    its refresh (stale) and after it."""
    name = sql_surface.MV_STATE_CITY_SALES
    store = _raised(spark, sf_dir)
    store.refresh_view(name, reports.state_city_revenue(model_of(spark, sf_dir)))
    stale = store.read(name).select("state", "city", F.col("total_sales").alias("stale_sales"))
    places = store.read("orders").select("order_id", "state", "city")
    maintenance.refresh_by_change(store, name, layers.last_change(store, "order_items").join(places, "order_id"), ["state", "city"])
    return store.read(name).join(stale, ["state", "city"])


@register("region_total_unknown")
def q_region_total_unknown(spark, sf_dir):
    """F1 over every region and one that does not exist."""
    m = model_of(spark, sf_dir)
    unknown = spark.range(1).select(F.lit(UNKNOWN_REGION).alias("region"))
    return routines.region_total_or_zero(m, m.regions.select(F.col("region_name").alias("region")).unionByName(unknown))


# ---- inserts with keys, changes of some rows, lines as a stream ------------------------------

# The part of the orders and lines that the queries below copy.
COPIED_MODE, UNKNOWN_PRODUCT = "2-HIGH", -1


def _copied_orders(store):
    """The orders of one mode under new ids."""
    orders = store.read("orders").where(F.col("ship_mode") == COPIED_MODE)
    return orders.withColumn("order_id", -F.col("order_id") - 1)


@register("orders_inserted")
def q_orders_inserted(spark, sf_dir):
    """S3 with Q1, Q2: new orders pass the checks of their keys and references and
    stand beside the stored ones; orders per mode with the last date."""
    store = _branch(spark, sf_dir)
    layers.insert(
        store, "orders", _copied_orders(store), "order_id",
        {"customer_id": ("customers", "customer_id"), "region": ("regions", "region_name")},
    )
    return store.read("orders").groupBy("ship_mode").agg(
        F.count(F.lit(1)).alias("n_orders"), F.min("order_id").alias("least_id"), F.max("order_date").alias("last_date")
    )


@register("insert_violations")
def q_insert_violations(spark, sf_dir):
    """Q1, Q2 of an insert of lines that are there already, twice, and refer to an
    unknown product: what refuses them."""
    store = _branch(spark, sf_dir)
    items = store.read("order_items")
    urgent = store.read("orders").where(F.col("ship_mode") == NEW_MODE).select("order_id")
    again = items.join(urgent, "order_id", "left_semi").withColumn("product_id", F.lit(UNKNOWN_PRODUCT).cast("long"))
    return quality.insert_violations(
        again.unionByName(again), items.select("row_id"), "row_id",
        {"product_id": (store.read("products").select("product_id"), "product_id")}, "order_items",
    )


@register("lines_added_up")
def q_lines_added_up(spark, sf_dir):
    """M5 set form + J1, A5: every line of urgent orders gets an amount, twice
    (two batches beside the lines, the newest counts); revenue per mode by the
    bucketed join over base and batches."""
    store = _branch(spark, sf_dir)
    for _ in range(2):
        items, orders = store.read("order_items"), store.read("orders")
        urgent = orders.where(F.col("ship_mode") == NEW_MODE).select("order_id")
        asked = items.join(urgent, "order_id", "left_semi").select("row_id", F.lit(LINE_AMOUNT).alias("amount"))
        maintenance.commit_line_update(store, maintenance.touched_lines(items, asked))
    m = store_model(store)
    return m.order_items.join(m.orders.select("order_id", "ship_mode"), "order_id").groupBy("ship_mode").agg(
        F.sum("sales").alias("total_sales"), F.count(F.lit(1)).alias("n_lines")
    )


@register("stream_lines_with_old")
def q_stream_lines_with_old(spark, sf_dir):
    """T3 that sees OLD by itself: written lines (id and new amount) arrive as
    files; the old amounts come from the stored lines, the audit rows and the new
    amounts are published together."""
    src = new_scratch_dir(spark, "lines-in")
    raised = maintenance.new_version(_raise_changes(spark, sf_dir))
    raised.select("row_id", "sales").write.parquet(src)
    store = _branch(spark, sf_dir)
    triggers.run_audit_log_stream(
        spark, src, store, new_scratch_dir(spark, "ckpt"), schema=triggers.LINE_SCHEMA, commit=triggers.commit_line_batch
    )
    return store.read("sales_audit").drop("changed_at")
