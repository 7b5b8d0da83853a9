"""Spark SQL surface: the warehouse's tables, views and functions by name.

``register_sql(spark, model)`` makes a session able to run the statements a
user of the original warehouse runs -- ``SELECT * FROM v_sales_trend``,
``SELECT fn_total_sales_by_region('West')``,
``SELECT * FROM fn_top_products_by_month('2016-11', 5)`` -- over the stored
model.  Views are the report DataFrames; functions are SQL-bodied Spark
functions whose subqueries Catalyst decorrelates into joins and aggregates,
so calling a function once per row of a large table is one set-based plan,
not a loop.  Names are session-wide (temporary) and point at the model last
registered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwell.functions import routines
from martwell.operators import reports
from martwell.sources.model import RetailModel
from martwell.sources.storage import TableStore, preview_of

# The view and function names of the warehouse's SQL surface.
VIEW_SALES_BY_REGION_CATEGORY = "v_sales_by_region_category"
VIEW_SALES_TREND = "v_sales_trend"
VIEW_CUSTOMER_LIFETIME_VALUE = "v_customer_lifetime_value"
VIEW_DELAYED_SHIPMENTS = "v_delayed_shipments"
MV_CATEGORY_SALES = "mv_category_sales"
MV_STATE_CITY_SALES = "mv_state_city_sales"
FN_TOTAL_SALES_BY_REGION = "fn_total_sales_by_region"
FN_CUSTOMER_ORDER_COUNT = "fn_customer_order_count"
FN_TOP_PRODUCTS_BY_MONTH = "fn_top_products_by_month"
FN_GET_CUSTOMER_STATUS = "fn_get_customer_status"

# Type of summed amounts.
MONEY = "DECIMAL(32,2)"


def _function_sql(id_type: str) -> list[str]:
    status = (
        f"CASE WHEN days IS NULL THEN '{routines.STATUS_NOT_FOUND}' "
        f"WHEN days <= {routines.ACTIVE_DAYS} THEN '{routines.STATUS_ACTIVE}' "
        f"WHEN days <= {routines.AT_RISK_DAYS} THEN '{routines.STATUS_AT_RISK}' "
        f"ELSE '{routines.STATUS_CHURNED}' END"
    )
    return [
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {FN_TOTAL_SALES_BY_REGION}(p_region STRING)
RETURNS {MONEY}
RETURN SELECT COALESCE(SUM(sales), 0)
       FROM (SELECT order_id FROM orders WHERE region = p_region) JOIN order_items USING (order_id)""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {FN_CUSTOMER_ORDER_COUNT}(p_customer_id {id_type})
RETURNS BIGINT
RETURN SELECT COUNT(*) FROM orders WHERE customer_id = p_customer_id""",
        # The limit is a parameter, which LIMIT cannot take inside a SQL
        # function; a row number filter says the same, and once the call is
        # inlined Catalyst plans it as a top-k (TakeOrderedAndProject), so no
        # partition holds more than p_limit rows of it.
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {FN_TOP_PRODUCTS_BY_MONTH}(p_year_month STRING, p_limit INT DEFAULT 5)
RETURNS TABLE (product_name STRING, category STRING, total_revenue {MONEY})
RETURN SELECT product_name, category, total_revenue FROM (
  SELECT p.product_name, p.category, SUM(r.rev) AS total_revenue,
         ROW_NUMBER() OVER (ORDER BY SUM(r.rev) DESC, p.product_name, p.category) AS pos
  FROM (SELECT oi.product_id, SUM(oi.sales) AS rev
        FROM order_items oi JOIN orders o ON oi.order_id = o.order_id
        WHERE o.order_date >= to_date(p_year_month || '-01')
          AND o.order_date < add_months(to_date(p_year_month || '-01'), 1)
        GROUP BY oi.product_id) r
  JOIN products p ON r.product_id = p.product_id
  GROUP BY p.product_name, p.category) t
WHERE pos <= p_limit""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {FN_GET_CUSTOMER_STATUS}(p_customer_id {id_type})
RETURNS STRING
RETURN SELECT {status} FROM (
  SELECT datediff((SELECT MAX(order_date) FROM orders), MAX(order_date)) AS days
  FROM orders WHERE customer_id = p_customer_id)""",
    ]


# Stored results and the reports that define them (M9).
MATERIALIZED = {
    MV_CATEGORY_SALES: reports.category_revenue,
    MV_STATE_CITY_SALES: reports.state_city_revenue,
}


def refresh_materialized(store: TableStore, names: list[str] | None = None) -> list[str]:
    """M9: recompute stored results from the store's current tables and
    publish them (one commit); readers see the previous contents until then."""
    seen = store.current()
    model = RetailModel(**{t: store.read(t) for t in RetailModel.__dataclass_fields__})
    names = names or list(MATERIALIZED)
    paths = {n: store.stage(n, MATERIALIZED[n](model)) for n in names}
    store.publish(paths, expected=seen)
    return names


def views(model: RetailModel, store: TableStore | None = None) -> dict[str, DataFrame]:
    """Every view and stored result by name; stored results that ``store``
    holds are read, others are computed."""
    found = {
        VIEW_SALES_BY_REGION_CATEGORY: reports.revenue_by_region_category(model),
        VIEW_SALES_TREND: reports.revenue_by_month(model),
        VIEW_CUSTOMER_LIFETIME_VALUE: reports.customer_value(model),
        VIEW_DELAYED_SHIPMENTS: reports.shipping_delay(model),
    }
    stored = store.current() if store is not None else {}
    for name, define in MATERIALIZED.items():
        found[name] = store.read(name) if name in stored else define(model)
    return found


def inventory(model: RetailModel, store: TableStore) -> DataFrame:
    """(table_name, kind, n_rows) of the stored tables and the views."""
    out = store.inventory().withColumn("kind", F.lit("table"))
    for name, df in views(model, store).items():
        if name not in store.current():
            counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
            out = out.unionByName(counted.select(F.lit(name).alias("table_name"), "n_rows", F.lit("view").alias("kind")))
    return out


def preview(model: RetailModel, store: TableStore, name: str, n: int = 100, order_by: str | None = None) -> DataFrame:
    """S12 of a stored table or a view (see ``TableStore.preview``)."""
    found = views(model, store)
    return preview_of(found[name], n, order_by) if name in found else store.preview(name, n, order_by)


def register_sql(spark: SparkSession, model: RetailModel, store: TableStore | None = None) -> list[str]:
    """Register tables, views, stored results and functions; returns the
    names registered.  With ``store``, stored results that have been
    refreshed into it are served as stored (stale until the next refresh);
    otherwise they are computed on read."""
    names = []
    for name, df in model.tables().items():
        df.createOrReplaceTempView(name)
        names.append(name)
    for name, df in views(model, store).items():
        df.createOrReplaceTempView(name)
        names.append(name)
    for stmt in _function_sql(dict(model.customers.dtypes)["customer_id"].upper()):
        spark.sql(stmt)
    return names + [FN_TOTAL_SALES_BY_REGION, FN_CUSTOMER_ORDER_COUNT, FN_TOP_PRODUCTS_BY_MONTH, FN_GET_CUSTOMER_STATUS]
