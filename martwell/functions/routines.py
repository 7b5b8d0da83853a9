"""Stored-function equivalents.

Each has a single-key form (same inputs as the original function) and a set
form that answers for a whole DataFrame of keys in one job -- the form to use
at scale.  The asked keys are a DataFrame, so they can be as many as needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwell.functions.exprs import days_between, month_key, month_range
from martwell.operators.ranking import top_n_per_group
from martwell.operators.reports import lines_with_orders, revenue_per_product
from martwell.sources.model import RetailModel

# Customer status labels and day limits.
STATUS_ACTIVE = "Active (Mua gần đây)"
STATUS_AT_RISK = "At Risk (Sắp rời bỏ)"
STATUS_CHURNED = "Churned (Đã rời bỏ)"
STATUS_NOT_FOUND = "Not Found"
ACTIVE_DAYS = 90
AT_RISK_DAYS = 180

DEFAULT_TOP_N = 5


# ---- F1: revenue of a region, 0 when none -------------------------------------


def region_revenue(model: RetailModel) -> DataFrame:
    return lines_with_orders(model, ["region"]).groupBy("region").agg(F.sum("sales").alias("total"))


def region_total_or_zero(model: RetailModel, asked_regions: DataFrame) -> DataFrame:
    """Set form of F1: ``asked_regions(region)`` -> (region, total_sales)."""
    tot = region_revenue(model)
    return asked_regions.select("region").join(tot, "region", "left").select(
        "region", F.coalesce("total", F.lit(0)).alias("total_sales")
    )


def total_sales_by_region(model: RetailModel, region: str) -> DataFrame:
    """Single-key F1: one row, total revenue of ``region`` or 0."""
    here = lines_with_orders(model, ["region"]).where(F.col("region") == F.lit(region))
    return here.agg(F.coalesce(F.sum("sales"), F.lit(0)).alias("total_sales"))


# ---- F2: order count of a customer ----------------------------------------------


def customer_order_count(model: RetailModel, asked_ids: DataFrame) -> DataFrame:
    """Set form of F2: ``asked_ids(customer_id)`` -> (customer_id, order_count),
    counting order headers (0 for unknown ids)."""
    counts = model.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return asked_ids.select("customer_id").join(counts, "customer_id", "left").select(
        "customer_id", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("order_count")
    )


def order_count_of(model: RetailModel, customer_id) -> DataFrame:
    """Single-key F2."""
    return model.orders.where(F.col("customer_id") == F.lit(customer_id)).agg(
        F.count(F.lit(1)).cast("long").alias("order_count")
    )


# ---- F3: top products of a month ------------------------------------------------


def top_products_of_month(model: RetailModel, year_month: str, n: int = DEFAULT_TOP_N) -> DataFrame:
    """the n products (by name and category) with most revenue in the
    month; ties by name then category.  The month becomes a date range so the
    filter reaches the scan."""
    lo, hi = month_range(year_month)
    lines = lines_with_orders(model, ["order_date"]).where((F.col("order_date") >= lo) & (F.col("order_date") < hi))
    per = revenue_per_product(lines, [])
    j = per.join(model.products.select("product_id", "product_name", "category"), "product_id")
    return (
        j.groupBy("product_name", "category")
        .agg(F.sum("_rev").alias("rev"))
        .orderBy(
            F.col("rev").desc_nulls_first(),
            F.col("product_name").asc_nulls_last(),
            F.col("category").asc_nulls_last(),
        )
        .limit(n)
        .select("product_name", "category", F.col("rev").alias("total_revenue"))
    )


def top_products_all_months(model: RetailModel, n: int = DEFAULT_TOP_N) -> DataFrame:
    """Set form of F3: the top n of every month in one job."""
    lines = lines_with_orders(model, ["order_date"]).withColumn("order_month", month_key("order_date"))
    j = revenue_per_product(lines, ["order_month"]).join(
        model.products.select("product_id", "product_name", "category"), "product_id"
    )
    per = j.groupBy("order_month", "product_name", "category").agg(F.sum("_rev").alias("rev"))
    order: list[Column] = [
        F.col("rev").desc_nulls_first(),
        F.col("product_name").asc_nulls_last(),
        F.col("category").asc_nulls_last(),
    ]
    return top_n_per_group(per, ["order_month"], order, n, "pos").select(
        "order_month", "pos", "product_name", "category", F.col("rev").alias("total_revenue")
    )


# ---- F4: customer status ----------------------------------------------------------


def status_label(days: Column) -> Column:
    return (
        F.when(days <= ACTIVE_DAYS, F.lit(STATUS_ACTIVE))
        .when(days <= AT_RISK_DAYS, F.lit(STATUS_AT_RISK))
        .otherwise(F.lit(STATUS_CHURNED))
    )


def latest_order_date(model: RetailModel) -> Column:
    """A10 as a scalar subquery: Spark runs it once and uses the value as a
    constant -- no cross join, nothing collected by the caller."""
    return model.orders.agg(F.max("order_date")).scalar()


def customer_status(model: RetailModel, asked_ids: DataFrame) -> DataFrame:
    """Set form of F4: status from the days between the customer's last order
    and the latest order of the whole table; no orders -> Not Found."""
    last = model.orders.groupBy("customer_id").agg(F.max("order_date").alias("last_order"))
    days = days_between(latest_order_date(model), F.col("last_order"))
    return asked_ids.select("customer_id").join(last, "customer_id", "left").select(
        "customer_id",
        F.when(F.col("last_order").isNull(), F.lit(STATUS_NOT_FOUND)).otherwise(status_label(days)).alias("status"),
    )


def status_of(model: RetailModel, customer_id) -> DataFrame:
    """Single-key F4."""
    spark = model.orders.sparkSession
    asked = spark.range(1).select(F.lit(customer_id).alias("customer_id"))
    return customer_status(model, asked).select("status")
