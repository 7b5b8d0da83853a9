"""Staging -> dimensions and facts.

All are single-pass aggregations with map-side combine: a region, customer
or product that fills a third of the staging rows is reduced inside each task
before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwell.functions.exprs import parse_source_date, to_money, try_parse_source_date
from martwell.sources.model import SALES_TYPE, RetailModel


def dim_regions(staging: DataFrame) -> DataFrame:
    """SELECT DISTINCT region."""
    return staging.select(F.col("region").alias("region_name")).distinct()


def dim_customers(staging: DataFrame) -> DataFrame:
    """SELECT DISTINCT customer_id, customer_name, segment.  An id with two
    names gives two rows; Q1 on customer_id reports it."""
    return staging.select("customer_id", "customer_name", "segment").distinct()


def dim_products(staging: DataFrame) -> DataFrame:
    """One row per product id; the attributes of the lowest row_id win."""
    best = staging.groupBy("product_id").agg(
        F.min_by(F.struct("product_name", "category", "sub_category"), F.col("row_id")).alias("p")
    )
    return best.select("product_id", "p.product_name", "p.category", "p.sub_category")


def fact_orders(staging: DataFrame, strict: bool = True) -> DataFrame:
    """Distinct order rows with both dates parsed from d/M/yyyy text.

    ``strict`` fails the job on text that is no date (as the load does);
    otherwise such dates become NULL and Q6 lists them."""
    parse = parse_source_date if strict else try_parse_source_date
    return staging.select(
        "order_id",
        parse("order_date").alias("order_date"),
        parse("ship_date").alias("ship_date"),
        "ship_mode",
        "customer_id",
        "country",
        "city",
        "state",
        "postal_code",
        "region",
    ).distinct()


def fact_items(staging: DataFrame, strict: bool = True) -> DataFrame:
    """P5: line projection; the amount is assigned to NUMERIC(12,2).  An amount
    that does not fit is an error, or NULL without ``strict`` (Q5 reports it)."""
    sales = F.col("sales")
    money = to_money(sales) if strict else sales.try_cast(SALES_TYPE)
    return staging.select("row_id", "order_id", "product_id", money.alias("sales"))


def normalise(staging: DataFrame, tags: DataFrame, profiles: DataFrame, strict: bool = True) -> RetailModel:
    """S2 transform step: the whole model from staging (tags and profiles are
    side tables filled by their own inserts)."""
    return RetailModel(
        regions=dim_regions(staging),
        customers=dim_customers(staging),
        products=dim_products(staging),
        orders=fact_orders(staging, strict),
        order_items=fact_items(staging, strict),
        product_tags=tags,
        customer_profiles=profiles,
    )
