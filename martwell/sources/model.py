"""Retail model: table schemas and declared limits.

The warehouse has a staging table (flat text rows), three dimensions
(regions, customers, products), two facts (orders, order_items), the audit log
and two side tables (product_tags with an array column, customer_profiles with
a JSON text column).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared column limits of the model (VARCHAR(n)).
LENGTH_LIMITS: dict[str, dict[str, int]] = {
    "regions": {"region_name": 50},
    "customers": {"customer_id": 20, "customer_name": 150, "segment": 50},
    "products": {"product_id": 30, "category": 100, "sub_category": 100},
    "orders": {
        "order_id": 30,
        "ship_mode": 50,
        "customer_id": 20,
        "country": 100,
        "city": 100,
        "state": 100,
        "postal_code": 20,
        "region": 50,
    },
    "order_items": {"order_id": 30, "product_id": 30},
    "product_tags": {"product_id": 30},
    "customer_profiles": {"customer_id": 20},
}

# Primary keys and foreign keys of the model.
PRIMARY_KEYS: dict[str, list[str]] = {
    "regions": ["region_name"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["row_id"],
}
# (child table, child column, parent table, parent column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "region", "regions", "region_name"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
]

# Money in the line fact: NUMERIC(12,2).
SALES_TYPE = T.DecimalType(12, 2)
# Staging amount: unbounded NUMERIC in the source, widest Spark decimal here.
STAGING_SALES_TYPE = T.DecimalType(38, 10)

# Staging row layout, matched to the flat file by position (header skipped).
STAGING_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("ship_date", T.StringType()),
        T.StructField("ship_mode", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("sub_category", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("sales", STAGING_SALES_TYPE),
    ]
)

ORDER_COLUMNS = [
    "order_id",
    "order_date",
    "ship_date",
    "ship_mode",
    "customer_id",
    "country",
    "city",
    "state",
    "postal_code",
    "region",
]
ITEM_COLUMNS = ["row_id", "order_id", "product_id", "sales"]
CUSTOMER_COLUMNS = ["customer_id", "customer_name", "segment"]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "sub_category"]

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("audit_id", T.LongType()),
        T.StructField("row_id", T.LongType()),
        T.StructField("old_sales", SALES_TYPE),
        T.StructField("new_sales", SALES_TYPE),
        T.StructField("changed_at", T.TimestampNTZType()),
    ]
)


@dataclass
class RetailModel:
    """The warehouse tables as (lazy) DataFrames."""

    regions: DataFrame
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    product_tags: DataFrame
    customer_profiles: DataFrame

    # (lines of all other orders, lines of the hot orders, ids of the hot orders, the
    # orders in buckets) where the store keeps hot orders' lines apart (S8); no table.
    split = None

    def fact_parts(self) -> list[tuple[DataFrame, DataFrame]]:
        """The facts as (lines, the orders they can belong to) such that every order
        has its lines in one part.  Hot orders are fewer than a quarter of the
        buckets (``storage.hot_keys``), so their order rows are broadcast and their
        lines stay where they are; the other lines meet the orders bucket by bucket."""
        if self.split is None:
            return [(self.order_items, self.orders)]
        calm, apart, ids, orders = self.split
        few = orders.join(F.broadcast(ids), F.col("order_id").eqNullSafe(F.col("hot_key")), "left_semi")
        return [(calm, orders), (apart, F.broadcast(few))]

    def over_facts(self, join: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """``join(lines, orders)`` over each part of the facts, the rows together:
        right for joins on the order and for groups that lie within one order."""
        return reduce(DataFrame.unionByName, (join(lines, orders) for lines, orders in self.fact_parts()))

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def replace(self, **changes: DataFrame) -> "RetailModel":
        current = self.tables()
        current.update(changes)
        other = RetailModel(**current)
        other.split = None if {"orders", "order_items"} & set(changes) else self.split
        return other
