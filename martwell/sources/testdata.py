"""Bind the driver's TPC-H-style parquet tables onto the retail model.

| model column                        | source                                   |
| ----------------------------------- | ---------------------------------------- |
| regions.region_name                 | region.r_name                            |
| customers.customer_id/name/segment  | c_custkey / c_name / c_mktsegment        |
| products.product_id/name/category/  | p_partkey / p_name / p_type / p_brand     |
|   sub_category                      |                                          |
| orders.order_id/order_date/customer | o_orderkey / date(o_orderdate) / o_custkey|
| orders.ship_date                    | earliest l_shipdate of the order's lines |
| orders.ship_mode                    | o_orderpriority                          |
| orders.country/state/city/postal    | customer's nation and key                 |
| orders.region                       | customer's region name                   |
| order_items.row_id                  | see ``line_key``                         |
| order_items.product_id / sales      | l_partkey / decimal(12,2) extendedprice  |
| product_tags.tags                   | words of p_name                          |
| customer_profiles.profile           | events.user_id / events.props (JSON)     |

Everything here is lazy; Catalyst prunes the columns and joins a query does
not use (the ship-date aggregate is a left join on a unique key and vanishes
from plans that do not read ``ship_date``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwell.operators import ranking
from martwell.session import by_rows
from martwell.sources.model import SALES_TYPE, RetailModel

RAW_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# Line slots per order of the numeric line key.
LINE_SLOTS = 1000
# What tells the lines of an order apart, in order.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer key -> region / country / state / city / postal code.

    nation (25 rows) and region (5 rows) are fixed-size code tables; Spark's
    size check broadcasts them."""
    c = read_raw(spark, sf_dir, "customer")
    n = read_raw(spark, sf_dir, "nation")
    r = read_raw(spark, sf_dir, "region")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "inner")
        .join(r, n.n_regionkey == r.r_regionkey, "inner")
        .select(
            F.col("c_custkey").alias("geo_custkey"),
            F.col("n_name").alias("country"),
            F.concat(F.col("n_name"), F.lit("#"), (F.col("c_custkey") % 10).cast("string")).alias("city"),
            F.col("n_name").alias("state"),
            F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("postal_code"),
            F.col("r_name").alias("region"),
        )
    )


def bind_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_raw(spark, sf_dir, "orders")
    li = read_raw(spark, sf_dir, "lineitem")
    # Partial aggregation runs map-side; one row per order crosses the shuffle.
    first_ship = li.groupBy(F.col("l_orderkey").alias("ship_orderkey")).agg(
        F.min("l_shipdate").alias("first_ship_ts")
    )
    geo = customer_geography(spark, sf_dir)
    return (
        o.join(first_ship, o.o_orderkey == first_ship.ship_orderkey, "left")
        .join(geo, o.o_custkey == geo.geo_custkey, "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.to_date("first_ship_ts").alias("ship_date"),
            F.col("o_orderpriority").alias("ship_mode"),
            F.col("o_custkey").alias("customer_id"),
            "country",
            "city",
            "state",
            "postal_code",
            "region",
        )
    )


def most_lines(spark: SparkSession, sf_dir: str) -> int:
    """Lines of the largest order (combined map-side, one column read)."""
    per_order = read_raw(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per_order.agg(F.max("n")).first()[0] or 0


def line_key(pos: Column, place: Column) -> Column:
    """Numeric key of the line at ``pos`` (from 1) of its order: order key *
    ``LINE_SLOTS`` + pos.  Lines beyond the slots have the negative of their
    ``place`` among all lines of orders that outgrow their slots, so such an
    order changes the key of no line of an order that doesn't."""
    return F.when(pos < LINE_SLOTS, F.col("l_orderkey").cast("long") * F.lit(LINE_SLOTS) + pos).otherwise(-place)


def _long_order_lines(lines: DataFrame) -> DataFrame:
    """Lines of the long orders with ``pos`` and ``place``.  They are numbered in
    sorted ranges, all orders together, so one order of a third of all rows is
    spread over many tasks; an order's least place (combined map-side) turns
    places into positions."""
    identity = F.struct("l_orderkey", *LINE_ORDER, "source_file", "source_row")
    placed = ranking.numbered(lines.select(identity.alias("line")), "line", "place")
    first = placed.groupBy(F.col("line.l_orderkey").alias("long_order")).agg(F.min("place").alias("first_place"))
    return (
        placed.join(first, F.col("line.l_orderkey") == F.col("long_order"))
        .select("line.l_orderkey", "line.l_partkey", "line.l_extendedprice", "place",
                (F.col("place") - F.col("first_place") + 1).alias("pos"))
    )


def bind_order_items(
    spark: SparkSession, sf_dir: str, partitions: int | None = None, most: int | None = None
) -> DataFrame:
    """``most``: lines of the largest order (measured when not given).

    ``partitions``: hash-partition the lines by order key into exactly
    that many partitions first.  The position window then needs no shuffle of
    its own, and a bucketed write with as many buckets finds every bucket's
    rows in one task -- one shuffle of the largest table instead of two.  Only
    for orders that all fit their slots.

    Orders of ``LINE_SLOTS`` lines and more go by ``_long_order_lines``, so no
    window holds more lines than that."""
    most = most_lines(spark, sf_dir) if most is None else most
    raw = read_raw(spark, sf_dir, "lineitem")
    li = raw.repartition(partitions, "l_orderkey") if partitions else raw
    if most >= LINE_SLOTS:
        per_order = raw.groupBy(F.col("l_orderkey").alias("long_order")).agg(F.count(F.lit(1)).alias("n"))
        long_orders = per_order.where(F.col("n") >= LINE_SLOTS).select("long_order")
        is_long = F.col("l_orderkey") == F.col("long_order")
        li = li.join(long_orders, is_long, "left_anti")
    # Position of the line inside its order under a total order of the line
    # identity.  The window is partitioned by the order key, the same key the
    # fact join shuffles on, so Spark reuses that partitioning.
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    lines = li.select("l_orderkey", "l_partkey", "l_extendedprice", F.lit(0).cast("long").alias("place"), pos.alias("pos"))
    if most >= LINE_SLOTS:
        # equal lines are told apart by where they stand in the source, so that they can be cut as well
        told_apart = raw.select(
            "*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("source_row")
        )
        lines = lines.unionByName(_long_order_lines(told_apart.join(long_orders, is_long, "left_semi")))
    return lines.select(
        line_key(F.col("pos"), F.col("place")).alias("row_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast(SALES_TYPE).alias("sales"),
    )


def bind_model(
    spark: SparkSession, sf_dir: str, fact_partitions: int | None = None, most: int | None = None
) -> RetailModel:
    region = read_raw(spark, sf_dir, "region")
    customer = read_raw(spark, sf_dir, "customer")
    part = read_raw(spark, sf_dir, "part")
    events = read_raw(spark, sf_dir, "events")
    return RetailModel(
        regions=region.select(F.col("r_name").alias("region_name")),
        customers=customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
        ),
        products=part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
        ),
        orders=bind_orders(spark, sf_dir),
        order_items=bind_order_items(spark, sf_dir, fact_partitions, most),
        product_tags=part.select(
            F.col("p_partkey").alias("product_id"),
            F.split(F.col("p_name"), " ").alias("tags"),
        ),
        customer_profiles=events.select(
            F.col("user_id").alias("customer_id"),
            F.col("props").alias("profile"),
        ),
    )


def staging_frame(model: RetailModel) -> DataFrame:
    """Flat staging rows (all text except row_id and sales) built from the
    model, with dates rendered as d/M/yyyy text like the source files."""
    from martwell.sources.model import STAGING_SCHEMA

    # customers are joined to the ids of orders, and products to the narrow lines,
    # first; the lines then meet their orders on the fact key, and what comes out,
    # many times as wide, is shuffled no more
    buyers = model.orders.select(F.col("order_id").alias("bought_in"), "customer_id").distinct().join(
        by_rows(model.customers), "customer_id"
    ).withColumnRenamed("customer_id", "buyer")
    # an equality of the customers would be a key of the join, and the orders, which
    # lie in buckets of the order alone, would be shuffled for it
    theirs = (F.col("customer_id") >= F.col("buyer")) & (F.col("customer_id") <= F.col("buyer"))
    oc = model.orders.join(buyers, (F.col("order_id") == F.col("bought_in")) & theirs, "left").drop("bought_in", "buyer")
    lines = model.order_items.join(by_rows(model.products), "product_id", "left")
    j = lines.join(oc, "order_id", "left")
    as_text = lambda col: F.col(col).cast("string")
    return j.select(
        F.col("row_id").cast("long").alias("row_id"),
        as_text("order_id").alias("order_id"),
        F.date_format("order_date", "d/M/yyyy").alias("order_date"),
        F.date_format("ship_date", "d/M/yyyy").alias("ship_date"),
        "ship_mode",
        as_text("customer_id").alias("customer_id"),
        "customer_name",
        "segment",
        "country",
        "city",
        "state",
        "postal_code",
        "region",
        as_text("product_id").alias("product_id"),
        "category",
        "sub_category",
        "product_name",
        F.col("sales").cast(STAGING_SCHEMA["sales"].dataType).alias("sales"),
    )
