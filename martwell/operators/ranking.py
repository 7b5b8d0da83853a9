"""Rankings, running totals and per-group picks (W1-W4, U1, N6, M8 numbering).

A global ``rank() OVER (ORDER BY x)`` without PARTITION BY makes Spark move
every row into one partition.  ``global_rank`` computes the same numbers with
the work spread out:

1. count rows per distinct value (partial aggregation: a value held by a third
   of all rows still leaves each task as one row);
2. write the distinct values in order: range-partitioned (as many ranges as
   the session's shuffle partitions, so the number follows the input's size),
   sorted, one file per range;
3. rows per file -> offsets of the files (one row per file);
4. inside each file, a window over *distinct values* gives the rows above;
5. join the rank of each value back to the rows.

``numbered`` needs no window at all: a row's position is its file's offset and
its place in the file.  Equal values never straddle two ranges, and values
are compared as they are (no cast), so the result equals the single-partition
rank exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwell.functions.exprs import col, month_key
from martwell.operators.reports import lines_with_orders
from martwell.session import ensure_checkpoint_dir, new_scratch_dir
from martwell.sources.model import RetailModel


def _direction(value_col: str, descending: bool) -> Column:
    """Sort order of SQL: NULL first when descending, last when ascending."""
    c = F.col(value_col)
    return c.desc_nulls_first() if descending else c.asc_nulls_last()


def _in_order(df: DataFrame, value_col: str, descending: bool, ranges: int | None) -> DataFrame:
    """``df`` written in order of ``value_col``, one sorted file per range, and
    read again with ``_file`` and ``_index`` (place in the file, from 0)."""
    order = _direction(value_col, descending)
    dealt = df.repartitionByRange(ranges, order) if ranges else df.repartitionByRange(order)
    path = new_scratch_dir(df.sparkSession, "in-order")
    dealt.sortWithinPartitions(order).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")
    )


def _offsets(written: DataFrame, value_col: str, descending: bool, n: Column) -> DataFrame:
    """(_file, _offset): rows in the files before.  One row per file, so
    ordering them in one partition is free."""
    # nulls are passed over by max and min; a file of nothing else is the first
    # (descending) or the last one (ascending)
    edge = F.max(value_col) if descending else F.min(value_col)
    per_file = written.groupBy("_file").agg(edge.alias("_edge"), F.sum(n).alias("_file_n"))
    before = Window.orderBy(_direction("_edge", descending)).rowsBetween(Window.unboundedPreceding, -1)
    return per_file.select("_file", F.coalesce(F.sum("_file_n").over(before), F.lit(0)).alias("_offset"))


def numbered(df: DataFrame, key_col: str, out_col: str, ranges: int | None = None) -> DataFrame:
    """Rows with their position (from 1) in ascending order of a unique key."""
    written = _in_order(df, key_col, False, ranges)
    return (
        written.join(_offsets(written, key_col, False, F.lit(1)), "_file")
        .withColumn(out_col, F.col("_offset") + F.col("_index") + F.lit(1))
        .drop("_file", "_index", "_offset")
    )


def global_rank(
    df: DataFrame, value_col: str, out_col: str = "rank", descending: bool = True, ranges: int | None = None
) -> DataFrame:
    """``rank() over (order by value_col desc nulls first)`` (or ascending,
    nulls last) without a single-partition exchange of the rows.

    The input is read twice (counts, rows), so it is written once to the
    checkpoint folder first: every read sees the same rows and values even if
    recomputing them would not give identical bits (floating-point sums)."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    counts = df.groupBy(value_col).agg(F.count(F.lit(1)).alias("_n"))
    written = _in_order(counts, value_col, descending, ranges)
    in_file = Window.partitionBy("_file").orderBy("_index").rowsBetween(Window.unboundedPreceding, -1)
    above = F.coalesce(F.sum("_n").over(in_file), F.lit(0))
    ranks = written.join(_offsets(written, value_col, descending, F.col("_n")), "_file").select(
        F.col(value_col).alias("_v"), (F.col("_offset") + above + F.lit(1)).alias(out_col)
    )
    return df.join(ranks, df[value_col].eqNullSafe(ranks["_v"]), "inner").drop("_v")


def customer_totals(model: RetailModel) -> DataFrame:
    """Revenue per customer *name* (J4; homonyms merge, as in the source)."""
    per_cust = lines_with_orders(model, ["customer_id"]).groupBy(
        "customer_id"
    ).agg(F.sum("sales").alias("spent"))
    return (
        per_cust.join(model.customers.select("customer_id", "customer_name"), "customer_id")
        .groupBy("customer_name")
        .agg(F.sum("spent").alias("total"))
        .select("customer_name", F.col("total").alias("total_sales"))
    )


def customer_rank_single_partition(model: RetailModel) -> DataFrame:
    """W1 written literally: RANK() OVER (ORDER BY total DESC).  Spark moves
    every row into one partition for it, so this form is kept only as the
    reference the range-split form is tested against."""
    w = Window.orderBy(F.col("total_sales").desc_nulls_first())
    return customer_totals(model).withColumn("sales_rank", F.rank().over(w).cast("long"))


def customer_rank(model: RetailModel, ranges: int | None = None) -> DataFrame:
    """W1 + N6: customers by revenue, ties share a rank, gaps follow."""
    ranked = global_rank(customer_totals(model), "total_sales", "sales_rank", True, ranges)
    return ranked.select("customer_name", "total_sales", F.col("sales_rank").cast("long"))


def top_customers_ranked(model: RetailModel, n: int = 10) -> DataFrame:
    """The n best customers with their global rank.  The rank of a row in
    the top n depends only on rows above it, so ranking the n rows is exact."""
    top = (
        customer_totals(model)
        .orderBy(F.col("total_sales").desc_nulls_first(), F.col("customer_name").asc_nulls_last())
        .limit(n)
    )
    w = Window.orderBy(F.col("total_sales").desc_nulls_first())
    return top.withColumn("sales_rank", F.rank().over(w).cast("long"))


def running_revenue(model: RetailModel) -> DataFrame:
    """Revenue per month and the running total (default RANGE frame).
    One row per month reaches the window, so one partition is fine."""
    j = lines_with_orders(model, ["order_date"])
    monthly = j.groupBy(month_key("order_date").alias("month")).agg(F.sum("sales").alias("m"))
    w = Window.orderBy("month").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select(
        "month",
        F.col("m").alias("monthly_sales"),
        F.sum("m").over(w).alias("cumulative_sales"),
    ).orderBy("month")


def largest_line_per_customer(model: RetailModel) -> DataFrame:
    """Per customer the line with the largest sales (NULL sales first, as
    DESC does), ties to the lowest order id, then the lowest row id.

    ``max_by`` aggregates partially, so each task sends one candidate per
    customer; a customer owning a third of all lines costs nothing extra.
    The struct-valued aggregate is sort-based (each task sorts its own lines
    by customer, spilling if needed): the tie-break key does not fit one
    fixed-width value, and every hash-based alternative (max, then join the
    lines back) would shuffle line rows instead of one row per customer."""
    j = lines_with_orders(model, ["customer_id"])
    numeric_ids = dict(j.dtypes)["order_id"] in ("bigint", "int", "smallint", "tinyint")
    if numeric_ids:
        key = F.struct(
            F.col("sales").isNull(), F.col("sales"), -F.col("order_id"), -F.col("row_id")
        )
        best = j.groupBy("customer_id").agg(F.max_by(F.struct("order_id", "sales"), key).alias("b"))
        return best.select("customer_id", F.col("b.order_id").alias("order_id"), F.col("b.sales").alias("sales"))
    w = Window.partitionBy("customer_id").orderBy(
        F.col("sales").desc_nulls_first(), F.col("order_id").asc_nulls_last(), F.col("row_id").asc_nulls_last()
    )
    return (
        j.withColumn("_rn", F.row_number().over(w))
        .where("_rn = 1")
        .select("customer_id", "order_id", "sales")
    )


def month_calendar(start: Column, stop: Column) -> Column:
    """First days of each month from start to stop (inclusive)."""
    return F.explode(F.sequence(F.trunc(start, "month"), F.trunc(stop, "month"), F.expr("INTERVAL 1 MONTH")))


def calendar_revenue(model: RetailModel) -> DataFrame:
    """U1 over the data: every month between the first and last order, with
    its revenue (0 for a month without sales).  The calendar has one row per
    month of the date span, so it is tiny whatever the data size."""
    bounds = model.orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    months = bounds.select(month_calendar(F.col("lo"), F.col("hi")).alias("month_date"))
    j = lines_with_orders(model, ["order_date"])
    monthly = j.groupBy(F.trunc("order_date", "month").alias("month_date")).agg(F.sum("sales").alias("m"))
    return months.join(monthly, "month_date", "left").select(
        "month_date", F.coalesce(F.col("m"), F.lit(0)).alias("monthly_sales")
    )


def top_n_per_group(
    df: DataFrame, group_cols: list[str], order: list[Column], n: int, out_col: str = "pos"
) -> DataFrame:
    """Top-n rows per group by ``order``.  Spark inserts a partial group limit
    before the shuffle (WindowGroupLimit), so a hot group sends at most n rows
    per task."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(out_col, F.row_number().over(w)).where(col(out_col) <= n)
