"""Warehouse build (S2) and the stored model the reports read.

The source tables are normalised once into the retail model and written:

* dimensions (regions, customers, products) and side tables as Parquet;
* both facts (orders, order_items) bucketed and sorted by ``order_id`` with
  the same bucket count (sized from the line count by ``plan_layout``), so
  the fact join (J1) reads matching buckets with no shuffle (each task only
  sorts its own bucket); the lines of hot orders, if there are any, are kept in a
  folder apart, spread as they come, and meet their few order rows by a broadcast;
* the line fact is shuffled once in the build: hash-partitioned by order
  into the bucket count, which serves the line-position window and the
  bucketed write alike;
* ``order_date`` / ``ship_date`` stored as DATE, so date filters reach the
  Parquet reader, and the customer geography stored on the order, so reports
  do not re-join customer / nation / region.

Written tables also cut the lineage: a lost executor re-reads files instead
of recomputing the whole binding.  A build is reused for the same session and
source folder (the sources are immutable); a new session builds again.
"""

from __future__ import annotations

import math
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwell.session import new_scratch_dir
from martwell.sources import layers
from martwell.sources.model import RetailModel
from martwell.sources.storage import HOT_FACTOR, TableStore, run_parallel
from martwell.sources.testdata import LINE_SLOTS, bind_model, read_raw

_BUILT: dict[tuple[str, str], str] = {}
_BUILD_LOCK = threading.Lock()
FACTS = ("orders", "order_items")

# Rows of the narrow line fact per bucket: a task sorts a bucket in memory, and joins
# of it with whole order rows as well, so it is small while the count of files allows.
ROWS_PER_BUCKET = 500_000
# From this count of buckets on they get larger instead, up to ~128-256 MB of Parquet.
MANY_BUCKETS = 4096
MOST_ROWS_PER_BUCKET = 8_000_000


def buckets_for(n_rows: int) -> int:
    """Buckets for so many line rows, whatever the cluster."""
    small = min(math.ceil(n_rows / ROWS_PER_BUCKET), MANY_BUCKETS)
    return max(small, math.ceil(n_rows / MOST_ROWS_PER_BUCKET), 1)


def plan_layout(items: DataFrame, buckets: int | None = None) -> tuple[int, bool, int]:
    """Bucket count, whether every order fits a bucket, and the largest number of
    lines of one order.

    The count is sized from the line rows, never below the cluster's default
    parallelism.  Bucketing puts every line of an order into one file read
    by one task, and a bucketed scan cannot be split; so the lines of an order
    with more than ``HOT_FACTOR`` times a bucket's share of them are stored apart
    (``TableStore.stage_split``).  All numbers come from one narrow aggregation
    (order id only, combined map-side)."""
    spark = items.sparkSession
    per_order = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    stats = per_order.agg(F.sum("n").alias("rows"), F.max("n").alias("top")).first()
    n_rows, top = int(stats.rows or 0), int(stats.top or 0)
    if buckets is None:
        buckets = max(spark.sparkContext.defaultParallelism, buckets_for(n_rows))
    hot = top > HOT_FACTOR * max(1.0, n_rows / buckets)
    return buckets, not hot, top


def stage_warehouse(
    store: TableStore, model: RetailModel, buckets: int | None = None,
    jobs: int = 4, layout: tuple[int, bool, int] | None = None, prepartitioned: tuple[str, ...] = (),
) -> dict[str, str]:
    """Write every model table as a new, not yet published version (up to
    ``jobs`` tables at a time); returns table -> version reference.
    ``layout`` reuses a ``plan_layout`` result already computed."""
    buckets, bucket_lines, _ = layout or plan_layout(model.order_items, buckets)

    def write(item: tuple[str, DataFrame]) -> str:
        name, df = item
        if name == "order_items" and not bucket_lines:
            hot = store.stage_hot_keys(name, df.select("order_id"), "order_id", buckets)
            return store.stage_split(name, df, "order_id", buckets, hot)
        if name in FACTS:
            return store.stage_bucketed(name, df, "order_id", buckets, prepartitioned=name in prepartitioned)
        return store.stage(name, df, keep_layout=False)

    items = list(model.tables().items())
    return dict(zip([n for n, _ in items], run_parallel(write, items, jobs)))


def staged_model(store: TableStore, refs: dict[str, str]) -> RetailModel:
    model = RetailModel(**{name: store.read_ref(refs[name]) for name in RetailModel.__dataclass_fields__})
    split = layers.split_of(store, refs["order_items"])
    if split:
        # a join that takes the facts as they are shuffles both, so that adaptive
        # execution can split the hot order; beside buckets it could not
        model.split = (*split, model.orders)
        model.orders = store.read_ref(layers.unbucketed(refs["orders"]))
    return model


def build_warehouse(
    spark: SparkSession, model: RetailModel, root: str | None = None, buckets: int | None = None,
    jobs: int = 4,
) -> TableStore:
    """Write every model table (from the test binding or from staging
    normalisation) into a new versioned store and publish them together."""
    store = TableStore(spark, root or new_scratch_dir(spark, "warehouse"))
    store.publish(stage_warehouse(store, model, buckets, jobs))
    return store


def open_store(spark: SparkSession, sf_dir: str) -> TableStore:
    """The warehouse store for ``sf_dir``: built on first use in this session,
    then reused (the sources are immutable)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _BUILD_LOCK:  # callers in several threads build once
        root = _BUILT.get(key)
        if root is None:
            store = TableStore(spark, new_scratch_dir(spark, "warehouse"))
            layout = plan_layout(read_raw(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "order_id"))
            buckets, bucket_lines, top = layout
            # lines arrive hash-partitioned by order into the bucket count, but for
            # orders beyond their slots, which come in ranges
            dealt = bucket_lines and top < LINE_SLOTS
            model = bind_model(spark, sf_dir, buckets if dealt else None, top)
            refs = stage_warehouse(store, model, layout=layout, prepartitioned=("order_items",) if dealt else ())
            store.publish(refs)
            _BUILT[key] = store.root
            return store
    return TableStore(spark, root)


def store_model(store: TableStore) -> RetailModel:
    return staged_model(store, store.current())


def open_warehouse(spark: SparkSession, sf_dir: str) -> RetailModel:
    """The stored model for ``sf_dir`` (see ``open_store``)."""
    return store_model(open_store(spark, sf_dir))
