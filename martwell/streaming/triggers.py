"""Row triggers as Structured Streaming queries.

Both are stateless: each micro-batch is filtered / projected with the same
column functions as the batch operators, and appended to a file sink.  The
file sink plus checkpoint gives exactly-once output; a lost executor only
re-runs its tasks.  ``run_audit_log_stream`` instead appends each micro-batch
to the versioned audit log with ids (M8) numbered after the highest existing
one; a replayed micro-batch is recognised by its epoch and skipped.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martwell.operators import maintenance
from martwell.operators.audit import audit_rows, repaired_ship_date
from martwell.sources.layers import log_state
from martwell.sources.storage import Conflict, TableStore

CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("old_sales", T.DecimalType(12, 2)),
        T.StructField("sales", T.DecimalType(12, 2)),
    ]
)
LINE_SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("sales", T.DecimalType(12, 2))])


def audit_stream(changes: DataFrame) -> DataFrame:
    """The T1 filter on a stream of (row_id, old_sales, sales) changes."""
    return audit_rows(changes)


def ship_repair_stream(orders: DataFrame) -> DataFrame:
    """T4: the T2 projection on a stream of written order rows."""
    return orders.withColumn("ship_date", repaired_ship_date())


def run_file_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    transform,
    sink_dir: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Read parquet files arriving in ``source_dir``, apply ``transform`` and
    append to parquet files in ``sink_dir``; processes what is there now
    (``availableNow``) and stops.  Restarting with the same checkpoint skips
    files already done."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    out = transform(reader.load(source_dir))
    q = (
        out.writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def changes_frame(items_changes: DataFrame) -> DataFrame:
    """Shape a batch change frame as the stream's change rows."""
    return items_changes.select(
        F.col("row_id").cast("long"), F.col("old_sales"), F.col("sales")
    )


def _once(store: TableStore, log: str, stream: str, epoch: int, commit) -> bool:
    """Run ``commit`` unless the log has the stream's epoch; again from the new
    snapshot if another writer was first.  Returns whether it was committed."""
    while True:
        store.refresh()
        if epoch <= log_state(store, log)[1].get(stream, -1):
            return False
        try:
            commit()
            return True
        except Conflict:
            continue  # number the batch after what the other writer logged


def commit_audit_batch(store: TableStore, changes: DataFrame, epoch_id: int, stream: str, log: str = "sales_audit") -> bool:
    """T1 + M7 + M8 for one micro-batch: keep the real changes, number them after
    the highest audit id and append them to the audit log in one manifest commit.
    ``foreachBatch`` may replay a batch after a failure; the log keeps the last
    epoch of every stream (epochs come in order), and a replayed epoch is skipped,
    so every change is logged exactly once.  Returns whether rows were committed."""
    return _once(store, log, stream, epoch_id, lambda: maintenance.commit_audit(store, changes, stream, epoch_id, log))


def commit_line_batch(store: TableStore, written: DataFrame, epoch_id: int, stream: str, log: str = "sales_audit") -> bool:
    """T3 with OLD: one micro-batch of written lines (row_id, sales).  The old
    amounts are fetched from the stored lines, and the new amounts and the audit
    rows are published in one commit, exactly once.  A line that is written
    several times in a batch gets its greatest amount; an unknown line changes
    nothing, as an UPDATE that finds no row."""

    def commit():
        new = written.groupBy("row_id").agg(F.max("sales").alias("sales"))
        old = store.read("order_items").select("row_id", F.col("sales").alias("old_sales"))
        maintenance.commit_line_update(store, old.join(new, "row_id"), audit_log=log, stream=stream, epoch=epoch_id)

    return _once(store, log, stream, epoch_id, commit)


def query_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """Id of the streaming query that a checkpoint folder belongs to."""
    return json.loads(spark.read.text(f"{checkpoint_dir.rstrip('/')}/metadata").first()[0])["id"]


def run_audit_log_stream(
    spark: SparkSession,
    source_dir: str,
    store: TableStore,
    checkpoint_dir: str,
    stream: str = "audit",
    max_files_per_trigger: int | None = None,
    schema: T.StructType = CHANGE_SCHEMA,
    commit=commit_audit_batch,
) -> StreamingQuery:
    """T3 into the versioned store: change files -> real changes -> numbered,
    appended audit batches (exactly once per micro-batch, see
    ``commit_audit_batch``).  A batch is known by the query id of its
    checkpoint and its epoch, so a stream with a new checkpoint, whose epochs
    start at 0 again, logs all its changes.  With ``LINE_SCHEMA`` and
    ``commit_line_batch`` the files hold written lines, whose old amounts come
    from the store."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (
        reader.load(source_dir)
        .writeStream.foreachBatch(
            lambda df, epoch: commit(store, df, epoch, f"{stream}-{query_id(spark, checkpoint_dir)}")
        )
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
