"""Table storage: versions, partitioned and bucketed layouts, snapshots.

Everything is written and read by Spark itself (Parquet / JSON datasets), so
it works on any Hadoop-compatible shared file system the cluster uses.

Versions (N5).  A table's data lives in ``<root>/tables/<name>/<version>/``
and is never overwritten.  Which version is current is recorded in a manifest
dataset ``<root>/_manifest/seq=<n>/`` (one row per table); publishing writes it
aside and renames it to the next sequence number, so a commit is all-or-nothing
for every table it names.  The first rename to a number takes it for good (an
atomic rename of folders, as HDFS and local disks have); any other writer gets
``Conflict`` and publishes nothing.  Readers take the highest sequence (found by
listing, without reading older manifests).  A crash before publish leaves unused
folders and no visible change.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from martwell.operators.quality import enforce, range_partition

# Separator of the batch folders of an append-only table in a manifest row.
PATH_SEP = "|"
# Manifest prefix of a bucketed version: "bucketed:<n>:<key>:<path>".
BUCKETED_REF = "bucketed:"
# Manifest prefix of a table in layers (``martwell.sources.layers``).
LAYERED_REF = "layers:"
# Prefix of a snapshot's layout note for a table whose hot keys are kept apart.
APART_LAYOUT = "apart:"
# A key whose rows exceed this many times a bucket's fair share is "hot".
HOT_FACTOR = 4.0
# Codec of the store's Parquet files: smaller files than the default's.
COMPRESSION = "zstd"


def base_ref(ref: str) -> str:
    """The base's reference of a table in layers, else the reference itself."""
    return json.loads(ref[len(LAYERED_REF):]).get("base", "") if ref.startswith(LAYERED_REF) else ref


def hot_ref(ref: str) -> str | None:
    """Where the hot keys of a table that keeps their rows apart are stored."""
    return json.loads(ref[len(LAYERED_REF):]).get("hot") if ref.startswith(LAYERED_REF) else None



def _catalog_name(path: str) -> str:
    """Session catalog name of a bucketed version (bucket specs live in the
    catalog, so a bucketed read goes through a table)."""
    return "mw_" + hashlib.sha1(path.encode()).hexdigest()[:16]


MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("writer", T.StringType()),
    ]
)
MANIFEST_READ_SCHEMA = T.StructType(MANIFEST_SCHEMA.fields + [T.StructField("seq", T.LongType())])
_SEQ = re.compile(r"/seq=(\d+)/")
_TS = re.compile(r"/ts=(\d+)/")


class Conflict(RuntimeError):
    """Another writer published a table that this commit was computed from, or
    the commit that this one was about to be."""


def preview_of(df: DataFrame, n: int, order_by: str | None) -> DataFrame:
    if not 10 <= int(n) <= 1000:
        raise ValueError("a preview has 10 to 1000 rows")
    return (df.orderBy(F.col(order_by).asc_nulls_last()) if order_by else df).limit(n)


class TableStore:
    """Versioned warehouse tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- manifest ----------------------------------------------------------------------

    def _latest_seq(self) -> int:
        """Highest committed sequence number, from the file listing only
        (no manifest data is read; folders still being written hold only
        hidden temporary files and are not listed)."""
        try:
            files = self.spark.read.schema(MANIFEST_READ_SCHEMA).json(f"{self.root}/_manifest").inputFiles()
        except AnalysisException:
            return 0
        seqs = [int(m.group(1)) for m in (_SEQ.search(f) for f in files) if m]
        return max(seqs, default=0)

    def refresh(self) -> tuple[int, dict[str, str]]:
        """Read the newest published manifest (one row per table) into this
        handle.  Readers keep that snapshot until they refresh or publish, so
        a report sees one consistent set of table versions.  (A number that
        holds the rows of two writers, from before numbers were taken by
        rename, reads as the one with the smaller token.)"""
        seq, cur, token = self._latest_seq(), {}, None
        if seq:
            rows = self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.root}/_manifest/seq={seq}").collect()
            if rows:
                token = min(r.writer for r in rows)
                cur = {r.table_name: r.path for r in rows if r.writer == token}
        self._state = (seq, cur)
        self._winner = token
        return self._state

    def current(self) -> dict[str, str]:
        """table -> data path of this handle's manifest snapshot."""
        state = getattr(self, "_state", None) or self.refresh()
        return dict(state[1])

    def publish(self, paths: dict[str, str], expected: dict[str, str] | None = None) -> int:
        """Make new versions current together (one manifest commit).

        ``expected``: the references that the new versions were computed from
        (a snapshot of ``current()``).  If a published table has another one
        by now, or another writer takes the next number first, ``Conflict`` is
        raised, nothing is published and this handle keeps its snapshot; the
        caller refreshes and computes anew."""
        held = getattr(self, "_state", None)
        seq, cur = self.refresh()
        moved = [] if expected is None else sorted(t for t in paths if cur.get(t) != expected.get(t))
        if moved:
            self._state = held or (seq, expected)
            raise Conflict(f"changed by another writer meanwhile: {', '.join(moved)}")
        if not self._take(seq + 1, {**cur, **paths}):
            self._state = held or (seq, cur)
            raise Conflict(f"another writer published commit {seq + 1} meanwhile")
        self.refresh()
        return seq + 1

    def _take(self, seq: int, refs: dict[str, str]) -> bool:
        """Make ``refs`` the manifest ``seq``; False if the number is taken.

        A rename onto a folder that is there fails or ends inside of it, below a
        name that readers skip, so a number that is taken never changes."""
        token = uuid.uuid4().hex
        staged, final = f"{self.root}/_manifest/_new-{token}", f"{self.root}/_manifest/seq={seq}"
        rows = [(k, v, token) for k, v in sorted(refs.items())]
        self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("errorifexists").json(staged)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(staged).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if fs.exists(path(final)):
            return False
        return bool(fs.rename(path(staged), path(final))) and self._winner_of(seq) == token

    def _winner_of(self, seq: int) -> str | None:
        rows = self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.root}/_manifest/seq={seq}").collect()
        return min((r.writer for r in rows), default=None)

    # -- data ------------------------------------------------------------------------

    def _new_path(self, name: str) -> str:
        return f"{self.root}/tables/{name}/{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"

    def stage(self, name: str, df: DataFrame, partition_by: list[str] | None = None, keep_layout: bool = True) -> str:
        """Write a new, not yet visible version of ``name``; returns its path.
        A table that is bucketed now stays bucketed the same way, so later
        joins keep their shuffle-free plan."""
        now = self.current().get(name, "") if keep_layout else ""
        ref = base_ref(now)
        if ref.startswith(BUCKETED_REF) and not partition_by:
            n, key, _ = ref[len(BUCKETED_REF):].split(":", 2)
            hot = hot_ref(now)
            return self.stage_split(name, df, key, int(n), hot) if hot else self.stage_bucketed(name, df, key, int(n))
        path = self._new_path(name)
        w = df.write.mode("errorifexists").option("compression", COMPRESSION)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return path

    def stage_bucketed(
        self, name: str, df: DataFrame, key: str, buckets: int, prepartitioned: bool = False
    ) -> str:
        """Write a new version bucketed and sorted by ``key`` (S8).  Rows are
        hash-partitioned into exactly ``buckets`` partitions first (the same
        hash as bucketing), so each task writes one file; ``prepartitioned``
        says the caller already did that on the same key.  The manifest entry
        records the bucket spec, so any session can register the table again."""
        path = self._new_path(name)
        if not prepartitioned:
            df = df.repartition(buckets, key)
        (
            df.write.mode("errorifexists")
            .option("path", path)
            .option("compression", COMPRESSION)
            .bucketBy(buckets, key)
            .sortBy(key)
            .saveAsTable(_catalog_name(path))
        )
        return f"{BUCKETED_REF}{buckets}:{key}:{path}"

    def stage_hot_keys(self, name: str, df: DataFrame, key: str, buckets: int) -> str:
        """Write the hot keys of ``df`` (``hot_keys``) aside; returns their path."""
        return self.stage_apart(f"{name}_hot", hot_keys(df, key, buckets).coalesce(1))

    def stage_split(self, name: str, df: DataFrame, key: str, buckets: int, hot: str) -> str:
        """Write a new version bucketed by ``key``, but for the rows of the hot keys
        stored at ``hot``: those are dealt evenly into a folder of their own, so that no bucket holds a
        hot key and no task all of its rows."""
        is_hot = F.col(key).eqNullSafe(F.col("hot_key"))
        ids = F.broadcast(self.spark.read.parquet(hot))  # fewer than buckets / HOT_FACTOR rows
        base = self.stage_bucketed(name, df.join(ids, is_hot, "left_anti"), key, buckets)
        apart = self.stage_apart(f"{name}_apart", df.join(ids, is_hot, "left_semi").hint("rebalance"))
        return LAYERED_REF + json.dumps({"apart": apart, "base": base, "hot": hot}, sort_keys=True)

    def clone(self, root: str) -> "TableStore":
        """A branch at ``root`` that starts from this store's current tables.
        Only the manifest is written: versions are immutable, so the branch
        shares their files until it publishes versions of its own."""
        branch = TableStore(self.spark, root)
        branch.publish(self.current())
        return branch

    def write(
        self, name: str, df: DataFrame, partition_by: list[str] | None = None, expected: dict[str, str] | None = None
    ) -> str:
        """Write and publish one table, computed from ``expected`` (this handle's
        snapshot, which its reads see, if not given); ``Conflict`` as in ``publish``."""
        seen = self.current() if expected is None else expected
        path = self.stage(name, df, partition_by)
        self.publish({name: path}, expected=seen)
        return path

    def write_all(self, tables: dict[str, DataFrame], expected: dict[str, str] | None = None) -> int:
        """Write several tables and publish them in one commit (M4); ``expected``
        as in ``write``."""
        seen = self.current() if expected is None else expected
        paths = {name: self.stage(name, df) for name, df in tables.items()}
        return self.publish(paths, expected=seen)

    def stage_apart(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write rows that are a layer of a table (a batch, a log's rows, bounds)
        in a folder of their own; returns its path."""
        return self.stage(name, df, partition_by, keep_layout=False)

    def read(self, name: str) -> DataFrame:
        cur = self.current()
        if name not in cur:
            raise KeyError(f"no table {name!r}")
        return self.read_ref(cur[name])

    def read_ref(self, ref: str) -> DataFrame:
        """Read a version by its reference (published or only staged)."""
        if ref.startswith(LAYERED_REF):
            from martwell.sources.layers import read_layers

            return read_layers(self, ref)
        if ref.startswith(BUCKETED_REF):
            n, key, path = ref[len(BUCKETED_REF):].split(":", 2)
            table = _catalog_name(path)
            if not self.spark.catalog.tableExists(table):
                schema = self.spark.read.parquet(path).schema
                cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
                self.spark.sql(
                    f"CREATE TABLE {table} ({cols}) USING parquet CLUSTERED BY (`{key}`) "
                    f"SORTED BY (`{key}`) INTO {int(n)} BUCKETS LOCATION '{path}'"
                )
            return self.spark.table(table)
        return self.spark.read.parquet(*ref.split(PATH_SEP))

    def list_tables(self) -> list[str]:
        """Table names, sorted."""
        return sorted(self.current())

    def preview(self, name: str, n: int = 100, order_by: str | None = None) -> DataFrame:
        """``n`` (10..1000) rows of a listed table.  With ``order_by``
        the first n by that column (a top-k: each task keeps n rows, so the
        table size does not matter); otherwise any n rows."""
        if name not in self.current():
            raise KeyError(f"no table {name!r}")
        return preview_of(self.read(name), n, order_by)

    def refresh_view(self, name: str, definition: DataFrame) -> str:
        """M9: recompute a stored result and publish it; readers see the old
        contents until the publish."""
        return self.write(name, definition)

    def inventory(self) -> DataFrame:
        """S11 + S6: every table with its row count (one union job)."""
        out = None
        for name in self.list_tables():
            row = self.read(name).agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), "n_rows"
            )
            out = row if out is None else out.unionByName(row)
        return out


# ---- range-partitioned orders (S7) -----------------------------------------------------


def write_year_partitioned(
    orders: DataFrame, path: str, bounds: list[tuple[str, date, date]], strict: bool = True
) -> tuple[str, DataFrame]:
    """Orders in declared half-open year ranges, one folder per range
    (``order_year=<name>``).  A row outside every range refuses the whole
    write (as inserting into a range-partitioned table does); without
    ``strict`` such rows are not written but returned (lazily) for Q4.

    No shuffle: a year holds a large share of all rows, so funnelling it
    into one task would be a hot spot.  Each task sorts its own rows by
    (year, date) and writes one file per year it holds, with tight min/max
    date statistics for later filters."""
    tagged = orders.withColumn("order_year", range_partition("order_date", bounds))
    outside = tagged.where(F.col("order_year").isNull()).drop("order_year")
    if strict:
        enforce(outside, "row outside every declared range")
    valid = tagged.where(F.col("order_year").isNotNull())
    valid.sortWithinPartitions("order_year", "order_date").write.mode("errorifexists").partitionBy(
        "order_year"
    ).parquet(path)
    return path, outside


def read_years(spark: SparkSession, path: str, years: list[str] | None = None) -> DataFrame:
    """Read the partitioned orders; a year filter prunes folders."""
    df = spark.read.parquet(path)
    if years:
        df = df.where(F.col("order_year").isin([int(y) for y in years]))
    return df


def year_ranges(orders: DataFrame) -> list[tuple[str, date, date]]:
    """Calendar-year ranges over the whole span of the orders' dates."""
    lo, hi = orders.agg(F.min("order_date"), F.max("order_date")).first()
    return [] if lo is None else [(str(y), date(y, 1, 1), date(y + 1, 1, 1)) for y in range(lo.year, hi.year + 1)]


def read_date_range(
    spark: SparkSession, path: str, lo: date, hi: date, bounds: list[tuple[str, date, date]]
) -> DataFrame:
    """Orders with ``lo <= order_date < hi`` from the table partitioned by
    ``bounds``.  A date filter alone prunes no folders, so a filter on the
    ranges that overlap is added: only their folders are read, and the date
    filter still reaches the Parquet reader inside them."""
    touched = [int(name) for name, start, end in bounds if start < hi and lo < end]
    return spark.read.parquet(path).where(F.col("order_year").isin(touched)).where(
        (F.col("order_date") >= F.lit(lo)) & (F.col("order_date") < F.lit(hi))
    )


# ---- bucketed facts (S8) -----------------------------------------------------------------


def hot_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """(hot_key): keys with more than ``HOT_FACTOR`` times a bucket's fair share of
    the rows (a missing key counts as one).  There are fewer than ``buckets /
    HOT_FACTOR`` of them, whatever the data."""
    per_key = df.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    share = per_key.agg(F.sum("n")).scalar() / F.lit(buckets)
    return per_key.where(F.col("n") > F.lit(HOT_FACTOR) * F.greatest(F.lit(1.0), share)).select("hot_key")


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table bucketed and sorted by ``key`` at ``path``; two tables
    bucketed alike on the join key join without a shuffle.  At scale choose
    ``buckets`` so one bucket file is ~128-512 MB.  The rows are first
    hash-partitioned on the key into ``buckets`` partitions (the same hash as
    bucketing), so each task writes one file instead of one per bucket."""
    (
        df.repartition(buckets, key)
        .write.mode("errorifexists")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    written = df.sparkSession.table(table)  # keeps the bucket spec; the name is not needed any more
    df.sparkSession.sql(f"DROP TABLE `{table}`")
    return written


# ---- snapshot and restore (S9, S10) --------------------------------------------------------


def content_hash(df: DataFrame) -> DataFrame:
    """Rows and an order-free content hash (sum of per-row 64-bit hashes as an
    exact decimal; equal rows add up instead of cancelling)."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    row_hash = F.xxhash64(F.to_json(row, {"ignoreNullFields": "false"}))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(row_hash.cast("decimal(38,0)")).cast("string").alias("content_hash"),
    )


def run_parallel(fn, items, jobs: int):
    """Run one Spark job per item from up to ``jobs`` driver threads (the
    scheduler runs them side by side; each job is still spread over the
    cluster).  Results keep the order of ``items``."""
    with ThreadPoolExecutor(max_workers=max(1, jobs)) as pool:
        return list(pool.map(fn, items))


SNAPSHOT_SCHEMA = "table_name string, n_rows long, schema_json string, content_hash string, layout string"


def _layout_of(ref: str) -> str:
    """'<n>:<key>' for a bucketed version reference ('apart:<n>:<key>' if the rows of
    its hot keys are kept apart), '' otherwise."""
    base = base_ref(ref)
    if base.startswith(BUCKETED_REF):
        n, key, _ = base[len(BUCKETED_REF):].split(":", 2)
        return f"{APART_LAYOUT if hot_ref(ref) else ''}{n}:{key}"
    return ""


def snapshot(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    ts: str | None = None,
    jobs: int = 4,
    layouts: dict[str, str] | None = None,
) -> str:
    """Copy every table to ``<root>/ts=<ts>/<table>`` and record a
    manifest (table, rows, schema, content hash, bucket layout) of the source
    tables; a copy that differs from its source stops the snapshot.  Up to ``jobs`` tables are copied at the same time.
    ``layouts`` (table -> store reference) records which tables are bucketed,
    so a restore lays them out the same way."""
    ts = ts or time.strftime("%Y%m%d%H%M%S") + f"{int(time.time() * 1000) % 1000:03d}"
    base = f"{root.rstrip('/')}/ts={ts}"
    layouts = layouts or {}

    def copy(item):
        name, df = item
        df.write.mode("errorifexists").parquet(f"{base}/{name}")
        written = spark.read.parquet(f"{base}/{name}")
        h = content_hash(df).first()
        if content_hash(written).first() != h:
            raise RuntimeError(f"the copy of {name} differs from its source")
        layout = _layout_of(layouts.get(name, ""))
        return (name, int(h.n_rows), written.schema.json(), h.content_hash or "0", layout)

    rows = run_parallel(copy, list(tables.items()), jobs)
    spark.createDataFrame(rows, SNAPSHOT_SCHEMA).coalesce(1).write.mode("errorifexists").json(
        f"{root.rstrip('/')}/_snapshots/ts={ts}"
    )
    return ts


def snapshot_store(store: TableStore, root: str, ts: str | None = None, jobs: int = 4) -> str:
    """S9 of a whole store: every current table, with its layout."""
    cur = store.current()
    return snapshot(store.spark, {t: store.read(t) for t in sorted(cur)}, root, ts, jobs, layouts=cur)


def latest_snapshot(spark: SparkSession, root: str) -> str:
    """Newest snapshot stamp, from the listing of the snapshot manifests."""
    files = spark.read.json(f"{root.rstrip('/')}/_snapshots").inputFiles()
    return max(m.group(1) for m in (_TS.search(f) for f in files) if m)


def restore(spark: SparkSession, root: str, target: TableStore, ts: str | None = None, jobs: int = 4) -> DataFrame:
    """Load the newest (or given) snapshot into ``target`` -- each table
    a new version, up to ``jobs`` at a time, published in one commit -- and
    verify rows and content hash against the snapshot manifest.  Returns
    (table_name, n_rows, restored_equal)."""
    ts = ts or latest_snapshot(spark, root)
    manifest = (
        spark.read.schema(SNAPSHOT_SCHEMA).json(f"{root.rstrip('/')}/_snapshots/ts={ts}").collect()
    )  # one row per table

    def load(m):
        schema = T.StructType.fromJson(json.loads(m.schema_json))
        df = spark.read.schema(schema).parquet(f"{root}/ts={ts}/{m.table_name}")
        if m.layout:
            n, key = m.layout.removeprefix(APART_LAYOUT).split(":", 1)
            if m.layout.startswith(APART_LAYOUT):
                hot = target.stage_hot_keys(m.table_name, df, key, int(n))
                return target.stage_split(m.table_name, df, key, int(n), hot)
            return target.stage_bucketed(m.table_name, df, key, int(n))
        return target.stage(m.table_name, df, keep_layout=False)

    paths = dict(zip([m.table_name for m in manifest], run_parallel(load, manifest, jobs)))
    target.publish(paths)

    def verify(m):
        h = content_hash(target.read(m.table_name)).first()
        equal = int(h.n_rows) == int(m.n_rows) and (h.content_hash or "0") == m.content_hash
        return (m.table_name, int(h.n_rows), bool(equal))

    out = run_parallel(verify, manifest, jobs)
    return spark.createDataFrame(out, "table_name string, n_rows long, restored_equal boolean")
