"""Tables in layers: a stored base, rows inserted since, and changes by key.

A one-row update (M5, M1, M6) writes one small batch of new values and leaves
the base as it is; a read takes, for each key, the values of the newest batch
that has it.  That is a left join of the base with the batches: small batches
are broadcast (by Spark's size check), so the base is neither shuffled nor loses
its buckets, and large ones are joined by key like any table.  ``fold`` writes
the layers into a new base.

Inserted rows (S3) and the batches of an append-only log (M7) are folders beside
the base.  When ``MERGE`` folders of one size class have come together they are
written as one of the next class, so a table has few folders however many
commits it has seen, and a row is rewritten once per class.

A bucketed table with hot keys (S8) keeps their rows in a folder apart, so that no
bucket holds a hot key; the hot keys are a small dataset of their own.

A log keeps its highest id and, for streams, the last epoch of each query, so
neither is looked up in its rows.  A table in ranges (S7) keeps the declared
bounds as a dataset of its own, which routes later inserts and prunes reads.

What a table consists of is one reference in the store's manifest; the data are
Parquet folders that Spark writes and reads.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martwell.operators.quality import ConstraintViolation, enforce, insert_violations, range_partition
from martwell.sources.storage import BUCKETED_REF, LAYERED_REF, PATH_SEP, TableStore

#: Folders of one size class, or change batches, that are merged into one.
MERGE = 8
RANGE_COLUMN = "order_year"


def parts_of(ref: str | None) -> dict:
    """What a reference says; a plain one is a base without layers.  Folders of
    rows come as pairs of path and size class."""
    if ref is None:
        return {}
    if not ref.startswith(LAYERED_REF):
        return {"inserts": [[p, 0] for p in ref.split(PATH_SEP)]} if PATH_SEP in ref else {"base": ref}
    parts = json.loads(ref[len(LAYERED_REF):])
    if "rows" in parts:
        parts["inserts"] = [[p, c] for p, c in zip(parts.pop("rows").split(PATH_SEP), parts.pop("classes"))]
    return parts


def ref_of(parts: dict) -> str:
    told = {k: v for k, v in parts.items() if k != "inserts" and v not in (None, [], {})}
    if parts.get("inserts"):
        told |= {"rows": PATH_SEP.join(p for p, _ in parts["inserts"]), "classes": [c for _, c in parts["inserts"]]}
    return LAYERED_REF + json.dumps(told, sort_keys=True)


# ---- reading -----------------------------------------------------------------------------


def _newest(store: TableStore, parts: dict) -> DataFrame:
    """(key, _new: the values of the newest batch that has the key)."""
    key, columns = parts["key"], parts["columns"]
    out = None
    for at, path in enumerate(parts["changes"]):
        rows = store.spark.read.parquet(path).select(key, F.struct(*columns).alias("_new"), F.lit(at).alias("_at"))
        out = rows if out is None else out.unionByName(rows)
    if len(parts["changes"]) == 1:  # a batch has a key once
        return out.drop("_at")
    return out.groupBy(key).agg(F.max_by("_new", "_at").alias("_new"))


def _base_rows(store: TableStore, parts: dict) -> DataFrame | None:
    rows = store.read_ref(parts["base"]) if "base" in parts else None
    return rows.unionByName(store.read_ref(parts["apart"])) if "apart" in parts else rows


def read_layers(store: TableStore, ref: str) -> DataFrame:
    """The rows of a layered table."""
    parts = parts_of(ref)
    rows = _base_rows(store, parts)
    rows = rows.drop(*parts.get("hidden", [])) if rows is not None else None  # the base alone has them
    inserts = [p for p, _ in parts.get("inserts", [])]
    if inserts and "bounds" not in parts:
        added = store.spark.read.parquet(*inserts)
        rows = added if rows is None else rows.unionByName(added)
    else:  # partitioned folders are read one by one
        for path in inserts:
            added = store.spark.read.parquet(path)
            rows = added if rows is None else rows.unionByName(added)
    return _changed(store, parts, rows)


def split_of(store: TableStore, ref: str) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(rows of all other keys, rows of the hot keys, the hot keys) of a table that
    keeps them apart; None for any other table, and while rows have been inserted
    beside the base, as those may be of any key (``fold`` deals them out)."""
    parts = parts_of(ref)
    if "apart" not in parts or parts.get("inserts"):
        return None
    hidden = parts.get("hidden", [])
    calm, apart = (_changed(store, parts, store.read_ref(parts[p]).drop(*hidden)) for p in ("base", "apart"))
    return calm, apart, store.read_ref(parts["hot"])


def unbucketed(ref: str) -> str:
    """A reference to the same rows that doesn't say that they lie in buckets."""
    parts = parts_of(ref)
    if parts.get("base", "").startswith(BUCKETED_REF):
        parts["base"] = parts["base"][len(BUCKETED_REF):].split(":", 2)[2]
    return ref_of(parts) if ref.startswith(LAYERED_REF) else parts.get("base", ref)


def _changed(store: TableStore, parts: dict, rows: DataFrame) -> DataFrame:
    """Stored rows as readers see them, with the newest values of the changes."""
    if not parts.get("changes"):
        return rows
    changed = rows.join(_newest(store, parts), parts["key"], "left")
    hit = F.col("_new").isNotNull()
    return changed.select(
        *(
            F.when(hit, F.col("_new").getField(c)).otherwise(F.col(c)).alias(c) if c in parts["columns"] else F.col(c)
            for c in rows.columns
        )
    )


# ---- changes by key ------------------------------------------------------------------------


def with_change(store: TableStore, name: str, path: str, key: str, columns: list[str]) -> str:
    """The reference of ``name`` with one more batch of new values (``path`` has
    each changed key once, and all of ``columns``).  Every ``MERGE`` batches
    become one that holds the newest values."""
    parts = parts_of(store.current().get(name))
    if parts.get("changes") and (parts["key"], parts["columns"]) != (key, columns):
        raise ValueError(f"{name} is changed by {parts['key']}: {parts['columns']}")
    parts |= {"key": key, "columns": columns, "changes": [*parts.get("changes", []), path]}
    if len(parts["changes"]) > MERGE:
        merged = _newest(store, parts).select(key, *(F.col("_new").getField(c).alias(c) for c in columns))
        parts["changes"] = [store.stage_apart(f"{name}_changes", merged)]
    return ref_of(parts)


def change(store: TableStore, name: str, touched: DataFrame, key: str, columns: list[str]) -> int:
    """Publish new values of ``columns`` for the keys of ``touched`` (each once),
    computed from this handle's snapshot."""
    seen = store.current()
    path = store.stage_apart(f"{name}_changes", touched.select(key, *columns))
    return store.publish({name: with_change(store, name, path, key, columns)}, expected=seen)


def last_change(store: TableStore, name: str) -> DataFrame:
    """The rows that the last change of ``name`` touched, with old and new values."""
    parts = parts_of(store.current()[name])
    if parts.get("changes"):
        rows = store.spark.read.parquet(parts["changes"][-1])
    else:
        rows = _base_rows(store, parts)
    if "old_sales" not in rows.columns:
        raise ValueError(f"the old values of {name}'s last change are not kept")
    return rows


def fold(store: TableStore, name: str) -> str:
    """Write the layers of a table into a new base with the base's layout."""
    seen = store.current()
    path = store.stage(name, store.read(name))
    store.publish({name: path}, expected=seen)
    return path


# ---- inserts and logs ----------------------------------------------------------------------


def _merged(store: TableStore, name: str, inserts: list) -> list:
    """``inserts`` (path, size class) with every ``MERGE`` of one class as one of the next."""
    size = 0
    while any(c >= size for _, c in inserts):
        same = [p for p, c in inserts if c == size]
        if len(same) >= MERGE:
            one = store.stage_apart(f"{name}_rows", store.spark.read.parquet(*same))
            inserts = [[p, c] for p, c in inserts if c != size] + [[one, size + 1]]
        size += 1
    return inserts


def with_rows(store: TableStore, name: str, path: str | None, **told) -> str:
    """The reference of ``name`` with one more folder of rows and new facts about it."""
    parts = parts_of(store.current().get(name)) | told
    if path is not None:
        inserts = [*parts.get("inserts", []), [path, 0]]
        parts["inserts"] = inserts if "bounds" in parts else _merged(store, name, inserts)
    return ref_of(parts)


def insert(
    store: TableStore, name: str, rows: DataFrame, key: str, references: dict[str, tuple[str, str]] | None = None
) -> int:
    """S3 into a table with keys: the new rows are written apart, checked against
    the keys of the existing rows (Q1) and of the tables they refer to (Q2; column
    -> table, its key), and published only if nothing is found."""
    seen = store.current()
    existing = store.read(name)
    path = store.stage_apart(f"{name}_rows", rows.select(*existing.columns))
    new = store.spark.read.parquet(path)
    parents = {c: (store.read(t).select(k), k) for c, (t, k) in (references or {}).items()}
    enforce(insert_violations(new, existing.select(key), key, parents, name), f"rows refused by {name}")
    return store.publish({name: with_rows(store, name, path)}, expected=seen)


def log_state(store: TableStore, name: str) -> tuple[int, dict[str, int]]:
    """Highest id of a log and the last epoch of every stream that wrote to it."""
    ref = store.current().get(name)
    parts = parts_of(ref)
    if ref is not None and "last" not in parts:  # a log from before the mark was kept
        parts["last"] = store.read(name).agg(F.max("audit_id")).first()[0] or 0
    return parts.get("last", 0), parts.get("epochs", {})


# ---- ranges (S7) -----------------------------------------------------------------------------

_BOUNDS_DDL = "name string, low date, high date"


def declare_ranges(store: TableStore, name: str, column: str, bounds: list[tuple[str, date, date]]) -> int:
    """An empty table in half-open ranges of ``column``, [low, high)."""
    seen = store.current()
    path = store.stage_apart(f"{name}_bounds", store.spark.createDataFrame(bounds, _BOUNDS_DDL).coalesce(1))
    return store.publish({name: ref_of({"bounds": path, "column": column})}, expected=seen)


def bounds_of(store: TableStore, name: str) -> tuple[str, list[tuple[str, date, date]]]:
    """The range column and its declared ranges (a row per range), as the table keeps them."""
    parts = parts_of(store.current()[name])
    rows = store.spark.read.parquet(parts["bounds"]).orderBy("low").collect()
    return parts["column"], [tuple(r) for r in rows]


def insert_ranged(store: TableStore, name: str, rows: DataFrame) -> int:
    """Insert into a table in ranges: every row goes to its range's folder; a row
    outside all ranges (or without a date) refuses the whole insert.  The rows are
    read once: those outside are counted while the others are written."""
    seen = store.current()
    column, bounds = bounds_of(store, name)
    outside = Observation()
    tagged = rows.withColumn(RANGE_COLUMN, range_partition(column, bounds))
    told = tagged.observe(outside, F.count_if(F.col(RANGE_COLUMN).isNull()).alias("n"))
    valid = told.where(F.col(RANGE_COLUMN).isNotNull()).sortWithinPartitions(RANGE_COLUMN, column)
    path = store.stage_apart(f"{name}_rows", valid, partition_by=[RANGE_COLUMN])
    if outside.get["n"]:
        raise ConstraintViolation(f"{outside.get['n']} rows outside every declared range of {name}")
    return store.publish({name: with_rows(store, name, path)}, expected=seen)


def read_range(store: TableStore, name: str, low: date, high: date) -> DataFrame:
    """Rows with ``low <= date < high``; only folders of overlapping ranges are read."""
    column, bounds = bounds_of(store, name)
    touched = [n for n, a, b in bounds if a < high and low < b]
    rows = read_layers(store, store.current()[name])
    return rows.where(F.col(RANGE_COLUMN).cast("string").isin(touched)).where(
        (F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high))
    )
