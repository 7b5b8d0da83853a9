"""Prefix tries of conversations by padded matrices of turn ids.

A conversation is a path of turns; a turn's id is a 128-bit digest of its role
and text.  Paths are dealt to shards by range, so a shard holds a run of the
sorted paths.  In a shard:

1. the paths become rows of a matrix of turn numbers, padded with zeros, in
   panels of ``PANEL`` columns (a panel holds only the rows that reach it), and
   are ordered by ``numpy.lexsort``;
2. a row's columns are compared with the row above; the masks of change, OR-ed
   along the row, mark at each depth the rows where a node starts;
3. ``reduceat`` over these starts gives members, smallest member and ends of
   all nodes of a depth; sums over subtrees go from the deepest depth upward.

A node of which all members are in one shard is whole.  Only the nodes on the
path of a shard's first and last row can go on in a neighbour; each shard gives
the part that it has of those (two paths), and these parts are recombined by
their prefix digest: members and inner sums are added, and what the recombined
nodes add to their ancestors is a running sum along the one path that owns each
of them.  No table of all nodes is joined but for the parents on these paths.

The digest of a node's ends is one stream of ids in order.  A node whose ends
lie in one shard is hashed there; those of the boundary nodes are ordered by
Spark and hashed in passing, with constant memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwell.llm.common import kept_by, ship, stored, table

PANEL = 16
ID_BYTES = 16
#: Turns (and conversations) of a shard, about.
SHARD_TURNS = 500_000
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Of the rebuilding: conversations that share a head, and the longest head + 1.
FAMILY, HEADS = 100, 6

_FOUND = pa.schema(
    [
        ("kind", pa.int32()),
        ("shard", pa.int64()),
        ("side", pa.int32()),
        ("depth", pa.int64()),
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
        ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("chars", pa.int64()),
        ("ends_sha256", pa.string()),
    ]
)
_FOUND_DDL = (
    "kind int, shard long, side int, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, chars long, ends_sha256 string"
)
WHOLE, PART, END = 0, 1, 2
NODE_COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


# ---- paths -----------------------------------------------------------------------------


def _turn_id(role: Column, text: Column) -> Column:
    """128 bits of a digest of both, the same only for equal roles and texts."""
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(told.cast("binary"), 256), 1, 2 * ID_BYTES))


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (id, chars)) of every conversation, in the order
    of ``turn``, null first; equal turn numbers go by the turn's id.  A null role
    or text is empty; rows without conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), _turn_id(role, text).alias("id"), F.length(text).cast("long").alias("chars")).alias("t"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return ordered.select("conv_id", F.transform("ts", lambda t: F.struct(t["id"], t["chars"])).alias("turns"))


def rebuilt(told: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Every path with the head of its family's first conversation: the first h
    turns of conversation c - c % family (none if there is none), then its own
    turns after its first h; h = crc32 of the decimal c, modulo ``heads``."""
    c = F.col("conv_id")
    own = told.withColumn("h", (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")).withColumn(
        "first_id", c - c % family
    )
    first = told.filter(c % family == 0).select(
        c.alias("first_id"), F.slice("turns", 1, max(heads - 1, 1)).alias("head")
    )
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", 1, F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(first, "first_id", "left").select("conv_id", F.concat(head, rest).alias("turns"))


# ---- one shard -------------------------------------------------------------------------


def panel(ids: np.ndarray, at: np.ndarray, lengths: np.ndarray, start: int, width: int = PANEL) -> np.ndarray:
    """Columns ``start`` onward of the rows that begin at ``at`` in ``ids``, padded with 0."""
    column = start + np.arange(width)
    spot = at[:, None] + column
    return np.where(column < lengths[:, None], ids[np.minimum(spot, len(ids) - 1)], 0)


def order_of(ids: np.ndarray, at: np.ndarray, lengths: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Places of the rows in the order of (path, conv_id); a shorter path comes first.

    Panel by panel: rows that are equal so far are told apart by the next one."""
    rank, start = np.zeros(len(conv), np.int64), 0
    while True:
        equal = np.bincount(rank, minlength=1)[rank] > 1 if len(rank) else np.zeros(0, bool)
        open_ = np.flatnonzero(equal & (lengths > start))
        if not open_.size:
            return np.lexsort((conv, rank))
        m = panel(ids, at[open_], lengths[open_], start)
        o = np.lexsort((*m.T[::-1], rank[open_]))
        new = np.ones(len(o), bool)
        new[1:] = (m[o[1:]] != m[o[:-1]]).any(axis=1) | (rank[open_[o[1:]]] != rank[open_[o[:-1]]])
        sub = np.zeros(len(rank), np.int64)
        sub[open_[o]] = np.cumsum(new)
        o = np.lexsort((sub, rank))
        new = np.ones(len(o), bool)
        new[1:] = (rank[o[1:]] != rank[o[:-1]]) | (sub[o[1:]] != sub[o[:-1]])
        rank[o] = np.cumsum(new) - 1
        start += PANEL


class _Level:
    """Nodes of one depth: first row, members, smallest member, ends, last text."""

    def __init__(self, start, members, low, ends, chars):
        self.start, self.members, self.low, self.ends, self.chars = start, members, low, ends, chars


def levels(ids: np.ndarray, at: np.ndarray, lengths: np.ndarray, conv: np.ndarray, chars: np.ndarray) -> list[_Level]:
    """The nodes of all depths of rows that are in order."""
    n = len(conv)
    root = _Level(np.zeros(1, np.int64), np.array([n]), np.array([conv.min()]), np.array([(lengths == 0).sum()]), np.zeros(1, np.int64))
    found, rows, carry, start = [root], np.flatnonzero(lengths > 0), None, 0
    while rows.size:
        m = panel(ids, at[rows], lengths[rows], start)
        changed = np.ones(m.shape, bool)
        changed[1:] = m[1:] != m[:-1]
        if carry is not None:
            changed[:, 0] |= carry
        changed = np.logical_or.accumulate(changed, axis=1)
        for j in range(PANEL):
            here = m[:, j] != 0
            if not here.any():
                break
            place, depth = rows[here], start + j + 1
            first = np.flatnonzero(changed[here, j])
            found.append(
                _Level(
                    place[first],
                    np.diff(np.append(first, len(place))),
                    np.minimum.reduceat(conv[place], first),
                    np.add.reduceat((lengths[place] == depth).astype(np.int64), first),
                    chars[at[place[first]] + depth - 1],
                )
            )
        start += PANEL
        on = np.flatnonzero(lengths[rows] > start)
        # a row differs from the last one that goes on if any row between did
        sums = np.cumsum(changed[:, -1])
        carry = np.diff(np.append(0, sums[on])) > 0
        carry[:1] = True
        rows = rows[on]
    return found


def _ends_sha(conv: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, conv.tolist())).encode()).hexdigest()


def _prefix_keys(path: bytes) -> list[bytes]:
    """A digest of every prefix, the empty one first."""
    told, out = hashlib.sha256(), []
    for d in range(0, len(path) + 1, ID_BYTES):
        out.append(told.copy().digest()[:ID_BYTES])
        told.update(path[d : d + ID_BYTES])
    return out


def shard_rows(shard: int, conv: np.ndarray, lengths: np.ndarray, flat: bytes, chars: np.ndarray) -> Iterator[dict]:
    """Columns of ``_FOUND`` for the paths of one shard, depth by depth."""
    digests = np.frombuffer(flat, f"S{ID_BYTES}")
    at = np.cumsum(lengths) - lengths
    ids = np.unique(digests, return_inverse=True)[1].astype(np.int64) + 1 if len(digests) else np.zeros(1, np.int64)
    order = order_of(ids, at, lengths, conv)
    conv, lengths, at = conv[order], lengths[order], at[order]
    depths = levels(ids, at, lengths, conv, chars)
    sides = [(int(lengths[i]), _prefix_keys(flat[ID_BYTES * at[i] : ID_BYTES * (at[i] + lengths[i])])) for i in (0, -1)]
    (first_len, first_keys), (last_len, last_keys) = sides

    def edge(depth: int) -> np.ndarray:
        """Which nodes are on the path of the first or the last row."""
        out = np.zeros(len(depths[depth].start), bool)
        if depth <= first_len:
            out[0] = True
        if depth <= last_len:
            out[-1] = True
        return out

    below = None  # the depth beneath: parents' numbers, whether on an edge, sums
    for depth in range(len(depths) - 1, -1, -1):
        level, at_edge = depths[depth], edge(depth)
        n = len(level.start)
        all_children, children, leaves, saved = (np.zeros(n, np.int64) for _ in range(4))
        if below is not None:
            start, below_edge, below_leaves, below_saved = below
            parent = np.searchsorted(level.start, start, "right") - 1
            np.add.at(all_children, parent, 1)
            np.add.at(children, parent, (~below_edge).astype(np.int64))
            np.add.at(leaves, parent, below_leaves)
            np.add.at(saved, parent, below_saved)
        leaves += (all_children == 0) & ~at_edge
        saved += np.where(at_edge, 0, (level.members - 1) * level.chars)
        below = level.start, at_edge, leaves, saved
        if depth:
            up = np.searchsorted(depths[depth - 1].start, level.start, "right") - 1
            up_edge = edge(depth - 1)[up]
            up_conv = depths[depth - 1].low[up]
            up_side = np.where((up == 0) & (depth - 1 <= first_len), 0, 1)
        else:
            up_edge, up_conv, up_side = np.zeros(1, bool), np.zeros(1, np.int64), np.zeros(1, np.int64)
        whole = np.flatnonzero(~at_edge)
        if whole.size:
            sha = [
                _ends_sha(conv[s : s + e]) if e else NO_ENDS
                for s, e in zip(level.start[whole].tolist(), level.ends[whole].tolist())
            ]
            told = up_edge[whole]
            yield {
                "kind": np.full(len(whole), WHOLE), "shard": np.full(len(whole), shard),
                "side": pa.array(up_side[whole], mask=~told), "depth": np.full(len(whole), depth),
                "conv_id": level.low[whole], "parent_conv_id": pa.array(up_conv[whole], mask=told),
                "n_convs": level.members[whole], "n_children": children[whole], "n_leaves": leaves[whole],
                "saved_tokens": saved[whole], "chars": level.chars[whole], "ends_sha256": sha,
            }
        for side, (length, keys) in enumerate(sides):
            if depth > length:
                continue
            i = 0 if side == 0 else n - 1
            again = side == 1 and depth <= first_len and n == 1  # told with the first row's path
            yield {
                "kind": [PART], "shard": [shard], "side": [side], "depth": [depth], "key": [keys[depth]],
                "parent_key": [keys[depth - 1] if depth else None], "conv_id": [None if again else int(level.low[i])],
                "n_convs": [0 if again else int(level.members[i])], "n_children": [0 if again else int(children[i])],
                "n_leaves": [0 if again else int(leaves[i])], "saved_tokens": [0 if again else int(saved[i])],
                "chars": [int(level.chars[i])],
            }
            if level.ends[i] and not again:
                ends = conv[level.start[i] : level.start[i] + level.ends[i]]
                yield {"kind": np.full(len(ends), END), "key": [keys[depth]] * len(ends), "conv_id": ends}


def _shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept_by("trie")
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    conv = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in held]).astype(np.int64)
    lengths = np.concatenate([pa.compute.list_value_length(b.column(1)).to_numpy(zero_copy_only=False) for b in held])
    flat = b"".join(x for b in held for x in b.column(1).flatten().to_pylist())
    chars = np.concatenate([b.column(2).flatten().to_numpy(zero_copy_only=False) for b in held]).astype(np.int64)
    del held
    for found in shard_rows(TaskContext.get().partitionId(), conv, lengths.astype(np.int64), flat, chars):
        rows = len(found["kind"])
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(rows, f.type) if f.name not in found
                else found[f.name].cast(f.type) if isinstance(found[f.name], pa.Array)
                else pa.array(found[f.name], f.type)
                for f in _FOUND
            ],
            schema=_FOUND,
        )


def _hash_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends_sha256) of rows that come in the order of (key, conv_id)."""
    key, told = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([told.hexdigest()])], names=["key", "ends_sha256"])

    for batch in batches:
        keys, conv = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for k, c in zip(keys, conv):
            if k != key:
                if told:
                    yield done()
                key, told = k, hashlib.sha256(str(c).encode())
            else:
                told.update(f",{c}".encode())
    if told:
        yield done()


# ---- all shards ------------------------------------------------------------------------


def _recombined(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the shards' paths: the whole nodes (key and node columns but for the
    ends), and of every place on a path (shard, side, depth) the node's conv_id."""
    path = F.struct("shard", "side")
    node = parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner_children"),
        F.sum("n_leaves").alias("inner_leaves"), F.sum("saved_tokens").alias("inner_saved"),
        F.max("chars").alias("chars"), F.min(path).alias("owner"),
    )
    node = stored(node, "trie-edges")
    children = node.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("edge_children"))
    node = node.join(children, "key", "left").withColumn(
        "n_children", F.col("inner_children") + F.coalesce("edge_children", F.lit(0))
    )
    own = node.select(
        "key", "owner", F.col("conv_id").alias("node_id"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"),
    )
    on_path = parts.select("shard", "side", "depth", "key").join(own, "key")
    owned = F.col("owner") == path
    upward = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = on_path.select(
        "shard", "side", "depth", "key", "node_id",
        F.sum(F.when(owned, F.col("leaf")).otherwise(0)).over(upward).alias("leaves"),
        F.sum(F.when(owned, F.col("own_saved")).otherwise(0)).over(upward).alias("saved"),
    )
    summed = stored(summed, "trie-paths")
    added = summed.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    parent = node.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    whole = (
        node.join(added, "key")
        .join(parent, "parent_key", "left")
        .select(
            "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            (F.col("inner_leaves") + F.col("leaves")).alias("n_leaves"),
            (F.col("inner_saved") + F.col("saved")).alias("saved_tokens"),
        )
    )
    return whole, summed.select("shard", "side", "depth", "node_id")


def prefix_trie(told: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``told`` (conv_id, turns: array of (id, chars),
    as ``paths`` gives them; ids have 16 bytes): one row per distinct sequence of
    first d turns.  Columns: conv_id (smallest member; with depth it names the
    node), depth, parent_conv_id (null at the root), n_convs (members),
    n_children, n_leaves (childless nodes of its subtree, itself included),
    saved_tokens (sum over its subtree of (members - 1) times the chars of the
    node's last turn) and ends_sha256 (of the decimal conv_ids, ascending and
    comma-joined, that end here).

    A path without turns is a member of the root alone.  Repeated conv_ids are
    members of their own.  Other columns are not read; no paths, no nodes.
    A task holds the paths of a shard (about ``shard_turns`` turns, or one
    path); one node's ends pass through one task as a stream."""
    spark = told.sparkSession
    ship(spark)
    rows = stored(told.select("conv_id", F.col("turns.id").alias("path"), F.col("turns.chars").alias("chars")), "trie-rows")
    turns = rows.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    found = stored(rows.repartitionByRange(shards, "path", "conv_id").mapInArrow(_shard, _FOUND_DDL), "trie-found")
    whole, places = _recombined(found.filter(F.col("kind") == PART).drop("parent_conv_id", "ends_sha256"))
    ends = found.filter(F.col("kind") == END).select("key", "conv_id")
    hashed = ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_hash_ends, "key binary, ends_sha256 string")
    edges = whole.join(hashed, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    inner = found.filter(F.col("kind") == WHOLE)
    known = inner.filter(F.col("side").isNull())
    # the parent is on an edge: its smallest member may be in another shard
    places = places.select("shard", "side", (F.col("depth") + 1).alias("depth"), "node_id")
    asked = inner.filter(F.col("side").isNotNull()).join(places, ["shard", "side", "depth"])
    asked = asked.withColumn("parent_conv_id", F.col("node_id"))
    return (
        known.select(*NODE_COLUMNS)
        .unionByName(asked.select(*NODE_COLUMNS))
        .unionByName(edges.select(*NODE_COLUMNS))
    )


def last_turns(nodes: DataFrame, told: DataFrame) -> DataFrame:
    """``nodes`` with the id and chars of their last turn (null at the root), by
    their smallest member's path."""
    last = F.when(F.col("depth") > 0, F.element_at("turns", F.col("depth").cast("int")))
    return nodes.join(told, "conv_id").select(*nodes.columns, last["id"].alias("turn_id"), last["chars"].alias("turn_chars"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie(rebuilt(paths(table(spark, sf_dir, "conversations"))))
