"""Near-duplicate groups by ProbMinHash.

1. Shingles of five words get weights (1 + ln of their count in the document).
   Each weighted shingle is a Poisson process with its weight as rate; its
   arrivals fall on random registers, and a register keeps the shingle that
   arrives first.  A shingle's arrivals are drawn until they come later than
   the last register's first one (early termination), so two documents agree in
   a register with their probability Jaccard similarity.  A document that repeats
   a shingle gets a second signature, all weights 1: its registers agree with
   the plain Jaccard similarity, the one that is verified.  Without repeats both
   are the same.
2. Equal texts are one class, a node.  The registers of each signature of a node
   make ``BANDS`` bands of ``ROWS``; nodes with an equal band share a bucket.
3. Verification: the exact Jaccard similarity of the shingle sets, at least
   ``SIMILARITY``, makes a link.
4. Groups are the connected components of the links.

No step emits the pairs of a bucket.  A bucket's hub is its most central node
(the one whose buckets are largest, such as the text that many copies were
edited from) and all others are verified against it.  After the components of
those links are known, only pairs that lie in one bucket but in different
components are left.  A bucket's nodes outside its largest component meet its nodes
in blocks, whose registers a task compares as matrices; it notes, in one row,
which pairs agree, in either signature, about as much as the similarity asks
for.  The shingle sets of a block's noted nodes then come to that block, and
pairs whose components its earlier links have not joined yet are verified there.
A block gives out only links that join two components, so fewer rows than it has
nodes; no pair becomes a row.  So every pair that shares a band is linked up or
looked at, and a large group of near copies costs strangers times members
comparisons, in blocks.

A class of copies that a third of all documents belong to is one node.  Joins
on hashes and hubs are plain equi-joins that Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwell.llm.common import kept_by, ship, steps, stored, table, text_of
from martwell.llm.shingles import jaccard, mixed, shingles

BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
SIMILARITY = 0.8
#: A pair beyond the hubs is not worth a look if the share of agreeing registers
#: of both signatures is this many standard deviations under the similarity
#: asked for (0.7 for 0.8).
DEVIATIONS = 3.46

_SIGNED_DDL = "uid long, doc_id long, hash string, bands array<long>, low binary, size int"


def prob_minhash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, owners: int, registers: int) -> np.ndarray:
    """(owners, registers) matrix of the elements that arrive first.

    All elements of all owners go on together, a few arrivals at a time; an
    element stops when its next arrival is later than its owner's latest
    register."""
    first = np.full(owners * registers, np.inf)
    holder = np.zeros(owners * registers, np.uint64)
    active = np.arange(len(element))
    time = np.zeros(len(element))
    drawn = 0
    while active.size:
        block = 1 if drawn < 4 else 16
        number = np.arange(drawn + 1, drawn + block + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
        drawn += block
        e = element[active]
        bits = mixed(e[:, None] + number)
        gap = -np.log1p(-(bits >> np.uint64(11)).astype(np.float64) * 2.0**-53) / weight[active][:, None]
        at = time[active][:, None] + np.cumsum(gap, axis=1)
        time[active] = at[:, -1]
        spot = ((mixed(bits) >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
        slot = (owner[active] * registers)[:, None] + spot.astype(np.int64)
        better = at < first[slot]
        at_, slot_ = at[better], slot[better]
        np.minimum.at(first, slot_, at_)
        won = first[slot_] == at_
        holder[slot_[won]] = np.broadcast_to(e[:, None], at.shape)[better][won]
        some = np.unique(owner[active])
        latest = np.zeros(owners)
        latest[some] = first.reshape(owners, registers)[some].max(axis=1)
        active = active[time[active] < latest[owner[active]]]
    return holder.reshape(owners, registers)


def least_agreement(similarity: float) -> float:
    """Share of agreeing registers, of a signature of plain shingle sets, that a
    pair of this similarity falls short of by chance only (they are independent)."""
    return similarity - DEVIATIONS * (similarity * (1 - similarity) / REGISTERS) ** 0.5


def signatures(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts, 2, REGISTERS) registers of every text, with weights 1 and with
    weights by count; how many different shingles it has, and whether it repeats one."""
    owner, element, weight = [], [], []
    sizes, repeats = np.zeros(len(texts), np.int32), np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        found, counts = np.unique(shingles(t), return_counts=True)
        sizes[i], repeats[i] = len(found), bool((counts > 1).any())
        owner.append(np.full(len(found), i))
        element.append(found)
        weight.append(1 + np.log(counts))
    own, elements, weights = np.concatenate(owner).astype(np.int64), np.concatenate(element), np.concatenate(weight)
    held = np.empty((len(texts), 2, REGISTERS), np.uint64)
    held[:] = prob_minhash(own, elements, np.ones(len(own)), len(texts), REGISTERS)[:, None]
    if repeats.any():
        some = repeats[own]
        number = np.cumsum(repeats) - 1
        held[repeats, 1] = prob_minhash(number[own[some]], elements[some], weights[some], int(repeats.sum()), REGISTERS)
    return held, sizes, repeats


def band_hashes(held: np.ndarray) -> np.ndarray:
    """A hash per band, different for each band."""
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(held), BANDS))
    for r in range(ROWS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + held[:, r::ROWS])
    return out.view(np.int64)


def _sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept_by("neardup")
    for batch in batches:
        for part in steps(batch, 3, 1_000_000):
            held, sizes, repeats = signatures(part.column(3).to_pylist())
            # the second signature is kept where it differs
            kept = np.column_stack([sizes > 0, repeats])
            bands = band_hashes(held.reshape(-1, REGISTERS)).reshape(-1, 2, BANDS)[kept].ravel()
            ends = np.cumsum(kept.sum(axis=1) * BANDS)
            low = (held & np.uint64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2),
                 pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(bands)),
                 pa.array([r[: 1 + twice].tobytes() for r, twice in zip(low, repeats)], pa.binary()), pa.array(sizes, pa.int32())],
                names=["uid", "doc_id", "hash", "bands", "low", "size"],
            )


def text_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def sign(docs: DataFrame) -> DataFrame:
    """uid, doc_id, hash of the text, band hashes (none without words), the
    registers' low bytes and the number of shingles of every row of ``docs`` (doc_id, text); of two
    signatures if a shingle is repeated; stored."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", text_hash(F.col("text")).alias("hash"), "text")
    return stored(rows.mapInArrow(_sign, _SIGNED_DDL), "signatures")


def classes(signed: DataFrame) -> DataFrame:
    """One row per distinct text: hash, node (a row's uid), rep (place of its
    first document: not null, smallest id), copies; stored."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    found = signed.groupBy("hash").agg(
        F.min(place).alias("rep"), F.count(F.lit(1)).alias("copies"),
    )
    return stored(found.select("hash", F.col("rep.uid").alias("node"), "rep", "copies"), "classes")


def buckets(signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(bucket, node, central) of the bands that several nodes share; central is
    the number of nodes in all buckets of the node; stored."""
    own = signed.join(nodes.select(F.col("node").alias("uid")), "uid", "left_semi")
    rows = own.select(F.col("uid").alias("node"), F.explode(F.array_distinct("bands")).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = stored(rows.join(sizes, "bucket"), "buckets")
    central = shared.groupBy("node").agg(F.sum("size").alias("central"))
    return stored(shared.select("bucket", "node").join(central, "node"), "central-buckets")


def hub_pairs(shared: DataFrame) -> DataFrame:
    """(node, hub) for the most central node of every bucket."""
    hubs = shared.groupBy("bucket").agg(F.max(F.struct("central", (-F.col("node")).alias("n"))).alias("hub"))
    hubs = hubs.select("bucket", (-F.col("hub.n")).alias("hub"))
    return shared.join(hubs, "bucket").filter("node <> hub").select("node", "hub").distinct()


#: Nodes of a block of a bucket's members and of its strangers, and shingles of both, about.
MEMBERS, STRANGERS = 2048, 1024
BLOCK_SHINGLES = 500_000


def _block_of(nodes: str, size: str, most: int) -> Column:
    """The number of a node's block in its bucket: about ``most`` nodes each and
    no more than ``BLOCK_SHINGLES`` shingles."""
    blocks = F.ceil(F.greatest(F.col(nodes) / most, F.col(size) / BLOCK_SHINGLES))
    return F.pmod(F.xxhash64("node"), F.greatest(blocks, F.lit(1)))


def _blocks(rows: DataFrame, block: Column, name: str) -> DataFrame:
    held = F.collect_list(F.struct("node", "root", "low", "bands")).alias(f"{name}_nodes")
    return rows.groupBy("bucket", block.alias(name)).agg(held)


def _block(cell: pa.StructArray) -> tuple[np.ndarray, ...]:
    """Nodes, roots, and low bytes and bands of both signatures (rows, 2, ...)."""
    node, root = (cell.field(n).to_numpy(zero_copy_only=False) for n in ("node", "root"))
    both = (low if len(low) > REGISTERS else low * 2 for low in cell.field("low").to_pylist())
    low = np.frombuffer(b"".join(both), np.uint8).reshape(-1, 2, REGISTERS)
    bands = cell.field("bands")
    sizes = pa.compute.list_value_length(bands).to_numpy(zero_copy_only=False).astype(np.int64)
    spot = (np.cumsum(sizes) - sizes)[:, None] + np.arange(2 * BANDS) % sizes[:, None]
    return node, root, low, bands.flatten().to_numpy(zero_copy_only=False)[spot].reshape(-1, 2, BANDS)


def _agreeing(batches: Iterable[pa.RecordBatch], similarity: float = SIMILARITY) -> Iterator[pa.RecordBatch]:
    least = least_agreement(similarity) * REGISTERS
    for batch in batches:
        for bucket, main, members, strangers in zip(*batch.columns):
            bucket, main = bucket.as_py(), main.as_py()
            node, root, low, bands = _block(members.values)
            out_node, out_hub = [], []
            for hub, hub_root, hub_low, hub_bands in zip(*_block(strangers.values)):
                once = np.flatnonzero((root != hub_root) & ((root == main) | (node < hub)))
                near = once[((low[once] == hub_low).sum(axis=2) >= least).any(axis=1)]
                # of all buckets that the two share, by any signature, this is the least
                equal = bands[near][:, :, None] == hub_bands
                shared = np.where(equal, hub_bands, np.iinfo(np.int64).max).min(axis=(1, 2, 3))
                near = near[shared == bucket]
                out_node.append(node[near])
                out_hub.append(np.full(len(near), hub))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).astype(np.int64)) for x in (out_node, out_hub)], names=["node", "hub"]
            )


_NOTED_DDL = "bucket long, member long, stranger long, nodes array<long>, roots array<long>, pairs binary"


def _noted(batches: Iterable[pa.RecordBatch], similarity: float = SIMILARITY) -> Iterator[pa.RecordBatch]:
    """Per block pair with agreeing pairs, in one row: the nodes that have any,
    their roots, and the pairs as places of both in these."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            cells = row.select(["bucket", "main", "member_nodes", "stranger_nodes"])
            found = pa.Table.from_batches(list(_agreeing([cells], similarity)))
            if not found.num_rows:
                continue
            node, hub = (c.to_numpy() for c in found.columns)
            held = [row.column(c)[0].values for c in ("member_nodes", "stranger_nodes")]
            every, root = (np.concatenate([h.field(n).to_numpy(zero_copy_only=False) for h in held]) for n in ("node", "root"))
            nodes = np.unique(np.concatenate([node, hub]))
            order = np.argsort(every, kind="stable")
            roots = root[order[np.searchsorted(every, nodes, sorter=order)]]
            pairs = np.column_stack([np.searchsorted(nodes, x) for x in (hub, node)]).astype(np.int32)
            out = [row.column("bucket")[0].as_py(), row.column("member")[0].as_py(), row.column("stranger")[0].as_py()]
            out += [nodes, roots, pairs.tobytes()]
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(out, kinds)], names=[x.split()[0] for x in _NOTED_DDL.split(", ")]
            )


class _Trees:
    """Components that links of a block have joined."""

    def __init__(self, roots: Iterable[int]):
        self.up = {r: r for r in roots}

    def of(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.of(a), self.of(b)
        self.up[a] = b
        return a != b


def _joining(similarity: float):
    """Of rows (nodes, roots, pairs, sets: node and its hashes): links that join
    two components of their block."""

    def of_block(nodes: list, roots: list, pairs: np.ndarray, sets: dict[int, bytes]) -> Iterator[tuple[int, int]]:
        trees = _Trees(roots)
        held = [np.frombuffer(sets[n], np.uint64) for n in nodes]
        for i, j in pairs.tolist():
            if trees.of(roots[i]) != trees.of(roots[j]) and jaccard(held[i], held[j]) >= similarity:
                trees.join(roots[i], roots[j])
                yield nodes[j], nodes[i]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                nodes, roots, pairs, sets = (c[r].as_py() for c in batch.columns)
                places = np.frombuffer(pairs, np.int32).reshape(-1, 2)
                found = list(of_block(nodes, roots, places, {s["node"]: s["hashes"] for s in sets}))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["node", "hub"]
                )

    return run


def _hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, 1, 1_000_000):
            sets = [np.unique(shingles(t)).tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "hashes"])


def left_links(shared: DataFrame, component: DataFrame, signed: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links between nodes that share a bucket and are in different components:
    enough of them to join all components that such links join.

    Buckets meet their nodes outside the largest component in blocks, which a
    task compares as matrices; a pair is looked at in the least of the buckets
    that it shares."""
    rows = (
        shared.select("bucket", "node")
        .join(component, "node", "left")
        .join(signed.select(F.col("uid").alias("node"), "size"), "node")
        .select("bucket", "node", F.coalesce("root", "node").alias("root"), "size")
    )
    counted = rows.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    mixed_ = (
        counted.groupBy("bucket")
        .agg(F.max(F.struct("n", "root", "size")).alias("main"), F.sum("n").alias("members"), F.sum("size").alias("member_size"))
        .filter("members > main.n")
        .select(
            "bucket", "members", "member_size", F.col("main.root").alias("main"),
            (F.col("members") - F.col("main.n")).alias("strangers"),
            (F.col("member_size") - F.col("main.size")).alias("stranger_size"),
        )
    )
    registers = signed.select(F.col("uid").alias("node"), "low", "bands")
    open_ = rows.join(mixed_, "bucket").join(registers, "node")
    members = _blocks(open_, _block_of("members", "member_size", MEMBERS), "member")
    strangers = _blocks(open_.filter("root <> main"), _block_of("strangers", "stranger_size", STRANGERS), "stranger")
    blocks = members.join(strangers, "bucket").join(mixed_.select("bucket", "main"), "bucket")
    agreeing = blocks.select("bucket", "main", "member", "member_nodes", "stranger", "stranger_nodes").mapInArrow(
        partial(_noted, similarity=similarity), _NOTED_DDL
    )
    agreeing = stored(agreeing, "agreeing")
    block = ["bucket", "member", "stranger"]
    asked = agreeing.select(*block, F.explode("nodes").alias("node"))
    sets = texts.join(asked.select("node").distinct(), "node").select("node", "text").mapInArrow(_hashes, "node long, hashes binary")
    brought = asked.join(sets, "node").groupBy(*block).agg(F.collect_list(F.struct("node", "hashes")).alias("sets"))
    return (
        agreeing.join(brought, block)
        .select("nodes", "roots", "pairs", "sets")
        .mapInArrow(_joining(similarity), "node long, hub long")
    )


class _Sets:
    """Shingle sets of texts met lately, by node; holds ``most`` hashes or one set."""

    def __init__(self, most: int = 4_000_000):
        self.most, self.held, self.sets = most, 0, {}

    def of(self, node: int, text: str) -> np.ndarray:
        found = self.sets.get(node)
        if found is None:
            found = np.unique(shingles(text))
            if self.held + found.size > self.most:
                self.sets, self.held = {}, 0
            self.sets[node] = found
            self.held += found.size
        return found


def _verify(similarity: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets()
        for batch in batches:
            for part in steps(batch, 2, 1_000_000):
                keep = [
                    jaccard(sets.of(node, node_text), sets.of(hub, hub_text)) >= similarity
                    for node, hub, node_text, hub_text in zip(*(c.to_pylist() for c in part.columns))
                ]
                yield pa.RecordBatch.from_arrays(
                    [c.filter(pa.array(keep, pa.bool_())) for c in part.columns[:2]], names=["node", "hub"]
                )

    return run


def links(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets are similar enough, by the texts."""
    first = pairs.join(texts.select("node", F.col("text").alias("node_text")), "node")
    both = first.join(texts.select(F.col("node").alias("hub"), F.col("text").alias("hub_text")), "hub")
    return both.select("node", "hub", "node_text", "hub_text").mapInArrow(_verify(similarity), "node long, hub long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the least node that it
    is connected with.  Each round takes the least root among the neighbours
    and then the root's root, until no root changes; rounds are stored."""
    both = stored(edges.select("node", "hub").union(edges.select("hub", "node")).distinct(), "edges")
    now = stored(both.groupBy("node").agg(F.least(F.col("node"), F.min("hub")).alias("root")), "roots")
    while True:
        near = both.join(now.withColumnsRenamed({"node": "hub"}), "hub").groupBy("node").agg(F.min("root").alias("near"))
        pulled = now.join(near, "node").select("node", "root", F.least("root", "near").alias("to"))
        jump = now.select(F.col("node").alias("to"), F.col("root").alias("far"))
        after = pulled.join(jump, "to").select("node", F.col("far").alias("root"), (F.col("far") < F.col("root")).alias("moved"))
        after = stored(after, "roots")
        now = after.select("node", "root")
        if after.filter("moved").isEmpty():
            return now


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row per row of ``docs``: doc_id, hash (of the text), class_id (first
    doc_id with that text), group_id (first doc_id of its near-duplicate group),
    class_size, and keep: true for one row of each group, the one with the
    smallest id (null ids come last; repeated rows count as copies).

    Null text is empty; equal texts are one class also when they are empty;
    texts without words are similar to no other text; other columns are not
    read; an empty table gives no rows."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    signed = sign(rows)
    nodes = classes(signed)
    shared = buckets(signed, nodes)
    # texts of the nodes that share a bucket with another one
    wanted = shared.select("node").distinct().join(nodes, "node").select("hash", "node", F.col("rep.doc_id").alias("id"))
    hashed = rows.select(text_hash(F.col("text")).alias("hash"), F.col("doc_id").alias("own_id"), "text")
    found = hashed.join(wanted, (hashed["hash"] == wanted["hash"]) & hashed["own_id"].eqNullSafe(wanted["id"]))
    texts = stored(found.groupBy("node").agg(F.first("text").alias("text")), "texts")
    direct = stored(links(hub_pairs(shared), texts, similarity), "links")
    component = components(direct)
    more = stored(left_links(shared, component, signed, texts, similarity), "links")
    if not more.isEmpty():
        component = components(direct.union(more))
    grouped = component.join(nodes.select("node", "rep"), "node")
    first = grouped.groupBy("root").agg(F.min("rep").alias("first"))
    group = component.join(first, "root").select("node", "first")
    by_class = nodes.join(group, "node", "left").select(
        "hash", "copies", F.col("rep.doc_id").alias("class_id"), F.coalesce("first", "rep").alias("first")
    )
    return (
        signed.select("uid", "doc_id", "hash")
        .join(by_class, "hash")
        .select(
            "doc_id", "hash", "class_id",
            F.col("first.doc_id").alias("group_id"),
            F.col("copies").alias("class_size"),
            (F.col("first.uid") == F.col("uid")).alias("keep"),
        )
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and group of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("hash")
