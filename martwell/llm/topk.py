"""Exact top-k inner products by a bit-sliced index.

Every component x becomes the integer floor(scale * x).  Rows are dealt evenly
into blocks of about ``BLOCK_ROWS``; a block's index holds, for each dimension,
the row bitmaps of the upper ``SLICES`` bits of value - least value, and the
integers themselves.

For a block of queries, slices are added up with bitmap arithmetic: query
weight |q| times slice is a shift and a ripple addition, a negative weight
takes the slices of the reflected attribute (their complement).  That gives,
bit by bit, a score of the quantised values for every row of the block and
every query at once, and a bound on what the cut-off bits can add.  The k-th
greatest quantised score is found from the most significant slice downward;
rows within the bound of it are the boundary and are scored exactly.  A block
gives each query its k best rows, and the best k of all blocks are the result.

Query blocks meet index blocks by an equi-join on the block number; neither
side is collected or broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwell.llm.common import ship, stored, table

SCALE = 1024
BLOCK_ROWS = 8192
QUERY_ROWS = 128
SLICES = 7
LONG = 1 << 63

_INDEX_DDL = (
    "block int, rows int, dims int, cut int, ids binary, least binary, integers binary, slices binary"
)
_QUERY_DDL = "query_block long, uids binary, ids binary, dims int, integers binary"
_BEST_DDL = "uid long, query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return vector.isNotNull() & ~bad


def quantised(vector: Column, scale: int = SCALE) -> Column:
    def whole(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * F.lit(float(scale)))
        fits = F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(float(LONG))
        return F.when(fits, scaled.cast("bigint")).otherwise(F.raise_error(F.lit("a quantised component is no long")).cast("bigint"))

    return F.transform(vector, whole)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix, shorter rows filled with zeros."""
    rows = [np.asarray(v.values.to_numpy(zero_copy_only=False), np.int64) for v in column]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _greatest(values: np.ndarray) -> int:
    """Greatest amount of any component."""
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def exact_scores(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of rows with a query: in 64 bits where none can leave them,
    else in whole numbers of any size."""
    if _greatest(values) * _greatest(query) * max(1, len(query)) < LONG:
        return values @ query
    return (values.astype(object) * query.astype(object)).sum(axis=1)


def _pack(flags: np.ndarray) -> np.ndarray:
    """Rows of booleans as little-endian 64-bit words."""
    words = -(-flags.shape[-1] // 64)
    bytes_ = np.packbits(flags, axis=-1, bitorder="little")
    out = np.zeros((*flags.shape[:-1], words * 8), np.uint8)
    out[..., : bytes_.shape[-1]] = bytes_
    return out.view(np.uint64)


def slice_block(values: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """Least value per dimension, number of cut-off bits, and the bitmaps
    (dimension, slice, words) of the upper bits, least slice first."""
    least = values.min(axis=0)
    raised = values.view(np.uint64) - least.view(np.uint64)  # no overflow: it wraps to the true difference
    bits = int(raised.max()).bit_length() if raised.size else 0
    cut = max(0, bits - SLICES)
    planes = [(raised >> np.uint64(cut + b)) & np.uint64(1) for b in range(bits - cut)]
    packed = [_pack(p.T.astype(bool)) for p in planes]
    words = -(-len(values) // 64)
    slices = np.stack(packed, axis=1) if packed else np.zeros((values.shape[1], 0, words), np.uint64)
    return least, cut, slices


class BitCounter:
    """Sums of bitmaps: bit p of every row's sum is ``bits[p]``.  Three bitmaps
    of a place become one there and a carry (full adder)."""

    def __init__(self):
        self.waiting: list[list[np.ndarray]] = []

    def add(self, bitmap: np.ndarray, place: int) -> None:
        while len(self.waiting) <= place:
            self.waiting.append([])
        here = self.waiting[place]
        here.append(bitmap)
        if len(here) == 3:
            a, b, c = here
            half = a ^ b
            self.waiting[place] = [half ^ c]
            self.add((a & b) | (half & c), place + 1)

    def bits(self, like: np.ndarray) -> list[np.ndarray]:
        place = 0
        while place < len(self.waiting):
            here = self.waiting[place]
            if len(here) == 2:
                a, b = here
                self.waiting[place] = [a ^ b]
                self.add(a & b, place + 1)
            elif not here:
                self.waiting[place] = [np.zeros_like(like)]
            place += 1
        return [w[0] for w in self.waiting]


def quantised_scores(slices: np.ndarray, queries: np.ndarray, shape: np.ndarray) -> list[np.ndarray]:
    """Bit slices (queries, words) of sum |q| * quantised attribute, where a
    negative q takes the reflected attribute."""
    counter = BitCounter()
    weights = np.abs(queries).astype(np.uint64)
    for d in range(queries.shape[1]):
        flip = np.where(queries[:, d] < 0, ~np.uint64(0), np.uint64(0))[:, None]
        chosen = [
            (j, np.where((weights[:, d] >> np.uint64(j)) & np.uint64(1), ~np.uint64(0), np.uint64(0))[:, None])
            for j in range(int(weights[:, d].max()).bit_length())
        ]
        for b in range(slices.shape[1]):
            bitmap = slices[d, b][None] ^ flip
            for j, mask in chosen:
                counter.add(bitmap & mask, b + j)
    return counter.bits(shape)


def _count(bitmap: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bitmap).sum(axis=1, dtype=np.int64)


def kth_greatest(bits: list[np.ndarray], rows: np.ndarray, k: int) -> list[np.ndarray]:
    """Slices of each query's k-th greatest score (0 if fewer rows) as masks,
    greatest slice first."""
    sure, equal, found = np.zeros_like(rows), rows.copy(), []
    for plane in reversed(bits):
        with_bit = sure | (equal & plane)
        enough = (_count(with_bit) >= k)[:, None]
        found.append(enough)
        sure = np.where(enough, sure, with_bit)
        equal = np.where(enough, equal & plane, equal & ~plane)
    return found


def at_least(bits: list[np.ndarray], rows: np.ndarray, bounds: list[int]) -> np.ndarray:
    """Rows whose sum is at least the query's bound."""
    greater, equal = np.zeros_like(rows), rows.copy()
    for p in range(len(bits) - 1, -1, -1):
        one = np.array([(b >> p) & 1 for b in bounds], bool)[:, None]
        greater = np.where(one, greater, greater | (equal & bits[p]))
        equal = np.where(one, equal & bits[p], equal & ~bits[p])
    return greater | equal


def block_top(
    ids: np.ndarray, values: np.ndarray, least: np.ndarray, cut: int, slices: np.ndarray,
    query_ids: np.ndarray, queries: np.ndarray, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, row numbers, scores) of each query's k best rows."""
    dims = min(values.shape[1], queries.shape[1])
    exact_values, exact_queries = values[:, :dims], queries[:, :dims]
    rows = np.repeat(_pack(np.ones((1, len(ids)), bool)), len(queries), axis=0)
    own = np.stack([_pack((ids == q)[None])[0] for q in query_ids]) if len(query_ids) else rows
    rows &= ~own
    bits = quantised_scores(slices[:dims], exact_queries, rows)
    threshold = kth_greatest(bits, rows, k)
    slack = [sum(abs(x) for x in q) * ((1 << cut) - 1) for q in exact_queries.tolist()]
    bounds = []
    for i in range(len(queries)):
        value = sum(1 << (len(bits) - 1 - p) for p, mask in enumerate(threshold) if mask[i, 0])
        # a row may gain the slack that the k-th has not got
        bounds.append(max(0, value - -(-slack[i] >> cut) if cut else value))
    boundary = np.unpackbits(at_least(bits, rows, bounds).view(np.uint8), axis=1, bitorder="little")
    for i in range(len(queries)):
        near = np.flatnonzero(boundary[i, : len(ids)])
        score = exact_scores(exact_values[near], exact_queries[i])
        if score.dtype == object:
            best = np.array(sorted(range(len(near)), key=lambda j: (-score[j], ids[near[j]]))[:k], np.int64)
            if any(not -LONG <= x < LONG for x in score[best]):
                raise ValueError("a score is no long")
        else:
            best = np.lexsort((ids[near], -score))[:k]
        yield i, near[best], score[best].astype(np.int64)


def build_index(vectors: DataFrame, blocks: int) -> DataFrame:
    """``vectors`` (vec_id, v: integers) as index blocks, stored."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        ids = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in held]).astype(np.int64)
        values = _matrix(pa.concat_arrays([b.column(1) for b in held]))
        least, cut, slices = slice_block(values)
        row = [
            TaskContext.get().partitionId(), len(ids), values.shape[1], cut, ids.tobytes(),
            least.tobytes(), values.astype(np.int32 if _greatest(values) < 1 << 31 else np.int64).tobytes(), slices.tobytes(),
        ]
        kinds = [pa.int32()] * 4 + [pa.binary()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip(row, kinds)], names=[x.split()[0] for x in _INDEX_DDL.split(", ")]
        )

    return stored(vectors.select("vec_id", "v").repartition(blocks).mapInArrow(build, _INDEX_DDL), "bit-slices")


def _query_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, QUERY_ROWS):
            some = batch.slice(at, QUERY_ROWS)
            uids, ids = (some.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
            values = _matrix(some.column(2))
            row = [(task << 32) + number, uids.tobytes(), ids.tobytes(), values.shape[1], values.tobytes()]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, kinds)], names=[x.split()[0] for x in _QUERY_DDL.split(", ")]
            )


def top_k(vectors: DataFrame, queries: DataFrame, k: int, *, scale: int = SCALE) -> DataFrame:
    """Per row of ``queries`` (vec_id, embedding) the k rows of ``vectors`` with
    the greatest integer inner product, but for rows of the query's own id:
    query_id, rank, vec_id, score; ties go to the smaller vec_id.

    Vectors or queries that are null or hold null or non-finite components,
    and null ids, take no part; a missing component counts as 0; repeated rows
    are rows of their own; an empty table gives no rows; other columns are not
    read.  Large components take part like any (scores that could leave 64 bits are
    added up in whole numbers of any size); the job stops with an error only if a
    scaled component, or a score of the result, is no long."""
    spark = vectors.sparkSession
    ship(spark)

    def rows(df: DataFrame) -> DataFrame:
        sound = df.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        return sound.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("v"))

    every = rows(vectors)
    blocks = max(1, -(-every.count() // BLOCK_ROWS))
    index = build_index(every, blocks)
    asked = rows(queries).select(F.monotonically_increasing_id().alias("uid"), "vec_id", "v")
    asked = asked.mapInArrow(_query_blocks, _QUERY_DDL)
    pairs = (
        asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumnsRenamed({"ids": "query_ids", "dims": "query_dims", "integers": "query_integers"})
        .join(index, "block")
        .select(
            "uids", "query_ids", "query_dims", "query_integers",
            "rows", "dims", "cut", "ids", "least", "integers", "slices",
        )
    )

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                uids, query_ids, ids, least = (
                    np.frombuffer(r[n], np.int64) for n in ("uids", "query_ids", "ids", "least")
                )
                kind = np.int32 if len(r["integers"]) == 4 * r["rows"] * r["dims"] else np.int64
                values = np.frombuffer(r["integers"], kind).reshape(r["rows"], r["dims"]).astype(np.int64)
                asked_ = np.frombuffer(r["query_integers"], np.int64).reshape(len(uids), r["query_dims"])
                slices = np.frombuffer(r["slices"], np.uint64).reshape(r["dims"], -1, -(-r["rows"] // 64))
                found = [
                    (uids[q], query_ids[q], ids[row], score)
                    for q, near, scores in block_top(ids, values, least, r["cut"], slices, query_ids, asked_, k)
                    for row, score in zip(near, scores)
                ]
                cols = zip(*found) if found else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(list(c), np.int64)) for c in cols], names=["uid", "query_id", "vec_id", "score"]
                )

    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.mapInArrow(best, _BEST_DDL)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op9_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"), 10)
