"""Exact ranked lexical search by norm buckets of impact vectors (as LEMP has them).

A document is a sparse vector of impacts, an item (query) a sparse vector of
term weights times repeats, and a score their inner product in integers.

1. Items are taken in blocks of bounded size (``BLOCK_ITEMS`` rows and
   ``BLOCK_CHARS`` of text, or one item), so a block's terms and weights fit
   every task whatever the number of items.  Every document is cut into terms
   once a block; kept are the block's terms in it with their counts.
2. Corpus counts (documents, terms, documents per term) are sums over all
   documents, pre-aggregated by the tasks.
3. Documents are dealt to ranges of their vector's length (Euclidean norm),
   greatest first; a bucket is a run of ``BUCKET_ROWS`` documents of about the
   same length.
4. The longest documents are scored for all items; the k-th best score of each
   item there is a bound that every later bucket starts from.
5. Bucket by bucket: an item whose norm times the bucket's greatest length is
   below its bound skips the bucket (Cauchy-Schwarz).  Else the bound, over both
   lengths, is the least cosine of interest, which gives a range for each
   coordinate of the document's direction; documents outside the range at the
   item's heaviest coordinates are left out.  The survivors are scored exactly
   in 64-bit integers, and a task's bound rises with what it finds.

Lengths and ranges are doubles; the bounds are widened by ``SAFETY`` so that no
rounding leaves out a document.  A task holds one bucket and k rows per item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwell.llm.common import kept_by, ship, steps, stored, table

BLOCK_ITEMS, BLOCK_CHARS = 1024, 2_000_000
BUCKET_ROWS = 4096
#: Documents (about) that give the first bounds.
FIRST_ROWS = 4096
#: Heaviest coordinates of an item that are looked at inside a bucket.
FOCUS = 4
SAFETY = 1e-9
#: Fixed values of the score.
TOP, K1, MIX, FLOOR = 1_000_000_000, 1000, 75, 100
#: Separators become blanks and A-Z become a-z, byte by byte: all of them are
#: ASCII, and no byte of another character is.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

_COUNTED_DDL = "uid long, doc_id long, n long, terms binary, tfs binary"
_BEST_DDL = "item int, score long, doc_id long, uid long"


def terms_of(text: str) -> list[bytes]:
    """The terms, in order."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


# ---- items -----------------------------------------------------------------------------


def _item_blocks(items: DataFrame) -> Iterator[DataFrame]:
    """``items`` (uid, item_id, text) in blocks of bounded size: blocks are
    planned from the stored texts' sizes, a range of uids each."""
    sizes = items.select("uid", F.length("text").alias("n")).repartitionByRange("uid").sortWithinPartitions("uid")
    first = last = None
    rows = chars = 0
    for uid, n in sizes.toLocalIterator():
        if rows and (rows == BLOCK_ITEMS or chars + n > BLOCK_CHARS):
            yield items.filter(F.col("uid").between(first, last))
            rows = chars = 0
        first = uid if not rows else first
        last, rows, chars = uid, rows + 1, chars + n
    if rows:
        yield items.filter(F.col("uid").between(first, last))


class Block:
    """Items of a block as rows of term numbers and repeats."""

    def __init__(self, rows: list):
        self.uids = [r.uid for r in rows]
        self.vocabulary: dict[bytes, int] = {}
        self.terms, self.repeats = [], []
        for r in rows:
            found = Counter(terms_of(r.text or ""))
            self.terms.append(np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in found], np.int64))
            self.repeats.append(np.array(list(found.values()), np.int64))


# ---- documents -------------------------------------------------------------------------


def _count(batches: Iterable[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    kept_by("lexical")
    number = vocabulary.get
    for batch in batches:
        for part in steps(batch, 2, 4_000_000):
            n, ids, tfs = [], [], []
            for text in part.column(2).to_pylist():
                words = terms_of(text) if text else []
                n.append(len(words))
                found = Counter(map(number, words))
                found.pop(None, None)
                ids.append(np.fromiter(found.keys(), np.int32, len(found)).tobytes())
                tfs.append(np.fromiter(found.values(), np.int64, len(found)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())],
                names=["uid", "doc_id", "n", "terms", "tfs"],
            )


def _documents_per_term(batches: Iterable[pa.RecordBatch], terms: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(terms, np.int64)
    for batch in batches:
        ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32)
        total += np.bincount(ids, minlength=terms)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (TOP * tf) // (K1 * tf + 8 * m)


def _lengths(batches: Iterable[pa.RecordBatch], docs: int, all_terms: int) -> Iterator[pa.RecordBatch]:
    """uid, doc_id, terms, impacts and the length of every impact vector."""
    for batch in batches:
        n = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        tf = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.int64)
        sizes = pa.compute.binary_length(batch.column(4)).to_numpy(zero_copy_only=False) // 8
        m = FLOOR - MIX + (MIX * n * docs) // all_terms
        impact = impacts(tf, np.repeat(m, sizes))
        ends = np.cumsum(sizes)
        parts = [impact[e - s : e] for s, e in zip(sizes, ends)]
        # each row's own sum: a difference of running sums would lose digits
        norm = [math.sqrt(float((p.astype(np.float64) ** 2).sum())) for p in parts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(3), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array(norm, pa.float64())],
            names=["uid", "doc_id", "terms", "impacts", "norm"],
        )


# ---- buckets ---------------------------------------------------------------------------


class Bucket:
    """Documents of about the same length, by term: rows and impacts."""

    def __init__(self, uid, doc_id, no_id, terms: list[bytes], impact: list[bytes], norm: np.ndarray):
        self.uid, self.doc_id, self.no_id, self.norm = uid, doc_id, no_id, norm
        ids = np.frombuffer(b"".join(terms), np.int32).astype(np.int64)
        values = np.frombuffer(b"".join(impact), np.int64)
        rows = np.repeat(np.arange(len(terms)), [len(t) // 4 for t in terms])
        order = np.argsort(ids, kind="stable")
        self.rows, self.values = rows[order], values[order]
        self.held, first = np.unique(ids[order], return_index=True)
        self.first = np.append(first, len(ids))
        self.longest = float(norm.max()) if len(norm) else 0.0

    def list_of(self, term: int) -> slice:
        i = int(np.searchsorted(self.held, term))
        if i == len(self.held) or self.held[i] != term:
            return slice(0, 0)
        return slice(int(self.first[i]), int(self.first[i + 1]))

    def survivors(self, terms: np.ndarray, weights: np.ndarray, length: float, bound: int) -> np.ndarray | None:
        """Mask of the rows whose score may be ``bound`` or more; None if no row's can."""
        keep = np.ones(len(self.norm), bool)
        if bound <= 0 or length <= 0:
            return keep
        if length * self.longest * (1 + SAFETY) < bound:
            return None
        keep &= length * self.norm * (1 + SAFETY) >= bound
        least = np.minimum(1.0, bound / (length * np.maximum(self.norm, 1e-300)) * (1 - SAFETY))
        direction = weights / length
        for i in np.argsort(-direction, kind="stable")[:FOCUS]:
            q = float(direction[i])
            spread = np.sqrt(np.maximum(0.0, (1 - least**2) * max(0.0, 1 - q * q)))
            at = self.list_of(int(terms[i]))
            value = np.zeros(len(self.norm))
            value[self.rows[at]] = self.values[at]
            value /= np.maximum(self.norm, 1e-300)
            # the angle between both is arccos(least) at most; beyond the item's own angle there is no upper end
            keep &= (value >= q * least - spread - SAFETY) & ((value <= q * least + spread + SAFETY) | (q > least))
        return keep

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of all rows in integers."""
        out = np.zeros(len(self.norm), np.int64)
        for t, w in zip(terms.tolist(), weights.tolist()):
            at = self.list_of(t)
            out[self.rows[at]] += w * self.values[at]
        return out


class Search:
    """k best documents of every item over the buckets of a task."""

    def __init__(self, terms: list[np.ndarray], weights: list[np.ndarray], bounds: list[int], k: int):
        self.terms, self.weights, self.k = terms, weights, k
        self.length = [math.sqrt(float((w.astype(np.float64) ** 2).sum())) for w in weights]
        self.bounds = list(bounds)
        self.best: list[tuple[np.ndarray, ...] | None] = [None] * len(terms)
        self.skipped = self.scored = 0

    def add(self, b: Bucket) -> None:
        for i, (terms, weights) in enumerate(zip(self.terms, self.weights)):
            keep = b.survivors(terms, weights, self.length[i], self.bounds[i])
            if keep is None or not keep.any():
                self.skipped += 1
                continue
            self.scored += int(keep.sum())
            score = b.scores(terms, weights)
            near = np.flatnonzero(keep & (score > 0) & (score >= self.bounds[i]))
            if not near.size:
                continue
            found = score[near], b.no_id[near], b.doc_id[near], b.uid[near]
            if self.best[i] is not None:
                found = tuple(np.concatenate(x) for x in zip(self.best[i], found))
            top = np.lexsort((found[3], found[2], found[1], -found[0]))[: self.k]
            self.best[i] = tuple(x[top] for x in found)
            if len(top) == self.k:
                self.bounds[i] = max(self.bounds[i], int(self.best[i][0][-1]))

    def rows(self) -> pa.RecordBatch:
        some = [(i, x) for i, x in enumerate(self.best) if x is not None]
        item = np.concatenate([np.full(len(x[0]), i) for i, x in some] or [np.zeros(0, np.int64)])
        score, no_id, doc_id, uid = (
            np.concatenate([x[j] for _, x in some] or [np.zeros(0, np.int64)]) for j in range(4)
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(doc_id, pa.int64(), mask=no_id.astype(bool)), pa.array(uid, pa.int64())],
            names=["item", "score", "doc_id", "uid"],
        )


def _search(batches: Iterable[pa.RecordBatch], terms, weights, bounds, k) -> Iterator[pa.RecordBatch]:
    kept_by("lexical")
    search = Search(terms, weights, bounds, k)
    for batch in batches:
        for at in range(0, batch.num_rows, BUCKET_ROWS):
            part = batch.slice(at, BUCKET_ROWS)
            uid, doc_id = (part.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
            no_id = part.column(1).is_null().to_numpy(zero_copy_only=False)
            norm = part.column(4).to_numpy(zero_copy_only=False)
            search.add(Bucket(uid, doc_id, no_id, part.column(2).to_pylist(), part.column(3).to_pylist(), norm))
    yield search.rows()


def _best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    block = Block(items.select("uid", "text").collect())  # of bounded size
    counted = stored(docs.mapInArrow(partial(_count, vocabulary=block.vocabulary), _COUNTED_DDL), "lexical-counts")
    told = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    per_term = counted.select("terms").mapInArrow(
        partial(_documents_per_term, terms=len(block.vocabulary)), "term long, df long"
    )
    df = np.zeros(len(block.vocabulary), np.int64)
    for r in per_term.groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row per term of the block
        df[r.term] = r.df
    w = np.array([math.floor(1000 * math.log((2 * told.docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    if not told.docs:
        return spark.createDataFrame([], "uid long, rank int, doc_id long, score long")
    weights = [w[t] * r for t, r in zip(block.terms, block.repeats)]
    vectors = counted.filter(F.length("terms") > 0).mapInArrow(
        partial(_lengths, docs=told.docs, all_terms=told.terms),
        "uid long, doc_id long, terms binary, impacts binary, norm double",
    )
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = vectors.repartitionByRange(ranges, F.desc("norm"), F.asc("uid")).sortWithinPartitions(F.desc("norm"), "uid")
    ordered = stored(ordered, "lexical-vectors")
    share = min(1.0, FIRST_ROWS / told.docs)
    cut = ordered.agg(F.percentile_approx("norm", 1 - share, 10_000)).first()[0]
    if cut is None:
        return spark.createDataFrame([], "uid long, rank int, doc_id long, score long")
    nothing = [0] * len(weights)
    first = ordered.filter(F.col("norm") >= cut).mapInArrow(
        partial(_search, terms=block.terms, weights=weights, bounds=nothing, k=k), _BEST_DDL
    )
    bounds = list(nothing)
    for r in _best_of(first, k).filter(F.col("rank") == k).select("item", "score").collect():  # a row per item of the block
        bounds[r.item] = r.score
    found = ordered.mapInArrow(partial(_search, terms=block.terms, weights=weights, bounds=bounds, k=k), _BEST_DDL)
    uid = F.element_at(F.array(*map(F.lit, block.uids)), F.col("item") + 1).cast("long")
    return _best_of(found, k).select(uid.alias("uid"), "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int, *, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``items`` its ``k`` best rows of ``docs`` with a score above 0:
    item_id, rank (from 1), doc_id, score; equal scores go by doc_id (null last),
    then by the row's place.

    A null text has no terms; a document or item without terms takes no part
    (and is in no count); repeated rows are rows of their own, also with the same
    or a null id; an empty table gives no rows; other columns are not read.
    Whole texts are cut into terms, however long."""
    spark = docs.sparkSession
    ship(spark)
    asked = items.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(item_col).cast("long").alias("item_id"),
        F.col(text_col).alias("text"),
    )
    asked = stored(asked.withColumn("text", F.coalesce("text", F.lit(""))), "lexical-items")
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(doc_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    out = None
    for block in _item_blocks(asked):
        found = _search_block(rows, block, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.join(asked.select("uid", "item_id"), "uid").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
