"""Removal of repeated strings by suffix arrays of shards.

Each byte that is covered by a string of ``length`` bytes (a window) which also
starts anywhere else, in the same document or another, goes.

1. A window's anchor is its least hashed string of ``gram`` bytes (11/25 of the
   window; the leftmost, if equal).  Equal windows have equal anchors.  Windows of a document that
   follow each other and share an anchor make a piece: its text is the union of
   these windows.  A window is in exactly one piece.
2. Anchors are counted over all documents.  A piece with an anchor that is seen
   once holds no repeated window and goes no further.  Equal pieces (groups of
   copies, the inside of a common passage) are counted, not compared: all their
   windows are repeated, and one of them stands for all in what follows.
3. Different pieces with one anchor are compared in a shard: their texts, one
   after the other, get a suffix array by induced sorting and permuted common
   prefixes (``suffixes``).  A window is repeated if its suffix shares ``length``
   bytes with its neighbour in the array.  A shard holds whole anchors, about
   ``SHARD_BYTES``.
4. An anchor with more than ``MOST`` different pieces (a short common line, the
   edge of a common passage) is split instead: the windows of its pieces are cut
   in two at the same distance from the anchor, and a half's key is what all its
   windows share, which is longer than the anchor was.  Halves are counted and
   compared as pieces are; in the end a half is one window.  So no anchor is
   compared in one task, and none is left out.
5. The repeated windows of each different piece return to all documents with it,
   joined by the piece, and each document is cut.

Texts are read as UTF-8 bytes; the byte 0xFF, which UTF-8 has not, stands
between pieces.  Hashes only choose what is compared and count equal pieces
(128 bits); what differs is compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwell.llm.common import kept_by, ship, steps, stored, table, text_of
from martwell.llm.shingles import mixed
from martwell.llm.suffixes import common_prefixes, suffix_array

LENGTH = 400
#: Bytes that one numpy step holds, and text of a suffix array.
CHUNK = 1_000_000
SHARD_BYTES = 1_000_000
#: Different pieces of an anchor that are compared in one shard.
MOST = 1024
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE_BITS = 24  # of a place in a chunk

_SEEN_DDL = "doc binary, key long, p1 long, p2 long, n long"
_TEXT_DDL = "key long, p1 long, p2 long, n long, kinds long, q1 long, q2 long, shift int, before int, low int, high int, body binary"
_MARK_DDL = "p1 long, p2 long, low int, high int"


# ---- pieces ----------------------------------------------------------------------------


def _powers(n: int, kept: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the base, of its inverse, and a hash of every byte value."""
    if len(kept.get("up", ())) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps_ = np.full(n, base, np.uint64)
            steps_[0] = 1
            kept[name] = np.cumprod(steps_, dtype=np.uint64)
        kept["of"] = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1))
    return kept["up"][:n], kept["down"][:n], kept["of"]


def _grams(data: np.ndarray, size: int, kept: dict) -> np.ndarray:
    """A hash of the ``size`` bytes from every place."""
    up, down, of = _powers(len(data) + 1, kept)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(of[data] * up[:-1], dtype=np.uint64, out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * down[: len(data) - size + 1])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values that follow each other."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def gram(length: int) -> int:
    """Bytes of an anchor: longer ones tell more texts apart, shorter ones make fewer pieces."""
    return max(1, length * 11 // 25)


def cut(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """The pieces of documents that lie one after the other in ``data`` and end
    at ``ends``: first window, one behind the last window, place of the anchor,
    hash of the anchor."""
    kept = kept_by("repeats")
    end_of = np.repeat(ends, np.diff(np.append(0, ends)))
    found: list[list[np.ndarray]] = [[], [], [], []]
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    for at in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[at : at + CHUNK + length - 1]
        hashed = _grams(part, gram(length), kept)
        least = _least((hashed & ~mask) | np.arange(len(hashed), dtype=np.uint64), length - gram(length) + 1)
        window = np.flatnonzero(end_of[at : at + len(least)] - np.arange(at, at + len(least)) >= length)
        if not window.size:
            continue
        anchor = (least[window] & mask).astype(np.int64)
        new = np.ones(len(window), bool)
        new[1:] = (np.diff(window) != 1) | (np.diff(anchor) != 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(window)) - 1
        for out, values in zip(found, (window[first] + at, window[last] + at + 1, anchor[first] + at, hashed[anchor[first]])):
            out.append(values)
    if not found[0]:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in found)


def _digests(raw: bytes, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """128-bit hashes of the strings, as rows of two signed words."""
    told = b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(first.tolist(), stop.tolist()))
    return np.frombuffer(told, ">i8").astype(np.int64).reshape(-1, 2)


def _bytes_of(texts: list[str]) -> tuple[bytes, np.ndarray]:
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    return b"".join(parts), np.cumsum([len(p) for p in parts], dtype=np.int64)


def _same_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the different rows, and how often each is there."""
    order = np.lexsort(rows.T[::-1])
    new = np.ones(len(order), bool)
    new[1:] = (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _seen(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The different pieces of every document (doc, text)."""
    for batch in batches:
        for part in steps(batch, 1, CHUNK):
            raw, ends = _bytes_of(part.column(1).to_pylist())
            first, stop, _, key = cut(np.frombuffer(raw, np.uint8), ends, length)
            told = _digests(raw, first, stop + length - 1)
            row = np.searchsorted(ends, first, "right")
            some, count = _same_rows(np.column_stack([row, told]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row[some])), pa.array(key[some].view(np.int64)),
                 pa.array(told[some, 0]), pa.array(told[some, 1]), pa.array(count)],
                names=["doc", "key", "p1", "p2", "n"],
            )


def _bodies(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The texts of the wanted pieces (text, wanted: array of key, p1, p2, n, kinds)."""
    for batch in batches:
        for i in range(batch.num_rows):
            text, wanted = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            raw, ends = _bytes_of([text])
            first, stop, anchor, _ = cut(np.frombuffer(raw, np.uint8), ends, length)
            told = _digests(raw, first, stop + length - 1)
            place = {(a, b): j for j, (a, b) in enumerate(told.tolist())}
            rows = [(w, place[w["p1"], w["p2"]]) for w in wanted if (w["p1"], w["p2"]) in place]
            names = ["key", "p1", "p2", "n", "kinds"]
            held = [pa.array([w[c] for w, _ in rows], pa.int64()) for c in names]
            where = np.array([j for _, j in rows], np.int64)
            a, b = first[where], stop[where] + length - 1
            yield pa.RecordBatch.from_arrays(
                [*held, held[1], held[2], pa.array(np.zeros(len(rows), np.int32)), pa.array((anchor[where] - a).astype(np.int32)),
                 pa.array(np.zeros(len(rows), np.int32)), pa.array(np.full(len(rows), length - gram(length) + 1, np.int32)),
                 pa.array([raw[x:y] for x, y in zip(a.tolist(), b.tolist())], pa.binary())],
                names=[x.split()[0] for x in _TEXT_DDL.split(", ")],
            )


# ---- comparing -------------------------------------------------------------------------


def repeated_windows(bodies: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """(text, first window, one behind the last) of the windows of different
    ``bodies`` that stand in two places of them."""
    raw = b"\xff".join(bodies) + b"\xff"
    data = np.frombuffer(raw, np.uint8)
    ends = np.cumsum([len(b) + 1 for b in bodies])
    before, shared = common_prefixes(data, suffix_array(data))
    hit = np.zeros(len(data) + 1, bool)
    long_ = np.flatnonzero(shared >= length)
    hit[long_] = True
    hit[before[long_]] = True
    # what starts too late for a window in its text is no window
    starts = np.append(0, ends[:-1])
    windows = np.maximum(0, np.array([len(b) for b in bodies]) - length + 1)
    inside = np.zeros(len(data) + 2, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + windows, -1)
    hit &= np.cumsum(inside)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        i = int(np.searchsorted(ends, a, "right"))
        yield i, a - int(starts[i]), b - int(starts[i])


def _compare(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Marks of rows (key, p1, p2, shift, body) that come in the order of key."""
    kept_by("repeats")
    held: list[tuple] = []
    size = 0

    def done() -> pa.RecordBatch:
        found = [
            (held[i][1], held[i][2], held[i][3] + a, held[i][3] + b)
            for i, a, b in repeated_windows([x[4] for x in held], length)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            names=["p1", "p2", "low", "high"],
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[0] != held[-1][0] and size + len(row[4]) > SHARD_BYTES:
                yield done()
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield done()


def _halves(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every row of ``_TEXT_DDL`` as its two halves; kinds is open."""
    kinds = [pa.int64()] * 7 + [pa.int32()] * 4 + [pa.binary()]
    for batch in batches:
        out = []
        for key, p1, p2, n, _, _, _, shift, before, low, high, body in zip(*(c.to_pylist() for c in batch.columns)):
            middle = (low + high) // 2
            for a, b in ((low, middle), (middle, high)):
                # windows from a up to b - 1 bytes before the anchor, as far as the piece has them
                first, last = max(0, before - b + 1), min(len(body) - length, before - a)
                if a == b or first > last:
                    continue
                common = body[before - a : before - b + 1 + length]
                text = body[first : last + length]
                half = np.uint64(xxhash.xxh3_64_intdigest(b"%d %d %d " % (key, a, b) + common)).astype(np.int64)
                q = _digests(text, np.zeros(1, np.int64), np.array([len(text)]))[0]
                out.append((int(half), p1, p2, n, 0, int(q[0]), int(q[1]), shift + first, before - first, a, b, text))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 12, kinds)],
            names=[x.split()[0] for x in _TEXT_DDL.split(", ")],
        )


def _compared(texts: DataFrame, length: int) -> DataFrame:
    """Marks of the pieces, whole keys dealt to shards."""
    size = texts.agg(F.sum(F.length("body"))).first()[0] or 0
    least = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, min(-(-size // (SHARD_BYTES // 4)), max(least, -(-size // SHARD_BYTES))))
    dealt = texts.select("key", "p1", "p2", "shift", "body").repartition(shards, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(partial(_compare, length=length), _MARK_DDL)


def _split(texts: DataFrame, length: int, most: int) -> list[DataFrame]:
    """Marks of the pieces whose keys have too many of them, half by half."""
    marks = []
    while not texts.isEmpty():
        halves = stored(texts.mapInArrow(partial(_halves, length=length), _TEXT_DDL), "repeats-halves")
        same = halves.groupBy("key", "q1", "q2").agg(F.sum("n").alias("m"))
        per_key = same.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.sum("m").alias("total")).filter("total > 1")
        told = stored(same.join(per_key, "key"), "repeats-keys")
        full = halves.join(told.filter("m > 1").select("key", "q1", "q2"), ["key", "q1", "q2"])
        high = F.col("shift") + F.octet_length("body") - length + 1
        marks.append(full.select("p1", "p2", F.col("shift").alias("low"), high.cast("int").alias("high")))
        several = halves.drop("kinds").join(told.filter("k > 1").select("key", "q1", "q2", F.col("k").alias("kinds")), ["key", "q1", "q2"])
        one = several.dropDuplicates(["key", "q1", "q2"]).select(*texts.columns)
        left = stored(one, "repeats-texts")
        marks.append(_compared(left.filter(F.col("kinds") <= most), length))
        texts = left.filter(F.col("kinds") > most)
    return marks


# ---- documents -------------------------------------------------------------------------


def _runs(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as ranges in order."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > high[:-1]
    first = np.flatnonzero(new)
    return low[first], high[np.append(first[1:], len(low)) - 1]


def _cut_out(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """n_bytes, spans and what is kept of rows (row, text, marks)."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for part in steps(batch, 1, CHUNK):
            sizes, spans, kept = [], [], []
            for text, marks in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                sizes.append(len(raw))
                found = []
                if marks:
                    first, stop, _, _ = cut(np.frombuffer(raw, np.uint8), np.array([len(raw)]), length)
                    runs = {(m["p1"], m["p2"]): m["runs"] for m in marks}
                    told = _digests(raw, first, stop + length - 1).tolist()
                    ranges = [
                        (a + r["low"], min(a + r["high"], b) + length - 1)
                        for a, b, p in zip(first.tolist(), stop.tolist(), told)
                        for r in runs.get(tuple(p), ())
                    ]
                    if ranges:
                        low, high = _runs(*np.array(ranges, np.int64).T)
                        found = list(zip(low.tolist(), high.tolist()))
                spans.append([{"start": a, "end": b} for a, b in found])
                at, pieces = 0, []
                for a, b in found:
                    pieces.append(raw[at:a])
                    at = b
                kept.append(b"".join([*pieces, raw[at:]]) if found else raw)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )


def _doc_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def repeated_marks(docs: DataFrame, length: int = LENGTH, most: int = MOST) -> DataFrame:
    """(doc, marks: array of piece and its repeated windows) of every text of
    ``docs`` (doc: digest of the text, doc_id, text) that has repeated windows."""
    seen = docs.filter(F.octet_length("text") >= length).select("doc", "text").mapInArrow(partial(_seen, length=length), _SEEN_DDL)
    anchors = seen.groupBy("key").agg(F.sum("n").alias("total")).filter("total > 1").select("key")
    shared = stored(seen.join(anchors, "key"), "repeats-seen")
    pieces = shared.groupBy("key", "p1", "p2").agg(F.sum("n").alias("n"), F.min("doc").alias("doc"))
    kinds = pieces.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("singles"))
    pieces = stored(pieces.join(kinds, "key"), "repeats-pieces")
    several = pieces.filter("kinds > 1 and singles > 0")
    asked = several.groupBy("doc").agg(F.collect_list(F.struct("key", "p1", "p2", "n", "kinds")).alias("wanted"))
    # one of the rows with that text: its smallest id
    ids = docs.select("doc", "doc_id").groupBy("doc").agg(F.min("doc_id").alias("one_id"))
    asked = asked.join(ids, "doc").withColumnRenamed("doc", "asked")
    at_it = (F.col("doc") == F.col("asked")) & F.col("doc_id").eqNullSafe(F.col("one_id"))
    rows = docs.join(asked, at_it).select("text", "wanted")
    texts = rows.mapInArrow(partial(_bodies, length=length), _TEXT_DDL).dropDuplicates(["key", "p1", "p2"])
    texts = stored(texts, "repeats-texts")
    whole = pieces.filter("n > 1").select(
        "p1", "p2", F.lit(0).alias("low"), F.lit(np.iinfo(np.int32).max // 2).cast("int").alias("high")
    )
    marks = [whole, _compared(texts.filter(F.col("kinds") <= most), length), *_split(texts.filter(F.col("kinds") > most), length, most)]
    told = marks[0]
    for more in marks[1:]:
        told = told.unionByName(more)
    by_piece = stored(told.groupBy("p1", "p2").agg(F.collect_set(F.struct("low", "high")).alias("runs")), "repeats-marks")
    own = shared.join(by_piece, ["p1", "p2"]).select("doc", F.struct("p1", "p2", "runs").alias("m"))
    return own.groupBy("doc").agg(F.collect_set("m").alias("marks"))


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, most: int = MOST
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (array of start, end in
    bytes: the maximal removed runs) and kept (the remaining bytes).

    Removed is every byte that is covered by a string of ``length`` bytes which
    starts in another place of the documents too; strings are those of the input
    and don't cross documents.  A null text is empty; rows with the same text, or
    the same or a null id, are documents of their own; a text shorter than
    ``length`` stays whole; an empty table gives no rows; other columns are not
    read.  A cut can fall inside a character, so kept is binary.  Memory of a
    task: one text or ``CHUNK`` bytes, and one shard."""
    if length < 1 or most < 1:
        raise ValueError("length and most are at least 1")
    ship(docs.sparkSession)
    text = text_of(text_col)
    rows = docs.select(_doc_key(text).alias("doc"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    marks = repeated_marks(rows, length, most).withColumnRenamed("doc", "marked")
    both = rows.join(marks, F.col("doc") == F.col("marked"), "left").select("doc_id", "text", "marks")
    return both.mapInArrow(
        partial(_cut_out, length=length),
        "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary",
    )


def op12_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 400 bytes that repeat."""
    told = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return told.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
