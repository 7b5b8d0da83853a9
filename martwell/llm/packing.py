"""Harmonic packing of token sequences.

A bin (sequence) has ``capacity`` tokens.  Class i holds the pieces that are
longer than capacity/(i+1) and no longer than capacity/i, so a bin of class i
takes exactly i pieces, whichever they are.  No task looks at another's bins:
each one fills the open bin of each class as its documents arrive, and a
document never moves between tasks, so the operator has no shuffle.

Lengths are fitted to the classes by cutting:

* whole sequences are cut off the front of a document (class 1);
* a remainder that would waste more than ``slack`` of its share of a bin gives
  a piece of exactly capacity/(i+1) to the next class, and the rest is fitted
  the same way;
* a piece of a class beyond ``classes`` is small: these are laid next to each
  other in one open bin (next fit), cut where the bin ends.

At the end of a task some classes have a bin with fewer than i pieces.  Their
pieces are laid into the open bin of small pieces, cut where a bin ends, so one
sequence per task is not full, whatever the number of classes.

Sequences: ``sequence_id`` is the task's partition number (upper bits) and a
running number in it.  Every token of a document is in exactly one piece, and
the pieces of a sequence lie at ``offset`` 0, without gaps.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwell.llm.common import kept_by, ship, steps, table, text_of

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

#: Remembered chunks of a Python worker; it starts anew beyond this number.
REMEMBERED = 2_000_000
#: Bytes of texts that a Python worker encodes at once.
STEP_BYTES = 4_000_000
_spaced = re.compile(r"\s ")
#: White space of any script, as Arrow's regular expressions have it.
_WHITE = r"[\s\v\x1c-\x1f\x{85}\p{Z}]"
_chunk = re.compile(r"(?<=\S)(?= )")
#: Chunks that the tokenizer gets as one text.
TOGETHER = 1000


#: Fixed value: how a byte-level tokenizer of this family parts words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def by_ranks(tokenizer) -> "tiktoken.Encoding | None":  # noqa: F821
    """The same byte-level BPE by ranks, which encodes plain words several times
    faster; None if the file's merges are not in the order of its ids or it parts
    or changes texts in another way."""
    import tiktoken

    told = json.loads(tokenizer.to_str())
    model, before = told["model"], told.get("pre_tokenizer") or {}
    level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
    if model["type"] != "BPE" or told.get("normalizer") or not level or model.get("ignore_merges") or model.get("dropout"):
        return None
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printed)]
    byte_of = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = model["vocab"]
    merged = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    single = [vocabulary.get(c) for c in byte_of]
    if None in merged or None in single or merged != sorted(set(merged)) or (merged and max(single) > merged[0]):
        return None
    of_merges = set(merged)
    tokens = [*byte_of, *(t for t, i in vocabulary.items() if i in of_merges)]
    ranks = {bytes(byte_of[c] for c in t): vocabulary[t] for t in tokens}
    return tiktoken.Encoding("by ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids (as little-endian unsigned 32-bit bytes) of texts by a tokenizer file.

    Text is cut before every space that follows a non-space.  A byte-level BPE
    pattern of this family never has a word that crosses such a place, so the
    ids of the chunks, joined, are the ids of the text; each distinct chunk is
    encoded once per worker, many of them in one text (``by_ranks`` where the file
    allows it), told apart again by the space that begins each.  A text with an added token of the tokenizer (such as
    ``<|endoftext|>``) is encoded as it is.

    Ids of known chunks lie in one array; a step of texts is cut and numbered by
    Arrow and its ids are gathered from there."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = by_ranks(self.tokenizer)
        self.most = REMEMBERED
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.leads = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.leads[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True  # a space, byte by byte
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.at, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def chunks(self, text: str) -> list[str]:
        """The chunks; all but the first come without the space that begins them."""
        if _spaced.search(text):
            first, *rest = _chunk.split(text)
            return [first, *(x[1:] for x in rest)]
        return text.split(" ")

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Put the chunks and their ids behind those that are known; their places."""
        known = len(self.known)
        simple = pa.compute.invert(pa.compute.match_substring_regex(new, _WHITE))
        simple = pa.compute.and_(simple, pa.compute.not_equal(new, ""))
        plain, rest = new.filter(simple), new.filter(pa.compute.invert(simple))
        words = plain.to_pylist()
        texts = [" " + " ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        parts = [self.ranked.encode_to_numpy(t) for t in texts] if self.ranked else self._encoded(texts)
        flat = np.concatenate([np.zeros(0, np.uint32), *parts])
        first = np.flatnonzero(self.leads[flat])
        if len(first) != len(words):  # a tokenizer that does not begin a chunk with its space
            plain, rest, flat, first = new[:0], new, flat[:0], first[:0]
        alone = self._encoded([" " + x for x in rest.to_pylist()])
        sizes = np.append(np.diff(np.append(first, len(flat))), [len(x) for x in alone]).astype(np.int64)
        added = pa.concat_arrays([plain, rest])
        self.known = pa.concat_arrays([self.known, added])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, flat, *alone])
        return known + pa.compute.index_in(new, value_set=added).to_numpy(zero_copy_only=False).astype(np.int64)

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Which texts are encoded whole, and the chunks of the others."""
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pa.compute.match_substring(texts, token).to_numpy(zero_copy_only=False)
        odd = pa.compute.match_substring_regex(texts, _WHITE + " ").to_numpy(zero_copy_only=False)
        cut = pa.compute.split_pattern(pa.compute.if_else(pa.array(whole | odd), "", texts), " ")
        if odd.any():
            own = [self.chunks(t) if o and not w else c for t, w, o, c in zip(texts.to_pylist(), whole, odd, cut.to_pylist())]
            cut = pa.array(own, pa.list_(pa.string()))
        return whole, cut

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of every text."""
        if len(self.known) > self.most:
            self._forget()
        if not texts:
            return
        whole, cut = self._cut(pa.array(texts, pa.string()))
        starts = np.cumsum(np.append(0, pa.compute.list_value_length(cut).to_numpy(zero_copy_only=False)))
        firsts, chunks = starts[:-1], cut.flatten()
        after = np.ones(len(chunks), bool)
        after[firsts] = False
        heads = chunks.take(pa.array(firsts)).to_pylist()
        told = chunks.filter(pa.array(after)).dictionary_encode()
        found = pa.compute.index_in(told.dictionary, value_set=self.known)
        place, unknown = found.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), found.is_null()
        if found.null_count:
            place[unknown.to_numpy(zero_copy_only=False)] = self._learn(told.dictionary.filter(unknown))
        spot = place[told.indices.to_numpy(zero_copy_only=False)]
        begin, sizes = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        begin[after], sizes[after] = self.at[spot], self.at[spot + 1] - self.at[spot]
        ends = np.append(0, np.cumsum(sizes))
        ids = self.ids[np.repeat(begin - ends[:-1], sizes) + np.arange(ends[-1])].astype("<u4")
        first_ids = self._encoded([t if w else h for t, w, h in zip(texts, whole, heads)])
        for head, a, b in zip(first_ids, ends[starts[:-1]], ends[starts[1:]]):
            yield head.astype("<u4").tobytes() + ids[a:b].tobytes()


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    known = kept_by("packing")
    if path not in known:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known[path] = Encoder(path)
    known[path].most = remembered
    return known[path]


class HarmonicBins:
    """Open bins of one task.  ``add`` and ``close`` give finished pieces as
    (document, start, length, sequence, offset)."""

    def __init__(self, capacity: int, classes: int, slack: float, first_id: int):
        self.capacity, self.classes, self.slack = capacity, classes, slack
        self.next_id = first_id
        self.open: dict[int, list[tuple]] = {}
        self.small: tuple[int, int] | None = None  # open sequence and its fill

    def _sequence(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _lay(self, doc, start: int, length: int) -> Iterator[tuple]:
        """Next fit into the open bin of small pieces, cut where it ends."""
        while length:
            seq, used = self.small or (self._sequence(), 0)
            n = min(length, self.capacity - used)
            yield doc, start, n, seq, used
            start, length = start + n, length - n
            self.small = (seq, used + n) if used + n < self.capacity else None

    def add(self, doc, total: int) -> Iterator[tuple]:
        start = 0
        while start < total:
            length = min(total - start, self.capacity)
            share = self.capacity // length
            if share > self.classes:
                yield from self._lay(doc, start, length)
                return
            if self.capacity - share * length > self.slack * self.capacity:
                share += 1
                length = self.capacity // share
                if share > self.classes:
                    yield from self._lay(doc, start, total - start)
                    return
            bin_ = self.open.setdefault(share, [])
            bin_.append((doc, start, length))
            start += length
            if len(bin_) == share:
                seq, offset = self._sequence(), 0
                for d, s, n in self.open.pop(share):
                    yield d, s, n, seq, offset
                    offset += n

    def close(self) -> Iterator[tuple]:
        for share in sorted(self.open):
            for d, s, n in self.open.pop(share):
                yield from self._lay(d, s, n)


def _packer(path: str, end_id: int, capacity: int, classes: int, slack: float, remembered: int, step_bytes: int):
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 33
        bins = HarmonicBins(capacity, classes, slack, first)
        enc = encoder(path, remembered)
        # ids of documents with pieces in open bins only: at most `classes` squared pieces
        waiting: dict[int, list] = {}
        number = 0

        def rows(found: Iterator[tuple]) -> pa.RecordBatch:
            out = []
            for key, start, length, seq, offset in found:
                doc_id, ids, left, total = waiting[key]
                out.append((doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, seq, offset))
                if left == length:
                    del waiting[key]
                else:
                    waiting[key][2] = left - length
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(PIECES), PIECES.types)],
                schema=PIECES,
            )

        def placed(docs: list, texts: list[str]) -> Iterator[tuple]:
            nonlocal number
            for doc_id, ids in zip(docs, enc.encode(texts)):
                ids += end
                number += 1
                total = len(ids) // 4
                waiting[number] = [doc_id, ids, total, total]
                yield from bins.add(number, total)

        for batch in batches:
            for part in steps(batch, 1, step_bytes):
                yield rows(placed(part.column(0).to_pylist(), part.column(1).to_pylist()))
        yield rows(bins.close())

    return pack


def harmonic_pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    classes: int = 64,
    slack: float = 1 / 64,
    remembered: int = REMEMBERED,
    step_bytes: int = STEP_BYTES,
    end_id: int = 0,
) -> DataFrame:
    """Pack every document of ``docs`` into sequences of ``capacity`` tokens.

    Result: one row per piece (``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``).  A document's ids are the tokenizer's followed by
    ``end_id``; a null or empty text is that one id.  Null or repeated
    ``id_col`` values are packed like any other row (each row is a document of
    its own); other columns of ``docs`` are not read; an empty table gives no
    rows.  Memory of a task: one step of texts (about ``step_bytes``, one text at
    least) with what it takes to encode them, its open bins (fewer than
    ``classes`` squared pieces with their documents) and about ``remembered``
    chunks.
    """
    if capacity < 1 or classes < 1 or not 0 <= slack < 1:
        raise ValueError("capacity and classes are at least 1, slack is from 0 to below 1")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_packer(tokenizer_path, end_id, capacity, min(classes, capacity), slack, remembered, step_bytes), _DDL)


def padding(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """One row: sequences, tokens and padded share (a sequence whose length is
    a power of two is not padded)."""
    seq = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    pad = F.when(F.bit_count("used") == 1, 0).otherwise(F.lit(capacity) - F.col("used"))
    return seq.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum("used").alias("tokens"),
        (F.sum(pad) / (F.sum(pad) + F.sum("used"))).alias("padded_share"),
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic_pack(table(spark, sf_dir, "documents"), default_tokenizer())
