"""SentencePiece encoding and decoding by suffix-array matching.

A step of texts is normalised and cut into units (no piece goes on over white
space that follows another character).  The units a worker has not met yet are
concatenated and indexed by a suffix array, deep enough for the longest piece.
Every piece of the model is looked up by binary search, all at once, character
by character; its range of suffixes is all its occurrences.  The occurrences
are the edges of the units' lattices: they are sorted by position and relaxed
from left to right, all units side by side.

The models in use are BPE models, whose result is not the path of best score:
merges happen by rank.  Its relaxation is exact all the same.  The encoding of
every prefix ends in one token, and a token can follow another if and only if
the two stand side by side in the encoding of their own concatenation.  So the
edge into a position is the one whose token may follow the last token of where
it starts; pairs are decided by merging their few characters, and remembered.

Characters without a piece become their UTF-8 byte pieces.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwell.llm.common import kept_by, ship, steps, table, text_of

SPACE = "▁"
_unit = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_SEPARATOR = 0x110000
_SPREAD = 0x9E3779B1  # of a pair's number over the slots

#: Remembered units and pairs of a worker; they start anew beyond these numbers.
REMEMBERED_UNITS = 500_000
REMEMBERED_PAIRS = 1_000_000
#: Slots of a worker's table before those pairs, a power of two; a slot has the pair met last.
PAIR_SLOTS = 1 << 20
#: Characters that one suffix array covers, or one unit.
INDEXED = 300_000


class PieceModel:
    """Pieces of a SentencePiece BPE model file and what a worker remembers."""

    def __init__(self, path: str):
        import sentencepiece

        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {self.names[i]: i for i in plain}
        self.score = {self.names[i]: sp.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece goes on over white space; units would not be independent")
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        # a byte below 128 is a character by itself; others are part of one
        self.in_character = np.array([self.byte_of.get(i, 0) >= 128 for i in range(n)])
        self.written = [
            "" if sp.is_control(i) else chr(self.byte_of[i]) if i in self.byte_of else self.names[i] for i in range(n)
        ]
        self.unknown = sp.unk_id()
        self.order = sorted(self.ids)
        self.lengths = np.array([len(p) for p in self.order], np.int32)
        self.numbers = np.array([self.ids[p] for p in self.order], np.int32)
        self.longest = int(self.lengths.max())
        self.codes = np.zeros((len(self.order), self.longest), np.int64)
        for i, p in enumerate(self.order):
            self.codes[i, : len(p)] = [ord(c) for c in p]
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        # a pair and whether it can stand, in one number each
        self.slots = np.full(PAIR_SLOTS, -1, np.int64)

    # -- rules of a BPE model

    def merged(self, text: str) -> list[str]:
        """Tokens of a short text: the best-scored neighbours first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def token_ids(self, token: int) -> list[int]:
        """Ids of a lattice token (beyond the pieces: a character)."""
        if token < len(self.names):
            return [token]
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in chr(token - len(self.names)).encode()]

    def name(self, token: int) -> str:
        return self.names[token] if token < len(self.names) else chr(token - len(self.names))

    def follows(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token can stand after the token ``before`` (-1: the unit's start)."""
        width = len(self.names) + _SEPARATOR
        wanted = (before + 1) * width + token
        slot = (wanted * _SPREAD >> 32) & (PAIR_SLOTS - 1)
        held = self.slots[slot]
        told = (held & 1).astype(bool)
        unmet = np.flatnonzero(held >> 1 != wanted)
        if unmet.size:
            keys, back = np.unique(wanted[unmet], return_inverse=True)
            if len(self.pairs) > REMEMBERED_PAIRS:
                self.pairs.clear()
            found = np.zeros(len(keys), np.int64)
            for i, key in enumerate(keys.tolist()):
                known = self.pairs.get(key)
                if known is None:
                    a, b = divmod(key, width)
                    two = [self.name(a - 1), self.name(b)] if a else [self.name(b)]
                    known = self.pairs[key] = self.merged("".join(two)) == two
                found[i] = known
            told[unmet] = found[back]
            self.slots[slot[unmet]] = wanted[unmet] * 2 + found[back]
        return told

    # -- index

    def suffixes(self, codes: np.ndarray) -> np.ndarray:
        """Suffix array of ``codes``, sorted as deep as the longest piece."""
        n = len(codes)
        symbols, rank = np.unique(codes, return_inverse=True)
        rank = rank.astype(np.int64)
        # as many characters as fit in a number come first, then twice as many each time
        base = len(symbols) + 1
        key, depth = rank + 1, 1
        while depth < self.longest and base ** (depth + 1) < 1 << 63:
            key = key * base
            key[:-depth] += rank[depth:] + 1
            depth += 1
        while True:
            order = np.argsort(key)
            if depth >= self.longest:
                return order
            ordered = key[order]
            rank[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
            key = rank * (n + 1)
            key[:-depth or None] += rank[depth:] + 1 if depth < n else 0
            depth *= 2

    def ranges(self, codes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per piece the range of suffixes that begin with it."""
        low = np.zeros(len(self.order), np.int64)
        high = np.full(len(self.order), len(codes), np.int64)
        padded = np.append(codes, np.full(self.longest, -1))
        live = np.arange(len(self.order))
        for d in range(self.longest):
            live = live[(self.lengths[live] > d) & (low[live] < high[live])]
            want = self.codes[live, d]
            low[live], high[live] = (
                self._bound(padded, order, low[live], high[live], want + more, d) for more in (0, 1)
            )
        return low, high

    @staticmethod
    def _bound(codes, order, low, high, want, d) -> np.ndarray:
        """First suffix in [low, high) whose character d is at least ``want``."""
        low, high = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not open_.size:
                return low
            mid = (low[open_] + high[open_]) >> 1
            small = codes[order[mid] + d] < want[open_]
            low[open_[small]] = mid[small] + 1
            high[open_[~small]] = mid[~small]

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and token of every occurrence of a piece, and of every
        character that is no piece."""
        order = self.suffixes(codes)
        low, high = self.ranges(codes, order)
        n = np.maximum(high - low, 0)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = order[np.repeat(low, n) + inside].astype(np.int32)
        length, token = np.repeat(self.lengths, n), np.repeat(self.numbers, n)
        single = np.ones(len(codes), bool)
        single[start[length == 1]] = False
        single &= codes != _SEPARATOR
        alone = np.flatnonzero(single)
        return (
            np.concatenate([start, alone.astype(np.int32)]),
            np.concatenate([length, np.ones(len(alone), np.int32)]),
            np.concatenate([token, (codes[alone] + len(self.names)).astype(np.int32)]),
        )

    # -- encoding

    def solve(self, units: list[str]) -> Iterator[bytes]:
        """Ids of each unit as little-endian unsigned 32-bit numbers."""
        joined = chr(0).join(units)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.array([len(u) for u in units], np.int64)
        begin = np.cumsum(sizes + 1) - sizes - 1
        codes[begin[1:] - 1] = _SEPARATOR
        start, length, token = self.edges(codes)
        unit_of = np.repeat(begin, sizes + 1)[: len(codes)]
        offset = start + length - unit_of[start]
        # few units are as long as 65536 characters, and short numbers are sorted sooner
        by_offset = np.argsort(offset.astype(np.uint16) if sizes.max() < 1 << 16 else offset, kind="stable")
        start, length, token, offset = (x[by_offset] for x in (start, length, token, offset))
        # last[p + 1], span[p + 1]: token that ends at place p and its length; at a unit's start none
        last = np.full(len(codes) + 2, -2, np.int64)
        span = np.zeros(len(codes) + 2, np.int64)
        stops = np.append(np.flatnonzero(np.diff(offset)) + 1, len(offset))
        at = 0
        for stop in stops.tolist():
            s, size, t = start[at:stop], length[at:stop], token[at:stop]
            at = stop
            before = np.where(s == unit_of[s], -1, last[s])
            good = before > -2
            s, size, t, before = s[good], size[good], t[good], before[good]
            good = self.follows(before, t)
            end = s[good] + size[good]
            last[end], span[end] = t[good], size[good]
        # from every unit's end back to its start, side by side
        place, unit = begin + sizes, np.arange(len(units))
        tokens, owners = [], []
        while place.size:
            if (span[place] == 0).any():
                raise ValueError(f"no encoding of {units[unit[span[place] == 0][0]][:40]!r}")
            tokens.append(last[place])
            owners.append(unit)
            place = place - span[place]
            more = place > begin[unit]
            place, unit = place[more], unit[more]
        token, owner = np.concatenate(tokens[::-1]), np.concatenate(owners[::-1])
        token = token[np.argsort(owner, kind="stable")]
        ends = np.cumsum(np.bincount(owner, minlength=len(units))).tolist()
        odd = np.flatnonzero(token >= len(self.names)).tolist()
        ids = token.astype("<u4").tobytes()
        at = 0
        for end in ends:
            if odd and odd[0] < end:
                wide = [i for t in token[at:end].tolist() for i in self.token_ids(t)]
                yield struct.pack(f"<{len(wide)}I", *wide)
                odd = odd[bisect.bisect_left(odd, end) :]
            else:
                yield ids[4 * at : 4 * end]
            at = end

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        parts = [_unit.findall(self.sp.normalize(t)) if t else [] for t in texts]
        if len(self.known) > REMEMBERED_UNITS:
            self.known.clear()
        new = list(set().union(*(filterfalse(self.known.__contains__, p) for p in parts)))
        held: list[str] = []
        size = 0
        for i, unit in enumerate(new):
            held.append(unit)
            size += len(unit) + 1
            if size >= INDEXED or i + 1 == len(new):
                self.known.update(zip(held, self.solve(held)))
                held, size = [], 0
        for p in parts:
            yield b"".join(map(self.known.__getitem__, p))

    # -- decoding

    def decode(self, ids: np.ndarray) -> str:
        """Text of a document's ids: bytes are joined to characters (what is no
        UTF-8 becomes U+FFFD), control pieces are silent, and the space that
        encoding puts in front is taken away."""
        if self.in_character[ids].any():
            out, raw = [], bytearray()
            for i in ids.tolist():
                if self.in_character[i]:
                    raw.append(self.byte_of[i])
                    continue
                if raw:
                    out.append(raw.decode(errors="replace"))
                    raw = bytearray()
                out.append(self.written[i])
            out.append(raw.decode(errors="replace"))
        else:
            out = map(self.written.__getitem__, ids.tolist())
        return "".join(out).replace(SPACE, " ").removeprefix(" ")


def piece_model(path: str) -> PieceModel:
    kept = kept_by("pieces")
    if path not in kept:
        kept[path] = PieceModel(path)
    return kept[path]


ENCODED_DDL = "doc_id long, ids array<int>, ids_crc32 long"


def encode_pieces(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ENCODED_DDL`` of every row of ``docs``: the model's ids of the whole
    text.  Null or empty text has no ids; null and repeated ids are kept; other
    columns are not read; an empty table gives no rows."""
    ship(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            for part in steps(batch, 1, 2_000_000):
                found = list(model.encode(part.column(1).to_pylist()))
                ends = np.cumsum([0, *(len(f) // 4 for f in found)])
                ids = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                     pa.array([zlib.crc32(f) for f in found], pa.int64())],
                    names=["doc_id", "ids", "ids_crc32"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, ENCODED_DDL)


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids and others) with ``text``, the text of its ids;
    null ids are the empty text."""
    ship(encoded.sparkSession)
    others = [c for c in encoded.columns if c not in ("ids", "text")]
    schema = encoded.select(*others, "ids").schema.add("text", "string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            cells = batch.column(batch.num_columns - 1)
            texts = [
                model.decode(c.values.to_numpy(zero_copy_only=False) if c.is_valid else np.zeros(0, np.int32))
                for c in cells
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"]
            )

    return encoded.select(*others, "ids").mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op5_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document (number and checksum) and the text decoded from them."""
    path = default_model()
    encoded = encode_pieces(table(spark, sf_dir, "documents"), path)
    return decode_pieces(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        "ids_crc32",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
