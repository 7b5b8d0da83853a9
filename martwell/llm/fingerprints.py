"""Document fingerprints by one-permutation MinHash.

Every shingle of five words is hashed once.  The upper bits of the hash choose
one of ``BINS`` bins, which keeps its least hash.  An empty bin takes the value
of another one by optimal densification: it probes bins in an order that is
drawn for that bin alone and is the same for all documents, until a bin of its
own has a value.  Of every bin ``BITS`` low-order bits are stored; two
fingerprints agree in a bin by chance with probability 2^-BITS, which the
estimate takes off again.

DataFrame functions only.  A fingerprint needs one sort of a document's hashes
and no shuffle: bins come out of the sorted hashes as runs.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwell.llm.common import stored, table, text_of

WORDS = 5
BINS = 256
BITS = 4
PROBES = 6

_seeded = random.Random(2718)
#: The first probes of every bin; beyond them the order is that of a hash of
#: (bin, other bin), so a bin always ends at some bin with a value.
PROBE = [[_seeded.randrange(BINS) for _ in range(BINS)] for _ in range(PROBES)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingle_hashes(text: Column) -> Column:
    """Hashes of the runs of five words (white space parts words, case does not
    count); a text of one to four words is one shingle, an empty one has none."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")

    def shingles(h: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(h) - WORDS),
            lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WORDS))),
        )
        few = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= WORDS, runs).otherwise(few)

    return let(F.transform(words, lambda w: F.xxhash64(w)), shingles)


def _bin(hash_: Column) -> Column:
    return F.shiftright(hash_, 64 - BINS.bit_length() + 1).cast("int") + BINS // 2


def _dense(least: Column) -> Column:
    """All bins in order, null where empty, from the least hashes in order."""
    filled = F.transform(
        least,
        lambda x, i: F.concat(
            F.array_repeat(
                F.lit(None).cast("bigint"),
                _bin(x) - F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(least, i - 1))) - 1,
            ),
            F.array(x),
        ),
    )
    tail = F.array_repeat(F.lit(None).cast("bigint"), BINS - 1 - _bin(F.element_at(least, -1)))
    return F.concat(F.flatten(filled), tail)


def _densified(least: Column) -> Column:
    probes = [F.array(*map(F.lit, order)) for order in PROBE]

    def fill(bins: Column) -> Column:
        def value(v: Column, i: Column) -> Column:
            last = F.array_min(F.transform(least, lambda x: F.struct(F.xxhash64(i, _bin(x)).alias("o"), x.alias("v"))))
            return F.coalesce(v, *(F.get(bins, F.get(p, i)) for p in probes), last["v"])

        return F.transform(bins, value)

    return let(_dense(least), fill)


def fingerprint(text: Column) -> Column:
    """array<tinyint> of BINS values of BITS bits; empty for a text without
    words.  Equal texts have equal fingerprints."""

    def runs(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(ordered, i - 1))))

    def packed(least: Column) -> Column:
        # bits of value and bin: bins that one value fills agree by chance each on its own
        mask = F.lit((1 << BITS) - 1).cast("bigint")
        low = F.transform(_densified(least), lambda v, i: F.xxhash64(v, i).bitwiseAND(mask).cast("tinyint"))
        return F.when(F.size(least) > 0, low).otherwise(F.array().cast("array<tinyint>"))

    return let(let(F.sort_array(shingle_hashes(text)), runs), packed)


def as_hex(print_: Column) -> Column:
    """The packed bits, a hexadecimal digit per bin."""
    digits = F.array(*(F.lit(f"{d:x}") for d in range(1 << BITS)))
    return F.array_join(F.transform(print_, lambda v: F.get(digits, v.cast("int"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimate of the shingle sets' Jaccard similarity, chance agreements of
    the low-order bits taken off.  Two texts without words are alike (1)."""
    agree = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda z: z)) / F.lit(float(BINS))
    chance = 2.0**-BITS
    estimate = F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(estimate)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (hexadecimal) of every row.  Null text is empty;
    null and repeated ids are kept; other columns are not read; an empty table
    gives no rows, and a text of any length is one row's array of hashes."""
    return docs.select(F.col(id_col).alias("doc_id"), as_hex(fingerprint(text_of(text_col))).alias("fingerprint"))


def _step(pieces: int) -> int:
    return max(1, int(pieces**0.5))


def _range_starts(rows: DataFrame, pieces: int) -> DataFrame:
    """One row on the ids cut into at most ``pieces`` ranges of about equal size:
    ``firsts``, the least id of each (null first, if there are null ids), ``cuts``,
    those but the first, and ``some``, each ``_step``-th of the cuts.

    Only ids are shuffled; of a range one row goes on.  The row is written, so the
    ranges stay the same when a task runs again."""
    ids = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    least = (
        ids.repartitionByRange(pieces, F.col("doc_id").asc_nulls_first())
        .groupBy(F.spark_partition_id())
        .agg(F.min(F.struct("doc_id")).alias("least"))
        .agg(F.transform(F.sort_array(F.collect_list("least")), lambda x: x["doc_id"]).alias("firsts"))
    )
    cuts = least.select("firsts", F.expr("slice(firsts, 2, greatest(size(firsts) - 1, 0))").alias("cuts"))
    return stored(cuts.withColumn("some", F.filter("cuts", lambda _, i: i % _step(pieces) == 0)), "id-ranges")


def _range_of(value: Column, step: int) -> Column:
    """Number of ``_cuts`` that are at most ``value`` (0 for null), looked up in about
    twice the square root of their number of steps."""

    def place(coarse: Column) -> Column:
        near = F.slice("_cuts", (coarse - 1) * step + 1, step)
        fine = F.size(F.filter(near, lambda c: c <= value))
        return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + fine)

    return F.when(value.isNull(), F.lit(0)).otherwise(let(F.size(F.filter("_some", lambda c: c <= value)), place))


def with_next(rows: DataFrame, carried: list[str], pieces: int) -> DataFrame:
    """``rows`` (doc_id and others) with ``next_<c>`` for each carried column c:
    that of the next row by doc_id (ties by text, nulls first; after the last
    row comes the first).

    One shuffle of the rows: they are cut by doc_id into ``pieces`` ranges of about
    equal size, and the first row of a range goes to the range before it as well,
    so every range finds its rows' successors by itself.  The ranges are a written
    row that tasks look up as values of the plan; no row carries them."""
    ranges = _range_starts(rows, pieces)
    cuts = rows.select("*", *(ranges.select(c).scalar().alias(f"_{c}") for c in ("cuts", "some")))
    dealt = cuts.select(*rows.columns, _range_of(F.col("doc_id"), _step(pieces)).alias("b"))
    firsts = ranges.select("firsts").scalar()
    own = F.struct(F.col("b"), F.lit(False).alias("echo"))
    before = F.when(F.col("b") == 0, ranges.select(F.size("firsts")).scalar()).otherwise(F.col("b")) - 1
    echo = F.struct(before.alias("b"), F.lit(True).alias("echo"))
    is_first = F.col("doc_id").eqNullSafe(F.get(firsts, F.col("b")))
    placed = (
        dealt.withColumn("place", F.explode(F.when(is_first, F.array(own, echo)).otherwise(F.array(own))))
        .drop("b")
    )
    order = Window.partitionBy("place.b").orderBy("place.echo", F.col("doc_id").asc_nulls_first(), "text")
    return (
        placed.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in carried))
        .filter(~F.col("place.echo"))
        .drop("place")
    )


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its text with the second half taken
    from the next document, and the likeness to that text and that document."""
    pieces = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")
    )
    own = docs.withColumn("print", fingerprint(F.col("text")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    pairs = with_next(own, ["text", "print"], pieces).select(
        "doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "print", "next_print"
    )
    told = pairs.withColumn("edited_print", fingerprint(F.col("edited")))
    return told.select(
        "doc_id", "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_hex(F.col("print")).alias("fingerprint"),
        as_hex(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
