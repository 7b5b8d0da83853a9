"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

Features: letters in lower case, all else as single spaces; all runs of one to
three characters, hashed into ``FEATURES`` places; 1 + ln(count) times inverse
document frequency, each document scaled to length 1.

* Document frequencies come from every training document (one pass; a task
  adds them up before they meet others).
* The classifier is fitted on a bounded sample, ``SAMPLE_ROWS`` texts at most.
  Copies of a text count once, and the languages take turns: each gives its text
  of the least hash, then each its next one, until the sample is full, so copies
  and a frequent language crowd no rare one out.  It is
  trained on four fifths of each language's texts by follow-the-regularised-leader with L1 and L2
  penalties (weights that the data don't need stay exactly 0); the last fifth
  fits the temperature that calibrates its probabilities, and the rejection
  bound: at most a ``REJECTED`` share of documents like the held-out ones that
  it tells rightly has a best probability below it.
* Prediction runs where documents are read.  The model has a fixed size
  (``FEATURES`` by the number of languages), so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwell.llm.common import kept_by, ship, table

FEATURES = 1 << 15
LONGEST = 3
SAMPLE_ROWS = 6000
#: Parts in which a language's texts are thinned before the sample is drawn.
PARTS = 256
#: Share of clean documents that the rejection bound may cost.
REJECTED = 0.002
UNKNOWN = "und"
_SPACE = 32


def _fold() -> np.ndarray:
    """Code point to its lower-case letter, or to a space if it is no letter."""
    kept = kept_by("langid")
    if "fold" not in kept:
        table_ = np.full(0x110000, _SPACE, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table_[i] = ord(low) if len(low) == 1 else i
        kept["fold"] = table_
    return kept["fold"]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Feature numbers and counts of the whole text; None if it has no letter."""
    if not text:
        return None
    c = _fold()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = c == _SPACE
    if space.all():
        return None
    keep = np.ones(len(c) + 1, bool)
    keep[1:-1] = ~(space[1:] & space[:-1])
    c = np.concatenate([[_SPACE], c[keep[:-1]], [_SPACE]]).astype(np.uint32)
    gram, parts = np.zeros(len(c), np.uint32), []
    for n in range(1, LONGEST + 1):
        tail = c[n - 1 :]
        gram = gram[: len(tail)] * np.uint32(0x01000193) + tail * np.uint32(0x9E3779B1) + np.uint32(n)
        mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA77)
        parts.append(mixed >> np.uint32(32 - 15))
    counts = np.bincount(np.concatenate(parts), minlength=FEATURES)
    where = np.flatnonzero(counts)
    return where.astype(np.int32), counts[where]


@dataclass
class Model:
    """Fitted model; ``languages`` is empty if there was nothing to learn from.
    A text whose score is below ``least`` is in no learned language."""

    languages: list[str] = field(default_factory=list)
    idf: np.ndarray | None = None
    weights: np.ndarray | None = None
    temperature: float = 1.0
    least: float = 0.0

    def vector(self, counts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        where, n = counts
        x = (1 + np.log(n)) * self.idf[where]
        return where, x / np.sqrt((x * x).sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text) if self.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        where, x = self.vector(counts)
        p = softmax((x @ self.weights[where])[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, *,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.01, epochs: int = 3, batch: int = 32,
) -> np.ndarray:
    """Weights by FTRL-proximal with an elastic net, over small batches."""
    z = np.zeros((FEATURES, classes))
    n = np.zeros((FEATURES, classes))
    w = np.zeros((FEATURES, classes))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        turn = order.permutation(len(rows))
        for some in (turn[i : i + batch] for i in range(0, len(turn), batch)):
            used, spots = np.unique(np.concatenate([rows[i][0] for i in some]), return_inverse=True)
            x = np.zeros((len(some), len(used)))
            x[np.repeat(np.arange(len(some)), [len(rows[i][0]) for i in some]), spots] = np.concatenate(
                [rows[i][1] for i in some]
            )
            p = softmax(x @ w[used])
            p[np.arange(len(some)), labels[some]] -= 1
            g = x.T @ p
            sigma = (np.sqrt(n[used] + g * g) - np.sqrt(n[used])) / alpha
            z[used] += g - sigma * w[used]
            n[used] += g * g
            zu = z[used]
            shrunk = np.where(np.abs(zu) <= l1, 0.0, zu - np.sign(zu) * l1)
            w[used] = -shrunk / ((beta + np.sqrt(n[used])) / alpha + l2)
    return w


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log likelihood (golden section)."""
    if not len(scores):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, cut = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - cut * (high - low), low + cut * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def rejection_bound(told: np.ndarray, share: float = REJECTED) -> float:
    """The best probability that at most ``share`` of documents like those of
    ``told`` (best probabilities of held-out documents) are below (split
    conformal); 0, which rejects nothing, if ``told`` are too few to say."""
    rank = int(share * (len(told) + 1))
    return float(np.sort(told)[rank - 1]) if rank else 0.0


def _document_frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, documents with it) of a task; feature -1 counts documents."""
    total, seen = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts = ngram_counts(text)
            if counts is not None:
                total[counts[0]] += 1
                seen += 1
    where = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(where, -1)), pa.array(np.append(total[where], seen))], names=["feature", "n"]
    )


def _sample_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of the sample's texts, copies once a task."""
    seen = set()  # as large as the sample at most
    for batch in batches:
        rows = []
        for turn, h, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            counts = None if (h, lang) in seen else ngram_counts(text)
            seen.add((h, lang))
            if counts is not None:
                rows.append((turn, h, lang, counts[0].tobytes(), counts[1].astype(np.int32).tobytes()))
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
        cols = zip(*rows) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, kinds)], names=["turn", "h", "lang", "places", "counts"]
        )


def drawn_texts(rows: DataFrame, sample_rows: int) -> DataFrame:
    """(turn, h, lang) of at most ``sample_rows`` distinct labelled texts of
    ``rows`` (text, lang) with letters; h is the text's hash.  Hashes alone are
    shuffled, and copies become one row before; the last window of a language
    has ``PARTS`` * ``sample_rows`` hashes at most."""
    hashes = rows.filter(F.col("text").rlike(r"\p{L}")).select(F.xxhash64("text").alias("h"), "lang").distinct()
    # a language's hashes are thinned in parts first, so a frequent one is not one task
    part = F.row_number().over(Window.partitionBy("lang", "part").orderBy("h"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return (
        hashes.withColumn("part", F.pmod("h", F.lit(PARTS)))
        .withColumn("turn", part)
        .filter(F.col("turn") <= sample_rows)
        .withColumn("turn", turn)
        .filter(F.col("turn") <= sample_rows)
        .orderBy("turn", "h", "lang")
        .limit(sample_rows)
        .select("turn", "h", "lang")
    )


def held_out(keys: list[tuple[str, int]]) -> np.ndarray:
    """Which of the sample's (lang, text hash) calibrate: every fifth text of a
    language.  All rows of one text are on one side."""
    side: dict[int, bool] = {}
    for _, of_one in groupby(sorted(keys), key=lambda k: k[0]):
        for i, (_, h) in enumerate(of_one):
            side.setdefault(h, i % 5 == 4)
    return np.array([side[h] for _, h in keys], dtype=bool)


def fit(labelled: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model from ``labelled`` (text, lang).  Rows without label or letters
    teach nothing; with no row left the model predicts ``und`` everywhere."""
    ship(labelled.sparkSession)
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    frequencies = (
        rows.select("text").mapInArrow(_document_frequencies, "feature long, n long").groupBy("feature").sum("n")
    )
    found = dict(frequencies.collect())  # FEATURES + 1 rows at most
    documents = found.pop(-1, 0)
    if not documents:
        return Model()
    idf = np.zeros(FEATURES)
    idf[list(found)] = list(found.values())
    idf = np.log((1 + documents) / (1 + idf)) + 1
    chosen = F.broadcast(drawn_texts(rows, sample_rows))  # sample_rows rows at most
    sample = (
        rows.withColumn("h", F.xxhash64("text"))
        .join(chosen, ["h", "lang"])
        .select("turn", "h", "lang", "text")
        .mapInArrow(_sample_features, "turn int, h long, lang string, places binary, counts binary")
        .groupBy("h", "lang")
        .agg(F.min(F.struct("turn", "places", "counts")).alias("one"))
        .select("h", "lang", "one.*")
        .orderBy("h", "lang")
        .collect()
    )
    if not sample:
        return Model()
    model = Model(sorted({r["lang"] for r in sample}), idf)
    number = {lang: i for i, lang in enumerate(model.languages)}
    labels = np.array([number[r["lang"]] for r in sample])
    vectors = [
        model.vector((np.frombuffer(r["places"], np.int32), np.frombuffer(r["counts"], np.int32))) for r in sample
    ]
    held = held_out([(r["lang"], r["h"]) for r in sample])
    own = np.flatnonzero(~held)
    model.weights = train_ftrl([vectors[i] for i in own], labels[own], len(number))
    scores = np.array([vectors[i][1] @ model.weights[vectors[i][0]] for i in np.flatnonzero(held)])
    model.temperature = fit_temperature(scores, labels[held])
    model.weights = model.weights.astype(np.float32)
    # of the weights and in the arithmetic that predict uses
    scores = np.array([vectors[i][1] @ model.weights[vectors[i][0]] for i in np.flatnonzero(held)])
    if len(scores):
        told = softmax(scores / model.temperature)
        model.least = rejection_bound(told.max(axis=1)[told.argmax(axis=1) == labels[held]])
    return model


def has_letters(text: Column) -> Column:
    """Whether a text has a letter (what ``ngram_counts`` takes for one)."""

    def told(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(t) and any(map(str.isalpha, t)) for t in texts], dtype=bool)

    return F.pandas_udf(told, "boolean")(text)


def _predictor(shared):
    """Pandas UDF from text to (lang_pred, score) with the broadcast model."""

    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        for texts in batches:
            yield pd.DataFrame([fitted.predict(t) for t in texts], columns=["lang_pred", "score"])

    # a filter on the result is not pushed below, where the function would run once more
    return F.pandas_udf(told, "lang_pred string, score double").asNondeterministic()


def predict(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (a learned language, or ``und`` for a null
    text or one without letters) and ``score`` (calibrated probability, 0 for
    ``und``).  The whole text is used, and nothing but the text; rows and other
    columns stay as they are (columns of these two names are replaced)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, _predictor(shared)(F.col(text_col)).alias("__told")).select(
        *kept, F.col("__told.lang_pred").alias("lang_pred"), F.col("__told.score").alias("score")
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    learn = docs.filter(F.col("doc_id").isNotNull() & ~held).select("text", "lang")
    told = predict(docs.select("doc_id", "text"), fit(learn))
    return told.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "lang_pred", "score")
