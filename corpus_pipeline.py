"""A corpus pipeline over ``documents``, as stages that each apply one of the
training-data operators to all that the stage before kept.

Every stage but the last returns the columns of its input.  Rows travel as one
struct beside the few columns that a stage reads, so columns of any name pass
through.  Null texts count as empty, null and repeated ids are kept apart by
their texts, and an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwell.llm import langid, neardup, packing, secrets
from martwell.llm.common import stored, table, text_of

REDACTED = "[SECRET]"
#: Chunks that a packing worker remembers; fewer than alone, as executors hold
#: what the stages before left them.  Affects time only.
REMEMBERED = 100_000
#: Bytes of texts that a packing worker encodes at once; fewer than alone, for the
#: same reason.  Affects time and memory only.
STEP_BYTES = 1_000_000


def _row(docs: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def _key(hash_: Column, doc_id: Column) -> Column:
    """Of a row: its text's hash and its id."""
    return F.concat_ws("|", hash_, doc_id.cast("string"))


def _rows_again(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents, reject what has no language (no
    letters, or less likely to be in a learned one than the bound that the model
    takes from held-out documents), and label what has no label.

    With nothing to learn from (no label on a document with letters), documents
    with letters stay and ``lang`` stays null.  With one learned language, or
    too few held-out documents for a bound, only those without letters go."""
    model = langid.fit(docs.select("text", "lang"))
    if not model.languages:
        return docs.filter(langid.has_letters(F.col("text")))
    told = langid.predict(docs.select(_row(docs), "text"), model)
    kept = told.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= model.least))
    lang = F.coalesce(F.col("row.lang"), F.col("lang_pred"))
    return _rows_again(kept.select(F.col("row").withField("lang", lang).alias("row")), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group stays: the smallest id."""
    kept = neardup.near_duplicates(docs).filter("keep").select(_key(F.col("hash"), F.col("doc_id")).alias("key"))
    rows = docs.select(_row(docs), _key(neardup.text_hash(text_of()), F.col("doc_id")).alias("key"))
    repeated = Window.partitionBy("key").orderBy(F.xxhash64("row"))
    one = rows.join(kept, "key").withColumn("n", F.row_number().over(repeated)).filter("n = 1")
    return _rows_again(one, docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials are replaced in the texts; widely copied examples stay."""
    key = _key(neardup.text_hash(text_of()), F.col("doc_id"))
    read = docs.select(key.alias("key"), F.col("doc_id").alias("repo"), F.col("source").alias("owner"), "text")
    told = secrets.scan_secrets(read, id_col="key", repo_col="repo", owner_col="owner")
    found = (
        told.select(F.col("doc_id").alias("key"), F.filter("spans", lambda s: s["verdict"] != "example").alias("spans"))
        .filter(F.size("spans") > 0)
        .dropDuplicates(["key"])
    )
    rows = docs.select(_row(docs), key.alias("key")).join(found, "key", "left")
    clean = secrets.redact(F.col("row.text"), F.col("spans"), REDACTED)
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(clean)
    new = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        chars = F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(F.length(clean).cast(kind))
        new = new.withField("n_chars", chars)
    return _rows_again(rows.select(new.alias("row")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Harmonic packing of what is left (one row per piece)."""
    return packing.harmonic_pack(docs, packing.default_tokenizer(), remembered=REMEMBERED, step_bytes=STEP_BYTES)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]
#: The stages learn, hash and tokenize; SQL can't state them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and
    read again, so that a lost executor costs one stage at most."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
