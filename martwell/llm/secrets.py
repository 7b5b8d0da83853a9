"""Secret scan with corpus-wide ownership frequency.

Every text is searched for candidates: the base kinds (assignments, access
keys, hexadecimal runs) and two wider ones (tokens with an issuer's prefix,
long mixed strings).  A credential belongs to somebody, an example is copied
everywhere: candidate values are hashed and counted by distinct owners and by
distinct repositories over the whole corpus.  A value that ``example_owners``
owners or more have is an example; one that a single owner has is live-looking;
between them it is shared.  Base spans are always reported; long mixed strings
only if they are not examples and no base span covers them.

All of it is DataFrame operations.  Only lengths, positions and hashes leave
the scan, never texts or values.  A value in a third of all documents is
reduced to one row per (value, owner, repository) and then (value, owner)
before it meets others, and the counts reach the candidates by a join that
Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from martwell.llm.common import stored, table, text_of

#: Kinds in the order of the report: name, pattern, least length, group whose
#: length and hash count.  The first three are the base kinds.
KINDS = [
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        2,
    ),
    ("access", r"AKIA[A-Z0-9]+", 18, 0),
    ("hex", r"[0-9a-f]{16,}", 16, 0),
    (
        "issued",
        r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}"
        r"|(?:sk|rk)_live_[A-Za-z0-9]{16,}|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----",
        16,
        0,
    ),
    ("mixed", r"[A-Za-z0-9+/_=-]{24,}", 24, 0),
]
BASE = 3
NAMES = [k[0] for k in KINDS]
EXAMPLE_OWNERS = 3
#: Repositories of one owner from which a candidate is no longer told as live.
COPIED_REPOSITORIES = 50


def _found(text: Column, kind: int) -> Column:
    """Every match of a kind in order, with the length of the text between it
    and the match before; the lengths add up to its place."""
    matches = F.regexp_extract_all(text, F.lit(KINDS[kind][1]), F.lit(0))
    gaps = F.transform(F.split(text, KINDS[kind][1], -1), lambda x: F.length(x))
    pairs = F.zip_with(matches, gaps, lambda m, gap: F.struct(m.alias("match"), gap.alias("gap")))
    rows = F.transform(
        F.filter(pairs, lambda x: x["match"].isNotNull()),  # the last gap has no match
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("ord"), x["gap"].alias("gap"), x["match"].alias("match")),
    )
    empty = F.array().cast("array<struct<kind:int,ord:int,gap:int,match:string>>")
    return F.when(text.rlike(KINDS[kind][1]), rows).otherwise(empty)


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate (and one without a kind per document that has
    none): uid, doc_id, repo, owner, kind, start, end, hash.

    ``docs``: doc_id, repo, owner, text.  uid tells rows apart, whatever their
    ids; the result is stored, so it is made once."""
    found = docs.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "repo", "owner",
        F.concat(*(_found(F.col("text"), k) for k in range(len(KINDS)))).alias("found"),
    )
    rows = found.select("uid", "doc_id", "repo", "owner", F.explode_outer("found").alias("f")).select(
        "uid", "doc_id", "repo", "owner", "f.*"
    )
    value = F.col("match")
    for k, (_, pattern, _, group) in enumerate(KINDS):
        if group:
            value = F.when(F.col("kind") == k, F.regexp_extract("match", pattern, group)).otherwise(value)
    long_enough = F.create_map(*(F.lit(x) for k in range(len(KINDS)) for x in (k, KINDS[k][2])))
    mixed = F.col("match").rlike("[0-9]") & F.col("match").rlike("[A-Z]") & F.col("match").rlike("[a-z]")
    keep = (F.length("value") >= F.element_at(long_enough, F.col("kind"))) & (
        (F.col("kind") != NAMES.index("mixed")) | mixed
    )
    before = Window.partitionBy("uid", "kind").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("value", value)
        .select(
            "uid", "doc_id", "repo", "owner", "kind", "ord", "gap",
            F.length("match").alias("size"),
            F.coalesce(keep, F.lit(False)).alias("keep"),
            F.sha2(F.col("value").cast("binary"), 256).alias("hash"),
        )
        .repartition("uid")
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before))
    )
    return stored(
        placed.select(
            "uid", "doc_id", "repo", "owner",
            F.when(F.col("keep"), F.col("kind")).alias("kind"),
            F.when(F.col("keep"), F.col("end") - F.col("size")).alias("start"),
            F.when(F.col("keep"), F.col("end")).alias("end"),
            F.when(F.col("keep"), F.col("hash")).alias("hash"),
        ),
        "secret-candidates",
    )


def ownership(found: DataFrame) -> DataFrame:
    """Per hash of a candidate: distinct owners and distinct (owner,
    repository) pairs that have it.  Null owners count as one owner."""
    pairs = found.filter("hash IS NOT NULL").groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return owners.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repos").cast("long").alias("repos")
    )


def scan_secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_col: str = "doc_id",
    owner_col: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``spans``, an array of
    (start, kind, end, name, owners, repos, verdict) by start and kind; verdict
    is example (that many owners have it), live (one owner has it, in fewer than
    ``copied_repositories`` repositories) or shared.  Positions are code points, end exclusive.

    Null text is empty and has no spans; null ids, owners and repositories are
    values like any other; repeated rows get a row each; other columns are not
    read; an empty table gives no rows."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(repo_col).cast("string").alias("repo"),
        F.col(owner_col).cast("string").alias("owner"),
        text_of(text_col).alias("text"),
    )
    found = candidates(rows)
    own = (F.col("owners") == 1) & (F.col("repos") < copied_repositories)
    verdict = F.when(F.col("owners") >= example_owners, "example").when(own, "live").otherwise("shared")
    judged = (
        found.filter("hash IS NOT NULL")
        .join(ownership(found), "hash")
        .select(
            "uid", "doc_id",
            F.struct(
                F.col("start").cast("long").alias("start"), "kind", F.col("end").cast("long").alias("end"),
                F.element_at(F.array(*map(F.lit, NAMES)), F.col("kind") + 1).alias("name"),
                "owners", "repos", verdict.alias("verdict"),
            ).alias("span"),
        )
    )
    none = T.StructType([T.StructField("span", judged.schema["span"].dataType)])
    bare = found.filter("hash IS NULL").select("uid", "doc_id", F.lit(None).cast(none["span"].dataType).alias("span"))
    spans = F.array_sort(F.collect_list("span"))
    told = judged.unionByName(bare).groupBy("uid", "doc_id").agg(spans.alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] < BASE)
    useful = F.filter(
        "spans",
        lambda s: (s["name"] != "mixed")
        | ((s["verdict"] != "example") & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))),
    )
    return told.withColumn("base", base).select("doc_id", useful.alias("spans"))


def _joined(spans: Column) -> Column:
    parts = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def redact(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every span (sorted by start; they may overlap) replaced."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mark))).alias("out"),
        )

    return F.aggregate(
        spans, start, step,
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = scan_secrets(table(spark, sf_dir, "documents"))

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["name"] == name)).cast("long").alias(f"n_{name}")

    def judged(verdict: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["verdict"] == verdict)).cast("long").alias(f"n_{verdict}")

    base = F.filter("spans", lambda s: s["kind"] < BASE)
    return told.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *map(count, NAMES[:BASE]),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        *map(judged, ("live", "shared", "example")),
    )
