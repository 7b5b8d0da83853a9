"""Array and JSON side tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwell.functions.exprs import array_has, json_text, json_value

TAGS_SCHEMA = T.StructType(
    [T.StructField("product_id", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType()))]
)
PROFILE_SCHEMA = T.StructType(
    [T.StructField("customer_id", T.StringType()), T.StructField("profile", T.StringType())]
)


def profiles_with_key(profiles: DataFrame, filter_key: str, value: str, show_keys: list[str]) -> DataFrame:
    """Profiles whose ``filter_key`` (as text) equals ``value``; shows each
    key of ``show_keys`` as text (``<key>_text``) and as JSON (``<key>_json``)."""
    out = [F.col("customer_id")]
    for k in show_keys:
        out.append(json_text("profile", k).alias(f"{k}_text"))
        out.append(json_value("profile", k).alias(f"{k}_json"))
    return profiles.where(json_text("profile", filter_key) == F.lit(value)).select(*out)


def products_with_tag(tags: DataFrame, tag: str) -> DataFrame:
    """Products whose tag array contains the (trimmed) tag."""
    return tags.where(array_has("tags", tag)).select("product_id", "tags")


def append_tag_rows(spark: SparkSession, tags: DataFrame, rows: list[tuple[str, list[str]]]) -> DataFrame:
    """Literal rows with array values appended to the tag table."""
    new = spark.createDataFrame(rows, TAGS_SCHEMA)
    return tags.select(F.col("product_id").cast("string"), "tags").unionByName(new)


def append_profile_rows(
    spark: SparkSession, profiles: DataFrame, rows: list[tuple[str, str]]
) -> tuple[DataFrame, DataFrame]:
    """Literal rows with JSON text appended to the profile table.  Rows
    whose text is not JSON are refused (returned as the second frame)."""
    new = spark.createDataFrame(rows, PROFILE_SCHEMA)
    ok = F.try_parse_json("profile").isNotNull() | F.col("profile").isNull()
    good = new.where(ok)
    bad = new.where(~ok)
    merged = profiles.select(F.col("customer_id").cast("string"), "profile").unionByName(good)
    return merged, bad
