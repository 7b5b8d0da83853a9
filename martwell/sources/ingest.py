"""Flat-file load into staging (S1) and insert-from-select (S3).

The source is a CSV with a header line, columns matched by position.  Quoting
follows the usual CSV rules: a doubled quote inside a quoted field, commas and
(optionally) line breaks inside quotes.  An unquoted empty field is NULL, a
quoted empty field is empty text.  Any malformed row aborts the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martwell.sources.model import STAGING_SCHEMA

# CSV dialect of the source files.
CSV_READ_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "encoding": "UTF-8",
    # NUL never occurs in text, so only a truly empty unquoted field is NULL
    # and a quoted empty field stays ''.
    "nullValue": "\u0000",
    "emptyValue": "",
    "enforceSchema": "true",
}
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": '""',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # text of flat rows takes a tenth of the disk so; a compressed file is read by one
    # task, hence the lines of a file are bounded
    "compression": "gzip",
    "maxRecordsPerFile": "250000",
}


def read_staging_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Load flat order files into the staging layout.

    ``multiline`` is needed only when fields contain line breaks; it stops
    Spark from splitting a file, so large inputs should then come as many
    files (each file is still read in parallel with the others)."""
    reader = spark.read.schema(STAGING_SCHEMA).options(**CSV_READ_OPTIONS)
    if multiline:
        reader = reader.option("multiLine", "true")
    return reader.csv(path)


def write_staging_csv(df: DataFrame, path: str) -> str:
    """Write staging rows as compressed CSV files in the source dialect (one per
    partition, or more if it is large, so the load stays parallel)."""
    df.write.mode("errorifexists").options(**CSV_WRITE_OPTIONS).csv(path)
    return path


def insert_select(target_path: str, df: DataFrame, columns: list[str], fmt: str = "parquet") -> None:
    """S3: INSERT INTO t (cols) SELECT ... -- append the selected columns."""
    df.select(*columns).write.mode("append").format(fmt).save(target_path)
