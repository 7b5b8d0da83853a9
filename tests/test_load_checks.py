"""The checks of a load: counts against the violation frames, and passes made."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from martwell.operators import quality
from martwell.plans import pipeline
from martwell.session import new_scratch_dir
from martwell.sources.model import LENGTH_LIMITS, STAGING_SCHEMA
from martwell.sources.storage import TableStore
from tests.test_edges import make_model
from tests.test_plans import plan


def _faulty(spark):
    row = {f.name: None for f in STAGING_SCHEMA.fields}
    rows = [
        {**row, "row_id": 1, "order_date": "8/11/2016", "ship_date": "31/2/2016"},
        {**row, "row_id": 2, "order_date": "11/30/2016", "ship_date": "x"},
        {**row, "row_id": 3, "order_date": None, "ship_date": ""},
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], STAGING_SCHEMA)
    return df.withColumn("sales", F.when(F.col("row_id") == 2, F.lit("99999999999")).otherwise("1.5").cast(STAGING_SCHEMA["sales"].dataType))


def test_observed_counts_are_those_of_the_violation_frames(spark):
    df = _faulty(spark).repartition(3)
    store = TableStore(spark, new_scratch_dir(spark, "t-observed"))
    path, told = pipeline.stage_observed(store, "staging", df, quality.staging_faults())
    written = spark.read.parquet(path)
    assert told == {
        "amount": quality.amount_violations(written, "sales", "row_id", "staging").count(),
        "date_text": quality.date_text_violations(written, ["order_date", "ship_date"], "row_id", "staging").count(),
    }
    assert told["amount"] == 1 and told["date_text"] == 4
    assert pipeline.stage_observed(store, "staging", df.limit(0), quality.staging_faults())[1] == {"amount": 0, "date_text": 0}


def test_row_faults_are_counted_in_one_pass_per_table(spark, model_small):
    years = [("y", date(2020, 1, 1), date(2021, 1, 1))]
    orders = [("o1", date(2020, 5, 1)), ("o2", date(2021, 1, 1)), ("o" * 51, None)]
    m = make_model(spark, customers=[("C1", "n" * 300, "s" * 60), ("C2", "ok", None)], orders=orders, items=[])
    told = {r.check_name: r.n_violations for r in quality.row_fault_counts(m, years).collect()}
    assert told == {
        "length": quality.model_length_violations(m).count(),
        "range": quality.range_violations(m.orders, "order_date", "order_id", years, "orders").count(),
    }
    assert told["length"] > 0 and told["range"] == 2
    assert {r.check_name for r in quality.row_fault_counts(m).collect()} == {"length"}
    scans = plan(quality.row_fault_counts(model_small, years)).count("FileScan parquet")
    assert scans == len(LENGTH_LIMITS)
