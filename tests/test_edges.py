"""Hand-made edge fixtures: nulls, ties, limits, rounding, bad input (FIXTURES 3)."""

from __future__ import annotations

import os
import tempfile
from datetime import date
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from martwell.functions import routines
from martwell.functions.exprs import json_text, json_value, raise_by_percent, to_money
from martwell.operators import audit, lookups, maintenance, normalize, quality, ranking, reports
from martwell.sources.ingest import read_staging_csv
from martwell.sources.model import RetailModel
from tests.conftest import rows

ORDER_SCHEMA = (
    "order_id string, order_date date, ship_date date, ship_mode string, customer_id string, "
    "country string, city string, state string, postal_code string, region string"
)
ITEM_SCHEMA = "row_id long, order_id string, product_id string, sales decimal(12,2)"


def make_model(spark, orders=(), items=(), customers=(), products=(), regions=(), tags=(), profiles=()):
    def o(order_id, od, sd=None, customer="C1", region="West", mode="Standard Class"):
        return (order_id, od, sd, mode, customer, "US", "X", "S", "00000", region)

    return RetailModel(
        regions=spark.createDataFrame([(r,) for r in regions], "region_name string"),
        customers=spark.createDataFrame(list(customers), "customer_id string, customer_name string, segment string"),
        products=spark.createDataFrame(
            list(products), "product_id string, product_name string, category string, sub_category string"
        ),
        orders=spark.createDataFrame([o(*x) if len(x) <= 6 else x for x in orders], ORDER_SCHEMA),
        order_items=spark.createDataFrame(list(items), ITEM_SCHEMA),
        product_tags=spark.createDataFrame(list(tags), "product_id string, tags array<string>"),
        customer_profiles=spark.createDataFrame(list(profiles), "customer_id string, profile string"),
    )


# ---- CSV load (S1, N1) --------------------------------------------------------------------

HEADER = (
    "Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,City,"
    "State,Postal Code,Region,Product ID,Category,Sub-Category,Product Name,Sales\n"
)


def _csv(body: str) -> str:
    d = tempfile.mkdtemp(prefix="mw-csv-")
    with open(os.path.join(d, "part.csv"), "w", encoding="utf-8") as f:
        f.write(HEADER + body)
    return d


def test_csv_quoting_and_empty_fields(spark):
    body = (
        '1,A-1,8/11/2016,11/11/2016,First Class,C1,"Say ""hi"", Bob",Consumer,US,,"",1,West,P1,F,B,'
        '"Chair, red\nbig",12.5\n'
    )
    df = read_staging_csv(spark, _csv(body), multiline=True)
    r = df.collect()
    assert len(r) == 1
    r = r[0]
    assert r.customer_name == 'Say "hi", Bob'
    assert r.product_name == "Chair, red\nbig"
    assert r.city is None  # unquoted empty -> NULL
    assert r.state == ""  # quoted empty -> ''
    assert r.sales == Decimal("12.5")


def test_csv_bad_amount_fails_load(spark):
    body = "1,A-1,8/11/2016,11/11/2016,First Class,C1,Bob,Consumer,US,X,S,1,West,P1,F,B,Chair,abc\n"
    with pytest.raises(Exception):
        read_staging_csv(spark, _csv(body)).collect()


# ---- dates (E1, N2, Q6) ------------------------------------------------------------------


def test_date_text(spark):
    st = spark.createDataFrame(
        [(1, "8/11/2016"), (2, "08/11/2016"), (3, "31/02/2016"), (4, None)], "row_id long, order_date string"
    ).withColumn("ship_date", F.col("order_date"))
    bad = quality.date_text_violations(st, ["order_date"], "row_id", "staging")
    assert rows(bad, "row_key", "date_text") == [("3", "31/02/2016")]
    parsed = st.where("row_id in (1, 2, 4)").select("row_id", F.to_date("order_date", "d/M/yyyy").alias("d"))
    assert rows(parsed) == [(1, date(2016, 11, 8)), (2, date(2016, 11, 8)), (4, None)]
    with pytest.raises(Exception):
        normalize.fact_orders(
            st.select(
                F.col("row_id").cast("string").alias("order_id"),
                "order_date",
                "ship_date",
                *[F.lit(None).cast("string").alias(c) for c in
                  ["ship_mode", "customer_id", "country", "city", "state", "postal_code", "region"]],
            )
        ).collect()


# ---- shipping delay (A4, N7) -----------------------------------------------------------------


def test_delay_limit(spark):
    m = make_model(
        spark,
        orders=[
            ("o5", date(2020, 1, 1), date(2020, 1, 6)),
            ("o6", date(2020, 1, 1), date(2020, 1, 7)),
            ("onull", date(2020, 1, 1), None),
            ("oneg", date(2020, 1, 10), date(2020, 1, 1)),
        ],
    )
    got = rows(reports.shipping_delay(m), "order_id", "days_to_ship", "shipping_status")
    assert got == [
        ("o5", 5, "On Time"),
        ("o6", 6, "Delayed"),
        ("oneg", -9, "On Time"),
        ("onull", None, "On Time"),
    ]


# ---- customer status (F4) -------------------------------------------------------------------


def test_status_limits(spark):
    latest = date(2020, 12, 31)
    m = make_model(
        spark,
        orders=[
            ("x", latest, None, "LATEST"),
            ("a", date(2020, 10, 2), None, "D90"),
            ("b", date(2020, 10, 1), None, "D91"),
            ("c", date(2020, 7, 4), None, "D180"),
            ("d", date(2020, 7, 3), None, "D181"),
        ],
    )
    asked = spark.createDataFrame([("D90",), ("D91",), ("D180",), ("D181",), ("NOPE",)], "customer_id string")
    got = dict(rows(routines.customer_status(m, asked)))
    assert got == {
        "D90": routines.STATUS_ACTIVE,
        "D91": routines.STATUS_AT_RISK,
        "D180": routines.STATUS_AT_RISK,
        "D181": routines.STATUS_CHURNED,
        "NOPE": routines.STATUS_NOT_FOUND,
    }
    assert rows(routines.status_of(m, "D91")) == [(routines.STATUS_AT_RISK,)]


# ---- date repair (T2) ---------------------------------------------------------------------------


def test_date_repair(spark):
    m = make_model(
        spark,
        orders=[
            ("lt", date(2020, 1, 10), date(2020, 1, 1)),
            ("gt", date(2020, 1, 1), date(2020, 1, 10)),
            ("nullship", date(2020, 1, 1), None),
            ("nullorder", None, date(2020, 1, 1)),
        ],
    )
    got = rows(audit.repair_ship_dates(m.orders), "order_id", "ship_date")
    assert got == [
        ("gt", date(2020, 1, 10)),
        ("lt", date(2020, 1, 10)),
        ("nullorder", date(2020, 1, 1)),
        ("nullship", None),
    ]


def test_repair_only_touched_rows(spark):
    m = make_model(
        spark, orders=[("a", date(2020, 1, 10), date(2020, 1, 1)), ("b", date(2020, 1, 10), date(2020, 1, 1))]
    )
    upd = spark.createDataFrame([("a", "Same Day")], "order_id string, new_mode string")
    got = rows(maintenance.update_ship_mode(m.orders, upd), "order_id", "ship_mode", "ship_date")
    assert got == [("a", "Same Day", date(2020, 1, 10)), ("b", "Standard Class", date(2020, 1, 1))]
    forced = maintenance.set_ship_date(m.orders, "b", F.lit(date(2010, 1, 1)))
    assert rows(forced.where("order_id = 'b'"), "ship_date") == [(date(2020, 1, 10),)]


# ---- audit (T1) --------------------------------------------------------------------------------


def test_audit_nulls(spark):
    ch = spark.createDataFrame(
        [(1, Decimal("1"), Decimal("2")), (2, Decimal("1"), Decimal("1")), (3, None, Decimal("1")), (4, None, None)],
        "row_id long, old_sales decimal(12,2), sales decimal(12,2)",
    )
    assert [r[0] for r in rows(audit.audit_rows(ch), "row_id")] == [1, 3]


def test_audit_rounding_not_logged(spark):
    items = spark.createDataFrame([(1, "o", "p", Decimal("0.01"))], ITEM_SCHEMA)
    ch = maintenance.increase_sales(items, 5)
    assert rows(ch, "sales") == [(Decimal("0.01"),)]
    assert audit.audit_rows(ch).count() == 0


def test_rounding_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("1.005"),), (Decimal("-1.005"),)], "x decimal(38,10)")
    assert sorted(r[0] for r in df.select(to_money(F.col("x"))).collect()) == [Decimal("-1.01"), Decimal("1.01")]


def test_raise_stays_decimal(spark):
    df = spark.createDataFrame([(Decimal("10.00"),)], "sales decimal(12,2)")
    out = df.select(raise_by_percent("sales", Decimal("5")).alias("s"))
    assert dict(out.dtypes)["s"] == "decimal(12,2)"
    assert out.first().s == Decimal("10.50")


def test_amount_overflow(spark):
    df = spark.createDataFrame([(1, Decimal("99999999999.99")), (2, Decimal("5"))], "row_id long, sales decimal(38,10)")
    assert rows(quality.amount_violations(df, "sales", "row_id", "staging"), "row_key") == [("1",)]
    with pytest.raises(Exception):
        df.select(to_money(F.col("sales"))).collect()


def test_numbering_after_base(spark):
    a = spark.createDataFrame(
        [(r, Decimal("1"), Decimal("2")) for r in (30, 10, 20)], "row_id long, old_sales decimal(12,2), new_sales decimal(12,2)"
    )
    got = rows(audit.number_audit_rows(a, 100), "audit_id", "row_id")
    assert got == [(101, 10), (102, 20), (103, 30)]


# ---- ranking (W1, N6, W4) --------------------------------------------------------------------


def test_rank_ties_and_nulls(spark):
    df = spark.createDataFrame([("n", None), ("a", 2.0), ("b", 2.0), ("c", 1.0)], "customer_name string, total_sales double")
    got = rows(ranking.global_rank(df, "total_sales", "r", ranges=2), "customer_name", "r")
    assert got == [("a", 2), ("b", 2), ("c", 4), ("n", 1)]


def test_rank_hot_value(spark):
    # a third of all rows share one value
    data = [(f"h{i}", 5.0) for i in range(100)] + [(f"x{i}", float(i)) for i in range(200)]
    df = spark.createDataFrame(data, "customer_name string, total_sales double")
    from pyspark.sql import Window

    plain = df.withColumn("r", F.rank().over(Window.orderBy(F.col("total_sales").desc_nulls_first())))
    scal = ranking.global_rank(df, "total_sales", "r", ranges=16)
    assert rows(plain, "customer_name", "r") == rows(scal, "customer_name", "r")


def test_largest_line_tiebreak(spark):
    m = make_model(
        spark,
        orders=[("o1", date(2020, 1, 1), None, "C1"), ("o2", date(2020, 1, 1), None, "C1"),
                ("o3", date(2020, 1, 1), None, "C2"), ("o4", date(2020, 1, 1), None, "C2")],
        items=[(1, "o2", "p", Decimal("9")), (2, "o1", "p", Decimal("9")), (3, "o3", "p", Decimal("1")),
               (4, "o4", "p", None)],
    )
    m = m.replace(orders=m.orders.withColumn("order_id", F.col("order_id")))
    got = rows(ranking.largest_line_per_customer(m), "customer_id", "order_id")
    # ties go to the lowest order id; a NULL amount sorts first under DESC
    assert got == [("C1", "o1"), ("C2", "o4")]


# ---- functions / reports on missing data -------------------------------------------------------


def test_region_without_sales(spark):
    m = make_model(spark, orders=[("o1", date(2020, 1, 1), None, "C1", "West")], items=[(1, "o1", "p", Decimal("3"))])
    asked = spark.createDataFrame([("West",), ("Nowhere",)], "region string")
    assert dict(rows(routines.region_total_or_zero(m, asked))) == {"West": 3.0, "Nowhere": 0.0}
    assert rows(routines.total_sales_by_region(m, "Nowhere")) == [(0.0,)]
    assert reports.region_revenue_param(spark, m, "Nowhere").count() == 0
    assert rows(reports.region_revenue_param(spark, m, "West")) == [("West", 3.0)]


def test_top_products_month_range(spark):
    m = make_model(
        spark,
        orders=[("a", date(2016, 11, 1)), ("b", date(2016, 11, 30)), ("c", date(2016, 12, 1)), ("d", date(2016, 10, 31))],
        items=[(1, "a", "p1", Decimal("5")), (2, "b", "p2", Decimal("5")), (3, "c", "p1", Decimal("50")),
               (4, "d", "p2", Decimal("50"))],
        products=[("p1", "Pen", "Office", "Art"), ("p2", "Box", "Office", "Storage")],
    )
    got = [tuple(r) for r in routines.top_products_of_month(m, "2016-11", 5).collect()]
    assert got == [("Box", "Office", 5.0), ("Pen", "Office", 5.0)]


# ---- normalisation and keys (P3, Q1, Q2) -------------------------------------------------------


def test_duplicate_product_lowest_row_wins(spark):
    st = spark.createDataFrame(
        [(2, "P1", "Late", "C", "S"), (1, "P1", "Early", "C", "S")],
        "row_id long, product_id string, product_name string, category string, sub_category string",
    )
    assert rows(normalize.dim_products(st), "product_id", "product_name") == [("P1", "Early")]


def test_duplicate_customer_is_key_violation(spark):
    st = spark.createDataFrame(
        [("C1", "Ann", "Consumer"), ("C1", "Anne", "Consumer"), ("C2", "Bo", "Consumer")],
        "customer_id string, customer_name string, segment string",
    )
    v = quality.pk_violations(normalize.dim_customers(st), ["customer_id"], "customers")
    assert rows(v, "key_value", "n_rows") == [("C1", 2)]


def test_orphan_lines(spark):
    m = make_model(
        spark,
        orders=[("o1", date(2020, 1, 1))],
        items=[(1, "o1", "p", Decimal("1")), (2, "ghost", "p", Decimal("1")), (3, None, "p", Decimal("1"))],
    )
    v = quality.fk_violations(m.order_items, "order_id", m.orders, "order_id", "order_items")
    assert rows(v, "missing_value", "n_rows") == [("ghost", 1)]


def test_length_limits(spark):
    df = spark.createDataFrame([("k1", "x" * 5 + "   "), ("k2", "y" * 6)], "id string, name string")
    v = quality.length_violations(df, {"name": 5}, "t", "id")
    assert rows(v, "row_key", "value_length") == [("k2", 6)]


def test_partition_ranges(spark):
    bounds = [("2015", date(2015, 1, 1), date(2016, 1, 1)), ("2016", date(2016, 1, 1), date(2017, 1, 1))]
    df = spark.createDataFrame(
        [("a", date(2015, 1, 1)), ("b", date(2015, 12, 31)), ("c", date(2016, 1, 1)), ("d", date(2014, 12, 31)), ("e", None)],
        "order_id string, order_date date",
    )
    tagged = df.select("order_id", quality.range_partition("order_date", bounds).alias("p"))
    assert rows(tagged) == [("a", "2015"), ("b", "2015"), ("c", "2016"), ("d", None), ("e", None)]
    v = quality.range_violations(df, "order_date", "order_id", bounds, "orders")
    assert [r[0] for r in rows(v, "row_key")] == ["d", "e"]


# ---- erasure (M4, J5) ----------------------------------------------------------------------------


def test_erasure(spark):
    m = make_model(
        spark,
        customers=[("C1", "Ann", "Consumer"), ("C2", "Bo", "Consumer")],
        orders=[("o1", date(2020, 1, 1), None, "C1"), ("o2", date(2020, 1, 2), None, "C1"),
                ("o3", date(2020, 1, 3), None, "C2")],
        items=[(1, "o1", "p", Decimal("1")), (2, "o1", "p", Decimal("1")), (3, "o2", "p", Decimal("1")),
               (4, "o3", "p", Decimal("1")), (5, None, "p", Decimal("1"))],
        profiles=[("C1", '{"age": 30}'), ("C2", '{"age": 40}')],
    )
    ids = spark.createDataFrame([("C1",), (None,)], "customer_id string")
    e = maintenance.erase_customers(m, ids)
    assert [r[0] for r in rows(e.order_items, "row_id")] == [4, 5]
    assert [r[0] for r in rows(e.orders, "order_id")] == ["o3"]
    assert [r[0] for r in rows(e.customer_profiles, "customer_id")] == ["C2"]
    assert [r[0] for r in rows(e.customers, "customer_id")] == ["C2"]
    assert quality.fk_violations(e.order_items, "order_id", e.orders, "order_id", "order_items").count() == 0


# ---- JSON and arrays (E10, E11, E13, S4, S5) -------------------------------------------------------


def test_json_access(spark):
    df = spark.createDataFrame(
        [
            ("n", '{"age": 30, "membership": "gold", "preferences": ["office", "technology"]}'),
            ("jnull", '{"age": null}'),
            ("missing", '{"other": 1}'),
            ("bad", "{not json"),
        ],
        "customer_id string, profile string",
    )
    got = {r.customer_id: (r.t, r.j) for r in df.select("customer_id", json_text("profile", "age").alias("t"),
                                                         json_value("profile", "age").alias("j")).collect()}
    assert got["n"] == ("30", "30")
    assert got["jnull"][0] is None
    assert got["missing"] == (None, None)
    assert got["bad"] == (None, None)
    prefs = df.where("customer_id = 'n'").select(json_text("profile", "preferences").alias("p"),
                                                  json_value("profile", "membership").alias("m")).first()
    assert prefs.p == '["office","technology"]'
    assert prefs.m == '"gold"'  # the JSON form keeps the quotes of a string
    gold = lookups.profiles_with_key(df, "membership", "gold", ["age", "preferences"])
    assert rows(gold, "customer_id", "age_text") == [("n", "30")]


def test_profile_insert_refuses_bad_json(spark):
    base = spark.createDataFrame([], "customer_id string, profile string")
    merged, bad = lookups.append_profile_rows(spark, base, [("C1", '{"age": 30}'), ("C2", "{oops")])
    assert rows(merged, "customer_id") == [("C1",)]
    assert rows(bad, "customer_id") == [("C2",)]


def test_tags(spark):
    tags = spark.createDataFrame(
        [("p1", ["furniture", "wood", "office"]), ("p2", ["metal"]), ("p3", ["metal", None]), ("p4", None)],
        "product_id string, tags array<string>",
    )
    assert rows(lookups.products_with_tag(tags, "  wood "), "product_id") == [("p1",)]
    assert lookups.products_with_tag(tags, "plastic").count() == 0
    more = lookups.append_tag_rows(spark, tags, [("FUR-BO-10001798", ["furniture", "wood", "office"])])
    assert rows(lookups.products_with_tag(more, "wood"), "product_id") == [("FUR-BO-10001798",), ("p1",)]


def test_month_calendar(spark):
    df = spark.range(1).select(ranking.month_calendar(F.lit(date(2020, 1, 1)), F.lit(date(2020, 12, 1))).alias("m"))
    got = [r[0] for r in rows(df)]
    assert len(got) == 12 and got[0] == date(2020, 1, 1) and got[-1] == date(2020, 12, 1)


def test_segment_rename_keeps_null(spark):
    c = spark.createDataFrame([("1", "a", "Consumer"), ("2", "b", None), ("3", "c", "Corporate")],
                              "customer_id string, customer_name string, segment string")
    got = rows(maintenance.rename_segment(c, "Consumer", "B2C"), "customer_id", "segment")
    assert got == [("1", "B2C"), ("2", None), ("3", "Corporate")]


def test_line_deltas_set_form(spark):
    items = spark.createDataFrame([(1, "o", "p", Decimal("1.00")), (2, "o", "p", Decimal("2.00"))], ITEM_SCHEMA)
    d = spark.createDataFrame([(1, Decimal("0.5")), (1, Decimal("0.25"))], "row_id long, amount decimal(12,2)")
    ch = maintenance.add_to_lines(items, d)
    assert rows(ch, "row_id", "old_sales", "sales") == [(1, Decimal("1.00"), Decimal("1.75")),
                                                        (2, Decimal("2.00"), Decimal("2.00"))]
    assert rows(audit.audit_rows(ch), "row_id") == [(1,)]


def test_order_count_single_and_set(spark):
    m = make_model(spark, orders=[("o1", date(2020, 1, 1), None, "C1"), ("o2", date(2020, 1, 2), None, "C1")])
    assert rows(routines.order_count_of(m, "C1")) == [(2,)]
    assert rows(routines.order_count_of(m, "C9")) == [(0,)]
    asked = spark.createDataFrame([("C1",), ("C9",)], "customer_id string")
    assert rows(routines.customer_order_count(m, asked)) == [("C1", 2), ("C9", 0)]


def test_strict_pipeline_refuses_bad_rows(spark):
    from martwell.plans.pipeline import run_pipeline
    from martwell.session import new_scratch_dir
    from martwell.sources.storage import TableStore

    good = "1,A-1,8/11/2016,11/11/2016,First Class,C1,Bob,Consumer,US,X,S,1,West,P1,F,B,Chair,10\n"
    bad_date = "2,A-2,31/02/2016,11/11/2016,First Class,C1,Bob,Consumer,US,X,S,1,West,P1,F,B,Chair,10\n"
    tags = spark.createDataFrame([], "product_id string, tags array<string>")
    profiles = spark.createDataFrame([], "customer_id string, profile string")
    root = new_scratch_dir(spark, "t-pipe")
    with pytest.raises(quality.ConstraintViolation, match="date_text=1"):
        run_pipeline(spark, _csv(good + bad_date), tags, profiles, root=root)
    assert TableStore(spark, root).list_tables() == []  # nothing published
    ok = run_pipeline(spark, _csv(good), tags, profiles, root=new_scratch_dir(spark, "t-pipe"))
    assert dict(rows(ok.checks)) == {"pk": 0, "fk": 0, "length": 0, "amount": 0, "date_text": 0}
    assert "orders" in ok.store.list_tables() and "staging" in ok.store.list_tables()


def test_rank_of_floating_sums_keeps_every_row(spark):
    # totals that are floating-point sums: recomputation may reorder the
    # additions, so the ranked input must be read once
    df = spark.range(0, 20000).select((F.col("id") % 997).alias("k"), (F.col("id") * 0.1).alias("v"))
    totals = df.repartition(7).groupBy("k").agg(F.sum("v").alias("t"))
    ranked = ranking.global_rank(totals, "t", "r", ranges=9)
    assert ranked.count() == 997
    assert ranked.agg(F.min("r"), F.max("r")).first() == (1, 997)


def test_rank_groups_by_name_homonyms_merge(spark):
    m = make_model(
        spark,
        customers=[("C1", "Ann Lee", "Consumer"), ("C2", "Ann Lee", "Corporate"), ("C3", "Bo", "Consumer")],
        orders=[("o1", date(2020, 1, 1), None, "C1"), ("o2", date(2020, 1, 1), None, "C2"),
                ("o3", date(2020, 1, 1), None, "C3")],
        items=[(1, "o1", "p", Decimal("4")), (2, "o2", "p", Decimal("4")), (3, "o3", "p", Decimal("6"))],
    )
    got = rows(ranking.customer_rank(m), "customer_name", "total_sales", "sales_rank")
    assert got == [("Ann Lee", 8.0, 1), ("Bo", 6.0, 2)]


def test_enforce_fails_only_on_violations(spark):
    clean = spark.createDataFrame([("a",), ("b",)], "k string")
    dup = spark.createDataFrame([("a",), ("a",)], "k string")
    quality.enforce(quality.pk_violations(clean, ["k"], "t"), "t primary key")
    with pytest.raises(quality.ConstraintViolation, match="t primary key"):
        quality.enforce(quality.pk_violations(dup, ["k"], "t"), "t primary key")


def test_region_parameter_is_bound_not_pasted(spark):
    m = make_model(spark, orders=[("o1", date(2020, 1, 1), None, "C1", "West")], items=[(1, "o1", "p", Decimal("3"))])
    assert reports.region_revenue_param(spark, m, "x' OR '1'='1").count() == 0
    assert rows(reports.region_revenue_param(spark, m, "West")) == [("West", 3.0)]


def test_duplicate_updates_resolve_deterministically(spark):
    m = make_model(spark, orders=[("a", date(2020, 1, 1), date(2020, 1, 2))])
    upd = spark.createDataFrame([("a", "First Class"), ("a", "Same Day")], "order_id string, new_mode string")
    got = rows(maintenance.update_ship_mode(m.orders, upd), "order_id", "ship_mode")
    assert got == [("a", "Same Day")]  # one row per order; the larger value wins


def test_rank_keeps_cents_beyond_double_precision(spark):
    df = spark.createDataFrame(
        [("a", Decimal("90071992547409.93")), ("b", Decimal("90071992547409.94"))], "name string, total decimal(32,2)"
    )
    assert rows(ranking.global_rank(df, "total", "r"), "name", "r") == [("a", 2), ("b", 1)]


def test_numbering_has_as_many_files_as_the_session_has_partitions(spark):
    log = ranking._in_order(spark.range(100_000).withColumnRenamed("id", "row_id"), "row_id", False, 8)
    sizes = [r["count"] for r in log.groupBy("_file").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 100_000 / 4


def test_orders_of_thousands_of_lines_build(spark, tmp_path):
    from martwell.plans.warehouse import open_warehouse

    src = str(tmp_path / "long")
    os.makedirs(src)
    for t in ("region", "nation", "customer", "part", "orders", "events"):
        os.symlink(f"/root/testdata/sf0.001/{t}.parquet", f"{src}/{t}.parquet")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    first = lines.orderBy("l_orderkey", "l_linenumber").limit(1).drop("l_linenumber")
    kind = lines.schema["l_linenumber"].dataType
    more = first.crossJoin(spark.range(10, 5010).select(F.col("id").cast(kind).alias("l_linenumber")))
    lines.unionByName(more).write.parquet(f"{src}/lineitem.parquet")
    m = open_warehouse(spark, src)
    assert m.order_items.count() == lines.count() + 5000
    assert quality.model_pk_violations(m).isEmpty()

    # a long order changes the key of no line of another order, and has the keys of the plain formula
    from martwell.plans.oracle import with_model

    before = open_warehouse(spark, "/root/testdata/sf0.001").order_items
    key = first.first().l_orderkey
    others = lambda df: df.where(F.col("order_id") != key).select("row_id", "order_id", "product_id", "sales")
    assert others(before).exceptAll(others(m.order_items)).isEmpty() and others(m.order_items).count() == others(before).count()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{src}/lineitem.parquet/*.parquet')")
    for t in ("region", "nation", "customer", "part", "orders", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{src}/{t}.parquet')")
    want = con.execute(with_model("SELECT row_id, order_id, product_id, sales FROM m_items")).fetchall()
    assert sorted(map(tuple, m.order_items.select("row_id", "order_id", "product_id", "sales").collect())) == sorted(want)
    long_keys = sorted(r.row_id for r in m.order_items.where(F.col("order_id") == key).collect())
    over = len(long_keys) - 999
    assert long_keys[over:] == [key * 1000 + p for p in range(1, 1000)] and long_keys[0] == -len(long_keys)


def test_equal_lines_of_a_long_order_have_keys_of_their_own(spark, tmp_path):
    from martwell.sources.testdata import bind_order_items

    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    one = lines.orderBy("l_orderkey", "l_linenumber").limit(1)
    lines.unionByName(one.crossJoin(spark.range(3000)).drop("id")).write.parquet(f"{tmp_path}/lineitem.parquet")
    items = bind_order_items(spark, str(tmp_path))
    assert items.count() == items.select("row_id").distinct().count() == lines.count() + 3000


def test_snapshot_refuses_a_copy_that_differs(spark, tmp_path):
    from martwell.sources import storage

    changing = spark.range(10).select(F.current_timestamp().alias("v"))  # other values in every job
    with pytest.raises(RuntimeError, match="differs"):
        storage.snapshot(spark, {"t": changing}, str(tmp_path / "snap"))


def test_changes_keep_the_declared_limits(spark):
    m = make_model(spark, customers=[("C1", "Ann", "Consumer")], orders=[("o1", date(2020, 1, 1), None, "C1")], items=[])
    assert maintenance.rename_segment(m.customers, "Consumer", "x" * 50 + "  ").count() == 1  # blanks don't count
    assert maintenance.rename_segment(m.customers, "Other", "x" * 51).collect()[0].segment == "Consumer"  # no row written
    long = spark.createDataFrame([("o1", "x" * 51)], "order_id string, new_mode string")
    for changed in (
        maintenance.rename_segment(m.customers, "Consumer", "x" * 51),
        maintenance.set_ship_mode(m.orders, "o1", "x" * 51),
        maintenance.update_ship_mode(m.orders, long),
    ):
        with pytest.raises(Exception, match="too long"):
            changed.collect()
