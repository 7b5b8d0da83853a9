"""Property checks: the range-split global rank equals the literal window
rank for any values, ties, NULLs and range counts."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwell.operators import ranking

values = st.lists(st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, ranges=st.integers(1, 9), descending=st.booleans())
def test_global_rank_equals_window_rank(spark, vals, ranges, descending):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(vals)], "k long, v double")
    order = F.col("v").desc_nulls_first() if descending else F.col("v").asc_nulls_last()
    want = {r.k: r.r for r in df.withColumn("r", F.rank().over(Window.orderBy(order))).collect()}
    got = {r.k: r.r for r in ranking.global_rank(df, "v", "r", descending=descending, ranges=ranges).collect()}
    assert got == want


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.sets(st.integers(0, 10**9), min_size=1, max_size=40), ranges=st.integers(1, 9))
def test_unique_positions_are_dense(spark, keys, ranges):
    df = spark.createDataFrame([(k,) for k in keys], "row_id long")
    got = {r.row_id: r.p for r in ranking.numbered(df, "row_id", "p", ranges=ranges).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    amounts=st.lists(st.decimals(min_value=-6_000_000_000, max_value=6_000_000_000, places=2, allow_nan=False), min_size=1, max_size=30),
    percent=st.decimals(min_value=-50, max_value=50, places=2, allow_nan=False),
)
def test_raise_equals_exact_decimal_rounding(spark, amounts, percent):
    from decimal import ROUND_HALF_UP, Decimal, localcontext

    from martwell.operators import audit, maintenance

    items = spark.createDataFrame(
        [(i, "o", "p", a) for i, a in enumerate(amounts)], "row_id long, order_id string, product_id string, sales decimal(12,2)"
    )
    changes = maintenance.increase_sales(items, percent)
    got = {r.row_id: r.sales for r in changes.collect()}
    with localcontext() as ctx:
        ctx.prec = 50
        want = {
            i: (a + a * percent / Decimal(100)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
            for i, a in enumerate(amounts)
        }
    assert got == want
    logged = {r.row_id for r in audit.audit_rows(changes).collect()}
    assert logged == {i for i, a in enumerate(amounts) if want[i] != a}


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    pairs=st.lists(
        st.tuples(st.one_of(st.none(), st.dates()), st.one_of(st.none(), st.dates())), min_size=1, max_size=30
    )
)
def test_ship_repair_and_status_rules(spark, pairs):
    from martwell.functions.exprs import days_between, shipping_status
    from martwell.operators.audit import repaired_ship_date

    df = spark.createDataFrame([(i, o, s) for i, (o, s) in enumerate(pairs)], "k long, order_date date, ship_date date")
    out = df.select(
        "k",
        repaired_ship_date().alias("fixed"),
        shipping_status(days_between("ship_date", "order_date")).alias("status"),
    )
    got = {r.k: (r.fixed, r.status) for r in out.collect()}
    for i, (o, s) in enumerate(pairs):
        fixed = o if (o is not None and s is not None and s < o) else s
        delayed = o is not None and s is not None and (s - o).days > 5
        assert got[i] == (fixed, "Delayed" if delayed else "On Time")
