"""Command line: load, report, change, list, preview, snapshot and restore.

    python -m martwell load --csv data/*.csv --root WAREHOUSE
    python -m martwell build --source /root/testdata/sf0.1 --root WAREHOUSE
    python -m martwell report revenue_by_region_category --root WAREHOUSE
    python -m martwell report top_products_of_month --month 2016-11 --n 5 --root WAREHOUSE
    python -m martwell change raise --percent 5 --root WAREHOUSE
    python -m martwell change erase --customer SO-20335 --root WAREHOUSE
    python -m martwell tables --root WAREHOUSE
    python -m martwell preview orders -n 100 --root WAREHOUSE
    python -m martwell refresh --root WAREHOUSE
    python -m martwell sql "SELECT * FROM mv_category_sales" --root WAREHOUSE
    python -m martwell snapshot --root WAREHOUSE --to BACKUPS
    python -m martwell restore --from BACKUPS --root NEW_WAREHOUSE

Results are shown with a row limit (``--show``); nothing unbounded reaches
the driver.  Changes are written as new table versions and published in one
commit (with the audit rows for amount changes).  If another process published
one of the changed tables since they were read, or a commit at the same time,
the command ends in ``Conflict`` and changes nothing; run it again.
"""

from __future__ import annotations

import argparse
from decimal import Decimal

from pyspark.sql import functions as F

from martwell.functions import routines
from martwell.operators import lookups, maintenance, ranking, reports
from martwell.session import build_session


def _reports(spark, model, a):
    ids = lambda: spark.createDataFrame([(c,) for c in a.customer], "customer_id string")
    return {
        "revenue_by_region_category": lambda: reports.revenue_by_region_category(model),
        "revenue_by_month": lambda: reports.revenue_by_month(model),
        "customer_value": lambda: reports.customer_value(model),
        "shipping_delay": lambda: reports.shipping_delay(model),
        "shipping_status_counts": lambda: reports.shipping_status_counts(model),
        "category_revenue": lambda: reports.category_revenue(model),
        "state_city_revenue": lambda: reports.state_city_revenue(model),
        "kpi_summary": lambda: reports.kpi_summary(model),
        "region_revenue": lambda: reports.region_revenue_param(spark, model, a.region),
        "region_total": lambda: routines.total_sales_by_region(model, a.region),
        "top_customers_by_spend": lambda: reports.top_customers_by_spend(model, a.n),
        "customer_rank": lambda: ranking.customer_rank(model),
        "top_customers_ranked": lambda: ranking.top_customers_ranked(model, a.n),
        "running_revenue": lambda: ranking.running_revenue(model),
        "largest_line_per_customer": lambda: ranking.largest_line_per_customer(model),
        "month_calendar": lambda: ranking.calendar_revenue(model),
        "top_products_of_month": lambda: routines.top_products_of_month(model, a.month, a.n),
        "top_products_all_months": lambda: routines.top_products_all_months(model, a.n),
        "customer_order_count": lambda: routines.customer_order_count(model, ids()),
        "customer_status": lambda: routines.customer_status(model, ids()),
        "profile_lookup": lambda: lookups.profiles_with_key(
            model.customer_profiles, a.key, a.value, a.show_keys or [a.key]
        ),
        "tag_lookup": lambda: lookups.products_with_tag(model.product_tags, a.tag),
        "order_lookup": lambda: reports.order_lookup(model, a.order),
    }


# Report names accepted by ``report`` (the keys of ``_reports``).
REPORT_NAMES = [
    "revenue_by_region_category", "revenue_by_month", "customer_value", "shipping_delay",
    "shipping_status_counts", "category_revenue", "state_city_revenue", "kpi_summary",
    "region_revenue", "region_total", "top_customers_by_spend", "customer_rank",
    "top_customers_ranked", "running_revenue", "largest_line_per_customer", "month_calendar",
    "top_products_of_month", "top_products_all_months", "customer_order_count", "customer_status",
    "profile_lookup", "tag_lookup", "order_lookup",
]


def main(argv: list[str] | None = None, stop: bool = True) -> int:
    p = argparse.ArgumentParser(prog="martwell")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    q = sub.add_parser("load", help="S1 + checks + normalise + publish from CSV files")
    q.add_argument("--csv", required=True)
    q.add_argument("--root", required=True)
    q.add_argument("--multiline", action="store_true")
    q.add_argument("--lenient", action="store_true", help="publish even with violations")

    q = sub.add_parser("build", help="S2 from the TPC-H-style test tables")
    q.add_argument("--source", required=True)
    q.add_argument("--root", required=True)

    q = sub.add_parser("report")
    q.add_argument("name", choices=REPORT_NAMES)
    q.add_argument("--root", required=True)
    q.add_argument("--region", default="West")
    q.add_argument("--month", default="2016-11")
    q.add_argument("--n", type=int, default=5)
    q.add_argument("--customer", nargs="*", default=[])
    q.add_argument("--order", default=None)
    q.add_argument("--tag", default="office")
    q.add_argument("--key", default="membership")
    q.add_argument("--value", default="gold")
    q.add_argument("--show-keys", nargs="*", default=None)
    q.add_argument("--show", type=int, default=50)

    q = sub.add_parser("change")
    q.add_argument("what", choices=["ship-mode", "ship-date", "raise", "add", "rename-segment", "erase"])
    q.add_argument("--root", required=True)
    q.add_argument("--order", default=None)
    q.add_argument("--mode", default=None)
    q.add_argument("--date", default=None)
    q.add_argument("--percent", default="5")
    q.add_argument("--row", default=None)
    q.add_argument("--amount", default="50")
    q.add_argument("--old", default=None)
    q.add_argument("--new", default=None)
    q.add_argument("--customer", nargs="*", default=[])

    q = sub.add_parser("tag", help="S4: append a row of tags to a product")
    q.add_argument("--product", required=True)
    q.add_argument("--tags", nargs="*", default=[])
    q.add_argument("--root", required=True)

    q = sub.add_parser("profile", help="S5: append a JSON profile to a customer")
    q.add_argument("--customer", required=True)
    q.add_argument("--json", required=True)
    q.add_argument("--root", required=True)

    q = sub.add_parser("refresh", help="M9: recompute stored results")
    q.add_argument("names", nargs="*")
    q.add_argument("--root", required=True)

    q = sub.add_parser("sql", help="run one SQL statement over the warehouse's tables, views and functions")
    q.add_argument("statement")
    q.add_argument("--root", required=True)
    q.add_argument("--show", type=int, default=50)

    q = sub.add_parser("tables")
    q.add_argument("--root", required=True)
    q = sub.add_parser("preview")
    q.add_argument("table")
    q.add_argument("-n", type=int, default=100)
    q.add_argument("--root", required=True)
    q = sub.add_parser("snapshot")
    q.add_argument("--root", required=True)
    q.add_argument("--to", required=True)
    q = sub.add_parser("restore")
    q.add_argument("--from", dest="src", required=True)
    q.add_argument("--root", required=True)
    q.add_argument("--ts", default=None)

    a = p.parse_args(argv)
    spark = build_session(master=a.master)
    from martwell.plans import sql_surface
    from martwell.plans.warehouse import build_warehouse, store_model
    from martwell.sources import storage
    from martwell.sources.testdata import bind_model

    store = storage.TableStore(spark, a.root)
    if a.cmd == "load":
        from martwell.plans.pipeline import run_pipeline

        tags = spark.createDataFrame([], "product_id string, tags array<string>")
        profiles = spark.createDataFrame([], "customer_id string, profile string")
        res = run_pipeline(spark, a.csv, tags, profiles, root=a.root, strict=not a.lenient, multiline=a.multiline)
        res.checks.show(truncate=False)
    elif a.cmd == "build":
        build_warehouse(spark, bind_model(spark, a.source), root=a.root)
        print(store.list_tables())
    elif a.cmd == "report":
        _reports(spark, store_model(store), a)[a.name]().show(a.show, truncate=False)
    elif a.cmd == "change":
        m, seen = store_model(store), store.current()
        if a.what == "ship-mode":
            asked = m.orders.where(F.col("order_id") == F.lit(a.order)).select("order_id", F.lit(a.mode).alias("new_mode"))
            maintenance.commit_order_change(store, maintenance.touched_orders(m.orders, asked))
        elif a.what == "ship-date":
            maintenance.commit_order_change(store, maintenance.redated_order(m.orders, a.order, F.to_date(F.lit(a.date))))
        elif a.what == "raise":
            maintenance.commit_line_change(store, maintenance.increase_sales(m.order_items, Decimal(a.percent)))
        elif a.what == "add":
            maintenance.commit_line_update(store, maintenance.touched_line(m.order_items, int(a.row), Decimal(a.amount)))
        elif a.what == "rename-segment":
            store.write("customers", maintenance.rename_segment(m.customers, a.old, a.new), expected=seen)
        elif a.what == "erase":
            ids = spark.createDataFrame([(c,) for c in a.customer], "customer_id string")
            e = maintenance.erase_customers(m, ids.select(F.col("customer_id").cast(dict(m.customers.dtypes)["customer_id"])))
            store.write_all(
                {t: getattr(e, t) for t in ("order_items", "orders", "customer_profiles", "customers")},
                expected=seen,
            )
        if "sales_audit" in store.refresh()[1]:
            store.read("sales_audit").orderBy(F.desc("audit_id")).limit(5).show(truncate=False)  # O3
    elif a.cmd == "refresh":
        from martwell.plans.sql_surface import refresh_materialized

        print(refresh_materialized(store, a.names or None))
    elif a.cmd == "sql":
        from martwell.plans.sql_surface import register_sql

        register_sql(spark, store_model(store), store)
        spark.sql(a.statement).show(a.show, truncate=False)
    elif a.cmd == "tag":
        seen = store.current()
        rows = lookups.append_tag_rows(spark, store.read("product_tags"), [(a.product, a.tags)])
        store.write("product_tags", rows, expected=seen)
    elif a.cmd == "profile":
        seen = store.current()
        rows, bad = lookups.append_profile_rows(spark, store.read("customer_profiles"), [(a.customer, a.json)])
        if not bad.isEmpty():
            raise SystemExit("the profile is no JSON")
        store.write("customer_profiles", rows, expected=seen)
    elif a.cmd == "tables":
        sql_surface.inventory(store_model(store), store).orderBy("table_name").show(200, truncate=False)
    elif a.cmd == "preview":
        sql_surface.preview(store_model(store), store, a.table, a.n).show(a.n, truncate=False)
    elif a.cmd == "snapshot":
        print(storage.snapshot_store(store, a.to))
    elif a.cmd == "restore":
        storage.restore(spark, a.src, store, a.ts).show(truncate=False)
    if stop:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
