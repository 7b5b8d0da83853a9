"""A small feed in the retail layout (text ids, d/M/yyyy dates) loaded by the
command line, then reports, functions and changes on the loaded warehouse."""

from __future__ import annotations

import os
import tempfile

import pytest

from martwell.functions import routines
from martwell.sources.storage import TableStore

HEADER = (
    "Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,City,"
    "State,Postal Code,Region,Product ID,Category,Sub-Category,Product Name,Sales\n"
)
ROWS = [
    "1,CA-2016-152156,8/11/2016,11/11/2016,Second Class,CG-12520,Claire Gute,Consumer,United States,Henderson,Kentucky,42420,South,FUR-BO-10001798,Furniture,Bookcases,Bush Somerset Collection Bookcase,261.96",
    "2,CA-2016-152156,8/11/2016,11/11/2016,Second Class,CG-12520,Claire Gute,Consumer,United States,Henderson,Kentucky,42420,South,FUR-CH-10000454,Furniture,Chairs,\"Hon Deluxe Fabric Upholstered Stacking Chairs, Rounded Back\",731.94",
    "3,CA-2016-138688,12/6/2016,16/6/2016,Second Class,DV-13045,Darrin Van Huff,Corporate,United States,Los Angeles,California,90036,West,OFF-LA-10000240,Office Supplies,Labels,Self-Adhesive Address Labels,14.62",
    "4,US-2015-108966,11/10/2015,18/10/2015,Standard Class,SO-20335,Sean O'Donnell,Consumer,United States,Fort Lauderdale,Florida,33311,South,FUR-TA-10000577,Furniture,Tables,Bretford Rectangular Conference Table,957.5775",
    "5,US-2015-108966,11/10/2015,18/10/2015,Standard Class,SO-20335,Sean O'Donnell,Consumer,United States,Fort Lauderdale,Florida,33311,South,OFF-ST-10000760,Office Supplies,Storage,Eldon Fold 'N Roll Cart System,22.368",
    "6,CA-2014-115812,9/6/2014,14/6/2014,Standard Class,BH-11710,Brosina Hoffman,Consumer,United States,Los Angeles,California,90032,West,FUR-FU-10001487,Furniture,Furnishings,Eldon Expressions Wood and Plastic Desk Accessories,48.86",
    "7,CA-2016-161389,6/12/2016,11/12/2016,Standard Class,IM-15070,Irene Maddox,Consumer,United States,Seattle,Washington,98103,West,OFF-BI-10003656,Office Supplies,Binders,Fellowes PB200 Plastic Comb Binding Machine,407.976",
]


def test_retail_feed_end_to_end(spark, capsys):
    from martwell.__main__ import main
    from martwell.plans.warehouse import store_model
    from martwell.session import new_scratch_dir

    feed = tempfile.mkdtemp(prefix="mw-feed-")
    with open(os.path.join(feed, "part-0.csv"), "w", encoding="utf-8") as f:
        f.write(HEADER + "\n".join(ROWS) + "\n")
    root = new_scratch_dir(spark, "t-retail")
    main(["load", "--csv", feed, "--root", root], stop=False)
    store = TableStore(spark, root)
    m = store_model(store)
    assert m.orders.count() == 5 and m.order_items.count() == 7 and m.customers.count() == 5
    # amounts narrowed to 2 places, half away from zero
    assert {r.row_id: str(r.sales) for r in m.order_items.collect()}[4] == "957.58"

    main(["report", "top_products_of_month", "--month", "2016-11", "--n", "5", "--root", root], stop=False)
    main(["report", "customer_status", "--customer", "CG-12520", "XX-0", "--root", root], stop=False)
    out = capsys.readouterr().out
    assert "Hon Deluxe Fabric Upholstered Stacking Chairs, Rounded Back" in out
    # latest order 2016-12-06; CG-12520 ordered 2016-11-08 (28 days before)
    assert routines.STATUS_ACTIVE in out and routines.STATUS_NOT_FOUND in out

    from martwell.plans.sql_surface import register_sql

    register_sql(spark, m)
    got = spark.sql("SELECT fn_total_sales_by_region('South') AS s, fn_customer_order_count('CG-12520') AS n").first()
    assert str(got.s) == "1973.85" and got.n == 1

    main(["refresh", "--root", root], stop=False)
    main(["sql", "SELECT category, total_sales FROM mv_category_sales ORDER BY category", "--root", root], stop=False)
    main(["sql", "SELECT fn_get_customer_status('CG-12520') AS st", "--root", root], stop=False)
    out = capsys.readouterr().out
    assert "Furniture" in out and "Office Supplies" in out and routines.STATUS_ACTIVE in out
    assert "mv_category_sales" in TableStore(spark, root).list_tables()

    main(["change", "ship-date", "--order", "CA-2016-152156", "--date", "2010-01-01", "--root", root], stop=False)
    main(["change", "erase", "--customer", "SO-20335", "--root", root], stop=False)
    m2 = store_model(TableStore(spark, root))
    row = m2.orders.where("order_id = 'CA-2016-152156'").first()
    assert str(row.ship_date) == "2016-11-08"  # forced into the past, repaired to the order date
    assert m2.orders.where("customer_id = 'SO-20335'").count() == 0
    assert m2.order_items.count() == 5

    main(["tag", "--product", "P-NEW", "--tags", "office", "desk", "--root", root], stop=False)
    main(["profile", "--customer", "CG-12520", "--json", '{"membership": "gold"}', "--root", root], stop=False)
    with pytest.raises(SystemExit):
        main(["profile", "--customer", "CG-12520", "--json", "gold {", "--root", root], stop=False)
    main(["report", "tag_lookup", "--tag", "office", "--root", root], stop=False)
    main(["report", "profile_lookup", "--root", root], stop=False)
    main(["tables", "--root", root], stop=False)
    main(["preview", "v_sales_trend", "-n", "10", "--root", root], stop=False)
    out = capsys.readouterr().out
    assert "P-NEW" in out and "gold" in out and "v_delayed_shipments" in out and "2016-11" in out
