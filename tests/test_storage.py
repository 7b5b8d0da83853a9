"""Versioned store: all-or-nothing publish, preview, refresh."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martwell.session import new_scratch_dir
from martwell.sources.storage import TableStore


def test_versions_and_atomic_publish(spark):
    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    a1 = spark.range(3).withColumnRenamed("id", "a")
    b1 = spark.range(5).withColumnRenamed("id", "b")
    store.write_all({"a": a1, "b": b1})
    reader = TableStore(spark, store.root)
    assert reader.read("a").count() == 3
    # staged but not published: invisible
    store.stage("a", spark.range(100).withColumnRenamed("id", "a"))
    assert TableStore(spark, store.root).read("a").count() == 3
    store.write_all({"a": spark.range(7).withColumnRenamed("id", "a"), "b": spark.range(9).withColumnRenamed("id", "b")})
    fresh = TableStore(spark, store.root)
    assert (fresh.read("a").count(), fresh.read("b").count()) == (7, 9)
    # the older reader keeps its consistent snapshot until it refreshes
    assert reader.read("a").count() == 3
    reader.refresh()
    assert reader.read("a").count() == 7
    assert fresh.list_tables() == ["a", "b"]


def test_preview_bounds_and_unknown_name(spark):
    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    store.write("t", spark.range(5000))
    assert store.preview("t", 10).count() == 10
    for n in (5, 100000):
        with pytest.raises(ValueError):
            store.preview("t", n)
    with pytest.raises(KeyError):
        store.preview("t; drop table t", 10)


def test_refresh_view_is_stale_until_refreshed(spark):
    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    store.write("base", spark.range(10))
    total = lambda: store.read("base").agg(F.sum("id").alias("s"))
    store.refresh_view("mv", total())
    store.write("base", spark.range(20))
    assert store.read("mv").first().s == 45
    store.refresh_view("mv", total())
    assert store.read("mv").first().s == 190


def test_insert_select_appends(spark):
    from martwell.sources.ingest import insert_select

    path = new_scratch_dir(spark, "t-insert")
    src = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "row_id long, order_id string, junk string")
    insert_select(path, src, ["row_id", "order_id"])
    insert_select(path, src.where("row_id = 2"), ["row_id", "order_id"])
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a"), (2, "b"), (2, "b")]


def test_update_and_audit_commit_together(spark):
    from decimal import Decimal

    from martwell.operators import maintenance

    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    items = spark.createDataFrame(
        [(1, "o", "p", Decimal("1.00")), (2, "o", "p", Decimal("0.01"))], "row_id long, order_id string, product_id string, sales decimal(12,2)"
    )
    store.write("order_items", items)
    maintenance.commit_line_change(store, maintenance.increase_sales(store.read("order_items"), 10))
    maintenance.commit_line_change(store, maintenance.add_to_line(store.read("order_items"), 2, Decimal("5")))
    log = sorted((r.audit_id, r.row_id, r.old_sales, r.new_sales) for r in store.read("sales_audit").collect())
    assert log == [(1, 1, Decimal("1.00"), Decimal("1.10")), (2, 2, Decimal("0.01"), Decimal("5.01"))]
    assert sorted((r.row_id, r.sales) for r in store.read("order_items").collect()) == [
        (1, Decimal("1.10")), (2, Decimal("5.01"))
    ]
    # the audit log grew by appending a batch folder, not by rewriting
    assert len(store.current()["sales_audit"].split("|")) == 2


def test_branch_shares_files_and_isolates_changes(spark):
    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    store.write_all({"a": spark.range(3), "b": spark.range(4)})
    branch = store.clone(new_scratch_dir(spark, "t-branch"))
    assert branch.current() == store.current()  # same files, nothing copied
    branch.write("a", spark.range(10))
    assert (branch.read("a").count(), store.read("a").count()) == (10, 3)
    assert branch.current()["b"] == store.current()["b"]


def test_bucketed_version_reregisters_in_catalog(spark):
    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    df = spark.range(100).withColumnRenamed("id", "order_id")
    ref = store.stage_bucketed("orders", df, "order_id", 4)
    store.publish({"orders": ref})
    from martwell.sources.storage import _catalog_name

    table = _catalog_name(ref.split(":", 3)[3])
    spark.sql(f"DROP TABLE {table}")  # external table: files stay
    again = TableStore(spark, store.root).read("orders")
    assert again.count() == 100
    # grouping on the bucket key uses the buckets: no shuffle
    g = again.groupBy("order_id").count()
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = g._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    assert "Exchange" not in p and "Bucketed: true" in p


def test_same_sequence_race_has_one_winner(spark):
    """Two writers that both land in one sequence number: every reader sees the
    rows of the smaller token only."""
    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    store.write("a", spark.range(1))
    from martwell.sources.storage import MANIFEST_SCHEMA

    for token, n in (("b" * 32, 5), ("a" * 32, 7)):
        path = store.stage("a", spark.range(n))
        spark.createDataFrame([("a", path, token)], MANIFEST_SCHEMA).write.mode("append").json(f"{store.root}/_manifest/seq=2")
    reader = TableStore(spark, store.root)
    assert reader.read("a").count() == 7
    # the next publish goes on top of the winner
    reader.write("b", spark.range(2))
    again = TableStore(spark, store.root)
    assert (again.read("a").count(), again.read("b").count()) == (7, 2)


def test_new_version_keeps_bucketing(spark):
    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    df = spark.range(50).withColumnRenamed("id", "order_id")
    store.publish({"orders": store.stage_bucketed("orders", df, "order_id", 4)})
    store.write("orders", df.where("order_id < 10"))
    assert store.current()["orders"].startswith("bucketed:4:order_id:")
    assert store.read("orders").count() == 10


def test_cli_round_trip(spark, capsys):
    from martwell.__main__ import main

    root = new_scratch_dir(spark, "t-cli")
    main(["build", "--source", "/root/testdata/sf0.001", "--root", root], stop=False)
    main(["change", "raise", "--percent", "5", "--root", root], stop=False)
    main(["report", "kpi_summary", "--root", root], stop=False)
    main(["change", "erase", "--customer", "1", "2", "--root", root], stop=False)
    main(["tables", "--root", root], stop=False)
    out = capsys.readouterr().out
    assert "total_revenue" in out and "sales_audit" in out
    st = TableStore(spark, root)
    assert st.read("customers").where("customer_id in (1, 2)").count() == 0
    assert st.current()["order_items"].startswith("bucketed:")
    backups, restored = new_scratch_dir(spark, "t-cli-bk"), new_scratch_dir(spark, "t-cli-rs")
    main(["snapshot", "--root", root, "--to", backups], stop=False)
    main(["restore", "--from", backups, "--root", restored], stop=False)
    again = TableStore(spark, restored)
    assert sorted(again.list_tables()) == sorted(st.list_tables())
    assert again.current()["order_items"].startswith("bucketed:")
    assert "false" not in capsys.readouterr().out


def test_materialized_results_stale_until_refresh(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from martwell.operators import maintenance
    from martwell.plans.sql_surface import refresh_materialized, register_sql
    from martwell.plans.warehouse import build_warehouse, store_model
    from martwell.sources.testdata import bind_model

    store = build_warehouse(spark, bind_model(spark, "/root/testdata/sf0.001"), new_scratch_dir(spark, "t-mv"))
    refresh_materialized(store)
    total = lambda: spark.sql("SELECT SUM(total_sales) AS s FROM mv_category_sales").first().s
    register_sql(spark, store_model(store), store)
    before = total()
    maintenance.commit_line_change(store, maintenance.increase_sales(store.read("order_items"), Decimal("10")))
    register_sql(spark, store_model(store), store)
    assert total() == before  # stored result: stale
    refresh_materialized(store)
    register_sql(spark, store_model(store), store)
    raised = store.read("order_items").agg(F.sum("sales")).first()[0]
    assert total() == raised


def test_commit_on_top_of_ours_is_not_overwritten(spark):
    """Writer A commits; writer B commits on top of it; A's confirmation must
    look at its own sequence and not re-publish over B."""
    a = TableStore(spark, new_scratch_dir(spark, "t-store"))
    a.write("t", spark.range(1))
    b = TableStore(spark, a.root)
    pa = a.stage("t", spark.range(2))
    seq_a = a.publish({"t": pa})
    b.refresh()
    b.write("t", spark.range(3))
    assert a._winner_of(seq_a) is not None
    assert TableStore(spark, a.root).read("t").count() == 3


def test_restore_keeps_bucket_layout(spark):
    from martwell.sources.storage import restore, snapshot_store

    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    df = spark.range(40).withColumnRenamed("id", "order_id")
    store.publish({"orders": store.stage_bucketed("orders", df, "order_id", 4), "plain": store.stage("plain", df)})
    root = new_scratch_dir(spark, "t-snap")
    snapshot_store(store, root)
    target = TableStore(spark, new_scratch_dir(spark, "t-restored"))
    assert all(r.restored_equal for r in restore(spark, root, target).collect())
    assert target.current()["orders"].startswith("bucketed:4:order_id:")
    assert not target.current()["plain"].startswith("bucketed:")


def test_strict_year_partitions_refuse_rows_outside(spark):
    from datetime import date

    from martwell.operators.quality import ConstraintViolation
    from martwell.sources.storage import read_years, write_year_partitioned

    bounds = [("2015", date(2015, 1, 1), date(2016, 1, 1)), ("2016", date(2016, 1, 1), date(2017, 1, 1))]
    ok = spark.createDataFrame([("a", date(2015, 3, 1)), ("b", date(2016, 12, 31))], "order_id string, order_date date")
    bad = ok.unionByName(spark.createDataFrame([("c", date(2017, 1, 1))], "order_id string, order_date date"))
    with pytest.raises(ConstraintViolation):
        write_year_partitioned(bad, new_scratch_dir(spark, "t-years"), bounds, strict=True)
    path, outside = write_year_partitioned(ok, new_scratch_dir(spark, "t-years"), bounds, strict=True)
    assert outside.count() == 0
    assert sorted((r.order_id, r.order_year) for r in read_years(spark, path).collect()) == [("a", 2015), ("b", 2016)]


def test_cli_report_names_match_reports():
    import argparse

    from martwell.__main__ import REPORT_NAMES, _reports

    names = set(_reports(None, None, argparse.Namespace(customer=[])).keys())
    assert names == set(REPORT_NAMES)


def test_second_writer_conflicts_and_loses_nothing(spark):
    """Two handles raise different lines; the second one must compute anew."""
    from martwell.operators.maintenance import add_to_line, commit_line_change
    from martwell.sources.storage import Conflict

    lines = "SELECT id AS row_id, id AS order_id, id AS product_id, CAST(10 AS DECIMAL(12,2)) AS sales FROM range(1, 9)"
    a = TableStore(spark, new_scratch_dir(spark, "t-store"))
    a.write("order_items", spark.sql(lines))
    b = TableStore(spark, a.root)
    b.current()
    commit_line_change(a, add_to_line(a.read("order_items"), 1, 5))
    with pytest.raises(Conflict):
        commit_line_change(b, add_to_line(b.read("order_items"), 2, 7))
    b.refresh()
    commit_line_change(b, add_to_line(b.read("order_items"), 2, 7))
    now = {r.row_id: int(r.sales) for r in b.read("order_items").collect()}
    assert (now[1], now[2], now[3]) == (15, 17, 10)
    assert sorted(r.audit_id for r in b.read("sales_audit").collect()) == [1, 2]


def test_new_checkpoint_logs_its_own_changes(spark):
    """A stream with a new checkpoint starts at epoch 0 again; nothing is skipped."""
    from martwell.streaming.triggers import run_audit_log_stream

    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    for row_id in (1, 2):
        source = new_scratch_dir(spark, "t-changes")
        spark.sql(
            f"SELECT CAST({row_id} AS BIGINT) AS row_id, CAST(1 AS DECIMAL(12,2)) AS old_sales, "
            "CAST(2 AS DECIMAL(12,2)) AS sales"
        ).write.parquet(source)
        checkpoint = new_scratch_dir(spark, "t-ckpt")
        for _ in range(2):  # a restart with the same checkpoint adds nothing
            run_audit_log_stream(spark, source, store, checkpoint)
    assert sorted(r.row_id for r in store.read("sales_audit").collect()) == [1, 2]


def test_fiscal_year_ranges_read_by_their_bounds(spark):
    from datetime import date

    from martwell.sources.storage import read_date_range, write_year_partitioned

    bounds = [("2016", date(2015, 10, 1), date(2016, 10, 1))]
    rows = spark.createDataFrame([("a", date(2015, 11, 3))], "order_id string, order_date date")
    path, _ = write_year_partitioned(rows, new_scratch_dir(spark, "t-years"), bounds)
    assert read_date_range(spark, path, date(2015, 11, 1), date(2015, 12, 31), bounds).count() == 1


def test_cli_runs_every_report(spark, capsys):
    from martwell.__main__ import REPORT_NAMES, main

    root = new_scratch_dir(spark, "t-reports")
    main(["build", "--source", "/root/testdata/sf0.001", "--root", root], stop=False)
    for name in REPORT_NAMES:
        capsys.readouterr()
        main(["report", name, "--root", root, "--customer", "1", "--order", "1", "--show", "2"], stop=False)
        assert "+--" in capsys.readouterr().out, name


def test_write_from_an_older_snapshot_conflicts(spark):
    from martwell.sources.storage import Conflict

    a = TableStore(spark, new_scratch_dir(spark, "t-store"))
    a.write_all({"t": spark.range(3), "u": spark.range(3)})
    b = TableStore(spark, a.root)
    rows = b.read("t").where("id < 2")
    a.write("t", spark.range(9))
    for _ in range(2):  # a second try without a refresh is as stale
        with pytest.raises(Conflict):
            b.write("t", rows)
        with pytest.raises(Conflict):
            b.write_all({"u": b.read("u"), "t": rows})
    assert TableStore(spark, a.root).read("t").count() == 9
    b.refresh()
    b.write("t", b.read("t").where("id < 2"))
    assert TableStore(spark, a.root).read("t").count() == 2


def test_cli_change_does_not_overwrite_another_writer(spark, monkeypatch):
    from martwell import __main__ as cli
    from martwell.operators import lookups
    from martwell.sources.storage import Conflict

    root = new_scratch_dir(spark, "t-cli-race")
    cli.main(["build", "--source", "/root/testdata/sf0.001", "--root", root], stop=False)
    n = TableStore(spark, root).read("product_tags").count()
    append = lookups.append_tag_rows

    def slow(spark, tags, rows):
        other = TableStore(spark, root)
        other.write("product_tags", append(spark, other.read("product_tags"), [("1", ["theirs"])]))
        return append(spark, tags, rows)

    monkeypatch.setattr(lookups, "append_tag_rows", slow)
    with pytest.raises(Conflict):
        cli.main(["tag", "--product", "1", "--tags", "ours", "--root", root], stop=False)
    assert TableStore(spark, root).read("product_tags").count() == n + 1


def test_a_taken_number_never_changes(spark):
    """A later writer in the same number, whatever its token, undoes nothing."""
    store = TableStore(spark, new_scratch_dir(spark, "t-store"))
    seq = store.publish({"t": store.stage("t", spark.range(4))})
    late = TableStore(spark, store.root)
    path = late.stage("t", spark.range(7))
    fs = spark._jvm.org.apache.hadoop.fs.Path(store.root).getFileSystem(spark._jsc.hadoopConfiguration())
    for _ in range(4):
        assert not late._take(seq, {"t": path})
        # as a writer that saw the number free just before
        staged = spark.createDataFrame([("t", path, "0" * 32)], "table_name string, path string, writer string")
        hidden = f"{store.root}/_manifest/_new-{new_scratch_dir(spark, 'x').rsplit('/', 1)[-1]}"
        staged.write.json(hidden)
        to = spark._jvm.org.apache.hadoop.fs.Path
        fs.rename(to(hidden), to(f"{store.root}/_manifest/seq={seq}"))
        assert TableStore(spark, store.root).read("t").count() == 4
