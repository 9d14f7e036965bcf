"""Drop ingestion edge cases (header drift, quarantine, bad values, reruns)."""
import os
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martflow.operators import conform as C
from martflow.operators import manifest as MF
from martflow.operators import validate as V
from martflow.plans import batch_job as BJ
from martflow.sources import files as FS
from martflow.contracts import CUSTOMER, SALES_TEAM, STORE

HEAD = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def write(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def fixture_drop(root):
    d = os.path.join(root, "drop1")
    write(d, "plain.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n")
    write(d, "extra.csv", f"{HEAD},channel,coupon\n1,121,maida,2024-03-04,1,20,1,20,web,\n"
                          f"2,121,maida,2024-03-05,2,20,3,60,,\n")
    write(d, "reordered.csv", "total_cost,quantity,price,sales_person_id,sales_date,product_name,"
                              "store_id,customer_id\n30,3,10,2,2024-04-01,besan,121,2\n")
    write(d, "missing.csv", "customer_id,store_id,product_name,sales_date,sales_person_id,"
                            "quantity,total_cost\n1,121,sugar,2024-03-03,1,2,100\n")
    write(d, "case.csv", HEAD.replace("customer_id", "Customer_ID") +
          "\n2,121,oats,2024-05-01,1,212,1,212\n")
    write(d, "bad_values.csv", f"{HEAD}\n1,121,sugar,2024-13-40,1,50,1,50\n"
                               f"1,121,sugar,2024-06-01,1,50,1,50\n")
    write(d, "note.txt", "not a csv\n")
    return d


def _conformed(spark, root):
    listing = V.split_by_extension(FS.list_files(spark, root))
    checked = (V.check_headers(FS.read_headers(listing.where("accepted")))
               .join(listing.select("path", "drop", "file_name"), "path"))
    return listing, checked


def test_headers_and_quarantine(spark, tmp_dir):
    root = fixture_drop(tmp_dir)
    listing, checked = _conformed(spark, root)
    by_name = {r["file_name"]: r for r in checked.collect()}
    assert list(by_name["missing.csv"]["missing"]) == ["price"]
    assert by_name["case.csv"]["valid"]
    assert list(by_name["extra.csv"]["extras"]) == ["channel", "coupon"]
    report = {os.path.basename(r["path"]): r["reason"]
              for r in V.quarantine_report(listing, checked).collect()}
    assert report == {"note.txt": "extension", "missing.csv": "missing columns"}


def test_folding_reordering_and_bad_values(spark, tmp_dir):
    root = fixture_drop(tmp_dir)
    _, checked = _conformed(spark, root)
    good, bad = C.conform(spark, checked)
    rows = good.withColumn("f", F.regexp_extract("source_file", r"([^/]+)$", 1)).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r["f"], []).append(r)
    assert by_file["plain.csv"][0]["additional_column"] is None
    extras = sorted(r["additional_column"] for r in by_file["extra.csv"])
    assert extras == ["", "web"]
    (re,) = by_file["reordered.csv"]
    assert (re["customer_id"], re["price"], re["total_cost"]) == (2, D("10.00"), D("30.00"))
    assert re["sales_date"] == date(2024, 4, 1)
    assert len(by_file["case.csv"]) == 1
    assert len(by_file["bad_values.csv"]) == 1
    (b,) = bad.collect()
    assert list(b["bad_columns"]) == ["sales_date"] and b["sales_date"] == "2024-13-40"


def _dims(spark):
    c = spark.createDataFrame([(1, "A", "B", "x", "1", "9", None), (2, "C", "D", "y", "2", "8", None)],
                              CUSTOMER)
    s = spark.createDataFrame([(121, "x", "1", "M", None, None)], STORE)
    t = spark.createDataFrame([(1, "S", "L", 1, "Y", "x", "1", None),
                               (2, "K", "P", 1, "N", "x", "1", None)], SALES_TEAM)
    return BJ.Dimensions(c, s, t)


def test_rerun_adds_nothing_and_exact_names(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    write(os.path.join(land, "d"), "a.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n")
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    first = BJ.run_folder(spark, land, _dims(spark), layout, "r1")
    assert first["files"] == 1
    # a file whose name ends like the first one is a different file
    write(os.path.join(land, "d"), "data.csv", f"{HEAD}\n2,121,sugar,2024-03-04,2,50,1,50\n")
    second = BJ.run_folder(spark, land, _dims(spark), layout, "r2")
    assert second["files"] == 1
    third = BJ.run_folder(spark, land, _dims(spark), layout, "r3")
    assert third["files"] == 0
    assert BJ.ingested(spark, layout).count() == 2
    log = MF.read_log(spark, layout.manifest)
    assert MF.active(log).count() == 0 and MF.completed(log).count() == 2


def test_failure_before_commit_leaves_files_active(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    write(os.path.join(land, "d"), "a.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n")
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    broken = BJ.Dimensions(_dims(spark).customer.drop("first_name"), _dims(spark).store,
                           _dims(spark).team)
    with pytest.raises(Exception):
        BJ.run_folder(spark, land, broken, layout, "r1")
    log = MF.read_log(spark, layout.manifest)
    assert [r["status"] for r in MF.latest(log).collect()] == ["A"]
    assert BJ.run_folder(spark, land, _dims(spark), layout, "r2")["files"] == 1
    assert MF.active(MF.read_log(spark, layout.manifest)).count() == 0


def test_empty_or_csv_free_drop_fails_fast(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(os.path.join(land, "d"))
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    with pytest.raises(BJ.NoInputError):
        BJ.run_folder(spark, land, _dims(spark), layout, "r1")
    write(os.path.join(land, "d"), "note.txt", "x\n")
    with pytest.raises(BJ.NoInputError):
        BJ.run_folder(spark, land, _dims(spark), layout, "r1")


def test_quarantined_lines_are_kept_with_reason(spark, tmp_dir):
    root = fixture_drop(tmp_dir)
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    BJ.run_folder(spark, root, _dims(spark), layout, "r1")
    lines = spark.read.parquet(layout.quarantine + "/run_id=r1/lines")
    reasons = {(os.path.basename(r["path"]), r["reason"]) for r in lines.collect()}
    assert reasons == {("note.txt", "extension"), ("missing.csv", "missing columns")}


def test_read_dim_conforms_by_name(spark, tmp_dir):
    from martflow.sources.dims import read_dim
    path = os.path.join(tmp_dir, "store")
    spark.createDataFrame([(7, "Mgr", "x")], "ID int, store_manager_name string, junk string") \
        .write.parquet(path)
    (r,) = read_dim(spark, path, STORE).collect()
    assert r["id"] == 7 and r["store_manager_name"] == "Mgr" and r["reviews"] is None


def test_header_reader_ships_by_value():
    """Executors must not need this package installed to read headers."""
    from pyspark import cloudpickle
    assert FS.__name__ in cloudpickle.cloudpickle._PICKLE_BY_VALUE_MODULES


def test_replayed_run_overwrites_instead_of_duplicating(spark, tmp_dir):
    """A run (or stream batch) that died after staging rows but before its
    commit is replayed under the same run id: its outputs are rewritten, and
    what it had rejected is still quarantined."""
    land = os.path.join(tmp_dir, "landing")
    write(os.path.join(land, "d"), "a.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n"
                                            f"2,121,sugar,2024-03-04,2,50,1,50\n")
    write(os.path.join(land, "d"), "note.txt", "two\nlines\n")
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    broken = BJ.Dimensions(_dims(spark).customer.drop("first_name"), _dims(spark).store,
                           _dims(spark).team)
    run = "batch-000000000007"

    def quarantined():
        return spark.read.parquet(f"{layout.quarantine}/run_id={run}/lines").count()
    with pytest.raises(Exception):
        BJ.run_folder(spark, land, broken, layout, run)
    assert spark.read.parquet(layout.typed).count() == 2      # staged before the failure
    with pytest.raises(ValueError):
        BJ.ingested(spark, layout)                             # but not recorded
    assert quarantined() == 2
    for _ in range(2):
        BJ.run_folder(spark, land, _dims(spark), layout, run)
        assert BJ.ingested(spark, layout).count() == 2         # rewritten, not appended
        assert quarantined() == 2
    from martflow.sinks.files import latest_run
    assert latest_run(spark, layout.customer_mart).count() == 2
    assert spark.table(layout.bucketed_table).count() == 2
    assert latest_run(spark, layout.sales_totals).agg(F.sum("total_sales")).first()[0] == D("150.00")


def test_marts_hold_all_runs_and_pay_one_incentive_a_month(spark, tmp_dir):
    from martflow.sinks.files import latest_run
    land = os.path.join(tmp_dir, "landing")
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    write(os.path.join(land, "d"), "a.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n")
    BJ.run_folder(spark, land, _dims(spark), layout, "r1")
    write(os.path.join(land, "d"), "b.csv", f"{HEAD}\n1,121,sugar,2024-03-05,2,50,1,50\n")
    BJ.run_folder(spark, land, _dims(spark), layout, "r2")
    rows = {r["sales_person_id"]: (r["total_sales"], r["incentive"])
            for r in latest_run(spark, layout.sales_mart).collect()}
    assert rows == {1: (D("100.00"), D("1.00")), 2: (D("50.00"), D("0.00"))}
    (c,) = latest_run(spark, layout.customer_mart).collect()
    assert c["total_sales"] == D("150.00")


def test_names_that_need_quoting(spark, tmp_dir):
    land = os.path.join(tmp_dir, "land ing")
    names = ["a b.csv", "c#d.csv", "e[1].csv", "f%20g+h.csv", "i{j}*k?.csv", "plain.csv"]
    for i, name in enumerate(names):
        write(os.path.join(land, "d [x]") if i else land, name, f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n")
    write(land, "no#te [1].txt", "one line\n")
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    out = BJ.run_folder(spark, land, _dims(spark), layout, "r1")
    assert (out["files"], out["rejected"]) == (len(names), 1)
    got = {os.path.basename(r["source_file"]) for r in BJ.ingested(spark, layout).collect()}
    assert got == set(names)
    lines = spark.read.parquet(layout.quarantine + "/run_id=r1/lines").collect()
    assert [os.path.basename(r["path"]) for r in lines] == ["no#te [1].txt"]
    assert BJ.run_folder(spark, land, _dims(spark), layout, "r2")["files"] == 0


def test_extra_columns_may_have_any_name(spark, tmp_dir):
    extras = "source_file,corrupt_line,_corrupt_record,c0,a`b,drop,is_bad"
    write(tmp_dir, "d/a.csv", f"{HEAD},{extras}\n1,121,sugar,2024-03-03,1,50,2,100,S,C,R,Z,T,D,B\n")
    _, checked = _conformed(spark, tmp_dir)
    good, bad = C.conform(spark, checked)
    (r,) = good.collect()
    assert r["additional_column"] == ", ".join("RTZCDBS") and r["source_file"].endswith("a.csv")
    assert bad.count() == 0


def test_money_that_would_be_rounded_is_a_bad_row(spark, tmp_dir):
    write(tmp_dir, "d/a.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,12.345,2,100\n"
                              f"1,121,sugar,2024-03-03,1,12.340,2,100\n")
    _, checked = _conformed(spark, tmp_dir)
    good, bad = C.conform(spark, checked)
    assert [r["price"] for r in good.collect()] == [D("12.34")]
    assert [list(r["bad_columns"]) for r in bad.collect()] == [["price"]]


def test_a_first_line_without_end_is_quarantined(spark, tmp_dir, monkeypatch):
    write(tmp_dir, "d/a.csv", "x" * (FS.MAX_HEADER_BYTES + 10))
    write(tmp_dir, "d/b.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n")
    listing, checked = _conformed(spark, tmp_dir)
    report = V.quarantine_report(listing, checked).collect()
    assert [(os.path.basename(r["path"]), r["reason"]) for r in report] == [("a.csv", "no header")]
    assert checked.where("valid").count() == 1


def test_no_valid_file_is_an_error(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    write(os.path.join(land, "d"), "a.csv", "customer_id\n1\n")
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    with pytest.raises(BJ.NoInputError, match="no valid file"):
        BJ.run_folder(spark, land, _dims(spark), layout, "r1")
    assert [r["status"] for r in MF.latest(MF.read_log(spark, layout.manifest)).collect()] == ["Q"]


def test_price_check_and_database_append(spark, tmp_dir):
    """The run's marts in embedded Derby (a database only this process sees)."""
    from martflow.contracts import PRODUCT
    from martflow.sinks.files import latest_run
    from martflow.sinks.jdbc import JdbcTarget
    from martflow.sources.dims import read_dim
    land = os.path.join(tmp_dir, "landing")
    write(os.path.join(land, "d"), "a.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n"
                                            f"1,121,sugar,2024-03-03,1,40,2,80\n"
                                            f"1,121,oats,2024-03-03,1,40,2,80\n")
    product = spark.createDataFrame([(1, "sugar", D("50.00"), None, None, None, None),
                                     (2, "sugar", D("55.00"), None, None, None, None)], PRODUCT)
    d = _dims(spark)
    dims = BJ.Dimensions(d.customer, d.store, d.team, product)
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    url = f"jdbc:derby:{tmp_dir}/db;create=true"
    target = JdbcTarget(url, driver)
    BJ.run_folder(spark, land, dims, layout, "r1", jdbc=target)
    write(os.path.join(land, "d"), "b.csv", f"{HEAD}\n2,121,sugar,2024-03-05,2,50,1,50\n")
    BJ.run_folder(spark, land, dims, layout, "r2", jdbc=target)
    checks = {r["product_name"]: (r["rows"], r["off_list"])
              for r in spark.read.parquet(layout.price_check + "/run_id=r1").collect()}
    assert checks == {"sugar": (2, 1), "oats": (1, 1)}
    sales = spark.read.jdbc(url, target.sales_table, properties=driver)
    assert {(r["run_id"], r["sales_person_id"], r["total_sales"]) for r in sales.collect()} == {
        ("r1", 1, D("260.00")), ("r2", 2, D("50.00"))}
    assert latest_run(spark, layout.sales_mart).count() == 2
    spark.createDataFrame([(i, f"m{i}") for i in range(40)], "id int, store_manager_name string") \
        .write.jdbc(url, "STORES", properties=driver)
    stores = read_dim(spark, url, STORE, driver, "STORES", '"id"', 4)
    assert stores.count() == 40 and stores.rdd.getNumPartitions() == 4


def test_preview_shows_as_many_rows_as_asked(spark, tmp_dir, capsys):
    land = os.path.join(tmp_dir, "landing")
    write(os.path.join(land, "d"), "a.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n"
                                            f"2,121,oats,2024-03-04,2,50,1,50\n")
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    BJ.run_folder(spark, land, _dims(spark), layout, "r1", preview=1)
    shown = capsys.readouterr().out
    assert shown.count("|121 ") == 1 and "only showing top 1 row" in shown


def test_empty_relations_have_their_types(spark):
    from martflow.contracts import MANIFEST, SALES_FACT, empty
    for contract in (MANIFEST, SALES_FACT):
        e = empty(spark, contract)
        assert e.schema == contract and e.count() == 0


def test_a_broken_manifest_is_not_an_empty_one(spark, tmp_dir):
    write(tmp_dir, "log/part-0.parquet", "this is no parquet file")
    with pytest.raises(Exception):
        MF.read_log(spark, os.path.join(tmp_dir, "log")).count()
    assert MF.read_log(spark, os.path.join(tmp_dir, "none")).count() == 0


def test_run_writes_detail_marts_in_their_layouts(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    write(os.path.join(land, "d"), "a.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n"
                                            f"2,121,oats,2024-04-04,2,50,1,50\n")
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    BJ.run_folder(spark, land, _dims(spark), layout, "r1")
    detail = spark.table(layout.bucketed_table)
    grouped = detail.groupBy("customer_id").count()
    assert grouped.count() == 2
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    sales = spark.read.parquet(layout.sales_detail + "/run_id=r1")
    assert sorted(r["sales_month"] for r in sales.collect()) == ["2024-03", "2024-04"]
    assert {"store_id", "sales_person_first_name", "store_manager_name"} <= set(sales.columns)


def test_wide_header_is_read_whole(tmp_dir):
    cols = [f"c{i:05d}" for i in range(20000)]          # ~130 KB header line
    path = write(tmp_dir, "wide.csv", ",".join(cols) + "\r\n" + ",".join("1" * 1) + "\n")
    line = FS.first_line("file:" + path)
    assert FS.parse_header(line) == cols


def test_quarantined_files_are_settled(spark, tmp_dir):
    root = fixture_drop(tmp_dir)
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    assert BJ.run_folder(spark, root, _dims(spark), layout, "r1")["files"] == 5
    log = MF.read_log(spark, layout.manifest)
    states = {os.path.basename(r["file_name"]): r["status"] for r in MF.latest(log).collect()}
    assert states["note.txt"] == "Q" and states["missing.csv"] == "Q"
    assert states["plain.csv"] == "I"
    assert BJ.run_folder(spark, root, _dims(spark), layout, "r2")["files"] == 0
    assert spark.read.parquet(layout.quarantine + "/run_id=r2/report").count() == 0


def test_command_line_job(spark, tmp_dir):
    from martflow.__main__ import main
    from martflow.sources import testbed as tb
    from martflow.sources.tables import Tables
    from conftest import SMALL
    t = Tables.open(spark, SMALL)
    dims = {}
    for name, df in (("customer", tb.customer_dim(t)), ("store", tb.store_dim(t)),
                     ("team", tb.sales_team_dim(t))):
        dims[name] = os.path.join(tmp_dir, name)
        df.write.parquet(dims[name])
    land = os.path.join(tmp_dir, "landing")
    write(os.path.join(land, "d"), "a.csv", f"{HEAD}\n1,0,sugar,2024-03-03,1,50,2,100\n")
    out = os.path.join(tmp_dir, "out")
    res = main(["--landing", land, "--out", out, "--customer", dims["customer"],
                "--store", dims["store"], "--team", dims["team"], "--run-id", "cli-1"])
    assert res["files"] == 1
    from martflow.sinks.files import latest_run
    (row,) = latest_run(spark, out + "/sales_team_data_mart").collect()
    assert row["total_sales"] == D("100.00") and row["incentive"] == D("1.00")


def test_stream_picks_up_only_new_files(spark, tmp_dir):
    from martflow.streaming.ingest import start_ingest
    land = os.path.join(tmp_dir, "landing")
    write(os.path.join(land, "d"), "a.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n")
    layout = BJ.Layout(os.path.join(tmp_dir, "out"))
    ckpt = os.path.join(tmp_dir, "ckpt")
    archive = os.path.join(tmp_dir, "archive")

    def start():
        start_ingest(spark, land, _dims(spark), layout, ckpt, archive_dir=archive,
                     max_files_per_trigger=1).awaitTermination()
    start()
    assert BJ.ingested(spark, layout).count() == 1
    write(land, "b.csv", f"{HEAD}\n2,121,oats,2024-03-05,2,50,3,150\n"     # no folder of its own
                         f"1,121,oats,2024-03-06,1,50,1,50\n")
    write(os.path.join(land, "d", "e"), "c.csv", f"{HEAD}\n2,121,oats,2024-03-05,2,50,3,150\n")
    start()
    assert BJ.ingested(spark, layout).count() == 4
    from martflow.sinks.files import committed_runs, latest_run
    assert committed_runs(spark, layout.typed).count() == 3     # one run per micro-batch
    rows = {r["sales_person_id"]: (r["total_sales"], r["incentive"])
            for r in latest_run(spark, layout.sales_mart).collect()}
    assert rows == {1: (D("150.00"), D("0.00")), 2: (D("300.00"), D("3.00"))}
    start()
    assert BJ.ingested(spark, layout).count() == 4               # nothing new, nothing added
    moved = [f for _, _, names in os.walk(archive) for f in names if f.endswith(".csv")]
    assert "a.csv" in moved and not os.path.exists(os.path.join(land, "d", "a.csv"))
