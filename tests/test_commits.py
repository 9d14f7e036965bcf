"""One commit record a run: crashes at any step, resumed runs, months, appends."""
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martflow.operators import manifest as MF
from martflow.plans import batch_job as BJ
from martflow.sinks import commits as CM
from martflow.sinks import jdbc as SJ
from martflow.sources import files as FS
from test_ingest import HEAD, _dims, write


class Crash(Exception):
    pass


def crash_in(monkeypatch, number, after=True):
    """The run dies in its step ``number`` (from 1): its write is done, its
    record is not (after=False: before the write). The steps are counted."""
    count = [0]
    run = CM.Steps.run

    def step(self, name, do):
        if name in self.done:
            return None
        count[0] += 1
        if count[0] == number:
            if after:
                do()
            raise Crash(name)
        return run(self, name, do)
    monkeypatch.setattr(CM.Steps, "run", step)
    return count


def marts(spark, layout):
    return (sorted((tuple(r) for r in BJ.customer_mart(spark, layout).collect()), key=str),
            sorted((tuple(r) for r in BJ.sales_mart(spark, layout).collect()), key=str))


def drops(root):
    first = f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n2,121,sugar,2024-02-03,2,50,1,50\n"
    second = f"{HEAD}\n1,121,sugar,2024-03-04,1,10,2,20\n1,121,sugar,bad,1,10,2,20\n2,121,oats,2024-04-01,2,7,1,7\n"
    return write(root, "d/a.csv", first), write(root, "d/b.csv", second)


def two_drops(spark, tmp_dir):
    """A store after its first run, the second drop, and the marts of a single run over both."""
    land, layout = os.path.join(tmp_dir, "land"), BJ.Layout(os.path.join(tmp_dir, "out"))
    a, b = drops(land)
    files = FS.list_files(spark, land)
    single = BJ.Layout(os.path.join(tmp_dir, "single"))
    BJ.run_files(spark, files, _dims(spark), single, "all")
    BJ.run_files(spark, files.where(F.col("file_name") == "a.csv"), _dims(spark), layout, "r0")
    return layout, files.where(F.col("file_name") == "b.csv"), marts(spark, single)


def finished(spark, layout, want):
    assert marts(spark, layout) == want
    assert BJ.ingested(spark, layout).count() == 4 and BJ.customer_detail(spark, layout).count() == 4
    assert MF.active(BJ.manifest(spark, layout)).count() == 0
    assert BJ.interrupted_runs(spark, layout) == []


def test_new_runs_after_crashes_count_nothing_twice(spark, tmp_dir, monkeypatch):
    """Each run is a new one over the same file and dies in a later step (the
    last leaves everything but its commit); none leaves a trace for readers."""
    layout, b, want = two_drops(spark, tmp_dir)
    before = marts(spark, layout)
    for number in (4, 10, 16):
        with monkeypatch.context() as m:
            crash_in(m, number)
            with pytest.raises(Crash):
                BJ.run_files(spark, b, _dims(spark), layout, f"r{number}")
        assert marts(spark, layout) == before
        assert BJ.ingested(spark, layout).count() == 2 and BJ.customer_detail(spark, layout).count() == 2
    BJ.run_files(spark, b, _dims(spark), layout, "last")
    finished(spark, layout, want)


def test_a_run_resumed_after_many_crashes(spark, tmp_dir, monkeypatch):
    """The run dies in every second of its 16 steps in turn, the write done and
    its record not, and is started again under its id."""
    layout, b, want = two_drops(spark, tmp_dir)
    died = []
    while True:
        with monkeypatch.context() as m:
            crash_in(m, 2 if not died else 3)  # what died before is done now, and one more
            try:
                BJ.run_files(spark, b, _dims(spark), layout, "r1")
                break
            except Crash as e:
                died.append(str(e))
    assert len(died) == len(set(died)) == 8 and died[-1] == "rejected"
    finished(spark, layout, want)


def test_a_run_that_dies_in_its_commit_settles_nothing(spark, tmp_dir, monkeypatch):
    land, layout = os.path.join(tmp_dir, "land"), BJ.Layout(os.path.join(tmp_dir, "out"))
    drops(land)
    with monkeypatch.context() as m:
        m.setattr(CM, "commit", lambda *a: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            BJ.run_folder(spark, land, _dims(spark), layout, "r1")
    assert MF.completed(MF.read_log(spark, layout.manifest)).count() == 2  # written, but not to hold
    assert MF.active(BJ.manifest(spark, layout)).count() == 2
    assert BJ.interrupted_runs(spark, layout) == ["r1"]
    assert marts(spark, layout) == ([], [])
    assert BJ.run_folder(spark, land, _dims(spark), layout, "r2")["files"] == 2
    assert sum(r[-1] for r in marts(spark, layout)[0]) == D("177.00")
    assert BJ.run_folder(spark, land, _dims(spark), layout, "r2")["files"] == 2  # committed: done
    assert sum(r[-1] for r in marts(spark, layout)[0]) == D("177.00")


def test_a_resumed_run_reads_no_file_again(spark, tmp_dir, monkeypatch):
    """Killed behind the enriched fact: it goes on under its id although the
    drop is gone; a run whose files another one took starts anew."""
    land, layout = os.path.join(tmp_dir, "land"), BJ.Layout(os.path.join(tmp_dir, "out"))
    a, b = drops(land)
    files = FS.list_files(spark, land).cache()
    files.count()
    with monkeypatch.context() as m:
        crash_in(m, 7, after=False)  # selection, quarantine, picked, typed, bad_rows, enriched are done
        with pytest.raises(Crash, match="customer_detail"):
            BJ.run_files(spark, files, _dims(spark), layout, "r1")
    os.rename(os.path.join(land, "d"), os.path.join(tmp_dir, "away"))
    assert BJ.interrupted_runs(spark, layout) == ["r1"]
    with monkeypatch.context() as m:
        m.setattr(BJ.C, "conform_typed", lambda *x: pytest.fail("files were parsed again"))
        assert BJ.run_files(spark, files, _dims(spark), layout, "r1")["files"] == 2
    assert sum(r[-1] for r in marts(spark, layout)[0]) == D("177.00")


def test_a_run_whose_files_were_taken_starts_anew(spark, tmp_dir, monkeypatch):
    land, layout = os.path.join(tmp_dir, "land"), BJ.Layout(os.path.join(tmp_dir, "out"))
    drops(land)
    with monkeypatch.context() as m:
        crash_in(m, 10)
        with pytest.raises(Crash):
            BJ.run_folder(spark, land, _dims(spark), layout, "r1")
    BJ.run_folder(spark, land, _dims(spark), layout, "r2")
    want = marts(spark, layout)
    assert BJ.interrupted_runs(spark, layout) == []
    assert BJ.run_folder(spark, land, _dims(spark), layout, "r1")["files"] == 0
    assert marts(spark, layout) == want and BJ.ingested(spark, layout).count() == 4


def test_only_the_months_of_a_run_are_written(spark, tmp_dir):
    land, layout = os.path.join(tmp_dir, "land"), BJ.Layout(os.path.join(tmp_dir, "out"))
    months = lambda root, run: {x for x in os.listdir(f"{root}/run_id={run}") if "=" in x}
    write(land, "d/a.csv", f"{HEAD}\n1,121,sugar,2024-01-03,1,50,2,100\n1,121,sugar,2024-02-03,1,50,1,50\n"
                           f"2,121,sugar,,2,5,1,5\n")
    BJ.run_folder(spark, land, _dims(spark), layout, "r1")
    write(land, "d/b.csv", f"{HEAD}\n1,121,sugar,2024-02-05,2,50,2,100\n")
    BJ.run_folder(spark, land, _dims(spark), layout, "r2")
    assert months(layout.sales_totals, "r1") == {"sales_month=2024-01", "sales_month=2024-02",
                                                 "sales_month=__HIVE_DEFAULT_PARTITION__"}
    for root, month in ((layout.sales_totals, "sales_month"), (layout.sales_mart, "sales_month"),
                        (layout.customer_totals, "sales_date_month"), (layout.customer_mart, "sales_date_month")):
        assert months(root, "r2") == {f"{month}=2024-02"}
    named = {(p.output, p.part): p.version for p in CM.parts(spark, layout.root, "r2")}
    assert named["sales_team_data_mart", "sales_month=2024-01"] == "r1"
    assert named["sales_team_data_mart", "sales_month=2024-02"] == "r2"
    single = BJ.Layout(os.path.join(tmp_dir, "single"))
    BJ.run_folder(spark, land, _dims(spark), single, "all")
    assert marts(spark, layout) == marts(spark, single)


def test_database_appends_happen_once(spark, tmp_dir, monkeypatch):
    """A replay adds nothing, a failed move leaves nothing, the next run delivers it."""
    land, layout = os.path.join(tmp_dir, "land"), BJ.Layout(os.path.join(tmp_dir, "out"))
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    target = SJ.JdbcTarget(f"jdbc:derby:{tmp_dir}/db;create=true", driver)
    write(land, "d/a.csv", f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n")
    rows = lambda: sorted((r["run_id"], r["total_sales"]) for r in spark.read.jdbc(
        target.url, target.sales_table, properties=driver).collect())
    with monkeypatch.context() as m:
        m.setattr(SJ, "append_run", lambda *a: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):  # committed, not delivered
            BJ.run_folder(spark, land, _dims(spark), layout, "r1", jdbc=target)
    assert SJ.delivered(spark, target) == set()
    write(land, "d/b.csv", f"{HEAD}\n2,121,sugar,2024-03-05,2,50,1,50\n")
    BJ.run_folder(spark, land, _dims(spark), layout, "r2", jdbc=target)
    assert rows() == [("r1", D("100.00")), ("r2", D("50.00"))]
    BJ.run_folder(spark, land, _dims(spark), layout, "r2", jdbc=target)
    mart = BJ.sales_mart(spark, layout)
    assert SJ.append_run(spark, {target.sales_table: mart}, target, "r2") is False
    # the second table is refused inside the transaction: the first one's rows go too
    short = mart.select("store_id")
    write_jdbc = SJ.write_jdbc
    with monkeypatch.context() as m:
        m.setattr(SJ, "write_jdbc", lambda df, url, table, *a: None if table == "GONE"
                  else write_jdbc(df, url, table, *a))
        with pytest.raises(Exception, match="GONE"):
            SJ.append_run(spark, {target.sales_table: mart, "GONE": short}, target, "r3")
    assert SJ.delivered(spark, target) == {"r1", "r2"} and len(rows()) == 2
    assert SJ.append_run(spark, {target.sales_table: mart}, target, "r3") is True
    assert len(rows()) == 4


def test_a_run_of_the_bucketed_table_leaves_the_others(spark, tmp_dir):
    from martflow.sinks.files import append_bucketed
    for run, n in (("r1", 5), ("it's", 7), ("r1", 3)):
        append_bucketed(spark, spark.range(n).selectExpr("id as customer_id", "'x' as v"), "runs_of_a_table",
                        f"{tmp_dir}/t", 4, "customer_id", run)
    table = spark.table("runs_of_a_table")
    assert {r["run_id"]: r["count"] for r in table.groupBy("run_id").count().collect()} == {"r1": 3, "it's": 7}
    assert table.columns == ["customer_id", "v", "run_id"]
    spark.sql("DROP TABLE runs_of_a_table")
