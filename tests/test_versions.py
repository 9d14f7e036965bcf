"""Mirrored drops: copies, replacements, withdrawals, dead syncs; contents."""
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martflow.operators import marts as M
from martflow.operators import validate as V
from martflow.operators import versions as VS
from martflow.plans import mirror as MI
from martflow.sinks import commits as CM
from martflow.sources import files as FS
from test_ingest import HEAD, _dims, write

A = f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,100\n2,121,sugar,2024-02-03,2,50,1,50\n"
A2 = f"{HEAD}\n1,121,sugar,2024-03-03,1,50,2,70\n"
B = f"{HEAD}\n1,121,sugar,2024-03-04,1,10,2,20\n1,121,sugar,bad,1,10,2,20\n2,121,oats,2024-04-01,2,7,1,7\n"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def state(spark, store):
    return (rows(MI.totals(spark, store, MI.CUSTOMER)), rows(MI.totals(spark, store, MI.SALES)),
            rows(MI.facts(spark, store).drop("version")))


def sync(spark, land, store, run):
    return MI.sync(spark, FS.list_files(spark, land), _dims(spark), store, run)


def afresh(spark, land, tmp_dir, run):
    store = os.path.join(tmp_dir, f"afresh-{run}")
    sync(spark, land, store, "one")
    return state(spark, store)


def test_copy_replacement_withdrawal(spark, tmp_dir):
    land, store = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "store")
    write(land, "d/a.csv", A)
    write(land, "d/b.csv", B)
    assert sync(spark, land, store, "r1") == {"run_id": "r1", "came": 2, "went": 0, "kept": 0}
    first = state(spark, store)
    assert [r[2] for r in first[0]] == [120, 50, 7]

    # a copy under another name, its lines in another order, counts once
    lines = A.splitlines()
    write(land, "d/copy.csv", "\n".join([lines[0], *reversed(lines[1:])]) + "\n")
    assert sync(spark, land, store, "r2")["came"] == 0
    assert state(spark, store) == first

    # the first file goes, its copy holds the content
    os.remove(os.path.join(land, "d/a.csv"))
    assert sync(spark, land, store, "r3") == {"run_id": "r3", "came": 0, "went": 0, "kept": 2}
    assert state(spark, store) == first

    # the copy is replaced under its name: the old rows go, the new ones come
    write(land, "d/copy.csv", A2)
    assert sync(spark, land, store, "r4") == {"run_id": "r4", "came": 1, "went": 1, "kept": 1}
    got = state(spark, store)
    assert got == afresh(spark, land, tmp_dir, "r4") and got != first
    assert "2024-02" not in {r[1] for r in got[0]}  # that month lost its last row

    # withdrawn, and back with what it held at first
    os.remove(os.path.join(land, "d/b.csv"))
    assert sync(spark, land, store, "r5")["went"] == 1
    assert state(spark, store) == afresh(spark, land, tmp_dir, "r5")
    write(land, "d/b.csv", B)
    write(land, "d/copy.csv", A)
    sync(spark, land, store, "r6")
    assert state(spark, store) == first
    assert rows(MI.customer_mart(spark, store, _dims(spark))) == rows(
        M.customer_mart_from(MI.totals(spark, store, MI.CUSTOMER), _dims(spark).customer))


def test_a_sync_that_dies_changes_nothing(spark, tmp_dir, monkeypatch):
    land, store = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "store")
    write(land, "d/a.csv", A)
    sync(spark, land, store, "r1")
    before = state(spark, store)
    write(land, "d/a.csv", A2)
    for where in ("_store", "_change"):
        with monkeypatch.context() as m:
            real = getattr(MI, where)

            def dies(*args, real=real):
                real(*args)
                raise RuntimeError("dead")
            m.setattr(MI, where, dies)
            with pytest.raises(RuntimeError):
                sync(spark, land, store, "r2")
        assert state(spark, store) == before
    sync(spark, land, store, "r2")
    assert state(spark, store) == afresh(spark, land, tmp_dir, "x")
    assert sync(spark, land, store, "r2")["came"] == 0  # a committed run does nothing


def test_only_touched_months_are_written(spark, tmp_dir):
    land, store = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "store")
    write(land, "d/a.csv", A)
    write(land, "d/b.csv", B)
    sync(spark, land, store, "r1")
    write(land, "d/c.csv", f"{HEAD}\n2,121,oats,2024-04-09,2,7,1,7\n")
    sync(spark, land, store, "r2")
    new = {p.part for p in CM.parts(spark, store, "r2", "sales_totals") if p.version == "r2"}
    assert new == {"sales_month=2024-04"}
    assert sorted(f for f in os.listdir(f"{store}/sales_totals/run_id=r2") if "=" in f) == ["sales_month=2024-04"]


def test_an_emptied_folder_and_files_that_are_not_sales(spark, tmp_dir):
    land, store = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "store")
    write(land, "d/a.csv", A)
    write(land, "d/note.txt", "text\n")
    write(land, "d/odd.csv", "x,y\n1,2\n")
    write(land, "d/head.csv", f"{HEAD}\n")
    sync(spark, land, store, "r1")
    assert MI.files(spark, store).count() == 2
    reasons = {r["reason"] for r in spark.read.parquet(f"{store}/quarantine/run_id=r1").collect()}
    assert reasons == {"extension", "missing columns"}
    for f in ("a.csv", "head.csv", "odd.csv"):
        os.remove(os.path.join(land, "d", f))
    assert sync(spark, land, store, "r2")["went"] == 2
    assert state(spark, store) == ([], [], [])


def test_a_header_or_one_line_more_is_another_content(spark, tmp_dir):
    texts = {"a": A, "same": A, "twice": A + A.splitlines()[1] + "\n", "none": f"{HEAD}\n",
             "extra": A.replace("total_cost\n", "total_cost,x\n", 1), "case": A.replace("price", "PRICE")}
    for name, text in texts.items():
        write(tmp_dir, f"d/{name}.csv", text)
    listing = V.split_by_extension(FS.list_files(spark, tmp_dir))
    got = {os.path.basename(r["path"])[:-4]: r["content"]
           for r in VS.contents(spark, V.check_headers(FS.read_headers(listing))).collect()}
    assert got["a"] == got["same"] == got["case"]
    assert len({got[n] for n in ("a", "twice", "none", "extra")}) == 4


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_signed_totals_equal_a_fresh_sum(spark, seed):
    """Random rows come and go, amounts null among them, in a chain of changes."""
    rng = random.Random(seed)
    schema = "k bigint, total_cost decimal(18,2)"
    pool = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2, 5])) for _ in range(12)]

    def frame(some):
        return spark.createDataFrame([(k, None if v is None else __import__("decimal").Decimal(v)) for k, v in some], schema)
    present, held = [], None
    for _ in range(3):
        came = [r for r in pool if rng.random() < .5]
        went = [r for r in present if rng.random() < .5]
        for r in went:
            present.remove(r)
        present += came
        change = VS.signed_totals(frame(came), frame(went), ["k"])
        held = VS.changed_totals(change.limit(0) if held is None else held, change, ["k"])
    want = frame(present).groupBy("k").agg(F.sum("total_cost").alias("total_sales"))
    assert rows(held.select("k", F.col("total_sales").cast("double"))) == rows(
        want.select("k", F.col("total_sales").cast("double")))
