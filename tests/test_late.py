"""Parked rows of missing dimension keys; JDBC reads of skewed keys."""
import statistics

from martflow.operators.enrich import (DimSpec, parked_rows, retry_parked, settled_rows, star_join,
                                       with_missing)
from martflow.sinks import jdbc as SJ


def _specs(spark, a, b):
    return [DimSpec("a", spark.createDataFrame([(x,) for x in a], "id bigint"), "ka", "id"),
            DimSpec("b", spark.createDataFrame([(x,) for x in b], "id bigint"), "kb", "id")]


def test_parked_rows_come_back_with_their_keys(spark):
    fact = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z"), (2, 2, "w"), (None, 1, "n"), (2, 2, "w"),
                                  (9, 9, "q")], "ka bigint, kb bigint, v string")
    early, later = _specs(spark, [1, None], [1, 1]), _specs(spark, [1, 2, 2, None], [1, 2])
    marked = with_missing(fact, early)
    assert marked.count() == fact.count()  # duplicated and null keys of a dimension multiply nothing
    assert [r["v"] for r in settled_rows(marked).collect()] == ["x"]
    parked = parked_rows(marked)
    assert {r["v"]: list(r["missing"]) for r in parked.collect()} == {
        "y": ["b"], "z": ["a"], "w": ["a", "b"], "n": ["a"], "q": ["a", "b"]}
    again = retry_parked(parked, later)
    assert again.count() == parked.count()
    assert sorted(r["v"] for r in settled_rows(again).collect()) == ["w", "w", "y", "z"]
    assert {r["v"]: list(r["missing"]) for r in parked_rows(again).collect()} == {"n": ["a"], "q": ["a", "b"]}
    # a joined row is there once per copy of its key, as with all keys present from the start
    both = star_join(settled_rows(marked), early).unionByName(star_join(settled_rows(again), later))
    assert sorted(r["v"] for r in both.collect()) == sorted(["x", "x"] + ["y"] + ["z"] * 2 + ["w"] * 4)


def test_a_column_named_missing_and_an_empty_fact(spark):
    fact = spark.createDataFrame([(1, "m"), (2, "m")], "ka bigint, missing string")
    spec = _specs(spark, [1], [])[:1]
    assert [tuple(r) for r in parked_rows(with_missing(fact, spec)).collect()] == [(2, ["a"])]
    assert with_missing(fact.limit(0), spec).count() == 0


def test_a_skewed_table_is_read_in_even_partitions(spark, tmp_dir):
    """Half of the keys lie within a millionth of the key range."""
    url = f"jdbc:derby:{tmp_dir}/db;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    keys = spark.range(6000).selectExpr(
        "case when id % 10 = 9 then null when id % 2 = 0 then id else id * id * 1000 - 7 end as k", "id")
    SJ.write_jdbc(keys, url, "T", props)
    back = SJ.read_jdbc_balanced(spark, url, "T", '"k"', 8, props)
    rows = back.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    nulls = keys.where("k is null").count()
    assert rows[-1] == nulls and sum(rows) == 6000
    assert max(rows[:-1]) <= 2 * statistics.median(rows[:-1])
    assert sorted(r["id"] for r in back.select("id").collect()) == list(range(6000))
    even = SJ.read_jdbc(spark, url, "T", props, "k", *SJ.table_key_bounds(spark, url, "T", '"k"', props), 8)
    rows = even.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    assert max(rows) > 3 * statistics.median(rows)  # what equal widths give


def test_one_key_alone_and_no_rows(spark, tmp_dir):
    url = f"jdbc:derby:{tmp_dir}/db;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    SJ.write_jdbc(spark.range(50).selectExpr("cast(7 as bigint) as k"), url, "ONE", props)
    assert SJ.balanced_ranges(spark, url, "ONE", '"k"', 8, props) == [(7, 7, 50)]
    assert SJ.read_jdbc_balanced(spark, url, "ONE", '"k"', 8, props).count() == 50
    SJ.write_jdbc(spark.range(0).selectExpr("id as k"), url, "EMPTY_T", props)
    assert SJ.read_jdbc_balanced(spark, url, "EMPTY_T", '"k"', 8, props).count() == 0
