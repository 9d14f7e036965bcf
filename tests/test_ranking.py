"""The rank by value counts equals the plain window, hot groups and values included."""
import random

from pyspark.sql import functions as F

from martflow.operators import marts as M
from martflow.operators.ranking import rank_spread, rank_within, ranges


def _frame(spark, n=4000, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 4 else rnd.choice(["a", "b", None])
        v = None if rnd.random() < 0.05 else rnd.choice([0, 1, 1, 2, 3, 5]) * 100 + rnd.randint(0, 50)
        rows.append((g, 1, v))
    return spark.createDataFrame(rows, "g string, m int, v int")


def test_rank_equals_window(spark):
    df = _frame(spark)
    a = rank_within(df, ["g", "m"], "v")
    b = M.rank_window(df, ["g", "m"], "v")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rank_counts_the_greater_values(spark):
    rows = [r for r in rank_within(_frame(spark), ["g", "m"], "v").where(F.col("g") == "hot").collect()]
    vals = [r["v"] for r in rows if r["v"] is not None]
    for r in rows[:200]:
        if r["v"] is None:
            assert r["rnk"] == len(vals) + 1
        else:
            assert r["rnk"] == 1 + sum(1 for x in vals if x > r["v"])


def test_one_value_in_most_of_a_group_travels_as_one_row(spark):
    """Equal values are counted before the shuffle that the window needs."""
    df = spark.range(20000).selectExpr("id % 2 as g", "case when id % 10 = 0 then id else 7 end as v")
    a = rank_within(df, ["g"], "v")
    b = M.rank_window(df, ["g"], "v")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = a._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "partial_count" in window


def test_small_groups(spark):
    df = _frame(spark, n=200)
    a = rank_within(df, ["g", "m"], "v")
    b = M.rank_window(df, ["g", "m"], "v")
    assert a.exceptAll(b).count() == 0


def test_spread_rank_equals_window(spark):
    for df, group in ((_frame(spark), ["g", "m"]), (_frame(spark, n=200), ["g", "m"]),
                      (_frame(spark).limit(0), ["g"])):
        a = rank_spread(df, group, "v")
        b = M.rank_window(df, group, "v")
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_group_of_distinct_values_is_spread_over_the_tasks(spark):
    """All rows in one group, all values distinct: ranges of about equal size."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(100_000).selectExpr("1 as g", "(id * 7919) % 100003 as v")
        sizes = sorted(r["count"] for r in ranges(df, ["g"], "v").groupBy("__range").count().collect())
        ranked = rank_spread(df, ["g"], "v")
        plan = ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert "__range" in plan[plan.index("Window"):]
    got = ranked.selectExpr("count(*) as n", "max(rnk) as high", "count(distinct rnk) as ranks",
                            "corr(rnk, v) as c").first()
    assert (got["n"], got["high"], got["ranks"]) == (100_000, 100_000, 100_000) and got["c"] < -0.99


def test_top_k_keeps_ties_and_cuts_before_the_shuffle(spark):
    df = _frame(spark)
    for k in (1, 3, 50):
        a, b = M.top_k(df, ["g", "m"], k, "v"), M.rank_window(df, ["g", "m"], "v").where(f"rnk <= {k}")
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    tied = spark.createDataFrame([("a", 5), ("a", 5), ("a", 5), ("a", 1), ("b", None)], "g string, v int")
    assert sorted(tuple(r) for r in M.top_k(tied, ["g"], 2, "v").collect()) == [("a", 5, 1)] * 3 + [("b", None, 1)]
    plan = M.top_k(df, ["g"], 3, "v")._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("WindowGroupLimit"):] and plan.index("Final") < plan.index("Partial")
