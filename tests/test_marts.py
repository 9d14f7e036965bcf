"""Edge cases of the marts on small inline fixtures."""
from datetime import date
from decimal import Decimal as D

from pyspark.sql import Window
from pyspark.sql import functions as F

from martflow.contracts import CUSTOMER, SALES_TEAM, STORE
from martflow.operators import marts as M
from martflow.operators.enrich import dim_key_uniqueness

FACT = ("customer_id long, store_id long, sales_date date, sales_person_id long, "
        "total_cost decimal(18,2)")


def dims(spark, customers=None, team=None, stores=None):
    customers = customers or [(1, "Asha", "Rao", "Delhi", "1", "911", None),
                              (2, "Ben", "Ode", "Pune", "2", "922", None)]
    team = team or [(1, "Sam", "Lee", 1, "Y", "Delhi", "1", None),
                    (2, "Kim", "Park", 1, "N", "Delhi", "1", None),
                    (3, "Ola", "Nord", 3, "Y", "Pune", "2", None)]
    stores = stores or [(121, "Delhi", "1", "Mgr A", None, None),
                        (122, "Pune", "2", "Mgr B", None, None)]
    return (spark.createDataFrame(customers, CUSTOMER), spark.createDataFrame(stores, STORE),
            spark.createDataFrame(team, SALES_TEAM))


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_incentive_half_up_and_month_totals(spark):
    c, s, t = dims(spark)
    f = fact(spark, [
        (1, 121, date(2024, 3, 3), 1, D("4000.00")), (2, 121, date(2024, 3, 9), 1, D("718.50")),
        (1, 121, date(2024, 3, 4), 2, D("100.00")), (2, 121, date(2024, 4, 1), 1, D("5000.00")),
    ])
    out = by_key(M.sales_mart(f, c, s, t), "sales_person_id", "sales_month")
    assert out[(1, "2024-03")]["total_sales"] == D("4718.50")
    assert out[(1, "2024-03")]["incentive"] == D("47.19")  # 47.185 -> half up
    assert out[(2, "2024-03")]["incentive"] == D("0.00")
    assert out[(1, "2024-04")]["incentive"] == D("50.00")
    assert out[(1, "2024-03")]["full_name"] == "Sam Lee"
    cm = by_key(M.customer_mart(f, c, s, t), "customer_id", "sales_date_month")
    assert cm[(1, "2024-03")]["total_sales"] == D("4100.00")
    assert cm[(2, "2024-04")]["full_name"] == "Ben Ode"


def test_tied_leaders_are_both_paid(spark):
    c, s, t = dims(spark)
    f = fact(spark, [(1, 121, date(2024, 5, 1), 1, D("10.00")),
                     (1, 121, date(2024, 5, 2), 2, D("10.00"))])
    out = M.sales_mart(f, c, s, t).collect()
    assert sorted(r["incentive"] for r in out) == [D("0.10"), D("0.10")]
    tops = M.top_sellers(M.sales_month_totals(M.enriched_keys(f, c, s, t)),
                         ["store_id", "sales_month"])
    assert tops.count() == 2


def test_null_name_gives_null_full_name(spark):
    c, s, t = dims(spark, customers=[(1, "Asha", None, "Delhi", "1", "911", None)])
    f = fact(spark, [(1, 121, date(2024, 5, 1), 1, D("10.00"))])
    (r,) = M.customer_mart(f, c, s, t).collect()
    assert r["full_name"] is None


def test_null_and_orphan_keys_are_dropped(spark):
    c, s, t = dims(spark)
    f = fact(spark, [(None, 121, date(2024, 5, 1), 1, D("10.00")),
                     (99, 121, date(2024, 5, 1), 1, D("20.00")),
                     (1, 121, date(2024, 5, 1), 1, D("5.00"))])
    (r,) = M.sales_mart(f, c, s, t).collect()
    assert r["total_sales"] == D("5.00")


def test_null_date_is_its_own_month_group(spark):
    c, s, t = dims(spark)
    f = fact(spark, [(1, 121, None, 1, D("7.00")), (1, 121, None, 2, D("3.00"))])
    out = by_key(M.sales_mart(f, c, s, t), "sales_person_id")
    assert out[(1,)]["sales_month"] is None
    assert out[(1,)]["incentive"] == D("0.07")
    assert out[(2,)]["incentive"] == D("0.00")


def test_all_null_group_pays_null_like_rank(spark):
    c, s, t = dims(spark)
    f = fact(spark, [(1, 121, date(2024, 5, 1), 1, None), (1, 121, date(2024, 5, 2), 2, None)])
    out = M.sales_mart(f, c, s, t).collect()
    assert [r["incentive"] for r in out] == [None, None]


def _reference_form(enriched):
    """Window sum + distinct + rank window, as the original job computed it."""
    w = Window.partitionBy("store_id", "sales_person_id", "sales_month")
    base = (M.with_month(enriched)
            .withColumn("t", F.sum("total_cost").over(w))
            .select("store_id", "sales_person_id",
                    F.concat("sales_person_first_name", F.lit(" "), "sales_person_last_name")
                    .alias("full_name"), "sales_month", "t").distinct())
    r = Window.partitionBy("store_id", "sales_month").orderBy(F.col("t").desc())
    return (base.withColumn("rnk", F.rank().over(r))
            .withColumn("incentive", F.round(F.when(F.col("rnk") == 1, F.col("t") * F.lit(D("0.01")))
                                             .otherwise(F.lit(0)), 2))
            .select("store_id", "sales_person_id", "full_name", "sales_month",
                    F.col("t").alias("total_sales"), "incentive"))


def test_duplicate_dimension_key_keeps_original_fan_out(spark):
    c, s, t = dims(spark, team=[(1, "Sam", "Lee", 1, "Y", "Delhi", "1", None),
                                (1, "Samuel", "Lee", 1, "Y", "Delhi", "1", None),
                                (2, "Kim", "Park", 1, "N", "Delhi", "1", None)])
    f = fact(spark, [(1, 121, date(2024, 5, 1), 1, D("5.00")),
                     (2, 121, date(2024, 5, 2), 1, D("5.00")),
                     (1, 121, date(2024, 5, 3), 2, D("4.00"))])
    assert [r["key"] for r in dim_key_uniqueness(t, "id").collect()] == [1]
    ours = M.sales_mart(f, c, s, t)
    ref = _reference_form(M.star_enrich(f, c, s, t))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0
    totals = {r["full_name"]: r["total_sales"] for r in ours.collect()}
    assert totals["Sam Lee"] == totals["Samuel Lee"] == D("20.00")


def test_window_form_equals_group_form(spark):
    import random
    random.seed(3)
    c, s, t = dims(spark)
    rows = [(random.choice([1, 2]), random.choice([121, 122]),
             date(2024, random.randint(1, 4), random.randint(1, 28)), random.choice([1, 2, 3]),
             D(random.randint(1, 9999)) / 100) for _ in range(300)]
    e = M.enriched_keys(fact(spark, rows), c, s, t)
    g = M.sales_month_totals(e)
    w = M.sales_totals_window(e)
    assert g.exceptAll(w).count() == 0 and w.exceptAll(g).count() == 0
    g, w = M.customer_month_totals(e), M.customer_totals_window(e)
    assert g.exceptAll(w).count() == 0 and w.exceptAll(g).count() == 0
    assert (g.agg(F.sum("total_sales")).first()[0]
            == fact(spark, rows).agg(F.sum("total_cost")).first()[0])


def test_manager_rollup_sums_team(spark):
    c, s, t = dims(spark)
    f = fact(spark, [(1, 121, date(2024, 5, 1), 1, D("5.00")),
                     (1, 121, date(2024, 5, 1), 2, D("6.00")),
                     (2, 122, date(2024, 5, 1), 3, D("7.00"))])
    out = by_key(M.manager_rollup(f, t), "manager_id")
    assert out[(1,)]["team_total"] == D("11.00") and out[(1,)]["members"] == 2
    assert out[(3,)]["team_total"] == D("7.00")


def _hl_fixture(spark, team_rows):
    c, s, t = dims(spark, team=team_rows)
    headers = spark.createDataFrame(
        [(10, 1, date(2024, 5, 1)), (11, 2, date(2024, 5, 2)), (12, 1, date(2024, 6, 3)),
         (13, 99, date(2024, 6, 4))],
        "order_id long, customer_id long, sales_date date")
    items = spark.createDataFrame(
        [(10, 1, D("5.00")), (10, 2, D("4.00")), (11, 1, D("5.00")), (12, 3, D("7.50")),
         (13, 1, D("100.00")), (12, 9, D("1.00"))],
        "order_id long, sales_person_id long, total_cost decimal(18,2)")
    return headers, items, c, s, t


def test_header_line_plan_equals_original_semantics(spark):
    team = [(1, "Sam", "Lee", 1, "Y", "Delhi", "1", None),
            (1, "Samuel", "Lee", 1, "Y", "Delhi", "1", None),
            (2, "Kim", "Park", 1, "N", "Delhi", "1", None),
            (3, "Ola", "Nord", 3, "Y", "Pune", "2", None)]
    h, i, c, s, t = _hl_fixture(spark, team)
    stores = {1: 121, 2: 121, 3: 122}
    t = t.withColumn("store_id", F.when(F.col("id") == 3, 122).otherwise(121).cast("long"))
    flat = (i.join(h, "order_id")
            .withColumn("store_id", F.when(F.col("sales_person_id") == 3, 122)
                        .otherwise(121).cast("long")))
    ours = M.sales_mart_hl(h, i, c, s, t)
    ref = _reference_form(M.star_enrich(flat, c, s, t))
    ref = M.as_contract(ref, ours.schema)
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0
    assert stores and ours.count() == 4  # orphan customer 99 and seller 9 dropped

    cm = M.customer_mart_hl(h, i, c, s, t)
    cm_flat = M.customer_mart(flat, c, s, t)
    assert cm.exceptAll(cm_flat).count() == 0 and cm_flat.exceptAll(cm).count() == 0
    e_hl = M.star_enrich_hl(h, i, c, s, t).select(sorted(M.star_enrich(flat, c, s, t).columns))
    e_flat = M.star_enrich(flat, c, s, t).select(sorted(e_hl.columns))
    assert e_hl.exceptAll(e_flat).count() == 0 and e_flat.exceptAll(e_hl).count() == 0


def test_hot_order_key_is_split_by_the_skew_join(spark):
    """One order holding most lines: AQE splits its partition of the
    order-key join (thresholds scaled down to the fixture)."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        headers = spark.range(200).selectExpr("id as order_id", "id % 2 as customer_id",
                                              "date'2024-05-01' as sales_date")
        items = spark.range(20000).selectExpr(
            "case when id % 3 = 0 then id % 200 else 7 end as order_id",
            "id % 3 + 1 as sales_person_id", "cast(1.00 as decimal(18,2)) as total_cost")
        c, s, t = dims(spark, customers=[(0, "A", "B", "x", "1", "9", None),
                                         (1, "C", "D", "y", "2", "8", None)])
        t = t.withColumn("store_id", F.lit(121).cast("long"))
        df = M.sales_totals_hl(headers, items, c, s, t)
        total = sum(r["total_sales"] for r in df.collect())
        assert total == D("20000.00")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_orphan_report_counts_null_and_unmatched_keys(spark):
    from martflow.operators.enrich import DimSpec, orphan_report
    c, s, t = dims(spark)
    f = fact(spark, [(None, 121, date(2024, 5, 1), 1, D("1.00")),
                     (99, 121, date(2024, 5, 1), 1, D("1.00")),
                     (99, 555, date(2024, 5, 1), 7, D("1.00")),
                     (1, 121, date(2024, 5, 1), 2, D("1.00"))])
    out = {r["dimension"]: r["orphan_rows"] for r in orphan_report(f, [
        DimSpec("customer", c, "customer_id", "customer_id"),
        DimSpec("store", s, "store_id", "id"),
        DimSpec("team", t, "sales_person_id", "id")]).collect()}
    assert out == {"customer": 3, "store": 1, "team": 1}


def test_orphan_report_of_other_key_types_names_and_sizes(spark):
    """Keys of other types meet as in a join; a dimension's NULL, repeated and
    uncastable keys change nothing; an empty fact has no orphans."""
    from martflow.operators.enrich import DimSpec, orphan_report
    f = spark.createDataFrame([(1, "a", None), (2, "b", 1), (2, None, 2), (None, "a", 2)], "n int, known string, k0 long")
    d = spark.createDataFrame([("1", 2.0), ("x", 1.5), (None, None), ("1", 2.0)], "which string, half double")
    e = spark.createDataFrame([("a",), (None,)], "k string")
    specs = [DimSpec("text", d, "n", "which"), DimSpec("double", d, "n", "half"),
             DimSpec("names", e, "known", "k"), DimSpec("long", d, "k0", "half"),
             DimSpec("none", e.limit(0), "known", "k")]
    got = {r["dimension"]: r["orphan_rows"] for r in orphan_report(f, specs).collect()}
    want = {s.name: f.count() - f.join(s.df.select(s.dim_key).distinct(), f[s.fact_key].eqNullSafe(F.col(s.dim_key).try_cast(
        f.schema[s.fact_key].dataType)) & (f[s.fact_key].cast("double" if s.dim_key == "half" else "string")
                                           == F.col(s.dim_key)), "left_semi").count() for s in specs}
    assert got == want == {"text": 3, "double": 2, "names": 2, "long": 2, "none": 4}
    assert {r["orphan_rows"] for r in orphan_report(f.limit(0), specs).collect()} == {0}


def test_header_line_nulls_match_original_form(spark):
    c, s, t = dims(spark)
    t = t.withColumn("store_id", F.when(F.col("id") == 3, 122).otherwise(121).cast("long"))
    h = spark.createDataFrame(
        [(10, 1, None), (11, None, date(2024, 5, 2)), (12, 2, date(2024, 5, 3)),
         (13, 1, date(2024, 5, 4))],
        "order_id long, customer_id long, sales_date date")
    i = spark.createDataFrame(
        [(10, 1, D("5.00")), (10, 2, D("3.00")), (11, 1, D("9.00")), (12, None, D("8.00")),
         (12, 2, None), (13, 3, None), (13, 1, D("2.00"))],
        "order_id long, sales_person_id long, total_cost decimal(18,2)")
    flat = (i.join(h, "order_id")
            .withColumn("store_id", F.when(F.col("sales_person_id") == 3, 122)
                        .otherwise(121).cast("long")))
    ours = M.sales_mart_hl(h, i, c, s, t)
    ref = M.as_contract(_reference_form(M.star_enrich(flat, c, s, t)), ours.schema)
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0
    cm = M.customer_mart_hl(h, i, c, s, t)
    cm_flat = M.customer_mart(flat, c, s, t)
    assert cm.exceptAll(cm_flat).count() == 0 and cm_flat.exceptAll(cm).count() == 0
    null_month = [r for r in ours.collect() if r["sales_month"] is None]
    assert {r["sales_person_id"] for r in null_month} == {1, 2}
    (seller3,) = [r for r in ours.collect() if r["sales_person_id"] == 3]
    assert seller3["total_sales"] is None and seller3["incentive"] is None


def test_duplicated_seller_key_gives_one_result_whatever_is_broadcast(spark):
    """Rows and types are the same with and without broadcast joins."""
    team = [(1, "Sam", "Lee", 1, "Y", "Delhi", "1", None),
            (1, "Samuel", "Lee", 1, "Y", "Delhi", "1", None),
            (2, "Kim", "Park", 1, "N", "Delhi", "1", None),
            (3, "Ola", "Nord", 3, "Y", "Pune", "2", None)]
    h, i, c, s, t = _hl_fixture(spark, team)
    t = t.withColumn("store_id", F.when(F.col("id") == 3, 122).otherwise(121).cast("long"))
    flat = (i.join(h, "order_id")
            .withColumn("store_id", F.when(F.col("sales_person_id") == 3, 122)
                        .otherwise(121).cast("long")))
    expected = M.customer_mart(flat, c, s, t)
    for limit in ("-1", str(10 << 20)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            got = M.customer_mart_hl(h, i, c, s, t)
            assert got.schema == expected.schema
            assert got.exceptAll(expected).count() == 0
            assert expected.exceptAll(got).count() == 0
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
