"""Properties: the marts equal the original window/rank form on random
facts; every (store, month) pays at least one leader; money is conserved."""
from datetime import date
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from martflow.operators import marts as M
from conftest import SMALL
from test_marts import _reference_form, dims, fact

row = st.tuples(st.sampled_from([1, 2, None]), st.sampled_from([121, 122]),
                st.sampled_from([date(2024, 1, 5), date(2024, 1, 20), date(2024, 2, 2), None]),
                st.sampled_from([1, 2, 3]),
                st.one_of(st.none(), st.integers(0, 500).map(lambda c: D(c) / 4)))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40))
def test_sales_mart_equals_window_rank_form(spark, rows):
    c, s, t = dims(spark)
    f = fact(spark, rows)
    ours = M.sales_mart(f, c, s, t)
    ref = M.as_contract(_reference_form(M.star_enrich(f, c, s, t)), ours.schema)
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_every_store_month_pays_a_leader_and_money_is_conserved(spark):
    mart = E.queries()["sales_mart"](spark, SMALL)
    per_group = mart.groupBy("store_id", "sales_month").agg(
        F.max("incentive").alias("top"), F.sum("total_sales").alias("total"))
    assert per_group.where(F.col("top") <= 0).count() == 0
    cm = E.queries()["customer_mart"](spark, SMALL)
    a = mart.agg(F.sum("total_sales")).first()[0]
    b = cm.agg(F.sum("total_sales")).first()[0]
    assert abs(a - b) < 1e-6 * max(1.0, abs(a))


def test_synthetic_sales_follow_the_generator_rules(spark):
    from martflow.sources.synth import synth_sales
    from martflow.sources.tables import Tables
    t = Tables.open(spark, SMALL)
    s = synth_sales(t, seed=7)
    assert s.count() == t.lineitem.count()
    assert s.where(F.col("total_cost") != F.col("price") * F.col("quantity")).count() == 0
    assert s.where((F.col("quantity") < 1) | (F.col("quantity") > 10)).count() == 0
    assert s.where("sales_date < '1995-01-01' or sales_date >= '1995-01-01' + interval 1000 days").count() == 0
    stores = t.supplier.select(F.col("s_suppkey").alias("sales_person_id"),
                               F.col("s_nationkey").cast("long").alias("expected"))
    assert s.join(stores, "sales_person_id").where(F.col("store_id") != F.col("expected")).count() == 0
    assert s.join(t.customer, s.customer_id == t.customer.c_custkey, "left_anti").count() == 0
    assert s.select("customer_id").distinct().count() > 0.9 * t.customer.count()
    again = synth_sales(t, seed=7)
    assert s.exceptAll(again).count() == 0           # seeded: the same rows every run


def test_synthetic_sales_draw_from_keys_with_gaps(spark):
    from types import SimpleNamespace
    from martflow.sources.synth import synth_sales
    from martflow.sources.tables import Tables
    t = Tables.open(spark, SMALL)
    gappy = SimpleNamespace(lineitem=t.lineitem, customer=t.customer.where("c_custkey % 7 = 3"),
                            supplier=t.supplier.where("s_suppkey % 5 = 1"), part=t.part.where("p_partkey > 50"))
    s = synth_sales(gappy)
    assert s.count() == t.lineitem.count()
    assert s.where("customer_id % 7 <> 3 or sales_person_id % 5 <> 1 or total_cost is null").count() == 0
