"""Plan shape checks: pruning, pushdown, shuffles, no pairwise joins."""
import re

import __spark_entry__ as E
from martflow.plans.catalog import QUERIES

from conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_anywhere(spark):
    for name, q in QUERIES.items():
        if name in WRITES:
            continue
        p = plan(q(spark, SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_sales_mart_prunes_columns_and_aggregates_partially(spark):
    p = plan(E.queries()["sales_mart"](spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(s.count(":") == 3 for s in lineitem), lineitem
    assert "partial_sum" in p and "partial_max" in p


def test_bucketed_join_reads_without_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["bucketed_join"](spark, SMALL)
        assert "Exchange" not in plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioned_read_prunes_folders(spark):
    df = E.queries()["partition_pruned_read"](spark, SMALL)
    assert re.search(r"PartitionFilters: \[[^\]]*store_id", plan(df))


WRITES = {"stream_ingest", "batch_marts", "jdbc_roundtrip", "latest_run", "parquet_roundtrip",
          "bucketed_join", "partition_pruned_read", "dim_store",
          "corrected_drop", "late_dimensions",
          "seller_rank", "manager_hierarchy"}  # the last two stage their ranges and rounds
DROPS = {"file_listing", "header_inventory", "schema_check", "quarantine_split", "bad_rows",
         "fold_extra_columns", "conform_union", "csv_roundtrip_scan"}


def test_building_a_query_runs_no_job(spark):
    """Queries that neither write nor read written files are lazy."""
    tracker = spark.sparkContext.statusTracker()
    for name in sorted(set(QUERIES) - WRITES - DROPS):
        QUERIES[name](spark, SMALL)  # file footers are read when a table is first opened
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        QUERIES[name](spark, SMALL)
        assert list(tracker.getJobIdsForGroup(f"build-{name}")) == [], name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_windows_read_totals_not_facts(spark):
    for name in ("sales_mart_window", "customer_mart_window", "sales_month_total_window",
                 "customer_month_total_window"):
        p = plan(QUERIES[name](spark, SMALL))
        assert "partial_sum" in p[p.rindex("Window"):], name


def test_orphan_report_reads_the_fact_once(spark):
    p = plan(QUERIES["orphan_facts"](spark, SMALL))
    assert "Expand" not in p and p.split("== Initial Plan ==")[0].count("l_extendedprice") == 0
    assert len(re.findall(r"FileScan parquet [^\n]*l_orderkey", p.split("== Initial Plan ==")[0])) == 1


def test_orphan_report_groups_keys_and_joins_nothing(spark):
    from martflow.operators.enrich import DimSpec, orphan_report
    fact = spark.range(9).selectExpr("id as a", "id as b")
    p = plan(orphan_report(fact, [DimSpec(c, spark.range(5), c, "id") for c in "ab"])).split("== Initial Plan ==")[0]
    assert "Join" not in p and p.count("Exchange") == 2 and "partial_bit_or" in p


def test_line_sized_shuffles_at_scale(spark):
    """With no table broadcast (as at 100 TB), the flagship, the customer mart
    and the roll-up move the lines once; the detail enrichment twice."""
    from tools.plan_report import exchanges
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name, most in (("sales_mart", 1), ("sales_month_total", 1), ("customer_mart", 1),
                           ("star_enrich", 2), ("manager_rollup", 1)):
            p = plan(E.queries()[name](spark, SMALL))
            lines = [e for e in exchanges(p) if "LINE-SIZED" in e]
            assert len(lines) <= most, (name, lines)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_no_local_checkpoint_folder_on_a_cluster():
    """Without spark.checkpoint.dir, only local mode may use a temp folder."""
    import pytest
    from martflow.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "yarn"
        applicationId = "app-cluster-test"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
