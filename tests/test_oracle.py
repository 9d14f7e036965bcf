"""Every registered query against its DuckDB oracle on the smallest tables."""
import pytest

import __spark_entry__ as E
from tools.oracle_check import digest

from conftest import SMALL

from martflow.plans.catalog import QUERIES
from martflow.plans.oracle import ORACLE

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["store_id", "sales_person_id", "full_name", "sales_month",
                          "total_sales", "incentive"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(s_rows) > 0
        return
    cur = duck.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN"}
    s_types = {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    o_types = {r[0]: r[1] for r in duck.execute(f"describe {sql}").fetchall()}
    assert s_types == o_types
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows)[0] == digest(o_cols, o_rows)[0]
