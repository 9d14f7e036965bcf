"""Any number of header variants in one plan."""
import random
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.contracts import MANDATORY_COLUMNS
from martflow.operators import conform as C
from martflow.sources import files as FS
from test_ingest import HEAD, _conformed, write


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def shuffled_drop(root, files, lines, seed):
    """Files with a header order and extra columns of their own, and their rows."""
    draw = random.Random(seed)
    want = []
    for n in range(files):
        extras = [f"x{draw.randrange(10**6)}" for _ in range(draw.randrange(4))]
        names = MANDATORY_COLUMNS + sorted(set(extras))
        order = draw.sample(names, len(names))
        text = [",".join(order)]
        for i in range(lines):
            row = {"customer_id": str(n), "store_id": "121", "product_name": f"p {i}", "sales_date": "2024-03-03",
                   "sales_person_id": "1", "price": "50", "quantity": str(i), "total_cost": f"{50 * i}"}
            row |= {x: "" if draw.random() < .3 else f"{x}v" for x in names if x not in row}
            text.append(",".join(row[c] for c in order))
            found = [row[x] for x in sorted(set(extras)) if row[x]]
            want.append((n, f"p {i}", i, ", ".join(found) if extras else None))
        write(root, f"drop/f{n}.csv", "\n".join(text) + "\n")
    return want


def test_hundreds_of_headers_are_one_plan(spark, tmp_dir):
    want = shuffled_drop(f"{tmp_dir}/many", 300, 3, 1)
    shuffled_drop(f"{tmp_dir}/few", 2, 3, 2)
    _, checked = _conformed(spark, f"{tmp_dir}/many")
    checked = checked.cache()
    checked.count()
    start = time.time()
    good, bad = C.conform(spark, checked)
    plan = plan_of(good)
    assert time.time() - start < 20
    _, few = _conformed(spark, f"{tmp_dir}/few")
    assert plan.count("\n") == plan_of(C.conform(spark, few)[0]).count("\n")
    assert plan.count("] csv") == 1 and plan.count("from_csv") + plan.count("csvtostructs") == 1
    got = [tuple(r) for r in good.select("customer_id", "product_name", "quantity", "additional_column").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bad.count() == 0
    checked.unpersist()


LINES = ['1,121,"a, b",2024-03-03,1,50,2,100', '1,121,"say ""hi""",2024-03-03,1,50,2,100',
         '1,121,a\\"b,2024-03-03,1,50,2,100', "1,121,,2024-03-03,1,50,2,100", '1,121,"",2024-03-03,1,50,2,100',
         " 1 , 121 , x , 2024-03-03 , 1 , 50 , 2 , 100 ", "1,121,few", "1,121,x,2024-03-03,1,50,2,100,more,still",
         "1,121,x,2024-03-03,1,50,2,100,", "", "   ", ",,,,,,,", "1,121,x\x01y,2024-03-03,1,50,2,100",
         "1,121,x,2024-03-03,1,50,2,100,\x02end", "ünï,121,x,2024-03-03,1,50,2,100", "#1,121,x,2024-03-03,1,50,2,100",
         HEAD, '1,121,x"y,2024-03-03,1,50,2,100', "1,121,x,2024-03-03,1,50,2,"]


def test_lines_are_read_as_by_a_reader_of_one_header(spark, tmp_dir):
    write(tmp_dir, "drop/a.csv", HEAD + "\n" + "\n".join(LINES) + "\r\n")
    write(tmp_dir, "drop/wide.csv", f"{HEAD},z,y\n1,121,x,2024-03-03,1,50,2,100,,\n")
    write(tmp_dir, "drop/header_only.csv", HEAD)
    _, checked = _conformed(spark, tmp_dir)
    text = C.conform_text(spark, checked)
    names = [*MANDATORY_COLUMNS, FS.CORRUPT]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    plain = (spark.read.schema(schema).option("header", "true").option("enforceSchema", "true")
             .option("columnNameOfCorruptRecord", FS.CORRUPT).csv(f"{tmp_dir}/drop/a.csv"))
    got = text.where(F.col("source_file").endswith("/a.csv")).select(*names).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain.collect()))
    wide = text.where(F.col("source_file").endswith("/wide.csv")).first()
    assert wide["additional_column"] == "" and wide[FS.CORRUPT] is None
    assert text.where(F.col("source_file").endswith("/header_only.csv")).count() == 0


def test_an_open_quote_is_a_bad_row(spark, tmp_dir):
    write(tmp_dir, "drop/a.csv", f'{HEAD}\n1,121,"x,2024-03-03,1,50,2,100\n1,121,x,2024-03-03,1,50,2,"100\n'
                                 "1,121,x,2024-03-03,1,50,2,100\n")
    _, checked = _conformed(spark, tmp_dir)
    good, bad = C.conform(spark, checked)
    assert good.count() == 1
    assert sorted(r["raw_line"] for r in bad.collect()) == sorted(
        ['1,121,"x,2024-03-03,1,50,2,100', '1,121,x,2024-03-03,1,50,2,"100'])


def test_a_value_is_cast_once_and_a_path_is_cut_once(spark, tmp_dir):
    """The filter, the checks and the typed columns share the casts of a line's
    values; what follows from a file's path is not worked out for every line."""
    shuffled_drop(f"{tmp_dir}/d", 3, 4, 5)
    write(f"{tmp_dir}/d", "drop/odd.csv", HEAD + "\n" + "\n".join([
        "9,121,sugar,2024-03-03,1,50.001,2,100", "9,121,sugar,2024-03-03,1,50.010,2,100",
        "9,121,sugar,2024-13-03,x,50,2,1e30", "9,121,sugar,,1,,2,100", "9,121,sugar,2024-03-03,1,50,2"]) + "\n")
    _, checked = _conformed(spark, f"{tmp_dir}/d")
    checked = checked.localCheckpoint()
    good, bad = C.conform(spark, checked)
    assert plan_of(good).count("try_cast(") == 9  # seven values that are no text, money also in full
    assert "regexp_extract" not in plan_of(good)
    assert good.count() == 14 and {r["drop"] for r in good.select("drop").collect()} == {"drop"}
    assert sorted(tuple(r["bad_columns"]) for r in bad.collect()) == [
        (), ("price",), ("sales_date", "sales_person_id", "total_cost")]
