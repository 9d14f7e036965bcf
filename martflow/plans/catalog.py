"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each one runs a library operator over the whole test tables (or over data
Spark derives from them). Money is summed in decimal and cast to double only
at the edge, so that both engines print the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.contracts import MANDATORY_COLUMNS, SALES_FACT, STORE
from martflow.functions import columns as fn
from martflow.operators import conform as C
from martflow.operators import enrich as E
from martflow.operators import hierarchy as H
from martflow.operators import manifest as MF
from martflow.operators import marts as M
from martflow.operators import validate as V
from martflow.plans import batch_job as BJ
from martflow.plans import mirror as MI
from martflow.session import work_dir
from martflow.sinks import files as SK
from martflow.sinks import jdbc as SJ
from martflow.sources import files as FS
from martflow.sources import synth as SY
from martflow.sources import testbed as tb
from martflow.sources.dims import read_dim
from martflow.sources.tables import Tables
from martflow.streaming import ingest as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# the typed contract without the folded column: a plain drop's read schema
SALES_FACT_CSV = type(SALES_FACT)(SALES_FACT.fields[:-1])


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _dbl(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


def _str(c: str) -> F.Column:
    return F.col(c).cast("string").alias(c)


def _star(spark: SparkSession, sf_dir: str):
    """Flat view: the line-level fact (lines x orders x seller store) and the
    three dimensions; used where each line's attributes are the output."""
    t = Tables.open(spark, sf_dir)
    return (t, tb.sales_lines(t), tb.customer_dim(t), tb.store_dim(t), tb.sales_team_dim(t))


def _hl(spark: SparkSession, sf_dir: str):
    """Header/line view: orders, lineitems and the three dimensions."""
    t = Tables.open(spark, sf_dir)
    return (tb.sales_headers(t), tb.sales_items(t), tb.customer_dim(t), tb.store_dim(t),
            tb.sales_team_dim(t))


ROWS_A_TASK = 500_000  # of a step that holds its rows in hash tables and windows


def _tasks(t: Tables) -> int:
    """Tasks for the lines (their number is in the Parquet footers, read once):
    a task's rows, and so its memory, stay the same however many lines there are."""
    return max(1, -(-t.memo("n_lines", t.lineitem.count) // ROWS_A_TASK))


# ---------------------------------------------------------------- marts

@query
def sales_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.sales_mart_hl(*_hl(spark, sf_dir))
    return out.select("store_id", "sales_person_id", "full_name", "sales_month",
                      _dbl("total_sales"), _dbl("incentive"))


@query
def customer_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.customer_mart_hl(*_hl(spark, sf_dir))
    return out.select("customer_id", "full_name", "address", "phone_number",
                      "sales_date_month", _dbl("total_sales"))


@query
def sales_mart_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales-team mart with totals and rank from windows; same result as
    ``sales_mart``."""
    t, fact, cust, store, team = _star(spark, sf_dir)
    return _sales_mart_out(M.sales_mart_window(M.enriched_keys(fact, cust, store, team), team, _tasks(t)))


@query
def customer_mart_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer mart with totals from a window; same result as
    ``customer_mart``."""
    t, fact, cust, store, team = _star(spark, sf_dir)
    out = M.customer_mart_window(M.enriched_keys(fact, cust, store, team), cust, _tasks(t))
    return out.select("customer_id", "full_name", "address", "phone_number",
                      "sales_date_month", _dbl("total_sales"))


# ------------------------------------------------------- totals

@query
def customer_month_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.customer_totals_hl(*_hl(spark, sf_dir))
    return out.select("customer_id", "sales_date_month", _dbl("total_sales"))


@query
def customer_month_total_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window form: window sum per (customer, month) + DISTINCT."""
    t, fact, cust, store, team = _star(spark, sf_dir)
    out = M.customer_totals_window(M.enriched_keys(fact, cust, store, team), _tasks(t))
    return out.select("customer_id", "sales_date_month", _dbl("total_sales"))


@query
def sales_month_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.sales_totals_hl(*_hl(spark, sf_dir))
    return out.select("store_id", "sales_person_id", "sales_month", _dbl("total_sales"))


@query
def sales_month_total_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, fact, cust, store, team = _star(spark, sf_dir)
    out = M.sales_totals_window(M.enriched_keys(fact, cust, store, team), _tasks(t))
    return out.select("store_id", "sales_person_id", "sales_month", _dbl("total_sales"))


# ------------------------------------------------------- ranking

@query
def seller_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = M.sales_totals_hl(*_hl(spark, sf_dir))
    out = M.rank_spread(totals, ["store_id", "sales_month"])
    return out.select("store_id", "sales_person_id", "sales_month", _dbl("total_sales"),
                      F.col("rnk").cast("long").alias("rnk"))


@query
def top_k_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best sellers of each store and month, ties included."""
    totals = M.sales_totals_hl(*_hl(spark, sf_dir))
    out = M.top_k(totals, ["store_id", "sales_month"], k=3)
    return out.select("store_id", "sales_person_id", "sales_month", _dbl("total_sales"),
                      F.col("rnk").cast("long").alias("rnk"))


@query
def top_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = M.sales_totals_hl(*_hl(spark, sf_dir))
    out = M.top_sellers(totals, ["store_id", "sales_month"])
    return out.select("store_id", "sales_person_id", "sales_month", _dbl("total_sales"))


# ------------------------------------------------------- joins

def _fact_cols():
    return ["order_id", "line_number", "customer_id", "store_id", "sales_person_id",
            _str("sales_date"), _dbl("total_cost")]


@query
def join_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact x customer: unmatched facts drop."""
    _, fact, cust, _s, _t = _star(spark, sf_dir)
    spec = E.DimSpec("customer", cust, "customer_id", "customer_id",
                     {"first_name": "first_name", "last_name": "last_name", "address": "address"})
    return E.join_dim(fact, spec).select(*_fact_cols(), "first_name", "last_name", "address")


@query
def join_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fact, _c, store, _t = _star(spark, sf_dir)
    spec = E.DimSpec("store", store, "store_id", "id", {
        "store_manager_name": "store_manager_name", "store_address": "address"})
    return E.join_dim(fact, spec).select(*_fact_cols(), "store_manager_name", "store_address")


@query
def join_sales_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fact, _c, _s, team = _star(spark, sf_dir)
    spec = E.DimSpec("team", team, "sales_person_id", "id",
                     {"sales_person_first_name": "first_name",
                      "sales_person_last_name": "last_name", "manager_id": "manager_id"})
    return E.join_dim(fact, spec).select(*_fact_cols(), "sales_person_first_name",
                                         "sales_person_last_name", "manager_id")


@query
def join_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product join the original only promised: fact x part on the part
    key (names repeat across parts), with the list value of the line and
    whether the charged price is not the list price."""
    t, fact, _c, _s, _t = _star(spark, sf_dir)
    spec = E.DimSpec("product", tb.product_dim(t), "product_id", "id",
                     {"product_name": "name", "current_price": "current_price"})
    out = E.join_dim(fact, spec)
    return out.select(*_fact_cols(), "product_id", "product_name", _dbl("current_price"),
                      F.col("quantity").cast("long").alias("quantity"),
                      (F.col("current_price") * F.col("quantity")).cast("double").alias("list_total"),
                      (F.col("current_price") * F.col("quantity") != F.col("total_cost"))
                      .alias("price_mismatch"))


@query
def star_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = M.star_enrich_hl(*_hl(spark, sf_dir))
    return e.select(*_fact_cols(), "sales_person_first_name", "sales_person_last_name",
                    "manager_id", "is_manager", "sales_person_address", "sales_person_pincode",
                    "store_manager_name", "customer_first_name", "customer_last_name",
                    "customer_address", "customer_pincode", "customer_phone_number")


@query
def orphan_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per dimension, fact rows an inner join would silently drop (the last
    one is the customers that have an event)."""
    t, fact, cust, store, team = _star(spark, sf_dir)
    specs = [
        E.DimSpec("customer", cust, "customer_id", "customer_id"),
        E.DimSpec("store", store, "store_id", "id"),
        E.DimSpec("team", team, "sales_person_id", "id"),
        E.DimSpec("active_customer", t.events, "customer_id", "user_id"),
    ]
    return E.orphan_report(fact, specs)


@query
def manager_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per manager: lines of existing orders, totalled per seller, then
    rolled up through the team's manager reference."""
    headers, items, _c, _s, team = _hl(spark, sf_dir)
    lines = E.join_dim(items.select("order_id", "sales_person_id", "total_cost"),
                       E.DimSpec("order", headers, "order_id", "order_id"))
    out = M.manager_rollup(lines, team)
    return out.select("manager_id", _dbl("team_total"), "members")


@query
def manager_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales rolled up to every manager above a seller, at all levels. The test
    team has one level, so here seller n reports to seller n div 3."""
    t = Tables.open(spark, sf_dir)
    team = tb.sales_team_dim(t).select("id", F.expr("id div 3").alias("manager_id"))
    totals = M.period_total(tb.sales_items(t), ["sales_person_id"])
    return H.rollup(totals, team).select("manager_id", _dbl("team_total"), "members", "levels")


@query
def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store dimension written and read back by its contract: columns by
    name whatever their case, missing ones NULL of their type."""
    path = work_dir(spark, "dim_store")
    store = tb.store_dim(Tables.open(spark, sf_dir)).drop("reviews")
    SK.write_parquet(store.withColumnRenamed("id", "ID").withColumn("other", F.lit(1)), path)
    return read_dim(spark, path, STORE).select(
        "id", "address", "store_pincode", "store_manager_name",
        F.col("store_opening_date").cast("string").alias("store_opening_date"), "reviews")


@query
def dim_key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicated dimension keys (would fan facts out); part names are not
    unique in the test data, so that check reports rows."""
    t, _f, cust, store, team = _star(spark, sf_dir)
    prod = tb.product_dim(t)
    checks = [("customer.customer_id", cust, "customer_id"), ("store.id", store, "id"),
              ("sales_team.id", team, "id"), ("product.id", prod, "id"),
              ("product.name", prod, "name")]
    out = None
    for name, df, key in checks:
        part = (E.dim_key_uniqueness(df, key)
                .select(F.lit(name).alias("dimension"), F.col("key").cast("string").alias("key"),
                        "copies"))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------- projections

@query
def customer_mart_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.customer_detail(M.star_enrich_hl(*_hl(spark, sf_dir)))
    return out.select(*[c for c in out.columns if c not in ("sales_date", "total_cost")],
                      _str("sales_date"), _dbl("total_cost"))


@query
def sales_mart_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.sales_detail(M.star_enrich_hl(*_hl(spark, sf_dir)))
    return out.select(*[c for c in out.columns if c not in ("sales_date", "total_cost")],
                      _str("sales_date"), _dbl("total_cost"))


# ------------------------------------------------------- scalar and distinct

@query
def month_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables.open(spark, sf_dir).orders
    return o.select("o_orderkey", fn.month_key(F.to_date("o_orderdate")).alias("sales_month"))


@query
def full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tb.customer_dim(Tables.open(spark, sf_dir))
    return c.select("customer_id", fn.full_name("first_name", "last_name").alias("full_name"))


@query
def distinct_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DISTINCT over the projected seller attributes of every enriched row."""
    return M.seller_months_hl(*_hl(spark, sf_dir))


# ------------------------------------------------------- manifest

_MANIFEST_ORDER = {"order": ("event_ts", "event_id")}
_PENDING_ORDER = {"order": ("event_ts", "event_id")}


@query
def manifest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tb.manifest_log(Tables.open(spark, sf_dir))
    out = MF.latest(log, **_MANIFEST_ORDER)
    return out.select("file_name", "status", _str("event_ts"))


@query
def active_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which candidate drops (one per customer) were picked up and never
    committed: a membership test (semi join) plus the latest status 'A'."""
    t = Tables.open(spark, sf_dir)
    candidates = t.customer.select(F.col("c_custkey").cast("string").alias("file_name"))
    active = MF.active(tb.manifest_log(t), **_MANIFEST_ORDER).select("file_name")
    return candidates.join(active, "file_name", "left_semi").distinct()


@query
def new_files_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate drops (one per customer) minus files already committed."""
    t = Tables.open(spark, sf_dir)
    candidates = t.customer.select(F.col("c_custkey").cast("string").alias("file_name"))
    return MF.pending(candidates, tb.manifest_log(t), **_PENDING_ORDER)


# ------------------------------------------------------- ingestion

def _drop(spark: SparkSession, sf_dir: str):
    """(drop root, listing with ``accepted``, header check of accepted files)."""
    t = Tables.open(spark, sf_dir)
    root = tb.sales_drop(t)
    listing = V.split_by_extension(FS.list_files(spark, root))
    headers = FS.read_headers(listing.where("accepted"))
    checked = V.check_headers(headers).join(listing.select("path", "drop"), "path", "inner")
    return root, listing, checked


def _array_text(c: str) -> F.Column:
    return F.array_join(F.col(c), ",").alias(c)


@query
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders and extensions of the drop, and whether each kind is accepted."""
    _, listing, _ = _drop(spark, sf_dir)
    return listing.select("drop", "extension", "accepted").distinct()


@query
def header_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct header lines per drop folder (CSV files only)."""
    _, _, checked = _drop(spark, sf_dir)
    return checked.select("drop", "header", F.size("columns").alias("n_columns")).distinct()


@query
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mandatory-column check per drop: missing and extra names, validity."""
    _, _, checked = _drop(spark, sf_dir)
    return checked.select("drop", "valid", _array_text("missing"), _array_text("extras")).distinct()


@query
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected files by reason, with their data lines counted (header lines
    excluded)."""
    _, listing, checked = _drop(spark, sf_dir)
    report = V.quarantine_report(listing, checked).join(listing.select("path", "extension"), "path")
    lines = V.quarantine_lines(spark, report)
    per_reason = (lines.withColumn("drop", F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1))
                  .groupBy("drop", "reason").agg(F.count(F.lit(1)).alias("lines")))
    files = (report.groupBy("drop", "reason", _array_text("missing"))
             .agg(F.count(F.when(F.col("extension") == ".csv", 1)).alias("header_lines")))
    return (files.join(per_reason, ["drop", "reason"], "inner")
            .select("drop", "reason", "missing",
                    (F.col("lines") - F.col("header_lines")).alias("data_rows")))


@query
def bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose text does not cast to the contract (kept, not dropped)."""
    _, _, checked = _drop(spark, sf_dir)
    _, bad = C.conform(spark, checked)
    return bad.select("drop", F.col("customer_id").cast("long").alias("customer_id"),
                      F.col("sales_person_id").cast("long").alias("sales_person_id"),
                      "sales_date", _array_text("bad_columns"))


def _good(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, checked = _drop(spark, sf_dir)
    good, _ = C.conform(spark, checked)
    return good


@query
def fold_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed rows of every valid file; extras folded into one column."""
    good = _good(spark, sf_dir)
    return good.select("drop", "customer_id", "store_id", "product_name", _str("sales_date"),
                       "sales_person_id", _dbl("price"), "quantity", _dbl("total_cost"),
                       "additional_column")


@query
def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of the header variants, per drop: rows and money."""
    good = _good(spark, sf_dir)
    return (good.groupBy("drop")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum("total_cost").cast("double").alias("total_cost"),
                 F.count("additional_column").alias("with_extras")))


@query
def csv_roundtrip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain-contract folder read with the typed contract schema directly
    (no inference), summed per store."""
    root, _, _ = _drop(spark, sf_dir)
    df = (spark.read.schema(SALES_FACT_CSV).option("header", "true")
          .option("mode", "FAILFAST").csv(FS.literal_path(f"{root}/{tb.DROP_BY_PRIORITY['3-MEDIUM']}")))
    return (df.groupBy("store_id")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum("quantity").alias("quantity"),
                 F.sum("total_cost").cast("double").alias("total_cost")))


@query
def total_cost_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """total_cost against list price * quantity, per store (report only)."""
    rows = tb.sales_drop_rows(Tables.open(spark, sf_dir))
    return V.total_cost_check(rows, ["store_id"])


# ------------------------------------------------------- sinks

def _sales_mart_out(df: DataFrame) -> DataFrame:
    return df.select("store_id", "sales_person_id", "full_name", "sales_month",
                     _dbl("total_sales"), _dbl("incentive"))


@query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer mart written as Parquet (overwrite) and read back."""
    path = work_dir(spark, "customer_mart")
    SK.write_parquet(M.customer_mart_hl(*_hl(spark, sf_dir)), path)
    back = spark.read.parquet(path)
    return back.select("customer_id", "full_name", "address", "phone_number",
                       "sales_date_month", _dbl("total_sales"))


@query
def partition_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales detail mart partitioned by (sales_month, store_id), read back
    through a partition filter (PartitionFilters prune folders)."""
    path = work_dir(spark, "sales_partitioned")
    SK.write_partitioned(M.sales_detail(M.star_enrich_hl(*_hl(spark, sf_dir))), path,
                         ["sales_month", "store_id"])
    back = (spark.read.parquet(path)
            .where((F.col("store_id") <= 5) & (F.col("sales_month") >= "1998-01")))
    return (back.groupBy("sales_month", F.col("store_id").cast("long").alias("store_id"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum("total_cost").cast("double").alias("total_cost")))


@query
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer detail and customer attributes as bucketed tables on
    customer_id, one bucket per shuffle partition of the session; the grouped
    join of the two reads them without a shuffle."""
    buckets = max(BJ.CUSTOMER_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hl = _hl(spark, sf_dir)
    cust = hl[2]
    tag = work_dir(spark, "bucketed").rsplit("-", 1)[-1]
    detail_t, attrs_t = f"customer_detail_b{tag}", f"customer_attrs_b{tag}"
    detail = M.customer_detail(M.star_enrich_hl(*hl))
    SK.write_bucketed(detail.select("customer_id", "sales_date", "total_cost"), detail_t,
                      work_dir(spark, detail_t), buckets, "customer_id")
    SK.write_bucketed(M.customer_attributes(cust).withColumnRenamed("attr_customer_id",
                                                                    "customer_id"),
                      attrs_t, work_dir(spark, attrs_t), buckets, "customer_id")
    totals = (spark.table(detail_t).groupBy("customer_id")
              .agg(F.sum("total_cost").alias("total_sales"), F.count(F.lit(1)).alias("lines")))
    out = totals.join(spark.table(attrs_t), "customer_id", "inner")
    return out.select("customer_id", "full_name", _dbl("total_sales"), "lines")


@query
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the sales mart: the first commits, the second dies after
    writing part of its files. The reader returns the committed run only."""
    root = work_dir(spark, "sales_mart_runs")
    SK.publish_run(spark, M.sales_mart_hl(*_hl(spark, sf_dir)), root, "00000001")
    # the second run dies after writing one store's rows and before its commit
    partial = spark.read.parquet(SK.run_path(root, "00000001")).where(F.col("store_id") == 0)
    SK.write_parquet(partial, SK.run_path(root, "00000002"))
    return _sales_mart_out(SK.latest_run(spark, root))


@query
def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales mart appended to a JDBC table with its run id, read back in
    parallel ranges of sales_person_id with about equal rows, filtered to the
    run (pushed down).

    Uses embedded Derby, which only this JVM sees: on a cluster point the
    URL at a shared database."""
    url = f"jdbc:derby:{work_dir(spark, 'derby')}/db;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
             "createTableColumnTypes": "run_id VARCHAR(32), full_name VARCHAR(128), "
                                       "sales_month VARCHAR(16)"}
    mart = M.sales_mart_hl(*_hl(spark, sf_dir)).withColumn("run_id", F.lit("00000001"))
    SJ.write_jdbc(mart, url, "SALES_TEAM_DATA_MART", props)
    read_props = {"driver": props["driver"]}
    back = SJ.read_jdbc_balanced(spark, url, "SALES_TEAM_DATA_MART", '"sales_person_id"', 8, read_props)
    back = back.toDF(*[c.lower() for c in back.columns]).where(F.col("run_id") == "00000001")
    return _sales_mart_out(back)


# ------------------------------------------------------- streaming (K7) and the whole job

def _dims(t: Tables) -> BJ.Dimensions:
    return BJ.Dimensions(tb.customer_dim(t), tb.store_dim(t), tb.sales_team_dim(t))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drop ingested by a file stream (AvailableNow) in several
    micro-batches, started twice on the same checkpoint: the second start finds
    no new file, so nothing is ingested twice. Returns the sales mart over all
    micro-batches."""
    t = Tables.open(spark, sf_dir)
    landing = tb.write_sales_drop(t, work_dir(spark, "landing"))
    layout = BJ.Layout(work_dir(spark, "stream_out"))
    ckpt = work_dir(spark, "stream_ckpt")
    archive = work_dir(spark, "stream_archive")
    for _ in range(2):
        ST.start_ingest(spark, landing, _dims(t), layout, ckpt, archive_dir=archive,
                        max_files_per_trigger=8).awaitTermination()
    return _sales_mart_out(SK.latest_run(spark, layout.sales_mart))


@query
def batch_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job over the drop in two runs, the second for what the
    first left, and a rerun that finds every file settled; returns the sales
    mart, which holds both runs."""
    t = Tables.open(spark, sf_dir)
    landing = tb.write_sales_drop(t, work_dir(spark, "landing"))
    layout = BJ.Layout(work_dir(spark, "job_out"))
    some = FS.list_files(spark, landing).where(F.col("drop").isin("high", "urgent"))
    BJ.run_files(spark, some, _dims(t), layout, "run-1")
    BJ.run_folder(spark, landing, _dims(t), layout, "run-2")
    again = BJ.run_folder(spark, landing, _dims(t), layout, "run-3")
    if again["files"]:
        raise AssertionError(f"settled files were read again: {again}")
    return _sales_mart_out(SK.latest_run(spark, layout.sales_mart))


@query
def corrected_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop folder mirrored in two versions. The first holds wrong amounts, a
    folder that is withdrawn and one that stays; the second holds the amounts put
    right, the folder that stayed with a copy of each of its files, and a new
    folder. Returns the sales mart as of the second version."""
    t = Tables.open(spark, sf_dir)
    root, store = work_dir(spark, "versions"), work_dir(spark, "mirror")
    rows = SK.staged(tb.sales_drop_rows(t), "version_rows")

    def drop(version: str, folder: str, priority: str, factor: int = 1) -> None:
        # rows go to files by their customer, so a second write has files of the same contents
        picked = (rows.where(F.col("priority") == priority).withColumn("total_cost", F.col("total_cost") * factor)
                  .select(*MANDATORY_COLUMNS).repartition(8, "customer_id"))
        picked.write.option("header", "true").csv(f"{root}/{version}/{folder}")

    drop("v1", "corrected", "3-MEDIUM", factor=2)
    drop("v1", "withdrawn", "4-NOT SPECIFIED")
    drop("both", "stays", "2-HIGH")
    drop("v2", "corrected", "3-MEDIUM")
    drop("v2", "copy", "2-HIGH")
    drop("v2", "new", "5-LOW")
    for version in ("v1", "v2"):
        files = FS.list_files(spark, f"{root}/{version}").unionByName(FS.list_files(spark, f"{root}/both"))
        MI.sync(spark, files, _dims(t), store, version)
    return _sales_mart_out(MI.sales_mart(spark, store, _dims(t)))


@query
def late_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer mart over two versions of the dimensions. The first lacks a
    market segment's customers and the managers among the sellers; lines that
    miss a key are parked, and settled by the second version, which has all."""
    t, fact, cust, store, team = _star(spark, sf_dir)
    early = M.key_specs(cust.where(F.col("phone_number") != "BUILDING"), store,
                        team.where(F.col("is_manager") == "N"))
    late = M.key_specs(cust, store, team)
    first = SK.staged(E.with_missing(fact, early), "marked")
    known = M.customer_month_totals(E.star_join(E.settled_rows(first), early))
    then = SK.staged(E.retry_parked(E.parked_rows(first), late), "retried")
    caught_up = M.customer_month_totals(E.star_join(E.settled_rows(then), late))
    # dealt anew, so that no task holds the tables of all three totals at once
    both = M.dealt(known.unionByName(caught_up), ["customer_id", "sales_date_month"], _tasks(t))
    totals = M.period_total(both, ["customer_id", "sales_date_month"], amount="total_sales")
    out = M.customer_mart_from(totals, cust)
    return out.select("customer_id", "full_name", "address", "phone_number",
                      "sales_date_month", _dbl("total_sales"))


# ------------------------------------------------------- generator

@query
def synth_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded synthetic sales, one per lineitem row."""
    out = SY.synth_sales(Tables.open(spark, sf_dir))
    return out.select("customer_id", "store_id", "product_name", _str("sales_date"),
                      "sales_person_id", _dbl("price"), "quantity", _dbl("total_cost"))
