"""The driver's TPC-H-like tables, seen through the sales contracts.

Role mapping (the oracle SQL in ``martflow.plans.oracle`` uses the same one):

* sales line  = lineitem x orders x supplier-nation:
  customer_id = o_custkey, store_id = s_nationkey (the seller's store),
  product_id = l_partkey, sales_date = date(o_orderdate),
  sales_person_id = l_suppkey, quantity = l_quantity,
  total_cost = decimal(l_extendedprice), unit price = total / quantity,
  additional_column = the folded extras l_linestatus, l_returnflag.
* customer    = customer (+ nation name as address, market segment as phone).
* store       = nation (+ region name as manager).
* sales team  = supplier (+ nation name; manager = lowest supplier key of the nation).
* product     = part (keyed by p_partkey; p_name is not unique).
* manifest    = events: file_name = user_id, status 'I' for a purchase else 'A'.

Every builder is lazy; only the CSV drops are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.contracts import EXTRA_COLUMN, MONEY, PRICE, STATUS_ACTIVE, STATUS_INACTIVE
from martflow.functions.columns import fold_columns, money, split_part
from martflow.sources.tables import Tables

# The lineitem columns that play the role of a drop's extra columns.
EXTRA_SOURCE_COLUMNS = ["l_linestatus", "l_returnflag"]


def _nation_names(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", "n_name", "n_regionkey")


def customer_dim(t: Tables) -> DataFrame:
    return t.memo("customer_dim", lambda: _customer_dim(t))


def _customer_dim(t: Tables) -> DataFrame:
    c, n = t.customer, _nation_names(t)
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    split_part("c_name", "#", 1).alias("first_name"),
                    split_part("c_name", "#", 2).alias("last_name"),
                    F.col("n_name").alias("address"),
                    F.col("c_nationkey").cast("string").alias("pincode"),
                    F.col("c_mktsegment").alias("phone_number"),
                    F.lit(None).cast("date").alias("customer_joining_date")))


def store_dim(t: Tables) -> DataFrame:
    return t.memo("store_dim", lambda: _store_dim(t))


def _store_dim(t: Tables) -> DataFrame:
    n, r = t.nation, t.region
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("long").alias("id"),
                    F.col("n_name").alias("address"),
                    F.col("n_regionkey").cast("string").alias("store_pincode"),
                    F.col("r_name").alias("store_manager_name"),
                    F.lit(None).cast("date").alias("store_opening_date"),
                    F.lit(None).cast("string").alias("reviews")))


def sales_team_dim(t: Tables) -> DataFrame:
    return t.memo("sales_team_dim", lambda: _sales_team_dim(t))


def _sales_team_dim(t: Tables) -> DataFrame:
    """Suppliers as sellers; the manager of a nation's team is its lowest key.

    The manager table is a grouped minimum (one row per nation, partial
    aggregation before the shuffle), joined back; a window over the nation
    would put a whole nation's suppliers into one task.
    """
    s, n = t.supplier, _nation_names(t)
    managers = (s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("manager_id"))
                .withColumnRenamed("s_nationkey", "m_nationkey"))
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
            .join(managers, s.s_nationkey == managers.m_nationkey, "left")
            .select(F.col("s_suppkey").alias("id"),
                    split_part("s_name", "#", 1).alias("first_name"),
                    split_part("s_name", "#", 2).alias("last_name"),
                    F.col("manager_id"),
                    F.when(F.col("s_suppkey") == F.col("manager_id"), "Y")
                     .otherwise("N").alias("is_manager"),
                    F.col("n_name").alias("address"),
                    F.col("s_nationkey").cast("string").alias("pincode"),
                    F.lit(None).cast("date").alias("joining_date"),
                    F.col("s_nationkey").cast("long").alias("store_id")))


def product_dim(t: Tables) -> DataFrame:
    return t.memo("product_dim", lambda: _product_dim(t))


def _product_dim(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast(PRICE).alias("current_price"),
        F.lit(None).cast(PRICE).alias("old_price"),
        F.lit(None).cast("timestamp").alias("created_date"),
        F.lit(None).cast("timestamp").alias("updated_date"),
        F.lit(None).cast("date").alias("expiry_date"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"))


def seller_stores(t: Tables) -> DataFrame:
    """supplier -> its nation (the store of the seller); keys only."""
    return t.supplier.select(F.col("s_suppkey").alias("ss_suppkey"),
                             F.col("s_nationkey").cast("long").alias("store_id"))


def sales_lines(t: Tables) -> DataFrame:
    return t.memo("sales_lines", lambda: _sales_lines(t))


def _sales_lines(t: Tables) -> DataFrame:
    """One row per lineitem: the canonical sales fact over the test tables.

    lineitem x orders is the one fact-sized join (sort-merge on the order key,
    or none if both sides are bucketed by it); the seller's store comes from a
    supplier key lookup.
    """
    li, o = t.lineitem, t.orders
    stores = seller_stores(t)
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
            .join(stores, li.l_suppkey == stores.ss_suppkey, "inner")
            .select(F.col("o_custkey").alias("customer_id"),
                    F.col("store_id"),
                    F.col("l_partkey").alias("product_id"),
                    F.to_date("o_orderdate").alias("sales_date"),
                    F.col("l_suppkey").alias("sales_person_id"),
                    (F.col("l_extendedprice") / F.col("l_quantity")).cast(MONEY).alias("price"),
                    F.col("l_quantity").cast("int").alias("quantity"),
                    money("l_extendedprice").alias("total_cost"),
                    fold_columns(EXTRA_SOURCE_COLUMNS).alias(EXTRA_COLUMN),
                    F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").alias("line_number")))


def sales_headers(t: Tables) -> DataFrame:
    """The order level of the fact: one row per order (who, when)."""
    return t.memo("sales_headers", lambda: t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("sales_date")))


def sales_items(t: Tables) -> DataFrame:
    """The line level of the fact: one row per lineitem (who sold, how much)."""
    return t.memo("sales_items", lambda: t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_suppkey").alias("sales_person_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("total_cost")))


def sales_drop_rows(t: Tables) -> DataFrame:
    return t.memo("sales_drop_rows", lambda: _sales_drop_rows(t))


def _sales_drop_rows(t: Tables) -> DataFrame:
    """Rows of a sales file drop: the eight contract columns plus the two
    extra source columns (with product name and list price from ``part``)."""
    li, o, p = t.lineitem, t.orders, t.part
    stores = seller_stores(t)
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
            .join(stores, li.l_suppkey == stores.ss_suppkey, "inner")
            .join(p, li.l_partkey == p.p_partkey, "inner")
            .select(F.col("o_custkey").alias("customer_id"),
                    F.col("store_id"),
                    F.col("p_name").alias("product_name"),
                    F.to_date("o_orderdate").alias("sales_date"),
                    F.col("l_suppkey").alias("sales_person_id"),
                    money("p_retailprice").alias("price"),
                    F.col("l_quantity").cast("int").alias("quantity"),
                    money("l_extendedprice").alias("total_cost"),
                    *[F.col(c) for c in EXTRA_SOURCE_COLUMNS],
                    F.col("o_orderpriority").alias("priority")))


def manifest_log(t: Tables) -> DataFrame:
    return t.memo("manifest_log", lambda: _manifest_log(t))


def _manifest_log(t: Tables) -> DataFrame:
    """events as an append-only manifest log (one state event per row)."""
    return t.events.select(
        F.col("user_id").cast("string").alias("file_name"),
        F.concat(F.lit("drops/"), F.col("user_id").cast("string")).alias("file_location"),
        F.when(F.col("event_type") == "purchase", F.lit(STATUS_INACTIVE))
         .otherwise(F.lit(STATUS_ACTIVE)).alias("status"),
        F.col("ts").alias("event_ts"),
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_id"))


# --------------------------------------------------------------------------
# Sales file drops written by Spark from the tables (ingestion fixtures).
# --------------------------------------------------------------------------

# One drop folder per order priority, each with its own shape.
#   urgent      - CSV without the price column        -> quarantined (missing)
#   high        - CSV with extras; dates dd/MM/yyyy on returned lines -> bad rows
#   medium ...  - CSV with exactly the contract columns; a folder name that needs quoting
#   unspecified - CSV, columns reversed, header upper-case, with extras, one of
#                 them named like the library's own source_file column
#   low         - JSON lines, not CSV                  -> quarantined (extension)
DROP_BY_PRIORITY = {
    "1-URGENT": "urgent",
    "2-HIGH": "high",
    "3-MEDIUM": "medium 50% [a] #1",
    "4-NOT SPECIFIED": "unspecified",
    "5-LOW": "low",
}

_DROP_CACHE: dict[tuple[str, str], str] = {}


def write_sales_drop(t: Tables, root: str) -> str:
    """Write the five drop folders under ``root``; returns ``root``."""
    from martflow.contracts import MANDATORY_COLUMNS
    # one pass over the joined tables, staged by priority; each folder then
    # reads only its own partition
    from martflow.session import work_dir
    staged = work_dir(t.spark, "drop_rows")
    sales_drop_rows(t).write.mode("overwrite").partitionBy("priority").parquet(staged)
    rows = t.spark.read.parquet(staged)
    contract = list(MANDATORY_COLUMNS)

    def out(priority: str):
        return rows.where(F.col("priority") == priority).drop("priority")

    def csv(df: DataFrame, folder: str):
        df.write.mode("overwrite").option("header", "true").csv(f"{root}/{folder}")

    csv(out("1-URGENT").select(*[c for c in contract if c != "price"]), "urgent")
    high = out("2-HIGH").withColumn(
        "sales_date", F.when(F.col("l_returnflag") == "R", F.date_format("sales_date", "dd/MM/yyyy"))
        .otherwise(F.col("sales_date").cast("string")))
    csv(high.select(*contract, *EXTRA_SOURCE_COLUMNS), "high")
    csv(out("3-MEDIUM").select(*contract), DROP_BY_PRIORITY["3-MEDIUM"])
    rev = list(reversed(contract + EXTRA_SOURCE_COLUMNS))
    names = {"l_returnflag": "SOURCE_FILE"}
    csv(out("4-NOT SPECIFIED").select(*[F.col(c).alias(names.get(c, c.upper())) for c in rev]),
        "unspecified")
    out("5-LOW").select(*contract).write.mode("overwrite").json(f"{root}/low")
    return root


def sales_drop(t: Tables) -> str:
    """The drop for these tables, written once per session under the shared
    work folder (``spark.checkpoint.dir``)."""
    from martflow.session import work_dir
    key = (t.spark.sparkContext.applicationId, t.root)
    if key not in _DROP_CACHE:
        _DROP_CACHE[key] = write_sales_drop(t, work_dir(t.spark, "drop"))
    return _DROP_CACHE[key]
