"""Seeded synthetic sales, drawn from the warehouse's own keys.

The job this replaces generated a few hundred rows with Python's ``random``
on one machine. Here every draw is taken from the MD5 of (seed, draw, driver
row), so the output is the same on every run, cluster size and engine, and
the generation is joins and projections over a driver table (one synthetic
sale per driver row): it scales with that table and needs no coordination.

A key is drawn by position, so keys may have gaps: a dimension's keys are
dealt into ``SLOTS`` buckets by hash and numbered within each; a draw picks a
slot (which stands for one of the filled buckets) and a place in that bucket.

Rules kept from that generator: a seller belongs to one store (the seller's
store is looked up, not drawn), the price is the product's list price, the
quantity is 1..10 and total_cost = price * quantity exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.contracts import MONEY
from martflow.sources.tables import Tables

MAX_QUANTITY = 10
SLOTS = 4096
START_DATE = "1995-01-01"
DAYS = 1000


def _numbers(seed: int, draw: int, keys: list[str]) -> list[Column]:
    """Four whole numbers below 2**32 from one MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(str(draw)), *[F.col(k).cast("string") for k in keys])
    return [F.conv(F.substring(F.md5(text.cast("binary")), 1 + 8 * i, 8), 16, 10).cast("bigint")
            for i in range(4)]


def _numbered(dim: DataFrame, key: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """(dim with bucket and place, slots: slot -> bucket, size). Every slot
    stands for a filled bucket."""
    dealt = dim.withColumn("bucket", _numbers(seed, 0, [key])[0] % SLOTS)
    placed = dealt.withColumn("place", F.row_number().over(
        Window.partitionBy("bucket").orderBy(key)) - 1)
    sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    # at most SLOTS rows: one task numbers the filled buckets
    filled = (sizes.withColumn("nth", F.row_number().over(Window.orderBy("bucket")) - 1)
              .withColumn("filled", F.count(F.lit(1)).over(Window.partitionBy())))
    slots = filled.select("bucket", "size", F.explode(F.sequence(
        F.col("nth").cast("bigint"), F.lit(SLOTS - 1).cast("bigint"), F.col("filled"))).alias("slot"))
    return placed, slots


def _draw(rows: DataFrame, dim: DataFrame, key: str, seed: int, slot: str, place: str) -> DataFrame:
    """rows with one dim row each, picked by the numbers in slot and place."""
    placed, slots = _numbered(dim, key, seed)
    return (rows.withColumn("slot", F.col(slot) % SLOTS).join(slots, "slot")
            .withColumn("place", F.col(place) % F.col("size"))
            .join(placed, ["bucket", "place"]).drop("slot", "bucket", "size", "place"))


def synth_sales(t: Tables, seed: int = 42, start: str = START_DATE, days: int = DAYS) -> DataFrame:
    """One synthetic sale per lineitem row, in the sales contract's columns."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    first, second = _numbers(seed, 1, keys), _numbers(seed, 2, keys)
    drafts = t.lineitem.select(
        *[n.alias(f"n{i}") for i, n in enumerate([*first, *second[:2]])],
        F.date_add(F.to_date(F.lit(start)), (second[2] % days).cast("int")).alias("sales_date"),
        (second[3] % MAX_QUANTITY + 1).cast("int").alias("quantity"))
    customers = t.customer.select(F.col("c_custkey").alias("customer_id"))
    sellers = t.supplier.select(F.col("s_suppkey").alias("sales_person_id"),
                                F.col("s_nationkey").cast("long").alias("store_id"))
    products = t.part.select(F.col("p_partkey").alias("product_key"), F.col("p_name").alias("product_name"),
                             F.col("p_retailprice").cast(MONEY).alias("price"))
    out = _draw(drafts, customers, "customer_id", seed, "n0", "n1")
    out = _draw(out, sellers, "sales_person_id", seed, "n2", "n3")
    out = _draw(out, products, "product_key", seed, "n4", "n5")
    return out.select("customer_id", "store_id", "product_name", "sales_date",
                      "sales_person_id", "price", "quantity",
                      (F.col("price") * F.col("quantity")).cast(MONEY).alias("total_cost"))
