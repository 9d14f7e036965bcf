"""Exact ``rank()`` within groups by counting values.

``rank() over (partition by g order by v desc nulls last)`` moves and sorts
every row of a group in one task. Here the rows are counted per (group, value)
first, with partial aggregation, so equal values travel as one row however
many there are; the rank of a value is one more than the rows of the greater
values of its group, a running sum over the distinct values; the rows then get
their value's rank by a join, which AQE splits when one value is hot.

``rank_within`` is one lazy plan, whose running sum orders one group's distinct
values in one task. ``rank_spread`` spreads them: the counts are sorted by
(group, value) over all tasks by range partitioning, each range sums up its own
values, and the sums of the ranges before it in the same group are added. The
ranges are written to the shared folder once, so both steps see the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.sinks.files import staged


def rank_within(df: DataFrame, group: list[str], value: str, out: str = "rnk") -> DataFrame:
    """``df`` with ``out`` = rank() over (group ORDER BY value DESC NULLS LAST)."""
    keys = [*group, value]
    greater = (Window.partitionBy(*group).orderBy(F.col(value).desc_nulls_last())
               .rowsBetween(Window.unboundedPreceding, -1))
    ranks = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
             .withColumn("__rank", (F.coalesce(F.sum("__n").over(greater), F.lit(0)) + 1).cast("int")))
    return _ranked(df, ranks, keys, out)


def _ranked(df: DataFrame, ranks: DataFrame, keys: list[str], out: str) -> DataFrame:
    """df with the ``__rank`` of its (group, value)."""
    ranks = ranks.select(*[F.col(k).alias(f"__r_{i}") for i, k in enumerate(keys)], "__rank")
    same = [df[k].eqNullSafe(ranks[f"__r_{i}"]) for i, k in enumerate(keys)]
    return (df.join(ranks, same, "inner").withColumnRenamed("__rank", out)
            .drop(*[f"__r_{i}" for i in range(len(keys))]))


def ranges(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The counts ``__n`` per (group, value), dealt to ranges ``__range`` of
    about equal size that ascend by group and, within it, descend by value."""
    order = [*[F.col(g).asc_nulls_first() for g in group], F.col(value).desc_nulls_last()]
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))
    return staged(counts.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")


def rank_spread(df: DataFrame, group: list[str], value: str, out: str = "rnk") -> DataFrame:
    """``rank_within`` for groups of any number of distinct values: no task
    holds more of a group than one range."""
    placed = ranges(df, group, value)
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = (placed.groupBy(*group, "__range").agg(F.sum("__n").alias("__n"))
            .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
            .select(*[F.col(g).alias(f"__g_{i}") for i, g in enumerate(group)],
                    F.col("__range").alias("__at"), "__before"))
    greater = (Window.partitionBy(*group, "__range").orderBy(F.col(value).desc_nulls_last())
               .rowsBetween(Window.unboundedPreceding, -1))
    inside = placed.withColumn("__inside", F.coalesce(F.sum("__n").over(greater), F.lit(0)))
    same = [F.col(g).eqNullSafe(F.col(f"__g_{i}")) for i, g in enumerate(group)]
    ranks = (inside.join(sums, [F.col("__range") == F.col("__at"), *same])
             .withColumn("__rank", (F.col("__before") + F.col("__inside") + 1).cast("int")))
    return _ranked(df, ranks, [*group, value], out)
