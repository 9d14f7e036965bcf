"""All levels of the manager hierarchy, by pointer jumping.

Each member names its manager. After round r every member knows its ancestors
of up to 2**r levels and those exactly 2**r levels up, so a hierarchy of depth
d takes about log2(d) rounds of equi-joins, whatever its size. A round's result
is written to the shared folder (lineage cut); the driver learns only whether
there is more to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.sinks.files import staged


def _edges(team: DataFrame, key: str, parent: str) -> DataFrame:
    """(member, above): the distinct links; a member that names itself, nobody
    or someone who is not in the team is at the top."""
    links = team.select(F.col(key).alias("member"), F.col(parent).alias("above")).where("member <> above").distinct()
    known = team.select(F.col(key).alias("above")).distinct()
    return links.join(known, "above", "left_semi").select("member", "above")


def cyclic_members(team: DataFrame, key: str = "id", parent: str = "manager_id") -> DataFrame:
    """(member): those whose chain of managers runs into a cycle and never ends.

    The links exactly 2**r levels up are joined with themselves; beyond as many
    levels as there are links, only endless chains have any."""
    jump = staged(_edges(team, key, parent), "jump")
    longest, levels = jump.count(), 1
    while levels <= longest:
        if jump.isEmpty():
            break
        further = jump.select(F.col("member").alias("above"), F.col("above").alias("further"))
        jump = staged(jump.join(further, "above").select("member", F.col("further").alias("above")).distinct(), "jump")
        levels *= 2
    return jump.select("member").distinct()


def ancestors(team: DataFrame, key: str = "id", parent: str = "manager_id") -> DataFrame:
    """(member, ancestor, level): every manager above each member, level 1 the
    own one (the smallest level, if several ways lead there). Members whose
    chain runs into a cycle have no rows (``cyclic_members`` lists them); an
    empty team gives none."""
    endless = cyclic_members(team, key, parent)
    jump = staged(_edges(team, key, parent).join(endless, "member", "left_anti"), "jump")
    reach = staged(jump.select("member", F.col("above").alias("ancestor"), F.lit(1).alias("level")), "reach")
    levels = 1
    while not jump.isEmpty():
        up = jump.select("member", F.col("above").alias("via"))
        beyond = (up.join(reach.select(F.col("member").alias("via"), "ancestor", "level"), "via")
                  .select("member", "ancestor", (F.col("level") + levels).alias("level")))
        reach = staged(reach.unionByName(beyond).groupBy("member", "ancestor")
                       .agg(F.min("level").alias("level")), "reach")
        further = jump.select(F.col("member").alias("above"), F.col("above").alias("further"))
        jump = staged(jump.join(further, "above").select("member", F.col("further").alias("above")).distinct(), "jump")
        levels *= 2
    return reach


def rollup(totals: DataFrame, team: DataFrame, member: str = "sales_person_id", amount: str = "total_sales",
           key: str = "id", parent: str = "manager_id") -> DataFrame:
    """Per manager with sales below: manager_id, team_total (of all levels below,
    the own sales left out), members (with sales), levels (the deepest with sales).

    totals may have several rows a member; they are summed first."""
    own = totals.groupBy(F.col(member).alias("member")).agg(F.sum(amount).alias("amount"))
    return (own.join(ancestors(team, key, parent), "member").groupBy(F.col("ancestor").alias("manager_id"))
            .agg(F.sum("amount").alias("team_total"), F.count(F.lit(1)).alias("members"),
                 F.max("level").cast("bigint").alias("levels")))
