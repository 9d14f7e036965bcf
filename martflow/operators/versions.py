"""Contents of dropped files, and signed changes of totals.

What counts is a file's content, not its name. The content of a file is its
normalised header and the multiset of its data lines, as a digest that tasks
compute from line hashes and Spark adds up, so a huge file is digested by many
tasks and the order of its lines does not matter. Two copies of a file are one
content; a corrected file is a content that goes and one that comes.

Totals follow as signed rows: +1 for the rows of a content that came, -1 for
those of one that went, as they were stored when they came (dimensions may have
changed since). ``changed_totals`` adds them to the totals held. A total is kept
with its number of rows, so that one without rows vanishes, and its number of
amounts, so that one with null amounts alone is null, as a fresh sum would be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.sources.files import read_lines

COUNTS = ("n_rows", "n_amounts")


def _halves(h: Column, name: str) -> list[Column]:
    """Sums of the upper and the lower 32 bits: no sum of fewer than 2^31 lines overflows."""
    return [F.sum(F.shiftrightunsigned(h, 32)).alias(f"{name}_hi"),
            F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"{name}_lo")]


def contents(spark: SparkSession, checked: DataFrame) -> DataFrame:
    """path, content of every valid file of a header check. A file without a
    data line has the content of its header alone."""
    files = checked.where("valid").select("path", F.to_json("norm_columns").alias("head"))
    paths = sorted(r["path"] for r in files.select("path").toLocalIterator())  # as the scan's file index
    if not paths:
        return files.select("path", F.lit("").alias("content"))
    sums = ["n", "a_hi", "a_lo", "b_hi", "b_lo"]
    per_file = (read_lines(spark, paths).groupBy("source_file")
                .agg(F.count(F.lit(1)).alias("n"), *_halves(F.xxhash64("line"), "a"),
                     *_halves(F.xxhash64(F.lit("second"), "line"), "b")))
    met = files.join(per_file, files["path"] == per_file["source_file"], "left")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in sums]
    return met.select("path", F.sha2(F.concat_ws("|", "head", *parts), 256).alias("content"))


def signed_totals(came: DataFrame, went: DataFrame, keys: list[str], amount: str = "total_cost",
                  out: str = "total_sales") -> DataFrame:
    """keys, out, n_rows, n_amounts: what the rows that came add and those that went take."""
    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(*keys, (F.col(amount) * sign).alias(out), F.lit(sign).cast("bigint").alias("n_rows"),
                           F.when(F.col(amount).isNull(), 0).otherwise(sign).cast("bigint").alias("n_amounts"))
    return _added(signed(came, 1).unionByName(signed(went, -1)), keys, out)


def _added(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(out).alias(out), *[F.sum(c).alias(c) for c in COUNTS])


def changed_totals(held: DataFrame, change: DataFrame, keys: list[str], out: str = "total_sales") -> DataFrame:
    """The totals after a change; keys without rows left are gone."""
    columns = [*keys, out, *COUNTS]
    after = _added(held.select(columns).unionByName(change.select(columns)), keys, out)
    return (after.where(F.col("n_rows") != 0)
            .withColumn(out, F.when(F.col("n_amounts") != 0, F.col(out))))
