"""Drop validation: extension, mandatory columns, value types, data checks.

Everything stays a DataFrame: the header check is ``array_except`` on the
normalised names, quarantine is a report plus the raw lines of the rejected
files, and bad rows are the rows whose text does not cast to the contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.contracts import MANDATORY_COLUMNS, SALES_FACT
from martflow.sources.files import CORRUPT, literal_path, normalized, plain_path


def split_by_extension(files: DataFrame, accepted: tuple[str, ...] = (".csv",)) -> DataFrame:
    """Adds ``accepted``: the file's extension is one of ``accepted``."""
    return files.withColumn("accepted", F.col("extension").isin(*accepted))


def check_headers(headers: DataFrame, contract: list[str] = MANDATORY_COLUMNS) -> DataFrame:
    """Per file: normalised columns, missing contract columns, extras, duplicates, valid.

    Names are compared after lower(trim()); a name that appears twice after
    normalising (``Price`` and ``price``) makes the file ambiguous. A file
    without a header (a first line that does not end) misses every column.
    """
    want = F.array(*[F.lit(c) for c in contract])
    cols = F.coalesce(normalized(F.col("columns")), F.expr("cast(array() as array<string>)"))
    return (headers
            .withColumn("norm_columns", cols)
            .withColumn("missing", F.array_sort(F.array_except(want, F.col("norm_columns"))))
            .withColumn("extras", F.array_sort(F.array_except(F.col("norm_columns"), want)))
            .withColumn("duplicated",
                        F.size(F.col("norm_columns")) != F.size(F.array_distinct("norm_columns")))
            .withColumn("valid", (F.size("missing") == 0) & ~F.col("duplicated")))


def quarantine_report(listing: DataFrame, checked: DataFrame) -> DataFrame:
    """Rejected files with the reason: extension, missing columns or ambiguity."""
    by_ext = (listing.where(~F.col("accepted"))
              .select("path", "drop", F.lit("extension").alias("reason"),
                      F.lit(None).cast("array<string>").alias("missing")))
    by_cols = (checked.where(~F.col("valid"))
               .select("path", "drop",
                       F.when(F.col("header").isNull(), F.lit("no header"))
                        .when(F.col("duplicated"), F.lit("ambiguous columns"))
                        .otherwise(F.lit("missing columns")).alias("reason"),
                       "missing"))
    return by_ext.unionByName(by_cols)


def quarantine_lines(spark: SparkSession, report: DataFrame) -> DataFrame:
    """The raw lines of rejected files, tagged with the reason (to keep under
    an error folder). One text read per reason, the reason a literal: no join
    of lines to files, so one huge rejected file is read by many tasks."""
    by_reason: dict[str, list[str]] = {}
    for r in report.select("path", "reason").toLocalIterator():
        by_reason.setdefault(r["reason"], []).append(r["path"])
    parts = [spark.read.text([literal_path(p) for p in sorted(paths)])
             .select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("line"),
                     F.lit(reason).alias("reason"))
             for reason, paths in sorted(by_reason.items())]
    if not parts:
        return spark.createDataFrame([], "path string, line string, reason string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def typed(df: DataFrame, schema=SALES_FACT, columns: list[str] = MANDATORY_COLUMNS) -> DataFrame:
    """Cast text columns to the contract with ``try_cast`` and flag the rows
    where a non-empty value did not cast, would be rounded (money with a third
    decimal), or the line did not parse."""
    types = {f.name: f.dataType for f in schema.fields}
    money = [c for c in columns if isinstance(types[c], T.DecimalType)]
    # cast by a generator, so that the checks, the filters and the typed columns share one cast of each value
    cast = F.struct(*[F.col(c).try_cast(types[c]).alias(f"typed_{c}") for c in columns],
                    *[F.col(c).try_cast(T.DecimalType(38, 18)).alias(f"exact_{c}") for c in money])
    rows = df.select("*", F.inline(F.array(cast)))

    def fails(c: str) -> F.Column:
        value = F.col(f"typed_{c}")
        bad = value.isNull()
        if c in money:
            exact = F.col(f"exact_{c}")
            bad = bad | exact.isNull() | (exact != value)
        return F.col(c).isNotNull() & bad

    bad_cols = F.array_compact(F.array(*[F.when(fails(c), F.lit(c)) for c in columns]))
    is_bad = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    for c in columns:
        is_bad = is_bad | fails(c)
    return rows.select(*df.columns, bad_cols.alias("bad_columns"), is_bad.alias("is_bad"),
                       *[f"typed_{c}" for c in columns])


def total_cost_check(fact: DataFrame, by: list[str]) -> DataFrame:
    """Rows where total_cost differs from price * quantity (report only)."""
    differs = (F.col("total_cost") != F.col("price") * F.col("quantity"))
    return (fact.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count(F.when(differs, 1)).alias("mismatched"),
                 F.count(F.when(F.col("total_cost").isNull() | F.col("price").isNull()
                                | F.col("quantity").isNull(), 1)).alias("incomplete")))


def price_check(fact: DataFrame, product: DataFrame) -> DataFrame:
    """Per product name: sales, and those at a price that no product of that
    name lists (report only; names may repeat, and an unknown name lists none)."""
    sold = fact.groupBy("product_name", "price").agg(F.count(F.lit(1)).alias("n"))
    listed = product.select(F.col("name").alias("product_name"),
                            F.col("current_price").cast("decimal(18,2)").alias("price")).distinct()
    known = sold.join(listed.withColumn("known", F.lit(True)), ["product_name", "price"], "left")
    return known.groupBy("product_name").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("off_list"))
