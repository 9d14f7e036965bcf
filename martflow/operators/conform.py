"""Conform validated drops to the canonical sales fact.

One scan reads the lines of all valid files, however many different headers
they have. A small table says for each file where its header has each contract
column and where the others, by name; joined to the lines by path (Spark
broadcasts it if it is under its size limit, else a hot file's lines are split
by AQE), it puts every line's fields into the contract's order. Extra columns
are folded into ``additional_column`` (names sorted, NULLs skipped; NULL when
the file has no extras). The plan has one size for any number of headers.
Values stay text until ``validate.typed`` casts them, so a bad value marks its
row instead of changing a column's type.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.contracts import EXTRA_COLUMN, EXTRA_SEPARATOR, MANDATORY_COLUMNS
from martflow.operators.validate import typed
from martflow.sources.files import CORRUPT, read_lines, split_fields


def _places(spark: SparkSession, checked: DataFrame, contract: list[str]
            ) -> tuple[list[str], int, DataFrame]:
    """(valid files, most columns of one, the table of places): per file its
    width, the position of each contract column, and of the extra columns by
    name (null if none). The driver holds the files' paths, as Spark's own
    file index of the scan does."""
    paths, widths, at, extras = [], [], [], []
    for r in checked.where("valid").select("path", "norm_columns").toLocalIterator():
        place = {name: i for i, name in enumerate(r["norm_columns"])}
        paths.append(r["path"])
        widths.append(len(place))
        at.append([place[c] for c in contract])
        extras.append([place[c] for c in sorted(place.keys() - set(contract))] or None)
    table = pa.table({"source_file": pa.array(paths, pa.string()), "width": pa.array(widths, pa.int32()),
                      "at": pa.array(at, pa.list_(pa.int32())),
                      "extras": pa.array(extras, pa.list_(pa.int32()))})
    # from Arrow, so that Spark knows the table's size
    return paths, max(widths, default=0), spark.createDataFrame(table)


def conform_text(spark: SparkSession, checked: DataFrame,
                 contract: list[str] = MANDATORY_COLUMNS) -> DataFrame | None:
    """The lines of every valid file: contract columns as text,
    additional_column, source_file, drop, and the parse-error column (the line,
    if it has more or fewer fields than its header or an open quote).

    Columns are bound by their position in the header, so an extra column may
    have any name. A line of a file that is not in the table of places (it
    cannot be, unless a path is spelt in two ways) ends the job."""
    paths, widest, places = _places(spark, checked, contract)
    if not paths:
        return None
    # what follows from a file's path is worked out once a file, not once a line
    places = places.withColumn("drop", F.regexp_extract("source_file", r"/([^/]+)/[^/]+$", 1))
    lines = read_lines(spark, sorted(paths)).join(places, "source_file", "left")
    width = F.coalesce("width", F.raise_error(F.concat(F.lit("no header known of "), "source_file")).cast("int"))
    rows = split_fields(lines.withColumn("width", width), widest)
    folded = F.array_join(F.transform("extras", lambda i: F.get("fields", i)), EXTRA_SEPARATOR)
    return rows.select(*[F.get("fields", F.get("at", F.lit(i))).alias(c) for i, c in enumerate(contract)],
                       folded.alias(EXTRA_COLUMN), CORRUPT, "source_file", "drop")


def conform_typed(spark: SparkSession, checked: DataFrame,
                  contract: list[str] = MANDATORY_COLUMNS) -> DataFrame:
    """Every row once: the text columns, their typed values and ``is_bad``."""
    text = conform_text(spark, checked, contract)
    if text is None:
        raise ValueError("no valid file to process")
    return typed(text)


def split_typed(t: DataFrame, contract: list[str] = MANDATORY_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(good rows in the contract types, bad rows with the failing columns).

    ``is_bad`` may come back from a partitioned folder as text; it is cast."""
    t = t.withColumn("is_bad", F.col("is_bad").cast("boolean"))
    good = (t.where(~F.col("is_bad"))
            .select(*[F.col(f"typed_{c}").alias(c) for c in contract],
                    EXTRA_COLUMN, "source_file", "drop"))
    bad = t.where(F.col("is_bad")).select(*contract, EXTRA_COLUMN, "bad_columns",
                                          F.col(CORRUPT).alias("raw_line"), "source_file", "drop")
    return good, bad


def conform(spark: SparkSession, checked: DataFrame,
            contract: list[str] = MANDATORY_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows); each use re-reads the CSVs, so a job that needs
    both stages ``conform_typed`` once (see ``plans.batch_job``)."""
    return split_typed(conform_typed(spark, checked, contract), contract)
