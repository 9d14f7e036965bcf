"""Dimension tables from Parquet or JDBC, conformed to their contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.sinks.jdbc import read_jdbc, read_jdbc_balanced


def conform_to(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select the contract's columns by (case-insensitive) name and cast them;
    a column the source lacks is NULL of its type."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
        .cast(f.dataType).alias(f.name) for f in contract.fields])


def read_dim(spark: SparkSession, uri: str, contract: T.StructType,
             jdbc_properties: dict | None = None, table: str | None = None,
             partition_column: str | None = None, num_partitions: int = 8) -> DataFrame:
    """A dimension at ``uri``: a Parquet folder, or a JDBC URL plus ``table``
    (read by several tasks in ranges of ``partition_column``
    with about equal rows, if one is named)."""
    if uri.startswith("jdbc:"):
        properties = dict(jdbc_properties or {})
        if partition_column:
            df = read_jdbc_balanced(spark, uri, table, partition_column, num_partitions, properties)
        else:
            df = read_jdbc(spark, uri, table, properties)
    else:
        df = spark.read.parquet(uri)
    return conform_to(df, contract)
