"""File sinks: plain, partitioned and bucketed Parquet, stamped with a run.

Layouts:

* every output of a run lives under ``<root>/run_id=<id>/``. An output of its
  own (``publish_run``) is recorded in ``<root>/_runs`` only after all its files
  are committed; the outputs of a store (see ``commits``) become visible
  together by the store's one record a run. ``latest_run`` and ``all_runs``
  read recorded runs only, so a run that died half way is never read;
* partitioned writes go through AQE's ``rebalance`` so each partition folder
  gets a few well-sized files, and a hot partition is split across tasks
  instead of landing in one writer;
* bucketed writes are rebalanced by the bucket key first, so each writer
  holds few buckets and a hot key is split across writers.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.session import work_dir
from martflow.sinks import commits

RUNS = "_runs"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written to the shared work folder and read back: a
    lineage cut that survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """Hive-style partition folders."""
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, by: str,
                   mode: str = "overwrite") -> None:
    """A bucketed, sorted Parquet table at an explicit path (joins and
    aggregations on ``by`` with the same bucket count read it without a
    shuffle).

    The rows are rebalanced by the bucket key first: the shuffle hashes like
    the buckets do, so a writer task holds few buckets (few files per bucket),
    and AQE splits a hot key's partition over several writers instead of one
    task writing a third of the table (a bucket may then have several files,
    which readers handle)."""
    (df.hint("rebalance", by).write.mode(mode)
     .bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(table))


def append_bucketed(spark: SparkSession, df: DataFrame, table: str, path: str, buckets: int,
                    by: str, run_id: str) -> None:
    """The rows as partition ``run_id`` of one bucketed table for all runs; a
    replay of the run replaces its partition."""
    if not spark.catalog.tableExists(table):
        (df.withColumn("run_id", F.lit(run_id)).limit(0).write.partitionBy("run_id")
         .bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(table))
    # one named partition is overwritten, so those of other runs stay
    columns = ", ".join(f"`{c}`" for c in df.columns)
    literal = run_id.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (run_id = '{literal}') "
              f"SELECT {columns} FROM {{rows}}", rows=df.hint("rebalance", by))


def new_run_id(at: _dt.datetime | None = None) -> str:
    ts = at or _dt.datetime.now(_dt.timezone.utc)
    return ts.strftime("%Y%m%dT%H%M%S%fZ")


def run_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/run_id={run_id}"


def publish_run(spark: SparkSession, df: DataFrame, root: str, run_id: str,
                partition_by: list[str] | None = None) -> None:
    """Write ``df`` as run ``run_id`` of ``root`` (overwriting a replay of
    the same run), then record the run as committed."""
    target = run_path(root, run_id)
    if partition_by:
        write_partitioned(df, target, partition_by)
    else:
        write_parquet(df, target)
    commit_run(spark, root, run_id)


def commit_run(spark: SparkSession, root: str, run_id: str) -> None:
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    (spark.createDataFrame([(run_id, now)], "run_id string, committed_at timestamp")
     .write.mode("append").parquet(f"{root.rstrip('/')}/{RUNS}"))


def _store_of(root: str) -> tuple[str, str]:
    """The store that an output at root would belong to, and its name there."""
    store, _, output = root.rstrip("/").rpartition("/")
    return store, output


def committed_runs(spark: SparkSession, root: str) -> DataFrame:
    """run_id, committed_at of every commit of root's own, or of its store with
    a version of root; empty before the first."""
    schema = "run_id string, committed_at timestamp"
    try:
        own = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{RUNS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        own = spark.createDataFrame([], schema)
    store, output = _store_of(root)
    named = commits.log(spark, store).where((F.col("output") == output) & (F.col("version") == F.col("run_id")))
    return own.unionByName(named.select("run_id", "committed_at").distinct())


def is_committed(spark: SparkSession, root: str, run_id: str) -> bool:
    return not committed_runs(spark, root).where(F.col("run_id") == run_id).isEmpty()


def _last(runs: DataFrame) -> str | None:
    return runs.agg(F.max_by("run_id", F.struct("committed_at", "run_id")).alias("r")).first()["r"]


def _read_run(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    return spark.read.option("basePath", root).parquet(run_path(root, run_id)).drop("run_id")


def latest_run(spark: SparkSession, root: str) -> DataFrame:
    """The rows of root as of the run committed last: those folders alone."""
    store, output = _store_of(root)
    newest = commits.last(spark, store)
    if newest is not None:
        named = commits.parts(spark, store, newest, output)
        if not named:
            raise ValueError(f"no rows under {root} as of run {newest}")
        return commits.read_parts(spark, store, named)
    last = _last(committed_runs(spark, root))
    if last is None:
        raise ValueError(f"no committed run under {root}")
    return _read_run(spark, root, last)


def all_runs(spark: SparkSession, root: str) -> DataFrame:
    """The rows of every committed run of ``root``, each run once."""
    ids = sorted({r["run_id"] for r in committed_runs(spark, root).select("run_id").distinct()
                  .toLocalIterator()})
    if not ids:
        raise ValueError(f"no committed run under {root}")
    return (spark.read.option("basePath", root).parquet(*[run_path(root, i) for i in ids])
            .drop("run_id"))
