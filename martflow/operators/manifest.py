"""The file manifest as an append-only event log.

The job this replaces kept one mutable row per file in a database and
flipped it from 'A' (picked up) to 'I' (committed) with UPDATEs. Plain
Parquet has no UPDATE, and an update-in-place is not safe when a run dies
half way, so every state change is an appended event and the current state
is the latest event per file:

    latest = max_by(state, (event_ts, tiebreak)) per file_name

``max_by`` is an ordinary aggregate with a partial phase, so a file with
millions of events costs one row per map task before the shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.contracts import (MANIFEST, STATUS_ACTIVE, STATUS_INACTIVE, STATUS_QUARANTINED,
                                empty)


def latest(log: DataFrame, key: str = "file_name",
           order: tuple[str, ...] = ("event_ts", "run_id", "status"),
           carry: tuple[str, ...] = ("status", "file_location", "event_ts", "run_id")) -> DataFrame:
    """Current state per key: the carried columns of its latest event."""
    state = F.max_by(F.struct(*[F.col(c) for c in carry]), F.struct(*[F.col(c) for c in order]))
    return (log.groupBy(key).agg(state.alias("__s"))
            .select(key, *[F.col(f"__s.{c}").alias(c) for c in carry]))


def active(log: DataFrame, **kw) -> DataFrame:
    """Files whose latest event is 'A': picked up but never committed
    (an interrupted run left them behind)."""
    return latest(log, **kw).where(F.col("status") == STATUS_ACTIVE)



def completed(log: DataFrame, **kw) -> DataFrame:
    return latest(log, **kw).where(F.col("status") == STATUS_INACTIVE)


def settled(log: DataFrame, **kw) -> DataFrame:
    """Files whose latest state is final: committed or quarantined."""
    return latest(log, **kw).where(F.col("status").isin(STATUS_INACTIVE, STATUS_QUARANTINED))


def committed(log: DataFrame, runs: DataFrame) -> DataFrame:
    """The events that hold: pick-ups, and final states of committed runs. A
    run that died before its commit settled nothing, whatever it wrote."""
    done = runs.select(F.col("run_id").alias("__run")).distinct()
    final = log.where(F.col("status") != STATUS_ACTIVE)
    return (log.where(F.col("status") == STATUS_ACTIVE)
            .unionByName(final.join(done, final["run_id"] == done["__run"], "left_semi")))


def pending(candidates: DataFrame, log: DataFrame, key: str = "file_name",
            log_key: str = "file_name", **kw) -> DataFrame:
    """Candidate files not yet settled: a rerun of the same drop selects nothing."""
    done = settled(log, key=log_key, **kw).select(F.col(log_key).alias("__done"))
    return candidates.join(done, candidates[key] == done["__done"], "left_anti")


def events(files: DataFrame, status: str, run_id: str,
           at: _dt.datetime | None = None) -> DataFrame:
    """Manifest events for a set of files (columns file_name, file_location)."""
    ts = at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return files.select(
        F.col("file_name").cast("string"),
        F.col("file_location").cast("string"),
        F.lit(status).alias("status"),
        F.lit(ts).cast("timestamp").alias("event_ts"),
        F.lit(run_id).alias("run_id"))


def record(spark: SparkSession, log_path: str, files: DataFrame, status: str,
           run_id: str, at: _dt.datetime | None = None) -> None:
    """Append one event per file to the Parquet log (no read-modify-write)."""
    events(files, status, run_id, at).write.mode("append").parquet(log_path)


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The log, empty before the first event (any other failure is raised)."""
    try:
        return spark.read.schema(MANIFEST).parquet(log_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, MANIFEST)
