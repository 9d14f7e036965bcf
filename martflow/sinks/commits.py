"""One commit record per run: the only thing that makes a run's outputs visible.

A store is the folder of one deployment. Its runs write their outputs below
``<store>/<output>/run_id=<id>/`` in any order; a run's last write appends one
record to ``<store>/_commits`` that names every output with the version (the
run) that holds it, month folders one by one. A month that a run does not touch
is carried by reference: its row names the run that wrote it last. Readers, the
manifest's settled files and the totals of the next run all go through the
newest record, so a run that dies at any point before it has done nothing, and
its files are taken again by the next run.

A record is one Parquet file, renamed into place by the commit protocol, so it
is there as a whole or not at all. A store has one writer at a time.

``Steps`` is the ledger of a run's finished steps: a run that is resumed under
its id does not repeat them. Steps that build on the run before carry its id in
their name; if files of an interrupted run were taken by another one meanwhile,
the run starts a new attempt.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"
STEPS = "_steps"
SCHEMA = "run_id string, committed_at timestamp, output string, part string, version string"
STEP_SCHEMA = "run_id string, attempt int, step string"


class Part(NamedTuple):
    """A folder of an output: ``part`` below the run ``version`` (None: all of it)."""
    output: str
    part: str | None
    version: str


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def log(spark: SparkSession, store: str) -> DataFrame:
    """run_id, committed_at, output, part, version of every record, empty before the first."""
    return _read(spark, f"{store}/{COMMITS}", SCHEMA)


def runs(spark: SparkSession, store: str) -> DataFrame:
    """run_id, committed_at of every committed run."""
    return log(spark, store).select("run_id", "committed_at").distinct()


def last(spark: SparkSession, store: str) -> str | None:
    return runs(spark, store).agg(F.max_by("run_id", F.struct("committed_at", "run_id")).alias("r")).first()["r"]


def is_committed(spark: SparkSession, store: str, run_id: str) -> bool:
    return not log(spark, store).where(F.col("run_id") == run_id).isEmpty()


def parts(spark: SparkSession, store: str, run_id: str | None, output: str | None = None) -> list[Part]:
    """What the record of a run names (of one output): folders, a control value."""
    rows = log(spark, store).where(F.col("run_id") == run_id)
    if output is not None:
        rows = rows.where(F.col("output") == output)
    return sorted((Part(r["output"], r["part"], r["version"]) for r in
                   rows.select("output", "part", "version").distinct().toLocalIterator()),
                  key=lambda p: (p.output, p.part or "", p.version))


def commit(spark: SparkSession, store: str, run_id: str, named: list[Part]) -> None:
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(run_id, now, p.output, p.part, p.version) for p in named]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{store}/{COMMITS}")


def read_parts(spark: SparkSession, store: str, named: list[Part]) -> DataFrame:
    """The rows of these folders of one output, without run_id."""
    root = f"{store}/{named[0].output}"
    paths = [f"{root}/run_id={p.version}" + (f"/{p.part}" if p.part else "") for p in named]
    return spark.read.option("basePath", root).parquet(*paths).drop("run_id")


def begun(spark: SparkSession, store: str) -> DataFrame:
    """run_id of every run that finished a step."""
    return _read(spark, f"{store}/{STEPS}", STEP_SCHEMA).select("run_id").distinct()


class Steps:
    """The finished steps of a run's current attempt."""

    def __init__(self, spark: SparkSession, store: str, run_id: str):
        self.spark, self.path, self.run_id = spark, f"{store}/{STEPS}", run_id
        rows = _read(spark, self.path, STEP_SCHEMA).where(F.col("run_id") == run_id).collect()
        self.attempt = max((r["attempt"] for r in rows), default=0)
        self.done = {r["step"] for r in rows if r["attempt"] == self.attempt}

    def renew(self) -> None:
        self.attempt, self.done = self.attempt + 1, set()

    def run(self, step: str, write: Callable[[], None]) -> None:
        """Do the step unless it is done. ``write`` overwrites what a dead
        attempt of it may have left."""
        if step in self.done:
            return
        write()
        (self.spark.createDataFrame([(self.run_id, self.attempt, step)], STEP_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.path))
        self.done.add(step)
