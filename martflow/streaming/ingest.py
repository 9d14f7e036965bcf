"""File-drop ingestion as a Structured Streaming query.

The file source tracks which files it has handed out in the checkpoint, so
each drop is processed once even across restarts; every micro-batch runs the
batch job over just its new files. The batch id is the run id, and every
sink of a run overwrites that run's folder, so a batch replayed after a
failure rewrites the same outputs instead of appending twice.

``cleanSource=archive`` moves a processed file to the archive folder (the
move happens in a later micro-batch; the checkpoint, not the move, is what
guarantees exactly-once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martflow.plans.batch_job import Dimensions, Layout, run_files
from martflow.sinks.jdbc import JdbcTarget
from martflow.sources.files import LISTING

# The binaryFile source's fixed schema (content is never selected, so never read).
BINARY_FILE = ("path string, modificationTime timestamp, length bigint, content binary")
MAX_AGE = "36500d"  # the source would skip files that are older than its newest by a week


def file_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None,
                archive_dir: str | None = None) -> DataFrame:
    """New files under ``landing``, at any depth and of any age, as listing rows."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
              .option("recursiveFileLookup", "true").option("maxFileAge", MAX_AGE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = (reader.option("cleanSource", "archive")
                  .option("sourceArchiveDir", archive_dir))
    df = reader.load(landing).select("path", "length", "modificationTime")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return df.select(
        "path", name.alias("file_name"),
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("drop"),
        F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("extension"),
        "length", F.col("modificationTime").alias("modified"))


def start_ingest(spark: SparkSession, landing: str, dims: Dimensions, layout: Layout,
                 checkpoint: str, available_now: bool = True, processing_time: str | None = None,
                 archive_dir: str | None = None, max_files_per_trigger: int | None = None,
                 jdbc: JdbcTarget | None = None) -> StreamingQuery:
    def batch(files: DataFrame, batch_id: int) -> None:
        run_files(spark, files.select(*[f.name for f in LISTING.fields]), dims, layout,
                  f"batch-{batch_id:012d}", jdbc)

    writer = (file_stream(spark, landing, max_files_per_trigger, archive_dir)
              .writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
