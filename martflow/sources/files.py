"""File drops: listing, header inventory and header-aware CSV reads.

* ``list_files``: Spark's own file index (``binaryFile`` with the content
  column pruned), so listing is paginated, recursive and parallel; hidden
  and ``_``-prefixed files are skipped as for any Spark source.
* ``read_headers``: the first line of every file, read on the executors
  (``mapInPandas`` over the listing, a bounded number of bytes per file). A
  ``spark.read.text`` of the drop would scan every byte to keep one line. The
  files are opened with pyarrow, so its credentials must reach the store.
* ``read_lines``: the data lines of any number of files as text in one scan,
  whatever their headers; ``split_fields`` cuts a line into its fields.

A file is known by its listed path; ``plain_path`` brings the encoded path of
``_metadata`` into that form, ``literal_path`` quotes a path's glob characters.
"""

from __future__ import annotations

import csv
import io
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The header reader runs in Python workers: ship this module's functions by
# value, so executors need pandas/pyarrow but not this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADER_BYTES = 1 << 16
CORRUPT = "corrupt_line"  # beside columns named c0, c1, ...: no header's name clashes

LISTING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("drop", T.StringType()),
    T.StructField("extension", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
])

HEADERS = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("header", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
])


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """path, file_name, drop (parent folder), extension, length, modified."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(root).select("path", "length", "modificationTime")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return df.select(
        "path", name.alias("file_name"),
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("drop"),
        F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("extension"),
        "length", F.col("modificationTime").alias("modified"))


def plain_path(path: F.Column) -> F.Column:
    """An encoded ``_metadata.file_path`` as a listing writes it."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def literal_path(path: str) -> str:
    """path for a reader that takes globs, its glob characters quoted."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _open(path: str):
    """Open a Spark-listed path (not encoded) with pyarrow's filesystem layer
    (local, HDFS, S3; Hadoop's s3a/s3n spellings map to s3)."""
    from pyarrow import fs as pafs
    scheme, _, rest = path.partition(":")
    if scheme == "file" or path.startswith("/"):
        return pafs.LocalFileSystem().open_input_stream("/" + path.removeprefix("file:").lstrip("/"))
    authority, _, inner = rest.lstrip("/").partition("/")
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    filesystem, base = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return filesystem.open_input_stream(f"{base.rstrip('/')}/{inner}")


MAX_HEADER_BYTES = 16 << 20


def first_line(path: str, chunk: int = HEADER_BYTES) -> str | None:
    """The file's first line, read in chunks up to the first newline (a very
    wide header is read whole); None if it does not end within 16 MB: such a
    file has no header and is quarantined."""
    buf = b""
    with _open(path) as f:
        while b"\n" not in buf:
            part = f.read(chunk)
            if not part:
                break
            buf += part
            if len(buf) > MAX_HEADER_BYTES:
                return None
    text = buf.split(b"\n", 1)[0].decode("utf-8-sig", errors="replace")
    return text.rstrip("\r")


def parse_header(line: str) -> list[str]:
    row = next(csv.reader(io.StringIO(line)), [])
    return [c for c in row]


def _headers_batch(batches):
    for pdf in batches:
        lines = [first_line(p) for p in pdf["path"]]
        yield pd.DataFrame({"path": pdf["path"].values, "header": lines,
                            "columns": [None if x is None else parse_header(x) for x in lines]})


def read_headers(files: DataFrame) -> DataFrame:
    """One row per file: its raw header line and parsed column names."""
    return files.select("path").mapInPandas(_headers_batch, HEADERS)


def normalized(columns: F.Column) -> F.Column:
    """lower(trim(name)) for every header name (case-only differences match)."""
    return F.transform(columns, lambda c: F.lower(F.trim(c)))


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every line of the files but their headers and blank lines: line, and
    the path (source_file). One scan: the reader splits large files and packs
    small ones. A separator that no text has leaves a line whole (a line that
    does hold it comes from the corrupt column)."""
    schema = T.StructType([T.StructField("line", T.StringType()), T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema)
            .option("header", "true").option("enforceSchema", "true")
            .option("sep", "\u0001").option("quote", "")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .csv([literal_path(p) for p in paths])
            .select(F.coalesce(CORRUPT, "line").alias("line"),
                    plain_path(F.col("_metadata.file_path")).alias("source_file")))


END = "\u0002end"  # put behind a line as one more field: where it is found, the line ends


def split_fields(lines: DataFrame, widest: int) -> DataFrame:
    """Adds ``fields`` (array, ``widest`` of them at least; null where the line
    has none) and ``CORRUPT``: the line if it has not exactly ``width`` fields
    or a quote that does not close, else null. Takes line and width.

    The line is cut and its fields are put in an array by generators, since
    the optimizer would repeat either for every column that is taken from it."""
    n = widest + 2
    cut = F.from_csv(F.concat("line", F.lit("," + END)), ", ".join(f"f{i} string" for i in range(n)),
                     {"mode": "PERMISSIVE", "maxColumns": str(max(20480, n))})
    rows = (lines.select("*", F.inline(F.array(cut)))
            .select(*lines.columns, F.explode(F.array(F.array(*[f"f{i}" for i in range(n)]))).alias("cut")))
    whole = F.coalesce((F.get("cut", "width") == END) & F.get("cut", F.col("width") + 1).isNull(), F.lit(False))
    clean = F.transform("cut", lambda f: F.when(f != END, F.replace(f, F.lit("," + END))))
    return rows.select(*lines.columns, F.when(~whole, F.col("line")).alias(CORRUPT),
                       F.when(whole, F.col("cut")).otherwise(clean).alias("fields"))
