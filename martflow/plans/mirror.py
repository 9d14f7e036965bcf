"""Marts that mirror a drop folder: corrected, copied and withdrawn files.

The batch job takes a path once. Here the files that lie in the folder *now* are
the truth: ``sync`` brings the stored facts and totals to what a single run over
the present valid files would give, each content counted once however many
copies of it lie there.

    listing -> files unchanged by (path, length, modified) keep their content;
    only others are read -> contents (see ``operators.versions``)
    -> contents that came: their rows are parsed from one of their files (the
       smallest path), joined to the dimensions and stored with their content
    -> contents that went: their rows as they were stored
    -> signed totals, added to those held: only the months that the change
       touches are written, the others are carried by reference
    -> one commit record (see ``sinks.commits``)

A sync that dies before its record has done nothing. A store has one writer at a
time. The driver holds paths of the files that changed (as Spark's own file
index does), run ids and months.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.contracts import CUSTOMER_MART, SALES_TEAM_MART, empty
from martflow.operators import conform as C
from martflow.operators import marts as M
from martflow.operators import validate as V
from martflow.operators import versions as VS
from martflow.plans.batch_job import HIVE_NULL, Dimensions
from martflow.sinks import commits as CM
from martflow.sinks import files as SK
from martflow.sources import files as FS

FILES = "path string, length bigint, modified timestamp, content string, version string"
FACT_COLUMNS = ("customer_id", "store_id", "sales_person_id", "sales_date", "total_cost")


@dataclass(frozen=True)
class Grain:
    """One family of totals: its folder, its keys and its month column."""
    name: str
    keys: tuple[str, ...]
    month: str

    @property
    def by(self) -> list[str]:
        return [*self.keys, self.month]


CUSTOMER = Grain("customer_totals", ("customer_id",), "sales_date_month")
SALES = Grain("sales_totals", ("store_id", "sales_person_id"), "sales_month")


def _run(store: str, output: str, run_id: str) -> str:
    return SK.run_path(f"{store}/{output}", run_id)


def _named(spark: SparkSession, store: str, output: str) -> list[CM.Part]:
    return CM.parts(spark, store, CM.last(spark, store), output)


def files(spark: SparkSession, store: str) -> DataFrame:
    """The valid files as of the last sync: path, length, modified, content and
    the version (run) that stored the content's rows; empty before the first."""
    named = _named(spark, store, "files")
    if not named:
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).parquet(*[_run(store, "files", p.version) for p in named])


def _rows(spark: SparkSession, store: str, live: DataFrame) -> DataFrame:
    """The stored rows of these (content, version): only the versions' folders are read."""
    versions = sorted(r[0] for r in live.select("version").distinct().toLocalIterator())
    if not versions:
        return _no_rows(spark)
    root = f"{store}/facts"
    rows = spark.read.option("basePath", root).parquet(*[_run(store, "facts", v) for v in versions])
    rows = rows.withColumn("version", F.col("run_id").cast("string")).drop("run_id")
    return rows.join(live.select("content", "version").distinct(), ["content", "version"], "left_semi")


def _no_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "content string, customer_id bigint, store_id bigint, sales_person_id bigint, "
                                     "sales_date date, total_cost decimal(18,2), version string")


def facts(spark: SparkSession, store: str) -> DataFrame:
    """The enriched rows of the present contents, each content once."""
    return _rows(spark, store, files(spark, store))


def sync(spark: SparkSession, listing: DataFrame, dims: Dimensions, store: str, run_id: str) -> dict:
    """Bring the store to the files of ``listing`` (``list_files``) as run
    ``run_id``; counts of the contents that came, went and stayed. A run that is
    committed already does nothing."""
    if CM.is_committed(spark, store, run_id):
        return {"run_id": run_id, "came": 0, "went": 0, "kept": files(spark, store).select("content").distinct().count()}
    before = files(spark, store)
    listed = V.split_by_extension(listing)
    same = ["path", "length", "modified"]
    known = listed.where("accepted").select(same).join(before, same)
    fresh = listed.where("accepted").join(known.select("path"), "path", "left_anti")

    # the headers of the files that are to be read, and their contents, each once
    checked_path = _run(store, "checked", run_id)
    (V.check_headers(FS.read_headers(fresh)).join(fresh.select(*same, "drop"), "path")
     .write.mode("overwrite").parquet(checked_path))
    checked = spark.read.parquet(checked_path)
    SK.write_parquet(V.quarantine_report(listed, checked), _run(store, "quarantine", run_id))
    held = before.groupBy("content").agg(F.min("version").alias("version"))
    seen_path = _run(store, "seen", run_id)
    seen = (checked.select(same).join(VS.contents(spark, checked), "path")
            .unionByName(known.select(*same, "content")))
    seen.join(held, "content", "left").select(*same, "content", "version").write.mode("overwrite").parquet(seen_path)
    seen = spark.read.schema(FILES).parquet(seen_path)

    came = seen.where(F.col("version").isNull()).groupBy("content").agg(F.min("path").alias("path"))
    went = held.join(seen.select("content"), "content", "left_anti")
    counts = {"came": came.count(), "went": went.count(),
              "kept": seen.where(F.col("version").isNotNull()).select("content").distinct().count()}
    files_path = _run(store, "files", run_id)
    SK.write_parquet(seen.withColumn("version", F.coalesce("version", F.lit(run_id))), files_path)

    new = _no_rows(spark)
    if counts["came"]:
        _store(spark, checked, came, dims, store, run_id)
        new = _rows(spark, store, came.select("content", F.lit(run_id).alias("version")))
    old = _rows(spark, store, went)
    named = [CM.Part(o, None, run_id) for o in ("files", "quarantine")]
    live = spark.read.schema(FILES).parquet(files_path).select("version").distinct()
    for output in ("facts", "bad_rows"):
        named += [CM.Part(output, None, r[0]) for r in live.toLocalIterator()]
    for grain in (CUSTOMER, SALES):
        named += _change(spark, store, grain, new, old, run_id)
    CM.commit(spark, store, run_id, named)
    return {"run_id": run_id, **counts}


def _store(spark: SparkSession, checked: DataFrame, came: DataFrame, dims: Dimensions, store: str,
           run_id: str) -> None:
    """Parse the files of the contents that came, once, and store their rows."""
    typed_path = _run(store, "typed", run_id)
    one_each = checked.join(came.select("path"), "path", "left_semi")
    (C.conform_typed(spark, one_each)
     .join(came.select(F.col("path").alias("source_file"), "content"), "source_file")
     .write.mode("overwrite").partitionBy("is_bad").parquet(typed_path))
    typed = spark.read.parquet(typed_path)
    # good rows in the contract's types, bad rows as they were read, with their content
    is_bad = F.col("is_bad").cast("boolean")
    good = typed.where(~is_bad).select("content", *[F.col(f"typed_{c}").alias(c) for c in FACT_COLUMNS])
    rows = M.enriched_keys(good, dims.customer, dims.store, dims.team)
    SK.write_parquet(rows.select("content", *FACT_COLUMNS).hint("rebalance", "content"),
                     _run(store, "facts", run_id))
    SK.write_parquet(typed.where(is_bad), _run(store, "bad_rows", run_id))


def _change(spark: SparkSession, store: str, grain: Grain, new: DataFrame, old: DataFrame,
            run_id: str) -> list[CM.Part]:
    """Write the totals of the months that the change touches; the folders that
    the record is to name, those of the other months as they are."""
    change_path = _run(store, f"changed_{grain.name}", run_id)
    month = {"out": grain.month}
    SK.write_parquet(VS.signed_totals(M.with_month(new, **month), M.with_month(old, **month), grain.by), change_path)
    change = spark.read.parquet(change_path)
    touched = {f"{grain.month}={HIVE_NULL if r[0] is None else r[0]}"
               for r in change.select(grain.month).distinct().toLocalIterator()}
    held = _named(spark, store, grain.name)
    carried = [p for p in held if p.part not in touched]
    if not touched:
        return carried
    mine = [p for p in held if p.part in touched]
    was = _totals_of(spark, store, grain, mine) if mine else change.limit(0)
    after = (VS.changed_totals(was, change, grain.by)
             .withColumn("total_sales", F.col("total_sales").cast("decimal(38,2)")))
    path = _run(store, grain.name, run_id)
    SK.write_partitioned(after, path, [grain.month])
    return carried + [CM.Part(grain.name, f"{grain.month}={HIVE_NULL if m is None else m}", run_id)
                      for m in _months(spark, path, grain)]


def _months(spark: SparkSession, path: str, grain: Grain) -> list[str | None]:
    """The months that have totals (a month may have lost its last row)."""
    written = spark.read.schema(_schema(grain)).parquet(path)
    return sorted((r[0] for r in written.select(grain.month).distinct().toLocalIterator()), key=str)


def _schema(grain: Grain) -> str:
    return (", ".join(f"{k} bigint" for k in grain.keys)
            + f", total_sales decimal(38,2), n_rows bigint, n_amounts bigint, {grain.month} string")


def _totals_of(spark: SparkSession, store: str, grain: Grain, named: list[CM.Part]) -> DataFrame:
    root = f"{store}/{grain.name}"
    return (spark.read.schema(_schema(grain)).option("basePath", root)
            .parquet(*[f"{_run(store, p.output, p.version)}/{p.part}" for p in named]))


def totals(spark: SparkSession, store: str, grain: Grain) -> DataFrame:
    """The totals as of the last sync, empty before the first."""
    named = _named(spark, store, grain.name)
    df = _totals_of(spark, store, grain, named) if named else spark.createDataFrame([], _schema(grain))
    return df.select(*grain.by, "total_sales")


def customer_mart(spark: SparkSession, store: str, dims: Dimensions) -> DataFrame:
    held = totals(spark, store, CUSTOMER)
    return M.customer_mart_from(held, dims.customer) if _named(spark, store, "files") else empty(spark, CUSTOMER_MART)


def sales_mart(spark: SparkSession, store: str, dims: Dimensions) -> DataFrame:
    held = totals(spark, store, SALES)
    return M.sales_mart_from(held, dims.team) if _named(spark, store, "files") else empty(spark, SALES_TEAM_MART)
