"""One ingestion run over a set of dropped files, end to end.

    listing -> extension split -> headers -> contract check -> skip settled
    -> selection written (a resumed run works on the same one)
    -> quarantine report -> manifest 'A' -> conform (text -> typed, bad rows)
    -> stage the typed rows, good and bad apart (a written table cuts lineage;
       a lost executor recomputes from the staged files, not from the CSVs)
    -> star join with attributes, staged once -> customer detail (bucketed by
       customer), sales detail (partitioned by month and store) -> the run's own
       totals -> of the months they touch: totals of all runs, customer mart,
       sales mart (one incentive per store and month) -> manifest 'I' and 'Q'
    -> the commit record, which names every output's version (see
       ``sinks.commits``): months that the run does not touch stay where they are
    -> JDBC append of the run's own marts, if a target is given, once per run
       however often it is tried (see ``sinks.jdbc``)

Nothing counts before the commit record. A run that dies earlier leaves its
files unsettled, its outputs unread, and the next run takes the files again; a
run that is started again under its id goes on behind its last finished step.
Appends that a run committed but did not deliver are made by the next run.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.contracts import (CUSTOMER_MART, SALES_TEAM_MART, STATUS_ACTIVE, STATUS_INACTIVE,
                                STATUS_QUARANTINED, empty)
from martflow.operators import conform as C
from martflow.operators import manifest as MF
from martflow.operators import marts as M
from martflow.operators import validate as V
from martflow.sinks import commits as CM
from martflow.sinks import files as SK
from martflow.sinks import jdbc as SJ
from martflow.sources import files as FS


# The customer detail mart's bucket count (on customer_id): the contract's
# default, for small tables; a bucket is one reading task, so choose it by size.
CUSTOMER_BUCKETS = 10
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a null


class NoInputError(ValueError):
    """The drop holds no file, or no file of an accepted kind."""


@dataclass(frozen=True)
class Dimensions:
    customer: DataFrame
    store: DataFrame
    team: DataFrame
    product: DataFrame | None = None  # given: a price check report per run


@dataclass(frozen=True)
class Layout:
    """Folders of one deployment (all under shared storage)."""
    root: str

    @staticmethod
    def name(root: str) -> str:
        """An output's name in the commit records."""
        return root.rsplit("/", 1)[1]

    @property
    def by_month(self) -> set[str]:
        """The outputs that are carried from run to run by month."""
        return {self.name(r) for r in (self.customer_totals, self.sales_totals, self.customer_mart,
                                       self.sales_mart)}

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def bucketed_table(self) -> str:
        """Catalog name of the bucketed customer detail (a partition a run)."""
        return "customer_detail_" + hashlib.md5(self.root.encode()).hexdigest()[:12]

    @property
    def price_check(self) -> str:
        return f"{self.root}/price_check"

    @property
    def customer_totals(self) -> str:
        return f"{self.root}/customer_totals"

    @property
    def sales_totals(self) -> str:
        return f"{self.root}/sales_totals"

    @property
    def own_customer_totals(self) -> str:
        return f"{self.root}/own_customer_totals"

    @property
    def own_sales_totals(self) -> str:
        return f"{self.root}/own_sales_totals"

    @property
    def typed(self) -> str:
        return f"{self.root}/typed"

    @property
    def enriched(self) -> str:
        return f"{self.root}/enriched"

    @property
    def bad_rows(self) -> str:
        return f"{self.root}/bad_rows"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def selections(self) -> str:
        return f"{self.root}/selections"

    @property
    def customer_detail(self) -> str:
        return f"{self.root}/customer_detail_bucketed"

    @property
    def sales_detail(self) -> str:
        return f"{self.root}/sales_detail_partitioned"

    @property
    def customer_mart(self) -> str:
        return f"{self.root}/customers_data_mart"

    @property
    def sales_mart(self) -> str:
        return f"{self.root}/sales_team_data_mart"


def manifest(spark: SparkSession, layout: Layout) -> DataFrame:
    """The manifest's events that hold: those of committed runs, and pick-ups."""
    return MF.committed(MF.read_log(spark, layout.manifest), CM.runs(spark, layout.root))


def _selection(spark: SparkSession, files: DataFrame, layout: Layout, steps: CM.Steps
               ) -> tuple[DataFrame, DataFrame]:
    """(listing, checked headers) of the run's files, from its snapshot.

    The selection is written first: later writes to the manifest must not
    change which files the run is about, neither while it runs nor when it is
    resumed. If another run settled one of its files meanwhile, the files are
    selected anew and every step is done again."""
    snap = SK.run_path(layout.selections, steps.run_id)
    events = manifest(spark, layout)
    if "selection" in steps.done:
        taken = MF.settled(events).select(F.col("file_name").alias("path"))
        if not spark.read.parquet(f"{snap}/listing").join(taken, "path", "left_semi").isEmpty():
            steps.renew()
    listing = MF.pending(V.split_by_extension(files), events, key="path")
    checked = (V.check_headers(FS.read_headers(listing.where("accepted")))
               .join(listing.select("path", "drop"), "path", "inner"))

    def write() -> None:
        checked.write.mode("overwrite").parquet(f"{snap}/checked")
        listing.write.mode("overwrite").parquet(f"{snap}/listing")
    steps.run("selection", write)
    return (spark.read.schema(listing.schema).parquet(f"{snap}/listing"),
            spark.read.schema(checked.schema).parquet(f"{snap}/checked"))


def run_files(spark: SparkSession, files: DataFrame, dims: Dimensions, layout: Layout,
              run_id: str, jdbc: SJ.JdbcTarget | None = None,
              buckets: int = CUSTOMER_BUCKETS) -> dict:
    """Process the files of ``files`` (a ``list_files`` listing) as run ``run_id``;
    a run that is committed already only delivers what is still to deliver."""
    quarantine = SK.run_path(layout.quarantine, run_id)
    if CM.is_committed(spark, layout.root, run_id):
        checked = spark.read.parquet(f"{SK.run_path(layout.selections, run_id)}/checked")
        result = {"run_id": run_id, "files": checked.where("valid").count(),
                  "rejected": spark.read.parquet(f"{quarantine}/report").count()}
    else:
        steps = CM.Steps(spark, layout.root, run_id)
        listing, checked = _selection(spark, files, layout, steps)
        report = V.quarantine_report(listing, checked)

        def keep_rejected() -> None:
            report.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").parquet(f"{quarantine}/report")
            V.quarantine_lines(spark, report).write.mode("overwrite").parquet(f"{quarantine}/lines")
        steps.run("quarantine", keep_rejected)
        rejected = report.select(F.col("path").alias("file_name"), F.col("path").alias("file_location"))
        valid = checked.where("valid").select(F.col("path").alias("file_name"),
                                              F.col("path").alias("file_location"))
        result = {"run_id": run_id, "files": valid.count(), "rejected": rejected.count()}
        parent = CM.last(spark, layout.root)
        carried = [p for p in CM.parts(spark, layout.root, parent) if p.output in layout.by_month]
        named = [CM.Part("manifest", None, run_id)]
        if result["files"]:
            steps.run("picked", lambda: MF.record(spark, layout.manifest, valid, STATUS_ACTIVE, run_id))
            named += _load(spark, checked, dims, layout, steps, parent, carried, buckets)
            steps.run("settled", lambda: MF.record(spark, layout.manifest, valid, STATUS_INACTIVE, run_id))
        else:
            named += carried
        steps.run("rejected", lambda: MF.record(spark, layout.manifest, rejected, STATUS_QUARANTINED, run_id))
        CM.commit(spark, layout.root, run_id, named)
    if jdbc is not None:
        deliver(spark, dims, layout, jdbc)
    return result


def _load(spark: SparkSession, checked: DataFrame, dims: Dimensions, layout: Layout, steps: CM.Steps,
          parent: str | None, carried: list[CM.Part], buckets: int) -> list[CM.Part]:
    """Write the run's outputs; what its record is to name."""
    run_id = steps.run_id
    # parse every CSV once: typed rows are staged by is_bad, then good and bad
    # rows are read back from the staged files (partition-pruned)
    typed_path = SK.run_path(layout.typed, run_id)
    steps.run("typed", lambda: C.conform_typed(spark, checked).write.mode("overwrite")
              .partitionBy("is_bad").parquet(typed_path))
    fact, bad = C.split_typed(spark.read.parquet(typed_path))
    steps.run("bad_rows", lambda: SK.write_parquet(bad, SK.run_path(layout.bad_rows, run_id)))

    # the dimension joins run once for every output: the enriched fact (with
    # attributes) is staged; the totals aggregate it (reading only their
    # columns) and the detail marts are projections of it
    enriched_path = SK.run_path(layout.enriched, run_id)
    steps.run("enriched", lambda: SK.write_parquet(
        M.star_enrich(fact, dims.customer, dims.store, dims.team), enriched_path))
    enriched = spark.read.parquet(enriched_path)
    steps.run("customer_detail", lambda: SK.append_bucketed(
        spark, M.customer_detail(enriched), layout.bucketed_table, layout.customer_detail, buckets,
        "customer_id", run_id))
    steps.run("sales_detail", lambda: SK.write_partitioned(
        M.sales_detail(enriched), SK.run_path(layout.sales_detail, run_id), ["sales_month", "store_id"]))
    outputs = [layout.typed, layout.bad_rows, layout.enriched, layout.customer_detail, layout.sales_detail,
               layout.own_customer_totals, layout.own_sales_totals]
    if dims.product is not None:
        outputs.append(layout.price_check)
        steps.run("price_check", lambda: SK.write_parquet(
            V.price_check(fact, dims.product), SK.run_path(layout.price_check, run_id)))
    named = [CM.Part(layout.name(o), None, run_id) for o in outputs]

    named += _months(spark, M.customer_month_totals(enriched), ["customer_id"], "sales_date_month",
                     layout.own_customer_totals, layout.customer_totals, layout.customer_mart,
                     lambda totals: M.customer_mart_from(totals, dims.customer), layout, steps, parent, carried)
    named += _months(spark, M.sales_month_totals(enriched), ["store_id", "sales_person_id"], "sales_month",
                     layout.own_sales_totals, layout.sales_totals, layout.sales_mart,
                     lambda totals: M.sales_mart_from(totals, dims.team), layout, steps, parent, carried)
    return named


def _months(spark: SparkSession, totals: DataFrame, keys: list[str], month: str, own_root: str,
            totals_root: str, mart_root: str, mart, layout: Layout, steps: CM.Steps,
            parent: str | None, carried: list[CM.Part]) -> list[CM.Part]:
    """The totals and the mart of the months that the run touches: its own
    totals added to those of the run before. The other months are carried."""
    run_id, store = steps.run_id, layout.root
    own_path = SK.run_path(own_root, run_id)
    steps.run(f"own {month}", lambda: SK.write_parquet(_exact(totals, keys, month), own_path))
    own = spark.read.parquet(own_path)
    touched = {r[0] for r in own.select(month).distinct().collect()}  # months, a control value
    folders = {f"{month}={HIVE_NULL if m is None else m}" for m in touched}

    name = layout.name(totals_root)
    before = [p for p in carried if p.output == name and p.part in folders]
    if before:
        was = CM.read_parts(spark, store, before).select(own.columns)
        merged = M.period_total(own.unionByName(was), [*keys, month], amount="total_sales")
    else:
        merged = own
    path = SK.run_path(totals_root, run_id)
    steps.run(f"totals {month} after {parent}", lambda: SK.write_partitioned(
        _exact(merged, keys, month, "total_sales"), path, [month]))
    if touched:
        totals = spark.read.option("basePath", path).parquet(path)
        totals = totals.withColumn(month, F.col(month).cast("string"))
        steps.run(f"mart {month} after {parent}", lambda: SK.write_partitioned(
            mart(totals), SK.run_path(mart_root, run_id), [month]))
    out = []
    for root in (totals_root, mart_root):
        name = layout.name(root)
        out += [p for p in carried if p.output == name and p.part not in folders]
        written = folders if root == totals_root else _written(spark, SK.run_path(root, run_id), month, folders)
        out += [CM.Part(name, f, run_id) for f in sorted(written)]
    return out


def _written(spark: SparkSession, path: str, month: str, folders: set[str]) -> set[str]:
    """Of the month folders, those that a mart has rows of (a total whose
    dimension row is gone has none)."""
    if not folders:
        return set()
    try:
        rows = spark.read.option("basePath", path).parquet(path).select(F.col(month).cast("string")).distinct()
    except AnalysisException as e:  # no row at all
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return set()
    return {f"{month}={HIVE_NULL if r[0] is None else r[0]}" for r in rows.collect()}


def _exact(totals: DataFrame, keys: list[str], month: str, amount: str = "total_sales") -> DataFrame:
    return totals.select(*keys, month, F.col(amount).cast("decimal(38,2)").alias("total_sales"))


def deliver(spark: SparkSession, dims: Dimensions, layout: Layout, jdbc: SJ.JdbcTarget) -> list[str]:
    """Append the own marts of every committed run that the database's ledger
    does not know; the runs delivered, oldest first."""
    known = SJ.delivered(spark, jdbc)
    rows = (CM.log(spark, layout.root).where(F.col("output") == layout.name(layout.own_sales_totals))
            .where(F.col("version") == F.col("run_id")).orderBy("committed_at").toLocalIterator())
    runs = [run for r in rows if (run := r["run_id"]) not in known]
    for run_id in runs:
        customer = spark.read.parquet(SK.run_path(layout.own_customer_totals, run_id))
        sales = spark.read.parquet(SK.run_path(layout.own_sales_totals, run_id))
        SJ.append_run(spark, {jdbc.customer_table: M.customer_mart_from(customer, dims.customer),
                              jdbc.sales_table: M.sales_mart_from(sales, dims.team)}, jdbc, run_id)
    return runs


def _as_of_last(spark: SparkSession, layout: Layout, root: str, contract) -> DataFrame:
    named = CM.parts(spark, layout.root, CM.last(spark, layout.root), layout.name(root))
    return M.as_contract(CM.read_parts(spark, layout.root, named), contract) if named else empty(spark, contract)


def customer_mart(spark: SparkSession, layout: Layout) -> DataFrame:
    """The customer mart as of the last committed run, empty before the first."""
    return _as_of_last(spark, layout, layout.customer_mart, CUSTOMER_MART)


def sales_mart(spark: SparkSession, layout: Layout) -> DataFrame:
    """The sales-team mart as of the last committed run, empty before the first."""
    return _as_of_last(spark, layout, layout.sales_mart, SALES_TEAM_MART)


def customer_detail(spark: SparkSession, layout: Layout) -> DataFrame:
    """The bucketed customer detail of the committed runs (partition-pruned)."""
    runs = [r["run_id"] for r in SK.committed_runs(spark, layout.customer_detail).select("run_id").toLocalIterator()]
    return spark.table(layout.bucketed_table).where(F.col("run_id").isin(runs))


def interrupted_runs(spark: SparkSession, layout: Layout) -> list[str]:
    """Runs that began and are not committed, oldest first by id: start one
    again under its id to go on behind its last finished step. A run whose
    files another run has settled since is left out."""
    begun = CM.begun(spark, layout.root).join(CM.runs(spark, layout.root), "run_id", "left_anti")
    picked = MF.active(manifest(spark, layout)).select("run_id").distinct()
    return sorted(r["run_id"] for r in begun.join(picked, "run_id", "left_semi").collect())


def ingested(spark: SparkSession, layout: Layout) -> DataFrame:
    """The good rows of every run that reached its end."""
    return C.split_typed(SK.all_runs(spark, layout.typed))[0]


def require_input(files: DataFrame) -> None:
    """Fail fast on an empty drop or one without a single CSV file."""
    kinds = V.split_by_extension(files).groupBy("accepted").count().collect()
    counts = {r["accepted"]: r["count"] for r in kinds}
    if not counts:
        raise NoInputError("no file in the drop")
    if not counts.get(True):
        raise NoInputError("no CSV file in the drop")


def run_folder(spark: SparkSession, landing: str, dims: Dimensions, layout: Layout,
               run_id: str | None = None, preview: int = 0,
               jdbc: SJ.JdbcTarget | None = None, buckets: int = CUSTOMER_BUCKETS) -> dict:
    """Batch entry point: every file under ``landing`` not yet settled. New
    files of which none is valid are quarantined, then reported as an error.

    ``preview > 0`` prints that many rows of the published sales mart (an
    opt-in action; off by default so the job runs no extra query).
    """
    files = FS.list_files(spark, landing)
    require_input(files)
    out = run_files(spark, files, dims, layout, run_id or SK.new_run_id(), jdbc, buckets)
    if out["rejected"] and not out["files"]:
        raise NoInputError(f"no valid file among {out['rejected']} new ones (quarantined)")
    if preview and out.get("files"):
        sales_mart(spark, layout).show(preview, truncate=False)
    return out
