"""Run one ingestion: ``python -m martflow`` (or ``spark-submit`` this module).

    python -m martflow --landing DIR --out DIR --customer URI --store URI --team URI
                       [--product URI] [--jdbc-url URL] [--jdbc-property KEY=VALUE ...]
                       [--stream --checkpoint DIR [--archive DIR]] [--preview N]

Dimensions are Parquet folders (or JDBC URLs with ``--jdbc-table-*``) in the
contract shapes of ``martflow.contracts``; ``--jdbc-url`` names the database
that the run's marts are appended to; ``--jdbc-property`` (user, password,
driver, ...) holds for all JDBC connections. The session is the one Spark
gives (``spark.checkpoint.dir`` must name a shared folder on a cluster).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from martflow.contracts import CUSTOMER, PRODUCT, SALES_TEAM, STORE
from martflow.plans.batch_job import CUSTOMER_BUCKETS, Dimensions, Layout, run_folder
from martflow.session import ensure_checkpoint_dir
from martflow.sinks.jdbc import JdbcTarget
from martflow.sources.dims import read_dim


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="martflow")
    ap.add_argument("--landing", required=True, help="folder of drop folders")
    ap.add_argument("--out", required=True, help="output root (manifest, marts, ...)")
    ap.add_argument("--customer", required=True)
    ap.add_argument("--store", required=True)
    ap.add_argument("--team", required=True, help="sales team, with a store_id column")
    ap.add_argument("--product", help="adds a price check report")
    for name in ("customer", "store", "team", "product"):
        ap.add_argument(f"--jdbc-table-{name}")
        ap.add_argument(f"--jdbc-key-{name}", help="numeric column to read the table in ranges of")
    ap.add_argument("--jdbc-url", help="append the run's marts to this database")
    ap.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    ap.add_argument("--buckets", type=int, default=CUSTOMER_BUCKETS,
                    help="buckets of the customer detail (one reading task each)")
    ap.add_argument("--run-id")
    ap.add_argument("--stream", action="store_true", help="file stream, AvailableNow")
    ap.add_argument("--checkpoint", help="stream checkpoint folder (with --stream)")
    ap.add_argument("--archive", help="move ingested files here (with --stream)")
    ap.add_argument("--preview", type=int, default=0)
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("martflow").getOrCreate()
    ensure_checkpoint_dir(spark)
    properties = dict(p.split("=", 1) for p in a.jdbc_property)
    jdbc = JdbcTarget(a.jdbc_url, properties) if a.jdbc_url else None
    team_contract = T.StructType(SALES_TEAM.fields + [T.StructField("store_id", T.LongType())])

    def dim(name: str, contract: T.StructType):
        return read_dim(spark, getattr(a, name), contract, properties,
                        getattr(a, f"jdbc_table_{name}"), getattr(a, f"jdbc_key_{name}"))

    dims = Dimensions(dim("customer", CUSTOMER), dim("store", STORE), dim("team", team_contract),
                      dim("product", PRODUCT) if a.product else None)
    layout = Layout(a.out.rstrip("/"))
    if a.stream:
        from martflow.streaming.ingest import start_ingest
        if not a.checkpoint:
            ap.error("--stream needs --checkpoint")
        start_ingest(spark, a.landing, dims, layout, a.checkpoint, archive_dir=a.archive,
                     jdbc=jdbc).awaitTermination()
        result = {"stream": "done"}
    else:
        result = run_folder(spark, a.landing, dims, layout, a.run_id, a.preview, jdbc, a.buckets)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
