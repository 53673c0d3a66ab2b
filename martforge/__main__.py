"""Command line: one batch run, or one incremental (availableNow) run.

    spark-submit -m martforge --landing s3a://b/sales_data/ --output s3a://b/marts \\
        --customer s3a://b/dims/customer --store s3a://b/dims/store \\
        --sales-team s3a://b/dims/sales_team [--dims-format jdbc --jdbc-url ...]

The session comes from ``SparkSession.builder.getOrCreate()`` (whatever the
submitting environment configures); ``tune`` adds the runtime SQL settings.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from martforge.config import PipelineConfig
from martforge.plans.pipeline import run_pipeline
from martforge.session import tune
from martforge.sources import tables
from martforge.streaming import arrivals, incremental, monthly


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="martforge")
    p.add_argument("--landing", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--ledger", help="default: <output>/ledger")
    p.add_argument("--dims-format", choices=["parquet", "jdbc"], default="parquet")
    p.add_argument("--customer", help="path (parquet) or table (jdbc); batch runs, and the marts of incremental ones")
    p.add_argument("--store", help="batch runs")
    p.add_argument("--sales-team", help="batch runs")
    p.add_argument("--store-bounded", action="store_true",
                   help="the store table is small and fixed: always broadcast it")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-properties", default="{}", help="JSON object, e.g. driver, user")
    p.add_argument("--jdbc-partitions", type=int, default=8,
                   help="tasks that read a dimension over JDBC, in ranges of equally many rows")
    p.add_argument("--write-jdbc", action="store_true", help="also append monthly marts over JDBC")
    p.add_argument("--processed-dir")
    p.add_argument("--error-dir")
    p.add_argument("--on-open-files", choices=["reprocess", "fail"], default="reprocess")
    p.add_argument("--compact-ledger", action="store_true", help="snapshot the ledger's state after the run")
    p.add_argument("--check-dimensions", choices=["off", "report", "fail"], default="off")
    p.add_argument("--redeliveries", action="store_true",
                   help="incremental mode: a name delivered again is ingested again")
    p.add_argument("--incremental", action="store_true", help="availableNow streaming ingest")
    p.add_argument("--checkpoint", help="stream checkpoint (incremental mode)")
    a = p.parse_args(argv)
    if not a.incremental and not (a.customer and a.store and a.sales_team):
        p.error("a batch run needs --customer, --store and --sales-team")
    return a


def main(argv: list[str] | None = None) -> int:
    a = parse(sys.argv[1:] if argv is None else argv)
    spark = tune(SparkSession.builder.appName("martforge").getOrCreate())
    props = json.loads(a.jdbc_properties)

    def read(name: str, key: str):
        if a.dims_format == "jdbc":
            return tables.read_jdbc_split(spark, a.jdbc_url, name, key, a.jdbc_partitions, props)
        return tables.read_parquet(spark, name)

    given = a.customer and a.store and a.sales_team
    dims = (read(a.customer, "customer_id"), read(a.store, "id"), read(a.sales_team, "id")) if given else None
    if a.incremental:
        checkpoint = a.checkpoint or f"{a.output.rstrip('/')}/_stream_checkpoint"
        sums = monthly.Dimensions(*dims, store_bounded=a.store_bounded) if dims else None
        if a.redeliveries:
            arrivals.run_available(spark, a.landing, a.output, checkpoint, dims=sums)
        else:
            incremental.run_available(spark, a.landing, a.output, checkpoint, archive_dir=a.processed_dir, dims=sums)
        return 0
    conf = PipelineConfig(
        landing=a.landing, output=a.output, ledger=a.ledger or f"{a.output.rstrip('/')}/ledger",
        on_open_files=a.on_open_files, jdbc_url=a.jdbc_url if a.write_jdbc else None,
        jdbc_properties=props, processed_dir=a.processed_dir, error_dir=a.error_dir,
        compact_ledger=a.compact_ledger, check_dimensions=a.check_dimensions)
    res = run_pipeline(spark, conf, *dims, store_bounded=a.store_bounded)
    print(json.dumps({"run_id": res.run_id, "accepted_files": res.accepted_files,
                      "rejected_files": res.rejected_files, "bad_rows": res.bad_rows, "failed_moves": res.failed_moves,
                      "outputs": res.outputs}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
