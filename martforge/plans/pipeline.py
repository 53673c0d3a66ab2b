"""The end-to-end run (ORC-1, FLT-8, SNK-6..9, SCL-11/12).

list → skip finished files → route headers → quarantine → open ledger
events → one typed scan per header → enrich (written once as a staging
snapshot and read back, so the marts do not recompute the joins) →
marts and monthly aggregates → close ledger events.

Each stage is recorded in a manifest (``runlog``) once its outputs stand, so a call
after a crash takes the run up behind its last finished stage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.config import PipelineConfig
from martforge.functions.columns import run_clock
from martforge.operators import compaction, conform, contracts, enrich, ledger, marts
from martforge.plans import runlog
from martforge.schemas import CUSTOMER_MONTHLY, LEDGER_CLOSED, LEDGER_REJECTED, SALES_TEAM_MONTHLY
from martforge.sinks import moves, writers
from martforge.session import shared_dir
from martforge.sources import files as fsrc


REPORT_ORDER = ["sales_person_store_id", "sales_person_name", "total_billing"]


class NoInputError(RuntimeError):
    """FLT-8: nothing to process (no file, no CSV, or no valid CSV)."""


class OpenFilesError(RuntimeError):
    """T13: a previous run left files open and the config says fail."""


@dataclass
class RunResult:
    run_id: int
    accepted_files: int
    rejected_files: int
    bad_rows: int
    failed_moves: int = 0     # files that could not be moved: tried again by the next run
    outputs: dict[str, str] = field(default_factory=dict)


def run_pipeline(spark: SparkSession, conf: PipelineConfig, customer: DataFrame,
                 store: DataFrame, sales_team: DataFrame, run_id: int | None = None,
                 store_bounded: bool = False) -> RunResult:
    """One run over all files not yet processed; a run that an earlier call did not
    finish is taken up behind its last finished stage, under its own id."""
    shared_dir(spark)  # checkpoint() needs the shared folder
    clock_id, clock_secs = run_clock()
    again = runlog.unfinished(spark, conf.path("runs")) if run_id is None else None
    run_id, clock_secs = again or (clock_id if run_id is None else run_id, clock_secs)
    log = runlog.RunLog(spark, conf.path("runs"), run_id)
    outputs: dict[str, str] = {}
    if conf.check_dimensions != "off":
        outputs["dimension_violations"] = writers.snapshot_path(conf.path("dimension_violations"), run_id)
        if not log.finished("dimensions"):
            found = contracts.dimension_violations({"customer": customer, "store": store, "sales_team": sales_team})
            writers.write(found, outputs["dimension_violations"])
            if conf.check_dimensions == "fail":
                contracts.refuse(spark.read.parquet(outputs["dimension_violations"]))
            log.finish("dimensions")
    snap = lambda name: writers.snapshot_path(conf.path(name), run_id)

    # routing is small (one row per file); it and the moves that earlier runs left are
    # pinned in the run's own folder, so every stage, of whatever call, sees the same files
    if not log.finished("route"):
        _route(spark, conf, log, snap, clock_secs)
    routing = spark.read.parquet(snap("staging/routing"))
    due = spark.read.parquet(snap("staging/due"))
    rejected = routing.where(F.col("reason") != conform.ACCEPTED)
    accepted = routing.where(F.col("reason") == conform.ACCEPTED)

    outputs["quarantine_files"], outputs["quarantine_lines"] = snap("quarantine/files"), snap("quarantine/lines")
    if not log.finished("quarantine"):
        quarantined = conform.quarantined_lines(spark, routing, conf.landing)
        writers.write_quarantine(routing, quarantined, conf.path("quarantine"), run_id)
        log.finish("quarantine")
    if not log.finished("reject"):
        ledger.append_once(conf.ledger, ledger.rejected_events(rejected, run_id, clock_secs), run_id)
        log.finish("reject")
    # rejected files leave the landing folder whether or not any file is accepted
    failed = _move(spark, conf, log, rejected, due.where(F.col("status") == LEDGER_REJECTED), conf.error_dir,
                   "rejected", outputs)

    n_accepted = accepted.count()
    if n_accepted == 0:
        _move(spark, conf, log, accepted, due.where(F.col("status") == LEDGER_CLOSED), conf.processed_dir, "processed",
              outputs)
        log.finish(runlog.DONE)
        raise NoInputError("no file passed the header check")
    if not log.finished("open"):
        ledger.append_once(conf.ledger, ledger.open_events(accepted, run_id, clock_secs), run_id)
        log.finish("open")

    def stage(name: str, folder: str, make, partition_by=None, order=None) -> DataFrame:
        """The snapshot of a stage: written by ``make`` unless the run has it, read back."""
        outputs[name] = snap(folder)
        if not log.finished(name):
            writers.write_snapshot(make(), conf.path(folder), run_id, partition_by=partition_by, order=order)
            log.finish(name)
        return spark.read.parquet(outputs[name])

    # parse the CSV once: stage every conformed row with its bad-row flag
    # (bad ones keep their text), then split from the Parquet copy.  Not
    # partitioned by the flag: a partitioned write would sort every row.
    rows = stage("conformed", "staging/conformed", lambda: conform.ingest(spark, routing, conf.landing).conformed
                 .withColumn("_raw", F.when(F.col("_bad"), F.col("_raw"))))
    ing = conform.split_conformed(rows, routing)
    _preview(spark, conf, outputs["conformed"])
    bad = stage("bad_rows", "bad_rows", lambda: ing.bad_rows)

    enriched = stage("enriched", "staging/enriched", lambda: enrich.enrich_sales(
        ing.sales, customer, store, sales_team, store_bounded=store_bounded))
    _preview(spark, conf, outputs["enriched"])

    cmart = marts.customer_mart(enriched)
    smart = marts.sales_team_mart(enriched)
    stage("customer_mart", "customer_data_mart", lambda: cmart)
    stage("sales_team_mart", "sales_team_data_mart", lambda: smart)
    stage("sales_team_mart_partitioned", "sales_partitioned_data_mart", lambda: smart,
          ["sales_month", "store_id"], ["sales_person_id"])
    _preview(spark, conf, outputs["customer_mart"], outputs["sales_team_mart"])

    cmonthly = stage("customers_data_mart", "customers_data_mart", lambda: marts.customer_monthly(cmart)
                     .select(*CUSTOMER_MONTHLY))
    incentives = stage("sales_team_data_mart", "sales_team_data_mart_monthly", lambda: marts.sales_team_incentive(
        marts.sales_team_monthly(smart), conf.incentive_rate).select(*SALES_TEAM_MONTHLY))
    _preview(spark, conf, outputs["customers_data_mart"], outputs["sales_team_data_mart"])
    if conf.monthly_report_csv:
        outputs["incentive_report_csv"] = snap("reports/incentive")
        if not log.finished("report"):
            writers.write_csv_report(marts.incentive_report(incentives), outputs["incentive_report_csv"],
                                     partition_by=["sales_month"], order=REPORT_ORDER)
            log.finish("report")
    if conf.jdbc_url:
        for name, table, df in (("jdbc customer", conf.customer_monthly_table, cmonthly),
                                ("jdbc sales team", conf.sales_team_monthly_table, incentives)):
            if not log.finished(name):
                writers.write_jdbc_run(df, conf.jdbc_url, table, run_id, properties=conf.jdbc_properties)
                log.finish(name)

    if not log.finished("close"):
        ledger.append_once(conf.ledger, ledger.close_events(accepted, run_id, run_clock()[1]), run_id)
        log.finish("close")
    # moves come after the close: what a crash in between leaves in the
    # landing folder is closed, and moved when the run is taken up or by the next
    failed += _move(spark, conf, log, accepted, due.where(F.col("status") == LEDGER_CLOSED), conf.processed_dir,
                    "processed", outputs)
    result = RunResult(run_id, n_accepted, rejected.count(), bad.count(), failed, outputs)
    log.finish(runlog.DONE)
    if conf.compact_ledger:   # what a crash in here leaves undone, the next run does
        compaction.compact(spark, conf.ledger, runlog.open_runs(spark, conf.path("runs")))
        compaction.set_aside(spark, conf.ledger)
    return result


def _route(spark: SparkSession, conf: PipelineConfig, log: runlog.RunLog, snap, clock_secs: int) -> None:
    """The first stage: the files of the run with their headers, and the listed files
    that an earlier run brought to an end but did not move."""
    # list the landing folder once (one row per file) and pin the listing
    listed = fsrc.manifest(spark, conf.landing).checkpoint(eager=True)
    if listed.isEmpty():
        raise NoInputError(f"no file below {conf.landing}")
    csv, _ = fsrc.split_by_extension(listed)
    if csv.isEmpty():
        raise NoInputError(f"no CSV file below {conf.landing}")
    current = compaction.current_state(spark, conf.ledger).checkpoint(eager=True)
    if conf.on_open_files == "fail" and not ledger.open_files(listed, current).isEmpty():
        raise OpenFilesError("files of an unfinished run are still open")
    done = current.where(F.col("status").isin(LEDGER_REJECTED, LEDGER_CLOSED)).select(
        F.col("file_path").alias("path"), "length", "modification_time", "status")
    writers.write(listed.join(done, fsrc.IDENTITY).select("path", "status"), snap("staging/due"))
    writers.write(conform.route_files(ledger.pending(listed, current), method=conf.header_method),
                  snap("staging/routing"))
    log.finish(runlog.STARTED, clock_secs)
    log.finish("route")


def _preview(spark: SparkSession, conf: PipelineConfig, *paths: str) -> None:
    """Show the snapshots just written, each read back: nothing is computed again."""
    if conf.preview:
        for path in paths:
            writers.preview(spark.read.parquet(path), enabled=True)


def _move(spark: SparkSession, conf: PipelineConfig, log: runlog.RunLog, files: DataFrame, left: DataFrame,
          target: str | None, name: str, outputs: dict[str, str]) -> int:
    """Move ``files`` of this run, and those that an earlier run ``left`` behind, below
    ``target``/run_id=...: a later delivery of a name never replaces an earlier one.
    Returns how many could not be moved (the status table has the errors)."""
    if not target:
        return 0
    outputs[f"moved_{name}"] = writers.snapshot_path(conf.path(f"moves/{name}"), log.run_id)
    if not log.finished(f"move {name}"):
        writers.write_snapshot(
            moves.move_files(files.select("path").unionByName(left.select("path")), conf.landing,
                             writers.snapshot_path(target, log.run_id)), conf.path(f"moves/{name}"), log.run_id)
        log.finish(f"move {name}")
    return spark.read.parquet(outputs[f"moved_{name}"]).where(~F.col("moved")).count()
