"""Ledger compaction: a snapshot of the state plus the events appended since (SNK-6/7).

Layout below the ledger folder (names with ``_`` are hidden from readers of the events)::

    part-*.parquet             events, as ``ledger.append`` writes them
    _state/<name>/rows         state of each file identity, as far as events are covered
    _state/<name>/files        names of the event files that these rows cover
    _state/<name>.done         made last: the snapshot counts from here on
    _covered/                  event files set aside once two snapshots cover them

A snapshot and its list of covered files belong together, so whichever snapshot a reader
picks, ``rows`` and the events of all other files give the same state: appends and other
compactions may run meanwhile, and a compaction that dies leaves nothing that is read.
The last two snapshots stay, so a reader of the one before is not cut off.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators import ledger
from martforge.schemas import LEDGER, LEDGER_STATE
from martforge.session import shared_dir
from martforge.sinks import moves
from martforge.sources import folders

STATES, ASIDE, DONE = "_state", "_covered", ".done"
KEPT = 2   # snapshots


def snapshots(spark: SparkSession, ledger_path: str) -> list[str]:
    """Folders of the finished snapshots, oldest first."""
    base = f"{ledger_path.rstrip('/')}/{STATES}"
    return [f"{base}/{n.removesuffix(DONE)}" for n in folders.names(spark, base) if n.endswith(DONE)]


def _events(spark: SparkSession, ledger_path: str) -> DataFrame:
    """All events in the ledger folder with the name of their file.  The files are listed
    here, once: every use of the frame sees the same ones."""
    if not folders.exists(spark, ledger_path):
        return spark.createDataFrame([], LEDGER).select("*", F.lit("").alias("_file"), F.lit("").alias("_path"))
    return spark.read.schema(LEDGER).parquet(ledger_path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_path").alias("_path"))


def _covered(spark: SparkSession, snapshot: str) -> DataFrame:
    return spark.read.schema("_file string").parquet(f"{snapshot}/files")


def _states(spark: SparkSession, events: DataFrame, snapshot: str | None) -> DataFrame:
    parts = ledger.as_states(events)
    if snapshot is None:
        return parts
    return parts.unionByName(spark.read.schema(LEDGER_STATE).parquet(f"{snapshot}/rows"))


def current_state(spark: SparkSession, ledger_path: str) -> DataFrame:
    """``ledger.state`` of all events ever appended: from the last snapshot and the events
    of the files that it does not cover."""
    snapshot = (snapshots(spark, ledger_path) or [None])[-1]
    events = _events(spark, ledger_path)
    if snapshot:
        events = events.join(_covered(spark, snapshot), "_file", "left_anti")
    return ledger.shown(ledger.merged(_states(spark, events, snapshot)))


def compact(spark: SparkSession, ledger_path: str, open_runs: DataFrame | None = None) -> str:
    """Write and publish a new snapshot; returns its folder.

    Files with an event of ``open_runs`` (column ``run_id``: runs that may be taken up
    again) stay uncovered, so ``append_once`` of such a run still finds its events.
    """
    base = f"{ledger_path.rstrip('/')}/{STATES}"
    last = (snapshots(spark, ledger_path) or [None])[-1]
    listed = _events(spark, ledger_path)
    new, files = listed, listed.select("_file").distinct()
    if last:
        new = listed.join(_covered(spark, last), "_file", "left_anti")
    if open_runs is not None:
        held = new.join(open_runs.select("run_id").distinct(), "run_id", "left_semi").select("_file").distinct()
        new, files = (df.join(held, "_file", "left_anti") for df in (new, files))
    # names sort by time; the random end keeps two compactions of one instant apart
    clock = time.time_ns() // 1_000_000
    if last:
        clock = max(clock, int(last.rsplit("/", 1)[1].split("-")[0]) + 1)
    name = f"{clock:015d}-{uuid.uuid4().hex[:8]}"
    ledger.merged(_states(spark, new, last)).write.parquet(f"{base}/{name}/rows")
    files.write.parquet(f"{base}/{name}/files")
    folders.mark(spark, f"{base}/{name}{DONE}")
    _drop_older(spark, ledger_path)
    return f"{base}/{name}"


def _drop_older(spark: SparkSession, ledger_path: str) -> None:
    """Snapshots before the last ``KEPT``, and what dead compactions of that time left."""
    base = f"{ledger_path.rstrip('/')}/{STATES}"
    kept = [s.rsplit("/", 1)[1] for s in snapshots(spark, ledger_path)[-KEPT:]]
    if len(kept) < KEPT:
        return
    old = [n for n in folders.names(spark, base) if n.removesuffix(DONE) < kept[0]]
    for n in sorted(old, key=lambda n: not n.endswith(DONE)):   # a marker goes before its folder
        folders.remove(spark, f"{base}/{n}")


def set_aside(spark: SparkSession, ledger_path: str) -> int:
    """Move the event files that the last two snapshots cover out of the readers' way
    (in tasks); returns how many could not be moved, which later calls try again."""
    done = snapshots(spark, ledger_path)
    if len(done) < KEPT:
        return 0
    shared_dir(spark)
    paths = _events(spark, ledger_path).select("_file", F.col("_path").alias("path")).distinct()
    for snapshot in done[-KEPT:]:
        paths = paths.join(_covered(spark, snapshot), "_file", "left_semi")
    # pinned: a task that runs again must not look for files that were moved
    paths = paths.select("path").checkpoint(eager=True)
    return moves.move_files(paths, ledger_path, f"{ledger_path.rstrip('/')}/{ASIDE}").where(~F.col("moved")).count()
