"""Ledger compaction: snapshot and later events give the state of all events."""
import os

from pyspark.sql import functions as F

from conftest import write_text
from martforge.config import PipelineConfig
from martforge.operators import compaction, ledger
from martforge.plans.pipeline import run_pipeline
from martforge.sources import files as fsrc, folders, generate


def _files(spark, ids, day="2024-01-01"):
    return spark.createDataFrame([(f"land/f{i}.csv", f"f{i}.csv", 100 + i) for i in ids],
                                 "path string, file_name string, length long") \
        .withColumn("modification_time", F.lit(day).cast("timestamp"))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _append(spark, path, full, ev):
    ledger.append(path, ev)
    ledger.append(full, ev)         # a copy that is never compacted


def _same(spark, path, full):
    got = _rows(compaction.current_state(spark, path))
    assert got == _rows(ledger.state(ledger.read(spark, full)))
    return got


def test_state_is_that_of_all_events(spark, tmp):
    path, full = f"{tmp}/ledger", f"{tmp}/full"
    assert _rows(compaction.current_state(spark, path)) == []         # nothing written yet
    one, two = _files(spark, range(6)), _files(spark, range(4, 9), "2024-02-01")
    _append(spark, path, full, ledger.open_events(one, 1, 1000))
    _append(spark, path, full, ledger.close_events(one.where("length < 103"), 1, 1000))
    _same(spark, path, full)
    compaction.compact(spark, path)
    _same(spark, path, full)
    _append(spark, path, full, ledger.open_events(two, 2, 2000))      # two files under older names
    _append(spark, path, full, ledger.rejected_events(one.where("length = 105"), 2, 2000))
    assert len(_same(spark, path, full)) == 11
    assert compaction.set_aside(spark, path) == 0 and len(ledger.read(spark, path).inputFiles()) == \
        len(ledger.read(spark, full).inputFiles())                    # one snapshot: nothing moves
    compaction.compact(spark, path)
    _append(spark, path, full, ledger.close_events(two, 3, 3000))
    _same(spark, path, full)
    before = len(ledger.read(spark, path).inputFiles())
    assert compaction.set_aside(spark, path) == 0
    assert 0 < len(ledger.read(spark, path).inputFiles()) < before
    _same(spark, path, full)
    for _ in range(2):                                                # files set aside stay counted, once
        compaction.compact(spark, path)
        compaction.set_aside(spark, path)
        _same(spark, path, full)
    assert len(compaction.snapshots(spark, path)) == compaction.KEPT


def test_dead_and_parallel_compactions(spark, tmp):
    path, full = f"{tmp}/ledger", f"{tmp}/full"
    _append(spark, path, full, ledger.open_events(_files(spark, range(5)), 1, 1000))
    dead = compaction.compact(spark, path)
    folders.remove(spark, dead + compaction.DONE)                     # died before it was published
    _append(spark, path, full, ledger.close_events(_files(spark, range(3)), 1, 2000))
    _same(spark, path, full)
    stale = compaction.compact(spark, path)
    _append(spark, path, full, ledger.close_events(_files(spark, [3]), 1, 3000))
    late = compaction.compact(spark, path)
    folders.remove(spark, late + compaction.DONE)                     # readers take the one before up
    assert compaction.snapshots(spark, path) == [stale]
    _same(spark, path, full)
    folders.mark(spark, late + compaction.DONE)
    _same(spark, path, full)


def test_events_of_open_runs_stay(spark, tmp):
    path, full = f"{tmp}/ledger", f"{tmp}/full"
    _append(spark, path, full, ledger.open_events(_files(spark, range(3)), 1, 1000))
    _append(spark, path, full, ledger.open_events(_files(spark, range(3, 6)), 2, 1000))
    open_runs = spark.createDataFrame([(2,)], "run_id long")
    for _ in range(3):
        compaction.compact(spark, path, open_runs)
        compaction.set_aside(spark, path)
        _same(spark, path, full)
    again = ledger.open_events(_files(spark, range(3, 6)), 2, 1000)
    ledger.append_once(path, again, 2)                                # run 2 is taken up: nothing twice
    _same(spark, path, full)
    compaction.compact(spark, path)                                   # covered now ...
    compaction.compact(spark, path, open_runs)                        # ... and named as open afterwards
    _same(spark, path, full)


def test_pipeline_compacts_its_ledger(spark, tmp):
    dims = (generate.customers(spark), generate.stores(spark), generate.sales_team(spark))
    conf = PipelineConfig(landing=f"{tmp}/landing", output=f"{tmp}/out", ledger=f"{tmp}/ledger", compact_ledger=True)
    os.makedirs(f"{tmp}/landing")
    for run in (1, 2, 3):
        generate.sales(spark, 20, seed=run).toPandas().to_csv(f"{tmp}/landing/s{run}.csv", index=False)
        write_text(f"{tmp}/landing/bad{run}.csv", "customer_id\n1\n")
        res = run_pipeline(spark, conf, *dims, run_id=run, store_bounded=True)
        assert (res.accepted_files, res.rejected_files) == (1, 1)     # earlier files are known
    state = compaction.current_state(spark, conf.ledger)
    assert {(r.file_name[0], r.status, r.n_events) for r in state.collect()} == {("s", "I", 2), ("b", "R", 1)}
    assert ledger.pending(fsrc.manifest(spark, conf.landing), state).count() == 0
    assert len(compaction.snapshots(spark, conf.ledger)) == 2
