"""Registered queries over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
work grows with the input tables.  Money columns are reported as DOUBLE
(exact conversion of the DECIMAL(18,2) results), matching the oracle
SQL in ``martforge.plans.oracle``.
"""

from __future__ import annotations

import calendar
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.config import PipelineConfig
from martforge.operators import compaction, conform, contracts, enrich, ledger, marts
from martforge.plans.pipeline import REPORT_ORDER, run_pipeline
from martforge.schemas import MANDATORY
from martforge.sinks import moves, writers
from martforge.session import shared_dir
from martforge.sources import drops, files as fsrc, tpch
from martforge.streaming import arrivals, incremental, monthly

Query = Callable[[SparkSession, str], DataFrame]


def _doubles(df: DataFrame, *money_cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in money_cols else F.col(c)
                       for c in df.columns])


def enriched(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    dims = tpch.dimensions(spark, sf_dir)
    # stores are the nations: a fixed, 25-row table, always broadcast
    fact = tpch.sales_fact(spark, sf_dir, products="product_name" in (keep or []))
    return enrich.enrich_sales(fact, dims["customer"], dims["store"], dims["sales_team"],
                               store_bounded=True, keep=keep)


def q_conformed_sales(spark, sf_dir):
    return _doubles(tpch.sales_fact(spark, sf_dir), "price", "total_cost")


def q_enriched_sales(spark, sf_dir):
    return _doubles(enriched(spark, sf_dir), "total_cost")


def q_customer_mart(spark, sf_dir):
    return _doubles(marts.customer_mart(enriched(spark, sf_dir)), "total_cost")


def q_sales_team_mart(spark, sf_dir):
    return _doubles(marts.sales_team_mart(enriched(spark, sf_dir)), "total_cost")


def customer_monthly(spark, sf_dir, method="groupby"):
    return marts.customer_monthly(marts.customer_mart(enriched(spark, sf_dir)), method)


def sales_team_monthly(spark, sf_dir, method="groupby"):
    return marts.sales_team_monthly(marts.sales_team_mart(enriched(spark, sf_dir)), method)


def q_customer_monthly(spark, sf_dir):
    return _doubles(customer_monthly(spark, sf_dir), "total_sales")


def q_customer_monthly_window(spark, sf_dir):
    return _doubles(customer_monthly(spark, sf_dir, "window"), "total_sales")


def q_sales_team_monthly(spark, sf_dir):
    return _doubles(sales_team_monthly(spark, sf_dir), "total_sales")


def q_sales_team_monthly_window(spark, sf_dir):
    return _doubles(sales_team_monthly(spark, sf_dir, "window"), "total_sales")


def q_sales_team_rank(spark, sf_dir):
    r = marts.sales_team_rank(sales_team_monthly(spark, sf_dir))
    return _doubles(r.withColumn("rnk", F.col("rnk").cast("long")), "total_sales")


def q_sales_team_rank_window(spark, sf_dir):
    r = marts.sales_team_rank(sales_team_monthly(spark, sf_dir), method="window")
    return _doubles(r.withColumn("rnk", F.col("rnk").cast("long")), "total_sales")


def q_sales_team_incentive(spark, sf_dir):
    return _doubles(marts.sales_team_incentive(sales_team_monthly(spark, sf_dir)),
                    "total_sales", "incentive")


def q_top_seller_per_store_month(spark, sf_dir):
    return _doubles(marts.top_sellers(sales_team_monthly(spark, sf_dir)), "total_sales")


def q_incentive_report(spark, sf_dir):
    inc = marts.sales_team_incentive(sales_team_monthly(spark, sf_dir))
    return _doubles(marts.incentive_report(inc), "total_billing", "total_incentive")


def q_daily_products_per_customer(spark, sf_dir):
    return marts.daily_products_per_customer(tpch.sales_fact(spark, sf_dir))


ODD_FOLDER = "day #1 [a] 100%?"     # characters that URIs and globs treat apart


def ingest_derived_drops(spark: SparkSession, sf_dir: str):
    """Write the canonical fact as three CSV drops (fresh folder in the
    shared checkpoint dir), then route and ingest them like a landing
    folder: SRC-1..4, FLT-1/4/5, PRJ-1, SET-1, SCL-4, SNK-11."""
    root = f"{shared_dir(spark, 'drops')}/{ODD_FOLDER}"
    drops.derived_drops(tpch.sales_fact(spark, sf_dir), root)
    # pinned: every use below sees the same files and headers
    routing = conform.route_files(fsrc.manifest(spark, fsrc.literal(root))).checkpoint(eager=True)
    return conform.ingest(spark, routing)


def q_csv_drop_union(spark, sf_dir):
    ing = ingest_derived_drops(spark, sf_dir)
    return _doubles(ing.sales.drop("source_file"), "price", "total_cost")


def q_csv_bad_rows(spark, sf_dir):
    """T7 at scale: rows of accepted drops with a cell that does not parse,
    with their text, by drop folder."""
    ing = ingest_derived_drops(spark, sf_dir)
    return ing.bad_rows.select(
        F.element_at(F.split("source_file", "/"), -2).alias("drop_name"), "raw")


def q_csv_quarantined_lines(spark, sf_dir):
    """SNK-9: every data line of the rejected drop, with its text."""
    ing = ingest_derived_drops(spark, sf_dir)
    return conform.quarantined_lines(spark, ing.routing).select(
        F.element_at(F.split("path", "/"), -2).alias("drop_name"), "reason",
        F.array_join("missing_columns", ",").alias("missing_columns"), "raw")


def q_csv_drop_routing(spark, sf_dir):
    ing = ingest_derived_drops(spark, sf_dir)
    quarantined = conform.quarantined_lines(spark, ing.routing)
    return conform.routing_summary(ing.routing, ing, quarantined)


def q_csv_many_shapes(spark, sf_dir):
    """SRC-4 + SET-1 over ``drops.SHAPES`` header shapes: every row of the fact comes back
    through one scan and a plan that knows no shape."""
    root = shared_dir(spark, "shapes")
    drops.many_shapes(tpch.sales_rows(spark, sf_dir), root, {"price": tpch.price()})
    routing = conform.route_files(fsrc.manifest(spark, root)).checkpoint(eager=True)
    ing = conform.ingest(spark, routing, root)
    return _doubles(ing.sales.drop("source_file"), "price", "total_cost")


def q_incremental_ingest(spark, sf_dir):
    """STR-1..3: the same drops ingested by an availableNow file stream in
    about three micro-batches; the union of all batch outputs."""
    root = shared_dir(spark, "stream")
    drops.derived_drops(tpch.sales_fact(spark, sf_dir), f"{root}/landing")
    n_files = fsrc.manifest(spark, f"{root}/landing").count()
    incremental.run_available(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint",
                              max_files_per_trigger=max(1, -(-n_files // 3)))
    out = incremental.read_output(spark, f"{root}/out").drop("source_file", "batch_id")
    return _doubles(out, "price", "total_cost")


def _streamed_marts(spark, sf_dir):
    """The whole fact as drops of many shapes, streamed in about three micro-batches with
    monthly partial sums, merged every two batches; returns the output folder."""
    root = shared_dir(spark, "monthly")
    drops.many_shapes(tpch.sales_rows(spark, sf_dir), f"{root}/landing", {"price": tpch.price()})
    n_files = fsrc.manifest(spark, f"{root}/landing").count()
    dims = tpch.dimensions(spark, sf_dir)
    incremental.run_available(
        spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", max_files_per_trigger=max(1, -(-n_files // 3)),
        dims=monthly.Dimensions(dims["customer"], dims["store"], dims["sales_team"], store_bounded=True,
                                merge_every=2))
    return f"{root}/out"


def q_incremental_customer_monthly(spark, sf_dir):
    """STR-1 + AGG-1: monthly spend per customer, summed over micro-batches."""
    return _doubles(monthly.customer_monthly(spark, _streamed_marts(spark, sf_dir)), "total_sales")


def q_incremental_sales_team_incentive(spark, sf_dir):
    """STR-1 + AGG-2 + WIN-4: incentives on the monthly totals of all micro-batches."""
    return _doubles(monthly.sales_team_incentive(spark, _streamed_marts(spark, sf_dir)), "total_sales", "incentive")


def q_redelivered(spark, sf_dir):
    """STR-2 + T16: the clean drop is ingested; files of the rest of the fact then replace
    files of its names (part by part); the next call ingests the new deliveries, a third
    one finds nothing.  All rows of both deliveries."""
    root = shared_dir(spark, "again")
    fact = tpch.sales_fact(spark, sf_dir)
    early = F.col("sales_date") < F.lit(drops.CLEAN_BEFORE).cast("date")
    drops.write_drop(fact.where(early), f"{root}/landing", MANDATORY)
    ingest = lambda: arrivals.run_available(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint")
    ingest()
    drops.write_drop(fact.where(~early), f"{root}/next", MANDATORY)
    part = F.regexp_extract("path", r"/(part-\d+)-[^/]*$", 1)
    old = fsrc.manifest(spark, f"{root}/landing").select(F.col("path").alias("target"), part.alias("part"))
    new = fsrc.manifest(spark, f"{root}/next").select("path", "file_name", part.alias("part"))
    own = F.concat(F.lit(moves.qualify(spark, f"{root}/landing") + "/"), "file_name")
    pairs = new.join(old, "part", "left").select("path", F.coalesce("target", own).alias("target"))
    left = moves.move_pairs(pairs.checkpoint(eager=True)).where(~F.col("moved")).count()
    if left:
        raise RuntimeError(f"{left} files could not be delivered")
    ingest()
    ingest()
    out = incremental.read_output(spark, f"{root}/out").drop("source_file", "batch_id")
    return _doubles(out, "price", "total_cost")


def q_dimension_violations(spark, sf_dir):
    """DDL-1 + AGG-1's condition on dimensions as a careless export gives them: customers
    of two segments stand twice (those of one with another pincode), salespeople of nation 0
    have no key, the store lacks a column and has another of a wrong type."""
    dims = tpch.dimensions(spark, sf_dir)
    c = dims["customer"]
    moved = c.where("address = 'BUILDING'").withColumn("pincode", F.lit(None).cast("string"))
    customer = c.unionByName(moved).unionByName(c.where("address = 'MACHINERY'"))
    sales_team = dims["sales_team"].withColumn("id", F.when(F.col("manager_id") != 0, F.col("id")))
    store = dims["store"].drop("reviews").withColumn("store_pincode", F.col("store_pincode").cast("int"))
    return contracts.dimension_violations({"customer": customer, "store": store, "sales_team": sales_team})


def q_unmatched_facts(spark, sf_dir):
    """JN-4 report: facts an inner star join drops.  The dimensions are
    stale snapshots: customers of the BUILDING segment and the stores
    (nations) of region 0 are missing from them."""
    dims = tpch.dimensions(spark, sf_dir)
    customer = dims["customer"].where(F.col("address") != "BUILDING")
    store = dims["store"].where(F.col("store_pincode") != "0")
    miss = enrich.unmatched_facts(tpch.sales_fact(spark, sf_dir), customer, store,
                                  dims["sales_team"], store_bounded=True)
    return _doubles(miss, "price", "total_cost")


def _ts_text(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss").alias(c)


def q_ledger_state(spark, sf_dir):
    """SNK-6/7 state: latest status per file identity."""
    st = ledger.state(tpch.ledger_events(spark, sf_dir))
    return st.select("file_name", "file_path", "length", _ts_text("modification_time"), "status",
                     "run_id", _ts_text("created_ts"), _ts_text("updated_ts"), "n_events")


def q_ledger_open_files(spark, sf_dir):
    """SRC-7 / FLT-3 / JN-5 / AGG-4: listed files still open in the ledger."""
    st = ledger.state(tpch.ledger_events(spark, sf_dir))
    return ledger.open_files(tpch.landing_listing(spark, sf_dir), st)


def q_ledger_pending(spark, sf_dir):
    """T13/T16: listed files that still need work (new or still open)."""
    st = ledger.state(tpch.ledger_events(spark, sf_dir))
    pend = ledger.pending(tpch.landing_listing(spark, sf_dir), st)
    return pend.select("path", "file_name", "length", _ts_text("modification_time"))


def q_ledger_compacted(spark, sf_dir):
    """SNK-6/7, T13, T16: three runs over the landing folder of orders, each at its own
    instant: new files are rejected or opened, and closed; those of status P are closed only
    by the run after the one that opened them; files delivered later are never seen.  After
    the first two runs the ledger is compacted, and what both snapshots cover is set aside;
    the state is read from the last snapshot and the events of the third run."""
    path = shared_dir(spark, "ledger")
    delivered = tpch.deliveries(spark, sf_dir)
    for run_id, end in tpch.LEDGER_RUNS:
        clock = calendar.timegm(time.strptime(end, "%Y-%m-%d"))
        current = compaction.current_state(spark, path)
        again = current.where("status = 'A'").select(F.col("file_path").alias("path"), "length", "modification_time",
                                                     F.lit(True).alias("again"))
        todo = (ledger.pending(tpch.listing_at(delivered, end), current)
                .join(again, fsrc.IDENTITY, "left").checkpoint(eager=True))
        rejects = F.col("o_orderpriority") == tpch.LEDGER_REJECTS
        opened = todo.where(~rejects)
        ledger.append(path, ledger.rejected_events(todo.where(rejects), run_id, clock))
        ledger.append(path, ledger.open_events(opened, run_id, clock))
        ledger.append(path, ledger.close_events(opened.where("o_orderstatus <> 'P' or again"), run_id, clock + 3600))
        if run_id < tpch.LEDGER_RUNS[-1][0]:
            compaction.compact(spark, path)
            compaction.set_aside(spark, path)
    return compaction.current_state(spark, path).select(
        "file_name", "file_path", "length", _ts_text("modification_time"), "status", "run_id",
        _ts_text("created_ts"), _ts_text("updated_ts"), "n_events")


def _partitioned_mart(spark, sf_dir):
    """The sales-team mart written partitioned by (sales_month, store_id)
    and read back."""
    path = shared_dir(spark, "sales_partitioned")
    smart = marts.sales_team_mart(enriched(spark, sf_dir))
    writers.write_partitioned(smart, path, ["sales_month", "store_id"], ["sales_person_id"])
    return spark.read.parquet(path)


def _mart_rows(back):
    return _doubles(back.withColumn("store_id", F.col("store_id").cast("long")), "total_cost")


def q_partitioned_mart_roundtrip(spark, sf_dir):
    """SNK-2: every row of the partitioned mart."""
    return _mart_rows(_partitioned_mart(spark, sf_dir))


def q_partitioned_mart_months(spark, sf_dir):
    """SNK-2: the partitioned mart from a month on (partition pruning)."""
    return _mart_rows(_partitioned_mart(spark, sf_dir).where(F.col("sales_month") >= "1999-01"))


SNAPSHOT_RUN_ID = 1700000000000


def q_snapshot_roundtrip(spark, sf_dir):
    """SNK-4/5 + SCL-12: the monthly incentive mart published as run
    ``SNAPSHOT_RUN_ID`` and read back from the snapshot root."""
    base = shared_dir(spark, "snapshots")
    inc = marts.sales_team_incentive(sales_team_monthly(spark, sf_dir))
    writers.write_snapshot(inc, base, SNAPSHOT_RUN_ID)
    back = writers.read_snapshot(spark, base).withColumn("run_id", F.col("run_id").cast("long"))
    return _doubles(back, "total_sales", "incentive")


def q_incentive_report_csv(spark, sf_dir):
    """EXT-1: the report written as CSV by month from the staged monthly mart, read back."""
    base = shared_dir(spark, "report")
    mart = writers.write(marts.sales_team_incentive(sales_team_monthly(spark, sf_dir)), f"{base}/mart")
    path = writers.write_csv_report(marts.incentive_report(spark.read.parquet(mart)), f"{base}/csv",
                                    partition_by=["sales_month"], order=REPORT_ORDER)
    back = spark.read.option("header", "true").schema(
        "sales_person_name string, sales_person_store_id long, total_billing double, total_incentive double, "
        "sales_month string").csv(path)
    return back


PIPELINE_RUN_ID = 1700000000001


def _pipeline_run(spark, sf_dir):
    """ORC-1: a landing folder with the derived drops (a clean one, one with bad cells, one
    to be rejected), brought to marts by one run that moves what it consumed."""
    root = shared_dir(spark, "run")
    drops.derived_drops(tpch.sales_fact(spark, sf_dir), f"{root}/landing")
    conf = PipelineConfig(landing=f"{root}/landing", output=f"{root}/out", ledger=f"{root}/ledger",
                          processed_dir=f"{root}/processed", error_dir=f"{root}/error")
    dims = tpch.dimensions(spark, sf_dir)
    result = run_pipeline(spark, conf, dims["customer"], dims["store"], dims["sales_team"],
                          run_id=PIPELINE_RUN_ID, store_bounded=True)
    return conf, result


def q_pipeline_customer_mart(spark, sf_dir):
    """ORC-1: the customer mart of a whole run."""
    _, result = _pipeline_run(spark, sf_dir)
    return _doubles(spark.read.parquet(result.outputs["customer_mart"]), "total_cost")


def _drop_of(path: str):
    return F.element_at(F.split(path, "/"), -2).alias("drop_name")


def q_pipeline_ledger(spark, sf_dir):
    """SNK-6/7, SNK-9/10 in a run: lines of each drop by the state that the ledger ends
    with, whether they parsed, and whether the file was moved."""
    conf, result = _pipeline_run(spark, sf_dir)
    state = ledger.state(ledger.read(spark, conf.ledger)).select(F.col("file_path").alias("path"), "status", "n_events")
    moved = (spark.read.parquet(result.outputs["moved_processed"])
             .union(spark.read.parquet(result.outputs["moved_rejected"])).select("path", "moved"))
    rows = spark.read.parquet(result.outputs["conformed"]).select(F.col("source_file").alias("path"),
                                                                 F.col("_bad").alias("bad"))
    lines = spark.read.parquet(result.outputs["quarantine_lines"]).select("path", F.lit(False).alias("bad"))
    per_file = rows.union(lines).groupBy("path", "bad").agg(F.count(F.lit(1)).alias("n"))
    return (per_file.join(state, "path").join(moved, "path")
            .groupBy(_drop_of("path"), "status", "n_events", "moved", "bad").agg(F.sum("n").alias("n_rows")))


QUERIES: dict[str, Query] = {
    "conformed_sales": q_conformed_sales,
    "enriched_sales": q_enriched_sales,
    "customer_mart": q_customer_mart,
    "sales_team_mart": q_sales_team_mart,
    "customer_monthly": q_customer_monthly,
    "customer_monthly_window": q_customer_monthly_window,
    "sales_team_monthly": q_sales_team_monthly,
    "sales_team_monthly_window": q_sales_team_monthly_window,
    "sales_team_rank": q_sales_team_rank,
    "sales_team_rank_window": q_sales_team_rank_window,
    "sales_team_incentive": q_sales_team_incentive,
    "top_seller_per_store_month": q_top_seller_per_store_month,
    "incentive_report": q_incentive_report,
    "daily_products_per_customer": q_daily_products_per_customer,
    "csv_drop_union": q_csv_drop_union,
    "csv_drop_routing": q_csv_drop_routing,
    "csv_bad_rows": q_csv_bad_rows,
    "csv_quarantined_lines": q_csv_quarantined_lines,
    "csv_many_shapes": q_csv_many_shapes,
    "incremental_ingest": q_incremental_ingest,
    "incremental_customer_monthly": q_incremental_customer_monthly,
    "incremental_sales_team_incentive": q_incremental_sales_team_incentive,
    "redelivered": q_redelivered,
    "dimension_violations": q_dimension_violations,
    "incentive_report_csv": q_incentive_report_csv,
    "ledger_compacted": q_ledger_compacted,
    "pipeline_customer_mart": q_pipeline_customer_mart,
    "pipeline_ledger": q_pipeline_ledger,
    "unmatched_facts": q_unmatched_facts,
    "ledger_state": q_ledger_state,
    "ledger_open_files": q_ledger_open_files,
    "ledger_pending": q_ledger_pending,
    "partitioned_mart_roundtrip": q_partitioned_mart_roundtrip,
    "partitioned_mart_months": q_partitioned_mart_months,
    "snapshot_roundtrip": q_snapshot_roundtrip,
}
