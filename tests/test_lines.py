"""Lines join their files without a shuffle of the lines, and only where files are wanted."""
from martforge.operators import conform
from martforge.sources import files as fsrc
from martforge.schemas import MANDATORY


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_of_a_pinned_routing_are_not_shuffled(spark, tmp_path):
    head, row = ",".join(MANDATORY), "1,121,tea,2024-01-05,1,3.50,2,7.00"
    (tmp_path / "a.csv").write_text(f"{head}\n{row}\n{row}\n")
    (tmp_path / "b.csv").write_text(f"{head}\n{row}\n")
    routing = conform.route_files(fsrc.manifest(spark, str(tmp_path))).checkpoint(eager=True)
    rows = conform.ingest(spark, routing, str(tmp_path)).conformed
    assert "Exchange hashpartitioning" not in _plan(rows) and rows.count() == 3
    none = conform.quarantined_lines(spark, routing, str(tmp_path))
    assert "FileScan csv" not in _plan(none) and none.count() == 0          # no file is rejected: none is read
    (tmp_path / "c.csv").write_text("customer_id\n3\n")
    routing = conform.route_files(fsrc.manifest(spark, str(tmp_path))).checkpoint(eager=True)
    bad = conform.quarantined_lines(spark, routing, str(tmp_path))
    assert "Exchange hashpartitioning" not in _plan(bad) and [r.raw for r in bad.collect()] == ["3"]


def test_broadcast_sides_are_not_shuffled_with_the_customer(spark):
    from martforge.operators import enrich
    from martforge.sources import generate
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        p = _plan(enrich.enrich_sales(generate.sales(spark, 100_000), generate.customers(spark, 50_000),
                                      generate.stores(spark), generate.sales_team(spark), store_bounded=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # parents are printed first
    assert 0 <= p.index("BroadcastHashJoin [sales_person_id") < p.index("Exchange hashpartitioning(customer_id")
