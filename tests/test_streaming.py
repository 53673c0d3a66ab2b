"""availableNow incremental ingest: each file exactly once over 3 runs."""
import os

from conftest import write_text
from martforge.streaming import incremental

HDR = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def test_three_available_now_runs(spark, tmp):
    land, out, ck = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/ck"
    write_text(f"{land}/a.csv", HDR + "\n1,121,tea,2024-01-05,1,3.50,2,7.00\n")
    incremental.run_available(spark, land, out, ck)
    write_text(f"{land}/b.csv", HDR + ",payment_mode\n2,122,rice,2024-02-01,5,12.00,1,12.00,UPI\n")
    write_text(f"{land}/c.csv", "customer_id\n3\n")
    incremental.run_available(spark, land, out, ck)
    incremental.run_available(spark, land, out, ck)        # nothing new
    sales = incremental.read_output(spark, out)
    assert sorted(r.customer_id for r in sales.collect()) == [1, 2]
    assert sales.where("customer_id = 2").first().additional_column == "UPI"
    routing = incremental.read_output(spark, out, "routing")
    reasons = sorted((os.path.basename(r.path), r.reason) for r in routing.collect())
    assert reasons == [("a.csv", "accepted"), ("b.csv", "accepted"), ("c.csv", "missing_columns")]
    assert routing.select("batch_id").distinct().count() == 2


def test_archive_moves_consumed_files(spark, tmp):
    land, out, ck, arch = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/ck", f"{tmp}/archive"
    write_text(f"{land}/a.csv", HDR + "\n1,121,tea,2024-01-05,1,3.50,2,7.00\n")
    write_text(f"{land}/b.csv", HDR + "\n2,121,tea,2024-01-05,1,3.50,2,7.00\n")
    incremental.run_available(spark, land, out, ck, max_files_per_trigger=1, archive_dir=arch)
    incremental.run_available(spark, land, out, ck, max_files_per_trigger=1, archive_dir=arch)
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".csv")]
    assert len(archived) >= 1          # cleanSource lags one commit behind
    assert incremental.read_output(spark, out).count() == 2


def test_replayed_batch_is_idempotent(spark, tmp):
    land, out = f"{tmp}/landing", f"{tmp}/out"
    write_text(f"{land}/a.csv", HDR + "\n1,121,tea,2024-01-05,1,3.50,2,7.00\n")
    from martforge.sources import files as fsrc
    manifest = fsrc.manifest(spark, land)
    run = incremental.ingest_batch(out)
    run(manifest, 7)
    run(manifest, 7)             # at-least-once replay of the same batch
    assert incremental.read_output(spark, out).count() == 1


def _dims(spark, merge_every=2):
    from martforge.sources import generate
    from martforge.streaming import monthly
    return monthly.Dimensions(generate.customers(spark), generate.stores(spark), generate.sales_team(spark),
                              store_bounded=True, merge_every=merge_every)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_monthly_marts_over_batches_and_replays(spark, tmp):
    from martforge.operators import enrich, marts
    from martforge.sources import generate
    from martforge.streaming import monthly
    dims, out = _dims(spark), f"{tmp}/out"
    sales = [generate.sales(spark, 60, seed=i) for i in range(5)]
    whole = None
    for i, s in enumerate(sales):
        for _ in range(2):                                  # each batch is replayed
            monthly.add_batch(spark, out, s, i, dims)
        whole = s if whole is None else whole.unionByName(s)
        enriched = enrich.enrich_sales(whole, dims.customer, dims.store, dims.sales_team, store_bounded=True)
        assert _sorted(monthly.customer_monthly(spark, out)) == \
            _sorted(marts.customer_monthly(marts.customer_mart(enriched)))
    assert _sorted(monthly.sales_team_incentive(spark, out)) == \
        _sorted(marts.sales_team_incentive(marts.sales_team_monthly(marts.sales_team_mart(enriched))))
    # merged after batches 1 and 3; parts that the table before the last holds are gone
    assert monthly._merges(spark, f"{out}/customer_monthly") == [1, 3]
    assert sorted(os.listdir(f"{out}/customer_monthly/part")) == [f"batch_id={i}" for i in (2, 3, 4)]
    # a merged table that was not committed does not count
    os.remove(f"{out}/customer_monthly/merged/upto=3/_SUCCESS")
    monthly.add_batch(spark, out, sales[3], 3, dims)
    assert _sorted(monthly.customer_monthly(spark, out)) == \
        _sorted(marts.customer_monthly(marts.customer_mart(enriched)))


def test_stream_keeps_the_marts(spark, tmp):
    from martforge.streaming import monthly
    land, out, ck = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/ck"
    write_text(f"{land}/a.csv", HDR + "\n1,121,tea,2024-01-05,1,3.50,2,7.00\nx,121,tea,2024-01-05,1,3.50,2,7.00\n")
    incremental.run_available(spark, land, out, ck, dims=_dims(spark))
    write_text(f"{land}/b.csv", HDR + "\n1,121,tea,2024-01-06,1,3.50,2,8.00\n")
    write_text(f"{land}/c.csv", "customer_id\n3\n")
    incremental.run_available(spark, land, out, ck, dims=_dims(spark))
    got = [(r.customer_id, r.sales_date_month, str(r.total_sales)) for r in monthly.customer_monthly(spark, out).collect()]
    assert got == [(1, "2024-01", "15.00")]


def test_a_rewritten_name_arrives_again(spark, tmp):
    from martforge.streaming import arrivals
    land, out, ck = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/ck"
    run = lambda: arrivals.run_available(spark, land, out, ck, files_per_batch=2)
    ids = lambda: sorted(r.customer_id for r in incremental.read_output(spark, out).collect())
    for i in (1, 2, 3):
        write_text(f"{land}/f{i}.csv", HDR + f"\n{i},121,tea,2024-01-05,1,3.50,2,7.00\n")
    write_text(f"{land}/empty.csv", "")
    run()
    assert ids() == [1, 2, 3]
    run()                                                      # nothing new
    assert ids() == [1, 2, 3]
    write_text(f"{land}/f2.csv", HDR + "\n20,121,tea,2024-01-05,1,3.50,2,7.00\n")      # same name, other file
    run()
    assert ids() == [1, 2, 3, 20]
    reasons = [(os.path.basename(r.path), r.reason) for r in incremental.read_output(spark, out, "routing").collect()]
    assert sorted(reasons).count(("f2.csv", "accepted")) == 2 and ("empty.csv", "empty_file") in reasons
    # a call that died before the stream ran: the delivery is recorded, the next call ingests it
    write_text(f"{land}/f4.csv", HDR + "\n4,121,tea,2024-01-05,1,3.50,2,7.00\n")
    arrivals.record(spark, land, f"{out}/arrivals")
    run()
    assert ids() == [1, 2, 3, 4, 20]
