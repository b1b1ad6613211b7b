"""Lake, warehouse and jobs: two simulated days end to end, repeats and missing data."""

import glob
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from salesmart.operators import affinity, cards, marts, quality, rfm, silver, stock
from salesmart.plans import jobs
from salesmart.schemas import UNIQUE_KEYS
from salesmart.sources import external, lake, samples
from salesmart.sources.warehouse import Warehouse

RAW = ["sale_id", "customer_id", "store_id", "product_id", "amount", "sale_date"]
START = "2023-12-31 00:00:00"


def rows(df, *drop):
    df = df.drop("processed_at", "updated_at", "last_updated", "ingest", "run", *drop)
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def new_warehouse(spark, sf, path):
    wh = Warehouse(spark, str(path))
    wh.save_version("products", "20231231T000000", samples.products(spark, sf))
    wh.save_version("inventory", "20231231T000000", samples.inventory(spark, sf))
    return wh


def batch(spark, sf, run_at):
    """Sales of the hours since the run six hours before, shifted into two days to have busy hours."""
    squeezed = samples.raw_sales(spark, sf).withColumn(
        "sale_date", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (arrival_seq * 7 % 2880) * 60)")
    )
    sold = F.col("sale_date")
    hour = squeezed.where((sold >= F.lit(run_at - timedelta(hours=6))) & (sold < F.lit(run_at)))
    return hour.orderBy("arrival_seq").select(*RAW).coalesce(1)


@pytest.fixture(scope="module")
def two_days(spark, sf, tmp_path_factory):
    wh = new_warehouse(spark, sf, tmp_path_factory.mktemp("warehouse"))
    first = datetime(2024, 1, 1, 5)
    for step in range(4):
        run_at = first + timedelta(hours=6 * step)
        lake.write_batch(batch(spark, sf, run_at), wh.raw, run_at)
        assert jobs.bronze_hour(wh, run_at)
        jobs.silver_hour(wh, run_at, run_at)
        jobs.stock_hour(wh, run_at, (run_at - timedelta(hours=6), run_at))
    jobs.run_day(wh, datetime(2024, 1, 1, 23))
    return wh


def test_lake_layout_and_rerun(spark, sf, tmp_path):
    root, run_at = str(tmp_path / "sales"), datetime(2024, 1, 1, 5)
    df = batch(spark, sf, run_at)
    lake.write_batch(df, root, run_at)
    lake.write_batch(df, root, run_at)
    assert glob.glob(f"{root}/year=2024/month=01/day=01/hour=05/*.snappy.parquet")
    back = lake.read_hour(spark, root, run_at)
    assert rows(back.select(*RAW)) == rows(df)
    assert back.first().month == "01"
    other = datetime(2024, 1, 1, 11)
    lake.write_batch(batch(spark, sf, other), root, other)
    assert rows(lake.read_hour(spark, root, run_at).select(*RAW)) == rows(df)
    assert lake.read_lake(spark, root).count() == df.count() + batch(spark, sf, other).count()


def test_files_written_by_pandas_are_read(spark, tmp_path):
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "sales" / "year=2024" / "month=01" / "day=05" / "hour=09"
    folder.mkdir(parents=True)
    frame = pd.DataFrame({
        "sale_id": [123456, 123456, 777777], "customer_id": [1, 1, 2], "store_id": [1, 2, 3], "product_id": [5, 6, 7],
        "amount": [50.05, 60.0, 70.1], "sale_date": pd.to_datetime(["2024-01-05 08:01:02.123456789"] * 3),
    })
    pq.write_table(pa.Table.from_pandas(frame), folder / "batch_2024-01-05T09.parquet", version="2.6", compression="snappy")
    got = lake.read_hour(spark, str(tmp_path / "sales"), "2024-01-05 09:00:00")
    first = quality.clean_batch(got).orderBy("sale_id").first()
    assert (first.sale_id, first.store_id, str(first.amount), first.hour) == ("123456", 1, "50.05", "09")
    assert first.sale_date == datetime(2024, 1, 5, 8, 1, 2, 123456)
    assert got.count() == 3


def test_missing_hour_is_empty_and_not_copied(spark, sf, tmp_path):
    wh = new_warehouse(spark, sf, tmp_path)
    assert lake.read_hour(spark, wh.raw, START).count() == 0
    assert not jobs.bronze_hour(wh, START)
    jobs.silver_hour(wh, START)
    jobs.stock_hour(wh, START)
    jobs.run_day(wh, "2023-12-31 23:00:00")
    assert wh.read("silver.sales_enriched").count() == 0
    assert wh.latest("gold.mart_product_affinity") is None


def test_copy_keeps_arrival_order(two_days, spark):
    run_at = datetime(2024, 1, 1, 11)
    raw, bronze = (lake.read_hour(spark, root, run_at) for root in (two_days.raw, two_days.bronze))

    def order(df):
        return [r.sale_id for r in df.orderBy("_file", "_row").select("sale_id").collect()]

    assert order(raw) == order(bronze)


def test_fast_track_lake(spark, sf, tmp_path):
    df = samples.raw_sales(spark, sf).select(*RAW)
    for _ in range(2):
        lake.write_fast_track(df, str(tmp_path / "ft"), "2024-01-05 10:00:00")
    assert glob.glob(f"{tmp_path}/ft/year=2024/month=01/day=05/*.parquet")
    assert spark.read.parquet(str(tmp_path / "ft")).count() == 2 * df.count()


def test_silver_hours_equal_the_batch_operators(two_days, spark, sf):
    raw = lake.read_lake(spark, two_days.bronze)
    clean = quality.clean_batch(raw, scope=lake.LAKE_PARTITIONS)
    want = silver.enrich(clean, samples.products(spark, sf))
    assert rows(two_days.read("silver.sales_enriched")) == rows(want)
    before = rows(two_days.read("silver.sales_enriched"))
    jobs.silver_hour(two_days, datetime(2024, 1, 1, 11), "2024-03-01 00:00:00")
    assert rows(two_days.read("silver.sales_enriched")) == before


def test_rebuild_equals_hourly_silver_and_skips_bad_files(two_days, spark, sf, tmp_path):
    wh = new_warehouse(spark, sf, tmp_path)
    for step in range(4):
        run_at = datetime(2024, 1, 1, 5) + timedelta(hours=6 * step)
        lake.write_batch(batch(spark, sf, run_at), wh.raw, run_at)
    bad = glob.glob(f"{wh.raw}/year=2024/month=01/day=01/hour=05/")[0] + "broken.parquet"
    with open(bad, "wb") as handle:
        handle.write(b"not a parquet file at all")
    check = jobs.rebuild_silver(wh, "2024-03-01 00:00:00").first()
    assert rows(wh.read("silver.sales_enriched")) == rows(two_days.read("silver.sales_enriched"))
    assert check.total == wh.read("silver.sales_enriched").count() and check.has_name < check.total
    assert [(f.path.rsplit("/", 1)[1], f.reason) for f in check.skipped_files] == [("broken.parquet", "footer")]


def test_only_broken_files_are_quarantined(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "cast(id * 7 as string) s").coalesce(1).write.parquet(str(tmp_path / "a"))
    sound = glob.glob(f"{tmp_path}/a/*.parquet")[0]
    data = open(sound, "rb").read()
    broken = {"cut": data[: len(data) // 2], "empty": b"", "flipped": data[:100] + bytes(range(256)) + data[356:]}
    for name, content in broken.items():
        (tmp_path / f"{name}.parquet").write_bytes(content)
    paths = [f"{tmp_path}/{name}.parquet" for name in broken]
    found = dict(lake.unreadable_files(spark, [*paths, sound]))
    assert found == dict(zip(paths, ["footer", "footer", "data"]))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.unreadable_files(spark, [sound, f"{tmp_path}/gone.parquet"])
    assert lake.corruption(OSError("no route to host")) is None


def test_rebuild_needs_products(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.rebuild_silver(Warehouse(spark, str(tmp_path)))


def test_stock_equals_the_replay_and_reruns_do_not_deduct_twice(two_days, spark, sf):
    def level():
        return rows(two_days.latest("inventory").select("product_id", "stock_qty"))

    sold = stock.sold_quantities(two_days.read("silver.sales_enriched"), "2023-12-31 23:00:00", "2024-01-01 23:00:00")
    want = stock.deduct_stock(samples.inventory(spark, sf), sold)
    assert level() == rows(want.select("product_id", "stock_qty"))
    alerts = rows(two_days.read("inventory_alerts"))
    assert alerts
    last = datetime(2024, 1, 1, 23)
    jobs.stock_hour(two_days, last, (last - timedelta(hours=6), last))
    assert level() == rows(want.select("product_id", "stock_qty"))
    assert rows(two_days.read("inventory_alerts")) == alerts
    assert jobs.alert_report(two_days, "2024-01-01").count() == len(alerts)


def test_marts_after_the_day(two_days, spark):
    facts = two_days.read("silver.sales_enriched")
    assert rows(two_days.read("gold.mart_sales"), "sale_day") == rows(marts.mart_sales(facts))
    snapshot = rfm.rfm_full(facts, "2024-01-01 23:00:00")
    assert rows(two_days.latest("silver.rfm_snapshot"), "as_of") == rows(snapshot)
    assert rows(two_days.read("gold.mart_account")) == rows(marts.mart_account(snapshot, "2024-01-01"))
    inventory = marts.mart_inventory(
        two_days.latest("inventory"), two_days.latest("products"), two_days.read("inventory_alerts")
    )
    assert rows(two_days.latest("gold.mart_inventory")) == rows(inventory)
    assert two_days.latest("gold.mart_cf_recommendations").count() > 0
    for name in UNIQUE_KEYS:
        assert two_days.duplicates(name).isEmpty()


def test_second_day_adds_to_the_first(two_days, spark, sf):
    """Last in this file's order for the shared warehouse: it moves the state on."""
    first_sales = rows(two_days.read("gold.mart_sales").where("sale_hour < '2024-01-01 22:00:00'"), "sale_day")
    run_at = datetime(2024, 1, 2, 5)
    lake.write_batch(batch(spark, sf, run_at), two_days.raw, run_at)
    jobs.bronze_hour(two_days, run_at)
    jobs.silver_hour(two_days, run_at, run_at)
    jobs.stock_hour(two_days, run_at, (run_at - timedelta(hours=6), run_at))
    jobs.run_day(two_days, datetime(2024, 1, 2, 23))
    facts = two_days.read("silver.sales_enriched")
    # rows of 23:00 to 23:59 arrived with the next day's run and still reach the first day's mart
    assert facts.where("sale_date >= '2024-01-01 23:00:00' and sale_date < '2024-01-02 00:00:00'").count() > 0
    assert rows(two_days.read("gold.mart_sales"), "sale_day") == rows(marts.mart_sales(facts))
    assert rows(two_days.read("gold.mart_sales").where("sale_hour < '2024-01-01 22:00:00'"), "sale_day") == first_sales
    want = rfm.rfm_full(facts, "2024-01-02 23:00:00")
    assert rows(two_days.latest("silver.rfm_snapshot"), "as_of") == rows(want)
    assert two_days.read("gold.mart_account").select("snapshot_date").distinct().count() == 2
    assert jobs.rfm_snapshot(two_days, "2024-01-09 23:00:00", skip_when_idle=True) is False
    assert jobs.rfm_snapshot(two_days, "2024-01-09 23:00:00") is True
    aged = two_days.latest("silver.rfm_snapshot")
    assert aged.agg(F.min("recency_days")).first()[0] >= 7

    two_days.register_views()
    total = spark.sql("SELECT COALESCE(SUM(total_revenue), 0) AS value FROM gold.mart_sales").first()[0]
    assert total == facts.agg(F.sum("amount")).first()[0]
    assert spark.sql("SELECT COUNT(*) FROM raw_sales").first()[0] == 0
    card = cards.segment_summary(spark.table("gold.mart_account"), latest_only=True)
    assert card.agg(F.sum("customers")).first()[0] == want.count()


def test_no_rules_leave_the_old_mart(two_days, spark, sf):
    version = two_days.versions("gold.mart_product_affinity")
    few = two_days.read("silver.sales_enriched").where("customer_id < 5")
    assert affinity.association_rules(few).count() == 0
    assert two_days.versions("gold.mart_product_affinity") == version


def test_incomplete_version_is_not_read(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.save_version("products", "1", spark.createDataFrame([(1, "a")], "product_id bigint, product_name string"))
    half = tmp_path / "tables" / "products" / "version=2"
    half.mkdir()
    assert wh.versions("products") == ["1"]
    assert wh.latest("products").count() == 1
    assert wh.latest("products", before="1") is None


def test_landing_table_appends(spark, sf):
    df = samples.raw_sales(spark, sf).select(*RAW)
    spark.sql("DROP VIEW IF EXISTS raw_sales")
    external.append_landing(df, "landing_sales")
    external.append_landing(df, "landing_sales")
    assert spark.table("landing_sales").count() == 2 * df.count()
    spark.sql("DROP TABLE landing_sales")


def test_one_hour_reads_one_directory_and_marts_prune(two_days, spark):
    hour = lake.read_hour(spark, two_days.raw, datetime(2024, 1, 1, 5))
    assert len(hour.inputFiles()) == len(glob.glob(f"{two_days.raw}/year=2024/month=01/day=01/hour=05/*.parquet"))
    day = marts.mart_sales(two_days.read("silver.sales_enriched"), ["2024-01-01"])
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_date_only" in plan


def test_stock_reads_recent_alerts_only_and_ids_go_on(spark, sf, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.save_version("inventory", "20240101T000000", spark.createDataFrame([(1, 5, 9), (2, 5, 9)], "product_id long, stock_qty int, restock_threshold int"))
    sold = [("a", 1, "2024-01-02 00:10:00"), ("b", 2, "2024-01-02 00:10:00"), ("c", 1, "2024-01-02 00:40:00"), ("d", 2, "2024-01-02 03:10:00")]
    facts = spark.createDataFrame(sold, "sale_id string, product_id long, at string").selectExpr(
        "sale_id", "product_id", "cast(at as timestamp_ntz) sale_date", "cast(at as date) sale_date_only", "'x' ingest")
    wh.replace_run("silver.sales_enriched", "ingest", "x", facts)
    for run_at, start in [("00:30", "00:00"), ("01:00", "00:30"), ("02:00", "01:00"), ("03:30", "02:30")]:
        jobs.stock_hour(wh, f"2024-01-02 {run_at}:00", (datetime.fromisoformat(f"2024-01-02 {start}:00"), datetime.fromisoformat(f"2024-01-02 {run_at}:00")))
    found = [(r.alert_id, r.product_id, str(r.alert_time)[11:16]) for r in wh.read("inventory_alerts").orderBy("alert_id").collect()]
    assert found == [(1, 1, "00:30"), (2, 2, "00:30"), (3, 2, "03:30")]  # product 1 was still silent at 01:00
