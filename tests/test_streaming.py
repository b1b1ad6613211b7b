"""Streams against the batch operators on the sample events."""

import pytest
from pyspark.sql import functions as F

from salesmart.operators import marts, quality, rfm, stock
from salesmart.operators.fast_track import fast_track_messages
from salesmart.operators.silver import enrich
from salesmart.session import materialize
from salesmart.sources import external, lake, samples
from salesmart.sources.warehouse import Warehouse
from salesmart.streaming import flows

RAW = ["sale_id", "customer_id", "store_id", "product_id", "amount", "sale_date"]


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def world(spark, sf, tmp_path_factory):
    """A lake with one file per day (each day is its own ingest hour), and batch silver."""
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("stream")))
    raw = samples.raw_sales(spark, sf).orderBy("arrival_seq")
    days = lake.with_partitions(raw, F.date_trunc("day", "sale_date") + F.expr("INTERVAL 1 DAY"))
    days.repartition(1).sortWithinPartitions("arrival_seq").select(*RAW, *lake.LAKE_PARTITIONS).write.partitionBy(
        *lake.LAKE_PARTITIONS
    ).parquet(wh.raw)
    wh.save_version("products", "20240101T000000", samples.products(spark, sf))
    wh.save_version("inventory", "20240101T000000", samples.inventory(spark, sf))
    source = flows.read_lake_stream(spark, wh.raw, files_per_batch=7)
    flows.stream_silver(wh, source, f"{wh.root}/cp/silver", "2024-02-01 00:00:00").awaitTermination()
    return wh


def enriched_stream(spark, wh):
    folder = f"{wh.root}/as-files"
    silver = wh.read("silver.sales_enriched")
    silver.repartition(24, "sale_id").write.mode("ignore").parquet(folder)
    return spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", 8).parquet(folder)


def test_silver_stream_equals_batch(spark, sf, world):
    got = world.read("silver.sales_enriched").drop("processed_at", "ingest")
    clean = quality.clean_batch(lake.read_lake(spark, world.raw), scope=lake.LAKE_PARTITIONS)
    want = enrich(clean, samples.products(spark, sf))
    assert rows(got.select(*want.columns)) == rows(want)
    assert world.read("silver.sales_enriched").select("ingest").distinct().count() > 1


def test_fast_track_stream_equals_batch(spark, world, tmp_path):
    stream = flows.fast_track_stream(flows.read_lake_stream(spark, world.raw, 7), above=100)
    query = external.send_stream(stream, str(tmp_path / "cp"), sink="parquet", path=str(tmp_path / "out"))
    query.awaitTermination()
    want = fast_track_messages(lake.read_lake(spark, world.raw), above=100)
    assert want.count() > 0
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(want)


def test_hourly_revenue_emits_every_closed_hour_once(spark, world, tmp_path):
    query = (
        flows.hourly_revenue(enriched_days(spark, world, tmp_path), "30 minutes")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = marts.mart_sales(world.read("silver.sales_enriched"))
    last = got.agg(F.max("sale_hour")).first()[0]
    assert got.count() > 0.9 * want.count()
    assert rows(got) == rows(want.where(F.col("sale_hour") <= F.lit(last)).select(*got.columns))


def enriched_days(spark, wh, tmp_path):
    """Silver rewritten as one file per sale day, read in date order."""
    silver = wh.read("silver.sales_enriched").drop("ingest")
    days = sorted(r[0] for r in silver.select("sale_date_only").distinct().collect())
    target = str(tmp_path / "days")
    for day in days:
        silver.where(F.col("sale_date_only") == F.lit(day)).coalesce(1).write.mode("append").parquet(target)
    return spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", 6).parquet(target)


def test_dedup_stream_keeps_one_row_per_sale(spark, world, tmp_path):
    stream = flows.deduplicated(flows.read_lake_stream(spark, world.raw, 3), "60 days")
    query = (
        stream.select("sale_id", "amount")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == got.select("sale_id").distinct().count()
    assert got.where("amount <= 0").count() == 0
    clean = lake.read_lake(spark, world.raw).dropna(subset=["sale_id", "customer_id", "product_id", "amount"])
    ids = clean.groupBy("sale_id").agg(F.max("amount").alias("best"), F.min("amount").alias("worst"))
    certain = ids.where("worst > 0").select("sale_id")
    assert certain.exceptAll(got.select("sale_id")).count() == 0


def test_stock_stream_ends_where_the_replay_ends(spark, sf, world, tmp_path):
    flows.stream_stock(world, enriched_stream(spark, world), str(tmp_path / "cp")).awaitTermination()
    level = world.latest("inventory")
    silver = world.read("silver.sales_enriched")
    sold = stock.sold_quantities(silver, "2023-01-01", "2025-01-01")
    want = stock.deduct_stock(samples.inventory(spark, sf), sold)
    assert rows(level.select("product_id", "stock_qty")) == rows(want.select("product_id", "stock_qty"))
    replay = stock.replay_stock(samples.inventory(spark, sf), silver)
    end = replay.groupBy("product_id").agg(F.min("stock_after").cast("int").alias("stock_qty"))
    touched = level.join(end.select("product_id"), "product_id", "left_semi").select("product_id", "stock_qty")
    assert rows(touched) == rows(end)
    alerts = world.read("inventory_alerts")
    assert alerts.count() == alerts.select("alert_id").distinct().count() > 0


def test_rfm_stream_equals_full(spark, world, tmp_path):
    path = str(tmp_path / "rfm")
    flows.stream_rfm(enriched_stream(spark, world), path, str(tmp_path / "cp")).awaitTermination()
    got = flows.rfm_totals(spark, path)
    want = rfm.rfm_base(world.read("silver.sales_enriched"))
    assert rows(got) == rows(want.select(*got.columns))


def test_materialize_cuts_the_lineage(spark):
    assert materialize(spark.range(3)).count() == 3
