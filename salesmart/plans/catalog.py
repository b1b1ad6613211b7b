"""Every query over the sample tables, by name. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.expressions import at, cut
from salesmart.operators import affinity, cards, fast_track, maintained, marts, quality, recommend, rfm, silver, stock, upsert
from salesmart.operators.gram import gram, pack_rows
from salesmart.plans import jobs
from salesmart.schemas import LAKE_PARTITIONS, MONEY
from salesmart.session import materialize, prepare, run_folder
from salesmart.sources import lake, samples
from salesmart.sources.commits import CommittedTable, MergedTable, SummedTable
from salesmart.sources.external import send_stream
from salesmart.sources.skipping import SkippingTable
from salesmart.sources.warehouse import Warehouse
from salesmart.streaming import flows, keyed, revenue

Query = Callable[[SparkSession, str], DataFrame]

# Evaluation times over the samples (fixed values).
CARDS_AS_OF = "2024-01-30 18:00:00"
SALES_DAY = "2024-01-15"
STOCK_FROM, STOCK_TO = "2024-01-15 12:00:00", "2024-01-15 18:00:00"
RFM_PREVIOUS, RFM_AS_OF = "2001-05-31 23:00:00", "2001-08-01 23:00:00"  # the last after the last order
RFM_STALE_BEFORE = "2001-03-01 00:00:00"
EDGE_PREVIOUS, EDGE_AS_OF = "2024-01-14 23:00:00", "2024-01-31 23:00:00"  # the last after the last event
BROKEN_DAYS = ("05", "17")
RULES_SUPPORT = "0.05"
HISTORY_CUT = "2024-01-15 00:00:00"
TREND_DAYS, TREND_AS_OF = ("2024-01-15", "2024-01-20"), "2024-02-10 18:00:00"  # the card begins inside a day
CF_CUSTOMER = 1
SEARCHED_PRODUCT, SEARCHED_DAYS = 7, ("2024-01-10", "2024-01-12")  # and the unknown product on these days
ITEM_IDS = [-1, *range(100)]  # the sample's product ids: the unknown one and 0 … 99

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- silver --------------------------------------------------------------------------------------------------


@query
def scan_hour_partition(spark, sf_dir):
    """Raw rows of one ingest hour, from the sample as a partitioned lake; a run at 13:00 ingests the hour before."""
    ingested = cut("hour", F.col("sale_date")) + F.expr("INTERVAL 1 HOUR")
    raw = lake.with_partitions(samples.raw_sales(spark, sf_dir), ingested)
    root = f"{_sink(spark)}/lake"
    raw.repartition(*LAKE_PARTITIONS).write.partitionBy(*LAKE_PARTITIONS).parquet(root)
    return lake.read_hour(spark, root, "2024-01-15 13:00:00").drop("_file", "_row")


@query
def quality_not_null(spark, sf_dir):
    return quality.drop_incomplete(samples.raw_sales(spark, sf_dir))


@query
def dedup_first(spark, sf_dir):
    return quality.keep_first(quality.drop_incomplete(samples.raw_sales(spark, sf_dir)), ["sale_id"], ["arrival_seq"])


@query
def quality_check(spark, sf_dir):
    return quality.clean_batch(samples.raw_sales(spark, sf_dir), arrival=["arrival_seq"])


@query
def quality_counts(spark, sf_dir):
    return quality.quality_counts(samples.raw_sales(spark, sf_dir), ["arrival_seq"])


@query
def silver_enriched(spark, sf_dir):
    return samples.sales_enriched(spark, sf_dir)


@query
def silver_rebuild(spark, sf_dir):
    """Cleaning per file in the rows' physical order, as the rebuild job does."""
    events = quality.with_file_order(samples.table(spark, sf_dir, "events"))
    raw = samples.sales_from_events(events, "_file", "_row")
    clean = quality.clean_batch(raw, scope=["_file"])
    return silver.enrich(clean, samples.products(spark, sf_dir))


@query
def raw_quarantine(spark, sf_dir):
    """A rebuild from a lake with a file for every day, two of them broken: the verification row and the broken files."""
    wh = _stream_warehouse(spark, sf_dir)
    days = lake.with_partitions(samples.raw_sales(spark, sf_dir), cut("day", F.col("sale_date")))
    days.repartition("day").sortWithinPartitions("arrival_seq").write.partitionBy(*LAKE_PARTITIONS).parquet(wh.raw)
    jvm = spark.sparkContext._jvm
    for day in BROKEN_DAYS:
        folder = jvm.org.apache.hadoop.fs.Path(f"{wh.raw}/year=2024/month=01/day={day}/hour=00")
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.listStatus(folder):
            out = fs.create(status.getPath(), True)
            out.write(bytearray(b"PAR1 and no more"))
            out.close()
    check = jobs.rebuild_silver(wh, CARDS_AS_OF)
    broken = F.transform("skipped_files", lambda f: F.concat(F.regexp_extract(f["path"], "day=([0-9]+)", 1), F.lit(" "), f["reason"]))
    return check.select("total", "has_name", "from_date", "to_date", F.array_join(F.array_sort(broken), ", ").alias("broken"))


@query
def silver_verify(spark, sf_dir):
    return silver.verify_silver(samples.sales_enriched(spark, sf_dir))


@query
def silver_history(spark, sf_dir):
    """The fact table as of five moments: after two runs, a run again, a rebuild, and a run again after that."""
    sales = samples.sales_enriched(spark, sf_dir).select("sale_id", "amount", "sale_date", "event_type", F.lit("").alias("ingest"))
    facts = CommittedTable(spark, f"{_sink(spark)}/facts", sales.schema, run_column="ingest")
    early = sales.where(F.col("sale_date") < at(HISTORY_CUT)).withColumn("ingest", F.lit("early"))
    late = sales.where(F.col("sale_date") >= at(HISTORY_CUT)).withColumn("ingest", F.lit("late"))
    facts.replace_run("early", early, "2024-02-01 01:00:00")
    facts.replace_run("late", late, "2024-02-01 02:00:00")
    facts.replace_run("early", early.where("event_type = 'purchase'"), "2024-02-01 03:00:00")
    facts.replace_all(facts.read().where("amount > 100"), "2024-02-01 04:00:00")
    facts.replace_run("late", late.where("event_type <> 'error'"), "2024-02-01 05:00:00")
    states = [facts.read(facts.version_at(f"2024-02-01 0{hour}:30:00")).withColumn("hour", F.lit(hour)) for hour in range(1, 6)]
    return reduce(DataFrame.unionByName, states)


@query
def sales_of_product(spark, sf_dir):
    """All sales of one product, and of a frequent one on some days, found by the index of a clustered table of two runs."""
    sales = samples.sales_enriched(spark, sf_dir).select("sale_id", "customer_id", "store_id", "product_id", "amount", "sale_date")
    facts = SkippingTable(spark, f"{_sink(spark)}/facts", sales.schema, ["product_id", "sale_date", "product_id", "customer_id"])
    facts.replace_run("early", sales.where(F.col("sale_date") < at(HISTORY_CUT)))
    facts.replace_run("late", sales.where(F.col("sale_date") >= at(HISTORY_CUT)))
    days = tuple(f"{day} 00:00:00" for day in SEARCHED_DAYS)
    return facts.search({"product_id": SEARCHED_PRODUCT}).unionByName(facts.search({"product_id": -1}, {"sale_date": days}))


@query
def fast_track_filter(spark, sf_dir):
    return fast_track.fast_track_filter(samples.raw_sales(spark, sf_dir)).select(
        "sale_id", "customer_id", "store_id", "product_id", "amount", "sale_date", "arrival_seq"
    )


@query
def fast_track_json(spark, sf_dir):
    """Messages of the order lines above 50,000."""
    return fast_track.fast_track_messages(samples.line_sales(spark, sf_dir), above=50_000)


# --- sales mart ----------------------------------------------------------------------------------------------


def _sales_mart(spark, sf_dir) -> DataFrame:
    return marts.mart_sales(samples.sales_enriched(spark, sf_dir))


@query
def mart_sales(spark, sf_dir):
    return _sales_mart(spark, sf_dir)


@query
def mart_sales_day(spark, sf_dir):
    return marts.mart_sales(samples.sales_enriched(spark, sf_dir), [SALES_DAY])


@query
def upsert_mart_sales(spark, sf_dir):
    sales = samples.sales_enriched(spark, sf_dir)
    before = marts.mart_sales(sales.where(F.col("event_type") != "error"))
    day = marts.mart_sales(sales, [SALES_DAY])
    return upsert.merge_upsert(before, day, marts.SALES_KEYS, marts.SALES_UPDATES, keys_unique=True)


@query
def upsert_mart_sales_log(spark, sf_dir):
    """The mart as a log of three batches, the last with NULL keys, compacted after the second."""
    sales = samples.sales_enriched(spark, sf_dir)
    stale, day = sales.where(F.col("event_type") != "error"), marts.mart_sales(sales, [SALES_DAY])
    log = MergedTable(spark, f"{_sink(spark)}/mart", T.StructType(day.schema.fields), marts.SALES_KEYS, marts.SALES_UPDATES)
    log.upsert(marts.mart_sales(stale, [SALES_DAY]), keys_unique=True)
    log.upsert(marts.mart_sales(stale), keys_unique=True)
    log.compact_step(fan_in=2)
    log.upsert(day.unionByName(day.where("store_id = 1").withColumn("store_id", F.lit(None).cast("bigint"))))
    return log.read()


# --- RFM and account mart --------------------------------------------------------------------------------------


def _orders_before(spark, sf_dir, moment) -> DataFrame:
    return samples.order_sales(spark, sf_dir).where(F.col("sale_date") < at(moment))


def _two_snapshots(spark, sf_dir) -> DataFrame:
    orders = samples.order_sales(spark, sf_dir)
    return rfm.rfm_full(orders, RFM_PREVIOUS, "as_of").unionByName(rfm.rfm_full(orders, RFM_AS_OF))


@query
def rfm_full(spark, sf_dir):
    return rfm.rfm_full(samples.order_sales(spark, sf_dir), RFM_AS_OF)


@query
def rfm_delta(spark, sf_dir):
    return rfm.rfm_delta(rfm.new_since(samples.order_sales(spark, sf_dir), RFM_PREVIOUS, RFM_AS_OF))


@query
def rfm_incremental(spark, sf_dir):
    """Half-open ranges: equals the full run."""
    sales = samples.sales_enriched(spark, sf_dir)
    previous = rfm.rfm_full(sales, EDGE_PREVIOUS, "as_of")
    return rfm.rfm_incremental(previous, sales, EDGE_PREVIOUS, EDGE_AS_OF)


@query
def rfm_incremental_snapshot_date(spark, sf_dir):
    """The snapshot-date boundary: the previous run's day counts twice, and nothing bounds the new rows."""
    sales = samples.sales_enriched(spark, sf_dir)
    previous = rfm.rfm_full(sales, EDGE_PREVIOUS, "as_of")
    return rfm.rfm_incremental(previous, sales, EDGE_PREVIOUS, EDGE_AS_OF, boundary="snapshot_date")


@query
def rfm_latest_snapshot(spark, sf_dir):
    return rfm.latest_snapshot(_two_snapshots(spark, sf_dir))


@query
def rfm_segment_counts(spark, sf_dir):
    return rfm.segment_counts(rfm.rfm_full(samples.order_sales(spark, sf_dir), RFM_AS_OF))


@query
def mart_account(spark, sf_dir):
    return marts.mart_account(_two_snapshots(spark, sf_dir), RFM_AS_OF)


@query
def upsert_mart_account(spark, sf_dir):
    """History of two days; the second day was first written from incomplete data."""
    orders = samples.order_sales(spark, sf_dir)
    stale = rfm.score(rfm.rfm_base(_orders_before(spark, sf_dir, RFM_STALE_BEFORE)), RFM_AS_OF)
    history = marts.mart_account(rfm.rfm_full(orders, RFM_PREVIOUS, "as_of"), RFM_PREVIOUS)
    target = history.unionByName(marts.mart_account(stale, RFM_AS_OF))
    updates = marts.mart_account(rfm.rfm_full(orders, RFM_AS_OF), RFM_AS_OF)
    return upsert.merge_upsert(target, updates, marts.ACCOUNT_KEYS, marts.ACCOUNT_UPDATES, keys_unique=True)


# --- stock ---------------------------------------------------------------------------------------------------


def _alerts_until(spark, sf_dir, moment) -> DataFrame:
    return samples.inventory_alerts(spark, sf_dir).where(F.col("alert_time") < at(moment))


def _sold(spark, sf_dir) -> DataFrame:
    return stock.sold_quantities(samples.sales_enriched(spark, sf_dir), STOCK_FROM, STOCK_TO)


def _inventory_mart(spark, sf_dir) -> DataFrame:
    return marts.mart_inventory(
        samples.inventory(spark, sf_dir), samples.products(spark, sf_dir), samples.inventory_alerts(spark, sf_dir)
    )


@query
def hour_sold_qty(spark, sf_dir):
    return _sold(spark, sf_dir)


@query
def inventory_after_sales(spark, sf_dir):
    return stock.deduct_stock(samples.inventory(spark, sf_dir), _sold(spark, sf_dir))


@query
def inventory_new_alerts(spark, sf_dir):
    movement = stock.stock_movement(samples.inventory(spark, sf_dir), _sold(spark, sf_dir))
    return stock.new_alerts(movement, _alerts_until(spark, sf_dir, STOCK_TO), STOCK_TO)


@query
def inventory_alert_report(spark, sf_dir):
    return stock.alert_report(samples.inventory_alerts(spark, sf_dir), samples.products(spark, sf_dir), SALES_DAY)


@query
def inventory_replay(spark, sf_dir):
    return stock.replay_stock(samples.inventory(spark, sf_dir), samples.sales_enriched(spark, sf_dir))


@query
def mart_inventory(spark, sf_dir):
    return _inventory_mart(spark, sf_dir)


@query
def upsert_mart_inventory(spark, sf_dir):
    """Rows already in the mart keep their old name and threshold; only stock, status and alerts move."""
    now = _inventory_mart(spark, sf_dir)
    old = now.where(F.col("category") != "SMALL").select(
        "product_id",
        F.concat("product_name", F.lit(" (old)")).alias("product_name"),
        "category",
        F.lit(99).alias("stock_qty"),
        F.lit(40).alias("restock_threshold"),
        F.lit("OK").alias("status"),
        F.lit(0).cast("bigint").alias("alert_count"),
    )
    return upsert.merge_upsert(old, now, marts.INVENTORY_KEYS, marts.INVENTORY_UPDATES)


@query
def insert_if_absent(spark, sf_dir):
    products = samples.products(spark, sf_dir)
    present = products.where(F.col("category") != "SMALL").withColumn(
        "product_name", F.concat("product_name", F.lit(" (old)"))
    )
    twice = products.union(products.withColumn("product_name", F.concat("product_name", F.lit(" (again)"))))
    return upsert.insert_if_absent(present, twice, ["product_id"], ["product_name"])


# --- affinity and recommendations ------------------------------------------------------------------------------


@query
def distinct_counts(spark, sf_dir):
    return affinity.distinct_counts(samples.sales_enriched(spark, sf_dir))


@query
def customer_basket(spark, sf_dir):
    return affinity.customer_basket(samples.line_sales(spark, sf_dir))


@query
def affinity_item_support(spark, sf_dir):
    return affinity.item_support(affinity.customer_basket(samples.line_sales(spark, sf_dir)))


@query
def affinity_pair_support(spark, sf_dir):
    basket = materialize(affinity.customer_basket(samples.line_sales(spark, sf_dir)))
    customers = basket.agg(F.count_distinct("customer_id")).first()[0]
    return affinity.pair_support(basket, affinity.support_threshold(customers))


def _rules(spark, sf_dir) -> DataFrame:
    return affinity.association_rules(samples.line_sales(spark, sf_dir))


@query
def affinity_rules(spark, sf_dir):
    return _rules(spark, sf_dir)


@query
def affinity_rules_top(spark, sf_dir):
    return affinity.top_rules(_rules(spark, sf_dir), 5)


@query
def affinity_rules_two_items(spark, sf_dir):
    """Rules with two antecedents that a twentieth of all customers support."""
    return affinity.two_item_rules(samples.line_sales(spark, sf_dir), RULES_SUPPORT)


@query
def user_item_spend(spark, sf_dir):
    return recommend.user_item_spend(samples.sales_enriched(spark, sf_dir))


@query
def user_item_pivot(spark, sf_dir):
    return recommend.user_item_pivot(samples.sales_enriched(spark, sf_dir), ITEM_IDS)


@query
def product_name_lookup(spark, sf_dir):
    return recommend.product_names(samples.sales_enriched(spark, sf_dir))


@query
def unbought_pairs(spark, sf_dir):
    """What customers touched in any way but never purchased."""
    sales = samples.sales_enriched(spark, sf_dir)
    return recommend.unbought_pairs(sales, sales.where(F.col("event_type") == "purchase"))


@query
def unbought_counts(spark, sf_dir):
    """For every customer, how many products of the catalogue they have never bought."""
    return recommend.unbought_counts(samples.products(spark, sf_dir), samples.sales_enriched(spark, sf_dir))


@query
def spend_top5_per_customer(spark, sf_dir):
    return recommend.top_per_customer(recommend.user_item_spend(samples.sales_enriched(spark, sf_dir)), score="spend")


@query
def cf_recommendations(spark, sf_dir):
    return recommend.recommend(samples.sales_enriched(spark, sf_dir))


@query
def cf_recommendations_one_factor(spark, sf_dir):
    """The same with a single factor, which SQL can follow by power iteration."""
    return _recommendation_mart(spark, sf_dir)


@query
def spend_gram(spark, sf_dir):
    """For every two products the sum over customers of the products of their spends, in the operator's matrix form."""
    spend = materialize(recommend.user_item_spend(samples.sales_enriched(spark, sf_dir)))
    items = materialize(affinity.number_items(spend.select("product_id").distinct(), "product_id"))
    cells = spend.join(items, "product_id").select("customer_id", "item", F.col("spend").cast("double").alias("spend"))
    sums = gram(pack_rows(cells, "customer_id", "item", "spend"))
    one, two = (items.select(F.col("item").alias(i), F.col("product_id").alias(p)) for i, p in (("i", "_p"), ("j", "_q")))
    return sums.join(one, "i").join(two, "j").select(
        F.least("_p", "_q").alias("product_a"), F.greatest("_p", "_q").alias("product_b"),
        F.round("x", 4).cast("decimal(24,4)").alias("total"))


# --- dashboards ------------------------------------------------------------------------------------------------


def _account_mart(spark, sf_dir) -> DataFrame:
    snapshots = _two_snapshots(spark, sf_dir)
    return marts.mart_account(snapshots, RFM_PREVIOUS).unionByName(marts.mart_account(snapshots, RFM_AS_OF))


def _recommendation_mart(spark, sf_dir) -> DataFrame:
    """Recommendations by one factor: real ones, and SQL can check them."""
    return recommend.recommend(samples.sales_enriched(spark, sf_dir), factors=1)


def _card(name: str, build: Callable[[DataFrame], DataFrame], mart: Query) -> None:
    def run(spark, sf_dir):
        return build(mart(spark, sf_dir))

    run.__name__ = name
    query(run)


def _register_cards() -> None:
    def dated(fn):
        return lambda mart: fn(mart, CARDS_AS_OF)

    _card("card_store_revenue_7d", dated(cards.store_revenue_7d), _sales_mart)
    _card("card_sales_trend_30d", dated(cards.sales_trend_30d), _sales_mart)
    _card("card_top10_products_7d", dated(cards.top10_products_7d), samples.sales_enriched)
    _card("card_category_revenue_7d", dated(cards.category_revenue_7d), _sales_mart)
    _card("card_segment_summary", cards.segment_summary, _account_mart)
    _card("card_segment_summary_latest", lambda mart: cards.segment_summary(mart, latest_only=True), _account_mart)
    _card("card_top_champions", cards.top_champions, _account_mart)
    _card("card_at_risk", cards.at_risk, _account_mart)
    _card("card_monetary_frequency", cards.monetary_frequency, _account_mart)
    _card("card_inventory_overview", cards.inventory_overview, _inventory_mart)
    _card("card_status_counts", cards.status_counts, _inventory_mart)
    _card("panel_revenue_today", dated(cards.revenue_today), _sales_mart)
    _card("panel_orders_today", dated(cards.orders_today), _sales_mart)
    _card("panel_avg_order_today", dated(cards.avg_order_today), _sales_mart)
    _card("panel_open_alerts", cards.open_alerts, samples.inventory_alerts)
    _card("panel_hourly_by_store_24h", dated(cards.hourly_by_store_24h), _sales_mart)
    _card("panel_store_today", dated(cards.store_today), _sales_mart)
    _card("panel_category_today", dated(cards.category_today), _sales_mart)
    _card("panel_inventory_top20", cards.inventory_top20, _inventory_mart)
    _card("panel_daily_7d", dated(cards.daily_7d), _sales_mart)
    _card("panel_customer_count", cards.customer_count, _account_mart)
    _card("panel_champions_count", cards.champions_count, _account_mart)
    _card("panel_at_risk_count", cards.at_risk_count, _account_mart)
    _card("panel_lost_count", cards.lost_count, _account_mart)
    _card("panel_segment_distribution", cards.segment_distribution, _account_mart)
    _card("panel_segment_avg_monetary", cards.segment_avg_monetary, _account_mart)
    _card("panel_top20_customers", cards.top20_customers, _account_mart)
    _card("panel_recency_values", cards.recency_values, _account_mart)
    _card("panel_recency_histogram", lambda mart: cards.histogram(cards.recency_values(mart), "30"), _account_mart)
    _card("panel_recency_histogram_auto", lambda mart: cards.histogram(cards.recency_values(mart)), _account_mart)
    _card("panel_top_rules", cards.top_rules, _rules)
    _card("panel_lift_values", cards.lift_values, _rules)
    _card("panel_lift_histogram", lambda mart: cards.histogram(cards.lift_values(mart), "0.1"), _rules)
    _card("panel_lift_histogram_auto", lambda mart: cards.histogram(cards.lift_values(mart)), _rules)
    _card("card_cf_for_customer", lambda mart: cards.cf_for_customer(mart, CF_CUSTOMER), _recommendation_mart)
    _card("panel_top_recommended", cards.top_recommended, _recommendation_mart)


_register_cards()


@query
def customers_by_range(spark, sf_dir):
    """Distinct customers of the last 1, 7 and 30 days, each from the same bitmaps by day."""
    bitmaps = materialize(maintained.customer_bitmaps(samples.sales_enriched(spark, sf_dir)))
    return reduce(DataFrame.unionByName, [maintained.distinct_customers(bitmaps, CARDS_AS_OF, days) for days in (1, 7, 30)])


@query
def card_sales_trend_incremental(spark, sf_dir):
    """The trend card after two upserts, from day totals that only the replaced hours have changed."""
    sales = samples.sales_enriched(spark, sf_dir)
    full = materialize(marts.mart_sales(sales))
    root = _sink(spark)
    mart = MergedTable(spark, f"{root}/mart", T.StructType(full.schema.fields), marts.SALES_KEYS, marts.SALES_UPDATES)
    days = SummedTable(spark, f"{root}/days", T.StructType([
        T.StructField("day", T.DateType()), T.StructField("total_revenue", MONEY), T.StructField("orders", T.LongType())]), ["day"])
    stale = marts.mart_sales(sales.where(F.col("event_type") != "error"))
    for number, fresh in enumerate([stale, *(full.where(F.to_date("sale_hour") == F.lit(day).cast("date")) for day in TREND_DAYS)]):
        fresh = materialize(fresh)
        days.add(f"{number:04d}", maintained.day_changes(maintained.replaced_rows(mart.read(), fresh, marts.SALES_KEYS), fresh))
        mart.upsert(fresh, keys_unique=True)
    return maintained.sales_trend(days.read(), mart.read(), TREND_AS_OF)


# --- streams -------------------------------------------------------------------------------------------------
# Each runs the stream over the events file until it is consumed and returns what the sink holds.


def _event_stream(spark, sf_dir) -> DataFrame:
    schema = samples.table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return samples.sales_from_events(files)


def _silver_stream(spark, sf_dir) -> DataFrame:
    """The cleaned and enriched sales as a stream of files, as the marts' streams read them."""
    clean, folder = samples.sales_enriched(spark, sf_dir), f"{_sink(spark)}/silver"
    clean.write.parquet(folder)
    return spark.readStream.schema(clean.schema).parquet(folder)


def _sink(spark) -> str:
    return f"{run_folder(spark)}/stream-{uuid.uuid4().hex}"


def _drained(spark, stream: DataFrame) -> DataFrame:
    folder = _sink(spark)
    send_stream(stream, f"{folder}/checkpoint", sink="parquet", path=f"{folder}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def _stream_warehouse(spark, sf_dir) -> Warehouse:
    wh = Warehouse(spark, _sink(spark))
    wh.save_version("products", "0", samples.products(spark, sf_dir))
    wh.save_version("inventory", "0", samples.inventory(spark, sf_dir))
    return wh


@query
def stream_silver(spark, sf_dir):
    """Arriving files cleaned per ingest hour and enriched."""
    wh = _stream_warehouse(spark, sf_dir)
    ingested = cut("hour", F.col("sale_date")) + F.expr("INTERVAL 1 HOUR")
    source = lake.with_partitions(_event_stream(spark, sf_dir), ingested)
    arrival = source.withColumns({"_file": F.lit(""), "_row": F.col("arrival_seq")})
    flows.stream_silver(wh, arrival, f"{wh.root}/checkpoint", CARDS_AS_OF).awaitTermination()
    return wh.read("silver.sales_enriched").drop("ingest", "processed_at")


@query
def stream_fast_track(spark, sf_dir):
    return _drained(spark, flows.fast_track_stream(_event_stream(spark, sf_dir), above=200))


@query
def stream_sales_once(spark, sf_dir):
    return _drained(spark, flows.once_per_sale(_event_stream(spark, sf_dir)).select("sale_id"))


def _arriving(spark, frame: DataFrame, order: str, parts: int, column) -> DataFrame:
    """``frame`` as a stream of ``parts`` batches, cut by ``column`` (0 to parts - 1), each written in ``order``."""
    folder = f"{_sink(spark)}/arriving"
    dealt = materialize(frame.withColumn("_part", column))
    for part in range(parts):
        dealt.where(F.col("_part") == part).drop("_part").repartition(1).sortWithinPartitions(order).write.mode("append").parquet(folder)
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query
def stream_first_sale(spark, sf_dir):
    """Whole first rows over three batches: every repeat of a sale comes one batch or more after its first row."""
    raw = samples.raw_sales(spark, sf_dir)
    repeat = (F.col("sale_id") != F.col("arrival_seq").cast("string")).cast("int")
    batch = F.when(F.col("arrival_seq") % 20 < 10, repeat).otherwise(1 + repeat)
    stream = _arriving(spark, raw, "arrival_seq", 3, batch)
    return _drained(spark, keyed.first_sales(stream, ["arrival_seq"], timedelta(days=400)))


@query
def stream_alerts(spark, sf_dir):
    """Alerts of four batches in order of time, from stock kept as state, looked at every 20 minutes."""
    sales = samples.sales_enriched(spark, sf_dir).select("product_id", "sale_date")
    stream = _arriving(spark, sales, "sale_date", 4, F.floor((F.dayofmonth("sale_date") - 1) / 8).cast("int"))
    changes = keyed.stock_changes(stream, samples.inventory(spark, sf_dir), "20 minutes", "20 minutes")
    return keyed.alerts_of(_drained(spark, changes))


@query
def stream_hourly_revenue(spark, sf_dir):
    """Hours that the watermark, one hour behind the newest sale, has closed."""
    return _drained(spark, flows.hourly_revenue(_silver_stream(spark, sf_dir)))


@query
def stream_revenue_corrected(spark, sf_dir):
    """Hourly revenue of five batches in shuffled order: most rows come late, and their hours are corrected."""
    sales = samples.sales_enriched(spark, sf_dir).select("sale_id", "store_id", "category", "amount", "sale_date")
    stream = _arriving(spark, sales, "sale_id", 5, F.pmod(F.xxhash64("sale_id"), F.lit(5)).cast("int"))
    mart = revenue.RevenueMart(spark, _sink(spark))
    revenue.stream_revenue(mart, stream, f"{_sink(spark)}/checkpoint").awaitTermination()
    return mart.read(open_hours=True)


@query
def stream_stock_level(spark, sf_dir):
    wh = _stream_warehouse(spark, sf_dir)
    flows.stream_stock(wh, _silver_stream(spark, sf_dir), f"{wh.root}/checkpoint").awaitTermination()
    return wh.latest_or_empty("inventory").select("product_id", "stock_qty", "restock_threshold")


@query
def stream_rfm_totals(spark, sf_dir):
    folder, stream = _sink(spark), _silver_stream(spark, sf_dir)
    flows.stream_rfm(stream, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return flows.rfm_totals(spark, f"{folder}/rows")
