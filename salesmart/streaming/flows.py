"""The hourly jobs as Structured Streaming queries over the lake.

Every query runs with ``availableNow``: it processes what has arrived, in batches limited by the source, and stops;
a longer-lived trigger needs no other change. Sinks written by ``foreachBatch`` key their output by batch id, so a
batch that is replayed after a failure replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesmart.functions.expressions import exact_mean
from salesmart.operators import quality, silver, stock
from salesmart.operators.fast_track import fast_track_messages
from salesmart.schemas import LAKE_SALES, MONEY, PRICE
from salesmart.session import materialize
from salesmart.sources import lake
from salesmart.sources.warehouse import Warehouse


def read_lake_stream(
    spark: SparkSession, root: str, files_per_batch: int | None = None, schema: T.StructType = LAKE_SALES
) -> DataFrame:
    """New lake files as a stream, with their arrival order inside a batch.

    ``schema`` is that of the files; it differs from the canonical one where another writer filled the lake.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return lake.conform_raw(quality.with_file_order(reader.parquet(root)))


def _run(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    writer = df.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _batch_name(batch_id: int) -> str:
    # Sorts by batch, and after every version named by a run time.
    return f"batch-{batch_id:012d}"


# --- silver --------------------------------------------------------------------------------------------------


def stream_silver(wh: Warehouse, source: DataFrame, checkpoint: str, processed_at) -> StreamingQuery:
    """Clean and enrich arriving files into the fact table.

    Repeats are removed inside one ingest hour of a batch, the scope of the hourly job; products are read per
    batch, so a changed product applies from the next one.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        clean = quality.clean_batch(batch, scope=["year", "month", "day", "hour"])
        rows = silver.enrich(clean, wh.latest_or_empty("products"), processed_at)
        wh.replace_run("silver.sales_enriched", "ingest", _batch_name(batch_id), rows)

    return _run(source, checkpoint, each)


def _first_per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        repeats = batch.column("sale_id").to_pandas().duplicated().to_numpy()
        yield batch.filter(pa.array(~repeats))


def once_per_sale(stream: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """One complete row per sale id across batches, for repeats that arrive within ``lateness`` of each other; of
    repeats in one batch, any.

    Spark's stateful operator ships every row to its key. Repeats inside an Arrow batch are dropped before that,
    with the same result, so an id that fills a third of a stream sends one row per batch. State is dropped once
    the watermark has passed.
    """
    complete = quality.drop_incomplete(stream)
    thinned = complete.mapInArrow(_first_per_batch, complete.schema)
    timed = thinned.withColumn("event_time", F.col("sale_date").cast("timestamp"))
    return timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["sale_id"])


def deduplicated(stream: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """The same with amounts checked afterwards.

    Which of an id's rows is met first is up to the tasks: where repeats differ in their amount, use ``stream_silver``,
    which keeps the first arrival.
    """
    return quality.keep_positive(once_per_sale(stream, lateness))


# --- messages ------------------------------------------------------------------------------------------------


def fast_track_stream(stream: DataFrame, above=400) -> DataFrame:
    """High-value sales as key/value messages; write them with ``external.send_stream``."""
    return fast_track_messages(stream, above)


# --- revenue -------------------------------------------------------------------------------------------------


def hourly_revenue(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Revenue, orders and average per store, category and hour of an enriched stream.

    In append mode an hour is emitted once the watermark has closed it; the last hours stay open.
    """
    timed = stream.withColumn("event_time", F.col("sale_date").cast("timestamp"))
    grouped = timed.withWatermark("event_time", lateness).groupBy(
        F.window("event_time", "1 hour").alias("hour"),
        "store_id",
        F.coalesce("category", F.lit("Unknown")).alias("category"),
    )
    return grouped.agg(
        F.sum("amount").cast(MONEY).alias("total_revenue"),
        F.count(F.lit(1)).alias("order_count"),
        exact_mean(F.sum("amount"), F.count("amount"), 2).cast(PRICE).alias("avg_order_value"),
    ).select(
        "store_id",
        "category",
        F.col("hour.start").cast("timestamp_ntz").alias("sale_hour"),
        "total_revenue",
        "order_count",
        "avg_order_value",
    )


# --- stock ---------------------------------------------------------------------------------------------------


def stream_stock(wh: Warehouse, enriched: DataFrame, checkpoint: str) -> StreamingQuery:
    """Deduct every batch's sales from stock and raise alerts.

    Stock levels are versions named by batch: the first starts from the newest level of the hourly job, a
    replayed one again from the version before it. The batch's latest sale stands for "now".
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        sold = materialize(
            batch.groupBy("product_id").agg(F.count(F.lit(1)).alias("sold_qty"), F.max("sale_date").alias("_last"))
        )
        now = sold.agg(F.max("_last")).first()[0]
        if now is None:
            return
        version = _batch_name(batch_id)
        inventory = wh.latest_or_empty("inventory", before=version)
        sold = sold.drop("_last")
        alerts = wh.read("inventory_alerts").where(F.col("run") < version)
        due = stock.new_alerts(stock.stock_movement(inventory, sold), alerts, now)
        wh.replace_run("inventory_alerts", "run", version, due)
        wh.save_version("inventory", version, stock.deduct_stock(inventory, sold, now))

    return _run(enriched, checkpoint, each)


# --- RFM -----------------------------------------------------------------------------------------------------


def stream_rfm(enriched: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Running totals per customer: every batch writes the customers it changed.

    The table is a log of changed rows keyed by batch; ``rfm_totals`` reads the newest row per customer. A batch
    therefore costs its own customers, not the whole customer base.
    """
    totals = enriched.groupBy("customer_id").agg(
        F.max("sale_date").alias("last_purchase"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("amount").cast(MONEY).alias("monetary"),
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={_batch_name(batch_id)}")

    return _run(totals, checkpoint, each, mode="update")


def rfm_totals(spark: SparkSession, path: str) -> DataFrame:
    """Newest totals per customer from the change log."""
    log = spark.read.parquet(path)
    newest = F.max_by(F.struct("last_purchase", "frequency", "monetary"), "batch").alias("t")
    return log.groupBy("customer_id").agg(newest).select("customer_id", "t.*")
