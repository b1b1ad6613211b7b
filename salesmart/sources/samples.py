"""The sample tables (TPC-H-like plus ``events``) seen as the sales model.

About 10 % repeated sale ids, 1 % missing customers, 1 % negative amounts and 5 % sales of an unknown product
(id -1) are derived on purpose, so that every cleaning rule has rows to act on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.quality import clean_batch
from salesmart.operators.silver import enrich


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _item(props: str = "props"):
    return F.get_json_object(props, "$.k").cast("bigint")


def sales_from_events(events: DataFrame, *keep: str) -> DataFrame:
    """The raw sales view of an ``events`` frame, batch or stream; ``keep`` passes further columns through."""
    eid = F.col("event_id")
    return events.select(
        (eid - F.when(eid % 10 == 9, 1).otherwise(0)).cast("string").alias("sale_id"),
        F.when(eid % 97 != 0, F.col("user_id")).alias("customer_id"),
        (eid % 10 + 1).alias("store_id"),
        F.when(eid % 19 == 0, F.lit(-1).cast("bigint")).otherwise(_item()).alias("product_id"),
        F.when(eid % 89 == 0, -F.col("value")).otherwise(F.col("value")).cast("decimal(10,2)").alias("amount"),
        F.col("ts").alias("sale_date"),
        eid.alias("arrival_seq"),
        "event_type",
        *keep,
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from_events(table(spark, sf_dir, "events"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        (F.col("p_partkey") * 37 % 120).cast("int").alias("stock_qty"),
        F.lit(50).alias("restock_threshold"),
    )


def inventory_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return errors.select(
        F.col("event_id").alias("alert_id"),
        _item().alias("product_id"),
        (_item() * 37 % 120).cast("int").alias("stock_qty"),
        F.lit(50).alias("threshold"),
        F.col("ts").alias("alert_time"),
        (F.col("event_id") % 3 != 0).alias("resolved"),
    )


def sales_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = clean_batch(raw_sales(spark, sf_dir), arrival=["arrival_seq"])
    return enrich(clean, products(spark, sf_dir), keep=("event_type",))


def order_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("sale_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.col("o_orderdate").alias("sale_date"),
    )


def line_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sales: a larger fact whose product name is brand and type, so that baskets overlap."""
    lines, orders, parts = (table(spark, sf_dir, name) for name in ("lineitem", "orders", "part"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("sale_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_suppkey").alias("store_id"),
            F.col("l_partkey").alias("product_id"),
            F.concat("p_brand", F.lit(" "), "p_type").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
            F.col("o_orderdate").alias("sale_date"),
        )
    )
