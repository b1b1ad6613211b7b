"""Enrichment of cleaned sales with the product dimension and derived time columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.expressions import at

ENRICHED_COLUMNS = (
    "sale_id",
    "customer_id",
    "store_id",
    "product_id",
    "product_name",
    "category",
    "amount",
    "sale_date",
    "sale_hour",
    "sale_date_only",
)


def enrich(
    sales: DataFrame, products: DataFrame, processed_at: datetime | str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Left join to products plus ``sale_hour`` and ``sale_date_only``; unknown products keep NULL names.

    No join hint: a product table under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast from its measured
    size, a larger one is sort-merge joined, where adaptive execution splits a hot product.
    """
    dimension = products.select("product_id", "product_name", "category")
    sold_at = F.col("sale_date").cast("timestamp_ntz")
    wide = (
        sales.withColumn("sale_date", sold_at)
        .withColumn("sale_hour", F.hour("sale_date"))
        .withColumn("sale_date_only", F.to_date("sale_date"))
        .join(dimension, "product_id", "left")
    )
    columns = [*ENRICHED_COLUMNS, *keep]
    if processed_at is not None:
        wide = wide.withColumn("processed_at", at(processed_at))
        columns.append("processed_at")
    return wide.select(*columns)


def verify_silver(silver: DataFrame) -> DataFrame:
    """Row count, rows with a product name and the date span of the fact table."""
    return silver.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("product_name").alias("has_name"),
        F.min("sale_date_only").alias("from_date"),
        F.max("sale_date_only").alias("to_date"),
    )
