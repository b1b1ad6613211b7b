"""Gold marts: hourly revenue, customer accounts and stock status."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.expressions import cut, mean_price, money_sum, on, stock_status
from salesmart.schemas import MONEY

SALES_KEYS = ("store_id", "category", "sale_hour")
SALES_UPDATES = ("total_revenue", "order_count", "avg_order_value")
ACCOUNT_KEYS = ("customer_id", "snapshot_date")
ACCOUNT_UPDATES = ("segment", "frequency", "monetary", "recency_days")
INVENTORY_KEYS = ("product_id",)
# Name, category and threshold stay as first inserted.
INVENTORY_UPDATES = ("stock_qty", "status", "alert_count")


def mart_sales(silver: DataFrame, dates: Iterable | None = None) -> DataFrame:
    """Revenue, orders and average order value per store, category and hour, for some days or all."""
    if dates is not None:
        silver = silver.where(F.col("sale_date_only").isin([on(day) for day in dates]))
    return silver.groupBy(
        "store_id",
        F.coalesce("category", F.lit("Unknown")).alias("category"),
        cut("hour", F.col("sale_date")).alias("sale_hour"),
    ).agg(
        money_sum().alias("total_revenue"),
        F.count(F.lit(1)).alias("order_count"),
        mean_price().alias("avg_order_value"),
    )


def mart_account(rfm_snapshot: DataFrame, snapshot_date) -> DataFrame:
    """Account rows of one snapshot day."""
    return rfm_snapshot.where(F.col("snapshot_date") == on(snapshot_date)).select(
        "customer_id",
        "segment",
        "frequency",
        F.round("monetary", 2).cast(MONEY).alias("monetary"),
        "recency_days",
        "snapshot_date",
    )


def open_alert_counts(alerts: DataFrame) -> DataFrame:
    """Unresolved alerts per product, aggregated before any join so a noisy product ships one row per task."""
    return alerts.where(~F.col("resolved")).groupBy("product_id").agg(F.count("alert_id").alias("alert_count"))


def mart_inventory(inventory: DataFrame, products: DataFrame, alerts: DataFrame) -> DataFrame:
    """Stock level, status and open alerts per stocked product; products without alerts count zero."""
    return (
        inventory.select("product_id", "stock_qty", "restock_threshold")
        .join(products.select("product_id", "product_name", "category"), "product_id")
        .join(open_alert_counts(alerts), "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            "stock_qty",
            "restock_threshold",
            stock_status(F.col("stock_qty"), F.col("restock_threshold")).alias("status"),
            F.coalesce("alert_count", F.lit(0)).cast("bigint").alias("alert_count"),
        )
    )
