"""High-value sales as JSON messages; the same columns serve batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAST_TRACK_ABOVE = 400
RAW_COLUMNS = ("sale_id", "customer_id", "store_id", "product_id", "amount", "sale_date")


def fast_track_filter(sales: DataFrame, above=FAST_TRACK_ABOVE) -> DataFrame:
    """Sales strictly above the limit."""
    return sales.where(F.col("amount") > F.lit(above))


def as_json(*columns: str) -> Column:
    """One JSON object per row; missing values stay visible as null."""
    options = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
    return F.to_json(F.struct(*columns), options)


def fast_track_messages(sales: DataFrame, above=FAST_TRACK_ABOVE, key: str = "sale_id") -> DataFrame:
    """Key and JSON value of every high-value sale, the shape a message sink takes."""
    return fast_track_filter(sales, above).select(F.col(key).alias("key"), as_json(*RAW_COLUMNS).alias("value"))
