"""Aggregates kept up to date instead of recomputed: day totals behind the trend card, customer bitmaps by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.expressions import at, before, cut, on
from salesmart.schemas import MONEY


# --- day totals ----------------------------------------------------------------------------------------------


def day_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(day, total_revenue, orders): what replacing the mart rows ``old`` by ``new`` changes in the totals of their days.

    Both are rows of the hourly sales mart; old rows are subtracted, new ones added, in one pre-aggregated pass.
    """
    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(F.to_date("sale_hour").alias("day"), (sign * F.col("total_revenue")).cast(MONEY).alias("total_revenue"),
                           (sign * F.col("order_count")).alias("orders"))

    return signed(new, 1).unionByName(signed(old, -1)).groupBy("day").agg(
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"), F.sum("orders").alias("orders"))


def replaced_rows(mart: DataFrame, updates: DataFrame, keys) -> DataFrame:
    """The rows of ``mart`` that an upsert of ``updates`` overwrites; the range of the updates' hours reaches the scan."""
    first, last = updates.agg(F.min("sale_hour"), F.max("sale_hour")).first()
    if first is None:
        return mart.limit(0)
    return mart.where(F.col("sale_hour").between(at(first), at(last))).join(updates.select(*keys), list(keys), "left_semi")


def sales_trend(days: DataFrame, mart: DataFrame, as_of, interval: str = "30 DAYS") -> DataFrame:
    """The 30-day trend card from day totals: whole days from their totals, only the hours of the first, cut one from the
    mart. Days whose rows have all gone are not shown."""
    start = before(as_of, interval)
    first = F.to_date(start)
    whole = days.where((F.col("day") > first) & (F.col("orders") > 0)).select(cut("day", F.col("day").cast("timestamp_ntz")).alias("date"), "total_revenue", "orders")
    cut_day = (
        mart.where((F.col("sale_hour") >= start) & (F.col("sale_hour") < F.date_add(first, 1).cast("timestamp_ntz")))
        .groupBy(cut("day", F.col("sale_hour")).alias("date"))
        .agg(F.sum("total_revenue").cast(MONEY).alias("total_revenue"), F.sum("order_count").alias("orders"))
    )
    return cut_day.unionByName(whole).orderBy("date")


# --- distinct customers --------------------------------------------------------------------------------------


def customer_bitmaps(sales: DataFrame) -> DataFrame:
    """(day, bucket, bits): for each day and range of 32,768 ids the customers who bought, exactly, as a bitmap.

    Any integer id has its place, negative ones too. Bitmaps are combined before the shuffle, so a day or a customer with
    a third of all sales sends 4 KB for each task and range. A customer without an id is not counted.
    """
    known = sales.where("customer_id is not null and sale_date is not null")
    return known.groupBy(F.to_date("sale_date").alias("day"), F.bitmap_bucket_number("customer_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("bits"))


def distinct_customers(bitmaps: DataFrame, day, days: int) -> DataFrame:
    """(days, customers): distinct customers of the ``days`` days that end with ``day``, from the bitmaps alone."""
    window = F.col("day").between(F.date_sub(on(day), days - 1), on(day))
    merged = bitmaps.where(window).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.agg(F.lit(days).alias("days"), F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("customers"))
