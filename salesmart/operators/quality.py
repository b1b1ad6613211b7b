"""Batch cleaning: required columns, first row per sale id, positive amounts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REQUIRED = ("sale_id", "customer_id", "product_id", "amount")
FILE_ORDER = ("_file", "_row")


def _complete(required: Sequence[str]) -> Column:
    # Plain IS NOT NULL terms reach the parquet scan as pushed filters; dropna() would not.
    return reduce(and_, [F.col(name).isNotNull() for name in required])


def drop_incomplete(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Drop rows with a NULL in a required column; store and date may be missing."""
    return df.where(_complete(required))


def with_file_order(df: DataFrame) -> DataFrame:
    """Add the arrival order of a file scan: file path, then row number inside the file."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def keep_first(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """First row per key in arrival order.

    ``row_number() = 1`` lets Spark keep one row per key and map task before the shuffle (a partial window group
    limit), so a key that repeats in a third of all rows costs the reducer one row per map task.
    """
    order = Window.partitionBy(*keys).orderBy(*arrival)
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def keep_positive(df: DataFrame) -> DataFrame:
    return df.where(F.col("amount") > 0)


def clean_batch(df: DataFrame, arrival: Sequence[str] = FILE_ORDER, scope: Sequence[str] = ()) -> DataFrame:
    """Cleaning in its fixed order: a first row with a bad amount takes all of its repeats with it.

    ``scope`` narrows what counts as a repeat, for example to one file in a rebuild.
    """
    return keep_positive(keep_first(drop_incomplete(df), [*scope, "sale_id"], arrival))


def quality_counts(df: DataFrame, arrival: Sequence[str] = FILE_ORDER) -> DataFrame:
    """Rows before and after cleaning and the number dropped, in one scan and one pre-aggregated shuffle."""
    # Incomplete rows share the NULL group; a NULL sale id is never complete.
    per_sale = df.groupBy(F.when(_complete(REQUIRED), F.col("sale_id")).alias("sale_id")).agg(
        F.count(F.lit(1)).alias("rows"),
        # A single arrival column keeps the buffers fixed-size and with them the hash aggregation.
        F.min_by("amount", arrival[0] if len(arrival) == 1 else F.struct(*arrival)).alias("first_amount"),
    )
    kept = F.col("sale_id").isNotNull() & (F.col("first_amount") > 0)
    return per_sale.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_before"), F.count_if(kept).alias("rows_after")
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))
