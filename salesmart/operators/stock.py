"""Stock deduction, restock alerts, the alert report and the replay of a whole history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.expressions import at, before, cut, depleted, on
from salesmart.operators.upsert import assign_serial
from salesmart.session import materialize


def sold_quantities(sales: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Units sold per product in the half-open window."""
    window = (F.col("sale_date") >= at(start)) & (F.col("sale_date") < at(end))
    return sales.where(window).groupBy("product_id").agg(F.count(F.lit(1)).alias("sold_qty"))


def stock_movement(inventory: DataFrame, sold: DataFrame) -> DataFrame:
    """Inventory rows with ``sold_qty`` (NULL when nothing was sold) and ``stock_after``, floored at zero."""
    level = depleted(F.col("stock_qty"), F.coalesce("sold_qty", F.lit(0))).cast("int")
    return inventory.join(sold, "product_id", "left").withColumn("stock_after", level)


def deduct_stock(inventory: DataFrame, sold: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Inventory after the sales; products without sales keep their row as it is."""
    after = stock_movement(inventory, sold).withColumn("stock_qty", F.col("stock_after"))
    if as_of is not None and "last_updated" in inventory.columns:
        touched = F.when(F.col("sold_qty").isNotNull(), at(as_of)).otherwise(F.col("last_updated"))
        after = after.withColumn("last_updated", touched)
    return after.select(*inventory.columns)


def alerts_due(movement: DataFrame, alerts: DataFrame, as_of: datetime | str) -> DataFrame:
    """Products sold in this run whose stock is at or below the threshold and that have no unresolved alert
    from the hour before ``as_of`` (an alert exactly one hour old no longer counts)."""
    recent = alerts.where(~F.col("resolved") & (F.col("alert_time") > before(as_of, "1 HOUR")))
    low = F.col("sold_qty").isNotNull() & (F.col("stock_after") <= F.col("restock_threshold"))
    return (
        movement.where(low)
        .join(recent.select("product_id"), "product_id", "left_anti")
        .select(
            "product_id",
            F.col("stock_after").alias("stock_qty"),
            F.col("restock_threshold").alias("threshold"),
            at(as_of).alias("alert_time"),
            F.lit(False).alias("resolved"),
        )
    )


def new_alerts(movement: DataFrame, alerts: DataFrame, as_of: datetime | str, latest: DataFrame | None = None) -> DataFrame:
    """The alerts due, with ids that continue those of ``latest``, which defaults to ``alerts``.

    ``alerts`` need not reach back further than the hour of silence. Numbering reads the alerts due twice, so they are written once to the checkpoint folder first.
    """
    due = materialize(alerts_due(movement, alerts, as_of))
    known = alerts if latest is None else latest
    numbered = assign_serial(due, "product_id", known.agg(F.max("alert_id")), "alert_id")
    return numbered.select("alert_id", "product_id", "stock_qty", "threshold", "alert_time", "resolved")


def alert_report(alerts: DataFrame, products: DataFrame, day) -> DataFrame:
    """Unresolved alerts of a day with product names, emptiest first."""
    start = on(day).cast("timestamp_ntz")
    in_day = (F.col("alert_time") >= start) & (F.col("alert_time") < start + F.expr("INTERVAL 1 DAY"))
    return (
        alerts.where(~F.col("resolved") & in_day)
        .join(products.select("product_id", "product_name"), "product_id")
        .select("product_name", "stock_qty", "threshold", "alert_time")
        .orderBy("stock_qty", "product_name", "alert_time")
    )


def hourly_sold(sales: DataFrame) -> DataFrame:
    """Units sold per product and hour."""
    return sales.groupBy("product_id", cut("hour", F.col("sale_date")).alias("sale_hour")).agg(
        F.count(F.lit(1)).alias("sold_qty")
    )


def replay_stock(inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Stock of every product after every hour with sales.

    Hour-by-hour deduction with a floor at zero equals start stock minus the running total, floored once,
    because nothing restocks in between. The window runs over hourly totals, so a product that holds a third of
    all sales still gives its task one row per hour.
    """
    running = Window.partitionBy("product_id").orderBy("sale_hour").rowsBetween(Window.unboundedPreceding, 0)
    total = hourly_sold(sales).withColumn("_total", F.sum("sold_qty").over(running))
    return total.join(inventory.select("product_id", "stock_qty"), "product_id").select(
        "product_id",
        "sale_hour",
        "sold_qty",
        depleted(F.col("stock_qty"), F.col("_total")).cast("bigint").alias("stock_after"),
    )
