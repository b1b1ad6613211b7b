"""The dashboard queries over the marts. ``as_of`` stands for "now"; predicates have no upper bound.

Every top-k has a unique last sort column, so its rows do not depend on the partitioning.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.expressions import at, before, cut, exact_mean, money_sum, status_priority
from salesmart.operators.rfm import latest_snapshot
from salesmart.schemas import MONEY


def _since(column: str, as_of, interval: str) -> Column:
    return F.col(column) >= before(as_of, interval)


def _today(as_of) -> Column:
    return F.col("sale_hour") >= cut("day", at(as_of))


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _mean(column: str, scale: int, digits: int = 20) -> Column:
    return exact_mean(F.sum(F.col(column).cast("decimal(20,2)")), F.count(column), scale).cast(f"decimal({digits},{scale})")


# --- sales ---------------------------------------------------------------------------------------------------


def store_revenue_7d(mart_sales: DataFrame, as_of) -> DataFrame:
    return (
        mart_sales.where(_since("sale_hour", as_of, "7 DAYS"))
        .groupBy("store_id")
        .agg(money_sum("total_revenue").alias("total_revenue"), F.sum("order_count").alias("orders"))
        .orderBy(F.desc("total_revenue"), "store_id")
    )


def sales_trend_30d(mart_sales: DataFrame, as_of) -> DataFrame:
    return (
        mart_sales.where(_since("sale_hour", as_of, "30 DAYS"))
        .groupBy(cut("day", F.col("sale_hour")).alias("date"))
        .agg(money_sum("total_revenue").alias("total_revenue"), F.sum("order_count").alias("orders"))
        .orderBy("date")
    )


def top10_products_7d(silver: DataFrame, as_of) -> DataFrame:
    return (
        silver.where(_since("sale_date", as_of, "7 DAYS"))
        .groupBy("product_name", "category")
        .agg(
            _count("order_count"),
            money_sum("amount").alias("total_revenue"),
            _mean("amount", 2).alias("avg_price"),
        )
        .orderBy(F.desc("total_revenue"), F.asc_nulls_last("product_name"), F.asc_nulls_last("category"))
        .limit(10)
    )


def category_revenue_7d(mart_sales: DataFrame, as_of) -> DataFrame:
    """The average is an unweighted mean of the hourly averages."""
    return (
        mart_sales.where(_since("sale_hour", as_of, "7 DAYS"))
        .groupBy("category")
        .agg(
            money_sum("total_revenue").alias("total_revenue"),
            F.sum("order_count").alias("orders"),
            _mean("avg_order_value", 2).alias("avg_order"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def revenue_today(mart_sales: DataFrame, as_of) -> DataFrame:
    total = F.coalesce(F.sum("total_revenue"), F.lit(0)).cast(MONEY)
    return mart_sales.where(_today(as_of)).agg(total.alias("value"))


def orders_today(mart_sales: DataFrame, as_of) -> DataFrame:
    return mart_sales.where(_today(as_of)).agg(F.coalesce(F.sum("order_count"), F.lit(0)).alias("value"))


def avg_order_today(mart_sales: DataFrame, as_of) -> DataFrame:
    mean = F.sum("avg_order_value").cast("double") / F.count("avg_order_value")
    any_rows = F.count("avg_order_value") > 0
    return mart_sales.where(_today(as_of)).agg(F.when(any_rows, mean).otherwise(0.0).alias("value"))


def hourly_by_store_24h(mart_sales: DataFrame, as_of) -> DataFrame:
    return (
        mart_sales.where(_since("sale_hour", as_of, "24 HOURS"))
        .groupBy(F.col("sale_hour").alias("time"), F.col("store_id").cast("string").alias("metric"))
        .agg(money_sum("total_revenue").alias("value"))
        .orderBy("time", "metric")
    )


def store_today(mart_sales: DataFrame, as_of) -> DataFrame:
    return (
        mart_sales.where(_today(as_of))
        .groupBy("store_id")
        .agg(money_sum("total_revenue").alias("value"))
        .select(F.concat(F.lit("Store "), F.col("store_id").cast("string")).alias("metric"), "value")
        .orderBy(F.desc("value"), "metric")
    )


def category_today(mart_sales: DataFrame, as_of) -> DataFrame:
    return (
        mart_sales.where(_today(as_of) & F.col("category").isNotNull())
        .groupBy("category")
        .agg(money_sum("total_revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def daily_7d(mart_sales: DataFrame, as_of) -> DataFrame:
    return (
        mart_sales.where(_since("sale_hour", as_of, "7 DAYS"))
        .groupBy(cut("day", F.col("sale_hour")).alias("time"))
        .agg(money_sum("total_revenue").alias("total_revenue"), F.sum("order_count").alias("orders"))
        .orderBy("time")
    )


# --- customers -----------------------------------------------------------------------------------------------


def _snapshots(mart_account: DataFrame, latest_only: bool) -> DataFrame:
    # The mart keeps one row per customer and day; the dashboards count all of them unless told otherwise.
    return latest_snapshot(mart_account) if latest_only else mart_account


def segment_summary(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return (
        _snapshots(mart_account, latest_only)
        .groupBy("segment")
        .agg(
            _count("customers"),
            _mean("monetary", 2).alias("avg_spend"),
            _mean("frequency", 1).alias("avg_orders"),
            _mean("recency_days", 0).alias("avg_recency_days"),
        )
        .orderBy(F.desc("avg_spend"), "segment")
    )


def _top_spenders(mart_account: DataFrame, segment: str, inactivity: str) -> DataFrame:
    return (
        mart_account.where(F.col("segment") == segment)
        .select(
            "customer_id",
            F.round("monetary", 2).cast(MONEY).alias("total_spent"),
            F.col("frequency").alias("total_orders"),
            F.col("recency_days").alias(inactivity),
            "snapshot_date",
        )
        .orderBy(F.desc("total_spent"), "customer_id", "snapshot_date")
        .limit(20)
        .drop("snapshot_date")
    )


def top_champions(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return _top_spenders(_snapshots(mart_account, latest_only), "Champions", "days_since_last_buy")


def at_risk(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return _top_spenders(_snapshots(mart_account, latest_only), "At Risk", "days_inactive")


def monetary_frequency(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return (
        _snapshots(mart_account, latest_only)
        .orderBy(F.desc("monetary"), "customer_id", "snapshot_date")
        .limit(200)
        .select("customer_id", "segment", F.round("monetary", 0).cast(MONEY).alias("monetary"), "frequency")
    )


def customer_count(mart_account: DataFrame) -> DataFrame:
    return mart_account.agg(F.count_distinct("customer_id").alias("value"))


def _segment_count(mart_account: DataFrame, segment: str, latest_only: bool) -> DataFrame:
    return _snapshots(mart_account, latest_only).where(F.col("segment") == segment).agg(_count("value"))


def champions_count(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return _segment_count(mart_account, "Champions", latest_only)


def at_risk_count(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return _segment_count(mart_account, "At Risk", latest_only)


def lost_count(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return _segment_count(mart_account, "Lost", latest_only)


def segment_distribution(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return (
        _snapshots(mart_account, latest_only)
        .groupBy(F.col("segment").alias("metric"))
        .agg(_count("value"))
        .orderBy(F.desc("value"), "metric")
    )


def segment_avg_monetary(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return (
        _snapshots(mart_account, latest_only)
        .groupBy(F.col("segment").alias("metric"))
        .agg(_mean("monetary", 2).alias("value"))
        .orderBy(F.desc("value"), "metric")
    )


def top20_customers(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return (
        _snapshots(mart_account, latest_only)
        .orderBy(F.desc("monetary"), "customer_id", "snapshot_date")
        .limit(20)
        .select("customer_id", "segment", "frequency", F.round("monetary", 2).cast(MONEY).alias("monetary"), "recency_days")
    )


def recency_values(mart_account: DataFrame, latest_only: bool = False) -> DataFrame:
    return _snapshots(mart_account, latest_only).select(F.col("recency_days").alias("value")).orderBy("value")


#: The widths that a histogram chooses from: 1, 2 and 5 times a power of ten, in units of 0.0001; and about how many buckets.
WIDTHS = [digit * 10**power for power in range(17) for digit in (1, 2, 5)]
BUCKETS = 30


def histogram(values: DataFrame, width: str | None = None, column: str = "value") -> DataFrame:
    """Counts per equal-width bucket, computed on the cluster instead of in the charting client.

    ``width`` is decimal text: bucket edges are exact, so 0.7 is not 0.7000000000000001. Without it the width is the
    smallest of WIDTHS that covers the values' range in at most BUCKETS steps, found by one aggregate over the column
    inside the same query; values count in units of 0.0001. Missing values are one bucket of their own.
    """
    if width is None:
        units = values.select((F.round(F.col(column).cast("decimal(18,4)"), 4) * 10_000).cast("bigint").alias("u"))
        steps = F.array(*(F.lit(w).cast("bigint") for w in WIDTHS))
        span = units.agg((F.max("u") - F.min("u")).alias("span"))
        step = span.select(F.get(F.filter(steps, lambda w: F.col("span") <= BUCKETS * w), F.lit(0))).scalar()
        start = ((F.col("u") - F.pmod(F.col("u"), step)).cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast("decimal(18,4)")
        return units.groupBy(start.alias("bucket")).agg(_count("values")).orderBy("bucket")
    step = F.lit(Decimal(width))
    bucket = (F.floor(F.col(column).cast("decimal(18,4)") / step) * step).cast("decimal(18,4)")
    return values.groupBy(bucket.alias("bucket")).agg(_count("values")).orderBy("bucket")


# --- inventory -----------------------------------------------------------------------------------------------

_INVENTORY_COLUMNS = ("product_name", "category", "stock_qty", "restock_threshold", "status", "alert_count")


def inventory_overview(mart_inventory: DataFrame) -> DataFrame:
    return mart_inventory.orderBy(status_priority(F.col("status")), "stock_qty", "product_id").select(*_INVENTORY_COLUMNS)


def inventory_top20(mart_inventory: DataFrame) -> DataFrame:
    ranked = mart_inventory.orderBy(status_priority(F.col("status")), "stock_qty", "product_id")
    return ranked.limit(20).select(*_INVENTORY_COLUMNS)


def status_counts(mart_inventory: DataFrame) -> DataFrame:
    return mart_inventory.groupBy("status").agg(_count("product_count")).orderBy(F.desc("product_count"), "status")


def open_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.where(~F.col("resolved")).agg(_count("value"))


# --- affinity and recommendations ----------------------------------------------------------------------------


def top_rules(mart_affinity: DataFrame) -> DataFrame:
    return (
        mart_affinity.orderBy(F.desc("lift"), "antecedent", "consequent")
        .limit(20)
        .select(
            "antecedent",
            "consequent",
            *[F.round(name, 3).cast("decimal(12,3)").alias(name) for name in ("confidence", "support", "lift")],
        )
    )


def lift_values(mart_affinity: DataFrame) -> DataFrame:
    return mart_affinity.select(F.col("lift").alias("value"))


def cf_for_customer(mart_recommendations: DataFrame, customer_id: int) -> DataFrame:
    """Recommendations of one customer; the id is a bound parameter, not query text."""
    return mart_recommendations.sparkSession.sql(
        "SELECT customer_id, rank AS position, product_name, CAST(ROUND(score, 2) AS DECIMAL(18,2)) AS score"
        " FROM {recommendations} WHERE customer_id = :customer_id ORDER BY rank",
        args={"customer_id": customer_id},
        recommendations=mart_recommendations,
    )


def top_recommended(mart_recommendations: DataFrame) -> DataFrame:
    return (
        mart_recommendations.where(F.col("rank") == 1)
        .groupBy(F.col("product_name").alias("metric"))
        .agg(_count("value"))
        .orderBy(F.desc("value"), F.asc_nulls_last("metric"))
        .limit(10)
    )
