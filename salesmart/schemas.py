"""Explicit schemas of every table.

Money totals are wider than the 12 digits of a small warehouse: one hot customer may hold a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
MONEY = T.DecimalType(20, 2)
RATIO = T.DecimalType(12, 4)
SCORE = T.DecimalType(18, 4)

LAKE_PARTITIONS = ("year", "month", "day", "hour")
FAST_TRACK_PARTITIONS = ("year", "month", "day")


_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "PRICE": PRICE,
    "MONEY": MONEY,
    "RATIO": RATIO,
    "SCORE": SCORE,
}


def _struct(text: str) -> T.StructType:
    """Schema from ``name TYPE`` pairs; needs no running session, unlike DDL parsing."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_RAW = "sale_id STRING, customer_id BIGINT, store_id BIGINT, product_id BIGINT, amount PRICE, sale_date TIMESTAMP"

RAW_SALES = _struct(_RAW)
LAKE_SALES = _struct(_RAW + ", year STRING, month STRING, day STRING, hour STRING")
LAKE_FAST_TRACK = _struct(_RAW + ", year STRING, month STRING, day STRING")

PRODUCTS = _struct("product_id BIGINT, product_name STRING, category STRING, price PRICE")
INVENTORY = _struct("product_id BIGINT, stock_qty INT, restock_threshold INT, last_updated TIMESTAMP")
INVENTORY_ALERTS = _struct(
    "alert_id BIGINT, product_id BIGINT, stock_qty INT, threshold INT, alert_time TIMESTAMP, resolved BOOLEAN"
)
SALES_ENRICHED = _struct(
    "sale_id STRING, customer_id BIGINT, store_id BIGINT, product_id BIGINT, product_name STRING, category STRING,"
    " amount PRICE, sale_date TIMESTAMP, sale_hour INT, sale_date_only DATE, processed_at TIMESTAMP"
)
# as_of is the evaluation time of the run; the next incremental run starts there.
RFM_SNAPSHOT = _struct(
    "customer_id BIGINT, last_purchase TIMESTAMP, frequency BIGINT, monetary MONEY, recency_days INT,"
    " segment STRING, snapshot_date DATE, as_of TIMESTAMP, updated_at TIMESTAMP"
)
MART_SALES = _struct(
    "store_id BIGINT, category STRING, sale_hour TIMESTAMP, total_revenue MONEY, order_count BIGINT,"
    " avg_order_value PRICE, updated_at TIMESTAMP"
)
MART_ACCOUNT = _struct(
    "customer_id BIGINT, segment STRING, frequency BIGINT, monetary MONEY, recency_days INT,"
    " snapshot_date DATE, updated_at TIMESTAMP"
)
MART_INVENTORY = _struct(
    "product_id BIGINT, product_name STRING, category STRING, stock_qty INT, restock_threshold INT, status STRING,"
    " alert_count BIGINT, updated_at TIMESTAMP"
)
MART_PRODUCT_AFFINITY = _struct(
    "antecedent STRING, consequent STRING, support RATIO, confidence RATIO, lift RATIO,"
    " updated_at TIMESTAMP"
)
MART_CF_RECOMMENDATIONS = _struct(
    "customer_id BIGINT, product_id BIGINT, product_name STRING, score SCORE, rank INT,"
    " updated_at TIMESTAMP"
)

TABLES: dict[str, T.StructType] = {
    "products": PRODUCTS,
    "inventory": INVENTORY,
    "inventory_alerts": INVENTORY_ALERTS,
    "raw_sales": RAW_SALES,
    "silver.sales_enriched": SALES_ENRICHED,
    "silver.rfm_snapshot": RFM_SNAPSHOT,
    "gold.mart_sales": MART_SALES,
    "gold.mart_account": MART_ACCOUNT,
    "gold.mart_inventory": MART_INVENTORY,
    "gold.mart_product_affinity": MART_PRODUCT_AFFINITY,
    "gold.mart_cf_recommendations": MART_CF_RECOMMENDATIONS,
}

# Unique keys; each stands for a unique index of the warehouse model.
UNIQUE_KEYS: dict[str, tuple[str, ...]] = {
    "products": ("product_id",),
    "inventory": ("product_id",),
    "gold.mart_sales": ("store_id", "category", "sale_hour"),
    "gold.mart_account": ("customer_id", "snapshot_date"),
    "gold.mart_inventory": ("product_id",),
}
