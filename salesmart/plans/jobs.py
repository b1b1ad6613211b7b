"""The platform's jobs over a warehouse: plain functions in the order a scheduler would call them.

Every job can be repeated for the same run time without changing the outcome, but for sales mart rows without a store:
their NULL key never matches, so a repeat inserts them again.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.expressions import at
from salesmart.operators import affinity, marts, quality, recommend, rfm, silver, stock, upsert
from salesmart.session import materialize
from salesmart.sources import lake
from salesmart.sources.warehouse import Warehouse, stamp_text

LAST_HOUR = 23


def _moment(run_at: datetime | str) -> datetime:
    return datetime.fromisoformat(str(run_at))


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _ingest(run_at: datetime | str) -> str:
    return _moment(run_at).strftime("%Y%m%d%H")


# --- hourly --------------------------------------------------------------------------------------------------


def bronze_hour(wh: Warehouse, run_at: datetime | str) -> bool:
    """Copy the hour's raw partition to bronze; False when there is none."""
    return lake.copy_hour(wh.spark, wh.raw, wh.bronze, run_at)


def silver_hour(wh: Warehouse, run_at: datetime | str, processed_at: datetime | str | None = None) -> None:
    """Clean and enrich one bronze hour into the fact table, replacing an earlier attempt of that hour."""
    bronze = lake.read_hour(wh.spark, wh.bronze, run_at)
    if bronze.isEmpty():
        return
    products = wh.latest_or_empty("products")
    rows = silver.enrich(quality.clean_batch(bronze), products, processed_at or _now())
    wh.replace_run("silver.sales_enriched", "ingest", _ingest(run_at), rows)


def rebuild_silver(wh: Warehouse, processed_at: datetime | str | None = None) -> DataFrame:
    """Rebuild the fact table from all raw files, cleaning file by file; a file that breaks anywhere stays out whole.

    The new rows are one commit: readers see the old table until then, also where the rebuild fails on the way.
    Returns the verification row (rows, named rows, date span) with the files that were left out and what is broken in
    them. Only a broken file is left out: an error of storage or of an executor fails the rebuild.
    """
    products = wh.latest_or_empty("products")
    if products.isEmpty():
        raise ValueError("the products table is empty: load it before a rebuild")
    skipped = lake.unreadable_files(wh.spark, lake.lake_files(wh.spark, wh.raw))
    raw = lake.read_lake(wh.spark, wh.raw, [path for path, _ in skipped])
    ingest = F.concat("year", "month", "day", "hour").alias("ingest")
    clean = quality.clean_batch(raw, scope=["_file"]).select("*", ingest)
    rows = silver.enrich(clean, products, processed_at or _now(), keep=("ingest",))
    facts = wh.committed("silver.sales_enriched")
    version = facts.replace_all(rows)
    broken = [F.struct(F.lit(path).alias("path"), F.lit(reason).alias("reason")) for path, reason in skipped]
    left_out = F.array(*broken).cast("array<struct<path: string, reason: string>>").alias("skipped_files")
    return silver.verify_silver(facts.read(version)).select("*", left_out)


def stock_hour(wh: Warehouse, run_at: datetime | str, window: tuple | None = None) -> None:
    """Deduct the hour's sales from stock and raise restock alerts.

    ``window`` defaults to the hour before the run, which holds the run's data. The previous stock level is the
    newest one from before this run, so repeating a run does not deduct twice.
    """
    now, version = _moment(run_at), stamp_text(run_at)
    start, end = window or (now - timedelta(hours=1), now)
    sold = stock.sold_quantities(_silver_between(wh, start, end), start, end)
    inventory = wh.latest_or_empty("inventory", before=version)
    sold = materialize(sold)  # read by the stock level and by the alerts
    if sold.isEmpty():
        return
    alerts = wh.read("inventory_alerts").where(F.col("run") < version)
    # Partitions prune both reads: the hour of silence, and the newest run that raised an alert.
    silent = alerts.where(F.col("run") >= stamp_text(now - timedelta(hours=1)))
    latest = alerts.where(F.lit(False))
    for run in reversed([r for r in wh.runs("inventory_alerts", "run") if r < version]):
        latest = alerts.where(F.col("run") == run)
        if not latest.isEmpty():
            break
    due = stock.new_alerts(stock.stock_movement(inventory, sold), silent, run_at, latest)
    wh.replace_run("inventory_alerts", "run", version, due)
    wh.save_version("inventory", version, stock.deduct_stock(inventory, sold, run_at))


def _silver_between(wh: Warehouse, start: datetime, end: datetime) -> DataFrame:
    # The day filter prunes partitions; the exact time filter follows in the operator.
    days = F.col("sale_date_only").between(F.lit(start.date()), F.lit(end.date()))
    return wh.read("silver.sales_enriched").where(days)


# --- daily ---------------------------------------------------------------------------------------------------


def alert_report(wh: Warehouse, day) -> DataFrame:
    """Unresolved alerts of the day with product names, emptiest first; its row count is the report's total."""
    return stock.alert_report(wh.read("inventory_alerts"), wh.latest_or_empty("products"), day)


def rfm_snapshot(
    wh: Warehouse,
    as_of: datetime | str,
    full: bool = False,
    boundary: str = "as_of",
    skip_when_idle: bool = False,
) -> bool:
    """Write the customer snapshot of ``as_of``: incremental from the snapshot before, or from all sales.

    ``skip_when_idle`` leaves the old snapshot in place when nothing was sold since; by default customers age.
    """
    version = stamp_text(as_of)
    sales = wh.read("silver.sales_enriched")
    previous = None if full else wh.latest("silver.rfm_snapshot", before=version)
    if previous is None:
        # "as_of" keeps runs that are repeated later from counting sales of their future.
        snapshot = rfm.rfm_full(sales, as_of, boundary)
    else:
        then = previous.agg(F.max("as_of")).first()[0]
        day = F.col("sale_date_only") >= F.lit(then.date())  # prunes partitions
        recent = sales.where(day)
        if skip_when_idle and rfm.new_since(recent, then, as_of, boundary).isEmpty():
            return False
        snapshot = rfm.rfm_incremental(previous, recent, then, as_of, boundary)
    stamped = snapshot.withColumn("as_of", at(as_of)).withColumn("updated_at", at(as_of))
    wh.save_version("silver.rfm_snapshot", version, stamped)
    return True


def touched_dates(wh: Warehouse, ingest_hours: Iterable[str]) -> list[date]:
    """Sale dates that the given ingest hours brought rows for (partition values, at most a few per hour)."""
    silver_rows = wh.read("silver.sales_enriched").where(F.col("ingest").isin(list(ingest_hours)))
    return [row[0] for row in silver_rows.select("sale_date_only").distinct().collect()]


def refresh_mart_sales(wh: Warehouse, dates: Iterable, stamp: datetime | str) -> None:
    """Upsert the sales mart for the given dates: their rows are appended to its log and merged when read."""
    dates = list(dates)
    if not dates:
        return
    fresh = marts.mart_sales(wh.read("silver.sales_enriched"), dates).withColumn("updated_at", at(stamp))
    _upsert(wh, "gold.mart_sales", fresh, stamp)


def _upsert(wh: Warehouse, name: str, fresh: DataFrame, stamp: datetime | str) -> None:
    mart = wh.merged(name)
    mart.upsert(fresh, stamp, keys_unique=True)
    while mart.compact_step(stamp):
        pass


def refresh_mart_account(wh: Warehouse, day, stamp: datetime | str) -> None:
    """Upsert the account mart for one snapshot day; earlier days stay as history."""
    snapshot = wh.latest_or_empty("silver.rfm_snapshot")
    _upsert(wh, "gold.mart_account", marts.mart_account(snapshot, day).withColumn("updated_at", at(stamp)), stamp)


def refresh_mart_inventory(wh: Warehouse, stamp: datetime | str) -> None:
    """Upsert the inventory mart from the newest stock level and the open alerts."""
    version = stamp_text(stamp)
    fresh = marts.mart_inventory(wh.latest_or_empty("inventory"), wh.latest_or_empty("products"), wh.read("inventory_alerts"))
    old = wh.latest_or_empty("gold.mart_inventory", before=version)
    merged = upsert.merge_upsert(old, fresh, marts.INVENTORY_KEYS, marts.INVENTORY_UPDATES, at(stamp))
    wh.save_version("gold.mart_inventory", version, merged)


def product_affinity(wh: Warehouse, stamp: datetime | str) -> None:
    """Mine rules and recommendations from all sales; an empty result leaves the earlier mart in place."""
    version = stamp_text(stamp)
    sales = wh.read("silver.sales_enriched")
    if sales.isEmpty():
        return
    results = {
        "gold.mart_product_affinity": affinity.association_rules(sales),
        "gold.mart_cf_recommendations": recommend.recommend(sales),
    }
    for name, result in results.items():
        ready = materialize(result)
        if not ready.isEmpty():
            wh.save_version(name, version, ready.withColumn("updated_at", at(stamp)))


# --- drivers -------------------------------------------------------------------------------------------------


def run_hour(wh: Warehouse, run_at: datetime | str, processed_at: datetime | str | None = None) -> None:
    """One hourly run; the run of 23:00 also closes the day."""
    bronze_hour(wh, run_at)
    silver_hour(wh, run_at, processed_at)
    stock_hour(wh, run_at)
    if _moment(run_at).hour == LAST_HOUR:
        run_day(wh, run_at)


def run_day(wh: Warehouse, run_at: datetime | str) -> None:
    """Daily snapshot, marts and mining.

    The sales mart is refreshed for every date that the last 24 ingest hours brought rows for, so the sales of
    23:00 to 23:59, which arrive with the next day's first run, reach their own date.
    """
    now = _moment(run_at)
    rfm_snapshot(wh, now)
    hours = [_ingest(now - timedelta(hours=back)) for back in range(24)]
    refresh_mart_sales(wh, touched_dates(wh, hours), now)
    refresh_mart_account(wh, now.date(), now)
    refresh_mart_inventory(wh, now)
    product_affinity(wh, now)
