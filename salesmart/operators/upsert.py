"""Keyed merges over plain files: upsert, insert-if-absent, unique-key check, serial ids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIAL_BUCKETS = 1024


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _with_spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # A NULL key never matches, so its rows may go anywhere: spread them by content over the shuffle
    # instead of sending every NULL to one task.
    spread = F.when(any_null(keys), F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("bigint"))
    return df.withColumn("_spread", spread)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail at run time when a fully known key occurs twice; NULL keys are distinct, as in a unique index."""
    spread = df if "_spread" in df.columns else _with_spread(df, keys)
    counted = spread.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_spread")))
    message = F.concat(F.lit("duplicate key: "), F.to_json(F.struct(*keys)))
    single = F.when((F.col("_copies") > 1) & ~any_null(keys), F.raise_error(message).cast("boolean")).otherwise(True)
    kept = counted.where(single).drop("_copies")
    return kept if "_spread" in df.columns else kept.drop("_spread")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that a unique index would refuse, with their row counts."""
    known = df.where(~any_null(keys))
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def merge_upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    stamp: Column | None = None,
    stamp_col: str = "updated_at",
    keys_unique: bool = False,
) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols``, as one full outer join on the keys.

    A match overwrites only ``update_cols`` (an incoming NULL overwrites too) and sets ``stamp_col`` to ``stamp``;
    a row with a NULL key always inserts. ``keys_unique`` skips the duplicate check where the updates come from
    a grouping on the keys.
    """
    left = _with_spread(target, keys)
    right = _with_spread(updates, keys)
    if not keys_unique:
        right = require_unique(right, keys)
    old = left.select(F.struct(*target.columns).alias("old"), *[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)],
                      F.col("_spread").alias("_old_spread"))
    new = right.select(F.struct(*updates.columns).alias("new"), *[F.col(k).alias(f"_n{i}") for i, k in enumerate(keys)],
                       F.col("_spread").alias("_new_spread"))
    match = [F.col(f"_o{i}") == F.col(f"_n{i}") for i in range(len(keys))]
    joined = old.join(new, reduce(and_, match) & (F.col("_old_spread") == F.col("_new_spread")), "full_outer")

    incoming, existing = F.col("new").isNotNull(), F.col("old").isNotNull()

    def column(name: str) -> Column:
        kind = target.schema[name].dataType
        was = F.col(f"old.{name}")
        if name == stamp_col and stamp is not None:
            return F.when(incoming, stamp.cast(kind)).otherwise(was).alias(name)
        now = F.col(f"new.{name}").cast(kind) if name in updates.columns else F.lit(None).cast(kind)
        if name in update_cols:
            return F.when(incoming, now).otherwise(was).alias(name)
        return F.when(existing, was).otherwise(now).alias(name)

    return joined.select(*[column(name) for name in target.columns])


def insert_if_absent(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: existing rows win, and of updates with one key the first by ``order``.

    Without ``order`` the columns themselves decide, so the result is the same on every run. NULL keys never conflict.
    """
    ranked = Window.partitionBy(*keys, "_spread").orderBy(*(order or updates.columns))
    single = (
        _with_spread(updates, keys).withColumn("_n", F.row_number().over(ranked))
        .where((F.col("_n") == 1) | any_null(keys)).drop("_n", "_spread")
    )
    fresh = single.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def assign_serial(df: DataFrame, key: str, start: DataFrame, name: str, buckets: int = SERIAL_BUCKETS) -> DataFrame:
    """Consecutive ids after the one-row ``start`` frame, in order of (key modulo buckets, key).

    Numbering runs inside ``buckets`` groups and adds each group's offset, so no task sees all the rows; only
    the bucket counts (at most ``buckets`` rows) pass through a single window.
    """
    keyed = df.withColumn("_bucket", F.pmod(F.col(key), F.lit(buckets)))
    sizes = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    first = start.scalar()
    # At most `buckets` rows, whatever the data: a proven bound for the broadcast.
    return (
        keyed.withColumn("_local", local)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.coalesce(first, F.lit(0)) + F.col("_offset") + F.col("_local"))
        .drop("_bucket", "_local", "_offset")
    )
