"""Hourly revenue that late sales correct.

Every batch adds its sums to a log of changes. Hours that the watermark has passed are published; a sale that comes for a
published hour goes to a table of late sales, and its key's old total is retracted and the new one added. A batch writes
its own keys and those of the hours that it closes, and reads back only these.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesmart.functions.expressions import at, cut, exact_mean
from salesmart.operators import marts
from salesmart.schemas import MONEY, PRICE
from salesmart.session import materialize
from salesmart.sources.commits import CommittedTable, SummedTable

HOUR = timedelta(hours=1)
KEYS = list(marts.SALES_KEYS)
_KEY_FIELDS = [T.StructField("store_id", T.LongType()), T.StructField("category", T.StringType()), T.StructField("sale_hour", T.TimestampNTZType())]
_SUM_FIELDS = [T.StructField("total_revenue", MONEY), T.StructField("order_count", T.LongType()), T.StructField("amounts", T.LongType())]
SUMS = T.StructType([*_KEY_FIELDS, *_SUM_FIELDS])
CHANGES = T.StructType([T.StructField("run", T.StringType()), T.StructField("kind", T.StringType()), *SUMS.fields])
LATE = T.StructType([*_KEY_FIELDS, T.StructField("amount", PRICE), T.StructField("sale_date", T.TimestampNTZType()), T.StructField("run", T.StringType())])


class RevenueMart:
    """The tables of one corrected mart under ``root``.

    ``open_sums``: all changes by key; ``published``: those of published hours; ``changes``: what readers of the mart have
    to apply, as rows of kind close, retract and correct; ``late``: late sales as they came, with each run's watermark.
    """

    def __init__(self, spark: SparkSession, root: str, lateness: timedelta = HOUR) -> None:
        self.spark, self.lateness = spark, lateness
        self.open_sums = SummedTable(spark, f"{root}/open", SUMS, KEYS)
        self.published = SummedTable(spark, f"{root}/published", SUMS, KEYS)
        self.changes = CommittedTable(spark, f"{root}/changes", CHANGES, run_column="run")
        self.late = CommittedTable(spark, f"{root}/late", LATE, run_column="run")

    def watermark(self, before: str | None = None) -> datetime | None:
        """``lateness`` behind the newest sale of all runs, or of those before one."""
        marks = [s["watermark"] for s in self.late.segments() if s["watermark"] and (before is None or s["run"] < before)]
        return datetime.fromisoformat(max(marks)) if marks else None

    def late_rows(self) -> int:
        return sum(s["rows"] for s in self.late.segments())

    def add(self, sales: DataFrame, run: str) -> None:
        """One batch of enriched sales; runs come in the order of their names, and a repeated one changes nothing."""
        sales = materialize(sales.where("sale_date is not null").select(
            "store_id", F.coalesce("category", F.lit("Unknown")).alias("category"), cut("hour", F.col("sale_date")).alias("sale_hour"),
            F.col("amount").cast(PRICE).alias("amount"), F.col("sale_date").cast("timestamp_ntz").alias("sale_date"), F.lit(run).alias("run")))
        old = self.watermark(before=run)
        newest = sales.agg(F.max("sale_date")).first()[0]
        marks = [m for m in (old, newest and newest - self.lateness) if m]
        new = max(marks) if marks else None
        fresh = materialize(sales.groupBy(*KEYS).agg(
            F.sum("amount").cast(MONEY).alias("total_revenue"), F.count(F.lit(1)).alias("order_count"), F.count("amount").alias("amounts")))
        closed_before = lambda mark: F.lit(False) if mark is None else F.col("sale_hour") <= at(mark - HOUR)
        corrections = fresh.where(closed_before(old))
        self.open_sums.add(run, fresh)
        closing = self.open_sums.read().where(closed_before(new) & ~closed_before(old))
        known = self.published.read()  # as of now: the commit below does not change it
        if run <= max((s["run"] for s in self.published.table.segments()), default=""):
            known = None  # this run was published before it failed
        else:
            retracted = self._matching(known, corrections)
            changed = (
                closing.withColumn("kind", F.lit("close"))
                .unionByName(retracted.withColumn("kind", F.lit("retract")))
                .unionByName(self._plus(retracted, corrections).withColumn("kind", F.lit("correct"))))
            self.changes.replace_run(run, changed.withColumn("run", F.lit(run)))
            self.published.add(run, closing.unionByName(corrections))
        self.late.replace_run(run, sales.where(closed_before(old)), watermark=None if new is None else new.isoformat(timespec="microseconds"))
        for log in (self.open_sums, self.published):
            while log.compact_step():
                pass

    @staticmethod
    def _matching(known: DataFrame, corrections: DataFrame) -> DataFrame:
        """The published sums of the corrected keys; their hours' range reaches the scan, NULL keys match as in a grouping."""
        first, last = corrections.agg(F.min("sale_hour"), F.max("sale_hour")).first()
        if first is None:
            return known.limit(0)
        k, c = known.where(F.col("sale_hour").between(at(first), at(last))).alias("k"), corrections.alias("c")
        return k.join(c, [F.col(f"k.{name}").eqNullSafe(F.col(f"c.{name}")) for name in KEYS], "left_semi")

    @staticmethod
    def _plus(old: DataFrame, corrections: DataFrame) -> DataFrame:
        sums = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in _SUM_FIELDS]
        return old.unionByName(corrections).groupBy(*KEYS).agg(*sums)

    def read(self, open_hours: bool = False) -> DataFrame:
        """The mart of the published hours, in the columns of ``marts.mart_sales``; on demand with the open ones so far."""
        rows = self.published.read()
        if open_hours:
            mark = self.watermark()
            rest = self.open_sums.read()
            rows = rows.unionByName(rest if mark is None else rest.where(F.col("sale_hour") > at(mark - HOUR)))
        return rows.select(*KEYS, "total_revenue", "order_count", exact_mean(F.col("total_revenue"), F.col("amounts"), 2).cast(PRICE).alias("avg_order_value"))


def stream_revenue(mart: RevenueMart, enriched: DataFrame, checkpoint: str) -> StreamingQuery:
    """Feed a stream of enriched sales into the mart, batch by batch; a replayed batch changes nothing."""
    def each(batch: DataFrame, batch_id: int) -> None:
        mart.add(batch, f"batch-{batch_id:012d}")

    writer = enriched.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
