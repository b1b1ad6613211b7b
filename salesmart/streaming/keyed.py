"""Keyed state across batches: the first arrival of every sale, and stock with its alerts.

Sales and products are dealt over buckets by a hash: a call to Python serves all sales or products of a bucket, and only
buckets that have rows are touched. Rows are reduced before they are sent to their bucket: a sale that fills a third of a
batch sends one row for each Arrow batch, a product one row for each closed interval.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from salesmart.operators import quality

HOUR = timedelta(hours=1)
#: Buckets of sales and of products; the rows of one micro-batch in a bucket are held by one call.
BUCKETS = 512


def _bucket(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int").alias("bucket")


def _packed(rows: Iterable[tuple], schema: pa.Schema) -> tuple[bytes]:
    """Rows as one value of state: a value for each sale or product would cost a call to the JVM each."""
    columns = list(zip(*rows)) or [()] * len(schema)
    return (pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema).serialize().to_pybytes(),)


def _unpacked(value: tuple, schema: pa.Schema) -> list[tuple]:
    part = pa.ipc.read_record_batch(pa.py_buffer(bytes(value[0])), schema)
    return list(zip(*(column.to_pylist() for column in part.columns)))


# --- first arrival -------------------------------------------------------------------------------------------


def _thinned(rows: pa.RecordBatch | pa.Table, arrival: Sequence[str]) -> pa.RecordBatch | pa.Table:
    order = pd.DataFrame({c: rows.column(c).to_pandas() for c in ("sale_id", *arrival)})
    order = order.sort_values(list(arrival), kind="stable").drop_duplicates("sale_id")
    return rows.take(pa.array(sorted(order.index)))


def _firsts(arrival: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _thinned(batch, arrival)

    return thin


def first_sales(stream: DataFrame, arrival: Sequence[str] = quality.FILE_ORDER, lateness: timedelta = 2 * HOUR) -> DataFrame:
    """The cleaning of ``quality.clean_batch`` over a whole stream: a sale's first complete row in arrival order, across
    batches, and only if its amount is positive; a bad first row takes the repeats with it.

    Repeats are known while they come within ``lateness`` of the first. A row whose sale time is behind the watermark by
    more than that is late and dropped, whatever its id. A missing sale time counts as 1970 and is always late.

    Of a batch one row for each sale is left, its first, in buckets of sales; what was seen in earlier batches is Spark's own
    keyed state, so no call to Python is made for a single sale. The watermark follows the rows that are left.
    """
    complete = quality.drop_incomplete(stream)
    timed = complete.withColumn("event_time", F.col("sale_date").cast("timestamp")).where(
        F.col("event_time") > F.timestamp_seconds(F.lit(0)))  # the watermark is never before 1970
    dealt = timed.mapInArrow(_firsts(arrival), timed.schema).withColumn("bucket", _bucket("sale_id"))
    firsts = dealt.groupBy("bucket").applyInArrow(lambda rows: _thinned(rows, arrival), dealt.schema)
    seconds = int(lateness.total_seconds())
    new = firsts.withWatermark("event_time", f"{seconds} seconds").dropDuplicatesWithinWatermark(["sale_id"])
    return quality.keep_positive(new).drop("event_time", "bucket")


# --- stock ---------------------------------------------------------------------------------------------------

STOCK_CHANGES = T.StructType([
    T.StructField("product_id", T.LongType()), T.StructField("at", T.TimestampType()), T.StructField("sold_qty", T.LongType()),
    T.StructField("stock_qty", T.LongType()), T.StructField("threshold", T.LongType()), T.StructField("alert_no", T.LongType()),
])


LEVELS = pa.schema([("product_id", pa.int64()), ("stock_qty", pa.int64()), ("threshold", pa.int64()),
                    ("last_alert", pa.timestamp("us")), ("alerts", pa.int64())])


class StockLevel(StatefulProcessor):
    """Stock of each product of a bucket, when it last raised an alert, and how many it has raised."""

    def __init__(self, silence: timedelta) -> None:
        self.silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels = handle.getValueState("levels", "levels binary")

    def _levels(self) -> dict[int, tuple]:
        return {level[0]: level for level in _unpacked(self.levels.get(), LEVELS)} if self.levels.exists() else {}

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        levels = self._levels()
        for row in initialState.itertuples():
            levels.setdefault(int(row.product_id), (int(row.product_id), int(row.stock_qty), int(row.restock_threshold), None, 0))
        self.levels.update(_packed(levels.values(), LEVELS))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        levels, out = self._levels(), []
        for row in pd.concat(list(rows), ignore_index=True).sort_values("at").itertuples():
            product = int(row.product_id)
            if product not in levels:
                continue  # a product without stock has no level to keep
            _, stock, threshold, last, alerts = levels[product]
            stock = max(stock - int(row.sold_qty), 0)
            number = None
            if stock <= threshold and (last is None or last <= row.at - self.silence):
                last, alerts = row.at.to_pydatetime(), alerts + 1
                number = alerts
            levels[product] = product, stock, threshold, last, alerts
            out.append((product, row.at, int(row.sold_qty), stock, threshold, number))
        if out:
            self.levels.update(_packed(levels.values(), LEVELS))
            frame = pd.DataFrame(out, columns=STOCK_CHANGES.fieldNames())
            yield frame.astype({"alert_no": "Int64"})

    def close(self) -> None:
        pass


def stock_changes(stream: DataFrame, inventory: DataFrame, every: str = "1 hour", lateness: str = "1 hour",
                  silence: timedelta = HOUR) -> DataFrame:
    """Stock after every interval in which a product was sold, with the number of the alert that it raised, if any.

    ``inventory`` (product_id, stock_qty, restock_threshold) is where the state starts. Intervals close in order, once
    the watermark, ``lateness`` behind the newest sale, has passed them. An alert is due when the level is at or below the
    threshold and the product raised none for ``silence`` (one exactly that old no longer counts). Only products sold in
    the closed intervals are touched or written; nothing reads the inventory or earlier alerts again.
    """
    timed = stream.where("product_id is not null").withColumn("event_time", F.col("sale_date").cast("timestamp"))
    sold = timed.withWatermark("event_time", lateness).groupBy("product_id", F.window("event_time", every)).agg(
        F.count(F.lit(1)).alias("sold_qty"))
    number = F.col("product_id").cast("long").alias("product_id")
    closed = sold.select(number, F.col("window.end").alias("at"), "sold_qty", F.window_time("window").alias("event_time"))
    start = inventory.where("product_id is not null and stock_qty is not null and restock_threshold is not null").select(
        number, F.col("stock_qty").cast("long"), F.col("restock_threshold").cast("long"))
    return closed.select("*", _bucket("product_id")).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=StockLevel(silence), outputStructType=STOCK_CHANGES, outputMode="Append", timeMode="EventTime",
        initialState=start.select("*", _bucket("product_id")).groupBy("bucket"))


def alerts_of(changes: DataFrame) -> DataFrame:
    """The alerts among stock changes, in the columns of the alert table. An id is made of the product's own count and
    its id, so nothing has to number all alerts, and a replayed batch gives the same ids."""
    return changes.where("alert_no is not null").select(
        (F.col("alert_no") * (1 << 40) + F.col("product_id")).alias("alert_id"), "product_id",
        F.col("stock_qty").cast("int").alias("stock_qty"), F.col("threshold").cast("int").alias("threshold"),
        F.col("at").cast("timestamp_ntz").alias("alert_time"), F.lit(False).alias("resolved"))
