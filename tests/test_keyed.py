"""State across batches: first arrivals and stock with alerts, over several batches, repeats and replays."""

import glob
import os
from datetime import datetime, timedelta
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StructField, StructType

from salesmart.schemas import RAW_SALES
from salesmart.sources import external
from salesmart.streaming import keyed

T0 = datetime(2024, 1, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def batches(spark, folder, schema, *parts):
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(spark, stream, path):
    external.send_stream(stream, f"{path}/cp", sink="parquet", path=f"{path}/out").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def sale(number, seq, amount, minutes=0, customer=1, at=True):
    return (None if number is None else str(number), customer, 1, 2, amount, T0 + timedelta(minutes=minutes) if at else None, seq)


@pytest.fixture
def arriving(spark, tmp_path):
    from decimal import Decimal

    d = lambda x: None if x is None else Decimal(x)
    schema = StructType([*RAW_SALES.fields, StructField("seq", LongType())])
    one = [sale(1, 2, d(5)), sale(1, 1, d(-5)), sale(2, 3, d(7)), sale(4, 4, None), sale(4, 5, d(3)), sale(9, 6, d(2), customer=None)]
    two = [sale(1, 7, d(5), 1), sale(2, 8, d(9), 1), sale(3, 9, d(1), 2), sale(None, 10, d(1))]
    three = [sale(3, 11, d(8), 3), sale(5, 12, d(6), 90)] + [sale(6, 13 + i, d(1 + i), 91) for i in range(2000)]
    four = [sale(6, 5000, d(50), 95), sale(5, 5001, d(6), 96), sale(7, 5002, d(4), 96)]
    return batches(spark, str(tmp_path / "in"), schema, one, two, three, four)


def test_first_rows_across_batches(spark, arriving, tmp_path):
    got = rows(drain(spark, keyed.first_sales(arriving, ["seq"]), tmp_path).select("sale_id", "amount", "seq"))
    assert [(i, float(a), s) for i, a, s in got] == [("2", 7, 3), ("3", 1, 9), ("4", 3, 5), ("5", 6, 12), ("6", 1, 13), ("7", 4, 5002)]


def test_a_replayed_batch_changes_nothing(spark, arriving, tmp_path):
    first = rows(drain(spark, keyed.first_sales(arriving, ["seq"]), tmp_path))
    commits = sorted(glob.glob(f"{tmp_path}/cp/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for path in (commits[-1], f"{os.path.dirname(commits[-1])}/.{os.path.basename(commits[-1])}.crc"):
        if os.path.exists(path):
            os.remove(path)
    assert rows(drain(spark, keyed.first_sales(arriving, ["seq"]), tmp_path)) == first


def test_a_hot_sale_sends_one_row_a_batch():
    batch = pa.RecordBatch.from_pydict({"sale_id": ["a"] * 1000 + ["b"], "seq": [*range(1000, 0, -1), 5]})
    out = list(keyed._firsts(["seq"])([batch]))
    assert out[0].to_pylist() == [{"sale_id": "a", "seq": 1}, {"sale_id": "b", "seq": 5}]


def drained_states(stream, path):
    query = external.send_stream(stream, f"{path}/cp", sink="parquet", path=f"{path}/out")
    query.awaitTermination()
    return [state for progress in query.recentProgress for state in progress.stateOperators]


def test_sales_are_not_calls_of_their_own(spark, tmp_path):
    schema = StructType([*RAW_SALES.fields, StructField("seq", LongType())])
    stream = batches(spark, str(tmp_path / "in"), schema, [sale(i % 700, i, Decimal(i + 1)) for i in range(1400)], [sale(1, 9000, Decimal(1))])
    stream = stream.repartition(3)  # a sale's rows come to several tasks of a batch
    states = drained_states(keyed.first_sales(stream, ["seq"]), tmp_path)
    assert {s.operatorName for s in states} == {"dedupeWithinWatermark"}  # no state of Python, which takes calls for each key
    got = spark.read.parquet(f"{tmp_path}/out").select("sale_id", "seq").collect()
    assert sorted((int(i), s) for i, s in got) == [(i, i) for i in range(700)]


def test_products_share_their_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKETS", 3)
    schema = "product_id long, sale_date timestamp_ntz"
    stream = batches(spark, str(tmp_path / "in"), schema, [(i, T0) for i in range(40)], [(1, T0 + timedelta(hours=9))], [(1, T0 + timedelta(hours=19))])
    inventory = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(None, 1, 1)], "product_id long, stock_qty int, restock_threshold int")
    states = drained_states(keyed.stock_changes(stream, inventory), tmp_path)
    levels = [s.numRowsTotal for s in states if s.operatorName.startswith("transformWithState")]
    assert 0 < max(levels) <= 3  # one value for each bucket, not for each product
    got = spark.read.parquet(f"{tmp_path}/out").select("product_id", "sold_qty", "stock_qty", "alert_no").collect()
    assert sorted(map(tuple, got)) == sorted([(i, 1, 0, 1) for i in range(40)] + [(1, 1, 0, 2)])


def test_stock_and_alerts(spark, tmp_path):
    sold = lambda product, *minutes: [(product, T0 + timedelta(minutes=m)) for m in minutes]
    schema = "product_id long, sale_date timestamp_ntz"
    stream = batches(
        spark, str(tmp_path / "in"), schema,
        sold(1, 1, 2, 3, 25) + sold(2, 1) + sold(8, 1) + [(None, T0), (1, None)],
        sold(1, 45, 65) + sold(2, 70), sold(1, 85, 145), sold(3, 400))
    inventory = spark.createDataFrame(
        [(1, 5, 3), (2, 100, 1), (3, 9, 9), (4, 0, 9), (5, None, 1)], "product_id long, stock_qty int, restock_threshold int")
    changes = keyed.stock_changes(stream, inventory, "20 minutes", "10 minutes", timedelta(hours=1))
    out = drain(spark, changes, tmp_path)
    minute = lambda at: int((at - T0).total_seconds() // 60)
    got = [(p, minute(at), n, left, no) for p, at, n, left, _, no in rows(out.selectExpr(
        "product_id", "cast(at as timestamp_ntz)", "sold_qty", "stock_qty", "threshold", "alert_no"))]
    # product 1: below its threshold at 20; silent at 40 and 60; at 80 the alert of 20 is exactly an hour old
    assert sorted(got) == [(1, 20, 3, 2, 1), (1, 40, 1, 1, None), (1, 60, 1, 0, None), (1, 80, 1, 0, 2), (1, 100, 1, 0, None),
                           (1, 160, 1, 0, 3), (2, 20, 1, 99, None), (2, 80, 1, 98, None)]
    alerts = keyed.alerts_of(out)
    assert alerts.count() == alerts.select("alert_id").distinct().count() == 3
    assert alerts.where("product_id <> 1 or resolved").count() == 0
