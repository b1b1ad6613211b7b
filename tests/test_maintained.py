"""Aggregates that are kept: corrected revenue, day totals, customer bitmaps."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.operators import cards, maintained, marts
from salesmart.schemas import MONEY
from salesmart.sources.commits import CommittedTable, MergedTable, SummedTable
from salesmart.streaming.revenue import RevenueMart

T0 = datetime(2024, 1, 1)
SALES = "sale_id string, store_id long, category string, amount decimal(10,2), sale_date timestamp_ntz, sale_date_only date"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def sales(spark, rng, n, first, last):
    out = []
    for i in range(n):
        at = T0 + timedelta(minutes=rng.randrange(first, last))
        out.append((str(i), rng.choice([1, 2, None]), rng.choice(["a", None]), Decimal(rng.randrange(1, 999)) / 100, at, at.date()))
    return spark.createDataFrame(out, SALES)


def test_late_sales_correct_published_hours(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    mart, batches = RevenueMart(spark, str(tmp_path / "r")), []
    for number, (first, last) in enumerate([(0, 120), (60, 300), (0, 310), (280, 600), (0, 40)]):
        batches.append(sales(spark, rng, 60, first, last))
        run = f"batch-{number:03d}"
        if number == 2:  # the run dies before its corrections are published, then is repeated
            with monkeypatch.context() as patch:
                patch.setattr(CommittedTable, "replace_run", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    mart.add(batches[-1], run)
        mart.add(batches[-1], run)
        if number == 3:
            mart.add(batches[-1], run)
        seen = batches[0]
        for more in batches[1:]:
            seen = seen.unionByName(more)
        want = marts.mart_sales(seen)
        mark = mart.watermark()
        assert mark == seen.agg(F.max("sale_date")).first()[0] - timedelta(hours=1)
        assert rows(mart.read(open_hours=True)) == rows(want)
        assert rows(mart.read()) == rows(want.where(F.col("sale_hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(mark)))
    mart.add(spark.createDataFrame([], SALES), "batch-005")
    late = [0]
    mark = None
    for batch in batches:
        if mark:
            late.append(batch.where(F.date_trunc("hour", "sale_date") <= F.lit(mark - timedelta(hours=1))).count())
        mark = max(filter(None, [mark, batch.agg(F.max("sale_date")).first()[0] - timedelta(hours=1)]))
    assert mart.late_rows() == sum(late) > 50
    # whoever applies the changes in order holds the published sums
    sign = F.when(F.col("kind") == "retract", -1).otherwise(1)
    applied = mart.changes.read().groupBy("store_id", "category", "sale_hour").agg(
        F.sum(sign * F.col("total_revenue")).cast(MONEY), F.sum(sign * F.col("order_count")), F.sum(sign * F.col("amounts")))
    assert rows(applied) == rows(mart.published.read())
    assert mart.changes.read().where("kind = 'retract'").count() > 0


def test_summed_runs_count_once_also_after_compaction(spark, tmp_path):
    log = SummedTable(spark, str(tmp_path / "s"), T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType())]), ["k"])
    assert log.read().count() == 0
    for run in range(9):
        change = spark.createDataFrame([(1, 1), (1, 1), (None, -1), (run, 5)], "k long, n long")
        assert log.add(f"{run:03d}", change)
        while log.compact_step():
            pass
        assert not log.add(f"{run:03d}", change)
    want = {(None, -9), (1, 23), (0, 5), *((k, 5) for k in range(2, 9))}
    assert set(map(tuple, log.read().collect())) == want
    assert set(map(tuple, spark.sql(log.view_sql()).collect())) == want
    assert len(log.table.segments()) < 9


def test_trend_card_follows_upserts_and_reads_changed_hours_only(spark, tmp_path):
    rng = random.Random(3)
    full = marts.mart_sales(sales(spark, rng, 500, 0, 60 * 24 * 40))
    schema = T.StructType(full.schema.fields)
    mart = MergedTable(spark, str(tmp_path / "m"), schema, marts.SALES_KEYS, marts.SALES_UPDATES)
    days = SummedTable(spark, str(tmp_path / "d"), T.StructType([
        T.StructField("day", T.DateType()), T.StructField("total_revenue", MONEY), T.StructField("orders", T.LongType())]), ["day"])
    known = full.where("store_id is not null")
    updates = [known, known.where("sale_hour >= '2024-01-20' and sale_hour < '2024-01-21'").withColumn("order_count", F.col("order_count") + 7),
               known.where("false")]
    for number, update in enumerate(updates):
        old = maintained.replaced_rows(mart.read(), update, marts.SALES_KEYS)
        if number == 1:
            plan = spark._jvm.PythonSQLUtils.explainString(old._jdf.queryExecution(), "formatted")
            assert "GreaterThanOrEqual(sale_hour,2024-01-20" in plan and "LessThanOrEqual(sale_hour,2024-01-20" in plan
        days.add(f"{number:03d}", maintained.day_changes(old, update))
        mart.upsert(update, keys_unique=True)
    for as_of in ("2024-02-05 11:30:00", "2024-01-31 00:00:00", "2024-03-20 00:00:00"):
        assert rows(maintained.sales_trend(days.read(), mart.read(), as_of)) == rows(cards.sales_trend_30d(mart.read(), as_of))


def test_distinct_customers_of_any_ids(spark):
    big = [0, 1, -1, -32768, -32769, 32767, 32768, 32769, 2**31, 2**31 + 5, 2**40, -(2**40), 2**62]
    found = [(c, datetime(2024, 1, 1 + i % 9), "x") for i, c in enumerate(big * 3)] + [(None, T0, "x"), (5, None, "x"), (7, datetime(2023, 12, 1), "x")]
    bitmaps = maintained.customer_bitmaps(spark.createDataFrame(found, "customer_id long, sale_date timestamp_ntz, day string").drop("day"))
    for days in (1, 3, 9, 400):
        first = date(2024, 1, 9) - timedelta(days=days - 1)
        want = len({c for c, at, _ in found if c is not None and at is not None and first <= at.date() <= date(2024, 1, 9)})
        assert maintained.distinct_customers(bitmaps, "2024-01-09", days).first().customers == want
    assert maintained.distinct_customers(bitmaps.where("false"), "2024-01-09", 3).first().customers == 0
