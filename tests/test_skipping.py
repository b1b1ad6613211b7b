"""Clustered segments and their index: what is opened, and that nothing is lost by it."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.sources.commits import CommittedTable
from salesmart.sources.skipping import SkippingTable, with_curve

SCHEMA = T.StructType([
    T.StructField("sale_id", T.LongType()), T.StructField("product_id", T.LongType()), T.StructField("store", T.StringType()),
    T.StructField("sale_date", T.TimestampNTZType()), T.StructField("day", T.DateType()), T.StructField("ingest", T.StringType())])
TURNS = ["product_id", "sale_date", "product_id", "store"]


def sales(spark, n, run="a", first=0):
    """A third of all rows are product 7's, some have no product, store or date."""
    i = F.col("sale_id")
    mix = lambda seed, m: F.pmod(F.xxhash64(i, F.lit(seed)), F.lit(m))
    stamp = F.timestamp_seconds(F.lit(1_704_067_200) + mix(3, 60 * 86_400)).cast("timestamp_ntz")
    return spark.range(first, first + n).withColumnRenamed("id", "sale_id").select(
        "sale_id", F.when(i % 101 == 0, None).when(i % 3 == 0, 7).otherwise(mix(1, 1000)).alias("product_id"),
        F.when(i % 103 == 0, None).otherwise(F.concat(F.lit("s"), mix(2, 40))).alias("store"),
        F.when(i % 107 == 0, None).otherwise(stamp).alias("sale_date"),
        F.when(i % 107 == 0, None).otherwise(stamp.cast("date")).alias("day"), F.lit(run).alias("ingest"))


def ids(df):
    return sorted(r[0] for r in df.select("sale_id").collect())


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    table = SkippingTable(spark, str(tmp_path_factory.mktemp("skipping") / "t"), SCHEMA, TURNS, file_rows=200)
    rows = sales(spark, 60_000).cache()
    table.replace_run("a", rows)
    return table, rows


def test_a_search_opens_few_files_and_finds_all(filled):
    table, rows = filled
    files = table.index().count()
    assert files >= 300
    assert table.index().agg(F.max("rows"), F.sum("rows")).first() == (200, 60_000)
    for product in (0, 500, 999):
        assert ids(table.search({"product_id": product})) == ids(rows.where(F.col("product_id") == product)) != []
        assert len(table.files_for({"product_id": product})) < files / 10
    # The hot product has a third of all files; a few hours of it have few.
    hot = ("2024-01-10 00:00:00", "2024-01-11 00:00:00")
    found = table.search({"product_id": 7}, {"sale_date": hot})
    assert ids(found) == ids(rows.where(F.col("product_id") == 7).where(f"sale_date between timestamp_ntz'{hot[0]}' and timestamp_ntz'{hot[1]}'")) != []
    assert len(table.files_for({"product_id": 7}, {"sale_date": hot})) < files / 10
    assert len(found.inputFiles()) == len(table.files_for({"product_id": 7}, {"sale_date": hot}))
    assert ids(table.search({"product_id": 7})) == ids(rows.where("product_id = 7"))
    assert ids(table.search({"store": "s11", "product_id": 7})) == ids(rows.where("store = 's11' and product_id = 7"))


def test_nothing_matches_null_or_absent_values(filled):
    table, rows = filled
    assert table.search({"product_id": None}).count() == 0
    assert table.search({"product_id": 5000}).count() == 0 and table.files_for({"product_id": 5000}) == []
    assert table.search({}, {"sale_date": (None, datetime(2030, 1, 1))}).count() == 0
    assert ids(table.search({})) == ids(rows) == ids(table.read())
    with pytest.raises(ValueError, match="sale_id is not in the index"):
        table.search({"sale_id": 1})


def test_runs_versions_and_rebuilds(spark, tmp_path):
    path = str(tmp_path / "t")
    old = CommittedTable(spark, path, SCHEMA, ["day"], "ingest")
    first, second = sales(spark, 500, "a"), sales(spark, 500, "b", 500)
    old.replace_run("a", first)  # before the table had an index
    table = SkippingTable(spark, path, SCHEMA, TURNS, ["day"], "ingest", file_rows=100)
    assert ids(table.search({"product_id": 7})) == ids(first.where("product_id = 7"))
    before = table.replace_run("b", second)
    both = first.union(second)
    assert ids(table.search({"product_id": 7})) == ids(both.where("product_id = 7"))
    table.replace_all(both)
    table.replace_run("b", second.where("product_id <> 7"))  # strikes out its rows in the rebuilt segment
    assert ids(table.search({"product_id": 7})) == ids(first.where("product_id = 7"))
    assert ids(table.search({"product_id": 7}, version=before)) == ids(both.where("product_id = 7"))
    table.expire(datetime.now() + timedelta(days=400), grace_hours=-1)
    assert set(table._names("index")) == set(table._names("data"))
    assert ids(table.search({"product_id": 7})) == ids(first.where("product_id = 7"))


def test_empty_tables_and_one_value(spark, tmp_path):
    table = SkippingTable(spark, str(tmp_path / "t"), SCHEMA, TURNS, file_rows=10)
    assert table.search({"product_id": 7}).count() == 0
    table.replace_run("a", sales(spark, 50).limit(0))
    assert table.search({"product_id": 7}).count() == 0
    same = sales(spark, 95).withColumn("product_id", F.lit(3).cast("long")).withColumn("store", F.lit(None).cast("string"))
    table.replace_run("b", same)
    assert ids(table.search({"product_id": 3})) == ids(same) and table.search({"store": "s1"}).count() == 0
    assert table.index().count() >= 9


def test_the_curve_keeps_the_order_of_each_column(spark):
    rows = spark.range(4096).select((F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"))
    curve, n = with_curve(rows, ["x", "y"])
    assert n == 4096
    by_column = {c: [r[0] for r in curve.where(f"{other} = 0").orderBy(c).select("_curve").collect()] for c, other in (("x", "y"), ("y", "x"))}
    assert all(v == sorted(v) and len(set(v)) == 64 for v in by_column.values())
    # A fifth of the curve lies in a quarter of the square, whose border is only as exact as the quantiles are.
    fifth = curve.orderBy("_curve").limit(4096 // 5).agg(F.max("x"), F.max("y")).first()
    assert max(fifth) <= 32
