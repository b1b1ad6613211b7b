"""A third of all rows in one sale id, one customer, one product: results stay whole, hot groups shrink early."""

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesmart.operators import affinity, marts, quality, recommend, rfm, silver
from salesmart.operators.gram import gram, pack_rows

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    i = F.col("id")
    return spark.range(0, N, 1, 8).select(
        F.when(i % 3 == 0, "hot").otherwise(i.cast("string")).alias("sale_id"),
        F.when(i % 3 == 1, 1).otherwise(i % 997).cast("bigint").alias("customer_id"),
        (i % 5).alias("store_id"),
        F.when(i % 3 == 2, 7).otherwise((i * 31 + (i / 997).cast("bigint")) % 60).cast("bigint").alias("product_id"),
        (i % 400 + 1).cast("decimal(10,2)").alias("amount"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=(i % 40_000).cast("int"))).alias("sale_date"),
        i.alias("seq"),
    )


@pytest.fixture(scope="module")
def facts(spark, hot):
    names = spark.range(50).select(F.col("id").alias("product_id"), F.concat(F.lit("p"), "id").alias("product_name"),
                                   (F.col("id") % 4).cast("string").alias("category"))
    return silver.enrich(quality.clean_batch(hot, ["seq"]), names).cache()


def test_hot_sale_id_keeps_its_first_row_only(hot, facts):
    assert facts.count() == N - N // 3 + 1
    assert hot.where("sale_id = 'hot'").agg(F.min("seq")).first()[0] == 0
    assert facts.where("sale_id = 'hot'").first().amount == 1


def test_marts_over_hot_groups_equal_pandas(facts):
    frame = facts.toPandas()
    frame["category"] = frame["category"].fillna("Unknown")
    frame["hour"] = pd.to_datetime(frame["sale_date"]).dt.floor("h")
    want = frame.groupby(["store_id", "category", "hour"])["amount"].agg(["sum", "count"]).reset_index()
    got = marts.mart_sales(facts).toPandas()
    keys = lambda rows: Counter((int(a), b, pd.Timestamp(c), float(d), int(e)) for a, b, c, d, e in rows)
    assert keys(got[["store_id", "category", "sale_hour", "total_revenue", "order_count"]].itertuples(index=False)) == keys(
        want.itertuples(index=False)
    )
    base = rfm.rfm_base(facts).toPandas().set_index("customer_id")
    assert base["frequency"].to_dict() == frame.groupby("customer_id").size().to_dict()


def test_pair_counts_of_a_hot_customer_equal_brute_force(facts):
    basket = affinity.customer_basket(facts)
    sets = basket.groupBy("customer_id").agg(F.collect_set("product_name").alias("s")).collect()
    assert max(len(r.s) for r in sets) >= 45
    want = Counter()
    for row in sets:
        names = sorted(row.s)
        want.update((a, b) for k, a in enumerate(names) for b in names[k + 1:])
    got = affinity.pair_support(basket, 12).collect()
    assert {(r.product_a, r.product_b): r.pair_customers for r in got} == {k: n for k, n in want.items() if n >= 12}


def test_gram_emits_sums_not_pairs(spark, facts):
    """The rows that leave the tasks are bounded by the columns, not by the baskets."""
    spend = recommend.user_item_spend(facts).withColumn("item", F.pmod("product_id", F.lit(60)))
    rows = pack_rows(spend.groupBy("customer_id", "item").agg(F.sum("spend").alias("spend")), "customer_id", "item", "spend")
    cells = gram(rows)
    assert cells.count() <= 60 * 61 // 2
    assert cells.where("i > j").isEmpty()


def test_recommendations_skip_everything_a_hot_customer_bought(facts):
    recs = recommend.recommend(facts, factors=5)
    bought = facts.select("customer_id", "product_id").distinct()
    assert recs.join(bought, ["customer_id", "product_id"], "left_semi").isEmpty()
    per = recs.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("r")).where("n <> r or n > 5")
    assert per.isEmpty()


@pytest.mark.parametrize("blocks", [3, 6, 12])
def test_a_task_emits_each_cell_about_once(monkeypatch, blocks):
    """Whatever the number of column blocks, a task emits at most one sum a cell each time it has gathered its fill."""
    from salesmart.operators import gram as G

    monkeypatch.setattr(G, "BLOCK", 8)
    monkeypatch.setattr(G, "CHUNK", 16)
    rng = np.random.default_rng(blocks)
    rows = [np.flatnonzero(rng.random(8 * blocks) < 0.5).astype(np.int32) for _ in range(200)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(part), pa.array([np.ones(len(r)) for r in part])], names=["idx", "val"])
        for part in (rows[:90], rows[90:])
    ]
    cells = pa.Table.from_batches(list(G._block_products(iter(batches))))
    dense = np.zeros((200, 8 * blocks))
    for i, r in enumerate(rows):
        dense[i, r] = 1
    want = np.triu(dense.T @ dense)
    got = np.zeros_like(want)
    np.add.at(got, (cells["i"].to_numpy(), cells["j"].to_numpy()), cells["x"].to_numpy())
    assert (got == want).all() and cells.num_rows == np.count_nonzero(want)
