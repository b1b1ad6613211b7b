"""Hand-made rows for the rules that sample data does not reach."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesmart.functions.expressions import at, elapsed_days, exact_mean, exact_ratio, rfm_segment
from salesmart.operators import affinity, marts, quality, recommend, rfm, silver, stock, upsert
from salesmart.operators.fast_track import fast_track_filter, fast_track_messages

SALE = "sale_id string, customer_id bigint, store_id bigint, product_id bigint, amount decimal(10,2), sale_date timestamp_ntz"


def sales(spark, *rows):
    full = [(r[0], r[1], r[2], r[3], None if r[4] is None else Decimal(str(r[4])), r[5], i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, SALE + ", seq int")


NOON = datetime(2024, 1, 15, 12, 0)


def products(spark):
    return spark.createDataFrame([(1, "one", "A"), (2, "two", "B")], "product_id bigint, product_name string, category string")


# --- quality and enrichment ---


def test_bad_first_row_takes_its_repeats_along(spark):
    df = sales(spark, ("s1", 1, 1, 1, -5, NOON), ("s1", 1, 1, 1, 10, NOON), ("s2", 1, 1, 1, 7, NOON))
    assert [r.sale_id for r in quality.clean_batch(df, ["seq"]).collect()] == ["s2"]


def test_incomplete_rows_go_but_store_and_date_may_be_missing(spark):
    df = sales(
        spark, (None, 1, 1, 1, 1, NOON), ("a", None, 1, 1, 1, NOON), ("b", 1, 1, None, 1, NOON),
        ("c", 1, 1, 1, None, NOON), ("d", 1, None, 1, 1, NOON), ("e", 1, 1, 1, 1, None),
    )
    assert sorted(r.sale_id for r in quality.clean_batch(df, ["seq"]).collect()) == ["d", "e"]
    counts = quality.quality_counts(df, ["seq"]).first()
    assert (counts.rows_before, counts.rows_after, counts.rows_dropped) == (6, 2, 4)


def test_incomplete_first_row_does_not_shadow_a_complete_one(spark):
    df = sales(spark, ("x", None, 1, 1, 5, NOON), ("x", 2, 1, 1, 6, NOON))
    assert [r.customer_id for r in quality.clean_batch(df, ["seq"]).collect()] == [2]
    assert quality.quality_counts(df, ["seq"]).first().rows_after == 1


def test_quality_counts_of_nothing(spark):
    assert tuple(quality.quality_counts(sales(spark), ["seq"]).first()) == (0, 0, 0)


def test_unknown_product_is_unknown_in_the_mart(spark):
    wide = silver.enrich(sales(spark, ("s", 1, 3, 99, 10, NOON)), products(spark))
    assert wide.first().product_name is None
    assert marts.mart_sales(wide).first().category == "Unknown"


def test_dedup_keeps_one_row_per_map_task_before_the_shuffle(spark):
    df = sales(spark, ("s", 1, 1, 1, 1, NOON))
    plan = quality.keep_first(df, ["sale_id"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


# --- expressions ---


@pytest.mark.parametrize(
    "now, then, days",
    [
        ("2024-01-02 00:10:00", "2024-01-01 23:50:00", 0),
        ("2024-01-02 00:00:00", "2024-01-02 00:30:00", -1),
        ("2024-01-09 12:00:00", "2024-01-02 12:00:00", 7),
        ("2024-01-09 11:59:59.999999", "2024-01-02 12:00:00", 6),
    ],
)
def test_elapsed_days(spark, now, then, days):
    assert spark.range(1).select(elapsed_days(at(now), at(then))).first()[0] == days


@pytest.mark.parametrize(
    "recency, frequency, segment",
    [(7, 5, "Champions"), (7, 4, "Loyal"), (14, 1, "Loyal"), (30, 1, "At Risk"), (31, 99, "Lost"), (-1, 5, "Champions"), (None, 9, "Lost")],
)
def test_segments(spark, recency, frequency, segment):
    df = spark.createDataFrame([(recency, frequency)], "r int, f bigint")
    assert df.select(rfm_segment(F.col("r"), F.col("f"))).first()[0] == segment


def test_mean_is_rounded_once(spark):
    # 0.00499999 must not become 0.005 and then 0.01.
    df = spark.createDataFrame([(Decimal("4999.99"), 1_000_000)], "t decimal(20,2), n bigint")
    assert df.select(exact_mean(F.col("t"), F.col("n"), 2)).first()[0] == Decimal("0.00")


def test_ratio_is_half_up_and_exact(spark):
    df = spark.createDataFrame([(1, 32), (63, 20000), (2, 3), (0, 5)], "a bigint, b bigint")
    got = [r[0] for r in df.select(exact_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("0.0313"), Decimal("0.0032"), Decimal("0.6667"), Decimal("0.0000")]


# --- stock ---


def stock_world(spark):
    inventory = spark.createDataFrame([(1, 3, 50), (2, 51, 50), (3, 60, 50), (4, 10, 50)], "product_id bigint, stock_qty int, restock_threshold int")
    sold = spark.createDataFrame([(1, 5), (2, 1), (3, 1)], "product_id bigint, sold_qty bigint")
    return inventory, sold


ALERTS = "alert_id bigint, product_id bigint, stock_qty int, threshold int, alert_time timestamp_ntz, resolved boolean"


def test_stock_floor_and_threshold(spark):
    inventory, sold = stock_world(spark)
    after = {r.product_id: r.stock_qty for r in stock.deduct_stock(inventory, sold).collect()}
    assert after == {1: 0, 2: 50, 3: 59, 4: 10}


def test_alerts_are_suppressed_for_one_hour_only(spark):
    inventory, sold = stock_world(spark)
    now = "2024-01-15 13:00:00"
    exactly = spark.createDataFrame([(7, 1, 0, 50, datetime(2024, 1, 15, 12, 0), False)], ALERTS)
    newer = spark.createDataFrame([(7, 1, 0, 50, datetime(2024, 1, 15, 12, 0, 1), False)], ALERTS)
    resolved = spark.createDataFrame([(7, 1, 0, 50, datetime(2024, 1, 15, 12, 30), True)], ALERTS)
    movement = stock.stock_movement(inventory, sold)

    def due(alerts):
        return {r.product_id: r.alert_id for r in stock.new_alerts(movement, alerts, now).collect()}

    assert due(exactly) == {1: 8, 2: 9}
    assert due(newer) == {2: 8}
    assert due(resolved) == {1: 8, 2: 9}
    assert due(exactly.limit(0)) == {1: 1, 2: 2}


def test_serial_ids_are_dense_across_buckets(spark):
    rows = spark.range(5000).withColumnRenamed("id", "product_id")
    start = spark.range(1).select(F.lit(10).cast("bigint").alias("m"))
    ids = [r[0] for r in upsert.assign_serial(rows, "product_id", start, "alert_id", buckets=16).select("alert_id").collect()]
    assert sorted(ids) == list(range(11, 5011))


# --- upsert ---

MART = "k string, s bigint, name string, qty int, updated_at timestamp_ntz"


def test_upsert_changes_only_update_columns(spark):
    old = spark.createDataFrame([("a", 1, "old", 1, NOON), ("b", 1, "keep", 2, NOON)], MART)
    new = spark.createDataFrame([("a", 1, "new", None), ("c", 1, "fresh", 9)], "k string, s bigint, name string, qty int")
    later = datetime(2024, 2, 1)
    got = {r.k: (r.name, r.qty, r.updated_at) for r in upsert.merge_upsert(old, new, ["k", "s"], ["qty"], at(later)).collect()}
    assert got == {"a": ("old", None, later), "b": ("keep", 2, NOON), "c": ("fresh", 9, later)}


def test_upsert_twice_is_once_except_for_null_keys(spark):
    empty = spark.createDataFrame([], MART)
    new = spark.createDataFrame([("a", 1, "x", 1), ("a", None, "y", 2)], "k string, s bigint, name string, qty int")
    once = upsert.merge_upsert(empty, new, ["k", "s"], ["qty"], at(NOON))
    twice = upsert.merge_upsert(once, new, ["k", "s"], ["qty"], at(NOON))
    assert once.count() == 2
    assert twice.count() == 3 and twice.where("s is null").count() == 2


def test_duplicate_key_in_one_upsert_fails(spark):
    empty = spark.createDataFrame([], MART)
    twice = spark.createDataFrame([("a", 1, "x", 1), ("a", 1, "y", 2)], "k string, s bigint, name string, qty int")
    with pytest.raises(PySparkException, match="duplicate key"):
        upsert.merge_upsert(empty, twice, ["k", "s"], ["qty"]).collect()
    nulls = spark.createDataFrame([("a", None, "x", 1), ("a", None, "y", 2)], "k string, s bigint, name string, qty int")
    assert upsert.merge_upsert(empty, nulls, ["k", "s"], ["qty"]).count() == 2
    assert [(r.k, r.copies) for r in upsert.duplicate_keys(twice, ["k", "s"]).collect()] == [("a", 2)]


def test_insert_if_absent_keeps_existing_rows(spark):
    old = spark.createDataFrame([(1, "old")], "id bigint, name string")
    new = spark.createDataFrame([(1, "new"), (2, "two")], "id bigint, name string")
    assert sorted(map(tuple, upsert.insert_if_absent(old, new, ["id"]).collect())) == [(1, "old"), (2, "two")]


# --- RFM ---


def history(spark):
    return sales(
        spark, ("a", 1, 1, 1, 10, datetime(2024, 1, 1, 8)), ("b", 1, 1, 1, 5, datetime(2024, 1, 10, 23, 30)),
        ("c", 2, 1, 1, 7, datetime(2024, 1, 11, 0, 0)), ("d", 1, 1, 1, 2, datetime(2024, 1, 11, 22, 59)),
        ("e", 3, 1, 1, 4, datetime(2024, 1, 11, 23, 0)), ("f", 3, 1, 1, 4, datetime(2024, 1, 12, 9, 0)),
    )


@pytest.mark.parametrize("split", ["2024-01-01 08:00:00", "2024-01-10 23:00:00", "2024-01-11 00:00:00", "2024-01-11 23:00:00"])
def test_incremental_equals_full_for_any_split(spark, split):
    as_of, rows = "2024-01-12 23:00:00", history(spark)
    step = rfm.rfm_incremental(rfm.rfm_full(rows, split, "as_of"), rows, split, as_of)
    assert sorted(map(tuple, step.collect())) == sorted(map(tuple, rfm.rfm_full(rows, as_of, "as_of").collect()))


def test_snapshot_date_boundary_counts_the_day_again(spark):
    rows = history(spark)
    first = rfm.rfm_full(rows, "2024-01-11 23:00:00", "as_of")
    again = rfm.rfm_incremental(first, rows, "2024-01-11 23:00:00", "2024-01-12 23:00:00", boundary="snapshot_date")
    got = {r.customer_id: (r.frequency, r.monetary) for r in again.collect()}
    # customer 2's midnight sale is not after midnight, customer 1's evening sale counts twice
    assert got == {1: (4, Decimal("19.00")), 2: (1, Decimal("7.00")), 3: (2, Decimal("8.00"))}
    with pytest.raises(ValueError):
        rfm.new_since(rows, "2024-01-11", "2024-01-12", boundary="other")


def test_delta_counts_dated_sales_only(spark):
    row = rfm.rfm_delta(sales(spark, ("a", 1, 1, 1, 10, NOON), ("b", 1, 1, 1, 5, None))).first()
    assert (row.frequency, row.monetary) == (1, Decimal("15.00"))


# --- fast track ---


def test_fast_track_limit_is_strict(spark):
    df = sales(spark, ("a", 1, 1, 1, 400, NOON), ("b", None, 1, 1, "400.01", NOON))
    assert [r.sale_id for r in fast_track_filter(df).collect()] == ["b"]
    message = fast_track_messages(df).first()
    assert message.key == "b"
    assert message.value == (
        '{"sale_id":"b","customer_id":null,"store_id":1,"product_id":1,"amount":400.01,"sale_date":"2024-01-15 12:00:00.000000"}'
    )


# --- affinity ---


def baskets(spark, *sets):
    rows = [(f"{c}{n}", c, 1, ord(n), 1, NOON) for c, names in enumerate(sets) for n in names]
    df = sales(spark, *rows)
    return df.withColumn("product_name", F.char("product_id"))


def brute_rules(sets, threshold, confidence):
    n, out = len([s for s in sets if s]), {}
    items = sorted({i for s in sets for i in s})
    count = {i: sum(i in s for s in sets) for i in items}
    for a in items:
        for b in items:
            both = sum(a in s and b in s for s in sets)
            if a != b and both >= threshold and both / count[a] >= confidence:
                out[a, b] = (both / n, both / count[a], both * n / (count[a] * count[b]))
    return out


@pytest.mark.parametrize("block", [2, 1024])
def test_rules_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr("salesmart.operators.gram.BLOCK", block)
    monkeypatch.setattr("salesmart.operators.gram.CHUNK", 3)
    monkeypatch.setattr("salesmart.operators.gram.HELD_CELLS", 6)
    sets = ["abc", "ab", "abd", "ac", "bcd", "abce", "de", "aab", "cd", "abcde"]
    got = {
        (r.antecedent, r.consequent): tuple(map(float, (r.support, r.confidence, r.lift)))
        for r in affinity.association_rules(baskets(spark, *sets), min_support="0.3", min_confidence="0.5").collect()
    }
    want = brute_rules([set(s) for s in sets], 3, 0.5)
    assert got.keys() == want.keys() and got
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=5.1e-5)
        assert got[key][::2] == got[key[1], key[0]][::2] if (key[1], key[0]) in got else True


def test_rules_equal_fpgrowth(spark):
    df = baskets(spark, "abc", "ab", "abd", "ac", "bcd", "abce", "de", "ab", "cd", "abcde")
    ours = affinity.association_rules(df, min_support="0.3", min_confidence="0.5")
    theirs = affinity.fpgrowth_rules(df, 0.3, 0.5)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_default_support_needs_ten_customers(spark):
    assert affinity.association_rules(baskets(spark, *["ab"] * 9)).count() == 0
    assert affinity.association_rules(baskets(spark, *["ab"] * 10)).count() == 2
    assert affinity.support_threshold(1500) == 15 and affinity.support_threshold(1501) == 16


def test_exact_confidence_passes_the_cut(spark):
    sets = ["ab"] * 7 + ["a"] * 28
    rules = affinity.association_rules(baskets(spark, *sets), min_support="0.1")
    assert ("a", "b") in {(r.antecedent, r.consequent) for r in rules.collect()}


def test_unnamed_products_are_in_no_basket(spark):
    df = baskets(spark, "ab").withColumn("product_name", F.when(F.col("product_name") == "a", F.col("product_name")))
    assert affinity.customer_basket(df).count() == 1


def test_sales_without_a_date_count_in_a_full_scan(spark):
    rows = spark.sql("""
        SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-01-10 00:00:00', 5.00BD), (1, NULL, 7.00BD), (2, NULL, 1.00BD),
               (1, TIMESTAMP_NTZ '2024-02-01 00:00:00', 2.00BD) AS t(customer_id, sale_date, amount)""")
    full = {r.customer_id: (r.frequency, str(r.monetary)) for r in rfm.rfm_full(rows, "2024-01-12 23:00:00").collect()}
    assert full == {1: (3, "14.00"), 2: (1, "1.00")}
    replay = {r.customer_id: r.frequency for r in rfm.rfm_full(rows, "2024-01-12 23:00:00", "as_of").collect()}
    assert replay == {1: 2, 2: 1}
    new = rfm.new_since(rows, "2024-01-11", "2024-02-02", undated=True)
    delta = {r.customer_id: (r.frequency, str(r.monetary)) for r in rfm.rfm_delta(new).collect()}
    assert delta == {1: (1, "9.00"), 2: (0, "1.00")}  # spend, but no frequency
    assert rfm.new_since(rows, "2024-01-11", "2024-02-02").count() == 1


def test_insert_if_absent_keeps_one_of_repeated_updates(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    updates = spark.createDataFrame([(2, "y"), (2, "x"), (1, "z"), (None, "a"), (None, "a")], "k int, v string")
    got = sorted(map(tuple, upsert.insert_if_absent(target, updates, ["k"], ["v"]).collect()), key=str)
    assert got == sorted([(1, "old"), (2, "x"), (None, "a"), (None, "a")], key=str)


def test_pivot_refuses_products_that_are_not_listed(spark):
    sales = spark.createDataFrame([(1, 10, 2.5), (1, 20, 1.0)], "customer_id int, product_id int, amount double").selectExpr(
        "customer_id", "product_id", "cast(amount as decimal(10,2)) amount")
    assert recommend.user_item_pivot(sales, [10, 20]).count() == 1
    with pytest.raises(Exception, match="product not in the list: 20"):
        recommend.user_item_pivot(sales, [10]).collect()
