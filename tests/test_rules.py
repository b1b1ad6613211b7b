"""Rules with two antecedents against all triples, and histograms that choose their buckets."""

import random
from collections import Counter
from decimal import Decimal
from itertools import combinations

import pytest

from salesmart.operators import affinity, cards


def brute(baskets, n_customers, support, confidence):
    least = max(10, -(-support[0] * n_customers // support[1]))
    sets = Counter(c for basket in baskets.values() for k in (1, 2, 3) for c in combinations(sorted(basket), k))
    rules = {}
    for triple, n in sets.items():
        if len(triple) == 3 and n >= least:
            for z in triple:
                pair = tuple(x for x in triple if x != z)
                if n * confidence[1] >= sets[pair] * confidence[0]:
                    rules[*pair, z] = (n / len(baskets), n / sets[pair], n * len(baskets) / (sets[pair] * sets[z,]))
    return rules


@pytest.mark.parametrize("prefix", [affinity.PREFIX, 2])
def test_two_item_rules_equal_all_triples(spark, monkeypatch, prefix):
    monkeypatch.setattr(affinity, "PREFIX", prefix)
    rng = random.Random(prefix)
    popular = [f"p{i}" for i in range(9)]
    baskets = {}
    for i in range(260):
        customer = rng.choice([i, i + 2**33, -i * 40_000])  # ids far apart, negative ones too
        baskets[customer] = set(rng.sample(popular, rng.randrange(0, 8))) | {f"rare{rng.randrange(300)}"}
    baskets[5_000_000] = set(popular) | {f"rare{i}" for i in range(300)}
    rows = [(c, p) for c, basket in baskets.items() for p in basket] * 2 + [(None, "p1"), (None, "p2"), (77_777, None)]
    sales = spark.createDataFrame(rows, "customer_id long, product_name string")
    got = {(r.antecedent_a, r.antecedent_b, r.consequent): r for r in affinity.two_item_rules(sales, "0.05").collect()}
    want = brute(baskets, len(baskets) + (77_777 not in baskets), (1, 20), (1, 5))
    assert set(got) == set(want) and len(want) > 10
    for key, (support, confidence, lift) in want.items():
        assert [float(got[key][i]) for i in (3, 4, 5)] == pytest.approx([support, confidence, lift], abs=6e-5)


def test_no_frequent_triples(spark):
    sales = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c")], "customer_id long, product_name string")
    assert affinity.two_item_rules(sales).count() == 0
    assert affinity.two_item_rules(sales.where("false")).count() == 0


@pytest.mark.parametrize("values, width", [
    ([0, 30], "1"), ([0, 31], "2"), ([-5, 160], "10"), ([7], "0.0001"), (["0.0001", "0.0029"], "0.0001"), (["1.5", "2.6"], "0.05"),
    ([-1_000_000, 1_000_000, 3, None], "100000")])
def test_bucket_widths(spark, values, width):
    rows = [(None if v is None else Decimal(str(v)),) for v in values]
    frame = spark.createDataFrame(rows, "value decimal(18,4)")
    got = {r.bucket: r["values"] for r in cards.histogram(frame).collect()}
    step = Decimal(width)
    want = Counter(None if v is None else (v // step - (1 if v % step < 0 else 0)) * step for v, in rows)
    assert got == want
    assert cards.histogram(frame.where("false")).count() == 0
