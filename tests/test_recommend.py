"""Recommendations against a dense numpy SVD."""

import numpy as np
import pandas as pd
import pytest

from salesmart.operators import recommend as R


def make_sales(spark, customers, products, density, seed, decay=0.6):
    rng = np.random.default_rng(seed)
    rank = min(customers, products, 8)
    left, right = rng.gamma(1.0, 1.0, (customers, rank)), rng.gamma(1.0, 1.0, (rank, products))
    cells = (left * decay ** np.arange(rank)) @ right * 30 + rng.uniform(0, 5, (customers, products))
    mask = rng.random(cells.shape) < density
    rows = [
        (f"s{c}-{p}", int(c) + 1, int(p) * 3 + 2, f"name {p}", round(float(cells[c, p]), 2))
        for c, p in zip(*np.nonzero(mask))
    ]
    frame = pd.DataFrame(rows, columns=["sale_id", "customer_id", "product_id", "product_name", "amount"])
    sales = spark.createDataFrame(frame).selectExpr(
        "sale_id", "customer_id", "product_id", "product_name", "cast(amount as decimal(10,2)) amount",
        "timestamp_ntz '2024-01-01 00:00:00' as sale_date",
    )
    return sales, frame


def expected(frame, k, n):
    matrix = frame.pivot_table(index="customer_id", columns="product_id", values="amount", aggfunc="sum", fill_value=0)
    k = min(k, min(matrix.shape) - 1)
    u, s, vt = np.linalg.svd(matrix.to_numpy(), full_matrices=False)
    predicted = (u[:, :k] * s[:k]) @ vt[:k]
    bought = frame.groupby("customer_id")["product_id"].apply(set)
    out = []
    for row, customer in enumerate(matrix.index):
        ranked = sorted(
            ((-predicted[row, j], p) for j, p in enumerate(matrix.columns) if p not in bought[customer])
        )[:n]
        out += [(customer, p, r + 1, -s) for r, (s, p) in enumerate(ranked)]
    return out


def check(result, frame, k, n):
    got = {(r.customer_id, r["rank"]): (r.product_id, float(r.score)) for r in result.collect()}
    want = expected(frame, k, n)
    assert len(got) == len(want)
    for customer, product, rank, score in want:
        assert got[(customer, rank)][0] == product
        assert got[(customer, rank)][1] == pytest.approx(score, abs=1e-4)


def test_equal_dense_svd(spark):
    sales, frame = make_sales(spark, 60, 25, 0.4, 1)
    check(R.recommend(sales, factors=6), frame, 6, 5)


def test_scores_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "ITEM_BLOCK", 8)
    monkeypatch.setattr(R, "SCORE_CHUNK", 2)
    sales, frame = make_sales(spark, 40, 22, 0.5, 2)
    check(R.recommend(sales, factors=3), frame, 3, 5)


@pytest.mark.parametrize("shape, k", [((500, 99), 20), ((60, 150), 10)])
def test_factors_of_a_flat_spectrum(spark, shape, k):
    """Uniform random spend has no gap between its singular values."""
    matrix = np.random.default_rng(7).uniform(0, 100, shape)
    c, i = np.indices(shape)
    frame = pd.DataFrame({"customer_id": c.ravel(), "item": i.ravel().astype(np.int32), "spend": matrix.ravel()})
    cells = R.materialize(spark.createDataFrame(frame))
    vectors, width, passes = R.krylov_factors(cells, cells.select("item").distinct(), k, blocks=3)
    assert width == k and passes <= 100
    got = vectors.orderBy("item").drop("item").toPandas().to_numpy()
    want = np.linalg.svd(matrix, full_matrices=False)[2][:k].T
    assert np.abs(got @ got.T - want @ want.T).max() < 1e-6
    assert np.abs(got.T @ got - np.eye(k)).max() < 1e-9


def test_factor_count_is_capped_by_the_smaller_side(spark):
    sales, frame = make_sales(spark, 12, 5, 0.6, 3)
    check(R.recommend(sales), frame, 20, 5)


def test_one_product_gives_no_recommendations(spark):
    sales, _ = make_sales(spark, 5, 1, 1.0, 4)
    assert R.recommend(sales).count() == 0


def test_buyer_of_everything_gets_none_and_names_follow_first_sale(spark):
    rows = [(c, p) for c in (1, 2, 3) for p in (10, 20, 30) if c == 1 or p != 10 * c]
    sales = spark.createDataFrame(rows, "customer_id bigint, product_id bigint").selectExpr(
        "concat(customer_id, '-', product_id) sale_id", "customer_id", "product_id",
        "if(product_id = 20 and customer_id = 1, null, concat('n', customer_id, '-', product_id)) product_name",
        "cast(customer_id + product_id as decimal(10,2)) amount", "timestamp_ntz '2024-01-01 00:00:00' sale_date",
    )
    got = {(r.customer_id, r.product_id): r.product_name for r in R.recommend(sales).collect()}
    assert got == {(2, 20): None, (3, 30): "n1-30"}
    named = {r.product_id: r.product_name for r in R.recommend(sales, name_fallback=True).collect()}
    assert named[20] == "Product_20"


def test_ties_go_to_the_smaller_product_id():
    scores = np.array([[1.0, 2.0, 2.0, 2.0, 0.5]])
    none = np.zeros(0, dtype=int)
    _, cols, _ = R._best(scores, none, none, np.array([50, 40, 30, 20, 10]), 2)
    assert cols.tolist() == [3, 2]


@pytest.mark.parametrize("spectrum, share", [("flat", 1.0), ("decaying", 1 / 3)])
def test_blocks_out_of_reach_are_not_scored(spark, monkeypatch, spectrum, share):
    """Equal to all scores; where the lengths of the products' vectors decay, most scores are never computed."""
    monkeypatch.setattr(R, "ITEM_BLOCK", 16)
    rng = np.random.default_rng(5)
    n, m, k = 60, 400, 3
    v = rng.normal(size=(m, k))
    v *= (np.ones(m) if spectrum == "flat" else 0.97 ** np.arange(m))[:, None] / np.linalg.norm(v, axis=1)[:, None]
    v[50] = v[51] = v[49]  # ties
    spend = np.where(rng.random((n, m)) < 0.05, rng.integers(1, 100, (n, m)), 0).astype(float)
    spend[:, 0] = 1
    c, i = np.nonzero(spend)
    cells = R.materialize(spark.createDataFrame(pd.DataFrame({"customer_id": c, "item": i.astype(np.int32), "spend": spend[c, i]})))
    vectors = spark.createDataFrame(pd.DataFrame({"item": np.arange(m, dtype=np.int32), **{f"v{j}": v[:, j] for j in range(k)}}))
    items = spark.createDataFrame(pd.DataFrame({"item": np.arange(m, dtype=np.int32), "product_id": m - np.arange(m)}))
    scored = []
    best = R.top_per_customer(R.best_scores(cells, vectors, k, items, 5, n, scored).join(items, "item"), 5).toPandas()
    scores = np.where(spend > 0, -np.inf, spend @ v @ v.T)
    for customer in range(n):
        want = sorted(range(m), key=lambda x: (-round(scores[customer, x], 9), m - x))[:5]
        assert best[best.customer_id == customer].sort_values("rank").item.tolist() == want
    assert sum(scored) <= share * n * m
    assert len(scored) > 1
